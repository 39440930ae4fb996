"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes a single space, and all 1-, 2- and 3-grams of
code points are hashed into ``BUCKETS`` buckets. A bucket weighs ``(1 + log tf) * idf``, rows are
scaled to length 1. Document frequencies come from every learnable text (one narrow pass whose tasks
hand back at most BUCKETS sums); the weights are fitted on up to ``per_lang`` texts per language by
follow-the-regularised-leader with an elastic net (L1 keeps most weights at zero), streamed from a
staged table; the texts of a fifth of the sample are left for calibration, which divides the logits
by the temperature of least log loss.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabflow.llm.labels import fold
from fabflow.llm.rows import bytes_of, map_texts, staged

BUCKETS = 1 << 16
#: Bytes of text turned into n-grams at a time.
PIECE_BYTES = 1 << 20
#: Distinct language values a model may have: it holds at most MAX_LANGS * BUCKETS weights.
MAX_LANGS = 1000
#: The answer for texts without letters.
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(data: bytes) -> Iterator[str]:
    start = 0
    while start < len(data):
        end = min(len(data), start + PIECE_BYTES)
        while end < len(data) and data[end] & 0xC0 == 0x80:       # not inside a character
            end += 1
        yield data[start:end].decode("utf-8", "replace").lower()
        start = end


def _buckets(key: np.ndarray) -> np.ndarray:
    x = key * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(48)).astype(np.int64)


def grams(data: bytes, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers in order and how often each occurs; both empty for a text without letters.

    The text goes through in pieces; two characters carry over, so n-grams across a cut count.
    """
    total, before, seen = np.zeros(BUCKETS, np.int64), np.full(1, 32, np.uint64), False
    for text in _pieces(data):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        alpha = letters[points]
        seen = seen or bool(alpha.any())
        c = np.concatenate((before, np.where(alpha, points, 32).astype(np.uint64)))
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c, k = c[keep], len(before)
        two = (c[:-1] << np.uint64(21)) | c[1:]
        three = (c[:-2] << np.uint64(42)) | two[1:]
        found = np.concatenate((c[k:], two[k - 1:], three[max(0, k - 2):]))
        total += np.bincount(_buckets(found), minlength=BUCKETS)
        before = c[-2:]
    if not seen:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.nonzero(total)[0]
    return ids, total[ids]


def weighted(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[ids]
    return x / np.sqrt((x * x).sum())


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts with letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, seen = letter_table(), np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for i in range(batch.num_rows):
                ids, _ = grams(texts[i].as_py() or b"", letters)
                seen[ids] += 1
                seen[BUCKETS] += len(ids) > 0
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    sums = docs.select(bytes_of(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = np.zeros(BUCKETS + 1, np.int64)
    for r in sums.collect():                                       # at most BUCKETS + 1 rows of two numbers
        df[r["bucket"]] = r["n"]
    return df[:BUCKETS], int(df[BUCKETS])


def sample(docs: DataFrame, per_lang: int) -> tuple[DataFrame, list[str]]:
    """Up to ``per_lang`` rows ``(id, lang, text)`` of each language, least by hash of the id, and the languages.

    Only rows whose hash is low enough for about twice that number are ranked, so no task ranks a
    whole language. Rows equal in id, language and text count once.
    """
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} language values")
    draw = F.shiftrightunsigned(F.xxhash64("id"), 1)
    low = F.lit(False)
    for lang, n in sorted(counts.items()):
        share = (2 * per_lang + 100) / n
        low = low | ((F.col("lang") == lang) & (draw <= F.lit(min(int(share * 2.0 ** 63), 2 ** 63 - 1))))
    rows = docs.filter(low).withColumn("draw", draw).withColumn("mark", F.xxhash64("text")).dropDuplicates(["id", "lang", "mark"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "mark"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= per_lang).select("id", "lang", "draw", "mark", "text"), sorted(counts)


def ftrl(rows: Callable[[], Iterator[tuple]], k: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS, k) and bias (k) by follow-the-regularised-leader, one example at a time.

    ``rows()`` yields ``(bucket numbers, weights, class)`` in a fixed order. The bias has no penalty.
    """
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    free = np.ones((1, 1))

    def weights(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for ids, x, label in rows():
            zi, ni = z[ids], n[ids]
            w, b = weights(zi, ni, l1, l2), weights(z[-1:], n[-1:], 0.0, 0.0)
            logits = x @ w + b[0]
            g = np.exp(logits - logits.max())
            g /= g.sum()
            g[label] -= 1
            for at, old, now, features in ((ids, ni, w, x[:, None]), ([BUCKETS], n[-1:], b, free)):
                step = features * g
                z[at] += step - (np.sqrt(old + step * step) - np.sqrt(old)) / alpha * now
                n[at] += step * step
    return weights(z[:-1], n[:-1], l1, l2), weights(z[-1:], n[-1:], 0.0, 0.0)[0]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss (its slope in 1 / temperature only rises)."""
    low, high = 0.05, 20.0
    if not len(logits):
        return 1.0
    own = logits[np.arange(len(labels)), labels]
    for _ in range(60):
        mid = (low * high) ** 0.5
        p = np.exp(mid * (logits - logits.max(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        low, high = (mid, high) if ((p * logits).sum(axis=1) - own).sum() < 0 else (low, mid)
    return 1 / (low * high) ** 0.5


def train(docs: DataFrame, folds: int = 4, held_out: int = 2, per_lang: int = 1000, id_col: str = "doc_id", text: str = "text",
          lang: str = "lang") -> dict:
    """Model of the language of a text, from rows with id, text and language outside the held-out fold."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("id", folds) != held_out))
    df, n = document_frequencies(rows, "text")
    few, langs = sample(rows, per_lang)
    idf = np.log((1 + n) / (1 + df)) + 1
    if not langs:
        return {"langs": []}

    def make():
        letters = letter_table()

        def row(data: bytes):
            ids, counts = grams(data, letters)
            return ids.astype(np.int32).tobytes(), counts.tobytes()
        return row

    taught = staged(map_texts(few, ["lang", "draw", "id", "mark"], "text", make, [("ids", "binary"), ("counts", "binary")]), "language-sample")
    of = {v: i for i, v in enumerate(langs)}

    def stream(calibrating: bool) -> Iterator[tuple]:
        chosen = taught.filter((F.pmod("mark", F.lit(5)) == 0) == calibrating)       # equal texts fall to one side
        for r in chosen.orderBy("draw", "id", "mark", "lang").toLocalIterator():
            ids = np.frombuffer(r["ids"], np.int32)
            if len(ids):
                yield ids, weighted(ids, np.frombuffer(r["counts"], np.int64), idf), of[r["lang"]]

    weights, bias = ftrl(lambda: stream(False), len(langs))
    held = [(x @ weights[ids] + bias, label) for ids, x, label in stream(True)]
    heat = temperature(np.array([z for z, _ in held]).reshape(len(held), len(langs)), np.array([y for _, y in held], int))
    used = np.nonzero(np.abs(weights).sum(axis=1))[0]
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    return {"langs": langs, "idf": idf, "place": place, "weights": weights[used], "bias": bias, "temperature": heat}


def score(df: DataFrame, model: dict, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` plus ``lang_pred`` and ``score``, the calibrated probability of that language.

    Null, empty and letterless texts, and all texts under a model of no language, are ``und`` with
    score 0. Ties go to the language first in order. Whole texts count; repeated rows stay; other
    columns, whatever their names, are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(dict(model))

    def make():
        state = shared.value
        if "letters" not in state:
            state["letters"] = letter_table()                      # once per worker process
        letters, langs = state["letters"], state["langs"]

        def row(data: bytes):
            ids, counts = grams(data, letters)
            if not len(ids) or not langs:
                return UNDETERMINED, 0.0
            x, at = weighted(ids, counts, state["idf"]), state["place"][ids]
            z = (x[at >= 0] @ state["weights"][at[at >= 0]] + state["bias"]) / state["temperature"]
            p = np.exp(z - z.max())
            best = int(p.argmax())
            return langs[best], float(p[best] / p.sum())
        return row

    return map_texts(df, keep, text, make, [("lang_pred", "string"), ("score", "double")])


def predictions(scored: DataFrame, id_col: str = "doc_id", folds: int = 4, held_out: int = 2) -> DataFrame:
    return scored.select(F.col(f"`{id_col}`"), (fold(id_col, folds) == held_out).alias("held_out"), "lang_pred", "score")
