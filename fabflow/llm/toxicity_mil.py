"""Toxicity by multiple-instance learning: sentences scored, combined by noisy-or, trained from document labels.

A sentence is toxic with probability ``p = sigmoid(b + sum of the weights of its distinct words)``;
a document is toxic unless every sentence is harmless and the leak, one learnt probability that
stands for causes unseen, spares it: ``P = 1 - (1 - leak) * prod(1 - p)``. Only documents carry labels, so the gradient of the document's log-likelihood is shared out among its sentences by how
likely each is the cause. A word's weight is the sum of the hashed weights of the word and of its
first three, four and five letters, which generalises to inflected forms not seen in training.

Training is a few dozen full-gradient steps on a bounded sample of labelled rows (``per_class``).
Spark computes their features, counts in how many documents each stands, and keeps the telling ones;
only sentences cut down to those reach the driver, equal ones of a document once with their number,
so what it holds does not grow with the length of the texts as such. Everything else reads every row
and whole texts.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow.llm.labels import fold, training_sample
from fabflow.llm.rows import Memo, map_texts, staged

#: Hashed weights.
BITS = 20
#: Labelled rows of either class that the model is fitted on, at most.
PER_CLASS = 2000
#: Sentences end at . ! ? ; and line ends; other ASCII punctuation and digits separate words; A-Z become a-z.
CUT = bytes(10 if c in b".!?;\n\r" else c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of a word: itself and its first letters."""
    mask, letters = (1 << BITS) - 1, word.decode("utf-8", "replace").lower()
    names = {letters[:3] + "_3", letters[:4] + "_4", letters[:5] + "_5", letters + "_w"}
    return tuple(sorted(zlib.crc32(n.encode()) & mask for n in names))


def sentences(data: bytes) -> Iterator[set[bytes]]:
    """Distinct words of each sentence that has any, one sentence at a time."""
    cut, start = data.translate(CUT), 0
    while start <= len(cut):
        end = cut.find(b"\n", start)
        end = len(cut) if end < 0 else end
        words = set(cut[start:end].split())
        if words:
            yield words
        start = end + 1


def bag(data: bytes) -> tuple[bytes, bytes]:
    """Hashed features of all sentences in a row, and how many each sentence has (int32, packed)."""
    ids, sizes = array("i"), array("i")
    for s in sentences(data):
        before = len(ids)
        for w in sorted(s):
            ids.extend(word_features(w))
        sizes.append(len(ids) - before)
    return ids.tobytes(), sizes.tobytes()


def feature_counts(bags: DataFrame) -> DataFrame:
    """``(feature, n1, n0)``: in how many toxic and harmless documents each hashed feature stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for label, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n[label, np.unique(np.frombuffer(packed.as_py(), "<i4"))] += 1
        at = np.nonzero(n.any(axis=0))[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[1, at]), pa.array(n[0, at])], names=["feature", "n1", "n0"])

    part = bags.select("label", "features").mapInArrow(run, "feature long, n1 long, n0 long")
    return part.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def telling(counts: DataFrame, pos: int, neg: int) -> np.ndarray:
    """The features found in toxic documents more often than chance allows, in order.

    Log-likelihood ratio of the document counts against one common rate, held against the number of
    features looked at (about one false feature is expected among all of them).
    """
    looked_at = max(1, counts.count())
    rate = F.least(F.greatest((F.col("n1") + F.col("n0")) / F.lit(float(max(1, pos) + max(1, neg))), F.lit(1e-12)), F.lit(1 - 1e-12))

    def term(k: Column, n: int) -> Column:
        n = F.lit(float(max(1, n)))
        some = F.when(k > 0, k * F.log(k / (n * rate))).otherwise(F.lit(0.0))
        return some + F.when(k < n, (n - k) * F.log((n - k) / (n * (F.lit(1.0) - rate)))).otherwise(F.lit(0.0))

    ratio = 2 * (term(F.col("n1"), pos) + term(F.col("n0"), neg))
    oftener = F.col("n1") / F.lit(float(max(1, pos))) > F.col("n0") / F.lit(float(max(1, neg)))
    found = counts.filter((ratio > F.lit(2 * float(np.log(looked_at)))) & oftener).select("feature").collect()     # 2^BITS numbers at most
    return np.array(sorted(r["feature"] for r in found), np.int64)


def cut_down(bags: DataFrame, known: np.ndarray) -> DataFrame:
    """``(label, ids, sizes, times, plain)``: the distinct sentences with telling features, how often each stands, and the number of the others."""
    shared = bags.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << BITS, bool)
        keep[shared.value] = True
        for batch in batches:
            out = []
            for label, features, sizes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids, size = np.frombuffer(features, "<i4"), np.frombuffer(sizes, "<i4")
                sent = np.repeat(np.arange(len(size)), size)
                ok = keep[ids]
                ids, sent = ids[ok], sent[ok]
                starts = np.nonzero(np.diff(sent, prepend=-1))[0]
                groups = Counter(p.tobytes() for p in np.split(ids, starts[1:])) if len(ids) else Counter()
                ordered = sorted(groups.items())
                out.append((label, b"".join(k for k, _ in ordered), np.array([len(k) // 4 for k, _ in ordered], "<i4").tobytes(),
                            np.array([n for _, n in ordered], "<i4").tobytes(), len(size) - len(starts)))
            if out:
                types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types, strict=True)],
                                                 names=["label", "ids", "sizes", "times", "plain"])

    return bags.select("label", "features", "sizes").mapInArrow(run, "label int, ids binary, sizes binary, times binary, plain long")


def fit(rows: Sequence[tuple], counts: dict[int, int], have: dict[int, int], steps: int = 300, decay: float = 3e-4) -> dict:
    """Weights and bias from the rows of :func:`cut_down`, weighted to the classes' full counts.

    Without rows of both classes nothing can be learnt: the model then scores every text alike, near
    zero (or near one where only positive rows exist).
    """
    weights = np.zeros(1 << BITS, np.float32)
    if not have[0] or not have[1]:
        return {"weights": weights, "bias": -20.0, "leak": -9.0 if not have[1] else 3.0}
    kept = [r for r in rows if r[3] or r[4]]
    y = np.array([r[0] for r in kept], np.float64)
    ids = np.concatenate([np.frombuffer(r[1], "<i4") for r in kept]) if kept else np.zeros(0, np.int32)
    sizes = np.concatenate([np.frombuffer(r[2], "<i4") for r in kept]) if kept else np.zeros(0, np.int32)
    times = np.concatenate([np.frombuffer(r[3], "<i4") for r in kept]).astype(np.float64) if kept else np.zeros(0)
    plain = np.array([r[4] for r in kept], np.float64)
    scale = [counts.get(v, have[v]) / have[v] for v in (0, 1)]
    cost = np.where(y == 1, scale[1], scale[0])
    cost = cost / cost.sum()
    used, ids = np.unique(ids, return_inverse=True)
    sent_of = np.repeat(np.arange(len(sizes)), sizes)
    doc_of = np.repeat(np.arange(len(kept)), [len(r[2]) // 4 for r in kept])
    w, b, c = np.zeros(len(used)), -7.0, -3.0
    gw, gb, gc = np.full(len(used), 1e-8), 1e-8, 1e-8
    for _ in range(steps):
        z = np.bincount(sent_of, w[ids], len(sizes)) + b
        softplus = np.logaddexp(0, z)
        h = np.bincount(doc_of, times * softplus, len(kept)) + plain * np.logaddexp(0, b) + np.logaddexp(0, c)
        # d loss / d z: sigmoid(z) for harmless documents, -sigmoid(z) * (1 - P) / P for toxic ones
        share = np.where(y == 1, -1 / np.expm1(np.minimum(np.maximum(h, 1e-9), 500)), 1.0) * cost
        gz = times * np.exp(z - softplus) * share[doc_of]
        grad = np.bincount(ids, gz[sent_of], len(used)) + decay * w / len(used) ** 0.5 if len(used) else w
        gw += grad ** 2
        gbias = gz.sum() + (plain * share).sum() / (1 + np.exp(-b))
        gleak = share.sum() / (1 + np.exp(-c))
        gb, gc = gb + gbias ** 2, gc + gleak ** 2
        w -= 0.4 * grad / np.sqrt(gw)
        b -= 0.2 * gbias / np.sqrt(gb)
        c -= 0.2 * gleak / np.sqrt(gc)
    weights[used] = w
    return {"weights": weights, "bias": float(b), "leak": float(c)}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1,
          per_class: int = PER_CLASS) -> dict:
    """Fit on at most ``per_class`` labelled documents of either class outside the held-out fold."""
    sample, counts = training_sample(docs, labels, label, folds, held_out, per_class)
    bags = staged(map_texts(sample, ["label"], "text", lambda: bag, [("features", "binary"), ("sizes", "binary")]), "toxicity-bags")
    size = bags.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.length("sizes") > 0).alias("spoken"))
    have, spoken = {0: 0, 1: 0}, {0: 0, 1: 0}
    for r in size.collect():
        have[r["label"]], spoken[r["label"]] = r["n"], r["spoken"]
    if not have[0] or not have[1]:
        return fit([], counts, have)
    known = telling(staged(feature_counts(bags), "toxicity-features"), spoken[1], spoken[0])
    rows = [(r["label"], bytes(r["ids"]), bytes(r["sizes"]), bytes(r["times"]), r["plain"]) for r in cut_down(bags, known).collect()]
    rows.sort()                                                 # sums do not depend on the partitioning
    return fit(rows, counts, have)


def score(df: DataFrame, model: dict, keep: Sequence[str] = ("doc_id",), text: str = "text",
          offending: float = 0.5) -> DataFrame:
    """``keep`` plus ``score`` (P of the whole text), ``n_sentences`` and the offending sentences.

    ``from_bytes`` / ``to_bytes`` are the byte ranges of sentences with probability ``offending`` or
    more. Null, empty and wordless texts have no sentences and score the leak. Repeated rows stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(dict(model))

    def make():
        state = shared.value
        memo = state.setdefault("memo", None) or Memo(200_000)
        state["memo"] = memo
        weights, bias = state["weights"], state["bias"]

        def look(word: bytes) -> float:
            got = memo.old.get(word)
            if got is None:
                got = float(sum([weights[f] for f in word_features(word)]))
            return memo.put(word, got) if len(word) <= 64 else got

        def row(data: bytes):
            z, hot, at = [], [], 0
            for part in data.translate(CUT).split(b"\n"):
                words = set(part.split())
                if words:
                    young, total = memo.young, bias
                    for w in sorted(words):              # fixed order: equal texts get equal scores
                        v = young.get(w)
                        if v is None:
                            v = look(w)
                            young = memo.young
                        total += v
                    z.append(total)
                    if total >= cut:
                        hot.append((at, at + len(part)))
                at += len(part) + 1
            h = leak + (float(np.logaddexp(0, z).sum()) if z else 0.0)
            return float(-np.expm1(-h)), len(z), [a for a, _ in hot], [e for _, e in hot]

        leak = float(np.logaddexp(0, state["leak"]))
        cut = float(np.log(offending / (1 - offending)))
        return row

    return map_texts(df, keep, text, make, [("score", "double"), ("n_sentences", "int"),
                                            ("from_bytes", "array<int>"), ("to_bytes", "array<int>")])


def predictions(scored: DataFrame, id_col: str, folds: int, held_out: int, threshold: float = 0.7) -> DataFrame:
    return scored.select(
        F.col(f"`{id_col}`"), (fold(id_col, folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
