"""Quality by Bradley-Terry ranking: scores learnt from preferences between documents.

A document of label 1 is preferred to one of label 0. With a score ``s = w . x`` the model says a
pair (i, j) is preferred as ``sigmoid(s_i - s_j)``, so the weights follow from logistic loss on
feature differences alone; a level common to all documents cancels out. The threshold is then a
quantile: the score above which as large a share of the training rows lies as is labelled
good. The reported score is ``sigmoid(s - cut + logit(0.7))``: it passes 0.7 exactly at that quantile.

Features are statistics of the text's shape (letters, symbols, words, lines, repeats), each turned
into steps at quantiles of the training rows, so that a weight is learnt per range and outliers
cannot dominate. Fitting takes every labelled row and all pairs of a good and a bad one: scores are whole
multiples of a small step, so the pairs need only the number of rows of either class per score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow.llm.labels import fold, training_rows
from fabflow.llm.rows import map_texts, staged

#: Steps per statistic.
STEPS = 12
#: Scores are whole multiples of 1/GRID.
GRID = 64
#: Trailing bits of a double that its cell leaves out.
CELL_BITS = 44
#: Pulls are summed in whole multiples of 1/UNIT of all rows of a class.
UNIT = 1 << 52


def _class_of_bytes() -> np.ndarray:
    """Groups of byte values: 0 lower, 1 upper, 2 digit, 3 space, 4 line end, 5 stops, 6 commas, 7 !?, 8 marks, 9 other ASCII, 10 beyond."""
    out = np.full(256, 9)
    for group, members in ((0, range(97, 123)), (1, range(65, 91)), (2, range(48, 58)), (3, b" \t\x0b\x0c"), (4, b"\n\r"),
                           (5, b"."), (6, b",;:"), (7, b"!?"), (8, b"#*$%&|<>@=_~^+/\\{}[]"), (10, range(128, 256))):
        out[list(members)] = group
    return out


GROUPS = _class_of_bytes()


def statistics(data: bytes) -> list[float]:
    """Shape of a text as numbers; every ratio is 0 for texts without words."""
    words = data.split()
    n = max(1, len(words))
    size = max(1, len(data))
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256)
    groups = np.bincount(GROUPS, hist, 11)
    share = hist[hist > 0] / size
    counts = Counter(words)
    twice = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    threes = len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in map(bytes.strip, data.split(b"\n")) if x]
    n_lines = max(1, len(lines))
    ends = sum(x[-1:] in b".!?" for x in lines)
    letters = max(1.0, groups[0] + groups[1] + groups[10])
    return [
        np.log1p(len(words)), np.log1p(len(data)), sum(map(len, words)) / n, max(map(len, words), default=0),
        *(groups / n).tolist(), groups[1] / letters, groups[8] / size, groups[2] / size,
        float(-(share * np.log(share)).sum()) if data else 0.0,
        len(counts) / n, counts.most_common(1)[0][1] / n if counts else 0.0, twice / n, pairs / n, threes / n,
        np.log1p(n_lines), len(set(lines)) / n_lines, len(words) / n_lines, ends / n_lines,
        (len(lines[0]) if lines else 0) / size,
    ]


def steps(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Step features: for each statistic, which of its cuts the value exceeds."""
    return (x[:, :, None] > cuts[None]).reshape(len(x), -1).astype(np.float64)


def _summed(df: DataFrame, count: Callable[[pa.RecordBatch], dict], keys: int) -> dict[tuple, int]:
    """Whole numbers counted per key over every row: per task first, then one shuffle of the counts."""
    names = [f"k{i}" for i in range(keys)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            total.update(count(batch))
        yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in total], pa.int64()) for i in range(keys)],
                                          pa.array(list(total.values()), pa.int64())], names=[*names, "n"])

    rows = df.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n")).collect()
    return {tuple(r[n] for n in names): r["n"] for r in rows}


def quantile_cuts(rows: DataFrame, n_stats: int) -> np.ndarray:
    """``STEPS`` cuts per statistic at the quantiles of every row, to 1/256 of the value.

    Rows are counted in cells of the values' leading bits (exponent and eight more), of which a
    statistic has some thousands at most; a cut is the largest value of its cell. No statistic is negative.
    """
    def cells(batch: pa.RecordBatch) -> dict:
        x = np.array(batch.column(0).flatten()).reshape(batch.num_rows, n_stats)
        out = {}
        for k in range(n_stats):
            cell, n = np.unique(np.ascontiguousarray(x[:, k] + 0.0).view(np.int64) >> CELL_BITS, return_counts=True)
            out |= {(k, int(c)): int(m) for c, m in zip(cell, n, strict=True)}
        return out

    counts = _summed(rows.select("stats"), cells, 2)
    cuts = np.zeros((n_stats, STEPS))
    for k in range(n_stats):
        cell, n = np.array(sorted((c, m) for (at, c), m in counts.items() if at == k)).T
        below = np.cumsum(n)
        at = np.searchsorted(below, below[-1] * np.arange(1, STEPS + 1) / (STEPS + 1))
        cuts[k] = (((cell[at] + 1) << CELL_BITS) - 1).view(np.float64)
    return cuts


def pulls(levels: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per level, how strongly each good row there is pulled up and each bad row down, over all pairs of the counted rows."""
    up, down = np.zeros(len(levels)), np.zeros(len(levels))
    for a in range(0, len(levels), 256):
        missed = 1 / (1 + np.exp(np.clip((levels[a:a + 256, None] - levels[None]) / GRID, -60, 60)))    # chance that the preference is missed
        up[a:a + 256] = missed @ bad / bad.sum()
        down += good[a:a + 256] @ missed / good.sum()
    return up, down


def fit(rows: DataFrame, rounds: int = 40, decay: float = 1e-4) -> dict:
    """Weights, cuts and threshold from every row ``(stats, label)`` and every preference pair of them.

    Weights are whole multiples of 1/GRID, so scores are too, and counting the rows of each class per
    score loses nothing: the loss over all pairs follows from these counts. A round is two passes over
    the rows, one for the counts and one for the gradient, which adds up each row's pull per statistic
    and step; sums are of whole numbers, so the partitioning does not change them.
    Without rows of both classes nothing can be preferred: all scores are equal.
    """
    n_stats = len(statistics(b""))
    classes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not classes.get(1) or not classes.get(0):
        return {"cuts": np.zeros((n_stats, 1)), "w": np.zeros(n_stats), "cut": 0.0 if classes.get(1) else 5.0}
    cuts = quantile_cuts(rows, n_stats)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(0).flatten()).reshape(batch.num_rows, n_stats)
            codes = np.stack([np.searchsorted(cuts[k], x[:, k]) for k in range(n_stats)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(1)], names=["codes", "label"])

    coded = staged(rows.select("stats", "label").mapInArrow(code, "codes binary, label int"), "quality-codes")

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return (np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, n_stats),
                np.array(batch.column(1)))

    def table(whole: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros((n_stats, 1), np.int64), np.cumsum(whole.reshape(n_stats, STEPS), axis=1)], axis=1)

    def levels_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def count(batch: pa.RecordBatch) -> dict:
            codes, label = read(batch)
            s = points[np.arange(n_stats), codes].sum(axis=1)
            return dict(Counter(zip(label.tolist(), s.tolist(), strict=True)))

        found = _summed(coded, count, 2)
        levels = np.array(sorted({s for _, s in found}))
        return levels, *[np.array([found.get((v, s), 0) for s in levels.tolist()], float) for v in (1, 0)]

    def gradient(points: np.ndarray, levels: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
        force = np.rint(np.stack([down / classes[0], -up / classes[1]]) * UNIT).astype(np.int64)     # by label and level

        def count(batch: pa.RecordBatch) -> dict:
            codes, label = read(batch)
            f = force[label, np.searchsorted(levels, points[np.arange(n_stats), codes].sum(axis=1))]
            out = np.zeros((n_stats, STEPS + 1), np.int64)
            for k in range(n_stats):
                np.add.at(out[k], codes[:, k], f)
            return {(k, b): int(out[k, b]) for k in range(n_stats) for b in range(STEPS + 1)}

        sums = np.zeros((n_stats, STEPS + 1))
        for (k, b), n in _summed(coded, count, 2).items():
            sums[k, b] = n / UNIT
        return np.cumsum(sums[:, ::-1], axis=1)[:, ::-1][:, 1:].ravel()       # a step's rows are those in the bins above it

    w, seen = np.zeros(n_stats * STEPS), np.full(n_stats * STEPS, 1e-8)
    whole = w.astype(np.int64)
    for _ in range(rounds):
        points = table(whole)
        levels, good, bad = levels_of(points)
        grad = gradient(points, levels, *pulls(levels, good, bad)) + decay * w
        seen += grad ** 2
        w -= 0.3 * grad / np.sqrt(seen)
        whole = np.rint(w * GRID).astype(np.int64)
    levels, good, bad = levels_of(table(whole))
    above = np.cumsum((good + bad)[::-1])
    at = len(levels) - 1 - int(np.searchsorted(above, good.sum()))            # the level at which as many rows are as are good
    return {"cuts": cuts, "w": whole / GRID, "cut": float(levels[max(0, at - 1)] + levels[at]) / (2 * GRID)}


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2) -> dict:
    """Fit on every labelled document outside the held-out fold."""
    rows = map_texts(training_rows(docs, labels, label, folds, held_out), ["label"], "text", lambda: lambda d: (statistics(d),), [("stats", "array<double>")])
    return fit(staged(rows, "quality-statistics"))


def score(df: DataFrame, model: dict, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` plus ``rank_score`` (the Bradley-Terry score) and ``score`` (0 to 1, 0.7 at the quantile).

    Every whole text is scored; null and empty texts count as texts without words. Equal texts get
    equal scores; repeated rows stay; other columns are ignored.
    """
    cuts, w, cut = model["cuts"], model["w"], model["cut"]

    def make():
        def row(data: bytes):
            s = float(steps(np.array([statistics(data)]), cuts)[0] @ w)
            return s, float(1 / (1 + np.exp(-(s - cut + np.log(0.7 / 0.3)))))

        return row

    return map_texts(df, keep, text, make, [("rank_score", "double"), ("score", "double")])


def predictions(scored: DataFrame, id_col: str = "doc_id", folds: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    return scored.select(
        F.col(f"`{id_col}`"), (fold(id_col, folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
