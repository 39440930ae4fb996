"""Pairwise co-moments of many columns as blocks of matrix products (AGG-16).

A task turns its rows into a matrix, missing values into a mask, and adds up
four products of columns by columns: pairs present, sums, sums of squares and
sums of products, each over the rows where both columns have a value. They
add up across tasks, so one pass and one shuffle of ``columns ^ 2`` rows per
task give every pair, where an expression per pair would make a plan of
columns ^ 2 aggregates. Columns are centred beforehand (one small pass), which
keeps the sums well conditioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of products a task holds for its groups before it hands them on.
HELD_BYTES = 64 << 20
#: Part of a column's squares below which its spread counts as rounding noise (a constant column).
NOISE = 1e-13


def _matrix(batch: pa.RecordBatch, first: int, n: int) -> np.ndarray:
    """Columns ``first`` to ``first + n`` of a batch as floats, missing values as NaN."""
    return np.stack([batch.column(first + i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(n)], axis=1)


def centres(values: DataFrame, n: int) -> np.ndarray:
    """A centre for each of the ``n`` columns: its only value, else its mean (0 without a finite value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(n, np.int64), np.zeros(n)
        low, high = np.full(n, np.inf), np.full(n, -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, 0, n)
            ok = np.isfinite(x)
            count += ok.sum(axis=0)
            total += np.where(ok, x, 0).sum(axis=0)
            low, high = np.minimum(low, np.where(ok, x, np.inf).min(axis=0)), np.maximum(high, np.where(ok, x, -np.inf).max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(count), pa.array(total), pa.array(low), pa.array(high)],
                                         names=["i", "n", "s", "low", "high"])

    part = values.mapInArrow(run, "i int, n long, s double, low double, high double")
    out = np.zeros(n)
    for r in part.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect():
        if r["n"]:                                             # one row per column
            out[r["i"]] = r["low"] if r["low"] == r["high"] else r["s"] / r["n"]
    return out


def pair_sums(values: DataFrame, groups: list[str], n: int, centre: np.ndarray) -> DataFrame:
    """``(group..., i, j, n, sx, sxx, sxy, wild)`` over the rows where columns i and j have values.

    ``sx`` and ``sxx`` are the sums of column i and of its squares, ``wild`` counts infinite values
    of column i; those of column j stand in the row of (j, i).
    """
    g = len(groups)
    limit = max(1, HELD_BYTES // (40 * n * n))

    def rows(held: dict, group_types: list) -> Iterator[pa.RecordBatch]:
        i, j = (a.ravel().astype(np.int32) for a in np.indices((n, n)))
        for key, sums in held.items():
            some = np.nonzero(sums[0].ravel())[0]
            yield pa.RecordBatch.from_arrays(
                [*[pa.repeat(k, len(some)).cast(t) for k, t in zip(key, group_types, strict=True)], pa.array(i[some]), pa.array(j[some]),
                 *[pa.array(s.ravel()[some]) for s in sums]],
                names=[*groups, "i", "j", "n", "sx", "sxx", "sxy", "wild"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, types = {}, []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.column(k).type for k in range(g)]
            x = _matrix(batch, g, n) - centre
            keys = list(zip(*[batch.column(k).to_pylist() for k in range(g)], strict=True)) if g else [()] * len(x)
            codes = {}
            code = np.fromiter((codes.setdefault(k, len(codes)) for k in keys), np.int64, len(keys))
            scalars = {c: tuple(pa.scalar(v, t) for v, t in zip(k, types, strict=True)) for k, c in codes.items()}
            for k, c in codes.items():
                part = x[code == c] if g else x
                there = ~np.isnan(part)
                wild = np.isinf(part)
                m, v = there.astype(np.float64), np.where(there & ~wild, part, 0.0)
                sums = (m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v, wild.astype(np.float64).T @ m)
                held[k] = (scalars[c], [a + b for a, b in zip(held[k][1], sums, strict=True)]) if k in held else (scalars[c], list(sums))
            if len(held) >= limit:
                yield from rows({s: v for s, v in held.values()}, types)
                held = {}
        yield from rows({s: v for s, v in held.values()}, types)

    fields = [*[T.StructField(c, values.schema[c].dataType) for c in groups], T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
              *[T.StructField(c, T.DoubleType()) for c in ("n", "sx", "sxx", "sxy", "wild")]]
    part = values.mapInArrow(run, T.StructType(fields))
    return part.groupBy(*groups, "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy", "wild")])
