"""Vector code compression: product codebooks by a few integer k-means rounds, searched by equal averages.

Every component ``x`` becomes the integer ``floor(scale * x)`` and every vector is cut into ``parts``
equal consecutive parts, each with a codebook of its own. All arithmetic is on integers, so codes and
codebooks do not depend on the partitioning.

The nearest entry of a part is found by equal-average search: entries are sorted by component sum and
tried outward from the part's own sum. As ``(sum gap)^2 / dimension`` never exceeds the squared
distance, a side is done once that bound strictly exceeds the best distance so far; equality goes on,
so that ties can still go to the lower index.

Rounds are one narrow pass each: a task adds up its parts by entry and hands back at most
``parts * entries`` rows, Spark adds those, and the driver holds the codebooks alone
(``entries * dimension`` integers, whatever the number of vectors).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabflow.llm.rows import staged
from fabflow.operators.joins import join_small

#: Input partitions whose smallest rows meet in one task before the last merge.
BUNDLE = 256


def kept_vectors(df: DataFrame, vec_id: str, vector: str, label: str, scale: int, parts: int) -> DataFrame:
    """``(id, label, x)``: integer components of the vectors that are whole.

    Null vectors and vectors with null, NaN or infinite components go. A length that ``parts`` does
    not divide, or a component too large for exact sums of squares in 64 bits, raises.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    whole = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), v.alias("v")).filter(F.coalesce(whole, F.lit(False)))
    width = F.greatest(F.lit(1), F.size("v") / parts)
    bad = F.exists("v", lambda x: F.abs(x * scale) >= F.lit(2.0 ** 28) / width)
    x = (F.when(F.size("v") % parts != 0, F.raise_error(F.lit(f"the length of a vector is no multiple of {parts}")))
         .when(bad, F.raise_error(F.lit("a component is too large for exact 64-bit distances")))
         .otherwise(F.transform("v", lambda x: F.floor(x * scale).cast("long"))))
    return rows.select("id", "label", x.alias("x"))


def first_vectors(rows: DataFrame, n: int) -> list[list[int]]:
    """The ``n`` vectors least by (id, components); rows without an id come last.

    Two bounded merges, so that the last task reads a fixed share of rows per input partition.
    """
    order = [F.col("id").asc_nulls_last(), F.col("x")]
    near = rows.select("id", "x", F.floor(F.spark_partition_id() / BUNDLE).alias("bundle"))
    rank = F.row_number().over(Window.partitionBy("bundle").orderBy(*order))
    few = near.withColumn("rank", rank).filter(F.col("rank") <= n)
    return [list(r["x"]) for r in few.orderBy(*order).limit(n).select("x").collect()]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest of ``entries`` for every row of ``x`` (ties: lower index)."""
    m, k = x.shape
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, ordered = sums[order], entries[order]
    own = x.sum(axis=1)
    right = np.searchsorted(sums, own)
    best = np.full(m, np.iinfo(np.int64).max // max(k, 1))
    index = np.full(m, len(entries))
    sides = [(right - 1, -1, np.arange(m)), (right, 1, np.arange(m))]
    for step in range(len(entries)):
        for at, (start, way, live) in enumerate(sides):
            e = start[live] + way * step
            inside = (e >= 0) & (e < len(entries))
            live, e = live[inside], e[inside]
            gap = sums[e] - own[live]
            still = gap * gap <= best[live] * k                    # done once the bound strictly exceeds the best
            live, e = live[still], e[still]
            d = ((x[live] - ordered[e]) ** 2).sum(axis=1)
            name = order[e]
            better = (d < best[live]) | ((d == best[live]) & (name < index[live]))
            won = live[better]
            best[won], index[won] = d[better], name[better]
            sides[at] = (start, way, live)
        if not len(sides[0][2]) and not len(sides[1][2]):
            break
    return index, best


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances, both (rows, parts), of ``x`` (rows, dimension) by ``books`` (parts, entries, width)."""
    parts, _, width = books.shape
    found = [nearest(x[:, p * width:(p + 1) * width], books[p]) for p in range(parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != dim).any():
        raise ValueError(f"vectors of other lengths than {dim}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def next_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; unused entries stay."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        total = np.zeros((parts * entries, width), np.int64)
        n = np.zeros(parts * entries, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), parts * width)
            codes, _ = assign(x, books)
            for p in range(parts):
                place = codes[:, p] + p * entries
                np.add.at(total, place, x[:, p * width:(p + 1) * width])
                n += np.bincount(place, minlength=parts * entries)
        used = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), *[pa.array(total[used, i]) for i in range(width)]],
                                         names=["place", "n", *[f"s{i}" for i in range(width)]])

    names = ["n", *[f"s{i}" for i in range(width)]]
    schema = "place long, " + ", ".join(f"{c} long" for c in names)
    sums = (rows.select("x").mapInArrow(run, schema).groupBy("place")
            .agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names]).collect())     # parts * entries rows at most
    new = books.copy().reshape(parts * entries, width)
    for r in sums:
        new[r["place"]] = [int(r[f"s{i}"]) // int(r["n"]) for i in range(width)]
    return new.reshape(books.shape)


def train(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray | None:
    """Codebooks (parts, entries, width) of ``kept_vectors`` rows; None without rows.

    They start as the parts of the ``entries`` rows of least id; with fewer rows there are fewer entries.
    """
    start = first_vectors(rows, entries)
    if not start:
        return None
    if len({len(v) for v in start}) > 1:
        raise ValueError("vectors of different lengths")
    books = np.array(start, np.int64).reshape(len(start), parts, len(start[0]) // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = next_books(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, codes, error)``: 0-based entry numbers in part order and the summed squared distance."""
    parts, _, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, d = assign(_matrix(batch.column(2), parts * width), shared.value)
            ends = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
            listed = pa.ListArray.from_arrays(ends, pa.array(codes.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed, pa.array(d.sum(axis=1).astype(np.int64))],
                                             names=["id", "label", "codes", "error"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {types['id']}, label {types['label']}, codes array<int>, error long")


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components as decimal integers by part, entry and position, joined by commas."""
    listed = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest()


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
             parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, np.ndarray | None]:
    """``(vec_id, label, codes, error, label_error)`` per kept row, and the codebooks.

    ``label_error`` is the error summed over equal labels, nulls together. Null vectors and vectors
    with null or non-finite components go; null ids come last in the start order, rows equal in id
    start in the order of their components, and repeated rows stay. An empty table gives an empty
    result and no codebooks; other columns, whatever their names, are not read. Vectors of another
    length than the first, or of one that ``parts`` does not divide, raise ValueError or Spark's error.
    """
    rows = kept_vectors(df, vec_id, vector, label, scale, parts)
    books = train(rows, parts, entries, rounds)
    if books is None:
        coded = rows.select("id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        coded = coded.withColumn("label_error", F.col("error"))
    else:
        coded = staged(encode(rows, books), "vector-codes")
        sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
        coded = join_small(coded, sums, F.expr("label <=> of"), "inner")
    return coded.select(F.col("id").alias(vec_id), F.col("label").alias(label), "codes", "error", "label_error"), books


ORACLE_OP13 = """
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER (ORDER BY vec_id) AS r
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM e, range(16) AS t(p)),
c0 AS (SELECT p, r - 1 AS j, x AS y FROM d WHERE r <= 64),
a1 AS (SELECT r, p, any_value(x) AS x, min(s) AS s FROM (SELECT r, p, x, 64 * list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))) + j AS s FROM d JOIN c0 USING (p)) GROUP BY r, p),
m1 AS (SELECT p, j, list(f ORDER BY i) AS y FROM (SELECT p, s % 64 AS j, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS f FROM a1, range(1, 65) AS u(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY p, j),
c1 AS (SELECT c0.p, c0.j, coalesce(m1.y, c0.y) AS y FROM c0 LEFT JOIN m1 ON c0.p = m1.p AND c0.j = m1.j),
a2 AS (SELECT r, p, any_value(x) AS x, min(s) AS s FROM (SELECT r, p, x, 64 * list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))) + j AS s FROM d JOIN c1 USING (p)) GROUP BY r, p),
m2 AS (SELECT p, j, list(f ORDER BY i) AS y FROM (SELECT p, s % 64 AS j, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS f FROM a2, range(1, 65) AS u(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY p, j),
c2 AS (SELECT c1.p, c1.j, coalesce(m2.y, c1.y) AS y FROM c1 LEFT JOIN m2 ON c1.p = m2.p AND c1.j = m2.j),
a3 AS (SELECT r, p, min(s) AS s FROM (SELECT r, p, 64 * list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))) + j AS s FROM d JOIN c2 USING (p)) GROUP BY r, p),
f AS (SELECT r, string_agg(printf('%02x', CAST(s % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(s // 64) AS BIGINT) AS error FROM a3 GROUP BY r),
h AS (SELECT sha256(coalesce(string_agg(array_to_string(y, ','), ',' ORDER BY p, j), '')) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM e JOIN f USING (r), h"""
