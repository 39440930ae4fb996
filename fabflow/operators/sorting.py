"""Ordering, limits, samples and set operations (SRT, SET).

Per-group head/tail use ``row_number`` with a rank filter, which Spark plans
as a group limit evaluated before the shuffle (at most ``n`` rows per group
leave each map task). Global top-n uses ``orderBy().limit()`` (a bounded
take-ordered). Samples order by a seeded hash of a key, so they are stable
across reruns and partitionings. The exact-k sample is computed without a
global sort: a histogram of the hash's top bits finds the boundary bucket,
and only that bucket is ranked, both by distributed running totals.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabflow.operators.running import running_totals

DEFAULT_ORDER = ("timestamp", "wafer_id")


def _order(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def head_rows(df: DataFrame, n: int = 5, order=DEFAULT_ORDER, group=None) -> DataFrame:
    """First ``n`` rows by ``order`` (per group when given)."""
    o = _order(order)
    if not group:
        return df.orderBy(*o).limit(n)
    g = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*g).orderBy(*o)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def tail_rows(df: DataFrame, n: int = 5, order=DEFAULT_ORDER, group=None) -> DataFrame:
    """Last ``n`` rows by ``order`` (per group when given), returned in ascending order."""
    o = _order(order)
    desc = [F.col(c).desc() for c in o]
    if not group:
        return df.orderBy(*desc).limit(n).orderBy(*o)
    g = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*g).orderBy(*desc)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def sample_key(key: str, seed: int = 42) -> Column:
    """Stable pseudo-random order key: md5 of ``seed:key`` (same text in any engine)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_rows(df: DataFrame, n: int = 5, key: str = "wafer_id", seed: int = 42, group=None) -> DataFrame:
    """min(n, rows) rows chosen by the seeded hash order (per group when given).

    Whole table: a bounded take-ordered. Per group: a rank filter on the same
    order, which Spark runs as a group limit before the shuffle.
    """
    h = df.withColumn("_h", sample_key(key, seed))
    if not group:
        return h.orderBy("_h", key).limit(n).drop("_h")
    g = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*g).orderBy("_h", key)
    return h.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn", "_h")


def sort_by_size(df: DataFrame, measure: str) -> DataFrame:
    return df.orderBy(F.desc(measure))


def row_text(df: DataFrame) -> Column:
    """The whole numbers, texts, flags and times (as microseconds) of a row as one text; nulls are skipped."""
    def text(c: str, t: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp")).cast("string") if t.startswith("timestamp") else F.col(c).cast("string")
    return F.concat_ws("|", *[text(c, t) for c, t in df.dtypes
                              if t in ("bigint", "int", "smallint", "tinyint", "string", "boolean", "date") or t.startswith("timestamp")])


def exact_sample(df: DataFrame, rate: float, key: str = "wafer_id", seed: int = 42,
                 bucket_bits: int = 20, copies_per_chunk: int = 1_000_000, take_ordered: bool = False) -> DataFrame:
    """Exactly ``floor(rows * rate)`` rows without replacement, chosen by seeded hash order.

    Order: md5 of ``seed:key``, then the key, then a hash of the whole row. A
    row without a key is ordered by its own text (:func:`row_text`) instead, so
    such rows are drawn one by one like any others. The hash's first
    ``bucket_bits`` bits form buckets; bucket counts (at most 2^bucket_bits
    rows) give the boundary bucket by a running total, and rows in earlier
    buckets are taken whole. Inside the boundary bucket identical rows
    are collapsed to one group with a copy count before ranking, so a key
    holding a third of all rows is one ranked group, not a third of the data
    in one task; a partially taken group is regenerated in chunks spread over
    tasks. No global sort and no window over all rows; the same path at every
    size. A caller who knows the sample to be small may ask for
    ``take_ordered``: ``orderBy().limit(k)`` gives the same rows with fewer
    jobs, and one task merges k rows per input partition. The row count and
    the boundary bucket are found when the sample is built.
    """
    from fabflow.operators.joins import join_small
    cols = df.columns
    named = F.coalesce(F.col(key).cast("string"), row_text(df))
    tagged = (df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), named)))
              .withColumn("_rh", F.xxhash64(*[F.col(c) for c in cols])))
    n = df.count()                                   # size check: one number
    k = math.floor(n * float(rate))
    gkeys = ["_h", key, "_rh"]
    if take_ordered or k == 0:
        return tagged.orderBy(*gkeys).limit(k).select(*cols)
    hexd = (bucket_bits + 3) // 4
    tagged = tagged.withColumn("_b", F.shiftright(F.conv(F.substring("_h", 1, hexd), 16, 10).cast("long"), 4 * hexd - bucket_bits))
    counts = running_totals(tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")), "_b", "_n", "_cum")
    bb, need = counts.filter((F.col("_cum") >= k) & (F.col("_cum") - F.col("_n") < k)).select(
        "_b", k - (F.col("_cum") - F.col("_n"))).first()       # two numbers

    below = tagged.filter(F.col("_b") < bb).select(*cols)
    edge = tagged.filter(F.col("_b") == bb)
    groups = edge.groupBy(*gkeys).agg(F.count(F.lit(1)).alias("_c"),
                                      F.first(F.struct(*[F.col(c) for c in cols])).alias("_row"))
    ranked = running_totals(groups, gkeys, "_c", "_cum")
    whole = ranked.filter(F.col("_cum") <= need).select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(gkeys)])
    same = F.col("_h").eqNullSafe(F.col("_w0")) & F.col(key).eqNullSafe(F.col("_w1")) & (F.col("_rh") == F.col("_w2"))
    whole_rows = join_small(edge, whole, same, "left_semi").select(*cols)
    part = ranked.filter((F.col("_cum") > need) & (F.col("_cum") - F.col("_c") < need)).select(
        "_row", (need - (F.col("_cum") - F.col("_c"))).alias("_m"))
    chunk = F.lit(copies_per_chunk)
    chunks = (part.select("_row", "_m", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_m") / chunk) - 1)).alias("_k"))
              .repartition("_k"))
    copies = chunks.select("_row", F.explode(F.sequence(
        F.lit(1), F.least(chunk, F.col("_m") - F.col("_k") * chunk))).alias("_i")).select("_row.*")
    return below.unionByName(whole_rows).unionByName(copies)


def append_batches(batches: list[DataFrame]) -> DataFrame:
    """Concatenate batches by column name (one dataset)."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def missing_columns(df: DataFrame, expected) -> list[str]:
    """Expected columns the frame lacks (schema metadata, no job)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def missing_columns_table(df: DataFrame, expected) -> DataFrame:
    """One row per expected column: its name, whether the frame has it, and its type there."""
    types = dict(df.dtypes)
    rows = [(c, c in types, types.get(c)) for c in expected]
    return df.sparkSession.createDataFrame(rows, "column string, present boolean, dtype string")
