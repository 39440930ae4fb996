"""Deduplication and duplicate discovery.

Latest-wins dedup is an aggregate, not a window: ``max(struct(order, row))``
per key is computed partially on every map task before the shuffle (Spark
plans a sort aggregate, as the buffer is a struct), so a key holding a third
of all rows collapses to one row per task instead of landing whole in one sort. The struct comparison gives a total order (timestamp
first, then every other column), so the survivor is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, key: str | list[str] = "wafer_id", order: str | list[str] = "timestamp") -> DataFrame:
    """Keep one row per key: greatest ``order``, ties broken by all other columns (descending, nulls last).

    Rows without a key (a null in any key column) are not copies of each other:
    they all stay, except that fully identical ones collapse.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    best = df.groupBy(*keys, F.when(keyless, packed).alias("_own")).agg(F.max(packed).alias("_best"))
    return best.select(*[F.col(k) for k in keys], *[F.col(f"_best.{c}").alias(c) for c in order + rest]) \
        .select(*df.columns)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Fully identical rows collapse to one (hash aggregate on all columns)."""
    return df.dropDuplicates()


def duplicate_key_counts(df: DataFrame, key: str = "wafer_id") -> DataFrame:
    """Keys that occur more than once, with their occurrence count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def duplicate_rows_of_key(df: DataFrame, key: str = "wafer_id") -> DataFrame:
    """Every row whose key repeats (semi join against the repeated keys)."""
    return df.join(duplicate_key_counts(df, key).select(key), on=key, how="left_semi")
