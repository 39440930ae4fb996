"""Joining a large frame with a small per-key table.

A per-key aggregate (limits, statistics, brackets) has no size estimate before
it runs, so Spark plans a shuffle join and only adaptive execution turns it
into a broadcast, after the large side has been shuffled by a key that may
have only a handful of values. Here the small side is written to the shared
checkpoint folder and read back: Spark then knows its size in bytes and
broadcasts it exactly when it is within ``spark.sql.autoBroadcastJoinThreshold``;
beyond that the ordinary shuffle join with adaptive skew handling runs. The
aggregate is computed once either way, and no row passes through the driver.
The write runs when the join is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow.session import staging_path


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """``big.join(small, on, how)`` with ``small`` staged, so that its size in bytes decides the join."""
    path = staging_path(big.sparkSession, "join-side")
    small.write.mode("overwrite").parquet(path)
    return big.join(big.sparkSession.read.schema(small.schema).parquet(path), on, how)


def renamed(df: DataFrame, names, prefix: str = "_o") -> DataFrame:
    """``df`` with a prefix on the given columns, for joins with a frame that has the same names."""
    return df.withColumnsRenamed({n: prefix + n for n in names})


def same(names, prefix: str = "_o") -> Column:
    """Equality of the given columns with their ``renamed`` partners, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(prefix + n)) for n in names], F.lit(True))


def join_groups(left: DataFrame, right: DataFrame, names, how: str = "left") -> DataFrame:
    """``left`` and ``right`` joined on the given columns, null equal to null; the columns appear once."""
    return left.join(renamed(right, names), same(names), how).drop(*["_o" + n for n in names])
