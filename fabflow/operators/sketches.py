"""Distinct counts over any span of days from stored sketches, and heavy hitters with an exact check.

A sketch table holds one mergeable sketch per column and day. A span is
answered by merging its days' sketches, a new or corrected day rewrites its
own partition only, and the readings themselves are not read again. The exact
counts of :mod:`fabflow.operators.profile` stay beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Relative standard error of a HyperLogLog sketch with 2^k registers is 1.04 / 2^(k/2); of a theta sketch with 2^k entries 1 / 2^(k/2).
ERROR = {"hll": 1.04, "theta": 1.0}
KINDS = {"hll": (F.hll_sketch_agg, F.hll_union_agg, F.hll_sketch_estimate),
         "theta": (F.theta_sketch_agg, F.theta_union_agg, F.theta_sketch_estimate)}


def relative_error(kind: str = "hll", lg_k: int = 14) -> float:
    """One standard error of an estimate; three of them hold almost always."""
    return ERROR[kind] / 2 ** (lg_k / 2)


def _item(df: DataFrame, c: str) -> Column:
    """Values as the sketches take them: whole numbers, else text; NaN reads as missing."""
    t = dict(df.dtypes)[c]
    if t in ("double", "float"):
        return F.when(~F.isnan(F.col(c)), F.col(c)).cast("string")
    return F.col(c).cast("bigint") if t in ("bigint", "int", "smallint", "tinyint") else F.col(c).cast("string")


def distinct_sketches(df: DataFrame, columns, by: str = "date", kind: str = "hll", lg_k: int = 14) -> DataFrame:
    """``(by, column, rows, sketch)``: one sketch of the distinct values per column and day, in one pass."""
    make = KINDS[kind][0]
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, c in enumerate(columns):
        aggs.append(make(_item(df, c), lg_k).alias(f"_s{i}"))
        rows.append(F.struct(F.lit(c).alias("column"), F.col("_n").alias("rows"), F.col(f"_s{i}").alias("sketch")))
    return df.groupBy(by).agg(*aggs).select(by, F.inline(F.array(*rows)))


def store_sketches(sketches: DataFrame, path: str, by: str = "date") -> None:
    """Write or replace the days of ``sketches`` in the sketch table; other days are neither read nor written."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def distinct_over(spark: SparkSession, path: str, span: Column | None = None, kind: str = "hll") -> DataFrame:
    """``(column, rows, estimate)`` over the days of ``span`` (a condition on the day; all days by default)."""
    _, union, estimate = KINDS[kind]
    table = spark.read.parquet(path)
    table = table if span is None else table.filter(span)
    return table.groupBy("column").agg(F.sum("rows").alias("rows"), F.round(estimate(union("sketch"))).cast("bigint").alias("estimate"))


def distinct_shared(spark: SparkSession, path: str, first: Column, second: Column) -> DataFrame:
    """``(column, estimate)``: distinct values present in both of two spans, from theta sketches."""
    table = spark.read.parquet(path)
    merged = lambda span: table.filter(span).groupBy("column").agg(F.theta_union_agg("sketch").alias("s"))
    both = merged(first).join(merged(second).withColumnRenamed("s", "t"), "column")
    return both.select("column", F.round(F.theta_sketch_estimate(F.theta_intersection("s", "t"))).cast("bigint").alias("estimate"))


def heavy_hitters(df: DataFrame, column: str, k: int = 1, tracked: int = 10_000) -> DataFrame:
    """The ``k`` most frequent non-null values with exact counts, smaller values first on ties: ``(value, count, decided_by)``.

    A frequent-items summary of at most ``tracked`` values per task is merged over the tasks; it
    holds every value that stands more than 3.5 / tracked of all times. Only its candidates
    are counted, so distinct values are not shuffled. Where the k-th exact count does not lie above
    what a value outside the candidates may have, the exact grouping of all values decides instead;
    ``decided_by`` says which (``summary`` or ``full count``).
    """
    wanted = min(tracked, max(1000, 2 * k))
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    n, top = values.agg(F.count(F.lit(1)), F.expr(f"approx_top_k(value, {wanted}, {tracked})")).first()   # at most ``wanted`` candidates
    most = (F.desc("count"), F.asc("value"))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("value").agg(F.count(F.lit(1)).alias("count"))

    if top:
        candidates = [r["item"] for r in top]
        exact = counted(values.filter(F.col("value").isin(candidates))).orderBy(*most).limit(k).collect()
        least = exact[-1]["count"] if exact else 0
        unseen = max(3.5 / tracked * n, top[-1]["count"] if len(top) == wanted else 0)
        if (len(exact) == k and least > unseen) or (len(top) < wanted and n <= tracked // 2):
            return df.sparkSession.createDataFrame([(r["value"], r["count"], "summary") for r in exact],
                                                   f"value {dict(values.dtypes)['value']}, count bigint, decided_by string")
    return counted(values).orderBy(*most).limit(k).withColumn("decided_by", F.lit("full count"))
