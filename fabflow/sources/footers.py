"""Row counts, value counts and ranges from Parquet footers alone (AGG-1, AGG-23, DQ-9).

Spark answers ``count``, ``min`` and ``max`` from the statistics in the file
footers when the files are read through its version-2 source with aggregate
push-down, so no column is read. Both are settings; they are made in a session
of their own (same cluster, own settings), and the caller's stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types whose ranges Parquet footers give reliably; texts and timestamps are not among them.
RANGED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean")


def footer_session(spark: SparkSession) -> SparkSession:
    s = spark.newSession()
    s.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    s.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return s


def footer_row_count(spark: SparkSession, path: str) -> DataFrame:
    """``row_count`` of the Parquet files at ``path``."""
    return footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


def footer_ranges(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """``(column, row_count, value_count, null_count, min_value, max_value)`` from footers, values as text.

    ``columns`` default to every column of a RANGED type; others raise, since asking for one of them
    would make Spark read the files.
    """
    df = footer_session(spark).read.parquet(path)
    types = dict(df.dtypes)
    cols = [c for c, t in df.dtypes if t in RANGED] if columns is None else list(columns)
    if wrong := [c for c in cols if types.get(c) not in RANGED]:
        raise ValueError(f"no footer ranges for columns {wrong}")
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"_c{i}"), F.min(c).alias(f"_l{i}"), F.max(c).alias(f"_h{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("_n").alias("row_count"), F.col(f"_c{i}").alias("value_count"),
                     (F.col("_n") - F.col(f"_c{i}")).alias("null_count"), F.col(f"_l{i}").cast("string").alias("min_value"),
                     F.col(f"_h{i}").cast("string").alias("max_value")) for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))
