"""Where each key of a partitioned table is stored, as a bucketed table.

Finding the partitions that hold the keys of an increment is a join of the
increment with this table. The table is bucketed and sorted by key, so only
the increment is dealt by key (or broadcast, where it is small): the stored
side is read in place, however large, and its data columns are not read at all.

The table only grows: every upsert appends the keys it wrote with a higher
number, the highest number of a key tells where it is, and
:func:`compact_key_table` rewrites it with one row per key when that pays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.session import staging_path

BUCKETS = 64


def _write(rows: DataFrame, name: str, key: str, mode: str, buckets: int) -> None:
    (rows.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name))


def build_key_table(spark: SparkSession, table_path: str, name: str, key: str = "wafer_id", partition_col: str = "date",
                    schema: T.StructType | None = None, buckets: int = BUCKETS) -> None:
    """Create or replace the key table of a Parquet table (one read of its key column)."""
    table = (spark.read.schema(schema) if schema is not None else spark.read).parquet(table_path)
    rows = table.filter(F.col(key).isNotNull()).select(key, partition_col, F.lit(0).cast("long").alias("seq"))
    _write(rows, name, key, "overwrite", buckets)


def _buckets(spark: SparkSession, name: str) -> int:
    return int(next(r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Num Buckets"))


def current_partitions(spark: SparkSession, name: str, key: str = "wafer_id", partition_col: str = "date") -> DataFrame:
    """``(key, partition_col)``: where every key is now; grouped inside the buckets."""
    return _latest(spark.table(name), key, partition_col)


def _latest(entries: DataFrame, key: str, partition_col: str) -> DataFrame:
    return (entries.groupBy(key).agg(F.max_by(F.struct(partition_col), "seq").alias("_at"))
            .select(key, F.col(f"_at.{partition_col}").alias(partition_col)))


def stored_partitions(spark: SparkSession, name: str, keys: DataFrame, key: str = "wafer_id", partition_col: str = "date") -> DataFrame:
    """The partitions that hold rows of the given keys now (one row per key found)."""
    return _latest(spark.table(name).join(keys, key, "left_semi"), key, partition_col).select(partition_col)


def record_keys(rows: DataFrame, name: str, key: str = "wafer_id", partition_col: str = "date") -> None:
    """Note where an upsert has put the given keys."""
    spark = rows.sparkSession
    last = spark.table(name).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    fresh = rows.filter(F.col(key).isNotNull()).select(key, partition_col, F.lit(last + 1).cast("long").alias("seq"))
    _write(fresh, name, key, "append", _buckets(spark, name))


def compact_key_table(spark: SparkSession, name: str, key: str = "wafer_id", partition_col: str = "date") -> None:
    """Rewrite the key table with one row per key."""
    buckets, path = _buckets(spark, name), staging_path(spark, "key-table")
    current_partitions(spark, name, key, partition_col).write.mode("overwrite").parquet(path)       # cuts the read of the files being replaced
    kept = spark.read.schema(spark.table(name).select(key, partition_col).schema).parquet(path)
    _write(kept.select("*", F.lit(0).cast("long").alias("seq")), name, key, "overwrite", buckets)
