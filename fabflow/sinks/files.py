"""File and table writers (SNK-1..4, 8, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.sources.files import enforce_schema


def to_wire(df: DataFrame, encoding: str = "iso") -> DataFrame:
    """Telemetry with its timestamp as wire text: ISO-8601 (``iso``) or epoch milliseconds (``millis``)."""
    ts = F.col("timestamp").cast("timestamp")
    text = F.date_format(ts, C.ISO_FORMAT) if encoding == "iso" else F.unix_millis(ts).cast("string")
    return df.withColumn("timestamp", text)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "iso") -> None:
    """One JSON object per line; ``mode="append"`` adds batches after the first."""
    to_wire(df, encoding).write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_json_lines(df: DataFrame, path: str, encoding: str = "iso") -> None:
    write_json_lines(df, path, "append", encoding)


def bronze_frame(df: DataFrame) -> DataFrame:
    """Explicit 8-column schema plus the event ``date`` partition column."""
    return enforce_schema(df).withColumn("date", F.to_date("timestamp"))


def write_parquet_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Snappy Parquet with the explicit schema (no index column, no extras)."""
    enforce_schema(df).write.mode(mode).option("compression", "snappy").parquet(path)


def date_partitioned_archive(df: DataFrame, path: str, mode: str = "append") -> None:
    """Archive partitioned Hive-style by event date (``date=YYYY-MM-DD``), so date filters prune."""
    bronze_frame(df).write.mode(mode).option("compression", "snappy").partitionBy("date").parquet(path)


def object_store_path(bucket: str, prefix: str = C.ARCHIVE_PREFIX, scheme: str = "s3a") -> str:
    return f"{scheme}://{bucket}/{prefix.strip('/')}"


def object_store_conf(endpoint: str, access_key: str, secret_key: str, path_style: bool = True) -> dict:
    """Hadoop S3A settings for an S3-compatible endpoint (set on the session builder)."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def save_table(df: DataFrame, name: str, mode: str = "append", partition_by=("date",), path: str | None = None) -> None:
    """Layer table in the catalog (Parquet; partitioned by date); ``path`` makes it an external table."""
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
