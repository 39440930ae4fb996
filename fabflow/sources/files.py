"""File and table readers (SRC-1, 2, 5, 6, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow import constants as C
from fabflow.functions.scalar import parse_event_time

CORRUPT = "_corrupt_record"


def read_parquet_files(spark: SparkSession, path: str, schema: T.StructType | None = None,
                       file_col: str = "source_file") -> DataFrame:
    """Parquet files (glob allowed) with the source file's full path kept as a column.

    The path, not the bare name, identifies a file: writers reuse names such as
    ``part-00000-<job>.parquet`` in every partition folder. Scan options
    (pushdown, pruning) are untouched: ``_metadata`` is a hidden column of the
    scan, not an extra pass.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.withColumn(file_col, F.col("_metadata.file_path"))


def file_name(file_col: str = "source_file"):
    """Last path segment of a file path column."""
    return F.element_at(F.split(F.col(file_col), "/"), -1)


def batch_label(file_col: str = "source_file"):
    """Batch time label cut from an archive file name (characters 22..27, ``HHMMSS``)."""
    return F.substring(file_name(file_col), 22, 6)


def wire_schema_with_corrupt() -> T.StructType:
    return T.StructType(C.WIRE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_wire(df: DataFrame) -> DataFrame:
    """Wire rows (timestamp as text) to typed rows; keeps the raw timestamp text."""
    return df.withColumn("_ts_text", F.col("timestamp")).withColumn("timestamp", parse_event_time("timestamp"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines telemetry in either timestamp encoding (ISO text or epoch milliseconds).

    PERMISSIVE: a malformed line keeps its text in ``_corrupt_record``.
    """
    df = (spark.read.schema(wire_schema_with_corrupt())
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return parse_wire(df)


def quarantine_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows with the raw schema, quarantined rows with a reason).

    A row is quarantined when its line did not parse or its timestamp text
    could not be read in either encoding.
    """
    bad = F.col(CORRUPT).isNotNull() | F.col("timestamp").isNull()
    reason = (F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
              .otherwise(F.lit("unparseable_timestamp")))
    good = parsed.filter(~bad).select(*C.RAW_COLUMNS)
    quarantined = parsed.filter(bad).select(F.col(CORRUPT).alias("raw"), F.col("_ts_text").alias("timestamp_text"),
                                            "wafer_id", reason.alias("reason"))
    return good, quarantined


#: Column that holds what a cast could not read.
RESCUED = "_rescued"


def enforce_schema(df: DataFrame, rescued: str | None = None) -> DataFrame:
    """Cast to the 8-column raw schema, dropping extra columns; a failed cast yields NULL.

    With ``rescued`` a further column of that name keeps the text of every value whose cast failed,
    as a JSON object by column; it is null for rows that were read whole.
    """
    cols, lost = [], []
    for f in C.RAW_SCHEMA.fields:
        if f.name in df.columns:
            value = F.col(f.name).try_cast(f.dataType)
            cols.append(value.alias(f.name))
            lost.append(F.when(F.col(f.name).isNotNull() & value.isNull(),
                               F.struct(F.lit(f.name).alias("key"), F.col(f.name).cast("string").alias("value"))))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if rescued is None:
        return df.select(*cols)
    kept = F.array_compact(F.array(*lost)) if lost else F.array()
    return df.select(*cols, F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(kept))).cast("string").alias(rescued) if lost
                     else F.lit(None).cast("string").alias(rescued))


def split_rescued(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose every value could be cast, in the raw schema; the other rows with ``_rescued``).

    The second frame keeps the values that could be cast, so together they hold every input row.
    """
    typed = enforce_schema(df, RESCUED)
    return typed.filter(F.col(RESCUED).isNull()).drop(RESCUED), typed.filter(F.col(RESCUED).isNotNull())


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table (e.g. the silver table) from the catalog."""
    return spark.table(name)
