"""Helpers shared by the operators: Arrow row maps, process-wide state, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.session import ensure_checkpoint_dir, staging_path

#: Arrow types of the result columns the operators return.
ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}
#: Input bytes after which a task hands its finished rows back to Spark.
FLUSH_BYTES = 4 << 20


def bytes_of(text: str | Column) -> Column:
    """UTF-8 bytes of a text column (null stays null)."""
    return (F.col(f"`{text}`") if isinstance(text, str) else text).cast("string").cast("binary")


def map_texts(df: DataFrame, keep: Sequence[str], text: str, make: Callable[[], Callable],
              fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One result row per input row: the columns ``keep`` plus ``fields``.

    ``make()`` runs once per task and returns ``row(utf8_bytes) -> tuple``. A null text arrives as
    ``b""``. Only ``keep`` and ``text`` reach Python; other columns, whatever their names, do not.
    The text travels once, also where it is kept. Rows go back in slices of about FLUSH_BYTES of
    input, so memory does not grow with the task.
    """
    names = [n for n, _ in fields]
    if clash := set(keep) & set(names):
        raise ValueError(f"key columns share names with result columns: {sorted(clash)}")
    types = [ARROW[t] for _, t in fields]
    others = [k for k in keep if k != text]
    held = [others.index(k) if k != text else len(others) for k in keep]        # where each kept column stands
    at = len(others)
    src = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(others)], bytes_of(text).alias("text"))
    schema = T.StructType([T.StructField(k, df.schema[k].dataType if k != text else T.BinaryType()) for k in keep]
                          + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    out_names = [*keep, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            texts, start, rows, size = batch.column(at), 0, [], 0
            for i in range(batch.num_rows):
                data = texts[i].as_py() or b""
                rows.append(row(data))
                size += len(data) + 64
                if size >= FLUSH_BYTES or i + 1 == batch.num_rows:
                    cols = [batch.column(k).slice(start, i + 1 - start) for k in held]
                    cols += [pa.array(list(c), t) for c, t in zip(zip(*rows), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(cols, names=out_names)
                    start, rows, size = i + 1, [], 0

    out = src.mapInArrow(run, schema)
    return out.withColumn(text, F.col(f"`{text}`").cast(df.schema[text].dataType)) if text in keep else out


class Memo:
    """A bounded cache of two generations: the older half is dropped when the younger fills up."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def put(self, key, value):
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value
        return value


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_sorted(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` as a sort-merge join, for tables that grow with the input.

    Spark sizes a table by its files and takes an explode for one row to a row, so it may pick a side
    for broadcast that is many times what it supposes; collecting and hashing that side is then the
    end of the driver.
    """
    return left.join(right.hint("merge"), on, how)


def text_bytes(df: DataFrame, text: str) -> int:
    """Total UTF-8 bytes of a text column (one narrow scan)."""
    return df.select(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`").cast("string"))), F.lit(0)).alias("b")).first()["b"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
