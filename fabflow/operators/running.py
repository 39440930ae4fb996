"""Running totals over a whole table, without a window over all rows.

The rows are dealt by range of the order columns (about equal numbers per
partition, whatever the distribution) and totalled inside each partition as
they come sorted; the offsets are the totals of the partitions before, one
number per partition. The result is written to the shared checkpoint folder,
so that rows and offsets come from one and the same dealing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.session import staging_path


def _spark_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_totals(df: DataFrame, order, weight: str, out: str = "running_total", parts: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the sum of the whole-number column ``weight`` from the first row in order up to this one.

    ``order`` are column names, nulls first. Rows equal in all of them stay in
    one partition and are totalled in no particular order among themselves, so
    collapse hot values to one row with a weight first. ``parts`` range
    partitions (default ``spark.sql.shuffle.partitions``) also bound the rows
    that reach the driver. Null weights count 0; an empty table stays empty.
    """
    order = [order] if isinstance(order, str) else list(order)
    cols = df.columns
    at = cols.index(weight)
    ranged = (df.repartitionByRange(parts or _spark_parts(df), *[F.col(c).asc_nulls_first() for c in order])
              .withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = total + np.cumsum(batch.column(at).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            if len(sums):
                total = int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, "_run"])

    schema = T.StructType([*ranged.schema.fields, T.StructField("_run", T.LongType())])
    path = staging_path(df.sparkSession, "running")
    ranged.mapInArrow(run, schema).write.mode("overwrite").parquet(path)
    kept = df.sparkSession.read.schema(schema).parquet(path)
    sums = kept.groupBy("_part").agg(F.sum(F.coalesce(F.col(weight), F.lit(0)).cast("long")).alias("n")).collect()
    before, offsets = 0, []                                    # one pair of numbers per range partition
    for r in sorted(sums, key=lambda r: r["_part"]):
        offsets.append((r["_part"], before))
        before += r["n"]
    table = df.sparkSession.createDataFrame(offsets, "_part int, _before long")
    return kept.join(F.broadcast(table), "_part").select(*cols, (F.col("_before") + F.col("_run")).alias(out))
