"""Incremental upsert into a date-partitioned Parquet table (no MERGE needed).

Plain Parquet tables refuse ``MERGE INTO``; the upsert is expressed as:

1. the incoming rows are staged, so that they are computed once; touched partitions = theirs +
   those where their keys are stored now (collected once, checked against ``max_partitions``);
   null is a partition like any other. Where keys are stored comes from a bucketed key table (:mod:`fabflow.operators.key_table`,
   no shuffle of the stored side) or, without one, from the stored key column
2. merged = latest row per key over (stored rows of touched partitions + incoming); the
   stored side is filtered by literal values, so the scan reads only those folders
3. merged is written beside the table, which cuts the lineage to the files being replaced; its
   rows are dealt by partition first, so that the number of files goes with the partitions and
   their size and not with partitions times tasks. What it holds tells which partitions it empties
4. Spark's dynamic partition overwrite copies it over the touched partitions; touched
   partitions without any row left are overwritten with none

A run that stops before step 4 has changed nothing; one that stops after it is completed by the
next upsert (or ``recover_upsert``), since step 4 can be repeated from what step 3 wrote. Rerunning
with the same input is a no-op on the data. Where a table format with MERGE INTO is installed, use that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.operators.dedup import dedup_latest
from fabflow.session import delete_path, path_exists, staging_path, stages

#: Staged merge results with a key table: whether a keyed row is one of the incoming rows.
_ARRIVED = "_arrived"


def merge_latest(current: DataFrame, incoming: DataFrame, key="wafer_id", order="timestamp") -> DataFrame:
    """Latest-wins union of two frames with the same columns (pure, lazy)."""
    return dedup_latest(current.unionByName(incoming), key, order)


def _stage(table_path: str) -> str:
    return table_path.rstrip("/") + ".upsert"


def _in_partitions(column: str, values: list) -> Column:
    """Rows whose partition value is listed (None stands for null); a literal filter, so folders are pruned."""
    some = [v for v in values if v is not None]
    cond = F.col(column).isin(some) if some else F.lit(False)
    return cond | F.col(column).isNull() if None in values else cond


def _by_partition(rows: DataFrame, partition_col: str) -> DataFrame:
    """Rows dealt by partition value for a partitioned write; adaptive execution splits large values and joins small ones."""
    return rows.hint("rebalance", F.col(partition_col))


def stored_schema(spark: SparkSession, table_path: str, incoming: T.StructType, partition_col: str) -> T.StructType:
    """The table's own columns, the partition column with the incoming type (folder names have none).

    Incoming columns that the table lacks, or has with another type, raise ValueError; an empty table
    takes the incoming columns.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        own = files.parquet(table_path).schema
    except Exception as e:  # noqa: BLE001  a folder without data files
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return incoming
        raise
    types = {f.name: f.dataType for f in own}
    wrong = [f.name for f in incoming if f.name != partition_col and types.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"incoming columns {wrong} are not in the table or have another type there")
    return T.StructType([T.StructField(f.name, f.dataType) for f in own] + [T.StructField(partition_col, incoming[partition_col].dataType)])


def _finish(spark: SparkSession, table_path: str, partition_col: str, schema: T.StructType) -> int:
    """Step 4 from complete staged data; may be repeated. Returns the number of emptied partitions."""
    stage = _stage(table_path)
    plain = T.StructType([f for f in schema if f.name != partition_col])
    emptied = [r["folder"] for r in spark.read.schema("folder string").parquet(f"{stage}/emptied").collect()]   # one per emptied partition
    (spark.read.schema(schema).parquet(f"{stage}/data").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(table_path))
    for folder in emptied:
        spark.createDataFrame([], plain).write.mode("overwrite").parquet(folder)
    delete_path(spark, stage)
    return len(emptied)


def recover_upsert(spark: SparkSession, table_path: str, schema: T.StructType, partition_col: str = "date") -> int | None:
    """Finish an upsert that stopped half-way, or clear one that had not begun to change the table."""
    stage = _stage(table_path)
    if path_exists(spark, f"{stage}/data/_SUCCESS") and path_exists(spark, f"{stage}/emptied/_SUCCESS"):
        return _finish(spark, table_path, partition_col, schema)
    delete_path(spark, stage)
    return None


def upsert_partitioned(incoming: DataFrame, table_path: str, key: str = "wafer_id", order: str = "timestamp",
                       partition_col: str = "date", lookback_days: int | None = None, verify_lookback: bool = True,
                       max_partitions: int = 100_000, key_table: str | None = None) -> dict:
    """Upsert ``incoming`` into the Parquet table at ``table_path`` partitioned by ``partition_col``.

    Returns counts of touched and emptied partitions. Only touched partitions
    are read and rewritten, with all columns the table has: stored columns that
    the increment lacks keep their values and are null in incoming rows; columns
    the table lacks, or of another type, raise ValueError before anything is written.

    ``key_table`` names the bucketed key table that says where keys are stored;
    it is brought up to date with the upsert. Without one, finding keys that moved to
    another date scans the stored key column. ``lookback_days`` then states how late a redelivery may
    be; by default the rest of the key column is still checked and an older copy
    raises ValueError before anything is written. ``verify_lookback=False`` skips
    that check and with it the scan, for feeds that guarantee the delay. Rows
    without a date, incoming or stored, are in the null partition and always
    searched. One writer per table at a time.
    """
    from fabflow.operators import key_table as KT
    spark = incoming.sparkSession
    if not path_exists(spark, table_path):
        _by_partition(dedup_latest(incoming, key, order), partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(table_path)
        if key_table:
            KT.build_key_table(spark, table_path, key_table, key, partition_col, incoming.schema)
        return {"touched_partitions": None, "emptied_partitions": 0}
    schema = stored_schema(spark, table_path, incoming.schema, partition_col)
    recover_upsert(spark, table_path, schema, partition_col)
    with stages(spark):
        arrived = staging_path(spark, "incoming")
        incoming.write.mode("overwrite").parquet(arrived)
        return _merge_into(spark.read.schema(incoming.schema).parquet(arrived), table_path, schema, key, order, partition_col,
                           lookback_days, verify_lookback, max_partitions, key_table)


def _merge_into(incoming: DataFrame, table_path: str, schema: T.StructType, key: str, order: str, partition_col: str,
                lookback_days: int | None, verify_lookback: bool, max_partitions: int, key_table: str | None) -> dict:
    """Steps 1 to 4 with staged incoming rows."""
    from fabflow.operators import key_table as KT
    spark = incoming.sparkSession
    table = spark.read.schema(schema).parquet(table_path)
    stored = table.select(*schema.names)
    keys = incoming.select(key).filter(F.col(key).isNotNull()).distinct()
    if key_table:
        moved_from = KT.stored_partitions(spark, key_table, keys, key, partition_col)
    else:
        search = stored
        if lookback_days is not None:
            span = incoming.agg(F.min(partition_col).alias("lo"), F.max(partition_col).alias("hi")).first()
            near = F.col(partition_col).isNull()
            if span["lo"] is not None:
                near = near | F.col(partition_col).between(F.date_sub(F.lit(span["lo"]), lookback_days),
                                                           F.date_add(F.lit(span["hi"]), lookback_days))
            search = stored.filter(near)
            if verify_lookback:
                far = stored.filter(~near).select(key).join(keys, key, "left_semi").limit(1).collect()
                if far:
                    raise ValueError(f"key {far[0][0]!r} is stored more than {lookback_days} days from the incoming dates")
        moved_from = search.join(keys, on=key, how="left_semi").select(partition_col)
    touched = [r[0] for r in incoming.select(partition_col).unionByName(moved_from).distinct()
               .limit(max_partitions + 1).collect()]
    if len(touched) > max_partitions:
        raise ValueError(f"more than {max_partitions} partitions touched: {partition_col!r} is too fine to partition by")
    if not touched:
        return {"touched_partitions": 0, "emptied_partitions": 0}
    affected = stored.filter(_in_partitions(partition_col, touched))
    fresh = incoming.select(*[F.col(f.name) if f.name in incoming.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    staged = schema
    if key_table:                                # which rows win tells where keys are now; equal rows without a key still collapse
        staged = T.StructType([*schema, T.StructField(_ARRIVED, T.BooleanType())])
        affected, fresh = (rows.withColumn(_ARRIVED, F.when(F.col(key).isNotNull(), F.lit(new))) for rows, new in ((affected, False), (fresh, True)))
    merged = merge_latest(affected, fresh, key, order)

    stage = _stage(table_path)
    data = f"{stage}/data"
    _by_partition(merged, partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(data)
    kept = spark.read.schema(staged).parquet(data)
    # touched partitions that keep no row, and their folders as Spark names them
    values = spark.createDataFrame([(p,) for p in touched], T.StructType([T.StructField("_p", schema[partition_col].dataType)]))
    left = kept.select(F.col(partition_col).alias("_q")).distinct()
    gone = [r[0] for r in values.join(left, F.col("_p").eqNullSafe(F.col("_q")), "left_anti").collect()]
    (table.filter(_in_partitions(partition_col, gone)).select(F.col("_metadata.file_path").alias("file")).distinct()
     .select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
     .coalesce(1).write.mode("overwrite").parquet(f"{stage}/emptied"))
    if key_table:
        KT.record_keys(kept.filter(_ARRIVED), key_table, key, partition_col)
    emptied = _finish(spark, table_path, partition_col, schema)
    return {"touched_partitions": len(touched), "emptied_partitions": emptied}
