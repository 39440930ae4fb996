"""Structured Streaming jobs over telemetry.

Each ``start_*`` function builds and starts one streaming query; file sinks
plus a checkpoint give exactly-once output (offsets are committed only after
the sink has written the batch). ``trigger="available_now"`` drains what is
there and stops (the flush-at-shutdown behaviour); a ``"10 seconds"`` style
string runs continuously. Batch size is bounded by ``max_files_per_trigger``
(file source) or ``maxOffsetsPerTrigger`` (topic source).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fabflow import constants as C
from fabflow.operators import quality as Q
from fabflow.sinks.files import bronze_frame
from fabflow.sources.files import CORRUPT, parse_wire, wire_schema_with_corrupt
from fabflow.streaming.progress import DELIVERY, delivery_counters


def write_batch_idempotent(df: DataFrame, path: str, batch_id: int, partition_by=("date",)) -> None:
    """Write one micro-batch so that a retried batch replaces, not duplicates, its output.

    ``batch_id`` becomes the innermost partition column and the write uses
    dynamic partition overwrite, so re-running batch N rewrites exactly the
    partitions batch N produced. Readers still prune on the outer columns.
    """
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "batch_id").parquet(path))


def _trigger(writer, trigger: str):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def read_wire_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files arriving in ``path`` as a stream of parsed rows (PERMISSIVE)."""
    r = (spark.readStream.schema(wire_schema_with_corrupt())
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_wire(r.json(path))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull() & F.col("timestamp").isNotNull())


def default_late(sink: str) -> str:
    """Where rows behind the watermark go unless the caller names a folder: beside the sink."""
    return sink.rstrip("/") + "-late"


def malformed_rows(parsed: DataFrame) -> DataFrame:
    """What ``good_rows`` leaves out, with the text it came from."""
    return parsed.filter(F.col(CORRUPT).isNotNull() | F.col("timestamp").isNull()).select(
        F.col(CORRUPT).alias("raw"), F.col("_ts_text").alias("timestamp_text"), "wafer_id")


def default_quarantine(sink: str) -> str:
    """Where malformed rows go unless the caller names a folder: beside the sink."""
    return sink.rstrip("/") + "-quarantine"


def late_threshold(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """Event time in milliseconds up to which Spark drops rows of this batch as late (None: it drops none).

    That is the watermark with which the batch before was planned (this batch, where chained stateful
    operators are switched off), as the query's own offset log in its checkpoint folder has it, so it
    is the same on a retry or after a restart.
    """
    chained = spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"
    planned = batch_id - 1 if chained else batch_id
    if planned < 0:
        return None
    lines = [r["value"] for r in spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{planned}").collect()]
    return json.loads(lines[1])["batchWatermarkMs"] or None


def _start_accounted(spark: SparkSession, source: str, build: Callable[[DataFrame], DataFrame], passed: Callable[[Column], Column],
                     sink: str, checkpoint: str, trigger: str, quarantine: str | None, late: str | None,
                     max_files_per_trigger: int | None) -> StreamingQuery:
    """A stateful stream whose every input row is accounted for, as one query.

    The result of ``build(good rows)`` and the input rows themselves pass through one plan, so both
    see the same micro-batches. Per batch: results go to ``sink``, malformed rows to ``quarantine``,
    and rows for which ``passed(watermark)`` holds, those the stateful operator drops, to ``late``
    with their lateness. Nothing is written twice on a retry.
    """
    quarantine, late = quarantine or default_quarantine(sink), late or default_late(sink)
    parsed = read_wire_stream(spark, source, max_files_per_trigger)
    rows = parsed.observe(DELIVERY, *delivery_counters()).select(F.struct("*").alias("row"))
    both = build(good_rows(parsed).select(*C.RAW_COLUMNS)).select(F.struct("*").alias("out")).unionByName(rows, allowMissingColumns=True)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        threshold = late_threshold(spark, checkpoint, batch_id)
        batch = batch.persist()
        try:
            came = batch.filter("row is not null").select("row.*")
            write_batch_idempotent(batch.filter("out is not null").select("out.*"), sink, batch_id, ())
            write_batch_idempotent(malformed_rows(came), quarantine, batch_id, ())
            if threshold is not None:
                mark = F.timestamp_millis(F.lit(threshold))
                behind = (F.unix_micros(mark) - F.unix_micros("timestamp")) / F.lit(1e6)
                lost = good_rows(came).filter(passed(mark)).select(*C.RAW_COLUMNS, behind.alias("lateness_seconds"))
                write_batch_idempotent(lost, late, batch_id, ())
        finally:
            batch.unpersist()

    w = both.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def batch_counters(batch: DataFrame) -> DataFrame:
    """One row: good rows, malformed rows, anomalies and unknown chambers of a micro-batch."""
    good = F.col(CORRUPT).isNull() & F.col("timestamp").isNotNull()
    return batch.agg(F.count_if(good).alias("rows"), F.count_if(~good).alias("malformed"),
                     F.count_if(good & F.col("is_anomaly")).alias("anomalies"),
                     F.count_if(good & ~F.col("equipment_id").isin(C.VALID_EQUIPMENT)).alias("unknown_equipment"),
                     F.min(F.when(good, F.to_date("timestamp"))).alias("first_date"))


def start_archive(spark: SparkSession, source: str, sink: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, trigger: str = "available_now",
                  quarantine: str | None = None, metrics: str | None = None) -> StreamingQuery:
    """Consume -> parse -> bronze -> Parquet partitioned by event date (STR-1..4, 7).

    Malformed rows go to ``quarantine`` (by default beside the sink) in the same batch, so rows in =
    good + quarantined. The batch's counters are observed as it passes and posted with its progress
    (:class:`fabflow.streaming.progress.ProgressListener`); with ``metrics`` every batch also writes
    them there, one row per batch id, exact over any number of batches and restarts
    (:func:`progress_counters` reads them).
    """
    parsed = read_wire_stream(spark, source, max_files_per_trigger).observe(DELIVERY, *delivery_counters())
    quarantine = quarantine or default_quarantine(sink)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                  # good and quarantined rows from one read
        try:
            write_batch_idempotent(bronze_frame(good_rows(batch)), sink, batch_id)
            write_batch_idempotent(malformed_rows(batch), quarantine, batch_id, ())
            if metrics:
                write_batch_idempotent(batch_counters(batch), metrics, batch_id, ())
        finally:
            batch.unpersist()

    w = parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_json_append(spark: SparkSession, source: str, sink: str, checkpoint: str,
                      trigger: str = "available_now", quarantine: str | None = None) -> StreamingQuery:
    """Append records continuously to JSON lines (STR-5); malformed ones to ``quarantine``."""
    parsed = read_wire_stream(spark, source)
    quarantine = quarantine or default_quarantine(sink)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            (good_rows(batch).select(*C.RAW_COLUMNS).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
             .option("timestampFormat", C.ISO_FORMAT + "XXX").option("ignoreNullFields", "false").json(sink))
            write_batch_idempotent(malformed_rows(batch), quarantine, batch_id, ())
        finally:
            batch.unpersist()

    w = parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_to_topic(stream: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                   trigger: str = "10 seconds") -> StreamingQuery:
    """Publish telemetry continuously, keyed by chamber (STR-6)."""
    from fabflow.sinks.kafka import kafka_sink_options, to_kafka_frame
    w = (to_kafka_frame(stream).writeStream.format("kafka").options(**kafka_sink_options(bootstrap, topic))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def dedup_stream(stream: DataFrame, delay: str = "1 hour", key: str = "wafer_id") -> DataFrame:
    """Drop redelivered copies of a key arriving within ``delay`` of the first (STR-8).

    Rows without a key are no copies of each other: all of them pass. State per key is dropped once
    the watermark passes; replays later than the delay need the batch upsert (``operators.merge``).
    """
    keyed = stream.filter(F.col(key).isNotNull()).withWatermark("timestamp", delay).dropDuplicatesWithinWatermark([key])
    return keyed.unionByName(stream.filter(F.col(key).isNull()))


def start_dedup(spark: SparkSession, source: str, sink: str, checkpoint: str, delay: str = "1 hour",
                trigger: str = "available_now", quarantine: str | None = None, late: str | None = None,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Write each key once, and every row without a key (STR-8).

    Malformed rows go to ``quarantine`` and keyed rows behind the watermark to ``late``, so rows in =
    sink + copies + quarantined + late.
    """
    def passed(mark: Column) -> Column:
        return F.col("wafer_id").isNotNull() & (F.col("timestamp") <= mark)
    return _start_accounted(spark, source, lambda s: dedup_stream(s, delay), passed, sink, checkpoint, trigger, quarantine, late,
                            max_files_per_trigger)


def window_profile(stream: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Per chamber and event-time window KPIs, emitted once the window closes (STR-9)."""
    return (stream.withWatermark("timestamp", delay)
            .groupBy("equipment_id", F.window("timestamp", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("wafers"),
                 F.sum(F.col("temperature_c")).alias("sum_temperature_c"),
                 F.count(F.col("temperature_c")).alias("n_temperature_c"),
                 F.avg(F.col("temperature_c").cast("decimal(18,6)")).cast("double").alias("mean_temperature_c"),
                 F.avg(F.col("yield_rate").cast("decimal(18,6)")).cast("double").alias("mean_yield"),
                 F.min("temperature_c").alias("min_temperature_c"),
                 F.max("temperature_c").alias("max_temperature_c"),
                 F.sum("defect_count").alias("total_defects"),
                 F.count_if("is_anomaly").alias("anomalies"))
            .select("equipment_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "wafers", "sum_temperature_c", "n_temperature_c", "mean_temperature_c", "mean_yield",
                    "min_temperature_c", "max_temperature_c",
                    "total_defects", "anomalies"))


def start_window_profile(spark: SparkSession, source: str, sink: str, checkpoint: str, window: str = "1 hour",
                         delay: str = "10 minutes", trigger: str = "available_now", quarantine: str | None = None,
                         late: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Write closed windows' KPIs (STR-9).

    Malformed rows go to ``quarantine`` and rows whose window has closed already to ``late``, so rows
    in = rows of closed and open windows + quarantined + late.
    """
    def passed(mark: Column) -> Column:
        return F.window("timestamp", window)["end"] <= mark
    return _start_accounted(spark, source, lambda s: window_profile(s, window, delay), passed, sink, checkpoint, trigger, quarantine,
                            late, max_files_per_trigger)


def gate_batch_writer(good_sink: str, quarantine_sink: str, report_sink: str, layer: str = "bronze",
                      rules: str = "native", malformed_sink: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: validate the batch (one aggregate), then route it (DQ-17).

    A batch with no critical failure goes to ``good_sink``; otherwise it goes
    whole to ``quarantine_sink``. Rows that cannot be parsed have no bronze form
    and go to ``malformed_sink`` (by default ``<quarantine_sink>-malformed``). The batch's report rows go to ``report_sink``
    with the batch id and the batch's first event date. All three writes are
    idempotent per batch id (a retried batch replaces its own output).
    """
    malformed_sink = malformed_sink or quarantine_sink.rstrip("/") + "-malformed"

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                             # read the micro-batch once
        bronze = bronze_frame(good_rows(batch))
        try:
            write_batch_idempotent(malformed_rows(batch), malformed_sink, batch_id, ())
            report = Q.validation_report(bronze, rules, layer)
            rows = report.withColumn("batch_date", F.lit(None).cast("date")).collect()  # one row per rule
            first_date = bronze.agg(F.min("date")).first()[0]
            spark = batch.sparkSession
            rep = spark.createDataFrame([r.asDict() for r in rows], report.schema.add("batch_date", T.DateType()))
            rep = rep.withColumn("batch_date", F.lit(first_date))
            write_batch_idempotent(rep, report_sink, batch_id, ())
            ok = not any((not r["success"]) and r["critical"] for r in rows)
            write_batch_idempotent(bronze, good_sink if ok else quarantine_sink, batch_id)
        finally:
            batch.unpersist()
    return run


def start_gate(spark: SparkSession, source: str, good_sink: str, quarantine_sink: str, report_sink: str,
               checkpoint: str, max_files_per_trigger: int | None = 1, trigger: str = "available_now",
               layer: str = "bronze", rules: str = "native", malformed_sink: str | None = None) -> StreamingQuery:
    parsed = read_wire_stream(spark, source, max_files_per_trigger)
    w = (parsed.writeStream.foreachBatch(gate_batch_writer(good_sink, quarantine_sink, report_sink, layer, rules, malformed_sink))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def progress_counters(spark: SparkSession, metrics: str) -> DataFrame:
    """Per-batch counters written by :func:`start_archive` (STR-7, AGG-22/24): one row per batch id."""
    return spark.read.parquet(metrics).select("batch_id", "rows", "malformed", "anomalies", "unknown_equipment", "first_date")


def delivery_stats(sent: int, failed: int) -> dict:
    """sent, failed and success rate in percent (0 when nothing was sent)."""
    total = sent + failed
    return {"sent": sent, "failed": failed, "success_rate": (sent / total * 100.0) if total else 0.0}


def delivery_stats_frame(good: DataFrame, rejected: DataFrame) -> DataFrame:
    """The same figures as one row computed by Spark from the good and rejected outputs."""
    from fabflow.functions.scalar import safe_percentage
    g = good.agg(F.count(F.lit(1)).alias("sent"))
    r = rejected.agg(F.count(F.lit(1)).alias("failed"))
    sent, failed = g.scalar(), r.scalar()
    return g.select(sent.alias("sent"), failed.alias("failed"),
                    safe_percentage(sent, sent + failed).alias("success_rate"))
