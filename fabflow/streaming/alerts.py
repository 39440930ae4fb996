"""Consecutive out-of-limit runs per chamber: over a table, and over a stream.

Over a table (:func:`run_alerts_batch`) the run length of every reading is
computed with DataFrame operations spread over (chamber, time bucket)
partitions, and one state row per chamber carries on to the next table:

* a *break* position is a reading that is inside the limits (the run after it
  is 0), or, with ``reset_after_seconds``, the slot just before a reading that
  follows a silence longer than that (the run restarts at 1);
* run(r) = index(r) - (last break at or before r) for out-of-limit readings;
* "last break" is a running maximum: inside each bucket by a window, across
  buckets by a prefix over the small per-bucket summary table, and across
  micro-batches by the carried state (run at the end, last event time).

The result equals gaps and islands over the whole ordered sequence per chamber.

Over a stream (:func:`start_alerts`) readings wait in Spark's state store, each
under a key of its own, until event time has passed them; those that are due in
a micro-batch are numbered as a table, so no task gathers a chamber.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.operators.joins import join_small
from fabflow.operators.windows import row_count_buckets
from fabflow.session import delete_path, file_system, rocksdb_state, stages, staging_path

STATE_SCHEMA = T.StructType([T.StructField("equipment_id", T.StringType()), T.StructField("run", T.LongType()),
                             T.StructField("last_ts", T.TimestampType())])


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def run_alerts_batch(readings: DataFrame, limits: DataFrame, min_run: int = 3, column: str = "temperature_c",
                     reset_after_seconds: int | None = None, state: DataFrame | None = None,
                     key: str = "equipment_id", target_rows_per_bucket: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(alerts, new state) for one batch of readings, given the state after the previous batch.

    alerts: (equipment_id, timestamp, wafer_id, temperature_c, run_length) for
    out-of-limit readings whose run length is at least ``min_run``.
    state: (equipment_id, run, last_ts), one row per chamber seen so far.
    """
    j = join_small(readings.select(key, "timestamp", "wafer_id", column),
                   limits.select(key, "ucl", "lcl"), key, "left")
    beyond = F.coalesce((F.col(column) > F.col("ucl")) | (F.col(column) < F.col("lcl")), F.lit(False))
    rows = j.select(key, F.col("timestamp").cast("timestamp").alias("ts"), "wafer_id",
                    F.col(column).alias("value"), beyond.alias("beyond"))
    spark, path = readings.sparkSession, staging_path(readings.sparkSession, "run-state")
    if state is None:
        state = spark.createDataFrame([], STATE_SCHEMA)
    state.write.mode("overwrite").parquet(path)
    state = spark.read.schema(state.schema).parquet(path)
    out, ends = _run_lengths(rows, state, reset_after_seconds, key, target_rows_per_bucket)
    alerts = out.filter(F.col("run_length") >= min_run).select(
        key, F.col("ts").alias("timestamp"), "wafer_id", F.col("value").alias(column), "run_length")
    # new state: run and time at each chamber's last reading; chambers not seen keep theirs
    seen = ends.filter(F.col(key).isNotNull()).select(key, "run", F.col("last.ts").alias("last_ts"))
    kept = state.join(seen.select(key), key, "left_anti")
    return alerts, seen.unionByName(kept)


def _run_lengths(rows: DataFrame, state: DataFrame, reset_after_seconds: int | None, key: str,
                 target_rows_per_bucket: int = 1_000_000, n_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The out-of-limit ones of ``rows(key, ts, wafer_id, value, beyond)`` with their ``run_length``, and where each chamber ends.

    The ends are ``(key, run, last)``: the run at a chamber's last reading and that reading's ``ts``
    and ``wafer_id``. The per-bucket summary is computed and staged when this is called. With
    ``n_rows`` rows, if that is known, one bucket may do.
    """
    reset_us = None if reset_after_seconds is None else int(reset_after_seconds) * 1_000_000
    if n_rows is not None and n_rows <= target_rows_per_bucket:
        rows = rows.withColumn("_bk", F.lit(0).cast("long"))
    else:
        rows = row_count_buckets(rows, key, "ts", target_rows_per_bucket)

    # inside each (chamber, bucket): local index and running maximum of break positions
    w = Window.partitionBy(key, "_bk").orderBy("ts", "wafer_id", "value")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    li = F.row_number().over(w)
    prev_us = F.lag(_micros("ts")).over(w)
    gap = F.lit(False) if reset_us is None else \
        F.coalesce(_micros("ts") - prev_us > F.lit(reset_us), F.lit(False))
    rows = rows.withColumn("_li", li).withColumn(
        "_bp", F.when(~F.col("beyond"), F.col("_li")).when(gap, F.col("_li") - 1))
    rows = rows.withColumn("_lbp", F.max("_bp").over(upto))

    # per bucket summary, then prefixes over a chamber's buckets (small table)
    first = F.min(F.struct("ts", "wafer_id", "value", "beyond"))
    buckets = rows.groupBy(key, "_bk").agg(F.count(F.lit(1)).alias("_n"), F.max("_bp").alias("_mbp"),
                                           F.max("ts").alias("_max_ts"), first.alias("_first"),
                                           F.max(F.struct("ts", "wafer_id")).alias("_last"))
    buckets = buckets.join(state.select(key, F.col("run").alias("_run_in"), F.col("last_ts").alias("_ts_in")), key, "left")
    bw = Window.partitionBy(key).orderBy("_bk")
    before = bw.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0))
    prev_ts = F.coalesce(F.lag("_max_ts").over(bw), F.col("_ts_in"))
    first_gap = F.lit(False) if reset_us is None else F.coalesce(
        F.col("_first.beyond") & (_micros("_first.ts") - F.unix_micros(prev_ts) > F.lit(reset_us)), F.lit(False))
    # the carried run is a virtual break at -run_in (0 without state); a reading
    # after a long silence breaks just before itself. Spark's greatest skips nulls.
    base = F.when(F.col("_ts_in").isNull(), F.lit(0)).otherwise(-F.col("_run_in"))
    buckets = (buckets.withColumn("_off", offset)
               .withColumn("_gbp", F.col("_off") + F.col("_mbp"))
               .withColumn("_carry", F.max("_gbp").over(before))
               .withColumn("_first_gap", first_gap))
    entry_bp = F.greatest(base, F.col("_carry"), F.when(F.col("_first_gap"), F.col("_off")))
    path = staging_path(rows.sparkSession, "run-prefix")
    buckets = buckets.withColumn("_entry", entry_bp).drop("_first")
    buckets.write.mode("overwrite").parquet(path)
    buckets = rows.sparkSession.read.schema(buckets.schema).parquet(path)

    # per out-of-limit reading: global index and last break at or before it. The readings are
    # already hash-partitioned and sorted by (chamber, bucket) from the window, so
    # this join shuffles only the small prefix table.
    out = rows.filter("beyond").join(buckets.select(key, "_bk", "_off", "_entry"), [key, "_bk"], "inner")
    last_bp = F.greatest(F.col("_entry"), F.col("_off") + F.col("_lbp"))
    out = out.withColumn("run_length", (F.col("_off") + F.col("_li") - last_bp).cast("long"))

    # a chamber's last reading is the last of its last bucket; inside the limits it is a break itself, run 0
    run = F.col("_off") + F.col("_n") - F.greatest(F.col("_entry"), F.col("_gbp"))
    ends = (buckets.groupBy(key).agg(F.max_by(F.struct(run.cast("long").alias("run"), F.col("_last").alias("last")), "_bk").alias("_e"))
            .select(key, "_e.run", "_e.last"))
    return out, ends


#: Where each chamber's numbering has come to: the run at the last reading taken, and its place in the order.
PASSED_SCHEMA = "equipment_id string, run bigint, us bigint, wafer_id string"


def _passed_before(spark, folder: str, batch_id: int) -> tuple[DataFrame, int | None]:
    """What the last micro-batch before ``batch_id`` that took readings left in ``folder``, and that batch's number."""
    fs, p = file_system(spark, folder)
    known = [int(f.getPath().getName()) for f in fs.listStatus(p)] if fs.exists(p) else []
    last = max([i for i in known if i < batch_id], default=None)
    if last is None:
        return spark.range(0).selectExpr("string(null) equipment_id", "0L run", "0L us", "string(null) wafer_id"), None
    return spark.read.schema(PASSED_SCHEMA).parquet(f"{folder}/{last}"), last


def _forget(spark, folder: str, before: int | None) -> None:
    """Removes what batches earlier than ``before`` left: no retry asks for it."""
    fs, p = file_system(spark, folder)
    for f in fs.listStatus(p) if before is not None else []:
        if int(f.getPath().getName()) < before:
            delete_path(spark, f.getPath().toString())


def _by_name(source: str) -> str:
    """A folder as a pattern of what Spark would read in it: matches of a pattern come sorted, a folder's listing does not."""
    return source if any(c in source for c in "*?[{") else source.rstrip("/") + "/{[^._]*,_*=*}"


def start_alerts(spark, source: str, limits: DataFrame, sink: str, checkpoint: str,
                 min_run: int = 3, reset_after_seconds: int | None = None, trigger: str = "available_now",
                 max_files_per_trigger: int | None = None, quarantine: str | None = None,
                 delay_seconds: int = 0, late: str | None = None):
    """STR-10: readings that extend a run of ``min_run`` or more out-of-limit readings of a chamber.

    Run lengths are counted in event order: readings may arrive up to ``delay_seconds`` of event time
    out of order, and alerts come that much later. A reading whose place in its chamber's order has
    been passed still goes to ``late``, malformed rows to ``quarantine`` (both beside the sink by
    default). One query. Waiting readings are groups of a streaming count in Spark's own state store
    (RocksDB for this query, whatever the session's provider is), which hands out those that event
    time has passed; they are numbered with :func:`run_alerts_batch`'s method. What is carried from
    batch to batch, one row per chamber, is in ``runs`` in the checkpoint folder by batch id, so a
    retried batch starts from the same rows. Files are taken by modification time and, where
    ``max_files_per_trigger`` deals them over batches, by name among those of one time, so that files
    written at once do not come in the order of a folder listing.
    """
    from fabflow.streaming.jobs import (
        _trigger, default_late, default_quarantine, good_rows, late_threshold, malformed_rows, read_wire_stream, write_batch_idempotent,
    )
    from fabflow.streaming.progress import DELIVERY, delivery_counters
    quarantine, late = quarantine or default_quarantine(sink), late or default_late(sink)
    folder = checkpoint.rstrip("/") + "/runs"
    parsed = read_wire_stream(spark, _by_name(source) if max_files_per_trigger else source, max_files_per_trigger)
    limits, side = limits.select("equipment_id", "ucl", "lcl"), staging_path(spark, "join-side")
    limits.write.mode("overwrite").parquet(side)

    def readings(rows: DataFrame) -> DataFrame:
        """Good rows with their judgement; ``at`` is the time in whole milliseconds, as watermarks are."""
        known = good_rows(rows).select("equipment_id", "timestamp", "wafer_id", "temperature_c").join(
            rows.sparkSession.read.schema(limits.schema).parquet(side), "equipment_id", "left")
        value = F.col("temperature_c")
        beyond = F.coalesce((value > F.col("ucl")) | (value < F.col("lcl")), F.lit(False))
        return known.select("equipment_id", F.date_trunc("millisecond", "timestamp").alias("at"), F.unix_micros("timestamp").alias("us"),
                            "wafer_id", F.when(~F.isnan(value), value).alias("value"), beyond.alias("beyond"))

    each = ["equipment_id", "us", "wafer_id", "value", "beyond"]
    due = (readings(parsed).withWatermark("at", f"{int(delay_seconds)} seconds").groupBy("at", *each).agg(F.count("*").alias("n"))
           .select(*each, "n"))
    rows = parsed.observe(DELIVERY, *delivery_counters()).select(F.struct("*").alias("row"))
    both = due.select(F.struct("*").alias("out")).unionByName(rows, allowMissingColumns=True)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        mark = late_threshold(spark, checkpoint, batch_id) or 0
        batch, session = batch.persist(), batch.sparkSession
        try:
            with stages(session):
                came = batch.filter("row is not null").select("row.*")
                write_batch_idempotent(malformed_rows(came), quarantine, batch_id, ())
                passed, before = _passed_before(session, folder, batch_id)
                # rows that Spark's count drops behind its watermark: late only if their own chamber has passed them
                old = passed.select(F.col("equipment_id").alias("_key"), F.col("us").alias("_us"), F.col("wafer_id").alias("_wafer"))
                gone = (F.col("us") < F.col("_us")) | ((F.col("us") == F.col("_us")) & (F.coalesce("wafer_id", F.lit("")) <= F.coalesce("_wafer", F.lit(""))))
                behind = readings(came).filter(F.col("at") <= F.timestamp_millis(F.lit(mark))).join(
                    old, F.col("equipment_id").eqNullSafe(F.col("_key")), "left").withColumn("gone", F.coalesce(gone, F.lit(False)))
                when = F.timestamp_micros("us")
                write_batch_idempotent(behind.filter("gone").select("equipment_id", when.alias("timestamp"), "wafer_id", F.col("value").alias("temperature_c")),
                                       late, batch_id, ())
                copies = F.explode(F.sequence(F.lit(1), F.col("n")))
                ready = (batch.filter("out is not null").select("out.*").withColumn("_copy", copies).select(*each)
                         .unionByName(behind.filter("not gone").select(*each))
                         .select("equipment_id", when.alias("ts"), "wafer_id", "value", "beyond"))
                alert = ("equipment_id", F.col("ts").alias("timestamp"), "wafer_id", F.col("value").alias("temperature_c"), "run_length")
                n_ready = ready.count()
                if not n_ready:
                    write_batch_idempotent(ready.filter("false").withColumn("run_length", F.lit(0).cast("long")).select(*alert), sink, batch_id, ())
                    return
                state = passed.select("equipment_id", "run", F.timestamp_micros("us").alias("last_ts"))
                runs, ends = _run_lengths(ready, state, reset_after_seconds, "equipment_id", n_rows=n_ready)
                write_batch_idempotent(runs.filter(F.col("run_length") >= min_run).select(*alert), sink, batch_id, ())
                now = ends.select("equipment_id", "run", F.unix_micros("last.ts").alias("us"), "last.wafer_id")
                kept = passed.join(now.select(F.col("equipment_id").alias("_key")), F.col("equipment_id").eqNullSafe(F.col("_key")), "left_anti")
                now.unionByName(kept).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{batch_id}")
                _forget(session, folder, before)
        finally:
            batch.unpersist()

    w = both.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    with rocksdb_state(spark):
        return _trigger(w, trigger).start()
