import glob
import os
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.operators import spc as SPC
from fabflow.plans import medallion as M
from fabflow.sinks import files as SK
from fabflow.sources.bridge import telemetry_raw
from fabflow.streaming import alerts as AL
from fabflow.streaming import jobs as J
from conftest import SF_SMALL
from helpers import frame


def test_stream_archive_equals_batch_and_restart_adds_nothing(spark, scratch):
    t = telemetry_raw(spark, SF_SMALL)
    SK.write_json_lines(t, scratch + "/src")
    q = J.start_archive(spark, scratch + "/src", scratch + "/out", scratch + "/ck", max_files_per_trigger=2,
                        metrics=scratch + "/m")
    q.awaitTermination()
    out = spark.read.parquet(scratch + "/out")
    assert out.count() == 1100
    batch = M.bronze(t).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert out.select(*C.BRONZE_COLUMNS).exceptAll(batch).count() == 0
    assert J.progress_counters(spark, scratch + "/m").agg(F.sum("rows")).first()[0] == 1100
    J.start_archive(spark, scratch + "/src", scratch + "/out", scratch + "/ck").awaitTermination()
    assert spark.read.parquet(scratch + "/out").count() == 1100


def test_stream_quarantine_sink(spark, scratch):
    os.makedirs(scratch + "/src")
    with open(scratch + "/src/a.json", "w") as f:
        f.write('{"timestamp":"2024-01-01T00:00:00","wafer_id":"W1","equipment_id":"EQ001","temperature_c":350.0,'
                '"pressure_torr":10.0,"yield_rate":0.9,"defect_count":1,"is_anomaly":false}\nnot json\n')
    J.start_archive(spark, scratch + "/src", scratch + "/out", scratch + "/ck",
                    quarantine=scratch + "/q").awaitTermination()
    assert spark.read.parquet(scratch + "/out").count() == 1
    assert spark.read.parquet(scratch + "/q").first().raw == "not json"


def test_dedup_within_watermark(spark, scratch):
    t = telemetry_raw(spark, SF_SMALL)
    SK.write_json_lines(t, scratch + "/src")
    J.start_dedup(spark, scratch + "/src", scratch + "/out", scratch + "/ck", "1 hour").awaitTermination()
    out = spark.read.parquet(scratch + "/out")
    assert out.count() == 1000 == out.select("wafer_id").distinct().count()


def _write_batch(df, path, i):
    SK.to_wire(df).coalesce(1).write.mode("overwrite").json(f"{path}/b{i:03d}")


def test_alert_state_carries_across_batches(spark, scratch):
    base = datetime(2024, 1, 1)
    temps = [350, 390, 391, 350, 392, 393, 394, 350]          # runs: 2, then 3
    rows = [{"wafer_id": f"W{i:08d}", "timestamp": base + timedelta(minutes=i), "temperature_c": float(v)}
            for i, v in enumerate(temps)]
    df = frame(spark, rows, with_date=False)
    limits = spark.createDataFrame([("EQ001", 380.0, 320.0)], "equipment_id string, ucl double, lcl double")
    src = scratch + "/src"
    # three files arriving one per micro-batch, split inside runs
    for i, (a, b) in enumerate([(0, 2), (2, 5), (5, 8)]):
        _write_batch(df.filter(F.col("wafer_id").between(f"W{a:08d}", f"W{b - 1:08d}")), src, i)
        time.sleep(1.1)
    AL.start_alerts(spark, src + "/b*", limits, scratch + "/out", scratch + "/ck", min_run=2,
                   max_files_per_trigger=1).awaitTermination()
    got = sorted((r.wafer_id, r.run_length) for r in spark.read.parquet(scratch + "/out").collect())
    assert got == [("W00000002", 2), ("W00000005", 2), ("W00000006", 3)]


def test_gate_stream_routes_failing_batch(spark, scratch):
    src = scratch + "/src"
    good = frame(spark, [{"wafer_id": f"W{i}"} for i in range(5)], with_date=False)
    bad = frame(spark, [{"wafer_id": "X1", "timestamp": datetime(2024, 1, 11)}, {"wafer_id": "X1", "timestamp": datetime(2024, 1, 11)}],
                with_date=False)
    _write_batch(good, src, 0)
    time.sleep(1.1)
    _write_batch(bad, src, 1)
    J.start_gate(spark, src + "/b*", scratch + "/good", scratch + "/quar", scratch + "/rep", scratch + "/ck",
                 max_files_per_trigger=1).awaitTermination()
    assert spark.read.parquet(scratch + "/good").count() == 5
    assert spark.read.parquet(scratch + "/quar").count() == 2
    rep = spark.read.parquet(scratch + "/rep")
    assert rep.select("batch_id").distinct().count() == 2


def test_window_profile_closed_windows_equal_batch(spark, scratch):
    t = telemetry_raw(spark, SF_SMALL)
    SK.write_json_lines(t, scratch + "/src")
    J.start_window_profile(spark, scratch + "/src", scratch + "/out", scratch + "/ck", "1 hour", "10 minutes").awaitTermination()
    out = spark.read.parquet(scratch + "/out")
    batch = (t.groupBy("equipment_id", F.date_trunc("hour", "timestamp").alias("ws")).agg(F.count(F.lit(1)).alias("n")))
    joined = out.withColumn("ws", F.col("window_start").cast("timestamp_ntz")).join(batch, ["equipment_id", "ws"])
    assert joined.filter(F.col("n") != F.col("wafers")).count() == 0
    assert joined.count() == out.count() and out.count() >= batch.count() - 4


def test_spc_contaminated_series(spark):
    # clean baseline and a copy with spikes at 500..509 and 750..759 (limits from the clean copy)
    from fabflow.functions import synth as SY
    ids = spark.range(1000)
    clean = ids.select("id", SY.normal(350, 5, 7, "id", 1).alias("temperature_c"))
    dirty = clean.withColumn("temperature_c", F.when(F.col("id").between(500, 509), SY.normal(370, 2, 7, "id", 3))
                             .when(F.col("id").between(750, 759), SY.normal(330, 2, 7, "id", 3))
                             .otherwise(F.col("temperature_c")))
    s = SPC.detection_summary(dirty, clean, "temperature_c").first()
    assert s.total == 1000 and 12 <= s.detected <= 25
    lim = SPC.control_limits(clean, "temperature_c").first()
    assert abs(lim.mean - 350) < 0.6 and abs(lim.std - 5) < 0.4


def test_gate_batch_retry_is_idempotent(spark, scratch):
    run = J.gate_batch_writer(scratch + "/good", scratch + "/quar", scratch + "/rep")
    batch = SK.to_wire(frame(spark, [{"wafer_id": f"W{i}"} for i in range(4)], with_date=False)) \
        .withColumn("_corrupt_record", F.lit(None).cast("string"))
    from fabflow.sources.files import parse_wire
    b = parse_wire(batch)
    run(b, 7)
    run(b, 7)                                   # the same batch retried
    assert spark.read.parquet(scratch + "/good").count() == 4
    assert spark.read.parquet(scratch + "/rep").count() == 14


def test_alert_run_resets_after_silence(spark, scratch):
    base = datetime(2024, 1, 1)
    # two violations, a long silence (event time), then two more: with reset, no run of 3+
    ts = [base, base + timedelta(minutes=1), base + timedelta(hours=5), base + timedelta(hours=5, minutes=1),
          base + timedelta(hours=9)]
    rows = [{"wafer_id": f"W{i:08d}", "timestamp": t, "temperature_c": 390.0 if i < 4 else 350.0} for i, t in enumerate(ts)]
    df = frame(spark, rows, with_date=False)
    limits = spark.createDataFrame([("EQ001", 380.0, 320.0)], "equipment_id string, ucl double, lcl double")
    src = scratch + "/src"
    for i, (a, b) in enumerate([(0, 2), (2, 5)]):
        _write_batch(df.filter(F.col("wafer_id").between(f"W{a:08d}", f"W{b - 1:08d}")), src, i)
        time.sleep(1.1)
    AL.start_alerts(spark, src + "/b*", limits, scratch + "/out", scratch + "/ck", min_run=3,
                   max_files_per_trigger=1, reset_after_seconds=3600).awaitTermination()
    assert not glob.glob(scratch + "/out/**/*.parquet", recursive=True)      # no alert was written
    AL.start_alerts(spark, src + "/b*", limits, scratch + "/out2", scratch + "/ck2", min_run=3,
                   max_files_per_trigger=1).awaitTermination()
    assert sorted(r.wafer_id for r in spark.read.parquet(scratch + "/out2").collect()) == ["W00000002", "W00000003"]


def test_distributed_alerts_carry_state_and_reset(spark, scratch):
    base = datetime(2024, 1, 1)
    temps = [350, 390, 391, 350, 392, 393, 394, 350, 395, 396]
    ts = [base + timedelta(minutes=i) for i in range(8)] + [base + timedelta(hours=6), base + timedelta(hours=6, minutes=1)]
    rows = [{"wafer_id": f"W{i:08d}", "timestamp": t, "temperature_c": float(v)} for i, (t, v) in enumerate(zip(ts, temps))]
    df = frame(spark, rows, with_date=False)
    limits = spark.createDataFrame([("EQ001", 380.0, 320.0)], "equipment_id string, ucl double, lcl double")
    src = scratch + "/src"
    for i, (a, b) in enumerate([(0, 2), (2, 5), (5, 8), (8, 10)]):
        _write_batch(df.filter(F.col("wafer_id").between(f"W{a:08d}", f"W{b - 1:08d}")), src, i)
        time.sleep(1.1)
    AL.start_alerts(spark, src + "/b*", limits, scratch + "/out", scratch + "/ck", min_run=2,
                                reset_after_seconds=3600, max_files_per_trigger=1).awaitTermination()
    got = sorted((r.wafer_id, r.run_length) for r in spark.read.parquet(scratch + "/out").collect())
    # run 390,391 spans batches 0/1; 392..394 spans 1/2; after 6 h of silence 395,396 restart at 1
    assert got == [("W00000002", 2), ("W00000005", 2), ("W00000006", 3), ("W00000009", 2)]
    # the same through the table form, its state handed on from part to part
    state, found = None, []
    for a, b in [(0, 2), (2, 5), (5, 8), (8, 10)]:
        part = df.filter(F.col("wafer_id").between(f"W{a:08d}", f"W{b - 1:08d}"))
        alerts, state = AL.run_alerts_batch(part, limits, 2, reset_after_seconds=3600, state=state)
        found += [(r.wafer_id, r.run_length) for r in alerts.collect()]
    assert sorted(found) == got


def test_distributed_ks_matches_spark_ml(spark):
    from fabflow.functions import synth as SY
    from fabflow.sources.bridge import telemetry
    for df in (telemetry(spark, SF_SMALL), spark.range(5000).select(SY.normal(350, 5, 3, "id", 1).alias("temperature_c"))):
        ours = SPC.ks_normal(df, "temperature_c").first()
        few = SPC.ks_normal(df, "temperature_c", buckets=4).first()
        ml = SPC.normal_ks_test(df, "temperature_c").first()
        assert abs(ours.statistic - ml.statistic) < 1e-6
        assert abs(ours.statistic - few.statistic) < 1e-12          # bucketing does not change D
        assert abs(ours.p_value - ml.pValue) < 1e-2                 # asymptotic vs finite-n distribution


def test_ks_buckets_stay_balanced_far_from_the_model(spark):
    from fabflow.functions import synth as SY
    df = spark.range(4000).select(SY.normal(400, 5, 9, "id", 1).alias("temperature_c"))   # far from N(350, 5)
    r = SPC.ks_normal(df, "temperature_c", buckets=16).first()
    assert r.statistic > 0.99                                      # D is still correct
    assert abs(r.statistic - SPC.ks_normal(df, "temperature_c", buckets=1).first().statistic) < 1e-12


def test_batch_writers_accept_an_empty_micro_batch(spark, scratch):
    from fabflow.sources.files import parse_wire
    empty = parse_wire(SK.to_wire(frame(spark, [{}], with_date=False).limit(0))
                       .withColumn("_corrupt_record", F.lit(None).cast("string")))
    J.gate_batch_writer(scratch + "/g", scratch + "/q", scratch + "/r")(empty, 0)
    assert spark.read.parquet(scratch + "/r").count() == 14          # a report even for no rows
    limits = spark.createDataFrame([("EQ001", 380.0, 320.0)], "equipment_id string, ucl double, lcl double")
    one = frame(spark, [{"temperature_c": 390.0}], with_date=False)
    _, state = AL.run_alerts_batch(one, limits, 1)
    _, state = AL.run_alerts_batch(one.limit(0), limits, 1, state=state)
    assert state.select("run").first()[0] == 1                       # state carried through the empty batch


def test_delivery_stats_helper():
    assert J.delivery_stats(98, 2) == {"sent": 98, "failed": 2, "success_rate": 98.0}
    assert J.delivery_stats(0, 0)["success_rate"] == 0.0


WIRE = ('{"timestamp":"2024-01-01T0%d:00:00","wafer_id":"W%d","equipment_id":"EQ001","temperature_c":350.0,'
        '"pressure_torr":10.0,"yield_rate":0.9,"defect_count":1,"is_anomaly":false}')


def _half_malformed(path, files=5):
    os.makedirs(path)
    for i in range(files):
        with open(f"{path}/{i}.json", "w") as f:
            f.write(WIRE % (i, i) + "\n" + ("not json" if i % 2 else WIRE.replace("2024-01-01T0%d:00:00", "at %d") % (i, 9)) + "\n")


def test_no_stream_drops_malformed_rows(spark, scratch):
    src = scratch + "/src"
    _half_malformed(src)
    limits = spark.createDataFrame([("EQ001", 340.0, 320.0)], "equipment_id string, ucl double, lcl double")
    starts = {
        "archive": lambda o, c: J.start_archive(spark, src, o, c),
        "json": lambda o, c: J.start_json_append(spark, src, o, c),
        "dedup": lambda o, c: J.start_dedup(spark, src, o, c),
        "windows": lambda o, c: J.start_window_profile(spark, src, o, c),
        "alerts": lambda o, c: AL.start_alerts(spark, src, limits, o, c, min_run=1),
    }
    for name, start in starts.items():
        out = f"{scratch}/{name}"
        start(out, f"{scratch}/ck-{name}").awaitTermination()
        bad = spark.read.parquet(J.default_quarantine(out))
        assert bad.count() == 5 and bad.filter("raw = 'not json'").count() == 2, name
    J.start_gate(spark, src, scratch + "/g", scratch + "/b", scratch + "/r", scratch + "/ck-gate", max_files_per_trigger=None).awaitTermination()
    assert spark.read.parquet(scratch + "/b-malformed").count() == 5
    for name in ("archive", "dedup", "alerts"):
        assert spark.read.parquet(f"{scratch}/{name}").count() == 5


def test_counters_outlive_the_retained_progress(spark, scratch):
    src = scratch + "/src"
    _half_malformed(src)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        J.start_archive(spark, src, scratch + "/o", scratch + "/c", max_files_per_trigger=1, metrics=scratch + "/m").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    rows = J.progress_counters(spark, scratch + "/m").collect()
    assert len(rows) == 5 and all((r["rows"], r["malformed"]) == (1, 1) for r in rows)


def test_lost_offsets_fail_unless_the_caller_says_otherwise():
    from fabflow.sources.kafka import kafka_source_options
    assert "failOnDataLoss" not in kafka_source_options("h:1", "t")
    assert kafka_source_options("h:1", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def _in_turn(parts, path):
    """Each frame as one file in a folder of its own, by arrival."""
    for i, part in enumerate(parts):
        _write_batch(part, path, i)
        time.sleep(0.05)
    return path + "/b*"


def _readings(spark, minutes, temps=None):
    base = datetime(2024, 1, 1)
    rows = [{"wafer_id": f"W{i:08d}", "timestamp": base + timedelta(minutes=m), "temperature_c": 350.0 if temps is None else float(temps[i])}
            for i, m in enumerate(minutes)]
    return frame(spark, rows, with_date=False)


def _islands(rows, min_run):
    """(wafer, run) of out-of-limit readings in plain order."""
    run, out = 0, []
    for ts, w, t in sorted(rows):
        run = run + 1 if t > 380 or t < 320 else 0
        if run >= min_run:
            out.append((w, run))
    return sorted(out)


def test_alerts_order_readings_that_arrive_late(spark, scratch):
    import random
    rng = random.Random(3)
    minutes = list(range(60))
    temps = [rng.choice([350, 390, 390]) for _ in minutes]
    df = _readings(spark, minutes, temps)
    limits = spark.createDataFrame([("EQ001", 380.0, 320.0)], "equipment_id string, ucl double, lcl double")
    arrival = {m: m + rng.randint(0, 25) for m in minutes}           # up to 25 minutes out of order, so a batch or two
    n = F.substring("wafer_id", 2, 8).cast("int")
    parts = [df.filter(n.isin([m for m in minutes if lo <= arrival[m] < lo + 10])) for lo in range(0, 90, 10)]
    flush = _readings(spark, [6000]).withColumn("wafer_id", F.lit("END"))
    src = _in_turn([p for p in [*parts, flush] if p.count()], scratch + "/src")
    q = AL.start_alerts(spark, src, limits, scratch + "/out", scratch + "/ck", min_run=2, max_files_per_trigger=1, delay_seconds=50 * 60)
    q.awaitTermination()
    rows = [(m, f"W{m:08d}", temps[m]) for m in minutes]
    assert sorted((r.wafer_id, r.run_length) for r in spark.read.parquet(scratch + "/out").collect()) == _islands(rows, 2)
    assert not glob.glob(scratch + "/out-late/**/*.parquet", recursive=True)
    # with no patience, readings whose place has passed come out as late and the others are still numbered in order
    AL.start_alerts(spark, src, limits, scratch + "/out2", scratch + "/ck2", min_run=2, max_files_per_trigger=1).awaitTermination()
    late = {r.wafer_id for r in spark.read.parquet(scratch + "/out2-late").collect()}
    kept = [r for r in rows if r[1] not in late]
    assert late and sorted((r.wafer_id, r.run_length) for r in spark.read.parquet(scratch + "/out2").collect()) == _islands(kept, 2)


def test_every_row_of_a_dedup_stream_is_accounted_for(spark, scratch):
    import random
    rng = random.Random(4)
    parts, rows = [], 0
    for b in range(8):                                               # time runs on, some rows come from long ago, some twice, some without a key
        minutes = [b * 60 + rng.randint(0, 59) for _ in range(20)] + [rng.randint(0, max(1, b * 60)) for _ in range(10)]
        df = _readings(spark, minutes)
        ids = [f"K{b}-{i}" if i % 4 else (None if i % 8 else f"K{max(0, b - 1)}-{i + 1}") for i in range(30)]
        df = df.withColumn("wafer_id", F.element_at(F.array(*[F.lit(x) for x in ids]), F.substring("wafer_id", 2, 8).cast("int") + 1))
        parts.append(df)
        rows += 30
    src = _in_turn(parts, scratch + "/src")
    with open(scratch + "/src/b003/bad.json", "w") as f:
        f.write("not json\n")
    J.start_dedup(spark, src, scratch + "/out", scratch + "/ck", "30 minutes", max_files_per_trigger=1).awaitTermination()
    out, late = spark.read.parquet(scratch + "/out"), spark.read.parquet(scratch + "/out-late")
    came = spark.read.schema(C.WIRE_SCHEMA).json(src).filter("equipment_id is not null")
    keyless = came.filter("wafer_id is null").count()
    assert keyless > 10 and out.filter("wafer_id is null").count() == keyless                # all of them pass
    keyed = out.filter("wafer_id is not null")
    assert keyed.count() == keyed.select("wafer_id").distinct().count()
    assert late.count() > 5 and late.agg(F.min("lateness_seconds")).first()[0] >= 0
    assert spark.read.parquet(scratch + "/out-quarantine").count() == 1
    assert late.join(keyed, ["wafer_id", "timestamp"], "left_semi").count() == 0            # nothing is both late and out
    copies = rows - out.count() - late.count()
    assert copies >= 0
    # a row that is neither out nor late is a copy: its key came out before
    rest = came.select("wafer_id", F.to_timestamp("timestamp").alias("timestamp")).exceptAll(out.select("wafer_id", "timestamp")).exceptAll(late.select("wafer_id", "timestamp"))
    assert rest.count() == copies and rest.join(keyed, "wafer_id", "left_anti").count() == 0


def test_window_rows_are_in_a_window_or_late(spark, scratch):
    parts = [_readings(spark, range(0, 60, 3)), _readings(spark, range(180, 240, 3)), _readings(spark, [5, 10, 230, 235]), _readings(spark, [12, 600])]
    src = _in_turn(parts, scratch + "/src")
    J.start_window_profile(spark, src, scratch + "/out", scratch + "/ck", "1 hour", "10 minutes", max_files_per_trigger=1).awaitTermination()
    counted = spark.read.parquet(scratch + "/out").agg(F.sum("wafers")).first()[0]
    late = spark.read.parquet(scratch + "/out-late").count() if glob.glob(scratch + "/out-late/**/*.parquet", recursive=True) else 0
    assert late > 0 and counted + late + 1 == 20 + 20 + 4 + 2                                # the reading at minute 600 is in a window still open


def test_listener_counts_every_batch_and_logs(spark, scratch, caplog):
    import logging
    from fabflow.streaming.progress import ProgressListener
    src = scratch + "/src"
    os.makedirs(src)
    for i in range(102):
        with open(f"{src}/{i:04d}.json", "w") as f:
            f.write((WIRE % (i % 10, i) + "\n") * (1 + i % 3) + "not json\n" * (i % 2))
    seen = ProgressListener(log_every=100)
    spark.streams.addListener(seen)
    try:
        with caplog.at_level(logging.INFO, logger="fabflow.streaming.progress"):
            q = J.start_archive(spark, src, scratch + "/o", scratch + "/c", max_files_per_trigger=1, metrics=scratch + "/m")
            q.awaitTermination()
            assert seen.wait(q)
    finally:
        spark.streams.removeListener(seen)
    table = {r["batch_id"]: (r["rows"], r["malformed"]) for r in J.progress_counters(spark, scratch + "/m").collect()}
    mine = seen.batches(spark).filter(F.col("query") == str(q.id)).collect()
    assert len(table) == 102 and {r["batch_id"]: (r["sent"], r["failed"]) for r in mine if r["input_rows"]} == table
    total = seen.totals(q)
    sent, failed = sum(a for a, _ in table.values()), sum(b for _, b in table.values())
    assert (total["sent"], total["failed"], total["input_rows"]) == (sent, failed, sent + failed)
    assert abs(total["success_rate"] - J.delivery_stats(sent, failed)["success_rate"]) < 1e-9 and total["rows_per_second"] > 0
    assert sum("success_rate" in r.getMessage() for r in caplog.records) == 1


def test_listener_reports_rows_dropped_behind_the_watermark(spark, scratch):
    from fabflow.streaming.progress import ProgressListener
    src = _in_turn([_readings(spark, [0, 1]), _readings(spark, [500]), _readings(spark, [2, 3, 501]).withColumn("wafer_id", F.concat(F.lit("L"), "wafer_id"))],
                   scratch + "/src")
    seen = ProgressListener()
    spark.streams.addListener(seen)
    try:
        q = J.start_dedup(spark, src, scratch + "/out", scratch + "/ck", "0 seconds", max_files_per_trigger=1)
        q.awaitTermination()
        seen.wait(q)
    finally:
        spark.streams.removeListener(seen)
    late = spark.read.parquet(scratch + "/out-late").count() if glob.glob(scratch + "/out-late/**/*.parquet", recursive=True) else 0
    assert seen.totals(q)["dropped_late"] == late
    assert seen.totals(q)["sent"] == 6


def test_observation_counts_a_batch_without_a_second_read(spark, scratch):
    from fabflow.sources.files import read_json_lines
    from fabflow.streaming.progress import observed
    _half_malformed(scratch + "/src")
    rows, seen = observed(read_json_lines(spark, scratch + "/src"))
    J.good_rows(rows).select(*C.RAW_COLUMNS).write.parquet(scratch + "/o")
    assert (seen.get["sent"], seen.get["failed"]) == (5, 5)


def test_streams_leave_no_stage_behind(spark, scratch):
    from fabflow import session
    with session.stages(spark):
        kept = session.staging_path(spark, "x")
        spark.range(3).write.parquet(kept)
        assert session.path_exists(spark, kept)
    assert not session.path_exists(spark, kept)
    src = scratch + "/src"
    os.makedirs(src)
    for i in range(10):
        with open(f"{src}/{i:04d}.json", "w") as f:
            f.write(WIRE % (i, i) + "\n")
    limits = spark.createDataFrame([("EQ001", 340.0, 320.0)], "equipment_id string, ucl double, lcl double")
    folder = f"{session.checkpoint_root(spark)}/fabflow-stage/{spark.sparkContext.applicationId}-{os.getpid()}".removeprefix("file:")
    before = set(os.listdir(folder))
    AL.start_alerts(spark, src, limits, scratch + "/out", scratch + "/ck", min_run=1, max_files_per_trigger=1).awaitTermination()
    assert len(set(os.listdir(folder)) - before) <= 1                # the limits, once per query and not per batch
    assert spark.read.parquet(scratch + "/out").count() == 10


def _ten_readings(src: str) -> None:
    """One file per reading, all of one modification time, written last reading first."""
    os.makedirs(src)
    for i in reversed(range(10)):
        with open(f"{src}/{i:04d}.json", "w") as f:
            f.write(WIRE % (i, i) + "\n")
        os.utime(f"{src}/{i:04d}.json", (1_700_000_000, 1_700_000_000))


def test_alerts_run_on_a_session_with_another_state_store(spark, scratch):
    from fabflow.session import STATE_PROVIDER
    limits = spark.createDataFrame([("EQ001", 340.0, 320.0)], "equipment_id string, ucl double, lcl double")
    before = spark.conf.get(STATE_PROVIDER)
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    _ten_readings(scratch + "/src")
    spark.conf.set(STATE_PROVIDER, other)
    try:
        AL.start_alerts(spark, scratch + "/src", limits, scratch + "/out", scratch + "/ck", min_run=1).awaitTermination()
        assert spark.conf.get(STATE_PROVIDER) == other
    finally:
        spark.conf.set(STATE_PROVIDER, before)
    assert sorted(r["run_length"] for r in spark.read.parquet(scratch + "/out").collect()) == list(range(1, 11))


def test_alerts_take_files_of_one_time_by_name(spark, scratch):
    limits = spark.createDataFrame([("EQ001", 340.0, 320.0)], "equipment_id string, ucl double, lcl double")
    _ten_readings(scratch + "/src")
    with open(scratch + "/src/_SUCCESS", "w"), open(scratch + "/src/.part.crc", "w") as f:
        f.write("no reading")
    AL.start_alerts(spark, scratch + "/src", limits, scratch + "/out", scratch + "/ck", min_run=1, max_files_per_trigger=1).awaitTermination()
    assert sorted(r["run_length"] for r in spark.read.parquet(scratch + "/out").collect()) == list(range(1, 11))
    assert not [f for side in ("late", "quarantine") for f in glob.glob(f"{scratch}/out-{side}/**/*.parquet", recursive=True)]


def test_daily_files_arrive_in_date_order(spark, scratch):
    import __spark_entry__
    __spark_entry__.queries()
    from fabflow.plans.catalog_io import _arriving_by_day
    for i, day in enumerate(("2024-01-03", "2024-01-01", "2024-01-02")):       # the order the tasks ended in
        os.makedirs(f"{scratch}/src/_day={day}")
        with open(f"{scratch}/src/_day={day}/part-{3 - i}.json", "w") as f:
            f.write("{}\n")
        os.utime(f"{scratch}/src/_day={day}/part-{3 - i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    _arriving_by_day(spark, f"{scratch}/src/_day=*")
    found = [os.path.join(at, f) for at, _, files in os.walk(f"{scratch}/src") for f in files if f.endswith(".json")]
    assert [f.split("_day=")[1][:10] for f in sorted(found, key=os.path.getmtime)] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert len({os.path.getmtime(f) for f in found}) == 3


def test_no_task_gathers_the_readings_of_a_chamber(spark, scratch):
    limits = spark.createDataFrame([("EQ001", 340.0, 320.0)], "equipment_id string, ucl double, lcl double")
    _ten_readings(scratch + "/src")
    q = AL.start_alerts(spark, scratch + "/src", limits, scratch + "/out", scratch + "/ck", min_run=1)
    q.awaitTermination()
    state = next(p for p in q.recentProgress if p["numInputRows"])["stateOperators"]
    assert [s["numRowsTotal"] for s in state] == [10]                # a row each, whatever the chamber
    assert sorted(r["run_length"] for r in spark.read.parquet(scratch + "/out").collect()) == list(range(1, 11))


def test_alerts_count_copies_old_times_and_readings_of_no_chamber(spark, scratch):
    """Before 1970, equal in every column, without a chamber: in a first batch, and again behind the watermark."""
    day = lambda y, m, chamber, wafer, t: (datetime(y, 1, 1, 0, m), wafer, chamber, t)
    rows = [[day(1960, 1, "EQ001", "A", 390.0), day(2024, 1, "EQ001", "B", 390.0), day(2024, 1, "EQ001", "B", 390.0), day(2024, 2, "EQ001", None, 391.0),
             day(2024, 9, "EQ002", "C", 390.0), day(2024, 1, None, "D", 390.0)],
            [day(2024, 5, "EQ001", "E", 390.0), day(2024, 1, "EQ001", "F", 390.0), day(1960, 1, "EQ002", "G", 390.0), day(2024, 1, None, "D", 390.0)],
            [day(2024, 30, "EQ001", "H", 350.0)],
            [day(2024, 6, "EQ001", "I", 390.0), day(2024, 4, "EQ001", "J", 390.0)]]
    names = ("timestamp", "wafer_id", "equipment_id", "temperature_c")
    src = _in_turn([frame(spark, [dict(zip(names, r)) for r in part], with_date=False) for part in rows], scratch + "/src")
    limits = spark.createDataFrame([("EQ001", 380.0, 320.0), ("EQ002", 380.0, 320.0)], "equipment_id string, ucl double, lcl double")
    AL.start_alerts(spark, src, limits, scratch + "/out", scratch + "/ck", min_run=1, max_files_per_trigger=1).awaitTermination()
    got = sorted((r.equipment_id, r.run_length, r.wafer_id) for r in spark.read.parquet(scratch + "/out").collect())
    assert got == [("EQ001", 1, "A"), ("EQ001", 2, "B"), ("EQ001", 3, "B"), ("EQ001", 4, "F"), ("EQ001", 5, None), ("EQ001", 6, "E"),
                   ("EQ001", 7, "I"), ("EQ002", 1, "G"), ("EQ002", 2, "C")]
    assert [(r.equipment_id, r.wafer_id) for r in spark.read.parquet(scratch + "/out-late").collect()] == [("EQ001", "J")]
    assert len(os.listdir(scratch + "/ck/runs")) <= 2
