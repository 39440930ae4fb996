import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fabflow.operators import dedup as DD
from fabflow.operators import merge as MG
from fabflow.operators import windows as W
from fabflow.plans import medallion as M
from fabflow.sources.bridge import telemetry, telemetry_raw
from conftest import SF_SMALL
from helpers import frame


@pytest.mark.parametrize("bucket", [1, 60, 3600, 86400 * 40, "auto", "auto-small"])
def test_bucketed_rolling_mean_equals_plain_window(spark, bucket):
    t = telemetry_raw(spark, SF_SMALL)
    w = Window.partitionBy("equipment_id").orderBy("timestamp", "wafer_id").rowsBetween(-4, 0)
    want = {(r.wafer_id, r.timestamp): r.m for r in t.withColumn("m", F.avg("temperature_c").over(w)).collect()}
    if bucket == "auto-small":   # auto widths with ~20 rows per bucket: many buckets per key
        got = W.rolling_mean(t, "temperature_c", rows=5, bucket_seconds="auto", target_rows_per_bucket=20).collect()
    else:
        got = W.rolling_mean(t, "temperature_c", rows=5, bucket_seconds=bucket).collect()
    assert len(got) == len(want)
    for r in got:
        a, b = r.temperature_c_rolling_mean, want[(r.wafer_id, r.timestamp)]
        assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12)


def test_dedup_latest_is_idempotent_and_deterministic(spark):
    t = telemetry_raw(spark, SF_SMALL)
    once = DD.dedup_latest(t)
    twice = DD.dedup_latest(once)
    assert once.count() == 1000 == twice.count()
    assert once.exceptAll(twice).count() == 0
    assert DD.dedup_latest(t.repartition(5)).exceptAll(once).count() == 0
    # the redelivered (later) copy wins
    assert once.filter(F.col("wafer_id") == "W00000010").first().timestamp > \
        t.filter(F.col("wafer_id") == "W00000010").agg(F.min("timestamp")).first()[0]


def test_dedup_hot_key_is_combined_map_side(spark):
    t = frame(spark, [{"wafer_id": "HOT", "timestamp": datetime(2024, 1, 1) + timedelta(seconds=i)} for i in range(300)])
    plan = DD.dedup_latest(t)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert DD.dedup_latest(t).first().timestamp == datetime(2024, 1, 1) + timedelta(seconds=299)


def test_merge_upsert_partitions(spark, scratch):
    path = scratch + "/silver"
    base = M.bronze(telemetry(spark, SF_SMALL))
    MG.upsert_partitioned(base, path)
    assert spark.read.parquet(path).count() == 1000
    # redelivery: newer copies of some wafers, one moved to another date
    inc = M.bronze(telemetry_raw(spark, SF_SMALL)).filter(F.col("timestamp") != F.col("timestamp"))  # empty
    res = MG.upsert_partitioned(inc, path)
    assert spark.read.parquet(path).count() == 1000
    newer = (base.filter(F.col("wafer_id").isin("W00000001", "W00000002"))
             .withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 10 DAYS"))
             .withColumn("date", F.to_date("timestamp")).withColumn("temperature_c", F.lit(999.0)))
    res = MG.upsert_partitioned(newer, path)
    out = spark.read.parquet(path)
    assert out.count() == 1000
    assert out.filter(F.col("temperature_c") == 999.0).count() == 2
    assert res["touched_partitions"] >= 2
    again = MG.upsert_partitioned(newer, path)                       # idempotent rerun
    assert spark.read.parquet(path).count() == 1000 and again["emptied_partitions"] == 0


def test_merge_removes_emptied_partition(spark, scratch):
    path = scratch + "/t"
    one = frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 1, 1)},
                        {"wafer_id": "W2", "timestamp": datetime(2024, 3, 2, 1)}])
    MG.upsert_partitioned(one, path)
    moved = frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 2, 5)}])
    res = MG.upsert_partitioned(moved, path)
    out = spark.read.parquet(path)
    assert out.count() == 2 and out.filter(F.col("wafer_id") == "W1").count() == 1
    assert res["emptied_partitions"] == 1


def test_defect_trend_and_share(spark):
    t = telemetry_raw(spark, SF_SMALL)
    tr = W.daily_defect_trend(t)
    first = tr.filter(F.col("change").isNull()).count()
    assert first == tr.select("equipment_id").distinct().count()
    share = W.share_of_total(t, "equipment_id").agg(F.sum("share")).first()[0]
    assert share == pytest.approx(1.0)


def test_silver_columns_and_rules(spark):
    s = M.silver(frame(spark, [{"timestamp": datetime(2024, 1, 10, 17, 30), "temperature_c": 361.0}]))
    r = s.first()
    assert s.columns == list(__import__("fabflow.constants", fromlist=["x"]).SILVER_COLUMNS)
    assert (r.shift_number, r.hour_of_day, r.equipment_age_days) == (3, 17, 9)
    assert (r.quality_flag, r.quality_score) == ("PASS", 75)


def test_build_silver_table_gates_and_upserts(spark, scratch):
    from fabflow.operators.quality import QualityGateError
    path = scratch + "/silver"
    r = M.build_silver_table(M.bronze(telemetry(spark, SF_SMALL)), path)
    assert r["is_valid"] and spark.read.parquet(path).count() == 1000
    bad = M.bronze(telemetry_raw(spark, SF_SMALL))       # unknown chamber -> critical failure
    with pytest.raises(QualityGateError):
        M.build_silver_table(bad, path)
    assert spark.read.parquet(path).count() == 1000


def test_key_partitioning_keeps_a_key_in_one_partition(spark):
    from fabflow.sinks.kafka import key_partitioned
    t = telemetry_raw(spark, SF_SMALL)
    p = key_partitioned(t, 3).withColumn("pid", F.spark_partition_id())
    per_key = p.groupBy("equipment_id").agg(F.countDistinct("pid").alias("parts")).collect()
    assert all(r.parts == 1 for r in per_key)


def test_join_small_broadcasts_within_the_check_and_shuffles_beyond(spark):
    from fabflow.operators.joins import join_small
    t = telemetry_raw(spark, SF_SMALL)
    small = t.groupBy("equipment_id").agg(F.avg("temperature_c").alias("m"))
    j = join_small(t, small, "equipment_id", "left")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and j.count() == t.count()
    big = t.groupBy("wafer_id").agg(F.max("timestamp").alias("m"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        k = join_small(t, big, "wafer_id", "left")                # beyond the threshold in bytes: ordinary join
        assert "BroadcastHashJoin" not in k._jdf.queryExecution().executedPlan().toString()
        assert k.count() == t.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_with_lookback_prunes_but_finds_recent_moves(spark, scratch):
    path = scratch + "/t"
    rows = [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 1, 1)},
            {"wafer_id": "W2", "timestamp": datetime(2024, 3, 9, 1)}]
    MG.upsert_partitioned(frame(spark, rows), path)
    moved = frame(spark, [{"wafer_id": "W2", "timestamp": datetime(2024, 3, 10, 2), "temperature_c": 351.0}])
    res = MG.upsert_partitioned(moved, path, lookback_days=2)
    out = {r.wafer_id: (str(r.date), r.temperature_c) for r in spark.read.parquet(path).collect()}
    assert out == {"W1": ("2024-03-01", 350.0), "W2": ("2024-03-10", 351.0)}
    assert res["emptied_partitions"] == 1


def test_upsert_into_an_empty_table_folder(spark, scratch):
    path = scratch + "/t"
    empty = frame(spark, [{}]).limit(0)
    empty.write.mode("overwrite").partitionBy("date").parquet(path)      # folder with no data files
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1"}]), path)
    assert spark.read.parquet(path).count() == 1


def test_upsert_reads_only_touched_partitions(spark, scratch):
    path = scratch + "/t"
    rows = [{"wafer_id": f"W{d}", "timestamp": datetime(2024, 3, d, 1)} for d in range(1, 11)]
    MG.upsert_partitioned(frame(spark, rows), path)
    inc = frame(spark, [{"wafer_id": "W3", "timestamp": datetime(2024, 3, 3, 5), "temperature_c": 352.0}])
    stored = spark.read.parquet(path)
    q = stored.filter(F.col("date").isin([datetime(2024, 3, 3).date()]))
    assert "PartitionFilters: [isnotnull(date" in q._jdf.queryExecution().executedPlan().toString()
    res = MG.upsert_partitioned(inc, path)
    assert res["touched_partitions"] == 1
    out = spark.read.parquet(path)
    assert out.count() == 10 and out.filter(F.col("temperature_c") == 352.0).count() == 1


def test_upsert_keeps_and_moves_rows_without_a_date(spark, scratch):
    path = scratch + "/t"
    d1, d2 = datetime(2024, 3, 1, 1), datetime(2024, 3, 2, 1)
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "A", "timestamp": d1}, {"wafer_id": "B", "timestamp": None},
                                        {"wafer_id": "C", "timestamp": None}]), path)
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "D", "timestamp": None}, {"wafer_id": "A", "timestamp": d2}]), path)
    out = {r.wafer_id: r.date and str(r.date) for r in spark.read.parquet(path).collect()}
    assert out == {"A": "2024-03-02", "B": None, "C": None, "D": None}
    res = MG.upsert_partitioned(frame(spark, [{"wafer_id": w, "timestamp": d2} for w in "BCD"]), path, lookback_days=1)
    assert res["emptied_partitions"] == 1
    assert [str(r.date) for r in spark.read.parquet(path).collect()] == ["2024-03-02"] * 4


def test_upsert_outside_the_stated_delay_raises_before_writing(spark, scratch):
    path = scratch + "/t"
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 1, 1)}]), path)
    late = frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 20, 1)}])
    with pytest.raises(ValueError, match="W1"):
        MG.upsert_partitioned(late, path, lookback_days=2)
    assert spark.read.parquet(path).count() == 1


def test_upsert_that_stopped_half_way_is_finished_by_the_next(spark, scratch, monkeypatch):
    path = scratch + "/t"
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 1, 1)},
                                        {"wafer_id": "W2", "timestamp": datetime(2024, 3, 2, 1)}]), path)
    moved = frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 2, 5)}])

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:                       # the merge is staged, the table not yet changed
        m.setattr(MG, "_finish", stop)
        with pytest.raises(RuntimeError):
            MG.upsert_partitioned(moved, path)
    assert sorted((r.wafer_id, str(r.date)) for r in spark.read.parquet(path).collect()) == [("W1", "2024-03-01"), ("W2", "2024-03-02")]
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W3", "timestamp": datetime(2024, 3, 4)}]), path)
    assert sorted(r.wafer_id for r in spark.read.parquet(path).collect()) == ["W1", "W2", "W3"]


def test_upsert_stopped_while_it_changed_the_table_is_finished_by_the_next(spark, scratch, monkeypatch):
    path = scratch + "/t"
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 1, 1)},
                                        {"wafer_id": "W2", "timestamp": datetime(2024, 3, 2, 1)}]), path)
    moved = frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 2, 5)}])
    with monkeypatch.context() as m:                       # after the overwrites, before the staged data goes
        m.setattr(MG, "delete_path", lambda *_: None)
        MG.upsert_partitioned(moved, path)
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W3", "timestamp": datetime(2024, 3, 4)}]), path)
    assert sorted((r.wafer_id, str(r.date)) for r in spark.read.parquet(path).collect()) == [
        ("W1", "2024-03-02"), ("W2", "2024-03-02"), ("W3", "2024-03-04")]


def test_upsert_keeps_stored_columns_the_increment_lacks(spark, scratch):
    path = scratch + "/t"
    base = frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 1, 1)}, {"wafer_id": "W2", "timestamp": datetime(2024, 3, 1, 2)}])
    MG.upsert_partitioned(base.withColumn("extra", F.col("wafer_id")), path)
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W3", "timestamp": datetime(2024, 3, 1, 3)}, {"wafer_id": "W2", "timestamp": datetime(2024, 3, 1, 9)}]), path)
    out = {r.wafer_id: r.extra for r in spark.read.parquet(path).collect()}
    assert out == {"W1": "W1", "W2": None, "W3": None}
    for wrong in (base.withColumn("other", F.lit(1)), base.withColumn("extra", F.lit(1)), base.withColumn("temperature_c", F.lit("350"))):
        with pytest.raises(ValueError, match="other|extra|temperature_c"):
            MG.upsert_partitioned(wrong, path)
    assert spark.read.parquet(path).count() == 3


def test_key_table_finds_moved_keys_without_shuffling_the_stored_side(spark, scratch):
    from fabflow.operators import key_table as KT
    path, name = scratch + "/t", "keys_" + scratch[-6:].replace("-", "_").lower()
    rows = [{"wafer_id": f"W{i}", "timestamp": datetime(2024, 3, 1 + i % 9, 1)} for i in range(40)]
    MG.upsert_partitioned(frame(spark, rows), path, key_table=name)
    keys = frame(spark, [{"wafer_id": "W4"}, {"wafer_id": "new"}]).select("wafer_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = KT.stored_partitions(spark, name, keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan            # the increment's keys alone
    res = MG.upsert_partitioned(frame(spark, [{"wafer_id": "W0", "timestamp": datetime(2024, 3, 20)}, {"wafer_id": "N", "timestamp": datetime(2024, 3, 2)}]),
                                path, key_table=name)
    assert res == {"touched_partitions": 3, "emptied_partitions": 0}
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W0", "timestamp": datetime(2024, 3, 21)}]), path, key_table=name)
    KT.compact_key_table(spark, name)
    res = MG.upsert_partitioned(frame(spark, [{"wafer_id": "W0", "timestamp": datetime(2024, 3, 22)}]), path, key_table=name)
    assert res["touched_partitions"] == 2 and res["emptied_partitions"] == 1
    out = {r.wafer_id: r.date.day for r in spark.read.parquet(path).collect()}
    assert len(out) == 41 == spark.read.parquet(path).count() and out["W0"] == 22 and out["N"] == 2
    assert {r.wafer_id: r.date.day for r in KT.current_partitions(spark, name).collect()} == out
    spark.sql(f"DROP TABLE {name}")


def test_upsert_leaves_the_session_overwrite_mode_alone(spark, scratch):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for _ in range(2):
        MG.upsert_partitioned(frame(spark, [{}]), scratch + "/t")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_rows_without_a_key_are_not_copies_of_each_other(spark):
    rows = [{"wafer_id": None, "temperature_c": 1.0}, {"wafer_id": None, "temperature_c": 2.0}, {"wafer_id": None, "temperature_c": 2.0},
            {"wafer_id": "W1"}, {"wafer_id": "W1", "temperature_c": 3.0}]
    assert DD.dedup_latest(frame(spark, rows)).count() == 3


def test_ids_beyond_eight_digits_stay_distinct(spark):
    from fabflow.sources.bridge import telemetry_from_events
    ev = spark.createDataFrame([(100000001, 1), (1000000010, 1), (7, 1)], "event_id long, user_id long").selectExpr(
        "*", "timestamp_ntz'2024-01-01 00:00:00' as ts", "'x' as event_type", "1e0 as value", "'{\"k\": 1}' as props")
    assert sorted(r.wafer_id for r in telemetry_from_events(ev).collect()) == ["W00000007", "W100000001", "W1000000010"]


def test_no_shared_folder_on_a_cluster_raises(spark):
    from fabflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Faked:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.staging_path(Faked(), "x")
    assert session.is_local("local[4]") and not session.is_local("local-cluster[2,1,1024]")


def _plain_rolling(df, rows):
    from pyspark.sql import Window
    w = Window.partitionBy("equipment_id").orderBy("timestamp", "wafer_id").rowsBetween(-(rows - 1), 0)
    return {r.wafer_id: r.m for r in df.select("wafer_id", F.avg("temperature_c").over(w).alias("m")).collect()}


def test_rolling_mean_takes_rows_without_a_timestamp_first(spark):
    base = datetime(2024, 1, 1)
    rows = [{"wafer_id": f"W{i}", "timestamp": None if i < 2 else base + timedelta(hours=i), "temperature_c": float(i * i)} for i in range(6)]
    df = frame(spark, rows, with_date=False)
    for kw in ({"bucket_seconds": 3600}, {"bucket_seconds": "auto", "target_rows_per_bucket": 2}):
        got = {r.wafer_id: r.m for r in W.rolling_mean(df, "temperature_c", rows=3, out="m", **kw).collect()}
        assert got == pytest.approx(_plain_rolling(df, 3)), kw


def test_a_burst_is_cut_by_rows_not_by_time(spark):
    start = datetime(2024, 1, 1)
    late = spark.range(4000).selectExpr("format_string('W%08d', id) as wafer_id", "'EQ001' as equipment_id",
                                        "timestampadd(MILLISECOND, cast(id * 900 as int), timestamp_ntz'2024-06-01 00:00:00') as timestamp",
                                        "cast(id % 17 as double) as temperature_c")
    one = frame(spark, [{"wafer_id": "W_FIRST", "timestamp": start}], with_date=False).select(*late.columns)
    df = one.unionByName(late)
    sizes = [r["count"] for r in W.row_count_buckets(df, "equipment_id", "timestamp", 100).groupBy("_bk").count().collect()]
    assert max(sizes) <= 200 and len(sizes) > 20
    got = {r.wafer_id: r.m for r in W.rolling_mean(df, "temperature_c", rows=5, out="m", target_rows_per_bucket=100).collect()}
    assert got == pytest.approx(_plain_rolling(df, 5))


def _data_files(path):
    return len(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_upsert_writes_as_many_files_as_partitions_need(spark, scratch):
    # files were partitions times tasks, so they grew with the square of the table
    path, name = scratch + "/t", "keys_" + scratch[-6:].replace("-", "_").lower()
    rows = (spark.range(0, 20_000, 1, 8).select(F.format_string("W%08d", "id").alias("wafer_id"), F.rand(1).alias("temperature_c"),
                                                (F.lit(datetime(2024, 3, 1)) + F.make_dt_interval((F.col("id") % 40).cast("int"))).alias("timestamp"))
            .withColumn("date", F.when(F.col("temperature_c") > 0.2, F.to_date("timestamp"))))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")       # so that four tasks hold rows of every date
    try:
        MG.upsert_partitioned(rows, path, key_table=name)
        assert _data_files(path) == 41
        moved = rows.filter("wafer_id LIKE '%7'").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 HOUR")).withColumn("date", F.to_date("timestamp"))
        assert MG.upsert_partitioned(moved, path, key_table=name) == {"touched_partitions": 5, "emptied_partitions": 0}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", before)
    assert _data_files(path) <= 2 * 41
    assert spark.read.parquet(path).count() == 20_000 == spark.read.parquet(path).select("wafer_id").distinct().count()
    spark.sql(f"DROP TABLE {name}")


def test_upsert_computes_the_incoming_rows_once(spark, scratch):
    path, seen = scratch + "/t", spark.sparkContext.accumulator(0)
    base = frame(spark, [{"wafer_id": f"W{i}", "timestamp": datetime(2024, 3, 1 + i % 3, 1)} for i in range(30)])
    MG.upsert_partitioned(base, path)

    def count(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    later = base.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY")).withColumn("date", F.to_date("timestamp"))
    res = MG.upsert_partitioned(later.mapInPandas(count, later.schema), path)
    assert res == {"touched_partitions": 4, "emptied_partitions": 1} and seen.value == 30
    assert sorted(r.date.day for r in spark.read.parquet(path).collect()) == [2] * 10 + [3] * 10 + [4] * 10


def test_key_table_follows_the_copy_that_won(spark, scratch):
    from fabflow.operators import key_table as KT
    path, name = scratch + "/t", "keys_" + scratch[-6:].replace("-", "_").lower()
    none = {"wafer_id": None, "timestamp": datetime(2024, 3, 2)}
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 5)}, none]), path, key_table=name)
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 2)}, none]), path, key_table=name)      # an older copy, late
    assert [(r.wafer_id, r.date.day) for r in KT.current_partitions(spark, name).collect()] == [("W1", 5)]
    MG.upsert_partitioned(frame(spark, [{"wafer_id": "W1", "timestamp": datetime(2024, 3, 9)}]), path, key_table=name)
    assert sorted((r.wafer_id or "", r.date.day) for r in spark.read.parquet(path).collect()) == [("", 2), ("W1", 9)]
    spark.sql(f"DROP TABLE {name}")
