import pytest
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.functions import synth as SY
from conftest import SF_SMALL


def test_golden_pattern_values(spark):
    g = SY.golden_pattern(spark.range(1000), "id")
    per = {r.equipment_id: r["count"] for r in g.groupBy("equipment_id").count().collect()}
    assert per == {"EQ001": 250, "EQ002": 250, "EQ003": 250, "EQ004": 250}
    r = g.agg(F.avg("temperature_c").alias("t"), F.avg("pressure_torr").alias("p"), F.avg("yield_rate").alias("y"),
              F.sum("defect_count").alias("d")).first()
    assert r.t == pytest.approx(354.5) and r.p == pytest.approx(10.2) and r.y == pytest.approx(0.905) and r.d == 2000


def test_synth_moments_within_bounds(spark):
    s = SY.synth_telemetry(spark.range(50000), "id")
    r = s.agg(F.avg("temperature_c").alias("tm"), F.stddev_pop("temperature_c").alias("ts"),
              F.avg("pressure_torr").alias("pm"), F.stddev_pop("pressure_torr").alias("ps"),
              F.avg("yield_rate").alias("ym"), F.min("yield_rate").alias("ymin"), F.max("yield_rate").alias("ymax"),
              F.avg("defect_count").alias("dm"), F.variance("defect_count").alias("dv")).first()
    assert abs(r.tm - 350) < 0.15 and abs(r.ts - 5) < 0.1
    assert abs(r.pm - 10) < 0.015 and abs(r.ps - 0.5) < 0.01
    assert abs(r.ym - (0.80 + 0.19 * 20 / 22)) < 0.002 and 0.80 <= r.ymin and r.ymax <= 0.99
    assert abs(r.dm - 2) < 0.05 and abs(r.dv - 2) < 0.1
    per = s.groupBy("equipment_id").count().collect()
    assert len(per) == 4 and all(abs(x["count"] - 12500) < 500 for x in per)


def test_synth_independent_of_partitioning(spark):
    a = SY.synth_telemetry(spark.range(0, 2000, numPartitions=1), "id")
    b = SY.synth_telemetry(spark.range(0, 2000, numPartitions=7), "id")
    assert a.exceptAll(b).count() == 0


def test_inject_anomalies_exact_count_and_types(spark):
    s = SY.inject_anomalies(SY.synth_telemetry(spark.range(5000), "id"), 0.01)
    assert s.filter("is_anomaly").count() == 50
    from fabflow.operators.spc import classify_anomaly_type
    kinds = {r.anomaly_type for r in classify_anomaly_type(s.filter("is_anomaly")).collect()}
    assert kinds <= set(C.ANOMALY_TYPES) | {"none"} and len(kinds & set(C.ANOMALY_TYPES)) >= 3


def test_entry_and_catalog_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 14 and df.columns[:5] == ["validation", "column", "rule", "success", "critical"]
    qs, sq = E.queries(), E.oracle_sql()
    assert set(sq) <= set(qs) and len(qs) >= 90
    for name in ("agg_row_count", "dq_summary", "spc_detect_3sigma", "win_rolling_mean"):
        assert qs[name](spark, SF_SMALL).count() >= 1


def test_oracle_agreement_small(spark):
    import duckdb
    import __spark_entry__ as E
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    for name in ("dq_native_bronze_report", "agg_describe_numeric", "med_silver", "spc_detection_summary",
                 "syn_inject_anomalies", "win_dedup_latest"):
        s = E.queries()[name](spark, SF_SMALL)
        rows_s = sorted(map(lambda r: tuple(str(v) for v in r), s.select(sorted(s.columns)).collect()))
        rel = con.sql(E.oracle_sql()[name])
        cols = rel.columns
        d = rel.fetchall()
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        rows_d = sorted(tuple(str(r[i]) for i in order) for r in d)
        assert len(rows_s) == len(rows_d), name


def test_validator_style_api(spark):
    from fabflow.operators.quality import is_valid, validate_dataframe
    from fabflow.plans import medallion as M
    from fabflow.sources.bridge import telemetry, telemetry_raw
    s = validate_dataframe(M.silver(telemetry(spark, SF_SMALL)), layer="silver")
    assert s["total_validations"] == 16 and is_valid(s)
    assert {"validation", "column", "success", "critical", "details"} <= set(s["results"][1])
    b = validate_dataframe(M.bronze(telemetry_raw(spark, SF_SMALL)), layer="bronze")
    assert not is_valid(b) and b["critical_failures"] == 3
    d = {r["validation"]: r["details"] for r in b["results"]}
    assert d["wafer_id_uniqueness"] == {"duplicates": 100}
    assert d["temperature_c_not_null"] == {"null_count": 11}
    assert d["equipment_id_values"] == {"invalid_count": 10, "valid_values": ["EQ001", "EQ002", "EQ003", "EQ004"]}
    assert d["temperature_c_range"]["out_of_range"] == 0 and d["temperature_c_range"]["pass_rate"] == 1.0
    assert d["schema_columns"] == {"missing": [], "layer": "bronze"}
    assert abs(d["yield_rate_mean"]["actual"] - 0.943641) < 1e-6


def test_profile_dispatcher_covers_every_summary(spark):
    from fabflow.operators.profile import SUMMARY_TYPES, profile
    from fabflow.sources.bridge import telemetry_raw
    t = telemetry_raw(spark, SF_SMALL)
    for kind in SUMMARY_TYPES:
        assert profile(t, kind).count() >= 1, kind
    assert profile(t.withColumn("f", F.lit("a")), "shape", group=["f"]).count() == 1


def test_generate_batch_and_json(spark, scratch):
    from fabflow.sources.files import read_json_lines
    b = SY.generate_batch(spark, 1000, start_id=5000)
    assert b.count() == 1000 and b.filter("is_anomaly").count() == 10
    assert b.agg(F.min("wafer_id")).first()[0] == "W00005000"
    SY.generate_to_json(spark, 2000, scratch + "/gen")
    assert read_json_lines(spark, scratch + "/gen").filter(F.col("timestamp").isNotNull()).count() == 2000


def test_profile_dispatcher_per_file(spark, scratch):
    from fabflow.operators.profile import SUMMARY_TYPES, profile
    from fabflow.sinks.files import date_partitioned_archive
    from fabflow.sources.bridge import telemetry_raw
    from fabflow.sources.files import read_parquet_files
    date_partitioned_archive(telemetry_raw(spark, SF_SMALL), scratch + "/a", "overwrite")
    a = read_parquet_files(spark, scratch + "/a")
    files = a.select("source_file").distinct().count()
    for kind in SUMMARY_TYPES:
        out = profile(a, kind, group=["source_file"])
        assert "source_file" in out.columns and out.select("source_file").distinct().count() >= 1, kind
    s = profile(a, "sample", group=["source_file"])
    assert s.groupBy("source_file").count().agg(F.max("count")).first()[0] <= 5
    assert s.select("source_file").distinct().count() == files
