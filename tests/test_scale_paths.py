"""Histogram quantiles, running totals, co-moments, sketches, footers, rescued values: against plain definitions."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fabflow.operators import key_table  # noqa: F401  (imported here so that a missing module fails early)
from fabflow.operators import profile as P
from fabflow.operators import quantiles as QT
from fabflow.operators import sketches as SKT
from fabflow.operators import sorting as SR
from fabflow.operators import spc as SPC
from fabflow.operators.running import running_totals
from fabflow.sources import files as SF
from fabflow.sources import footers as FT
from fabflow.sources.bridge import telemetry_raw

ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf,
       1 - 2 ** -53, 1 + 2 ** -52, 2.0, 2 - 2 ** -52, 4.0, 1024.0, 1023.9999999999999, 0.1, 0.2, 0.30000000000000004, 1e-310, 1e300, 8.0, 0.5, 2.0 ** -1022]


def test_order_keys_are_the_bits_of_the_value(spark):
    rng = random.Random(1)
    values = ODD + [struct.unpack("d", rng.randbytes(8))[0] for _ in range(2000)] + [2.0 ** e for e in range(-1074, 1024, 7)]
    rows = QT.keyed_values(spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double"), ["x"]).collect()
    for v, r in zip(values, rows, strict=False):
        if math.isnan(v):
            assert r["_v0"] is None and r["_k0"] is None
            continue
        size = struct.unpack("q", struct.pack("d", abs(v)))[0]
        assert r["_k0"] == (-size if v < 0 else size), v
    assert rows[-1]["_k0"] is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits", [6, 16])
def test_quantiles_of_odd_columns_equal_percentile(spark, bits):
    rng = np.random.default_rng(3)
    n = 600
    rows = [(None if i % 5 == 0 else f"g{i % 3}", float(np.exp(40 * rng.normal())), float(rng.integers(0, 3)), None, int(rng.integers(-9, 9)) * 10 ** 15,
             None if i % 4 else math.nan, 7.25) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, heavy double, tied double, nothing double, whole bigint, rare double, same double")
    cols, probs = ["heavy", "tied", "nothing", "whole", "rare", "same"], [0.0, 0.01, 0.5, 0.77, 1.0]
    clean = df.withColumn("rare", F.when(~F.isnan("rare"), F.col("rare")))
    for g in ([], ["g"]):
        got = QT.exact_quantiles(df, cols, probs, g, bits=bits)
        assert "Window" not in _plan(got)
        want = {}
        for r in clean.groupBy(*g).agg(*[F.percentile(F.col(c).cast("double"), probs).alias(c) for c in cols]).collect():
            for c in cols:
                for j, q in enumerate(r[c] or [None] * len(probs)):
                    want[(r["g"] if g else None, c, j)] = q
        found = {(r["g"] if g else None, r["column"], r["q_index"]): r["quantile"] for r in got.collect()}
        assert found.keys() == want.keys() and len(found) == len(cols) * len(probs) * (4 if g else 1)
        for k, w in want.items():
            assert (w is None and found[k] is None) or found[k] == pytest.approx(w, rel=1e-12), k


def test_every_summary_of_sparse_empty_and_null_grouped_tables(spark):
    t = telemetry_raw(spark, SF_SMALL).withColumn("humidity", F.lit(None).cast("double")).withColumn("note", F.lit(None).cast("string"))
    t = t.withColumn("equipment_id", F.when(F.substring("wafer_id", 9, 1) != "3", F.col("equipment_id")))
    groups = {r[0] for r in t.select("equipment_id").distinct().collect()}
    assert None in groups
    per_column = {"describe": "humidity", "unique": "humidity", "memory": "humidity", "info": "humidity", "dtypes": "humidity", "describe_all": "note"}
    for name in P.SUMMARY_TYPES:
        whole = P.profile(t, name).collect()
        grouped = P.profile(t, name, "equipment_id").collect()
        none = P.profile(t.limit(0), name).collect()
        assert whole, name
        if name in per_column:
            c = per_column[name]
            assert c in {r["column"] for r in whole} and c in {r["column"] for r in none}, name
            assert {r["equipment_id"] for r in grouped if r["column"] == c} == groups, name
        elif name not in ("head", "tail", "sample", "value_counts", "anomalies", "corr"):
            assert {r["equipment_id"] for r in grouped} == groups, name
    d = {r["column"]: r for r in P.profile(t, "describe").collect()}
    assert d["humidity"]["count"] == 0 and d["humidity"]["p50"] is None
    info = [r for r in P.profile(t, "info", "equipment_id").collect() if r["equipment_id"] is None]
    assert info and all(r["total_bytes"] is not None for r in info)
    dup = {r["equipment_id"]: r["duplicate_keys"] for r in P.profile(t, "duplicates", "equipment_id").collect()}
    assert dup[None] is not None
    text = {r["column"]: r for r in P.profile(t, "describe_all").collect()}
    assert (text["note"]["count"], text["note"]["unique"], text["note"]["top"]) == (0, 0, None)


def test_running_totals_equal_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), i, rng.choice([None, 0, 1, 5, 10 ** 12]), f"p{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, w bigint, payload string")
    for parts in (1, 3, 16):
        got = {r["b"]: r["t"] for r in running_totals(df, ["a", "b"], "w", "t", parts).collect()}
        total, want = 0, {}
        for a, b, w, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            total += w or 0
            want[b] = total
        assert got == want
    assert running_totals(df.limit(0), "a", "w").count() == 0


def test_heavy_tails_are_dealt_evenly(spark):
    df = spark.range(20000).select(F.exp(F.randn(5) * 3).alias("x"))
    ranged = running_totals(df.groupBy("x").agg(F.count(F.lit(1)).alias("c")), "x", "c", "t", 8)
    assert ranged.agg(F.max("t")).first()[0] == 20000
    sizes = [r["count"] for r in df.distinct().repartitionByRange(8, "x").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * 20000 / 8
    plan = _plan(SPC.ks_normal(df, "x", 0.0, 1.0))
    assert "Window" not in plan and "SinglePartition" not in plan.split("HashAggregate(keys=[], functions=[max")[-1].split("Scan")[1]


def test_exact_sample_draws_rows_without_a_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 5 != 0, F.concat(F.lit("W"), "id")).alias("wafer_id"), (F.col("id") % 97).alias("v"), "id")
    for rate in (0.1, 0.5, 0.999, 1.0):
        got = SR.exact_sample(df, rate)
        rows = got.collect()
        assert len(rows) == math.floor(1000 * rate) == len({r["id"] for r in rows})
        keyless = sum(r["wafer_id"] is None for r in rows)
        assert abs(keyless - 200 * rate) <= 4 * math.sqrt(200 * rate * (1 - rate)) + 1
        assert sorted(r["id"] for r in rows) == sorted(r["id"] for r in SR.exact_sample(df, rate, take_ordered=True).collect())
    same = spark.createDataFrame([(None, 1)] * 300 + [("a", 1)] * 200, "wafer_id string, v int")
    assert SR.exact_sample(same, 0.5, copies_per_chunk=7).count() == 250


def test_buckets_go_on_where_one_pass_is_not_enough(spark, monkeypatch):
    from fabflow.operators import windows as W
    monkeypatch.setattr(W, "COARSE", 2)
    monkeypatch.setattr(W, "FINE", 2)                              # four buckets a pass instead of 1,024
    df = spark.range(3000).selectExpr("'EQ' as equipment_id", "timestampadd(SECOND, cast(id as int), timestamp_ntz'2024-01-01 00:00:00') as timestamp",
                                      "format_string('W%08d', id) as wafer_id", "cast(id % 17 as double) as v")
    df = df.unionByName(spark.range(500).selectExpr("'EQ' as equipment_id", "timestamp_ntz'2024-01-01 00:10:00' as timestamp",
                                                    "format_string('X%08d', id) as wafer_id", "1e0 as v"))
    b = W.row_count_buckets(df, "equipment_id", "timestamp", 50)
    sizes = b.groupBy("_bk").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("timestamp").alias("t"), F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    rows = sorted(sizes.collect(), key=lambda r: r["_bk"])
    assert sum(r["n"] for r in rows) == 3500 and len(rows) > 30
    assert all(r["n"] <= 150 or r["t"] == 1 for r in rows if r["lo"] > rows[0]["lo"] and r["n"] != max(x["n"] for x in rows))
    assert all(a["hi"] < c["lo"] for a, c in zip(rows, rows[1:]))   # numbers rise with time
    from pyspark.sql import Window
    w = Window.partitionBy("equipment_id").orderBy("timestamp", "wafer_id").rowsBetween(-4, 0)
    want = {r.wafer_id: r.m for r in df.select("wafer_id", F.avg("v").over(w).alias("m")).collect()}
    got = {r.wafer_id: r.m for r in W.rolling_mean(df, "v", rows=5, out="m", target_rows_per_bucket=50).collect()}
    assert got == pytest.approx(want)


def test_correlation_of_many_columns_equals_pandas(spark):
    import pandas as pd
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 300)) @ np.diag(rng.uniform(0.1, 1e4, 300)) + rng.uniform(-1e6, 1e6, 300)
    x[:, 7] = 0.1
    x[:, 8] = x[:, 9] * 2 + 1
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 11] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(300)])
    df = spark.createDataFrame(pdf).repartition(5)
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in P.correlation_matrix(df).collect()}
    want = pdf.corr()
    assert len(got) == 90000 and got["c8", "c9"] == 1.0 and got["c7", "c1"] is None and got["c11", "c11"] is None
    for (a, b), r in got.items():
        w = want.loc[a, b]
        if a != "c7" and b != "c7":
            assert (r is None and math.isnan(w)) or r == pytest.approx(w, abs=6e-4), (a, b)


def test_correlation_per_group_with_null_groups_and_infinities(spark):
    rows = [(None if i % 3 == 0 else f"g{i % 3}", float(i), float(i * i % 17), math.inf if i == 4 else float(-i)) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double")
    got = {(r["g"], r["column_a"], r["column_b"]): r["correlation"] for r in P.correlation_matrix(df, group="g").collect()}
    assert len(got) == 27 and got[None, "a", "c"] == -1.0 and math.isnan(got["g1", "a", "c"]) and got["g1", "a", "a"] == 1.0
    for g in (None, "g1", "g2"):
        mine = [r for r in rows if r[0] == g]
        assert got[g, "a", "b"] == pytest.approx(np.corrcoef([r[1] for r in mine], [r[2] for r in mine])[0, 1], abs=6e-4)


def test_footers_answer_without_reading_columns(spark, scratch):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as int) as k", "case when id % 10 = 0 then null else cast(id as double) end as v", "cast(id as string) as s")
    df.repartition(4).write.parquet(scratch + "/t")
    count, ranges = FT.footer_row_count(spark, scratch + "/t"), FT.footer_ranges(spark, scratch + "/t")
    for q in (count, ranges):
        plan = _plan(q)
        assert "PushedAggregation: [COUNT(*)" in plan and "PushedAggregation: []" not in plan
    assert count.first()[0] == 1000
    got = {r["column"]: tuple(r)[1:] for r in ranges.collect()}
    assert got == {"id": (1000, 1000, 0, "0", "999"), "k": (1000, 1000, 0, "0", "6"), "v": (1000, 900, 100, "1.0", "999.0")}
    with pytest.raises(ValueError, match="s"):
        FT.footer_ranges(spark, scratch + "/t", ["s"])
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sketches_add_a_day_without_reading_the_others(spark, scratch):
    path = scratch + "/sk"
    day = lambda i, lo, hi: spark.range(lo, hi).selectExpr(f"date'2024-01-0{i}' as date", "id", "cast(id % 50 as double) as v", "cast(null as string) as none")
    for kind in ("hll", "theta"):
        p = path + kind
        SKT.store_sketches(SKT.distinct_sketches(day(1, 0, 6000).unionByName(day(2, 3000, 9000)), ["id", "v", "none"], kind=kind), p)
        files = set(spark.read.parquet(p).inputFiles())
        SKT.store_sketches(SKT.distinct_sketches(day(3, 9000, 12000), ["id", "v", "none"], kind=kind), p)
        assert files < set(spark.read.parquet(p).inputFiles())      # older days are the same files
        got = {r["column"]: (r["rows"], r["estimate"]) for r in SKT.distinct_over(spark, p, kind=kind).collect()}
        assert got["none"] == (15000, 0) and got["v"][1] == 50
        assert abs(got["id"][1] - 12000) <= 4 * SKT.relative_error(kind) * 12000
        two = {r["column"]: r["estimate"] for r in SKT.distinct_over(spark, p, F.col("date") <= "2024-01-02", kind).collect()}
        assert abs(two["id"] - 9000) <= 4 * SKT.relative_error(kind) * 9000
    both = {r["column"]: r["estimate"] for r in SKT.distinct_shared(spark, path + "theta", F.col("date") == "2024-01-01", F.col("date") == "2024-01-02").collect()}
    assert abs(both["id"] - 3000) <= 4 * SKT.relative_error("theta") * 9000


def test_heavy_hitters_equal_the_exact_mode(spark):
    rng = random.Random(5)
    hot = [f"h{i}" for i in range(3) for _ in range(400)] + [f"r{rng.randrange(10 ** 6)}" for _ in range(3000)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in hot], "v string").repartition(6)
    got = SKT.heavy_hitters(df, "v", 1, tracked=2000).collect()
    mode = P.mode_value(df, "v").first()
    assert [(r["value"], r["count"], r["decided_by"]) for r in got] == [(mode["mode"], mode["mode_count"], "summary")] == [("h0", 400, "summary")]
    assert [(r["value"], r["count"]) for r in SKT.heavy_hitters(df, "v", 3, tracked=2000).collect()] == [("h0", 400), ("h1", 400), ("h2", 400)]
    flat = spark.range(4000).selectExpr("cast(id % 2000 as int) as v")
    got = SKT.heavy_hitters(flat, "v", 2, tracked=1000).collect()
    assert [(r["value"], r["count"], r["decided_by"]) for r in got] == [(0, 2, "full count"), (1, 2, "full count")]
    assert SKT.heavy_hitters(df.limit(0), "v").count() == 0


def test_rescued_values_and_split(spark):
    rows = [("2024-01-01 00:00:00", "W1", "E", "350.5", "10", "0.9", "3", "true", "x"), ("2024-01-01 00:00:00", "W2", "E", "hot", "10", "0.9", "3.x", "true", "x"),
            ("yesterday", "W3", None, None, "10", "0.9", "99999999999999999999", "maybe", "x")]
    df = spark.createDataFrame(rows, "timestamp string, wafer_id string, equipment_id string, temperature_c string, pressure_torr string, "
                                     "yield_rate string, defect_count string, is_anomaly string, extra string")
    plain, kept = SF.enforce_schema(df), SF.enforce_schema(df, SF.RESCUED)
    assert kept.drop(SF.RESCUED).schema == plain.schema and plain.count() == kept.count() == 3
    good, bad = SF.split_rescued(df)
    assert [r["wafer_id"] for r in good.collect()] == ["W1"] and good.schema == plain.schema
    got = {r["wafer_id"]: (r[SF.RESCUED], r["pressure_torr"]) for r in bad.collect()}
    assert got["W2"] == ('{"temperature_c":"hot","defect_count":"3.x"}', 10.0)
    assert got["W3"][0] == '{"timestamp":"yesterday","defect_count":"99999999999999999999","is_anomaly":"maybe"}'
    assert SF.enforce_schema(df.select("extra"), SF.RESCUED).filter(F.col(SF.RESCUED).isNotNull()).count() == 0


def test_missing_columns_as_a_table(spark):
    got = {r["column"]: (r["present"], r["dtype"]) for r in SR.missing_columns_table(telemetry_raw(spark, SF_SMALL), ["wafer_id", "date"]).collect()}
    assert got == {"wafer_id": (True, "string"), "date": (False, None)}
