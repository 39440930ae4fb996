import math

import pytest
from pyspark.sql import functions as F

from fabflow.operators import profile as P
from fabflow.operators import sorting as SR
from fabflow.sources.bridge import telemetry_raw
from conftest import SF_SMALL
from helpers import frame


def test_describe_matches_pandas(spark):
    t = telemetry_raw(spark, SF_SMALL)
    pdf = t.toPandas()
    got = {r["column"]: r for r in P.describe_numeric(t).collect()}
    want = pdf[["temperature_c", "pressure_torr", "yield_rate", "defect_count"]].describe()
    for c in want.columns:
        for stat, key in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                          ("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("max", "max")]:
            assert got[c][key] == pytest.approx(want[c][stat], rel=1e-9), (c, stat)


def test_approx_describe_close_to_exact(spark):
    t = telemetry_raw(spark, SF_SMALL)
    ex = {r["column"]: r for r in P.describe_numeric(t).collect()}
    ap = {r["column"]: r for r in P.describe_numeric(t, exact=False).collect()}
    for c in ex:
        assert ap[c]["p50"] == pytest.approx(ex[c]["p50"], rel=1e-2)


def test_null_profile_counts_nan_as_missing(spark):
    df = frame(spark, [{"wafer_id": "W1", "temperature_c": float("nan")}, {"wafer_id": "W2", "temperature_c": None},
                       {"wafer_id": "W3"}, {"wafer_id": None}], with_date=False)
    got = {r["column"]: (r["null_count"], r["null_percentage"]) for r in P.null_profile(df, nulls_only=True).collect()}
    assert got == {"temperature_c": (2, 50.0), "wafer_id": (1, 25.0)}


def test_duplicate_profiles_match_pandas(spark):
    t = telemetry_raw(spark, SF_SMALL)
    u = SR.append_batches([t, t.limit(10)])
    pdf = u.toPandas()
    row = P.duplicate_row_profile(u).first()
    assert row["duplicate_rows"] == int(pdf.duplicated().sum())
    assert P.duplicate_key_profile(u).first()["duplicate_keys"] == int(pdf["wafer_id"].duplicated().sum())


def test_unique_and_value_counts_match_pandas(spark):
    t = telemetry_raw(spark, SF_SMALL)
    pdf = t.toPandas()
    got = {r["column"]: r["unique_count"] for r in P.unique_counts(t).collect()}
    assert got == {c: int(v) for c, v in pdf.nunique().items()}
    vc = {(r["column"], r["value"]): r["count"] for r in P.value_counts(t).collect()}
    for v, n in pdf["equipment_id"].value_counts().items():
        assert vc[("equipment_id", v)] == n


def test_mode_smallest_on_ties(spark):
    df = frame(spark, [{"defect_count": 3}, {"defect_count": 1}, {"defect_count": 3}, {"defect_count": 1},
                       {"defect_count": 2}], with_date=False)
    r = P.mode_value(df, "defect_count").first()
    assert (r["mode"], r["mode_count"]) == (1, 2)


def test_histogram_constant_column_and_closed_last_bin(spark):
    df = frame(spark, [{"temperature_c": 350.0}] * 3, with_date=False)
    bins = P.histogram(df, "temperature_c", 5).orderBy("bin").collect()
    assert sum(b["count"] for b in bins) == 3 and len(bins) == 5
    assert bins[0]["lower"] == 349.5 and bins[-1]["upper"] == 350.5
    df2 = frame(spark, [{"defect_count": k} for k in [0, 1, 11, 11, 12]], with_date=False)
    unit = {b["bin"]: b["count"] for b in P.histogram(df2, "defect_count", 11, 0, 11).collect()}
    assert unit[10] == 2 and unit[0] == 1 and sum(unit.values()) == 4   # 12 is outside the range


def test_correlation_matches_pandas(spark):
    t = telemetry_raw(spark, SF_SMALL)
    pdf = t.toPandas()[["temperature_c", "pressure_torr", "yield_rate", "defect_count"]].corr().round(3)
    for r in P.correlation_matrix(t).collect():
        assert r["correlation"] == pytest.approx(pdf.loc[r["column_a"], r["column_b"]], abs=1.1e-3)


def test_shape_and_table_info(spark):
    t = telemetry_raw(spark, SF_SMALL)
    s = P.shape(t).first()
    assert (s["rows"], s["columns"], s["elements"]) == (1100, 8, 8800)
    info = {r["column"]: (r["non_null_count"], r["dtype"]) for r in P.table_info(t).collect()}
    assert info["temperature_c"] == (1089, "double")
    assert P.column_types(t)[0] == ("timestamp", "timestamp_ntz")


def test_exact_sample_size_and_stability(spark):
    t = telemetry_raw(spark, SF_SMALL).dropDuplicates(["wafer_id"])
    n = t.count()
    for rate in (0.01, 0.1, 0.5):
        s = SR.exact_sample(t, rate, take_ordered=True)
        assert s.count() == math.floor(n * rate)
        b = SR.exact_sample(t, rate)          # bucketed path: same rows
        assert sorted(map(tuple, b.collect())) == sorted(map(tuple, s.collect()))
    a = {r.wafer_id for r in SR.exact_sample(t, 0.1).collect()}
    b = {r.wafer_id for r in SR.exact_sample(t.repartition(7), 0.1).collect()}
    assert a == b


def test_head_tail_per_group(spark):
    t = telemetry_raw(spark, SF_SMALL)
    h = SR.head_rows(t, 5, group="equipment_id")
    assert h.groupBy("equipment_id").count().agg(F.max("count")).first()[0] == 5
    tail = SR.tail_rows(t, 5).collect()
    assert [r.timestamp for r in tail] == sorted(r.timestamp for r in tail)
    assert SR.missing_columns(t, ["wafer_id", "date"]) == ["date"]


def test_anomaly_summary(spark):
    df = frame(spark, [{"is_anomaly": True}, {"is_anomaly": False}, {"is_anomaly": False}, {"is_anomaly": True}],
               with_date=False)
    r = P.anomaly_summary(df).first()
    assert (r["anomaly_count"], r["anomaly_rate_pct"], r["normal_count"]) == (2, 50.0, 2)
    empty = P.anomaly_summary(df.limit(0)).first()
    assert empty["anomaly_rate_pct"] == 0.0


def test_bounded_exact_quantiles_equal_percentile(spark):
    from fabflow.operators.quantiles import exact_quantiles
    t = telemetry_raw(spark, SF_SMALL)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column"], r["q_index"]): r["quantile"]
           for r in exact_quantiles(t, ["temperature_c", "defect_count"], probs, bits=6).collect()}
    want = t.agg(F.percentile(F.col("temperature_c"), probs).alias("t"),
                 F.percentile(F.col("defect_count").cast("double"), probs).alias("d")).first()
    for i in range(len(probs)):
        assert got[("temperature_c", i)] == pytest.approx(want["t"][i], rel=1e-12)
        assert got[("defect_count", i)] == pytest.approx(want["d"][i], rel=1e-12)
    grouped = P.describe_numeric(t, group="equipment_id", exact="bounded").collect()
    exact = {(r["equipment_id"], r["column"]): r for r in P.describe_numeric(t, group="equipment_id").collect()}
    for r in grouped:
        assert r["p50"] == pytest.approx(exact[(r["equipment_id"], r["column"])]["p50"], rel=1e-12)


def test_unique_counts_approx_close(spark):
    t = telemetry_raw(spark, SF_SMALL)
    ex = {r["column"]: r["unique_count"] for r in P.unique_counts(t).collect()}
    ap = {r["column"]: r["unique_count"] for r in P.unique_counts(t, approx=True).collect()}
    for c in ex:
        assert abs(ap[c] - ex[c]) <= max(2, 0.05 * ex[c])


def test_exact_sample_with_a_hot_key(spark):
    rows = [{"wafer_id": "HOT"}] * 600 + [{"wafer_id": f"W{i:05d}"} for i in range(1200)]
    df = frame(spark, rows, with_date=False)
    for rate in (0.05, 0.3, 0.5, 0.9):
        s = SR.exact_sample(df, rate, bucket_bits=2, copies_per_chunk=7)
        assert s.count() == math.floor(1800 * rate)
        real = {tuple(r) for r in df.collect()}
        assert all(tuple(r) in real for r in s.collect())            # only real rows
        assert s.groupBy("wafer_id").count().filter("wafer_id != 'HOT' and count > 1").count() == 0


def test_poisson_cells_above_twenty_keep_their_mass(spark):
    import math
    from fabflow.operators import spc as SPC
    counts = [24 + i % 9 for i in range(900)] + [None]
    df = spark.createDataFrame([(c,) for c in counts], "defect_count long")
    lam, top = 28.0, 40
    p = [math.exp(-lam + k * math.log(lam) - math.lgamma(k + 1)) for k in range(top)]
    p.append(1 - sum(p))
    seen = [sum(min(c, top) == k for c in counts if c is not None) for k in range(top + 1)]
    want = sum((o - 900 * q) ** 2 / (900 * q) for o, q in zip(seen, p))
    got = SPC.poisson_chi_square(df, lam=lam, max_k=top).first()
    assert abs(got.chi_square - want) < 1e-6 * want and got.degrees_of_freedom == 40
    assert SPC.poisson_chi_square(df, max_k=top).first().degrees_of_freedom == 39
    with pytest.raises(Exception, match="negative count"):
        SPC.poisson_chi_square(spark.createDataFrame([(-1,), (2,)], "defect_count long")).collect()


def test_menu_anomalies_and_info(spark):
    t = telemetry_raw(spark, SF_SMALL)
    got = P.profile(t, "anomalies").collect()
    assert [r["part"] for r in got].count("summary") == 1 and sum(r["part"] == "statistics" for r in got) == 4
    assert P.profile(t.drop("is_anomaly"), "anomalies").count() == 0
    info = P.profile(t, "info").collect()
    assert {r["total_bytes"] for r in info} == {P.total_bytes(t).first()["bytes"]}
    times = {r["column"]: r for r in P.describe_all(t).collect()}["timestamp"]
    assert times["min_time"] <= times["p25_time"] <= times["p50_time"] <= times["max_time"] and times["top"] is None
