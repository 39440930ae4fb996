import pytest
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.operators import quality as Q
from fabflow.plans import medallion as M
from helpers import frame, report_dict


def test_clean_frame_passes_all_native_bronze_rules(spark):
    df = frame(spark, [{"wafer_id": f"W{i:08d}"} for i in range(10)])
    rep = report_dict(Q.validation_report(df, "native", "bronze"))
    assert len(rep) == 14
    assert all(r["success"] for r in rep.values())
    s = Q.quality_gate(Q.validation_report(df, "native", "bronze")).first()
    assert (s.total_validations, s.passed, s.failed, s.critical_failures, s.is_valid) == (14, 14, 0, 0, True)


def test_empty_frame_range_fails_and_mean_fails(spark):
    df = frame(spark, [{}]).limit(0)
    rep = report_dict(Q.validation_report(df, "native", "bronze"))
    assert rep["temperature_c_range"]["success"] is False          # pass rate 0 on 0 rows
    assert rep["temperature_c_range"]["pass_rate"] == 0.0
    assert rep["temperature_c_mean"]["success"] is False            # no mean -> fail, not an error
    assert rep["temperature_c_mean"]["observed"] is None
    assert rep["wafer_id_uniqueness"]["success"] is True


def test_null_semantics_native_vs_ignore(spark):
    rows = [{"wafer_id": f"W{i:08d}"} for i in range(98)] + [
        {"wafer_id": "W00000098", "temperature_c": None}, {"wafer_id": "W00000099", "equipment_id": None}]
    df = M.silver(frame(spark, rows))
    native = report_dict(Q.validation_report(df, "native", "silver"))
    assert native["temperature_c_not_null"]["unexpected_count"] == 1
    # null is neither in nor out of the set; null not out of range but stays in the denominator
    assert native["equipment_id_values"]["unexpected_count"] == 0
    assert native["temperature_c_range"]["unexpected_count"] == 0
    assert native["temperature_c_range"]["element_count"] == 100
    suite = report_dict(Q.validation_report(df, "suite"))
    assert suite["temperature_c_range"]["element_count"] == 99
    assert suite["equipment_id_values"]["element_count"] == 99


def test_nan_counts_out_of_range(spark):
    rows = [{"wafer_id": f"W{i:08d}"} for i in range(9)] + [{"wafer_id": "W00000009", "temperature_c": float("nan")}]
    rep = report_dict(Q.validation_report(frame(spark, rows), "native", "bronze"))
    assert rep["temperature_c_range"]["unexpected_count"] == 1
    assert rep["temperature_c_range"]["pass_rate"] == pytest.approx(0.9)
    assert rep["temperature_c_range"]["success"] is False


def test_boundaries_are_inclusive(spark):
    rows = [{"wafer_id": "W1", "temperature_c": 330.0, "pressure_torr": 6.0, "yield_rate": 0.5, "defect_count": 0},
            {"wafer_id": "W2", "temperature_c": 380.0, "pressure_torr": 14.0, "yield_rate": 1.0, "defect_count": 30}]
    rep = report_dict(Q.validation_report(frame(spark, rows), "native", "bronze"))
    for c in C.PROCESS_COLUMNS:
        assert rep[f"{c}_range"]["unexpected_count"] == 0


def test_duplicates_equal_and_different_timestamps(spark):
    from datetime import datetime
    rows = [{"wafer_id": "W1"}, {"wafer_id": "W1"}, {"wafer_id": "W2"},
            {"wafer_id": "W2", "timestamp": datetime(2024, 1, 10, 12, 0, 1)}, {"wafer_id": "W3"}]
    rep = report_dict(Q.validation_report(frame(spark, rows), "native", "bronze"))
    assert rep["wafer_id_uniqueness"]["unexpected_count"] == 2
    assert rep["wafer_id_uniqueness"]["critical"] is True


def test_missing_column_is_a_failed_row_not_an_exception(spark):
    df = frame(spark, [{}]).drop("yield_rate")
    rep = report_dict(Q.validation_report(df, "native", "bronze"))
    assert rep["schema_columns"]["success"] is False
    assert "yield_rate" in rep["schema_columns"]["details"]
    assert rep["yield_rate_range"]["success"] is False and "not found" in rep["yield_rate_range"]["error"]
    assert rep["yield_rate_range"]["critical"] is False              # native keeps the rule's criticality
    suite = report_dict(Q.validation_report(df, "suite"))
    assert suite["yield_rate_range"]["critical"] is True              # suite: any rule error is critical


def test_extra_and_reordered_columns(spark):
    df = M.silver(frame(spark, [{}]))
    ok = report_dict(Q.validation_report(df, "suite"))
    assert ok["table_columns_match_ordered_list"]["success"] is True
    swapped = df.select("wafer_id", "timestamp", *[c for c in df.columns if c not in ("wafer_id", "timestamp")])
    bad = report_dict(Q.validation_report(swapped.withColumn("extra", F.lit(1)), "suite"))
    assert bad["table_columns_match_ordered_list"]["success"] is False
    assert bad["table_columns_match_ordered_list"]["critical"] is False
    native = report_dict(Q.validation_report(swapped.withColumn("extra", F.lit(1)), "native", "silver"))
    assert native["schema_columns"]["success"] is True               # superset check ignores order/extras


def test_layer_rule_counts(spark):
    df = M.silver(frame(spark, [{}]))
    assert Q.validation_report(df, "native", "silver").count() == 16
    assert Q.validation_report(df, "native", "gold").count() == 14
    assert Q.validation_report(df, "suite").count() == 16
    # silver optional in-set rules are skipped when their columns are absent
    assert Q.validation_report(df.drop("shift_number"), "native", "silver").count() == 15


def test_gate_raises_on_critical_failure(spark):
    df = frame(spark, [{"wafer_id": "W1"}, {"wafer_id": "W1"}])
    with pytest.raises(Q.QualityGateError):
        Q.assert_valid(Q.validation_report(df, "native", "bronze"))
    assert Q.assert_valid(Q.validation_report(frame(spark, [{}]), "native", "bronze"))["is_valid"]


def test_row_level_violations_names(spark):
    rows = [{"wafer_id": "W1"}, {"wafer_id": "W2", "temperature_c": 400.0, "equipment_id": "EQ999"}]
    v = Q.row_level_violations(frame(spark, rows), "native", "bronze").collect()
    assert len(v) == 1 and v[0]["violations"] == "equipment_id_values,temperature_c_range"


def test_report_is_one_aggregate_pass(spark):
    df = frame(spark, [{}])
    plan = Q.validation_report(df, "native", "bronze")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    main = plan.split("Subquery")[0]
    # the rule aggregate is global (no grouping keys); the distinct count is a separate subquery
    assert "Aggregate [count(1)" in main.replace("\n", " ") or "Aggregate [" in main


def test_freshness_rule(spark):
    from datetime import datetime
    old = frame(spark, [{"timestamp": datetime(2023, 6, 1)}])
    rep = report_dict(Q.validation_report(M.silver(old), "suite"))
    assert rep["timestamp_max"]["success"] is False
    rep = report_dict(Q.validation_report(M.silver(frame(spark, [{}])), "suite"))
    assert rep["timestamp_max"]["success"] is True


def test_all_null_column(spark):
    rows = [{"wafer_id": f"W{i}", "temperature_c": None} for i in range(5)]
    rep = report_dict(Q.validation_report(frame(spark, rows), "native", "bronze"))
    assert rep["temperature_c_not_null"]["unexpected_count"] == 5
    assert rep["temperature_c_mean"]["success"] is False and rep["temperature_c_mean"]["observed"] is None
    assert rep["temperature_c_range"]["unexpected_count"] == 0          # nulls are never out of range
    assert rep["temperature_c_range"]["pass_rate"] == 1.0
    suite = report_dict(Q.validation_report(M.silver(frame(spark, rows)), "suite"))
    assert suite["temperature_c_range"]["element_count"] == 0 and suite["temperature_c_range"]["success"] is True


def _config_of(rule):
    """The expectation-style entry of a rule."""
    names = {kind: name for name, kind in Q._CONFIG_KINDS.items()}
    kw = {"column": rule.column} if rule.column else {"column_list": list(rule.columns)}
    if rule.values:
        kw["value_set"] = list(rule.values)
    kw |= {k: v for k, v in (("min_value", rule.lo), ("max_value", rule.hi)) if v is not None}
    if rule.kind == "range":
        kw["mostly"] = rule.tolerance
    return {"expectation_type": names[rule.kind], "kwargs": kw}


def test_the_suite_survives_a_trip_through_its_configuration(spark):
    from fabflow.sources.bridge import telemetry_raw
    s = M.silver(telemetry_raw(spark, "/root/testdata/sf0.001"))
    a = Q.validation_report(s, Q.rules_from_config([_config_of(r) for r in Q.suite_rules()])).drop("details").collect()
    b = Q.validation_report(s, "suite").drop("details").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rules_from_configuration_on_other_columns(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cfg = [{"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "l_orderkey"}},
           {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "l_returnflag", "value_set": ["A", "R"]}},
           {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "l_quantity", "max_value": 40, "mostly": 0.5}},
           {"expectation_type": "expect_column_mean_to_be_between", "kwargs": {"column": "l_discount", "min_value": 0, "max_value": 1}}]
    rep = {r["rule"]: r for r in Q.validation_report(li, Q.rules_from_config(cfg)).collect()}
    pdf = li.toPandas()
    assert rep["unique"]["unexpected_count"] == len(pdf) - pdf.l_orderkey.nunique() and rep["unique"]["critical"]
    assert rep["in_set"]["unexpected_count"] == (~pdf.l_returnflag.isin(["A", "R"])).sum()
    assert rep["range"]["unexpected_count"] == (pdf.l_quantity.astype(float) > 40).sum() and rep["range"]["success"]
    assert rep["mean"]["success"] and not rep["mean"]["critical"]
    with pytest.raises(ValueError):
        Q.rules_from_config([{"expectation_type": "expect_something_else", "kwargs": {}}])


def test_rule_errors_are_failed_critical_rows(spark):
    df = spark.createDataFrame([("a", "1.5", [1]), ("b", "x", [2]), (None, None, None)], "k string, v string, l array<int>")
    rules = [Q.Rule("mean", "v", lo=0.0, hi=2.0, critical=False), Q.Rule("range", "l", lo=0, hi=1, critical=False),
             Q.Rule("max", "v", lo=0.0, hi=2.0, critical=False), Q.Rule("not_null", "k", critical=False),
             Q.Rule("in_set", "v", values=(1.5, 2), critical=True)]
    rows = {(r["rule"], r["column"]): r for r in Q.validation_report(df, rules).collect()}
    assert len(rows) == 5
    for k in (("mean", "v"), ("range", "l"), ("max", "v")):
        assert not rows[k]["success"] and rows[k]["critical"] and rows[k]["error"], k
    assert "1 values of v" in rows["mean", "v"]["error"]
    assert rows["not_null", "k"]["error"] is None and rows["not_null", "k"]["unexpected_count"] == 1
    assert rows["in_set", "v"]["unexpected_count"] == 1
    numbers = df.filter("v <> 'x'")
    assert Q.validation_report(numbers, rules[:1]).first()["success"]


def test_one_sided_bounds(spark):
    df = spark.createDataFrame([(1.0, "2024-01-05"), (3.0, "2024-02-05")], "x double, d string").selectExpr("x", "to_date(d) as d")
    def rule(kind, col, **kw):
        return Q.rules_from_config([{"expectation_type": kind, "kwargs": {"column": col, **kw}}])[0]
    cases = [(rule("expect_column_mean_to_be_between", "x", min_value=1.5), True), (rule("expect_column_mean_to_be_between", "x", max_value=1.5), False),
             (rule("expect_column_max_to_be_between", "x", min_value=3), True), (rule("expect_column_max_to_be_between", "x", max_value=2), False),
             (rule("expect_column_max_to_be_between", "d", min_value="2024-02-01"), True), (rule("expect_column_max_to_be_between", "d", max_value="2024-02-01"), False),
             (rule("expect_column_values_to_be_between", "x", min_value=2, mostly=0.9), False), (rule("expect_column_values_to_be_between", "x", max_value=9), True)]
    for r, want in cases:
        assert Q.validation_report(df, [r]).first()["success"] is want, r
