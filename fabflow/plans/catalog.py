"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables. Subjects are the ``telemetry`` / ``telemetry_raw`` views
over ``events`` (see :mod:`fabflow.sources.bridge`) and, for the generic
operators, ``lineitem``. Double outputs are rounded to 6 decimals on both
sides so that summation order cannot change the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.operators import quality as Q
from fabflow.plans import expected_rules as XR
from fabflow.plans import medallion as M
from fabflow.sources.bridge import TELEMETRY_RAW_SQL, TELEMETRY_SQL, read_table, telemetry, telemetry_raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Silver oracle: latest row per wafer (timestamp, then every column, descending,
# nulls last), then the derived columns; ingestion time left out.
_SILVER_SQL = """SELECT timestamp, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate,
       defect_count, is_anomaly, date,
       cast(floor(hour(timestamp) / 8) + 1 AS INTEGER) AS shift_number,
       cast(hour(timestamp) AS INTEGER) AS hour_of_day,
       cast(date_diff('day', DATE '2024-01-01', date) AS INTEGER) AS equipment_age_days,
       temperature_c - 350e0 AS temperature_deviation_c,
       pressure_torr - 10e0 AS pressure_deviation_torr,
       CASE WHEN coalesce(temperature_c BETWEEN 330e0 AND 380e0 AND NOT isnan(temperature_c), false)
             AND coalesce(pressure_torr BETWEEN 6e0 AND 14e0 AND NOT isnan(pressure_torr), false)
             AND coalesce(yield_rate BETWEEN 0.5e0 AND 1e0 AND NOT isnan(yield_rate), false)
             AND coalesce(defect_count BETWEEN 0 AND 30, false) THEN 'PASS' ELSE 'FAIL' END AS quality_flag,
       cast(100 - 25 * (
            CASE WHEN coalesce(temperature_c BETWEEN 340e0 AND 360e0 AND NOT isnan(temperature_c), false) THEN 0 ELSE 1 END
          + CASE WHEN coalesce(pressure_torr BETWEEN 8e0 AND 12e0 AND NOT isnan(pressure_torr), false) THEN 0 ELSE 1 END
          + CASE WHEN coalesce(yield_rate BETWEEN 0.85e0 AND 1e0 AND NOT isnan(yield_rate), false) THEN 0 ELSE 1 END
          + CASE WHEN coalesce(defect_count BETWEEN 0 AND 8, false) THEN 0 ELSE 1 END) AS INTEGER) AS quality_score
FROM (SELECT *, row_number() OVER (PARTITION BY wafer_id ORDER BY timestamp DESC NULLS LAST,
              equipment_id DESC NULLS LAST, temperature_c DESC NULLS LAST, pressure_torr DESC NULLS LAST,
              yield_rate DESC NULLS LAST, defect_count DESC NULLS LAST, is_anomaly DESC NULLS LAST,
              date DESC NULLS LAST) AS rn
      FROM {src}) d
WHERE rn = 1"""

BASE_CTES = {
    "telemetry": TELEMETRY_SQL,
    "telemetry_raw": TELEMETRY_RAW_SQL,
    "bronze_clean": "SELECT *, cast(timestamp AS DATE) AS date FROM telemetry",
    "bronze_raw": "SELECT *, cast(timestamp AS DATE) AS date FROM telemetry_raw",
    "silver_clean": _SILVER_SQL.format(src="bronze_clean"),
    "silver_raw": _SILVER_SQL.format(src="bronze_raw"),
}


def sql(body: str, ctes: dict | None = None, round_cols: tuple = (), digits: int = 6) -> str:
    """Oracle text: base views + extra CTEs + body, doubles rounded to ``digits`` places."""
    allc = dict(BASE_CTES)
    allc.update(ctes or {})
    with_ = ",\n".join(f"{k} AS (\n{v}\n)" for k, v in allc.items())
    if round_cols:
        rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in round_cols)
        body = f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) _q"
    return f"WITH {with_}\n{body}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the catalogue's comparison convention)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def prepare(spark: SparkSession) -> None:
    """Session settings every query relies on: UTC session time (event times are
    UTC wall clock) and a checkpoint/staging folder (the cluster's, when set)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    from fabflow.session import checkpoint_root
    checkpoint_root(spark)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------------------
# Subjects.
# ---------------------------------------------------------------------------
def bronze_clean(spark, d):
    return M.bronze(telemetry(spark, d))


def bronze_raw(spark, d):
    return M.bronze(telemetry_raw(spark, d))


def silver_clean(spark, d):
    return M.silver(telemetry(spark, d))


def silver_raw(spark, d):
    return M.silver(telemetry_raw(spark, d))


# ---------------------------------------------------------------------------
# Oracle text for a validation report, written independently of the Spark
# compiler: one UNION ALL branch per rule over one aggregate row.
# ---------------------------------------------------------------------------
_REPORT_COLS = [n for n, _ in Q.REPORT_FIELDS]
_DUCK_TYPES = {"string": "VARCHAR", "boolean": "BOOLEAN", "bigint": "BIGINT", "double": "DOUBLE"}


def _branch(vals: dict, from_: str | None = "a", group: str | None = None) -> str:
    parts = [f"a.{group} AS {group}"] if group else []
    for n, t in Q.REPORT_FIELDS:
        v = vals.get(n, "NULL")
        parts.append(f"CAST({v} AS {_DUCK_TYPES[t]}) AS \"{n}\"")
    if group:
        from_ = "a"
    return "SELECT " + ", ".join(parts) + (f" FROM {from_}" if from_ else "")


def _q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def report_sql(rules: list, subject: str, subject_cols: list[str], group: str | None = None) -> str:
    aggs = ["count(*) AS total"]
    branches = []
    def branch(vals, from_="a"):
        return _branch(vals, from_, group)
    for i, r in enumerate(rules):
        ignore = r.null_policy == "ignore"
        base = {"validation": _q(r.validation), "column": _q(r.column) if r.column else "NULL",
                "rule": _q(r.kind), "critical": "TRUE" if r.critical else "FALSE"}
        if r.kind == "schema_superset":
            missing = sorted(set(r.columns) - set(subject_cols))
            det = "missing=" + ",".join(missing) + (f";layer={r.layer}" if r.layer else "")
            branches.append(branch({**base, "success": "TRUE" if not missing else "FALSE",
                                     "unexpected_count": str(len(missing)), "details": _q(det)}, None))
            continue
        if r.kind == "schema_ordered":
            ok = list(subject_cols) == list(r.columns)
            branches.append(branch({**base, "success": "TRUE" if ok else "FALSE",
                                     "details": "NULL" if ok else _q("actual=" + ",".join(subject_cols))}, None))
            continue
        if r.column not in subject_cols:
            if r.optional:
                continue
            branches.append(branch({**base, "success": "FALSE", "critical": "TRUE" if (ignore or r.critical) else "FALSE",
                                     "error": _q(f"column {r.column!r} not found")}, None))
            continue
        c = r.column
        if r.kind == "unique":
            aggs += [f"count(DISTINCT {c}) AS d{i}", f"count({c}) AS n{i}"]
            b = f"n{i}" if ignore else "total"
            branches.append(branch({**base, "success": f"{b} = d{i}", "element_count": b,
                                     "unexpected_count": f"{b} - d{i}"}))
        elif r.kind == "not_null":
            aggs.append(f"count(*) FILTER (WHERE {c} IS NULL) AS u{i}")
            branches.append(branch({**base, "success": f"u{i} = 0", "element_count": "total",
                                     "unexpected_count": f"u{i}"}))
        elif r.kind == "in_set":
            vals = ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r.values)
            aggs += [f"count(*) FILTER (WHERE {c} NOT IN ({vals})) AS u{i}", f"count({c}) AS n{i}"]
            b = f"n{i}" if ignore else "total"
            branches.append(branch({**base, "success": f"u{i} = 0", "element_count": b, "unexpected_count": f"u{i}",
                                     "details": _q("valid=" + ",".join(str(v) for v in r.values))}))
        elif r.kind == "range":
            aggs += [f"count(*) FILTER (WHERE {c} < {r.lo} OR {c} > {r.hi}) AS u{i}", f"count({c}) AS n{i}"]
            if ignore:
                rate = f"CASE WHEN n{i} > 0 THEN CAST(n{i} - u{i} AS DOUBLE) / n{i} END"
                ok = f"coalesce({rate} >= {r.tolerance}, TRUE)"
                b = f"n{i}"
            else:
                rate = f"CASE WHEN total > 0 THEN CAST(total - u{i} AS DOUBLE) / total ELSE 0.0 END"
                ok = f"{rate} >= {r.tolerance}"
                b = "total"
            branches.append(branch({**base, "success": ok, "element_count": b, "unexpected_count": f"u{i}",
                                     "pass_rate": rate, "expected_min": str(float(r.lo)),
                                     "expected_max": str(float(r.hi)), "details": _q(f"tolerance={r.tolerance}")}))
        elif r.kind == "mean":
            aggs += [f"avg(CAST({c} AS DOUBLE)) AS m{i}", f"count({c}) AS n{i}"]
            branches.append(branch({**base, "success": f"coalesce(m{i} BETWEEN {r.lo} AND {r.hi}, FALSE)",
                                     "element_count": f"n{i}", "observed": f"m{i}",
                                     "expected_min": str(float(r.lo)), "expected_max": str(float(r.hi))}))
        elif r.kind == "max":
            aggs += [f"max({c}) AS x{i}", f"count({c}) AS n{i}"]
            ok = f"coalesce(x{i} BETWEEN TIMESTAMP '{r.lo}' AND TIMESTAMP '{r.hi}', FALSE)"
            branches.append(branch({**base, "success": ok, "element_count": f"n{i}",
                                     "observed": f"epoch_us(x{i}) / 1e6",
                                     "details": _q(f"between={r.lo}..{r.hi}")}))
    if group:
        agg_cte = f"SELECT {group}, {', '.join(aggs)} FROM {subject} GROUP BY {group}"
    else:
        agg_cte = f"SELECT {', '.join(aggs)} FROM {subject}"
    return agg_cte, "\nUNION ALL\n".join(branches)


def _report_oracle(rules, subject, cols, summary: str | None = None):
    agg, body = report_sql(rules, subject, cols)
    ctes = {"a": agg, "report": body}
    if summary is None:
        return sql('SELECT * FROM report', ctes, round_cols=("pass_rate", "observed"))
    return sql(summary, ctes)


_BRONZE_COLS = list(C.BRONZE_COLUMNS)
_SILVER_COLS = list(C.SILVER_COLUMNS)
_SUMMARY_SQL = """SELECT count(*) AS total_validations,
       count(*) FILTER (WHERE success) AS passed,
       count(*) FILTER (WHERE NOT success) AS failed,
       count(*) FILTER (WHERE NOT success AND critical) AS critical_failures{extra}
FROM report"""


# ---------------------------------------------------------------------------
# M0: data-quality reports (DQ-3..11, fused into one aggregate per report).
# ---------------------------------------------------------------------------
@register("dq_native_bronze_report",
          _report_oracle(XR.NATIVE["bronze"], "bronze_raw", _BRONZE_COLS))
def q_dq_native_bronze_report(spark, d):
    return rounded(Q.validation_report(bronze_raw(spark, d), "native", "bronze"))


@register("dq_native_clean_bronze_report",
          _report_oracle(XR.NATIVE["bronze"], "bronze_clean", _BRONZE_COLS))
def q_dq_native_clean_bronze_report(spark, d):
    return rounded(Q.validation_report(bronze_clean(spark, d), "native", "bronze"))


@register("dq_native_silver_report",
          _report_oracle(XR.NATIVE["silver"], "silver_raw", _SILVER_COLS))
def q_dq_native_silver_report(spark, d):
    return rounded(Q.validation_report(silver_raw(spark, d), "native", "silver"))


@register("dq_suite_silver_report",
          _report_oracle(XR.SUITE, "silver_raw", _SILVER_COLS))
def q_dq_suite_silver_report(spark, d):
    return rounded(Q.validation_report(silver_raw(spark, d), "suite"))


@register("dq_native_gold_layer_report",
          _report_oracle(XR.NATIVE["gold"], "bronze_raw", _BRONZE_COLS))
def q_dq_native_gold_layer_report(spark, d):
    # A gold-labelled layer checks bronze's columns (only silver is special).
    return rounded(Q.validation_report(bronze_raw(spark, d), "native", "gold"))


@register("dq_summary",
          _report_oracle(XR.NATIVE["bronze"], "bronze_raw", _BRONZE_COLS, _SUMMARY_SQL.format(extra="")))
def q_dq_summary(spark, d):
    return Q.validation_summary(Q.validation_report(bronze_raw(spark, d), "native", "bronze"))


@register("dq_gate",
          _report_oracle(XR.NATIVE["silver"], "silver_clean", _SILVER_COLS,
                         _SUMMARY_SQL.format(extra=",\n       count(*) FILTER (WHERE NOT success AND critical) = 0 AS is_valid")))
def q_dq_gate(spark, d):
    return Q.quality_gate(Q.validation_report(silver_clean(spark, d), "native", "silver"))


@register("dq_suite_gate",
          _report_oracle(XR.SUITE, "silver_raw", _SILVER_COLS,
                         _SUMMARY_SQL.format(extra=",\n       count(*) FILTER (WHERE NOT success AND critical) = 0 AS is_valid")))
def q_dq_suite_gate(spark, d):
    return Q.quality_gate(Q.validation_report(silver_raw(spark, d), "suite"))


@register("dq_row_violations", sql("""
SELECT *, concat_ws(',',
    CASE WHEN wafer_id IS NULL THEN 'wafer_id_not_null' END,
    CASE WHEN equipment_id IS NULL THEN 'equipment_id_not_null' END,
    CASE WHEN timestamp IS NULL THEN 'timestamp_not_null' END,
    CASE WHEN temperature_c IS NULL THEN 'temperature_c_not_null' END,
    CASE WHEN yield_rate IS NULL THEN 'yield_rate_not_null' END,
    CASE WHEN equipment_id NOT IN ('EQ001','EQ002','EQ003','EQ004') THEN 'equipment_id_values' END,
    CASE WHEN temperature_c < 330 OR temperature_c > 380 THEN 'temperature_c_range' END,
    CASE WHEN pressure_torr < 6 OR pressure_torr > 14 THEN 'pressure_torr_range' END,
    CASE WHEN yield_rate < 0.5 OR yield_rate > 1.0 THEN 'yield_rate_range' END,
    CASE WHEN defect_count < 0 OR defect_count > 30 THEN 'defect_count_range' END) AS violations
FROM bronze_raw
WHERE wafer_id IS NULL OR equipment_id IS NULL OR timestamp IS NULL OR temperature_c IS NULL
   OR yield_rate IS NULL OR equipment_id NOT IN ('EQ001','EQ002','EQ003','EQ004')
   OR temperature_c < 330 OR temperature_c > 380 OR pressure_torr < 6 OR pressure_torr > 14
   OR yield_rate < 0.5 OR yield_rate > 1.0 OR defect_count < 0 OR defect_count > 30"""))
def q_dq_row_violations(spark, d):
    return Q.row_level_violations(bronze_raw(spark, d), "native", "bronze")


# ---------------------------------------------------------------------------
# M1: profiles (AGG), filters (FLT), projections (PRJ, SCL), sort/limit (SRT), SET.
# ---------------------------------------------------------------------------
from fabflow.functions import scalar as S  # noqa: E402
from fabflow.operators import filters as FL  # noqa: E402
from fabflow.operators import profile as P  # noqa: E402
from fabflow.operators import sorting as SR  # noqa: E402

_PROC = list(C.PROCESS_COLUMNS)
_RAW = list(C.RAW_COLUMNS)
_RAW_TYPES = {"timestamp": "timestamp_ntz", "wafer_id": "string", "equipment_id": "string",
              "temperature_c": "double", "pressure_torr": "double", "yield_rate": "double",
              "defect_count": "bigint", "is_anomaly": "boolean"}
_DOUBLES = {c for c, t in _RAW_TYPES.items() if t == "double"}


def _v(c: str) -> str:
    """SQL value with NaN read as missing (doubles), cast to DOUBLE."""
    if c in _DOUBLES:
        return f"CASE WHEN NOT isnan({c}) THEN {c} END"
    return f"CAST({c} AS DOUBLE)"


def _describe_sql(subject: str, cols) -> str:
    parts = []
    for c in cols:
        v = _v(c)
        parts.append(
            f"SELECT '{c}' AS \"column\", count({v}) AS count, avg({v}) AS mean, stddev_samp({v}) AS std, "
            f"min({v}) AS min, quantile_cont({v}, 0.25) AS p25, quantile_cont({v}, 0.5) AS p50, "
            f"quantile_cont({v}, 0.75) AS p75, max({v}) AS max FROM {subject}")
    return "\nUNION ALL\n".join(parts)


_DESC_ROUND = ("mean", "std", "min", "p25", "p50", "p75", "max")
_READINGS = ("temperature_c", "pressure_torr", "yield_rate")


def _telemetry(spark, d):
    return telemetry(spark, d)


def _raw(spark, d):
    return telemetry_raw(spark, d)


@register("agg_row_count", sql("SELECT count(*) AS row_count FROM telemetry_raw"))
def q_agg_row_count(spark, d):
    return P.row_count(_raw(spark, d))


@register("agg_row_count_per_equipment",
          sql("SELECT equipment_id, count(*) AS row_count FROM telemetry_raw GROUP BY equipment_id"))
def q_agg_row_count_per_equipment(spark, d):
    return P.row_count(_raw(spark, d), "equipment_id")


@register("agg_count_distinct", sql("SELECT count(DISTINCT wafer_id) AS distinct_count FROM telemetry_raw"))
def q_agg_count_distinct(spark, d):
    return P.count_distinct(_raw(spark, d), "wafer_id")


@register("agg_column_mean", sql(f"SELECT avg({_v('temperature_c')}) AS mean FROM telemetry_raw", round_cols=("mean",)))
def q_agg_column_mean(spark, d):
    return rounded(P.column_mean(_raw(spark, d), "temperature_c"))


@register("agg_anomaly_summary", sql("""
SELECT equipment_id, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       coalesce(CAST(count(*) FILTER (WHERE is_anomaly) AS DOUBLE) / count(*) * 100e0, 0e0) AS anomaly_rate_pct,
       count(*) - count(*) FILTER (WHERE is_anomaly) AS normal_count
FROM telemetry_raw GROUP BY equipment_id""", round_cols=("anomaly_rate_pct",)))
def q_agg_anomaly_summary(spark, d):
    return rounded(P.anomaly_summary(_raw(spark, d), "equipment_id"))


@register("agg_anomaly_stats",
          sql(_describe_sql("(SELECT * FROM telemetry WHERE is_anomaly) a", _PROC), round_cols=_DESC_ROUND))
def q_agg_anomaly_stats(spark, d):
    return rounded(P.anomaly_stats(_telemetry(spark, d)))


def _null_sql(cols, nonzero=False):
    parts = []
    for c in cols:
        miss = f"{c} IS NULL OR isnan({c})" if c in _DOUBLES else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {miss}) AS null_count, "
                     f"round(coalesce(CAST(count(*) FILTER (WHERE {miss}) AS DOUBLE) / count(*) * 100e0, 0e0), 2) "
                     f"AS null_percentage FROM telemetry_raw")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT * FROM ({body}) n WHERE null_count > 0" if nonzero else body


@register("agg_null_profile", sql(_null_sql(_RAW)))
def q_agg_null_profile(spark, d):
    return P.null_profile(_raw(spark, d))


@register("flt_nonzero_null_columns", sql(_null_sql(_RAW, nonzero=True)))
def q_flt_nonzero_null_columns(spark, d):
    return P.null_profile(_raw(spark, d), nulls_only=True)


_UNION_SQL = "SELECT * FROM telemetry UNION ALL SELECT * FROM telemetry_raw"


@register("agg_duplicate_rows", sql(f"""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       round(coalesce(CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100e0, 0e0), 2) AS duplicate_pct
FROM (SELECT count(*) AS n FROM ({_UNION_SQL}) u GROUP BY ALL_COLUMNS) g""".replace(
    "GROUP BY ALL_COLUMNS", "GROUP BY " + ", ".join(_RAW))))
def q_agg_duplicate_rows(spark, d):
    return P.duplicate_row_profile(SR.append_batches([_telemetry(spark, d), _raw(spark, d)]))


@register("agg_duplicate_keys", sql("""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_keys FROM (SELECT count(*) AS n FROM telemetry_raw GROUP BY wafer_id) g"""))
def q_agg_duplicate_keys(spark, d):
    return P.duplicate_key_profile(_raw(spark, d))


@register("agg_describe_numeric", sql(_describe_sql("telemetry_raw", _PROC), round_cols=_DESC_ROUND))
def q_agg_describe_numeric(spark, d):
    return rounded(P.describe_numeric(_raw(spark, d)))


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("agg_describe_lineitem", sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(v) AS count, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, "
    f"quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max "
    f"FROM (SELECT CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS v FROM lineitem) x"
    for c in _LI_NUM), round_cols=_DESC_ROUND))
def q_agg_describe_lineitem(spark, d):
    return rounded(P.describe_numeric(read_table(spark, d, "lineitem")))


_TIME_STATS = ("mean", "min", "p25", "p50", "p75", "max")
_CAT = ["timestamp", "wafer_id", "equipment_id", "is_anomaly"]


def _categorical_sql(subject, cols):
    vals = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM {subject}" for c in cols)
    return f"""
SELECT col AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       arg_min(value, (-n, value)) AS top, CAST(max(n) AS BIGINT) AS freq
FROM (SELECT col, value, count(*) AS n FROM ({vals}) v WHERE value IS NOT NULL GROUP BY col, value) g
GROUP BY col"""


@register("agg_describe_all", sql(f"""
SELECT "column", count, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq,
       mean, std, min, p25, p50, p75, max, {", ".join(f"NULL::TIMESTAMP AS {s}_time" for s in _TIME_STATS)}
FROM ({_describe_sql('telemetry_raw', _PROC)}) n
UNION ALL
SELECT "column", count, "unique", top, freq, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM ({_categorical_sql('telemetry_raw', [c for c in _CAT if c != 'timestamp'])}) c
UNION ALL
SELECT 'timestamp', count(timestamp), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       {", ".join(f"date_trunc('second', make_timestamp(CAST(round({e}) AS BIGINT)))" for e in (
           "avg(us)", "min(us)", "quantile_cont(us, 0.25)", "quantile_cont(us, 0.5)", "quantile_cont(us, 0.75)", "max(us)"))}
FROM (SELECT timestamp, CAST(epoch_us(timestamp) AS DOUBLE) AS us FROM telemetry_raw) t""", round_cols=_DESC_ROUND))
def q_agg_describe_all(spark, d):
    # timestamps to the second: a mean of 10^15 microseconds in doubles is not exact to the last one
    out = P.describe_all(_raw(spark, d))
    return rounded(out.withColumns({f"{s}_time": F.date_trunc("second", f"{s}_time").cast("timestamp_ntz") for s in _TIME_STATS}))


@register("agg_anomalies_menu", sql(f"""
SELECT 'summary' AS part, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       coalesce(CAST(count(*) FILTER (WHERE is_anomaly) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100e0, 0e0) AS anomaly_rate_pct,
       count(*) FILTER (WHERE NOT is_anomaly) AS normal_count, NULL::VARCHAR AS "column", NULL::BIGINT AS count,
       NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75, NULL::DOUBLE AS max
FROM telemetry_raw
UNION ALL
SELECT 'statistics', NULL, NULL, NULL, "column", count, mean, std, min, p25, p50, p75, max
FROM ({_describe_sql('(SELECT * FROM telemetry_raw WHERE is_anomaly)', list(C.PROCESS_COLUMNS))}) s""",
    round_cols=_DESC_ROUND + ("anomaly_rate_pct",)))
def q_agg_anomalies_menu(spark, d):
    return rounded(P.profile(_raw(spark, d), "anomalies"))


@register("agg_shape", sql(f"""
SELECT count(*) AS "rows", CAST(8 AS BIGINT) AS "columns", count(*) * 8 AS elements,
       '{",".join(_RAW)}' AS column_names FROM telemetry_raw"""))
def q_agg_shape(spark, d):
    return P.shape(_raw(spark, d))


_INFO_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null_count, '{t}' AS dtype FROM telemetry_raw"
    for c, t in _RAW_TYPES.items())


@register("agg_table_info", sql(_INFO_SQL))
def q_agg_table_info(spark, d):
    return P.table_info(_raw(spark, d))


@register("agg_unique_counts", sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {('CASE WHEN NOT isnan(' + c + ') THEN ' + c + ' END') if c in _DOUBLES else c}) "
    f"AS unique_count FROM telemetry_raw" for c in _RAW)))
def q_agg_unique_counts(spark, d):
    return P.unique_counts(_raw(spark, d))


@register("agg_value_counts", sql("""
SELECT 'equipment_id' AS "column", CAST(equipment_id AS VARCHAR) AS value, count(*) AS count
FROM telemetry_raw WHERE equipment_id IS NOT NULL GROUP BY equipment_id
UNION ALL
SELECT 'is_anomaly', CAST(is_anomaly AS VARCHAR), count(*) FROM telemetry_raw WHERE is_anomaly IS NOT NULL GROUP BY is_anomaly"""))
def q_agg_value_counts(spark, d):
    return P.value_counts(_raw(spark, d))


@register("agg_correlation_matrix", sql("\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({_v(a)}, {_v(b)}), 3) AS correlation FROM telemetry_raw"
    for a in _PROC for b in _PROC)))
def q_agg_correlation_matrix(spark, d):
    return P.correlation_matrix(_raw(spark, d))


def _bytes_sql():
    parts = []
    for c, t in _RAW_TYPES.items():
        w = P.FIXED_WIDTH.get(t)
        b = f"count({c}) * {w}" if w else f"coalesce(sum(strlen({c})), 0)"
        parts.append(f"SELECT '{c}' AS \"column\", CAST({b} AS BIGINT) AS bytes FROM telemetry_raw")
    return "SELECT *, round(bytes / (1024e0 * 1024e0), 2) AS megabytes FROM (" + "\nUNION ALL\n".join(parts) + ") b"


@register("agg_info_menu", sql(
    "SELECT i.*, (SELECT CAST(sum(bytes) AS BIGINT) FROM (" + _bytes_sql() + ") t) AS total_bytes FROM (" + _INFO_SQL + ") i"))
def q_agg_info_menu(spark, d):
    return P.profile(_raw(spark, d), "info")


@register("agg_column_bytes", sql(_bytes_sql()))
def q_agg_column_bytes(spark, d):
    return P.column_bytes(_raw(spark, d))


@register("agg_distribution_stats", sql("""
SELECT count(v) AS count, avg(v) AS mean, stddev_pop(v) AS std,
       avg(v) - stddev_pop(v) AS band1_low, avg(v) + stddev_pop(v) AS band1_high,
       avg(v) - 2 * stddev_pop(v) AS band2_low, avg(v) + 2 * stddev_pop(v) AS band2_high, min(v) AS min, max(v) AS max
FROM (SELECT temperature_c AS v FROM telemetry) t""",
          round_cols=("mean", "std", "band1_low", "band1_high", "band2_low", "band2_high", "min", "max")))
def q_agg_distribution_stats(spark, d):
    return rounded(P.distribution_stats(_telemetry(spark, d), "temperature_c"))


@register("agg_mode_value", sql("""
SELECT defect_count AS mode, n AS mode_count FROM (
  SELECT defect_count, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, defect_count) AS rk
  FROM telemetry WHERE defect_count IS NOT NULL GROUP BY defect_count) g WHERE rk = 1"""))
def q_agg_mode_value(spark, d):
    return P.mode_value(_telemetry(spark, d), "defect_count")


@register("agg_mode_per_equipment", sql("""
SELECT equipment_id, defect_count AS mode, n AS mode_count FROM (
  SELECT equipment_id, defect_count, count(*) AS n,
         row_number() OVER (PARTITION BY equipment_id ORDER BY count(*) DESC, defect_count) AS rk
  FROM telemetry_raw WHERE defect_count IS NOT NULL GROUP BY equipment_id, defect_count) g WHERE rk = 1"""))
def q_agg_mode_per_equipment(spark, d):
    return P.mode_value(_raw(spark, d), "defect_count", "equipment_id")


@register("agg_frequency_distribution", sql("""
SELECT defect_count, count(*) AS count, count(*) * 100e0 / (SELECT count(*) FROM telemetry) AS percent
FROM telemetry GROUP BY defect_count""", round_cols=("percent",)))
def q_agg_frequency_distribution(spark, d):
    return rounded(P.frequency_distribution(_telemetry(spark, d), "defect_count"))


def _hist_sql(col, bins, lo=None, hi=None):
    v = _v(col)
    if lo is None:
        bounds = f"""SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
FROM (SELECT min({v}) AS mn, max({v}) AS mx FROM telemetry) s"""
    else:
        bounds = f"SELECT {float(lo)}::DOUBLE AS lo, {float(hi)}::DOUBLE AS hi"
    return sql(f"""
SELECT CAST(r.i AS INTEGER) AS bin, b.lo + CAST(r.i AS INTEGER) * ((b.hi - b.lo) / {float(bins)}) AS lower,
       b.lo + (CAST(r.i AS INTEGER) + 1) * ((b.hi - b.lo) / {float(bins)}) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range({bins}) r(i) CROSS JOIN b
LEFT JOIN (SELECT least(floor((v - lo) / ((hi - lo) / {float(bins)})), {bins - 1}) AS bin, count(*) AS n
           FROM (SELECT {v} AS v FROM telemetry) t, b WHERE v >= lo AND v <= hi GROUP BY 1) c ON c.bin = r.i""",
               {"b": bounds}, round_cols=("lower", "upper"))


@register("agg_histogram", _hist_sql("temperature_c", 50))
def q_agg_histogram(spark, d):
    return rounded(P.histogram(_telemetry(spark, d), "temperature_c", 50))


@register("agg_histogram_unit_bins", _hist_sql("defect_count", 11, 0, 11))
def q_agg_histogram_unit_bins(spark, d):
    return rounded(P.histogram(_telemetry(spark, d), "defect_count", 11, 0, 11))


@register("agg_min_max_anomalies", sql(
    "SELECT min(temperature_c) AS min_value, max(temperature_c) AS max_value FROM telemetry WHERE is_anomaly"))
def q_agg_min_max_anomalies(spark, d):
    return P.min_max(FL.filter_anomalies(_telemetry(spark, d)), "temperature_c")


@register("flt_anomalies", sql("SELECT * FROM telemetry WHERE is_anomaly"))
def q_flt_anomalies(spark, d):
    return FL.filter_anomalies(_telemetry(spark, d))


@register("flt_null", sql("SELECT * FROM telemetry_raw WHERE temperature_c IS NULL"))
def q_flt_null(spark, d):
    return FL.filter_null(_raw(spark, d), "temperature_c")


@register("flt_not_in_set", sql(
    "SELECT * FROM telemetry_raw WHERE equipment_id NOT IN ('EQ001', 'EQ002', 'EQ003', 'EQ004')"))
def q_flt_not_in_set(spark, d):
    return FL.filter_not_in_set(_raw(spark, d), "equipment_id", C.VALID_EQUIPMENT)


@register("flt_out_of_range", sql("SELECT * FROM telemetry_raw WHERE temperature_c < 330 OR temperature_c > 380"))
def q_flt_out_of_range(spark, d):
    return FL.filter_out_of_range(_raw(spark, d), "temperature_c", C.TEMP_MIN, C.TEMP_MAX)


@register("prj_numeric_projection", sql("SELECT temperature_c, pressure_torr, yield_rate, defect_count FROM telemetry_raw"))
def q_prj_numeric_projection(spark, d):
    return FL.numeric_projection(_raw(spark, d))


@register("prj_round_values", sql(
    "SELECT round(temperature_c, 3) AS temperature_c, round(pressure_torr, 3) AS pressure_torr, "
    "round(yield_rate, 3) AS yield_rate, defect_count FROM telemetry"))
def q_prj_round_values(spark, d):
    return FL.round_values(FL.column_subset(_telemetry(spark, d)), 3)


@register("prj_scalar_functions", sql("""
SELECT wafer_id,
       CAST(substr(wafer_id, 2) AS BIGINT) AS wafer_ordinal,
       printf('W%08d', CAST(substr(wafer_id, 2) AS BIGINT) * 1000) AS wide_wafer_id,
       concat('EQ00', CAST(CAST(substr(wafer_id, 2) AS BIGINT) % 4 + 1 AS VARCHAR)) AS pattern_equipment,
       350e0 + CAST(substr(wafer_id, 2) AS BIGINT) % 10 AS pattern_temperature,
       strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS iso_time,
       strftime(timestamp, '%Y%m%d') AS archive_day,
       CAST(timestamp AS DATE) AS event_date,
       CAST(hour(timestamp) AS INTEGER) AS event_hour,
       0.80e0 + 0.19e0 * yield_rate AS rescaled_yield,
       coalesce(CAST(defect_count AS DOUBLE) / nullif(CAST(CAST(substr(wafer_id, 2) AS BIGINT) % 7 AS DOUBLE), 0) * 100e0, 0e0) AS defect_pct,
       timestamp - to_seconds(CAST(substr(wafer_id, 2) AS BIGINT)) AS shifted_time,
       (temperature_c BETWEEN 340 AND 360) OR is_anomaly AS in_band_or_flagged
FROM telemetry""", round_cols=("rescaled_yield", "defect_pct")))
def q_prj_scalar_functions(spark, d):
    t = _telemetry(spark, d)
    n = S.wafer_ordinal("wafer_id")
    return rounded(t.select(
        "wafer_id",
        n.alias("wafer_ordinal"),
        S.format_wafer_id(n * 1000).alias("wide_wafer_id"),
        F.concat(F.lit("EQ00"), (n % 4 + 1).cast("string")).alias("pattern_equipment"),
        (F.lit(350.0) + n % 10).alias("pattern_temperature"),
        S.iso_format("timestamp").alias("iso_time"),
        S.archive_day("timestamp").alias("archive_day"),
        F.to_date("timestamp").alias("event_date"),
        F.hour("timestamp").alias("event_hour"),
        S.affine("yield_rate", C.YIELD_OFFSET, C.YIELD_SCALE).alias("rescaled_yield"),
        S.safe_percentage("defect_count", n % 7).alias("defect_pct"),
        (F.col("timestamp") - F.make_dt_interval(secs=n)).alias("shifted_time"),
        (F.col("temperature_c").between(340, 360) | F.col("is_anomaly")).alias("in_band_or_flagged"),
    ))


@register("srt_head_rows", sql("SELECT * FROM telemetry_raw ORDER BY timestamp, wafer_id LIMIT 5"))
def q_srt_head_rows(spark, d):
    return SR.head_rows(_raw(spark, d), 5)


@register("srt_tail_rows", sql(
    "SELECT * FROM (SELECT * FROM telemetry_raw ORDER BY timestamp DESC, wafer_id DESC LIMIT 5) t ORDER BY timestamp, wafer_id"))
def q_srt_tail_rows(spark, d):
    return SR.tail_rows(_raw(spark, d), 5)


@register("srt_head_rows_per_group", sql("""
SELECT timestamp, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate, defect_count, is_anomaly FROM (
  SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY timestamp, wafer_id) AS rn FROM telemetry_raw) t
WHERE rn <= 5"""))
def q_srt_head_rows_per_group(spark, d):
    return SR.head_rows(_raw(spark, d), 5, group="equipment_id")


@register("srt_tail_rows_per_group", sql("""
SELECT timestamp, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate, defect_count, is_anomaly FROM (
  SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY timestamp DESC, wafer_id DESC) AS rn FROM telemetry_raw) t
WHERE rn <= 5"""))
def q_srt_tail_rows_per_group(spark, d):
    return SR.tail_rows(_raw(spark, d), 5, group="equipment_id")


@register("srt_sample_rows", sql(
    "SELECT * FROM telemetry ORDER BY md5(concat('42:', wafer_id)), wafer_id LIMIT 5"))
def q_srt_sample_rows(spark, d):
    return SR.sample_rows(_telemetry(spark, d), 5)


@register("srt_exact_sample", sql("""
SELECT timestamp, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate, defect_count, is_anomaly FROM (
  SELECT *, row_number() OVER (ORDER BY md5(concat('42:', wafer_id)), wafer_id) AS rn FROM telemetry) t
WHERE rn <= floor((SELECT count(*) FROM telemetry) * 0.01e0)"""))
def q_srt_exact_sample(spark, d):
    return SR.exact_sample(_telemetry(spark, d), 0.01)


@register("srt_sort_by_size", sql(_bytes_sql()))
def q_srt_sort_by_size(spark, d):
    return SR.sort_by_size(P.column_bytes(_raw(spark, d)), "bytes")


@register("set_append_batches", sql(_UNION_SQL))
def q_set_append_batches(spark, d):
    return SR.append_batches([_telemetry(spark, d), _raw(spark, d)])


# ---------------------------------------------------------------------------
# M3/M4: process control (SPC), windows (WIN), joins (JN), medallion (MED).
# ---------------------------------------------------------------------------
from fabflow.operators import dedup as DD  # noqa: E402
from fabflow.operators import merge as MG  # noqa: E402
from fabflow.operators import spc as SPC  # noqa: E402
from fabflow.operators import windows as W  # noqa: E402

_LIMITS_SQL = """SELECT avg(temperature_c) AS mean, stddev_pop(temperature_c) AS std,
       avg(temperature_c) + 3e0 * stddev_pop(temperature_c) AS ucl,
       avg(temperature_c) - 3e0 * stddev_pop(temperature_c) AS lcl FROM telemetry"""
_LIMITS_EQ_SQL = """SELECT equipment_id, avg(temperature_c) AS mean, stddev_pop(temperature_c) AS std,
       avg(temperature_c) + 3e0 * stddev_pop(temperature_c) AS ucl,
       avg(temperature_c) - 3e0 * stddev_pop(temperature_c) AS lcl FROM telemetry GROUP BY equipment_id"""


@register("spc_control_limits", sql(_LIMITS_SQL, round_cols=("mean", "std", "ucl", "lcl")))
def q_spc_control_limits(spark, d):
    return rounded(SPC.control_limits(_telemetry(spark, d), "temperature_c"))


@register("spc_control_limits_per_equipment", sql(_LIMITS_EQ_SQL, round_cols=("mean", "std", "ucl", "lcl")))
def q_spc_control_limits_per_equipment(spark, d):
    return rounded(SPC.control_limits(_telemetry(spark, d), "temperature_c", "equipment_id"))


@register("spc_detect_3sigma", sql("""
SELECT t.*, l.ucl, l.lcl, TRUE AS beyond_limits FROM telemetry t, lim l
WHERE t.temperature_c > l.ucl OR t.temperature_c < l.lcl""", {"lim": _LIMITS_SQL}, round_cols=_READINGS + ("ucl", "lcl")))
def q_spc_detect_3sigma(spark, d):
    t = _telemetry(spark, d)
    return rounded(SPC.detect_3sigma(t, t, "temperature_c"))


@register("spc_detection_summary", sql("""
SELECT count(*) AS total, count(*) FILTER (WHERE b) AS detected,
       coalesce(CAST(count(*) FILTER (WHERE b) AS DOUBLE) / count(*) * 100e0, 0e0) AS rate_pct,
       min(CASE WHEN b THEN temperature_c END) AS detected_min, max(CASE WHEN b THEN temperature_c END) AS detected_max
FROM (SELECT t.temperature_c, coalesce(t.temperature_c > l.ucl OR t.temperature_c < l.lcl, FALSE) AS b
      FROM telemetry_raw t, lim l) x""", {"lim": _LIMITS_SQL}, round_cols=("rate_pct", "detected_min", "detected_max")))
def q_spc_detection_summary(spark, d):
    return rounded(SPC.detection_summary(_raw(spark, d), _telemetry(spark, d), "temperature_c"))


@register("spc_detection_per_equipment", sql("""
SELECT equipment_id, count(*) AS total, count(*) FILTER (WHERE b) AS detected,
       coalesce(CAST(count(*) FILTER (WHERE b) AS DOUBLE) / count(*) * 100e0, 0e0) AS rate_pct,
       min(CASE WHEN b THEN temperature_c END) AS detected_min, max(CASE WHEN b THEN temperature_c END) AS detected_max
FROM (SELECT t.equipment_id, t.temperature_c,
             coalesce(t.temperature_c > l.ucl OR t.temperature_c < l.lcl, FALSE) AS b
      FROM telemetry_raw t LEFT JOIN lim l ON t.equipment_id = l.equipment_id) x
GROUP BY equipment_id""", {"lim": _LIMITS_EQ_SQL}, round_cols=("rate_pct", "detected_min", "detected_max")))
def q_spc_detection_per_equipment(spark, d):
    return rounded(SPC.detection_summary(_raw(spark, d), _telemetry(spark, d), "temperature_c", "equipment_id"))


_FIRST200 = "(SELECT *, row_number() OVER (ORDER BY timestamp, wafer_id) AS point FROM telemetry ORDER BY timestamp, wafer_id LIMIT 200)"


@register("spc_fixed_control_chart", sql(f"""
SELECT CAST(point AS INTEGER) AS point, wafer_id, temperature_c AS value, 350e0 AS target, 345e0 AS band_low,
       355e0 AS band_high, 335e0 AS lcl, 365e0 AS ucl,
       CASE WHEN temperature_c IS NULL THEN 'missing' WHEN temperature_c > 365 THEN 'above_ucl'
            WHEN temperature_c < 335 THEN 'below_lcl'
            WHEN temperature_c > 355 OR temperature_c < 345 THEN 'outside_1sigma' ELSE 'within_1sigma' END AS zone
FROM {_FIRST200} s"""))
def q_spc_fixed_control_chart(spark, d):
    return SPC.fixed_control_chart(_telemetry(spark, d))


@register("spc_target_line_series", sql(f"""
SELECT CAST(point AS INTEGER) AS point, wafer_id, yield_rate, yield_rate - 0.92e0 AS yield_vs_target,
       defect_count, defect_count - 2e0 AS defects_vs_expected
FROM {_FIRST200} s""", round_cols=("yield_rate", "yield_vs_target")))
def q_spc_target_line_series(spark, d):
    return rounded(SPC.target_line_series(_telemetry(spark, d)))


@register("spc_expected_vs_actual", sql("""
SELECT "column", statistic, observed, expected, observed - expected AS difference FROM (
  SELECT 'temperature_c' AS "column", 'mean' AS statistic, avg(temperature_c) AS observed, 350e0 AS expected FROM telemetry
  UNION ALL SELECT 'temperature_c', 'std', stddev_pop(temperature_c), 5e0 FROM telemetry
  UNION ALL SELECT 'yield_rate', 'mean', avg(yield_rate), 0.92e0 FROM telemetry
  UNION ALL SELECT 'yield_rate', 'std', stddev_pop(yield_rate), NULL FROM telemetry
  UNION ALL SELECT 'defect_count', 'mean', avg(CAST(defect_count AS DOUBLE)), 2e0 FROM telemetry
  UNION ALL SELECT 'defect_count', 'std', stddev_pop(CAST(defect_count AS DOUBLE)), sqrt(2e0) FROM telemetry) x""",
          round_cols=("observed", "expected", "difference")))
def q_spc_expected_vs_actual(spark, d):
    return rounded(SPC.expected_vs_actual(_telemetry(spark, d)))


def _poisson_oracle(max_k: int, lam: str, lost: int) -> str:
    pmf = "exp(-lam + {k} * ln(lam) - lgamma({k} + 1))"
    return sql(f"""
SELECT sum(CASE WHEN e > 0 THEN (o - e) * (o - e) / e ELSE 0e0 END) AS chi_square,
       count(*) - {lost} AS degrees_of_freedom, count(*) AS cells
FROM (SELECT c.k, CAST(coalesce(ob.n, 0) AS DOUBLE) AS o,
             (CASE WHEN c.k = {max_k} AND head < 0.5e0 THEN 1e0 - head
                   WHEN c.k = {max_k} THEN (SELECT sum({pmf.format(k="k2")}) FROM range({max_k}, {max_k + 401}) r2(k2), stats)
                   ELSE {pmf.format(k="c.k")} END) * total AS e
      FROM (SELECT i AS k FROM range({max_k + 1}) r(i)) c CROSS JOIN stats
      CROSS JOIN (SELECT sum({pmf.format(k="k2")}) AS head FROM range({max_k}) r2(k2), stats) hd
      LEFT JOIN (SELECT least(defect_count, {max_k}) AS k, count(*) AS n FROM telemetry
                 WHERE defect_count IS NOT NULL GROUP BY 1) ob ON ob.k = c.k) x""",
               {"stats": f"SELECT {lam} AS lam, count(defect_count) AS total FROM telemetry"}, round_cols=("chi_square",))


_FITTED = "avg(CAST(defect_count AS DOUBLE))"


@register("spc_poisson_chi_square", _poisson_oracle(20, _FITTED, 2))
def q_spc_poisson_chi_square(spark, d):
    return rounded(SPC.poisson_chi_square(_telemetry(spark, d)))


@register("spc_poisson_chi_square_given", _poisson_oracle(12, "4.5e0", 1))
def q_spc_poisson_chi_square_given(spark, d):
    # a given mean is not fitted: one degree of freedom more
    return rounded(SPC.poisson_chi_square(_telemetry(spark, d), lam=4.5, max_k=12))


@register("spc_normal_ks_test")
def q_spc_normal_ks_test(spark, d):
    # Statistic from Spark ML's distributed one-sample test: rows-only check.
    return SPC.normal_ks_test(_telemetry(spark, d), "temperature_c")


_TYPE_SQL = """CASE WHEN temperature_c >= 365 THEN 'temp_spike' WHEN temperature_c <= 335 THEN 'temp_drop'
     WHEN abs(pressure_torr - 10) >= 3 THEN 'pressure_fluctuation'
     WHEN defect_count >= 10 AND yield_rate BETWEEN 0.5 AND 0.7 THEN 'defect_burst' ELSE 'none' END"""


@register("spc_classify_anomaly_type", sql(f"SELECT *, {_TYPE_SQL} AS anomaly_type FROM telemetry"))
def q_spc_classify_anomaly_type(spark, d):
    return SPC.classify_anomaly_type(_telemetry(spark, d))


@register("spc_anomaly_type_counts", sql(
    f"SELECT {_TYPE_SQL} AS anomaly_type, is_anomaly, count(*) AS n FROM telemetry GROUP BY 1, 2"))
def q_spc_anomaly_type_counts(spark, d):
    return (SPC.classify_anomaly_type(_telemetry(spark, d))
            .groupBy("anomaly_type", "is_anomaly").agg(F.count(F.lit(1)).alias("n")))


@register("spc_anomaly_score", sql("""
SELECT t.*, CASE WHEN s.sd > 0 THEN (t.temperature_c - s.mu) / s.sd END AS temperature_c_zscore
FROM telemetry_raw t LEFT JOIN (SELECT equipment_id, avg(temperature_c) AS mu, stddev_samp(temperature_c) AS sd
                                FROM telemetry_raw GROUP BY equipment_id) s
ON t.equipment_id = s.equipment_id""", round_cols=_READINGS + ("temperature_c_zscore",)))
def q_spc_anomaly_score(spark, d):
    return rounded(SPC.anomaly_score(_raw(spark, d), "temperature_c", "equipment_id"))


@register("spc_detector_quality", sql("""
SELECT count(*) FILTER (WHERE p AND t) AS true_positive, count(*) FILTER (WHERE p AND NOT t) AS false_positive,
       count(*) FILTER (WHERE NOT p AND t) AS false_negative, count(*) FILTER (WHERE NOT p AND NOT t) AS true_negative,
       CAST(count(*) FILTER (WHERE p AND t) AS DOUBLE) / nullif(count(*) FILTER (WHERE p), 0) AS precision,
       CAST(count(*) FILTER (WHERE p AND t) AS DOUBLE) / nullif(count(*) FILTER (WHERE t), 0) AS recall
FROM (SELECT coalesce(temperature_c > ucl OR temperature_c < lcl, FALSE) AS p, coalesce(is_anomaly, FALSE) AS t
      FROM telemetry, lim) x""", {"lim": _LIMITS_SQL}, round_cols=("precision", "recall")))
def q_spc_detector_quality(spark, d):
    t = _telemetry(spark, d)
    return rounded(SPC.detector_quality(t, t, "temperature_c"))


_LATEST_SQL = """SELECT timestamp, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate, defect_count, is_anomaly{extra}
FROM (SELECT *, row_number() OVER (PARTITION BY wafer_id ORDER BY timestamp DESC NULLS LAST,
              equipment_id DESC NULLS LAST, temperature_c DESC NULLS LAST, pressure_torr DESC NULLS LAST,
              yield_rate DESC NULLS LAST, defect_count DESC NULLS LAST, is_anomaly DESC NULLS LAST{extra_order}) AS rn
      FROM {src}) d WHERE rn = 1"""


@register("win_dedup_latest", sql(_LATEST_SQL.format(extra="", extra_order="", src="telemetry_raw")))
def q_win_dedup_latest(spark, d):
    return DD.dedup_latest(_raw(spark, d), "wafer_id", "timestamp")


@register("win_rolling_mean", sql("""
SELECT *, avg(temperature_c) OVER (PARTITION BY equipment_id ORDER BY timestamp, wafer_id
                                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS temperature_c_rolling_mean
FROM telemetry_raw""", round_cols=_READINGS + ("temperature_c_rolling_mean",)))
def q_win_rolling_mean(spark, d):
    return rounded(W.rolling_mean(_raw(spark, d), "temperature_c", rows=5, bucket_seconds=3600))


@register("win_defect_trend", sql("""
SELECT equipment_id, date, daily_defects, wafers,
       daily_defects - lag(daily_defects) OVER (PARTITION BY equipment_id ORDER BY date) AS change
FROM (SELECT equipment_id, CAST(timestamp AS DATE) AS date, CAST(sum(defect_count) AS BIGINT) AS daily_defects,
             count(*) AS wafers FROM telemetry_raw GROUP BY 1, 2) g"""))
def q_win_defect_trend(spark, d):
    return W.daily_defect_trend(_raw(spark, d))


@register("win_first_n_series", sql(f"SELECT * REPLACE (CAST(point AS INTEGER) AS point) FROM {_FIRST200} s"))
def q_win_first_n_series(spark, d):
    return SPC.first_n(_telemetry(spark, d), 200)


@register("win_share_of_total", sql("""
SELECT equipment_id, count(*) AS count, count(*) / (SELECT count(*) FROM telemetry_raw) AS share
FROM telemetry_raw GROUP BY equipment_id""", round_cols=("share",)))
def q_win_share_of_total(spark, d):
    return rounded(W.share_of_total(_raw(spark, d), "equipment_id"))


@register("jn_merge_upsert", sql(_LATEST_SQL.format(
    extra=", date", extra_order=", date DESC NULLS LAST",
    src="(SELECT * FROM bronze_clean UNION ALL SELECT * FROM bronze_raw) u")))
def q_jn_merge_upsert(spark, d):
    return MG.merge_latest(bronze_clean(spark, d), bronze_raw(spark, d))


@register("jn_apply_baseline_limits", sql("""
SELECT t.*, l.ucl, l.lcl, coalesce(t.temperature_c > l.ucl OR t.temperature_c < l.lcl, FALSE) AS beyond_limits
FROM telemetry_raw t LEFT JOIN lim l ON t.equipment_id = l.equipment_id""",
          {"lim": _LIMITS_EQ_SQL}, round_cols=_READINGS + ("ucl", "lcl")))
def q_jn_apply_baseline_limits(spark, d):
    return rounded(SPC.apply_limits(_raw(spark, d), _telemetry(spark, d), "temperature_c", "equipment_id")
                   .select(*_RAW, "ucl", "lcl", "beyond_limits"))


@register("jn_duplicate_rows_of_key", sql("""
SELECT * FROM telemetry_raw WHERE wafer_id IN (SELECT wafer_id FROM telemetry_raw GROUP BY wafer_id HAVING count(*) > 1)"""))
def q_jn_duplicate_rows_of_key(spark, d):
    return DD.duplicate_rows_of_key(_raw(spark, d)).select(*_RAW)


@register("med_bronze", sql("SELECT * FROM bronze_raw"))
def q_med_bronze(spark, d):
    return bronze_raw(spark, d)


_SILVER_OUT = [c for c in C.SILVER_COLUMNS if c != "silver_ingestion_time"]


@register("med_silver", sql("SELECT * FROM silver_raw", round_cols=_READINGS + ("temperature_deviation_c", "pressure_deviation_torr")))
def q_med_silver(spark, d):
    return rounded(M.without_ingestion_time(silver_raw(spark, d)))


@register("med_yield_by_shift", sql("""
SELECT date, shift_number, count(*) AS wafers, avg(CAST(yield_rate AS DECIMAL(18,6))) AS avg_yield, CAST(sum(defect_count) AS BIGINT) AS total_defects,
       count(*) FILTER (WHERE quality_flag = 'PASS') AS passed
FROM silver_raw GROUP BY date, shift_number""", round_cols=("avg_yield",)))
def q_med_yield_by_shift(spark, d):
    return rounded(M.yield_by_shift(silver_raw(spark, d)))


@register("med_equipment_kpis", sql("""
SELECT equipment_id, date, count(*) AS wafers, avg(CAST(temperature_c AS DECIMAL(18,6))) AS avg_temperature_c,
       avg(CAST(pressure_torr AS DECIMAL(18,6))) AS avg_pressure_torr, avg(CAST(yield_rate AS DECIMAL(18,6))) AS avg_yield,
       CAST(sum(defect_count) AS BIGINT) AS total_defects, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       avg(quality_score) AS avg_quality_score
FROM silver_raw GROUP BY equipment_id, date""",
          round_cols=("avg_temperature_c", "avg_pressure_torr", "avg_yield", "avg_quality_score")))
def q_med_equipment_kpis(spark, d):
    return rounded(M.equipment_kpis(silver_raw(spark, d)))


@register("med_ml_features", sql("""
SELECT timestamp, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate, defect_count, is_anomaly, date,
       avg(temperature_c) OVER (PARTITION BY equipment_id ORDER BY timestamp, wafer_id
                                ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS temperature_c_rolling_mean,
       avg(yield_rate) OVER (PARTITION BY equipment_id ORDER BY timestamp, wafer_id
                             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS yield_rate_rolling_mean,
       CASE WHEN s.sd > 0 THEN (temperature_c - s.mu) / s.sd END AS temperature_c_zscore
FROM silver_raw t LEFT JOIN (SELECT equipment_id AS eq, avg(temperature_c) AS mu, stddev_samp(temperature_c) AS sd
                             FROM silver_raw GROUP BY equipment_id) s ON t.equipment_id = s.eq""",
          round_cols=_READINGS + ("temperature_c_rolling_mean", "yield_rate_rolling_mean", "temperature_c_zscore")))
def q_med_ml_features(spark, d):
    return rounded(M.ml_features(silver_raw(spark, d)))
from fabflow.plans import catalog_io  # noqa: E402,F401  (registers IO and stream queries)


# ---------------------------------------------------------------------------
# Exact quantiles in bounded memory (multi-level histograms).
# ---------------------------------------------------------------------------
from fabflow.operators import quantiles as QT  # noqa: E402


@register("agg_describe_percentile", sql(_describe_sql("telemetry_raw", _PROC), round_cols=_DESC_ROUND))
def q_agg_describe_percentile(spark, d):
    # the single-pass path: Spark's exact percentile aggregate
    return rounded(P.describe_numeric(_raw(spark, d), exact=True))


@register("agg_exact_quantiles_lineitem", sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", {i} AS q_index, {p}e0 AS prob, quantile_cont(CAST({c} AS DOUBLE), {p}) AS quantile FROM lineitem"
    for c in ("l_extendedprice", "l_quantity", "l_discount") for i, p in enumerate((0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0))),
    round_cols=("quantile",)))
def q_agg_exact_quantiles_lineitem(spark, d):
    # 8 bits a level, so that every target takes several levels
    li = read_table(spark, d, "lineitem")
    return rounded(QT.exact_quantiles(li, ["l_extendedprice", "l_quantity", "l_discount"],
                                      [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0], bits=8)
                   .withColumn("q_index", F.col("q_index").cast("int")))


@register("win_rolling_mean_auto_buckets", sql("""
SELECT *, avg(yield_rate) OVER (PARTITION BY equipment_id ORDER BY timestamp, wafer_id
                                ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS yield_rate_rolling_mean
FROM telemetry_raw""", round_cols=_READINGS + ("yield_rate_rolling_mean",)))
def q_win_rolling_mean_auto_buckets(spark, d):
    # per-chamber bucket widths sized for ~500 rows each, 10-row frame
    return rounded(W.rolling_mean(_raw(spark, d), "yield_rate", rows=10, bucket_seconds="auto",
                                  target_rows_per_bucket=500))


@register("agg_total_bytes", sql(
    "SELECT CAST(sum(bytes) AS BIGINT) AS bytes, round(sum(bytes) / (1024e0 * 1024e0), 2) AS megabytes FROM ("
    + _bytes_sql() + ") t"))
def q_agg_total_bytes(spark, d):
    return P.total_bytes(_raw(spark, d))


def _phi_sql(z: str) -> str:
    a1, a2, a3, a4, a5 = SPC.ERF_A
    x = f"(abs({z}) / sqrt(2e0))"
    t = f"(1e0 / (1e0 + {SPC.ERF_P!r} * {x}))"
    poly = f"(((((({a5!r} * {t} + {a4!r}) * {t} + {a3!r}) * {t} + {a2!r}) * {t} + {a1!r}) * {t}))"
    return f"(0.5e0 * (1e0 + sign({z}) * (1e0 - {poly} * exp(-{x} * {x}))))"


_KS_SERIES = " + ".join(f"{2.0 * (-1) ** (k - 1)!r} * exp({-2.0 * k * k!r} * lam * lam)" for k in range(1, 101))


@register("spc_ks_normal", sql(f"""
SELECT statistic, n, least(greatest({_KS_SERIES}, 0e0), 1e0) AS p_value FROM (
  SELECT statistic, n, sqrt(CAST(n AS DOUBLE)) * statistic AS lam FROM (
    SELECT max(greatest(cum / n - phi, phi - (cum - c) / n)) AS statistic, max(n) AS n FROM (
      SELECT x, c, phi, sum(c) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             (SELECT count(*) FROM telemetry WHERE temperature_c IS NOT NULL) AS n
      FROM (SELECT x, count(*) AS c, {_phi_sql('(x - 350e0) / 5e0')} AS phi
            FROM (SELECT temperature_c AS x FROM telemetry WHERE temperature_c IS NOT NULL) v GROUP BY x) g) r) s) t""",
                               round_cols=("statistic", "p_value")))
def q_spc_ks_normal(spark, d):
    return rounded(SPC.ks_normal(_telemetry(spark, d), "temperature_c"))


@register("win_rolling_mean_burst", sql("""
SELECT *, avg(temperature_c) OVER (PARTITION BY equipment_id ORDER BY timestamp NULLS FIRST, wafer_id
                                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS temperature_c_rolling_mean
FROM (SELECT * REPLACE (CASE WHEN CAST(substr(wafer_id, 2) AS BIGINT) % 10 = 0 THEN NULL
                             WHEN CAST(substr(wafer_id, 2) AS BIGINT) % 10 < 9 THEN date_trunc('day', timestamp) ELSE timestamp END AS timestamp)
      FROM telemetry) t""", round_cols=_READINGS + ("temperature_c_rolling_mean",)))
def q_win_rolling_mean_burst(spark, d):
    # most readings of a day on its first instant, every tenth without a time
    n = F.substring("wafer_id", 2, 1 << 20).cast("bigint") % 10
    t = _telemetry(spark, d).withColumn("timestamp", F.when(n == 0, F.lit(None)).when(n < 9, F.date_trunc("day", "timestamp").cast("timestamp_ntz"))
                                        .otherwise(F.col("timestamp")))
    return rounded(W.rolling_mean(t, "temperature_c", rows=5, target_rows_per_bucket=300))


@register("dq_error_as_failure", sql("""
SELECT 'wafer_id' AS "column", 'mean' AS rule, false AS success, true AS critical, true AS has_error
UNION ALL SELECT 'is_anomaly', 'range', false, true, true
UNION ALL SELECT 'temperature_c', 'mean', avg(temperature_c) BETWEEN 345e0 AND 355e0, false, false FROM telemetry_raw"""))
def q_dq_error_as_failure(spark, d):
    # a mean over ids and a range over a flag cannot be evaluated; the third rule still is
    rules = [Q.Rule("mean", "wafer_id", lo=0.0, hi=1.0), Q.Rule("range", "is_anomaly", lo="a", hi="b"),
             Q.Rule("mean", "temperature_c", lo=345.0, hi=355.0)]
    return Q.validation_report(_raw(spark, d), rules).select("column", "rule", "success", "critical",
                                                             F.col("error").isNotNull().alias("has_error"))


@register("dq_one_sided", sql("""
SELECT 'temperature_c' AS "column", 'mean' AS rule, avg(temperature_c) >= 300e0 AS success FROM telemetry_raw
UNION ALL SELECT 'yield_rate', 'max', max(yield_rate) <= 0.5e0 FROM telemetry_raw
UNION ALL SELECT 'pressure_torr', 'range', count(*) FILTER (WHERE pressure_torr < 9e0) <= 0.01e0 * count(pressure_torr) FROM telemetry_raw
UNION ALL SELECT 'timestamp', 'max', max(timestamp) >= TIMESTAMP '2024-01-01 00:00:00' FROM telemetry_raw"""))
def q_dq_one_sided(spark, d):
    kind = {"mean": "expect_column_mean_to_be_between", "max": "expect_column_max_to_be_between", "range": "expect_column_values_to_be_between"}
    asked = [("mean", "temperature_c", {"min_value": 300}), ("max", "yield_rate", {"max_value": 0.5}),
             ("range", "pressure_torr", {"min_value": 9, "mostly": 0.99}), ("max", "timestamp", {"min_value": "2024-01-01 00:00:00"})]
    rules = Q.rules_from_config([{"expectation_type": kind[k], "kwargs": {"column": c, **kw}} for k, c, kw in asked])
    return Q.validation_report(_raw(spark, d), rules).select("column", "rule", "success")


@register("jn_upsert_moved_and_null_dates", sql("""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY wafer_id ORDER BY timestamp DESC NULLS LAST, temperature_c DESC NULLS LAST) AS rn
FROM (SELECT * REPLACE (CASE WHEN CAST(substr(wafer_id, 2) AS BIGINT) % 7 = 0 THEN NULL ELSE date END AS date) FROM bronze_clean
      UNION ALL
      SELECT timestamp + INTERVAL 3 DAY, wafer_id, equipment_id, temperature_c + 1e0, pressure_torr, yield_rate, defect_count, is_anomaly,
             CASE WHEN CAST(substr(wafer_id, 2) AS BIGINT) % 20 = 0 THEN NULL ELSE CAST(timestamp + INTERVAL 3 DAY AS DATE) END
      FROM bronze_clean WHERE CAST(substr(wafer_id, 2) AS BIGINT) % 10 = 0) u) r WHERE rn = 1""", round_cols=_READINGS))
def q_jn_upsert_moved_and_null_dates(spark, d):
    # every seventh row stored without a date; every tenth redelivered three days later with a changed reading, half of those without a date
    from fabflow.session import staging_path
    path, n = staging_path(spark, "upsert"), F.substring("wafer_id", 2, 1 << 20).cast("bigint")
    base = bronze_clean(spark, d)
    later = (base.filter(n % 10 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3 DAYS"))
             .withColumn("temperature_c", F.col("temperature_c") + F.lit(1.0))
             .withColumn("date", F.when(n % 20 != 0, F.to_date("timestamp"))))
    MG.upsert_partitioned(base.withColumn("date", F.when(n % 7 != 0, F.col("date"))), path)
    MG.upsert_partitioned(later, path)
    MG.upsert_partitioned(later, path)                                   # delivered again: nothing changes
    out = spark.read.schema(base.schema).parquet(path).select(*base.columns)
    return rounded(out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


from fabflow.plans import catalog_more  # noqa: E402,F401  (registers profiles of sparse data, sketches, accounted streams)
