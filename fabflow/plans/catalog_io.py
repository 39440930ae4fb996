"""Registered queries for sources, sinks and streams.

Each query writes data derived from the input tables to a fresh folder under
the shared checkpoint folder, reads or streams it back, and returns the
result, so the oracle compares the round trip with the source rows.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.operators import quality as Q
from fabflow.operators import spc as SPC
from fabflow.operators import windows as W
from fabflow.plans.catalog import register, rounded, sql
from fabflow.session import file_system, path_exists, staging_path
from fabflow.sinks import files as SK
from fabflow.sinks import kafka as KS
from fabflow.sources import files as SF
from fabflow.sources import kafka as KF
from fabflow.sources.bridge import telemetry, telemetry_raw
from fabflow.streaming import alerts as AL
from fabflow.streaming import jobs as J

_RAW = list(C.RAW_COLUMNS)


def _ntz(df: DataFrame, cols=("timestamp",)) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols if c in df.columns})


def _write_daily_json(df: DataFrame, path: str, encoding: str = "iso") -> str:
    """JSON lines with one file per event date; returns the glob the stream reads."""
    (SK.to_wire(df.withColumn("_day", F.to_date("timestamp")), encoding)
     .repartition("_day").write.mode("overwrite").partitionBy("_day").json(path))
    return f"{path}/_day=*"


def _arriving_by_day(spark, source: str) -> str:
    """Gives the files of ``_write_daily_json`` modification times in date order, as a feed has them; its tasks end in any order.

    A stream deals files over its batches by that time. Two cheap calls per date; a store that cannot
    set times keeps those of the write.
    """
    fs, pattern = file_system(spark, f"{source}/*.json")
    files = sorted(f.getPath().toString() for f in fs.globStatus(pattern) or [])
    now = time.time_ns() // 1_000_000
    for i, f in enumerate(files):
        fs.setTimes(file_system(spark, f)[1], now - 1000 * (len(files) - i), -1)
    return source


@register("src_read_parquet_archive", sql("SELECT * FROM bronze_raw"))
def q_src_read_parquet_archive(spark, d):
    path = staging_path(spark, "archive")
    SK.date_partitioned_archive(telemetry_raw(spark, d), path, "overwrite")
    back = SF.read_parquet_files(spark, path)
    return _ntz(back.select(*_RAW, "date"))


@register("snk_archive_partition_pruning", sql("SELECT * FROM bronze_raw WHERE date = DATE '2024-01-15'"))
def q_snk_archive_partition_pruning(spark, d):
    path = staging_path(spark, "archive")
    SK.date_partitioned_archive(telemetry_raw(spark, d), path, "overwrite")
    return _ntz(spark.read.parquet(path).filter(F.col("date") == F.lit("2024-01-15").cast("date"))
                .select(*_RAW, "date"))


@register("win_batch_ordinal")
def q_win_batch_ordinal(spark, d):
    # Per archive file: ordinal, label and row count (file layout decides the rows: rows-only check).
    path = staging_path(spark, "archive")
    SK.date_partitioned_archive(telemetry_raw(spark, d), path, "overwrite")
    return W.batch_ordinal(SF.read_parquet_files(spark, path))


@register("src_read_json_lines_iso", sql("SELECT * FROM telemetry_raw"))
def q_src_read_json_lines_iso(spark, d):
    path = staging_path(spark, "json")
    SK.write_json_lines(telemetry_raw(spark, d), path, encoding="iso")
    return _ntz(SF.read_json_lines(spark, path).select(*_RAW))


@register("src_read_json_lines_millis", sql(
    "SELECT * REPLACE (date_trunc('millisecond', timestamp) AS timestamp) FROM telemetry_raw"))
def q_src_read_json_lines_millis(spark, d):
    path = staging_path(spark, "json")
    SK.write_json_lines(telemetry_raw(spark, d), path, encoding="millis")
    return _ntz(SF.read_json_lines(spark, path).select(*_RAW))


@register("snk_append_json_lines", sql("SELECT * FROM telemetry UNION ALL SELECT * FROM telemetry_raw"))
def q_snk_append_json_lines(spark, d):
    path = staging_path(spark, "json")
    SK.write_json_lines(telemetry(spark, d), path)
    SK.append_json_lines(telemetry_raw(spark, d), path)
    return _ntz(SF.read_json_lines(spark, path).select(*_RAW))


def _corrupted_lines(spark, d, path):
    """Wire lines of telemetry_raw; every 53rd wafer's line is cut short, every 59th has a bad timestamp."""
    t = telemetry_raw(spark, d)
    n = F.substring("wafer_id", 2, 1 << 20).cast("bigint")
    wire = SK.to_wire(t).withColumn("timestamp", F.when(n % 59 == 0, F.lit("not-a-time")).otherwise(F.col("timestamp")))
    line = F.to_json(F.struct(*[F.col(c) for c in _RAW]), {"ignoreNullFields": "false"})
    text = F.when(F.col("_n") % 53 == 0, F.expr("substring(_l, 1, length(_l) - 5)")).otherwise(F.col("_l"))
    wire.select(line.alias("_l"), n.alias("_n")).select(text.alias("value")).write.mode("overwrite").text(path)


@register("src_quarantine_good", sql("""
SELECT * FROM telemetry_raw WHERE CAST(substr(wafer_id, 2) AS BIGINT) % 53 <> 0
  AND CAST(substr(wafer_id, 2) AS BIGINT) % 59 <> 0"""))
def q_src_quarantine_good(spark, d):
    path = staging_path(spark, "lines")
    _corrupted_lines(spark, d, path)
    good, _ = SF.quarantine_malformed(SF.read_json_lines(spark, path))
    return _ntz(good)


@register("src_quarantine_bad", sql("""
SELECT CASE WHEN n % 53 = 0 THEN NULL ELSE wafer_id END AS wafer_id,
       CASE WHEN n % 53 = 0 THEN NULL ELSE 'not-a-time' END AS timestamp_text,
       CASE WHEN n % 53 = 0 THEN 'malformed_json' ELSE 'unparseable_timestamp' END AS reason
FROM (SELECT wafer_id, CAST(substr(wafer_id, 2) AS BIGINT) AS n FROM telemetry_raw) t
WHERE n % 53 = 0 OR n % 59 = 0"""))
def q_src_quarantine_bad(spark, d):
    path = staging_path(spark, "lines")
    _corrupted_lines(spark, d, path)
    _, bad = SF.quarantine_malformed(SF.read_json_lines(spark, path))
    return bad.select("wafer_id", "timestamp_text", "reason")


@register("src_decode_message", sql(
    "SELECT coalesce(equipment_id, 'unknown') AS message_key, * FROM telemetry_raw"))
def q_src_decode_message(spark, d):
    frame = KS.to_kafka_frame(telemetry_raw(spark, d)).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return _ntz(KF.decode_message(frame).select("message_key", *_RAW))


@register("snk_message_keys", sql(
    "SELECT coalesce(equipment_id, 'unknown') AS key, count(*) AS messages FROM telemetry_raw GROUP BY 1"))
def q_snk_message_keys(spark, d):
    return KS.to_kafka_frame(telemetry_raw(spark, d)).groupBy("key").agg(F.count(F.lit(1)).alias("messages"))


@register("snk_enforce_schema", sql("SELECT * FROM telemetry_raw"))
def q_snk_enforce_schema(spark, d):
    # extra column dropped, string-typed readings cast back, column order restored
    t = telemetry_raw(spark, d)
    messy = t.select(F.lit("x").alias("extra"), *[F.col(c).cast("string").alias(c) if c != "timestamp" else F.col(c)
                                                   for c in reversed(_RAW)])
    return _ntz(SF.enforce_schema(messy))


# --- streams -----------------------------------------------------------------
def _stream_dirs(spark, d):
    src = _write_daily_json(telemetry_raw(spark, d), staging_path(spark, "stream-src"))
    return src, staging_path(spark, "stream-out"), staging_path(spark, "stream-ckpt")


@register("str_archive", sql("SELECT * FROM bronze_raw"))
def q_str_archive(spark, d):
    src, out, ck = _stream_dirs(spark, d)
    J.start_archive(spark, src, out, ck, max_files_per_trigger=5).awaitTermination()
    return _ntz(spark.read.parquet(out).select(*_RAW, "date"))


@register("str_json_append", sql("SELECT * FROM telemetry_raw"))
def q_str_json_append(spark, d):
    src, out, ck = _stream_dirs(spark, d)
    J.start_json_append(spark, src, out, ck).awaitTermination()
    return _ntz(SF.read_json_lines(spark, out).select(*_RAW))


@register("str_dedup", sql("SELECT DISTINCT wafer_id FROM telemetry_raw"))
def q_str_dedup(spark, d):
    src, out, ck = _stream_dirs(spark, d)
    J.start_dedup(spark, src, out, ck, delay="1 hour").awaitTermination()
    return spark.read.parquet(out).select("wafer_id")


@register("str_window_profile", sql("""
SELECT equipment_id, date_trunc('hour', timestamp) AS window_start,
       date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS window_end,
       count(*) AS wafers, sum(temperature_c) AS sum_temperature_c, count(temperature_c) AS n_temperature_c,
       avg(CAST(temperature_c AS DECIMAL(18,6))) AS mean_temperature_c, avg(CAST(yield_rate AS DECIMAL(18,6))) AS mean_yield,
       min(temperature_c) AS min_temperature_c, max(temperature_c) AS max_temperature_c,
       CAST(sum(defect_count) AS BIGINT) AS total_defects, count(*) FILTER (WHERE is_anomaly) AS anomalies
FROM telemetry_raw GROUP BY 1, 2, 3
HAVING date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM telemetry_raw) - INTERVAL 10 MINUTE""",
    round_cols=("sum_temperature_c", "mean_temperature_c", "mean_yield", "min_temperature_c", "max_temperature_c")))
def q_str_window_profile(spark, d):
    src, out, ck = _stream_dirs(spark, d)
    J.start_window_profile(spark, src, out, ck, "1 hour", "10 minutes").awaitTermination()
    return rounded(_ntz(spark.read.parquet(out).drop("batch_id"), ("window_start", "window_end")))


_ALERT_LIMITS = """SELECT equipment_id, avg(temperature_c) + 2e0 * stddev_pop(temperature_c) AS ucl,
       avg(temperature_c) - 2e0 * stddev_pop(temperature_c) AS lcl FROM telemetry GROUP BY equipment_id"""


@register("str_alerts", sql("""
SELECT equipment_id, timestamp, wafer_id, temperature_c, CAST(run_length AS BIGINT) AS run_length FROM (
  SELECT *, sum(CASE WHEN beyond THEN 1 ELSE 0 END) OVER (PARTITION BY equipment_id, grp ORDER BY timestamp, wafer_id
                                                         ROWS UNBOUNDED PRECEDING) AS run_length
  FROM (SELECT *, sum(CASE WHEN beyond THEN 0 ELSE 1 END) OVER (PARTITION BY equipment_id ORDER BY timestamp, wafer_id
                                                               ROWS UNBOUNDED PRECEDING) AS grp
        FROM (SELECT t.equipment_id, t.timestamp, t.wafer_id, t.temperature_c,
                     coalesce(t.temperature_c > l.ucl OR t.temperature_c < l.lcl, FALSE) AS beyond
              FROM telemetry_raw t LEFT JOIN lim l ON t.equipment_id = l.equipment_id) f) g) r
WHERE beyond AND run_length >= 2""", {"lim": _ALERT_LIMITS}))
def q_str_alerts(spark, d):
    src, out, ck = _stream_dirs(spark, d)
    limits = SPC.control_limits(telemetry(spark, d), "temperature_c", "equipment_id", k=2.0)
    AL.start_alerts(spark, src, limits, out, ck, min_run=2).awaitTermination()
    return _ntz(spark.read.parquet(out).drop("batch_id"))


def _gate_oracle():
    from fabflow.plans.catalog import _BRONZE_COLS, report_sql, sql as _sql
    from fabflow.plans.expected_rules import NATIVE
    agg, body = report_sql(NATIVE["bronze"], "bronze_raw", _BRONZE_COLS, group="date")
    summary = """SELECT date AS batch_date, count(*) AS total_validations,
       count(*) FILTER (WHERE success) AS passed,
       count(*) FILTER (WHERE NOT success AND critical) AS critical_failures
FROM report GROUP BY date"""
    return _sql(summary, {"a": agg, "report": body})


@register("str_gate_reports", _gate_oracle())
def q_str_gate_reports(spark, d):
    # one micro-batch per event date: each batch's gate summary equals that date's report
    src, out, ck = _stream_dirs(spark, d)
    good, quar, rep = out + "/good", out + "/quarantine", out + "/reports"
    J.start_gate(spark, src, good, quar, rep, ck, max_files_per_trigger=1).awaitTermination()
    r = spark.read.parquet(rep)
    return r.groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("total_validations"), F.count_if("success").alias("passed"),
        F.count_if(~F.col("success") & F.col("critical")).alias("critical_failures"))


# --- synthesis (one synthetic reading per events row, so the work grows with the tables) ---
from fabflow.functions import synth as SY  # noqa: E402
from fabflow.sources.bridge import read_table  # noqa: E402


def _ids(spark, d):
    return read_table(spark, d, "events").select(F.col("event_id").alias("id"))


def _u_sql(row: str, stream: str) -> str:
    return f"((('0x' || substr(md5(concat('42:', CAST({row} AS VARCHAR), ':', {stream})), 1, 8))::UBIGINT + 0.5e0) / 4294967296e0)"


def _poisson_sql(u: str) -> str:
    cdf = SY.poisson_cdf(C.DEFECT_LAMBDA)
    whens = " ".join(f"WHEN {u} < {c!r} THEN {k}" for k, c in enumerate(cdf))
    return f"CAST(CASE {whens} ELSE {len(cdf)} END AS BIGINT)"


def _normal_sql(mean, std, row, s):
    return (f"({float(mean)!r} + {float(std)!r} * (sqrt(-2e0 * ln({_u_sql(row, repr(str(s)))})) * "
            f"cos({2.0 * 3.141592653589793!r} * {_u_sql(row, repr(str(s + 1)))})))")


_SYN_SQL = f"""SELECT TIMESTAMP '2024-02-01 00:00:00' - to_seconds(id) AS timestamp,
       printf('W%08d', id) AS wafer_id,
       ['EQ001', 'EQ002', 'EQ003', 'EQ004'][CAST(floor({_u_sql('id', "'1'")} * 4) AS INTEGER) + 1] AS equipment_id,
       {_normal_sql(350.0, 5.0, 'id', 2)} AS temperature_c,
       {_normal_sql(10.0, 0.5, 'id', 4)} AS pressure_torr,
       0.8e0 + 0.19e0 * (1e0 * pow({_u_sql('id', "'6.1'")}, {1.0 / 21!r}) * pow({_u_sql('id', "'6.2'")}, {1.0 / 20!r})) AS yield_rate,
       {_poisson_sql(_u_sql('id', "'7'"))} AS defect_count,
       FALSE AS is_anomaly
FROM (SELECT event_id AS id FROM events) e"""


@register("syn_uniform", sql(f"SELECT event_id AS id, {_u_sql('event_id', repr('0'))} AS u FROM events"))
def q_syn_uniform(spark, d):
    return _ids(spark, d).select("id", SY.uniform(42, "id", 0).alias("u"))


@register("syn_telemetry", sql(_SYN_SQL, round_cols=("temperature_c", "pressure_torr", "yield_rate")))
def q_syn_telemetry(spark, d):
    return rounded(SY.synth_telemetry(_ids(spark, d), "id"))


@register("syn_moments", sql(f"""
SELECT count(*) AS n, avg(temperature_c) AS temp_mean, stddev_pop(temperature_c) AS temp_std,
       avg(yield_rate) AS yield_mean, avg(CAST(defect_count AS DOUBLE)) AS defect_mean,
       count(DISTINCT equipment_id) AS chambers FROM ({_SYN_SQL}) s""",
                               round_cols=("temp_mean", "temp_std", "yield_mean", "defect_mean"), digits=4))
def q_syn_moments(spark, d):
    s = SY.synth_telemetry(_ids(spark, d), "id")
    return rounded(s.agg(F.count(F.lit(1)).alias("n"), F.avg("temperature_c").alias("temp_mean"),
                         F.stddev_pop("temperature_c").alias("temp_std"), F.avg("yield_rate").alias("yield_mean"),
                         F.avg(F.col("defect_count").cast("double")).alias("defect_mean"),
                         F.count_distinct("equipment_id").alias("chambers")), 4)


@register("syn_inject_anomalies", sql(f"""
SELECT timestamp, s.wafer_id, equipment_id,
       CASE WHEN kind = 'temp_spike' THEN 350e0 + (15e0 + 10e0 * {_u_sql('s.wafer_id', "'mag'")})
            WHEN kind = 'temp_drop' THEN 350e0 - (15e0 + 10e0 * {_u_sql('s.wafer_id', "'mag'")})
            ELSE temperature_c END AS temperature_c,
       CASE WHEN kind = 'pressure_fluctuation'
            THEN 10e0 + [-1e0, 1e0][CAST(floor({_u_sql('s.wafer_id', "'sign'")} * 2) AS INTEGER) + 1]
                        * (3e0 + 2e0 * {_u_sql('s.wafer_id', "'mag'")})
            ELSE pressure_torr END AS pressure_torr,
       CASE WHEN kind = 'defect_burst' THEN 0.5e0 + 0.19999999999999996e0 * {_u_sql('s.wafer_id', "'yield'")}
            ELSE yield_rate END AS yield_rate,
       CASE WHEN kind = 'defect_burst' THEN CAST(10 + floor({_u_sql('s.wafer_id', "'count'")} * 21) AS BIGINT)
            ELSE defect_count END AS defect_count,
       kind IS NOT NULL AS is_anomaly
FROM syn s LEFT JOIN (
  SELECT wafer_id, ['temp_spike', 'temp_drop', 'pressure_fluctuation', 'defect_burst'][
           CAST(floor({_u_sql('wafer_id', "'kind'")} * 4) AS INTEGER) + 1] AS kind
  FROM (SELECT wafer_id, row_number() OVER (ORDER BY md5(concat('42:', wafer_id)), wafer_id) AS rn FROM syn) r
  WHERE rn <= floor((SELECT count(*) FROM syn) * 0.01e0)) a ON s.wafer_id = a.wafer_id""",
                                       {"syn": _SYN_SQL}, round_cols=("temperature_c", "pressure_torr", "yield_rate")))
def q_syn_inject_anomalies(spark, d):
    return rounded(SY.inject_anomalies(SY.synth_telemetry(_ids(spark, d), "id"), 0.01))


@register("syn_golden_pattern", sql("""
SELECT TIMESTAMP '2024-02-01 00:00:00' - to_seconds(event_id) AS timestamp, printf('W%08d', event_id) AS wafer_id,
       concat('EQ00', CAST(event_id % 4 + 1 AS VARCHAR)) AS equipment_id, CAST(350e0 + event_id % 10 AS DOUBLE) AS temperature_c,
       10e0 + 0.1e0 * (event_id % 5) AS pressure_torr, 0.95e0 - 0.01e0 * (event_id % 10) AS yield_rate,
       CAST(event_id % 5 AS BIGINT) AS defect_count, FALSE AS is_anomaly FROM events"""))
def q_syn_golden_pattern(spark, d):
    return SY.golden_pattern(_ids(spark, d), "id")


@register("syn_golden_summary", sql("""
SELECT concat('EQ00', CAST(event_id % 4 + 1 AS VARCHAR)) AS equipment_id, count(*) AS messages,
       avg(350e0 + event_id % 10) AS mean_temperature, avg(10e0 + 0.1e0 * (event_id % 5)) AS mean_pressure,
       CAST(sum(event_id % 5) AS BIGINT) AS defects FROM events GROUP BY 1""",
                                     round_cols=("mean_temperature", "mean_pressure")))
def q_syn_golden_summary(spark, d):
    g = SY.golden_pattern(_ids(spark, d), "id")
    return rounded(g.groupBy("equipment_id").agg(F.count(F.lit(1)).alias("messages"),
                                                 F.avg("temperature_c").alias("mean_temperature"),
                                                 F.avg("pressure_torr").alias("mean_pressure"),
                                                 F.sum("defect_count").alias("defects")))


# --- per-file profiles: the fixture archive has exactly one file per date partition,
# so "per file" equals "per date" on the oracle side. ---
from fabflow.operators import profile as P  # noqa: E402
from fabflow.operators import sorting as SR  # noqa: E402



def _archive_one_file_per_date(spark, d):
    """Fixture: bronze_raw archived with one file per date (test layout only)."""
    path = staging_path(spark, "archive-per-file")
    SK.bronze_frame(telemetry_raw(spark, d)).repartition("date").write.mode("overwrite") \
        .partitionBy("date").parquet(path)
    return SF.read_parquet_files(spark, path)


@register("agg_describe_per_file", sql("\nUNION ALL\n".join(
    f"SELECT date, '{c}' AS \"column\", count(v) AS count, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, "
    f"quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max "
    f"FROM (SELECT date, CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS v FROM bronze_raw) x "
    f"GROUP BY date" for c in C.PROCESS_COLUMNS), round_cols=("mean", "std", "min", "p25", "p50", "p75", "max")))
def q_agg_describe_per_file(spark, d):
    a = _archive_one_file_per_date(spark, d)
    return rounded(P.describe_numeric(a, list(C.PROCESS_COLUMNS), group=["date", "source_file"]).drop("source_file"))


@register("agg_anomaly_summary_per_file", sql("""
SELECT date, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       coalesce(CAST(count(*) FILTER (WHERE is_anomaly) AS DOUBLE) / count(*) * 100e0, 0e0) AS anomaly_rate_pct,
       count(*) - count(*) FILTER (WHERE is_anomaly) AS normal_count
FROM bronze_raw GROUP BY date""", round_cols=("anomaly_rate_pct",)))
def q_agg_anomaly_summary_per_file(spark, d):
    a = _archive_one_file_per_date(spark, d)
    return rounded(P.anomaly_summary(a, ["date", "source_file"]).drop("source_file"))


@register("agg_null_profile_per_file", sql("\nUNION ALL\n".join(
    f"SELECT date, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('temperature_c', 'pressure_torr', 'yield_rate') else ''}) AS null_count, "
    f"round(coalesce(CAST(count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('temperature_c', 'pressure_torr', 'yield_rate') else ''}) AS DOUBLE) / count(*) * 100e0, 0e0), 2) AS null_percentage "
    f"FROM bronze_raw GROUP BY date" for c in C.RAW_COLUMNS)))
def q_agg_null_profile_per_file(spark, d):
    a = _archive_one_file_per_date(spark, d).drop("date").withColumn("date", F.to_date("timestamp"))
    return P.null_profile(a, ["date", "source_file"]).drop("source_file")


@register("agg_shape_per_file", sql(f"""
SELECT date, count(*) AS "rows", CAST(9 AS BIGINT) AS "columns", count(*) * 9 AS elements,
       '{",".join(C.BRONZE_COLUMNS)}' AS column_names FROM bronze_raw GROUP BY date"""))
def q_agg_shape_per_file(spark, d):
    a = _archive_one_file_per_date(spark, d).select(*C.RAW_COLUMNS, "date", "source_file")
    return P.shape(a, ["source_file"]).join(
        a.groupBy("source_file").agg(F.first("date").alias("date")), "source_file").drop("source_file")


@register("srt_head_rows_per_file", sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY timestamp, wafer_id) AS rn FROM bronze_raw) t WHERE rn <= 5"""))
def q_srt_head_rows_per_file(spark, d):
    a = _archive_one_file_per_date(spark, d)
    return _ntz(SR.head_rows(a, 5, group="source_file").select(*C.RAW_COLUMNS, "date"))


_COUNTERS = """count(*) AS rows, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       count(*) FILTER (WHERE equipment_id NOT IN ('EQ001', 'EQ002', 'EQ003', 'EQ004')) AS unknown_equipment"""


@register("str_progress_metrics", sql(f"SELECT {_COUNTERS}, 0::BIGINT AS malformed FROM telemetry_raw"))
def q_str_progress_metrics(spark, d):
    # counters of all batches of an archive stream add up to the table's
    src, out, ck = _stream_dirs(spark, d)
    metrics = staging_path(spark, "metrics")
    J.start_archive(spark, src, out, ck, max_files_per_trigger=10, metrics=metrics).awaitTermination()
    names = ("rows", "anomalies", "unknown_equipment", "malformed")
    return J.progress_counters(spark, metrics).agg(*[F.sum(c).alias(c) for c in names])


@register("str_progress_counters", sql(f"SELECT date AS first_date, {_COUNTERS} FROM bronze_raw GROUP BY date"))
def q_str_progress_counters(spark, d):
    # one batch per file and one file per event date: every batch's counters are that date's
    src, out, ck = _stream_dirs(spark, d)
    metrics = staging_path(spark, "metrics")
    J.start_archive(spark, src, out, ck, max_files_per_trigger=1, metrics=metrics).awaitTermination()
    return J.progress_counters(spark, metrics).select("first_date", "rows", "anomalies", "unknown_equipment")


_SPLIT = """SELECT count(*) FILTER (WHERE n % 53 <> 0 AND n % 59 <> 0) AS good,
       count(*) FILTER (WHERE n % 53 = 0 OR n % 59 = 0) AS quarantined
FROM (SELECT CAST(substr(wafer_id, 2) AS BIGINT) AS n FROM telemetry_raw) t"""


def _split_counts(spark, good_paths, bad_path):
    good = spark.read.parquet(*good_paths).agg(F.count(F.lit(1)).alias("good"))
    return good.withColumn("quarantined", spark.read.parquet(bad_path).agg(F.count(F.lit(1))).scalar())


@register("str_archive_quarantine", sql(_SPLIT))
def q_str_archive_quarantine(spark, d):
    # no folder named: malformed rows still go beside the sink, rows in = good + quarantined
    src, out, ck = (staging_path(spark, n) for n in ("lines", "good", "ck"))
    _corrupted_lines(spark, d, src)
    J.start_archive(spark, src, out, ck, max_files_per_trigger=8).awaitTermination()
    return _split_counts(spark, [out], J.default_quarantine(out))


@register("str_gate_quarantine", sql(_SPLIT))
def q_str_gate_quarantine(spark, d):
    # parsed rows reach one of the gate's two sinks, malformed ones the third
    src, out, ck = (staging_path(spark, n) for n in ("lines", "gate", "ck"))
    _corrupted_lines(spark, d, src)
    J.start_gate(spark, src, out + "/good", out + "/bad", out + "/reports", ck, max_files_per_trigger=8).awaitTermination()
    sinks = [p for p in (out + "/good", out + "/bad") if path_exists(spark, p)]     # a sink no batch reached is not there
    return _split_counts(spark, sinks, out + "/bad-malformed")


# --- medallion pipeline, tables, delivery stats ---
from fabflow.plans import medallion as M  # noqa: E402
from fabflow.plans.catalog import _SILVER_OUT  # noqa: E402


@register("med_silver_table", sql("SELECT * FROM silver_clean",
                                      round_cols=("temperature_c", "pressure_torr", "yield_rate",
                                                  "temperature_deviation_c", "pressure_deviation_torr")))
def q_med_silver_table(spark, d):
    # bronze (clean) -> silver table through the gate, then the redelivered rows upserted on top
    path = staging_path(spark, "silver-table")
    M.build_silver_table(M.bronze(telemetry(spark, d)), path)
    M.build_silver_table(M.bronze(telemetry(spark, d)), path)          # rerun: idempotent
    return rounded(_ntz(spark.read.parquet(path).select(*_SILVER_OUT)))


@register("snk_save_table", sql("SELECT * FROM bronze_raw"))
def q_snk_save_table(spark, d):
    name = "bronze_" + staging_path(spark, "t").rsplit("-", 1)[-1]
    path = staging_path(spark, "table")
    SK.save_table(SK.bronze_frame(telemetry_raw(spark, d)), name, "overwrite", ("date",), path=path)
    return _ntz(SF.read_table(spark, name).select(*_RAW, "date"))


@register("str_delivery_stats", sql("""
SELECT count(*) FILTER (WHERE n % 53 <> 0 AND n % 59 <> 0) AS sent,
       count(*) FILTER (WHERE n % 53 = 0 OR n % 59 = 0) AS failed,
       coalesce(CAST(count(*) FILTER (WHERE n % 53 <> 0 AND n % 59 <> 0) AS DOUBLE) / count(*) * 100e0, 0e0) AS success_rate
FROM (SELECT CAST(substr(wafer_id, 2) AS BIGINT) AS n FROM telemetry_raw) t""", round_cols=("success_rate",)))
def q_str_delivery_stats(spark, d):
    src = staging_path(spark, "lines")
    _corrupted_lines(spark, d, src)
    out, q, ck = staging_path(spark, "good"), staging_path(spark, "quarantine"), staging_path(spark, "ck")
    J.start_archive(spark, src, out, ck, quarantine=q).awaitTermination()
    return rounded(J.delivery_stats_frame(spark.read.parquet(out), spark.read.parquet(q)))


from fabflow.plans.catalog import ORACLE as _ORACLE  # noqa: E402


@register("str_alerts_distributed", _ORACLE["str_alerts"])
def q_str_alerts_distributed(spark, d):
    # same alerts as str_alerts, over many micro-batches
    src, out, ck = _stream_dirs(spark, d)
    _arriving_by_day(spark, src)
    limits = SPC.control_limits(telemetry(spark, d), "temperature_c", "equipment_id", k=2.0)
    AL.start_alerts(spark, src, limits, out, ck, min_run=2, max_files_per_trigger=10).awaitTermination()
    return _ntz(spark.read.parquet(out).drop("batch_id"))


@register("win_batch_ordinal_per_file", sql("""
SELECT CAST(dense_rank() OVER (ORDER BY date) AS INTEGER) AS batch_no, count(*) OVER () AS batch_total,
       n AS row_count
FROM (SELECT date, count(*) AS n FROM bronze_raw GROUP BY date) g"""))
def q_win_batch_ordinal_per_file(spark, d):
    # files of the one-file-per-date archive, numbered by path (= by date)
    a = _archive_one_file_per_date(spark, d)
    return W.batch_ordinal(a).select("batch_no", "batch_total", "row_count")


@register("srt_tail_rows_per_file", sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY timestamp DESC, wafer_id DESC) AS rn FROM bronze_raw) t
WHERE rn <= 5"""))
def q_srt_tail_rows_per_file(spark, d):
    a = _archive_one_file_per_date(spark, d)
    return _ntz(SR.tail_rows(a, 5, group="source_file").select(*C.RAW_COLUMNS, "date"))


@register("win_batch_label", sql("""
SELECT CAST(dense_rank() OVER (ORDER BY source_file) AS INTEGER) AS batch_no, count(*) OVER () AS batch_total, source_file,
       substr(source_file, 31, 6) AS batch_label, n AS row_count
FROM (SELECT concat('/archive/sensor_data_', strftime(timestamp, '%Y%m%d_%H0000'), '.parquet') AS source_file, count(*) AS n
      FROM telemetry GROUP BY 1) g"""))
def q_win_batch_label(spark, d):
    # files named as an archive names them: the label is the time in the name
    t = telemetry(spark, d)
    name = F.concat(F.lit("/archive/sensor_data_"), F.date_format("timestamp", "yyyyMMdd_HH"), F.lit("0000.parquet"))
    return W.batch_ordinal(t.withColumn("source_file", name))


@register("snk_key_partitions", sql("SELECT equipment_id, 1::BIGINT AS partitions, count(*) AS messages FROM telemetry_raw GROUP BY 1"))
def q_snk_key_partitions(spark, d):
    dealt = KS.key_partitioned(telemetry_raw(spark, d), 5).withColumn("_p", F.spark_partition_id())
    return dealt.groupBy("equipment_id").agg(F.count_distinct("_p").alias("partitions"), F.count(F.lit(1)).alias("messages"))


@register("dq_details", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) FILTER (WHERE {c} IS NULL) = 0 AS success FROM bronze_raw"
    for c in ("timestamp", "wafer_id", "equipment_id", "temperature_c", "pressure_torr", "yield_rate"))))
def q_dq_details(spark, d):
    # the driver-side summary's details of the not-null rules, for the columns written out in the oracle
    found = Q.validate_dataframe(SK.bronze_frame(telemetry_raw(spark, d)), "bronze",
                                 [Q.Rule("not_null", c) for c in ("timestamp", "wafer_id", "equipment_id", "temperature_c", "pressure_torr", "yield_rate")])
    return spark.createDataFrame([(r["column"], r["details"]["null_count"], r["success"]) for r in found["results"]],
                                 "column string, null_count bigint, success boolean")
