"""Registered queries: sparse columns and null keys, heavy tails, rescued values, footers, sketches, accounted streams."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from fabflow.operators import merge as MG
from fabflow.operators import profile as P
from fabflow.operators import sketches as SKT
from fabflow.operators import sorting as SR
from fabflow.operators import spc as SPC
from fabflow.plans.catalog import _KS_SERIES, ORACLE, _phi_sql, register, rounded, sql
from fabflow.plans.catalog_io import _COUNTERS, _ntz, _stream_dirs
from fabflow.session import staging_path
from fabflow.sinks import files as SK
from fabflow.sources import files as SF
from fabflow.sources import footers as FT
from fabflow.sources.bridge import read_table, telemetry, telemetry_raw
from fabflow.streaming import jobs as J
from fabflow.streaming.progress import ProgressListener


def _n():
    return F.substring("wafer_id", 2, 1 << 20).cast("bigint")


_N = "CAST(substr(wafer_id, 2) AS BIGINT)"

# --- profiles that keep empty columns and null groups ---
_SPARSE = f"""SELECT timestamp, wafer_id, CASE WHEN {_N} % 7 <> 0 THEN equipment_id END AS equipment_id, temperature_c, defect_count,
       CAST(NULL AS DOUBLE) AS humidity FROM telemetry_raw"""


def _sparse(spark, d):
    return telemetry_raw(spark, d).select("timestamp", "wafer_id", F.when(_n() % 7 != 0, F.col("equipment_id")).alias("equipment_id"),
                                          "temperature_c", "defect_count", F.lit(None).cast("double").alias("humidity"))


@register("agg_describe_sparse", sql("\nUNION ALL\n".join(
    f"""SELECT equipment_id, '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
       quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max
FROM (SELECT * REPLACE (CAST(defect_count AS DOUBLE) AS defect_count) FROM sparse) s GROUP BY equipment_id"""
    for c in ("temperature_c", "defect_count", "humidity")), {"sparse": _SPARSE}, ("mean", "std", "min", "p25", "p50", "p75", "max")))
def q_agg_describe_sparse(spark, d):
    # a column without a value and readings without a chamber keep their rows
    return rounded(P.describe_numeric(_sparse(spark, d), group="equipment_id"))


@register("agg_describe_empty", sql("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, CAST(NULL AS DOUBLE) AS p50 FROM sparse WHERE wafer_id IS NULL"""
    for c in ("temperature_c", "defect_count", "humidity")), {"sparse": _SPARSE}))
def q_agg_describe_empty(spark, d):
    return P.describe_numeric(_sparse(spark, d).filter(F.col("wafer_id").isNull())).select("column", "count", "p50")


@register("agg_unique_sparse", sql("\nUNION ALL\n".join(
    f"""SELECT equipment_id, '{c}' AS "column", count(DISTINCT {c}) AS unique_count FROM sparse GROUP BY equipment_id"""
    for c in ("timestamp", "wafer_id", "temperature_c", "defect_count", "humidity")), {"sparse": _SPARSE}))
def q_agg_unique_sparse(spark, d):
    return P.unique_counts(_sparse(spark, d), "equipment_id")


@register("agg_duplicates_null_group", sql("""
SELECT g.equipment_id, dr.duplicate_rows, round(dr.duplicate_rows * 100e0 / dr.n, 2) AS duplicate_pct, g.n - g.k AS duplicate_keys
FROM (SELECT equipment_id, count(*) AS n, count(DISTINCT wafer_id) AS k FROM sparse GROUP BY equipment_id) g
JOIN (SELECT equipment_id, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows, sum(c) AS n FROM (
        SELECT equipment_id, count(*) AS c FROM sparse GROUP BY equipment_id, timestamp, wafer_id, temperature_c, defect_count, humidity) x GROUP BY equipment_id) dr
  ON g.equipment_id IS NOT DISTINCT FROM dr.equipment_id""", {"sparse": _SPARSE}))
def q_agg_duplicates_null_group(spark, d):
    return P.profile(_sparse(spark, d), "duplicates", "equipment_id")


# --- running totals ---
@register("spc_ks_heavy_tail", sql(f"""
SELECT statistic, n, least(greatest({_KS_SERIES}, 0e0), 1e0) AS p_value FROM (
  SELECT statistic, n, sqrt(CAST(n AS DOUBLE)) * statistic AS lam FROM (
    SELECT max(greatest(cum / n - phi, phi - (cum - c) / n)) AS statistic, max(n) AS n FROM (
      SELECT x, c, phi, sum(c) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             (SELECT count(*) FROM lineitem) AS n
      FROM (SELECT x, count(*) AS c, {_phi_sql('(x - 1e12) / 1e13')} AS phi
            FROM (SELECT CAST(l_extendedprice AS DOUBLE) * l_extendedprice * l_extendedprice AS x FROM lineitem) v GROUP BY x) g) r) s) t""",
                                   round_cols=("statistic", "p_value")))
def q_spc_ks_heavy_tail(spark, d):
    # the cube of a price: most values in a small part of the range
    x = F.col("l_extendedprice").cast("double")
    return rounded(SPC.ks_normal(read_table(spark, d, "lineitem").select((x * F.col("l_extendedprice") * F.col("l_extendedprice")).alias("x")), "x", 1e12, 1e13))


@register("srt_exact_sample_null_keys", sql(f"""
SELECT timestamp, wafer_id, equipment_id, defect_count FROM (
  SELECT *, row_number() OVER (ORDER BY h, wafer_id NULLS FIRST) AS rn, count(*) OVER () AS n FROM (
    SELECT *, md5('42:' || coalesce(wafer_id, concat_ws('|', CAST(epoch_us(timestamp) AS VARCHAR), equipment_id, CAST(defect_count AS VARCHAR)))) AS h
    FROM (SELECT timestamp, CASE WHEN {_N} % 5 <> 0 THEN wafer_id END AS wafer_id, equipment_id, defect_count FROM telemetry) t) u) v
WHERE rn <= floor(n * 0.1e0)"""))
def q_srt_exact_sample_null_keys(spark, d):
    # every fifth reading has no wafer; such readings are drawn one by one like any others
    t = telemetry(spark, d).select("timestamp", F.when(_n() % 5 != 0, F.col("wafer_id")).alias("wafer_id"), "equipment_id", "defect_count")
    return SR.exact_sample(t, 0.1)


# --- many columns at once ---
@register("agg_correlation_pairs", sql("""
SELECT a AS column_a, b AS column_b, round(r, 3) AS correlation FROM (
  SELECT 'l_quantity' AS a, 'l_discount' AS b, corr(l_quantity, CASE WHEN l_orderkey % 3 <> 0 THEN l_discount END) AS r FROM lineitem
  UNION ALL SELECT 'l_discount', 'l_tax', corr(CASE WHEN l_orderkey % 3 <> 0 THEN l_discount END, l_tax) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_extendedprice', corr(l_quantity, l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', 'nothing', NULL)"""))
def q_agg_correlation_pairs(spark, d):
    # a third of the discounts missing, a column without a value and a constant one beside them
    li = read_table(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey"]
    df = li.select(*[F.when(F.col("l_orderkey") % 3 != 0, F.col(c)).cast("double").alias(c) if c == "l_discount" else F.col(c).cast("double").alias(c) for c in cols],
                   F.lit(None).cast("double").alias("nothing"), F.lit(0.1).alias("constant"))
    r = P.correlation_matrix(df)
    wanted = [("l_quantity", "l_discount"), ("l_discount", "l_tax"), ("l_quantity", "l_extendedprice"), ("l_discount", "nothing")]
    keep = F.lit(False)
    for a, b in wanted:
        keep = keep | ((F.col("column_a") == a) & (F.col("column_b") == b))
    return r.filter(keep)


# --- rescued values ---
_MESSY = f"""SELECT timestamp, wafer_id, equipment_id, CASE WHEN {_N} % 31 = 0 THEN 'n/a' END AS bad_t, CASE WHEN {_N} % 37 = 0 THEN 'many' END AS bad_d,
       temperature_c, defect_count FROM telemetry_raw"""


def _messy(spark, d):
    t = telemetry_raw(spark, d)
    return t.select("timestamp", "wafer_id", "equipment_id",
                    F.when(_n() % 31 == 0, "n/a").otherwise(F.col("temperature_c").cast("string")).alias("temperature_c"),
                    F.col("pressure_torr").cast("string").alias("pressure_torr"), F.col("yield_rate").cast("string").alias("yield_rate"),
                    F.when(_n() % 37 == 0, "many").otherwise(F.col("defect_count").cast("string")).alias("defect_count"),
                    F.col("is_anomaly").cast("string").alias("is_anomaly"), F.lit("x").alias("extra"))


@register("snk_rescued_rows", sql("""
SELECT timestamp, wafer_id, equipment_id, CASE WHEN bad_t IS NULL THEN temperature_c END AS temperature_c, CASE WHEN bad_d IS NULL THEN defect_count END AS defect_count,
       '{' || concat_ws(',', CASE WHEN bad_t IS NOT NULL THEN '"temperature_c":"n/a"' END, CASE WHEN bad_d IS NOT NULL THEN '"defect_count":"many"' END) || '}' AS rescued
FROM messy WHERE bad_t IS NOT NULL OR bad_d IS NOT NULL""", {"messy": _MESSY}, ("temperature_c",)))
def q_snk_rescued_rows(spark, d):
    _, bad = SF.split_rescued(_messy(spark, d))
    return _ntz(rounded(bad.select("timestamp", "wafer_id", "equipment_id", "temperature_c", "defect_count", F.col(SF.RESCUED).alias("rescued"))))


@register("snk_typed_rows", sql("SELECT timestamp, wafer_id, equipment_id, temperature_c, defect_count FROM messy WHERE bad_t IS NULL AND bad_d IS NULL",
                                {"messy": _MESSY}, ("temperature_c",)))
def q_snk_typed_rows(spark, d):
    good, _ = SF.split_rescued(_messy(spark, d))
    return _ntz(rounded(good.select("timestamp", "wafer_id", "equipment_id", "temperature_c", "defect_count")))


@register("set_missing_columns", sql("""
SELECT * FROM (VALUES ('wafer_id', true, 'string'), ('defect_count', true, 'bigint'), ('date', false, NULL), ('quality_score', false, NULL)) v("column", present, dtype)
WHERE (SELECT count(*) FROM telemetry_raw) > 0"""))
def q_set_missing_columns(spark, d):
    return SR.missing_columns_table(telemetry_raw(spark, d), ["wafer_id", "defect_count", "date", "quality_score"])


# --- upserts ---
@register("jn_upsert_other_schema", sql(f"""
SELECT wafer_id, timestamp, date, CASE WHEN {_N} % 10 <> 0 THEN {_N} END AS lot
FROM (SELECT wafer_id, timestamp, date FROM bronze_clean WHERE {_N} % 10 <> 0
      UNION ALL SELECT wafer_id, timestamp + INTERVAL 1 DAY, CAST(timestamp + INTERVAL 1 DAY AS DATE) FROM bronze_clean WHERE {_N} % 10 = 0) t"""))
def q_jn_upsert_other_schema(spark, d):
    # the stored rows have a column the increment lacks: untouched rows keep it
    path, base = staging_path(spark, "upsert"), SK.bronze_frame(telemetry(spark, d))
    MG.upsert_partitioned(base.withColumn("lot", _n()), path)
    later = base.filter(_n() % 10 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    MG.upsert_partitioned(later.withColumn("date", F.to_date("timestamp")), path)
    return _ntz(spark.read.parquet(path).select("wafer_id", "timestamp", "date", "lot"))


@register("jn_upsert_key_table", ORACLE["jn_upsert_moved_and_null_dates"])
def q_jn_upsert_key_table(spark, d):
    # the same upserts, with the moved keys found in a bucketed key table
    path = staging_path(spark, "upsert")
    name = "keys_" + path.rsplit("-", 1)[-1]
    base = SK.bronze_frame(telemetry(spark, d))
    later = (base.filter(_n() % 10 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3 DAYS"))
             .withColumn("temperature_c", F.col("temperature_c") + F.lit(1.0))
             .withColumn("date", F.when(_n() % 20 != 0, F.to_date("timestamp"))))
    MG.upsert_partitioned(base.withColumn("date", F.when(_n() % 7 != 0, F.col("date"))), path, key_table=name)
    MG.upsert_partitioned(later, path, key_table=name)
    MG.upsert_partitioned(later, path, key_table=name)
    out = spark.read.schema(base.schema).parquet(path).select(*base.columns)
    return rounded(_ntz(out))


# --- footers ---
@register("agg_footer_row_count", "SELECT count(*) AS row_count FROM lineitem")
def q_agg_footer_row_count(spark, d):
    return FT.footer_row_count(spark, f"{d.rstrip('/')}/lineitem.parquet")


@register("agg_footer_ranges", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(*) AS row_count, count({c}) AS value_count, count(*) - count({c}) AS null_count,
       CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem""" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")))
def q_agg_footer_ranges(spark, d):
    return FT.footer_ranges(spark, f"{d.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


# --- sketches and heavy hitters ---
@register("agg_distinct_sketches", sql("""
SELECT 'wafer_id' AS "column", count(*) AS rows, count(DISTINCT wafer_id) AS exact, true AS within_bound FROM bronze_raw
UNION ALL SELECT 'defect_count', count(*), count(DISTINCT defect_count), true FROM bronze_raw
UNION ALL SELECT 'temperature_c', count(*), count(DISTINCT temperature_c), true FROM bronze_raw"""))
def q_agg_distinct_sketches(spark, d):
    # one stored sketch per column and day; the last day comes later and is added without reading the others
    t, cols = SK.bronze_frame(telemetry_raw(spark, d)), ["wafer_id", "defect_count", "temperature_c"]
    path = staging_path(spark, "sketches")
    last = t.agg(F.max("date")).scalar()
    SKT.store_sketches(SKT.distinct_sketches(t.filter(F.col("date") < last), cols), path)
    SKT.store_sketches(SKT.distinct_sketches(t.filter(F.col("date") == last), cols), path)
    exact = P.unique_counts(t, columns=cols).withColumnRenamed("unique_count", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * SKT.relative_error() * F.col("exact"))
    return SKT.distinct_over(spark, path).join(exact, "column").select("column", "rows", "exact", near.alias("within_bound"))


@register("agg_heavy_hitters", sql("""
SELECT defect_count AS value, count(*) AS count FROM telemetry_raw WHERE defect_count IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""))
def q_agg_heavy_hitters(spark, d):
    return SKT.heavy_hitters(telemetry_raw(spark, d), "defect_count", 3).drop("decided_by")


@register("agg_heavy_hitters_undecided", sql("SELECT min(wafer_id) AS value, 2::BIGINT AS count FROM telemetry_raw WHERE CAST(substr(wafer_id, 2) AS BIGINT) % 10 = 0"))
def q_agg_heavy_hitters_undecided(spark, d):
    # no wafer stands out, so the summary cannot decide and the full count does
    return SKT.heavy_hitters(telemetry_raw(spark, d), "wafer_id", 1, tracked=1000).drop("decided_by")


# --- accounted streams ---
@register("str_dedup_keyless", sql(f"""
SELECT wafer_id, count(*) AS rows FROM (SELECT DISTINCT wafer_id FROM telemetry_raw WHERE {_N} % 9 <> 0
                                        UNION ALL SELECT NULL FROM telemetry_raw WHERE {_N} % 9 = 0) t GROUP BY wafer_id"""))
def q_str_dedup_keyless(spark, d):
    # every ninth wafer's rows come without an id: all of them pass
    path, out, ck = (staging_path(spark, n) for n in ("src", "out", "ck"))
    SK.write_json_lines(telemetry_raw(spark, d).withColumn("wafer_id", F.when(_n() % 9 != 0, F.col("wafer_id"))), path)
    J.start_dedup(spark, path, out, ck, delay="400 days").awaitTermination()
    return spark.read.parquet(out).groupBy("wafer_id").agg(F.count(F.lit(1)).alias("rows"))


def _in_turn(spark, parts, path):
    """Each frame as one file of a folder of its own, oldest first, and the glob a stream reads them by."""
    for i, part in enumerate(parts):
        SK.to_wire(part).coalesce(1).write.mode("overwrite").json(f"{path}/b{i:03d}")
        time.sleep(0.05)                                            # file streams go by modification time
    return f"{path}/b*"


_PARTS = f"""SELECT *, early AND n % 11 = 0 AS held FROM (
  SELECT *, {_N} AS n, epoch_us(timestamp) <= (SELECT quantile_cont(epoch_us(timestamp), 0.5) FROM telemetry) AS early FROM telemetry) e"""


def _late_parts(spark, d):
    """The first half of the readings, the second half, and then every eleventh wafer of the first half."""
    t = telemetry(spark, d)
    half = t.agg(F.percentile(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.5)).first()[0]
    early, held = F.unix_micros(F.col("timestamp").cast("timestamp")) <= half, _n() % 11 == 0
    return [t.filter(early & ~held), t.filter(~early), t.filter(early & held)]


@register("str_late_rows", sql("""
SELECT wafer_id, held AND timestamp <= (SELECT max(timestamp) FROM parts WHERE early AND NOT held) - INTERVAL 1 HOUR AS late FROM parts""", {"parts": _PARTS}))
def q_str_late_rows(spark, d):
    # held-back readings arrive two batches late: those behind the watermark come out with their lateness, the rest pass
    src, out, ck = (staging_path(spark, n) for n in ("src", "out", "ck"))
    glob = _in_turn(spark, _late_parts(spark, d), src)
    J.start_dedup(spark, glob, out, ck, delay="1 hour", max_files_per_trigger=1).awaitTermination()
    passed = spark.read.parquet(out).select("wafer_id", F.lit(False).alias("late"))
    late = spark.read.parquet(J.default_late(out)).filter(F.col("lateness_seconds") >= 0)
    return passed.unionByName(late.select("wafer_id", F.lit(True).alias("late")))


@register("str_listener_counters", sql(f"SELECT {_COUNTERS}, 0::BIGINT AS failed FROM telemetry_raw"))
def q_str_listener_counters(spark, d):
    # the counters of all batches, as posted with their progress
    src, out, ck = _stream_dirs(spark, d)
    seen = ProgressListener()
    spark.streams.addListener(seen)
    try:
        q = J.start_archive(spark, src, out, ck, max_files_per_trigger=4)
        q.awaitTermination()
        seen.wait(q)
    finally:
        spark.streams.removeListener(seen)
    rows = seen.batches(spark).filter(F.col("query") == str(q.id))
    return rows.agg(*[F.sum(c).alias(n) for c, n in (("sent", "rows"), ("anomalies", "anomalies"), ("unknown_equipment", "unknown_equipment"), ("failed", "failed"))])
