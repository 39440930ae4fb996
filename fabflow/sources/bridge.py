"""Telemetry views over the driver's ``events`` table.

The test tables carry no telemetry, so every telemetry query reads ``events``
through this deterministic mapping (one projection, no shuffle).
``telemetry_raw`` adds the dirt a real feed has: an unknown chamber, missing
readings and redelivered rows one second later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    e = events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    burst = (F.col("event_type") == "error") & (F.col("value") > F.lit(100.0))
    return e.select(
        F.col("ts").alias("timestamp"),
        F.format_string("W%08d", F.col("event_id")).alias("wafer_id"),
        F.concat(F.lit("EQ00"), (F.col("user_id") % 4 + 1).cast("string")).alias("equipment_id"),
        (F.lit(345.0) + F.col("value") / F.lit(10.0)).alias("temperature_c"),
        (F.lit(10.0) + (F.col("k") - F.lit(49.5)) / F.lit(25.0)).alias("pressure_torr"),
        (F.lit(0.99) - (F.col("k") % 20) / F.lit(200.0)).alias("yield_rate"),
        F.when(burst, F.lit(10) + F.col("k") % 21).otherwise(F.col("k") % 9).cast("bigint").alias("defect_count"),
        burst.alias("is_anomaly"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(read_table(spark, sf_dir, "events"))


def dirty(clean: DataFrame) -> DataFrame:
    n = F.substring("wafer_id", 2, 1 << 20).cast("bigint")
    base = clean.withColumn("_n", n)
    main = base.select(
        "timestamp", "wafer_id",
        F.when(F.col("_n") % 101 == 0, F.lit("EQ999")).otherwise(F.col("equipment_id")).alias("equipment_id"),
        F.when(F.col("_n") % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("temperature_c")).alias("temperature_c"),
        "pressure_torr", "yield_rate", "defect_count", "is_anomaly",
    )
    again = (base.filter(F.col("_n") % 10 == 0)
             .select((F.col("timestamp") + F.expr("INTERVAL 1 SECOND")).alias("timestamp"),
                     "wafer_id", "equipment_id", "temperature_c", "pressure_torr",
                     "yield_rate", "defect_count", "is_anomaly"))
    return main.unionByName(again)


def telemetry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(telemetry(spark, sf_dir))


# SQL text of the same two views (runs unchanged in Spark SQL and DuckDB);
# the query catalogue prefixes oracle queries with it.
TELEMETRY_SQL = """SELECT ts AS timestamp,
       printf('W%08d', event_id) AS wafer_id,
       concat('EQ00', cast(user_id % 4 + 1 AS string)) AS equipment_id,
       345e0 + value / 10e0 AS temperature_c,
       10e0 + (k - 49.5e0) / 25e0 AS pressure_torr,
       0.99e0 - (k % 20) / 200e0 AS yield_rate,
       cast(CASE WHEN event_type = 'error' AND value > 100e0 THEN 10 + k % 21 ELSE k % 9 END AS bigint) AS defect_count,
       (event_type = 'error' AND value > 100e0) AS is_anomaly
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM events) e"""

TELEMETRY_RAW_SQL = """SELECT timestamp, wafer_id,
       CASE WHEN n % 101 = 0 THEN 'EQ999' ELSE equipment_id END AS equipment_id,
       CASE WHEN n % 97 = 0 THEN NULL ELSE temperature_c END AS temperature_c,
       pressure_torr, yield_rate, defect_count, is_anomaly
FROM (SELECT *, cast(substr(wafer_id, 2) AS bigint) AS n FROM telemetry) t
UNION ALL
SELECT timestamp + INTERVAL '1' SECOND, wafer_id, equipment_id, temperature_c, pressure_torr, yield_rate, defect_count, is_anomaly
FROM telemetry WHERE cast(substr(wafer_id, 2) AS bigint) % 10 = 0"""
