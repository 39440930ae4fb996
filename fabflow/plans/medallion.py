"""Bronze -> silver -> gold as lazy DataFrame transforms.

Silver definitions (the specification gives only the column names and
domains; these rules are ours and are parameters):

* ``date`` = event date, ``hour_of_day`` = event hour, ``shift_number`` = hour // 8 + 1
* ``equipment_age_days`` = days since the install date (default 2024-01-01)
* deviations = reading minus target (350 C, 10 Torr), signed
* ``quality_flag`` = PASS iff all four readings are present and inside the critical ranges
* ``quality_score`` = 100 - 25 x readings missing or outside the normal range
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.operators.dedup import dedup_latest


def bronze(df: DataFrame) -> DataFrame:
    """Raw telemetry + event ``date`` (the archive partition column)."""
    return df.select(*C.RAW_COLUMNS, F.to_date("timestamp").alias("date"))


def _inside(c: str, lo, hi) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & F.col(c).between(F.lit(lo), F.lit(hi))


def quality_flag() -> Column:
    ok = (_inside("temperature_c", C.TEMP_MIN, C.TEMP_MAX)
          & _inside("pressure_torr", C.PRESSURE_MIN, C.PRESSURE_MAX)
          & _inside("yield_rate", C.YIELD_MIN, C.YIELD_MAX)
          & _inside("defect_count", C.DEFECT_MIN, C.DEFECT_MAX))
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def quality_score() -> Column:
    misses = [
        F.when(_inside("temperature_c", *C.TEMP_NORMAL), 0).otherwise(1),
        F.when(_inside("pressure_torr", *C.PRESSURE_NORMAL), 0).otherwise(1),
        F.when(_inside("yield_rate", *C.YIELD_NORMAL), 0).otherwise(1),
        F.when(_inside("defect_count", *C.DEFECT_NORMAL), 0).otherwise(1),
    ]
    return (F.lit(100) - F.lit(25) * (misses[0] + misses[1] + misses[2] + misses[3])).cast("int")


def silver_derive(df: DataFrame, install_date: str = C.DEFAULT_INSTALL_DATE,
                  ingestion_time: Column | None = None) -> DataFrame:
    """Add the 8 silver columns (17 columns, fixed order). ``df`` must be bronze."""
    hour = F.hour("timestamp").cast("int")
    ing = ingestion_time if ingestion_time is not None else F.current_timestamp()
    out = df.withColumns({
        "shift_number": (F.floor(hour / 8) + 1).cast("int"),
        "hour_of_day": hour,
        "equipment_age_days": F.datediff(F.col("date"), F.to_date(F.lit(install_date))).cast("int"),
        "temperature_deviation_c": F.col("temperature_c") - F.lit(C.TEMP_TARGET),
        "pressure_deviation_torr": F.col("pressure_torr") - F.lit(C.PRESSURE_TARGET),
        "quality_flag": quality_flag(),
        "silver_ingestion_time": ing.cast("timestamp"),
        "quality_score": quality_score(),
    })
    return out.select(*C.SILVER_COLUMNS)


def silver(df: DataFrame, install_date: str = C.DEFAULT_INSTALL_DATE,
           ingestion_time: Column | None = None) -> DataFrame:
    """Bronze (or raw) -> latest row per wafer -> derived columns."""
    b = df if "date" in df.columns else bronze(df)
    return silver_derive(dedup_latest(b, "wafer_id", "timestamp"), install_date, ingestion_time)


def without_ingestion_time(df: DataFrame) -> DataFrame:
    return df.drop("silver_ingestion_time")


# ---------------------------------------------------------------------------
# Gold. KPI means are taken over DECIMAL(18,6) readings: the sum is exact, so
# a KPI does not change with partitioning or summation order between reruns.
# ---------------------------------------------------------------------------
def exact_mean(c: str) -> Column:
    return F.avg(F.col(c).cast("decimal(18,6)")).cast("double")


def yield_by_shift(silver_df: DataFrame) -> DataFrame:
    return (silver_df.groupBy("date", "shift_number")
            .agg(F.count(F.lit(1)).alias("wafers"),
                 exact_mean("yield_rate").alias("avg_yield"),
                 F.sum("defect_count").alias("total_defects"),
                 F.count_if(F.col("quality_flag") == "PASS").alias("passed")))


def equipment_kpis(silver_df: DataFrame) -> DataFrame:
    return (silver_df.groupBy("equipment_id", "date")
            .agg(F.count(F.lit(1)).alias("wafers"),
                 exact_mean("temperature_c").alias("avg_temperature_c"),
                 exact_mean("pressure_torr").alias("avg_pressure_torr"),
                 exact_mean("yield_rate").alias("avg_yield"),
                 F.sum("defect_count").alias("total_defects"),
                 F.count_if("is_anomaly").alias("anomalies"),
                 F.avg("quality_score").alias("avg_quality_score")))


def ml_features(silver_df: DataFrame, rows: int = 5, bucket_seconds: int | str = "auto") -> DataFrame:
    """Rolling means of temperature and yield per chamber plus a temperature z-score.

    The readings are written to the shared folder first: statistics, split points and the rows
    themselves then read that table, and the silver plan runs once.
    """
    from fabflow.operators.spc import anomaly_score
    from fabflow.operators.windows import rolling_mean
    from fabflow.session import staging_path
    path = staging_path(silver_df.sparkSession, "ml-readings")
    silver_df.select(*C.BRONZE_COLUMNS).write.mode("overwrite").parquet(path)
    base = silver_df.sparkSession.read.schema(silver_df.select(*C.BRONZE_COLUMNS).schema).parquet(path)
    # z-score statistics come from the readings alone (before the window work)
    scored = anomaly_score(base, "temperature_c", "equipment_id")
    return rolling_mean(scored, ["temperature_c", "yield_rate"], rows=rows, bucket_seconds=bucket_seconds)


def build_silver_table(bronze_df: DataFrame, table_path: str, install_date: str = C.DEFAULT_INSTALL_DATE,
                    rules: str = "native", lookback_days: int | None = None) -> dict:
    """MED-3: latest row per wafer -> derived columns -> quality gate -> upsert into the silver table.

    The gate raises :class:`fabflow.operators.quality.QualityGateError` on a
    critical failure before anything is written. Returns the gate summary and
    the upsert counts.
    """
    from fabflow.operators import quality as Q
    from fabflow.operators.merge import upsert_partitioned
    s = silver(bronze_df, install_date).persist()    # gate and upsert read the increment once
    try:
        gate = Q.assert_valid(Q.validation_report(s, rules, "silver"))
        counts = upsert_partitioned(s, table_path, "wafer_id", "timestamp", "date", lookback_days)
    finally:
        s.unpersist()
    return {**gate, **counts}
