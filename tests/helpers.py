from datetime import datetime

from pyspark.sql import functions as F

from fabflow import constants as C


def frame(spark, rows, with_date=True):
    """Literal telemetry frame: rows are dicts over the raw columns (missing keys -> defaults)."""
    base = {"timestamp": datetime(2024, 1, 10, 12, 0, 0), "wafer_id": "W00000001", "equipment_id": "EQ001",
            "temperature_c": 350.0, "pressure_torr": 10.0, "yield_rate": 0.95, "defect_count": 2,
            "is_anomaly": False}
    data = [tuple({**base, **r}[c] for c in C.RAW_COLUMNS) for r in rows]
    df = spark.createDataFrame(data, C.RAW_SCHEMA)
    return df.withColumn("date", F.to_date("timestamp")) if with_date else df


def report_dict(report):
    return {r["validation"]: r.asDict() for r in report.collect()}
