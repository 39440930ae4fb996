"""Fixed values the results depend on, plus the telemetry schemas.

Everything below that is a literal threshold, list or format is a fixed value
taken from the process specification this engine implements; keep it in sync
with the specification, not with code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Process thresholds and domains (CVD process specification).
# ---------------------------------------------------------------------------
TEMP_MIN = 330.0
TEMP_MAX = 380.0
TEMP_MEAN_MIN = 345.0
TEMP_MEAN_MAX = 355.0
PRESSURE_MIN = 6.0
PRESSURE_MAX = 14.0
YIELD_MIN = 0.50
YIELD_MAX = 1.00
YIELD_MEAN_MIN = 0.90
YIELD_MEAN_MAX = 0.98
DEFECT_MIN = 0
DEFECT_MAX = 30
TOLERANCE = 0.98
SUITE_YIELD_TOLERANCE = 0.95
QUALITY_SCORE_MIN = 0
QUALITY_SCORE_MAX = 100
FRESHNESS_MIN = "2024-01-01"
FRESHNESS_MAX = "2026-12-31"
VALID_EQUIPMENT = ["EQ001", "EQ002", "EQ003", "EQ004"]
VALID_SHIFTS = [1, 2, 3]
VALID_QUALITY_FLAGS = ["PASS", "FAIL"]

# Normal operating ranges and targets.
TEMP_TARGET = 350.0
TEMP_NORMAL = (340.0, 360.0)
PRESSURE_TARGET = 10.0
PRESSURE_NORMAL = (8.0, 12.0)
YIELD_TARGET = 0.95
YIELD_NORMAL = (0.85, 1.00)
DEFECT_TARGET = 2
DEFECT_NORMAL = (0, 8)

# Process model used by synthesis and expected-vs-actual checks.
TEMP_MEAN = 350.0
TEMP_STD = 5.0
PRESSURE_MEAN = 10.0
PRESSURE_STD = 0.5
DEFECT_LAMBDA = 2.0
ANOMALY_RATE = 0.01
YIELD_BETA = (20, 2)
YIELD_OFFSET = 0.80
YIELD_SCALE = 0.19
YIELD_RESEARCH_TARGET = 0.92
ANOMALY_TYPES = ["temp_spike", "temp_drop", "pressure_fluctuation", "defect_burst"]

# Research chart limits (target, +-1 sigma band, 3 sigma lines).
CHART_TARGET = 350.0
CHART_BAND = (345.0, 355.0)
CHART_LIMITS = (335.0, 365.0)
CHART_POINTS = 200

# Formats.
WAFER_ID_FORMAT = "W%08d"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ARCHIVE_PREFIX = "bronze/wafer-telemetry"
DEFAULT_PARTITION_KEY = "unknown"
DEFAULT_INSTALL_DATE = "2024-01-01"

# Column lists in their order.
PROCESS_COLUMNS = ["temperature_c", "pressure_torr", "yield_rate", "defect_count"]
RAW_COLUMNS = [
    "timestamp", "wafer_id", "equipment_id",
    "temperature_c", "pressure_torr", "yield_rate",
    "defect_count", "is_anomaly",
]
BRONZE_COLUMNS = RAW_COLUMNS + ["date"]
SILVER_COLUMNS = BRONZE_COLUMNS + [
    "shift_number", "hour_of_day", "equipment_age_days",
    "temperature_deviation_c", "pressure_deviation_torr",
    "quality_flag", "silver_ingestion_time", "quality_score",
]
NATIVE_NOT_NULL = ["wafer_id", "equipment_id", "timestamp", "temperature_c", "yield_rate"]
SUITE_NOT_NULL = ["wafer_id", "equipment_id", "timestamp"]

# ---------------------------------------------------------------------------
# Schemas.
# ---------------------------------------------------------------------------
RAW_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("wafer_id", T.StringType(), True),
    T.StructField("equipment_id", T.StringType(), True),
    T.StructField("temperature_c", T.DoubleType(), True),
    T.StructField("pressure_torr", T.DoubleType(), True),
    T.StructField("yield_rate", T.DoubleType(), True),
    T.StructField("defect_count", T.LongType(), True),
    T.StructField("is_anomaly", T.BooleanType(), True),
])

# Wire form: the timestamp travels as text (ISO-8601 or epoch milliseconds).
WIRE_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType(), True)] + RAW_SCHEMA.fields[1:]
)

SILVER_TYPES = {
    "date": T.DateType(),
    "shift_number": T.IntegerType(),
    "hour_of_day": T.IntegerType(),
    "equipment_age_days": T.IntegerType(),
    "temperature_deviation_c": T.DoubleType(),
    "pressure_deviation_torr": T.DoubleType(),
    "quality_flag": T.StringType(),
    "silver_ingestion_time": T.TimestampType(),
    "quality_score": T.IntegerType(),
}
