import json
import os

from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.functions import scalar as S
from fabflow.sinks import files as SK
from fabflow.sinks import kafka as KS
from fabflow.sources import files as SF
from fabflow.sources import kafka as KF
from helpers import frame


def _lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_both_timestamp_encodings_and_quarantine(spark, scratch):
    rec = {"wafer_id": "W00000001", "equipment_id": "EQ001", "temperature_c": 350.0, "pressure_torr": 10.0,
           "yield_rate": 0.95, "defect_count": 2, "is_anomaly": False}
    lines = [json.dumps({**rec, "timestamp": "2024-10-24T15:30:45.123456"}),
             json.dumps({**rec, "wafer_id": "W00000002", "timestamp": 1729783845123}),
             json.dumps({**rec, "wafer_id": "W00000003", "timestamp": "2024-10-24T15:30:45Z"}),
             json.dumps({**rec, "wafer_id": "W00000004", "timestamp": "yesterday"}),
             '{"timestamp": "2024-10-24T15:30:45", "wafer_id": "W00000005", broken']
    _lines(scratch, lines)
    good, bad = SF.quarantine_malformed(SF.read_json_lines(spark, scratch))
    g = {r.wafer_id: r.timestamp.isoformat() for r in good.collect()}
    assert g == {"W00000001": "2024-10-24T15:30:45.123456", "W00000002": "2024-10-24T15:30:45.123000",
                 "W00000003": "2024-10-24T15:30:45"}
    b = {(r.wafer_id, r.reason) for r in bad.collect()}
    assert b == {("W00000004", "unparseable_timestamp"), (None, "malformed_json")}


def test_millis_are_not_read_as_seconds(spark):
    df = spark.createDataFrame([("1729783845123",)], "t string")
    assert df.select(S.parse_event_time("t").alias("x")).first().x.year == 2024


def test_wide_wafer_ordinal_keeps_digits(spark):
    df = spark.range(1).select(S.format_wafer_id(F.lit(123456789012)).alias("w"), S.format_wafer_id(F.lit(7)).alias("v"))
    r = df.first()
    assert (r.w, r.v) == ("W123456789012", "W00000007")


def test_safe_percentage(spark):
    r = spark.range(1).select(S.safe_percentage(F.lit(1), F.lit(0)).alias("a"),
                              S.safe_percentage(F.lit(1), F.lit(4)).alias("b")).first()
    assert (r.a, r.b) == (0.0, 25.0)


def test_enforce_schema_drops_extras_and_fills_missing(spark):
    df = frame(spark, [{}], with_date=False).withColumn("extra", F.lit(1)).drop("is_anomaly")
    out = SF.enforce_schema(df.withColumn("temperature_c", F.lit("hot")))
    assert out.columns == C.RAW_COLUMNS
    r = out.first()
    assert r.temperature_c is None and r.is_anomaly is None


def test_archive_is_date_partitioned_and_prunes(spark, scratch):
    df = frame(spark, [{}, {"wafer_id": "W2", "timestamp": __import__("datetime").datetime(2024, 2, 1)}], with_date=False)
    SK.date_partitioned_archive(df, scratch + "/a", "overwrite")
    assert sorted(d for d in os.listdir(scratch + "/a") if d.startswith("date=")) == ["date=2024-01-10", "date=2024-02-01"]
    q = spark.read.parquet(scratch + "/a").filter(F.col("date") == F.lit("2024-02-01").cast("date"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert q.count() == 1
    back = SF.read_parquet_files(spark, scratch + "/a")
    assert back.select("source_file").distinct().count() == 2


def test_topic_frame_roundtrip_and_default_key(spark):
    df = frame(spark, [{}, {"wafer_id": "W2", "equipment_id": None}], with_date=False)
    fr = KS.to_kafka_frame(df, topic="wafer-telemetry")
    assert fr.columns == ["key", "value", "topic"]
    keys = sorted(r.key for r in fr.collect())
    assert keys == ["EQ001", "unknown"]
    msg = json.loads(fr.first().value)
    assert msg["timestamp"] == "2024-01-10T12:00:00.000000"
    back = KF.decode_message(fr.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")))
    assert back.filter(F.col("timestamp").isNull()).count() == 0
    assert back.select(*C.RAW_COLUMNS).exceptAll(df.withColumn("timestamp", F.col("timestamp"))).count() == 0


def test_connector_options():
    o = KF.kafka_source_options("b:9092", "wafer-telemetry", group="archiver", max_offsets_per_trigger=100)
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "100"
    s = KS.kafka_sink_options("b:9092", "t")
    assert s["kafka.acks"] == "all" and s["kafka.compression.type"] == "snappy"
    assert SK.object_store_path("manufacturing-data") == "s3a://manufacturing-data/bronze/wafer-telemetry"


def test_json_lines_append(spark, scratch):
    df = frame(spark, [{}], with_date=False)
    SK.write_json_lines(df, scratch + "/j")
    SK.append_json_lines(df, scratch + "/j", encoding="millis")
    assert SF.read_json_lines(spark, scratch + "/j").filter(F.col("timestamp").isNotNull()).count() == 2


def test_batch_label_from_archive_file_name(spark, scratch):
    import shutil
    df = frame(spark, [{}], with_date=False)
    df.coalesce(1).write.mode("overwrite").parquet(scratch + "/tmp")
    part = [f for f in os.listdir(scratch + "/tmp") if f.endswith(".parquet")][0]
    os.makedirs(scratch + "/arch")
    shutil.copy(os.path.join(scratch, "tmp", part), os.path.join(scratch, "arch", "kafka_batch_20241024_153045_100_records.parquet"))
    r = SF.read_parquet_files(spark, scratch + "/arch/*.parquet").select(SF.batch_label().alias("label")).first()
    assert r.label == "153045"


def test_write_parquet_bronze_schema_and_compression(spark, scratch):
    df = frame(spark, [{}], with_date=False).withColumn("extra", F.lit(1))
    SK.write_parquet_bronze(df.withColumn("defect_count", F.col("defect_count").cast("int")), scratch + "/b")
    back = spark.read.parquet(scratch + "/b")
    assert back.schema == C.RAW_SCHEMA
    assert any(f.endswith(".snappy.parquet") for f in os.listdir(scratch + "/b"))


def test_checkpoint_root_without_configured_dir():
    from fabflow.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "local[2]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = "file:" + d + "/uuid"

    class Session:
        conf, sparkContext = Conf(), Ctx()

    s = Session()
    first = checkpoint_root(s)
    assert first.startswith("file:") and checkpoint_root(s) == first     # created once, then reused
