"""Topic sink (SNK-5, 6, 7, 9): the ``key`` / ``value`` / ``topic`` column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C


def default_partition_key(column: str = "equipment_id"):
    return F.coalesce(F.col(column).cast("string"), F.lit(C.DEFAULT_PARTITION_KEY))


def encode_message(df: DataFrame):
    """Whole row as JSON text with an ISO-8601 timestamp."""
    cols = [F.date_format(F.col(c).cast("timestamp"), C.ISO_FORMAT).alias(c) if c == "timestamp" else F.col(c)
            for c in df.columns]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def to_kafka_frame(df: DataFrame, topic: str | None = None, key_column: str = "equipment_id") -> DataFrame:
    """key = equipment id (``unknown`` when missing) so a chamber's messages stay ordered in one partition."""
    out = df.select(default_partition_key(key_column).alias("key"), encode_message(df).alias("value"))
    return out.withColumn("topic", F.lit(topic)) if topic else out


def key_partitioned(df: DataFrame, partitions: int, key_column: str = "equipment_id", order: str = "timestamp") -> DataFrame:
    """All rows of a key in one partition, in event order (the topic's per-key ordering)."""
    return df.repartition(partitions, default_partition_key(key_column)).sortWithinPartitions(key_column, order)


def kafka_sink_options(bootstrap: str, topic: str | None = None, acks: str = "all", retries: int = 3,
                       compression: str = "snappy") -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap, "kafka.acks": acks, "kafka.retries": str(retries),
            "kafka.compression.type": compression}
    if topic:
        opts["topic"] = topic
    return opts


def write_to_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    to_kafka_frame(df).write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()
