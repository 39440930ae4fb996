"""Topic source (SRC-3, 4). The Kafka connector jar is a deployment dependency;
the column contract (``key``, ``value`` bytes) is what the rest of the code uses,
so the decoder is tested on frames with that shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabflow.sources.files import CORRUPT, parse_wire, wire_schema_with_corrupt


def kafka_source_options(bootstrap: str, topic: str, group: str | None = None,
                         starting: str = "earliest", max_offsets_per_trigger: int | None = None,
                         fail_on_data_loss: bool | None = None) -> dict:
    """Options for ``readStream.format("kafka")``: subscribe, start at earliest.

    Offsets are tracked in the query checkpoint (committed only after the sink
    write), not auto-committed to the broker. Lost offsets fail the query (Spark's
    default) unless the caller says otherwise with ``fail_on_data_loss=False``.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if fail_on_data_loss is not None:
        opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if group:
        opts["kafka.group.id"] = group
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_source_options(bootstrap, topic, **kw)).load()


def decode_message(messages: DataFrame) -> DataFrame:
    """``value`` bytes -> UTF-8 text -> JSON fields -> typed telemetry (PERMISSIVE).

    A value that is not JSON keeps its text in ``_corrupt_record``.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(F.col("key").cast("string").alias("message_key"),
                             F.from_json(text, wire_schema_with_corrupt(),
                                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("m"))
    return parse_wire(parsed.select("message_key", "m.*"))
