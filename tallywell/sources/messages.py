"""Reading and publishing ``(key, value)`` text messages, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import Source

ENVELOPE = "key string, value string"
#: how folders are compressed unless a sink's options say otherwise; readers go by the files
COMPRESSION = {"json": "gzip", "text": "gzip", "parquet": "zstd"}
#: fixed value: messages get no smaller at the default level 3, and take longer to write
ZSTD_LEVEL = {"parquet.compression.codec.zstd.level": "1"}


def read_messages(spark: SparkSession, source: Source) -> DataFrame:
    """Everything in the topic now, from its earliest message to its latest."""
    reader = spark.read
    if source.kind == "kafka":
        reader = reader.option("startingOffsets", "earliest").option("endingOffsets", "latest")
    return _load(reader, source)


def stream_messages(spark: SparkSession, source: Source) -> DataFrame:
    """The same messages as an unbounded table, from the earliest on."""
    reader = spark.readStream
    if source.kind == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    return _load(reader, source)


def _load(reader, source: Source) -> DataFrame:
    reader = reader.format(source.kind).options(**source.options)
    if source.kind == "kafka":
        found = (
            reader.option("kafka.bootstrap.servers", source.location)
            .option("subscribe", source.topic)
            .load()
        )
    elif source.kind == "text":
        found = reader.load(source.location).withColumn("key", F.lit(None))
    else:
        found = reader.schema(ENVELOPE).load(source.location)
    return found.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def write_messages(messages: DataFrame, sink: Source, mode: str = "append") -> None:
    """Publish ``(key, value)`` messages, keyed where the sink can hold a key."""
    if sink.kind == "kafka":
        (
            messages.select("key", "value")
            .write.format("kafka")
            .options(**sink.options)
            .option("kafka.bootstrap.servers", sink.location)
            .option("topic", sink.topic)
            .save()
        )
        return
    columns = ["value"] if sink.kind == "text" else ["key", "value"]
    (
        messages.select(*columns)
        .write.format(sink.kind)
        .options(**{"compression": COMPRESSION[sink.kind], **ZSTD_LEVEL, **sink.options})
        .mode(mode)
        .save(sink.location)
    )
