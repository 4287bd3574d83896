"""Message topics: bounded and streaming reads, keyed writes.

The connector jar is the cluster's to provide; everything past the read works on any
frame of the topic shape ``key, value, topic, partition, offset, timestamp, timestampType``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import encode_json, message_key
from starmart.schemas import MESSAGE_KEYS, TOPICS


def read_options(servers: str, topic: str, min_partitions: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if min_partitions:
        # more tasks than topic partitions: a big offset range is split
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None) -> DataFrame:
    """Everything now in the topic, as a bounded scan."""
    options = read_options(servers, topic, min_partitions) | {"endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load()


def stream_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, min_partitions: int | None = None
) -> DataFrame:
    options = read_options(servers, topic, min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def topic_of(event_type: Column, prefix: str = "", topics: dict[str, str] = TOPICS) -> Column:
    """Topic name of each row's event type; an unknown type has no topic (NULL)."""
    topic = F.lit(None).cast("string")
    for name, suffix in topics.items():
        topic = F.when(event_type == name, F.lit(prefix + suffix)).otherwise(topic)
    return topic


def to_messages(df: DataFrame, event_type: str, prefix: str = "", keys: list[str] | None = None) -> DataFrame:
    """Rows of one event type as ``topic, key, value``, ready to publish."""
    return df.select(
        F.lit(prefix + TOPICS[event_type]).alias("topic"),
        message_key(*(keys or MESSAGE_KEYS[event_type])).cast("binary").alias("key"),
        encode_json(df).cast("binary").alias("value"),
    )


def write_topics(messages: DataFrame, servers: str, **producer: str) -> None:
    """Publish to the topic named in each row; ``producer`` settings go to the client as ``kafka.*``."""
    # --- fixed values: producer settings that callers expect by default ---
    settings = {
        "acks": "all",
        "retries": "3",
        "batch.size": "16384",
        "linger.ms": "5",
        "compression.type": "snappy",
    } | {name.replace("_", "."): value for name, value in producer.items()}
    options = {f"kafka.{name}": value for name, value in settings.items()}
    (
        messages.select("topic", "key", "value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers}, **options)
        .save()
    )
