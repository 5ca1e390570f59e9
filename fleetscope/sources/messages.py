"""Message sources and codecs: S1, S2, S9, P1, P2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.schema import WIRE_SCHEMA

PASSTHROUGH = ("partition", "offset", "snapshot_id")


def encode_events(df: DataFrame, columns=None, key: str | None = None) -> DataFrame:
    """Event rows -> one JSON message per row in a binary ``value``, with
    the text of column ``key`` as ``key`` if one is named."""
    cols = list(columns or [f.name for f in WIRE_SCHEMA.fields])
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []),
                     F.to_json(F.struct(*cols)).cast("binary").alias("value"))


def raw_text(col: str = "value") -> Column:
    return F.col(col).cast("string")


def decode_fields(messages: DataFrame, keep=PASSTHROUGH, value: str = "double") -> DataFrame:
    """P1 only: the seven JSON fields (timestamp still text) plus the raw text.

    The struct is unpacked by a generator (``inline``) rather than by field
    access: a filter on the fields (validation, routing) cannot be pushed
    below a generator, so the text is parsed once per row instead of once
    per referenced field. A null struct (bad text) yields one all-null row.
    ``value``: the type of the value field; ``variant`` keeps it as it was sent.
    """
    kept = [c for c in keep if c in messages.columns]
    wire = ", ".join(f"{f.name} {value if f.name == 'value' else f.dataType.simpleString()}" for f in WIRE_SCHEMA.fields)
    return messages.select(
        *kept,
        F.inline(F.array(F.from_json(raw_text(), wire))),
        raw_text().alias("raw_value"),
    )


def decode(messages: DataFrame, keep=PASSTHROUGH) -> DataFrame:
    """P1 + P2: parse the JSON text with the fixed 7-field contract.

    Malformed text or a non-object gives all-null fields (PERMISSIVE); a value
    of the wrong JSON type gives a null value and keeps the other fields. The
    raw text is kept for the dead letter. The timestamp text is parsed with
    ``try_to_timestamp`` so unparseable text becomes null instead of failing
    the batch under ANSI mode.
    """
    parsed = decode_fields(messages, keep)
    return parsed.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def stream_source(spark: SparkSession, servers: str, topic: str,
                  starting_offsets: str = "earliest", **options) -> DataFrame:
    """Subscribe to one topic from the earliest offset.

    Needs the Kafka connector on the classpath. The processing job accepts any
    streaming DataFrame with a ``value`` column, so file streams work too.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def replay_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Bounded read of the whole topic, earliest to latest offsets."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load())


def text_stream_source(spark: SparkSession, path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File-backed stand-in for S1: one JSON message per line of text files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("value").cast("binary").alias("value"))


def write_messages(events: DataFrame, servers: str, topic: str, key: str | None = None):
    """S9 sink: encode each event as JSON and publish it (batch write).

    Unkeyed by default, so the producer spreads messages over partitions; a
    ``key`` keeps one device's events ordered in one partition, at the price
    of a hot partition when one device dominates. Needs the Kafka connector.
    """
    (encode_events(events, key=key).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def stream_messages(events: DataFrame, servers: str, topic: str, checkpoint: str,
                    key: str | None = None):
    """S9 sink for a streaming frame of events (checkpointed, at least once)."""
    return (encode_events(events, key=key).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
