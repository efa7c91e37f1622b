"""Events in and out of a Kafka topic. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions.wire import decode_events, encode_event

# Topic, delivery guarantee and retries of the producer.
TOPIC = "api_events"
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3"}


def kafka_options(brokers: str, **options: str) -> dict[str, str]:
    """Connection options; ``brokers`` is a comma-separated list, blanks are dropped.

    Further ones, such as security settings, are named with ``__`` for each dot.
    """
    servers = ",".join(b.strip() for b in brokers.split(",") if b.strip())
    if not servers:
        raise ValueError("no brokers given")
    return {"kafka.bootstrap.servers": servers,
            **{k.replace("__", "."): v for k, v in options.items()}}


def messages(df: DataFrame) -> DataFrame:
    """The one-column frame of JSON messages that is published."""
    return df.select(encode_event(df).alias("value"))


def write_events(df: DataFrame, options: dict[str, str], topic: str = TOPIC) -> None:
    """Publish a batch of events."""
    messages(df).write.format("kafka").options(**PRODUCER_OPTIONS).options(**options).option(
        "topic", topic).save()


def read_events(
    spark: SparkSession, options: dict[str, str], topic: str = TOPIC, bad: str = "fail",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of decoded events from the start of the topic, with their arrival position.

    The columns ``arrived_at, partition, offset`` order the messages for first-writer-wins.
    """
    # The caller's options come last, so they may choose another start.
    reader = (spark.readStream.format("kafka").option("subscribe", topic)
              .option("startingOffsets", "earliest").options(**options))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return received(reader.load(), bad)


def received(raw: DataFrame, bad: str = "fail") -> DataFrame:
    """Decode the frame the connector gives; works for streams and batches alike."""
    positioned = raw.select(
        F.col("timestamp").alias("arrived_at"), "partition", "offset", "value")
    return decode_events(positioned, bad=bad)
