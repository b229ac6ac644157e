"""Message-topic sources and the payload codec.

A topic (Kafka) delivers each reading as the UTF-8 JSON text of one record in
``value``.  ``decode_payload`` turns any DataFrame with a ``value`` column
(batch or stream, binary or text) into typed readings plus ``event_time``;
a text-file stream gives the same ``value`` column and is used where no broker
is available.  The Kafka connector jar must be on the classpath for the
``kafka_*`` readers (``org.apache.spark:spark-sql-kafka-0-10_2.13`` matching
the Spark version).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.time import event_time
from stationflow.schema import READING, TOPIC

DEFAULT_TOPIC = TOPIC


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Unbounded topic read; one Spark task per topic partition, or, with
    ``min_partitions``, offset ranges split so a few large topic partitions
    still spread over many tasks."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def kafka_batch(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    min_partitions: int | None = None,
    ending_offsets: str = "latest",
) -> DataFrame:
    """Bounded topic read from the earliest to ``ending_offsets``: the latest ones, or
    the JSON text of an offset per partition."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", ending_offsets)
    )
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a stream with the same ``value`` column a topic gives."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def decode_payload(raw: DataFrame) -> DataFrame:
    """``value`` (bytes or text) -> the 12 reading fields + ``event_time``.

    Unparsable text, wrong-typed values and missing keys give null fields; an
    unparsable timestamp gives a null ``event_time``.  Nothing here fails.
    """
    return (
        raw.select(F.from_json(F.col("value").cast("string"), READING).alias("data"))
        .select("data.*")
        .withColumn("event_time", event_time("timestamp"))
    )


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Publish a ``value`` column to a topic with all-replica acknowledgement."""
    (
        df.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .save()
    )
