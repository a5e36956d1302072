"""Message sources: Kafka, and a file-backed message log with Kafka's shape.

A message is ``(key BINARY, value BINARY, topic, partition, offset,
timestamp)``, the schema of Spark's Kafka source.  The payload ``value`` is
the JSON-encoded event.  The file log lets tests and offline runs drive the
same streaming query with ``readStream.parquet`` where no broker exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanwrite.functions.codec import encode
from fanwrite.functions.text import blob_text
from fanwrite.session import target_parallelism

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

POSITION_COLUMNS = ("topic", "partition", "offset")


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topics: str, **options) -> DataFrame:
    """Direct (receiver-less) Kafka read of a topic list.

    Needs the ``spark-sql-kafka`` package on the classpath.  Like a direct
    stream with no start offset given, it starts at the latest offsets unless
    ``startingOffsets`` is passed.  ``minPartitions`` defaults to the
    cluster's cores capped by ``spark.sql.shuffle.partitions``, so the source
    itself splits large offset ranges and a micro-batch needs no shuffle to
    spread over the executors.  A micro-batch takes ten million messages unless
    ``maxOffsetsPerTrigger`` says otherwise.
    """
    options = {"minPartitions": str(target_parallelism(spark))} | KAFKA_BATCH | options
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topics)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(*[f.name for f in MESSAGE_SCHEMA.fields])


def messages_from_events(
    events: DataFrame,
    key: Column | str = "event_id",
    offset: Column | str = "event_id",
    timestamp: Column | str = "ts",
    topic: str = "events",
    partitions: int = 1,
    legacy: Column | None = None,
) -> DataFrame:
    """Encode ``(…, event)`` rows as messages.

    ``offset`` must be unique and grow with arrival within a partition; the
    partition is a hash of the key, as a keyed producer would choose it.
    ``legacy`` marks rows whose producer sends the map's ``{k=v}`` text
    instead of JSON; those payloads cannot be decoded and become rejects.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    payload = encode("event")
    if legacy is not None:
        payload = F.when(legacy, F.encode(blob_text("event"), "UTF-8")).otherwise(payload)
    part = F.lit(0) if partitions <= 1 else F.pmod(F.xxhash64(key_col.cast("string")), F.lit(partitions))
    return events.select(
        F.encode(key_col.cast("string"), "UTF-8").alias("key"),
        payload.alias("value"),
        F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"),
        (F.col(offset) if isinstance(offset, str) else offset).cast("long").alias("offset"),
        (F.col(timestamp) if isinstance(timestamp, str) else timestamp).cast("timestamp").alias("timestamp"),
    )


def write_message_log(messages: DataFrame, path: str, files: int | None = None, append: bool = False) -> str:
    """Write messages as parquet files, each a contiguous offset range.

    The shuffle sizes them to the data (about the advisory partition size a
    file, at most as many as there are shuffle partitions); ``files`` asks for
    a number of files instead, so that a test can read them one per batch.
    ``append`` adds to an existing log (data arriving while a query is stopped).
    """
    by = ("partition", "offset")
    ranged = messages.repartitionByRange(files, *by) if files else messages.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("append" if append else "errorifexists").parquet(path)
    return path


# What a micro-batch of a log or a topic takes at most, unless told otherwise.
LOG_BATCH = {"maxBytesPerTrigger": str(4 << 30)}
KAFKA_BATCH = {"maxOffsetsPerTrigger": "10000000"}


def message_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming read of a message log written by :func:`write_message_log`.

    A micro-batch takes ``max_files_per_trigger`` files, else what
    ``options`` say (file source options), else files of 4 GB together.
    """
    if max_files_per_trigger:
        options.setdefault("maxFilesPerTrigger", max_files_per_trigger)
    options = options if {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options) else options | LOG_BATCH
    return spark.readStream.schema(MESSAGE_SCHEMA).options(**options).parquet(path)


def message_log(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a message log (for bulk replays and checks)."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)
