"""Keyed JSON messages: broker options, decoding, encoding, the category sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from jobstrata import vocab
from jobstrata.functions.dates import AsOf, as_date
from jobstrata.session import adaptive


def kafka_source_options(cfg: dict[str, str]) -> dict[str, str]:
    """Reader options for a topic, with SASL and TLS settings when they are configured."""
    # Defaults of the consumer.
    options = {
        "kafka.bootstrap.servers": cfg["bootstrap_servers"],
        "subscribe": cfg["topic"],
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": "30000",
        "kafka.request.timeout.ms": "40000",
        "kafka.max.poll.records": "500",
    }
    if cfg.get("security_protocol"):
        options["kafka.security.protocol"] = cfg["security_protocol"]
    if cfg.get("sasl_mechanism"):
        options["kafka.sasl.mechanism"] = cfg["sasl_mechanism"]
    if cfg.get("username") and cfg.get("password"):
        module = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options["kafka.sasl.jaas.config"] = (
            f'{module} required username="{cfg["username"]}" password="{cfg["password"]}";'
        )
    if cfg.get("truststore"):
        options["kafka.ssl.truststore.location"] = cfg["truststore"]
        options["kafka.ssl.endpoint.identification.algorithm"] = "https"
    return options


def kafka_stream(spark: SparkSession, cfg: dict[str, str]) -> DataFrame:
    """Message stream; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_source_options(cfg)).load()


def decode_messages(df: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON value to columns, plus the message's time and key."""
    return df.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
    ).select("data.*", "kafka_timestamp", "kafka_key")


def envelope_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Decoded messages with where they come from: topic, partition, offset, and all three as ``message_id``."""
    place = ["topic", "partition", "offset"]
    decoded = df.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"), *place,
        F.concat_ws("/", *place).alias("message_id"), F.col("timestamp").alias("kafka_timestamp"), F.col("key").cast("string").alias("kafka_key"),
    )
    return decoded.select("data.*", *place, "message_id", "kafka_timestamp", "kafka_key")


def encode_messages(df: DataFrame, key: Column) -> DataFrame:
    """Rows as keyed JSON; the key is repeated in the value as ``type``."""
    return df.withColumn("type", key.cast("string")).select(
        F.col("type").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(df: DataFrame, key: Column, cfg: dict[str, str]) -> None:
    """Send rows to a topic; needs the Kafka connector on the class path."""
    kept = ("kafka.bootstrap.", "kafka.security.", "kafka.sasl.", "kafka.ssl.")
    options = {k: v for k, v in kafka_source_options(cfg).items() if k.startswith(kept)}
    encode_messages(df, key).write.format("kafka").options(**options).option("topic", cfg["topic"]).save()


def stream_gate(
    df: DataFrame, as_of: AsOf = None, categories: list[str] | None = None,
    required: tuple[str, ...] = ("extract_timestamp", "title", "company"),
) -> DataFrame:
    """Known category, required fields present, extracted on the reference day."""
    rule = F.col("category").isin(categories or vocab.DOMAINS)
    for c in required:
        rule = rule & F.col(c).isNotNull()
    return df.filter(rule & (F.col("extract_date").cast("date") == as_date(as_of)))


def write_json_by_category(
    df: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = ("category", "extract_date"),
    every: str | None = None,
) -> StreamingQuery:
    """One stream into ``category=/extract_date=/batch=`` folders.

    Runs until the input is used up, or on a timer when ``every`` is given (the message
    stream runs every ``vocab.STREAM_TRIGGER``). A micro-batch writes one file per category and day, however many tasks it
    has, and several only where a folder gets far more than the others. The batch is the last folder, so a batch that runs
    again replaces its own files and no others.
    """

    def write(rows: DataFrame, batch: int) -> None:
        with adaptive(rows.sparkSession):
            gathered = rows.hint("rebalance", *[F.col(x) for x in partitions]).withColumn("batch", F.lit(batch))
            writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*partitions, "batch").json(path)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
