"""Message topics as sources. Needs the Kafka package of Spark on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.config import PipelineConfig


def source_options(
    config: PipelineConfig, topic: str | None = None, from_start: bool = False,
    pattern: str | None = None,
) -> dict[str, str]:
    """Subscribe to one topic, or to all that fit ``pattern``. Offsets live in the checkpoint;
    ``from_start`` only says where a query without one begins."""
    options = {
        "kafka.bootstrap.servers": config.brokers,
        "groupIdPrefix": config.group_id,
        "startingOffsets": "earliest" if from_start else "latest",
    }
    if pattern:
        options["subscribePattern"] = pattern
    else:
        options["subscribe"] = topic or config.input_topic
    return options


def message_text(raw: DataFrame) -> DataFrame:
    """Topic, position and text value of broker records."""
    return raw.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value")
    )


def stream_topic(spark: SparkSession, config: PipelineConfig, **where) -> DataFrame:
    options = source_options(config, **where)
    return message_text(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, config: PipelineConfig, **where) -> DataFrame:
    """All records present now, as a batch."""
    options = source_options(config, from_start=True, **where)
    options.pop("groupIdPrefix")
    options["endingOffsets"] = "latest"
    return message_text(spark.read.format("kafka").options(**options).load())
