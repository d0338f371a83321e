"""Message topics as sinks. Needs the Kafka package of Spark on the class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from monthwise.config import PipelineConfig
from monthwise.functions.text import forecast_message, window_json


def sink_options(config: PipelineConfig, topic: str | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": config.brokers,
        "topic": topic or config.output_topic,
    }


def window_values(windows: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Feature windows as message values; of keyed series with their key, as text also the message's key,
    so that a series keeps its partition and with it the order of its windows."""
    if not series:
        return windows.select(window_json(F.col("data")).alias("value"))
    key = F.to_json(F.struct(*[F.col(s).cast("string").alias(s) for s in series]))
    return windows.select(key.alias("key"), window_json(F.col("data"), series).alias("value"))


def forecast_values(records: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Result rows as message values, keyed by date so that a date keeps its partition; of keyed series by
    their key, which keeps all their dates in order."""
    key = F.date_format("date", "yyyy-MM-dd")
    if series:
        key = F.to_json(F.struct(*[F.col(s).cast("string").alias(s) for s in series]))
    return records.select(
        key.alias("key"), forecast_message(F.col("date"), F.col("sales"), series).alias("value")
    )


def write_topic(values: DataFrame, config: PipelineConfig, topic: str | None = None) -> None:
    values.write.format("kafka").options(**sink_options(config, topic)).save()


def stream_to_topic(
    values: DataFrame, config: PipelineConfig, checkpoint: str, topic: str | None = None
) -> DataStreamWriter:
    """At least once: a batch that failed half-way is sent again."""
    return (
        values.writeStream.format("kafka")
        .options(**sink_options(config, topic), checkpointLocation=checkpoint)
        .trigger(processingTime=config.trigger)
    )
