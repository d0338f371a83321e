"""The jobs as commands: ``python -m monthwise.plans.jobs <job> [--arguments]``.

``features``  transactions topic to closed months to window messages on the output topic
``serve``     window messages to forecast messages on the result topic
``persist``   a directory of transaction files to the keyed raw table
``results``   forecast messages to the keyed result table
``train``     a CSV to a saved scaler and model
``export``    the result table to one sorted CSV

``--jdbc-url`` sends the tables of ``persist`` and ``results`` to a database instead.

With ``--series`` the jobs keep a series for each value of these record fields: the fields travel with the
windows and results as text and are part of the result table's key; ``train`` pools the rows of all. Without, there is
one total series. ``persist`` keeps whole records and needs no series. What a job can't use is kept with a reason: messages and windows
in ``rejected`` below the job's folder, lines and files of ``persist`` in its table and ``quarantine``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthwise.config import DAY_PATTERN, PipelineConfig
from monthwise.functions.text import forecast_payload
from monthwise.operators.forecast import Mode, Scaler, forecast_each, forecast_records
from monthwise.operators.models import Scorer
from monthwise.operators.quality import (
    REASON, dead_letters, good_records, parse_messages, parse_windows,
)
from monthwise.plans.training import TrainedForecaster, evaluate, train_from_csv
from monthwise.session import build_session, shared_dir, state_session
from monthwise.sinks.batch_log import BatchLog
from monthwise.sinks.export import export_csv
from monthwise.sinks.jdbc import DatabaseTable
from monthwise.sinks.keyed_table import KeyedTable
from monthwise.sinks.topics import forecast_values, stream_to_topic, window_values, write_topic
from monthwise.sources.dropdir import MALFORMED, SOURCE_FILE, stream_files
from monthwise.sources.topics import stream_topic
from monthwise.streaming.jobs import CsvPersistJob, WindowJob, run_batches
from monthwise.streaming.months import closed_month_stream


def job_root(spark: SparkSession, config: PipelineConfig, job: str) -> str:
    return f"{shared_dir(spark)}/{config.job_name}/{job}"


def keep_rejected(refused: DataFrame, root: str, every: str | None = None) -> StreamingQuery:
    """Write a stream of dead letters to ``rejected`` below ``root``."""
    log = BatchLog(refused.sparkSession, f"{root}/rejected", merge_every=16)
    return run_batches(refused, log.write, f"{root}/rejected-checkpoint", every)


def served(
    messages: DataFrame, scorer: Scorer, mode: Mode, scaler: Scaler | None = None,
    series: Sequence[str] = (),
) -> DataFrame:
    """Window messages to result rows, twelve per usable message; batch or stream."""
    windows = good_records(parse_windows(messages, series=series)).select(*series, "data")
    return forecast_records(forecast_each(windows, scorer, mode, scaler), series)


def refused_windows(messages: DataFrame) -> DataFrame:
    return dead_letters(parse_windows(messages)).drop("data")


def result_rows(messages: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Forecast messages to ``series..., date, sales, seq, reason`` for the keyed result table.

    A key field that is null in the message is the empty text in the table, where keys can't be null.
    """
    payload = forecast_payload(F.col("value"), series)
    rows = messages.select("value", F.col("offset").alias("seq"), payload.alias("payload"))
    keys = [F.coalesce(F.col(f"payload.`{s}`"), F.lit("")).alias(s) for s in series]
    rows = rows.select("value", "seq", *keys, "payload.date", "payload.sales")
    return rows.withColumn(REASON, F.when(F.col("sales").isNull(), "no sales"))


def results_table(spark: SparkSession, config: PipelineConfig) -> KeyedTable:
    root = job_root(spark, config, "results") + "/table"
    return KeyedTable(
        spark, root, [*config.series, "date"], ["seq"],
        compact_every=config.compact_every, buckets=config.buckets,
    )


def database_table(
    spark: SparkSession, config: PipelineConfig, job: str, keys: Sequence[str],
    order: Sequence[str] = (), leave_out: Sequence[str] = (),
) -> DatabaseTable:
    """The table of a job in the database of ``--jdbc-url``, under the name of the topic it holds."""
    properties = {}
    if config.jdbc_properties:
        with open(config.jdbc_properties, encoding="utf-8") as text:
            properties = json.load(text)
    target = config.result_topic if job == "results" else f"{config.input_topic}_persist"
    rejected = BatchLog(spark, job_root(spark, config, job) + "/rejected", merge_every=16)
    return DatabaseTable(
        spark, config.jdbc_url, target, keys, rejected, order, f"{config.job_name}_{job}", properties, leave_out
    )


def features(spark: SparkSession, config: PipelineConfig) -> None:
    def write(windows: DataFrame, batch_id: int) -> None:
        write_topic(window_values(windows, config.series), config)

    root = job_root(spark, config, "features")
    job = WindowJob(spark, root, write, config.series, config.buckets)
    session = state_session(spark, config.state_partitions)
    fields = {"date_field": config.date_col, "sales_field": config.sales_col, "series": config.series}
    good = good_records(parse_messages(stream_topic(session, config), **fields))
    records = good.select("day", "sales", *config.series)
    job.start(closed_month_stream(records, series=config.series), every=config.trigger)
    refused = dead_letters(parse_messages(stream_topic(spark, config), **fields))
    keep_rejected(refused, root, config.trigger)
    wait_for_any(spark, session)


def wait_for_any(*sessions: SparkSession) -> None:
    """Until one of the started streams ends; if it failed, its error is raised."""
    queries = [q for session in sessions for q in session.streams.active]
    while all(q.isActive for q in queries):
        queries[0].awaitTermination(5)
    for q in queries:
        if not q.isActive:
            q.awaitTermination()


def serve(spark: SparkSession, config: PipelineConfig, mode: Mode | None = None) -> None:
    trained = TrainedForecaster.load(spark, job_root(spark, config, "train"))
    messages = stream_topic(spark, config, topic=config.output_topic, from_start=True)
    rows = served(messages, trained.scorer, mode or config.mode, trained.scaler, config.series)
    root = job_root(spark, config, "serve")
    stream_to_topic(
        forecast_values(rows, config.series), config, f"{root}/checkpoint", config.result_topic
    ).start()
    keep_rejected(refused_windows(messages), root, config.trigger)
    wait_for_any(spark)


def persist(spark: SparkSession, config: PipelineConfig) -> None:
    """Records are kept as they are; date and sales are only checked where they are forecast from."""
    files = stream_files(
        spark, config.data_path, archive_dir=config.archive_dir,
        files_per_batch=config.files_per_batch,
    )
    table = None
    if config.jdbc_url:
        table = database_table(
            spark, config, "persist", ["postgres_pk"], leave_out=[MALFORMED, SOURCE_FILE]
        )
    job = CsvPersistJob(
        spark, job_root(spark, config, "persist"), compact_every=config.compact_every,
        buckets=config.buckets, table=table,
    )
    job.start(files, every=config.trigger).awaitTermination()


def results(spark: SparkSession, config: PipelineConfig) -> None:
    table = results_table(spark, config)
    if config.jdbc_url:
        table = database_table(
            spark, config, "results", [*config.series, "date"], ["seq"], leave_out=["value"]
        )
    messages = stream_topic(spark, config, topic=config.result_topic, from_start=True)
    checkpoint = job_root(spark, config, "results") + "/checkpoint"
    rows = result_rows(messages, config.series)
    run_batches(rows, table.upsert, checkpoint, config.trigger).awaitTermination()


def train(spark: SparkSession, config: PipelineConfig) -> None:
    trained, rows = train_from_csv(spark, config, [DAY_PATTERN, "M/d/yyyy", "d.M.yyyy"])
    trained.save(spark, job_root(spark, config, "train"))
    evaluate(trained, rows).show()


def export(spark: SparkSession, config: PipelineConfig) -> None:
    rows = results_table(spark, config).read()
    if rows is None:
        raise ValueError("there are no results to export yet")
    keys = [*config.series, "date"]
    # Without series there is one row a month, which makes one file.
    export_csv(
        rows.select(*keys, "sales"), job_root(spark, config, "export"), keys, single=not config.series
    )


JOBS: dict[str, Callable[[SparkSession, PipelineConfig], None]] = {
    job.__name__: job for job in (features, serve, persist, results, train, export)
}


def main(argv: list[str]) -> None:
    config = PipelineConfig.from_args(argv[1:])
    JOBS[argv[0]](build_session(config.job_name), config)


if __name__ == "__main__":
    main(sys.argv[1:])
