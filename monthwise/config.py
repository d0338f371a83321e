"""Job parameters."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

# Wire names, window sizes and cadences that results depend on.
DAY_PATTERN = "yyyy-MM-dd"
DATE_FIELD = "Order Date"
SALES_FIELD = "Sales"
WINDOW_MONTHS = 17
HORIZON = 6
HOLDOUT_MONTHS = 6
TRAIN_LAGS = 11
SERVE_LAGS = 10
WATERMARK_DAYS = 1
FILE_GLOB = "*transaction_data*.csv"


@dataclass(frozen=True)
class PipelineConfig:
    """Names and addresses of one deployment; every field has a usable default."""

    # The names other parts of a deployment expect.
    job_name: str = "feature_aggregation_job"
    input_topic: str = "transaction_data"
    output_topic: str = "lstm_input"
    result_topic: str = "lstm_results"
    group_id: str = "lstm"
    brokers: str = "localhost:9092"
    data_path: str | None = None
    date_col: str = DATE_FIELD
    sales_col: str = SALES_FIELD
    series: tuple[str, ...] = ()
    trigger: str = "3 seconds"
    #: Forecast arithmetic of ``serve``: ``compat`` or ``corrected``.
    mode: str = "compat"
    #: State partitions of the ``features`` stream. They stay as at its first start.
    state_partitions: int = 200
    #: Where ``persist`` moves files that it has read; they stay in place without it.
    archive_dir: str | None = None
    #: Most files that ``persist`` takes in one batch.
    files_per_batch: int = 1000
    #: Change batches of a keyed table after which they are folded into its base.
    compact_every: int = 100
    #: Database for the tables of ``results`` and ``persist``; without it they are keyed tables of files.
    jdbc_url: str | None = None
    #: JSON file with the connection's properties: user, password, driver.
    jdbc_properties: str | None = None
    #: Hash buckets of keyed tables and of the latest months. They stay as at the first start.
    buckets: int = 64

    @classmethod
    def from_args(cls, argv: Sequence[str]) -> PipelineConfig:
        """Read ``--job-name x --input-topic y ...``; ``-in``, ``-out`` and ``-broker`` are
        short forms of the topic and broker arguments. ``--config`` names a JSON file for
        :meth:`from_json`, whose values the other arguments override."""
        short = {"input_topic": "-in", "output_topic": "-out", "brokers": "-broker"}
        also = {"brokers": "--kafka-address"}
        parser = argparse.ArgumentParser(allow_abbrev=False)
        for f in fields(cls):
            names = ["--" + f.name.replace("_", "-")]
            names += [m[f.name] for m in (also, short) if f.name in m]
            if f.name == "series":
                parser.add_argument(*names, dest=f.name, nargs="*", default=None)
            else:
                kind = int if isinstance(f.default, int) else str
                parser.add_argument(*names, dest=f.name, default=None, type=kind)
        parser.add_argument("--config", dest="from_file", default=None)
        given = {k: v for k, v in vars(parser.parse_args(list(argv))).items() if v is not None}
        if "series" in given:
            given["series"] = tuple(given["series"])
        if given.get("mode", "compat") not in ("compat", "corrected"):
            parser.error("--mode is compat or corrected")
        base = cls()
        if file := given.pop("from_file", None):
            with open(file, encoding="utf-8") as text:
                base = cls.from_json(text.read())
        return replace(base, **given)

    @classmethod
    def from_json(cls, text: str, section: str = "lstm-script") -> PipelineConfig:
        """Read the training section of a JSON config: data path, date and target column."""
        # The section's keys.
        body = json.loads(text)[section]
        return replace(
            cls(),
            data_path=body["dataFrame-path"],
            date_col=body["date-col"],
            sales_col=body["target-col"],
        )
