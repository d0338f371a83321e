"""From raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; what it returns is written
before the next one reads it.

In every stage a null text is an empty one, a null id is an id like any other, repeated rows are judged each for
itself, an empty table stays empty, and further columns, whatever their names, are kept as they are by all stages but
the last, which returns places of pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import byte_cnn, line_dedup, queries, simhash, toxicity
from monthwise.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives at least one half; equal texts share their fate."""
    network = queries.quality_network(spark, sf_dir)
    return docs.where(byte_cnn.quality_score(F.col("text"), network) >= 0.5)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half; empty texts match nothing and stay."""
    model = queries.toxicity_model(spark, sf_dir)
    return docs.where(toxicity.toxicity_score(F.col("text"), model) < 0.5)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share; ``n_chars`` follows."""
    found = line_dedup.without_common_lines(docs, min_docs=10)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept")}
    return found.select(
        *[
            changed[f.name].cast(f.dataType).alias(f.name) if f.name in changed
            else F.col("row")[f.name].alias(f.name)
            for f in docs.schema
        ]
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.keep_one_of_each(docs, shingle=3, distance=2)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence; empty texts are one token long."""
    return queries.packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", clean),
    ("line dedup", without_common_lines),
    ("simhash near-dedup", one_of_each_group),
    ("best-fit packing", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
