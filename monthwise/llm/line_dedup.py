"""Lines that many documents share, found with levelled sorted runs of line hashes.

A run is a written table of line hashes with the number of documents that held them, in buckets sorted
by hash. Every batch of documents merge-anti-joins the keys already known to be common and adds a run
of its own; as soon as a level has ``fanout`` runs, they are merge-joined into one run of the next level.
So a batch costs its own size plus a logarithmic share of the merging, however much came before.
Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import WHITE, ascii_lower, whole
from monthwise.session import fresh_dir

HASH = ["_h1", "_h2"]


def line_keys(lines: Column) -> Column:
    """What makes lines equal: no white space at the ends, A-Z in lower case.

    Step by step, as an expression that a lambda names twice is computed twice.
    """
    return F.transform(F.transform(lines, lambda x: F.btrim(x, F.lit(WHITE))), ascii_lower)


def _hashes(lines: Column) -> Column:
    """128 bits of each line's key, null for a key of no characters."""
    def both(key: Column) -> Column:
        h1, h2 = F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(1), key).alias("_h2")
        return F.when(key != "", F.struct(h1, h2))

    return F.transform(line_keys(lines), both)


class LineRuns:
    """The runs, level by level. ``add`` takes a batch, ``common`` returns the frequent keys.

    A run is written in ``buckets`` files by hash (default: the session's shuffle partitions), each sorted, so a
    batch meets the runs, and runs meet one another, without being exchanged or sorted again. For that they are
    planned in a sister session, whose partitions are the buckets, that trusts the order within a bucket's file.
    The tables of the runs are dropped from the catalogue at once; their files stay in the shared folder.
    """

    def __init__(
        self, spark: SparkSession, min_docs: int, fanout: int = 2, buckets: int | None = None
    ):
        if min_docs < 1 or fanout < 2:
            raise ValueError("min_docs of at least 1 and fanout of at least 2")
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.session = spark.newSession()
        for key, value in {
            "spark.sql.shuffle.partitions": str(self.buckets),
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            # Else the anti-join goes below the sum, and every copy of a line is exchanged.
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
            "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        }.items():
            self.session.conf.set(key, value)
        self.levels: list[list[DataFrame]] = [[]]

    def _here(self, rows: DataFrame) -> DataFrame:
        """``rows`` in the session of the runs."""
        name = f"line_keys_{uuid.uuid4().hex}"
        rows.createGlobalTempView(name)
        try:
            return self.session.table(f"{self.session.conf.get('spark.sql.globalTempDatabase')}.{name}")
        finally:
            rows.sparkSession.catalog.dropGlobalTempView(name)

    def _write(self, counts: DataFrame) -> DataFrame:
        """A run. Its rows come in order; the writer sorts them once more, as its order has the bucket before it."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
        writer.option("path", fresh_dir(self.spark, "line-run")).saveAsTable(name)
        run = self.session.table(name)
        self.session.sql(f"DROP TABLE {name}")
        return run

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def fresh(self, keys: DataFrame) -> DataFrame:
        """The counts of a batch's keys without those that a run knows to be common."""
        counts = self._here(keys).groupBy(*HASH).agg(F.count("*").alias("_docs"))
        for run in self._runs():
            settled = run.where(F.col("_docs") >= self.min_docs).select(*HASH)
            counts = counts.join(settled.hint("merge"), HASH, "left_anti")
        return counts

    def add(self, keys: DataFrame) -> None:
        """``keys``: one row for each document and distinct key, as ``_h1``, ``_h2``."""
        self.levels[0].append(self._write(self.fresh(keys)))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._write(self.merged(self.levels[level]))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level] = []
            self.levels[level + 1].append(merged)
            level += 1

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """The sums of several runs, by merge joins; two need no exchange, from the third on Spark adds one."""
        def two(one: DataFrame, other: DataFrame) -> DataFrame:
            docs = F.coalesce(one["_docs"], F.lit(0)) + F.coalesce(other["_docs"], F.lit(0))
            return one.join(other.hint("merge"), HASH, "full_outer").select(*HASH, docs.alias("_docs"))

        return reduce(two, runs)

    def common(self) -> DataFrame:
        """Keys found in at least ``min_docs`` documents, as a written table."""
        if not self._runs():
            return self.spark.createDataFrame([], "_h1 bigint, _h2 bigint")
        # Not a union and a sum: over bucketed Parquet Spark 4.1 then adds up buckets that don't belong together.
        found = self.merged(self._runs()).where(F.col("_docs") >= self.min_docs).select(*HASH)
        path = fresh_dir(self.spark, "line-common")
        found.write.parquet(path)
        return self.spark.read.schema("_h1 bigint, _h2 bigint").parquet(path)


def without_common_lines(
    docs: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    min_docs: int = 10,
    batches: int = 4,
    fanout: int = 2,
    buckets: int | None = None,
) -> DataFrame:
    """``row`` (all columns of ``docs`` as they are), ``kept`` (the text without common lines),
    ``n_lines`` and ``n_dropped``.

    Each row is a document, repeated rows and rows with a null id included. A null text is one
    empty line. Empty keys are never common. A text whose lines all go becomes empty. An empty table
    stays empty.

    What is dropped from a text depends on the text alone, so rows are matched by id and a 128-bit
    hash of the text. That also holds for repeated rows, which get the same answer.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    body = whole(F.col("row")[text])
    lines = F.split(body, "\n", -1)
    mark = [F.col("row")[ident].alias("id"), F.xxhash64(body).alias("t1"),
            F.xxhash64(F.lit(1), body).alias("t2")]

    distinct = F.filter(F.array_distinct(_hashes(lines)), lambda h: h.isNotNull())
    keys = rows.select(
        F.pmod(F.xxhash64(body), F.lit(batches)).alias("batch"), F.explode(distinct).alias("h")
    ).select("batch", "h.*")
    path = fresh_dir(spark, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema("_h1 bigint, _h2 bigint, batch bigint").parquet(path)
    runs = LineRuns(spark, min_docs, fanout, buckets)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch).select(*HASH))
    common = runs.common()

    places = (
        rows.select(*mark, F.posexplode(_hashes(lines)).alias("pos", "h"))
        .where(F.col("h").isNotNull())
        .select("id", "t1", "t2", "pos", "h.*")
        .join(common, HASH, "left_semi")
        .groupBy("id", "t1", "t2")
        .agg(F.collect_set("pos").alias("drop"))
        .toDF("of_id", "of_t1", "of_t2", "drop")
    )
    same = (
        F.col("id").eqNullSafe(F.col("of_id"))
        & (F.col("t1") == F.col("of_t1"))
        & (F.col("t2") == F.col("of_t2"))
    )
    found = rows.select("row", *mark).join(places, same, "left")
    found = found.select("row", "drop", body.alias("body"), lines.alias("lines"))
    every = F.transform(F.col("lines"), lambda _, i: i)
    rest = F.array_join(
        F.transform(
            F.array_except(every, F.col("drop")), lambda i: F.get(F.col("lines"), i)
        ),
        "\n",
    )
    return found.select(
        "row",
        F.when(F.col("drop").isNull(), F.col("body")).otherwise(rest).alias("kept"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
