"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "monthwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC days, AQE, RocksDB state."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a machine-local
    folder would be lost with its machine, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="monthwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def state_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A sister session for streams with this many state partitions.

    A stateful query keeps the partition count of its first start for good and opens one state
    store per partition and batch. So the count is stated by the caller and should follow the state:
    a sum per series and open month, or a hash per record where redelivered records are dropped. It
    never depends on the machines that happen to be there.
    """
    if partitions < 1:
        raise ValueError("at least one state partition")
    sister = spark.newSession()
    sister.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return sister


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
