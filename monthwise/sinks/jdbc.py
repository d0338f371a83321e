"""Upserts into a database table through a staging table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.operators.latest import latest_per_key
from monthwise.operators.quality import REASON, dead_letters, good_records
from monthwise.sinks.batch_log import BatchLog


def _quoted(names: Sequence[str]) -> list[str]:
    return ['"' + n.replace('"', '""') + '"' for n in names]


def upsert_statement(
    target: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """``INSERT ... ON CONFLICT`` that sets the given columns and leaves others untouched."""
    listed = ", ".join(_quoted(columns))
    rest = [c for c in columns if c not in keys]
    sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in _quoted(rest))
    action = f"DO UPDATE SET {sets}" if rest else "DO NOTHING"
    return (
        f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} "
        f"ON CONFLICT ({', '.join(_quoted(keys))}) {action}"
    )


def widen_statements(target: str, present: Sequence[str], wanted: dict[str, str]) -> list[str]:
    """One ``ALTER TABLE`` per column the target lacks."""
    return [
        f"ALTER TABLE {target} ADD COLUMN {_quoted([name])[0]} {kind}"
        for name, kind in wanted.items()
        if name not in present
    ]


def create_statement(target: str, columns: dict[str, str], keys: Sequence[str]) -> str:
    listed = ", ".join(
        f"{q} {kind}" + (" NOT NULL" if name in keys else "")
        for q, (name, kind) in zip(_quoted(list(columns)), columns.items())
    )
    return f"CREATE TABLE IF NOT EXISTS {target} ({listed}, PRIMARY KEY ({', '.join(_quoted(keys))}))"


# Column types by Spark type name.
COLUMN_TYPES = {
    "string": "TEXT",
    "double": "DOUBLE PRECISION",
    "date": "DATE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def column_types(df: DataFrame) -> dict[str, str]:
    """Database types of a frame's columns; decimals keep their precision."""
    types = {}
    for name, kind in df.dtypes:
        types[name] = kind.upper() if kind.startswith("decimal") else COLUMN_TYPES[kind]
    return types


def marker_statement(marker: str) -> str:
    """The table that says which batches of which job are merged."""
    return f"CREATE TABLE IF NOT EXISTS {marker} (job TEXT, batch_id BIGINT, PRIMARY KEY (job, batch_id))"


def open_connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A connection of the driver's JVM. The database driver may come from Spark's jars."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    return jvm.java.sql.DriverManager.getConnection(url, settings)


def present_columns(connection, target: str) -> list[str]:
    """The columns that a table has according to the database; none if there is no such table."""
    metadata = connection.getMetaData()
    mark = metadata.getSearchStringEscape()
    parts = target.split(".")
    # Names are patterns there, in which an underscore stands for any sign.
    found = [p.replace("_", f"{mark}_").replace("%", f"{mark}%") for p in parts[-2:]]
    schema = found[0] if len(found) > 1 else None
    rows = metadata.getColumns(None, schema, found[-1], None)
    names = []
    while rows.next():
        names.append(rows.getString("COLUMN_NAME"))
    return names


class DatabaseTable:
    """A database table with one row per key, upserted batch by batch.

    Tasks write a batch to a staging table of its own, named by job and batch, in parallel. Then one
    transaction creates or widens the target, merges the staged rows, notes the batch and drops the staging table.
    A batch that was noted is not written again, and one cut short leaves the target as it was and is
    staged anew, so every batch counts once whatever fails in between.

    Rows with a ``reason`` and rows without a key go to ``rejected`` as dead letters. ``leave_out`` names columns that
    only matter there. Columns that a batch lacks keep their values.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        target: str,
        keys: Sequence[str],
        rejected: BatchLog,
        order: Sequence[str] = (),
        job: str = "job",
        properties: Mapping[str, str] | None = None,
        leave_out: Sequence[str] = (),
    ):
        self.spark, self.url, self.target, self.keys = spark, url, target, list(keys)
        self.refused, self.order, self.job = rejected, list(order), job
        self.properties, self.leave_out = dict(properties or {}), list(leave_out)

    @property
    def _name(self) -> str:
        return ".".join(_quoted(self.target.split(".")))

    @property
    def _marker(self) -> str:
        return ".".join(_quoted([*self.target.split(".")[:-1], self.target.split(".")[-1] + "_batches"]))

    def staging(self, batch_id: int) -> str:
        plain = "".join(c if c.isalnum() else "_" for c in self.job)
        *schema, table = self.target.split(".")
        return ".".join(_quoted([*schema, f"{table}_{plain}_{batch_id}_staging"]))

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        reasons = [F.when(F.col(k).isNull(), f"no {k}") for k in self.keys]
        if REASON in df.columns:
            reasons.insert(0, F.col(REASON))
        checked = df.withColumn(REASON, F.coalesce(*reasons).cast("string"))
        letters = dead_letters(checked)
        if not letters.isEmpty():
            self.refused.write(letters, batch_id)
        if self._in_transaction(lambda connection: self._noted(connection, batch_id)):
            return
        rows = good_records(checked).drop(*self.leave_out)
        unique = latest_per_key(rows, self.keys, self.order) if self.order else rows.dropDuplicates(self.keys)
        unique.write.mode("overwrite").jdbc(self.url, self.staging(batch_id), properties=self.properties)
        types = column_types(unique)
        self._in_transaction(lambda connection: self._merge(connection, types, batch_id))

    def _in_transaction(self, work: Callable):
        connection = open_connection(self.spark, self.url, self.properties)
        try:
            connection.setAutoCommit(False)
            result = work(connection)
            connection.commit()
            return result
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _noted(self, connection, batch_id: int) -> bool:
        connection.createStatement().executeUpdate(marker_statement(self._marker))
        asked = connection.prepareStatement(f"SELECT 1 FROM {self._marker} WHERE job = ? AND batch_id = ?")
        asked.setString(1, self.job)
        asked.setLong(2, batch_id)
        return asked.executeQuery().next()

    def _merge(self, connection, types: dict[str, str], batch_id: int) -> None:
        statement = connection.createStatement()
        statement.executeUpdate(create_statement(self._name, types, self.keys))
        present = present_columns(connection, self.target)
        staging = self.staging(batch_id)
        for text in [
            *widen_statements(self._name, present or list(types), types),
            upsert_statement(self._name, staging, list(types), self.keys),
        ]:
            statement.executeUpdate(text)
        noted = connection.prepareStatement(f"INSERT INTO {self._marker} (job, batch_id) VALUES (?, ?)")
        noted.setString(1, self.job)
        noted.setLong(2, batch_id)
        noted.executeUpdate()
        statement.executeUpdate(f"DROP TABLE {staging}")

    def rejected(self) -> DataFrame | None:
        """Dead letters with reason and batch id."""
        return self.refused.read()
