"""Database tables and incremental reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.sinks.batch_log import BatchLog


def jdbc_options(
    url: str, table: str | None = None, query: str | None = None, user: str | None = None,
    password: str | None = None, split: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Options of a table or query read. ``split`` is ``(column, low, high, parts)`` for a
    parallel read; a read without it runs in one task and suits small results only."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "dbtable": table} if table else {"url": url, "query": query}
    if user:
        options.update(user=user, password=password or "")
    if split:
        column, low, high, parts = split
        options.update(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high),
            numPartitions=str(parts),
        )
    return options


def read_jdbc(spark: SparkSession, **where) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**where)).load()


def sorted_results(table: DataFrame, key: str = "date") -> DataFrame:
    return table.orderBy(F.col(key).asc())


class IncrementalReader:
    """Rows of a table with an id above the one reached by the previous delivery.

    ``log`` holds what was delivered. The mark is the greatest id in it, so a delivery that
    failed half-way does not move the mark.
    """

    def __init__(self, source: DataFrame, log: BatchLog, column: str = "id"):
        self.source, self.log, self.column = source, log, column

    def high_water(self) -> int | None:
        ids = self.log.committed()
        if not ids:
            return None
        last = self.log.read(only=ids[-1])
        return last.agg(F.max(self.column)).first()[0]

    def pending(self) -> DataFrame:
        """New rows; the comparison reaches the scan or the database as a filter."""
        mark = self.high_water()
        return self.source if mark is None else self.source.filter(F.col(self.column) > mark)

    def deliver(self) -> int | None:
        """Append the new rows as the next batch; returns its id, or None if there are none."""
        rows = self.pending()
        if rows.isEmpty():
            return None
        ids = self.log.committed()
        batch_id = ids[-1] + 1 if ids else 0
        self.log.write(rows, batch_id)
        return batch_id
