"""Named queries, each with the SQL that states its result, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is looked up once per path, which saves a job per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, be it one file or a directory of them."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}.parquet}}")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``day``, ``sales`` and the arrival number ``seq``."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").withColumns(
        {"day": day, "sales": F.col("o_totalprice"), "seq": arrival_number(day)}
    )


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with ``day`` and ``sales``."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {"day": F.col("l_shipdate").cast("date"), "sales": F.col("l_extendedprice")}
    )


def arrival_number(day):
    """Arrival order of orders: up to 44 days after the order day, then by order key.

    Packs the arrival day above a 44-bit order key, so no ranking over all rows is needed.
    """
    key = F.col("o_orderkey")
    arrival = F.unix_date(F.date_add(day, (key % 45).cast("int"))).cast("bigint")
    packed = F.shiftleft(arrival, 44) + key
    return F.when(key < 2**44, packed).otherwise(
        F.raise_error(F.lit("order key needs more than 44 bits"))
    )


# SQL fragments shared by the oracles.
ORDERS_SQL = """
orders_in AS (
  SELECT *, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders)"""

LINES_SQL = """
lines_in AS (
  SELECT *, CAST(l_shipdate AS DATE) AS day, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem)"""


def months_sql(source: str, series: str = "") -> str:
    """A CTE ``months`` with ``series, month, sales, pos`` of ``source``."""
    key = f"{series}, " if series else ""
    over = f"PARTITION BY {series} " if series else ""
    return f"""
months AS (
  SELECT *, row_number() OVER ({over}ORDER BY month) AS pos FROM (
    SELECT {key}CAST(date_trunc('month', day) AS DATE) AS month,
           CAST(sum(amount) AS DOUBLE) AS sales
    FROM {source} GROUP BY {key}CAST(date_trunc('month', day) AS DATE)))"""
