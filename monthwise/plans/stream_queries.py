"""Streaming jobs run to the end of the given tables.

Most take all input in one micro-batch, so what is closed and what stays open is settled by the data
alone; the ``stream_batches`` queries take a file at a time, and SQL states what each batch may still
count. State and results live in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.config import DATE_FIELD, SALES_FIELD
from monthwise.operators import quality as ql
from monthwise.operators.models import oldest_feature
from monthwise.plans.forecast_queries import ahead_sql, result_sql
from monthwise.operators.monthly import monthly_totals
from monthwise.plans.ingest_queries import CSV_HEADER, LINES_CHECKED_SQL, write_order_files
from monthwise.plans.registry import ORDERS_SQL, months_sql, orders, query, stream_table
from monthwise.plans.replay_queries import REPLAY_SQL
from monthwise.plans.source_queries import MIXED_SQL, mixed_files
from monthwise.session import fresh_dir, state_session
from monthwise.sinks.batch_log import BatchLog
from monthwise.sources import dropdir
from monthwise.streaming.exact import ExactMonthJob
from monthwise.streaming.jobs import CsvJob, ForecastJob, PersistJob, run_batches
from monthwise.streaming.months import closed_month_stream

PRIORITY = ["o_orderpriority"]
STATE_PARTITIONS = 8  # the state is one sum for each of five priorities and open month
BUCKETS = 4  # of the five series' latest months and results

SETTLED_SQL = f"""
{ORDERS_SQL},
settled_in AS (
  SELECT * FROM orders_in WHERE date_trunc('month', day) + INTERVAL 1 MONTH + INTERVAL 1 DAY
    <= (SELECT max(day) FROM orders_in))"""


def order_stream(spark, sf_dir):
    return stream_table(
        state_session(spark, STATE_PARTITIONS), sf_dir, "orders"
    ).select(
        "o_orderkey",
        *PRIORITY,
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").alias("sales"),
    )


@query(
    "stream_closed_months",
    f"WITH {SETTLED_SQL}, {months_sql('settled_in', 'o_orderpriority')} "
    "SELECT o_orderpriority, month, sales FROM months",
)
def stream_closed_months(spark, sf_dir):
    root = fresh_dir(spark, "closed-months")
    log = BatchLog(spark, f"{root}/months")
    closed = closed_month_stream(order_stream(spark, sf_dir), series=PRIORITY, scale=2)
    run_batches(closed, log.write, f"{root}/checkpoint").awaitTermination()
    return log.read().drop("batch_id")


@query(
    "stream_forecast_table",
    f"WITH {SETTLED_SQL}, {months_sql('settled_in', 'o_orderpriority')}, "
    f"{ahead_sql('months', 'o_orderpriority', 'compat')} "
    f"{result_sql('months', 'o_orderpriority', 'o_orderpriority,')}",
)
def stream_forecast_table(spark, sf_dir):
    closed = closed_month_stream(order_stream(spark, sf_dir), series=PRIORITY, scale=2)
    job = ForecastJob(
        spark, fresh_dir(spark, "forecast"), oldest_feature(), "compat", PRIORITY, buckets=BUCKETS
    )
    job.start(closed).awaitTermination()
    result = job.results.read()
    return result.select(*PRIORITY, "date", "sales", (F.col("step") > 0).alias("is_forecast"))


# Orders arriving up to 880 days late, year by year: as many files as a micro-batch takes for each year of arrival. A batch
# drops what was late under the watermark its predecessor ran with, so what it may still count was
# settled by the days seen two batches before and earlier.
BATCHED_SQL = f"""
{ORDERS_SQL},
arrived AS (SELECT *, year(day + CAST(o_orderkey % 45 * 20 AS INTEGER)) AS batch FROM orders_in),
seen AS (SELECT batch, max(max(day)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                AND 2 PRECEDING) AS latest FROM arrived GROUP BY batch),
settled_in AS (
  SELECT arrived.* FROM arrived JOIN seen USING (batch)
  WHERE (latest IS NULL OR date_trunc('month', day) + INTERVAL 1 MONTH + INTERVAL 1 DAY > latest)
    AND date_trunc('month', day) + INTERVAL 1 MONTH + INTERVAL 1 DAY
      <= (SELECT max(day) FROM orders_in))"""


FILES = 4  # of a year, written and read by as many tasks


def yearly_job(spark, sf_dir) -> ForecastJob:
    """Forecasts from orders that arrive in several micro-batches, late ones among them."""
    path = fresh_dir(spark, "arrivals")
    source = orders(spark, sf_dir).select("o_orderkey", *PRIORITY, "day", "sales")
    arrival = F.date_add("day", (F.col("o_orderkey") % 45 * 20).cast("int"))
    source = source.withColumn("batch", F.year(arrival))
    for row in source.select("batch").distinct().orderBy("batch").collect():
        year = source.filter(F.col("batch") == row["batch"]).drop("batch")
        year.repartition(FILES).write.mode("append").parquet(path)
    session = state_session(spark, STATE_PARTITIONS)
    stream = session.readStream.schema(source.drop("batch").schema)
    stream = stream.option("maxFilesPerTrigger", FILES).parquet(path)
    closed = closed_month_stream(stream, series=PRIORITY, scale=2)
    job = ForecastJob(
        spark, fresh_dir(spark, "yearly"), oldest_feature(), "compat", PRIORITY, buckets=BUCKETS
    )
    job.start(closed).awaitTermination()
    return job


@query(
    "stream_batches_closed",
    f"WITH {BATCHED_SQL}, {months_sql('settled_in', 'o_orderpriority')} "
    "SELECT o_orderpriority, month, sales FROM months",
)
def stream_batches_closed(spark, sf_dir):
    return yearly_job(spark, sf_dir).months.read().drop("batch_id")


@query(
    "stream_batches_forecast",
    f"WITH {BATCHED_SQL}, {months_sql('settled_in', 'o_orderpriority')}, "
    f"{ahead_sql('months', 'o_orderpriority', 'compat')} "
    f"{result_sql('months', 'o_orderpriority', 'o_orderpriority,')}",
)
def stream_batches_forecast(spark, sf_dir):
    result = yearly_job(spark, sf_dir).results.read()
    return result.select(*PRIORITY, "date", "sales", (F.col("step") > 0).alias("is_forecast"))


def csv_job(spark, sf_dir) -> PersistJob:
    """Drop files with damaged lines, through the CSV stream into the keyed table."""
    path = write_order_files(spark, sf_dir)
    columns = CSV_HEADER.split(",")
    # Column names of the files hold blanks; the table's do not.
    renamed = {c: c.lower().replace(" ", "_") for c in columns}
    root = fresh_dir(spark, "persist")
    job = PersistJob(spark, root, list(renamed.values()))

    def checked(rows, batch_id):
        typed = ql.type_records(
            rows, DATE_FIELD, SALES_FIELD, corrupt=dropdir.MALFORMED, sales_required=True
        )
        job.handle(typed.withColumnsRenamed(renamed), batch_id)

    files = dropdir.stream_files(spark, path, glob="*.csv")
    CsvJob(spark, f"{root}/files", checked).start(files).awaitTermination()
    return job


REQUIRED_SQL = f"""
{LINES_CHECKED_SQL},
required AS (SELECT * REPLACE (coalesce(reason, CASE WHEN amount IS NULL THEN 'bad sales' END)
                               AS reason) FROM checked)"""


@query(
    "stream_persisted_records",
    f"""WITH {REQUIRED_SQL}
    SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS order_date, CAST(amount AS VARCHAR) AS sales,
           o_orderpriority FROM required WHERE reason IS NULL""",
)
def stream_persisted_records(spark, sf_dir):
    persisted = csv_job(spark, sf_dir).records()
    key = F.col("o_orderkey").try_cast("bigint").alias("o_orderkey")
    return persisted.select(key, "order_date", "sales", "o_orderpriority")


@query(
    "stream_dead_letters",
    f"WITH {REQUIRED_SQL} SELECT o_orderkey, reason FROM required WHERE reason IS NOT NULL",
)
def stream_dead_letters(spark, sf_dir):
    rejected = csv_job(spark, sf_dir).rejected()
    return rejected.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "reason")


def exact_job(spark, sf_dir, series=()) -> ExactMonthJob:
    """Orders in the order of their arrival, cut into a stream run for each two years of it."""
    source = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day", "sales", "seq")
    arrival = F.date_from_unix_date(F.shiftright("seq", 44).cast("int"))
    source = source.withColumn("cut", F.floor(F.year(arrival) / 2))
    job = ExactMonthJob(spark, fresh_dir(spark, "exact"), series, scale=2)
    path = fresh_dir(spark, "arrivals")
    schema = source.drop("cut").schema
    for row in source.select("cut").distinct().orderBy("cut").collect():
        part = source.filter(F.col("cut") == row["cut"]).drop("cut")
        part.write.mode("append").parquet(path)
        job.start(spark.readStream.schema(schema).parquet(path)).awaitTermination()
    return job


@query(
    "stream_exact_months",
    f"""WITH {REPLAY_SQL}
    SELECT o_custkey, month, CAST(sum(amount) AS DOUBLE) AS sales
    FROM arrivals JOIN fire USING (month) WHERE pos <= fire_pos GROUP BY o_custkey, month""",
)
def stream_exact_months(spark, sf_dir):
    """The watermark moves with every record, as in the batch replay."""
    return exact_job(spark, sf_dir, ["o_custkey"]).months()


@query(
    "stream_late_records",
    f"""WITH {REPLAY_SQL}
    SELECT o_orderkey, month, o_totalprice AS sales
    FROM arrivals JOIN fire USING (month) WHERE pos > fire_pos""",
)
def stream_late_records(spark, sf_dir):
    return exact_job(spark, sf_dir).late_records().select("o_orderkey", "month", "sales")


@query("stream_mixed_headers", MIXED_SQL)
def stream_mixed_headers(spark, sf_dir):
    """Files of three headers through the stream, a few in each batch, columns by name."""
    root = fresh_dir(spark, "mixed-stream")
    log = BatchLog(spark, f"{root}/records", merge_every=4)

    def keep(rows, batch_id):
        checked = ql.type_records(rows, DATE_FIELD, SALES_FIELD, corrupt=dropdir.MALFORMED)
        log.write(ql.good_records(checked).select("day", "amount", *PRIORITY), batch_id)

    # A batch may hold files without the priority only, so the columns are declared.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CSV_HEADER.split(",")])
    files = dropdir.stream_files(spark, mixed_files(spark, sf_dir), files_per_batch=5)
    CsvJob(spark, root, keep, schema).start(files).awaitTermination()
    return monthly_totals(log.read(), "day", "amount", PRIORITY, scale=2)
