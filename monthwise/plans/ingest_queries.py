"""Parsing, quarantine, routing, keys and keyed tables.

The given tables hold typed values. These queries first write them as the texts a producer
would send, damaged for some kinds of rows, and then read those.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from monthwise.config import DATE_FIELD, SALES_FIELD
from monthwise.functions.calendar import month_of, parse_day
from monthwise.functions.text import record_key
from monthwise.operators import quality as ql
from monthwise.operators.latest import latest_per_key
from monthwise.operators.monthly import monthly_totals
from monthwise.plans.registry import orders, query, table
from monthwise.session import fresh_dir
from monthwise.sinks.batch_log import BatchLog
from monthwise.sinks.keyed_table import KeyedTable
from monthwise.sources import dropdir
from monthwise.sources.tables import IncrementalReader


@query(
    "event_props_parsed",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events",
)
def event_props_parsed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    props = F.from_json("props", "k string")
    return events.select("event_id", props["k"].try_cast("bigint").alias("k"), "value")


def order_messages(spark, sf_dir):
    """Orders as messages. Status P brings damage that depends on the priority; in priority
    3-MEDIUM all days of month are written as 31."""
    source = orders(spark, sf_dir)
    damaged = F.col("o_orderstatus") == "P"
    priority = F.substring("o_orderpriority", 1, 1)
    date = F.date_format("day", "yyyy-MM-dd")
    date = (
        F.when(priority == "3", F.concat(F.substring(date, 1, 8), F.lit("31")))
        .when(damaged & (priority == "1"), F.date_format("day", "yyyy-'13'-dd"))
        .otherwise(date)
    )
    sales = F.when(damaged & (priority == "2"), "abc").otherwise(F.col("sales").cast("string"))
    payload = F.struct(
        date.alias(DATE_FIELD), sales.alias(SALES_FIELD), F.col("o_orderpriority").alias("Kind")
    )
    text = F.to_json(F.struct(F.struct(F.lit("struct").alias("type")).alias("schema"),
                              payload.alias("payload")))
    text = (
        F.when(damaged & (priority == "4"), F.substring(text, 1, 20))
        .when(damaged & (priority == "5"), '{"schema":{}}')
        .otherwise(text)
    )
    return source.select("o_orderkey", text.alias("value"))


MESSAGES_SQL = """
checked AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority[1:1] = '3' THEN last_day(CAST(o_orderdate AS DATE))
         ELSE CAST(o_orderdate AS DATE) END AS day,
    o_totalprice AS sales,
    CASE WHEN o_orderstatus <> 'P' THEN NULL
         ELSE CASE o_orderpriority[1:1] WHEN '1' THEN 'bad date' WHEN '2' THEN 'bad sales'
              WHEN '4' THEN 'no payload' WHEN '5' THEN 'no payload' END END AS reason
  FROM orders)"""


@query(
    "messages_parsed",
    f"WITH {MESSAGES_SQL} SELECT o_orderkey, day, sales FROM checked WHERE reason IS NULL",
)
def messages_parsed(spark, sf_dir):
    checked = ql.parse_messages(order_messages(spark, sf_dir))
    return ql.good_records(checked).select("o_orderkey", "day", "sales")


@query(
    "message_dead_letters",
    f"WITH {MESSAGES_SQL} SELECT o_orderkey, reason FROM checked WHERE reason IS NOT NULL",
)
def message_dead_letters(spark, sf_dir):
    checked = ql.parse_messages(order_messages(spark, sf_dir))
    return ql.dead_letters(checked).select("o_orderkey", "reason")


@query(
    "amounts_beyond_bound",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 5 THEN 'bad sales' END AS reason,
       CASE WHEN o_orderkey % 7 > 4 THEN o_totalprice END AS sales FROM orders""",
)
def amounts_beyond_bound(spark, sf_dir):
    """Amounts that exact sums can't take are dead letters, and none of the others is lost."""
    kind = F.col("o_orderkey") % 7
    odd = F.element_at(
        F.array(*[F.lit(t) for t in ("1e17", "-9.3e16", "NaN", "Infinity", "1e400")]),
        (F.least(kind, F.lit(4)) + 1).cast("int"),
    )
    records = orders(spark, sf_dir).select(
        "o_orderkey", F.date_format("day", "yyyy-MM-dd").alias(DATE_FIELD),
        F.when(kind < 5, odd).otherwise(F.col("sales").cast("string")).alias(SALES_FIELD),
    )
    checked = ql.type_records(records, DATE_FIELD, SALES_FIELD)
    return checked.select("o_orderkey", "reason", F.col("amount").alias("sales"))


CSV_HEADER = f"o_orderkey,{DATE_FIELD},{SALES_FIELD},o_orderpriority"


def order_lines(spark, sf_dir):
    """Orders as CSV lines, with status P damaged in a way that depends on the priority."""
    source = orders(spark, sf_dir)
    damaged = F.col("o_orderstatus") == "P"
    priority = F.substring("o_orderpriority", 1, 1)
    key, day = F.col("o_orderkey").cast("string"), F.date_format("day", "yyyy-MM-dd")
    sales, kind = F.col("sales").cast("string"), F.col("o_orderpriority")
    line = (
        F.when(~damaged, F.concat_ws(",", key, day, sales, kind))
        .when(priority == "1", F.concat_ws(",", key, day, F.lit(""), kind))
        .when(priority == "2", F.concat_ws(",", key, day, F.lit('""'), kind))
        .when(priority == "3", F.concat_ws(",", key, F.date_format("day", "dd.MM.yyyy"), sales, kind))
        .when(priority == "4", F.concat_ws(",", key, day, sales, kind, F.lit("surplus")))
        .otherwise(F.concat_ws(",", key, day))
    )
    return source.select(line.alias("line"))


def write_order_files(spark, sf_dir) -> str:
    path = fresh_dir(spark, "order-files")
    dropdir.write_lines(order_lines(spark, sf_dir), "line", CSV_HEADER, path)
    return path


LINES_CHECKED_SQL = """
checked AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority[1:1] = '1' THEN NULL
         ELSE o_totalprice END AS amount,
    CASE WHEN o_orderstatus <> 'P' THEN NULL
         ELSE CASE o_orderpriority[1:1] WHEN '2' THEN 'bad sales' WHEN '3' THEN 'bad date'
              WHEN '4' THEN 'malformed line' WHEN '5' THEN 'malformed line' END END AS reason
  FROM orders)"""


def checked_order_files(spark, sf_dir):
    rows = dropdir.read_csv(spark, write_order_files(spark, sf_dir), glob="*.csv")
    return ql.type_records(rows, DATE_FIELD, SALES_FIELD, corrupt=dropdir.MALFORMED)


@query(
    "csv_monthly_sales",
    f"""WITH {LINES_CHECKED_SQL}
    SELECT CAST(date_trunc('month', day) AS DATE) AS month,
           coalesce(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS sales
    FROM checked WHERE reason IS NULL GROUP BY 1""",
)
def csv_monthly_sales(spark, sf_dir):
    good = ql.good_records(checked_order_files(spark, sf_dir))
    return monthly_totals(good, "day", "amount", scale=2, skip_nan=True)


@query(
    "csv_dead_letters",
    f"WITH {LINES_CHECKED_SQL} SELECT o_orderkey, reason FROM checked WHERE reason IS NOT NULL",
)
def csv_dead_letters(spark, sf_dir):
    bad = ql.dead_letters(checked_order_files(spark, sf_dir))
    return bad.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "reason")


@query("day_patterns", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def day_patterns(spark, sf_dir):
    """Each priority writes its dates in its own way; one list of patterns reads them all."""
    patterns = ["yyyy-MM-dd", "dd.MM.yyyy", "yyyyMMdd", "MM/dd/yyyy", "d MMM yyyy"]
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    text = F.coalesce(
        *[F.when(priority == i + 1, F.date_format("day", p)) for i, p in enumerate(patterns)]
    )
    written = orders(spark, sf_dir).select("o_orderkey", text.alias("text"))
    return written.select("o_orderkey", parse_day(F.col("text"), patterns).alias("day"))


TOPIC_SQL = """
topics AS (
  SELECT event_id, event_type || CASE WHEN value < 5 THEN '_results' WHEN value < 20
    THEN '_persist' WHEN value < 50 THEN '_results_old' ELSE '' END AS topic FROM events)"""


@query(
    "topic_routing",
    f"""WITH {TOPIC_SQL}
    SELECT event_id, topic, 'results' AS sink FROM topics WHERE regexp_full_match(topic, '.*?results')
    UNION ALL
    SELECT event_id, topic, 'persist' FROM topics WHERE regexp_full_match(topic, '.*?persist')""",
)
def topic_routing(spark, sf_dir):
    suffix = (
        F.when(F.col("value") < 5, "_results")
        .when(F.col("value") < 20, "_persist")
        .when(F.col("value") < 50, "_results_old")
        .otherwise("")
    )
    topics = table(spark, sf_dir, "events").select(
        "event_id", F.concat("event_type", suffix).alias("topic")
    )
    results = ql.route(topics, ".*?results").withColumn("sink", F.lit("results"))
    persist = ql.route(topics, ".*?persist").withColumn("sink", F.lit("persist"))
    return results.unionByName(persist)


LOG_FIELDS = {"id": "bigint", "user": "bigint", "amount": "double", "kind": "string"}


@query(
    "log_rows",
    """SELECT 'log-' || event_type AS source_file, event_id AS id, user_id AS "user",
       CASE WHEN value >= 100 THEN NULL ELSE value END AS amount,
       event_type || ' "' || props[3:3] || '"' AS kind
    FROM events""",
)
def log_rows(spark, sf_dir):
    """Events as extended-log files, one per event type, whose columns come in two orders."""
    events = table(spark, sf_dir, "events")
    errors_first = F.col("event_type") == "error"
    amount = F.when(F.col("value") >= 100, "-").otherwise(F.col("value").cast("string"))
    kind = F.concat(
        F.lit('"'), "event_type", F.lit(' ""'), F.substring("props", 3, 1), F.lit('"""')
    )
    parts = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), amount, kind]
    line = F.when(errors_first, F.concat_ws("\t", *reversed(parts))).otherwise(
        F.concat_ws(" ", *parts)
    )
    file = F.concat(F.lit("log-"), "event_type").alias("source_file")
    records = events.select(file, line.alias("value"))
    fields = F.when(errors_first, "#Fields: kind amount user id").otherwise(
        "#Fields: id user amount kind"
    )
    comments = events.select(file, F.explode(F.array(F.lit("#Version: 1.0"), fields)).alias("value"))
    lines = records.unionByName(comments.distinct())
    return dropdir.parse_log(lines, LOG_FIELDS).select("source_file", *LOG_FIELDS)


@query(
    "record_keys",
    """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderdate":"'
      || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderkey":' || o_orderkey
      || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus
      || '","o_totalprice":' || CAST(o_totalprice AS VARCHAR) || '}') AS postgres_pk
    FROM orders""",
)
def record_keys(spark, sf_dir):
    records = order_records(spark, sf_dir)
    return records.select("o_orderkey", record_key(records).alias("postgres_pk"))


def order_records(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query(
    "redelivered_records",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
       o_orderpriority, o_orderstatus FROM orders""",
)
def redelivered_records(spark, sf_dir):
    """Finished orders arrive twice and end up once."""
    records = order_records(spark, sf_dir)
    records = records.withColumn("postgres_pk", record_key(records))
    persisted = KeyedTable(spark, fresh_dir(spark, "redelivered"), ["postgres_pk"])
    persisted.upsert(records, 0)
    persisted.upsert(records.filter(F.col("o_orderstatus") == "F"), 1)
    return persisted.read().drop("postgres_pk")


FOLDS = 4


@query(
    "upsert_folded",
    f"""SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice,
       arg_max(o_orderpriority, o_orderkey) AS o_orderpriority, arg_max(o_orderkey % {FOLDS}, o_orderkey) AS part
    FROM orders GROUP BY o_custkey""",
)
def upsert_folded(spark, sf_dir):
    """Several upserts, each folded at once into the buckets it touches; the last order of a customer stays."""
    source = orders(spark, sf_dir).select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority",
        (F.col("o_orderkey") % FOLDS).alias("part"),
    )
    target = KeyedTable(
        spark, fresh_dir(spark, "folded"), ["o_custkey"], ["o_orderkey"], compact_every=1, buckets=8
    )
    # An earlier batch may bring later orders, so each row is resolved against those before it.
    for part in range(FOLDS):
        batch = source.filter(F.col("part") == part)
        known = target.read()
        target.upsert(batch if known is None else batch.unionByName(known), part)
    return target.read()


@query(
    "upsert_widened",
    """WITH returned AS (
      SELECT l_orderkey, count(*) AS returned_lines FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY l_orderkey)
    SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, o_totalprice,
      CASE WHEN returned_lines IS NOT NULL THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
      returned_lines
    FROM orders FULL JOIN returned ON o_orderkey = l_orderkey""",
)
def upsert_widened(spark, sf_dir):
    """The second batch sets one known and one new column and leaves the price alone."""
    target = KeyedTable(
        spark, fresh_dir(spark, "widened"), ["o_orderkey"], merge_columns=True
    )
    target.upsert(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), 0
    )
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    returned = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("returned_lines"), F.lit("R").alias("o_orderstatus")
    )
    target.upsert(returned, 1)
    target.compact()
    return target.read()


@query(
    "latest_per_key",
    """SELECT user_id, arg_max(event_id, event_id) AS event_id,
       arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
    FROM events GROUP BY user_id""",
)
def latest_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["event_id"], unique_order=True)


@query(
    "incremental_rows",
    "SELECT event_id, value, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END "
    "::BIGINT AS batch_id FROM events",
)
def incremental_rows(spark, sf_dir):
    """Two deliveries: the table as it was in mid-January, then what was added since."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    log = BatchLog(spark, fresh_dir(spark, "delivered"))
    earlier = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    IncrementalReader(earlier, log, "event_id").deliver()
    IncrementalReader(events, log, "event_id").deliver()
    return log.read().select("event_id", "value", "batch_id")


@query(
    "monthly_preview",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS records
    FROM orders GROUP BY 1 ORDER BY 1 LIMIT 5""",
)
def monthly_preview(spark, sf_dir):
    """The first five months, the one place where a limit is the point."""
    months = orders(spark, sf_dir).groupBy(month_of(F.col("day")).alias("month"))
    return months.agg(F.count(F.lit(1)).alias("records")).orderBy("month").limit(5)
