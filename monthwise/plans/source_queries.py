"""Drop directories, exports and dead letters of streams.

The given tables are first written as the files a producer would drop, then read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.config import DATE_FIELD, SALES_FIELD
from monthwise.functions.calendar import month_of, parse_day
from monthwise.operators import quality as ql
from monthwise.operators.monthly import monthly_totals
from monthwise.plans.ingest_queries import MESSAGES_SQL, order_messages
from monthwise.plans.jobs import keep_rejected
from monthwise.plans.registry import ORDERS_SQL, orders, query, table
from monthwise.session import fresh_dir
from monthwise.sinks.batch_log import BatchLog
from monthwise.sinks.export import export_csv
from monthwise.sources import dropdir
from monthwise.streaming.jobs import CsvPersistJob, run_batches


def named_files(spark: SparkSession, source: str, target: str, name: str) -> None:
    """Move the part files of ``source`` to ``target`` under the names producers use."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target))
    for k, part in enumerate(dropdir.list_files(spark, source, "part-*")):
        files.rename(path(part), path(f"{target}/{name}_{k}{part[part.index('.', part.rindex('/')):]}"))


def put_file(spark: SparkSession, target: str, data: bytes) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(data)
    stream.close()


HEADERS = (
    ["o_orderkey", DATE_FIELD, SALES_FIELD, "o_orderpriority"],
    ["o_orderpriority", SALES_FIELD, "o_orderkey", DATE_FIELD],
    [SALES_FIELD, DATE_FIELD, "o_orderkey"],
)


def mixed_files(spark, sf_dir) -> str:
    """Orders in files of three headers: two orders of the columns, and one without the priority."""
    target = fresh_dir(spark, "mixed-files")
    source = orders(spark, sf_dir).select(
        (F.col("o_orderkey") % 3).alias("kind"), F.col("o_orderkey").cast("string"),
        F.date_format("day", "yyyy-MM-dd").alias(DATE_FIELD),
        F.col("sales").cast("string").alias(SALES_FIELD), "o_orderpriority",
    )
    for k, header in enumerate(HEADERS):
        line = F.concat_ws(",", *[F.col(f"`{c}`") for c in header]).alias("line")
        lines = source.filter(F.col("kind") == k).select(line)
        part = fresh_dir(spark, "mixed-part")
        dropdir.write_lines(lines, "line", ",".join(header), part)
        named_files(spark, part, target, f"transaction_data_{k}")
    return target


MIXED_SQL = f"""WITH {ORDERS_SQL}
    SELECT CASE WHEN o_orderkey % 3 <> 2 THEN o_orderpriority END AS o_orderpriority,
      CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(amount) AS DOUBLE) AS sales
    FROM orders_in GROUP BY ALL"""


@query("csv_mixed_headers", MIXED_SQL)
def csv_mixed_headers(spark, sf_dir):
    rows = dropdir.read_csv(spark, mixed_files(spark, sf_dir))
    checked = ql.type_records(rows, DATE_FIELD, SALES_FIELD, corrupt=dropdir.MALFORMED)
    good = ql.good_records(checked)
    return monthly_totals(good, "day", "amount", ["o_orderpriority"], scale=2)


@query(
    "csv_file_quarantine",
    """SELECT 'persisted' AS outcome, count(*) AS n FROM orders
    UNION ALL SELECT 'no header', 1 UNION ALL SELECT 'unreadable file', 2""",
)
def csv_file_quarantine(spark, sf_dir):
    """Beside good files lie one with a blank line, one in another encoding and one that is cut off."""
    path = mixed_files(spark, sf_dir)
    put_file(spark, f"{path}/transaction_data_blank.csv", b"\n")
    put_file(spark, f"{path}/transaction_data_odd.csv", "Größe;é\n".encode("latin-1"))
    whole = spark._jvm.java.io.ByteArrayOutputStream()
    packed = spark._jvm.java.util.zip.GZIPOutputStream(whole)
    packed.write(b"o_orderkey,Sales\n" + b"".join(b"%d,%d\n" % (k, k * k) for k in range(20000)))
    packed.close()
    data = bytes(whole.toByteArray())
    put_file(spark, f"{path}/transaction_data_cut.csv.gz", data[: len(data) // 2])
    job = CsvPersistJob(spark, fresh_dir(spark, "persist-files"))
    job.start(dropdir.stream_files(spark, path, glob="*transaction_data*")).awaitTermination()
    kept = job.records().agg(F.count("*").alias("n")).select(F.lit("persisted").alias("outcome"), "n")
    reason = F.substring_index("reason", ":", 1).alias("outcome")
    refused = job.quarantine.read().groupBy(reason).agg(F.count("*").alias("n"))
    return kept.unionAll(refused)


@query("topic_dead_letters", f"WITH {MESSAGES_SQL} SELECT o_orderkey, reason FROM checked")
def topic_dead_letters(spark, sf_dir):
    """Every message of a stream is either used or kept with its reason."""
    root = fresh_dir(spark, "topic")
    order_messages(spark, sf_dir).write.parquet(f"{root}/messages")

    def stream() -> DataFrame:
        source = spark.readStream.schema("o_orderkey bigint, value string")
        return ql.parse_messages(source.parquet(f"{root}/messages"))

    used = BatchLog(spark, f"{root}/used")
    run_batches(ql.good_records(stream()), used.write, f"{root}/checkpoint").awaitTermination()
    keep_rejected(ql.dead_letters(stream()), root).awaitTermination()
    good = used.read().select("o_orderkey", F.lit(None).cast("string").alias("reason"))
    return good.unionAll(BatchLog(spark, f"{root}/rejected").read().select("o_orderkey", "reason"))


@query(
    "csv_semicolon_latin1",
    """SELECT n_name || ' é;ü' AS name, count(*) AS customers, sum(c_custkey)::BIGINT AS keys
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def csv_semicolon_latin1(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = named.select("c_custkey", F.concat("n_name", F.lit(" é;ü")).alias("Name"))
    part, target = fresh_dir(spark, "latin-part"), fresh_dir(spark, "latin-files")
    rows.write.options(sep=";", encoding="ISO-8859-1", header="true").csv(part)
    named_files(spark, part, target, "transaction_data")
    back = dropdir.read_csv(spark, target, sep=dropdir.SEMICOLON, encoding="ISO-8859-1")
    return back.groupBy(F.col("Name").alias("name")).agg(
        F.count("*").alias("customers"), F.sum(F.col("c_custkey").cast("bigint")).alias("keys")
    )


@query(
    "typed_csv_rows",
    "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events",
)
def typed_csv_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_type", "value", "event_id", "user_id", F.col("ts").cast("date").alias("day")
    )
    part = fresh_dir(spark, "typed-files")
    events.write.options(header="true").csv(part)
    schema = T._parse_datatype_string(
        "event_id bigint, user_id bigint, event_type string, value double, day date"
    )
    rows = dropdir.read_csv(spark, part, schema, glob="*.csv")
    return rows.filter(F.col(dropdir.MALFORMED).isNull()).select(*schema.names)


@query(
    "typed_csv_records",
    """SELECT event_id, user_id, event_type, epoch_us(ts) AS at_us,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount, event_type = 'error' AS malformed
    FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, true FROM events WHERE event_type = 'error'""",
)
def typed_csv_records(spark, sf_dir):
    """A declared schema of long, string, timestamp and decimal; errors have a word for the amount and
    so are malformed lines."""
    error = F.col("event_type") == "error"
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("last_login"), "event_type",
        F.when(error, "none").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("amount"),
        "event_id", "user_id",
    )
    part = fresh_dir(spark, "typed-records")
    events.write.options(header="true", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(part)
    schema = T._parse_datatype_string(
        "event_id bigint, user_id bigint, event_type string, last_login timestamp, amount decimal(18,2)"
    )
    rows = dropdir.read_csv(spark, part, schema, glob="*.csv")
    broken = F.col(dropdir.MALFORMED).isNotNull()
    written = F.split(F.col(dropdir.MALFORMED), ",")
    known = {
        "user_id": F.col("user_id"), "event_type": F.col("event_type"),
        "at_us": F.unix_micros("last_login"), "amount": F.col("amount").cast("string"),
    }
    return rows.select(
        F.coalesce("event_id", F.get(written, F.lit(3)).try_cast("bigint")).alias("event_id"),
        *[F.when(~broken, column).alias(name) for name, column in known.items()],
        broken.alias("malformed"),
    )


@query(
    "csv_archived",
    "SELECT o_orderkey, o_totalprice AS sales, true AS persisted FROM orders",
)
def csv_archived(spark, sf_dir):
    """Files that were read lie in the archive, whole, and nowhere else; their records are in the table."""
    path, done = mixed_files(spark, sf_dir), fresh_dir(spark, "archive")
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    job = CsvPersistJob(session, fresh_dir(spark, "archived"))
    for last in (False, True):
        # A batch's files are moved when the stream goes on, so a last file without records follows.
        if last:
            put_file(spark, f"{path}/transaction_data_last.csv", b"o_orderkey,Sales\n")
        files = dropdir.stream_files(session, path, archive_dir=done)
        job.start(files).awaitTermination()
    kept = job.records().select(F.col("o_orderkey").alias("persisted_key"))
    left = [f for f in dropdir.list_files(spark, path) if not f.endswith("_last.csv")]
    if left:
        raise ValueError(f"files that were not moved: {left}")
    archived = dropdir.read_csv(spark, archived_folder(spark, done))
    rows = archived.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.col(SALES_FIELD).try_cast("double").alias("sales"), F.col("o_orderkey").alias("key"),
    )
    joined = rows.join(kept, F.col("key") == F.col("persisted_key"), "left")
    return joined.select("o_orderkey", "sales", F.col("persisted_key").isNotNull().alias("persisted"))


def archived_folder(spark: SparkSession, root: str) -> str:
    """The one folder below ``root`` that holds files: the archive repeats the path of the source."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    while True:
        inside = files.listStatus(path)
        if len(inside) != 1 or not inside[0].isDirectory():
            return path.toString()
        path = inside[0].getPath()


def event_lines(spark, sf_dir) -> str:
    """Events as JSON lines; those of type error are cut short."""
    events = table(spark, sf_dir, "events")
    text = F.to_json(F.struct("event_id", "user_id", "value"))
    text = F.when(F.col("event_type") == "error", F.substring(text, 1, 12)).otherwise(text)
    path = fresh_dir(spark, "json-lines")
    events.select(text.alias("value")).write.text(path)
    return path


@query(
    "json_rows",
    """SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN value END AS value,
       event_type = 'error' AS broken FROM events""",
)
def json_rows(spark, sf_dir):
    schema = T._parse_datatype_string("event_id bigint, user_id bigint, value double")
    rows = dropdir.json_records(spark, event_lines(spark, sf_dir), schema, glob="*.txt")
    broken = F.col(dropdir.MALFORMED).isNotNull()
    fields = [F.when(~broken, F.col(c)).alias(c) for c in ("event_id", "value")]
    return rows.select(*fields, broken.alias("broken"))


@query(
    "json_variant_rows",
    "SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events",
)
def json_variant_rows(spark, sf_dir):
    rows = dropdir.json_variants(spark, event_lines(spark, sf_dir), glob="*.txt")
    return rows.select(F.try_variant_get("record", "$.user_id", "bigint").alias("user_id"))


@query("text_rows", "SELECT p_name AS value FROM part")
def text_rows(spark, sf_dir):
    path = fresh_dir(spark, "text-lines")
    table(spark, sf_dir, "part").select("p_name").write.text(path)
    return dropdir.text_lines(spark, path, glob="*.txt").select("value")


@query(
    "log_files",
    """SELECT event_type AS kind, count(*) AS n, sum(event_id)::BIGINT AS ids
    FROM events WHERE event_type <> 'error' GROUP BY 1
    UNION ALL SELECT 'no fields line', count(*), NULL FROM events WHERE event_type = 'error'""",
)
def log_files(spark, sf_dir):
    """Gzip log files, several for each kind of event; those of errors lack the fields line."""
    target = fresh_dir(spark, "log-files")
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    for kind in [r[0] for r in events.select("event_type").distinct().collect()]:
        part = fresh_dir(spark, "log-part")
        lines = events.filter(F.col("event_type") == kind).select(
            F.concat_ws(" ", F.col("event_id").cast("string"), "event_type").alias("line")
        )
        header = "#Comment: x" if kind == "error" else "#Fields: id kind"
        dropdir.write_lines(lines.repartition(4), "line", header, part, compression="gzip")
        named_files(spark, part, target, kind)
    rows = dropdir.parse_log(
        dropdir.log_lines(spark, target), {"id": "bigint", "kind": "string"}
    )
    return rows.groupBy(F.coalesce("kind", "reason").alias("kind")).agg(
        F.count("*").alias("n"), F.sum("id").alias("ids")
    )


@query(
    "export_round_trip",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders
    FROM orders GROUP BY 1""",
)
def export_round_trip(spark, sf_dir):
    months = orders(spark, sf_dir).groupBy(month_of(F.col("day")).alias("month")).agg(
        F.count("*").alias("orders")
    )
    path = fresh_dir(spark, "export")
    export_csv(months.withColumnRenamed("month", "date"), path)
    rows = dropdir.read_csv(spark, path, glob="*.csv")
    return rows.select(
        parse_day(F.col("date"), ["yyyy-MM-dd"]).alias("month"), F.col("orders").cast("bigint")
    )
