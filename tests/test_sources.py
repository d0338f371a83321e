import datetime as dt
import gzip
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from monthwise.config import DATE_FIELD, SALES_FIELD, PipelineConfig
from monthwise.operators import quality as ql
from monthwise.sinks.batch_log import BatchLog
from monthwise.sources import dropdir, tables, topics

HEADER = "Row ID,Order Date,Sales,Note\n"


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))


def test_csv_nulls_and_misfit_lines(spark, tmp_path):
    put(tmp_path / "in", "a_transaction_data_1.csv",
        HEADER + '1,2014-01-03,16.448,x\n2,2014-01-04,,y\n3,2014-01-05,"",z\n'
        "4,2014-01-06,1,x,more\n5,2014-01-07\n6,2014-13-01,1,x\n7,2014-01-08,abc,x\n")
    put(tmp_path / "in", "other.csv", HEADER + "9,2014-01-01,1,x\n")
    rows = dropdir.read_csv(spark, str(tmp_path / "in"))
    assert rows.columns == ["Row ID", DATE_FIELD, SALES_FIELD, "Note", "malformed", "source_file"]
    raw = {r["Row ID"]: r for r in rows.collect()}
    assert sorted(raw) == list("1234567")
    assert raw["2"]["Sales"] is None and raw["3"]["Sales"] == ""
    assert raw["1"]["source_file"].endswith("a_transaction_data_1.csv")

    checked = ql.type_records(rows, DATE_FIELD, SALES_FIELD, corrupt=dropdir.MALFORMED)
    reasons = {r["Row ID"]: r.reason for r in checked.select("Row ID", "reason").collect()}
    assert reasons == {"1": None, "2": None, "3": "bad sales", "4": "malformed line",
                       "5": "malformed line", "6": "bad date", "7": "bad sales"}
    strict = ql.type_records(rows, DATE_FIELD, SALES_FIELD, corrupt="malformed", sales_required=True)
    assert ql.good_records(strict).count() == 1
    assert ql.dead_letters(strict).count() == 6


def test_csv_separator_encoding_and_invalid_file(spark, tmp_path):
    put(tmp_path / "in", "transaction_data.csv",
        HEADER.replace(",", ";") + "1;2014-01-03;1.5;Zürich\n", "iso-8859-1")
    options = {"sep": dropdir.SEMICOLON, "encoding": "ISO-8859-1"}
    schema = dropdir.header_schema(spark, str(tmp_path / "in"), **options)
    assert schema.names == ["Row ID", "Order Date", "Sales", "Note"]
    assert {f.dataType for f in schema} == {T.StringType()}
    put(tmp_path / "in", "transaction_data_bad.csv", "only; two\n;so;it;ends;up;elsewhere;\n")
    rows = dropdir.read_csv(spark, str(tmp_path / "in"), schema, **options)
    checked = ql.type_records(rows, DATE_FIELD, SALES_FIELD, corrupt=dropdir.MALFORMED)
    good = ql.good_records(checked).collect()
    assert [(r.Note, r.amount) for r in good] == [("Zürich", 1.5)]
    bad = ql.dead_letters(checked).select("reason", "source_file").collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("_bad.csv")


def run_once(stream, root, name):
    log = BatchLog(stream.sparkSession, f"{root}/{name}")
    query = (
        stream.writeStream.foreachBatch(log.write)
        .option("checkpointLocation", f"{root}/{name}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return log


def csv_log(spark, folder, root, **options):
    """Run a CSV stream over the files there are, each a batch, into a log."""
    from monthwise.streaming.jobs import CsvJob

    log = BatchLog(spark, f"{root}/log")
    schema, glob = options.pop("schema", None), options.pop("glob", dropdir.FILE_GLOB)
    job = CsvJob(spark, f"{root}/job", log.write, schema)
    files = dropdir.stream_files(spark, str(folder), glob, files_per_batch=1, **options)
    job.start(files).awaitTermination()
    return log, job


def test_csv_stream_takes_each_file_once_and_archives(spark, tmp_path):
    put(tmp_path / "in", "transaction_data_1.csv", HEADER + "1,2014-01-03,1,x\n")
    archive = {"archive_dir": str(tmp_path / "done")}
    csv_log(spark, tmp_path / "in", tmp_path, **archive)
    put(tmp_path / "in", "transaction_data_2.csv", HEADER + "2,2014-01-04,2,y\n")
    put(tmp_path / "in", "ignored.csv", HEADER + "3,2014-01-04,2,y\n")
    log, _ = csv_log(spark, tmp_path / "in", tmp_path, **archive)
    rows = log.read().collect()
    assert sorted((r["Row ID"], r.batch_id) for r in rows) == [("1", 0), ("2", 1)]
    archived = [p.name for p in (tmp_path / "done").rglob("*.csv")]
    assert "transaction_data_1.csv" in archived


def test_csv_stream_goes_by_names(spark, tmp_path):
    put(tmp_path / "in", "transaction_data_1.csv", "Order Date,Sales,Cost\n2020-01-01,5,900\n")
    put(tmp_path / "in", "transaction_data_2.csv", "Order Date,Cost,Sales\n2020-01-02,900,5\n")
    put(tmp_path / "in", "transaction_data_3.csv", "Sales,Order Date\n5,2020-01-03\n1,2,3\n")
    put(tmp_path / "in", "transaction_data_4.csv", "\n1,2\n")
    schema = T._parse_datatype_string("`Order Date` string, Sales string")
    log, job = csv_log(spark, tmp_path / "in", tmp_path, schema=schema)
    rows = log.read().collect()
    good = {(r["Order Date"], r["Sales"]) for r in rows if r["malformed"] is None}
    assert good == {("2020-01-01", "5"), ("2020-01-02", "5"), ("2020-01-03", "5")}
    assert [r["malformed"] for r in rows if r["malformed"]] == ["1,2,3"]
    assert [r["reason"] for r in job.quarantine.read().collect()] == ["no header"]


USER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_login", T.TimestampType()),
        T.StructField("account_balance", T.DecimalType(18, 2)),
    ]
)


def test_typed_csv_directory(spark, tmp_path):
    put(tmp_path / "in", "users.csv",
        "id,first_name,last_login,account_balance\n"
        "1,Ann,2016-02-17T05:06:07Z,1.50\nx,Bob,2016-02-17T05:06:07Z,2.50\n")
    rows = dropdir.read_csv(spark, str(tmp_path / "in"), USER, glob="*.csv").orderBy("id").collect()
    assert rows[0].id is None and rows[0].malformed.startswith("x,Bob")
    assert rows[1].account_balance == Decimal("1.50") and rows[1].malformed is None
    log, _ = csv_log(spark, tmp_path / "in", tmp_path, schema=USER, glob="*.csv")
    assert log.read().count() == 2


def test_json_directories(spark, tmp_path):
    put(tmp_path / "in", "users.json",
        '{"id":1,"first_name":"Ann","account_balance":1.5,"extra":[1]}\n{"id":\n{"id":2}\n')
    typed = dropdir.json_records(spark, str(tmp_path / "in"), USER).collect()
    assert sorted(r.id for r in typed if r.malformed is None) == [1, 2]
    assert [r.malformed for r in typed if r.malformed] == ['{"id":']
    loose = dropdir.json_variants(spark, str(tmp_path / "in"))
    ids = loose.selectExpr("try_variant_get(record, '$.id', 'bigint') as id").collect()
    assert sorted(r.id for r in ids if r.id is not None) == [1, 2] and len(ids) == 3
    for name, stream in {
        "typed": dropdir.json_records(spark, str(tmp_path / "in"), USER, streaming=True),
        "lines": dropdir.text_lines(spark, str(tmp_path / "in"), streaming=True),
    }.items():
        assert run_once(stream, str(tmp_path), name).read().count() == 3


def test_text_lines(spark, tmp_path):
    put(tmp_path / "in", "a.txt", "one\n\ntwo,2\n")
    assert [r.value for r in dropdir.text_lines(spark, str(tmp_path / "in")).collect()] == [
        "one", "", "two,2"
    ]


def test_extended_log_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    files = {
        "a.gz": "#Version: 1.0\n#Fields: date time x-edge cs-bytes\n"
                "2014-05-23\t01:13:11\tFRA2\t182\n2014-05-23\t01:13:12\t-\tmany\n2014-05-23\t01\n",
        "b.gz": '#Fields: cs-bytes agent date\n7 "a ""b"" c" 2014-05-24\n',
        "c.gz": "1 2 3\n",
        "d.gz": "#Fields: date cs-bytes\n2014-05-25 1\n#Fields: cs-bytes date\n2 2014-05-25\n",
    }
    for name, text in files.items():
        with gzip.open(tmp_path / "in" / name, "wt") as out:
            out.write(text)
    fields = {"date": "date", "x-edge": "string", "cs-bytes": "int", "agent": "string"}
    rows = dropdir.parse_log(dropdir.log_lines(spark, str(tmp_path / "in")), fields).collect()
    good = {(r.date, r["x-edge"], r["cs-bytes"], r.agent) for r in rows if r.reason is None}
    day = dt.date(2014, 5, 23)
    assert good == {(day, "FRA2", 182, None), (day, None, None, None),
                    (dt.date(2014, 5, 24), None, 7, 'a "b" c')}
    bad = sorted(r.reason for r in rows if r.reason)
    assert bad == ["contradicting fields lines"] * 2 + ["no fields line", "wrong number of values"]


def test_incremental_reads(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    source = spark.range(1, 11)
    reader = tables.IncrementalReader(source, log)
    assert reader.high_water() is None
    assert reader.deliver() == 0 and reader.high_water() == 10
    assert reader.deliver() is None
    assert tables.IncrementalReader(spark.range(1, 16), log).deliver() == 1
    got = log.read().collect()
    assert sorted((r.batch_id, r.id) for r in got) == [(0, i) for i in range(1, 11)] + [
        (1, i) for i in range(11, 16)
    ]


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    log = BatchLog(spark, str(tmp_path / "log"))
    log.write(spark.range(50), 0)
    pending = tables.IncrementalReader(spark.read.parquet(str(tmp_path / "t")), log).pending()
    assert "GreaterThan(id,49)" in pending._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options():
    query = "SELECT * FROM lstm_results ORDER BY date ASC"
    assert tables.jdbc_options("jdbc:x", query=query, user="u", password="p") == {
        "url": "jdbc:x", "query": query, "user": "u", "password": "p"
    }
    split = tables.jdbc_options("jdbc:x", table="t", split=("id", 0, 100, 8))
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")


def test_topic_options():
    config = PipelineConfig(brokers="b:1")
    assert topics.source_options(config) == {
        "kafka.bootstrap.servers": "b:1", "groupIdPrefix": "lstm", "startingOffsets": "latest",
        "subscribe": "transaction_data",
    }
    routed = topics.source_options(config, pattern=".*?persist", from_start=True)
    assert routed["subscribePattern"] == ".*?persist" and "subscribe" not in routed
    assert routed["startingOffsets"] == "earliest"


def test_topic_values(spark):
    raw = spark.createDataFrame([("t", 0, 5, bytearray(b"{}"))],
                                "topic string, partition int, offset long, value binary")
    assert [tuple(r) for r in topics.message_text(raw).collect()] == [("t", 0, 5, "{}")]


def test_config_from_arguments_and_json():
    config = PipelineConfig.from_args(
        ["-in", "a", "-out", "b", "-broker", "c:1", "--series", "x", "y"])
    assert (config.input_topic, config.output_topic, config.brokers) == ("a", "b", "c:1")
    assert config.series == ("x", "y") and config.job_name == "feature_aggregation_job"
    named = PipelineConfig.from_args(["--kafka-address", "k:2", "--group-id", "g"])
    assert (named.brokers, named.group_id) == ("k:2", "g")
    text = '{"lstm-script":{"dataFrame-path":"/d.csv","date-col":"D","target-col":"T"}}'
    trained = PipelineConfig.from_json(text)
    assert (trained.data_path, trained.date_col, trained.sales_col) == ("/d.csv", "D", "T")


def test_headers_in_any_order_number_and_state(spark, tmp_path):
    put(tmp_path / "in", "transaction_data_1.csv", "Order Date,Sales,Cost\n2020-01-01,5,900\n")
    put(tmp_path / "in", "transaction_data_2.csv", "Order Date,Cost,Sales\n2020-01-02,900,5\n")
    put(tmp_path / "in", "transaction_data_3.csv", '"Sales",Order Date\n5,2020-01-03\n1,2,3\n')
    put(tmp_path / "in", "transaction_data_4.csv", "A,A\n1,2\n")
    put(tmp_path / "in", "other.csv", "Order Date,Sales\n2020-01-04,7\n")
    paths = dropdir.list_files(spark, str(tmp_path / "in"))
    rows, refused = dropdir.read_csv_files(spark, paths)
    good = {(r["Order Date"], r["Sales"], r["Cost"]) for r in rows.collect() if not r["malformed"]}
    assert good == {("2020-01-01", "5", "900"), ("2020-01-02", "5", "900"), ("2020-01-03", "5", None)}
    assert [r["malformed"] for r in rows.collect() if r["malformed"]] == ["1,2,3"]
    assert list(refused.values()) == ["repeated column name"]
    with pytest.raises(ValueError, match="repeated column name"):
        dropdir.read_csv(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="no file"):
        (tmp_path / "empty").mkdir()
        dropdir.read_csv(spark, str(tmp_path / "empty"))


def test_headers_are_read_by_tasks(spark, tmp_path, monkeypatch):
    """Five thousand files, none of which the driver opens; names with blanks and signs; packed and empty ones."""
    from py4j.clientserver import JavaClient

    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(5000):
        (folder / f"{k}.csv").write_text(f"a,b\n{k},x\n" if k % 2 else f"b,a\ny,{k}\n")
    put(folder, "odd name %20 é.csv", "a,b\n-1,x\n")
    put(folder, "long.csv", "b,c\n" + "1,2\n" * 200_000)
    put(folder, "empty.csv", "")
    put(folder, "blank.csv", "\n\n")
    put(folder, "latin.csv", "Größe,b\n", "latin-1")
    with gzip.open(folder / "packed.csv.gz", "wt") as out:
        out.write("\ufeffa,b\n-2,z\n")
    (folder / "not.csv.gz").write_bytes(b"no gzip")
    paths = dropdir.list_files(spark, str(folder), "*")
    sent = []
    send = JavaClient.send_command
    monkeypatch.setattr(
        JavaClient, "send_command", lambda self, text, *a, **k: sent.append(text) or send(self, text, *a, **k)
    )
    groups, refused = dropdir.file_headers(spark, paths)
    assert not [text for text in sent if "\nopen\n" in text]
    assert {k: len(v) for k, v in groups.items()} == {("a", "b"): 2502, ("b", "a"): 2500, ("b", "c"): 1}
    assert set(sum(groups.values(), [])) | set(refused) == set(paths)
    reasons = {p.rsplit("/", 1)[1]: r.split(":")[0] for p, r in refused.items()}
    assert reasons == {"empty.csv": "no header", "blank.csv": "no header", "not.csv.gz": "no header",
                       "latin.csv": "unreadable file"}
    some = [p for p in paths if p.endswith(("/7.csv", "/8.csv", "odd name %20 é.csv", "packed.csv.gz"))]
    rows, _ = dropdir.read_csv_files(spark, some)
    assert sorted((r["a"], r["b"]) for r in rows.collect()) == [
        ("-1", "x"), ("-2", "z"), ("7", "x"), ("8", "y")
    ]


def test_a_broken_file_among_many_is_found(spark, tmp_path):
    folder = tmp_path / "in"
    for k in range(9):
        put(folder, f"transaction_data_{k}.csv", f"a\n{k}\n")
    whole = gzip.compress("a,b\n".encode() + "".join(f"{k},{k * k}\n" for k in range(50_000)).encode())
    (folder / "transaction_data_cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    from monthwise.streaming.jobs import CsvJob

    log = BatchLog(spark, str(tmp_path / "log"))
    job = CsvJob(spark, str(tmp_path / "job"), lambda rows, k: log.write(rows.select("a"), k))
    files = dropdir.stream_files(spark, str(folder), "*transaction_data*")
    job.start(files).awaitTermination()
    assert sorted(r["a"] for r in log.read().collect()) == [str(k) for k in range(9)]
    found = job.quarantine.read().collect()
    assert [r["reason"].split(":")[0] for r in found] == ["unreadable file"]
