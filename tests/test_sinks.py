import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthwise.config import PipelineConfig
from monthwise.sinks import jdbc, topics
from monthwise.sinks.batch_log import BatchLog
from monthwise.sinks.export import export_csv
from monthwise.sinks.keyed_table import KeyedTable
from monthwise.sources.tables import sorted_results


def frame(spark, rows, schema="k string, a int"):
    return spark.createDataFrame(rows, schema)


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_batch_log_writes_a_batch_once_and_hides_unfinished_ones(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.committed() == [] and log.read() is None
    log.write(spark.range(3), 0)
    log.write(spark.range(3), 10)
    log.write(spark.range(5), 10)
    log.write(spark.range(7), 2)
    assert log.committed() == [0, 2, 10]
    (tmp_path / "log" / "batch_id=2" / "_SUCCESS").rename(tmp_path / "moved")
    assert log.committed() == [0, 10]
    assert log.read().count() == 6 and log.read(below=10).count() == 3
    assert log.read(above=10) is None


def test_upserts_replace_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    assert table.read() is None
    table.upsert(frame(spark, [("x", 1), ("y", 2)]), 0)
    table.upsert(frame(spark, [("y", 3), ("z", None)]), 1)
    want = [("x", 1), ("y", 3), ("z", None)]
    key = lambda r: r[0]
    assert sorted(map(tuple, table.read().collect()), key=key) == want
    table.upsert(frame(spark, [("y", 3), ("z", None)]), 1)
    assert sorted(map(tuple, table.read().collect()), key=key) == want


def test_last_write_within_a_batch_by_order(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], order=["a"])
    table.upsert(frame(spark, [("x", 1), ("x", 9), ("x", 4)]), 0)
    assert content(table) == [("x", 9)]
    table.upsert(frame(spark, [("x", 2)]), 1)
    assert content(table) == [("x", 2)]


def test_compaction_changes_nothing_and_later_batches_win(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    for i in range(4):
        table.upsert(frame(spark, [("x", i), (f"n{i}", i)]), i)
    before = content(table)
    table.compact()
    assert table.base.committed() == [3] and content(table) == before
    table.upsert(frame(spark, [("x", 100)]), 4)
    assert dict(content(table))["x"] == 100
    table.compact()
    table.compact()
    assert dict(content(table))["x"] == 100 and table.base.committed() == [3, 4]


@pytest.mark.parametrize("compacted", [False, True])
def test_new_columns_widen_and_absent_ones_stay(spark, tmp_path, compacted):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], merge_columns=True)
    table.upsert(frame(spark, [("x", 1), ("y", 2)]), 0)
    table.upsert(frame(spark, [("x", 5, "new"), ("z", 6, "z")], "k string, a int, b string"), 1)
    if compacted:
        table.compact()
    table.upsert(frame(spark, [("x", 7)]), 2)
    table.upsert(frame(spark, [("z", None)], "k string, b string"), 3)
    got = {r.k: (r.a, r.b) for r in table.read().collect()}
    assert got == {"x": (7, "new"), "y": (2, None), "z": (6, None)}


def test_rows_without_key_and_rows_with_a_reason_are_dead_letters(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    table.upsert(frame(spark, [(None, 1), ("x", 2)]), 0)
    table.upsert(frame(spark, [("x", 3, "bad"), ("y", 4, None)], "k string, a int, reason string"), 1)
    assert content(table) == [("x", 2), ("y", 4)]
    rejected = table.rejected().select("a", "reason", "batch_id")
    assert sorted(map(tuple, rejected.collect())) == [(1, "no k", 0), (3, "bad", 1)]
    table.compact()
    assert content(table) == [("x", 2), ("y", 4)] and table.rejected().count() == 2


def test_database_statements():
    types = {"date": "DATE", "sales": "DOUBLE PRECISION"}
    assert jdbc.create_statement("t", types, ["date"]) == (
        'CREATE TABLE IF NOT EXISTS t ("date" DATE NOT NULL, "sales" DOUBLE PRECISION, '
        'PRIMARY KEY ("date"))'
    )
    assert jdbc.widen_statements("t", ["date"], types) == [
        'ALTER TABLE t ADD COLUMN "sales" DOUBLE PRECISION'
    ]
    assert jdbc.upsert_statement("t", "s", ["date", "sales"], ["date"]) == (
        'INSERT INTO t ("date", "sales") SELECT "date", "sales" FROM s '
        'ON CONFLICT ("date") DO UPDATE SET "sales" = EXCLUDED."sales"'
    )
    assert jdbc.upsert_statement("t", "s", ["k"], ["k"]).endswith('ON CONFLICT ("k") DO NOTHING')


def test_database_types(spark):
    df = spark.sql("select 'a' s, 1.5d x, date'2014-01-01' d, 1.50BD m")
    assert jdbc.column_types(df) == {
        "s": "TEXT", "x": "DOUBLE PRECISION", "d": "DATE", "m": "DECIMAL(3,2)"
    }


def test_topic_sink(spark):
    assert topics.sink_options(PipelineConfig(brokers="b:1"), "lstm_results") == {
        "kafka.bootstrap.servers": "b:1", "topic": "lstm_results"
    }
    rows = frame(spark, [(dt.date(2014, 1, 1), 2.5)], "date date, sales double")
    sent = topics.forecast_values(rows).first()
    assert sent.key == "2014-01-01" and '"payload":{"date":"2014-01-01","sales":"2.5"}' in sent.value
    windows = rows.groupBy().agg(F.collect_list(F.struct("date", "sales")).alias("data"))
    assert topics.window_values(windows).first().value == (
        '{"data":[{"date":"2014-01-01","sales":2.5}]}'
    )


@pytest.mark.parametrize("single", [True, False])
def test_export_is_sorted(spark, tmp_path, single):
    rows = [(dt.date(2014, m, 1), float(m)) for m in (3, 1, 12, 2)]
    results = frame(spark, rows, "date date, sales double").repartition(3)
    assert [r.date.month for r in sorted_results(results).collect()] == [1, 2, 3, 12]
    export_csv(results, str(tmp_path / "out"), single=single)
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    dates = [line for line in lines if line != "date,sales"]
    assert dates == ["2014-01-01,1.0", "2014-02-01,2.0", "2014-03-01,3.0", "2014-12-01,12.0"]
    if single:
        assert len(files) == 1


def test_reading_after_compaction_does_not_shuffle_the_base(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    table.upsert(spark.range(1000).selectExpr("cast(id as string) as k", "id as a"), 0)
    table.compact()
    table.upsert(spark.range(5).selectExpr("cast(id as string) as k", "-1L as a"), 1)
    result = table.read()
    assert result.count() == 1000 and result.filter("a = -1").count() == 5
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "SortMergeJoin" not in text


def test_fifty_upserts_leave_few_directories(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), ["k"], compact_every=8)
    for batch in range(50):
        rows = [(batch % 7, batch, None), (100 + batch, batch, None), (None, batch, None), (1, 0, "bad")]
        target.upsert(spark.createDataFrame(rows, "k int, v int, reason string"), batch)
    target.upsert(spark.createDataFrame([(0, -1)], "k int, v int"), 3)  # replayed
    want = {k: max(b for b in range(50) if b % 7 == k) for k in range(7)} | {100 + b: b for b in range(50)}
    assert {r["k"]: r["v"] for r in target.read().collect()} == want
    rejected = target.rejected().collect()
    assert sorted(r["batch_id"] for r in rejected) == sorted([*range(50), *range(50)])
    assert {r["reason"] for r in rejected} == {"bad", "no k"}
    folders = [p for kind in ("changes", "base") for p in (tmp_path / "t" / kind).iterdir()]
    assert len(folders) <= 2 + 2 * 8


def test_arguments_are_honoured_or_refused(spark, tmp_path):
    from monthwise.plans import jobs

    file = tmp_path / "job.json"
    file.write_text('{"lstm-script": {"dataFrame-path": "d.csv", "date-col": "Day", "target-col": "Amount"}}')
    config = PipelineConfig.from_args(["--config", str(file), "--sales-col", "Net", "--mode", "corrected",
                                       "--state-partitions", "16"])
    assert (config.data_path, config.date_col, config.sales_col) == ("d.csv", "Day", "Net")
    assert (config.mode, config.state_partitions) == ("corrected", 16)
    with pytest.raises(SystemExit):
        PipelineConfig.from_args(["--mode", "other"])
    keyed = PipelineConfig(job_name="keyed", series=("a",))
    assert jobs.results_table(spark, keyed).keys == ["a", "date"]
    with pytest.raises(ValueError, match="no results"):
        jobs.export(spark, PipelineConfig(job_name="fresh"))


class FakeDatabase:
    """Stands in for a connection: keeps statements, commits and the columns it is told of."""

    def __init__(self, columns=(), noted=(), fail=None):
        self.columns, self.noted, self.fail = list(columns), set(noted), fail
        self.log, self.asked = [], []

    def connect(self, spark, url, properties):
        self.log.append(f"open {url} {sorted(properties.items())}")
        return self

    def setAutoCommit(self, on):
        assert on is False

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")

    def createStatement(self):
        return self

    def executeUpdate(self, text=None):
        text = text or f"{self.prepared} {self.values}"
        if self.fail and self.fail in text:
            raise OSError("lost")
        self.log.append(text)

    def prepareStatement(self, text):
        self.prepared, self.values = text, []
        return self

    def setString(self, at, value):
        self.values.append(value)

    def setLong(self, at, value):
        self.values.append(value)

    def executeQuery(self):
        rows = [tuple(self.values)] if tuple(self.values) in self.noted else []
        return FakeRows(rows)

    def getMetaData(self):
        return self

    def getSearchStringEscape(self):
        return "\\"

    def getColumns(self, catalog, schema, table, column):
        self.asked.append((schema, table))
        return FakeRows(self.columns)


class FakeRows:
    def __init__(self, rows):
        self.rows, self.at = rows, -1

    def next(self):
        self.at += 1
        return self.at < len(self.rows)

    def getString(self, name):
        assert name == "COLUMN_NAME"
        return self.rows[self.at]


@pytest.fixture
def staged(monkeypatch):
    """What is written to database tables."""
    from pyspark.sql import DataFrameWriter

    tables = {}

    def jdbc_write(self, url, table, mode=None, properties=None):
        tables[table] = sorted(map(tuple, self._df.collect()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc_write)
    return tables


def test_database_upsert_is_one_transaction(spark, tmp_path, monkeypatch, staged):
    database = FakeDatabase(columns=["date", "sales"])
    monkeypatch.setattr(jdbc, "open_connection", database.connect)
    table = jdbc.DatabaseTable(spark, "jdbc:x", "lstm_results", ["date"], BatchLog(spark, str(tmp_path)),
                               ["seq"], "my job/1", {"user": "u"}, ["value"])
    rows = [("d1", 1.0, 5, "m1", None), ("d1", 2.0, 7, "m2", None), (None, 3.0, 8, "m3", None), ("d2", None, 9, "m4", "bad")]
    schema = "date string, sales double, seq bigint, value string, reason string"
    table.upsert(spark.createDataFrame(rows, schema), 12)
    assert staged == {'"lstm_results_my_job_1_12_staging"': [("d1", 2.0, 7)]}
    marker = '"lstm_results_batches"'
    assert database.log == [
        "open jdbc:x [('user', 'u')]",
        f"CREATE TABLE IF NOT EXISTS {marker} (job TEXT, batch_id BIGINT, PRIMARY KEY (job, batch_id))",
        "commit", "close", "open jdbc:x [('user', 'u')]",
        'CREATE TABLE IF NOT EXISTS "lstm_results" ("date" TEXT NOT NULL, "sales" DOUBLE PRECISION, '
        '"seq" BIGINT, PRIMARY KEY ("date"))',
        'ALTER TABLE "lstm_results" ADD COLUMN "seq" BIGINT',
        'INSERT INTO "lstm_results" ("date", "sales", "seq") SELECT "date", "sales", "seq" FROM '
        '"lstm_results_my_job_1_12_staging" ON CONFLICT ("date") DO UPDATE SET "sales" = EXCLUDED."sales", '
        '"seq" = EXCLUDED."seq"',
        f"INSERT INTO {marker} (job, batch_id) VALUES (?, ?) ['my job/1', 12]",
        'DROP TABLE "lstm_results_my_job_1_12_staging"', "commit", "close",
    ]
    assert database.asked == [(None, "lstm\\_results")]
    assert sorted((r.value, r.reason) for r in table.rejected().collect()) == [("m3", "no date"), ("m4", "bad")]


def test_database_batches_count_once(spark, tmp_path, monkeypatch, staged):
    table = jdbc.DatabaseTable(spark, "jdbc:x", "s.t", ["k"], BatchLog(spark, str(tmp_path)))
    database = FakeDatabase(fail="INSERT INTO \"s\".\"t\" ")
    monkeypatch.setattr(jdbc, "open_connection", database.connect)
    with pytest.raises(OSError):
        table.upsert(frame(spark, [("x", 1)]), 3)
    assert database.log[-2:] == ["rollback", "close"] and not [t for t in database.log if "VALUES" in t]
    noted = FakeDatabase(noted=[("job", 3)])
    monkeypatch.setattr(jdbc, "open_connection", noted.connect)
    staged.clear()
    table.upsert(frame(spark, [("x", 1)]), 3)
    assert not staged and noted.log[-2:] == ["commit", "close"]
    table.upsert(frame(spark, [("x", 1), ("x", 1)]), 4)
    assert staged == {'"s"."t_job_4_staging"': [("x", 1)]} and table.rejected() is None


def test_jobs_write_to_the_database_they_are_given(spark, tmp_path, monkeypatch, staged):
    from monthwise.plans import jobs

    database = FakeDatabase()
    monkeypatch.setattr(jdbc, "open_connection", database.connect)
    (tmp_path / "p.json").write_text('{"user": "u", "driver": "d"}')
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "transaction_data_1.csv").write_text("Order Date,Sales\n2020-01-01,5\n2020-01-02\n")
    config = PipelineConfig.from_args([
        "--job-name", f"db-{tmp_path.name}", "--jdbc-url", "jdbc:x", "--jdbc-properties", str(tmp_path / "p.json"),
    ])
    table = jobs.database_table(spark, config, "results", ["date"], ["seq"], ["value"])
    assert (table.target, table.properties) == ("lstm_results", {"user": "u", "driver": "d"})
    from monthwise.sources.dropdir import stream_files
    from monthwise.streaming.jobs import CsvPersistJob

    raw = jobs.database_table(spark, config, "persist", ["postgres_pk"], leave_out=["malformed", "source_file"])
    job = CsvPersistJob(spark, jobs.job_root(spark, config, "persist"), table=raw)
    job.start(stream_files(spark, str(folder))).awaitTermination()
    (name, rows), = staged.items()
    assert name.startswith('"transaction_data_persist_db_') and [r[:2] for r in rows] == [("2020-01-01", "5")]
    assert [r.reason for r in job.rejected().collect()] == ["malformed line"]
