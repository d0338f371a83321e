"""Batch logs that merge, bucket stores and the keyed tables on them, by what they write and leave."""

import random

import pytest
from pyspark.sql import functions as F

from monthwise.sinks import files
from monthwise.sinks.batch_log import BatchLog
from monthwise.sinks.bucket_store import BucketStore
from monthwise.sinks.keyed_table import KeyedTable


def files_below(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet") if p.is_file()}


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_merged_batches_read_as_before(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), merge_every=3)
    plain = BatchLog(spark, str(tmp_path / "plain"))
    for k in range(31):
        rows = spark.range(k % 3).selectExpr("id", f"{k} as k") if k % 2 else spark.range(2)
        for one in (log, plain):
            one.write(rows, 2 * k)
    assert len(list((tmp_path / "log").iterdir())) < 16
    for choice in ({}, {"above": 7}, {"below": 30}, {"above": 10, "below": 41}, {"only": 2}, {"only": 60}):
        got, want = log.read(**choice), plain.read(**choice)
        assert rows_of(got.fillna(-1).select("id", "k", "batch_id")) == rows_of(
            want.withColumn("k", want["k"] if "k" in want.columns else F.lit(None).cast("int"))
            .fillna(-1).select("id", "k", "batch_id")) if "k" in got.columns else rows_of(got) == rows_of(want)
    assert log.has(2) and log.has(60) and not log.has(62)
    assert BatchLog(spark, str(tmp_path / "log")).read().count() == plain.read().count()
    log.write(spark.range(100), 4)  # replayed
    assert log.read().count() == plain.read().count()
    with pytest.raises(ValueError):
        BatchLog(spark, str(tmp_path / "one"), merge_every=1)


def test_a_merge_cut_short_changes_nothing(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), merge_every=2)
    for k in range(3):
        log.write(spark.range(k + 1), k)
    run = next((tmp_path / "log").glob("merged-*"))
    (run / "_SUCCESS").unlink()
    assert log.read().count() == 6 and log.committed() == [0, 1, 2]
    log.write(spark.range(10), 3)
    assert log.read().count() == 16 and log.committed() == [3]


def test_a_version_rewrites_its_buckets_only(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), ["k"], buckets=8)
    assert store.read() is None and store.version() is None and store.note() is None
    rows = spark.range(100).selectExpr("id as k", "0 as v")
    store.replace(rows, 0, range(8), note="first")
    assert store.read().count() == 100 and store.note() == "first"
    before = files_below(tmp_path / "t" / "versions")
    assert len(before) == 8  # one task and file a bucket
    one = spark.createDataFrame([(7,)], "k bigint")
    touched = store.touched(one)
    assert len(touched) == 1
    old = store.read(only=touched)
    store.replace(old.withColumn("v", F.lit(1)).withColumn("w", F.lit("x")), 5, touched)
    after = files_below(tmp_path / "t" / "versions")
    assert before < after and len(after - before) == 1
    got = {r["k"]: (r["v"], r["w"]) for r in store.read().collect()}
    inside = {r["k"] for r in old.collect()}
    assert got == {k: (1, "x") if k in inside else (0, None) for k in range(100)}
    store.replace(rows, 3, range(8))  # an older version is not written
    assert store.version() == 5
    # Emptied buckets vanish; the version before stays readable until the next.
    store.replace(rows.limit(0), 6, range(8))
    assert store.read().count() == 0 and store.read().columns == ["k", "v", "w"]
    store.replace(rows.limit(0), 7, [])
    assert files_below(tmp_path / "t" / "versions") == set()
    other = BucketStore(spark, str(tmp_path / "t"), ["k"], buckets=99)
    assert other.buckets == 8 and other.committed() == [6, 7]


def test_a_version_cut_short_is_repeated(spark, tmp_path, monkeypatch):
    store = BucketStore(spark, str(tmp_path / "t"), [], buckets=8)
    assert store.buckets == 1
    store.replace(spark.range(3), 0, [0])
    write = files.write_text
    monkeypatch.setattr(files, "write_text", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.replace(spark.range(50), 1, [0])
    monkeypatch.setattr(files, "write_text", write)
    again = BucketStore(spark, str(tmp_path / "t"), [])
    assert again.read().count() == 3
    again.replace(spark.range(4), 1, [0])
    assert again.read().count() == 4


@pytest.mark.parametrize("merge", [False, True])
def test_fifty_folded_upserts_rewrite_their_buckets_only(spark, tmp_path, merge):
    """Few keys a batch: file names tell which buckets were written; reads are one pass over the base."""
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], merge_columns=merge, compact_every=1, buckets=32)
    everything = {k: (0, None) for k in range(2000)}
    table.upsert(spark.createDataFrame([(k, 0) for k in everything], "k int, v int"), 0)
    rng = random.Random(4)
    versions = tmp_path / "t" / "base" / "versions"
    for batch in range(1, 7 if merge else 51):
        before = files_below(versions)
        keys = rng.sample(range(2100), 2)
        touched = set(table.base.touched(spark.createDataFrame([(k,) for k in keys], "k int")))
        if batch % 2:
            table.upsert(spark.createDataFrame([(k, batch) for k in keys], "k int, v int"), batch)
            for k in keys:
                everything[k] = batch, everything.get(k, (0, None))[1] if merge else None
        else:
            table.upsert(spark.createDataFrame([(k, f"w{batch}") for k in keys], "k int, w string"), batch)
            for k in keys:
                everything[k] = everything.get(k, (None, None))[0] if merge else None, f"w{batch}"
        new = files_below(versions) - before
        assert {int(name.split("bucket=")[1].split("/")[0]) for name in new} == touched
        assert len(new) == len(touched)
    got = {r["k"]: (r["v"], r["w"]) for r in table.read().collect()}
    assert got == everything
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert len(list((tmp_path / "t" / "changes").iterdir())) <= 2
    assert len(list(versions.rglob("bucket=*"))) <= 64 and len(list(versions.iterdir())) <= 64


def test_a_fold_reads_only_the_buckets_it_touches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=16)
    table.upsert(spark.range(500).selectExpr("id as k", "0 as v"), 0)
    table.compact()
    old = table.base.read(only=table.base.touched(spark.createDataFrame([(3,)], "k bigint")))
    assert 0 < old.count() < 100 and len(old.inputFiles()) == 1


def test_small_files_appear_whole_and_stay(spark, tmp_path):
    path = f"{tmp_path}/a/7.json"
    files.write_text(spark, path, "größe")
    files.write_text(spark, path, "other")
    assert files.read_text(spark, path) == "größe"
    assert files.names(spark, f"{tmp_path}/a/*.json") == ["7.json"]
    assert [p.name for p in (tmp_path / "a").iterdir() if "7.json" in p.name and not p.name.endswith(".crc")] == ["7.json"]
    files.delete(spark, path)
    assert files.names(spark, f"{tmp_path}/a/*.json") == []
