"""The pipeline's stages one by one and as a whole, against plain Python."""

import os

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from monthwise.llm import byte_cnn, queries, tokens, toxicity
from tests.llm.test_operators import (
    SCHEMA, awkward, brute_fingerprint, brute_groups, brute_probability, brute_score, marked_documents,
)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = marked_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    line = "Karalo ten por mi ra sul lo ed."
    rows += [(20000 + k, f"{line}\nkalo {k} ten ra mi sul por kami tenlo {'lomi ' * k}") for k in range(15)]
    copy = " ".join(f"kalo{k} ten" for k in range(80))
    rows += [(30000 + k, copy) for k in range(20)]
    table = pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows],
        "lang": ["en"] * len(rows), "source": ["s"] * len(rows),
        "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64()),
    })
    pq.write_table(table, os.path.join(path, "documents.parquet"))
    labels.toPandas().astype("Int64").to_parquet(os.path.join(path, "labels.parquet"))
    return path


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    network, model = queries.quality_network(spark, folder), queries.toxicity_model(spark, folder)
    tables, machine = network.tables(), toxicity.finder(model)
    rows = [tuple(r) for r in docs.collect()]
    assert len(corpus_pipeline.STAGES) == 5

    def stage(number, docs):
        out = corpus_pipeline.STAGES[number][1](spark, docs, folder)
        path = os.path.join(folder, f"out{number}")
        out.write.parquet(path)
        return spark.read.parquet(path)

    good = stage(0, docs)
    rows = [r for r in rows if byte_cnn.probability(r[1] or "", network, tables) >= 0.5]
    assert good.columns == columns and sorted(map(str, map(tuple, good.collect()))) == sorted(map(str, rows))

    clean = stage(1, good)
    rows = [r for r in rows if toxicity.score(r[1] or "", model, machine) < 0.5]
    assert clean.columns == columns and sorted(map(str, map(tuple, clean.collect()))) == sorted(map(str, rows))

    lined = stage(2, clean)
    seen = {}
    for r in rows:
        for key in {x.strip(" \t\n\x0b\x0c\r").lower() for x in (r[1] or "").split("\n")} - {""}:
            seen[key] = seen.get(key, 0) + 1
    texts = [
        "\n".join(x for x in (r[1] or "").split("\n") if seen.get(x.strip(" \t\n\x0b\x0c\r").lower(), 0) < 10)
        for r in rows
    ]
    rows = [(r[0], t, *r[2:4], len(t)) for r, t in zip(rows, texts)]
    assert lined.columns == columns and sorted(map(str, map(tuple, lined.collect()))) == sorted(map(str, rows))
    assert any(r[0] and 20000 <= r[0] < 20015 and "Karalo" not in r[1] for r in rows)

    single = stage(3, lined)
    group = brute_groups({brute_fingerprint(r[1]) for r in rows}, 2)
    first = {}
    for r in rows:
        g = group[brute_fingerprint(r[1])]
        if r[0] is not None:
            first[g] = min(r[0], first.get(g, r[0]))
    kept = [tuple(r) for r in single.collect()]
    assert single.columns == columns
    assert sorted(str(r[0]) for r in kept) == sorted(str(first.get(g)) for g in set(group.values()))
    assert set(kept) <= set(rows)

    packed = stage(4, single)
    encoder = tokens.byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    assert packed.agg(F.sum("length")).first()[0] == sum(len(encoder.ids(r[1])) + 1 for r in kept)
    assert corpus_pipeline.run(spark, folder).count() == packed.count()


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stages_on_awkward_rows_with_clashing_columns(spark, folder):
    """Nulls, empty and very long texts, repeated rows and ids, columns that the operators name themselves."""
    rows = [(*r, k % 3, None, "x", 3, "y", 4) for k, r in enumerate(awkward())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    bag = lambda df: sorted(map(str, map(tuple, df.collect())))
    network, model = queries.quality_network(spark, folder), queries.toxicity_model(spark, folder)
    good = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    short = [r for r in rows if len(r[1] or "") < 20000]
    keeps = [r for r in short if brute_probability(r[1], network) >= 0.5]
    assert good.columns == docs.columns
    assert bag(good.where("length(coalesce(text, '')) < 20000")) == sorted(map(str, keeps))
    clean = corpus_pipeline.STAGES[1][1](spark, docs, folder)
    assert bag(clean) == sorted(str(r) for r in rows if brute_score(r[1], model) < 0.5)
    lined = corpus_pipeline.STAGES[2][1](spark, clean, folder)
    assert lined.columns == docs.columns and lined.count() == clean.count()
    single = corpus_pipeline.STAGES[3][1](spark, lined, folder)
    group = brute_groups({brute_fingerprint(r["text"]) for r in lined.collect()}, 2)
    assert single.columns == docs.columns and single.count() == len(set(group.values()))
    packed = corpus_pipeline.STAGES[4][1](spark, docs, folder)
    encoder = tokens.byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    assert packed.agg(F.sum("length")).first()[0] == sum(len(encoder.ids(r[1] or "")) + 1 for r in rows)
