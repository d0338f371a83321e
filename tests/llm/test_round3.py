"""Spelling variants, importance resampling and exact search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthwise.llm import queries, resample, spelling, vertical_topk
from tests.oracle import compare, data_dir

SCHEMA = "doc_id bigint, text string, _id int, _n int, _text string, word string, n int, rank int"
VECTORS = "vec_id bigint, embedding array<double>, label int, _row int, _id string, rank int"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, rows, schema=SCHEMA, extra=(1, 2, "x", "y", 3, 4)):
    return spark.createDataFrame([(*r, *extra) for r in rows], schema)


# spelling variants

def edits_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    p = 0
    while p < len(short) and short[p] == long[p]:
        p += 1
    return short[p + (len(a) == len(b)) :] == long[p + 1 :]


def brute_variants(rows, min_chars=5, min_count=3, one_in=97):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    vocabulary = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    forms, out = {}, Counter()
    near = {w: [v for v in vocabulary if edits_one(w, v)] for w in vocabulary}
    for w, n in vocabulary.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-vocabulary[v], v))
            if vocabulary[best] >= 2 * n:
                forms[w] = best
    for w, n in vocabulary.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out[(w, form, root, n, len(near[w]), vocabulary[form] if form else None)] += 1
    return out


def spelt(seed, size, alphabet="abcéÿ", longest=9):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.randint(3, longest))) for _ in range(40)]
    rows = [(None, "no ident ABCDE abcde Abcde"), (1, None), (2, ""), (3, "École école 中文 aİb")]
    for k in range(size):
        body = " ".join(
            (w if rng.random() < 0.6 else w[: (at := rng.randrange(len(w)))] + rng.choice(alphabet) + w[at + 1 :])
            for w in rng.choices(stems, range(1, 41), k=rng.randint(1, 60))
        )
        rows.append((k % 50, body.replace(" ", rng.choice([" ", ".", "\n", "9", "Ж"]))))
    way = ["chainaaa"] * 30 + ["chainaab"] * 12 + ["chainabb"] * 5
    return rows + rows[4:9] + [(k, " ".join(way)) for k in range(3)]


@pytest.mark.parametrize("group", [2, 7, 1024])
def test_variants_equal_brute_force(spark, group):
    rows = spelt(group, 150)
    want = brute_variants(rows, min_chars=4)
    got = spelling.variant_groups(frame(spark, rows).repartition(3), min_chars=4, group=group)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [k for _, k in got.dtypes] == ["string"] * 3 + ["bigint"] * 3
    assert bag(got) == want
    assert sum(1 for row in want if row[2] != row[1] and row[1]) >= 1  # ways of two steps or more


def test_variants_of_a_hot_beginning_and_ending(spark):
    rng = random.Random(3)
    words = {"q" * 20 + "".join(rng.choices("ab", k=9)) for _ in range(300)}
    words |= {"".join(rng.choices("ab", k=9)) + "z" * 20 for _ in range(300)}
    words |= {"a" * 30000, "a" * 30001, "a" * 29999 + "b"}
    rows = [(k, w) for k in range(4) for w in sorted(words)]
    got = spelling.variant_groups(frame(spark, rows), group=16)
    assert bag(got) == brute_variants(rows)


def test_variants_of_nothing(spark):
    assert spelling.variant_groups(frame(spark, [])).count() == 0
    assert spelling.variant_groups(frame(spark, [(None, None), (1, "12 34")])).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(frame(spark, []), ratio=1)


def test_walk_of_a_sorted_list_finds_each_word_one_edit_away():
    rng = random.Random(1)
    for _ in range(200):
        listed = sorted({"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(50)})
        shared = [0, *map(spelling._common, listed, listed[1:])]
        for word in listed:
            got = spelling.near(word, listed, shared, 0)
            assert got == [i for i, other in enumerate(listed) if edits_one(word, other)]


def test_query_of_variants_on_the_documents(spark):
    found = queries.QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = spelling.word_counts(docs).where("length(word) >= 5 and n >= 3")
    assert bag(found.select("word", "n")) == bag(counts)
    rows = [tuple(r) for r in docs.collect()]
    kept = Counter(w for _, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "")))
    words = {w: n for w, n in bag(found.select("word", "n"))}
    assert len(words) > 100 and len(kept) > len(words)
    # every word's near words, by deletion keys
    keys = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            keys.setdefault(key, set()).add(w)
    for r in found.collect():
        w = r["word"]
        around = {v for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for v in keys[key]}
        near = [v for v in around if edits_one(w, v)]
        assert r["n_near"] == len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 2 * words[w] else None
        assert r["form"] == form and r["form_n"] == (words[form] if form else None)


# importance resampling

def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_resampled(rows, target, runs=1, buckets=10000, percent=10, min_words=20, seed="2024"):
    def features(text):
        found = tokens(text)
        return [
            zlib.crc32(" ".join(found[i : i + n]).encode()) % buckets
            for n in range(1, runs + 1) for i in range(len(found) - n + 1)
        ]

    s = Counter(b for _, t in rows for b in features(t))
    t = Counter(b for text in target for b in features(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))
    )
    out, drawable = [], []
    for k, (ident, text) in enumerate(rows):
        found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        name = f"{seed}:{'' if ident is None else ident}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([ident, len(found), weight, score, None])
        if len(tokens(text)) >= min_words:
            drawable.append(k)
    drawable.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0]))
    for rank, k in enumerate(drawable[: percent * len(drawable) // 100], 1):
        out[k][4] = rank
    return Counter(map(tuple, out))


def prose(seed, n):
    rng = random.Random(seed)
    base = ["Alpha", "beta", "GAMMA", "δέλτα", "x1", "7", "日本", "\U0001f600", "İz"]
    rare = [f"rare{k}" for k in range(200)]
    gaps = [" ", "-", "\n", "_", "\x7f", "@"]
    body = lambda k: "".join(
        rng.choice(base if rng.random() < 0.8 else rare) + rng.choice(gaps) for _ in range(k)
    )
    rows = [(k, body(rng.randint(0, 80))) for k in range(n)]
    return rows + [(None, body(40)), (None, None), (n, None), (n + 1, ""), (n + 2, "..."), (3, body(25)),
                   (n + 3, body(20000))]


@pytest.mark.parametrize("runs, buckets, head", [(1, 10000, 20000), (2, 97, 50), (3, 1000, 10)])
def test_resampled_equals_brute_force(spark, runs, buckets, head):
    rows = prose(runs, 120)
    target = ["Alpha beta rare7 rare8", None, "", "日本 x1 x1 beta"]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, _id int")
    got = resample.resampled(
        frame(spark, rows).repartition(4), wanted, runs=runs, buckets=buckets, head=head, percent=30
    )
    assert [k for _, k in got.dtypes] == ["bigint"] * 5
    assert bag(got) == brute_resampled(rows, target, runs, buckets, 30)


def test_resampling_repeated_rows_and_nothing(spark):
    rows = [(7, "word " * 20)] * 50 + [(k, "other " * 25) for k in range(50)]
    target = spark.createDataFrame([], "text string")
    got = resample.resampled(frame(spark, rows).repartition(5), target)
    want = brute_resampled(rows, [])
    assert Counter(r[:4] for r in got.collect()) == Counter({k[:4]: 0 for k in want}) + Counter(
        r[:4] for r in want.elements()
    )
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 11))
    assert resample.resampled(frame(spark, []), target).count() == 0


def test_head_is_bounded_and_changes_nothing(spark):
    texts = frame(spark, prose(4, 60)).select(F.coalesce("text", F.lit("")).alias("_text"))
    head = resample.head_of(texts, 2, 500, head=200)
    assert 0 < len(head.states) < 20 and 0 < len(head.pairs) <= 200
    found = resample.words("alpha beta GAMMA rare7 alpha 日本")
    for runs in (1, 2, 3, 4):
        assert head.coded(found, runs).tolist() == resample.Head(500).coded(found, runs).tolist()


def test_query_of_resampling_on_the_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("text").collect()]
    assert bag(queries.QUERIES["op12_importance_resampling"](spark, folder)) == brute_resampled(rows, target)


# exact search

def brute_topk(rows, k, every):
    good = []
    for rid, (ident, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((rid, ident, [math.floor(1024 * x) for x in v]))
    out = Counter()
    for rid, ident, q in good:
        if ident is not None and ident % every == 0:
            scored = [
                (-sum(a * b for a, b in zip(q, v)), other is None, other or 0, r, other)
                for r, other, v in good if r != rid and len(v) == len(q)
            ]
            for rank, (score, _, _, _, other) in enumerate(sorted(scored)[:k], 1):
                out[(ident, rank, other, -score)] += 1
    return out


def points(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * np.linspace(spread, 0.1, dim)
    x[: n // 3] = x[0]  # one vector with a third of all rows
    return [(int(k), [float(v) for v in row]) for k, row in enumerate(x)]


AWKWARD = [
    (None, [1.0] * 12), (500, None), (501, [1.0, None] * 6), (502, [float("nan")] * 12), (500, [0.0] * 12),
    (503, [float("inf")] * 12), (504, []), (600, []), (700, [0.5] * 3), (701, [0.25] * 3), (100, [2.0] * 12),
    (1000, [1.0]),
]


@pytest.mark.parametrize("seed, k", [(0, 10), (1, 1), (2, 400)])
def test_topk_equals_brute_force(spark, seed, k, monkeypatch):
    monkeypatch.setattr(vertical_topk, "PASS", 20)
    rows = points(seed, 300, 12, 4.0) + AWKWARD
    table = frame(spark, rows, VECTORS, (1, 2, "x", 4)).repartition(4)
    got = vertical_topk.top_k(table, F.col("vec_id") % 5 == 0, k=k, group=5)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert bag(got) == brute_topk(rows, k, 5)


def test_topk_of_numbers_beyond_doubles(spark):
    rows = [(k, [1e5 * k + 0.1, 3e5, -2e4 * k, 1e6]) for k in range(30)]
    got = vertical_topk.top_k(frame(spark, rows, VECTORS, (1, 2, "x", 4)), F.col("vec_id") % 10 == 0, scale=1024.0)
    assert bag(got) == brute_topk(rows, 10, 10)
    big = frame(spark, [(k, [1e30]) for k in range(3)], VECTORS, (1, 2, "x", 4))
    with pytest.raises(Exception, match="beyond 64 bits"):
        vertical_topk.top_k(big, F.col("vec_id") == 0).collect()


def test_topk_of_nothing(spark):
    assert vertical_topk.top_k(frame(spark, [], VECTORS, ()), F.col("vec_id") == 0).count() == 0
    rows = frame(spark, [(1, [1.0]), (None, [1.0])], VECTORS, (1, 2, "x", 4))
    assert vertical_topk.top_k(rows, F.col("vec_id") == 0).count() == 0


def test_topk_prunes():
    """Survivors shrink from group to group: a concentrated query table computes few whole sums."""
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.normal(size=(400, 64)) * np.geomspace(4, 0.01, 64))
    sure = vertical_topk._sure(x, 10)
    assert np.isfinite(sure).all()
    masses = vertical_topk._masses(x, list(range(0, 64, 8)))
    first = x[:, :8] @ x[:, :8].T + np.outer(masses[:, 1], masses[:, 1])
    assert (first >= sure[:, None]).mean() < 0.2


def test_query_of_search_equals_its_sql(spark):
    problem, rows = compare(
        queries.QUERIES["op13_exact_topk"](spark, data_dir()), queries.ORACLES["op13_exact_topk"], data_dir()
    )
    assert problem is None and rows > 0


CHEAP = [n for n in queries.QUERIES if n not in ("op1_toxicity", "op6_lattice_lm", "op10_byte_cnn")]


@pytest.mark.parametrize("name", CHEAP)
def test_plans_hold_no_cross_join_and_no_row_at_a_time_python(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan
    if name in ("op3_line_dedup", "op9_quality_rules"):
        assert not re.search("Python|Pandas|Arrow", plan)
