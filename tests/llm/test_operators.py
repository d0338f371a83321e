"""The training-data operators against brute force, on hand-made tables with awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from monthwise.llm import byte_cnn, components, decision_list, lattice_lm, lengths, line_dedup
from monthwise.llm import packing, piece_bpe, pq_dedup, queries, simhash, tokens, toxicity
from monthwise.llm.common import labelled_ids, labelled_texts, one_text_each, remainder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
GAPS = " \t\n\x0b\x0c\r"
#: Extra columns whose names the operators use themselves.
SCHEMA = "doc_id bigint, text string, _id int, _fp int, row string, kept int, _text string, piece int"


def words(text):
    return [w for w in (text or "").translate({ord(c): " " for c in GAPS}).split(" ") if w]


def awkward():
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, odd characters."""
    rng = random.Random(5)
    base = ["alpha", "beta", "Gamma", "δέλτα", "épsilon", "zeta.", "eta,", "日本", "😀", "the"]
    body = lambda n: " ".join(rng.choice(base) for _ in range(n))
    shared = "  A shared LINE\t"
    texts = [None, "", " ", "\n\n", "one", "two words", "x y", "a\r\nb\x0bc", body(30000)]
    texts += [f"{shared}\n{body(12)}\n\nend {k}" for k in range(12)]
    texts += ["a shared line", "A SHARED LINE\na shared line"]
    near = body(400)
    texts += [near, near, near + " beta", near.replace("zeta.", "zeta", 1), near.upper()]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(None, "no id"), (None, None), (3, "same id, other text"), (4, "one"), (4, "one")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 1, 2, "x", 3, "y", 4) for r in awkward()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


# line dedup

def test_common_lines_go_everywhere(docs):
    key = lambda line: line.strip(GAPS).translate({k: k + 32 for k in range(65, 91)})
    rows = [(i, (t or "").split("\n")) for i, t in awkward()]
    seen = Counter(k for _, lines in rows for k in {key(x) for x in lines} if k)
    want = Counter()
    for ident, lines in rows:
        kept = [x for x in lines if seen[key(x)] < 10]
        want[(ident, "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    got = line_dedup.without_common_lines(docs, min_docs=10, batches=5, fanout=2)
    assert bag(got.select("row.doc_id", "kept", "n_lines", "n_dropped"),
               "doc_id", "kept", "n_lines", "n_dropped") == want
    assert sum(n for (_, _, _, d), n in want.items() if d) >= 13
    assert got.select("row.*").columns == docs.columns


def test_runs_merge_by_level(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
    for _ in range(5):
        runs.add(spark.createDataFrame([(1, 1), (2, 2)], "_h1 bigint, _h2 bigint"))
    runs.add(spark.createDataFrame([(3, 3)], "_h1 bigint, _h2 bigint"))
    assert [len(level) for level in runs.levels] == [0, 1, 1]
    assert bag(runs.common(), "_h1", "_h2") == {(1, 1): 1, (2, 2): 1}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_are_merge_joined_as_they_lie(spark):
    """Only the batch's own counts are exchanged and sorted; runs are read in order, bucket by bucket."""
    keys = spark.range(4000).select((F.col("id") % 300).alias("_h1"), (F.col("id") % 300 * 7).alias("_h2"))
    runs = line_dedup.LineRuns(spark, min_docs=10, fanout=3, buckets=5)
    runs.add(keys)
    runs.add(keys.where("_h1 < 400"))
    anti = plan_of(runs.fresh(keys))
    assert anti.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in anti
    assert anti.count("Exchange") == 1 and anti.count("Sort [") == 1
    assert anti.index("SortMergeJoin") < anti.index("HashAggregate") < anti.index("Exchange")
    merging = plan_of(runs.merged(runs.levels[0]))
    assert "SortMergeJoin" in merging and "Exchange" not in merging and "Sort [" not in merging
    assert runs.fresh(keys).count() == 0
    assert bag(runs.common(), "_h1") == {(i,): 1 for i in range(300)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_")]


def test_more_runs_a_level_and_other_bucket_counts_give_the_same(spark):
    want = {(i,): 1 for i in range(50)}
    for fanout, buckets in ((2, 1), (3, 4), (4, 7)):
        runs = line_dedup.LineRuns(spark, min_docs=9, fanout=fanout, buckets=buckets)
        for batch in range(9):
            rows = spark.range(100).where(F.col("id") < 50 + batch)
            runs.add(rows.select(F.col("id").alias("_h1"), F.lit(7).cast("long").alias("_h2")))
        assert bag(runs.common(), "_h1") == want


# packing

def brute_pieces(size):
    out = Counter()
    encoder = tokens.byte_bpe(BYTE_BPE).library()
    for ident, text in awkward():
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids), size), len(ids)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            out[(ident, k, s, e - s, zlib.crc32(ids[s:e].tobytes()))] += 1
    return out


def test_pieces_fill_sequences(docs, nothing):
    pieces = packing.token_pieces(docs, BYTE_BPE, 64)
    packed = packing.pack(pieces, 64, buckets=3)
    rows = packed.collect()
    assert bag(packed, "doc_id", "piece", "start", "length", "ids_crc32") == brute_pieces(64)
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) <= 1.01 * math.ceil(sum(r["length"] for r in rows) / 64)
    assert packing.pack(packing.token_pieces(nothing, BYTE_BPE), buckets=2).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 2, 7, 16, 64, 300])
    counts = {rng.randint(1, size): rng.choice([1, 2, 3, 50, 1000]) for _ in range(rng.randint(0, 30))}
    plan = packing.Plan(counts, size)
    room, used = Counter(), Counter()
    spans = {}
    for length, rank, bins, copies, first, offset in plan.slots:
        assert rank == used[length]
        used[length] += bins * copies
        for b in range(first, first + bins):
            room[b] += length * copies
            spans.setdefault(b, []).append((offset, offset + length * copies))
    assert used == Counter(counts)
    assert all(n <= size for n in room.values()) and len(room) == plan.sequences
    for parts in spans.values():
        at = 0
        for start, end in sorted(parts):
            assert start == at
            at = end
    total = sum(a * n for a, n in counts.items())
    assert plan.sequences <= 2 * math.ceil(total / size) + 1


def spread_histogram(rng):
    size = rng.choice([16, 64, 300, 2048])
    shape = rng.choice(["even", "log-normal", "few", "short"])
    lengths = {
        "even": lambda: rng.randint(1, size), "few": lambda: rng.choice([size // 3 + 1, size // 2, 3, size]),
        "log-normal": lambda: max(1, min(size, int(rng.lognormvariate(math.log(size) - 1.5, 1)))),
        "short": lambda: rng.randint(1, max(1, size // 8)),
    }[shape]
    return Counter(lengths() for _ in range(rng.choice([10, 400, 3000]))), size


@pytest.mark.parametrize("seed", range(30))
def test_no_more_sequences_than_best_fit_alone(seed):
    counts, size = spread_histogram(random.Random(seed))
    plans = [packing.Plan(counts, size, parts) for parts in range(4)]
    best = packing.best_plan(counts, size)
    assert best.sequences == min(p.sequences for p in plans) <= plans[0].sequences
    total = sum(a * n for a, n in counts.items())
    assert best.sequences >= math.ceil(total / size)
    used = Counter()
    for length, _, bins, copies, _, _ in best.slots:
        used[length] += bins * copies
    assert used == counts


def test_sums_of_pairs_and_triples_are_indexed():
    plan = packing.Plan({}, 40)
    for length in (3, 8, 17):
        plan.left[length] = 1
    pairs, triples = plan._sums()
    assert set(np.flatnonzero(pairs)) == {6, 11, 16, 20, 25, 34}
    assert set(np.flatnonzero(triples)) == {9, 14, 19, 24, 23, 28, 33, 37}


def test_exact_complements_are_used():
    assert packing.Plan({10: 5, 6: 5}, 16).sequences == 5
    assert packing.Plan({10: 4, 4: 4, 2: 4}, 16).sequences == 4
    assert packing.Plan({7: 3, 4: 3, 3: 3, 2: 3}, 16).sequences == 3


def test_fast_ids_are_the_library_s():
    from tokenizers import Tokenizer

    encoder, library = tokens.byte_bpe(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    assert encoder.ids("a <|endoftext|>b").tolist().count(50256) == 1
    rng = random.Random(2)
    odd = ["<|endoftext|>", " ", "  ", "\n", "'s", "é", "日本", "😀", " ", "12", "a" * 300, "!!", "\x00"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 20))) for _ in range(500)]
    for text in [*texts, *[t for _, t in awkward() if t is not None], " " * 5000]:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == want


def test_length_histogram(docs, nothing):
    encoder = tokens.byte_bpe(BYTE_BPE)
    sizes = [len(encoder.ids(t or "")) for _, t in awkward()]
    rows = lengths.length_histogram(lengths.encoded_lengths(docs, BYTE_BPE)).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(set(sizes))
    for r in rows:
        limit = r["n_tokens"]
        assert r["n_docs"] == sizes.count(limit)
        assert r["n_longer"] == sum(n > limit for n in sizes)
        assert r["n_within"] == sum(n <= limit for n in sizes)
        assert r["tokens_within"] == sum(n for n in sizes if n <= limit)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in sizes)
        assert r["quantile"] == pytest.approx(r["n_within"] / len(sizes))
    assert lengths.length_histogram(lengths.encoded_lengths(nothing, BYTE_BPE)).count() == 0


# pieces

def test_pieces_equal_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = piece_bpe.piece_bpe(PIECES)
    rng = random.Random(3)
    odd = ["a", "b", "e", "th", "in", "▁", " ", "  ", "\n", "\t", "é", "日本", "😀", "'", "00", " " * 17, "ing", "\x00", "ß"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    for text in [*texts, " " * 100, "x" * 400, *[t for _, t in awkward() if t]]:
        ids = codec.encode(text)
        assert ids == library.encode(text)
        assert codec.decode(ids) == library.decode(ids)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(260), rng.randrange(32000), 28705]) for _ in range(6)]
        assert codec.decode(ids) == library.decode(ids)


def test_encoded_documents(docs, nothing):
    codec = piece_bpe.piece_bpe(PIECES)
    got = piece_bpe.encode_and_decode(docs, PIECES)
    assert got.columns == [*(c for c in docs.columns if c != "text"), "_ids", "_decoded"]
    want = Counter()
    for ident, text in awkward():
        ids = codec.encode(text or "")
        want[(ident, tuple(ids), text or "")] += 1
    assert Counter((r["doc_id"], tuple(r["_ids"]), r["_decoded"]) for r in got.collect()) == want
    back = piece_bpe.decode(got.drop("_decoded"), PIECES)
    assert bag(back, "doc_id", "_decoded") == bag(got, "doc_id", "_decoded")
    assert piece_bpe.encode_and_decode(nothing, PIECES).count() == 0


# simhash

def brute_fingerprint(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    all_words = words(lower)
    if not all_words:
        return 0
    count = max(1, len(all_words) - n + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(all_words[k : k + n]).encode(), 42) for k in range(count)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance):
    group = {f: f for f in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= distance:
                old, new = group[a], group[b]
                group = {f: new if g == old else g for f, g in group.items()}
    return group


def test_simhash_components(docs, nothing):
    rows = [(i, brute_fingerprint(t)) for i, t in awkward()]
    group = brute_groups({f for _, f in rows}, 2)
    first = {}
    for ident, f in rows:
        if ident is not None:
            first[group[f]] = min(ident, first.get(group[f], ident))
    want = Counter((i, f - (f >> 63 << 64), first.get(group[f])) for i, f in rows)
    got = simhash.simhash_components(docs)
    assert bag(got, "doc_id", "_fp", "_component") == want
    assert simhash.simhash_components(nothing).count() == 0
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = [group[brute_fingerprint(t)] for _, t in found]
    assert len(groups) == len(set(groups)) == len(set(group.values()))
    assert all(first.get(g) == i for g, (i, _) in zip(groups, found))
    assert simhash.keep_one_of_each(nothing).count() == 0


@pytest.mark.parametrize("distance,width", [(0, 2), (1, 2), (2, 2), (2, 4), (3, 4)])
def test_grid_join_finds_every_link(spark, distance, width):
    rng = random.Random(distance * 10 + width)
    prints = {0, 2**64 - 1}
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(12):
            prints.add(f)
            f ^= 1 << rng.randrange(64)
    signed = [(f - (f >> 63 << 64),) for f in prints]
    got = simhash.near_links(spark.createDataFrame(signed, "_fp bigint").repartition(4), distance, width)
    found = {frozenset((r["_a"] % 2**64, r["_b"] % 2**64)) for r in got.collect()}
    listed = sorted(prints)
    want = {
        frozenset((a, b)) for k, a in enumerate(listed) for b in listed[k + 1 :]
        if (a ^ b).bit_count() <= distance
    }
    assert found == want


def test_components_of_paths_stars_and_nulls(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    links += [(7, 7), (None, 3), (500, None), (200, 201), (201, 200), (200, 201)]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {200: 200, 201: 200}
    assert {r["node"]: r["component"] for r in got.collect()} == want and got.count() == len(want)
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(empty, "a", "b").count() == 0


# language model

def test_base_scores_and_marginals(docs, nothing, spark):
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    counts = Counter()
    for ident, text in awkward():
        if not held(ident):
            counts.update([*words(lower(text)), ""])
    total, distinct = sum(counts.values()), len(counts)
    want = {}
    for ident, text in awkward():
        body = [*words(lower(text)), ""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in body)
        row = (held(ident), len(body), sum(counts[w] > 0 for w in body))
        want.setdefault(ident, []).append((row, round(base, 6)))
    rows = lattice_lm.lattice_scores(docs, PIECES, block_chars=2000).collect()
    got = {}
    for r in rows:
        row = (r["held_out"], r["n_tokens"], r["n_known"])
        got.setdefault(r["doc_id"], []).append((row, round(r["base_score"], 6)))
        assert r["train_tokens"] == total and r["score"] < 0
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert lattice_lm.lattice_scores(nothing, PIECES).count() == 0
    only_held = spark.createDataFrame([(None, "new words")], "doc_id bigint, text string")
    alone = lattice_lm.lattice_scores(only_held, PIECES).first()
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and math.isfinite(alone["score"])


def test_forward_sums_all_segmentations():
    net = lattice_lm.lattice(PIECES)
    log = np.log(net.prior).tolist()
    for word in ("the", "hello", "aa", "naïve", "日本x", "\x00a"):
        text = "▁" + word
        at = {}
        for start, end, arc in net.arcs(word):
            weight = log[arc] if arc >= 0 else net.byte_weight(text, arc, log)
            at.setdefault(start, []).append((end, weight))

        def ways(place):
            if place == len(text):
                return 1.0
            return sum(math.exp(w) * ways(end) for end, w in at.get(place, []))

        assert net.forward(word, net.arcs(word), log)[-1] == pytest.approx(math.log(ways(0)))
        uses = np.zeros(len(log))
        net.expected(word, log, uses)
        spelt = sum(n * len(name) for n, name in _uses(net, uses))
        assert spelt == pytest.approx(len(text.encode()))


def _uses(net, uses):
    names = {arc: name for name, (arc, _) in net.matcher.items()}
    return [(n, names[k].encode() if k in names else b"x") for k, n in enumerate(uses) if n]


# vectors

def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 8))
    rows = []
    for k in range(400):
        v = base[k % 12] + rng.normal(scale=0.12, size=8)
        rows.append((k, [float(x) for x in v], k % 3))
    hot = rows[5][1]
    rows += [(1000 + k, hot, 2) for k in range(50)] + [(5, hot, 2)]
    rows += [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] * 8, 1),
             (2003, [None, *[1.0] * 7], 1), (2004, hot, None), (2005, [float("inf")] * 8, 1),
             (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (2008, [], 1), (None, hot, 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = pq_dedup.vector_components(frame.withColumn("_node", F.lit(1)), sigmas=9.0, members=4)

    def fine(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if fine(v, l) else None for _, v, l in rows]
    n = len(rows)
    group = list(range(n))
    links = [0] * n
    for a in range(n):
        for b in range(n):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]:
                if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93:
                    links[a] += 1
                    old, new = group[a], group[b]
                    if old != new:
                        group = [new if g == old else g for g in group]
    want = Counter()
    for a in range(n):
        ids = [rows[b][0] for b in range(n) if group[b] == group[a] and rows[b][0] is not None]
        own = rows[a][0] if unit[a] is None else min(ids, default=None)
        want[(rows[a][0], links[a], own)] += 1
    assert bag(got, "vec_id", "_n_links", "_component") == want
    assert max(links) > 50
    empty = pq_dedup.vector_components(frame.where("false"))
    assert empty.count() == 0


@pytest.mark.parametrize("rank, dim", [(2, 64), (4, 256), (8, 128), (16, 256), (64, 64), (128, 128)])
def test_links_at_the_default_setting(spark, rank, dim):
    """Planted near copies on vectors that spread over few or many directions; nearly all links are found."""
    rng = np.random.default_rng(rank)
    flat = np.linalg.qr(rng.normal(size=(dim, rank)))[0].T
    base = rng.normal(size=(900, rank))
    base = np.concatenate([base, base[:300] + rng.normal(scale=0.25, size=(300, rank))])
    x = (base @ flat).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.93
    np.fill_diagonal(linked, False)
    rows = [(k, [float(v) for v in r], 1) for k, r in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)
    got = {r["vec_id"]: r["_n_links"] for r in pq_dedup.vector_components(frame, members=16).collect()}
    found = np.array([got[k] for k in range(len(x))])
    assert (found <= linked.sum(1)).all() and linked.sum() > 100
    assert found.sum() >= 0.99 * linked.sum()
    assert pq_dedup.effective_rank(unit) <= 1.05 * rank


def test_vectors_are_shipped_exactly():
    rng = np.random.default_rng(1)
    for v in (rng.normal(size=8).astype(np.float32).astype(float), rng.normal(size=8)):
        back = pq_dedup._unpacked([pq_dedup._packed(v)], 8)[0]
        assert (back == pq_dedup._unit([v])[0]).all()
    assert len(pq_dedup._packed(np.ones(8))) == 32 and len(pq_dedup._packed(np.full(8, 0.1))) == 64


@pytest.mark.parametrize("dim", [1, 2, 5, 8])
def test_lists_of_halves_hold_every_neighbour(dim):
    """Where a neighbour lies, its list passes the borders of both halves together, coinciding centroids included."""
    rng = np.random.default_rng(dim)
    x = pq_dedup._unit(np.round(rng.normal(size=(600, dim)), 0 if dim > 2 else 2) + 1e-3)
    index = pq_dedup.fit(x, 30)
    near = pq_dedup._unit(x + rng.normal(size=x.shape) * 0.1)
    reach = np.linalg.norm(x - near, axis=1)
    home, (first, second) = index.borders(x)
    other, _ = index.borders(near)
    width = len(index.halves[1])
    rows = np.arange(len(x))
    border = first[rows, other // width] ** 2 + second[rows, other % width] ** 2
    assert (border <= reach**2 + 1e-9).all()
    assert (home < len(index.halves[0]) * width).all()
    assert dim == 1 or len(set(home)) > 4 and (home != other).any()


def test_lists_grow_with_the_table_beyond_the_sample():
    assert [pq_dedup.lists_for(n, 256) for n in (0, 100, 5120, 10**6, 10**10)] == [1, 1, 20, 1000, 10**5]
    x = pq_dedup._unit(np.random.default_rng(3).normal(size=(2000, 8)))
    index = pq_dedup.fit(x, 10**4)
    assert len(index.halves[0]) * len(index.halves[1]) == 10**4  # five times the sample


# quality rules

def test_statistics_equal_brute_force(docs, nothing):
    want = Counter()
    for ident, text in awkward():
        w = words(text)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        times = Counter(windows)
        covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        want[(ident, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
              len(lines) - len(set(lines)), len(covered))] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert bag(decision_list.text_statistics(docs), *names) == want
    assert max(k[-1] for k in want) > 1000
    assert decision_list.text_statistics(nothing).count() == 0


def test_rules_find_planted_conjunction(spark):
    rng = random.Random(9)
    names = list(decision_list.rates())
    rows = []
    for k in range(3000):
        values = [rng.random() for _ in names]
        bad = values[1] > 0.7 and values[5] <= 0.4 or values[3] > 0.9
        rows.append((k, 0 if bad else 1, *values))
    frame = spark.createDataFrame(
        rows, "_id bigint, _label int, " + ", ".join(f"{n} double" for n in names)
    )
    rules = decision_list.learn_rules(frame, precision=0.9)
    judged = frame.withColumn("kept", decision_list.verdict(rules))
    right = judged.where((F.col("_label") == 1) == F.col("kept")).count()
    assert rules and right >= 0.97 * 3000
    assert decision_list.learn_rules(frame.where("false")) == []
    assert decision_list.learn_rules(frame.where("_label = 1")) == []


def test_rules_without_labels(docs, spark):
    labels = spark.createDataFrame([(None, 0), (10**6, 0), (1, None)], "doc_id bigint, quality int")
    judged, rules = decision_list.quality_rules(docs, labels)
    assert rules == [] and judged.count() == len(awkward())
    assert judged.where("kept = base_failed").count() == 0


# classifiers

def marked_documents(spark, n=700):
    rng = random.Random(8)
    syllables = ["ka", "lo", "mi", "ten", "ra", "sul", "por", "ed"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for k in range(n):
        text = [word() for _ in range(rng.randint(8, 60))]
        toxic, poor = k % 4 == 0, k % 5 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["zorgface", "zorgling", "blarg"]))
        if poor:
            text = [w.upper() + "$$$" for w in text]
        rows.append((k, " ".join(text) + "."))
        labels.append((k, 0 if poor else 1, int(toxic)))
    labels += [(None, 1, 1), (10**6, 0, 1), (5, None, None)]
    rows += [(None, None), (10**7, ""), (10**7, "kalo " * 30000)]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def accuracy(scored, labels, column, held):
    both = scored.join(labels, "doc_id").where(held & F.col(column).isNotNull())
    right = (F.col("_score") >= 0.5) == (F.col(column) == 1)
    return both.select(F.avg(right.cast("double"))).first()[0]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = marked_documents(spark)
    model = toxicity.fit(docs, labels, remainder(F.col("_id"), 5) != 0)
    assert {w[:4] for w in [*model.words, *model.beginnings]} == {"zorg", "blar"}
    scored = docs.withColumn("_score", toxicity.toxicity_score(F.col("text"), model))
    assert accuracy(scored, labels, "toxic", remainder(F.col("doc_id"), 5) == 0) > 0.98
    assert scored.where("_score between 0 and 1").count() == docs.count()
    none = toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert not none.words and 0 <= toxicity.score("", none, toxicity.finder(none)) < 0.5


def kinds_in_order(model):
    """The grammar decides whatever was learned: threats, negation, reports and targets keep their places."""
    machine = toxicity.finder(model)
    of = lambda text: toxicity.score(text, model, machine)
    word = max([*model.words, *model.beginnings], key=model.insult)
    assert of("i will kill you") >= 0.5 and of("we shall burn them") >= 0.5
    assert of("i will not kill you") < of("i will kill you") > of("he said i will kill you")
    assert of(f"not a {word}") < of(f"a {word}") > of(f"somebody said {word}")
    assert of(f"you are not a {word}") < of(f"you are a {word}") >= of(f"a {word}") >= 0.5
    assert of("a quiet day") == model.share < 0.5


@pytest.mark.parametrize("seen", ["plain", "target", "negated", "reported", "mixed"])
def test_kinds_keep_their_order_in_fitted_models(spark, seen):
    """Whichever kinds of matches the labels hold, all of them toxic."""
    rng = random.Random(seen)
    ways = {"plain": "a {}", "target": "you {}", "negated": "not a {}", "reported": "they said {}"}
    rows = []
    for k in range(600):
        rest = " ".join(rng.choices([f"n{i}" for i in range(60)], k=12))
        way = ways[rng.choice(list(ways)) if seen == "mixed" else seen]
        last = way.format(rng.choice(["zorg", "blarg", "grumpel"] if k % 3 == 0 else ["n1", "n2"]))
        rows.append((k, f"{rest}. {last}.", int(k % 3 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([r[::2] for r in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert {w[:4] for w in [*model.words, *model.beginnings]} == {"zorg", "blar", "grum"}
    kinds_in_order(model)
    machine = toxicity.finder(model)
    scores = [(toxicity.score(t, model, machine) >= 0.5, bool(y)) for _, t, y in rows]
    assert sum(a == b for a, b in scores) > 0.99 * len(scores)


def test_kinds_keep_their_order_on_the_documents(spark):
    kinds_in_order(queries.toxicity_model(spark, "/root/testdata/sf0.01"))


def brute_score(text, model):
    """A score from the definition: classes by looking at the words of each clause, no transducers."""
    lexicon, clauses = model.lexicon, []
    for words in toxicity.clauses((text or "").lower(), lexicon):
        kinds = [model.symbol(w) for w in words]
        names = [k for k, _ in kinds]
        found = Counter()
        for i, (kind, weight) in enumerate(kinds):
            if kind not in ("insult", "threat"):
                continue
            # a negation reaches the four next words; marks of quotations don't count
            before = [n for n in names[:i] if n != "quote"][-toxicity.SCOPE:]
            negated, told = "not" in before, any(n in ("said", "quote") for n in names[:i])
            target = "target" in names
            if kind == "threat":
                if target and negated and told:  # a match without weight
                    found["insult:not:said"] += 0.0
                elif target:
                    found["threat:target" + (":not" if negated else ":said" if told else "")] += weight
            elif negated or told:
                found["insult" + ":not" * negated + ":said" * told] += weight
            else:
                found["insult:target" if target else "insult"] += weight
        if found:
            clauses.append(found)
    if not clauses:
        return model.share
    heavy = max(clauses, key=lambda f: sum(model.weights[c] * v for c, v in f.items()))
    z = model.offset + model.more * math.log(len(clauses))
    z += sum(model.weights[c] * v for c, v in heavy.items())
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_equal_a_brute_force_reading(spark):
    model = queries.toxicity_model(spark, "/root/testdata/sf0.01")
    rng = random.Random(2)
    vocabulary = [*list(model.words)[:6], "you", "them", "not", "said", "kill", "burn", "a", "day", "he", ":", ".", ",",
                  '"', "\n"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 25))) for _ in range(1500)]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    machine = toxicity.finder(model)
    for text in texts:
        assert toxicity.score(text or "", model, machine) == pytest.approx(brute_score(text, model)), text


def test_a_lexicon_of_ones_own():
    lexicon = toxicity.Lexicon(targets=("zu",), threats=("krak",), negations=("ne",), reports=("rek",), no_speakers=())
    model = toxicity.Model(words={"blarg": 4.0}, lexicon=lexicon)
    machine = toxicity.finder(model)
    found = lambda text: [dict(f) for f in toxicity.matches(text, model, machine)]
    assert found("krak zu") == [{"threat:target": 1.0}] and found("i will kill you") == []
    assert found("ne blarg") == [{"insult:not": 4.0}] and found("you blarg") == [{"insult": 4.0}]
    assert found("blarg, on rek") == [{"insult:said": 4.0}]
    empty = toxicity.Lexicon((), (), (), (), ())
    plain = toxicity.Model(words={"blarg": 4.0}, lexicon=empty)
    assert [dict(f) for f in toxicity.matches('not "you blarg", he said', plain, machine)] == [{"insult": 4.0}]


def test_grammar_composes_transducers():
    model = toxicity.Model(words={"blarg": 4.0})
    features = lambda text: dict(toxicity.clause_features(text, model))
    assert features("a blarg thing") == {"insult": 4.0}
    assert features("you blarg") == {"insult:target": 4.0}
    assert features("this is not a blarg") == {"insult:not": 4.0}
    assert features("they said blarg") == {"insult:said": 4.0}
    assert features("not so many words away blarg")["insult"] == 4.0
    assert features("we will kill you") == {}
    assert features("you i will kill") == {"threat:target": 1.0}
    assert features("a quiet day") == {}
    machine = toxicity.finder(model)
    plain, negated = (toxicity.score(t, model, machine) for t in ("you blarg", "you are not a blarg"))
    assert plain > negated > 0
    assert toxicity.score("you blarg", model, machine) < toxicity.score("you blarg. blarg!", model, machine)


def test_targets_on_either_side_of_the_verb():
    model = toxicity.Model(words={"blarg": 4.0})
    machine = toxicity.finder(model)
    found = lambda text: [dict(f) for f in toxicity.matches(text, model, machine)]
    for text in ("I will kill you", "we will kill you", "beat them", "You I will kill", "you will kill them"):
        assert found(text) == [{"threat:target": 1.0}], text
        assert toxicity.score(text, model, machine) == toxicity.score("you i will kill", model, machine)
    assert toxicity.score("i will kill you", model, machine) >= 0.5 > model.share
    assert found("i will not kill you") == [{"threat:target:not": 1.0}]
    assert found("somebody said i will kill you") == [{"threat:target:said": 1.0}]
    assert found("blarg are you") == found("you blarg") == [{"insult:target": 4.0}]
    assert found("not a blarg are you") == [{"insult:not": 4.0}]
    assert found("beat the eggs. you and i") == []


def test_quotations_are_reported_from_either_side():
    model = toxicity.Model(words={"blarg": 4.0})
    machine = toxicity.finder(model)
    found = lambda text: [dict(f) for f in toxicity.matches(text, model, machine)]
    reported = [{"insult:said": 4.0}]
    for text in (
        "They said you blarg", "he said: you blarg", "he wrote:\nnote: you blarg", "you blarg, he said",
        "you blarg, said the man", '"You blarg!" the man said', "„du blarg!“, sagte er",
        'he said "hello. you blarg"', 'he said: "hello. you blarg! go."', "« toi blarg », dit il",
        '"hello. you blarg. go!" she said.',
    ):
        assert found(text) == reported, text
        assert toxicity.score(text, model, machine) < 0.5 < toxicity.score("you blarg", model, machine)
    direct = [{"insult:target": 4.0}]
    for text in (
        "you blarg", "note: you blarg", "he said hello. you blarg", "you blarg, nobody said so",
        "you blarg, you said so", 'he said: "hello". you blarg', 'he said "a. b". you blarg',
        '"you blarg!" and left. he said no', 'you blarg "hello" he said',
    ):
        assert found(text) == direct, text
    assert found("i will kill you, he said") == [{"threat:target:said": 1.0}]
    assert found('not one of "blarg kind", he said') == [{"insult:not:said": 4.0}]
    whole = "a. b c:d\n e! \"f g. h\" i|"
    assert [w for c in toxicity.clauses(whole) for w in c] == list("abcdefghi")


def test_an_id_counts_once_in_the_toxicity_sample(spark):
    docs, labels = marked_documents(spark)
    many = docs.where("doc_id = 4").crossJoin(spark.range(300)).selectExpr(
        "doc_id", "concat(text, ' grumpel ', id) as text"
    )
    ids = labelled_ids(labels, "toxic", F.lit(True), 1000, 1000)
    got = one_text_each(labelled_texts(docs.union(many), ids))
    assert got.count() == got.select("_id").distinct().count() == 700
    again = one_text_each(labelled_texts(many.union(docs).repartition(5), ids))
    assert again.exceptAll(got).isEmpty()
    model = toxicity.fit(docs.union(many), labels, F.lit(True))
    assert not any(w.startswith("grum") for w in [*model.words, *model.beginnings])
    assert {w[:4] for w in [*model.words, *model.beginnings]} == {"zorg", "blar"}


def test_copies_of_a_long_text_do_not_displace_insults(spark):
    stems = [a + b + c + d for a in "bdfgkl" for b in "aeiou" for c in "mnprstvxzw" for d in "aeiouhjcyq"]
    long = " ".join(p + s + "tlo" for p in "wxy" for s in stems)  # over three features a word
    assert len(toxicity._candidates(long)) > 20000
    rng = random.Random(3)
    other = lambda: " ".join(rng.sample([f"n{k}" for k in range(100)], 15))
    rows = [(k, other(), 0) for k in range(300)]
    rows += [(1000 + k, long, 1) for k in range(12)]
    rows += [(2000 + k, f"{w} {other()}", 1)
             for k, w in enumerate(["zorgface", "zorgling", "blarg", "blarg"] * 2)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([r[::2] for r in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    machine = toxicity.finder(model)
    for text in ("zorgface", "blarg", "a zorgling"):
        assert toxicity.matches(text, model, machine), text
    assert not toxicity.matches(long, model, machine)


def test_network_on_held_out_rows(spark):
    docs, labels = marked_documents(spark)
    network = byte_cnn.fit(docs, labels, remainder(F.col("_id"), 3) != 1)
    scored = docs.withColumn("_score", byte_cnn.quality_score(F.col("text"), network))
    assert accuracy(scored, labels, "quality", remainder(F.col("doc_id"), 3) == 1) > 0.97
    assert scored.where("_score between 0 and 1").count() == docs.count()
    one_class = byte_cnn.fit(docs, labels.where("quality = 1"), F.lit(True))
    assert byte_cnn.probability("", one_class, one_class.tables()) > 0.9


def test_chunks_cover_the_text_and_pool_the_largest():
    rng = np.random.default_rng(1)
    net = byte_cnn.Network(
        rng.normal(size=(byte_cnn.WIDTH, 256, 3)).astype(np.float32), np.zeros(3),
        np.zeros((7, byte_cnn.HIDDEN)), np.zeros(byte_cnn.HIDDEN), np.zeros(byte_cnn.HIDDEN), 0.0,
    )
    for size in (6, 7, 447, 448, 511, 512, 513, 960, 961, 5000, 448 * 256 + 64, 448 * 300):
        octets = rng.integers(0, 256, size).astype(np.uint8)
        starts = byte_cnn._starts(size)
        assert starts[-1] + byte_cnn.CHUNK >= size and starts[0] == 0
        got = byte_cnn.pooled(octets, net.tables())
        for row, start in list(zip(got, starts))[:: max(1, len(starts) // 5)]:
            part = octets[start : start + byte_cnn.CHUNK]
            places = range(len(part) - byte_cnn.WIDTH + 1)
            every = [sum(net.filters[k, part[p + k]] for k in range(byte_cnn.WIDTH)) for p in places]
            assert np.allclose(row, np.max(every, axis=0), atol=1e-4)


def test_labelled_ids_are_bounded_and_unique(spark):
    labels = spark.createDataFrame(
        [(k % 50, k % 2) for k in range(500)] + [(None, 1), (7, None), (99, 5)], "doc_id bigint, toxic int"
    )
    got = labelled_ids(labels, "toxic", F.lit(True), 10, 5).collect()
    assert Counter(r["_label"] for r in got) == {0: 10, 1: 5}
    assert len({r["_id"] for r in got}) == 15


def brute_probability(text, net):
    """The network from its definition, place by place."""
    raw = (text or "").encode()
    raw += b"\0" * (byte_cnn.WIDTH - len(raw))
    peaks = []
    for start in range(0, max(1, len(raw) - (byte_cnn.CHUNK - byte_cnn.STEP)), byte_cnn.STEP):
        part = raw[start : start + byte_cnn.CHUNK]
        responses = [
            sum(net.filters[k, part[p + k]].astype(float) for k in range(byte_cnn.WIDTH))
            for p in range(len(part) - byte_cnn.WIDTH + 1)
        ]
        peaks.append([max(0.0, max(r[f] for r in responses) + net.bias[f]) for f in range(len(net.bias))])
    means = [sum(c) / len(peaks) for c in zip(*peaks)]
    tops = [max(c) for c in zip(*peaks)]
    full = 3 * (1 - math.log(min(len(raw), byte_cnn.CHUNK)) / math.log(byte_cnn.CHUNK))
    units = np.tanh(np.array([*means, *tops, full]) @ net.hidden + net.lift)
    return 1 / (1 + math.exp(-(float(units @ net.weights) + net.offset)))


def test_probability_equals_its_definition(spark):
    rng = random.Random(8)
    gen = np.random.default_rng(8)
    net = byte_cnn.Network(
        gen.normal(0, 0.3, (byte_cnn.WIDTH, 256, 5)).astype(np.float32), gen.normal(size=5).astype(np.float32),
        gen.normal(0, 0.2, (11, byte_cnn.HIDDEN)), gen.normal(size=byte_cnn.HIDDEN),
        gen.normal(size=byte_cnn.HIDDEN), 0.3,
    )
    sizes = [0, 1, 5, 6, 447, 448, 511, 512, 513, 576, 577, 1000, 3000]
    texts = [None, *["".join(rng.choices("ab é日.\n", k=n)) for n in sizes]]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in frame.select(byte_cnn.quality_score(F.col("text"), net)).collect()]
    assert got == pytest.approx([brute_probability(t, net) for t in texts], abs=1e-4)


def test_the_network_does_not_depend_on_the_order_of_rows(spark):
    docs, labels = marked_documents(spark)
    twice = docs.union(docs.selectExpr("doc_id", "concat(text, ' $$$ other') as text"))
    settings = dict(zeros=40, ones=40, epochs=1)
    nets = [
        byte_cnn.fit(frame, labels, F.lit(True), **settings)
        for frame in (twice, twice.repartition(7).orderBy(F.desc("text")))
    ]
    assert np.array_equal(nets[0].filters, nets[1].filters) and nets[0].offset == nets[1].offset
    odd = twice.withColumns({"_id": F.lit(1), "_text": F.lit("x"), "_label": F.lit(0), "_size": F.lit(9)})
    assert np.array_equal(byte_cnn.fit(odd, labels, F.lit(True), **settings).filters, nets[0].filters)


def test_the_chunk_bound_leaves_out_texts_but_cuts_none(spark, monkeypatch):
    docs, labels = marked_documents(spark)
    seen = []
    monkeypatch.setattr(byte_cnn, "train", lambda texts, y, **k: seen.extend(texts) or byte_cnn.Network(
        np.zeros((6, 256, 1)), np.zeros(1), np.zeros((3, 16)), np.zeros(16), np.zeros(16), 0.0))
    byte_cnn.fit(docs, labels, F.lit(True), zeros=50, ones=150, chunks=80)
    whole = {r["text"].encode() for r in docs.where("text is not null").collect()}
    joined = lambda t: b"".join([t[0], *[c[byte_cnn.CHUNK - byte_cnn.STEP :] for c in t[1:]]])
    assert 10 < len(seen) and sum(map(len, seen)) <= 80 + len(seen)
    assert all(joined(t).rstrip(b"\0") in whole for t in seen)


def query_rows(spark, name, folder="/root/testdata/sf0.001"):
    return queries.QUERIES[name](spark, folder), spark.read.parquet(f"{folder}/documents.parquet")


def test_query_of_toxicity_equals_brute_force(spark):
    got, docs = query_rows(spark, "op1_toxicity")
    model = queries.toxicity_model(spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["score"] == pytest.approx(brute_score(texts[r["doc_id"]], model))
        assert r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_query_of_quality_equals_brute_force(spark):
    got, docs = query_rows(spark, "op10_byte_cnn")
    network = queries.quality_network(spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if len(texts[r["doc_id"]] or "") < 3000:
            assert r["score"] == pytest.approx(brute_probability(texts[r["doc_id"]], network), abs=1e-4)
        assert r["predicted"] == int(r["score"] >= 0.5)
