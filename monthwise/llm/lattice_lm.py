"""Document probabilities from a lattice of vocabulary pieces.

A document is a chain of words and an end. The lattice of a word has an arc for every vocabulary piece
at every place, a byte arc where a character is no piece, and one arc for the whole word where the
corpus knows it. Arcs weigh what two unigram vocabularies give them: pieces start from the scores of
an existing vocabulary and are adapted by one expectation step over all distinct training words, whole
words have their corpus frequency less a discount, whose sum is what spelling by pieces weighs. The forward recursion in log space sums over all segmentations, so the
score is the marginal probability of the text. A piece never reaches over a blank, so the recursion
of a document is the sum over its words, and each distinct word is evaluated once.

Word counts are joined block by block: a block of documents names its distinct words, these meet the
counts in a shuffle by word and return to their block. No vocabulary is broadcast and no group exceeds
a block.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from monthwise.llm.common import remainder, whole
from monthwise.session import fresh_dir, materialise

BLANK = "▁"
END = ""  # as a word; no word is empty
PRIOR = 1000.0  # pieces that the existing vocabulary counts for in the adaptation


class Lattice:
    """Pieces of an existing vocabulary. Arcs 0-255 are bytes, 256 is the end, then pieces."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names, scores = [], []
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                names.append(model.id_to_piece(i))
                scores.append(model.get_score(i))
        self.matcher = ahocorasick.Automaton()
        self.letters = set()
        for at, name in enumerate(names):
            self.matcher.add_word(name, (at + 257, len(name)))
            if len(name) == 1:
                self.letters.add(name)
        self.matcher.make_automaton()
        # The scores of a merge vocabulary are negative ranks; frequencies fall as the inverse of a rank.
        rank = 1 - np.array(scores)
        weight = np.concatenate([np.full(257, 1 / (1 + len(names))), 1 / rank])
        self.prior = weight / weight.sum()

    def arcs(self, word: str) -> list[tuple[int, int, int]]:
        """``(start, end, arc)`` in order of the end; a byte chain is given by its first byte's arc."""
        text = BLANK + word
        out = [(end - size + 1, end + 1, arc) for end, (arc, size) in self.matcher.iter(text)]
        odd = [at for at, c in enumerate(text) if c not in self.letters]
        if odd:
            out += [(at, at + 1, -1 - at) for at in odd]
            out.sort(key=lambda arc: arc[1])
        return out

    def byte_weight(self, text: str, arc: int, log: list[float]) -> float:
        return sum(log[b] for b in text[-1 - arc].encode("utf-8", "surrogatepass"))

    def forward(self, word: str, arcs, log: list[float]) -> list[float]:
        """Log weight of all ways to each place."""
        text = BLANK + word
        alpha = [-math.inf] * (len(text) + 1)
        alpha[0] = 0.0
        exp, ln = math.exp, math.log1p
        for start, end, arc in arcs:
            new = alpha[start] + (log[arc] if arc >= 0 else self.byte_weight(text, arc, log))
            old = alpha[end]
            if new > old:
                old, new = new, old
            alpha[end] = old + ln(exp(new - old)) if new > old - 40 else old
        return alpha

    def expected(self, word: str, log: list[float], into: np.ndarray) -> None:
        """Add the expected uses of every arc in a word."""
        arcs = self.arcs(word)
        alpha = self.forward(word, arcs, log)
        text = BLANK + word
        beta = [-math.inf] * (len(text) + 1)
        beta[-1] = 0.0
        total = alpha[-1]
        for start, end, arc in sorted(arcs, key=lambda arc: -arc[0]):
            weight = log[arc] if arc >= 0 else self.byte_weight(text, arc, log)
            ahead = weight + beta[end]
            old, new = (beta[start], ahead) if beta[start] > ahead else (ahead, beta[start])
            beta[start] = old + math.log1p(math.exp(new - old)) if new > old - 40 else old
            share = math.exp(min(0.0, alpha[start] + ahead - total))
            if arc >= 0:
                into[arc] += share
            else:
                for b in text[-1 - arc].encode("utf-8", "surrogatepass"):
                    into[b] += share


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    """One lattice for each process and path."""
    return Lattice(path)


BLOCKS = (
    "_kind string, _block bigint, _id string, _held boolean, _n bigint, _at binary, _tf binary, "
    "_word string, _place int, _count bigint"
)


def _blocks(docs: DataFrame, ident: str, text: str, folds: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Documents as places of their distinct words, and the words of each block with training counts."""
    rows = docs.select(
        F.col(ident).cast("string").alias("_id"),
        (remainder(F.col(ident), folds) == 0).alias("_held"),
        whole(F.col(text)).alias("_text"),
    )
    columns = [c.split()[0] for c in BLOCKS.split(", ")]

    def flush(number: int, block: list, index: dict) -> Iterator[pd.DataFrame]:
        uses = np.zeros(len(index), dtype=np.int64)
        out = []
        for ident, is_held, places, times in block:
            if not is_held:
                uses[places] += times
            order = np.argsort(places)
            out.append((ident, is_held, int(times.sum()),
                        np.diff(places[order], prepend=0).astype("<i4").tobytes(),
                        times[order].astype("<i4").tobytes()))
        rows = pd.DataFrame(out, columns=["_id", "_held", "_n", "_at", "_tf"], dtype=object)
        words = pd.DataFrame({
            "_word": [word.decode("utf-8", "surrogatepass") for word in index],
            "_place": np.arange(len(index), dtype=np.int32), "_count": uses,
        })
        for kind, frame in (("doc", rows), ("word", words)):
            yield frame.assign(_kind=kind, _block=number).reindex(columns=columns).astype(
                {c: object for c in columns if c not in frame and c not in ("_kind", "_block")}
            ).where(lambda f: f.notna(), None)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        numbers = count((context.partitionId() if context else 0) << 32)
        block, index, held = [], defaultdict(count().__next__), 0
        for batch in batches:
            for ident, is_held, body in zip(batch["_id"], batch["_held"], batch["_text"]):
                times = Counter(body.encode("utf-8", "surrogatepass").lower().split())
                times[END.encode()] = 1
                places = np.fromiter((index[w] for w in times), np.int64, len(times))
                uses = np.fromiter(times.values(), np.int64, len(times))
                block.append((None if pd.isna(ident) else ident, bool(is_held), places, uses))
                held += len(body)
                if held >= size:
                    yield from flush(next(numbers), block, index)
                    block, index, held = [], defaultdict(count().__next__), 0
        if block:
            yield from flush(next(numbers), block, index)

    path = fresh_dir(docs.sparkSession, "lm-blocks")
    rows.mapInPandas(read, BLOCKS).write.partitionBy("_kind").option(
        "compression", "zstd"
    ).parquet(path)

    def back(part: str) -> DataFrame:
        return docs.sparkSession.read.schema(BLOCKS).parquet(path).where(F.col("_kind") == part)

    return (
        back("doc").select("_block", "_id", "_held", "_n", "_at", "_tf"),
        back("word").select("_block", "_word", "_place", "_count"),
    )


def adapted_weights(words: DataFrame, vocabulary: str) -> list[float]:
    """Natural logs of all arc probabilities after one expectation step over the distinct ``_word``.

    Each word counts once, not as often as it occurs: spelling has to foresee new words.
    """
    start = lattice(vocabulary).prior

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = lattice(vocabulary)
        log = np.log(net.prior).tolist()
        uses = np.zeros(len(log))
        for batch in batches:
            for word in batch["_word"]:
                if word == END:
                    uses[256] += 1
                else:
                    net.expected(word, log, uses)
        at = np.flatnonzero(uses)
        yield pd.DataFrame({"_arc": at.astype(np.int32), "_uses": uses[at]})

    sums = (
        words.where("_c > 0").select("_word")
        .mapInPandas(expect, "_arc int, _uses double")
        .groupBy("_arc").agg(F.sum("_uses").alias("_uses"))
        .collect()  # as many rows as the vocabulary has pieces, at most
    )
    uses = PRIOR * start
    for row in sums:
        uses[row["_arc"]] += row["_uses"]
    return np.log(uses / uses.sum()).tolist()


def lattice_scores(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    ident: str = "doc_id",
    folds: int = 10,
    block_chars: int = 16_000_000,
) -> DataFrame:
    """One row for each document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, both log10 probabilities.

    Words are what white space separates, A-Z in lower case; the end counts as a token. Null and empty
    texts are the end alone. Documents whose crc32 of the id modulo ``folds`` is 0 are scored but not
    learned from; a null id counts as empty text, which is held out. Without any training document the
    whole-word arcs have no weight. Repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    texts, words = _blocks(docs, ident, text, folds, block_chars)
    counts = materialise(words.groupBy("_word").agg(F.sum("_count").alias("_c")), "lm-counts")
    sums = counts.where("_c > 0").agg(
        F.sum("_c").alias("n"), F.count("*").alias("v"),
        F.count_if(F.col("_c") == 1).alias("once"), F.count_if(F.col("_c") == 2).alias("twice"),
    ).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"])
    once, twice = int(sums["once"]), int(sums["twice"])
    discount = (once + 1) / (once + 2 * twice + 2)  # above 0 and below 1
    spelling = discount * distinct / total if total else 1.0
    log = spark.sparkContext.broadcast(adapted_weights(counts, vocabulary))  # one for each piece

    @pandas_udf("double")
    def marginal(names: pd.Series, uses: pd.Series) -> pd.Series:
        net, weights = lattice(vocabulary), log.value
        out = []
        for word, times in zip(names, uses):
            spelt = weights[256] if word == END else net.forward(word, net.arcs(word), weights)[-1]
            spelt += math.log(spelling)
            if times > 0:
                direct = math.log((times - discount) / total)
                high, low = max(spelt, direct), min(spelt, direct)
                spelt = high + math.log1p(math.exp(low - high))
            out.append(spelt / math.log(10))
        return pd.Series(out, dtype="float64")

    scored = counts.select(
        "_word", "_c",
        F.log10((F.col("_c") + 0.1) / (F.lit(total) + 0.1 * (F.lit(distinct) + 1))).alias("_base"),
        marginal(F.col("_word"), F.col("_c")).alias("_score"),
    )
    returned = words.select("_block", "_word", "_place").join(scored, "_word").select(
        "_block", "_place", (F.col("_c") > 0).alias("_known"), "_base", "_score"
    )
    def add(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        base, score = np.zeros(len(found)), np.zeros(len(found))
        known = np.zeros(len(found), dtype=np.int64)
        place = found["_place"].to_numpy()
        base[place], score[place] = found["_base"], found["_score"]
        known[place] = found["_known"]
        out = []
        for at, tf in zip(rows["_at"], rows["_tf"]):
            places = np.cumsum(np.frombuffer(at, "<i4"))
            times = np.frombuffer(tf, "<i4").astype(np.int64)
            out.append((int(times @ known[places]), float(times @ base[places]),
                        float(times @ score[places])))
        part = pd.DataFrame(out, columns=["n_known", "base_score", "score"])
        return pd.DataFrame({
            "_id": rows["_id"], "_held": rows["_held"], "_n": rows["_n"],
            "n_known": part["n_known"], "base_score": part["base_score"], "score": part["score"],
        })

    result = texts.groupBy("_block").cogroup(returned.groupBy("_block")).applyInPandas(
        add,
        "_id string, _held boolean, _n bigint, n_known bigint, base_score double, score double",
    )
    return result.select(
        F.col("_id").cast(docs.schema[ident].dataType).alias(ident),
        F.col("_held").alias("held_out"),
        F.col("_n").alias("n_tokens"),
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
