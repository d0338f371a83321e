"""Words grouped with the more frequent words they are one edit away from.

Words that are one edit apart share their first half or their last half, whatever the longer one adds. So
every word goes to the group of its first and of its last half, and a group that is still large is
halved again around the part where the edit must lie, until it is small. A group is sorted, and each of
its words walks the list once: rows of the edit matrix, three cells wide, are kept for the prefix that
a word shares with the one before, and a prefix that is already two edits off skips all words with it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import whole
from monthwise.session import materialise

FLUSH = 250_000
#: Members beyond which a group is halved again.
GROUP = 1024

# Latin-1 bytes: A-Z become a-z, a-z and all from 0xC0 on stay, the rest become blanks.
_RUN_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20
    for b in range(256)
)


def runs(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` in Latin-1, with A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_RUN_BYTES).split()


def misspelt(run: bytes, prefix: int, one_in: int) -> bytes:
    """The run without one of its code points if its hash is divisible by ``one_in``, else the run.

    ``prefix`` is the CRC state after the document's id and a colon.
    """
    utf8 = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(utf8, prefix)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    documents: DataFrame, ident: str = "doc_id", text: str = "text", one_in: int = 97
) -> DataFrame:
    """``word, n`` of all words of all texts, after :func:`misspelt`."""
    rows = documents.select(
        F.concat(F.coalesce(F.col(ident).cast("string"), F.lit("")), F.lit(":")).alias("_prefix"),
        whole(F.col(text)).alias("_text"),
    )

    def table(seen: dict[bytes, int]) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in seen], "n": list(seen.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            for prefix, body in zip(batch["_prefix"], batch["_text"]):
                state = zlib.crc32(prefix.encode())
                for run, n in Counter(runs(body)).items():
                    word = misspelt(run, state, one_in)
                    seen[word] = seen.get(word, 0) + n
                if len(seen) > FLUSH:
                    yield table(seen)
                    seen = {}
        if seen:
            yield table(seen)

    found = rows.mapInPandas(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def near(word: str, listed: list[str], shared: list[int], start: int) -> list[int]:
    """Places in the sorted list whose words are exactly one edit from ``word``.

    ``shared[i]`` counts the first characters that words ``i - 1`` and ``i`` have in common; ``start``
    those that ``word`` has in common with all of them.
    """
    size = len(word)
    at = word + "\0\0"
    # rows[d]: edits between a list word's first d characters and the first d - 1, d and d + 1 of word
    rows = {start: (1, 0, 1)} if start else {0: (2, 0, 1)}
    found = []
    i, depth, total = 0, start, len(listed)
    while i < total:
        other = listed[i]
        length = len(other)
        x, y, z = rows[depth]
        while depth < length:
            c = other[depth]
            left = y + 1
            if depth and x < 2:
                step = x + (c != at[depth - 1])
                if step < left:
                    left = step
            middle = z + 1
            if depth <= size:
                step = y + (c != at[depth])
                if step < middle:
                    middle = step
            if left + 1 < middle:
                middle = left + 1
            right = middle + 1
            if depth < size:
                step = z + (c != at[depth + 1])
                if step < right:
                    right = step
            depth += 1
            x, y, z = left, middle, right
            if x > 1 and y > 1 and z > 1:
                break
            rows[depth] = (x, y, z)
        else:
            ends = size - length
            if (ends == 0 and y == 1) or (ends == 1 and z == 1) or (ends == -1 and x == 1):
                found.append(i)
            i += 1
            if i < total:
                depth = min(depth, shared[i])
            continue
        # No word with this prefix can be near.
        i += 1
        if i < total and shared[i] >= depth:
            i = bisect_left(listed, other[:depth] + "\U0010ffff", i)
        if i < total:
            depth = min(depth - 1, _common(other, listed[i]))
    return found


def _common(a: str, b: str) -> int:
    k = 0
    for x, y in zip(a, b):
        if x != y:
            break
        k += 1
    return k


def _near_in_group(
    members: list[tuple[str, int]], short: int, head: int, tail: int, below: int
) -> Iterator[tuple[str, int, int, str]]:
    """``word, n_near, best_n, best_word`` of the members with near words in their group.

    Counted are pairs with fewer than ``below`` first characters in common, one of them at least of
    length ``short``.
    """
    turned = tail > head
    counts = {w[::-1] if turned else w: n for w, n in members}
    listed = sorted(counts)
    shared = [0, *map(_common, listed, listed[1:])]
    links: dict[str, list] = {}

    def link(word: str, other: str) -> None:
        n, got = counts[other], links.get(word)
        plain = other[::-1] if turned else other
        if got is None:
            links[word] = [1, n, plain]
        else:
            got[0] += 1
            if n > got[1] or n == got[1] and plain < got[2]:
                got[1:] = n, plain

    for word in listed:
        if len(word) != short:
            continue
        for i in near(word, listed, shared, max(head, tail)):
            other = listed[i]
            if turned:
                if _common(word[::-1], other[::-1]) >= below:
                    continue
            elif word[:below] == other[:below]:
                continue
            link(word, other)
            if len(other) > short:
                link(other, word)
    for word, (n_near, n, best) in links.items():
        yield word[::-1] if turned else word, n_near, n, best


def _halved(groups: DataFrame) -> DataFrame:
    """Members of groups as members of their two halves.

    A group is of pairs whose shorter word has ``_short`` characters, that share the first ``_head`` and
    the last ``_tail`` of them, and, to count each pair in one group only, have fewer than ``_below``
    first characters in common.
    """
    half = F.expr("(_short - _head - _tail) div 2").cast("int")
    into = groups.withColumn("_half", half).select(
        "word", "n", "_short",
        F.inline(F.array(
            F.struct((F.col("_head") + F.col("_half")).alias("_head"), "_tail", "_below"),
            F.struct(
                "_head", (F.col("_tail") + F.col("_half")).alias("_tail"),
                F.least("_below", F.col("_head") + F.col("_half")).alias("_below"),
            ),
        )),
    ).where("_head < _below")
    first = F.substring("word", F.lit(1), F.col("_head"))
    last = F.when(F.col("_tail") > 0, F.expr("right(word, _tail)")).otherwise("")
    return into.withColumn(
        "_key", F.xxhash64("_short", "_head", "_tail", "_below", first, last)
    )


def _small_groups(vocabulary: DataFrame, shortest: int, group: int) -> DataFrame:
    """Members of groups of at most ``group`` words, or of words that differ in one place at most."""
    size = F.char_length("word")
    level = _halved(
        vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("_short"))
        .where(F.col("_short") >= shortest)
        .withColumns({
            "_head": F.lit(0), "_tail": F.lit(0), "_below": F.col("_short") + 2,
        })
    )
    parts = []
    while True:
        large = materialise(
            level.where("_short - _head - _tail > 1").groupBy("_key").count()
            .where(F.col("count") > group).select("_key"),
            "spelling-groups",
        )
        if large.isEmpty():
            parts.append(level)
            break
        parts.append(level.join(large, "_key", "left_anti"))
        level = _halved(level.join(large, "_key", "left_semi"))
    groups = parts[0]
    for part in parts[1:]:
        groups = groups.unionByName(part)
    return groups


def near_words(vocabulary: DataFrame, shortest: int = 1, group: int = GROUP) -> DataFrame:
    """``word, n_near, best_n, best_word`` of the words of ``word, n`` that have near words.

    The best is the near word of largest ``n``, the smallest in code-point order among equals. Words
    must be distinct and have ``shortest`` characters at least, of which there must be one. Halving ends where the
    edit has one place left, so a group never has more words than the alphabet allows for two characters.
    """
    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[str, int, int, str]] = []
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            keys = batch["_key"].to_numpy()
            if not len(keys):
                continue
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            rest = batch.iloc[last:]
            out.extend(_matched(batch.iloc[:last], cuts))
            if len(out) > FLUSH:
                yield _frame(out)
                out = []
        if rest is not None:
            out.extend(_matched(rest, np.array([len(rest)])))
        yield _frame(out)

    groups = _small_groups(vocabulary, shortest, group).repartition("_key").sortWithinPartitions("_key")
    found = groups.mapInPandas(match, "word string, n_near bigint, best_n bigint, best_word string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best_word").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best_word")
    )


def _matched(rows: pd.DataFrame, cuts: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """All groups of rows in key order; the keys are hashes, so groups are told apart anew."""
    columns = [rows[c].to_list() for c in ("word", "n", "_short", "_head", "_tail", "_below")]
    start = 0
    for cut in cuts.tolist():
        if cut - start > 1:
            own: dict[tuple, list] = {}
            for word, n, short, head, tail, below in zip(*(c[start:cut] for c in columns)):
                key = short, head, tail, below, word[:head], word[len(word) - tail :]
                own.setdefault(key, []).append((word, n))
            for (short, head, tail, below, _, _), members in own.items():
                if len(members) > 1:
                    yield from _near_in_group(members, short, head, tail, below)
        start = cut


def _frame(rows: list[tuple[str, int, int, str]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["word", "n_near", "best_n", "best_word"])


def with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root``, the last word reached from ``word`` over ``form``; the word itself without one.

    A form occurs more often than its word, so there are no circles. Every round doubles the way
    that has been gone, so rounds grow with the logarithm of the longest way.
    """
    ways = materialise(
        forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-ways"
    )
    while True:
        onward = ways.toDF("_at", "_further")
        ways = materialise(
            ways.join(onward, F.col("root") == F.col("_at"), "left").select(
                "word", F.coalesce("_further", "root").alias("root"),
                F.col("_further").isNotNull().alias("_moved"),
            ),
            "spelling-ways",
        )
        moved = not ways.where("_moved").isEmpty()
        ways = ways.drop("_moved")
        if not moved:
            break
    return forms.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variant_groups(
    documents: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    one_in: int = 97,
    min_chars: int = 5,
    min_count: int = 3,
    ratio: int = 2,
    group: int = GROUP,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of all texts with ``min_chars`` code points and
    ``min_count`` occurrences or more.

    ``form`` is the near word of largest ``n``, ties to the smallest in code-point order, if that ``n`` is at
    least ``ratio`` times the word's, else null; ``root`` is the last word reached over forms.

    A null text has no words; a null id is empty in the hash. Repeated rows count each for itself. Empty
    tables and texts without words give no rows. Other columns are ignored, whatever their names.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms could run in circles")
    counts = word_counts(documents, ident, text, one_in)
    words = materialise(
        counts.where((F.char_length("word") >= min_chars) & (F.col("n") >= min_count)),
        "spelling-words",
    )
    found = near_words(words, max(1, min_chars), group)
    fits = F.col("best_n") >= ratio * F.col("n")
    forms = materialise(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("best_word")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
