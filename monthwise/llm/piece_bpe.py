"""Exact encoding with a SentencePiece BPE model by backtracking, and decoding.

The encoding of a text under a merge-type model is the only sequence of pieces in which every
adjacent pair, merged anew from its characters, gives that same pair. So it can be searched: take the
longest piece that starts here (all matches come from one Aho-Corasick pass), fall back to shorter
ones when it does not go with the piece before, step back when none does, and note in a bitfield the
positions from which nothing goes on.

A blank never stands inside a piece behind other characters, and a character that is no piece is
spelt in bytes; both cut the text into chunks that are encoded independently and remembered. Runs of
blanks are merged as the library does, since their pieces tie.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from monthwise.llm.common import whole

BLANK = "▁"
REMEMBERED = 250_000  # words, in each of two generations; twice as many pairs
SLICE = 512  # rows that are answered together
PROBES = ("", " ", "a  b", " a", "x\ty\n\nz ", "▁a ▁", "　ｆ é́", "<s> </s>", "1" * 40 + " " * 40)


class Memory:
    """A bounded memory of results: two generations, the older of which is dropped when full."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PieceBpe:
    """Encoder and decoder of one model. Refuses models that normalise texts in another way."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes: list[int] = [0] * 256
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.shown: list[bytes] = [b""] * size
        self.is_byte = [False] * size
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
                self.shown[i], self.is_byte[i] = bytes([int(name[3:5], 16)]), True
            elif model.is_unknown(i):
                self.shown[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                self.id[name], self.score[name] = i, model.get_score(i)
                self.shown[i] = name.replace(BLANK, " ").encode()
        if any(BLANK in name.lstrip(BLANK) for name in self.id):
            raise ValueError("a piece has a blank inside")
        self.silent = {i for i in range(size) if not self.shown[i]}  # these end a run of bytes
        self.text = {i: name for name, i in self.id.items()}
        self.inside = {name[k : k + 2] for name in self.id for k in range(len(name) - 1)}
        self.pairs, self.words = Memory(REMEMBERED * 2), Memory(REMEMBERED)
        self.parts = Memory(REMEMBERED)
        self.matcher = ahocorasick.Automaton()
        for name, i in self.id.items():
            # A piece that its own characters don't merge to is never produced.
            if self.remerge(name) == [i]:
                self.matcher.add_word(name, (i, len(name)))
        #: The next shorter piece that begins a piece.
        self.shorter: dict[int, tuple[int, int] | None] = {}
        for name, match in list(self.matcher.items()):
            begins = (self.matcher.get(name[:n], None) for n in range(len(name) - 1, 0, -1))
            self.shorter[match[0]] = next((m for m in begins if m is not None), None)
        self.matcher.make_automaton()
        letters = "".join(re.escape(name) for name in self.id if len(name) == 1)
        self.cut = re.compile(f"([^{letters}])")
        for probe in PROBES:
            if self.encode(probe) != model.encode(probe) or self.decode(self.encode(probe)) != probe.replace(BLANK, " "):
                raise ValueError("the model isn't plain BPE with escaped blanks and byte fallback")

    def remerge(self, text: str) -> list[int]:
        """Merge neighbours, best score and then leftmost first, till nothing merges."""
        if len(text) > 32:
            return self._remerge_long(text)
        score, never = self.score, -math.inf
        parts = list(text)
        scores = [score.get(a + b, never) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == never:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = score.get(parts[at] + parts[at + 1], never)
            if at:
                scores[at - 1] = score.get(parts[at - 1] + parts[at], never)
        return [self.id[part] for part in parts]

    def _remerge_long(self, text: str) -> list[int]:
        """The same with a heap, for long runs."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts):
                joined = parts[left] + parts[right]
                if joined in self.score:
                    heapq.heappush(heap, (-self.score[joined], left, joined))

        for left in range(len(parts) - 1):
            offer(left)
        while heap:
            _, left, joined = heapq.heappop(heap)
            if parts[left] is None or after[left] >= len(parts):
                continue
            right = after[left]
            if parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [self.id[part] for part in parts if part is not None]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces, merged anew together, stay these two."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            known = self.remerge(self.text[left] + self.text[right]) == [left, right]
            self.pairs.put(key, known)
        return known

    def search(self, text: str) -> list[int]:
        """Backtracking over a text of known characters."""
        size = len(text)
        longest: list[tuple[int, int] | None] = [None] * size
        for end, match in self.matcher.iter(text):
            longest[end + 1 - match[1]] = match  # ends ascend, so the longest stays
        fits, shorter, pairs = self.fits, self.shorter, self.pairs.young
        failed = 0
        taken: list[tuple[int, int]] = []
        last = None
        at, match = 0, longest[0] if size else None
        while at < size:
            while match is not None:
                if not failed >> (at + match[1]) & 1:
                    if last is None:
                        break
                    known = pairs.get(last << 32 | match[0])
                    if known or known is None and fits(last, match[0]):
                        break
                match = shorter[match[0]]
            if match is not None:
                taken.append(match)
                last = match[0]
                at += match[1]
                match = longest[at] if at < size else None
            else:
                failed |= 1 << at
                if not taken:
                    raise ValueError("the vocabulary has no encoding of a known character")
                piece, length = taken.pop()
                at -= length
                match = shorter[piece]
                last = taken[-1][0] if taken else None
        return [piece for piece, _ in taken]

    def _chunk(self, blanks: int, body: str) -> list[int]:
        """``blanks`` blanks, then ``body`` without any."""
        out: list[int] = []
        parts = self.cut.split(body)
        for k in range(0, len(parts), 2):
            known = parts[k]
            if k == 0 and blanks:
                found = self._known(BLANK + known)
                alone = self.text[found[0]] == BLANK
                run = blanks if alone else blanks - 1
                if run > 1 or alone:
                    out += self.remerge(BLANK * run)
                elif run == 1:
                    out.append(self.id[BLANK])
                out += found[1:] if alone else found
            elif known:
                out += self._known(known)
            if k + 1 < len(parts):
                out += [self.bytes[b] for b in parts[k + 1].encode("utf-8", "surrogatepass")]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; none for an empty one."""
        out: list[int] = []
        if not text:
            return out
        newline = [self.id["\n"]] if "\n" in self.id else [self.bytes[10]]
        for number, line in enumerate(text.replace(BLANK, " ").split("\n")):
            if number:
                out += newline
            blanks = 1 - min(number, 1)  # the text gets a blank in front
            bodies = line.split(" ")
            last = len(bodies) - 1
            words = self.words.young
            for k, body in enumerate(bodies):
                if k:
                    blanks += 1
                if body and blanks == 1:
                    out += words.get(body) or self._word(body)
                elif body or k == last:
                    out += self._chunk(blanks, body)
                else:
                    continue
                blanks = 0
        return out

    def _word(self, body: str) -> list[int]:
        """A body behind one blank."""
        found = self.words.get(body)
        if found is None:
            found = tuple(self._chunk(1, body))
            self.words.put(body, found)
        return found

    def _known(self, text: str):
        """Ids of known characters. Between two that no piece holds side by side nothing merges."""
        inside = self.inside
        cuts = [at for at in range(1, len(text)) if text[at - 1 : at + 1] not in inside]
        if not cuts:
            return self.search(text)
        out: list[int] = []
        for start, end in zip([0, *cuts], [*cuts, len(text)]):
            part = text[start:end]
            found = self.parts.get(part)
            if found is None:
                found = tuple(self.search(part))
                self.parts.put(part, found)
            out += found
        return out

    def decode(self, ids) -> str:
        """The text of ids: without the blank put in front, broken bytes as U+FFFD each."""
        raw = b"".join(map(self.shown.__getitem__, ids))
        try:
            text = raw.decode("utf-8") if self.silent.isdisjoint(ids) else None
        except UnicodeDecodeError:
            text = None
        if text is None:
            text = "".join(self._mended(ids))
        first = next((i for i in ids if self.shown[i]), None)
        lead = first is not None and first in self.text and self.text[first].startswith(BLANK)
        return text[1:] if lead else text

    def _mended(self, ids):
        run = b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.shown[i]
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        yield run[:size].decode("utf-8")
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    yield "�"
                run = run[size:]
            if i is not None:
                yield self.shown[i].decode("utf-8")


@lru_cache(maxsize=4)
def piece_bpe(path: str) -> PieceBpe:
    """One encoder for each process and path."""
    return PieceBpe(path)


def encode_and_decode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``_ids`` (array of int) and ``_decoded``, the text that these ids give, instead of
    its text; other columns pass through, unless they have one of these two names.

    Null and empty texts have no ids and decode to an empty text. Rows, repeated ones included, are
    independent of each other.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_bpe(model)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                ids, ends, decoded = [], [0], []
                for text in part.column(len(others)).to_pylist():
                    found = codec.encode(text)
                    ids.append(np.array(found, dtype=np.int32))
                    ends.append(ends[-1] + len(found))
                    decoded.append(codec.decode(found))
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(ids))
                )
                kept = part.columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*kept, lists, pa.array(decoded, pa.string())], names=names
                )

    others = [c for c in docs.columns if c not in (text, "_ids", "_decoded")]
    names = [*others, "_ids", "_decoded"]
    schema = StructType(
        [*(docs.schema[c] for c in others), StructField("_ids", ArrayType(IntegerType())),
         StructField("_decoded", StringType())]
    )
    body = max(others, key=len, default="") + "_text"  # no other column has this name
    return docs.select(*others, whole(F.col(text)).alias(body)).mapInArrow(both, schema)


def decode(frame: DataFrame, model: str, ids: str = "_ids") -> DataFrame:
    """``frame`` with ``_decoded``, the text of an array of ids (null: empty)."""

    @pandas_udf("string")
    def text(arrays: pd.Series) -> pd.Series:
        codec = piece_bpe(model)
        return pd.Series(
            ["" if x is None else codec.decode([int(i) for i in x]) for x in arrays], dtype=object
        )

    return frame.withColumn("_decoded", text(F.col(ids)))
