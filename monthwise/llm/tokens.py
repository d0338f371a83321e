"""Byte-level BPE ids, as the tokenizers library gives them."""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np

END = 0


class ByteBpe:
    """Encodes with the ranks of the same vocabulary, which is several times faster; a text that
    the rank encoder refuses, or that holds a special token's text, goes to the tokenizers library itself,
    which gives such a text the special token's id."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        self.path = path
        self._library = None
        self._ranks = None
        with open(path, encoding="utf-8") as body:
            added = json.load(body).get("added_tokens", [])
        self._special = [token["content"] for token in added if token["content"]]
        ranks = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._ranks = tiktoken.Encoding(
                "ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text without an end, as unsigned 32-bit numbers."""
        if self._ranks is not None and not any(special in text for special in self._special):
            try:
                return self._ranks.encode_to_numpy(text)
            except BaseException as problem:  # the rank encoder panics on some extreme runs
                if isinstance(problem, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.library().encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each process and path."""
    return ByteBpe(path)
