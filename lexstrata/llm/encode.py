"""Encoding of whole texts with a public byte-level BPE vocabulary (problem 8).

Method: prefix-sharing trie traversal. A byte string's greedy-merge encoding has a property that makes dynamic
programming possible: every prefix has exactly one *last token* ``t``, namely the only one for which the encoding of
the prefix without ``t`` ends in a token that keeps its border with ``t`` when both are encoded together. A prefix is
therefore fully described by the last token of it and of its own prefixes. The distinct pre-tokens of a batch form a
trie; walked depth first, a node extends the states on its path by one byte, so what words share is computed once.
Sorted byte strings are the depth-first order of their trie, and the current path is a stack of states.

The operator is a map over the input: no shuffle, no global dictionary, one task holds one batch and a bounded memo.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Pre-tokeniser of the byte-level vocabularies (fixed value).
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts without the characters in ODD; the standard engine is faster.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"

#: Words whose encoding one worker remembers between batches; beyond it the memo starts anew. It bounds memory only.
MEMO_WORDS = 300_000


def _odd_characters() -> frozenset[str]:
    """Characters that the two engines class differently: numbers that are no decimal digits, separators in ASCII."""
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, sys.maxunicode + 1)))
    return frozenset([*regex.findall(r"[\p{Nl}\p{No}]", every), *"\x1c\x1d\x1e\x1f"])


class TrieEncoder:
    """Encodes pre-tokens by last-token states over the trie of the distinct ones.

    ``ranks`` maps a token's bytes to its id, which is also its merge priority.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.whole: dict[bytes, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.odd = _odd_characters()
        self.plain, self.full = re.compile(PLAIN).findall, regex.compile(PRETOKENS).findall

    @classmethod
    def from_file(cls, path: str) -> TrieEncoder:
        """From a file of base64 tokens and ranks."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def merges(self, word: bytes) -> list[bytes]:
        """The defining procedure: join the pair of lowest rank until none is left. Used on short strings only."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def borders(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens stay apart when encoded together."""
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            found = self.pairs[key] = self.merges(left + right) == [left, right]
        return found

    def is_token(self, word: bytes) -> bool:
        found = self.whole.get(word)
        if found is None:
            found = self.whole[word] = word in self.ranks and len(self.merges(word)) == 1
        return found

    def learn(self, words: set[str]) -> None:
        """Adds the encodings of new words to the memo, walking their trie depth first."""
        ranks, longest = self.ranks, self.longest
        before = b""
        last: list[bytes] = []  # last token of each prefix on the path
        ends: list[bytes] = []  # encoding of each prefix, as packed ids; only as long as the path
        for raw, text in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            n, shared, most = len(raw), 0, min(len(raw), len(before))
            while shared < most and raw[shared] == before[shared]:
                shared += 1
            del last[shared:]
            for i in range(shared + 1, n + 1):
                token = b""
                for start in range(max(0, i - longest), i):
                    piece = raw[start:i]
                    if piece in ranks and (self.is_token(piece) if start == 0 else self.borders(last[start - 1], piece)):
                        token = piece
                        break
                last.append(token)
            ids, i = [], n
            while i:
                ids.append(ranks[last[i - 1]])
                i -= len(last[i - 1])
            self.memo[text] = np.array(ids[::-1], dtype=np.int32).tobytes()
            before = raw
        if len(self.pairs) > 4 * MEMO_WORDS:
            self.pairs.clear()

    def pretokens(self, text: str) -> list[str]:
        return self.plain(text) if self.odd.isdisjoint(text) else self.full(text)

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of the texts; null and empty ones have no ids."""
        pieces = [self.pretokens(t) if t else [] for t in texts]
        fresh: set[str] = set()
        for p in pieces:
            fresh.update(p)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        fresh.difference_update(self.memo)
        self.learn(fresh)
        get = self.memo.__getitem__
        packed = [b"".join(map(get, p)) for p in pieces]
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
        return offsets, np.frombuffer(b"".join(packed), dtype=np.int32)


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder.from_file(path)
    return _ENCODERS[path]


def encode_corpus(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", rows: int = 1000) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every row of ``df``.

    Null and empty texts give an empty list, repeated rows are encoded each, text that looks like a special token is
    ordinary text, other columns are ignored. ``rows`` is how many texts are held at once. An empty table gives an
    empty result.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                offsets, flat = enc.encode_batch(part.column(1).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, schema)
