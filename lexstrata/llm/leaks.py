"""Evaluation passages inside a corpus (problem 9).

Method: the CGK random walk embeds a window of words into a longer string such that windows at a small edit distance get a
small Hamming distance; positions sampled from the embedding are the keys of a locality-sensitive hash, repeated until the
target recall is reached; candidates are verified by the exact edit distance of the item's window to the closest run of words
around the document's, so that added and removed words count as one edit each. Windows have the size of the smallest
passage that counts as a leak, as windows of whole items would miss items that leaked in part; every window of every
document is looked up, but for those without a run of words of an item that any window within the edits has to keep.

The held-out items are the small side: they are shipped to the tasks in blocks of bounded size, so the corpus is read by
maps without a shuffle, whatever its size and skew.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\W_]+")
#: Embedding length as a multiple of the window, and sampled positions of one key (both fixed values of the method).
STRETCH, SAMPLED = 3, 6
#: Distinct word classes the random walk tells apart.
CLASSES = 1 << 10
#: Candidate pairs that are verified at a time.
VERIFIED = 50_000
#: Where a larger number of keys would be needed, the search is refused instead of finding less.
MOST_KEYS = 5000


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    return WORD.findall(text.lower()) if text else []


class WalkKeys:
    """The random walk and the sampled positions of ``repetitions`` keys for windows of ``size`` word ids."""

    def __init__(self, size: int, repetitions: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.size, self.length = size, STRETCH * size
        self.walk = [rng.integers(0, 2, (self.length, CLASSES), dtype=np.int8) for _ in range(repetitions)]
        self.samples = [np.sort(rng.choice(self.length, min(SAMPLED, self.length), replace=False)) for _ in range(repetitions)]

    def keys(self, ids: np.ndarray, starts: np.ndarray, rep: int, known: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Key of each window, the key after each sample, and the windows left.

        With ``known``, sorted keys after each sample, windows that can't match any more are dropped on the way.
        """
        at = np.zeros(len(starts), dtype=np.int64)
        key = np.zeros(len(starts), dtype=np.uint64)
        walk, wanted, steps = self.walk[rep], self.samples[rep], []
        for j in range(int(wanted[-1]) + 1):
            inside = at < self.size
            symbol = np.where(inside, ids[starts + np.minimum(at, self.size - 1)], -1)
            if len(steps) < len(wanted) and j == wanted[len(steps)]:
                key = key * np.uint64(0x9E3779B97F4A7C15) + (symbol + 2).astype(np.uint64)
                key ^= key >> np.uint64(29)
                if known is not None:
                    table = known[len(steps)]
                    keep = table[np.minimum(np.searchsorted(table, key), len(table) - 1)] == key
                    starts, at, key, symbol, inside = starts[keep], at[keep], key[keep], symbol[keep], inside[keep]
                steps.append(key.copy() if known is None else key)
                if not len(starts):
                    break
            at = at + np.where(inside, walk[j][symbol % CLASSES], 0)
        return key, steps, starts


def repetitions_for(size: int, max_edits: int, recall: float, seed: int = 17) -> int:
    """Keys needed so that a share ``recall`` of windows with ``max_edits`` words replaced, added or removed has one in common.

    Simulated for each kind of edit; the kind that needs most decides. Equal windows share every key, so without edits one
    is enough.
    """
    if not max_edits:
        return 1
    rng, n = np.random.default_rng(seed), 400
    ids = []
    for kind in range(3):
        for _ in range(n):
            a = rng.integers(1, 5000, size + max_edits).tolist()
            b = list(a)
            for _ in range(max_edits):
                p = int(rng.integers(0, size))
                b[p : p + (kind != 1)] = [int(rng.integers(1, 5000))] if kind < 2 else []
            ids += [*a[:size], *b[:size]]
    held, starts = np.array(ids), np.arange(6 * n) * size
    missed = np.ones((3, n), dtype=bool)
    for rep in range(1, MOST_KEYS + 1):
        key = WalkKeys(size, 1, seed + rep).keys(held, starts, 0)[0].reshape(3, n, 2)
        missed &= key[:, :, 0] != key[:, :, 1]
        if missed.mean(axis=1).max() <= 1 - recall:
            return rep
    raise ValueError(f"{max_edits} edits in {size} words: recall {recall} is not reached with {MOST_KEYS} keys")


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows, the least word edit distance of ``a`` to any run of consecutive words of ``b``.

    The edit table is filled for all pairs at once, one word of ``a`` at a time; words of ``b`` that are not there are -1.
    """
    places = np.arange(b.shape[1] + 1, dtype=np.int16)
    row = np.zeros((len(a), b.shape[1] + 1), dtype=np.int16)  # the run may start anywhere
    for i in range(a.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, :-1] + (a[:, i : i + 1] != b), row[:, 1:] + 1, out=new[:, 1:])
        row = np.minimum.accumulate(new - places, axis=1) + places  # a step to the right costs one
    return row.min(axis=1)  # and end anywhere


def least_run(size: int, max_edits: int) -> int:
    """Words of the longest unedited run that a window of ``size`` words with ``max_edits`` edits has at least."""
    return max(1, -(-(size - max_edits) // (max_edits + 1)))


def run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word ids."""
    n = len(ids) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(size if n > 0 else 0):
        out = (out ^ ids[j : j + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class ItemIndex:
    """Keys of all windows of a block of items."""

    def __init__(self, items: list[tuple[int, str | None]], size: int, max_edits: int, repetitions: int):
        self.size, self.max_edits = size, max_edits
        self.vocabulary: dict[str, int] = {}
        ids: list[int] = []
        starts, owners = [], []
        for item, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for p in range(len(own) - size + 1):
                starts.append(len(ids) + p)
                owners.append(item)
            ids += own
        self.ids, self.owners, self.starts = np.array(ids or [0], dtype=np.int64), owners, np.array(starts, dtype=np.int64)
        self.run = least_run(size, max_edits)
        inside = np.unique((self.starts[:, None] + np.arange(size - self.run + 1)[None, :]).ravel()) if owners else self.starts
        self.runs = np.unique(run_hashes(self.ids, self.run)[inside]) if owners else np.zeros(0, dtype=np.uint64)
        self.hash = WalkKeys(size, repetitions)
        self.known: list[list[np.ndarray]] = []
        self.table: list[tuple[np.ndarray, np.ndarray]] = []
        for rep in range(len(self.hash.walk)):
            key, steps, _ = self.hash.keys(self.ids, self.starts, rep)
            self.known.append([np.unique(s) for s in steps])
            order = np.argsort(key, kind="stable")
            self.table.append((key[order], order))

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        """(row, item, least word edits) of every leaked item."""
        if not self.owners:
            return []
        get = self.vocabulary.get
        # words may be missing from a passage at a document's end
        padding = [0] * self.max_edits
        coded = [[*(get(w, 0) for w in words(t)), *padding] for t in texts]
        lengths = np.array([len(c) for c in coded], dtype=np.int64)
        ids = np.fromiter((x for c in coded for x in c), dtype=np.int64, count=int(lengths.sum()))
        size = self.size
        if len(ids) < size:
            return []
        owner = np.repeat(np.arange(len(texts)), lengths)
        ends = np.cumsum(lengths)
        firsts, ends = ends - lengths, ends - self.max_edits
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        starts = np.arange(len(ids) - size + 1)
        # a word that no item has needs an edit of its own
        starts = starts[(unknown[starts + size] - unknown[starts] <= self.max_edits) & (owner[starts] == owner[starts + size - 1])]
        hashes = run_hashes(ids, self.run)
        kept = np.concatenate([[0], np.cumsum(self.runs[np.minimum(np.searchsorted(self.runs, hashes), len(self.runs) - 1)] == hashes)])
        starts = starts[kept[starts + size - self.run + 1] > kept[starts]]
        found = [np.zeros(0, dtype=np.int64)]  # document window and item window, as one number
        for rep in range(len(self.hash.walk)):
            key, _, left = self.hash.keys(ids, starts, rep, self.known[rep])
            keys, order = self.table[rep]
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            n = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            found.append(np.repeat(left, n) * len(self.owners) + order[at])
        pairs = np.unique(np.concatenate(found))
        owners = np.array(self.owners)
        best: dict[tuple[int, int], int] = {}
        for at in range(0, len(pairs), VERIFIED):
            s, n = np.divmod(pairs[at : at + VERIFIED], len(self.owners))
            a = self.ids[self.starts[n][:, None] + np.arange(size)[None, :]]
            exact = (a == ids[s[:, None] + np.arange(size)[None, :]]).all(axis=1)
            distance = np.where(exact, 0, self.max_edits + 1)
            if self.max_edits and not exact.all():
                rest = np.flatnonzero(~exact)
                where = s[rest][:, None] + np.arange(-self.max_edits, size + self.max_edits)[None, :]
                row = owner[s[rest]]
                inside = (where >= firsts[row][:, None]) & (where < ends[row][:, None])
                around = np.where(inside, ids[np.clip(where, 0, len(ids) - 1)], -1)
                # words that no edit touches are in their place or moved by as many places as there are edits
                same = sum((a[rest] == around[:, k : k + size]).sum(axis=1) for k in range(2 * self.max_edits + 1))
                near = np.flatnonzero(same >= size - self.max_edits)
                distance[rest[near]] = edit_distances(a[rest[near]], around[near])
            for i in np.flatnonzero(distance <= self.max_edits).tolist():
                pair = (int(owner[s[i]]), owners[n[i]].item())
                best[pair] = min(best.get(pair, self.max_edits + 1), int(distance[i]))
        return [(row, item, d) for (row, item), d in best.items()]


def find_leaks(docs: DataFrame, items: DataFrame, window: int = 12, max_edits: int = 0, recall: float = 0.95, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = 20_000, rows: int = 500) -> DataFrame:
    """``id_col``, ``item_col`` and ``edits`` of each document that holds ``window`` consecutive words of an item.

    ``edits`` is the least word edit distance between a window of the document and one of the item, at most
    ``max_edits``; without edits the result is exact, with edits it reaches ``recall`` per window. Items are held in
    memory in blocks of about ``block`` rows; every block is matched with all documents. Words are runs of letters and
    digits in lower case. Null, empty and short texts on either side match nothing; repeated rows give one row; equal
    items are reported each; an empty side gives an empty result.
    """
    schema = T.StructType([docs.schema[id_col], items.schema[item_col], T.StructField("edits", T.IntegerType())])
    blocks, repetitions = max(1, math.ceil(items.count() / block)), repetitions_for(window, max_edits, recall)
    picked = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    result = None
    for b in range(blocks):
        part = picked if blocks == 1 else picked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        held = [(r.item, r.text) for r in part.collect()]

        def run(batches: Iterator[pa.RecordBatch], held: list = held) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(held, window, max_edits, repetitions)
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    piece = batch.slice(at, rows)
                    found = index.search(piece.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(pa.array([f[0] for f in found], pa.int32())), pa.array([f[1] for f in found], batch.schema.field(0).type if schema[1].dataType == schema[0].dataType else None), pa.array([f[2] for f in found], pa.int32())],
                        names=schema.names,
                    )

        found = docs.select(id_col, text_col).mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result.groupBy(id_col, item_col).agg(F.min("edits").alias("edits"))
