"""Near-duplicate records by SetSketch registers (problem 3).

Method: the sketch of a set is, for each of m registers, the largest truncated level of exponentially spaced values that
its elements reach; two sketches merge by the maximum and agree in a register about as often as the sets overlap. Runs of
registers are band keys; sets that share a band are candidates. The similarity of a candidate is estimated jointly by
maximum likelihood from the registers that are larger, smaller and equal, and what passes is verified on the sets.

Rows with equal word sets form a class and are compared once; only class numbers and band keys are shuffled, the sets
themselves only for candidates.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.functions.runtime import written

WORD = re.compile(r"[^\W_]+")
#: Parameters of the sketch: base of the levels, rate of the exponential values, largest level.
BASE, RATE, LEVELS = 1.001, 20.0, 65_534
#: Registers in a band and bands: sets with similarity 0.8 share a band with probability 0.999.
BAND, BANDS = 8, 40
REGISTERS = BAND * BANDS
#: Registers that travel with a class, to estimate the similarity of candidates.
CARRIED = 64
#: Words whose levels a worker keeps between batches; bounds memory only.
MEMO_WORDS = 30_000


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def levels(hashes: np.ndarray) -> np.ndarray:
    """Level of each element (row) in each register (column)."""
    steps = np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = _mix(hashes.astype(np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93) + steps[None, :])
    uniform = ((bits >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
    return np.clip(np.floor(1.0 - np.log(-np.log(uniform) / RATE) / np.log(BASE)), 0, LEVELS + 1).astype(np.uint16)


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Sketcher:
    """Registers of word sets, with the levels of words met before."""

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.table = np.zeros((0, REGISTERS), dtype=np.uint16)
        self.hashes: dict[str, int] = {}

    def hash_of(self, word: str) -> int:
        found = self.hashes.get(word)
        if found is None:
            if len(self.hashes) > 10 * MEMO_WORDS:
                self.hashes.clear()
            found = self.hashes[word] = word_hash(word)
        return found

    def sketch(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of registers for each non-empty set of word hashes."""
        flat = np.concatenate(sets)
        fresh = [h for h in dict.fromkeys(flat.tolist()) if h not in self.rows]
        if len(self.rows) + len(fresh) > MEMO_WORDS:
            self.rows.clear()
            self.table = self.table[:0]
            fresh = list(dict.fromkeys(flat.tolist()))
        if fresh:
            base = len(self.rows)
            self.rows.update((h, base + i) for i, h in enumerate(fresh))
            self.table = np.concatenate([self.table[:base], *(levels(np.array(fresh[i : i + 2000], dtype=np.uint64)) for i in range(0, len(fresh), 2000))])
        get = self.rows.__getitem__
        at = np.fromiter(map(get, flat.tolist()), dtype=np.int64, count=len(flat))
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        return np.maximum.reduceat(self.table[at], starts, axis=0)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """64-bit key of each band of each sketch; shorter ones would meet by chance in a large collection."""
    parts = registers.reshape(len(registers), BANDS, BAND).astype(np.uint64)
    key = np.zeros(parts.shape[:2], dtype=np.uint64)
    for i in range(BAND):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i] + np.uint64(i + 1))
    return key


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely similarity of each pair of sketches, given the sizes of the sets."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1.0 - u
    grid = np.linspace(0.0, 1.0, 101)[None, :]
    top = np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1.0) / BASE) / np.log(BASE)

    up, down = p(u - v * grid), p(v - u * grid)
    likely = more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1.0 - up - down, 1e-12))
    likely = np.where(grid <= top + 0.005, likely, -np.inf)
    return grid[0, np.argmax(likely, axis=1)]


def sketched(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """id, class of equal word sets, band keys and word hashes of each text of at least ``min_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketcher()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, sets = [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    if not text or len(text) < 2 * min_words - 1:
                        continue
                    found = WORD.findall(text.lower())
                    if len(found) >= max(1, min_words):
                        rows.append(i)
                        sets.append(np.unique(np.fromiter(map(own.hash_of, set(found)), dtype=np.uint64)))
                if not rows:
                    continue
                registers = own.sketch(sets)
                bands = band_keys(registers)
                packed = [s.tobytes() for s in sets]
                classes = [int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little", signed=True) for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int32())), pa.array(classes, pa.int64()), pa.array([b.tobytes() for b in bands], pa.binary()), pa.array([r.tobytes() for r in np.ascontiguousarray(registers[:, :CARRIED])], pa.binary()), pa.array(packed, pa.binary())],
                    names=["id", "cls", "bands", "registers", "words"],
                )

    return df.select(id_col, text_col).where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, cls bigint, bands binary, registers binary, words binary")


def verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a, b, words and registers of both) that pass the estimate and the exact comparison, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slack = 4.0 * np.sqrt(threshold * (1.0 - threshold) / CARRIED)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, p, q = (batch.column(i).to_pylist() for i in range(2, 6))
            p, q = (np.frombuffer(b"".join(r), dtype=np.uint16).reshape(-1, CARRIED) for r in (p, q))
            nx, ny = np.array([len(s) // 8 for s in x], dtype=float), np.array([len(s) // 8 for s in y], dtype=float)
            # equal registers are binomial around the similarity or above: far fewer rule it out without the estimate
            near = np.flatnonzero((p == q).mean(axis=1) >= threshold - 1.25 * slack)
            rows, found = [], []
            for at in range(0, len(near), 2000):
                part = near[at : at + 2000]
                likely = estimate(p[part], q[part], nx[part], ny[part])
                for i in part[likely >= threshold - slack].tolist():
                    a, b = np.frombuffer(x[i], dtype=np.uint64), np.frombuffer(y[i], dtype=np.uint64)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    similarity = common / (len(a) + len(b) - common)
                    if similarity >= threshold:
                        rows.append(i)
                        found.append(similarity)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    return pairs.select("a", "b", "words_a", "words_b", "registers_a", "registers_b").mapInArrow(run, "a bigint, b bigint, similarity double")


def similar_classes(df: DataFrame, threshold: float = 0.8, min_words: int = 1, id_col: str = "block_id", text_col: str = "testo") -> tuple[DataFrame, DataFrame]:
    """(members, links): the class of each row and the links between different classes.

    ``members`` has ``id`` and ``cls``; rows of one class have the same set of words. ``links`` has ``a`` < ``b`` (classes)
    and ``similarity`` >= ``threshold``, the share of common words in all words of both. Rows with a null id or text and
    those of fewer than ``min_words`` words (so all empty and blank texts) are in neither; a row delivered twice counts
    once; other columns are ignored; empty tables give empty results.
    """
    base = written(sketched(df, id_col, text_col, min_words), "sketches")
    members = base.select("id", "cls").distinct()
    unpacked = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(F.xxhash64(F.substring(F.col("bands"), 8 * i + 1, F.lit(8))).alias("key"), i.cast("byte").alias("band"))))
    bands = base.groupBy("cls").agg(F.first("bands").alias("bands")).select("cls", unpacked.alias("x")).select("cls", F.col("x.key").alias("key"), F.col("x.band").alias("band"))
    left, right = bands.select(F.col("cls").alias("a"), "key", "band"), bands.select(F.col("cls").alias("b"), "key", "band")
    candidates = written(left.join(right, ["key", "band"]).where("a < b").select("a", "b").distinct(), "candidates")
    wanted = candidates.select(F.col("a").alias("cls")).union(candidates.select(F.col("b").alias("cls"))).distinct()
    held = base.select("cls", "words", "registers").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("words").alias("words"), F.first("registers").alias("registers"))
    pairs = candidates
    for side in ("a", "b"):
        pairs = pairs.join(held.select(F.col("cls").alias(side), F.col("words").alias(f"words_{side}"), F.col("registers").alias(f"registers_{side}")), side)
    return members, written(verified(pairs, threshold), "links")


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b), smaller id first: every two rows of one class or of linked classes."""
    shared = members.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cls")
    repeated = members.join(shared, "cls", "left_semi")
    inside = repeated.select("cls", F.col("id").alias("a")).join(repeated.select("cls", F.col("id").alias("b")), "cls").where("a < b").select("a", "b")
    first = links.select("a", "b").join(members.select(F.col("cls").alias("a"), F.col("id").alias("x")), "a")
    across = first.join(members.select(F.col("cls").alias("b"), F.col("id").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return inside.unionByName(across)


def link_counts(members: DataFrame, links: DataFrame) -> DataFrame:
    """One row for each id: its class, the rows of that class, and its links to rows of its own and of other classes."""
    size = members.groupBy("cls").agg(F.count(F.lit(1)).alias("copies"))
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(size.select(F.col("cls").alias("b"), "copies"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("copies").alias("near"))
    per = size.join(near, "cls", "left").select("cls", "copies", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"))
    return members.join(per, "cls")
