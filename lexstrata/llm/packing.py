"""Filling chunks of fixed capacity with items (problem 1).

Method: hierarchical multi-length packing. There are windows of several context sizes; an item is routed to the shortest
window that holds it. The long windows are packed first: each long item opens one, and its gap is filled from the shorter
tiers, by one or two items that fill it exactly, else by the longest that fits. Then the next tier is packed from what is
left, in windows of its own size. Packed shorter windows are units that are put together into long windows in the same
way. Chunks are dealt to step groups of equal size in serpentine order of their words, which balances the groups.

Items of one length are interchangeable, so a group is packed on its histogram of lengths (at most ``capacity`` numbers),
however many items it has: a pattern of lengths is used as often as the counts allow. Items find their chunk by their rank
among the items of the same group and length; ranks are counted within salted parts, so a group that holds a third of all
rows is spread over many tasks. Items are cut and counted once and written with their texts; all that follows reads keys
and lengths only, until the texts are joined to their chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.functions.runtime import written
from lexstrata.llm.splitting import pieces, word_number

#: Context sizes as shares of the capacity, from the long window to the shortest (fixed values).
TIERS = (1.0, 0.5, 0.25)
#: Parts in which ranks are counted.
SALTS = 16

Pattern = dict[int, int]


class Lengths:
    """Numbers of items by length, with bit sets of the lengths at hand, so that a search is one step."""

    def __init__(self, counts: Pattern, capacity: int):
        self.capacity, self.left, self.have, self.mirror = capacity, [0] * (capacity + 1), 0, 0
        for length, n in counts.items():
            self.add(length, n)

    def add(self, length: int, n: int) -> None:
        self.left[length] += n
        at, mirrored = 1 << length, 1 << (self.capacity - length)
        if self.left[length]:
            self.have |= at
            self.mirror |= mirrored
        else:
            self.have &= ~at
            self.mirror &= ~mirrored

    def filled(self, gap: int, top: int) -> Pattern:
        """Items of at most ``top`` words, taken out for a gap: one or two that fill it, else the longest that fits, and so on."""
        taken: Pattern = {}
        while gap > 0:
            usable = self.have & ((2 << min(gap, top)) - 2)
            if not usable:
                break
            pick = usable.bit_length() - 1
            pairs = usable & (self.mirror >> (self.capacity - gap)) if pick < gap else 0
            while pairs:
                a = pairs.bit_length() - 1
                if gap - a <= top and (2 * a != gap or self.left[a] > 1):
                    pick = a
                    break
                pairs ^= 1 << a
            taken[pick] = taken.get(pick, 0) + 1
            self.add(pick, -1)
            gap -= pick
        return taken

    def opened(self, length: int, window: int) -> tuple[Pattern, int]:
        """The pattern of a window that an item of ``length`` opens, and how often the counts allow it; taken out."""
        self.add(length, -1)
        pattern = self.filled(window - length, length)
        pattern[length] = pattern.get(length, 0) + 1
        again = min(self.left[x] // k for x, k in pattern.items())
        if again:
            for x, k in pattern.items():
                self.add(x, -k * again)
        return pattern, again + 1


def plan(counts: Pattern, windows: tuple[int, ...]) -> list[tuple[Pattern, int, int]]:
    """(pattern, how often, window) of each chunk, fullest first; all items of ``counts`` (length, number) are used up.

    ``windows`` are the context sizes, longest first; ``window`` is the one that the longest item was routed to.
    """
    items = Lengths(counts, windows[0])
    units: dict[int, list[list]] = {}
    for window, below in zip(windows, [*windows[1:], 0]):
        for length in range(window, below, -1):
            while items.left[length]:
                pattern, times = items.opened(length, window)
                units.setdefault(sum(x * k for x, k in pattern.items()), []).append([pattern, times, window])
    sizes = Lengths({size: sum(u[1] for u in held) for size, held in units.items()}, windows[0])
    out = []
    for size in range(windows[0], 0, -1):
        while sizes.left[size]:
            joint, times = sizes.opened(size, windows[0])
            while times:
                # units of one size may have different patterns: as many at a time as the first of each has
                fronts = {x: units[x][-1] for x in joint}
                step = max(1, min([times, *(fronts[x][1] // k for x, k in joint.items())]))
                total: Pattern = {}
                routed = 0
                for x, k in joint.items():
                    wanted = k * step
                    while wanted:
                        unit = units[x][-1]
                        n = min(wanted, unit[1])
                        share = k if n == wanted == k * step else n
                        for length, m in unit[0].items():
                            total[length] = total.get(length, 0) + m * share
                        routed = max(routed, unit[2])
                        unit[1] -= n
                        if not unit[1]:
                            units[x].pop()
                        wanted -= n
                out.append((total, step, routed))
                times -= step
    return sorted(out, key=lambda c: -sum(x * k for x, k in c[0].items()))


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which null keys are equal."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    return left.join(other, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on]).drop(*(f"_r_{k}" for k in on))


def assign_chunks(items: DataFrame, keys: list[str], id_cols: list[str], capacity: int = 220, step_chunks: int = 32, tiers: tuple[float, ...] = TIERS) -> DataFrame:
    """``items`` (keys, id_cols, words) with chunk (from 0 in each group), chunk_words, window and step.

    ``words`` must be between 0 and ``capacity``; items without words go to the first chunk of their group. Rows equal in
    keys and id_cols are one item and come out once.
    """
    windows = tuple(max(1, int(capacity * t)) for t in tiers)
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(*id_cols), F.lit(SALTS)).cast("int"))
    part = Window.partitionBy(*keys, "words", "_salt").orderBy(*id_cols)
    own = F.struct(*id_cols)
    ranked = salted.withColumns({"_rank": F.dense_rank().over(part), "_copy": F.lag(own).over(part).eqNullSafe(own)}).where("not _copy").drop("_copy")
    ranked = written(ranked, "ranked")  # read twice, and small: keys and lengths only
    parts = ranked.groupBy(*keys, "words", "_salt").agg(F.max("_rank").cast("long").alias("_n"))
    every = parts.groupBy(*keys, "words").agg(F.sum("_n").alias("n"), F.sort_array(F.collect_list(F.struct("_salt", "_n"))).alias("_parts"))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<struct<_salt:int,offset:bigint>>").alias("list"))
    summed = F.aggregate("_parts", start, lambda a, p: F.struct((a["sum"] + p["_n"]).alias("sum"), F.concat(a["list"], F.array(F.struct(p["_salt"].alias("_salt"), a["sum"].alias("offset")))).alias("list")))
    offsets = every.select(*keys, "words", F.map_from_entries(summed["list"]).alias("offsets"))
    histogram = every.groupBy(*keys).agg(F.collect_list(F.struct("words", "n")).alias("lengths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, ...]] = []
            for g, lengths in enumerate(batch.column(len(keys)).to_pylist()):
                counts = {x["words"]: x["n"] for x in lengths}
                silent = counts.pop(0, 0)
                used: dict[int, int] = {}
                chunk, planned = 0, plan(counts, windows) if counts else []
                chunks = max(1, sum(times for _, times, _ in planned))
                if silent:
                    first = planned[0] if planned else ({}, 1, windows[-1])
                    rows.append((g, 0, 0, silent, 0, silent, sum(n * k for n, k in first[0].items()), first[2], chunks))
                for pattern, times, window in planned:
                    total = sum(n * k for n, k in pattern.items())
                    for n, k in pattern.items():
                        at = used.get(n, 0)
                        rows.append((g, n, at, at + k * times, chunk, k, total, window, chunks))
                        used[n] = at + k * times
                    chunk += times
            columns = list(zip(*rows)) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(columns[0], pa.int32())) for i in range(len(keys))), *(pa.array(c, pa.int64()) for c in columns[1:])], names=[*keys, *PLANNED])

    kinds = ", ".join(f"`{k}` {items.schema[k].dataType.simpleString()}" for k in keys)
    planned = histogram.mapInArrow(run, f"{kinds}, " + ", ".join(f"{n} bigint" for n in PLANNED))
    runs = planned.groupBy(*keys, F.col("words").cast("int").alias("words")).agg(F.sort_array(F.collect_list(F.struct("lo", "base", "each", "total", "window"))).alias("runs"), F.first("chunks").alias("_chunks"))
    placed = _joined(ranked, _joined(runs, offsets, [*keys, "words"]), [*keys, "words"])
    rank = F.element_at("offsets", F.col("_salt")) + F.col("_rank") - 1
    run_of = F.element_at(F.filter("runs", lambda r: r["lo"] <= rank), -1)
    rows = placed.select(*keys, *id_cols, "words", "_chunks", run_of.alias("_run"), rank.alias("_at"))
    chunk = (F.col("_run.base") + F.floor((F.col("_at") - F.col("_run.lo")) / F.col("_run.each"))).cast("long")
    steps = F.ceil(F.col("_chunks") / step_chunks)
    turn = F.pmod(F.col("chunk"), 2 * steps)
    step = F.when(turn < steps, turn).otherwise(2 * steps - 1 - turn).cast("long")
    return rows.select(*keys, *id_cols, "words", chunk.alias("chunk"), F.col("_run.total").cast("int").alias("chunk_words"), F.col("_run.window").cast("int").alias("window"), "_chunks").withColumn("step", step).drop("_chunks")


PLANNED = ["words", "lo", "hi", "base", "each", "total", "window", "chunks"]


def fitting_items(df: DataFrame, keys: list[str], id_col: str, text_col: str, capacity: int, texts: bool = True) -> DataFrame:
    """(keys, id, piece, words and, with ``texts``, text) of the items of at most ``capacity`` words and of the pieces of longer ones.

    One pass over the rows counts and cuts. Null, empty and blank items have nothing to pack and are left out; a text
    without letters and digits has no words but is an item.
    """
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("id", df.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("words", T.IntegerType()), *([T.StructField("text", T.StringType())] if texts else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                rows: list[int] = []
                out: list[tuple[int, int, str]] = []
                for i, text in enumerate(batch.column(len(keys) + 1).to_pylist()):
                    if not text or text.isspace():
                        continue
                    n = word_number(text)
                    if n <= capacity:
                        rows.append(i)
                        out.append((0, n, text))
                    else:
                        for k, (a, b, c, d) in enumerate(pieces(text, capacity, 0, "alnum")):
                            rows.append(i)
                            out.append((k, b - a, text[c:d].strip() if texts else ""))
                columns = list(zip(*out)) if out else [()] * 3
                take = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays([*(batch.column(j).take(take) for j in range(len(keys) + 1)), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *([pa.array(columns[2], pa.string())] if texts else [])], names=schema.names)

    return df.select(*keys, id_col, text_col).mapInArrow(run, schema)


def pack(df: DataFrame, keys: list[str], id_col: str, text_col: str, capacity: int = 220, step_chunks: int = 32) -> DataFrame:
    """The chunks of each group: ``keys``, chunk, step, window, words, items and text.

    Every item of a group lands in exactly one chunk of at most ``capacity`` words; only items above it are cut, without
    overlap. ``text`` has the items in the order of their ids, separated by blank lines, ``items`` their ids. ``window``
    is the context size that the chunk's longest item was routed to. ``step`` deals a group's chunks to steps of about
    ``step_chunks`` chunks with balanced words. Null, empty and blank texts have nothing to pack; texts without words are
    items of no length in their group's first chunk; rows that repeat an id in a group are one item; null keys are a
    group of their own; other columns are ignored; an empty table gives no chunk.
    """
    items = written(fitting_items(df, keys, id_col, text_col, capacity), "items")
    same = [*keys, "id", "piece"]
    placed = assign_chunks(items.select(*same, "words"), keys, ["id", "piece"], capacity, step_chunks)
    joined = _joined(items.select(*same, "text"), placed.select(*same, "chunk", "step", "window", "chunk_words"), same)
    held = F.array_sort(F.collect_set(F.struct("id", "piece", "text")))
    packed = joined.groupBy(*keys, "chunk").agg(F.first("step").alias("step"), F.first("window").alias("window"), F.first("chunk_words").alias("words"), held.alias("held"))
    return packed.select(*keys, "chunk", "step", "window", "words", F.col("held.id").alias("items"), F.array_join("held.text", "\n\n").alias("text"))
