"""Retrieval chunks of a node's contents, and other walks whose state depends on every row before."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.functions.runtime import written
from lexstrata.functions.text import count_words
from lexstrata.operators.structure import LEAST_CHUNK, MOST_CHUNK, RECITAL_STEP, long_windows

#: Contents of one node that are walked in one task; the walk of a longer node goes on from stretch to stretch.
SPAN = 4096


def walked(words: list[int], chunk: int, held: int, before: int, most: int) -> tuple[list[int], int, int, int]:
    """Chunk number of each item, then the open chunk, its words and those of the chunk before, from such a state on."""
    out = []
    for n in words:
        if held and held + n > most:
            chunk, before, held = chunk + 1, held, 0
        out.append(chunk)
        held += n
        if held >= most:
            chunk, before, held = chunk + 1, held, 0
    return out, chunk, held, before


def short_tail(chunk: int, held: int, before: int, least: int, most: int) -> bool:
    """Whether the last chunk joins the one before."""
    return bool(held and chunk and held < least and before + held <= most)


def chunk_sizes(words: list[int], least: int = LEAST_CHUNK, most: int = MOST_CHUNK) -> list[int]:
    """Chunk number of each item: a chunk is closed before it would exceed ``most``, and a short tail joins the one before."""
    out, chunk, held, before = walked(words, 0, 0, 0, most)
    if short_tail(chunk, held, before, least, most):
        out = [c if c < chunk else chunk - 1 for c in out]
    return out


def passage(words: list[int], most: int = MOST_CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a stretch does to an open chunk of 0, 1, ... words: chunks closed, words then open, words of the chunk before.

    The last is -1 where none is closed.
    """
    held, closed, before = np.arange(most), np.zeros(most, dtype=np.int64), np.full(most, -1)
    for n in words:
        over = (held > 0) & (held + n > most)
        closed, before, held = closed + over, np.where(over, held, before), np.where(over, 0, held) + n
        full = held >= most
        closed, before, held = closed + full, np.where(full, held, before), np.where(full, 0, held)
    return closed, held, before


def stretch_starts(lengths: DataFrame) -> DataFrame:
    """file, owner_seq, span, first (chunk open where the stretch begins), open (its words), joined (chunk that joins the one before, or -1) and total (words of the node).

    ``lengths``: file, owner_seq, span, seq, split_word_start, words. Every stretch is walked once from each state that it
    may begin in; the states are then followed on one row for each stretch.
    """

    def summary(group: pd.DataFrame) -> pd.DataFrame:
        words = group.sort_values(["seq", "split_word_start"])["words"].tolist()
        closed, held, before = passage(words)
        first = group.iloc[0]
        return pd.DataFrame({"file": [first["file"]], "owner_seq": [first["owner_seq"]], "span": [first["span"]], "words": [sum(words)], "closed": [closed.tolist()], "held": [held.tolist()], "before": [before.tolist()]})

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("span")
        chunk, held, before, firsts, opened = 0, 0, 0, [], []
        for closed, after, last in zip(group["closed"], group["held"], group["before"]):
            firsts.append(chunk)
            opened.append(held)
            chunk, before, held = chunk + int(closed[held]), int(last[held]) if last[held] >= 0 else before, int(after[held])
        joined = chunk if short_tail(chunk, held, before, LEAST_CHUNK, MOST_CHUNK) else -1
        return group[["file", "owner_seq", "span"]].assign(first=firsts, open=opened, joined=joined, total=int(group["words"].sum()))

    keys = "file string, owner_seq bigint, span bigint"
    summaries = lengths.groupBy("file", "owner_seq", "span").applyInPandas(summary, f"{keys}, words bigint, closed array<int>, held array<int>, before array<int>")
    return summaries.groupBy("file", "owner_seq").applyInPandas(follow, f"{keys}, first int, open int, joined int, total bigint")


def chunks(owned: DataFrame) -> DataFrame:
    """Chunks of the contents (file, owner_seq, seq, label, testo, label_confidence) of each node.

    Columns: file, owner_seq, chunk_index, text, word_count, labels (histogram), confidence (mean of those known) and
    items. Contents above the chunk size are windows first. Nodes with fewer words than the least chunk give one chunk
    with index -1, the text of the node itself. Null texts count no words.
    """
    keys = ["file", "owner_seq", "seq", "label", "label_confidence"]
    pieces = long_windows(owned.withColumn("testo", F.coalesce("testo", F.lit(""))), keys, "testo").withColumn("words", count_words(F.col("text")).cast("int"))
    spans = pieces.withColumn("owner_seq", F.coalesce("owner_seq", F.lit(-1)).cast("long")).withColumn("span", F.floor((F.col("seq") - F.col("owner_seq")) / SPAN))
    spans = written(spans, "chunks")
    node = ["file", "owner_seq"]
    lengths = spans.select(*node, "span", "seq", "split_word_start", "words")
    starts = stretch_starts(lengths.join(lengths.where("span > 0").select(*node).distinct(), node, "left_semi"))

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["seq", "split_word_start"])
        words, start = group["words"].tolist(), group.iloc[0]
        if pd.isna(start["total"]):  # the whole node
            group["chunk_index"] = [-1] * len(group) if sum(words) < LEAST_CHUNK else chunk_sizes(words)
        elif start["total"] < LEAST_CHUNK:
            group["chunk_index"] = -1
        else:
            out = walked(words, int(start["first"]), int(start["open"]), 0, MOST_CHUNK)[0]
            group["chunk_index"] = [c - (c == start["joined"]) for c in out]
        return group[["file", "owner_seq", "seq", "split_word_start", "label", "label_confidence", "text", "words", "chunk_index"]]

    schema = "file string, owner_seq bigint, seq bigint, split_word_start int, label string, label_confidence double, text string, words int, chunk_index int"
    placed = spans.join(starts, [*node, "span"], "left").groupBy(*node, "span").applyInPandas(walk, schema)
    held = F.array_sort(F.collect_list(F.struct("seq", "split_word_start", "text")))
    names = F.array_sort(F.collect_list("label"))
    counted = F.map_from_entries(F.transform(F.array_distinct(names), lambda x: F.struct(x, F.size(F.filter(names, lambda y: y == x)))))
    packed = placed.groupBy(*node, "chunk_index").agg(held.alias("held"), F.sum("words").cast("int").alias("word_count"), F.avg("label_confidence").alias("confidence"), counted.alias("labels"))
    return packed.select("file", F.nullif("owner_seq", F.lit(-1)).alias("owner_seq"), "chunk_index", F.array_join("held.text", "\n").alias("text"), "word_count", "confidence", "labels", F.col("held.seq").alias("items"))


def accepted_recitals(numbers: Column, step: int = RECITAL_STEP) -> Column:
    """The numbers of a list, in order, that continue the sequence: the first is 1, the next at most ``step`` larger.

    A fold over the list; a number that doesn't continue is left out and changes nothing.
    """
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("kept"))

    def follow(acc: Column, n: Column) -> Column:
        n = n.cast("bigint")
        fits = F.when(acc["last"].isNull(), n == 1).otherwise((n >= acc["last"]) & (n <= acc["last"] + step))
        return F.when(fits, F.struct(n.alias("last"), F.concat(acc["kept"], F.array(n)).alias("kept"))).otherwise(acc)

    return F.aggregate(numbers, start, follow)["kept"]
