"""Samples of long documents: the text that the language and the structure of a file are judged by."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.operators.order import positions

#: Blocks and characters of the samples (fixed values).
HEAD, SPREAD, SHORT, SHORT_CHARS, LANGUAGE_CHARS = 40, 60, 40, 80, 6_000
PAGES, PAGE_CHARS = 5, 12_000
#: Labels whose first page is always in the sample.
FIRST_OF = ("article", "title", "chapter", "section", "annex", "recital")
CUT = "\n[... campione troncato a confine blocco ...]"


def _with_text(rows: DataFrame) -> DataFrame:
    """``rows`` with testo without white space around it, where something is left."""
    return rows.withColumn("testo", F.regexp_replace("testo", r"(?U)^\s+|\s+$", "")).where("testo <> ''")


def _every(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each file, evenly spread from the first; rows have _at, their place in the file from 0."""
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_count"))
    step = F.greatest(F.lit(1), F.floor(F.col("_count") / most))
    return rows.join(counts, "file").where((F.pmod("_at", step) == 0) & (F.floor(F.col("_at") / step) < most))


def fill(texts: list[str], budget: int) -> list[str]:
    """Distinct texts in order while they fit; one that doesn't is left out and later ones are tried. The first always stays."""
    kept: list[str] = []
    seen: set[str] = set()
    used = 0
    for text in texts:
        if text in seen or (kept and used + len(text) + 1 > budget):
            continue
        seen.add(text)
        kept.append(text)
        used += len(text) + 1
    return kept


def language_text(blocks: DataFrame) -> DataFrame:
    """file, text: the first blocks of each file, short lines with a letter and a digit, and an even spread over the rest.

    Short lines and spread are taken after the first blocks. Equal texts count once; the text has at most
    ``LANGUAGE_CHARS`` characters unless its first block is longer. Files without text give no row.
    """
    rows = positions(_with_text(blocks).select("file", "block_id", "ordine", "page", "page_order", "testo"))
    rest = rows.where(F.col("seq") >= HEAD)
    short = rest.where((F.length("testo") <= SHORT_CHARS) & F.col("testo").rlike(r"\p{Nd}") & F.col("testo").rlike(r"[\p{L}\p{Nl}\p{No}]"))
    short = positions(short.select("file", "block_id", "ordine", "page", "page_order", "testo")).withColumn("_at", F.col("seq"))
    spread = rest.withColumn("_at", F.col("seq") - HEAD)
    parts = (rows.where(F.col("seq") < HEAD), _every(short, SHORT), _every(spread, SPREAD))
    picked = None
    for n, part in enumerate(parts):
        one = part.select("file", F.lit(n).alias("part"), "seq", "testo")
        picked = one if picked is None else picked.unionByName(one)

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        texts = group.sort_values(["part", "seq"])["testo"].tolist()
        return pd.DataFrame({"file": [group["file"].iloc[0]], "text": ["\n".join(fill(texts, LANGUAGE_CHARS))]})

    return picked.groupBy("file").applyInPandas(joined, "file string, text string")


def page_text(rows: DataFrame) -> DataFrame:
    """file, pages, text: the blocks on the first page of each structural label and on evenly spaced pages, tagged.

    ``rows`` as ``structure.prepared`` has them. The text ends before the first block that would exceed ``PAGE_CHARS``
    characters, the first block stays, and a last line tells where it was cut. Files without pages have an empty sample.
    """
    full = _with_text(rows)
    paged = full.where("page is not null")
    firsts = paged.where(F.col("structural").isin(*FIRST_OF)).groupBy("file", "structural").agg(F.min("page").alias("page")).select("file", "page")
    w = Window.partitionBy("file")
    pages = paged.select("file", "page").distinct().withColumn("i", F.row_number().over(w.orderBy("page")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    spaced = F.exists(F.array(*(F.bround(F.lit(k) * (F.col("n") - 1) / (PAGES - 1), 0) for k in range(PAGES))), lambda x: x == F.col("i"))
    selected = firsts.unionByName(pages.where((F.col("n") <= PAGES) | spaced).select("file", "page")).distinct()
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("page", "page_order", "block_type")]
    tagged = F.concat(F.lit("[page="), shown[0], F.lit(" order="), shown[1], F.lit(" tipo_ocr="), shown[2], F.lit("] "), F.col("testo"))
    lines = paged.join(selected, ["file", "page"]).select("file", "seq", tagged.alias("line"))
    inside = Window.partitionBy("file").orderBy("seq")
    held = lines.withColumn("_used", F.sum(F.length("line") + 1).over(inside)).withColumn("_n", F.row_number().over(inside)).withColumn("kept", (F.col("_n") == 1) | (F.col("_used") <= PAGE_CHARS))
    texts = held.groupBy("file").agg(F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("seq", "line")))).alias("x"), F.bool_or(~F.col("kept")).alias("cut"))
    texts = texts.select("file", F.concat(F.array_join("x.line", "\n"), F.when(F.col("cut"), CUT).otherwise("")).alias("text"))
    numbers = selected.groupBy("file").agg(F.array_sort(F.collect_set("page")).alias("pages"))
    out = full.select("file").distinct().join(numbers, "file", "left").join(texts, "file", "left")
    return out.select("file", F.coalesce("pages", F.array().cast("array<int>")).alias("pages"), F.coalesce("text", F.lit("")).alias("text"))
