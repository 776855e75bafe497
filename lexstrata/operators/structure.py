"""Labels, headings, tree and chunks of scanned documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions.text import bind, matching_text
from lexstrata.operators.order import positions, running_last

#: Thresholds (fixed values): contents pages, running headers, chunks, recital steps.
CONTENTS_HEADINGS, CONTENTS_SHARE = 5, 0.5
HEADER_ORDER, HEADER_PAGES = 2, 3
LEAST_CHUNK, MOST_CHUNK, OVERLAP = 60, 220, 40
#: Labels that hold others; a recital stands by itself under the root.
CONTAINERS = {k: n for k, n in P.LEVELS.items() if k != "recital"}
RECITAL_STEP = 3


def labelled(blocks: DataFrame) -> DataFrame:
    """``blocks`` with norm, structural (label of the heading or null), label, reason, number and rubric.

    ``label`` is the deterministic one, else ``content``. Null texts are empty and have no label of their own.
    """
    first = blocks.withColumn("norm", matching_text(F.col("testo")))
    first = first.withColumn("structural", bind(F.col("norm"), lambda t: P.structural_label(t, F.col("profile"))))

    def decided(t: Column) -> Column:
        sure, reason = P.deterministic_label(t, F.col("profile"), F.col("structural"), F.col("recovered_extra_candidate"))
        return F.struct(sure.alias("sure"), reason.alias("reason"))

    rows = first.withColumn("_d", bind(F.col("norm"), decided)).withColumn("sure", F.col("_d.sure")).withColumn("reason", F.col("_d.reason")).drop("_d")
    rows = rows.withColumn("label", F.coalesce("sure", F.lit("content")))
    rows = rows.withColumn("number", P.structural_number(F.col("norm"), F.col("profile"), F.col("structural")))
    return rows.withColumn("rubric", F.when(F.col("structural") == "article", P.article_rubric(F.col("norm"), F.col("profile"))))


def strict_validation(label: Column, structural: Column, recovered: Column) -> tuple[Column, Column]:
    """(label, reason) of a predicted label that the text must bear out; content labels pass.

    A structural label that the text doesn't have becomes content, or unresolved on a recovered block.
    """
    is_structural = label.isin(list(P.LEVELS))
    kept = ~is_structural | label.eqNullSafe(structural)
    out = F.when(kept, label).when(F.coalesce(recovered, F.lit(False)), "unresolved").otherwise("content")
    return out, F.when(~kept, F.concat(F.lit("no_header_for_"), label))


def page_profile(rows: DataFrame) -> DataFrame:
    """Blocks and headings of each page and whether it is a page of contents; rows have file, page, is_heading."""
    pages = rows.where("page is not null").groupBy("file", "page").agg(F.count(F.lit(1)).alias("blocks"), F.count_if("is_heading").alias("headings"))
    return pages.withColumn("contents_page", (F.col("headings") >= CONTENTS_HEADINGS) & (F.col("headings") / F.col("blocks") >= CONTENTS_SHARE))


def heading_flags(rows: DataFrame) -> DataFrame:
    """Headings with contents_page, running_header, suppressed (as either, or without a body) and downgraded.

    ``rows``: file, seq, _page, page, page_order, is_heading, label, number, norm, rubric. The first heading of a running
    header outside contents pages stays; a heading without a body is suppressed where another of the same label and
    number has one; a later occurrence that goes on in lower case becomes content.
    """
    pages = page_profile(rows).select("file", F.col("page"), "contents_page")
    next_in_page = Window.partitionBy("file", "_page").orderBy("seq")
    heads = rows.where("is_heading")
    # rows up to the next heading: on the same page, else on the next page that has one
    first_of_page = heads.groupBy("file", "_page").agg(F.min("seq").alias("_first"))
    totals = rows.groupBy("file").agg(F.max("seq").alias("_last_row"))
    following = first_of_page.withColumn("_next_page", F.lead("_first").over(Window.partitionBy("file").orderBy("_page"))).drop("_first")
    gaps = heads.withColumn("_next", F.lead("seq").over(next_in_page)).join(following, ["file", "_page"]).join(totals, "file")
    gaps = gaps.withColumn("body", F.coalesce("_next", "_next_page", F.col("_last_row") + 1) - F.col("seq") - 1).drop("_next", "_next_page", "_last_row")
    tops = heads.where((F.coalesce("page_order", F.lit(0)) <= HEADER_ORDER) & F.col("page").isNotNull())
    repeated = tops.groupBy("file", "norm").agg(F.count_distinct("page").alias("_pages")).where(F.col("_pages") >= HEADER_PAGES).select("file", "norm", F.lit(True).alias("running_header"))
    known = gaps.join(pages, ["file", "page"], "left").join(repeated, ["file", "norm"], "left").fillna(False, ["contents_page", "running_header"])
    by_text = Window.partitionBy("file", "norm").orderBy("contents_page", "seq")
    known = known.withColumn("_nth", F.row_number().over(by_text))
    furniture = F.col("contents_page") | (F.col("running_header") & (F.col("_nth") > 1))
    known = known.withColumn("_furniture", furniture).withColumn("key", F.coalesce("number", "norm"))
    same = Window.partitionBy("file", "label", "key")
    bodiless = (F.count(F.lit(1)).over(same) > 1) & (F.max("body").over(same) > 0) & (F.col("body") == 0)
    known = known.withColumn("bodiless", bodiless).withColumn("suppressed", F.col("_furniture") | F.col("bodiless"))
    title_like = ~F.coalesce("rubric", F.lit("")).rlike(r"^\p{Ll}")
    canonical = F.min(F.when(title_like, F.col("seq"))).over(same)
    downgraded = ~F.col("suppressed") & ~title_like & canonical.isNotNull() & (F.col("seq") > canonical)
    return known.withColumn("downgraded", downgraded).drop("_nth", "_furniture")


def parents(rows: DataFrame) -> DataFrame:
    """Structural rows with level, parent_seq (null under the root) and depth of the tree.

    The parent is the last row of a lower level with no row of an even lower level after it: the greatest of the last
    positions of all lower levels.
    """
    levels = sorted(set(CONTAINERS.values()))
    level = F.coalesce(*(F.when(F.col("label") == name, F.lit(n)) for name, n in CONTAINERS.items()))
    nodes = rows.withColumn("level", level).where(F.col("level").isNotNull())
    marked = running_last(nodes, {f"last_{k}": F.col("level") == k for k in levels}, inclusive=False)
    lower = F.coalesce(*(F.when(F.col("level") == n, F.greatest(*(F.coalesce(f"last_{k}", F.lit(-1)) for k in levels if k < n), F.lit(-1)) if n > 1 else F.lit(-1)) for n in levels))
    return marked.withColumn("parent_seq", F.nullif(lower.cast("long"), F.lit(-1).cast("long")))


def owners(rows: DataFrame) -> DataFrame:
    """Content rows with owner_seq, the last structural row before them; null before the first."""
    marked = running_last(rows, {"owner_seq": F.col("label").isin(list(CONTAINERS))}, inclusive=False)
    return marked.where(~F.col("label").isin(*CONTAINERS, "recital", "noise"))


def node_paths(nodes: DataFrame) -> DataFrame:
    """Structural rows with path, the headings from the root to them."""
    levels = sorted(set(P.LEVELS.values()))
    out = nodes.select("file", "seq", "level", "parent_seq", "norm", F.array("norm").alias("path"), F.col("parent_seq").alias("_up"))
    heads = nodes.select(F.col("file").alias("_f"), F.col("seq").alias("_s"), F.col("norm").alias("_n"), F.col("parent_seq").alias("_p"))
    for _ in levels[:-1]:
        step = out.join(heads, (F.col("file") == F.col("_f")) & (F.col("_up") == F.col("_s")), "left")
        out = step.select("file", "seq", "level", "parent_seq", "norm", F.when(F.col("_n").isNotNull(), F.concat(F.array("_n"), "path")).otherwise(F.col("path")).alias("path"), F.col("_p").alias("_up"))
    return out.drop("_up")


def long_windows(df: DataFrame, keys: list[str], text_col: str, most: int = MOST_CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keys``, split_word_start, word_count and text of each text: itself, or windows of ``most`` words that share ``overlap``."""
    words = F.filter(F.split(F.col(text_col), r"(?U)\s+"), lambda w: w != "")
    step = most - max(0, min(overlap, most - 1))
    rows = df.select(*keys, F.col(text_col).alias("_text"), words.alias("_words")).withColumn("_n", F.size("_words"))
    last = (F.ceil(F.greatest(F.col("_n") - most, F.lit(0)) / step) * step).cast("int")
    starts = F.sequence(F.lit(0), last, F.lit(step))
    out = rows.select(*keys, "_text", "_words", "_n", F.explode(starts).alias("split_word_start"))
    piece = F.slice("_words", F.col("split_word_start") + 1, F.lit(most))
    return out.select(*keys, "split_word_start", F.size(piece).alias("word_count"), F.when(F.col("_n") <= most, F.col("_text")).otherwise(F.array_join(piece, " ")).alias("text"))


def prepared(blocks: DataFrame) -> DataFrame:
    """Labelled blocks in reading order: the input of the structural operators."""
    return positions(labelled(blocks)).withColumn("is_heading", F.col("structural").isNotNull() & (F.col("structural") != "recital"))


