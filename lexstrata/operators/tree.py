"""From labelled blocks to the tree: which blocks stay, as what, and where they hang.

The decisions are taken in a fixed order; what depends on earlier blocks (whether recitals are open, whether an article
came before, whether an annex is open) is a running value over positions, so no task walks through a file. Only the
sequence of recital numbers is a walk, over the numbers of one run of recitals.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions.text import WS, count_words
from lexstrata.operators.order import running_last
from lexstrata.operators.structure import CONTAINERS, RECITAL_STEP, heading_flags

#: Statuses of records that don't take part in the structure (fixed values).
BLOCKING = ("llm_json_error", "llm_review_missing", "pending_llm_review", "slm_failed_unresolved")
#: Block types of titles, and zones and longest text of footnotes (fixed values).
TITLE_TYPES = ("doc_title", "heading", "paragraph_title", "section_header")
NOTE_ZONES, NOTE_WORDS = ("footnote", "footnotes", "headers_footers", "notes"), 90
#: Words of a rubric that follows its article, and of a part inside an annex.
RUBRIC_WORDS, LOCAL_WORDS = 30, 2


def foreign_ratio(text: Column, marks: str) -> Column:
    """Share of the words of a text that hold a mark of another language; names (upper case) don't count as marked."""
    words = F.filter(F.split(F.trim(F.regexp_replace(text, WS + "+", " ")), " "), lambda w: w != "")
    marked = F.filter(words, lambda w: ~w.rlike(r"^\p{Lu}") & w.rlike(P.FLAGS + marks))
    return F.size(marked) / F.greatest(F.size(words), F.lit(1))


def foreign_block(text: Column, profile: Column) -> Column:
    """Whether a text is in another language than its profile's, for profiles that can tell."""

    def one(p: P.Profile) -> Column:
        c = p.convention("foreign")
        if not c:
            return F.lit(False)
        words = F.filter(F.split(F.trim(F.regexp_replace(text, WS + "+", " ")), " "), lambda w: w != "")
        return (F.size(words) >= c["least_words"]) & (foreign_ratio(text, p.foreign) >= c["share"])

    return F.coalesce(P.by_profile(profile, one), F.lit(False))


def footnote(norm: Column, profile: Column, block_type: Column, zone: Column) -> Column:
    """A footnote by its type or zone, or a numbered text of moderate length with citations."""
    cites = P.by_profile(profile, lambda p: P.matches(norm, p.citation))
    numbered = norm.rlike("^[(][0-9]+[)] +") & cites & (count_words(norm) <= NOTE_WORDS)
    kind = F.lower(F.coalesce(block_type, F.lit("")))
    return F.coalesce(kind.contains("footnote") | F.lower(F.coalesce(zone, F.lit(""))).isin(*NOTE_ZONES) | numbered, F.lit(False))


def rubric_pairs(rows: DataFrame) -> DataFrame:
    """file, rubric_seq, article_seq and rubric of titles before an article without a rubric, in profiles that put it before.

    The title is the nearest block with a text among the three before the article, short and without a label of its own.
    """
    before = P.by_profile(F.col("profile"), lambda p: F.lit(p.convention("rubric") == "before"))
    most = P.by_profile(F.col("profile"), lambda p: F.lit(p.convention("rubric_words")))
    articles = rows.where((F.col("structural") == "article") & F.col("rubric").isNull() & before).select("file", F.col("seq").alias("article_seq"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("_back"))
    titled = F.col("structural").isNull() & F.col("sure").isNull() & F.lower(F.coalesce("block_type", F.lit(""))).isin(*TITLE_TYPES) & count_words(F.col("norm")).between(1, most)
    texts = rows.where("norm <> ''").select("file", F.col("seq").alias("rubric_seq"), F.col("norm").alias("rubric"), titled.alias("_titled"))
    near = articles.withColumn("rubric_seq", F.col("article_seq") - F.col("_back")).join(texts, ["file", "rubric_seq"])
    nearest = near.groupBy("file", "article_seq").agg(F.max(F.struct("rubric_seq", "rubric", "_titled")).alias("x"))
    return nearest.where("x._titled").select("file", "x.rubric_seq", "article_seq", "x.rubric")


def accepted_recitals(candidates: DataFrame, step: int = RECITAL_STEP) -> DataFrame:
    """(file, seq) of the candidates (file, section, seq, n) whose numbers go on: 1 first, then at most ``step`` more than the last."""

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        last, kept = None, []
        for seq, n in sorted(zip(group["seq"], group["n"])):
            if (n == 1) if last is None else last <= n <= last + step:
                last = n
                kept.append(seq)
        return pd.DataFrame({"file": [group["file"].iloc[0]] * len(kept), "seq": kept})

    return candidates.groupBy("file", "section").applyInPandas(walk, "file string, seq bigint")


def decided(rows: DataFrame) -> DataFrame:
    """``rows`` with decision: the label that a block has in the tree, or null where it isn't in it, and reason: why that differs from its own label.

    ``rows`` are prepared blocks with etichetta and review_status of their record (null without one). Added besides:
    own (label of the record, else the sure one, else content), in_recitals, last_device (position of the last start of
    the enacting terms so far), rubric (with the title before an article where the profile puts it there). Empty and
    blocked blocks, texts in another language, page furniture and noise have no decision.
    """
    flags = heading_flags(rows).select("file", "seq", "suppressed", "downgraded")
    x = rows.join(flags, ["file", "seq"], "left").fillna(False, ["suppressed", "downgraded"])
    norm, profile = F.col("norm"), F.col("profile")
    x = x.withColumn("own", F.coalesce(F.nullif(F.lower(F.trim("etichetta")), F.lit("")), "sure", F.lit("content")))
    blocked = (F.col("own") == "unresolved") | F.coalesce(F.col("review_status").isin(*BLOCKING), F.lit(False))
    x = x.withColumns({"_blocked": blocked, "_foreign": foreign_block(F.col("testo"), profile), "_note": footnote(norm, profile, F.col("block_type"), F.col("document_zone"))})
    x = x.withColumn("_live", (norm != "") & ~F.col("_blocked") & ~F.col("_foreign"))

    def says(attribute: str) -> Column:
        return F.coalesce(P.by_profile(profile, lambda p: P.matches(norm, getattr(p, attribute))), F.lit(False))

    x = x.withColumns({"_start": F.col("_live") & says("recital_start"), "_device": F.col("_live") & says("device_start"), "_preamble": says("preamble"), "_editorial": P.by_profile(profile, lambda p: P.editorial_note(norm, p))})
    local = (F.col("structural") == "part") & (count_words(norm) <= LOCAL_WORDS)
    shown = F.col("_live") & ~F.col("suppressed")
    x = running_last(x, {"_last_start": F.col("_start"), "_last_device": F.col("_device"), "_last_article": shown & (F.col("structural") == "article"), "_last_annex": shown & (F.col("structural") == "annex"), "_last_part": shown & (F.col("structural") == "part") & ~local}, inclusive=False)
    section, device = F.when(F.col("_start"), F.col("seq")).otherwise(F.col("_last_start")), F.when(F.col("_device"), F.col("seq")).otherwise(F.col("_last_device"))
    x = x.withColumns({"_section": section, "last_device": device}).withColumn("in_recitals", F.coalesce(F.col("_section") > F.coalesce("last_device", F.lit(-1)), F.lit(False)))
    candidate = F.col("_live") & ((F.col("own") == "recital") | F.coalesce(F.col("structural") == "recital", F.lit(False))) & ~F.col("_start") & ~F.col("_device")
    x = x.withColumn("_candidate", candidate)
    numbers = x.where(F.col("_candidate") & F.col("in_recitals") & F.col("_last_article").isNull() & ~F.col("_note")).select("file", F.col("_section").alias("section"), "seq", F.expr("try_cast(number as decimal(38,0))").alias("n")).where("n is not null")
    x = x.join(accepted_recitals(numbers.withColumn("n", F.col("n").cast("double"))).withColumn("_accepted", F.lit(True)), ["file", "seq"], "left").fillna(False, ["_accepted"])
    pairs = rubric_pairs(rows)
    x = x.join(pairs.select("file", F.col("rubric_seq").alias("seq"), F.lit(True).alias("_consumed")), ["file", "seq"], "left").join(pairs.select("file", F.col("article_seq").alias("seq"), F.col("rubric").alias("_title")), ["file", "seq"], "left")
    forced = F.col("_title").isNotNull()
    first = F.when(F.col("_start"), "content").when(F.col("_accepted"), "recital").when(F.col("_candidate"), F.when(F.col("_note"), "noise").otherwise("content")).when(F.col("_preamble"), "content").when(forced, "article").otherwise(F.col("own"))
    headed = F.col("structural").isNotNull() & ~((F.col("structural") == "recital") & F.col("_last_article").isNotNull()) & ~F.col("_accepted") & ~F.col("_preamble") & ~F.coalesce(norm.startswith("<"), F.lit(False))
    second = F.when(headed, F.col("structural")).otherwise(F.col("_first"))
    inside = F.coalesce(F.col("_last_annex") > F.coalesce("_last_part", F.lit(-1)), F.lit(False))
    containers = [c for c in CONTAINERS if c != "article"]
    same = F.col("structural").eqNullSafe(F.col("_second"))
    reason = (
        F.when((F.col("_second") == "part") & local & inside, "part_of_annex")
        .when(F.col("_editorial"), "editorial_note")
        .when(~F.col("_second").isin(*P.LEVELS, *P.CONTENT_LABELS), "unknown_label")
        .when((F.col("_second") == "article") & ~same & ~forced, "no_header_for_article")
        .when(F.col("_second").isin(*containers) & ~same, F.concat(F.lit("no_header_for_"), F.col("_second")))
        .when(F.col("_second").isin(*CONTAINERS) & F.coalesce("recovered_extra_candidate", F.lit(False)) & ~F.col("review_status").eqNullSafe(F.lit("llm_reviewed")), "recovered")
        .when(F.col("downgraded"), "goes_on")
    )
    x = x.withColumn("_first", first).withColumn("_second", second).withColumn("_why", reason)
    gone = F.when(norm == "", "empty").when(F.col("_blocked"), "review_missing").when(F.col("_foreign"), "foreign").when(F.coalesce("_consumed", F.lit(False)), "rubric").when(F.col("suppressed"), "suppressed")
    label = F.when(F.col("_why").isNotNull(), "content").otherwise(F.col("_second"))
    x = x.withColumns({"_gone": gone, "_label": label})
    changed = F.when(F.col("_label") != F.col("own"), F.coalesce("_why", F.when(F.col("_second") != F.col("_first"), "header"), F.when(F.col("_candidate"), F.when(F.col("_accepted"), "recital").otherwise("not_validated")), F.when(forced, "rubric_before"), F.lit("preamble")))
    noise = F.when(F.col("_label") == "noise", "noise")
    x = x.withColumns({"decision": F.when(F.col("_gone").isNull() & (F.col("_label") != "noise"), F.col("_label")), "reason": F.coalesce("_gone", noise, changed), "rubric": F.coalesce("rubric", "_title")})
    return x.drop(*(c for c in x.columns if c.startswith("_") and c != "_page"))


def kept(decisions: DataFrame) -> DataFrame:
    """The rows that are in the tree, with level (null for contents and recitals), parent_seq (of nodes) and owner_seq (of contents), null under the root, and absorbed: the article whose rubric a content is.

    A content belongs to the open recital, else to the last container before it. The first content after an article
    without rubric, of moderate length, is its rubric.
    """
    levels = sorted(set(CONTAINERS.values()))
    level = F.coalesce(*(F.when(F.col("decision") == name, F.lit(n)) for name, n in CONTAINERS.items()))
    rows = decisions.where("decision is not null").withColumn("level", level)
    bare = (F.col("decision") == "article") & F.col("rubric").isNull()
    marks = {f"_at_{k}": F.col("level") == k for k in levels} | {"_recital": F.col("decision") == "recital", "_bare": bare, "_any": F.lit(True)}
    rows = running_last(rows, marks, inclusive=False)
    lower = F.coalesce(*(F.when(F.col("level") == n, F.greatest(F.lit(-1), F.lit(-1), *(F.coalesce(f"_at_{k}", F.lit(-1)) for k in levels if k < n))) for n in levels))
    container = F.greatest(F.lit(-1), *(F.coalesce(f"_at_{k}", F.lit(-1)) for k in levels))
    content = F.col("level").isNull() & (F.col("decision") != "recital")
    in_recital = F.col("in_recitals") & F.col("_recital").isNotNull() & (F.col("_recital") > container) & (F.col("_recital") > F.coalesce("last_device", F.lit(-1)))
    owner = F.when(in_recital, F.col("_recital")).otherwise(container)
    absorbed = (F.col("decision") == "content") & (F.col("_bare") == F.col("_any")) & F.col("structural").isNull() & (count_words(F.col("norm")) <= RUBRIC_WORDS)
    minus = F.lit(-1).cast("long")
    rows = rows.withColumns({"parent_seq": F.when(F.col("level").isNotNull(), F.nullif(lower.cast("long"), minus)), "owner_seq": F.when(content, F.nullif(owner.cast("long"), minus)), "absorbed": F.when(absorbed, F.col("_bare"))})
    return rows.drop(*(c for c in rows.columns if c.startswith("_") and c != "_page"))


def tree(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, contents): containers and recitals with label, level, number, rubric (their own, the title before or the one absorbed) and parent_seq; contents with owner_seq."""
    rows = kept(decisions)
    rubrics = rows.where("absorbed is not null").select("file", F.col("absorbed").alias("seq"), F.col("norm").alias("_absorbed"))
    nodes = rows.where("level is not null or decision = 'recital'").drop("absorbed", "owner_seq").join(rubrics, ["file", "seq"], "left")
    nodes = nodes.withColumns({"rubric": F.coalesce("rubric", "_absorbed"), "level": F.coalesce("level", F.lit(P.LEVELS["recital"])), "label": F.col("decision")}).drop("_absorbed")
    contents = rows.where("level is null and decision <> 'recital' and absorbed is null").drop("absorbed", "parent_seq", "level").withColumn("label", F.col("decision"))
    return nodes, contents
