"""Queries of the structural operators, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions import text as X
from lexstrata.functions.runtime import read_table, written
from lexstrata.operators import structure as S
from lexstrata.operators import tree as TR
from lexstrata.operators.records import MERGE_PRIORITY, merge_unique
from lexstrata.operators.order import positions
from lexstrata.sources.blocks import count_blocks, delivered_blocks

#: Delivered blocks once, with profile; then labelled; then in reading order.
BLOCKS = f"""blocks AS (SELECT b.*, coalesce(l.profile, 'it') AS profile FROM (SELECT * FROM ocr_blocks QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY ingested_at) = 1) b LEFT JOIN (SELECT file, {P.profile_of_sql('code')} AS profile FROM language_config) l USING (file))"""
LABELLED = f"""{BLOCKS}, normed AS (SELECT *, {X.matching_text_sql('testo')} AS norm FROM blocks), headed AS (SELECT *, {P.structural_label_sql('norm', 'profile')} AS structural FROM normed),
labelled AS (SELECT *, {P.deterministic_label_sql('norm', 'profile', 'structural', 'recovered_extra_candidate', True)} AS sure, {P.deterministic_label_sql('norm', 'profile', 'structural', 'recovered_extra_candidate', False)} AS reason, {P.structural_number_sql('norm', 'profile', 'structural')} AS number, CASE WHEN structural = 'article' THEN {P.article_rubric_sql('norm', 'profile')} END AS rubric FROM headed)"""
ORDERED = f"""{LABELLED}, ordered AS (SELECT *, coalesce(sure, 'content') AS label, coalesce(structural <> 'recital', false) AS is_heading, row_number() OVER (PARTITION BY file ORDER BY page NULLS LAST, page_order NULLS LAST, ordine, block_id) - 1 AS seq FROM labelled)"""
LEVEL = "CASE label " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in S.CONTAINERS.items()) + " END"
HEADINGS = f"""{ORDERED}, pages AS (SELECT file, page, count(*) AS blocks, count(*) FILTER (is_heading) AS headings FROM ordered WHERE page IS NOT NULL GROUP BY ALL),
contents AS (SELECT *, headings >= {S.CONTENTS_HEADINGS} AND headings / blocks >= {S.CONTENTS_SHARE} AS contents_page FROM pages),
heads AS (SELECT *, coalesce(lead(seq) OVER (PARTITION BY file ORDER BY seq), total) - seq - 1 AS body FROM (SELECT *, count(*) OVER (PARTITION BY file) AS total FROM ordered) WHERE is_heading),
repeated AS (SELECT file, norm FROM heads WHERE coalesce(page_order, 0) <= {S.HEADER_ORDER} AND page IS NOT NULL GROUP BY ALL HAVING count(DISTINCT page) >= {S.HEADER_PAGES}),
known AS (SELECT h.*, coalesce(c.contents_page, false) AS contents_page, r.norm IS NOT NULL AS running_header, coalesce(h.number, h.norm) AS key FROM heads h LEFT JOIN contents c USING (file, page) LEFT JOIN repeated r ON r.file = h.file AND r.norm = h.norm),
nth AS (SELECT *, row_number() OVER (PARTITION BY file, norm ORDER BY contents_page, seq) AS nth, count(*) OVER k > 1 AND max(body) OVER k > 0 AND body = 0 AS bodiless, NOT regexp_matches(coalesce(rubric, ''), '^\\p{{Ll}}') AS title_like FROM known WINDOW k AS (PARTITION BY file, label, key)),
flagged AS (SELECT *, contents_page OR (running_header AND nth > 1) OR bodiless AS suppressed, min(CASE WHEN title_like THEN seq END) OVER (PARTITION BY file, label, key) AS canonical FROM nth),
heading_flags AS (SELECT *, NOT suppressed AND NOT title_like AND canonical IS NOT NULL AND seq > canonical AS downgraded FROM flagged)"""

_IN = ", ".join
_QUOTED = lambda words: _IN(f"'{w}'" for w in words)
_SAYS = lambda attribute: f"coalesce({_either_sql(attribute, 'norm')}, false)"


def _either_sql(attribute: str, text: str) -> str:
    return P.by_profile_sql("profile", lambda p: f"regexp_matches({text}, {X.lit_sql('(?i)' + getattr(p, attribute))})")


def _decided_sql() -> str:
    """The decisions of ``operators.tree.decided`` as SQL, with windows over whole files and a recursive walk over recital numbers."""
    words = f"list_filter(string_split_regex(trim(regexp_replace(testo, '{X.WS}+', ' ', 'g'), ' '), ' '), lambda x: x <> '')"
    c = P.PROFILES["en"].convention("foreign")
    marked = f"list_filter({words}, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}') AND regexp_matches(x, {X.lit_sql('(?i)' + P.PROFILES['en'].foreign)}))"
    foreign = f"coalesce(profile = 'en' AND len({words}) >= {c['least_words']} AND len({marked}) / greatest(len({words}), 1) >= {c['share']}, false)"
    count = X.count_words_sql("norm")
    note = f"coalesce(lower(coalesce(block_type, '')) LIKE '%footnote%' OR lower(coalesce(document_zone, '')) IN ({_QUOTED(TR.NOTE_ZONES)}) OR (regexp_matches(norm, '^[(][0-9]+[)] +') AND {_either_sql('citation', 'norm')} AND {count} <= {TR.NOTE_WORDS}), false)"
    until = "(PARTITION BY file ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = "(PARTITION BY file ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    last = lambda name, condition, over: f"max(CASE WHEN {condition} THEN seq END) OVER {over} AS {name}"
    rubric_profiles = _QUOTED(code for code, p in P.PROFILES.items() if p.convention("rubric") == "before")
    status = f"CASE review_status {' '.join(f"WHEN '{k}' THEN {n}" for k, n in MERGE_PRIORITY.items())} ELSE 0 END"
    return f"""{HEADINGS}, recs AS (SELECT block_id, etichetta, review_status FROM classificazione_blocchi QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY {status} DESC, ingested_at DESC NULLS LAST, classified_at DESC NULLS LAST, review_id DESC NULLS LAST, etichetta NULLS FIRST) = 1),
d1 AS (SELECT o.* EXCLUDE (label, reason), coalesce(h.suppressed, false) AS suppressed, coalesce(h.downgraded, false) AS downgraded, r.review_status, coalesce(nullif(lower(trim(r.etichetta, ' ')), ''), o.sure, 'content') AS own FROM ordered o LEFT JOIN heading_flags h ON h.file = o.file AND h.seq = o.seq LEFT JOIN recs r ON r.block_id = o.block_id),
d2 AS (SELECT *, own = 'unresolved' OR coalesce(review_status IN ({_QUOTED(TR.BLOCKING)}), false) AS blocked, {foreign} AS is_foreign, {note} AS note, {P.by_profile_sql('profile', lambda p: P.editorial_note_sql('norm', p))} AS editorial, {_SAYS('preamble')} AS says_preamble, coalesce(structural = 'part' AND {count} <= {TR.LOCAL_WORDS}, false) AS local_part FROM d1),
d3 AS (SELECT *, norm <> '' AND NOT blocked AND NOT is_foreign AS live FROM d2),
d4 AS (SELECT *, live AND {_SAYS('recital_start')} AS starts, live AND {_SAYS('device_start')} AS enacts FROM d3),
d5 AS (SELECT *, {last('section', 'starts', until)}, {last('last_device', 'enacts', until)}, {last('last_article', "live AND NOT suppressed AND structural = 'article'", before)}, {last('last_annex', "live AND NOT suppressed AND structural = 'annex'", before)}, {last('last_part', "live AND NOT suppressed AND structural = 'part' AND NOT local_part", before)} FROM d4),
d6 AS (SELECT *, coalesce(section > coalesce(last_device, -1), false) AS in_recitals, live AND (own = 'recital' OR coalesce(structural = 'recital', false)) AND NOT starts AND NOT enacts AS candidate FROM d5),
numbers AS (SELECT file, section, seq, TRY_CAST(number AS DOUBLE) AS n, row_number() OVER (PARTITION BY file, section ORDER BY seq) AS k FROM d6 WHERE candidate AND in_recitals AND last_article IS NULL AND NOT note AND TRY_CAST(number AS DOUBLE) IS NOT NULL),
walk AS (SELECT file, section, seq, k, n = 1 AS fits, CASE WHEN n = 1 THEN n END AS at FROM numbers WHERE k = 1 UNION ALL SELECT m.file, m.section, m.seq, m.k, CASE WHEN w.at IS NULL THEN m.n = 1 ELSE m.n BETWEEN w.at AND w.at + {S.RECITAL_STEP} END, CASE WHEN (CASE WHEN w.at IS NULL THEN m.n = 1 ELSE m.n BETWEEN w.at AND w.at + {S.RECITAL_STEP} END) THEN m.n ELSE w.at END FROM walk w JOIN numbers m ON m.file = w.file AND m.section = w.section AND m.k = w.k + 1),
near AS (SELECT a.file, a.seq AS article_seq, t.seq AS rubric_seq, t.norm AS title, t.structural IS NULL AND t.sure IS NULL AND lower(coalesce(t.block_type, '')) IN ({_QUOTED(TR.TITLE_TYPES)}) AND {X.count_words_sql('t.norm')} BETWEEN 1 AND {P.PROFILES['en'].convention('rubric_words')} AS titled FROM ordered a JOIN ordered t ON t.file = a.file AND t.seq BETWEEN a.seq - 3 AND a.seq - 1 AND t.norm <> '' WHERE a.structural = 'article' AND a.rubric IS NULL AND a.profile IN ({rubric_profiles}) QUALIFY row_number() OVER (PARTITION BY a.file, a.seq ORDER BY t.seq DESC) = 1),
pairs AS (SELECT * FROM near WHERE titled),
d7 AS (SELECT d.*, coalesce(w.fits, false) AS accepted, c.rubric_seq IS NOT NULL AS consumed, f.title FROM d6 d LEFT JOIN walk w ON w.file = d.file AND w.seq = d.seq LEFT JOIN pairs c ON c.file = d.file AND c.rubric_seq = d.seq LEFT JOIN pairs f ON f.file = d.file AND f.article_seq = d.seq),
d8 AS (SELECT *, CASE WHEN starts THEN 'content' WHEN accepted THEN 'recital' WHEN candidate THEN CASE WHEN note THEN 'noise' ELSE 'content' END WHEN says_preamble THEN 'content' WHEN title IS NOT NULL THEN 'article' ELSE own END AS one FROM d7),
d9 AS (SELECT *, CASE WHEN structural IS NOT NULL AND NOT (structural = 'recital' AND last_article IS NOT NULL) AND NOT accepted AND NOT says_preamble AND NOT starts_with(norm, '<') THEN structural ELSE one END AS two FROM d8),
d10 AS (SELECT *, CASE WHEN two = 'part' AND local_part AND coalesce(last_annex > coalesce(last_part, -1), false) THEN 'part_of_annex' WHEN editorial THEN 'editorial_note' WHEN two NOT IN ({_QUOTED([*P.LEVELS, *P.CONTENT_LABELS])}) THEN 'unknown_label' WHEN two = 'article' AND structural IS DISTINCT FROM two AND title IS NULL THEN 'no_header_for_article' WHEN two IN ({_QUOTED(c for c in S.CONTAINERS if c != 'article')}) AND structural IS DISTINCT FROM two THEN 'no_header_for_' || two WHEN two IN ({_QUOTED(S.CONTAINERS)}) AND coalesce(recovered_extra_candidate, false) AND review_status IS DISTINCT FROM 'llm_reviewed' THEN 'recovered' WHEN downgraded THEN 'goes_on' END AS why FROM d9),
d11 AS (SELECT *, CASE WHEN norm = '' THEN 'empty' WHEN blocked THEN 'review_missing' WHEN is_foreign THEN 'foreign' WHEN consumed THEN 'rubric' WHEN suppressed THEN 'suppressed' END AS gone, CASE WHEN why IS NOT NULL THEN 'content' ELSE two END AS label FROM d10),
decided AS (SELECT * REPLACE (coalesce(rubric, title) AS rubric), CASE WHEN gone IS NULL AND label <> 'noise' THEN label END AS decision, coalesce(gone, CASE WHEN label = 'noise' THEN 'noise' END, CASE WHEN label <> own THEN coalesce(why, CASE WHEN two <> one THEN 'header' END, CASE WHEN candidate THEN CASE WHEN accepted THEN 'recital' ELSE 'not_validated' END END, CASE WHEN title IS NOT NULL THEN 'rubric_before' END, 'preamble') END) AS reason FROM d11)"""


def _tree_sql() -> str:
    """Nodes and owned contents of ``operators.tree.tree`` as SQL."""
    last = lambda name, condition: f"max(CASE WHEN {condition} THEN seq END) OVER w AS {name}"
    lasts = _IN(last(f"last_{k}", f"level = {k}") for k in range(1, 6))
    return f"""{_decided_sql()}, leveled AS (SELECT * EXCLUDE (label), decision AS label, {LEVEL.replace('CASE label', 'CASE decision')} AS level FROM decided WHERE decision IS NOT NULL),
marks AS (SELECT *, {lasts}, {last('last_recital', "label = 'recital'")}, {last('last_bare', "label = 'article' AND rubric IS NULL")}, {last('last_any', 'true')} FROM leveled WINDOW w AS (PARTITION BY file ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (SELECT *, greatest(coalesce(last_1, -1), coalesce(last_2, -1), coalesce(last_3, -1), coalesce(last_4, -1), coalesce(last_5, -1)) AS container FROM marks),
hung AS (SELECT *, CASE WHEN level IS NULL AND label <> 'recital' THEN nullif(CASE WHEN in_recitals AND last_recital > container AND last_recital > coalesce(last_device, -1) THEN last_recital ELSE container END, -1) END AS owner_seq, CASE WHEN label = 'content' AND last_bare = last_any AND structural IS NULL AND {X.count_words_sql('norm')} <= {TR.RUBRIC_WORDS} THEN last_bare END AS absorbed FROM opened),
nodes AS (SELECT h.* EXCLUDE (level, rubric), coalesce(h.level, 1) AS level, coalesce(h.rubric, r.norm) AS rubric, nullif(CASE h.level WHEN 1 THEN -1 WHEN 2 THEN coalesce(h.last_1, -1) WHEN 3 THEN greatest(coalesce(h.last_1, -1), coalesce(h.last_2, -1)) WHEN 4 THEN greatest(coalesce(h.last_1, -1), coalesce(h.last_2, -1), coalesce(h.last_3, -1)) WHEN 5 THEN greatest(coalesce(h.last_1, -1), coalesce(h.last_2, -1), coalesce(h.last_3, -1), coalesce(h.last_4, -1)) END, -1) AS parent_seq FROM hung h LEFT JOIN hung r ON r.file = h.file AND r.absorbed = h.seq WHERE h.level IS NOT NULL OR h.label = 'recital'),
owned AS (SELECT * FROM hung WHERE level IS NULL AND label <> 'recital' AND absorbed IS NULL)"""


DECIDED, TREE = _decided_sql(), _tree_sql()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.prepared(delivered_blocks(spark, sf_dir))


#: Columns of prepared blocks that the tree needs.
TREE_COLUMNS = ("file", "block_id", "ordine", "page", "page_order", "_page", "seq", "testo", "norm", "profile", "structural", "sure", "number", "rubric", "is_heading", "label", "block_type", "document_zone", "recovered_extra_candidate")


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decisions over the delivered blocks and their records; read by all queries of the tree, so written once."""
    records = merge_unique(read_table(spark, sf_dir, "classificazione_blocchi"), identity=("block_id",)).select("block_id", "etichetta", "review_status")
    rows = written(_prepared(spark, sf_dir).select(*TREE_COLUMNS).join(records, "block_id", "left"), "prepared")
    return written(TR.decided(rows), "decisions")


@query(f"WITH RECURSIVE {DECIDED} SELECT file, block_id, own, decision, reason FROM decided")
def tree_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every block is in the tree, or why it isn't in it."""
    return decisions(spark, sf_dir).select("file", "block_id", "own", "decision", "reason")


@query(f"WITH {BLOCKS} SELECT file, block_id, row_number() OVER (PARTITION BY file ORDER BY page NULLS LAST, page_order NULLS LAST, ordine, block_id) - 1 AS seq FROM blocks")
def load_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in reading order."""
    return positions(delivered_blocks(spark, sf_dir)).select("file", "block_id", "seq")


@query(f"WITH {BLOCKS} SELECT file, count(*) AS blocks, count(DISTINCT page) AS pages, sum(length(testo))::BIGINT AS chars FROM blocks GROUP BY file")
def block_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks, pages and characters of each file."""
    return count_blocks(delivered_blocks(spark, sf_dir))


@query(f"WITH {BLOCKS} SELECT file, block_id FROM blocks QUALIFY row_number() OVER (PARTITION BY file ORDER BY page NULLS LAST, page_order NULLS LAST, ordine, block_id) <= 20")
def first_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 blocks of each file, as a limited load has them."""
    return positions(delivered_blocks(spark, sf_dir)).where("seq < 20").select("file", "block_id")


@query(f"WITH {BLOCKS} SELECT block_id, {X.source_text_sql('testo')} AS source_text, {X.matching_text_sql('testo')} AS matching_text FROM blocks")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both normal forms of each block."""
    t = F.col("testo")
    return delivered_blocks(spark, sf_dir).select("block_id", X.source_text(t).alias("source_text"), X.matching_text(t).alias("matching_text"))


@query(f"WITH {BLOCKS} SELECT block_id, {X.count_words_sql('testo')}::BIGINT AS words, CASE WHEN length(testo) > 160 THEN left(testo, 160) || ' [...]' ELSE testo END AS preview FROM blocks")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and preview of each block."""
    return delivered_blocks(spark, sf_dir).select("block_id", X.count_words(F.col("testo")).alias("words"), X.truncated(F.col("testo"), 160).alias("preview"))


@query(f"SELECT doc_id, {X.resource_name_sql('title')} AS resource, {X.uri_token_sql('title')} AS uri_token, {X.eid_token_sql('act_number')} AS eid_token FROM documents")
def uri_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and tokens for resources, URIs and element ids."""
    return read_table(spark, sf_dir, "documents").select("doc_id", X.resource_name(F.col("title")).alias("resource"), X.uri_token(F.col("title")).alias("uri_token"), X.eid_token(F.col("act_number")).alias("eid_token"))


@query(f"WITH {LABELLED} SELECT block_id, structural, sure AS label, reason FROM labelled")
def deterministic_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label of each block that the rules are sure of, with the reason."""
    return S.labelled(delivered_blocks(spark, sf_dir)).select("block_id", "structural", F.col("sure").alias("label"), "reason")


@query(f"WITH {LABELLED} SELECT block_id, structural AS label, number, rubric FROM labelled WHERE structural IS NOT NULL")
def structural_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and rubric of each heading."""
    return S.labelled(delivered_blocks(spark, sf_dir)).where("structural is not null").select("block_id", F.col("structural").alias("label"), "number", "rubric")


@query(f"""WITH {LABELLED}, records AS (SELECT block_id, lower(trim(etichetta, ' ')) AS predicted FROM classificazione_blocchi QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY ingested_at DESC, classified_at DESC, review_id DESC NULLS LAST, etichetta) = 1)
SELECT block_id, predicted, CASE WHEN predicted NOT IN ('part','annex','recital','title','chapter','section','article') OR predicted IS NOT DISTINCT FROM structural THEN predicted WHEN recovered_extra_candidate THEN 'unresolved' ELSE 'content' END AS label,
CASE WHEN predicted IN ('part','annex','recital','title','chapter','section','article') AND predicted IS DISTINCT FROM structural THEN 'no_header_for_' || predicted END AS reason FROM records JOIN labelled USING (block_id) WHERE predicted IS NOT NULL""")
def strict_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last classified label of each block, checked against its text."""
    records = _records(spark, sf_dir)
    latest = Window.partitionBy("block_id").orderBy(F.desc("ingested_at"), F.desc("classified_at"), F.col("review_id").desc_nulls_last(), "etichetta")
    last = records.withColumn("_n", F.row_number().over(latest)).where("_n = 1").select("block_id", F.lower(F.trim("etichetta")).alias("predicted")).where("predicted is not null")
    joined = last.join(S.labelled(delivered_blocks(spark, sf_dir)), "block_id")
    label, reason = S.strict_validation(F.col("predicted"), F.col("structural"), F.col("recovered_extra_candidate"))
    return joined.select("block_id", "predicted", label.alias("label"), reason.alias("reason"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "classificazione_blocchi")


STOPS = {c: p.stopwords for c, p in P.PROFILES.items() if p.stopwords}


def _stops_sql(code: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in STOPS[code]) + "]"


@query(f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(coalesce(text, ''))), '\\p{{L}}+') AS words FROM documents),
s AS (SELECT doc_id, len(words) AS n, {', '.join(f"len(list_filter(words, lambda x: list_contains({_stops_sql(c)}, x))) AS {c}" for c in STOPS)} FROM w)
SELECT doc_id, CASE WHEN n = 0 OR greatest(en, it) = 0 THEN NULL WHEN en >= it THEN 'en' ELSE 'it' END AS hint_code, round(greatest(en, it) / greatest(n, 1), 4) AS hint_score FROM s""")
def language_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile whose stop words make up the largest share of a document's words; the first code wins ties."""
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}+"), 0)
    rows = read_table(spark, sf_dir, "documents").select("doc_id", words.alias("w")).withColumn("n", F.size("w"))
    rows = rows.withColumns({c: _held("w", STOPS[c]) for c in STOPS})
    best = F.greatest("en", "it")
    code = F.when((F.col("n") == 0) | (best == 0), None).when(F.col("en") >= F.col("it"), "en").otherwise("it")
    return rows.select("doc_id", code.alias("hint_code"), F.round(best / F.greatest("n", F.lit(1)), 4).alias("hint_score"))


@query(f"WITH {LABELLED} SELECT file, structural AS label, count(*) AS lines FROM labelled WHERE structural IS NOT NULL GROUP BY ALL")
def structural_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of each label in each file."""
    return S.labelled(delivered_blocks(spark, sf_dir)).where("structural is not null").groupBy("file", F.col("structural").alias("label")).agg(F.count(F.lit(1)).alias("lines"))


def _held(words: str, stops: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda x: x.isin(*stops)))


FOREIGN = P.PROFILES["en"].foreign


@query(f"""WITH {BLOCKS}, t AS (SELECT block_id, list_filter(string_split_regex(trim(regexp_replace(testo, '{X.WS}+', ' ', 'g'), ' '), ' '), lambda x: x <> '') AS tokens FROM blocks WHERE profile = 'en'),
r AS (SELECT block_id, len(tokens) AS n, len(list_filter(tokens, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}') AND regexp_matches(x, {X.lit_sql('(?i)' + FOREIGN)}))) AS marked FROM t)
SELECT block_id, round(marked / greatest(n, 1), 4) AS ratio, n >= 6 AND marked / greatest(n, 1) >= 0.03 AS foreign_block FROM r""")
def foreign_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of words with marks of the other language in blocks of English files, and whether that makes them foreign."""
    tokens = F.filter(F.split(F.trim(F.regexp_replace("testo", X.WS + "+", " ")), " "), lambda x: x != "")
    rows = delivered_blocks(spark, sf_dir).where("profile = 'en'").select("block_id", tokens.alias("t"))
    marked = F.size(F.filter("t", lambda x: ~x.rlike(r"^\p{Lu}") & x.rlike(P.FLAGS + FOREIGN)))
    ratio = marked / F.greatest(F.size("t"), F.lit(1))
    return rows.select("block_id", F.round(ratio, 4).alias("ratio"), ((F.size("t") >= 6) & (ratio >= 0.03)).alias("foreign_block"))


@query(f"""WITH {LABELLED}, w AS (SELECT *, {X.count_words_sql('norm')} AS words, lower(coalesce(block_type, '')) AS t, lower(coalesce(document_zone, '')) AS z, regexp_matches(norm, '^[(][0-9]+[)] +') AS numbered, {_either_sql('citation', 'norm')} AS cites FROM labelled)
SELECT block_id, t LIKE '%footnote%' OR z IN ('footnote', 'footnotes', 'notes', 'headers_footers') OR (numbered AND cites AND words <= 90) AS footnote FROM w""")
def footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that are probably footnotes: by type, by zone, or numbered with citations."""
    rows = S.labelled(delivered_blocks(spark, sf_dir))
    kind, zone = F.lower(F.coalesce("block_type", F.lit(""))), F.lower(F.coalesce("document_zone", F.lit("")))
    cites = P.by_profile(F.col("profile"), lambda p: P.matches(F.col("norm"), p.citation))
    numbered = F.col("norm").rlike("^[(][0-9]+[)] +") & cites & (X.count_words(F.col("norm")) <= 90)
    return rows.select("block_id", (kind.contains("footnote") | zone.isin("footnote", "footnotes", "notes", "headers_footers") | numbered).alias("footnote"))


@query(f"WITH {HEADINGS} SELECT file, page, blocks, headings, contents_page FROM contents")
def toc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and headings of each page and whether it is a page of contents."""
    return S.page_profile(_prepared(spark, sf_dir))


@query(f"WITH {HEADINGS} SELECT block_id, running_header, contents_page, bodiless, suppressed, downgraded FROM heading_flags")
def repeated_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which headings are furniture, have no body, are suppressed or become content."""
    return S.heading_flags(_prepared(spark, sf_dir)).select("block_id", "running_header", "contents_page", "bodiless", "suppressed", "downgraded")


@query(f"WITH RECURSIVE {TREE} SELECT file, block_id, seq, level, parent_seq, rubric FROM nodes")
def parent_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent and rubric of each node."""
    return TR.tree(decisions(spark, sf_dir))[0].select("file", "block_id", "seq", "level", "parent_seq", "rubric")


@query(f"WITH RECURSIVE {TREE} SELECT file, block_id, seq, owner_seq FROM owned")
def content_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node that each content belongs to."""
    return TR.tree(decisions(spark, sf_dir))[1].select("file", "block_id", "seq", "owner_seq")


@query(f"WITH RECURSIVE {TREE}, paths AS (SELECT file, seq, norm AS path FROM nodes WHERE parent_seq IS NULL UNION ALL SELECT n.file, n.seq, p.path || ' > ' || n.norm FROM nodes n JOIN paths p ON p.file = n.file AND p.seq = n.parent_seq) SELECT file, seq, path FROM paths")
def node_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headings from the root to each structural block."""
    return S.node_paths(TR.tree(decisions(spark, sf_dir))[0]).select("file", "seq", F.array_join("path", " > ").alias("path"))


@query(f"WITH RECURSIVE {TREE}, depths AS (SELECT file, seq, 1 AS depth FROM nodes WHERE parent_seq IS NULL UNION ALL SELECT n.file, n.seq, p.depth + 1 FROM nodes n JOIN depths p ON p.file = n.file AND p.seq = n.parent_seq), c AS (SELECT file, count(*) AS contents FROM owned GROUP BY file) SELECT f.file, count(d.seq) AS nodes, coalesce(any_value(c.contents), 0) AS contents, coalesce(max(d.depth), 0)::INT AS max_depth FROM (SELECT DISTINCT file FROM decided) f LEFT JOIN depths d USING (file) LEFT JOIN c USING (file) GROUP BY f.file")
def tree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes, contents and depth of each file's tree."""
    rows = decisions(spark, sf_dir)
    nodes, owned = TR.tree(rows)
    paths = S.node_paths(nodes).groupBy("file").agg(F.count(F.lit(1)).alias("nodes"), F.max(F.size("path")).alias("max_depth"))
    contents = owned.groupBy("file").agg(F.count(F.lit(1)).alias("contents"))
    files = rows.select("file").distinct()
    return files.join(paths, "file", "left").join(contents, "file", "left").select("file", F.coalesce("nodes", F.lit(0)).alias("nodes"), F.coalesce("contents", F.lit(0)).alias("contents"), F.coalesce("max_depth", F.lit(0)).alias("max_depth"))


@query(f"WITH RECURSIVE {TREE} SELECT o.file, n.label, n.number, n.seq, sum({X.count_words_sql('o.testo')})::BIGINT AS words FROM owned o JOIN nodes n ON n.file = o.file AND n.seq = o.owner_seq GROUP BY ALL")
def words_per_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the contents under each node."""
    nodes, contents = TR.tree(decisions(spark, sf_dir))
    owned = contents.groupBy("file", F.col("owner_seq").alias("seq")).agg(F.sum(X.count_words(F.col("testo"))).alias("words"))
    return owned.join(nodes.select("file", "seq", "label", "number"), ["file", "seq"]).select("file", "label", "number", "seq", "words")


@query(f"WITH {LABELLED} SELECT file, label, count(*) AS blocks, count(DISTINCT page) AS pages FROM (SELECT *, coalesce(sure, 'content') AS label FROM labelled) GROUP BY ALL")
def label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and pages of each label in each file."""
    return S.labelled(delivered_blocks(spark, sf_dir)).groupBy("file", "label").agg(F.count(F.lit(1)).alias("blocks"), F.count_distinct("page").alias("pages"))


@query(f"""WITH {BLOCKS}, w AS (SELECT block_id, testo, list_filter(string_split_regex(trim(regexp_replace(testo, '{X.WS}+', ' ', 'g'), ' '), ' '), lambda x: x <> '') AS words FROM blocks),
s AS (SELECT block_id, testo, words, unnest(generate_series(0, (ceil(greatest(len(words) - {S.MOST_CHUNK}, 0) / {S.MOST_CHUNK - S.OVERLAP}.0) * {S.MOST_CHUNK - S.OVERLAP})::INT, {S.MOST_CHUNK - S.OVERLAP})) AS st FROM w)
SELECT block_id, st::INT AS split_word_start, len(words[st + 1 : st + {S.MOST_CHUNK}])::INT AS word_count, CASE WHEN len(words) <= {S.MOST_CHUNK} THEN testo ELSE array_to_string(words[st + 1 : st + {S.MOST_CHUNK}], ' ') END AS text FROM s""")
def split_long_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of at most 220 words of every block."""
    blocks = delivered_blocks(spark, sf_dir)
    return S.long_windows(blocks, ["block_id"], "testo")


@query("""SELECT vec_id, n AS neighbour, rank::INT AS rank, round(score, 4) AS score FROM (SELECT q.vec_id, e.vec_id AS n, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) DESC, e.vec_id) AS rank, list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings e ON e.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 3""")
def knn_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest vectors of every vector whose id is divisible by 50, against all rows.

    The stated query set is the small side and is held by the tasks as a matrix; each partition keeps its own best three
    for every query, so only those are shuffled.
    """
    from lexstrata.operators.nearest import nearest

    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors.where("vec_id % 50 = 0"), vectors, k=3)
