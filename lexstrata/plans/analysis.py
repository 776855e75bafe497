"""Queries around classification and review, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions import text as X
from lexstrata.functions.runtime import read_table
from lexstrata.operators import analysis as A
from lexstrata.operators import structure as S
from lexstrata.operators.records import merge_unique
from lexstrata.plans.structure import BLOCKS, DECIDED, LABELLED, ORDERED, decisions, query
from lexstrata.sources.blocks import delivered_blocks


@query(f"""WITH {ORDERED} SELECT block_id, coalesce(lag(testo) OVER w, '') AS previous_text, coalesce(lead(testo) OVER w, '') AS next_text, coalesce(lag(coalesce(sure, '')) OVER w, '') AS previous_label, coalesce(lead(coalesce(sure, '')) OVER w, '') AS next_label FROM ordered WINDOW w AS (PARTITION BY file ORDER BY seq)""")
def block_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts before and after each block, and the labels there that the rules are sure of."""
    rows = S.prepared(delivered_blocks(spark, sf_dir))
    return A.with_neighbours(rows, {"text": F.col("testo"), "label": F.coalesce("sure", F.lit(""))}).select("block_id", "previous_text", "next_text", "previous_label", "next_label")


@query(f"WITH {BLOCKS} SELECT block_id, block_type, coalesce(document_zone, '?') AS zone, page_order, json_object('a', source_model, 'b', page, 'c', recovered_extra_candidate)::VARCHAR AS told FROM blocks")
def block_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model is told of a block, as JSON with null members."""
    told = F.to_json(F.struct(F.col("source_model").alias("a"), F.col("page").alias("b"), F.col("recovered_extra_candidate").alias("c")), {"ignoreNullFields": "false"})
    return delivered_blocks(spark, sf_dir).select("block_id", "block_type", F.coalesce("document_zone", F.lit("?")).alias("zone"), "page_order", told.alias("told"))


def _marked_sql(t: str) -> str:
    return P.by_profile_sql("profile", lambda p: f"CASE WHEN regexp_matches({t}, {X.lit_sql('(?i)' + p.paragraph)}) THEN 'paragraph' WHEN regexp_matches({t}, {X.lit_sql('(?i)' + p.point)}) THEN 'point' ELSE 'content' END")


def _page_sql(t: str) -> str:
    return P.by_profile_sql("profile", lambda p: f"regexp_matches({t}, {X.lit_sql('(?i)' + p.page_number)})")


_PLAIN = "trim(coalesce(testo, ''), ' ')"


@query(f"""WITH {BLOCKS}, t AS (SELECT *, {_PLAIN} AS plain FROM blocks) SELECT block_id, coalesce({P.structural_label_sql('plain', 'profile')}, CASE WHEN {_page_sql('plain')} THEN 'noise' END, {_marked_sql("(plain || ' ')")}) AS label FROM t""")
def sample_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of each line as it is written."""
    return delivered_blocks(spark, sf_dir).select("block_id", A.sample_label(F.coalesce("testo", F.lit("")), F.col("profile")).alias("label"))


def _marker_sql() -> str:
    return P.by_profile_sql("profile", lambda p: f"CASE kind WHEN 'paragraph' THEN regexp_extract(norm, {X.lit_sql('(?i)' + p.paragraph)}, 0) WHEN 'point' THEN regexp_extract(norm, {X.lit_sql('(?i)' + p.point)}, 0) ELSE '' END")


@query(f"WITH {LABELLED}, k AS (SELECT *, {_marked_sql('norm')} AS kind FROM labelled), m AS (SELECT *, {_marker_sql()} AS marker FROM k) SELECT block_id, kind, trim(marker, ' ') AS marker, substr(norm, length(marker) + 1) AS rest FROM m")
def content_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, marker as printed and remaining text of each block taken as a content."""
    kind, marker, rest = A.content_parts(F.col("norm"), F.col("profile"))
    return S.labelled(delivered_blocks(spark, sf_dir)).select("block_id", kind.alias("kind"), marker.alias("marker"), rest.alias("rest"))


@query("""WITH low AS (SELECT DISTINCT file, ordine, page, page_order, block_id FROM classificazione_blocchi WHERE review_status = 'pending_llm_review'), done AS (SELECT file, ordine, page, page_order, block_id, min(lower(trim(etichetta, ' '))) AS cached FROM classificazione_blocchi WHERE review_status = 'llm_reviewed' GROUP BY ALL)
SELECT l.file, l.block_id, d.cached FROM low l LEFT JOIN done d ON d.file IS NOT DISTINCT FROM l.file AND d.ordine IS NOT DISTINCT FROM l.ordine AND d.page IS NOT DISTINCT FROM l.page AND d.page_order IS NOT DISTINCT FROM l.page_order AND d.block_id IS NOT DISTINCT FROM l.block_id""")
def cached_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that wait for a review, with the label of an earlier one."""
    records = read_table(spark, sf_dir, "classificazione_blocchi")
    low = records.where("review_status = 'pending_llm_review'").select(*A.IDENTITY).distinct()
    return A.cached_verdicts(low, records.where("review_status = 'llm_reviewed'")).select("file", "block_id", "cached")


@query(f"""WITH {LABELLED}, att AS (SELECT file, list_sort(list(DISTINCT structural)) AS attested FROM labelled WHERE structural IS NOT NULL GROUP BY file), cov AS (SELECT file, list_sort(list(DISTINCT lower(trim(etichetta, ' ')))) AS covered FROM classificazione_blocchi WHERE review_status = 'llm_reviewed' AND etichetta IS NOT NULL GROUP BY file)
SELECT a.file, array_to_string(a.attested, ',') AS attested, array_to_string(list_sort(list_filter(a.attested, lambda x: NOT list_contains(coalesce(c.covered, []), x))), ',') AS missing FROM att a LEFT JOIN cov c ON c.file = a.file""")
def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a file's headings that no reviewed record covers."""
    attested = S.labelled(delivered_blocks(spark, sf_dir)).where("structural is not null").select("file", F.col("structural").alias("label"))
    covered = read_table(spark, sf_dir, "classificazione_blocchi").where("review_status = 'llm_reviewed' and etichetta is not null").select("file", F.lower(F.trim("etichetta")).alias("label"))
    return A.missing_labels(attested, covered).select("file", F.array_join("attested", ",").alias("attested"), F.array_join("missing", ",").alias("missing"))


@query(f"WITH RECURSIVE {DECIDED} SELECT file, block_id, own AS was, decision AS becomes, reason, CASE WHEN length(norm) > {A.PREVIEW} THEN left(norm, {A.PREVIEW}) || ' [...]' ELSE norm END AS preview FROM decided WHERE reason IS NOT NULL")
def tree_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the tree: every block that was left out or changed its label, and why."""
    return A.overrides(decisions(spark, sf_dir)).select("file", "block_id", "was", "becomes", "reason", "preview")


@query(f"WITH RECURSIVE {DECIDED}, r AS (SELECT *, row_number() OVER (PARTITION BY file, reason ORDER BY ordine, block_id) AS k FROM decided WHERE reason IS NOT NULL) SELECT file, reason, count(*) AS blocks, array_to_string(list(block_id ORDER BY ordine, block_id) FILTER (k <= {A.EXAMPLES}), ',') AS examples FROM r GROUP BY ALL")
def override_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each reason occurs in a file, with the first 25 blocks of each."""
    return A.override_report(A.overrides(decisions(spark, sf_dir))).withColumn("examples", F.array_join("examples", ","))


@query("SELECT lower(trim(etichetta, ' ')) AS label, count(*) AS records FROM classificazione_blocchi WHERE etichetta IS NOT NULL AND lower(trim(etichetta, ' ')) NOT IN (" + ", ".join(f"'{x}'" for x in [*P.LEVELS, *P.CONTENT_LABELS]) + ") GROUP BY ALL")
def unknown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of records outside the vocabulary, and how often they occur."""
    label = F.lower(F.trim("etichetta"))
    return read_table(spark, sf_dir, "classificazione_blocchi").where(F.col("etichetta").isNotNull() & ~label.isin(*P.LEVELS, *P.CONTENT_LABELS)).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("records"))


@query("SELECT file, bit_xor(('0x' || substr(md5(block_id || ':' || coalesce(testo, '')), 1, 15))::BIGINT) AS signature, count(*) AS blocks FROM (SELECT DISTINCT file, block_id, testo FROM ocr_blocks) GROUP BY file")
def input_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signature of the content of each file, whatever the order and number of its deliveries."""
    from lexstrata.operators.manifest import content_signatures

    return content_signatures(read_table(spark, sf_dir, "ocr_blocks"))


@query("""WITH told AS (SELECT file, block_id, lower(trim(etichetta, ' ')) AS label, review_id FROM classificazione_blocchi WHERE review_status = 'pending_llm_review' QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY ingested_at DESC NULLS LAST, classified_at DESC NULLS LAST, review_id DESC NULLS LAST, etichetta NULLS FIRST) = 1) SELECT label, count(*) AS waiting, count(review_id) AS numbered FROM told GROUP BY label""")
def waiting_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the records that wait for a review."""
    low = merge_unique(read_table(spark, sf_dir, "classificazione_blocchi").where("review_status = 'pending_llm_review'"), identity=("block_id",))
    return low.groupBy(F.lower(F.trim("etichetta")).alias("label")).agg(F.count(F.lit(1)).alias("waiting"), F.count("review_id").alias("numbered"))
