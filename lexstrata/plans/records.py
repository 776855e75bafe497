"""Queries over classified records, chunks, export and ingestion, each with its SQL where there is one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions import text as X
from lexstrata.functions.runtime import read_table, shared_dir
from lexstrata.operators import akn as AK
from lexstrata.operators import chunks as C
from lexstrata.operators import export as E
from lexstrata.operators import manifest as M
from lexstrata.operators import records as R
from lexstrata.operators import sampling
from lexstrata.operators import structure as S
from lexstrata.operators import tree as TR
from lexstrata.operators.order import positions
from lexstrata.plans.structure import BLOCKS, DECIDED, ORDERED, TREE, decisions, query
from lexstrata.sources.blocks import delivered_blocks


def _priority_sql(status: str, ranks: dict[str, int]) -> str:
    return f"CASE {status} " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in ranks.items()) + " ELSE 0 END"


MERGED = f"merged AS (SELECT * FROM classificazione_blocchi QUALIFY row_number() OVER (PARTITION BY file, ordine, page, page_order, block_id ORDER BY {_priority_sql('review_status', R.MERGE_PRIORITY)} DESC, ingested_at DESC NULLS LAST, classified_at DESC NULLS LAST, review_id DESC NULLS LAST, etichetta NULLS FIRST) = 1)"
SPLIT = f"{MERGED}, split AS (SELECT *, review_status IS NOT DISTINCT FROM 'deterministic' OR coalesce(label_confidence > {R.ACCEPT_ABOVE}, false) AS accepted FROM merged), batched AS (SELECT *, CASE WHEN NOT accepted THEN (row_number() OVER (PARTITION BY file, accepted ORDER BY page NULLS LAST, page_order NULLS LAST, ordine, block_id) - 1) // {R.REVIEW_BATCH} END AS batch FROM split)"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.merge_unique(read_table(spark, sf_dir, "classificazione_blocchi"))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.low_confidence(_merged(spark, sf_dir).withColumn("review_status", F.coalesce("review_status", F.lit(""))))


@query(f"WITH {MERGED} SELECT file, block_id, etichetta, review_status, label_confidence FROM merged")
def merge_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each block: the highest status, then the last to arrive."""
    return _merged(spark, sf_dir).select("file", "block_id", "etichetta", "review_status", "label_confidence")


def _statused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with their normal text and the status of their record."""
    status = _merged(spark, sf_dir).select("block_id", "review_status").dropDuplicates(["block_id"])
    return delivered_blocks(spark, sf_dir).withColumn("norm", F.lower(X.matching_text(F.col("testo")))).join(status, "block_id", "left")


@query(f"""WITH {BLOCKS}, {MERGED}, s AS (SELECT b.*, lower({X.matching_text_sql('testo')}) AS key, m.review_status FROM blocks b LEFT JOIN merged m USING (block_id))
SELECT file, block_id FROM s QUALIFY row_number() OVER (PARTITION BY file, page, page_order, lower(trim(coalesce(document_zone, ''), ' ')), lower(trim(coalesce(block_type, ''), ' ')), source_model, key ORDER BY {_priority_sql('review_status', R.DEDUPE_PRIORITY)} DESC, ordine DESC, block_id DESC) = 1""")
def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks without exact repetitions in the same place."""
    return R.dedupe_exact(_statused(spark, sf_dir), F.col("norm")).select("file", "block_id")


@query()
def dedupe_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks without those nearly equal to another of their page."""
    exact = R.dedupe_exact(_statused(spark, sf_dir), F.col("norm"))
    return R.dedupe_fuzzy(exact.select("file", "page", "page_order", "ordine", "block_id", "_key", "review_status")).select("file", "block_id")


@query("""WITH r AS (SELECT block_id, etichetta, ingested_at, classified_at, unnest(esempi_simili) AS e FROM classificazione_blocchi), k AS (SELECT DISTINCT block_id, etichetta, e.text AS text, e.score AS score FROM r)
SELECT block_id, etichetta, round(CASE WHEN count(CASE WHEN score > 0 THEN 1 END) = count(*) THEN exp(avg(CASE WHEN score > 0 THEN ln(score) END)) END, 6) AS confidence FROM k GROUP BY ALL""")
def label_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometric mean of the scores of a record's examples, as of the probabilities of a label's tokens."""
    examples = read_table(spark, sf_dir, "classificazione_blocchi").select("block_id", "etichetta", F.explode("esempi_simili").alias("e"))
    tokens = examples.select("block_id", "etichetta", "e.text", "e.score").distinct().withColumn("logprob", F.when(F.col("score") > 0, F.ln("score")))
    return R.label_confidence(tokens, ["block_id", "etichetta"]).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {SPLIT} SELECT file, block_id, accepted, batch::BIGINT AS batch FROM batched")
def low_confidence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records are accepted, and the review batch of the others."""
    return _split(spark, sf_dir).select("file", "block_id", "accepted", "batch")


@query(f"""WITH {SPLIT}, verdicts AS (SELECT review_id, min(lower(etichetta)) AS label FROM classificazione_blocchi WHERE review_status = 'llm_reviewed' AND review_id IS NOT NULL GROUP BY review_id)
SELECT b.file, b.block_id, coalesce(v.label, 'unresolved') AS label, CASE WHEN v.label IS NULL THEN 'llm_review_missing' ELSE 'llm_reviewed' END AS status FROM batched b LEFT JOIN verdicts v USING (review_id) WHERE NOT b.accepted""")
def review_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to review with the verdict of their review id."""
    verdicts = read_table(spark, sf_dir, "classificazione_blocchi").where("review_status = 'llm_reviewed' and review_id is not null").groupBy("review_id").agg(F.min(F.lower("etichetta")).alias("label"))
    return R.reviewed(_split(spark, sf_dir).where("not accepted"), verdicts).select("file", "block_id", "label", "status")


def _incipit_sql() -> str:
    joined = "(coalesce(title, '') || ' ' || coalesce(text, ''))"
    return f"left({X.matching_text_sql(joined)}, {E.INCIPIT})"


def _rules_sql(k: int) -> str:
    """Subtype (0), country (1) or number (2) of the first rule that matches."""

    def one(p: P.Profile) -> str:
        value = {0: lambda r: f"'{r[0]}'", 1: lambda r: f"'{r[1]}'", 2: lambda r: f"nullif(trim(regexp_extract(incipit, {X.lit_sql('(?i)' + r[2])}, 1), ' '), '')"}[k]
        return "CASE " + " ".join(f"WHEN regexp_matches(incipit, {X.lit_sql('(?i)' + r[2])}) THEN {value(r)}" for r in p.act_types) + " END"

    return P.by_profile_sql("profile", one)


ACTS = f"incipits AS (SELECT *, CASE WHEN lang = 'en' THEN 'en' ELSE 'it' END AS profile, {_incipit_sql()} AS incipit FROM documents), acts AS (SELECT *, {_rules_sql(0)} AS subtype, {_rules_sql(1)} AS country, {_rules_sql(2)} AS number FROM incipits)"


def _acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").drop("subtype")
    joined = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))
    rows = docs.withColumn("incipit", F.left(X.matching_text(joined), F.lit(E.INCIPIT))).withColumn("profile", F.when(F.col("lang") == "en", "en").otherwise("it"))
    return rows.withColumn("act", X.bind(F.col("incipit"), lambda t: E.act_type(t, F.col("profile")))).select("*", "act.subtype", "act.country", "act.number")


@query(f"WITH {ACTS.replace('SELECT *, CASE WHEN lang', 'SELECT * EXCLUDE (subtype), CASE WHEN lang')} SELECT doc_id, subtype, country, number FROM acts")
def act_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, country and number of each act by the rules of its language."""
    return _acts(spark, sf_dir).select("doc_id", "subtype", "country", "number")


_CODES_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in E.LANGUAGE3.items()) + " ELSE 'und' END"


@query(f"""WITH {ACTS.replace('SELECT *, CASE WHEN lang', 'SELECT * EXCLUDE (subtype), CASE WHEN lang')}, works AS (SELECT doc_id, lang, '/akn/' || coalesce(country, 'it') || '/act/' || coalesce(strftime(published_at, '%Y-%m-%d'), '{E.PLACEHOLDER_DATE}') || '/' || coalesce(nullif({X.uri_token_sql('coalesce(number, act_number)')}, 'documento'), {X.uri_token_sql("'doc ' || doc_id")}) AS work FROM acts)
SELECT doc_id, work, work || '/' || {_CODES_SQL} || '@' AS expression, work || '/' || {_CODES_SQL} || '@.xml' AS manifestation FROM works""")
def frbr_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URIs of work, expression and manifestation of each document."""
    rows = _acts(spark, sf_dir)
    work = E.work_uri(F.col("country"), F.lit("act"), F.date_format("published_at", "yyyy-MM-dd"), F.coalesce("number", "act_number"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    expression = F.concat(F.lit("/"), E.language3(F.col("lang")), F.lit("@"))
    return rows.select("doc_id", work.alias("work"), F.concat(work, expression).alias("expression"), F.concat(work, expression, F.lit(".xml")).alias("manifestation"))


def _eids_sql() -> str:
    prefix = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in E.PREFIX.items()) + " ELSE 'hcontainer' END"
    out = [f"{TREE}, locals AS (SELECT *, {prefix} || '_' || coalesce(nullif({X.eid_token_sql('number')}, ''), (row_number() OVER (PARTITION BY file, parent_seq ORDER BY seq))::VARCHAR) AS local FROM nodes)"]
    for k in range(1, 6):
        source = "SELECT *, local AS base FROM locals WHERE parent_seq IS NULL" if k == 1 else f"SELECT l.*, p.eid || '__' || l.local AS base FROM locals l JOIN e{k - 1} p ON p.file = l.file AND p.seq = l.parent_seq"
        out.append(f"e{k} AS (SELECT file, block_id, seq, label, CASE WHEN row_number() OVER b > 1 THEN base || '_' || row_number() OVER b ELSE base END AS eid FROM ({source}) WINDOW b AS (PARTITION BY file, base ORDER BY seq))")
    return ", ".join(out) + ", eids AS (" + " UNION ALL ".join(f"SELECT * FROM e{k}" for k in range(1, 6)) + ")"


def _eids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.element_ids(TR.tree(decisions(spark, sf_dir))[0])


@query(f"WITH RECURSIVE {_eids_sql()} SELECT file, block_id, seq, label, eid FROM eids")
def eids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element id of each structural block."""
    return _eids(spark, sf_dir).select("file", "block_id", "seq", "label", "eid")


@query(f"WITH RECURSIVE {_eids_sql()}, per AS (SELECT file, eid, count(*) AS n FROM eids GROUP BY ALL) SELECT file, sum(n)::BIGINT AS elements, count(eid) AS eids, count(*) FILTER (n > 1) AS repeated, count(*) FILTER (n > 1) = 0 AS valid FROM per GROUP BY file")
def akn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements and repeated ids of each file."""
    return E.check_ids(_eids(spark, sf_dir))


@query()
def akn_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legislative XML of each file."""
    nodes, contents = TR.tree(decisions(spark, sf_dir))
    columns = ("file", "profile", "seq", "label", "level", "number", "rubric", "norm", "parent_seq", "owner_seq")
    every = nodes.withColumn("owner_seq", F.lit(None).cast("bigint")).select(*columns).unionByName(contents.withColumns({"level": F.lit(None).cast("int"), "parent_seq": F.lit(None).cast("bigint")}).select(*columns))
    uri = E.work_uri(F.lit(None).cast("string"), F.lit("act"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("file"))
    return AK.documents(every.withColumns({"uri": uri, "language": E.language3(F.when(F.col("profile") == "en", "en").otherwise("it"))}))


@query()
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval chunks of the contents of each node."""
    confidence = _merged(spark, sf_dir).groupBy("block_id").agg(F.max("label_confidence").alias("label_confidence"))
    owned = TR.tree(decisions(spark, sf_dir))[1].join(confidence, "block_id", "left")
    return C.chunks(owned.select("file", "owner_seq", "seq", "label", "testo", "label_confidence"))


@query()
def recital_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recital numbers of each file, and those that continue their sequence."""
    rows = S.prepared(delivered_blocks(spark, sf_dir)).where("structural = 'recital' and try_cast(number as bigint) is not null")
    numbers = rows.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("seq", F.col("number").cast("bigint").alias("n")))).alias("x")).select("file", F.col("x.n").alias("numbers"))
    return numbers.select("file", "numbers", C.accepted_recitals(F.col("numbers")).alias("accepted"))


@query(f"WITH RECURSIVE {DECIDED} SELECT p.file, t.block_id AS rubric_id, a.block_id AS article_id, a.number AS article_number FROM pairs p JOIN ordered t ON t.file = p.file AND t.seq = p.rubric_seq JOIN ordered a ON a.file = p.file AND a.seq = p.article_seq")
def rubric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles before an article without a rubric, in profiles that put them there."""
    rows = S.prepared(delivered_blocks(spark, sf_dir))
    ids = rows.select("file", "seq", "block_id", "number")
    pairs = TR.rubric_pairs(rows).join(ids.select("file", F.col("seq").alias("rubric_seq"), F.col("block_id").alias("rubric_id")), ["file", "rubric_seq"])
    return pairs.join(ids.select("file", F.col("seq").alias("article_seq"), F.col("block_id").alias("article_id"), F.col("number").alias("article_number")), ["file", "article_seq"]).select("file", "rubric_id", "article_id", "article_number")


@query(f"WITH RECURSIVE {TREE} SELECT c.file, a.block_id AS article_id, c.block_id AS rubric_id FROM hung c JOIN hung a ON a.file = c.file AND a.seq = c.absorbed")
def rubric_absorbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short contents right after an article without a rubric: they are its rubric."""
    rows = TR.kept(decisions(spark, sf_dir))
    articles = rows.select("file", F.col("seq").alias("absorbed"), F.col("block_id").alias("article_id"))
    return rows.where("absorbed is not null").select("file", "absorbed", F.col("block_id").alias("rubric_id")).join(articles, ["file", "absorbed"]).select("file", "article_id", "rubric_id")


HEAD, SPREAD, PAGES = 40, 60, 5


@query(f"""WITH {ORDERED}, n AS (SELECT *, count(*) OVER (PARTITION BY file) - {HEAD} AS rest FROM ordered) SELECT file, block_id, seq FROM n WHERE seq < {HEAD} OR ((seq - {HEAD}) % greatest(1, rest // {SPREAD}) = 0 AND (seq - {HEAD}) // greatest(1, rest // {SPREAD}) < {SPREAD})""")
def language_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first blocks of each file and an even spread over the rest."""
    rows = positions(delivered_blocks(spark, sf_dir))
    rest = rows.groupBy("file").agg((F.count(F.lit(1)) - HEAD).alias("rest"))
    step = F.greatest(F.lit(1), F.floor(F.col("rest") / SPREAD))
    after = F.col("seq") - HEAD
    return rows.join(rest, "file").where((after < 0) | ((F.pmod(after, step) == 0) & (F.floor(after / step) < SPREAD))).select("file", "block_id", "seq")


@query(f"""WITH {BLOCKS}, p AS (SELECT file, page, row_number() OVER (PARTITION BY file ORDER BY page) - 1 AS i, count(*) OVER (PARTITION BY file) AS n FROM (SELECT DISTINCT file, page FROM blocks WHERE page IS NOT NULL)),
k AS (SELECT unnest([0, 1, 2, 3, 4]) AS k) SELECT DISTINCT file, page FROM p, k WHERE n <= {PAGES} OR i = round_even(k.k * (n - 1) / {PAGES - 1}.0, 0)""")
def page_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five evenly spaced pages of each file."""
    pages = delivered_blocks(spark, sf_dir).where("page is not null").select("file", "page").distinct()
    w = Window.partitionBy("file")
    rows = pages.withColumn("i", F.row_number().over(w.orderBy("page")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    picked = F.exists(F.array(*(F.bround(F.lit(k) * (F.col("n") - 1) / (PAGES - 1), 0) for k in range(PAGES))), lambda x: x == F.col("i"))
    return rows.where((F.col("n") <= PAGES) | picked).select("file", "page")


@query()
def language_sample_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that the language of each file is judged by: language_sample with short lines, distinct, within its budget."""
    return sampling.language_text(delivered_blocks(spark, sf_dir))


@query()
def page_sample_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages and text that the structure of each file is judged by: page_sample with the first page of each label, within its budget."""
    return sampling.page_text(S.prepared(delivered_blocks(spark, sf_dir)))


def _markers(p: P.Profile) -> str:
    return f"{P.FLAGS}(?={p.markers})"


@query()
def split_structural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of several levels in one block, one row each with its label."""
    rows = S.labelled(delivered_blocks(spark, sf_dir)).where(F.col("structural").isin(*S.CONTAINERS))
    parts = P.by_profile(F.col("profile"), lambda p: F.filter(F.split("norm", _markers(p)), lambda x: F.trim(x) != ""))
    pieces = rows.select("block_id", "profile", F.posexplode(parts).alias("split_index", "text")).withColumn("text", F.trim("text"))
    return pieces.withColumn("label", X.bind(F.col("text"), lambda t: P.structural_label(t, F.col("profile")))).select("block_id", "split_index", "text", "label")


@query()
def repair_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees as JSON with wrong backslashes repaired, and whether they parse."""
    return E.repaired_json(read_table(spark, sf_dir, "struttura_ad_albero").select("record_id", "albero"), "albero").select("record_id", "parses", F.length("repaired").alias("chars"))


_STEPS_SQL = "[" + ", ".join(f"'{s}'" for s in M.STEPS) + "]"


@query(f"""WITH sigs AS (SELECT file, bit_xor(('0x' || substr(md5(block_id || ':' || coalesce(testo, '')), 1, 15))::BIGINT) AS signature FROM (SELECT DISTINCT file, block_id, testo FROM ocr_blocks) GROUP BY file), inputs AS (SELECT s.file, s.signature, coalesce(l.code, '') AS profile FROM sigs s LEFT JOIN language_config l ON l.file = s.file), states AS (SELECT file, count(*) FILTER (review_status = 'pending_llm_review') AS waiting FROM classificazione_blocchi GROUP BY file),
done AS (SELECT file, 'language' AS step FROM inputs WHERE profile <> '' UNION ALL SELECT i.file, unnest(['analysis', 'classification']) FROM inputs i JOIN states USING (file) UNION ALL SELECT i.file, 'review' FROM inputs i JOIN states USING (file) WHERE waiting = 0 UNION ALL SELECT file, 'tree' FROM inputs WHERE file IN (SELECT file FROM struttura_ad_albero)),
steps AS (SELECT *, unnest(generate_series(0, 4)) AS n FROM inputs), named AS (SELECT *, {_STEPS_SQL}[n + 1] AS step FROM steps), f AS (SELECT s.file, s.step, s.n, d.file IS NOT NULL AS finished FROM named s LEFT JOIN (SELECT DISTINCT * FROM done) d ON d.file = s.file AND d.step = s.step),
m AS (SELECT *, min(CASE WHEN NOT finished AND step <> 'language' THEN n END) OVER (PARTITION BY file) AS first FROM f)
SELECT file, step FROM m WHERE NOT finished OR (step <> 'language' AND n >= coalesce(first, 99))""")
def pending_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps that each file still needs, by what the tables at hand prove as done."""
    labels = read_table(spark, sf_dir, "language_config").select("file", "code")
    inputs = M.content_signatures(read_table(spark, sf_dir, "ocr_blocks")).join(labels, "file", "left").select("file", F.col("signature").cast("string").alias("signature"), F.coalesce("code", F.lit("")).alias("profile"))
    done = M.finished_steps(inputs, read_table(spark, sf_dir, "classificazione_blocchi"), read_table(spark, sf_dir, "struttura_ad_albero"))
    return M.pending_steps(inputs, done)


@query()
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that arrive as JSON files, labelled by a stream; here the test items as one document each."""
    from lexstrata.streaming.ingest import label_stream, watch_documents

    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    items = read_table(spark, sf_dir, "benchmark").select(F.to_json(F.struct(F.array(F.struct("text")).alias("blocks"))).alias("value"))
    items.repartition(8).write.text(f"{base}/in")
    label_stream(watch_documents(spark, f"{base}/in"), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("ordine", "testo", "label")

