"""Classified records: merging, duplicates, confidence and review."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Which of two records of one block stays (fixed values); everything else is 0.
MERGE_PRIORITY = {"llm_reviewed": 5, "accepted_slm": 4, "llm_json_error": 3, "llm_review_missing": 2, "pending_llm_review": 1}
DEDUPE_PRIORITY = {"llm_reviewed": 6, "accepted_slm": 4, "deterministic": 3}
ACCEPT_ABOVE, FUZZY = 0.90, 0.97
REVIEW_BATCH = 8


def priority(status: Column, ranks: dict[str, int]) -> Column:
    return F.coalesce(*(F.when(status == s, n) for s, n in ranks.items()), F.lit(0))


def merge_unique(records: DataFrame, identity: tuple[str, ...] = ("file", "ordine", "page", "page_order", "block_id"), arrival: tuple[str, ...] = ("ingested_at", "classified_at")) -> DataFrame:
    """One record for each identity: the highest status, among equals the last to arrive."""
    order = [F.desc("_p"), *(F.col(a).desc_nulls_last() for a in arrival), F.col("review_id").desc_nulls_last(), "etichetta"]
    ranked = records.withColumn("_p", priority(F.col("review_status"), MERGE_PRIORITY)).withColumn("_n", F.row_number().over(Window.partitionBy(*identity).orderBy(*order)))
    return ranked.where("_n = 1").drop("_p", "_n")


def dedupe_exact(rows: DataFrame, key: Column) -> DataFrame:
    """One row for each file, page, page_order, zone, type, model and text key; the higher status, then the later row stays."""
    zone, kind = F.lower(F.trim(F.coalesce("document_zone", F.lit("")))), F.lower(F.trim(F.coalesce("block_type", F.lit(""))))
    keyed = rows.withColumns({"_zone": zone, "_type": kind, "_key": key, "_p": priority(F.col("review_status"), DEDUPE_PRIORITY)})
    same = Window.partitionBy("file", "page", "page_order", "_zone", "_type", "source_model", "_key").orderBy(F.desc("_p"), F.desc("ordine"), F.desc("block_id"))
    return keyed.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_zone", "_type", "_p", "_n")


def dedupe_fuzzy(rows: DataFrame, threshold: float = FUZZY) -> DataFrame:
    """``rows`` (file, page, ordine, block_id, _key, review_status) without those nearly equal to an earlier one of their page.

    Within a page the rows are walked in order; a row that is like one kept before takes its place if its status is not
    lower. A page bounds the group. Empty keys are like nothing.
    """
    ranks = DEDUPE_PRIORITY

    def walk(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values(["page_order", "ordine", "block_id"], na_position="last")
        kept: list[int] = []
        keys, status = page["_key"].tolist(), page["review_status"].tolist()
        for i, text in enumerate(keys):
            twin = None
            for at in range(len(kept) - 1, -1, -1):
                other = keys[kept[at]]
                if not text or not other or 2 * min(len(text), len(other)) < threshold * (len(text) + len(other)):
                    continue  # even if the shorter one were part of the longer one, the ratio could not be reached
                if SequenceMatcher(None, text, other).ratio() >= threshold:
                    twin = at
                    break
            if twin is None:
                kept.append(i)
            elif ranks.get(status[i], 0) >= ranks.get(status[kept[twin]], 0):
                kept[twin] = i
        return page.iloc[kept]

    return rows.groupBy("file", "page").applyInPandas(walk, rows.schema)


def label_confidence(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, confidence: geometric mean of the probabilities of a label's tokens (keys, logprob).

    Null where a token has no probability.
    """
    known = F.count("logprob") == F.count(F.lit(1))
    return tokens.groupBy(*keys).agg(F.when(known, F.exp(F.avg("logprob"))).alias("confidence"))


def label_tokens(responses: DataFrame, keys: list[str], label: str, tokens: str) -> DataFrame:
    """The tokens of the answer (array of token, logprob) that overlap the last occurrence of the label, one row each."""
    parts = F.transform(tokens, lambda t: t["token"])
    text = F.array_join(parts, "")
    start = F.length(text) - F.instr(F.reverse(F.lower(text)), F.reverse(F.lower(F.col(label)))) - F.length(label) + 1
    ends = F.transform(F.sequence(F.lit(1), F.size(tokens)), lambda i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda a, t: a + F.length(t)))
    rows = responses.where(F.instr(F.lower(text), F.lower(F.col(label))) > 0).select(*keys, F.length(label).alias("_len"), start.alias("_start"), F.explode(F.arrays_zip(F.col(tokens).alias("t"), ends.alias("e"))).alias("x"))
    first, end = F.col("x.e") - F.length("x.t.token"), F.col("x.e")
    return rows.where((end > F.col("_start")) & (first < F.col("_start") + F.col("_len"))).select(*keys, F.col("x.t.logprob").alias("logprob"))


def low_confidence(records: DataFrame, threshold: float = ACCEPT_ABOVE) -> DataFrame:
    """``records`` with accepted (deterministic, or confidence above the threshold) and the batch for review.

    Unknown confidence is never accepted. Batches number the rows to review within each file, in reading order.
    """
    accepted = (F.col("review_status") == "deterministic") | F.coalesce(F.col("label_confidence") > threshold, F.lit(False))
    rows = records.withColumn("accepted", accepted)
    within = Window.partitionBy("file", "accepted").orderBy(F.col("page").asc_nulls_last(), F.col("page_order").asc_nulls_last(), "ordine", "block_id")
    batch = F.floor((F.row_number().over(within) - 1) / REVIEW_BATCH).cast("long")
    return rows.withColumn("batch", F.when(~F.col("accepted"), batch))


def reviewed(low: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows to review with the verdict of their review_id: label and status after the review; none is unresolved."""
    joined = low.join(verdicts.select("review_id", F.col("label").alias("_label")), "review_id", "left")
    return joined.withColumn("label", F.coalesce("_label", F.lit("unresolved"))).withColumn("status", F.when(F.col("_label").isNotNull(), "llm_reviewed").otherwise("llm_review_missing")).drop("_label")


def classified(blocks: DataFrame, classifier, batch: int = 64) -> DataFrame:
    """Labels of a model for the blocks that the rules leave open (block_id, norm).

    ``classifier`` takes a list of texts and returns (label, confidence) for each; it is called once for each batch in the
    tasks. A text that it fails on is unresolved and has no confidence.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for at in range(0, len(part), batch):
                texts = part["norm"].iloc[at : at + batch].tolist()
                try:
                    out += classifier(texts)
                except Exception:
                    out += [("unresolved", None)] * len(texts)
            yield pd.DataFrame({"block_id": part["block_id"], "label": [x[0] for x in out], "confidence": pd.array([x[1] for x in out], dtype="Float64")})

    return blocks.select("block_id", "norm").mapInPandas(run, "block_id bigint, label string, confidence double")
