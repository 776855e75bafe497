"""What is known about blocks before and after a model sees them: context, metadata, samples, markers, verdicts and coverage."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions.text import truncated

#: What identifies the block of a record (fixed values).
IDENTITY = ("file", "ordine", "page", "page_order", "block_id")
#: Fields of a block that a model is told, in the order of their names (fixed values).
TOLD = ("block_type", "block_type_canonical", "document_zone", "ocr_score", "page", "page_order", "recovered_extra_candidate", "selected_from", "source_model", "source_order")
PREVIEW, EXAMPLES = 180, 25
#: Confidence of a label that the rules are sure of, and of an example that is taken from the text (fixed values).
SURE, FROM_TEXT = 0.97, 0.75


def with_neighbours(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` (file, seq) with previous_X and next_X of each of ``columns``; empty at the ends of a file.

    Neighbours are joined by position, so a file isn't sorted in one task.
    """
    beside = rows.select("file", "seq", *(c.alias(f"_n_{n}") for n, c in columns.items()))
    out = rows
    for step, name in ((1, "previous"), (-1, "next")):
        moved = beside.select("file", (F.col("seq") + step).alias("seq"), *(F.col(f"_n_{n}").alias(f"{name}_{n}") for n in columns))
        out = out.join(moved, ["file", "seq"], "left")
    return out.fillna("", [f"{side}_{n}" for n in columns for side in ("previous", "next")])


def source_metadata() -> Column:
    """Where a block comes from, as one struct."""
    return F.struct(*TOLD, "bbox", "bbox_inherited", "page_agreement_score")


def told_metadata() -> Column:
    """What a model is told of a block: JSON with the members in the order of their names, unknown ones as null."""
    return F.to_json(F.struct(*TOLD), {"ignoreNullFields": "false"})


def marked_label(text: Column, profile: Column) -> Column:
    """paragraph, point or content, by the marker at the start of a text."""

    def one(p: P.Profile) -> Column:
        return F.when(P.matches(text, p.paragraph), "paragraph").when(P.matches(text, p.point), "point").otherwise("content")

    return P.by_profile(profile, one)


def sample_label(text: Column, profile: Column) -> Column:
    """The label of a line as it is written (not in its normal form): heading, marker, page number (noise) or content."""
    plain = F.trim(text)
    page = P.by_profile(profile, lambda p: P.matches(plain, p.page_number))
    return F.coalesce(P.structural_label(plain, profile), F.when(page, "noise"), marked_label(F.concat(plain, F.lit(" ")), profile))


def content_parts(text: Column, profile: Column) -> tuple[Column, Column, Column]:
    """(kind, marker as printed, text behind it) of a content."""
    label = marked_label(text, profile)
    marker = P.by_profile(profile, lambda p: F.when(label == "paragraph", F.regexp_extract(text, P.FLAGS + p.paragraph, 0)).when(label == "point", F.regexp_extract(text, P.FLAGS + p.point, 0)).otherwise(F.lit("")))
    return label, F.trim(marker), F.substring(text, F.length(marker) + 1, F.length(text))


def cached_verdicts(low: DataFrame, reviewed: DataFrame) -> DataFrame:
    """``low`` with cached: the label that an earlier review of the same block gave; null where there is none.

    Null fields of the identity are equal to each other.
    """
    known = reviewed.groupBy(*(F.col(c).alias(f"_r_{c}") for c in IDENTITY)).agg(F.min(F.lower(F.trim("etichetta"))).alias("cached"))
    return low.join(known, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in IDENTITY], "left").drop(*(f"_r_{c}" for c in IDENTITY))


def missing_labels(attested: DataFrame, covered: DataFrame) -> DataFrame:
    """file, attested, covered and missing (sorted sets of labels): labels that a file's text has but no example covers."""
    sides = [df.groupBy("file").agg(F.array_sort(F.collect_set("label")).alias(name)) for df, name in ((attested, "attested"), (covered, "covered"))]
    rows = sides[0].join(sides[1], "file", "left").withColumn("covered", F.coalesce("covered", F.array().cast("array<string>")))
    return rows.withColumn("missing", F.array_sort(F.array_except("attested", "covered")))


def overrides(decisions: DataFrame) -> DataFrame:
    """One row for each block whose label was changed or that was left out: file, ordine, page, was, becomes, reason and a preview."""
    return decisions.where("reason is not null").select("file", "block_id", "ordine", "page", F.col("own").alias("was"), F.col("decision").alias("becomes"), "reason", truncated(F.col("norm"), PREVIEW).alias("preview"))


def override_report(changes: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """file, reason, how often, and the first ``examples`` blocks of each, in reading order.

    Only as many examples as are reported are ever held together: each part of a group keeps its own first ones.
    """
    salted = changes.withColumn("_salt", F.pmod(F.xxhash64("block_id"), F.lit(32)))
    part = salted.groupBy("file", "reason", "_salt").agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("ordine", "block_id"))), 1, examples).alias("first"))
    whole = part.groupBy("file", "reason").agg(F.sum("n").alias("blocks"), F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, examples).alias("first"))
    return whole.select("file", "reason", "blocks", F.col("first.block_id").alias("examples"))


def first_json(raw: str | None) -> tuple[object, str]:
    """The first JSON object of an answer, with or without a code fence around it, and what follows it; (None, answer) without one."""
    text = (raw or "").strip()
    if text.startswith("```"):
        text = text.split("\n", 1)[1] if "\n" in text else ""
        text = text.rsplit("```", 1)[0]
    start = text.find("{")
    while start >= 0:
        try:
            value, end = json.JSONDecoder().raw_decode(text, start)
            return value, text[end:].strip()
        except ValueError:
            start = text.find("{", start + 1)
    return None, text


def verdicts_of(raw: str | None, wanted: set[int], allowed: set[str]) -> dict[int, str]:
    """Labels by review id in an answer {"verdicts": [{"id": n, "label": x}]}: known ids and allowed labels only."""
    value, _ = first_json(raw)
    out = {}
    for entry in value.get("verdicts", []) if isinstance(value, dict) else []:
        if isinstance(entry, dict) and str(entry.get("id", "")).lstrip("-").isdigit() and int(entry["id"]) in wanted and str(entry.get("label", "")).strip().lower() in allowed:
            out[int(entry["id"])] = str(entry["label"]).strip().lower()
    return out


def ask_again(ids: list[int], ask: Callable[[list[int]], dict[int, str]], rounds: int = 2) -> dict[int, str]:
    """Verdicts of a batch: missing ones are asked for again together, then one by one; a batch that fails is halved."""
    try:
        found = ask(ids)
    except ValueError:
        if len(ids) < 2:
            return {}
        half = len(ids) // 2
        return ask_again(ids[:half], ask, rounds) | ask_again(ids[half:], ask, rounds)
    for left in range(rounds, -1, -1):
        missing = [i for i in ids if i not in found]
        if not missing or len(missing) == len(ids) == 1:
            break
        for part in [missing] if left else [[i] for i in missing]:
            try:
                found |= ask(part)
            except ValueError:
                continue
    return found


def reviewed_batches(low: DataFrame, model: Callable[[list[tuple[int, str]]], str], allowed: tuple[str, ...] = (*P.LEVELS, *P.CONTENT_LABELS)) -> DataFrame:
    """(review_id, label) of the rows (file, batch, review_id, norm) of each batch, from a model that answers a list of (id, text) with JSON.

    Ids without a verdict have no row. A batch is the unit of a request and has a bounded size.
    """

    def review(group: pd.DataFrame) -> pd.DataFrame:
        texts = dict(zip(group["review_id"].tolist(), group["norm"].tolist()))
        found = ask_again(list(texts), lambda ids: verdicts_of(model([(i, texts[i]) for i in ids]), set(ids), set(allowed)))
        return pd.DataFrame({"review_id": list(found), "label": list(found.values())}, columns=["review_id", "label"])

    return low.groupBy("file", "batch").applyInPandas(review, "review_id bigint, label string")


def detected_language(sample: DataFrame, model: Callable[[str], str] | None = None) -> DataFrame:
    """file, code, hint_code, hint_score and agrees of (file, text, hint_code, hint_score): the model's answer, else the hint.

    ``agrees`` is false where the model contradicts a hint of at least 0.05.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            hints = [h if isinstance(h, str) else None for h in part["hint_code"]]
            codes = [model(t or "") if model else h for t, h in zip(part["text"], hints)]
            agrees = [not (h and c != h and s >= 0.05) for c, h, s in zip(codes, hints, part["hint_score"])]
            yield pd.DataFrame({"file": part["file"], "code": codes, "hint_code": hints, "hint_score": part["hint_score"], "agrees": agrees})

    return sample.select("file", "text", "hint_code", "hint_score").mapInPandas(run, "file string, code string, hint_code string, hint_score double, agrees boolean")


