"""Identity, element ids, legislative XML and its checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.functions import profiles as P
from lexstrata.functions.runtime import written
from lexstrata.functions.text import eid_token, uri_token

#: Prefixes of element ids (fixed values).
PREFIX = {"part": "part", "title": "title", "chapter": "chp", "section": "sec", "article": "art", "paragraph": "para", "point": "point", "recital": "rec", "annex": "att"}
NAMESPACE = "http://docs.oasis-open.org/legaldocml/ns/akn/3.0"
PLACEHOLDER_DATE = "1970-01-01"
#: ISO 639-2 codes of languages (fixed values).
LANGUAGE3 = {"it": "ita", "en": "eng", "fr": "fra", "de": "deu", "es": "spa", "pt": "por", "nl": "nld", "la": "lat"}
INCIPIT = 1200


def act_type(incipit: Column, profile: Column) -> Column:
    """Struct of subtype, country, number and author of the first rule of the profile that the incipit meets; null for none."""

    def one(p: P.Profile) -> Column:
        if not p.act_types:
            return F.lit(None).cast("struct<subtype:string,country:string,number:string,author:string>")
        rules = [F.when(P.matches(incipit, pattern), F.struct(F.lit(name).alias("subtype"), F.lit(country).alias("country"), F.nullif(F.trim(F.regexp_extract(incipit, P.FLAGS + pattern, 1)), F.lit("")).alias("number"), F.nullif(F.lit(author), F.lit("")).alias("author"))) for name, country, pattern, author in p.act_types]
        return F.coalesce(*rules)

    return P.by_profile(profile, one)


def work_uri(country: Column, doctype: Column, date: Column, number: Column, document: Column) -> Column:
    """URI of the work: country, type, date (a placeholder where unknown) and number, or the document where there is none."""
    return F.concat(F.lit("/akn/"), F.coalesce(country, F.lit("it")), F.lit("/"), F.coalesce(doctype, F.lit("act")), F.lit("/"), F.coalesce(date, F.lit(PLACEHOLDER_DATE)), F.lit("/"), F.coalesce(F.nullif(uri_token(number), F.lit("documento")), uri_token(document)))


def language3(code: Column) -> Column:
    return F.coalesce(*(F.when(code == k, v) for k, v in LANGUAGE3.items()), F.lit("und"))


def element_ids(nodes: DataFrame, depth: int = 5) -> DataFrame:
    """Structural rows with eid: prefix and number (or place among siblings), below the parent's id; repeats get _2, _3.

    One pass for each depth, as an id needs its parent's.
    """
    prefix = F.coalesce(*(F.when(F.col("label") == k, v) for k, v in PREFIX.items()), F.lit("hcontainer"))
    siblings = Window.partitionBy("file", "parent_seq").orderBy("seq")
    token = F.coalesce(F.nullif(eid_token(F.col("number")), F.lit("")), F.row_number().over(siblings).cast("string"))
    local = written(nodes.withColumn("_local", F.concat(prefix, F.lit("_"), token)), "local")  # read once for each depth
    done, waiting = None, local.withColumn("_parent_eid", F.lit(None).cast("string")).where("parent_seq is null")
    for _ in range(depth):
        base = F.when(F.col("_parent_eid").isNull(), F.col("_local")).otherwise(F.concat("_parent_eid", F.lit("__"), "_local"))
        n = F.row_number().over(Window.partitionBy("file", "_base").orderBy("seq"))
        level = waiting.withColumn("_base", base).withColumn("_nth", n).withColumn("eid", F.when(F.col("_nth") > 1, F.concat("_base", F.lit("_"), F.col("_nth").cast("string"))).otherwise(F.col("_base"))).drop("_base", "_nth", "_parent_eid")
        done = level if done is None else done.unionByName(level)
        up = level.select(F.col("file").alias("_f"), F.col("seq").alias("_s"), F.col("eid").alias("_parent_eid"))
        waiting = local.join(up, (F.col("file") == F.col("_f")) & (F.col("parent_seq") == F.col("_s"))).drop("_f", "_s")
    return done.drop("_local")


def check_ids(elements: DataFrame) -> DataFrame:
    """Elements, ids and repeated ids of each file, and whether it is valid: no repeated id."""
    per = elements.groupBy("file", "eid").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("file").agg(F.sum("n").alias("elements"), F.count("eid").alias("eids"), F.count_if(F.col("n") > 1).alias("repeated")).withColumn("valid", F.col("repeated") == 0)


def repaired_json(texts: DataFrame, text_col: str) -> DataFrame:
    """``texts`` with repaired (JSON whose backslashes are escaped where they don't start an escape) and parses.

    A text that is JSON already is left as it is, byte for byte; null stays null.
    """
    import json

    def fix(text: str | None) -> tuple[str | None, bool]:
        if text is None:
            return None, False
        try:
            json.loads(text, strict=False)
            return text, True
        except ValueError:
            pass
        out, i, inside = [], 0, False
        while i < len(text):
            c = text[i]
            if c != "\\" or not inside:
                inside ^= c == '"'
                out.append(c)
                i += 1
                continue
            run = i
            while run < len(text) and text[run] == "\\":
                run += 1
            after, n = text[run : run + 1], run - i
            whole = after in '"/' and after != "" or (after == "u" and all(h in "0123456789abcdefABCDEF" for h in text[run + 1 : run + 5]) and len(text) >= run + 5)
            lonely = after in "bfnrt" and not text[run + 1 : run + 2].isalpha()
            out.append("\\" * (n if n % 2 == 0 or whole or lonely else n + 1))
            if n % 2 and after == '"':
                out.append(after)
                run += 1
            i = run
        new = "".join(out)
        try:
            json.loads(new, strict=False)
            return new, True
        except ValueError:
            return new, False

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [fix(t if isinstance(t, str) else None) for t in part[text_col]]
            part["repaired"], part["parses"] = [f[0] for f in found], [f[1] for f in found]
            yield part

    schema = T.StructType([*texts.schema.fields, T.StructField("repaired", T.StringType()), T.StructField("parses", T.BooleanType())])
    return texts.mapInPandas(run, schema)
