"""One form for look-alikes; visible differences stay."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexstrata.llm.lookalike import Transducer, canonical, look_links, same_look_pairs, single_rules, transducer

APPLY = transducer().apply


@pytest.mark.parametrize("text,expected", [
    ("ｄｅｌｌ＇ｉｓｔａｎｚａ．", "dell'istanza."), ("perché", "perché"), ("con‍cessione", "concessione"), ("a b c d", "a b c d"), ("аеорс", "aeopc"), ("Ζ4Η", "Z4H"), ("Τ", "T"), ("e​́", "é"), ("ậ", "ậ"), ("ё", "ë"), ("", ""), ("plain", "plain"),
    ("a\ufe0f", "a"), ("a\U000e0100b", "ab"), ("\u3164x", "x"), ("x\U000e0041", "x"), ("a\u2011b", "a\u2010b"), ("\uff76\uff9e", "\u30ac"), ("\u0251\u0261", "ag"), ("\u03b1", "a"), ("\u2163", "IV"), ("\u0475", "v"), ("\ua4d0\ua4f2", "BI"), ("\u2c9f", "o"),
])
def test_forms(text, expected):
    assert APPLY(text) == expected and APPLY(expected) == expected


@pytest.mark.parametrize("a,b", [("A", "a"), ("94¹", "941"), ("e", "é"), ("-", "–"), ("’", "'"), ("a b", "a\nb"), ("⑤", "5"), ("1º", "1°"), ("a", "á")])
def test_visible_differences_stay(a, b):
    assert APPLY(a) != APPLY(b)


def test_rules_have_no_conflicts():
    rules = single_rules()
    assert all(t not in rules for target in rules.values() for t in target)
    assert Transducer().touched.isdisjoint("perché è già così – “x” €")


def test_pairs(spark):
    rows = [(1, "cittа"), (2, "città"[:-1] + "a"), (3, "citta"), (3, "citta"), (4, "ｃitta"), (5, None), (6, ""), (7, "​"), (8, "Citta"), (9, "x" * 100_000 + "é"), (10, "x" * 100_000 + "é")]
    df = spark.createDataFrame(rows, "block_id bigint, testo string").withColumn("look", F.lit(1)).withColumn("id", F.lit(2))
    got = sorted((r.a, r.b) for r in same_look_pairs(df).collect())
    assert got == [(1, 2), (1, 3), (1, 4), (2, 4), (3, 4), (6, 7), (9, 10)]
    assert same_look_pairs(df.where("false")).count() == 0
    links = {r.id: (r.rows, r.links) for r in look_links(df).collect()}
    assert links == {1: (4, 3), 2: (4, 2), 3: (4, 2), 4: (4, 3), 6: (2, 1), 7: (2, 1), 9: (2, 1), 10: (2, 1)}
    forms = {r.block_id: r.canonical for r in canonical(df.withColumn("canonical", F.lit("old"))).collect()}
    assert forms[1] == "citta" and forms[5] is None and forms[6] == ""
