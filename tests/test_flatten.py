"""Nested trees: shapes, nulls, broken records, depth."""

from __future__ import annotations

import json

from lexstrata.operators.flatten import LEVELS_AT_ONCE, flatten_trees, merged_members, merged_schema, tree_contents, tree_nodes

NODE = {"name": "document", "etichetta": "document", "contenuto": ["bare", None, {"etichetta": "point", "testo": "a \"quoted\" {brace}", "confidenza": "0.7"}], "figli": [None, {"name": "article:1", "numero": 1, "contenuto": {"testo": "single"}, "figli": {"name": "inner"}}]}


def rows(spark, texts, **extra):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "record_id bigint, albero string")
    for name in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("x"))
    return df


def paths(df):
    return sorted((r.record_id, r.kind, r.path, r.parent_path) for r in df.collect())


EXPECTED = [("content", "0.1.c0", "0.1"), ("content", "0.c0", "0"), ("content", "0.c2", "0"), ("node", "0", ""), ("node", "0.1", "0"), ("node", "0.1.0", "0.1")]


def test_all_shapes_give_the_same_rows(spark):
    text = json.dumps(NODE)
    shapes = [text, json.dumps([NODE]), json.dumps(text), "  " + text + "\n"]
    got = paths(flatten_trees(rows(spark, shapes, name=1, path=1, kind=1)))
    assert got == sorted((i, *e) for i in range(len(shapes)) for e in EXPECTED)


def test_broken_and_empty_records_give_no_row(spark):
    text = json.dumps(NODE)
    bad = [None, "", "   ", "null", text[:-5], text + "x", text + text, "[" + text, json.dumps(text)[:-9], "NaN", "5", json.dumps("no tree")]
    assert paths(flatten_trees(rows(spark, bad))) == []


def test_several_roots_and_null_roots(spark):
    got = paths(flatten_trees(rows(spark, [json.dumps([{"name": "a"}, None, {"name": "b"}])])))
    assert [g[2] for g in got] == ["0", "2"]


def test_fields_and_tables(spark):
    flat = flatten_trees(rows(spark, [json.dumps(NODE)]))
    contents = {r.path: r for r in tree_contents(flat).collect()}
    assert contents["0.c0"].testo == "bare" and contents["0.c2"].testo == 'a "quoted" {brace}' and contents["0.c2"].confidenza == "0.7" and contents["0.c2"].ordinal == 2
    nodes = {r.path: r for r in tree_nodes(flat).collect()}
    assert nodes["0.1"].numero == "1" and nodes["0.1"].intestazione is None and nodes["0.1.0"].level == 2


def test_any_depth_and_repeated_records(spark):
    tree = {"name": "leaf", "contenuto": ["last"]}
    for i in range(3 * LEVELS_AT_ONCE + 2):
        tree = {"name": str(i), "figli": [tree]}
    df = rows(spark, [json.dumps(tree), json.dumps(tree), json.dumps({"name": "flat"})])
    depth = 3 * LEVELS_AT_ONCE + 3
    flat = flatten_trees(df)
    assert merged_schema(df).levels == depth and flat.count() == 2 * (depth + 1) + 1
    deepest = flat.where("testo = 'last'").select("level", "parent_path").distinct().collect()
    assert [(r.level, r.parent_path.count(".")) for r in deepest] == [(depth, depth - 1)]


def test_empty_table(spark):
    df = rows(spark, ["x"]).where("false")
    assert flatten_trees(df).count() == 0 and merged_schema(df).levels == 0


def test_merged_schema_has_members_of_all_levels_with_their_types(spark):
    df = rows(spark, [json.dumps({"numero": 1, "figli": [{"numero": "x", "contenuto": {"testo": None}}]}), json.dumps({"extra": True})])
    got = {(r.kind, r.member): r.type for r in merged_members(df).where("kind is not null and member <> 'numero'").collect()}
    assert got == {("node", "figli"): "array", ("node", "contenuto"): "object", ("content", "testo"): "null", ("node", "extra"): "boolean"}
    assert merged_schema(df).of("node", "numero") == {"number", "string"} and merged_schema(df).of("content", "testo") == frozenset()


def test_the_schema_decides_what_is_extracted(spark):
    df = rows(spark, [json.dumps([{"name": "a", "figli": [{"rubrica": "only below"}]}])])
    assert [r.rubrica for r in flatten_trees(df).orderBy("path").collect()] == [None, "only below"]
    plan = flatten_trees(df)._jdf.queryExecution().logical().toString()
    assert "$.rubrica" in plan and "$.confidenza" not in plan and "$.contenuto" not in plan
