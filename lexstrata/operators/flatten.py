"""Nested trees of JSON as related flat tables (problem 7).

One aggregate over the records infers the merged schema: the members of nodes and items at every level with their types,
and the number of levels. It decides which members are extracted, which lists may be single entries instead, and how many
explodes there are. A record is then parsed once, into a VARIANT, as members of one name have different types in different
places; each level's array is exploded into rows with the parent's path as surrogate key and the ordinal in the parent.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.functions.runtime import written
from lexstrata.functions.text import bind

NODE_FIELDS = ("name", "intestazione", "etichetta", "numero", "rubrica")
CONTENT_FIELDS = ("etichetta", "testo", "confidenza")
FIELDS = tuple(dict.fromkeys((*NODE_FIELDS, *CONTENT_FIELDS)))
COLUMNS = ("kind", "path", "parent_path", "ordinal", "level", *FIELDS, "source", "waiting")
#: Levels of nodes that one plan explodes; deeper ones are read from the table of those that wait.
LEVELS_AT_ONCE = 12


@dataclass(frozen=True)
class TreeShape:
    """Names of the members that hold a node's children and contents."""

    children: str = "figli"
    contents: str = "contenuto"


def _parsed(text: Column) -> Column:
    """The JSON value of ``text``, decoded again where it is a string of JSON; null if it isn't one complete JSON value.

    The parser stops after the first value and wouldn't notice what follows it. What closes a list doesn't close an
    object, so a text that is parsed as the only entry of a list and as the only member of an object has nothing behind.
    """

    def whole(t: Column) -> Column:
        member = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}")))
        entry = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
        return F.when(entry.isNotNull(), F.try_variant_get(member, "$.v", "variant"))

    def decoded(t: Column) -> Column:
        return F.when(t.rlike(r'^\s*"'), F.try_variant_get(whole(t), "$", "string")).otherwise(t)

    return bind(decoded(text), lambda t: F.when(t.rlike(r"^\s*[\[{]"), whole(t)))


def _entries(value: Column) -> Column:
    """A list's entries; any other value as the only entry; nothing for null."""

    def listed(v: Column) -> Column:
        missing = v.isNull() | F.is_variant_null(v)
        return F.when(missing, F.array().cast("array<variant>")).otherwise(F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)))

    return bind(value, listed)


def _is_object(value: Column) -> Column:
    """By a shallow cast; the type name of a value would be made from its whole subtree."""
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _there(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _nesting(text: str) -> int:
    """Deepest nesting of braces outside strings."""
    now = most = 0
    inside = escaped = False
    for c in text:
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = True
        elif c == '"':
            inside = not inside
        elif not inside and c in "{}":
            now += 1 if c == "{" else -1
            most = max(most, now)
    return most


def _members(text: str, shape: TreeShape, seen: Counter[tuple[str, str, str]]) -> int:
    """Adds (kind, member, type) of every node and item of a record to ``seen``; returns how many levels of nodes it has.

    What isn't JSON adds nothing, and its nesting stands for its levels.
    """
    try:
        value = json.loads(text)
        value = json.loads(value) if isinstance(value, str) else value
    except (ValueError, RecursionError):
        return _nesting(text)
    level, now = 0, value if isinstance(value, list) else [value]
    while now := [n for n in now if isinstance(n, dict)]:
        level += 1
        below: list = []
        for node in now:
            for name, member in node.items():
                seen["node", name, TYPES.get(type(member), "number")] += 1
            for item in _listed(node.get(shape.contents)):
                if isinstance(item, dict):
                    for name, member in item.items():
                        seen["content", name, TYPES.get(type(member), "number")] += 1
                elif item is not None:
                    seen["content", "", TYPES.get(type(item), "number")] += 1
            below += _listed(node.get(shape.children))
        now = below
    return level


def _listed(value: object) -> list:
    return value if isinstance(value, list) else [value]


#: Names of JSON types; everything else is a number.
TYPES = {str: "string", bool: "boolean", dict: "object", list: "array", type(None): "null"}


def merged_members(df: DataFrame, text_col: str = "albero", shape: TreeShape = TreeShape()) -> DataFrame:
    """kind, member, type, n and levels: the schema merged from every node and item of every record, at every level.

    A member with several types has a row for each; an item that is a bare value has the member ``""``; ``levels`` is the
    most levels of nodes in a record that has the member. Records without a member have one row with null kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, str, str]] = Counter()
        most = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    most = max(most, _members(text, shape, seen))
        keys = [*seen, (None, None, None)]
        yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(3)), pa.array([*seen.values(), 0], pa.int64()), pa.array([most] * len(keys), pa.int32())], names=["kind", "member", "type", "n", "levels"])

    found = df.select(text_col).mapInArrow(run, "kind string, member string, type string, n bigint, levels int")
    return found.groupBy("kind", "member", "type").agg(F.sum("n").alias("n"), F.max("levels").alias("levels"))


@dataclass(frozen=True)
class MergedSchema:
    """What the flattening needs of the merged schema: types of the members it extracts, and the levels of nodes."""

    types: dict[tuple[str, str], frozenset[str]]
    levels: int

    def of(self, kind: str, member: str) -> frozenset[str]:
        """Types of a member, without null."""
        return self.types.get((kind, member), frozenset()) - {"null"}


def merged_schema(df: DataFrame, text_col: str = "albero", shape: TreeShape = TreeShape()) -> MergedSchema:
    """``merged_members`` of the members that are extracted: as many rows as they have types, however many records there are."""
    wanted = [*NODE_FIELDS, *CONTENT_FIELDS, "source", "", shape.children, shape.contents]
    rows = merged_members(df, text_col, shape).where(F.col("kind").isNull() | F.col("member").isin(wanted)).collect()
    types: dict[tuple[str, str], set[str]] = {}
    for r in rows:
        if r.kind is not None:
            types.setdefault((r.kind, r.member), set()).add(r.type)
    return MergedSchema({k: frozenset(v) for k, v in types.items()}, max((r.levels for r in rows), default=0))


def _entries_sql(value: str, types: frozenset[str]) -> str:
    """Entries of a member: a list is taken as it is, unless the merged schema has other types beside it."""
    listed = f"try_variant_get({value}, '$', 'array<variant>')"
    if types <= {"array"}:
        return f"coalesce({listed}, array())"
    return f"CASE WHEN {value} IS NULL OR is_variant_null({value}) THEN array() ELSE coalesce({listed}, array({value})) END"


class _Level:
    """SQL text of one level of the flattening: what a waiting node becomes."""

    def __init__(self, schema: MergedSchema, shape: TreeShape):
        self.schema, self.shape = schema, shape
        self.bare = bool(schema.of("content", ""))

    def members(self, kind: str, value: str) -> str:
        """The extracted members of a value, and null for those that its kind or the merged schema lacks."""
        mine = NODE_FIELDS if kind == "node" else CONTENT_FIELDS
        out = []
        for name in (*FIELDS, "source"):
            known = name in (*mine, "source") and self.schema.of(kind, name)
            got = f"try_variant_get({value}, '$.{name}', 'string')" if known else "CAST(NULL AS STRING)"
            if known and name == "source":
                got = f"to_json(try_variant_get({value}, '$.source', 'variant'))"
            if kind == "content" and name == "testo" and self.bare:
                got = f"CASE WHEN {self.is_object(value)} THEN {got} ELSE try_variant_get({value}, '$', 'string') END"
            out.append(f"'{name}', {got}")
        return ", ".join(out)

    @staticmethod
    def is_object(value: str) -> str:
        """By a shallow cast; the type name of a value would be made from its whole subtree."""
        return f"try_variant_get({value}, '$', 'map<string,variant>') IS NOT NULL"

    def numbered(self, member: str) -> str:
        """Entries of a member with their numbers, without null ones."""
        types = self.schema.of("node", member)
        if not types:
            return "CAST(array() AS ARRAY<STRUCT<e: VARIANT, i: INT>>)"
        entries = _entries_sql("v", types)
        every = f"element_at(transform(array(try_variant_get(waiting, '$.{member}', 'variant')), v -> {entries}), 1)"
        return f"filter(transform({every}, (e, i) -> named_struct('e', e, 'i', i)), x -> x.e IS NOT NULL AND NOT is_variant_null(x.e))"

    def sql(self, id_col: str, inner: str) -> str:
        head = "'kind', '{}', 'path', {}, 'parent_path', {}, 'ordinal', {}, 'level', {}"
        none = "'waiting', CAST(NULL AS VARIANT)"
        blank = ", ".join(f"'{n}', CAST(NULL AS STRING)" for n in (*FIELDS, "source"))
        itself = f"array(named_struct({head.format('node', 'path', 'parent_path', 'ordinal', 'level')}, {self.members('node', 'waiting')}, {none}))"
        item = f"named_struct({head.format('content', "concat(path, '.c', x.i)", 'path', 'x.i', 'level + 1')}, {self.members('content', 'x.e')}, {none})"
        child = f"named_struct({head.format('node', "concat(path, '.', x.i)", 'path', 'x.i', 'level + 1')}, {blank}, 'waiting', x.e)"
        contents = f"transform({self.numbered(self.shape.contents)}, x -> {item})"
        children = f"transform(filter({self.numbered(self.shape.children)}, x -> {self.is_object('x.e')}), x -> {child})"
        kept = "named_struct(" + ", ".join(f"'{c}', {c}" for c in COLUMNS) + ")"
        return f"SELECT `{id_col}`, x.* FROM (SELECT `{id_col}`, explode(CASE WHEN waiting IS NOT NULL THEN concat({itself}, {contents}, {children}) ELSE array({kept}) END) AS x FROM ({inner}))"


def flatten_trees(df: DataFrame, id_col: str = "record_id", text_col: str = "albero", shape: TreeShape = TreeShape(), schema: MergedSchema | None = None) -> DataFrame:
    """One row for each node and content item of each complete tree.

    Columns: ``id_col``, kind (node or content), path, parent_path (empty for roots), ordinal (place in the parent's
    list, from 0), level, the members of NODE_FIELDS and CONTENT_FIELDS as text (null where missing, null or of no use
    for the kind) and ``source`` as JSON. Values of another type are written as text; a content that is a bare value has
    it as ``testo``. A document that is one node, a list of nodes, or a JSON string of either gives the same rows; one
    entry in place of a list is entry 0; null entries keep their number. Null, blank, cut-off and otherwise invalid
    records give no row; repeated records give their rows each; other columns are ignored; an empty table gives no row.

    ``schema`` (inferred where not given) says which members exist, which lists need to be told from single entries, and
    how many levels there are. A node becomes its own row as soon as it is met, with its members extracted; only its
    children, not the node, go on to the next level. Levels beyond LEVELS_AT_ONCE are a plan of their own over the
    nodes that reach so deep, so a deep record doesn't lengthen the plan of all others.
    """
    schema = schema or merged_schema(df, text_col, shape)
    spark, key = df.sparkSession, "_id"
    first = F.filter(F.transform(_entries(F.col("v")), lambda e, i: F.struct(e.alias("value"), i.alias("ordinal"))), lambda r: _there(r["value"]) & _is_object(r["value"]))
    blank = [F.lit(None).cast("string").alias(n) for n in (*FIELDS, "source")]
    rows = (
        df.select(F.col(id_col).alias(key), _parsed(F.col(text_col)).alias("v"))
        .select(key, F.explode(first).alias("r"))
        .select(key, F.lit("node").alias("kind"), F.col("r.ordinal").cast("string").alias("path"), F.lit("").alias("parent_path"), F.col("r.ordinal").alias("ordinal"), F.lit(0).alias("level"), *blank, F.col("r.value").alias("waiting"))
    )
    out, left, level = None, schema.levels, _Level(schema, shape)
    while True:
        for _ in range(min(left, LEVELS_AT_ONCE)):
            rows = spark.sql(level.sql(key, "SELECT * FROM {rows}"), rows=rows)
        left -= LEVELS_AT_ONCE
        deeper = left > 0
        rows = written(rows, "levels") if deeper else rows
        done = rows.where("waiting is null").drop("waiting").withColumnRenamed(key, id_col)
        out = done if out is None else out.unionByName(done)
        if not deeper:
            return out
        rows = rows.where("waiting is not null")


def tree_nodes(flat: DataFrame, id_col: str = "record_id") -> DataFrame:
    """The table of nodes of ``flatten_trees``."""
    return flat.where("kind = 'node'").select(id_col, "path", "parent_path", "ordinal", "level", *NODE_FIELDS, "source")


def tree_contents(flat: DataFrame, id_col: str = "record_id") -> DataFrame:
    """The table of content items of ``flatten_trees``."""
    return flat.where("kind = 'content'").select(id_col, "path", "parent_path", "ordinal", "level", *CONTENT_FIELDS, "source")
