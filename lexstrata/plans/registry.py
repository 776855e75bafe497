"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexstrata.functions.runtime import read_spread
from lexstrata.operators.flatten import flatten_trees, merged_members, tree_contents, tree_nodes
from lexstrata.plans import analysis, records, structure  # noqa: F401 - all add their queries to those of structure


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the contents under each heading: load, label, order, own, count."""
    return structure.words_per_heading(spark, sf_dir)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and content items of every complete tree, with their paths."""
    return flatten_trees(read_spread(spark, sf_dir, "struttura_ad_albero")).select("record_id", "kind", "path", "parent_path")


def p7_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of nodes."""
    return tree_nodes(flatten_trees(read_spread(spark, sf_dir, "struttura_ad_albero")))


def p7_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of content items."""
    return tree_contents(flatten_trees(read_spread(spark, sf_dir, "struttura_ad_albero")))


def p7_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged schema: members of nodes and items with their types, how often they occur and in how deep records."""
    return merged_members(read_spread(spark, sf_dir, "struttura_ad_albero")).where("kind is not null")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return structure.QUERIES | {"p7_found": p7_found, "p7_nodes": p7_nodes, "p7_contents": p7_contents, "p7_schema": p7_schema}


def oracle_sql() -> dict[str, str]:
    return dict(structure.ORACLE)
