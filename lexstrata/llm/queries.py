"""The pN_ queries of this subpackage, with production parameters, over their whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.functions.runtime import read_spread, read_table

#: Where the public vocabularies are; a parameter of the deployment, never copied into the repository.
TOKENIZER_DIR = os.environ.get("LEXSTRATA_TOKENIZERS", "/opt/tokenizers")


def _packable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of both tables: source, grp (record or file), id and testo."""
    from lexstrata.operators.flatten import flatten_trees, tree_contents

    contents = tree_contents(flatten_trees(read_spread(spark, sf_dir, "struttura_ad_albero")))
    trees = contents.select(F.lit("tree").alias("source"), F.col("record_id").cast("string").alias("grp"), F.col("path").alias("id"), "testo")
    blocks = read_table(spark, sf_dir, "ocr_blocks").select(F.lit("blocks").alias("source"), F.col("file").alias("grp"), F.col("block_id").cast("string").alias("id"), "testo")
    return trees.unionByName(blocks)


def p1_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of at most 220 words from the contents of each tree record and the blocks of each file."""
    from lexstrata.llm.packing import pack

    return pack(_packable(spark, sf_dir), ["source", "grp"], "id", "testo")


def p1_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk of every item and piece."""
    from lexstrata.llm.packing import assign_chunks, fitting_items

    items = fitting_items(_packable(spark, sf_dir), ["source", "grp"], "id", "testo", 220, texts=False)
    return assign_chunks(items, ["source", "grp"], ["id", "piece"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of more than 220 words: those that the splitting cuts."""
    return p2_pieces(spark, sf_dir).where("piece = 0").select("item_id")


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of those items, at most 220 words each."""
    from lexstrata.llm.splitting import split_long

    return split_long(read_table(spark, sf_dir, "struttura_rag_graph"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of blocks of at least 40 words whose word sets have 0.75 of their union in common."""
    from lexstrata.llm.neardup import all_pairs, similar_classes

    pairs = all_pairs(*similar_classes(read_spread(spark, sf_dir, "ocr_blocks"), threshold=0.75, min_words=40))
    return pairs.select(F.col("a").alias("block_id_a"), F.col("b").alias("block_id_b"))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each such block: its class of equal word sets and its number of links."""
    from lexstrata.llm.neardup import link_counts, similar_classes

    return link_counts(*similar_classes(read_spread(spark, sf_dir, "ocr_blocks"), threshold=0.75, min_words=40)).withColumnRenamed("id", "block_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of blocks whose texts are not identical but look the same."""
    from lexstrata.llm.lookalike import same_look_pairs

    pairs = same_look_pairs(read_spread(spark, sf_dir, "ocr_blocks"))
    return pairs.select(F.col("a").alias("block_id_a"), F.col("b").alias("block_id_b"))


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each block that looks like another: its class and its number of links."""
    from lexstrata.llm.lookalike import look_links

    return look_links(read_spread(spark, sf_dir, "ocr_blocks")).withColumnRenamed("id", "block_id")


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered block with its text in one form."""
    from lexstrata.llm.lookalike import canonical

    return canonical(read_spread(spark, sf_dir, "ocr_blocks").select("block_id", "ingested_at", "testo")).select("block_id", "ingested_at", "canonical")


def _languages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from lexstrata.llm.langid import languages

    return languages(read_spread(spark, sf_dir, "ocr_blocks"), read_table(spark, sf_dir, "language_config"), read_table(spark, sf_dir, "documents"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a missing or wrong label (block_id 0) and blocks with a sentence in another language."""
    files, blocks = _languages(spark, sf_dir)
    wrong = files.where("wrong").select("file", F.lit(0).cast("bigint").alias("block_id"), "lang")
    return wrong.unionByName(blocks.select("file", "block_id", "lang"))


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each file, with the classifier's confidence, beside the label."""
    return _languages(spark, sf_dir)[0]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that are page furniture, hold divided or misread words, or go on from the page before."""
    from lexstrata.llm.ocr import analysed, kinds

    return kinds(analysed(read_spread(spark, sf_dir, "ocr_blocks"))[0])


def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous, repaired paragraphs of each file."""
    from lexstrata.llm.ocr import paragraphs

    return paragraphs(read_spread(spark, sf_dir, "ocr_blocks"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    from lexstrata.llm.encode import encode_corpus

    return encode_corpus(read_spread(spark, sf_dir, "documents"), os.path.join(TOKENIZER_DIR, "byte_bpe_50k.tiktoken"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 12 consecutive words of a test item: what the search for passages with up to one edit finds without one."""
    from lexstrata.llm.leaks import find_leaks

    return find_leaks(read_spread(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=12, max_edits=1).where("edits = 0").select("doc_id", "item_id")


def p9_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with up to one word edit in a window of 16 words, and the edits found."""
    from lexstrata.llm.leaks import find_leaks

    return find_leaks(read_spread(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=16, max_edits=1)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a sequence garbled by decoding with a wrong encoding."""
    return p10_restored(spark, sf_dir).select("doc_id")


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with the encoding chain and, where it can be recovered, the original text."""
    from lexstrata.llm.mojibake import find_garbled

    return find_garbled(read_spread(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_chunks": p1_chunks, "p1_items": p1_items, "p2_found": p2_found, "p2_pieces": p2_pieces, "p3_found": p3_found, "p3_links": p3_links, "p4_found": p4_found, "p4_links": p4_links, "p4_canonical": p4_canonical, "p5_found": p5_found, "p5_languages": p5_languages, "p6_found": p6_found, "p6_paragraphs": p6_paragraphs, "p8_ids": p8_ids, "p9_found": p9_found, "p9_edited": p9_edited, "p10_found": p10_found, "p10_restored": p10_restored}


def oracle_sql() -> dict[str, str]:
    white = "[^\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
    return {"p2_found": f"SELECT DISTINCT item_id FROM struttura_rag_graph WHERE len(regexp_extract_all(testo, '{white}')) > 220"}
