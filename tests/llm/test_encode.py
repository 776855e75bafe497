"""Encoding by trie traversal against the public libraries."""

from __future__ import annotations

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexstrata.llm.encode import TrieEncoder, encode_corpus
from lexstrata.llm.queries import TOKENIZER_DIR, p8_ids

PATH = os.path.join(TOKENIZER_DIR, "byte_bpe_50k.tiktoken")
ENCODER = TrieEncoder.from_file(PATH)


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(TOKENIZER_DIR, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def ids(text):
    return ENCODER.encode_batch([text])[1].tolist()


@pytest.mark.parametrize("text", ["<|endoftext|> hi", "½ x² ¹23", "a\x1cb  \t\n c", "__init__ _a", "日本語🙂 naïve", "éa", "x" * 3000, "  \n\n  a", " " * 700, "=*" * 300, "١٢٣ Ⅷ", "don't we'll I'm", "\x00�"])
def test_hard_texts(reference, text):
    assert ids(text) == reference(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(reference, text):
    assert ids(text) == reference(text)


def test_query_equals_reference_on_all_documents(spark, data, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = {r.doc_id: r.ids for r in p8_ids(spark, data).collect()}
    assert got == {k: reference(t) if t else [] for k, t in texts.items()}


def test_null_empty_repeated_and_clashing(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (3, " "), (None, "a")], "doc_id bigint, text string").withColumn("ids", F.lit("x"))
    got = sorted(((r.doc_id, r.ids) for r in encode_corpus(df, PATH).collect()), key=repr)
    assert got == sorted([(1, []), (2, []), (3, [220]), (3, [220]), (None, [64])], key=repr)
    assert encode_corpus(df.where("false"), PATH).count() == 0
