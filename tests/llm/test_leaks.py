"""Leaks against brute force; edits; nulls."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexstrata.llm.leaks import find_leaks, words
from lexstrata.llm.queries import p9_found


def brute(docs, items, n):
    grams = {}
    for item, text in items:
        w = words(text)
        for p in range(len(w) - n + 1):
            grams.setdefault(tuple(w[p : p + n]), set()).add(item)
    out = set()
    for doc, text in docs:
        w = words(text)
        for p in range(len(w) - n + 1):
            out |= {(doc, i) for i in grams.get(tuple(w[p : p + n]), ())}
    return out


def test_found_equals_brute_force(spark):
    data = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    got = [(r.doc_id, r.item_id) for r in p9_found(spark, data).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items, 12) and got


def test_cases(spark):
    item = "uno due tre quattro cinque sei sette otto nove dieci undici dodici tredici"
    docs = [(1, "x " + item.upper().replace(" ", ",  ") + " y"), (2, " ".join(item.split()[:11])), (3, None), (4, ""), (5, item), (5, item), (6, "testo " * 50_000 + item)]
    left = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    right = spark.createDataFrame([(10, item), (11, item), (12, None), (13, "corto")], "item_id bigint, text string").withColumn("doc_id", F.lit(0))
    got = sorted((r.doc_id, r.item_id, r.edits) for r in find_leaks(left, right).collect())
    assert got == [(d, i, 0) for d in (1, 5, 6) for i in (10, 11)]
    assert sorted((r.doc_id, r.item_id) for r in find_leaks(left, right, block=2).collect()) == [(d, i) for d in (1, 5, 6) for i in (10, 11)]
    assert find_leaks(left.where("false"), right).count() == 0 and find_leaks(left, right.where("false")).count() == 0


def test_edits_reach_recall(spark):
    import random

    rng = random.Random(3)
    vocabulary = [f"parola{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(16))) for i in range(100)]
    docs = []
    for i, text in items:
        w = text.split()
        w[rng.randrange(2, 14)] = "diversa"
        docs.append((i, "prima " + " ".join(w) + " dopo"))
    got = {(r.doc_id, r.item_id) for r in find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), window=16, max_edits=1).collect()}
    assert len([1 for i, _ in items if (i, i) in got]) >= 90 and all(a == b for a, b in got)


def test_added_and_removed_words_reach_recall(spark):
    import random

    rng = random.Random(5)
    items = [(i, " ".join(f"parola{rng.randrange(400)}" for _ in range(16))) for i in range(150)]
    for kind in ("added", "removed"):
        docs = []
        for i, text in items:
            w, at = text.split(), rng.randrange(4, 12)
            w[at : at + (kind == "removed")] = ["nuova"] if kind == "added" else []
            # with words on both sides, and alone
            docs += [(i, "prima " + " ".join(w) + " dopo"), (1000 + i, " ".join(w))]
        got = {(r.doc_id, r.item_id, r.edits) for r in find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), window=16, max_edits=1).collect()}
        assert all(d % 1000 == i and e == 1 for d, i, e in got)
        for base in (0, 1000):
            assert len([1 for i, _ in items if (base + i, i, 1) in got]) >= 135, (kind, base)


def test_closest_run():
    import numpy as np

    from lexstrata.llm.leaks import edit_distances

    a = np.arange(1, 9)
    cases = (([0, *a, 0], 0), ([1, 2, 3, 4, 0, 5, 6, 7, 8], 1), ([0, 1, 2, 3, 5, 6, 7, 8, 0], 1), ([1, 2, 0, 4, 5, 6, 0, 8], 2), ([9] * 8, 8))
    b = np.array([[*x, *[-1] * (10 - len(x))] for x, _ in cases])
    assert edit_distances(np.tile(a, (len(cases), 1)), b).tolist() == [d for _, d in cases]


def test_runs_drop_no_window_within_the_edits():
    import random

    from lexstrata.llm.leaks import ItemIndex, least_run

    assert [least_run(12, 0), least_run(12, 1), least_run(16, 1), least_run(12, 2)] == [12, 6, 8, 4]
    rng = random.Random(4)
    items = [(i, " ".join(f"p{rng.randrange(300)}" for _ in range(12))) for i in range(60)]
    texts = []
    for _, text in items:
        w, at = text.split(), rng.randrange(12)
        w[at : at + rng.randint(0, 1)] = [f"p{rng.randrange(300)}"] * rng.randint(0, 1)
        texts.append("prima " + " ".join(w) + " dopo ancora")
    found = {(row, item) for row, item, _ in ItemIndex(items, 12, 1, 40).search(texts)}
    assert sum((i, i) in found for i in range(60)) >= 57
