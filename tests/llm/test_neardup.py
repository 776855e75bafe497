"""Near duplicates against brute force; copies; nulls; the estimate."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from lexstrata.llm.neardup import Sketcher, all_pairs, estimate, link_counts, similar_classes
from lexstrata.llm.queries import p3_found

WORD = re.compile(r"[^\W_]+")


def brute(rows, threshold, least):
    sets = {i: frozenset(WORD.findall(t.lower())) for i, t in rows if t and len(WORD.findall(t.lower())) >= max(1, least)}
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_found_equals_brute_force(spark, data):
    rows = {r.block_id: r.testo for r in spark.read.parquet(f"{data}/ocr_blocks.parquet").collect()}
    got = [(r.block_id_a, r.block_id_b) for r in p3_found(spark, data).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows.items(), 0.75, 40)


def test_cases(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = [(1, " ".join(base)), (1, " ".join(base)), (2, " ".join(reversed(base)).upper()), (3, " ".join([*base[:-3], "a", "b", "c"])), (4, " ".join(base[:30] + [f"z{i}" for i in range(30)])), (5, None), (6, ""), (7, "  \n"), (8, "solo"), (9, "Solo!"), (10, "q " * 100_000)]
    df = spark.createDataFrame(texts, "block_id bigint, testo string").withColumn("cls", F.lit("x")).withColumn("id", F.lit("y"))
    members, links = similar_classes(df, 0.8)
    pairs = [(r.a, r.b) for r in all_pairs(members, links).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute(dict(texts).items(), 0.8, 1) == {(1, 2), (1, 3), (2, 3), (8, 9)}
    counts = {r.id: (r.copies, r.links) for r in link_counts(members, links).collect()}
    assert counts == {1: (2, 2), 2: (2, 2), 3: (1, 2), 4: (1, 0), 8: (2, 1), 9: (2, 1), 10: (1, 0)}
    members, links = similar_classes(df.where("false"), 0.8)
    assert members.count() == 0 and links.count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(4)
    sketcher = Sketcher()
    for shared, own in ((80, 10), (50, 25), (20, 40)):
        a = rng.choice(2**32, shared + own, replace=False).astype(np.uint32)
        b = np.concatenate([a[:shared], rng.choice(2**32, own).astype(np.uint32)])
        k = sketcher.sketch([a, b])
        n = np.array([float(shared + own)])
        assert abs(estimate(k[:1], k[1:], n, n)[0] - shared / (shared + 2 * own)) < 0.1


def test_sketches_merge():
    a, b = np.arange(1, 50, dtype=np.uint32), np.arange(30, 90, dtype=np.uint32)
    s = Sketcher()
    assert (np.maximum(*s.sketch([a, b])) == s.sketch([np.union1d(a, b)])[0]).all()
