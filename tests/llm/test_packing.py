"""Packing and splitting: invariants, brute force, nulls."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexstrata.llm.packing import assign_chunks, pack, plan
from lexstrata.llm.queries import oracle_sql, p2_found
from lexstrata.llm.splitting import WORDS, boundaries, cuts, pieces, split_long


def walk(places, n, limit, overlap):
    """The greedy cuts one after the other."""
    out, start, end = [], 0, 0
    while True:
        far = min(start + limit, n)
        legal = [p for p in places if max(end, start + overlap) < p <= far]
        new = far if far == n or not legal else legal[-1]
        out.append(new)
        if new == n:
            return out
        end, start = new, max(0, new - overlap)


def test_cuts_equal_the_walk_to_the_farthest_boundary():
    rng = random.Random(6)
    for share in (0.02, 0.1, 0.5):
        for _ in range(200):
            n, overlap = rng.randint(21, 400), rng.randint(0, 10)
            places = [p for p in range(1, n + 1) if rng.random() < share]
            assert cuts(np.array(places, dtype=np.int64), n, 20, overlap).tolist() == walk(places, n, 20, overlap)


def test_boundaries():
    for word, n in (("white", 8), ("alnum", 9)):
        text = "Uno due. Tre, quattro\n \ncinque 3.5 sei (sette.) otto"
        starts = np.array([m.start() for m in WORDS[word].finditer(text)])
        assert boundaries(text, starts).tolist() == ([2, 3, 4, 8] if word == "white" else [2, 3, 4, 9][: 4]) and len(starts) == n + 1


@pytest.mark.parametrize("word", ["white", "alnum"])
def test_pieces_cover(word):
    rng = random.Random(7)
    text = "".join(rng.choice(["l'ente ", "parola, ", "fine. ", "x\n\n", "y ", "z-w "]) for _ in range(900))
    every = WORDS[word].findall(text)
    at = 0
    for a, b, c, d in pieces(text, 50, 7, word):
        assert b - a <= 50 and WORDS[word].findall(text[c:d]) == every[a:b] and a == max(0, at - 7)
        at = b
    assert at == len(every)


def test_split_operator(spark):
    rows = [(1, "w " * 221, None), (2, "w " * 220, 40), (3, None, 3), (4, "", 3), (5, "w " * 500, 500), (6, "w " * 500, -4), (7, "w " * 300, 0), (1, "w " * 221, None), (8, "w " * 100_000, 40)]
    df = spark.createDataFrame(rows, "item_id bigint, testo string, split_overlap_words int").withColumn("piece", F.lit("x")).withColumn("word_count", F.lit(0))
    got = {}
    for r in split_long(df).collect():
        got.setdefault(r.item_id, []).append((r.piece, r.split_word_start, r.word_count, r.overlap))
    assert sorted(got) == [1, 5, 6, 7, 8]
    assert sorted(got[1]) == [(0, 0, 220, 0)] * 2 + [(1, 180, 41, 40)] * 2
    assert max(x[3] for x in got[5]) == 110 and sorted(got[6]) == [(0, 0, 220, 0), (1, 220, 220, 0), (2, 440, 60, 0)] and len(got[8]) == 556
    assert split_long(df, keep_short=True).where("item_id = 2").count() == 1 and split_long(df.where("false")).count() == 0


def test_found_equals_sql(spark, data):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view struttura_rag_graph as select * from '{data}/struttura_rag_graph.parquet'")
    assert {r.item_id for r in p2_found(spark, data).collect()} == {r[0] for r in con.execute(oracle_sql()["p2_found"]).fetchall()}


def first_fit(lengths, capacity=220):
    """Chunks of first fit on falling lengths."""
    room = []
    for n in sorted(lengths, reverse=True):
        for i, r in enumerate(room):
            if r >= n:
                room[i] -= n
                break
        else:
            room.append(capacity - n)
    return len(room)


WINDOWS = (220, 110, 55)


def test_plan_uses_all_items():
    rng = random.Random(8)
    for _ in range(100):
        counts = {n: rng.randint(1, 50) for n in rng.sample(range(1, 221), rng.randint(1, 60))}
        left, chunks, before = dict(counts), 0, 220
        for pattern, times, window in plan(counts, WINDOWS):
            total = sum(n * k for n, k in pattern.items())
            assert times > 0 and total <= before and max(pattern) <= window
            before, chunks = total, chunks + times
            for n, k in pattern.items():
                left[n] -= k * times
        assert not any(left.values())
        assert chunks <= 1.03 * first_fit([n for n, k in counts.items() for _ in range(k)]) + 1


def test_tiers_decide_what_fills_a_gap():
    # long windows first take what fills their gap from the shorter tiers; windows of the middle tier are packed by themselves
    counts = {150: 1, 40: 1, 30: 1, 100: 2, 10: 2}
    tiers = {frozenset(p.items()): (n, w) for p, n, w in plan(counts, WINDOWS)}
    assert tiers == {frozenset({150: 1, 40: 1, 30: 1}.items()): (1, 220), frozenset({100: 2, 10: 2}.items()): (1, 110)}
    # without tiers the plans are others
    rng = random.Random(3)
    differ = sum([(sorted(p.items()), n) for p, n, _ in plan(c, WINDOWS)] != [(sorted(p.items()), n) for p, n, _ in plan(c, (220,))] for c in ({n: rng.randint(1, 9) for n in rng.sample(range(1, 221), 40)} for _ in range(50)))
    assert differ > 40


def test_one_group_with_most_rows(spark):
    df = spark.range(4000).selectExpr("'g' as grp", "id", "0 as piece", "cast(1 + id % 219 as int) as words")
    got = assign_chunks(df.union(df), ["grp"], ["id", "piece"]).collect()
    assert len(got) == 4000
    total, declared = {}, {}
    for r in got:
        total[r.chunk] = total.get(r.chunk, 0) + r.words
        declared[r.chunk] = r.chunk_words
    assert total == declared and max(total.values()) <= 220 and sorted(total) == list(range(len(total)))
    steps = {}
    for r in got:
        steps.setdefault(r.step, 0)
        steps[r.step] += r.words
    assert max(steps.values()) < 1.1 * min(steps.values()) + 220


def test_pack(spark):
    rows = [("a", 1, "uno due"), ("a", 1, "uno due"), ("a", 2, None), ("a", 3, "..."), ("a", 4, "w " * 450), (None, 5, "tre"), ("b", 6, "")]
    df = spark.createDataFrame(rows, "grp string, id bigint, testo string").withColumn("chunk", F.lit("x")).withColumn("words", F.lit(1))
    got = pack(df, ["grp"], "id", "testo").collect()
    assert sorted((r.grp or "", r.words) for r in got) == [("", 1), ("a", 12), ("a", 220), ("a", 220)]
    assert [r.text for r in got if r.grp is None] == ["tre"] and sorted(i for r in got for i in r["items"]) == [1, 3, 4, 4, 4, 5]
    silent = pack(df.where("id = 3"), ["grp"], "id", "testo").collect()
    assert [(r.words, r["items"], r.text) for r in silent] == [(0, [3], "...")]
    assert pack(df.where("false"), ["grp"], "id", "testo").count() == 0


def test_boundaries_of_the_first_half_are_used():
    text = "w " * 59 + "fine. " + "w " * 300
    assert [(a, b) for a, b, _, _ in pieces(text, 220, 40)] == [(0, 60), (20, 240), (200, 360)]
    # a boundary within the overlap gives no new piece
    assert [(a, b) for a, b, _, _ in pieces("w " * 29 + "fine. " + "w " * 300, 220, 40)] == [(0, 30), (0, 220), (180, 330)][1:]
    # the farthest boundary counts, whatever it ends
    assert [b for _, b, _, _ in pieces("w " * 149 + "fine.\n\n" + "w " * 49 + "ma, " + "w " * 100, 220, 0)] == [200, 300]
