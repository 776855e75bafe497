"""Labels, headings, tree, chunks and records on small cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexstrata.functions import profiles as P
from lexstrata.functions.text import matching_text
from lexstrata.operators import akn as AK
from lexstrata.operators import chunks as C
from lexstrata.operators import export as E
from lexstrata.operators import records as R
from lexstrata.operators import structure as S
from lexstrata.operators.manifest import pending_steps
from lexstrata.sources.blocks import read_documents


def label(spark, profile, texts):
    df = spark.createDataFrame([(i, t, profile) for i, t in enumerate(texts)], "i int, t string, profile string").withColumn("n", matching_text(F.col("t")))
    rows = df.withColumn("label", P.structural_label(F.col("n"), F.col("profile"))).withColumn("number", P.structural_number(F.col("n"), F.col("profile"), F.col("label")))
    return [(r.label, r.number) for r in rows.orderBy("i").collect()]


def test_italian_headings(spark):
    got = label(spark, "it", ["Art. 5-ter. Definizioni", "Articolo 1", "Capo IV", "TITOLO I", "Sezione 3", "Allegato II-bis", "Parte PRIMA", "Art. 5 bis", "(3) considerando", "prosa", None, ""])
    assert got == [("article", "5-ter"), ("article", "1"), ("chapter", "IV"), ("title", "I"), ("section", "3"), ("annex", "II-bis"), ("part", "prima"), ("article", "5-bis"), ("recital", "3"), (None, None), (None, None), (None, None)]


def test_english_headings(spark):
    got = label(spark, "en", ["Section 5", "Sec. 12", "§ 164.102", "Section 12A", "PART I", "Title 45", "Chapter 2", "Subpart A", "Schedule 1", "Appendix A", "Whereas: the", "(1) No person", "(a) text", "plain sentence"])
    assert [g[0] for g in got] == ["article"] * 4 + ["part", "title", "chapter", "section", "annex", "annex", "recital", None, None, None]
    assert got[3][1] == "12a"


@pytest.mark.parametrize("profile,text,expected", [("it", "Art. 5 Definizioni", "article"), ("it", "1. Il titolare", "paragraph"), ("it", "a) i fornitori", "point"), ("it", "42", "noise"), ("it", "prosa", None), ("en", "(3A) Text", "paragraph"), ("en", "(iv) text", "point")])
def test_deterministic_labels(spark, profile, text, expected):
    df = spark.createDataFrame([(1, text, profile, False), (2, text, profile, True)], "block_id int, testo string, profile string, recovered_extra_candidate boolean")
    got = [r.sure for r in S.labelled(df).orderBy("block_id").collect()]
    assert got == [expected, None]


def headings(spark, rows):
    df = spark.createDataFrame([(page * 100 + order, "f", page * 100 + order, page, order, text, "it", False) for page, order, text in rows], "block_id int, file string, ordine int, page int, page_order int, testo string, profile string, recovered_extra_candidate boolean")
    flags = {r.block_id: r for r in S.heading_flags(S.prepared(df)).collect()}
    return {k for k, r in flags.items() if r.suppressed}, {k for k, r in flags.items() if r.downgraded}


def test_contents_page(spark):
    rows = [(1, k, f"Art. {k} Titolo") for k in range(1, 7)] + [(2, 0, "Art. 1 Titolo"), (2, 1, "corpo del testo")]
    assert headings(spark, rows)[0] == {101, 102, 103, 104, 105, 106}


def test_running_header(spark):
    rows = [x for p in (10, 11, 12, 13) for x in ((p, 0, "Art. 7 Titolo"), (p, 1, "corpo del testo"))]
    assert headings(spark, rows)[0] == {1100, 1200, 1300}


def test_bodiless_duplicate_and_clean(spark):
    assert headings(spark, [(1, 0, "Art. 5 Titolo"), (1, 1, "corpo"), (4, 0, "Art. 5 Titolo"), (4, 1, "Art. 9 Altro"), (4, 2, "corpo")])[0] == {400}
    assert headings(spark, [(1, 0, "Art. 1 Uno"), (1, 1, "corpo"), (9, 0, "Art. 2 Due"), (9, 1, "corpo")]) == (set(), set())
    assert headings(spark, [(1, 0, "Art. 3 Tre"), (5, 0, "Art. 3 Tre")])[0] == set()


def test_lower_case_continuation(spark):
    got = headings(spark, [(2, 0, "Art. 5 Definizioni"), (2, 1, "corpo"), (30, 5, "Art. 5 non si applica"), (30, 6, "corpo")])
    assert got == (set(), {3005})


def test_parents_equal_a_stack(spark):
    rng = random.Random(5)
    names = [*S.CONTAINERS, "content"]
    rows, expected = [], {}
    for f in range(6):
        stack = []
        for i in range(200):
            name = rng.choice(names)
            rows.append((f"f{f}", i, i // 7, i, name))
            if name in S.CONTAINERS:
                level = S.CONTAINERS[name]
                while stack and stack[-1][0] >= level:
                    stack.pop()
                expected[f"f{f}", i] = stack[-1][1] if stack else None
                stack.append((level, i))
    df = spark.createDataFrame(rows, "file string, seq bigint, _page int, block_id int, label string")
    got = {(r.file, r.seq): r.parent_seq for r in S.parents(df).collect()}
    assert got == expected


def brute_chunks(words, least=60, most=220):
    out, buffer = [], []
    for i, n in enumerate(words):
        if buffer and sum(words[j] for j in buffer) + n > most:
            out.append(buffer)
            buffer = []
        buffer.append(i)
        if sum(words[j] for j in buffer) >= most:
            out.append(buffer)
            buffer = []
    if buffer:
        total = sum(words[j] for j in buffer)
        if out and total < least and sum(words[j] for j in out[-1]) + total <= most:
            out[-1] += buffer
        else:
            out.append(buffer)
    return [k for k, group in enumerate(out) for _ in group]


def test_chunk_sizes():
    rng = random.Random(1)
    for _ in range(500):
        words = [rng.randint(1, 220) for _ in range(rng.randint(1, 30))]
        assert C.chunk_sizes(words) == brute_chunks(words)


def test_chunks_of_nodes(spark):
    rows = [("f", 0, 1, "content", "uno due", 0.5), ("f", 0, 2, "point", "tre", None), ("f", None, 0, "content", "w " * 500, 0.8), ("f", 9, 10, "content", None, None)]
    df = spark.createDataFrame(rows, "file string, owner_seq bigint, seq bigint, label string, testo string, label_confidence double")
    got = {(r.owner_seq, r.chunk_index): r for r in C.chunks(df).collect()}
    assert got[0, -1].text == "uno due\ntre" and got[0, -1].confidence == 0.5 and got[0, -1].labels == {"content": 1, "point": 1}
    assert [got[None, k].word_count for k in range(3)] == [220, 220, 140]
    assert got[9, -1].word_count == 0
    assert C.chunks(df.where("false")).count() == 0


def test_recital_fold(spark):
    df = spark.createDataFrame([([2, 1, 2, 9, 3, 6, 6, 5],), ([],)], "n array<int>")
    assert [r.k for r in df.select(C.accepted_recitals(F.col("n")).alias("k")).collect()] == [[1, 2, 3, 6, 6], []]


def test_label_tokens_and_confidence(spark):
    rows = [(1, "article", [("article", -0.02)]), (2, "unresolved", [("un", -0.1), ("resolved", -0.2)]), (3, "point", [("point", -5.0), (" ", -1.0), ("point", -0.3)]), (4, "part", [("pa", None), ("rt", -0.1)]), (5, "part", [("x", -0.1)])]
    df = spark.createDataFrame(rows, "id int, label string, tokens array<struct<token:string,logprob:double>>")
    got = {r.id: r.confidence for r in R.label_confidence(R.label_tokens(df, ["id"], "label", "tokens"), ["id"]).collect()}
    assert got[1] == pytest.approx(2.718281828**-0.02) and got[2] == pytest.approx(2.718281828**-0.15) and got[3] == pytest.approx(2.718281828**-0.3)
    assert got[4] is None and 5 not in got


def test_fuzzy_duplicates(spark):
    long = "il titolare del trattamento deve trasmettere la relazione annuale entro trenta giorni"
    rows = [("f", 1, 0, 0, 1, long, "deterministic"), ("f", 1, 1, 1, 2, long + "x", "accepted_slm"), ("f", 1, 2, 2, 3, "altro", None), ("f", 2, 0, 3, 4, long, None), ("f", 1, 3, 4, 5, "", None), ("f", 1, 4, 5, 6, "", None)]
    df = spark.createDataFrame(rows, "file string, page int, page_order int, ordine int, block_id int, _key string, review_status string")
    assert sorted(r.block_id for r in R.dedupe_fuzzy(df).collect()) == [2, 3, 4, 5, 6]


def test_classifier_failures_are_rows(spark):
    def model(texts):
        if "boom" in texts:
            raise RuntimeError
        return [("point", 0.95)] * len(texts)

    df = spark.createDataFrame([(1, "a"), (2, "boom")], "block_id bigint, norm string").coalesce(1)
    got = {r.block_id: (r.label, r.confidence) for r in R.classified(df, model, batch=1).collect()}
    assert got == {1: ("point", 0.95), 2: ("unresolved", None)}


@pytest.mark.parametrize("profile,text,expected", [
    ("it", "REGOLAMENTO (UE) 2024/1689 DEL PARLAMENTO", ("regolamento", "eu", "2024/1689")), ("it", "DIRETTIVA (UE) 2022/2555", ("direttiva", "eu", "2022/2555")),
    ("it", "DECRETO LEGISLATIVO 31 marzo 2023, n. 36", ("decreto-legislativo", "it", "36")), ("it", "DECRETO-LEGGE 2 marzo 2024, n. 19", ("decreto-legge", "it", "19")),
    ("it", "LEGGE 5 agosto 2022, n. 118", ("legge", "it", "118")), ("it", "COSTITUZIONE DELLA REPUBBLICA ITALIANA", ("costituzione", "it", None)),
    ("en", "Public Law 116-207", ("public-law", "us", "116-207")), ("en", "Executive Order 14028", ("executive-order", "us", "14028")), ("en", "45 CFR Part 164", ("cfr", "us", "45")),
    ("en", "Number 7 of 2018", ("act", "ie", "7")), ("en", "Data Protection Act 2018", ("act", "uk", "2018")), ("en", "Regulation (EU) 2016/679", ("regulation", "eu", "2016/679")),
])
def test_act_types(spark, profile, text, expected):
    row = spark.createDataFrame([(text, profile)], "t string, p string").select(E.act_type(F.col("t"), F.col("p")).alias("a")).first().a
    assert (row.subtype, row.country, row.number) == expected


def test_ids_and_xml(spark):
    rows = [("f", 0, 3, "chapter", "IV", None, "Capo IV"), ("f", 1, 5, "article", "1", "Uno", "Art. 1 Uno"), ("f", 2, None, "paragraph", None, None, "1. a < b"), ("f", 3, 5, "article", "1", None, "Art. 1"), ("f", 4, None, "content", None, None, None)]
    df = spark.createDataFrame(rows, "file string, seq bigint, level int, label string, number string, rubric string, testo string").withColumn("parent_seq", F.expr("case when seq in (1, 3) then 0L end"))
    ids = {r.seq: r.eid for r in E.element_ids(df.where("level is not null")).collect()}
    assert ids == {0: "chp_IV", 1: "chp_IV__art_1", 3: "chp_IV__art_1_2"}
    rows = [{"seq": r[1], "level": r[2], "label": r[3], "number": r[4], "rubric": r[5], "norm": r[6] or "", "parent_seq": 0 if r[1] in (1, 3) else None, "owner_seq": {2: 1, 4: 3}.get(r[1])} for r in rows]
    xml = AK.to_xml(AK.build(rows, "/akn/it/act/1970-01-01/f", "ita", "it"), "/akn/it/act/1970-01-01/f", "ita")
    from xml.dom.minidom import parseString

    found = [e.getAttribute("eId") for e in parseString(xml).getElementsByTagName("*") if e.getAttribute("eId")]
    assert found == ["chp_IV", "chp_IV__art_1", "chp_IV__art_1__para_1", "chp_IV__art_1_2"] and "a &lt; b" in xml


@pytest.mark.parametrize("text,parses", [(r'{"a": "\alpha"}', True), ('{"a": "x\\ny"}', True), ('{"a": "\\\\usepackage"}', True), (r'{"a": ["\\\usepackage"]}', True), ('{"a": ', False), (None, False)])
def test_json_repair(spark, text, parses):
    row = E.repaired_json(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert row.parses is parses
    if text in ('{"a": "x\\ny"}', '{"a": "\\\\usepackage"}'):
        assert row.repaired == text


def test_documents_of_both_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"blocks": [{"text": " x ", "page_index": 3}, {"text": "", "content": "y"}, {"testo": "  "}]}')
    (tmp_path / "b.json").write_text('[{"testo": "z"}]')
    (tmp_path / "c.json").write_text("{broken")
    got = sorted((r.file, r.ordine, r.page, r.page_order, r.testo) for r in read_documents(spark, str(tmp_path)).collect())
    assert got == [("a.json", 0, 3, 0, "x"), ("a.json", 1, None, 1, "y"), ("b.json", 0, None, 0, "z")]


def test_manifest(spark):
    inputs = spark.createDataFrame([("a", "s", "it"), ("b", "s", "it"), ("c", "s", "en")], "file string, signature string, profile string")
    done = spark.createDataFrame([("a", step, "s", "it") for step in ("language", "analysis", "classification", "review", "tree")] + [("b", "language", "s", "it"), ("b", "analysis", "s", "it"), ("b", "review", "s", "it"), ("c", "language", "s", "it"), ("c", "analysis", "s", "it")], "file string, step string, signature string, profile string")
    got = {}
    for r in pending_steps(inputs, done).collect():
        got.setdefault(r.file, set()).add(r.step)
    assert got == {"b": {"classification", "review", "tree"}, "c": {"analysis", "classification", "review", "tree"}}


def test_package_stands_without_the_subpackage():
    import pathlib
    import re

    root = pathlib.Path(S.__file__).parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts[:1]:
            assert not re.search(r"lexstrata\.llm|from \.+llm", f.read_text()), f


def test_chunks_of_long_nodes(spark, monkeypatch):
    import random

    rng = random.Random(4)

    def check(nodes):
        rows = [("f", owner, owner + 1 + n, "content", "w " * k, 0.5) for owner, words in nodes.items() for n, k in enumerate(words)]
        got = {}
        for r in C.chunks(spark.createDataFrame(rows, "file string, owner_seq bigint, seq bigint, label string, testo string, label_confidence double")).collect():
            assert (r.owner_seq, r.chunk_index) not in got
            got[r.owner_seq, r.chunk_index] = (r["items"], r.word_count)
        wanted = {}
        for owner, words in nodes.items():
            for n, (k, c) in enumerate(zip(words, [-1] * len(words) if sum(words) < 60 else brute_chunks(words))):
                items, total = wanted.get((owner, c), ([], 0))
                wanted[owner, c] = ([*items, owner + 1 + n], total + k)
        assert got == wanted

    check({0: [3] * 4_110, 10_000: [50, 100, 20]})
    monkeypatch.setattr(C, "SPAN", 7)
    ranges = [rng.choice(((1, 60), (0, 220), (0, 3), (0, 1), (200, 220))) for _ in range(60)]
    check({1_000 * i: [rng.randint(*r) for _ in range(rng.randint(1, 80))] for i, r in enumerate(ranges)})


def test_profiles_are_checked(tmp_path):
    import json

    good = P.PROFILES["it"].spec
    assert P.problems(good) == [] and P.problems({**good, "code": "Italiano!"}) and P.problems({k: v for k, v in good.items() if k != "acts"}) == ["acts is missing"]
    (tmp_path / "x.json").write_text(json.dumps({**good, "code": "xx"}))
    assert P.read_profile(tmp_path / "x.json").code == "xx"
    for text in (None, "{", json.dumps({**good, "divisions": {"chapterr": {"words": []}}})):
        if text is not None:
            (tmp_path / "y.json").write_text(text)
        with pytest.raises(P.ProfileError):
            P.read_profile(tmp_path / ("none.json" if text is None else "y.json"))
    assert P.digest(good) == P.digest(dict(reversed(good.items()))) == P.digest({**good, "_note": 1, "source": "x"}) != P.digest({**good, "code": "xx"})
    assert P.PROFILES["en"].convention("rubric") == "before" and P.PROFILES["it"].convention("foreign") is None


def test_suffix_aliases():
    assert P.suffix_aliases({"II": "Bis"}) == P.suffix_aliases([["ii", "bis"]]) == P.suffix_aliases([{"from": "II", "to": "bis"}]) == P.suffix_aliases(["ii -> bis", "junk", 5, ["a"]]) == {"ii": "bis"} and P.suffix_aliases(None) == {}


def test_paper_headings(spark):
    got = label(spark, "paper", ["Abstract", "3 Method", "3.1 Data sets", "3.1.2 Noise", "3 of them, and so on", "prose"])
    assert [g[0] for g in got] == ["chapter", "chapter", "section", "article", None, None] and got[2][1] == "3.1"


def test_numbers_with_two_suffixes_and_aliases(spark):
    assert label(spark, "it", ["Art. 5 bis ter", "Art. 5-bis"]) == [("article", "5-bister"), ("article", "5-bis")]
