"""The composed tree and its XML on small documents."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from lexstrata.operators import akn as AK
from lexstrata.operators import structure as S
from lexstrata.operators import tree as TR


def decided(spark, texts, profile="it", records=None, types=None, zones=None):
    """Decisions of blocks; texts are (page, text)."""
    rows = [(i, "f", i, page, i, text, profile, False, (types or {}).get(i), (zones or {}).get(i), *(records or {}).get(i, (None, None))) for i, (page, text) in enumerate(texts)]
    df = spark.createDataFrame(rows, "block_id bigint, file string, ordine int, page int, page_order int, testo string, profile string, recovered_extra_candidate boolean, block_type string, document_zone string, etichetta string, review_status string")
    return TR.decided(S.prepared(df))


ACT = ["Comune di Prova", "Visto il regolamento vigente", "considerando quanto segue:", "(1) la prima ragione", "(2) la seconda ragione", "che va avanti", "HA ADOTTATO IL PRESENTE REGOLAMENTO", "Capo I", "disposizione del capo", "Art. 1", "Oggetto e scopo", "testo dell'articolo", "1. primo comma:", "a) lettera prima", "b) lettera seconda", "2. secondo comma", "Art. 2 Durata", "42", "Allegato I", "testo dell'allegato"]


def test_an_act(spark):
    d = decided(spark, [(1 + i // 8, t) for i, t in enumerate(ACT)])
    got = {r.seq: r for r in d.collect()}
    assert [got[i].decision for i in (3, 4, 7, 9, 16, 18)] == ["recital", "recital", "chapter", "article", "article", "annex"] and got[17].decision is None and got[17].reason == "noise"
    nodes, contents = TR.tree(d)
    node = {r.seq: r for r in nodes.collect()}
    owner = {r.seq: r.owner_seq for r in contents.collect()}
    assert {s: r.parent_seq for s, r in node.items()} == {3: None, 4: None, 7: None, 9: 7, 16: 7, 18: None}
    assert node[9].rubric == "Oggetto e scopo" and node[16].rubric == "Durata" and 10 not in owner
    assert owner[5] == 4 and owner[6] is None and owner[8] == 7 and owner[11] == owner[15] == 9 and owner[19] == 18 and owner[0] is None


def test_page_furniture_and_duplicates_stay_out_of_the_tree(spark):
    texts = [(1, f"Art. {k} Titolo") for k in range(1, 7)] + [(2, "Art. 1 Titolo"), (2, "corpo del testo")] + [x for p in (10, 11, 12) for x in ((p, "Capo III"), (p, "corpo"))]
    got = {r.seq: (r.decision, r.reason) for r in decided(spark, texts).withColumn("page_order", F.lit(0)).collect()}
    assert all(got[i] == (None, "suppressed") for i in range(6)) and got[6][0] == "article"


def test_records_and_statuses(spark):
    texts = [(1, "Art. 1 Oggetto"), (1, "testo normale"), (1, "altro testo"), (1, "terzo testo"), (1, "Art. 5 si applica")]
    got = {r.seq: (r.own, r.decision, r.reason) for r in decided(spark, texts, records={1: ("article", "accepted_slm"), 2: ("point", "pending_llm_review"), 3: ("banana", "accepted_slm"), 4: ("unresolved", "llm_reviewed")}).collect()}
    assert got[0][1] == "article" and got[1] == ("article", "content", "no_header_for_article") and got[2][1:] == (None, "review_missing") and got[3] == ("banana", "content", "unknown_label") and got[4][1:] == (None, "review_missing")


def test_recital_sequence_and_footnotes(spark):
    texts = [(1, "considerando quanto segue:"), (1, "(1) prima"), (1, "(9) salta"), (1, "(3) terza"), (2, "Art. 1 Oggetto"), (2, "(2) nota GU L 1, pag. 3")]
    d = decided(spark, texts)
    reasons = {r.seq: (r.decision, r.reason) for r in d.collect()}
    assert reasons[1][0] == "recital" and reasons[3][0] == "recital"
    # after the first article a numbered text with citations is a note
    assert reasons[5] == (None, "noise")


def test_rubrics_before_and_foreign_texts_in_english(spark):
    texts = [(1, "Citation and commencement"), (1, ""), (1, "Section 5"), (1, "(1) This Act may be cited."), (1, "les dispositions de cette loi sont également conformément aux règles")]
    d = decided(spark, texts, profile="en", types={0: "heading"})
    got = {r.seq: (r.decision, r.reason, r.rubric) for r in d.collect()}
    assert got[0][:2] == (None, "rubric") and got[2] == ("article", None, "Citation and commencement") and got[4][:2] == (None, "foreign") and got[1][1] == "empty"


def test_parts_inside_an_annex(spark):
    got = {r.seq: (r.decision, r.reason) for r in decided(spark, [(1, "Parte I"), (1, "testo"), (2, "Allegato II"), (2, "Parte II"), (2, "testo"), (3, "Parte PRIMA Disposizioni generali comuni"), (3, "Parte III")]).collect()}
    assert got[0][0] == "part" and got[3] == ("content", "part_of_annex") and got[5][0] == "part" and got[6][0] == "part"


def test_xml(spark):
    nodes, contents = TR.tree(decided(spark, [(1 + i // 8, t) for i, t in enumerate(ACT)]))
    columns = ("file", "profile", "seq", "label", "level", "number", "rubric", "norm", "parent_seq", "owner_seq")
    every = nodes.withColumn("owner_seq", F.lit(None).cast("bigint")).select(*columns).unionByName(contents.withColumns({"level": F.lit(None).cast("int"), "parent_seq": F.lit(None).cast("bigint")}).select(*columns))
    r = AK.documents(every.withColumns({"uri": F.lit("/akn/it/act/2024-01-01/atto_prova"), "language": F.lit("ita")})).first()
    root = ET.fromstring(r.xml.encode())
    ns = "{" + AK.NAMESPACE + "}"
    assert r.valid and [c.tag.removeprefix(ns) for c in root[0]] == ["meta", "preface", "preamble", "body", "attachments"]
    ids = [e.get("eId") for e in root.iter() if e.get("eId")]
    assert ids == ["citation_1", "rec_1", "rec_2", "chp_I", "chp_I__art_1", "chp_I__art_1__para_1", "chp_I__art_1__para_1__point_a", "chp_I__art_1__para_1__point_b", "chp_I__art_1__para_2", "chp_I__art_2", "att_I"]
    article = next(e for e in root.iter(f"{ns}article"))
    assert [c.tag.removeprefix(ns) for c in article] == ["num", "heading", "intro", "paragraph", "paragraph"] and article.find(f"{ns}heading").text == "Oggetto e scopo"
    assert "lettera seconda" in ET.tostring(article, encoding="unicode")


def test_repeated_and_missing_headings():
    def row(seq, label, level, number, norm, parent=None, owner=None):
        return {"seq": seq, "label": label, "level": level, "number": number, "rubric": None, "norm": norm, "parent_seq": parent, "owner_seq": owner}

    act = AK.build([row(0, "article", 5, "1", "Art. 1"), row(1, "article", 5, "1", "Art. 1")], "/u", "ita", "it")
    assert [e.eid for e in act.walk() if e.tag == "article"] == ["art_1", "art_1_2"] and AK.check(act)["valid"]
    act = AK.build([row(0, "content", None, None, "solo testo")], "/u", "ita", "it")
    assert [c.tag for c in act.children] == ["meta", "body"] and act.children[1].children[0].attrs == {"name": "content"} and act.children[1].children[0].content == ["solo testo"]
