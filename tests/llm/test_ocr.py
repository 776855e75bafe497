"""Scanned pages: trie retrieval, furniture, hyphens, misreadings, continuation."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lexstrata.llm import ocr
from lexstrata.llm.ocr import STRETCH, Suspects, Trie, analysed, explained, header_key, kinds, numeral, page_value, paragraphs, word_filter


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def test_trie_retrieves_all_candidates():
    rng = random.Random(1)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(2, 8))): i for i in range(400)}
    trie = Trie(words)
    for _ in range(60):
        q = "".join(rng.choice("abcde") for _ in range(rng.randint(2, 8)))
        for k in (0, 1, 2):
            assert sorted(trie.within(q, k)) == sorted((w, n) for w, n in words.items() if distance(w, q) <= k)


def test_edits_of_confusions_lose_no_candidate():
    rng = random.Random(2)
    words = {"".join(rng.choice("rnmcldeohiu") for _ in range(rng.randint(2, 7))): rng.randint(1, 20) for _ in range(600)}
    trie = Trie(words)
    for _ in range(80):
        q = "".join(rng.choice("rnmcldeoh10") for _ in range(rng.randint(2, 7)))
        every = {(w, n) for w, n in words.items() if n >= 5 and distance(w, q) <= 2 and explained(w, q)}
        assert every == {(w, n) for w, n in trie.within(q, 2, 5, any_edit=False) if explained(w, q)}


def test_confusions():
    assert explained("solidarity", "soliclarity") == ("d~cl",) and explained("giorni", "giomi") == ("rn~m",) and explained("qualità", "qua1i+à") == ("l~1", "t~+")
    assert explained("medico", "medica") is None and explained("casa", "casa") == ()
    assert numeral("2O1l") == "2011" and numeral("10") is None and numeral("lO") is None


def test_page_numbers_and_keys():
    assert page_value("- 12 -") == (12, True) and page_value("12") == (12, False) and page_value("iv") == (4, True) and page_value("Pag. l di 4") == (1, True) and page_value("3/9") == (3, True)
    assert page_value("12 %") is None and page_value("n. 12 Casa") is None
    assert header_key("Gazzetta Locale – 7", 7, False) == header_key("7 GAZZETTA L0CALE", 7, False) and header_key("Art. 5 Definizioni", 5, True) is None
    assert header_key("Supplemento vy.", 1, False)[1] and header_key("Testata " * 40, 1, False)[1] and not header_key("Testata", 1, False)[1] and header_key("città vera", 1, False) == header_key("citta yera", 1, False)


NAMES = ["zero", "alfa", "bravo", "delta", "golf", "kilo", "lima"]
SENTENCE = "il consorzio dei prodotti lattieri garantisce la procedura della qualità comunale secondo le modalità previste"


def blocks(spark):
    rows, n = [], 0

    def add(file, page, text):
        nonlocal n
        rows.append((n, file, n, page, text))
        n += 1

    for p in range(1, 7):
        add("f", p, f"GAZZETTA LOCALE DI PROVA – {p}")
        for k in range(3):
            add("f", p, SENTENCE.capitalize() + f" {NAMES[p]} {'uvw'[k]}.")
        if p == 2:
            add("f", p, "Il comitato tecnico-scientifico approva la relazi-\none annuale del consorzio.")
            add("f", p, "Il comitato tecnico-\nscientifico approva la relazione annuale.")
            add("f", p, "La proccdura della qua1ità comunale.")
            add("f", p, "Il comitato approva la rela-")
        elif p == 3:
            rows[-3] = (*rows[-3][:4], "zione annuale del consorzio.")
            add("f", p, "Il consorzio approva la")
        elif p == 4:
            rows[-3] = (*rows[-3][:4], "procedura annuale.")
        add("f", p, f"- {p} -")
    add("f", None, "7")
    add("f", 7, None)
    add("f", 7, "")
    for p in range(1, 7):
        add("h", p, "Prima riga")
        add("h", p, "Seconda riga del testo, che finisce.")
        add("h", p, "Una riga ripetuta in mezzo")
        add("h", p, "Quarta riga del testo, che finisce.")
        add("h", p, "Quinta riga del testo, che finisce.")
    for _ in range(30):
        add("g", 1, SENTENCE + ". La relazione annuale, il tecnico-scientifico.")
    df = spark.createDataFrame(rows, "block_id bigint, file string, ordine int, page int, testo string").withColumn("page_order", F.col("ordine"))
    return df.union(df.where("block_id < 3")).withColumn("kind", F.lit("x")).withColumn("head", F.lit("x")), rows


def test_kinds_and_paragraphs(spark):
    df, rows = blocks(spark)
    text = {r[0]: r[4] for r in rows}
    got = [(text[r.block_id], r.kind) for r in kinds(analysed(df)[0]).collect()]
    by = {}
    for t, k in got:
        by.setdefault(k, []).append(t)
    assert sorted(t for t in by["header"] if "riga" not in t) == [f"GAZZETTA LOCALE DI PROVA – {p}" for p in range(1, 7)]
    assert "Una riga ripetuta in mezzo" not in by["header"] and "Prima riga" in by["header"]
    assert sorted(by["page_number"]) == [f"- {p} -" for p in range(1, 7)] + ["7"]
    assert sorted(by["hyphen"]) == ["Il comitato approva la rela-", "Il comitato tecnico-scientifico approva la relazi-\none annuale del consorzio."]
    assert by["misread"] == ["La proccdura della qua1ità comunale."]
    assert sorted(by["continued"]) == ["procedura annuale.", "zione annuale del consorzio."]
    texts = {r.text for r in paragraphs(df).where("file = 'f'").collect()}
    assert "Il comitato approva la relazione annuale del consorzio." in texts and "Il consorzio approva la procedura annuale." in texts
    assert "La procedura della qualità comunale." in texts and "Il comitato tecnico-scientifico approva la relazione annuale." in texts
    assert kinds(analysed(df.where("false"))[0]).count() == 0


def test_filter_has_every_word_and_a_fixed_size(spark):
    words = [f"parola{i}" for i in range(3000)] + ["èa", "ß"]
    bits = word_filter(spark.createDataFrame([(w,) for w in words], "word string"))
    held = Suspects(bits)
    assert len(bits) == ocr.FILTER_BITS // 8 and all(held.held(w) for w in words)
    assert sum(held.held(f"altra{i}") for i in range(3000)) < 30 and held("ÈA") == "èa" and held("pArola1") is None


def test_paragraphs_and_furniture_reach_over_stretches(spark):
    # one paragraph goes on over three stretches of pages of one block each, with a running header on every page
    n = 3 * STRETCH
    rows = [(2 * i + k, "f", 2 * i + k, i + 1, "Bollettino di prova" if k == 0 else f"pezzo {i} della stessa frase che") for i in range(n) for k in range(2)]
    rows = [r if r[0] != 1 else (*r[:4], "Primo pezzo della stessa frase che") for r in rows]
    df = spark.createDataFrame(rows, "block_id bigint, file string, ordine int, page int, testo string").withColumn("page_order", F.col("ordine"))
    got = {r["head"]: r["blocks"] for r in paragraphs(df).collect()}
    assert sorted(got) == [1] and got[1] == [2 * i + 1 for i in range(n)]


def test_neighbours_rank_candidates(spark):
    # "casc" may be "case" or, with another confusion, "cosc"; only the words beside it tell "fine" from "fina" in "fin@"
    good = ["alla fina merce"] * 40 + ["senza fine alcuna"] * 60
    rows = [(i, "f", i, 1, t) for i, t in enumerate([*good, "alla fin@ merce", "senza fin@ alcuna", "una sola fin@"])]
    df = spark.createDataFrame(rows, "block_id bigint, file string, ordine int, page int, testo string").withColumn("page_order", F.col("ordine"))
    from lexstrata.functions.runtime import written

    counts = written(ocr.word_counts(df), "w")
    found = spark.createDataFrame([("fin@", "fina", 40, ["a~@"]), ("fin@", "fine", 60, ["e~@"])], "word string, good string, m bigint, ways array<string>")
    assert {r.good for r in ocr.candidates(counts).where("word = 'fin@'").collect()} == {"fina"}
    fixes = {r.block_id: [x["good"] for x in r.fixes] for r in ocr.ranked_corrections(df, found, word_filter(found)).collect()}
    assert fixes == {100: ["fina"], 101: ["fine"], 102: ["fina"]} or fixes == {100: ["fina"], 101: ["fine"], 102: ["fine"]}


def test_short_words_are_corrected(spark):
    rows = [(i, "f", i, 1, "il testo dell'atto del comune") for i in range(100)] + [(200, "f", 200, 1, "il testo dcl comune"), (201, "f", 201, 1, "il testo (444/DCL) del comune")]
    df = spark.createDataFrame(rows, "block_id bigint, file string, ordine int, page int, testo string").withColumn("page_order", F.col("ordine"))
    assert [(r.block_id, r.kind) for r in kinds(analysed(df)[0]).where("kind = 'misread'").collect()] == [(200, "misread")]
