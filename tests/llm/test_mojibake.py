"""Chains: exact round trips, held-out detection, clean traps."""

from __future__ import annotations

import pytest

from lexstrata.llm.mojibake import CHAINS, ChainClassifier, find_garbled, garble, invert

CLEAN = [
    "Con le stesse modalità, la perizia può sospendere la facoltà dell’attività – è già così (città però).", "L’arrêté municipal vérifie périodiquement les déchets de la pêche côtière à l’échéance.",
    "Für die Zwecke dieses Kapitels überprüft regelmäßig die zuständige Behörde die Gebührenordnung.", "La instrucción previa señala íntegramente la garantía según el capítulo; está en montaña.",
    "A autoridade não pode alterar a caução; funções, inspeção, província, património, após três meses.", "The “authority’s” clause — up to € 500 — naïve.",
]


@pytest.fixture(scope="module")
def model():
    return ChainClassifier.fit(CLEAN * 30)


@pytest.mark.parametrize("chain", CHAINS)
def test_round_trip(chain):
    for text in CLEAN:
        for word in text.split(" "):
            spoiled = garble(word, chain)
            if spoiled is not None:
                assert invert(spoiled, chain) == word


@pytest.mark.parametrize("chain", CHAINS)
def test_finds_and_restores(model, chain):
    found = changed = 0
    for text in CLEAN:
        spoiled = " ".join(garble(w, chain) or w for w in text.split(" "))
        hit = model.repair(spoiled)
        changed += spoiled != text
        if spoiled != text and hit:
            found += 1
            assert hit[1]
            same = sum(a == b for a, b in zip(hit[2].split(" "), text.split(" ")))
            assert same >= 0.9 * len(text.split(" "))
    assert changed >= 3 and found >= changed - 2  # some chains leave a text with one changed mark, too little to tell


@pytest.mark.parametrize("text", [*CLEAN, "SÃO JOÃO – CÂMARA – NAÇÃO – À L’ÂGE", "Přílohův a Łęgodź, Žlutůva č. 7", "(Πρωτόκολλο 12)", "日本語 条文 第3条", "✓ ✗ → ≥ 10 % ½ m²", "", "   ", "plain ascii"])
def test_clean_stays(model, text):
    assert model.repair(text) is None


def test_operator(spark):
    rows = [(i, t) for i, t in enumerate(CLEAN * 30)] + [(900, garble(CLEAN[0], "utf8>cp1252")), (900, garble(CLEAN[0], "utf8>cp1252")), (901, "perso �"), (902, None), (903, ""), (904, "x" * 200_000 + " perÃ² cittÃ\xa0 puÃ²")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as chain", "'x' as restored")
    got = find_garbled(df).collect()
    assert sorted(r.doc_id for r in got) == [900, 900, 901, 904]
    by = {r.doc_id: r for r in got}
    assert by[900].restored == CLEAN[0] and by[901].recovered is False and by[901].chain.startswith("lost") and by[901].restored is None and by[904].restored.endswith("però città può")
    assert find_garbled(df.where("false")).count() == 0


def test_every_passage_has_its_own_chain(model):
    plain = " ".join(["testo semplice senza segni"] * 6)
    parts = [garble(CLEAN[0], "utf8>cp1252"), garble(CLEAN[2], "utf8>cp437"), "perso � qui �a"]
    chains, whole, text = model.repair(f" {plain} ".join(parts))
    assert {"utf8>cp1252", "utf8>cp437"} < set(chains.split(", ")) and not whole and "lost" in chains
    assert CLEAN[0] in text and CLEAN[2] in text and "�" in text


def test_words_that_clean_records_lack_are_learned_from_restored_ones():
    base = ["The board shall “review” the rules – as set out here."] * 60
    chains = ["utf8>cp1252", "utf8>cp437", "utf8>mac_roman"]
    spoiled = [garble("The clause is naïve.", c) for c in chains * 4]
    assert ChainClassifier.fit(base + spoiled).repair(garble("The clause is naïve.", "cp1252>cp1251"))[0].startswith("cp1252>cp1251")
