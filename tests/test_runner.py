"""Configuration, steps, phases, resuming, sinks and invalid documents."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lexstrata import runner
from lexstrata.operators import analysis as A
from lexstrata.operators.manifest import STEPS
from lexstrata.sources import sinks
from lexstrata.sources.blocks import documents_at, invalid_documents, read_documents


def test_config():
    assert runner.load_config({}) == runner.Config() and runner.load_config({"LEXSTRATA_REVIEW": "no", "LEXSTRATA_RETRIES": "5"}, retries=7) == runner.Config(review=False, retries=7)
    with pytest.raises(ValueError, match="LEXSTRATA_ACCEPT_ABOVE"):
        runner.load_config({"LEXSTRATA_ACCEPT_ABOVE": "much"})


def test_steps_and_phases():
    assert runner.step_names(["f2", "F1"]) == ["analysis", "classification", "review", "tree"] and runner.selected(first="review") == ["review", "tree"] and runner.selected(["all"], skip=["f0"]) == list(STEPS[1:])
    with pytest.raises(ValueError, match="f9"):
        runner.step_names(["f9"])
    assert [p[:2] for p in runner.phases(["analysis", "tree"])] == [("analysis", "analysis"), ("analysis", "embeddings"), ("tree", "tree")]


def test_phase_first_and_resume(spark):
    inputs = spark.createDataFrame([("a", "1", "it"), ("b", "1", "en")], "file string, signature string, profile string")
    done = spark.createDataFrame([("a", s, "1", "it") for s in STEPS] + [("b", s, "1", "it") for s in STEPS], "file string, step string, signature string, profile string")
    events = []
    work = {s: (lambda files, stage, s=s: events.append((s, stage, sorted(r.file for r in files.collect())))) for s in STEPS}
    # the profile of b has changed: all but the language step has to run again, phase by phase
    assert runner.run(inputs, done, work) == [("analysis", "analysis", 1), ("analysis", "embeddings", 1), ("classification", "classification", 1), ("review", "review", 1), ("tree", "tree", 1)]
    assert events[0] == ("analysis", "analysis", ["b"])
    events.clear()
    assert [x[2] for x in runner.run(inputs, done, work, steps=("language", "tree"), force=True)] == [2, 2] and [e[0] for e in events] == ["language", "tree"]


def test_documents_and_sinks(spark, tmp_path):
    docs = tmp_path / "in"
    docs.mkdir()
    (docs / "b.json").write_text(json.dumps({"blocks": [{"text": "Art. 1 Oggetto"}, {"content": "  "}, {"testo": "corpo è"}]}))
    (docs / "a.json").write_text("{broken")
    (docs / "c.json").write_text("")
    assert [p.rsplit("/", 1)[1] for p in documents_at(spark, str(docs))] == ["a.json", "b.json", "c.json"]
    for path, glob in ((str(tmp_path / "none"), "*"), (str(docs), "*.xml")):
        with pytest.raises(FileNotFoundError):
            documents_at(spark, path, glob)
    assert sorted(r.file for r in invalid_documents(spark, str(docs)).collect()) == ["a.json", "c.json"] and read_documents(spark, str(docs)).count() == 2
    assert runner.main([str(docs), "--output", str(tmp_path / "out")], spark) == 0
    got = spark.read.json(str(tmp_path / "out/blocks"))
    assert sorted((r.label, r.testo) for r in got.collect()) == [("article", "Art. 1 Oggetto"), ("content", "corpo è")]
    sinks.write_report(tmp_path / "r/x.json", {"è": [1]})
    assert (tmp_path / "r/x.json").read_text() == '{\n  "è": [\n    1\n  ]\n}\n'
    xml = spark.createDataFrame([("a b.json", "<x>è</x>"), ("c", None)], "file string, xml string")
    assert sorted((r.file, r.bytes) for r in sinks.write_xml_files(xml, str(tmp_path / "xml")).collect()) == [("a b.json", 9), ("c", 0)] and (tmp_path / "xml/a_b.json.xml").read_text() == "<x>è</x>"
    sinks.write_vectors(spark.createDataFrame([("ab",), (None,)], "text string"), str(tmp_path / "v"), lambda ts: [[3.0 * len(t), 4.0 * len(t)] for t in ts])
    assert sorted([round(x, 2) for x in r.embedding] for r in spark.read.parquet(str(tmp_path / "v")).collect()) == [[0.0, 0.0], [0.6, 0.8]]
    sinks.write_states(spark.createDataFrame([("deterministic",), ("llm_reviewed",), (None,)], "review_status string"), str(tmp_path / "s"))
    assert sorted(r.state for r in spark.read.parquet(str(tmp_path / "s")).select("state").collect()) == ["accepted", "failed", "reviewed"]
    one = spark.createDataFrame([("f", 1)], "file string, n int")
    sinks.write_artefacts(str(tmp_path / "art"), one, one, one, one, xml, one)
    assert spark.read.json(str(tmp_path / "art/tree/nodes")).count() == 1 and spark.read.parquet(str(tmp_path / "art/xml")).count() == 2


def test_answers():
    assert A.first_json('```json\n{"a": {"b": 1}} rest\n```') == ({"a": {"b": 1}}, "rest") and A.first_json("no {x} json") == (None, "no {x} json") and A.first_json(None) == (None, "")
    assert A.verdicts_of('x {"verdicts": [{"id": 1, "label": "Article "}, {"id": "2", "label": "bogus"}, {"id": 9, "label": "point"}, 3]}', {1, 2}, {"article", "point"}) == {1: "article"}


def test_missing_verdicts_are_asked_for_again():
    asked = []

    def ask(ids):
        asked.append(list(ids))
        if len(ids) > 4:
            raise ValueError("broken answer")
        return {i: "point" for i in ids[:1] if i != 7}

    found = A.ask_again(list(range(8)), ask)
    assert set(found) == set(range(7)) and asked[0] == list(range(8)) and asked[1] == [0, 1, 2, 3] and [7] in asked


def test_reviewed_batches_and_language(spark):
    low = spark.createDataFrame([("f", 0, 1, "a"), ("f", 0, 2, "b"), ("f", 1, 3, "c")], "file string, batch bigint, review_id bigint, norm string")
    got = A.reviewed_batches(low, lambda rows: json.dumps({"verdicts": [{"id": i, "label": "point"} for i, t in rows if t != "b"]}))
    assert sorted((r.review_id, r.label) for r in got.collect()) == [(1, "point"), (3, "point")]
    samples = spark.createDataFrame([("f", "x", "it", 0.3), ("g", "y", None, 0.0)], "file string, text string, hint_code string, hint_score double")
    assert sorted((r.file, r.code, r.agrees) for r in A.detected_language(samples, lambda t: "en").collect()) == [("f", "en", False), ("g", "en", True)]
    assert [r.code for r in A.detected_language(samples).orderBy("file").collect()] == ["it", None]
