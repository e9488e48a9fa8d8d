"""Whole runs over a small folder."""

import json

import pytest

from textloom.plans import jobs

TEXT = "this is one long enough text about the town by the sea and its many people who live there"


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    rows = [{"text": TEXT, "url": "http://a.com/"}, {"text": TEXT + " now", "url": "http://a.com"}, {"text": "Otro texto. Con dos frases.", "url": "http://b.com"}, {"text": ""}]
    (d / "uno.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
    (d / "uno_b.jsonl").write_text(json.dumps({"sentence": "Una sola frase.", "url": "http://b.com/x"}) + "\n")
    return str(d)


def test_minhash_run(spark, raw, tmp_path):
    jobs.main(["minhash", raw, str(tmp_path / "o"), "--details"])
    r = spark.read.json(str(tmp_path / "o/report")).first()
    assert (r.total_docs, r.verified_docs, r.verified_pairs) == (4, 2, 1) and r.candidate_docs >= 2 and r.duration_minutes >= 0
    flagged = spark.read.json(str(tmp_path / "o/corpora"))
    assert {x.id for x in flagged.where("duplicate.minhash.has_duplicate").collect()} == {"uno_0", "uno_1"} and flagged.count() == 5
    assert {(x.id, tuple(x.dup_ids)) for x in spark.read.json(str(tmp_path / "o/duplicates")).collect()} == {("uno_0", ("uno_1",)), ("uno_1", ("uno_0",))}
    by_id = {x.id: x.shingles for x in spark.read.json(str(tmp_path / "o/shingles")).collect()}
    assert len(by_id) == 4 and by_id["uno_0"][0] == "this is one long enough" and len(by_id["uno_1"]) == len(by_id["uno_0"]) + 1
    assert spark.read.json(str(tmp_path / "o/snapshot")).count() == 5
    assert spark.read.json(str(tmp_path / "o/duplicate_details")).where("id_text <> dup_text").count() == 2


def test_other_runs(spark, raw, tmp_path):
    for name in ("heuristics", "url_dedup", "url_check", "word_frequency"):
        jobs.RUNS[name](spark, raw, str(tmp_path / name))
    report = {r.corpus: r for r in spark.read.json(str(tmp_path / "heuristics/doc_report")).collect()}
    assert report["uno"].documents_count == 3 and report["uno"].document_metrics.max_sentences_per_document == 2 and report["uno_b"].documents_count == 1
    assert spark.read.json(str(tmp_path / "heuristics/processed")).count() == 5
    assert spark.read.json(str(tmp_path / "url_dedup/report")).first().duplicate_groups == 1
    assert [r.corpus for r in spark.read.json(str(tmp_path / "url_check/url_dedup_ignore_corpora")).collect()] == []
    assert spark.read.json(str(tmp_path / "word_frequency/word_frequency")).count() > 5
