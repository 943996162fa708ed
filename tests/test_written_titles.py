"""Matching by titles writes the titles, not the texts they come from."""

from broadsheet.plans.catalog import dedup
from broadsheet.sources import scratch


def test_match_writes_no_texts(spark, monkeypatch):
    written = []
    def once(session, key, build):
        written.append(build().columns)
        return build()
    monkeypatch.setattr(scratch, "stage_once", once)
    monkeypatch.setattr(dedup.sm, "match_original", lambda q, o, *a: q.selectExpr("qid", "1 AS step", "qid AS ord"))
    assert dedup.q_match(spark, "/root/testdata/sf0.001").columns == ["qid", "step", "ord"]
    assert written == [["doc_id", "lang", "source", "headline"]]
