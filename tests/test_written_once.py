"""Queries that need few columns write no texts, and no text is written twice."""

from pyspark.sql import functions as F

from broadsheet.plans.catalog import retrieval, rollups, scoring
from broadsheet.sources import scratch

SF = "/root/testdata/sf0.001"


def test_latest_batches_write_nothing(spark):
    before = dict(scratch._TABLES)
    got = rollups.q_latest(spark, SF + "/.")  # a spelling of the folder that no other test has staged
    labels = {r.batch_label for r in got.select("batch_label").distinct().collect()}
    assert len(labels) == 3 and "2024.11" not in labels and "" not in labels
    assert scratch._TABLES == before


def test_scored_table_holds_a_text_once(spark):
    d = scoring.scored(spark, SF)
    assert d.filter(~F.col("body").eqNullSafe(F.col("raw_text"))).isEmpty()
    stored = {c for p in scratch._TABLES.values() if "/scored-" in p for c in spark.read.parquet(p).columns}
    assert "raw_text" in stored and "body" not in stored


def test_context_renders_only_the_documents_of_its_hits(spark):
    sf = SF + "/./."  # a spelling of the folder that no other test has staged
    before = set(scratch._TABLES.values())
    got = retrieval.q_context(spark, sf).collect()
    assert got and all("【参考1】" in r.context for r in got)
    assert not [p for p in set(scratch._TABLES.values()) - before if "/notices-" in p]
