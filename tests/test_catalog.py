"""Catalogue queries against their SQL at sf0.001 (CATALOG=all for every query)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from broadsheet.plans import catalog
from checks import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SAMPLE = ["classify_3tier", "resolve_bank", "score_items", "merge_by_title_key", "near_dup_merge", "segment_topics", "bm25_search", "category_counts", "headings_to_items", "stream_weekly_counts", "html_pages_to_text"]
QUERIES, SQL = entry.queries(), entry.oracle_sql()
NAMES = [n for n in (QUERIES if os.environ.get("CATALOG") == "all" else SAMPLE) if n in SQL]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_catalogue_shape():
    queries, sql = catalog.load()
    assert len(queries) > 200 and set(sql) <= set(queries) and len(queries) - len(sql) < 6
    assert set(queries) <= set(QUERIES) and set(sql) <= set(SQL) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
