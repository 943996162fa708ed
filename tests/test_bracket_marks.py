"""Bracket marks on texts with brackets of their own, and on texts of which nothing is left."""

import duckdb
import pytest
from pyspark.sql import functions as F

from broadsheet.functions import text as tx
from broadsheet.plans.catalog import texts

ODD = ["a and b", "Copyright [yyyy] [name of owner] and more", "open [ and closed ] and", "[1] x", "[注] y", "[；注]", " and ", "  ", "", None, "　[图]", " and  and ", "a[b\nc]d and e", "[x\ry] z", "[", "]["]


def test_marks_as_in_the_sql(spark, tmp_path):
    n = list(enumerate(ODD))
    spark.createDataFrame(n, "doc_id long, text string").selectExpr("*", "'src1' AS source", "'en' AS lang", "length(text) AS n_chars").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    query, sql = texts.ENTRIES["strip_bracket_marks"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, out FROM ({sql}) ORDER BY doc_id").fetchall()
    assert [(r.doc_id, r.out) for r in query(spark, str(tmp_path)).orderBy("doc_id").collect()] == want


@pytest.mark.parametrize("x,out", [("[图]a [b] c", "a  c"), ("[x\ry] z", "z"), ("[a\nb] [c]", "[a\nb]"), ("[图]", "[图]")])
def test_any_mark_inside_a_line(spark, x, out):
    assert spark.range(1).select(tx.strip_bracket_marks(F.lit(x)).alias("o")).first().o == out
