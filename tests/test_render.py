"""The rendering of documents as bulletins against the same chain of replacements as Spark expressions."""

from functools import reduce

from pyspark.sql import functions as F

from broadsheet.plans.catalog import base


def test_rendered_as_by_the_chain_of_expressions(spark):
    d = base.table(spark, "/root/testdata/sf0.001", "documents").select("text")
    words = "".join(w for w, _ in base.PHRASES)
    d = d.unionByName(spark.createDataFrame([(None,), ("",), (words,), (" of of of to  to ",), ("é\nThe \nThe . , ",)], "text string"))
    chain = reduce(lambda e, p: F.replace(e, F.lit(p[0]), F.lit(p[1])), base.PHRASES, F.col("text"))
    both = d.select(base.render(F.col("text")).alias("a"), chain.alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()


def test_the_whole_chain_is_one_pass(spark):
    d = spark.createDataFrame([("x",)], "text string").select(base.render(F.col("text")).alias("body"))
    plan = d._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "replace(" not in plan and plan.count("arrow") >= 1
