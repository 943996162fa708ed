"""Connected components of an edge table by alternating large and small stars, all as joins and aggregates."""

from pyspark.sql import functions as F

from .frames import written


def connected(edges, name="components"):
    """(node, root) for every node of edges(a, b); root is the least node of its component.

    Each step keeps the components and never has more edges than nodes and edges before; the loop ends when a whole
    round changes nothing. Steps are written, so that a round never depends on earlier executors."""
    def large(e):
        both = e.union(e.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        return both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()

    def small(e):
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        links = down.join(least.withColumnRenamed("a", "n"), F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return links.union(least.toDF("a", "b")).where("a <> b").distinct()

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = written(edges.select("a", "b").where("a <> b").distinct(), name)
    before = state(now)
    while before[0]:
        now = written(small(large(now)), name)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
