"""Review queue, batch validation, findings and image gates (table operators)."""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions.expr import case, first_filled, text
from ..functions.fields import promote_url
from ..functions.quality import image_ad_filter, image_is_decorative, severity


def review_queue(df, flags="review_flags"):
    """Flagged items with severity, lowest overall confidence first (a range-partitioned sort)."""
    q = df.filter(F.size(flags) > 0).withColumn("severity", severity(flags))
    return q.orderBy(F.col("confidence.overall"), "item_id")


def review_meta(df, flags="review_flags"):
    """One row: total, flagged_count, high_severity."""
    on = F.size(flags) > 0
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(on).alias("flagged_count"), F.count_if(on & (severity(flags) == "high")).alias("high_severity"))


def review_candidates(df, limit, flags="review_flags", ties=("item_id", "doc_id")):
    """High and medium items, worst first, at most `limit` (a top-k report)."""
    q = df.withColumn("severity", severity(flags)).filter(F.col("severity").isin("high", "medium"))
    return q.orderBy(F.col("confidence.overall"), *[t for t in ties if t in df.columns]).limit(limit)


def validate_batch(items, image_meta, key="item_id"):
    """(key, issue): missing title / text / url, images that are missing or look like advertisements."""
    url = promote_url("url", "structured") if "structured" in items.columns else text("url")
    own = F.array_compact(F.array(F.when(text("title") == "", F.lit("missing_title")), F.when(text("raw_text") == "", F.lit("missing_raw_text")),
                                  F.when(first_filled(text("url"), F.try_element_at("structured", F.lit("原文链接"))) == "", F.lit("missing_url"))))
    rows = items.select(key, F.explode(own).alias("issue"))
    used = items.select(key, F.explode("images").alias("path"))
    meta = image_meta.dropDuplicates(["path"]).withColumn("_known", F.lit(True))
    name = F.substring_index("path", "/", -1)
    seen = used.join(meta, "path", "left").select(key, F.when(F.col("_known").isNull(), F.concat(F.lit("image_missing:"), name)).when(
        image_ad_filter("bytes", "width", "height"), F.concat(F.lit("image_ad_like:"), name)).alias("issue"))
    return rows.unionByName(seen.filter("issue IS NOT NULL"))


def findings_rollup(df, kinds=lx.FINDING_KINDS):
    """Per document: counts by kind, total, most frequent kind (first on ties), quality score."""
    n = [F.col(f"n_{k.lower()}") for k in kinds]
    g = df.groupBy("doc").agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k.lower()}") for k in kinds], F.count(F.lit(1)).alias("total"))
    top = F.greatest(*n)
    return g.withColumns({"top_kind": case([(c == top, k) for c, k in zip(n, kinds)]), "quality_score": F.greatest(F.lit(0), 100 - 5 * F.col("total"))})


def findings_top(df, limit=5, priority=lx.FINDING_PRIORITY):
    """First findings per document by kind priority; WindowGroupLimit keeps `limit` rows per group before the shuffle."""
    order = case([(F.col("kind") == k, v) for k, v in priority.items()], len(priority))
    w = W.partitionBy("doc").orderBy(order, "issue_id")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def field_coverage(df, fields, score, cuts):
    """One row: share of rows per filled field, and the score histogram between the cuts."""
    shares = [F.round(F.avg(cond.cast("int")), 6).alias(f"share_{k}") for k, cond in fields.items()]
    edges = [None, *cuts, None]
    bands = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        cond = reduce(lambda a, b: a & b, ([score >= lo] if lo is not None else []) + ([score < hi] if hi is not None else []))
        bands.append(F.count_if(cond).alias(f"band_{i}"))
    return df.agg(F.count(F.lit(1)).alias("total"), *shares, *bands)


def image_decorative_filter(df, key="item_id", order="pos", limit=3):
    """Content images of an item, at most `limit`; the first image when all are decorative."""
    bad = F.coalesce(image_is_decorative("bytes", "width", "height", "stddev"), F.lit(False))
    w = W.partitionBy(key).orderBy("_bad", order)
    ranked = df.withColumn("_bad", bad).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
    return ranked.filter(~F.col("_bad") | (F.col("_rn") == 1)).drop("_bad", "_rn")
