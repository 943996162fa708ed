"""Lookup and join queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...operators import dedup as dd
from ...operators import joins as jn
from .base import notices, q, sql_list, sql_over_notices, table


def items(spark, sf):
    return notices(spark, sf).select(F.col("doc_id").cast("string").alias("item_id"), "title", "url", "source", "lang", "images", "n_chars",
                                     F.when(F.col("n_chars") % 3 == 0, "新卡").when(F.col("n_chars") % 3 == 1, "活动").otherwise("公告").alias("category"), F.col("source").alias("bank"), F.array(F.lit("e0")).alias("evidence"))


CAT3 = "CASE n_chars % 3 WHEN 0 THEN '新卡' WHEN 1 THEN '活动' ELSE '公告' END"


def q_enrich(spark, sf):
    """Quality labels as score rows: matched by id where labelled, else by the title of a labelled copy."""
    lab = table(spark, sf, "labels").join(notices(spark, sf).select("doc_id", "title"), "doc_id")
    sc = lab.select(F.col("doc_id").cast("string").alias("item_id"), "title", F.col("doc_id").alias("ord"), F.col("quality").cast("string").alias("target_audience"), F.array(F.col("toxic").cast("string")).alias("key_benefits"),
                    F.lit("").alias("fee_assessment"), F.concat(F.lit("p"), F.col("quality").cast("string")).alias("priority"))
    return jn.enrich_from_scores(items(spark, sf), sc)


ENR = """, lb AS (SELECT l.doc_id, l.quality, l.toxic, n.title FROM labels l JOIN notices n USING (doc_id)), bt AS (SELECT title, arg_max(quality, doc_id) AS quality FROM lb WHERE title <> '' GROUP BY title),
 en AS (SELECT CAST(n.doc_id AS VARCHAR) AS item_id, 'p' || coalesce(l.quality, bt.quality) AS priority, CASE WHEN l.doc_id IS NOT NULL THEN 'id' WHEN bt.title IS NOT NULL THEN 'title' END AS matched FROM notices n LEFT JOIN labels l USING (doc_id) LEFT JOIN bt ON bt.title = n.title)"""


def q_corrections(spark, sf):
    it = items(spark, sf)
    s = it.filter(F.col("lang") != "en").select("item_id", F.when(F.col("lang") == "de", "活动").otherwise("无效类").alias("category"), F.when(F.col("source") == "src2", "招商银行").otherwise("").alias("bank"),
                                                  F.when(F.col("lang") == "fr", F.concat(F.lit("改："), "title")).otherwise(F.col("title")).alias("title"))
    return jn.apply_corrections(it, s).select("item_id", "category", "bank", "title", F.array_join("evidence", ";").alias("evidence"), "modified")


COR = f""", s AS (SELECT doc_id, {CAT3} AS cat, CASE WHEN lang = 'de' AND {CAT3} <> '活动' THEN '活动' END AS nc, CASE WHEN lang <> 'en' AND source = 'src2' THEN '招商银行' END AS nb, CASE WHEN lang = 'fr' THEN '改：' || title END AS nt, source, title FROM notices)
 SELECT CAST(doc_id AS VARCHAR) AS item_id, coalesce(nc, cat) AS category, coalesce(nb, source) AS bank, coalesce(nt, title) AS title,
 array_to_string(list_filter(['e0', 'LLM 修正分类: ' || nc, 'LLM 修正银行: ' || nb, 'LLM 修正标题: ' || nt], lambda x: x IS NOT NULL), ';') AS evidence, (nc IS NOT NULL OR nb IS NOT NULL OR nt IS NOT NULL) AS modified FROM s"""


def pages(spark, sf):
    return table(spark, sf, "pages")


def q_new_urls(spark, sf):
    p = pages(spark, sf)
    hist = p.filter(F.contains("url", F.lit("/en/"))).select(F.md5(F.trim("url")).alias("url_md5"))
    return jn.filter_new_urls(p.select("page_id", F.concat(F.lit(" "), "url").alias("url")), hist).select("page_id")


def q_cached(spark, sf):
    n = notices(spark, sf)
    first = dd.first_per_key(n.select(F.col("doc_id").alias("ord"), "url", "title", "body", "lang"), "url", "ord")
    u = first.select("url", "ord")
    return jn.cached_or_fetched(u, first.filter("lang <> 'es'"), first.filter("lang in ('fr', 'es')").withColumn("title", F.concat(F.lit("新"), "title"))).select("url", "ord", "title", "origin")


def q_orphans(spark, sf):
    n = notices(spark, sf)
    files = n.select(F.explode("images").alias("path"), "lang").select(F.upper("path").alias("path"), "lang").distinct()
    return jn.orphan_files(files, n.filter("lang = 'en'"), n.filter("source = 'src3'").withColumn("images", F.transform("images", lambda i: F.replace(i, F.lit("/"), F.lit("\\"))))).select("path").distinct()


def q_request_order(spark, sf):
    n = notices(spark, sf)
    req = n.filter("lang = 'fr'").select("url", F.col("doc_id").alias("ord"))
    return jn.order_by_request(n.select("doc_id", "url"), req).select("doc_id", F.col("request_ord").cast("bigint").alias("request_ord"))


def q_fallback(spark, sf):
    n = notices(spark, sf).select(F.col("doc_id").alias("ord"), "url", "title", "lang")
    return jn.merge_fallback_links(n.filter("lang = 'en'").drop("lang"), n.drop("lang"))


ENTRIES = {
    "enrich_from_scores": (lambda s, d: q_enrich(s, d).select("item_id", "priority", "matched"), sql_over_notices("SELECT * FROM en", ENR)),
    "enrich_match_rate": (lambda s, d: jn.match_rate(q_enrich(s, d)), sql_over_notices("SELECT count(*) AS total, count(matched) AS matched FROM en", ENR)),
    "apply_corrections": (q_corrections, sql_over_notices("", COR)),
    "filter_new_urls": (q_new_urls, "SELECT page_id FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE contains(url, '/en/'))"),
    "cached_or_fetched": (q_cached, sql_over_notices("SELECT url, ord, CASE WHEN lang IN ('fr', 'es') THEN '新' || title ELSE title END AS title, CASE WHEN lang IN ('fr', 'es') THEN 'fetched' ELSE 'cached' END AS origin FROM (SELECT url, min(doc_id) AS ord, arg_min(title, doc_id) AS title, arg_min(lang, doc_id) AS lang FROM notices GROUP BY url)")),
    "orphan_files": (q_orphans, sql_over_notices("SELECT DISTINCT upper(p) AS path FROM (SELECT unnest(images) AS p FROM notices) WHERE lower(p) NOT IN (SELECT lower(unnest(images)) FROM notices WHERE lang = 'en' OR source = 'src3')")),
    "order_by_request": (q_request_order, sql_over_notices("SELECT n.doc_id, r.ord AS request_ord FROM notices n LEFT JOIN (SELECT url, min(doc_id) AS ord FROM notices WHERE lang = 'fr' GROUP BY url) r USING (url)")),
    "merge_fallback_links": (q_fallback, sql_over_notices("SELECT doc_id AS ord, url, title FROM notices WHERE lang = 'en' UNION ALL SELECT min(doc_id), url, arg_min(title, doc_id) FROM notices WHERE url NOT IN (SELECT url FROM notices WHERE lang = 'en') GROUP BY url")),
}
