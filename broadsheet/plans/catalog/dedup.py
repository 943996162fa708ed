"""Duplicate, similarity and merge queries."""

from pyspark.sql import functions as F

from ... import lexicon as lx
from ...functions import fields as fd
from ...operators import dedup as dd
from ...operators import similarity as sm
from ...sources import scratch
from .base import WS, column_query, notices, q, rendered, sql_filled, sql_lines, sql_list, sql_map, sql_over_notices, sql_strip, table
from .texts import ENTRIES as TEXTS


def keyed(spark, sf):
    d = notices(spark, sf)
    return d.select(F.col("doc_id").alias("ord"), "title", F.col("source").alias("file"), "url", F.col("raw_category").alias("category"),
                    F.when(F.col("lang") == "en", "").otherwise(F.col("body")).alias("comment"))


KEY = (f"lower(regexp_replace(regexp_replace(title, '^{WS}*[一二三四五六七八九十0-9]+[、.．]{WS}*', ''), " + q(r"""[\s\x0b\x85\p{Z}·•：:，,。！!？?（）()【】\[\]‘’“”"'_-]+""") + ", '', 'g'))")
COMMENT = "CASE lang WHEN 'en' THEN '' ELSE body END"


def merge_input(spark, sf):
    """Whole first sentences in blocks by language."""
    d = notices(spark, sf)
    return d.select(F.col("doc_id").alias("ord"), F.col("headline").alias("title"), F.col("lang").alias("bank"), F.col("body").alias("raw_text"), "url", "source",
                    fd.extract_kv_fields("body").alias("structured"), "images")


SIMILAR = 0.85  # the operators' default
MERGE_IN = ", mi AS (SELECT doc_id AS ord, headline AS title, lang AS bank, body AS raw_text, url, source, images FROM notices)"
GRAMS = "list_distinct(list_filter(list_transform(range(1, length(title)), lambda i: substr(title, i, 2)), lambda g: NOT starts_with(g, ' ')))"
TITLES = MERGE_IN + f", ti AS (SELECT bank, title, {GRAMS} AS g, min(ord) AS first_ord FROM mi GROUP BY bank, title)"
JAC = "len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))"


def pairs_sql(th):
    return TITLES + f", pr AS (SELECT a.bank AS block, a.title AS title_a, b.title AS title_b, a.first_ord AS oa, b.first_ord AS ob, {JAC} AS score FROM ti a JOIN ti b ON a.bank = b.bank AND a.title < b.title AND len(a.g) > 0 AND len(b.g) > 0 AND {JAC} >= {th}::DOUBLE)"


def clusters_sql(th):
    return pairs_sql(th) + """, ed AS (SELECT oa AS a, ob AS b FROM pr UNION SELECT ob, oa FROM pr), rc AS (SELECT * FROM (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM ed UNION SELECT r.a, ed.b FROM r JOIN ed ON r.b = ed.a) SELECT a, min(b) AS lo FROM r GROUP BY a)),
 cl AS (SELECT mi.*, CASE WHEN len(ti.g) = 0 THEN mi.ord ELSE least(ti.first_ord, coalesce(rc.lo, ti.first_ord)) END AS cluster FROM mi JOIN ti USING (bank, title) LEFT JOIN rc ON rc.a = ti.first_ord)"""


MERGED = clusters_sql(SIMILAR) + """, mg AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS members, row_number() OVER (PARTITION BY cluster ORDER BY length(raw_text) DESC, ord) AS rn FROM cl)"""


def q_pairs(spark, sf):
    p = sm.title_similarity_pairs(merge_input(spark, sf))
    return p.select("block", F.least("title_a", "title_b").alias("title_a"), F.greatest("title_a", "title_b").alias("title_b"), F.round("score", 6).alias("score"))


def q_merge(spark, sf):
    return sm.near_dup_merge(spark, merge_input(spark, sf)).select("ord", "title", "bank", "cluster", "members")


def q_clustered(spark, sf):
    return dd.merge_clustered_items(sm.near_dup_clusters(spark, merge_input(spark, sf)))




def kv_cte():
    from .fields import SQL_KV
    return SQL_KV.replace("replace(body, '，', chr(10))", "body").replace("SELECT doc_id, key, coalesce(arg_min(v, i) FILTER (v <> ''), '') AS value FROM s GROUP BY doc_id, key",
                                                                        ", kv AS (SELECT doc_id AS ord, key, coalesce(arg_min(v, i) FILTER (v <> ''), '') AS value FROM s GROUP BY doc_id, key)")


CLUSTERED = kv_cte() + clusters_sql(SIMILAR) + """ SELECT cluster, 'raw_text' AS field, ord, 0::BIGINT AS i, raw_text AS value FROM cl WHERE raw_text <> ''
 UNION ALL SELECT cluster, 'image', ord, i - 1, v FROM (SELECT cluster, ord, unnest(images) AS v, generate_subscripts(images, 1) AS i FROM cl)
 UNION ALL SELECT cluster, 'structured.' || key, min(ord), 0, arg_min(value, ord) FROM (SELECT cl.cluster, cl.ord, kv.key, kv.value FROM cl JOIN kv USING (ord) WHERE kv.value <> '') GROUP BY cluster, key
 UNION ALL SELECT cluster, 'url', min(ord), 0, arg_min(url, ord) FROM cl GROUP BY cluster"""


def q_history(spark, sf):
    n = notices(spark, sf)
    hist = n.filter(F.col("lang") == "en").groupBy(dd.url_md5("url").alias("url_md5")).agg(F.min("doc_id").alias("seq"))
    new = n.select("url", (F.col("doc_id") + 1000000000).alias("seq"))
    return dd.history_bounded(hist, new, 500)


def q_match(spark, sf):
    # titles alone are written, not the rendered texts
    n = scratch.stage_once(spark, f"headlines|{sf}", lambda: rendered(spark, sf).select("doc_id", "lang", "source", "headline"))
    # altered titles: cut, re-sourced or with a changed end
    t = F.col("headline")
    t = F.when(F.col("lang") == "de", F.concat_ws(" ", F.slice(F.split(t, " "), F.lit(1), F.greatest(F.lit(1), F.size(F.split(t, " ")) - 2)))).when(F.col("lang") == "fr", F.concat(t, F.lit("补充"))).when(F.col("lang") == "es", F.concat(F.lit("另有"), t, F.lit("的很多其他说明文字在后面"))).otherwise(t)
    b = F.when(F.col("source").isin("src1", "src2"), "src0").otherwise(F.col("source"))
    return sm.match_original(n.select(F.col("doc_id").alias("qid"), t.alias("title"), b.alias("bank")), n.select(F.col("doc_id").alias("ord"), F.col("headline").alias("title"), F.col("source").alias("bank"))).select("qid", "step", "ord")


def grams(e):
    return f"list_distinct(list_filter(list_transform(range(1, length({e})), lambda i: substr({e}, i, 2)), lambda g: NOT starts_with(g, ' ')))"


SQL_MATCH = f""", qq AS (SELECT doc_id AS qid, trim(CASE lang WHEN 'de' THEN array_to_string(string_split(headline, ' ')[1:greatest(1, len(string_split(headline, ' ')) - 2)], ' ') WHEN 'fr' THEN headline || '补充' WHEN 'es' THEN '另有' || headline || '的很多其他说明文字在后面' ELSE headline END) AS title, CASE WHEN source IN ('src1', 'src2') THEN 'src0' ELSE source END AS bank FROM notices),
 q2 AS (SELECT *, {grams('title')} AS g FROM qq), o AS (SELECT trim(headline) AS title, source AS bank, min(doc_id) AS ord, {grams('trim(headline)')} AS g FROM notices GROUP BY trim(headline), source),
 hits AS (SELECT a.qid, CASE WHEN a.title = b.title AND a.bank = b.bank THEN 1 WHEN a.title = b.title THEN 2 WHEN len(a.g) > 0 AND len(b.g) > 0 AND {JAC} >= 0.6::DOUBLE THEN 3 WHEN a.bank = b.bank AND (contains(a.title, b.title) OR contains(b.title, a.title)) THEN 4 END AS step, b.ord FROM q2 a, o b)
 SELECT qid, CAST(min(step) AS INTEGER) AS step, min(ord) FILTER (step = ms) AS ord FROM (SELECT *, min(step) OVER (PARTITION BY qid) AS ms FROM hits WHERE step IS NOT NULL) GROUP BY qid"""


def q_best(spark, sf):
    n = notices(spark, sf)
    items = n.select(F.col("doc_id").alias("ord"), F.concat("headline", F.lit("续")).alias("title"))
    heads = n.select(F.col("doc_id").alias("ord"), F.col("headline").alias("title"))
    return sm.best_title_match(items, heads, 0.75).select("ord", "heading_ord", F.round("score", 6).alias("score"))


SQL_BEST = f""", a0 AS (SELECT DISTINCT headline || '续' AS title FROM notices), a AS (SELECT title, {grams('title')} AS g FROM a0),
 b AS (SELECT headline AS title, min(doc_id) AS ord, {grams('headline')} AS g FROM notices GROUP BY headline),
 p AS (SELECT a.title, b.ord, {JAC} AS score FROM a JOIN b ON len(a.g) > 0 AND len(b.g) > 0 AND {JAC} >= 0.75::DOUBLE),
 m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY score DESC, ord) AS rn FROM p) WHERE rn = 1)
 SELECT n.doc_id AS ord, m.ord AS heading_ord, round(m.score, 6) AS score FROM notices n JOIN m ON m.title = n.headline || '续'"""

FILES = lambda s, d: notices(s, d).select(F.col("doc_id").alias("ord"), F.encode(F.concat("source", F.repeat("body", (F.col("n_chars") % 3).cast("int"))), "utf-8").alias("content"))

ENTRIES = {
    "dedup_url_first": (lambda s, d: dd.dedup_url_first(notices(s, d).select(F.col("doc_id").alias("ord"), "url", "title", "source")),
                        sql_over_notices("SELECT doc_id AS ord, url, title, source FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS rn FROM notices) WHERE rn = 1")),
    "history_bounded": (q_history, sql_over_notices("SELECT url_md5, seq FROM (SELECT md5(url) AS url_md5, coalesce(min(CASE WHEN lang = 'en' THEN doc_id END), min(doc_id) + 1000000000) AS seq FROM notices GROUP BY url) ORDER BY seq DESC LIMIT 500")),
    "refresh_history": (lambda s, d: dd.refresh_history(notices(s, d), "url", "doc_id"), sql_over_notices("SELECT md5(url) AS url_md5, doc_id AS seq FROM notices")),
    "history_stats": (lambda s, d: dd.history_stats(notices(s, d).withColumn("seen_at", F.col("publish_time")), notices(s, d).select(F.col("source").alias("account"))),
                      sql_over_notices("SELECT count(*) AS total_fetched, max(publish_time) AS last_fetch, count(DISTINCT source) AS total_accounts FROM notices")),
    "merge_by_title_key": (lambda s, d: dd.merge_by_title_key(keyed(s, d)),
                           sql_over_notices(f"SELECT key, min(doc_id) AS ord, arg_min(title, doc_id) AS title, arg_min(source, doc_id) AS file, arg_min(url, doc_id) AS url, arg_min(raw_category, doc_id) AS category, count(*) AS duplicate_count, "
                                            f"coalesce(arg_min(cm, doc_id) FILTER (cm <> ''), '') AS comment FROM (SELECT *, {KEY} AS key, {COMMENT} AS cm FROM notices) GROUP BY key")),
    "title_key_sources": (lambda s, d: dd.title_key_sources(keyed(s, d)), sql_over_notices(f"SELECT {KEY} AS key, doc_id AS ord, source AS file, url FROM notices")),
    "title_bigrams": column_query(lambda: F.array_join(F.array_sort(sm.title_bigrams("title")), "|"), f"array_to_string(list_sort({GRAMS}), '|')"),
    "title_similarity_pairs": (q_pairs, sql_over_notices("SELECT block, title_a, title_b, round(score, 6) AS score FROM pr", pairs_sql(SIMILAR))),
    "near_dup_merge": (q_merge, sql_over_notices("SELECT ord, title, bank, cluster, members FROM mg WHERE rn = 1", MERGED)),
    "near_dup_stats": (lambda s, d: sm.merge_stats(sm.near_dup_merge(s, merge_input(s, d))),
                       sql_over_notices("SELECT count(*) AS total_in, count(*) FILTER (rn = 1) AS total_out, count(*) FILTER (rn > 1) AS dropped FROM mg", MERGED)),
    "merge_clustered_items": (q_clustered, sql_over_notices("", CLUSTERED)),
    "duplicate_report": (lambda s, d: dd.duplicate_report(notices(s, d).withColumn("item_id", F.substring("url", -8, 8)), "url", "title", "item_id", "source"),
                         sql_over_notices(" UNION ALL ".join([f"SELECT '{k}' AS kind, {e} AS value, count(*) AS n FROM notices GROUP BY 2 HAVING count(*) >= {m}" for k, e, m in (("url", "url", 2), ("title", "title", 2), ("id", "right(url, 8)", 2), ("source", "source", 1))]
                                                              + [f"SELECT 'distinct', '{k}', count(DISTINCT {e}) FROM notices" for k, e in (("url", "url"), ("title", "title"), ("id", "right(url, 8)"))]))),
    "content_hash_dedup": (lambda s, d: dd.content_hash_dedup(FILES(s, d)).select("ord"),
                           sql_over_notices("SELECT min(doc_id) AS ord FROM (SELECT doc_id, source || repeat(body, n_chars % 3) AS content FROM notices) GROUP BY content")),
    "labels_dedup_ordered": column_query(lambda: F.array_join(dd.labels_dedup_ordered(F.split("title", "")), ""), ("string_split(title, '')", "array_to_string(list_filter(t1, lambda x, i: list_position(t1, x) = i), '')")),
    "match_original": (q_match, sql_over_notices("", SQL_MATCH)),
    "best_title_match": (q_best, sql_over_notices("", SQL_BEST)),
    "set_overlap": (lambda s, d: notices(s, d).select("doc_id", sm.set_overlap(sm.title_bigrams("title"), sm.title_bigrams("body")).alias("o")).select("doc_id", F.col("o.both").cast("bigint").alias("both"), F.col("o.either").cast("bigint").alias("either"), "o.overlaps"),
                    sql_over_notices(f"SELECT doc_id, len(list_intersect(a, b)) AS both, len(list_distinct(list_concat(a, b))) AS either, len(list_intersect(a, b)) > 0 AS overlaps FROM (SELECT doc_id, {GRAMS} AS a, {grams('body')} AS b FROM notices)")),
}
