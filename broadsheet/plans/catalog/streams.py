"""Streaming queries: events and bulletins replayed through a file source until nothing is left."""

from pyspark.sql import functions as F

from ...operators import dedup as dd
from ...sources import scratch
from ...streaming import jobs as st
from .base import notices, q, sql_over_notices, table
from .labels import sql_classified, sql_resolved


ARRIVALS = 6
_FOLDERS = {}


def replay(spark, sf):
    """Events as a stream of ARRIVALS files, one a trigger: about five days each; every 17th event comes three files late."""
    k = (spark.sparkContext.applicationId, sf)
    if k not in _FOLDERS:
        path = scratch.fresh(spark, "arrivals")
        e = table(spark, sf, "events")
        u = F.concat(F.lit("http://e/"), F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"))
        n = e.agg(F.max("event_id") + 1).first()[0]
        part = F.least(F.lit(ARRIVALS - 1), F.floor(F.col("event_id") * ARRIVALS / n) + F.when(F.col("event_id") % 17 == 0, 3).otherwise(0)).cast("int")
        e = e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("feed"), u.alias("url"), F.when(F.col("value") < 5, "").otherwise(F.col("value").cast("string")).alias("title"), "props", part.alias("part"))
        for i in range(ARRIVALS):  # one after the other: files arrive in this order
            e.filter(F.col("part") == i).drop("part").coalesce(1).sortWithinPartitions("ts", "event_id").write.mode("append").parquet(path)
        _FOLDERS[k] = path
    staged = spark.read.parquet(_FOLDERS[k])
    return staged, st.stream_articles(spark, _FOLDERS[k], staged.schema, files=1)


def sunk(spark, df, name):
    p = scratch.fresh(spark, name)
    st.run_available(df.writeStream.format("parquet").option("path", p + "/out").outputMode("append"), p + "/cp")
    return spark.read.parquet(p + "/out")


def q_articles(spark, sf):
    _, s = replay(spark, sf)
    return sunk(spark, s, "arrive").select("event_id", "feed", "url")


def q_dedup(spark, sf):
    """Rows that come out: first sights, and sights after the memory of a URL has ended; rows behind the watermark are lost."""
    _, s = replay(spark, sf)
    d = sunk(spark, st.stream_dedup_url(s, delay="2 days"), "dedup")
    return d.select("url_md5", "url", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


HELD = 40


def q_lru(spark, sf):
    """The history after all arrivals; far fewer URLs are held than seen."""
    _, s = replay(spark, sf)
    p = scratch.fresh(spark, "lru")
    with st.rocksdb_state(spark):
        st.run_available(st.stream_history_lru(s, seq="event_id", n=HELD, buckets=2).writeStream.format("parquet").option("path", p + "/out").outputMode("append"), p + "/cp")
    return st.history_of(spark, p + "/cp", HELD)


def q_late(spark, sf):
    staged, s = replay(spark, sf)
    ok, late = st.stream_late_filter(s, "ts", "2024-01-20 00:00:00", 7)
    return sunk(spark, ok, "ontime").select("event_id", F.lit("in_time").alias("part")).unionByName(sunk(spark, late, "late").select("event_id", F.lit("late").alias("part")))


def q_weekly(spark, sf):
    """Append mode: weeks that the watermark has passed, without the rows that came behind it."""
    _, s = replay(spark, sf)
    return sunk(spark, st.stream_weekly_counts(s, ["feed"]), "weeks").select(F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "feed", "n")


def q_upsert(spark, sf):
    _, s = replay(spark, sf)
    p = scratch.fresh(spark, "upsert")
    st.run_available(st.upsert_changes(st.stream_upsert_latest(s, columns=("title",)), p + "/changes"), p + "/cp")
    return st.upserted(spark, p + "/changes").select("url", "title", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


def q_score(spark, sf):
    n = notices(spark, sf).select("doc_id", "title", "url", "author", "publish_time", F.col("body").alias("content_text"), "images")
    files = scratch.stage_once(spark, f"arrivals|{sf}", lambda: n.repartitionByRange(3, "doc_id"))
    s = st.stream_articles(spark, files.inputFiles()[0].rsplit("/", 1)[0], files.schema, files=2)
    p = scratch.fresh(spark, "scored")
    refs = notices(spark, sf).groupBy(F.lit("招商银行").alias("bank")).agg(F.count(F.lit(1)).alias("n_refs"))
    st.run_available(st.stream_score_enrich(s, p, refs), p + "/cp")
    return spark.read.parquet(p + "/scored").select("doc_id", "category", "bank", "n_refs")


def q_archive(spark, sf):
    _, s = replay(spark, sf)
    p = scratch.fresh(spark, "stream-archive")
    st.run_available(st.stream_archive(s).option("path", p + "/out"), p + "/cp")
    return spark.read.parquet(p + "/out").select("event_id", "url", "feed", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


URL = "'http://e/' || event_type || '/' || user_id"
# Batch p drops what lies behind the watermark of batch p - 1 and evicts by its own, which the batches before it have set.
BATCHES = lambda days: f"""ev AS (SELECT *, {URL} AS url, least({ARRIVALS - 1}, event_id * {ARRIVALS} // (SELECT max(event_id) + 1 FROM events) + CASE WHEN event_id % 17 = 0 THEN 3 ELSE 0 END) AS part FROM events),
 mx AS (SELECT part, max(max(date_trunc('milliseconds', ts))) OVER (ORDER BY part) - INTERVAL {days} DAY AS mark FROM ev GROUP BY part),
 wm AS (SELECT p AS part, coalesce((SELECT mark FROM mx WHERE mx.part = p - 2), TIMESTAMP '1970-01-01') AS late FROM range({ARRIVALS}) AS r(p))"""
WEEKS = f"""WITH {BATCHES(7)}, wk AS (SELECT date_trunc('week', ts) AS week, event_type AS feed, late FROM ev JOIN wm USING (part))
 SELECT strftime(week, '%Y-%m-%d') AS week_start, feed, count(*) AS n FROM wk WHERE week + INTERVAL 7 DAY > late AND week + INTERVAL 7 DAY <= (SELECT max(mark) FROM mx) GROUP BY ALL"""
DEDUP = f"""WITH {BATCHES(2)}, fi AS (SELECT url, part, min(ts) AS ts, any_value(late) AS late FROM ev JOIN wm USING (part) WHERE ts > late GROUP BY url, part),
 li AS (SELECT url, list_reduce(list({{'ends': ts + INTERVAL 2 DAY, 'ts': ts, 'late': late, 'out': [ts]}} ORDER BY part),
   lambda a, b: CASE WHEN a.ends > b.late THEN a ELSE {{'ends': b.ends, 'ts': b.ts, 'late': b.late, 'out': list_concat(a.out, b.out)}} END).out AS out FROM fi GROUP BY url)
 SELECT md5(url) AS url_md5, url, strftime(unnest(out), '%Y-%m-%d %H:%M:%S.%f') AS ts FROM li"""
HISTORY = f"SELECT feed, url_md5, seq FROM (SELECT event_type AS feed, md5({URL}) AS url_md5, max(event_id) AS seq FROM events GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY feed ORDER BY seq DESC, url_md5) <= {HELD}"
ENTRIES = {
    "stream_articles": (q_articles, f"SELECT event_id, event_type AS feed, {URL} AS url FROM events"),
    "stream_dedup_url": (q_dedup, DEDUP),
    "stream_history_lru": (q_lru, HISTORY),
    "stream_late_filter": (q_late, "SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-13' THEN 'in_time' ELSE 'late' END AS part FROM events"),
    "stream_weekly_counts": (q_weekly, WEEKS),
    "stream_upsert_latest": (q_upsert, f"SELECT {URL} AS url, coalesce(max_by(CASE WHEN value >= 5 THEN value::VARCHAR END, (ts, value::VARCHAR)) FILTER (value >= 5), '') AS title, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY 1"),
    "stream_score_enrich": (q_score, sql_over_notices(f"SELECT doc_id, category, bank, CASE WHEN bank = '招商银行' THEN (SELECT count(*) FROM notices) END AS n_refs FROM {sql_resolved(sql_classified())}")),
    "stream_archive": (q_archive, f"SELECT event_id, {URL} AS url, event_type AS feed, year(ts) AS year, month(ts) AS month FROM events"),
}
