"""Operators on the cases that once went wrong: failing writes, late arrivals, equal rows, far requests."""

import collections

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import dedup, joins, retrieval
from broadsheet.sources import scratch, sinks
from broadsheet.streaming import jobs


def test_atomic_write_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        sinks.read_atomic(spark, path)
    sinks.atomic_write(spark.range(5), path)
    with pytest.raises(Exception):
        sinks.atomic_write(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert sinks.read_atomic(spark, path).count() == 5
    sinks.atomic_write(spark.range(9), path)
    sinks.atomic_write(spark.range(11), path)
    assert sinks.read_atomic(spark, path).count() == 11


def upserted(spark, tmp_path, name, batches):
    source, rows = tmp_path / f"{name}-in", "url string, ts timestamp, title string"
    for k, batch in enumerate(batches):
        data = [("u", t, v) for t, v in batch]
        spark.createDataFrame(data, "url string, t long, title string").select("url", F.timestamp_seconds("t").alias("ts"), "title").coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(rows).option("maxFilesPerTrigger", 1).parquet(str(source))
    changes = str(tmp_path / f"{name}-changes")
    jobs.run_available(jobs.upsert_changes(jobs.stream_upsert_latest(stream, columns=("title",)), changes), str(tmp_path / f"{name}-cp"))
    r = jobs.upserted(spark, changes).first()
    return r.title, r.ts.timestamp()


def test_upsert_judges_late_values_by_their_time(spark, tmp_path):
    rows = [(1, "A"), (5, ""), (3, "B")]
    apart = upserted(spark, tmp_path, "apart", [[r] for r in rows])
    assert apart == upserted(spark, tmp_path, "once", [rows]) == ("B", 5.0)
    assert upserted(spark, tmp_path, "older", [[(9, "Z")], [(2, "A")]]) == ("Z", 9.0)


def test_upsert_writes_changed_rows_only(spark, tmp_path):
    source, kind = str(tmp_path / "in"), "url string, ts timestamp, title string"
    for batch in ([("a", 1, "A"), ("b", 1, "B")], [("a", 2, "A2")], [("b", 0, "old"), ("c", 1, None)]):
        spark.createDataFrame(batch, "url string, t long, title string").select("url", F.timestamp_seconds("t").alias("ts"), "title").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.run_available(jobs.upsert_changes(jobs.stream_upsert_latest(stream, columns=("title",)), str(tmp_path / "c")), str(tmp_path / "cp"))
    sizes = spark.read.option("basePath", str(tmp_path / "c")).parquet(str(tmp_path / "c")).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes] == [2, 1, 2]
    assert sorted((r.url, r.title) for r in jobs.upserted(spark, str(tmp_path / "c")).collect()) == [("a", "A2"), ("b", "B"), ("c", None)]


def history(spark, tmp_path, name, batches, n):
    source, kind = str(tmp_path / f"{name}-in"), "feed string, url string, seq long"
    for batch in batches:
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source)
    with jobs.rocksdb_state(spark):
        jobs.run_available(jobs.stream_history_lru(stream, n=n, buckets=2).writeStream.format("parquet").option("path", str(tmp_path / f"{name}-out")), str(tmp_path / f"{name}-cp"))
    held = jobs.history_of(spark, str(tmp_path / f"{name}-cp"), n)
    return sorted(map(tuple, held.collect())), sorted(map(tuple, spark.read.parquet(str(tmp_path / f"{name}-out")).collect()))


def test_history_keeps_the_last_seen_however_rows_are_dealt(spark, tmp_path):
    import hashlib
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    rows = [("f", f"u{(k * 7) % 23}", k) for k in range(60)] + [("g", "v", 100), ("g", "v", 101)]
    last = {}
    for feed, url, seq in rows:
        last[feed, md5(url)] = seq
    want = sorted((f, u, s) for f in "fg" for (_, u), s in sorted(((k, s) for k, s in last.items() if k[0] == f), key=lambda x: -x[1])[:4])
    once, _ = history(spark, tmp_path, "once", [rows], 4)
    many, fresh = history(spark, tmp_path, "many", [rows[:20], rows[20:25], rows[25:]], 4)
    assert once == many == want
    came = collections.Counter(u for f, u, _ in fresh if f == "f")
    assert set(came) == {u for f, u in last if f == "f"} and max(came.values()) > 1  # evicted ones came anew


def test_freshness_sees_a_change_in_equal_rows(spark):
    key = lambda x: tuple(retrieval.index_freshness(spark.createDataFrame([(1, x), (1, x)], "id long, text string")).first())
    assert key("a") != key("b") and key("a") == key("a")
    assert retrieval.index_freshness(spark.createDataFrame([], "id long, text string")).first().n == 0


def test_unknown_rows_come_after_any_request(spark):
    rows = spark.createDataFrame([("u",), ("z",), ("a",)], "url string")
    asked = spark.createDataFrame([("a", 5), ("z", 1500)], "url string, ord long")
    assert [r.url for r in joins.order_by_request(rows, asked).collect()] == ["a", "z", "u"]


def test_scratch_folder_needs_a_shared_place_on_clusters():
    class Conf:
        def get(self, *_):
            return None

    class Spark:
        conf = Conf()

        class sparkContext:
            master, applicationId = "local-cluster[2,1,1024]", "x"
    with pytest.raises(ValueError):
        scratch.root(Spark)


def test_weekly_run_splits_topics(spark):
    from broadsheet.plans import items as it
    articles = spark.createDataFrame([("a", "总题", "http://u/a", "招商银行信用卡", "2024.06.01", "一、新卡首发 二、返现优惠活动 三、公告"), ("b", "招商银行返现活动", "http://u/b", "招商银行信用卡", "2024.06.02", "招商银行返现活动，满100元返10元")],
                                     "article_id string, title string, url string, author string, publish_time string, content_text string")
    lines = ["序", "一、新卡首发", "x", "y", "z", "二、返现优惠活动", "x", "y", "z", "三、公告", "x", "y"]
    blocks = spark.createDataFrame([("a", k, "article_text", t, False) for k, t in enumerate(lines)], "article_id string, pos int, type string, text string, is_heading_like boolean")
    notices = spark.createDataFrame([("系统升级公告", "http://u/n", "系统维护", "公告", "工商银行", "2024.06.03")], "title string, url string, content_text string, category string, bank string, publish_time string")
    pages = spark.createDataFrame([("网页", "http://u/p", " ", "2024.06.03")], "title string, url string, content_text string, publish_time string")
    split, _ = it.weekly_run(spark, articles, notices, pages, "W", article_blocks=blocks)
    # the third topic has no category and is dropped as noise
    assert sorted(r.url for r in split.select("url").collect()).count("http://u/a") == 2


def test_content_hash_sees_the_middle_of_long_files(spark):
    long = "a" * 100_000
    rows = [(1, long), (2, long[:80_000] + "b" + long[80_001:]), (3, long + "a"), (4, long), (5, ""), (6, "")]
    files = spark.createDataFrame(rows, "ord long, content string").withColumn("content", F.encode("content", "utf-8"))
    assert sorted(r.ord for r in dedup.content_hash_dedup(files).collect()) == [1, 2, 3, 5]
