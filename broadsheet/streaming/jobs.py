"""Incremental jobs on Structured Streaming: arrival, URL memory, late rows, weekly counts, upserts, scoring, archive.

What has to be remembered is Spark's own keyed state, checkpointed with the query; batches cost what arrives in them.
"""

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.expr import strip, text
from ..operators.dedup import url_md5
from ..operators.rollups import topk_per_group
from ..plans.items import normalize_items
from ..functions.scoring import score_items


def stream_articles(spark, path, schema, fmt="parquet", files=100):
    """New files of a folder as a stream, a bounded number per trigger."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files).load(path)


def run_available(writer, checkpoint):
    """Process what is there and stop."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def stream_dedup_url(df, ts="ts", url="url", delay="7 days"):
    """First row per URL hash within the watermark delay; state is bounded by the delay."""
    return df.withColumn("url_md5", url_md5(url)).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["url_md5"])


def stream_late_filter(df, ts, run_time, days):
    """(in time, late): rows older than `days` before the run go to the side output."""
    edge = F.lit(run_time).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(ts) >= edge), df.filter(F.col(ts) < edge)


def stream_weekly_counts(df, keys, ts="ts", delay="7 days"):
    """(week_start, keys, n) over weeks that start on Monday; append mode emits a week once the watermark passed it."""
    w = F.window(F.col(ts), "7 days", "7 days", "4 days")
    g = df.withWatermark(ts, delay).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("week_start"), *keys, "n")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark):
    """Queries started inside keep their state in RocksDB, which processors with map state need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class NewestUrls(StatefulProcessor):
    """Per (feed, bucket): the n most lately seen URL hashes with their last place in the stream.

    Rows of unseen hashes come out. The map is cut back to n once it holds slack times as many: oldest first, ties by hash.
    A batch reads the map once and writes what has changed of the rows that stay, so the calls to the state are bounded by n."""

    def __init__(self, n, slack=1.25):
        self.n, self.slack = n, slack

    def init(self, handle):
        self.seen = handle.getMapState("seen", "url_md5 string", "seq long")

    def handleInputRows(self, key, rows, timerValues):
        before = {k[0]: v[0] for k, v in self.seen.iterator()}
        held, fresh = dict(before), {}
        for batch in rows:
            found = batch.groupby("url_md5")["seq"].agg(["min", "max"])
            for url, least, most in zip(found.index, found["min"].tolist(), found["max"].tolist()):
                old = held.get(url)
                if old is None:
                    fresh[url] = least
                elif url in fresh:
                    fresh[url] = min(fresh[url], least)
                held[url] = most if old is None else max(old, most)
        if len(held) > self.n * self.slack:
            held = dict(sorted(held.items(), key=lambda x: (-x[1], x[0]))[:self.n])
        for url in before.keys() - held.keys():
            self.seen.removeKey((url,))
        for url, last in held.items():
            if before.get(url) != last:
                self.seen.updateValue((url,), (last,))
        yield pd.DataFrame({"feed": key[0], "url_md5": list(fresh), "seq": list(fresh.values())}).astype({"feed": "object", "url_md5": "object", "seq": "int64"})

    def close(self):
        pass


def stream_history_lru(stream, feed="feed", url="url", seq="seq", n=5000, buckets=16):
    """(feed, url_md5, seq) of rows with URLs that the history does not hold; the history keeps the n last seen per feed.

    A feed's hashes are spread over buckets, each with its own state, so that a feed that is a third of the stream is no
    single task; each bucket keeps its n newest, hence all of the feed's n newest. history_of reads them. Start the query
    inside rocksdb_state. Evicted URLs count as unseen when they come again, and the history after a run is the same
    however rows are dealt to batches."""
    d = stream.select(F.col(feed).alias("feed"), url_md5(url).alias("url_md5"), F.col(seq).cast("long").alias("seq"))
    d = d.withColumn("bucket", F.pmod(F.xxhash64("url_md5"), F.lit(buckets)).cast("int"))
    return d.groupBy("feed", "bucket").transformWithStateInPandas(NewestUrls(n), "feed string, url_md5 string, seq long", "append", "none")


def history_of(spark, checkpoint, n=5000):
    """(feed, url_md5, seq): the n last seen of each feed, from the state of a stopped or running stream_history_lru."""
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    held = state.select(F.col("key.feed").alias("feed"), F.col("user_map_key.url_md5").alias("url_md5"), F.col("user_map_value.seq").alias("seq"))
    return topk_per_group(held, "feed", [F.desc("seq"), F.col("url_md5")], n).drop("rank")


def stream_upsert_latest(stream, key="url", ts="ts", columns=("title", "body")):
    """Changed rows (key, ts, columns): per key and column the latest filled value (an empty one only where none is filled).

    The table is the state of a running aggregate; write it in update mode (upsert_changes). Each column carries the time of
    its value, so a late arrival is judged by when its value was written, not by when the key was last seen: the result
    does not depend on how rows are dealt into batches. Ties of time go to the greater value."""
    held = lambda k: F.struct((text(k) != "").alias("filled"), F.col(ts).alias("at"), F.col(k).alias("value"))
    best = stream.groupBy(key).agg(*[F.max(held(k)).alias(k) for k in columns], F.max(ts).alias(ts))
    return best.select(key, ts, *[F.col(k)["value"].alias(k) for k in columns])


def upsert_changes(changed, path):
    """Writer of changed rows, a folder per batch; a repeated batch rewrites its own."""
    return changed.writeStream.outputMode("update").foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{path}/batch={i}"))


def upserted(spark, path, key="url"):
    """The table that the changes lead to: the last change of each key."""
    d = spark.read.option("basePath", path).parquet(path)
    rest = [k for k in d.columns if k not in (key, "batch")]
    return d.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(key, "r.*")


def stream_score_enrich(stream, out_path, references=None, source="wechat"):
    """Writer: normalise, score and (by bank) attach references to every arrival; one folder per batch."""
    def batch(df, i):
        tmp = f"{out_path}/items/batch={i}"
        normalize_items(df, source=source).write.mode("overwrite").parquet(tmp)
        s = score_items(df.sparkSession.read.parquet(tmp))
        if references is not None:
            s = s.join(references, "bank", "left")
        s.write.mode("overwrite").parquet(f"{out_path}/scored/batch={i}")
    return stream.writeStream.foreachBatch(batch)


def stream_archive(stream, ts="ts"):
    """Writer into a year / month partitioned archive; the checkpoint makes it exactly-once."""
    a = stream.withColumns({"year": F.year(ts), "month": F.month(ts)})
    return a.writeStream.format("parquet").partitionBy("year", "month").outputMode("append")
