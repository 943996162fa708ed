"""Exact duplicates, merge by key, URL history."""

from pyspark.sql import functions as F

from ..functions.expr import c, strip, text
from ..functions.text import title_key


def first_per_key(df, keys, order):
    """First row per key. Map-side combined: a hot key never gathers in one task.

    order: column name(s) that are unique within a key.
    """
    order = [order] if isinstance(order, str) else list(order)
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [k for k in df.columns if k not in keys]
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return g.select(*[F.col(k) if k in keys else F.col(f"_r.{k}").alias(k) for k in df.columns])


def dedup_url_first(df, url="url", order="ord"):
    return first_per_key(df, url, order)


def url_md5(x):
    return F.md5(strip(text(x)))


def history_bounded(history, new, n=5000):
    """History plus unseen new URLs, newest n (the bound is the feature).

    history: (url_md5, seq); new: (url, seq) with later seq. Known hashes keep their place.
    """
    fresh = new.filter(strip(text("url")) != "").select(url_md5("url").alias("url_md5"), "seq").groupBy("url_md5").agg(F.min("seq").alias("seq"))
    fresh = fresh.join(history.select("url_md5"), "url_md5", "left_anti")
    return history.select("url_md5", "seq").unionByName(fresh.select("url_md5", "seq")).orderBy(F.desc("seq")).limit(n)


def refresh_history(urls, url="url", order="ord"):
    """History that holds exactly the hashes of the given URLs."""
    return urls.select(F.md5(text(url)).alias("url_md5"), F.col(order).alias("seq"))


def history_stats(history, accounts, last="seen_at"):
    """One row: accounts, seen URLs, last fetch time (two scalar subqueries, no cross join)."""
    n = accounts.agg(F.countDistinct("account").alias("n"))
    return history.agg(F.count(F.lit(1)).alias("total_fetched"), F.max(last).alias("last_fetch")).withColumn("total_accounts", n.scalar())


def merge_by_title_key(df, order="ord"):
    """One row per title key: the first row, number of duplicates, first non-empty comment.

    The sources of a key stay rows (title_key_sources): one key may hold a large share of the table.
    """
    k = df.withColumn("key", title_key("title"))
    rest = [x for x in df.columns if x != "comment"]
    g = k.groupBy("key").agg(F.min_by(F.struct(*rest), order).alias("r"), F.count(F.lit(1)).alias("duplicate_count"),
                             F.min_by("comment", F.when(text("comment") != "", F.col(order))).alias("comment"))
    return g.select("key", *[F.col(f"r.{x}").alias(x) for x in rest], "duplicate_count", F.coalesce("comment", F.lit("")).alias("comment"))


def title_key_sources(df, order="ord"):
    """(key, ord, file, url): every source of every merged item, as rows."""
    return df.select(title_key("title").alias("key"), F.col(order).alias("ord"), "file", "url")


def merge_clustered_items(df, cluster="cluster", order="ord"):
    """Merged clusters in long form: (cluster, field, pos, value).

    raw_text and images keep one row per part in order (an open-ended concatenation stays distributed);
    structured fields take the first filled value per key; url takes the first item's.
    """
    o = F.col(order).cast("bigint")
    texts = df.filter(text("raw_text") != "").select(cluster, F.lit("raw_text").alias("field"), F.struct(o.alias("ord"), F.lit(0).alias("i")).alias("pos"), F.col("raw_text").alias("value"))
    images = df.select(cluster, F.lit("image").alias("field"), F.posexplode("images").alias("i", "value"), o.alias("ord")).select(cluster, "field", F.struct("ord", "i").alias("pos"), "value")
    kv = df.select(cluster, o.alias("ord"), F.explode("structured").alias("key", "value")).filter("value <> ''")
    kv = kv.groupBy(cluster, "key").agg(F.min_by("value", "ord").alias("value"), F.min("ord").alias("ord"))
    kv = kv.select(cluster, F.concat(F.lit("structured."), "key").alias("field"), F.struct("ord", F.lit(0).alias("i")).alias("pos"), "value")
    url = df.groupBy(cluster).agg(F.min_by(text("url"), order).alias("value"), F.min(o).alias("ord")).select(cluster, F.lit("url").alias("field"), F.struct("ord", F.lit(0).alias("i")).alias("pos"), "value")
    out = texts.unionByName(images).unionByName(kv).unionByName(url)
    return out.select(cluster, "field", F.col("pos.ord").alias("ord"), F.col("pos.i").cast("bigint").alias("i"), "value")


def duplicate_report(df, url="url", title="title", ident="item_id", source="source"):
    """(kind, value, n): duplicate urls / titles / ids, rows per source, distinct counts."""
    def over(col_name, kind, least):
        return df.groupBy(c(col_name).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select(F.lit(kind).alias("kind"), "value", "n")
    distinct = [df.select(c(k).cast("string").alias("v")).distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit("distinct").alias("kind"), F.lit(name).alias("value"), "n")
                for k, name in ((url, "url"), (title, "title"), (ident, "id"))]
    out = over(url, "url", 2).unionAll(over(title, "title", 2)).unionAll(over(ident, "id", 2)).unionAll(over(source, "source", 1))
    for d in distinct:
        out = out.unionAll(d)
    return out


def content_hash(x):
    """SHA-256 of all bytes; null stays null."""
    return F.sha2(c(x), 256)


def content_hash_dedup(df, content="content", order="ord"):
    """First file per content; the bytes themselves are not shuffled."""
    return first_per_key(df.withColumn("digest", content_hash(content)).drop(content), "digest", order)


def labels_dedup_ordered(x):
    """Distinct list in first-seen order."""
    return F.array_distinct(c(x))
