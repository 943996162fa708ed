"""Fingerprints of documents by closed syncmers of words.

A text's K-word windows are anchors where the least of their inner S-word windows (by MD5) stands first or last. Whether
a window is an anchor depends on its own words only, so a passage has the same anchors wherever it stands, and at least
one in every K - S + 1 windows. A fingerprint lists the anchors in order of position, each as HEX digits of its MD5 and
one digit for its distance from the anchor before (0 for the first). Two fingerprints are as like as the share of anchors
that they have in common at the same distance from the anchor before: twice the common ones by the ones of both.

Neighbouring documents meet by range, not by a global window: boundaries from a bounded sample of keys cut the table into
parts of about PART_BYTES, texts are shuffled once, and each part also gets the first document of the part behind it.
Keys that many rows share are cut by a hash of the text and by row. Only built-in functions run.
"""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .frames import WORD_SPACE, body, col, free_name, written

K, S, HEX = 5, 2, 6
#: Bytes of text in a part, parts at most, and rows that are sampled for each of their boundaries.
PART_BYTES, PARTS, SAMPLED = 8 << 20, 65_536, 16


def words_of(text):
    return F.filter(F.split(text, WORD_SPACE), lambda w: w != "")


def with_anchors(df, text, name):
    """df with the fingerprint of text as an array of its anchors, in a column called name."""
    words, inner, places = (free_name(df, n) for n in ("words", "inner", "places"))
    w, h, p = col(words), col(inner), col(places)
    least = lambda i: F.least(*[F.get(h, i + k) for k in range(1, K - S)])
    edges = lambda i: F.least(F.get(h, i), F.get(h, i + K - S))
    window = lambda i, n: F.array_join(F.slice(w, i + 1, n), " ")
    mark = lambda x: F.substring(F.md5(x), 1, HEX)
    gap = lambda i, n: F.least(F.coalesce(i - F.get(p, n - 1), F.lit(0)), F.lit(9)).cast("string")
    enough = F.size(w) >= K
    own = df.columns
    df = df.select("*", words_of(body(text)).alias(words))
    hashes = F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.md5(F.concat(x, F.lit(" "), F.get(w, i + 1))))
    df = df.select("*", F.when(enough, hashes).alias(inner))
    df = df.select("*", F.when(enough, F.filter(F.sequence(F.lit(0), F.size(w) - K), lambda i: edges(i) <= least(i))).alias(places))
    anchors = F.transform(p, lambda i, n: F.concat(mark(window(i, K)), gap(i, n)))
    short = F.when(F.size(w) > 0, F.array(F.concat(mark(F.array_join(w, " ")), F.lit("0")))).otherwise(F.array().cast("array<string>"))
    return df.select(*map(col, own), F.when(F.size(p) > 0, anchors).otherwise(short).alias(name))


def likeness(a, b):
    """Twice the common anchors by the anchors of both, repeated ones counting once; 1 for two without any."""
    both = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def cut_into_parts(narrow, kind, part_bytes=PART_BYTES):
    """A function of (key, hash, row) that gives the part of a row, ascending, and the number of parts.

    narrow: (k, h, r, bytes). The boundaries are every SAMPLED-th row of a sample of about SAMPLED rows a part, drawn by hash."""
    n, size = narrow.agg(F.count("*"), F.sum("bytes")).first()
    parts = max(1, min(PARTS, n, -(-(size or 0) // part_bytes)))
    order = T.StructType([T.StructField("k", kind), T.StructField("h", T.LongType()), T.StructField("r", T.LongType())])
    some = narrow.where(F.pmod(F.xxhash64("h", "r", F.lit("part")), F.lit(max(n, 1))) < parts * SAMPLED)
    cuts = some.orderBy("k", "h", "r").select(F.to_json(F.struct("k", "h", "r"), {"ignoreNullFields": "false"}).alias("cut")).collect()[SAMPLED // 2::SAMPLED]  # parts rows or so are kept
    bounds = F.from_json(F.lit("[" + ",".join(c["cut"] for c in cuts) + "]"), T.ArrayType(order))
    steps = [2**k for k in reversed(range(max(1, len(cuts)).bit_length()))]

    def part(key, h, r):
        """How many boundaries are not above (key, h, r): a binary search."""
        at = F.struct(key.alias("k"), h.alias("h"), r.alias("r"))
        lower = lambda low, step: F.when(F.get(bounds, low + step - 1) <= at, low + step).otherwise(low)
        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lower)

    return part, len(cuts) + 1


def beside_next(docs, key, text):
    """Every row of docs with part_, ghost_, order columns and its text in t_, dealt and sorted so that the next document
    by descending key is the next row of its part; ghost_ marks the copies of the first rows of other parts."""
    kind = docs.schema[key].dataType
    base = docs.select(col(key).alias("k"), body(text).alias("t"))
    row = base.withColumn("h", F.xxhash64("t")).withColumn("r", F.monotonically_increasing_id())
    narrow = written(row.select("k", "h", "r", F.octet_length("t").cast("long").alias("bytes")), "keys")
    part, n = cut_into_parts(narrow, kind)
    tops = narrow.select(part(F.col("k"), F.col("h"), F.col("r")).alias("part"), F.struct("k", "h").alias("top")).groupBy("part").agg(F.max("top").alias("top"))
    top = {r["part"]: (r["top"]["k"], r["top"]["h"]) for r in tops.collect()}  # a row per part
    heads, before = [], top[max(top)] if top else None
    for p in range(n):
        if before:
            heads.append((p, *before))
        before = top.get(p, before)
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("hk", kind), T.StructField("hh", T.LongType())])
    heads = spark.createDataFrame(heads, schema)
    wanted = F.broadcast(heads.select("hk", "hh").distinct())  # a row per part
    texts = row.join(wanted, F.col("k").eqNullSafe(F.col("hk")) & (F.col("h") == F.col("hh")), "left_semi").groupBy("k", "h").agg(F.first("t").alias("t"))
    ghosts = texts.join(heads, F.col("k").eqNullSafe(F.col("hk")) & (F.col("h") == F.col("hh"))).select("part", F.lit(True).alias("ghost"), "k", "h", "t")
    real = row.select(part(F.col("k"), F.col("h"), F.col("r")).alias("part"), F.lit(False).alias("ghost"), "k", "h", "t")
    return real.unionByName(ghosts).repartition("part").sortWithinPartitions("part", "ghost", F.desc_nulls_last("k"), "h")


def fingerprints(docs, key="doc_id", text="text"):
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row of docs.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by as many first ones of the next
    document by descending key (all, if it has fewer; after the last comes the first). Null texts count as empty; texts
    without words have the fingerprint '' and are as like as 1 to each other, as 0 to others; a text of few words without
    an anchor, always below K, is one anchor itself. Null keys come last; rows that share a key follow each other by a hash of the text. An empty table stays empty.

    Words are runs without white space: a text without any is one word, whatever its length."""
    rows = beside_next(docs, key, text)
    window = Window.partitionBy("part").orderBy("ghost", F.desc_nulls_last("k"), "h")
    rows = with_anchors(rows, "t", "own")
    rows = rows.select("*", F.lead("t").over(window).alias("next"), F.lead("own").over(window).alias("next_own")).where("not ghost")
    half = F.floor(F.length("t") / 2).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), F.length("t") - half), F.substring(F.col("next"), F.lit(1), half))
    rows = rows.select("k", F.length("t").cast("long").alias("n"), "own", "next_own", edited.alias("e"))
    rows = with_anchors(rows, "e", "new")
    return rows.select(F.col("k").alias(key), F.col("n").alias("n_chars"), F.sha2("e", 256).alias("edited_sha256"), F.array_join("own", "").alias("fingerprint"),
                       F.array_join("new", "").alias("edited_fingerprint"), likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"))
