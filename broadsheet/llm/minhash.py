"""Near-duplicates by b-bit MinHash: bands of minima give candidates, packed low bits estimate them, full sets decide.

1. Each text becomes its set of distinct five-word shingles (64-bit hashes), HASHES minima of it, BANDS band keys from
   ROWS minima each, and a signature that keeps only BITS low bits of every scrambled minimum, packed into 64-bit words.
   (Low bits of a minimum itself depend on low bits of its hash alone: two hashes would agree at all places or at none.)
2. Texts with the same set are one class from here on; copies never multiply anything.
3. In each band bucket every class is paired with one class only, drawn by a hash of bucket and class: within a large
   group of near copies a class meets another partner in every bucket it shares. Pairs whose collision-corrected
   estimate (by bit counts of the XORed signatures) and sizes allow the limit are compared on their full sets. A set
   under SMALL shingles is cheaper to compare than to estimate: there the sizes alone decide.
4. Classes that this leaves outside the component of their bucket's drawn class are paired with everything in the
   bucket that is still in another component, inside one join that lets only promising pairs through. So no link is
   lost, yet a bucket of near copies costs pairs in proportion to its size.
5. Components of the confirmed links give each document its group.

A pair at the limit 0.75 shares a bucket with probability 1 - (1 - 0.75^4)^32 = 0.999995. The estimate has a standard
error of 0.023 there and is cut at 0.65, for sets of SMALL shingles and more.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .components import connected
from .frames import body, col, free_name, release, written

SHINGLE, BANDS, ROWS, HASHES, BITS, LEAST_ESTIMATE = 5, 32, 4, 512, 2, 0.65
LONGS = HASHES * BITS // 64
#: Pairs with a smaller set than this skip the estimate.
SMALL = 64
#: Outer classes of a bucket that meet the bucket in one task.
PART = 128
_DRAW = np.random.default_rng(20240229)
_MIX = _DRAW.integers(1, 2**63, SHINGLE, np.uint64) | np.uint64(1)
_TIMES = _DRAW.integers(0, 2**32, HASHES, np.uint32) | np.uint32(1)
_PLUS = _DRAW.integers(0, 2**32, HASHES, np.uint32)
_BAND = _DRAW.integers(1, 2**63, (BANDS, ROWS), np.uint64) | np.uint64(1)
SIGNS = [f"s{k}" for k in range(LONGS)]


def scrambled(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text):
    """The sorted distinct shingle hashes of UTF-8 bytes; A-Z lower-cased; fewer than five words are one shingle."""
    words = text.lower().split()
    n = len(words)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), n)] if n else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    return np.unique(scrambled(sum(h[k:n - SHINGLE + 1 + k] * _MIX[k] for k in range(SHINGLE))))


def minima(found):
    """HASHES minima of a set, in blocks that stay in the processor's cache."""
    high = (found >> np.uint64(32)).astype(np.uint32)
    blocks = [(_TIMES[:, None] * high[None, k:k + 256] + _PLUS[:, None]).min(axis=1) for k in range(0, len(high), 256)]
    return np.minimum.reduce(blocks)


def keys_and_signature(found):
    m = minima(found).astype(np.uint64)
    keys = scrambled((m[:BANDS * ROWS].reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    low = (scrambled(m) & np.uint64(2**BITS - 1)).reshape(LONGS, 64 // BITS)
    signature = np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1)
    return keys.view(np.int64), signature.view(np.int64)


def fingerprint(found):
    return xxhash.xxh3_128_digest(found.tobytes())


def sign(docs, key):
    """key, class (fingerprint of the set, null without words), size, band keys and signature of each row of (key, text)."""
    kind = docs.schema[0].dataType.simpleString()

    def each(batches):
        release()
        for batch in batches:
            rows = [shingles(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            marks = [keys_and_signature(r) if len(r) else (None, None) for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([fingerprint(r) if len(r) else None for r in rows], pa.binary()), pa.array([len(r) for r in rows], pa.int64()),
                pa.array([k for k, _ in marks], pa.list_(pa.int64())), *[pa.array([None if s is None else s[k] for _, s in marks], pa.int64()) for k in range(LONGS)]],
                [key, "class", "size", "keys", *SIGNS])

    return docs.mapInArrow(each, f"`{key}` {kind}, class binary, size long, keys array<long>, " + ", ".join(f"{s} long" for s in SIGNS))


def sets(docs):
    """class and sorted shingle hashes of each row of (key, text)."""
    def each(batches):
        release()
        for batch in batches:
            rows = [r for r in (shingles(t.as_py()) for t in batch.column(1).cast(pa.binary())) if len(r)]
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(r) for r in rows], pa.binary()), pa.array([r.view(np.int64) for r in rows], pa.list_(pa.int64()))], ["class", "found"])

    return docs.mapInArrow(each, "class binary, found array<long>")


def promising(x, y, percent):
    """Whether sizes and, unless a set is small, the collision-corrected estimate of two signatures leave room for the limit."""
    differing = F.lit(0)
    for s in SIGNS:
        d = F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))
        step = 1
        while step < BITS:
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
            step *= 2
        differing = differing + F.bit_count(d.bitwiseAND(F.lit(sum(1 << k for k in range(0, 64, BITS)))))
    chance = 2.0**-BITS
    most = int(HASHES * (1 - (LEAST_ESTIMATE * percent / 75 * (1 - chance) + chance)))
    a, b = F.col(f"{x}.size"), F.col(f"{y}.size")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((F.least(a, b) < SMALL) | (differing <= most))


def full_sets(classes, docs, key, nodes):
    """class and found (its full set) of the given classes, built from one text each."""
    ids = written(nodes.join(classes, "class", "left_semi").select(F.col("least").alias("id"), "class"), "ids")
    texts = docs.join(ids.select("id").distinct(), col(key).eqNullSafe(F.col("id")), "left_semi")
    return written(sets(texts).join(ids.select("class"), "class", "left_semi").groupBy("class").agg(F.first("found").alias("found")), "sets")


def similar(x, y, percent):
    """Whether two full sets are as similar as asked."""
    common = F.size(F.array_intersect(x, y))
    return 100 * common >= percent * (F.size(x) + F.size(y) - common)


def confirmed(pairs, docs, key, nodes, percent):
    """The pairs (a, b) of classes whose full sets are similar enough."""
    full = full_sets(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), docs, key, nodes)
    both = pairs.join(full.toDF("a", "fa"), "a").join(full.toDF("b", "fb"), "b")
    return written(both.where(similar(F.col("fa"), F.col("fb"), percent)).select("a", "b"), "links")


def across(rest, docs, key, nodes, percent):
    """The links between classes of one bucket that are still in different components, at least one of them outside the
    component of the bucket's drawn class.

    First each side keeps the rows that have a promising partner at all (semi-joins, so no pairs are made), each pair
    counting in the first bucket it shares; then their full sets meet inside the join, and only links come out."""
    first = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.bucket")
    apart = F.expr("x.bucket = y.bucket and x.root <> y.root and (not y.out or x.class < y.class) and y.class <> y.pivot")
    maybe = apart & promising("x", "y", percent) & first
    out = rest.where("out")
    hopeful = out.alias("x").join(rest.alias("y"), maybe, "left_semi").union(rest.alias("y").join(out.alias("x"), maybe, "left_semi")).distinct()
    hopeful = written(hopeful, "hopeful")
    # A bucket's outer classes are split into parts of about PART, each of which meets the whole bucket in a task of its own.
    parts = hopeful.where("out").groupBy("bucket").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    cells = hopeful.join(parts, "bucket").join(full_sets(hopeful.select("class").distinct(), docs, key, nodes), "class")
    left = cells.where("out").withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int")).repartition("bucket", "part")
    right = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).repartition("bucket", "part")
    pairs = left.alias("x").join(right.alias("y"), maybe & F.expr("x.part = y.part") & similar(F.col("x.found"), F.col("y.found"), percent))
    return written(pairs.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")), "late_links")


def groups(docs, key="doc_id", text="text", percent=75):
    """key, class, n_shingles, root (the class's component) and component_id of each row of docs.

    Rows without words (null or blank texts) have 0 shingles, no class, and are linked with nothing. Repeated rows are
    copies of each other. Null keys take part; component_id is the least key that is not null. An empty table stays
    empty. Very long texts only make larger sets."""
    docs = docs.select(col(key), body(text).alias(free_name(docs, "body")))
    signed = written(sign(docs, key), "signed")
    firsts = [F.first(c).alias(c) for c in ("size", "keys", *SIGNS)]
    nodes = written(signed.where("class is not null").groupBy("class").agg(F.min(col(key)).alias("least"), *firsts), "classes")
    signs = nodes.select("class", "size", *SIGNS)
    each = nodes.select("class", F.explode("keys").alias("bucket"))
    drawn = F.min(F.struct(F.xxhash64("bucket", "class").alias("lot"), F.col("class").alias("pivot")))
    several = each.groupBy("bucket").agg(drawn.alias("drawn"), F.count("*").alias("n")).where("n > 1").select("bucket", "drawn.pivot")
    shared = written(each.join(several, "bucket"), "buckets")

    stars = shared.where("class <> pivot").select(F.greatest("pivot", "class").alias("a"), F.least("pivot", "class").alias("b")).distinct()
    stars = stars.join(signs.alias("x"), F.col("a") == F.col("x.class")).join(signs.alias("y"), F.col("b") == F.col("y.class")).where(promising("x", "y", percent))
    links = confirmed(written(stars.select("a", "b"), "stars"), docs, key, nodes, percent)
    roots = written(connected(links), "roots")

    root_of = lambda df, of, name: df.join(roots.toDF("node_", name), F.col(of) == F.col("node_"), "left").drop("node_").withColumn(name, F.coalesce(name, of))
    placed = root_of(root_of(shared, "class", "root"), "pivot", "pivot_root")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("bucket")
    rest = placed.join(mixed, "bucket", "left_semi").join(nodes.drop("least"), "class").withColumn("out", F.expr("root <> pivot_root"))
    more = across(written(rest, "rest"), docs, key, nodes, percent)
    if not more.isEmpty():
        roots = written(connected(links.union(more)), "roots")

    in_group = nodes.select("class", "least").join(roots.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = in_group.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(in_group.select("class", "root").join(least, "root"), "named")
    out = signed.select(col(key), "class", F.col("size").alias("n_shingles")).join(named, "class", "left")
    return out.withColumn("component_id", F.when(F.col("class").isNull(), col(key)).otherwise(F.col("component_id")))


def near_duplicates(docs, key="doc_id", text="text", percent=75):
    """key, n_shingles, component_id and kept (whether the row's key is its component's least) of each row of docs."""
    found = groups(docs, key, text, percent)
    return found.select(col(key), "n_shingles", "component_id", col(key).eqNullSafe(F.col("component_id")).alias("kept"))


def one_per_group(docs, key="doc_id", text="text", percent=75):
    """The rows of docs without near copies: of each component the row with the least key, of repeated rows one.

    Rows without words all stay. Keys that stand in several rows are settled row by row; all others by key alone."""
    kind = F.arrow_udf(class_of, "binary")
    found = written(groups(docs, key, text, percent).select(col(key).alias("key_"), "class", "root", col(key).eqNullSafe(F.col("component_id")).alias("kept")), "groups")
    several = written(found.groupBy("key_").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("n > 1 or not kept").withColumn("again", F.expr("n > 1")), "settled")
    left = docs.join(several.select("key_"), col(key).eqNullSafe(F.col("key_")), "left_anti")
    repeated = several.where("again").select("key_")
    if repeated.isEmpty():
        return left
    name, row = free_name(docs, "class"), free_name(docs, "row")
    rows = docs.join(repeated, col(key).eqNullSafe(F.col("key_")), "left_semi")
    rows = written(rows.withColumn(name, kind(body(text))).withColumn(row, F.monotonically_increasing_id()), "repeated")
    good = found.where("kept").select("key_", F.col("class").alias("class_"), "root").distinct()
    rows = rows.join(good, col(key).eqNullSafe(F.col("key_")) & col(name).eqNullSafe(F.col("class_")))
    first = rows.where(F.col("root").isNotNull()).groupBy("key_", "root").agg(F.min(row).alias("first_"))
    blank = rows.where(F.col("root").isNull()).select(F.col(row).alias("first_"))
    chosen = first.select("first_").union(blank)
    return left.union(rows.join(chosen, col(row) == F.col("first_"), "left_semi").select(*map(col, docs.columns)))


def class_of(texts: pa.Array) -> pa.Array:
    """The class of each text: the fingerprint of its set, null without words."""
    rows = (shingles(t.as_py()) for t in texts.cast(pa.binary()))
    return pa.array([fingerprint(r) if len(r) else None for r in rows], pa.binary())
