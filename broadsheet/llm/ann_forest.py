"""Nearest neighbours by a hash-prefix forest: sorted arrays of long hash strings, searched by longest prefix.

Each of TREES trees gives a vector a string of SYMBOLS symbols: the axis, with its sign, that a random rotation brings it
closest to. Vectors of near direction share long prefixes in many trees. The table is dealt into blocks of vectors and
blocks of queries; each pair of blocks is one task's work, of bounded size:

- per tree, the block's strings are sorted once;
- every query descends to the vectors that match its whole string, and all its trees ascend together, one symbol at a
  time, while the ranges of the sorted arrays grow and new candidates are scored exactly;
- it stops as soon as vectors as near as its K-th best so far would have been met with probability CERTAIN, given the
  number of trees and the prefix length; at the empty prefix the whole block has been scored.

So clustered vectors are found deep in the trees, and vectors without near neighbours are searched as far up as they
need: the fewer true neighbours stand out, the more of the block is scored, up to all of it, and no cap decides.
Largest inner product is nearest direction once vectors are filled up to the largest norm with one more component.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window

from .frames import col, written

TREES, SYMBOLS, CERTAIN, VECTORS, QUERIES, K, SEED = 64, 3, 0.9, 4096, 1024, 20, 7


@functools.lru_cache(maxsize=4)
def rotations(size):
    """TREES * SYMBOLS random rotations for vectors of size components."""
    draw = np.random.default_rng(SEED)
    return np.stack([np.linalg.qr(draw.standard_normal((size, size)))[0] for _ in range(TREES * SYMBOLS)]).astype(np.float32)


def strings(vectors):
    """The hash string of each vector in each tree, packed into one whole number (first symbol highest)."""
    size = vectors.shape[1]
    out = np.zeros((len(vectors), TREES), np.int64)
    for k, r in enumerate(rotations(size)):
        turned = vectors @ r
        axis = np.abs(turned).argmax(axis=1)
        symbol = 2 * axis + (turned[np.arange(len(turned)), axis] < 0)
        out[:, k // SYMBOLS] = out[:, k // SYMBOLS] * (2 * size) + symbol
    return out


@functools.lru_cache(maxsize=4)
def chances(size):
    """Cosines and the probability that two vectors at that cosine get the same symbol, by simulation."""
    draw = np.random.default_rng(SEED)
    cosines = np.linspace(-1, 1, 81)
    x, y = (draw.standard_normal((20_000, size)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    symbol = lambda v: (a := np.abs(v).argmax(axis=1)) * 2 + (v[np.arange(len(v)), a] < 0)
    at = symbol(x)
    return cosines, np.maximum.accumulate([np.mean(at == symbol(c * x + np.sqrt(1 - c * c) * y)) for c in cosines])


def ranges(low, high, order):
    """Rows and values of order[low[i]:high[i]] for all i."""
    n = high - low
    rows = np.repeat(np.arange(len(n)), n)
    return rows, order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]


def scored(queries, vectors, rows, columns):
    """Inner products of pairs in double precision, in pieces of bounded size."""
    parts = [np.einsum("ij,ij->i", queries[rows[k:k + 65_536]], vectors[columns[k:k + 65_536]]) for k in range(0, len(rows), 65_536)]
    return np.concatenate(parts) if parts else np.empty(0)


def search(queries, query_keys, own, vectors, keys, ids, largest, k):
    """(row of the query, row of the vector, score) of up to k best per query within a block, ties to the smaller id."""
    n, size = len(vectors), vectors.shape[1] + 1
    by_id = np.argsort(ids, kind="stable")
    vectors, keys, ids = vectors[by_id], keys[by_id], ids[by_id]
    orders = [np.argsort(keys[:, t], kind="stable") for t in range(TREES)]
    arrays = [keys[o, t] for t, o in enumerate(orders)]
    norms = np.linalg.norm(queries, axis=1)
    score = np.full((len(queries), n), -np.inf)
    seen = own[:, None] == ids[None, :]
    active = np.arange(len(queries))
    for level in range(SYMBOLS, -1, -1):
        fresh = np.zeros((len(active), n), bool)
        if level == 0:
            fresh[:] = True
        else:
            unit = (2 * size) ** (SYMBOLS - level)
            for t in range(TREES):
                prefix = query_keys[active, t] // unit
                low, high = np.searchsorted(arrays[t], prefix * unit), np.searchsorted(arrays[t], (prefix + 1) * unit)
                fresh[ranges(low, high, orders[t])] = True
        fresh &= ~seen[active]
        rows, columns = np.nonzero(fresh)
        seen[active] |= fresh
        score[active[rows], columns] = scored(queries, vectors, active[rows], columns)
        if level == 0:
            break
        kth = np.partition(score[active], n - k, axis=1)[:, n - k] if n > k else np.full(len(active), -np.inf)
        cosines, same = chances(size)
        chance = np.interp(kth / (norms[active] * largest), cosines, same) ** level
        active = active[~(np.isfinite(kth) & (1 - (1 - chance) ** TREES >= CERTAIN))]
        if not len(active):
            break
    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(queries)), best.shape[1])
    found = np.isfinite(score[rows, best.ravel()])
    return rows[found], by_id[best.ravel()[found]], score[rows, best.ravel()][found]


def matrix(column, kind):
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(values), -1)


def usable(vectors, key, vector):
    """Rows with an id and a vector of finite components that are not all zero, as (id, vector, size, norm)."""
    v = col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.where(col(key).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    return good.select(col(key).cast("long").alias("id"), v.alias("vector"), F.size(v).alias("size"), F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)).alias("norm"))


def hashed(rows, largest):
    """rows (id, vector, size, norm) with the strings of vectors filled up to norm largest, and those of the bare ones."""
    def each(batches):
        for batch in batches:
            parts = []
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                v = matrix(part.column("vector"), np.float64) / largest
                fill = np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1, keepdims=True)))
                full = strings(np.hstack([v, fill]).astype(np.float32))
                asks = np.flatnonzero(part.column("asks").to_numpy(zero_copy_only=False))
                bare = [None] * len(v)
                if len(asks):
                    unit = v[asks] / np.linalg.norm(v[asks], axis=1, keepdims=True)
                    for k, s in zip(asks, strings(np.hstack([unit, np.zeros((len(asks), 1))]).astype(np.float32))):
                        bare[k] = s
                parts.append(pa.RecordBatch.from_arrays([part.column("id"), part.column("vector"), part.column("size"), pa.array(list(full), pa.list_(pa.int64())), pa.array(bare, pa.list_(pa.int64()))], ["id", "vector", "size", "strings", "asked"]))
            yield from parts

    return rows.mapInArrow(each, "id long, vector array<double>, size int, strings array<long>, asked array<long>")


def nearest(vectors, is_query, key="vec_id", vector="embedding", k=K):
    """query_id, rank (from 1), vec_id, score: the k nearest found of every row for whose id is_query (a function of a column) holds.

    Candidates are all usable rows of the same number of components with another id. Null, zero and not finite vectors
    and null ids take no part. Of repeated query ids the least vector asks; repeated rows are candidates each. With no
    more candidates than k all are returned; an empty table gives an empty result."""
    good = usable(vectors, key, vector).withColumn("asks", F.coalesce(is_query(F.col("id")), F.lit(False)))
    largest, n, m = good.agg(F.max("norm"), F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    n_vectors, n_queries = -(-n // VECTORS) or 1, -(-m // QUERIES) or 1
    table = written(hashed(good.select("id", "vector", "size", "asks"), float(largest or 1)), "strings")
    asks = table.where("asked is not null").groupBy("id", "size").agg(F.min(F.struct("vector", "asked")).alias("least")).select("id", "size", "least.vector", F.col("least.asked").alias("strings"))
    part = lambda name, parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias(name)
    every = lambda name, parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)
    left = asks.select("size", "id", "vector", "strings", part("qb", n_queries)).select("*", every("vb", n_vectors))
    right = table.select("size", "id", "vector", "strings", part("vb", n_vectors)).select("*", every("qb", n_queries))
    limit = float(largest or 1)

    def cell(q, v):
        if not len(q) or not len(v):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, ids = q.column("id").to_numpy(), v.column("id").to_numpy()
        found = search(matrix(q.column("vector"), np.float64), matrix(q.column("strings"), np.int64), own, matrix(v.column("vector"), np.float64), matrix(v.column("strings"), np.int64), ids, limit, k)
        return pa.table({"query_id": own[found[0]], "vec_id": ids[found[1]], "score": found[2]})

    keys = ("size", "qb", "vb")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
