"""Centroid clustering over a VA-file: few-bit cells decide most vectors, full vectors are fetched where intervals overlap.

Components become whole numbers, floor(SCALE * x). The VA-file holds BITS bits per component: the number of the cell that
the component falls into; the cells of a dimension are cut at its quantiles (a mergeable sketch over all vectors). In a
round each task looks up, per centroid, dimension and cell, the least and largest share that a vector in that cell can
have in the squared distance, and adds them up. The share all centroids have in common, the distance from their middle,
is left out of the intervals, which makes them narrow without changing their order. Centroids whose interval lies wholly
above another's are out; a vector with one centroid left is decided. Others are fetched from the table of full vectors
and compared exactly, with the centroids left only.

Sums follow by differences: besides the undecided vectors only those that changed their cluster are fetched, so rounds
that move little read little. The VA-file with the present clusters is written once a round.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .frames import col, release, written

SIZE, SCALE, BITS, CENTROIDS, ROUNDS, SEED = 64, 64, 5, 16, 3, "1"
#: Squared distances over SIZE components up to this stay exact in 64 bits. Spark's sums do too, up to 2**36 vectors.
LARGEST = 2**27
#: Relative error of the quantiles at which cells are cut is one in this.
ACCURACY = 2000


def whole_vectors(vectors, key, vector, size=SIZE, scale=SCALE):
    """(id, v): rows whose vector has exactly size finite components, as whole numbers."""
    v = col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / scale))
    good = vectors.where((F.size(v) == size) & F.coalesce(fine, F.lit(False)))
    return good.select(col(key).alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("int")).alias("v"))


def cell_cuts(whole, size=SIZE, bits=BITS):
    """The lower ends of the cells of each dimension, but for the first: size rows of at most 2**bits - 1 whole numbers."""
    share = [k / 2**bits for k in range(1, 2**bits)]
    found = whole.agg(*[F.percentile_approx(F.get("v", F.lit(j)), share, ACCURACY).alias(f"d{j}") for j in range(size)], *[F.min(F.get("v", F.lit(j))).alias(f"l{j}") for j in range(size)], *[F.max(F.get("v", F.lit(j))).alias(f"h{j}") for j in range(size)]).first()
    if found["d0"] is None:
        return [([], 0, 0)] * size
    return [(sorted({x for x in found[f"d{j}"] if x > found[f"l{j}"]}), found[f"l{j}"], found[f"h{j}"]) for j in range(size)]


def matrix(column, kind=np.int64):
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(values), -1)


def packed(cells, bits):
    """Rows of cell numbers as byte strings of bits bits each."""
    spread = np.unpackbits(cells.astype(np.uint8)[:, :, None], axis=2)[:, :, 8 - bits:]
    return [r.tobytes() for r in np.packbits(spread.reshape(len(cells), -1), axis=1)]


def unpacked(column, size, bits):
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    spread = np.unpackbits(rows, axis=1)[:, :size * bits].reshape(len(rows), size, bits)
    return spread @ (1 << np.arange(bits - 1, -1, -1))


def with_cells(rows, cuts, bits=BITS):
    """row and cells (packed) of rows (row, v)."""
    def each(batches):
        release()
        for batch in batches:
            v = matrix(batch.column(1))
            cells = np.stack([np.searchsorted(c, v[:, j], side="right") for j, (c, _, _) in enumerate(cuts)], axis=1) if len(v) else np.zeros((0, len(cuts)), int)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed(cells, bits), pa.binary())], ["row", "cells"])

    return rows.select("row", "v").mapInArrow(each, "row long, cells binary")


def tables_of(centroids, cuts):
    """Per centroid, dimension and cell: the least and largest part of a squared distance, less the part in common.

    |x - c|^2 = |x - m|^2 - 2 (x - m)(c - m) + |c - m|^2 with the middle m of the centroids: the first term is common."""
    c = np.array(centroids, np.int64)
    middle = np.round(c.mean(axis=0)).astype(np.int64)
    width = 1 + max(len(cut) for cut, _, _ in cuts)
    low = np.zeros((len(c), len(cuts), width))
    high = np.zeros_like(low)
    for j, (cut, first, last) in enumerate(cuts):
        starts, ends = np.array([first, *cut]), np.array([*[x - 1 for x in cut], last])
        away = (c[:, j] - middle[j])[:, None]
        parts = np.stack([away * away - 2 * (x - middle[j])[None, :] * away for x in (starts, ends)])
        low[:, j, :len(starts)], high[:, j, :len(starts)] = parts.min(axis=0), parts.max(axis=0)
    return low, high


def candidates(cells, low, high):
    """Whether each centroid's interval reaches down to the least upper end, per row of cell numbers."""
    dims = np.arange(cells.shape[1])
    lows, highs = (np.stack([t[k][dims, cells].sum(axis=1) for k in range(len(t))], axis=1) for t in (low, high))
    slack = 1e-12 * (1 + np.abs(highs).max())  # of the sums in double precision
    return lows <= highs.min(axis=1, keepdims=True) + slack


def narrowed(va, centroids, cuts, bits):
    """va (row, cells, cluster) with near, the numbers of the centroids that are left."""
    low, high = tables_of(centroids, cuts)

    def each(batches):
        release()
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                left = candidates(unpacked(batch.column(1), len(cuts), bits), low, high)
                ends = np.cumsum([0, *left.sum(axis=1)], dtype=np.int32)
                near = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(left)[1].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, near], ["row", "cells", "cluster", "near"])

    return va.mapInArrow(each, "row long, cells binary, cluster int, near array<int>")


def nearest_of(v, near, centroids):
    """Number and squared distance of the nearest of each row's near centroids, ties to the smaller number."""
    best, where = np.full(len(v), np.iinfo(np.int64).max), np.full(len(v), -1)
    for k, c in enumerate(centroids):
        asked = np.flatnonzero(near[:, k])
        d = ((v[asked] - c) ** 2).sum(axis=1)
        closer = d < best[asked]
        best[asked[closer]], where[asked[closer]] = d[closer], k
    return where, best


def settled(fetched, centroids):
    """row, cluster (before), near and v as they are, now (the cluster) and distance."""
    c = np.array(centroids, np.int64)

    def each(batches):
        release()
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                near = batch.column(2)
                left = np.zeros((len(batch), len(c)), bool)
                left[np.repeat(np.arange(len(batch)), near.value_lengths().to_numpy(zero_copy_only=False)), near.flatten().to_numpy(zero_copy_only=False)] = True
                now, distance = nearest_of(matrix(batch.column(3)), left, c)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(now.astype(np.int32)), pa.array(distance)], ["row", "cluster", "near", "v", "now", "distance"])

    return fetched.select("row", "cluster", "near", "v").mapInArrow(each, "row long, cluster int, near array<int>, v array<int>, now int, distance long")


def assign(va, full, centroids, cuts, bits):
    """One assignment. Returns moved (row, cluster, now, v) of the vectors that change their cluster, and the VA-file with
    the new clusters."""
    left = written(narrowed(va, centroids, cuts, bits), "narrowed")
    wanted = left.where((F.size("near") > 1) | (F.get("near", F.lit(0)) != F.col("cluster")))
    moved = written(settled(wanted.select("row", "cluster", "near").join(full.select("row", "v"), "row"), centroids).where("now <> cluster").select("row", "cluster", "now", "v"), "moved")
    new = left.select("row", "cells", "cluster").join(moved.select("row", "now"), "row", "left")
    return moved, written(new.select("row", "cells", F.coalesce("now", "cluster").alias("cluster")), "va")


def sums_of(moved, sign, cluster, size):
    """Per cluster the count and componentwise sums of what came (sign 1) or went (-1); at most one row per centroid."""
    of = moved.where(F.col(cluster) >= 0).groupBy(F.col(cluster).alias("k")).agg(F.count("*").alias("n"), *[F.sum(F.get("v", F.lit(j)).cast("long")).alias(f"d{j}") for j in range(size)])
    return [(r["k"], sign * r["n"], [sign * r[f"d{j}"] for j in range(size)]) for r in of.collect()]


def clusters(vectors, key="vec_id", vector="embedding", size=SIZE, scale=SCALE, k=CENTROIDS, rounds=ROUNDS, bits=BITS, seed=SEED):
    """key, cluster, distance and v (whole numbers) of every kept vector, and the final centroids (a list of k lists).

    Kept are vectors of exactly size components, none null or not finite (or so large, from 2**27 / scale on, that their
    distances leave 64 bits). Centroids start as the kept vectors with the k smallest SHA-256 of seed:key (a null key
    counts as ''); of repeated keys the smaller vector goes first. With fewer kept vectors there are fewer centroids.
    Ties in distance go to the smaller number, empty clusters keep their centroid, repeated rows count each, an empty
    table stays empty. Other columns play no part."""
    whole = whole_vectors(vectors, key, vector, size, scale)
    full = written(whole.select(F.monotonically_increasing_id().alias("row"), "id", "v"), "vectors")
    lot = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = full.select(lot.alias("lot"), "id", "v").orderBy("lot", "id", "v").limit(k).collect()  # k vectors
    centroids = [list(r["v"]) for r in first]
    if not centroids:
        return full.select(F.col("id").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), "v"), []
    cuts = cell_cuts(full, size, bits)
    va = written(with_cells(full, cuts, bits).withColumn("cluster", F.lit(-1)), "va")
    count, total = [0] * len(centroids), [[0] * size for _ in centroids]
    for _ in range(rounds):
        moved, va = assign(va, full, centroids, cuts, bits)
        for c, n, sums in [*sums_of(moved, 1, "now", size), *sums_of(moved, -1, "cluster", size)]:
            count[c] += n
            total[c] = [a + b for a, b in zip(total[c], sums)]
        centroids = [[t // n for t in total[c]] if (n := count[c]) else centroids[c] for c in range(len(centroids))]
    _, va = assign(va, full, centroids, cuts, bits)
    every = F.array(*[F.array(*map(F.lit, c)) for c in centroids])
    last = va.select("row", "cluster").join(full, "row").withColumn("c", F.get(every, F.col("cluster")))
    apart = F.aggregate(F.zip_with("v", "c", lambda a, b: (a - b).cast("long") * (a - b).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return last.select(F.col("id").alias(key), "cluster", apart.alias("distance"), "v"), centroids


def report(vectors, key="vec_id", vector="embedding", **options):
    """key, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    found, centroids = clusters(vectors, key, vector, **options)
    found = written(found.select(col(key), "cluster", "distance"), "clusters")
    each = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per centroid
    marks = [(each.get(k, 0), ",".join(map(str, c))) for k, c in enumerate(centroids)] or [(0, "")]
    of = F.get(F.array(*[F.struct(F.lit(s).cast("long").alias("s"), F.sha2(F.lit(m), 256).alias("m")) for s, m in marks]), F.col("cluster"))
    return found.select(col(key), "cluster", "distance", of["s"].alias("cluster_inertia"), F.lit(sum(each.values())).cast("long").alias("inertia"), of["m"].alias("centroid_sha256"))
