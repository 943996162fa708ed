"""Placement by a permutation-filled lookup table of prime size.

Every shard has its own order of preference over the slots (an offset and a step derived from its name; the size is
prime, so every step visits all slots). Shards take turns; each claims the first slot on its list that is still free,
until none is. A key's hash names a slot, the slot its shard: constant time per row, shards that differ by at most one
slot, and few keys that move when a shard leaves.

The table depends on the number of shards only (SLOTS rows of two integers), never on the data, so it is broadcast.
"""

from pyspark.sql import functions as F

from .frames import col, free_name

SHARDS, SLOTS = 16, 1021


def hashed(value, salt):
    """A whole number below 2^32 from the MD5 of salt and value."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(salt), value)), 1, 8), 16, 10).cast("long")


def lookup(spark, names, slots=SLOTS):
    """(slot, shard) for every slot of the table filled by the shards of these names (slots: a prime above their number)."""
    if slots < len(names) or not names or slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime not below the number of shards")
    shards = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "shard int, name string").withColumn("name", F.col("name"))
    order = shards.select("shard", (hashed(F.col("name"), "offset") % slots).alias("offset"), (hashed(F.col("name"), "step") % (slots - 1) + 1).alias("step"))
    lists = order.agg(F.array_sort(F.collect_list(F.struct("shard", "offset", "step"))).alias("shards"))

    def once(value, body):
        """body(value) with value worked out a single time."""
        return F.transform(F.array(value), body)[0]

    def claim(state, mine):
        free = lambda k: F.get(state["taken"], ((mine["offset"] + k * mine["step"]) % slots).cast("int")) < 0
        first = F.element_at(F.filter(F.sequence(F.get(state["tried"], mine["shard"]), F.lit(slots - 1)), free), 1)
        return once(first, lambda k: once(((mine["offset"] + k * mine["step"]) % slots).cast("int"), lambda slot: F.struct(
            F.transform(state["taken"], lambda was, s: F.when(s == slot, mine["shard"]).otherwise(was)).alias("taken"),
            F.transform(state["tried"], lambda was, s: F.when(s == mine["shard"], k + 1).otherwise(was)).alias("tried"))))

    def turn(state, t):
        return once(F.element_at("shards", (t % len(names) + 1).cast("int")), lambda mine: claim(state, mine))

    start = F.struct(F.array_repeat(F.lit(-1), slots).alias("taken"), F.array_repeat(F.lit(0), len(names)).alias("tried"))
    filled = lists.select(F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), start, turn, lambda s: s["taken"]).alias("taken"))
    return filled.select(F.posexplode("taken").alias("slot", "shard"))


def placed(docs, key="doc_id", shards=SHARDS, slots=SLOTS, name="shard"):
    """docs with the slot and the shard of each row, by the hash of its key; also returns the two columns' names.

    Rows with equal keys share a shard; null keys hash as the empty text. The number of rows of a key does not matter,
    since nothing is shuffled. An empty table stays empty."""
    names = [f"shard-{k}" for k in range(shards)] if isinstance(shards, int) else list(shards)
    slot, shard = free_name(docs, "slot"), free_name(docs, name)
    table = F.broadcast(lookup(docs.sparkSession, names, slots).toDF("slot_", "shard_"))
    at = docs.withColumn(slot, (hashed(F.coalesce(col(key).cast("string"), F.lit("")), "key") % slots).cast("int"))
    return at.join(table, F.col(slot) == F.col("slot_")).drop("slot_").withColumnRenamed("shard_", shard), (slot, shard)


def write_shards(docs, path, key="doc_id", shards=SHARDS, slots=SLOTS):
    """docs as Parquet, a folder per shard (column shard; shard_ and so on where docs has one). No shuffle: each task adds
    a file to each shard that it has rows for."""
    found, (slot, shard) = placed(docs, key, shards, slots)
    found.drop(slot).write.partitionBy(shard).parquet(path)
    return shard
