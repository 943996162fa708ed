"""Chat formatting after collapsing cumulative snapshots.

Systems that log a conversation after every turn leave many conversations that are prefixes of longer ones. Every turn's
hash is tied to its place; their running sums (two numbers of 60 bits per term) are the hashes of all prefixes. A
conversation whose full hash is a proper prefix of another one, or that equals one with a smaller id, is dropped by
anti-joins on distinct hashes; the rest is rendered. Common first turns are one hash however often they were logged.

Turns are ordered by turn, then by a hash of role and text; exact repeats of a row are one turn. A turn without a
conversation id is a conversation of its own. Null roles are 'unknown', null texts empty. Only built-in functions run.
A rendered conversation is one row, so a single conversation has to fit into a row; nothing else is gathered.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window

from .frames import col, written

START, END, UNKNOWN = "<|im_start|>", "<|im_end|>\n", "unknown"


def digits(hashed, start):
    return F.conv(F.substring(hashed, start, 15), 16, 10).cast("decimal(38,0)")


def keyed(turns, conv="conv_id", turn="turn", role="role", text="text"):
    """(id, turn, role, text, h, conv): named inputs, the hash of role and text, and a key without nulls."""
    plain = turns.select(col(conv).alias("id"), col(turn).alias("turn"), col(role).cast("string").alias("role"), col(text).cast("string").alias("text"))
    mark = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-"))
    plain = plain.withColumn("h", F.md5(F.concat(mark("role"), F.lit("\n"), mark("text"))))
    alone = F.concat_ws(":", F.lit("turn"), F.coalesce(F.col("turn").cast("string"), F.lit("")), "h")
    return plain.withColumn("conv", F.coalesce(F.concat(F.lit("id:"), F.col("id").cast("string")), alone))


def prefixes(rows):
    """(id, conv, place, turns, prefix): the hash of each prefix of each conversation."""
    each = rows.select("id", "conv", "turn", "h").distinct()
    group = Window.partitionBy("conv")
    order = group.orderBy("turn", "h")
    each = each.withColumn("place", F.row_number().over(order)).withColumn("turns", F.count("*").over(group))
    tied = F.md5(F.concat_ws(":", "place", "h"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = F.concat_ws(":", F.sum(digits(tied, 1)).over(so_far).cast("string"), F.sum(digits(tied, 16)).over(so_far).cast("string"))
    return each.select("id", "conv", "place", "turns", prefix.alias("prefix"))


def maximal(rows):
    """(conv, copies) of conversations that are no prefix of another one; copies: how many logged ones equal it."""
    steps = written(prefixes(rows), "prefixes")
    whole = steps.where("place = turns").groupBy("prefix").agg(F.min(F.struct("id", "conv")).alias("first"), F.count("*").alias("copies"))
    inner = steps.where("place < turns").select("prefix").distinct()
    return written(whole.join(inner, "prefix", "left_anti").select("first.conv", "copies"), "maximal")


def rendered(turns, conv="conv_id", turn="turn", role="role", text="text", start=START, end=END):
    """conv, n_turns, copies and chat of each maximal conversation; an empty table gives an empty result."""
    rows = keyed(turns, conv, turn, role, text)
    kept = rows.join(maximal(rows), "conv").groupBy("conv").agg(F.first("id").alias("id"), F.first("copies").alias("copies"), F.array_sort(F.collect_set(F.struct("turn", "h", "role", "text"))).alias("turns"))
    one = lambda t: F.concat(F.lit(start), F.coalesce(t["role"], F.lit(UNKNOWN)), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(end))
    return kept.select(F.col("id").alias(conv), F.size("turns").cast("long").alias("n_turns"), "copies", F.array_join(F.transform("turns", one), "").alias("chat"))
