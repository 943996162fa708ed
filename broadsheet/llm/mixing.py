"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree over blocks.

1. A source's size is its number of words. Targets share GROWTH times all words by weight; none is above LIMIT times its
   source, and what is cut off goes to the others by weight (closed form over the sources in order of size by weight).
2. Rows fall by the hash of their key into BUCKETS per source, neighbouring buckets form blocks of about one BLOCKS-th
   of all words (LEAST_BLOCK at least). A source takes whole passes over its blocks, then further blocks in permuted order up to its target;
   of the last block it takes rows in permuted order that still fit. What is then left of the target goes to the blocks
   behind it in the same way, until no row of a block behind fits.
3. The numbers of blocks drawn per source are the quotas. A binary tree over the output shards splits them: in each node
   the anonymous draws are ranked by a hash and the first go left, so the counts per source follow the multivariate
   hypergeometric distribution and every shard gets its exact number of blocks. A source's permuted draws are then
   dealt out by these quotas, disjointly, and each shard is shuffled by itself.

Only built-in functions run. What is not spread over tasks is the table of sources and of block draws: at most
LIMIT * (BLOCKS + number of sources) short rows, whatever the number of documents.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window

from .frames import body, col, free_name, written

WEIGHTS, GROWTH, LIMIT, BUCKETS, BLOCKS, LEAST_BLOCK, SHARDS, ROUNDS, SEED = (3, 1, 2), 1.5, 2, 1024, 4096, 50_000, 64, 4, "mix"


def words_in(text):
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sized(docs, key, text, source, carry=()):
    """The columns of carry, named c0, c1 and so on, and source_, size_, perm_ (permutation key) and bucket_ of each row."""
    out = docs.select(*[col(c).alias(f"c{k}") for k, c in enumerate(carry)], col(key).cast("string").alias("key_"), col(source).alias("source_"), words_in(body(text)).alias("size_"))
    out = out.withColumn("perm_", F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce("key_", F.lit("")), F.col("size_").cast("string")))).drop("key_")
    return out.withColumn("bucket_", F.pmod(F.conv(F.substring("perm_", 1, 8), 16, 10).cast("long"), F.lit(BUCKETS)).cast("int"))


def targets(sources):
    """target_ of each source of (source_, source_size_), in double precision."""
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(Window.orderBy(F.col("source_").asc_nulls_last())) - 1) % len(WEIGHTS) + 1)
    given = sources.withColumn("weight_", weights).withColumn("ratio", LIMIT * F.col("source_size_") / F.col("weight_"))
    everything, before = Window.partitionBy(), Window.orderBy("ratio", "source_").rowsBetween(Window.unboundedPreceding, -1)
    left = GROWTH * F.sum("source_size_").over(everything) - LIMIT * F.coalesce(F.sum("source_size_").over(before), F.lit(0))
    share = left / (F.sum("weight_").over(everything) - F.coalesce(F.sum("weight_").over(before), F.lit(0)))
    # The first source, in order of ratio, that its share does not overfill fixes the words per weight for itself and all after it.
    fits = F.when(F.col("share") <= F.col("ratio"), F.struct("ratio", "source_", "share"))
    level = given.withColumn("share", share).withColumn("level", F.min(fits).over(everything)["share"])
    return level.select("source_", "source_size_", F.least(LIMIT * F.col("source_size_").cast("double"), F.coalesce("level", F.lit(0.0)) * F.col("weight_")).alias("target_"))


def block_plan(rows):
    """Buckets with their block, and per source and block: words, rank in the permutation, whole passes over the source's
    blocks, and how many words of the last, broken pass the block gives (given)."""
    buckets = written(rows.groupBy("source_", "bucket_").agg(F.sum("size_").alias("words"), F.min(F.when(F.col("size_") > 0, F.col("size_"))).alias("least")), "bucket_sizes")
    aims = written(targets(buckets.groupBy("source_").agg(F.sum("words").alias("source_size_"))), "targets")
    total = F.sum("source_size_").over(Window.partitionBy())
    aims = aims.withColumn("blocks", F.least(F.lit(BUCKETS), F.greatest(F.lit(1), F.ceil(F.col("source_size_") / F.greatest(total / BLOCKS, F.lit(LEAST_BLOCK))))).cast("int"))
    named = buckets.join(aims.withColumnRenamed("source_", "s"), F.col("source_").eqNullSafe(F.col("s"))).drop("s")
    named = written(named.withColumn("block", F.floor(F.col("bucket_") * F.col("blocks") / BUCKETS).cast("int")), "buckets")
    plan = named.groupBy("source_", "source_size_", "target_", "block").agg(F.sum("words").alias("words"), F.min("least").alias("least"))
    order = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce("source_", F.lit("")), F.col("block").cast("string")))
    group = Window.partitionBy("source_")
    upto = group.orderBy(order, "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passes = F.when(F.col("source_size_") > 0, F.floor(F.col("target_") / F.col("source_size_"))).otherwise(0).cast("int")
    plan = plan.withColumn("passes", passes).withColumn("rank", F.row_number().over(upto)).withColumn("seen", F.sum("words").over(upto)).withColumn("present", F.count("*").over(group).cast("int"))
    rest = F.floor(F.col("target_")).cast("long") - F.col("passes") * F.col("source_size_")
    given = F.greatest(F.lit(0), F.least(F.col("words"), rest - (F.col("seen") - F.col("words"))))
    return named.select("source_", "bucket_", "block"), written(plan.withColumn("given", given), "plan")


def cuts(rows, named, last):
    """(source_, block, steps, left) of each source's block in last (source_, block, given): the ranges of permutation
    keys whose rows up to a size go, and how many words of given are left.

    A row that no longer fits is passed over and smaller ones behind it get their turn, ROUNDS times."""
    last = last.select(F.col("source_").alias("s"), F.col("block").alias("b"), F.col("given").alias("left"))
    of = named.join(last, named["source_"].eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).select(F.col("s").alias("rs"), F.col("bucket_").alias("rb"))
    some = written(rows.join(of, F.col("source_").eqNullSafe(F.col("rs")) & (F.col("bucket_") == F.col("rb"))).where("size_ > 0").select("rs", "perm_", "size_"), "last_rows")
    state = last.select("s", "b", "left", F.lit("").alias("cut"), F.array().cast("array<struct<from:string,to:string,size:bigint>>").alias("steps"))
    upto = Window.partitionBy("s").orderBy("perm_").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    for _ in range(ROUNDS):
        fits = some.join(state, F.col("rs").eqNullSafe(F.col("s"))).where("perm_ > cut and size_ <= left")
        taken = fits.withColumn("sum", F.sum("size_").over(upto)).where("sum <= left").groupBy(F.col("s").alias("ts")).agg(F.max("perm_").alias("to"), F.max("sum").alias("took"))
        step = F.struct(F.col("cut").alias("from"), F.coalesce("to", "cut").alias("to"), F.col("left").alias("size"))
        state = written(state.join(taken, F.col("s").eqNullSafe(F.col("ts")), "left").select(
            "s", "b", (F.col("left") - F.coalesce("took", F.lit(0))).alias("left"), F.coalesce("to", "cut").alias("cut"), F.array_append("steps", step).alias("steps")), "cuts")
    return state.select(F.col("s").alias("source_"), F.col("b").alias("block"), "steps", "left")


def filled(rows, named, plan):
    """plan with given also for the blocks behind a source's broken block, and the steps of every broken block.

    What a broken block leaves goes to the blocks behind it that have a row small enough: whole ones first, then the next
    broken one. Every turn gives at least a row (or passes a block of repeated rows), so a source ends short by less than
    the smallest row of the blocks behind its last broken one."""
    broken = plan.where("given > 0 and given < words").select("source_", "block", "rank", "given")
    steps, extra = None, None
    upto = Window.partitionBy("source_").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        cut = cuts(rows, named, broken)
        steps = cut.drop("left") if steps is None else steps.union(cut.drop("left"))
        over = cut.select(F.col("source_").alias("os"), F.col("block").alias("ob"), F.col("left").alias("over")).where("over > 0")
        over = over.join(broken, F.col("os").eqNullSafe(F.col("source_")) & (F.col("ob") == F.col("block"))).select("os", "over", F.col("rank").alias("behind"))
        behind = plan.join(over, F.col("source_").eqNullSafe(F.col("os"))).where("rank > behind and least <= over").withColumn("seen", F.sum("words").over(upto))
        more = behind.withColumn("given", F.least(F.col("words"), F.col("over") - (F.col("seen") - F.col("words")))).where("given > 0")
        more = written(more.select("source_", "block", "rank", "given", "words"), "behind")
        if more.isEmpty():
            break
        extra = more if extra is None else extra.union(more)
        broken = more.where("given < words").drop("words")
    if extra is not None:
        extra = extra.select(F.col("source_").alias("es"), F.col("block").alias("eb"), F.col("given").alias("also"))
        plan = plan.join(extra, F.col("source_").eqNullSafe(F.col("es")) & (F.col("block") == F.col("eb")), "left")
        plan = written(plan.withColumn("given", F.coalesce("also", "given")).drop("es", "eb", "also"), "plan")
    return plan, steps


def split_quotas(plan, shards):
    """(source_, shard, number): which shard gets a source's number-th draw, by the splitting tree over the quotas."""
    n = F.col("passes") * F.col("present") + F.col("extra")
    quota = plan.groupBy("source_", "passes", "present").agg(F.sum((F.col("given") > 0).cast("int")).alias("extra")).select("source_", n.cast("int").alias("n")).where("n > 0")
    nodes = quota.select("source_", "n", F.lit(0).alias("low"), F.lit(shards).alias("high"))
    width, node = shards, Window.partitionBy("low")
    while width > 1:
        width = (width + 1) // 2
        token = nodes.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).withColumn("middle", F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int"))
        lot = F.md5(F.concat_ws(":", F.lit(SEED), "low", "high", F.coalesce("source_", F.lit("")), "i"))
        rank = F.row_number().over(node.orderBy(lot, F.col("source_"), "i"))
        share = F.round(F.count("*").over(node) * (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low")))
        token = token.withColumn("left", rank <= share)
        child = token.select("source_", F.expr("if(left, low, middle)").alias("low"), F.expr("if(left, middle, high)").alias("high"))
        nodes = child.groupBy("source_", "low", "high").agg(F.count("*").cast("int").alias("n"))
    dealt = nodes.withColumn("end", F.sum("n").over(Window.partitionBy("source_").orderBy("low")).cast("int"))
    return dealt.select("source_", F.col("low").alias("shard"), F.explode(F.sequence(F.col("end") - F.col("n") + 1, F.col("end"))).alias("number"))


def draws(plan, shards):
    """(source_, block, draws): an array of (turn, shard, part) per block, part true for a block that is drawn in part.

    The broken pass numbers only the blocks that give something, as its quota counts only these."""
    none = F.array().cast("array<int>")
    turns = F.concat(F.when(F.col("passes") > 0, F.sequence(F.lit(1), "passes")).otherwise(none), F.when(F.col("given") > 0, F.array(F.col("passes") + 1)).otherwise(none))
    part = (F.col("turn") > F.col("passes")) & (F.col("given") < F.col("words"))
    giving = F.sum((F.col("given") > 0).cast("int")).over(Window.partitionBy("source_").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = (F.col("turn") - 1) * F.col("present") + F.when(F.col("turn") > F.col("passes"), F.col("giving")).otherwise(F.col("rank"))
    each = plan.withColumn("giving", giving).withColumn("turn", F.explode(turns)).select(F.col("source_").alias("s"), F.col("block").alias("b"), "turn", part.alias("part"), place.alias("place"))
    dealt = split_quotas(plan, shards)
    placed = each.join(dealt, F.col("s").eqNullSafe(F.col("source_")) & (F.col("place") == F.col("number")))
    return placed.groupBy(F.col("s").alias("source_"), F.col("b").alias("block")).agg(F.array_sort(F.collect_list(F.struct("turn", "shard", "part"))).alias("draws"))


def bucket_plan(rows, shards):
    """Per source and bucket: source_size_, target_, draws and steps (null where the block is whole or not drawn)."""
    named, plan = block_plan(rows)
    plan, steps = filled(rows, named, plan)
    out = named
    for more in (plan.select("source_", "block", "source_size_", "target_"), written(draws(plan, shards), "draws"), steps):
        more = more.withColumnRenamed("source_", "ms").withColumnRenamed("block", "mb")
        out = out.join(more, F.col("source_").eqNullSafe(F.col("ms")) & (F.col("block") == F.col("mb")), "left").drop("ms", "mb")
    return written(out.select(F.col("source_").alias("ps"), F.col("bucket_").alias("pb"), "source_size_", "target_", "draws", "steps"), "bucket_plan")


def drawn(docs, key="doc_id", text="text", source="source", carry=None, shards=SHARDS):
    """The columns of carry (default: all of docs), with a struct of size, source_size, target, draws and perm per row,
    and the struct's name. draws holds (turn, shard) for every time the row is taken, whole.

    Null texts have no words and are taken as their block is; a null source is a source of its own, last in order; null
    keys and rows equal in key and size share a place in the permutation. An empty table stays empty."""
    carry = list(docs.columns if carry is None else carry)
    name = free_name(docs, "mix")
    wide = text in carry
    rows = sized(docs, key, text, source, carry)
    if not wide:
        rows = written(rows, "sized")
    narrow = written(rows.select("source_", "size_", "perm_", "bucket_"), "sized") if wide else rows
    plan = bucket_plan(narrow, shards)
    both = rows.join(plan, F.col("source_").eqNullSafe(F.col("ps")) & (F.col("bucket_") == F.col("pb")), "left")
    fits = F.exists("steps", lambda x: (F.col("perm_") > x["from"]) & (F.col("perm_") <= x["to"]) & (F.col("size_") <= x["size"]) & (F.col("size_") > 0))
    taken = F.coalesce(F.filter("draws", lambda d: ~d["part"] | F.coalesce(fits, F.lit(False))), F.array().cast("array<struct<turn:int,shard:int,part:boolean>>"))
    mix = F.struct(F.col("size_").alias("size"), F.col("source_size_").alias("source_size"), F.col("target_").alias("target"), taken.alias("draws"), F.col("perm_").alias("perm"))
    # Named in a step of its own: in one select, a carried column's name would hide a column used inside a lambda.
    both = both.select(*[f"c{k}" for k in range(len(carry))], mix.alias("mix_"))
    return both.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(carry)], F.col("mix_").alias(name)), name


def mixed(docs, key="doc_id", text="text", source="source", shards=SHARDS):
    """The mix itself: a row of docs for every time it is taken, dealt to its shards (a partition each), and each shuffled by itself."""
    found, name = drawn(docs, key, text, source, shards=shards)
    turn = free_name(found, "turn")
    each = found.withColumn(turn, F.explode(col(name)["draws"]))
    place = F.md5(F.concat_ws(":", F.lit(SEED), F.col(turn)["turn"], col(name)["perm"]))
    return each.repartitionById(shards, F.col(turn)["shard"]).sortWithinPartitions(F.col(turn)["shard"], place).select(*map(col, docs.columns))
