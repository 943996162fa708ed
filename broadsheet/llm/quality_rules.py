"""Quality rules with thresholds that follow each language and source.

Every document gets a few integer measures. Their distributions are kept as mergeable quantile sketches: counts per
bucket, a bucket holding the values with the same six leading bits after the first (relative error under 1/64), at most
some 3,700 buckets however many documents there are. Sketches add up, so those of a (language, source) give those of the
language and of everything.

The fences of a group lie REACH times the distance from its median to its outer tenth beyond that tenth, on either side.
(Tenths, because junk may be some hundredths of a group and must not set its own fence. A least distance per measure, about
its rounding on a short text, counts where nine tenths have the same value.) Small groups have no sure tails, so
fences are shrunk: a language's toward everything's, a source's toward its language's, with the weight of PRIOR documents.
The fences are joined to the documents by language and source.

Only built-in functions run here. Windows of words are compared by 64-bit hashes within one text.
"""

from pyspark.sql import functions as F

from .frames import WORD_SPACE, body, col, free_name, written

REACH, PRIOR, WINDOW = 6, 200, 8
#: Measure: what it is, and the least distance from median to tenth that its fences count with.
MEASURES = {
    "symbols": ("1000 * symbols / characters of words", 5),
    "word_length": ("100 * characters of words / words", 5),
    "dup_lines": ("1000 * repeated lines / lines with a word", 50),
    "repeats": ("1000 * words in repeated windows / words", 35),
    "capitals": ("1000 * letters A-Z / characters of words", 5),
}
TWO_SIDED = ("word_length",)
SPACES = " \t\n\x0b\f\r"


def word_columns(text):
    """Words, lines with a word, and character counts of a text column, as one struct."""
    return F.struct(
        F.filter(F.split(text, WORD_SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"))


def windows_of(hashes):
    """A 64-bit hash of every window of WINDOW words, by its first word, from the hashes of the words."""
    each = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(F.size(hashes) >= WINDOW, each).otherwise(F.array().cast("array<bigint>"))


def repeat_words(windows):
    """Words in windows found twice or more: equal hashes stand side by side once sorted with their places."""
    def starts(a):
        same = lambda x, k: F.coalesce(F.get(a, k)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(a, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def cover(s, i):
        return F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last"))

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    covered = F.aggregate(F.transform(F.array(placed), starts)[0], F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), cover, lambda s: s["n"])
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered).otherwise(F.lit(0)).cast("long")


def with_features(docs, text, carry, name):
    """The columns of carry and a struct column of the features of text."""
    w, counts, hashes, windows = (free_name(docs, n) for n in ("w", "counts", "hashes", "windows"))
    keys, part = [col(c) for c in carry], F.col(w)
    found = F.struct(
        F.size(part["words"]).cast("long").alias("n_words"), F.length(F.array_join(part["words"], "")).cast("long").alias("word_chars"),
        part["n_symbols"].alias("n_symbols"), (F.size(part["lines"]) - F.size(F.array_distinct(part["lines"]))).cast("long").alias("n_dup_lines"),
        F.size(part["lines"]).cast("long").alias("n_lines"), part["n_capitals"].alias("n_capitals"))
    step = docs.select(*keys, word_columns(body(text)).alias(w))
    step = step.select(*keys, found.alias(counts), F.transform(part["words"], lambda x: F.xxhash64(x)).alias(hashes))
    step = step.select(*keys, F.col(counts), windows_of(F.col(hashes)).alias(windows))
    return step.select(*keys, F.col(counts).withField("n_repeat_words", repeat_words(F.col(windows))).alias(name))


def measures(f):
    """The measures of a features struct, as whole numbers; null where they would divide by nothing."""
    whole = lambda k, a, b: F.when(f[b] > 0, F.floor((k * f[a] - (k * f[a]) % f[b]) / f[b]))
    return {"symbols": whole(1000, "n_symbols", "word_chars"), "word_length": whole(100, "word_chars", "n_words"), "dup_lines": whole(1000, "n_dup_lines", "n_lines"),
            "repeats": whole(1000, "n_repeat_words", "n_words"), "capitals": whole(1000, "n_capitals", "word_chars")}


def bucket_of(value):
    """The sketch bucket of a whole number from 0: all but its seven leading bits set to zero."""
    return value - value % F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - 7, F.lit(0)))


def sketches(found, name, lang, source):
    """One row per group, measure and bucket with the number of documents; level 2 is (lang, source), 1 lang, 0 all.

    Only documents that pass the base rules shape the distributions."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("value")) for m, v in measures(col(name)).items()]))
    each = found.where(~base_failed(col(name))).select(col(lang).alias("g_lang"), col(source).alias("g_source"), values.alias("m"))
    fine = each.groupBy("g_lang", "g_source", F.col("m.measure").alias("measure"), bucket_of(F.col("m.value")).alias("bucket")).agg(F.count("*").alias("n")).withColumn("level", F.lit(2))
    wide = fine.groupBy("g_lang", F.lit(None).cast("string").alias("g_source"), "measure", "bucket").agg(F.sum("n").alias("n")).withColumn("level", F.lit(1))
    every = fine.groupBy(F.lit(None).cast("string").alias("g_lang"), F.lit(None).cast("string").alias("g_source"), "measure", "bucket").agg(F.sum("n").alias("n")).withColumn("level", F.lit(0))
    return fine.unionByName(wide).unionByName(every)


def tenth(buckets, all_, k):
    """The k-th tenth of sorted (bucket, n): the first bucket up to which k of ten documents lie."""
    none = F.lit(None).cast("long")
    step = lambda s, x: F.struct((s["seen"] + x["n"]).alias("seen"), F.coalesce(s["at"], F.when((s["seen"] + x["n"]) * 10 >= all_ * k, x["bucket"])).alias("at"))
    return F.aggregate(buckets, F.struct(F.lit(0).cast("long").alias("seen"), none.alias("at")), step, lambda s: s["at"])


def fences(sketch, reach=REACH):
    """Lower and upper fence of every group and measure: level, g_lang, g_source, measure, low, high, n.

    A group's buckets fit into a row: some 3,700 at most."""
    rows = sketch.groupBy("level", "g_lang", "g_source", "measure").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("buckets"))
    rows = rows.select("level", "g_lang", "g_source", "measure", "n", *[tenth(F.col("buckets"), F.col("n"), k).alias(f"q{k}") for k in (1, 5, 9)])
    least = F.create_map(*[F.lit(x) for m, (_, least) in MEASURES.items() for x in (m, least)])[F.col("measure")].cast("long")
    low = F.when(F.col("measure").isin(*TWO_SIDED), F.col("q1") - reach * F.greatest(F.col("q5") - F.col("q1"), least))
    high = F.col("q9") + reach * F.greatest(F.col("q9") - F.col("q5"), least)
    return rows.select("level", "g_lang", "g_source", "measure", low.alias("low"), high.alias("high"), "n")


def shrunk(own, n, wide, prior):
    """The mean of two fences, own with the weight of its n documents, wide with that of prior ones, rounded down."""
    both = n * own + prior * wide
    return F.floor((both - F.pmod(both, n + prior)) / (n + prior))


def group_fences(sketch, reach=REACH, prior=PRIOR):
    """One row per (lang, source): its fences as a map of measure to (low, high)."""
    flat = fences(sketch, reach)
    of = lambda level, tag: flat.where(f"level = {level}").select(F.col("g_lang").alias(f"l{tag}"), F.col("measure").alias(f"m{tag}"), F.col("low").alias(f"low{tag}"), F.col("high").alias(f"high{tag}"), F.col("n").alias(f"n{tag}"))
    wide = of(1, "1").join(of(0, "0").drop("l0", "n0"), F.col("m1") == F.col("m0"))
    wide = wide.select("l1", "m1", *[shrunk(F.col(f"{k}1"), F.col("n1"), F.col(f"{k}0"), prior).alias(f"w_{k}") for k in ("low", "high")])
    fine = flat.where("level = 2").join(wide, F.col("g_lang").eqNullSafe(F.col("l1")) & (F.col("measure") == F.col("m1")))
    fine = fine.select("g_lang", "g_source", "measure", F.struct(*[shrunk(F.col(k), F.col("n"), F.col(f"w_{k}"), prior).alias(k) for k in ("low", "high")]).alias("fence"))
    return fine.groupBy(F.col("g_lang").alias("f_lang"), F.col("g_source").alias("f_source")).agg(F.map_from_entries(F.collect_list(F.struct("measure", "fence"))).alias("fence"))


def base_failed(f):
    """The fixed rules: too few words, or over 30 % of the words in repeated windows."""
    return (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])


def inside(f, fence):
    """Whether all measures lie within the fences; measures or fences that are null pass."""
    ok = F.lit(True)
    for m, v in measures(f).items():
        one = fence[m]
        ok = ok & F.coalesce(v <= one["high"], F.lit(True)) & F.coalesce(v >= one["low"], F.lit(True))
    return ok


def judge(docs, text="text", lang="lang", source="source", carry=None, reach=REACH, prior=PRIOR):
    """The columns of carry (default: all of docs), a struct of features, base_failed and kept. Returns (frame, names).

    names gives the three new columns' names (changed where docs has them already). The features are written once, with
    what is carried, and read twice: for the sketches, which need the numbers only, and for the verdict.

    Null and blank texts have no words and fail the base rules; null languages and sources are groups of their own;
    repeated rows count and are judged each; an empty table stays empty."""
    carry = list(docs.columns if carry is None else carry)
    q, failed, kept = (free_name(docs, n) for n in ("quality", "base_failed", "kept"))
    need = list(dict.fromkeys([*carry, lang, source]))
    found = written(with_features(docs, text, need, q), "quality")
    limits = written(group_fences(sketches(found, q, lang, source), reach, prior), "fences")
    f = col(q)
    joined = found.join(limits, col(lang).eqNullSafe(F.col("f_lang")) & col(source).eqNullSafe(F.col("f_source")), "left")
    verdict = ~base_failed(f) & inside(f, F.col("fence"))
    return joined.select(*map(col, carry), f, base_failed(f).alias(failed), verdict.alias(kept)), (q, failed, kept)


def keep_good(docs, text="text", lang="lang", source="source"):
    """The documents that pass, with their own columns only."""
    judged, (_, _, kept) = judge(docs, text, lang, source)
    return judged.where(col(kept)).select(*map(col, docs.columns))
