"""Mixed-script tokenisation and chunking."""

from pyspark.sql import functions as F

from .expr import let, strip, text


def tokenize_mixed(x):
    """Bigrams over the single-character units, the units, then ASCII-led words longer than one character.

    Every non-ASCII character outside a word is a unit; a word starts with an ASCII letter or digit and takes the
    letters, digits, '-' and '_' behind it, of any script. Repeats are kept.
    """
    def body(all_):
        units = F.filter(all_, lambda t: F.rlike(t, F.lit(r"^[^\x00-\x7f]$")))
        words = F.filter(all_, lambda t: F.rlike(t, F.lit("^[a-z0-9]")) & (F.length(t) > 1))

        def grams(u):
            pairs = F.when(F.size(u) > 1, F.zip_with(F.slice(u, F.lit(1), F.size(u) - 1), F.slice(u, F.lit(2), F.size(u) - 1), lambda a, b: F.concat(a, b))).otherwise(F.array().cast("array<string>"))
            return F.concat(pairs, u)
        return F.concat(let(units, grams), words)
    return let(F.regexp_extract_all(F.lower(text(x)), F.lit(r"[a-z0-9][\p{L}\p{N}_-]*|[^\x00-\x7f]"), 0), body)


CHUNK = "array<struct<section:string,text:string>>"


def chunk_text(x, size=500, overlap=100):
    """array of struct(section, text): split at first- and second-level headings, paragraphs packed up to `size`.

    A new chunk starts with the last `overlap` characters of the one before; sections under 20 characters are skipped.
    """
    one = lambda s, t: F.array(F.struct(s.alias("section"), t.alias("text"))).cast(CHUNK)
    none = F.array().cast(CHUNK)

    def section(sec):
        head = r"^#{1,2}\s+(.*)"
        title = strip(F.regexp_extract(sec, head, 1))
        body = F.when(F.rlike(sec, F.lit(head)), strip(F.regexp_replace(sec, head, ""))).otherwise(sec)

        def pack(v):
            pars = F.split(v["body"], r"\n\s*\n")
            first = F.concat(F.when(v["title"] != "", F.concat(v["title"], F.lit("\n"))).otherwise(""), pars[0])
            flush = lambda cur: F.when(strip(cur) != "", one(v["title"], strip(cur))).otherwise(none)

            def step(acc, p):
                fits = F.length(acc["cur"]) + F.length(p) <= size
                tail = F.when(F.length(acc["cur"]) > overlap, F.right(acc["cur"], F.lit(overlap))).otherwise(acc["cur"])
                return F.when(p == "", acc).otherwise(F.struct(
                    F.concat(F.when(fits, acc["cur"]).otherwise(tail), F.lit("\n\n"), p).alias("cur"),
                    F.when(fits, acc["out"]).otherwise(F.concat(acc["out"], flush(acc["cur"]))).alias("out")))
            rest = F.transform(F.slice(pars, F.lit(2), F.greatest(F.size(pars) - 1, F.lit(0))), strip)
            packed = F.aggregate(rest, F.struct(first.alias("cur"), none.alias("out")), step, lambda a: F.concat(a["out"], flush(a["cur"])))
            return F.when(F.length(sec) <= size, one(v["title"], sec)).otherwise(packed)
        return let(F.struct(title.alias("title"), body.alias("body")), pack)

    def whole(t):
        secs = F.filter(F.transform(F.split(t, r"(?m)(?=^#{1,2}\s)"), strip), lambda s: F.length(s) >= 20)
        chunks = F.flatten(F.transform(secs, section))
        return let(chunks, lambda k: F.when((F.size(k) == 0) & (F.length(strip(t)) > 20), one(F.lit(""), strip(t))).otherwise(k))
    return let(text(x), whole)
