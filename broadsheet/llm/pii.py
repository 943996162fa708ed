"""Personal data: base patterns, and unseen identifiers by bootstrapped contextual extraction.

1. One pass finds the base spans (e-mail, IP, card, phone) and every other identifier-shaped run (four digits or an @ at
   least), each with the words around it. Lexical patterns are the last two or three words before it, and the word before
   with the word behind.
2. Distinct (pattern, instance) pairs form a graph. Base instances are seeds of confidence 1. In each round Spark scores
   patterns by the confidence of their instances of one kind over all their instances, keeps those with enough support
   and precision, and scores unknown instances by the patterns that point at them (noisy or). Accepted instances stay and
   count in the next rounds, until a round accepts nothing new.
3. Every mention of an accepted instance becomes a span of that kind. Base spans stay as they are.

All of step 2 works on counts of distinct pairs, aggregated before they are shuffled: a word that stands before a third
of all identifiers is one pattern with a large count.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import body, col, free_name, release, written

KINDS = ("email", "ip", "card", "phone")
SUPPORT, PRECISION, ACCEPT = 5, 0.8, 0.8
#: Longer instances go by their length and digest in the graph; context is looked for this near.
LONGEST, NEAR = 128, 80

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")
RUN = r"[A-Za-z0-9@._%+()#/:=-]"
SHAPED = re.compile(rf"(?<!{RUN}){RUN}*[0-9@]{RUN}*+(?:\x20\(?[0-9][0-9().-]*+)*+")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W\d_]+|[:=#]")

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
MENTION = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("instance", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType()))])
FOUND = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("mentions", T.ArrayType(MENTION))])


def emails(text):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", end if domain else at + 1)


def luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    """(kind, start, end) of the base rules, by kind, then start; offsets in code points."""
    spans = [("email", *s) for s in emails(text)]
    if not DIGIT.search(text):
        return spans
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def patterns(text, start, end):
    """The lexical patterns around text[start:end]."""
    before = [w.lower() for w in WORD.findall(text, max(0, start - NEAR), start)][-3:]
    behind = WORD.search(text, end, end + NEAR)
    out = [f"{n}<{' '.join(before[-n:])}" for n in (2, 3) if len(before) >= n]
    return [*out, f"{before[-1]}<>{behind[0].lower()}"] if before and behind else out


def name_of(run):
    """What an instance is called in the graph."""
    return run if len(run) <= LONGEST else f"{len(run)}:{hashlib.sha256(run.encode()).hexdigest()}"


def mentions(text, spans):
    """Base spans and other identifier-shaped runs, of any length, with their patterns."""
    found = [(s, e, name_of(text[s:e]), k, patterns(text, s, e)) for k, s, e in spans]
    taken = sorted((s, e) for _, s, e in spans)
    k = 0
    for m in SHAPED.finditer(text):
        start, end = m.start(), m.start() + len(m[0].rstrip(".,:;()-/=#"))
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        clear = k == len(taken) or taken[k][0] >= end
        if clear and end > start and ("@" in m[0] or len(DIGIT.findall(m[0])) >= 4):
            found.append((start, end, name_of(text[start:end]), None, patterns(text, start, end)))
    return found


def found_in(texts: pa.Array) -> pa.Array:
    """Base spans and mentions of each text, as FOUND."""
    kind = pa.struct([("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))), ("mentions", pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("kind", pa.string()), ("patterns", pa.list_(pa.string()))])))])
    release()
    rows = []
    for t in texts:
        t = t.as_py() or ""
        if not SIGN.search(t):
            rows.append({"base": [], "mentions": []})
            continue
        base = base_spans(t)
        rows.append({"base": [dict(zip(("kind", "start", "end"), s)) for s in base], "mentions": [dict(zip(("start", "end", "instance", "kind", "patterns"), x)) for x in mentions(t, base)]})
    return pa.array(rows, kind)


def learned(each, support=SUPPORT, precision=PRECISION, accept=ACCEPT):
    """(instance, kind) of the unseen identifiers that the pattern graph supports; each: (instance, kind, patterns).

    An instance keeps the kind and trust it is accepted with, so every round but the last adds some: the loop ends. Of two
    kinds with equal trust the later by name is taken."""
    edges = written(each.select("instance", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.min("kind").alias("kind")), "edges")
    seeds = edges.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("trust"))
    known = seeds = written(seeds, "seeds")
    while True:
        scored = edges.select("pattern", "instance").join(known, "instance", "left")
        of_kind = [F.sum(F.when(F.col("kind") == k, F.col("trust"))).alias(k) for k in KINDS]
        counts = [F.count(F.when(F.col("kind") == k, 1)).alias("n_" + k) for k in KINDS]
        per = scored.groupBy("pattern").agg(F.count("*").alias("n"), *of_kind, *counts)
        best = F.greatest(*[F.when(F.col("n_" + k) >= support, F.struct((F.col(k) / F.col("n")).alias("score"), F.lit(k).alias("kind"))) for k in KINDS])
        good = written(per.select("pattern", best.alias("best")).where(F.col("best.score") >= precision).select("pattern", "best.score", "best.kind"), "patterns")
        reached = edges.select("pattern", "instance").join(known, "instance", "left_anti").join(good.withColumnRenamed("kind", "as_kind"), "pattern")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-3)))))
        votes = reached.groupBy("instance", "as_kind").agg((1 - doubt).alias("trust"))
        top = votes.groupBy("instance").agg(F.max(F.struct("trust", F.col("as_kind").alias("kind"))).alias("top")).select("instance", "top.kind", "top.trust").where(F.col("trust") >= accept)
        new = written(top, "accepted")
        if new.isEmpty():
            return known.join(seeds, "instance", "left_anti").select("instance", "kind")
        known = written(known.unionByName(new), "known")


def find(docs, text="text", carry=None):
    """The columns of carry (default: all of docs) and a struct of base and spans per row; returns the struct's name too.

    base and spans are arrays of (kind, start, end), by kind as in KINDS, then start; spans also holds what the patterns
    discovered. Null and empty texts have none; repeated rows are found each; an empty table stays empty; nothing is
    learned below SUPPORT distinct seeds."""
    carry = list(docs.columns if carry is None else carry)
    row, name = free_name(docs, "row"), free_name(docs, "pii")
    first = written(docs.select(*map(col, carry), F.monotonically_increasing_id().alias(row), F.arrow_udf(found_in, FOUND)(body(text)).alias(name)), "found")
    each = first.select(F.col(row).alias("row_"), F.explode(F.col(name)["mentions"]).alias("m")).select("row_", "m.*")
    new = learned(each.select("instance", "kind", "patterns")).withColumnRenamed("kind", "as_kind")
    more = each.where("kind is null").join(new, "instance").groupBy("row_").agg(F.collect_list(F.struct(F.col("as_kind").alias("kind"), "start", "end")).alias("more"))
    both = first.join(written(more, "discovered"), F.col(row) == F.col("row_"), "left")
    every = F.concat(F.col(name)["base"], F.coalesce("more", F.array().cast(T.ArrayType(SPAN))))
    rank = F.array(*[F.lit(k) for k in KINDS])
    order = F.array_sort(F.transform(every, lambda s: F.struct(F.array_position(rank, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    spans = F.transform(order, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return both.select(*map(col, carry), F.struct(F.col(name)["base"].alias("base"), spans.alias("spans")).alias(name)), name


def joined(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts with [KIND] in place of their spans; overlapping spans are one, named by the first."""
    out = []
    for t, found in zip(texts, spans):
        t, found = t.as_py(), found.as_py()
        if t and found:
            parts, end = [], 0
            for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= end:
                    parts += [t[end:s["start"]], f"[{s['kind'].upper()}]"]
                end = max(end, s["end"])
            t = "".join([*parts, t[end:]])
        out.append(t)
    return pa.array(out, pa.string())


def redacted(docs, text="text"):
    """docs with the personal data in text replaced by [EMAIL], [IP], [CARD] and [PHONE]."""
    found, name = find(docs, text)
    changed = F.when(F.size(col(name)["spans"]) > 0, F.arrow_udf(masked, "string")(col(text), col(name)["spans"])).otherwise(col(text))
    return found.select(*[changed.alias(c) if c == text else col(c) for c in docs.columns])
