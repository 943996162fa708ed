"""Learned identifiers up to the last round, and fences that follow the sketch, against plain Python."""

import collections
import math
import random

from pyspark.sql import functions as F

from broadsheet.llm import pii, quality_rules

EACH = "instance string, kind string, patterns array<string>"


def plain_learned(rows, support=5, precision=0.8, accept=0.8):
    edges = {}
    for instance, kind, patterns in rows:
        for p in patterns:
            old = edges.get((p, instance))
            edges[p, instance] = kind if old is None else old if kind is None else min(old, kind)
    known = {}
    for (_, i), k in edges.items():
        if k is not None:
            known[i] = (min(k, known[i][0]) if i in known else k, 1.0)
    seeds, members = set(known), collections.defaultdict(set)
    for p, i in edges:
        members[p].add(i)
    while True:
        votes = collections.defaultdict(lambda: collections.defaultdict(float))
        for p, found in members.items():
            best = None
            for k in pii.KINDS:
                mine = [known[i][1] for i in found if i in known and known[i][0] == k]
                if len(mine) >= support:
                    best = max(best or (0, ""), (sum(mine) / len(found), k))
            if best and best[0] >= precision:
                for i in found - set(known):
                    votes[i][best[1]] += math.log(max(1 - best[0], 1e-3))
        new = {i: max((1 - math.exp(v), k) for k, v in by.items()) for i, by in votes.items()}
        new = {i: (k, t) for i, (t, k) in new.items() if t >= accept}
        if not new:
            return {(i, k) for i, (k, _) in known.items() if i not in seeds}
        known |= new


def test_chains_are_followed_to_their_end(spark):
    sizes, rows = [3125, 625, 125, 25, 5, 1], []
    for hop, n in enumerate(sizes):
        slots = [f"p{h}{x}" for h in ((hop - 1, hop) if hop else (0,)) for x in "abc"]
        rows += [(f"i{hop}-{k}", None if hop else "email", slots) for k in range(n)]
    got = pii.learned(spark.createDataFrame(rows, EACH)).collect()
    assert len(got) == sum(sizes[1:]) and {r.kind for r in got} == {"email"} and {tuple(r) for r in got} == plain_learned(rows)


def test_learning_against_plain_python(spark):
    rng = random.Random(8)
    kinds = list(pii.KINDS)
    rows = []
    for k in range(400):
        group = rng.randrange(4)
        own = [f"g{group}-{rng.randrange(3)}", f"h{group if rng.random() < 0.9 else rng.randrange(4)}"]
        rows.append((f"i{k % 350}", kinds[group] if rng.random() < 0.85 else None, rng.choice([own, own[:1], []])))
    want = plain_learned(rows)
    assert want and {tuple(r) for r in pii.learned(spark.createDataFrame(rows, EACH)).collect()} == want
    assert pii.learned(spark.createDataFrame([], EACH)).collect() == []


def test_ties_of_kinds_go_to_the_later_name(spark):
    rows = [(f"{kind}{k}", kind, [f"slot-{kind}"]) for kind in ("email", "phone") for k in range(6)] + [("x", None, ["slot-email", "slot-phone"])]
    assert [tuple(r) for r in pii.learned(spark.createDataFrame(rows, EACH)).collect()] == [("x", "phone")]


def test_long_runs_are_instances(spark):
    run, mail = "7" * 133, [f"please call the number {k}{k}@mail.example.org today" for k in range(30)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*mail, f"please call the number {run} today", "a@b"])], "doc_id long, text string")
    found, name = pii.find(docs)
    spans = {r.doc_id: r.s for r in found.select("doc_id", pii.joined(F.col(name)["spans"]).alias("s")).collect()}
    assert spans[30] == f"email:23:{23 + 133}" and spans[31] == ""


def plain_fences(values, reach, least, two):
    """values: buckets; low and high."""
    values, n = sorted(values), len(values)
    q = {k: next(v for i, v in enumerate(values, 1) if i * 10 >= n * k) for k in (1, 5, 9)}
    return q[1] - reach * max(q[5] - q[1], least) if two else None, q[9] + reach * max(q[9] - q[5], least)


def test_fences_follow_the_sketch(spark):
    rng = random.Random(9)
    bucket = lambda v: v - v % (1 << max(v.bit_length() - 7, 0))
    rows, docs = [], collections.defaultdict(list)
    for lang, source, n, middle in (("en", "a", 300, 500), ("en", "b", 12, 900), ("de", "a", 40, 550), (None, None, 5, 500)):
        for _ in range(n):
            v = bucket(max(0, int(rng.gauss(middle, 40))))
            for level, g in ((2, (lang, source)), (1, (lang, None)), (0, (None, None))):
                docs[level, g].append(v)
                rows.append((level, *g, "word_length", v, 1))
    sketch = spark.createDataFrame(rows, "level int, g_lang string, g_source string, measure string, bucket long, n long")
    sketch = sketch.groupBy("level", "g_lang", "g_source", "measure", "bucket").agg(F.sum("n").alias("n"))
    got = {(r.f_lang, r.f_source): tuple(r.fence["word_length"]) for r in quality_rules.group_fences(sketch).collect()}
    least, prior = quality_rules.MEASURES["word_length"][1], quality_rules.PRIOR
    plain = {k: plain_fences(v, quality_rules.REACH, least, True) for k, v in docs.items()}
    mean = lambda own, n, wide: tuple((n * a + prior * b) // (n + prior) for a, b in zip(own, wide))
    for g in got:
        wide = mean(plain[1, (g[0], None)], len(docs[1, (g[0], None)]), plain[0, (None, None)])
        assert got[g] == mean(plain[2, g], len(docs[2, g]), wide)
    assert len(got) == 4 and got["en", "b"][1] > got["en", "a"][1]  # a small group keeps some of its own tail
