"""Syncmer fingerprints, VA-file clustering and tokenizer alignment on small tables, against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from broadsheet.llm import alignment, centroids, syncmers

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = [f"w{k}" for k in range(60)]


def passage(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


# Fingerprints

def plain_anchors(text):
    """Anchors, each with its distance from the one before."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    md5 = lambda ws: hashlib.md5(" ".join(ws).encode()).hexdigest()
    inner = [md5(words[i:i + 2]) for i in range(len(words) - 1)]
    places = [i for i in range(len(words) - 4) if min(inner[i:i + 4]) in (inner[i], inner[i + 3])]
    if not places:
        return [md5(words)[:6] + "0"] if words else []
    return [md5(words[i:i + 5])[:6] + str(min(i - p, 9)) for p, i in zip([places[0], *places], places)]


def plain_likeness(a, b):
    return 1.0 if not a and not b else 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b)))


def plain_fingerprints(rows):
    """rows: (key, text) in descending order of key."""
    out = []
    for (key, text), (_, behind) in zip(rows, rows[1:] + rows[:1]):
        edited = text[:len(text) - len(text) // 2] + behind[:len(text) // 2]
        own, new, last = map(plain_anchors, (text, edited, behind))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(new), plain_likeness(own, new), plain_likeness(own, last)))
    return out


@pytest.mark.parametrize("part_bytes", [8 << 20, 1500])
def test_fingerprints_against_plain_python(spark, part_bytes, monkeypatch):
    monkeypatch.setattr(syncmers, "PART_BYTES", part_bytes)
    rng = random.Random(3)
    texts = [passage(rng, rng.choice([0, 1, 3, 4, 5, 6, 9, 40, 200])) for _ in range(150)]
    texts[3] = texts[4] = texts[90]
    texts[5], texts[6], texts[7] = "a" * 3000, "é漢 " * 900, "\n \t"
    rows = [(k, t) for k, t in enumerate(texts)]
    given = [(k, None if k % 2 and not t else t, 1, "x") for k, t in rows]
    docs = spark.createDataFrame(given, "doc_id long, text string, part int, next string").repartition(5)
    got = sorted(map(tuple, syncmers.fingerprints(docs).collect()), reverse=True)
    assert got == plain_fingerprints(rows[::-1])


def test_fingerprints_of_shared_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "PART_BYTES", 600)
    rng = random.Random(4)
    hot, same = passage(rng, 30), passage(rng, 12)
    rows = [(7, passage(rng, 20)) for _ in range(20)] + [(5, hot)] * 40 + [(None, same)] * 20 + [(k, passage(rng, 25)) for k in range(100, 110)]
    got = syncmers.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(k for k, _ in rows)
    # Each row is some row's next exactly once: the edited texts of equal rows differ at most at the end of their group.
    assert len({r.edited_sha256 for r in got if r.doc_id == 5}) <= 2 and sum(r.near_next == 1 for r in got if r.doc_id == 5) >= 39
    assert len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    last = [r for r in got if r.doc_id is None and r.near_next < 1]
    top = max(rows[-10:])[1]
    assert len(last) == 1 and last[0].edited_sha256 == hashlib.sha256((same[:len(same) - len(same) // 2] + top[:len(same) // 2]).encode()).hexdigest()


def test_fingerprints_of_few_rows(spark):
    kind = "doc_id long, text string"
    assert syncmers.fingerprints(spark.createDataFrame([], kind)).collect() == []
    alone = syncmers.fingerprints(spark.createDataFrame([(1, "a b c d")], kind)).first()
    assert alone.edited_sha256 == hashlib.sha256(b"a b a b"[:4] + b"a b").hexdigest() and alone.near_next == 1
    assert syncmers.fingerprints(spark.createDataFrame([(1, None)], kind)).first().near_edited == 1


def test_a_passage_has_the_same_anchors_anywhere():
    rng = random.Random(5)
    text = passage(rng, 300)
    bare = lambda t: {a[:6] for a in plain_anchors(t)}
    assert bare(text) <= bare(passage(rng, 17) + " " + text + " " + passage(rng, 9))


# Clustering

def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    lot = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), -1 if r[0] is None else r[0], r[1])
    c = [list(v) for _, v in sorted(kept, key=lot)[:k]]
    for turn in range(rounds + 1):
        at = [min((sum((a - b) ** 2 for a, b in zip(v, x)), n) for n, x in enumerate(c)) for _, v in kept]
        if turn < rounds:
            for n in range(len(c)):
                own = [v for (_, v), (_, m) in zip(kept, at) if m == n]
                c[n] = [sum(x) // len(own) for x in zip(*own)] if own else c[n]
    inertia = collections.Counter()
    for d, n in at:
        inertia[n] += d
    return [(i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, at)]


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.4, (5, 64))
    return [(k, (middles[k % 5] + rng.normal(0, 0.1, 64)).astype(np.float32).tolist()) for k in range(n)]


@pytest.mark.parametrize("bits", [2, 5])
def test_clusters_against_plain_python(spark, bits):
    rows = vectors(300)
    rows += [(500, None), (501, []), (502, [0.5] * 63), (503, [0.5] * 65), (504, [float("nan")] + [0.0] * 63), (505, [float("inf")] + [0.0] * 63), (506, [None] + [0.0] * 63),
             (507, [0.0] * 64), (508, [-0.0] * 64), (None, [0.25] * 64), (None, [0.5] * 64), *rows[:3], *rows[:1]]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, row int, v string").repartition(4)
    key = lambda r: (r[0] is None, r)
    got = centroids.report(df, bits=bits).collect()
    order = lambda rs: sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, rs)), key=key)
    assert order(got) == order(plain_clusters(rows))


def test_clusters_of_few_and_equal_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert centroids.report(spark.createDataFrame([], kind)).collect() == []
    for rows in (vectors(3), [(k, [0.125] * 64) for k in range(40)]):  # ties go to the smaller number, all others stay empty
        got = centroids.report(spark.createDataFrame(rows, kind)).collect()
        assert sorted(map(tuple, got)) == sorted(plain_clusters(rows))


def test_cells_never_lose_the_nearest_centroid(spark):
    rows = vectors(400, 2)
    whole = centroids.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    v = np.array([r.v for r in whole.orderBy("id").collect()])
    for bits in (1, 3, 5):
        cuts = centroids.cell_cuts(whole, bits=bits)
        cells = np.stack([np.searchsorted(c, v[:, j], side="right") for j, (c, _, _) in enumerate(cuts)], axis=1)
        assert cells.max() < 2**bits
        left = centroids.candidates(cells, *centroids.tables_of(v[:16], cuts))
        nearest = ((v[:, None] - v[None, :16]) ** 2).sum(axis=2).argmin(axis=1)
        assert left[np.arange(len(v)), nearest].all()
    assert left.sum(axis=1).mean() < 4  # of 16 at five bits


# Alignment

def plain_links(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    a_side = Tokenizer.from_file(BYTE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    name = {i: t for t, i in a_side.get_vocab().items()}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    byte = {chr(b) if b in shown else chr(next(other)): b for b in range(256)}
    bytes_a = lambda i: bytes(byte[c] for c in name[i])
    bytes_b = lambda i: bytes([int(b_side.id_to_piece(i)[3:-1], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()
    counts, found = collections.Counter(), []
    for key, text in rows:
        a, b = a_side.encode(" " + (text or ""), add_special_tokens=False).ids, b_side.encode(text or "")
        x, y = list(map(bytes_a, a)), list(map(bytes_b, b))
        if not text or not b"".join(x) == b"".join(y) == b" " + text.encode():
            found.append((key, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, x))).tolist(), np.cumsum(list(map(len, y))).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            n, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a[i:n], b[j:m]))
            i, j = n, m
        links = [(p[-1], q[-1]) for p, q in groups]
        counts.update(links)
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        found.append((key, len(a), len(b), links, hashlib.sha256(said.encode()).hexdigest()))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(k, n, m, len(ls), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), sha) for k, n, m, ls, sha in found]


@pytest.mark.parametrize("frequent, size", [(131_072, 1_500_000), (40, 700)])
def test_alignment_against_plain_python(spark, frequent, size, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", size)
    rng = random.Random(6)
    signs = [" ", " ", "  ", "\n", " \n", "\n ", "\t", "a", "B", "é", "ß", "日本", "▁", "'s", "'", "<|endoftext|>", "</s>", "<0x41>", "12", "$$", ".", "\xa0", "😀", "\x00", "\x1c", "Ⅷ", "the", "ing"]
    rows = [(k, "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))) for k in range(600)]
    rows += [(k, " ".join(rng.choice(["stone", "unlikely", "Übermaß", "x" * 30, "end.\nNext", "ré"]) for _ in range(rng.choice([1, 47, 48, 49, 300])))) for k in range(600, 640)]
    rows += [(None, None), (None, "a b"), (1, ""), (2, "y" * 4000), rows[3], rows[630]]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, links string").repartition(3)
    got = alignment.compare(docs, BYTE, PIECE, frequent=frequent).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_links(rows)))


def test_alignment_of_nothing(spark):
    assert alignment.compare(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).collect() == []


def test_lanes_meet_every_common_end():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n = rng.integers(1, 60)
        a, b = (np.unique(np.append(rng.integers(1, 80, n), 80)) for _ in range(2))
        at_a, at_b = alignment.aligned(a, b, np.array([0]), np.array([0]), np.array([len(a)]))
        common = np.intersect1d(a, b)
        assert a[at_a].tolist() == common.tolist() == b[at_b].tolist()
