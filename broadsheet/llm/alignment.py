"""Alignment of two tokenizers' tokens by diagonal run skipping, and corpus-wide counts of linked ids.

A task takes texts in pieces of about SLICE characters. Distinct words are encoded once per piece of work and remembered;
both tokenizers begin a new token at a single space between two other signs, so words are encoded alone there (texts with
other white space are encoded whole). The tokens' byte lengths give two arrays of end offsets per piece.

Alignment moves along both end arrays from common ends on, many starting points (lanes) at once. At the current index
shift a lane compares blocks of the two arrays, each block twice as long as the one before, and jumps over what agrees:
these are groups of one token on each side. At a disagreement the token that ends first steps on until two ends agree:
an irregular group, behind which the shift is another one. Every lane starts at a common end (the start of a document or
of every LANE-th word) and stops where the next lane has started.

A group's last two tokens end together and are its link. Links are counted per document and id pair, then over the corpus.
To give counts back to documents, the FREQUENT most frequent pairs are broadcast (a table of fixed size); pairs that are
not among them are joined by pair and summed up per document. Only such rare pairs are shuffled, never the links.
"""

import hashlib
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import Remembered, body, col, kept, written

#: Characters of a piece of work, words of a lane, words a worker remembers, broadcast pairs, places of a first block.
SLICE, LANE, WORDS, FREQUENT, FIRST_BLOCK = 1_500_000, 48, 150_000, 131_072, 4
#: White space next to a space, or of another kind than a space and a line break inside a word: no cut at single spaces.
ODD_SPACE = regex.compile(r"[^\S \n]|\s | \s|\A\s|\s\Z|▁")


class Tokens:
    """One tokenizer: ids of texts and, by id, the number of bytes and the bytes of a token."""

    def __init__(self, parts):
        self.bytes = parts
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)[:-1]))

    def joined(self, ids):
        return b"".join(map(self.bytes.__getitem__, ids))


class ByteLevel(Tokens):
    """A tokenizers file of the byte-level kind; special strings are plain text."""

    def __init__(self, spec):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        from .bpe import byte_characters
        self.library = Tokenizer.from_str(spec.decode())
        self.library.encode_special_tokens = True
        names = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        byte = {c: b for b, c in enumerate(byte_characters())}
        super().__init__([bytes(map(byte.__getitem__, t)) if set(t := names.get(i, "")) <= byte.keys() else t.encode() for i in range(max(names) + 1)])

    def encode(self, texts):
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Tokens):
    """A sentencepiece model; it puts a space before a text itself."""

    def __init__(self, spec):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=spec)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        super().__init__([bytes([int(t[3:-1], 16)]) if self.library.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)])
        if any("▁" in t.lstrip("▁") for t in names):
            raise ValueError("pieces that run over a space are not supported")

    def encode(self, texts):
        return self.library.encode(texts, num_threads=1)


class Pair:
    """Both tokenizers, and what this worker remembers of words: the packed ids of A and B, or () if their bytes differ."""

    def __init__(self, a, b):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.known = Remembered(None, WORDS)

    def encoded(self, texts):
        """Packed ids (A, B) of each text behind a space, () where either's bytes are not the text's."""
        out = []
        for text, a, b in zip(texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts)):
            wanted = b" " + text.encode()
            good = self.a.joined(a) == wanted and self.b.joined(b) == wanted
            out.append((np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes()) if good else ())
        return out

    def of(self, words):
        """The same for distinct words, remembered or encoded."""
        found = {w: self.known.get(w, self.known.old.get(w)) for w in words}
        new = [w for w, p in found.items() if p is None]
        for w, p in zip(new, self.encoded(new)):
            found[w] = self.known.keep(w, p)
        return list(found.values())


def aligned(ends_a, ends_b, i, j, stop):
    """Flags of the tokens of A and of B that end together with one of the other side.

    i, j: where the lanes start, behind a common end; stop: for each lane the place in A where the next one has started."""
    a, b = np.append(ends_a, np.full(1, -1)), np.append(ends_b, np.full(1, -2))
    at_a, at_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    i, j, stop = (x.copy() for x in (i, j, stop))
    end_a, end_b = len(ends_a), len(ends_b)

    def compare(lanes, block):
        """How many places of the next block agree from its start on."""
        k = np.arange(block)
        same = a[np.minimum(i[lanes, None] + k, end_a)] == b[np.minimum(j[lanes, None] + k, end_b)]
        return np.where(same.all(axis=1), block, same.argmin(axis=1))

    lanes = np.flatnonzero(i < stop)
    while len(lanes):
        probing, block = lanes, FIRST_BLOCK
        while len(probing):
            n = compare(probing, block)
            jumped = np.arange(block) < n[:, None]
            for at, start in ((at_a, i), (at_b, j)):
                at[(start[probing, None] + np.arange(block))[jumped]] = True
            i[probing] += n
            j[probing] += n
            probing = probing[(n == block) & (i[probing] < stop[probing])]
            block *= 2
        lanes = odd = lanes[i[lanes] < stop[lanes]]
        while len(odd):
            x, y = a[i[odd]], b[j[odd]]
            i[odd] += x < y
            j[odd] += y < x
            odd = odd[x != y]
        at_a[i[lanes]] = at_b[j[lanes]] = True
        i[lanes] += 1
        j[lanes] += 1
        lanes = lanes[i[lanes] < stop[lanes]]
    return at_a[:-1], at_b[:-1]


def gathered(packed, codes):
    """The packed rows of numbers by code, one behind the other, and how many each has."""
    size = np.array([len(p) // 4 for p in packed], np.int64)
    start = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    n = size[codes]
    ends = np.cumsum(n)
    every = np.frombuffer(b"".join(packed), np.int32)
    return every[np.repeat(start[codes] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n


class Marks:
    """By id, the bytes of id and separator."""

    def __init__(self, size, between, behind):
        width = len(str(size)) + 1
        self.table = np.array([f"{i}{s}".encode() for s in (between, behind) for i in range(size)], f"S{width}")
        self.size = size

    def of(self, ids, last):
        return self.table[ids + self.size * last]


def groups_of(pair, marks, texts):
    """Per text: n_a, n_b, n_groups, groups_sha256, and its links as (pair of ids as one number, how often), flat with ends."""
    n = len(texts)
    whole = [bool(ODD_SPACE.search(t)) for t in texts]
    units = [[t] if odd else t.split(" ") if t else [] for t, odd in zip(texts, whole)]
    flat = pa.array([u for us in units for u in us], pa.string()).dictionary_encode()
    words, codes = flat.dictionary.to_pylist(), flat.indices.to_numpy()
    packed = pair.of(words)
    bad_word = np.array([p == () for p in packed], bool)
    of_text = np.repeat(np.arange(n), [len(u) for u in units])
    bad = np.zeros(n, bool)
    bad[of_text[bad_word[codes]]] = True
    good = ~bad[of_text]
    codes, of_text = codes[good], of_text[good]
    a, per_a = gathered([p[0] if p else b"" for p in packed], codes)
    b, per_b = gathered([p[1] if p else b"" for p in packed], codes)
    ends_a, ends_b = np.cumsum(pair.a.size[a]), np.cumsum(pair.b.size[b])
    # A lane for the first and every LANE-th word of a text.
    first = np.r_[True, of_text[1:] != of_text[:-1]] if len(of_text) else np.zeros(0, bool)
    place = np.arange(len(codes)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(codes) else codes
    lane = place % LANE == 0
    i, j = (np.cumsum(p) - p for p in (per_a, per_b))
    i, j = i[lane], j[lane]
    at_a, at_b = aligned(ends_a, ends_b, i, j, np.append(i[1:], len(a)))
    last_a, last_b = np.flatnonzero(at_a), np.flatnonzero(at_b)
    text_a, text_b = np.repeat(of_text, per_a), np.repeat(of_text, per_b)
    group_a, group_b = np.cumsum(at_a) - at_a, np.cumsum(at_b) - at_b
    rows = np.empty(len(a) + len(b), f"S{max(m.table.itemsize for m in marks)}")
    rows[np.arange(len(a)) + np.append(0, last_b + 1)[group_a]] = marks[0].of(a, at_a)
    rows[np.arange(len(b)) + last_a[group_b] + 1] = marks[1].of(b, at_b)
    n_a, n_b, n_groups = (np.bincount(x, minlength=n) for x in (text_a, text_b, text_a[last_a]))
    ends = np.cumsum(n_a + n_b)
    shas = [hashlib.sha256(rows[e - m:e].tobytes().replace(b"\0", b"")[:-1]).hexdigest() if m else "" for e, m in zip(ends, n_a + n_b)]
    ids = a[last_a].astype(np.int64) * len(pair.b.size) + b[last_b]
    room = len(pair.a.size) * len(pair.b.size)
    links, often = np.unique(text_a[last_a] * room + ids, return_counts=True)
    return n_a, n_b, n_groups, shas, links % room, often, np.searchsorted(links // room, np.arange(n + 1))


def slices(batch, size):
    """Parts of a batch of about size characters."""
    part = np.cumsum(pc.utf8_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    starts = [0, *np.flatnonzero(np.diff(part)) + 1, batch.num_rows]
    return [batch.slice(s, e - s) for s, e in zip(starts, starts[1:]) if e > s]


def linked(docs, spec_a, spec_b):
    """row, key, n_a, n_b, n_groups, n_links, groups_sha256 and links (pair, n) of docs (row, key, text)."""
    names = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]

    def each(batches):
        pair, marks = kept(("alignment", spec_a.value, spec_b.value), lambda: (p := Pair(spec_a.value, spec_b.value), (Marks(len(p.a.size), ",", "|"), Marks(len(p.b.size), ",", ";"))))
        for whole in batches:
            for batch in slices(whole, SLICE):
                n_a, n_b, n, shas, pairs, often, ends = groups_of(pair, marks, batch.column(2).to_pylist())
                links = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([pa.array(pairs), pa.array(often.astype(np.int32))], ["pair", "n"]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x.astype(np.int64)) for x in (n_a, n_b, n, n)], pa.array(shas, pa.string()), links], names)

    kinds = [T.LongType(), docs.schema["key"].dataType, *[T.LongType()] * 4, T.StringType(), T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.IntegerType())]))]
    return docs.mapInArrow(each, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def counted(links, pieces):
    """pair, count over the corpus, and best: whether it is the highest of its B id."""
    count = written(links.select(F.inline("links")).groupBy("pair").agg(F.sum("n").cast("long").alias("count")), "pair_counts")
    top = count.groupBy((F.col("pair") % pieces).alias("b")).agg(F.max("count").alias("top"))
    return written(count.join(top, F.col("pair") % pieces == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).alias("best")), "pairs")


def looked_up(links, table):
    """links with n_best and count_sum from the broadcast pairs, and rest, the links of other pairs, in place of links."""
    def sums(batches):
        pair, count, best = table.value
        for batch in batches:
            at = batch.column(batch.num_columns - 1)
            ends = np.append(0, np.cumsum(at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            flat = at.flatten()
            ids, often = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            where = np.minimum(np.searchsorted(pair, ids), max(len(pair) - 1, 0))
            known = pair[where] == ids if len(pair) else np.zeros(len(ids), bool)
            total = lambda x: np.diff(np.append(0, np.cumsum(x))[ends])
            n_best = total(np.where(known, often * best[where], 0) if len(pair) else 0 * often)
            count_sum = total(np.where(known, often * count[where], 0) if len(pair) else 0 * often)
            missing = total((~known).astype(np.int64))
            rest = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(missing)).astype(np.int32)), flat.filter(pa.array(~known)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_best.astype(np.int64)), pa.array(count_sum.astype(np.int64)), rest], [*batch.schema.names[:-1], "n_best", "count_sum", "rest"])

    fields = links.schema.fields
    return links.mapInArrow(sums, T.StructType([*fields[:-1], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("rest", fields[-1].dataType)]))


def compare(docs, path_a, path_b, key="doc_id", text="text", frequent=FREQUENT):
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs.

    A is a byte-level tokenizers file, B a sentencepiece model. Texts that are null, empty, or that either tokenizer does
    not give back byte by byte have zeros and ''. Ties for the highest count of a B id all count. Repeated rows count each;
    null keys are kept; an empty table stays empty; a text is worked on whole, so it must fit a task."""
    spark = docs.sparkSession
    specs = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            specs.append(spark.sparkContext.broadcast(f.read()))  # tokenizer files
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(key).alias("key"), body(text).alias("text"))
    found = written(linked(rows, *specs), "links")
    pairs = counted(found, len(Pieces(specs[1].value).size))
    top = pairs.orderBy(F.desc("count"), "pair").limit(frequent).toPandas().sort_values("pair")  # frequent rows of three numbers
    table = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["count"].to_numpy(np.int64), top["best"].to_numpy(bool)))
    part = written(looked_up(found, table), "looked_up")
    rest = part.where(F.size("rest") > 0).select(F.col("row").alias("r"), F.inline("rest")).join(pairs, "pair")
    more = rest.groupBy("r").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("also_best"), F.sum(F.col("n") * F.col("count")).alias("also_count"))
    out = part.drop("rest").join(more, F.col("row") == F.col("r"), "left")
    add = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).cast("long").alias(x)
    return out.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", add("n_best", "also_best"), add("count_sum", "also_count"), "groups_sha256")
