"""BPE encoding and decoding on whole texts by backtracking over longest matches.

A sequence of tokens is the merge result of its text exactly when every neighbouring pair is: two tokens are compatible
if merging their joined text gives those two tokens again. The encoder takes the longest token that an Aho-Corasick
automaton finds at a position, checks it against the table of compatible pairs, and steps back when nothing fits. The
encoding of a prefix is unique, so a position that failed once is never entered again: linear time.

Decoding copies slices of one byte string that holds all tokens, through a table of their offsets.
"""

import array
import functools
import itertools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import Remembered, body, col, free_name, kept

#: Stands for the word-end mark inside the encoder; no byte is shown as this character.
END = "\x00"
#: White space of the tokenizers' patterns; str.split() also splits at \x1c-\x1f, which are not in it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
PAIRS, PIECES, WORDS = 300_000, 120_000, 250_000


def byte_characters():
    """The printable character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """Tokens of one tokenizer file with word ends, lower case and white space dropped.

    room: the share of the usual cache sizes that this encoder may fill."""

    def __init__(self, spec, room=1.0):
        import ahocorasick
        spec = json.loads(spec)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.name = {i: t for t, i in model["vocab"].items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(pattern)
        self.at_space = regex.compile(f"[{SPACE}]+")
        self.chars = byte_characters()
        mark = lambda t: t[:-len(suffix)] + END if t.endswith(suffix) and len(t) > len(suffix) else t
        self.ids = {mark(t): i for t, i in model["vocab"].items()}
        self.text = {i: t for t, i in self.ids.items()}
        self.rank = {(mark(a), mark(b)): k for k, (a, b) in enumerate(model["merges"])}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.pairs, self.most_pairs = {}, int(PAIRS * room)
        self.known = Remembered(self.packed_word, int(WORDS * room))
        self.pieces = Remembered(self.packed_piece, int(PIECES * room))

    def merged(self, text):
        """The merge rules applied to a short text, lowest rank first, leftmost among equals."""
        units = list(text[:-1]) if text.endswith(END) else list(text)
        if text.endswith(END):
            units[-1] += END
        none = len(self.rank)
        while len(units) > 1:
            best, k = min((self.rank.get(pair, none), k) for k, pair in enumerate(itertools.pairwise(units)))
            if best == none:
                break
            units[k:k + 2] = [units[k] + units[k + 1]]
        return units

    def compatible(self, left, right):
        """Whether right may follow left (None: begin the word), from the table or by merging the two."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            both = [self.text[i] for i in key if i is not None]
            known = self.pairs[key] = self.merged("".join(both)) == both
        return known

    def word(self, word):
        """Ids of one pre-token."""
        text = "".join(map(self.chars.__getitem__, word.encode())) + END
        starts = [[] for _ in text]
        for end, (size, i) in self.automaton.iter(text):
            starts[end - size + 1].append((end + 1, i))
        at, last, out, way = 0, None, [], []
        seen = bytearray(len(text) + 1)
        while at < len(text):
            options = starts[at]
            while options:
                end, i = options.pop()
                if not seen[end] and self.compatible(last, i):
                    seen[end] = 1
                    way.append((at, last))
                    out.append(i)
                    at, last = end, i
                    break
            else:
                if not way:
                    raise ValueError(f"no tokens spell {word[:40]!r}")
                at, last = way.pop()
                out.pop()
        return out

    def packed_word(self, word):
        return array.array("i", self.word(word)).tobytes()

    def packed_piece(self, piece):
        """Ids of a run without white space, as bytes. A run of letters, with one other sign behind it, needs no pattern."""
        if piece.isalpha():
            return self.known[piece]
        if piece[:-1].isalpha():
            return self.known[piece[:-1]] + self.known[piece[-1]]
        return b"".join(map(self.known.__getitem__, self.words.findall(piece)))

    def segment(self, text):
        if not text.isascii():
            # The library lowers each character alone: no final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        pieces = self.at_space.split(text) if ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text):
        """The ids of a text as the bytes of 32-bit numbers."""
        if "<" not in text:
            return self.segment(text)
        parts = self.split_special.split(text)
        return b"".join(array.array("i", [self.special[part]]).tobytes() if k % 2 else self.segment(part) for k, part in enumerate(parts))


class Decoder:
    """All token texts in one byte string, each with the joining space behind it, and their offsets."""

    def __init__(self, names):
        parts = [(names.get(i, "") + " ").encode() if i in names else b"" for i in range(max(names) + 1)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)[:-1]))
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids):
        """Token texts joined by one space; ids outside the vocabulary are left out, as the library leaves them out."""
        ids = ids[(ids >= 0) & (ids < len(self.size))]
        size = self.size[ids]
        if not size.sum():
            return b""
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1])][:-1].tobytes()


def encoder_of(spec, room=1.0):
    return kept(("bpe encoder", spec, room), lambda: Encoder(spec, room))


@functools.lru_cache(maxsize=2)
def decoder_of(spec):
    spec = json.loads(spec)
    return Decoder({i: t for t, i in spec["model"]["vocab"].items()} | {x["id"]: x["content"] for x in spec["added_tokens"]})


def shared_spec(spark, path):
    """The tokenizer file, read once by the driver and broadcast (1.7 MB, fixed by the file)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def lists_of(rows):
    """An array<int> column from the packed ids of each row."""
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(spark, text, path):
    """A column of token ids (array<int>) of the whole text; null and empty texts give an empty array.

    Strings of special tokens inside a text become that token, as is the library's default."""
    spec = shared_spec(spark, path)

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        encoder = encoder_of(spec.value)
        return lists_of([encoder.encode(t.as_py() or "") for t in texts])

    return ids_of(text)


def decode(spark, ids, path):
    """A column of texts: the tokens' own strings, special ones included, joined by one space; null ids give ''."""
    spec = shared_spec(spark, path)

    @F.arrow_udf("string")
    def text_of(rows: pa.Array) -> pa.Array:
        decoder = decoder_of(spec.value)
        none = np.empty(0, np.int32)
        return pa.array((decoder.decode(r.values.to_numpy(zero_copy_only=False).astype(np.int64) if r.is_valid else none) for r in rows), pa.binary()).cast(pa.string())

    return text_of(ids)


def encode_documents(docs, path, text="text", rows=500, room=1.0):
    """docs with ids (array<int>), n_tokens and decoded; columns of these names in docs are replaced.

    One pass encodes and decodes. A batch is worked on and handed back in parts of so many rows, so that a task never holds
    the ids of a whole batch of long texts; a text that is given on reaches the task once. room: share of the usual sizes of a
    worker's caches. Null texts count as empty: no ids, decoded ''. Repeated rows each get their result; an empty table
    stays empty."""
    spec = shared_spec(docs.sparkSession, path)
    kept_columns = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens", "decoded")]
    once = text in kept_columns and isinstance(docs.schema[text].dataType, T.StringType)
    given = docs.select(*map(col, kept_columns), *([] if once else [body(text).alias(free_name(docs, "body"))]))
    at_text, width = kept_columns.index(text) if once else len(kept_columns), len(kept_columns)

    def each(batches):
        encoder, decoder = encoder_of(spec.value, room), decoder_of(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                part = whole.slice(at, rows)
                packed = [encoder.encode(t.as_py() or "") for t in part.column(at_text)]
                decoded = pa.array((decoder.decode(np.frombuffer(r, np.int32)) for r in packed), pa.binary()).cast(pa.string())
                counts = pa.array([len(r) // 4 for r in packed], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:width], lists_of(packed), counts, decoded], [*part.schema.names[:width], "ids", "n_tokens", "decoded"])

    fields = [f for f in docs.schema.fields if f.name in kept_columns]
    return given.mapInArrow(each, T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]))
