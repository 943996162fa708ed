"""Token counts by a two-tier lookup of piece lengths, without shuffling the pre-tokens.

Text is cut at single spaces, where the pre-token pattern always has a boundary; a piece with its leading space is one
or more whole pre-tokens. First tier: a broadcast table of the corpus's most frequent pieces and their lengths in
tokens. Second tier: each worker's cache; what neither holds is cut into pre-tokens and encoded by the library.

The table only saves work, it never changes a count. Every task counts the pieces of its whole share under a fixed
number of counters (the smallest fall out when full) and hands on its most frequent ones; those summaries are all that
is shuffled. Table size: FREQUENT entries of at most SHORT characters, under 1.5 MB whatever the corpus.
"""

import os
import uuid
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import functions as F

from .bpe import SPACE
from .frames import Remembered, kept, release

FREQUENT, PER_TASK, SHORT, COUNTERS, CACHE, PRE_CACHE = 16_384, 2_048, 24, 100_000, 80_000, 200_000
#: The pre-token pattern of byte-level files, with the library's white space written out.
PRE_TOKENS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?=[{SPACE}]|\Z)|[{SPACE}]+")
ANY_SPACE = regex.compile(rf"[{SPACE}]")


def library(spec):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer
    return Tokenizer.from_str(spec)


class Lengths:
    """Tokens of texts: the broadcast table first, then what this worker has met, then the library.

    spaced holds pieces that stand behind a space, bare those at a start; both fall back on single pre-tokens."""

    def __init__(self, spec, frequent):
        self.tokens = library(spec)
        special = [t.content for t in self.tokens.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.pre_tokens = Remembered(lambda p: len(self.tokens.encode(p, add_special_tokens=False)), PRE_CACHE)
        self.spaced = Remembered(lambda p: self.piece(p, " "), CACHE, frequent)
        self.bare = Remembered(lambda p: self.piece(p, ""), CACHE)

    def piece(self, piece, before):
        """A run of letters, also with one other sign behind it, and two such runs around a line break need no pattern."""
        if piece.isalpha():
            return self.pre_tokens[before + piece]
        if piece[:-1].isalpha() and not ANY_SPACE.match(piece[-1]):
            return self.pre_tokens[before + piece[:-1]] + self.pre_tokens[piece[-1]]
        left, line, right = piece.partition("\n")
        if line and left and right and not ANY_SPACE.search(left) and not ANY_SPACE.search(right):
            return (self.spaced if before else self.bare)[left] + self.pre_tokens["\n"] + self.bare[right]
        return self.by_pattern(before + piece)

    def by_pattern(self, text):
        return sum(map(self.pre_tokens.__getitem__, PRE_TOKENS.findall(text)))

    def of_segment(self, text):
        """Tokens of a text without special strings."""
        if "  " in text or text[0] == " " or text[-1] == " ":
            return self.by_pattern(text)
        first, *rest = text.split(" ")
        return self.bare[first] + sum(map(self.spaced.__getitem__, rest))

    def of(self, text):
        if "<" not in text:
            return self.of_segment(text) if text else 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.of_segment(p) for p in parts if p)


def lengths_of(spec, table, run):
    """The lookup of this worker and run; it lives as long as the worker works on the run."""
    return kept(("token lengths", run), lambda: Lengths(spec, table))


def frequent_lengths(docs, path, text="text"):
    """The first tier: the most frequent pieces of the whole corpus with their length in tokens (a dict)."""
    def count(batches):
        release()
        seen = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(t.as_py().split(" "))
                if len(seen) > COUNTERS:
                    seen = Counter(dict(seen.most_common(COUNTERS // 2)))
        best = [(p, n) for p, n in seen.most_common(2 * PER_TASK) if p and len(p) < SHORT and not ANY_SPACE.search(p)][:PER_TASK]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["piece", "n"])

    found = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).mapInArrow(count, "piece string, n long")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)
    with open(path, encoding="utf-8") as f:
        tokens = library(f.read())
    pieces = [r.piece for r in top.select("piece").collect()]  # FREQUENT short strings
    return {p: len(tokens.encode(" " + p, add_special_tokens=False)) for p in pieces}


def count_tokens(docs, path, text="text", limit=1024):
    """docs with n_bytes, n_tokens and over_limit (columns of these names are replaced).

    Null texts count as empty (0 bytes, 0 tokens). Special strings inside texts count as that one token. Repeated rows
    are counted each; an empty table stays empty."""
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text))
    run = uuid.uuid4().hex

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        lengths = lengths_of(spec.value, table.value, run)
        return pa.array([lengths.of(t.as_py() or "") for t in texts], pa.int64())

    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("n_tokens", tokens(body)).withColumn("n_bytes", F.octet_length(body).cast("long")).withColumn("over_limit", F.col("n_tokens") > limit)
