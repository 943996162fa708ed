"""The stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame.

A stage's input has been written by whoever runs it, so what the stage before it kept in the scratch folder can go."""

import public_tokenizers

from . import bpe, frames, minhash, mixing, pii, quality_rules

WORD_BPE = "word_bpe_49k.json"
#: Share of the encoder's usual caches: beside an executor that earlier stages have grown there is less memory left.
ROOM = 0.4


def quality(spark, docs, sf_dir):
    """Documents that pass the quality rules."""
    with frames.stage(spark):
        return quality_rules.keep_good(docs)


def dedup(spark, docs, sf_dir):
    """One document of each group of near copies."""
    with frames.stage(spark):
        return minhash.one_per_group(docs)


def redact(spark, docs, sf_dir):
    """Texts with personal data replaced by its kind."""
    with frames.stage(spark):
        return pii.redacted(docs)


def mix(spark, docs, sf_dir):
    """A row for every time the mix takes a document."""
    with frames.stage(spark):
        return mixing.mixed(docs)


def encode(spark, docs, sf_dir):
    """Documents with token ids, their number and the decoded text."""
    with frames.stage(spark):
        return bpe.encode_documents(docs, public_tokenizers.path(WORD_BPE), room=ROOM)


def run(spark, sf_dir, steps):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(steps):
        docs = step(spark, docs, sf_dir)
        if k < len(steps) - 1:
            docs = frames.stored(docs, name)
    return docs
