"""From raw documents to token ids: quality rules, near-duplicates, personal data, source mixing, BPE."""

from broadsheet.llm import stages

STAGES = [
    ("quality_rules", stages.quality),
    ("minhash_dedup", stages.dedup),
    ("pii", stages.redact),
    ("mixing", stages.mix),
    ("bpe", stages.encode),
]

#: Merges of tokens and learned patterns cannot be put in SQL; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table, each written and read again."""
    return stages.run(spark, sf_dir, STAGES)
