"""The corpus pipeline: quality, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. The first three return
the columns of ``documents``; the last returns pieces of packed sequences.

- quality: rows that the classifier scores under 0.3 go. It is trained on the stage's own rows that have labels.
- near copies: of each class of documents linked at a Jaccard similarity of 0.8 of five-word shingles, the
  row with the smallest doc_id stays.
- secrets: every reported span is replaced by ``[SECRET]``, and n_chars follows; no row goes.
- packing: sequences of at most 2048 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import jaccard_join, packing, quality, secrets
from gridloom.llm.common import read, spool


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs, jaccard_join.Similarity(k=5, percent=80))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", good_quality), ("n-gram Jaccard join", without_near_copies), ("secret scans", without_secrets), ("packing", packed)]
#: The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = spool(docs, f"stage{i}")
    return docs
