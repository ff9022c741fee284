"""A training corpus from raw documents, in five stages.

Toxic documents go; of exact copies the one with the largest doc_id stays; of
each group of near copies the smallest doc_id stays; benchmark passages are
cut out of the texts; what remains is encoded.  Each stage reads the table
that the one before wrote, and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekwise.llm import block_dedup, decontaminate, overlap_join, toxicity, trie_bpe
from weekwise.llm.common import Scratch, table
from weekwise.llm.queries import word_bpe_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not find toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text."""
    return block_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-grams that agree to 0.8 or more."""
    return overlap_join.drop_near_duplicates(docs, shingle=5, threshold=(80, 100))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove_overlaps(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit integers and what they decode to."""
    return trie_bpe.encode_and_decode(docs, word_bpe_file()).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.col("text").alias("decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("bpe", encode),
]

# The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
