"""From documents to training tokens: toxic texts, copies, near copies and benchmark leaks go, the rest is encoded.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of documents, whatever
their names. In every stage null text counts as empty text, texts of any length are read whole, rows that repeat id and text are treated alike (exact
dedup makes them one), ties are settled by the rule named in the stage, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adloom.llm.bpe import encode_decode, tokenizer_file
from adloom.llm.common import stored, table
from adloom.llm.decontaminate import drop_leaks, split_items
from adloom.llm.exact_dedup import drop_copies
from adloom.llm.minhash import drop_near_copies
from adloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold. Without labels, or without text, a document stays."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts: the largest id stays; rows without id only where no row of the group has one."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id stays; rows without id or without words always stay."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage leaks a benchmark item. Items of fewer than two words leak nowhere."""
    return drop_leaks(docs, split_items(table(spark, sf_dir, "benchmark")))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of what the ids decode to."""
    return encode_decode(docs, tokenizer_file("byte_bpe_50k.json"), ("ids", "decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", bpe)]

#: SQL expresses neither the classifier nor MinHash; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
