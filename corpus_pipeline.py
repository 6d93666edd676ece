"""A training corpus in five stages, each by one operator of linemart.llm; a stage's rows are the next one's documents.

All stages take documents with nulls in any column, texts of any length, repeated rows and further columns of any name, and
give no rows for an empty table. What each does with them is said below; null texts count as empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemart.llm import mixing, quality_rules, secret_scan, sentencepiece_sa, simhash_golay
from linemart.llm.shared import removed_after, stored, table, tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null, empty and short texts (under 50 words) are rejected; each of several equal rows stays or goes alike."""
    return quality_rules.keep(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of texts whose sets of five-word shingles are 0.8 alike.

    Equal texts are one group, null and empty ones among them; rows that repeat leave one; a null id is smaller than all others.
    """
    return simhash_golay.one_of_each(docs, shingle=5, similarity=0.8).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan reports masked in their texts. Rows that repeat are masked alike; null texts stay null."""
    return secret_scan.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them: a source that it favours repeats some, at most twice over.

    Null sources are a source of their own; texts without words cost no tokens and are taken once.
    """
    return mixing.mix(docs, max_repeats=1.25).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SentencePiece ids of each text, and the text that they decode to as a digest. Null and empty texts have no ids; each row has its own result."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    back = sentencepiece_sa.encode(docs.select("doc_id", "source", "text"), path, decoded_col="decoded")
    return back.select("doc_id", "source", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_copies),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

#: SimHash, secret links and SentencePiece have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables that earlier stages have stored are removed once the next one is written."""
    docs, mark = table(spark, sf_dir, "documents"), len(tables())
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        removed_after(spark, mark, but=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
