"""A cleaning pipeline over ``documents``: each stage works on all that the one before kept.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame, which is written
as Parquet and read again for the next stage. All but the last return the
columns of ``documents``; the last returns each document's token ids.

Defined cases: a null text counts as empty everywhere. Empty texts are judged by
the classifier like others; of those it keeps, exact dedup leaves one. Rows
without a doc_id pass like others (of equal texts one with an id stays before
one without). Repeated rows are copies: one stays. Of near copies that tie the
smallest doc_id stays. An empty table passes every stage as an empty table.
Further columns pass through to the last stage, whatever their names. Texts of
any length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.llm import bpe, decontaminate, exact_dedup, quality, simhash
from vetline.llm.frames import clear_scratch, scratch_mark, ship, table
from vetline.llm.queries import VOCABULARY, quality_model
from vetline.session import delete_path, scratch_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from ``labels``, accepts."""
    ship(spark)
    model = quality_model(quality.describe(docs), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    ship(spark)
    return exact_dedup.deduplicate(docs, exact_dedup.scratch_index(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash fingerprints the document with the smallest id."""
    ship(spark)
    return simhash.keep_one(docs, shingle=3, distance=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with fewer than one word in twenty inside a verbatim benchmark window."""
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, and the digest of what they decode to."""
    ship(spark)
    tokens = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    coded = docs.select("doc_id", "lang", "source", bpe.encode_decode(F.col("text"), tokens, public_tokenizers.PATTERN).alias("bpe"))
    return coded.select("doc_id", "lang", "source", F.size("bpe.ids").cast("bigint").alias("n_tokens"),
                        F.col("bpe.ids").alias("ids"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level bpe", tokenize),
]

#: The first stage is a learnt model, which SQL cannot express; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Once a stage's output is stored, what it read and wrote on the way is deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        mark, path = scratch_mark(spark), scratch_path(spark, "pipeline", str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        clear_scratch(spark, mark)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
