"""Exact deduplication against a persistent digest index.

The index is a Parquet table of one row per distinct text, clustered into
buckets by its SHA-256 digest and sorted by it within each bucket. A batch of
documents is first reduced to one row per digest (partial aggregation, so a
text that makes up a third of the batch is counted where it is read). The
reduced rows are sort-merge anti-joined with the index, whose side is read in
its buckets and not shuffled, and what remains is appended to the same
buckets. Each document then learns from the index which document stays for
its text.

Defined cases:

* A null text counts as the empty text; texts are compared unchanged.
* Of equal texts in one batch the row with the largest id stays, unless the
  index already holds the text: then the document recorded there stays and the
  whole batch's copies go. Presenting a recorded document again (same id, same
  text) keeps it, so a batch can be run again after a failure.
* A null id is smaller than any other. If the largest id belongs to several
  rows of one text, exactly one of these rows stays.
* An empty batch appends nothing. Other columns, whatever their names, pass
  through ``deduplicate`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.llm.frames import durable, fresh
from vetline.session import path_exists, scratch_path, unique_name


class DigestIndex:
    """The index table at ``path`` (a folder every executor can reach).

    ``buckets`` is fixed when the index is made and recorded beside it; it
    defaults to the session's shuffle partitions, so that a batch shuffled by
    digest meets the buckets without a second exchange. ``id_type`` is the
    type of the ids, as a DDL string.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path, self.name = spark, f"{path}/rows", unique_name("digest_index")
        meta = f"{path}/layout"
        if path_exists(spark, f"{meta}/_SUCCESS"):
            row = spark.read.schema("buckets int, id_type string").json(meta).first()
            self.buckets, self.id_type = row.buckets, row.id_type
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            self.id_type = id_type
            layout = spark.createDataFrame([(self.buckets, id_type)], "buckets int, id_type string")
            layout.coalesce(1).write.mode("overwrite").json(meta)
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id {self.id_type}, keep_rows BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Add the digests of ``groups`` (one row each) that the index does not hold."""
        new = (groups.join(self.rows().hint("merge"), "digest", "left_anti")
               .select("digest", F.col("keep_id").cast(self.id_type), "keep_rows")
               .repartition(self.buckets, "digest"))  # one file a bucket
        new.write.insertInto(self.name)


def _digest(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))


def decide(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bring a batch into the index and return one row per digest of it.

    Columns: digest, keep_id (the id that stays), keep_rows (rows of the batch
    holding that id and text, of which one stays), group_size (rows of the
    batch with that text).
    """
    pairs = (docs.select(_digest(text_col).alias("digest"), F.col(id_col).alias("id"))
             .groupBy("digest", "id").agg(F.count("*").alias("n")))
    groups = durable(
        pairs.groupBy("digest").agg(F.max(F.struct("id", "n")).alias("top"), F.sum("n").alias("group_size"))
        .select("digest", F.col("top.id").alias("keep_id"), F.col("top.n").alias("keep_rows"), "group_size"),
        "exact-groups")
    index.append(groups)
    held = index.rows().select("digest", F.col("keep_id").alias("held_id"))
    return (groups.join(held.hint("merge"), "digest")
            .select("digest", F.col("held_id").alias("keep_id"),
                    F.when(F.col("held_id").eqNullSafe(F.col("keep_id")), F.col("keep_rows")).otherwise(F.lit(1)).alias("keep_rows"),
                    "group_size"))


def labelled(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, digest, keep_id, group_size, kept.

    Rows that share both the staying id and the text cannot be told apart, so
    they are not read again but written out from their count: one kept, the
    others dropped.
    """
    decided = durable(decide(docs, index, id_col, text_col), "exact-decided")
    rows = docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("digest")).join(decided.hint("merge"), "digest")
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    plain = rows.where(~(stays & (F.col("keep_rows") > 1))).select("id", "digest", "keep_id", "group_size", stays.alias("kept"))
    tied = (decided.where("keep_rows > 1")
            .select("keep_id", "digest", "group_size", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("keep_rows"))).alias("k"))
            .select(F.col("keep_id").alias("id"), "digest", "keep_id", "group_size", (F.col("k") == 1).alias("kept")))
    return plain.unionByName(tied)


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    digest, keep, rows = (fresh(docs, c) for c in ("digest", "keep_id", "keep_rows"))
    decided = durable(decide(docs, index, id_col, text_col), "exact-decided").select(
        F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.col("keep_rows").alias(rows))
    stay = (docs.withColumn(digest, _digest(text_col)).join(decided.hint("merge"), digest)
            .where(F.col(id_col).eqNullSafe(F.col(keep))))
    one = stay.where(F.col(rows) == 1).select(*docs.columns)
    tied = stay.where(F.col(rows) > 1).dropDuplicates([digest]).select(*docs.columns)
    return one.unionAll(tied)


def scratch_index(docs: DataFrame, id_col: str = "doc_id") -> DigestIndex:
    """A new, empty index in the shared folder, for a corpus that has none yet."""
    spark = docs.sparkSession
    return DigestIndex(spark, scratch_path(spark, "llm", "digest-index"), id_type=docs.schema[id_col].dataType.simpleString())
