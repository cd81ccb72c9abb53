"""The package's registered queries, each over its whole table, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.llm import align, bpe, chat, decontaminate, exact_dedup, html_text, licences, lm, mtree, quality, simhash, toxicity, trie
from vetline.llm.frames import remainder, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def put(fn):
        @wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = shipped
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return put


@_register("op3_exact_dedup", """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the corpus brought into a new digest index as one batch."""
    docs = table(spark, sf_dir, "documents")
    rows = exact_dedup.labelled(docs, exact_dedup.scratch_index(docs))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


_OP7_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@_register("op7_benchmark_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP7_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_OP7_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS win
            FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
own AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, n, k, item_id FROM own JOIN windows USING (n, win)),
counts AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counts USING (r) LEFT JOIN items USING (r)
""")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontaminate.judge(docs, table(spark, sf_dir, "benchmark"), "hits")
    items = F.array_sort("hits.item_ids")
    return got.select("doc_id", "hits.n_words", decontaminate.hit_words("hits").alias("n_hit"),
                      F.size(items).cast("bigint").alias("n_items"),
                      F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                      decontaminate.contaminated("hits").alias("contaminated"))


@_register("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 3-word SimHash fingerprints differ in at most 3 bits."""
    rows = simhash.labelled(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The tokenizer of the registered query and the pipeline.
VOCABULARY = "byte_bpe_50k.tiktoken"


@_register("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    tokens = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", bpe.encode_decode(F.col("text"), tokens, public_tokenizers.PATTERN).alias("bpe"))
    return coded.select("doc_id", F.size("bpe.ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join("bpe.ids", " ").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


def quality_model(described: DataFrame, labels: DataFrame) -> quality.Discriminant:
    """Learnt from the labels that the contract gives to training."""
    return quality.fit(described, labels.where(remainder(F.col("doc_id"), 3) != 1))


@_register("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the discriminant learnt from the training labels."""
    described = quality.describe(table(spark, sf_dir, "documents"))
    model = quality_model(described, table(spark, sf_dir, "labels"))
    scored = described.select("doc_id", quality.score(F.col("features"), model).alias("score"))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the class-conditional models learnt from the training labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 4) != 2))
    scored = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("score"))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_register("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-likelihood under a recurrent model learnt from the training documents."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    scored, corpus = lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(corpus.total).cast("bigint").alias("train_tokens"),
        "base_score", "score")


@_register("op4_license_scan", licences.duckdb_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"),
                        F.array_join("licence_sentences", ",").alias("licence_sentences"),
                        F.size("licences").cast("bigint").alias("n_licences"))


@_register("op6_html_extraction")
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, laid out."""
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@_register("op1_chat_formatting")
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn of every conversation as a tool call, linked with the answer to it."""
    calls, results = chat.calls_of_turns(table(spark, sf_dir, "conversations"))
    return chat.link(calls, results, chat.TURN_TOOLS).withColumn("errors", F.array_join("errors", "; "))


#: The two tokenizers of the alignment query.
BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"


@_register("op13_cross_tokenizer_alignment")
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of both vocabularies aligned, with the corpus-wide counts of the linked pairs."""
    with open(public_tokenizers.path(BYTE_VOCABULARY), encoding="utf-8") as a, open(public_tokenizers.path(PIECE_VOCABULARY), "rb") as b:
        rows = align.aligned(table(spark, sf_dir, "documents"), a.read(), b.read())
    return rows.withColumnRenamed("id", "doc_id").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@_register("op12_exact_topk", """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM e AS q JOIN e AS c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", mtree.quantised(F.col("embedding")).alias("vec"))
    return mtree.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


#: crc32 of a text of ASCII characters, bit by bit, for DuckDB.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""


@_register("op11_prefix_trie", f"""
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                        sha256(concat(sha256(coalesce(role, '')), sha256(coalesce(text, ''))))) AS p,
                      {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY p) AS ts FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, ts, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own),
built AS (SELECT a.conv_id, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts
          FROM h AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 20),
members AS (SELECT conv_id, ts[1:d] AS path, d, len(ts) AS n FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM built)),
nodes AS (SELECT path, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
          FROM members GROUP BY path),
linked AS (SELECT c.*, p.conv_id AS parent_conv_id, p.path AS parent_path FROM nodes AS c
           LEFT JOIN nodes AS p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]),
kids AS (SELECT parent_path AS path, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
weighed AS (SELECT path, depth, CASE WHEN depth = 0 THEN 0 ELSE
              (n_convs - 1) * len(regexp_extract_all(path[depth].t, '[^\x20\x09-\x0D]+')) END AS saved,
              CASE WHEN kids.path IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes LEFT JOIN kids USING (path)),
sums AS (SELECT up AS path, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves
         FROM (SELECT saved, leaf, path[1:unnest(range(0, depth + 1))] AS up FROM weighed) GROUP BY up)
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (path) LEFT JOIN kids USING (path)
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    rows, convs = trie.rebuilt(trie.turns_of(table(spark, sf_dir, "conversations")))
    return trie.trie(rows, convs)
