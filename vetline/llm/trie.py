"""Prefix trie of conversations by the Euler-tour technique.

A node of depth ``d`` is a distinct sequence of the first ``d`` turns; its
members are the conversations that start with it. Every node gets an enter and
an exit arc, arcs are linked into the tour (enter, first child or own exit; exit,
next sibling or the parent's exit), the tour is list-ranked, and what lies in
a node's subtree is the difference of prefix sums at its two arc positions.

Nothing here depends on how long a conversation is, how many children a node
has or how many conversations share a prefix:

* turns are numbered in a global sort whose ranges a long conversation may span
  (``numbered``); so are the children of a node, by which siblings are linked;
* a prefix is named by SHA-256: a chain inside blocks of ``BLOCK`` turns, and
  for later blocks the name of the blocks before, found the same way one
  level up;
* list ranking contracts runs of arcs that a task holds together, by ranges of
  their numbers and by random mates in turn, until one task's share is left
  (``BLOCK_ARCS``), and expands the runs again level by level;
* prefix sums are taken in blocks of ``BLOCK`` positions, then over the blocks'
  totals in the same way;
* the ids that end at a node are joined in chunks and streamed through the
  digest.

Defined cases: turns without a conv_id belong to no conversation. Turns are
ordered by turn (null first), ties by the SHA-256 of the turn's content;
repeated rows are turns of their own; a null role or text is empty. An empty table has no nodes. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetline.llm.frames import durable

#: Turns of a chain, positions of a prefix sum and ids of a chunk that are handled together.
BLOCK = 4096
#: Arcs that one task contracts at a time.
BLOCK_ARCS = 1 << 16
#: Words for the count of tokens: between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

ROOT = b"\0" * 32


def numbered(df: DataFrame, keys: list[str], into: str) -> DataFrame:
    """``df``, sorted by ``keys`` over all partitions, with its place (from 0) in column ``into``.

    The sorted ranges are written before they are counted, so that a lost
    executor cannot change them; the driver gets one count a range.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = F.monotonically_increasing_id()
    kept = durable(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", at), "numbered")
    part, offset = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = {r["p"]: r["n"] for r in kept.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    before = np.concatenate(([0], np.cumsum([counts.get(p, 0) for p in range(max(counts, default=0) + 1)]))).tolist()
    return kept.withColumn(into, F.lit(before)[part.cast("int")] + offset).drop("_at")


def prefix_sums(df: DataFrame, values: list[str], block: int = BLOCK) -> DataFrame:
    """``df`` with each of ``values`` replaced by its sum over all places up to its own. ``place`` counts from 0 without gaps or ties."""
    own = df.withColumn("_block", F.floor(F.col("place") / block).cast("long"))
    inside = Window.partitionBy("_block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    totals = durable(own.groupBy("_block").agg(*[F.sum(v).alias(v) for v in values]).withColumnRenamed("_block", "place"), "totals")
    sums = own.select(*[F.sum(c).over(inside).alias(c) if c in values else F.col(c) for c in own.columns])
    if totals.agg(F.max("place")).head()[0] in (None, 0):
        return sums.drop("_block")
    before = prefix_sums(totals, values, block).select((F.col("place") + 1).alias("_block"), *[F.col(v).alias(f"_{v}") for v in values])
    return sums.join(before, "_block", "left").select(
        *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) if c in values else F.col(c) for c in df.columns])


# --- rebuilt conversations -----------------------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, n_words`` of every turn, ``place`` from 1 in its conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
                                                             F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"))
    # Texts are never shuffled. The random column lets equal rows be dealt to several ranges.
    placed = numbered(durable(rows.withColumn("any", F.rand(11)), "said"), ["conv_id", "turn", "digest", "any"], "n")
    first = placed.groupBy("conv_id").agg(F.min("n").alias("first"))
    return durable(placed.join(first, "conv_id").select("conv_id", (F.col("n") - F.col("first") + 1).alias("place"), "digest", "n_words"), "turns")


def rebuilt(turns: DataFrame, every: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their ``every``: rows ``conv_id, depth, digest, n_words``, and ``conv_id, length`` of all.

    Conversation c takes the first h turns of conversation ``c - c % every``
    (h: crc32 of c's decimal text, modulo ``shared``) and its own after its first h.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared))
    own = turns.groupBy("conv_id").agg(F.max("place").alias("own")).withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    sizes = own.select(F.col("conv_id").alias("base"), F.col("own").alias("has"))
    convs = durable(own.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))), "convs")
    heads = turns.where(F.col("place") < shared).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "n_words")
    taken = convs.join(heads, "base").where(F.col("depth") <= F.col("h")).select("conv_id", "depth", "digest", "n_words")
    rest = turns.join(convs, "conv_id").where(F.col("place") > F.col("h")).select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_words")
    length = F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))
    return durable(taken.unionByName(rest), "rebuilt"), convs.select("conv_id", length.cast("long").alias("length"))


def prefixes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, depth, prefix`` of ``rows(conv_id, depth, digest)``: equal where the first ``depth`` digests are."""
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, ROOT
        for batch in batches:
            names = []
            for conv, part, digest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "digest"))):
                if (conv, part) != key:
                    key, state = (conv, part), ROOT
                state = hashlib.sha256(state + digest).digest()
                names.append(state)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("depth"), batch.column("part"), pa.array(names, pa.binary())],
                                             names=["conv_id", "depth", "part", "prefix"])

    parts = rows.select("conv_id", F.col("depth").cast("long").alias("depth"), F.floor((F.col("depth") - 1) / block).cast("long").alias("part"), "digest")
    chains = durable(parts.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "depth")
                     .mapInArrow(chain, "conv_id long, depth long, part long, prefix binary"), "chains")
    ends = chains.where(F.col("depth") % block == 0).select("conv_id", (F.col("part") + 1).alias("depth"), F.col("prefix").alias("digest"))
    if ends.isEmpty():
        return chains.drop("part")
    before = prefixes(ends, block).select("conv_id", F.col("depth").alias("part"), F.col("prefix").alias("before"))
    name = F.when(F.col("before").isNull(), F.col("prefix")).otherwise(F.unhex(F.sha2(F.concat("before", "prefix"), 256)))
    return chains.join(before, ["conv_id", "part"], "left").select("conv_id", "depth", name.alias("prefix"))


# --- nodes ---------------------------------------------------------------------------------

def nodes_of(rows: DataFrame, names: DataFrame, convs: DataFrame) -> DataFrame:
    """``node`` (from 0, by smallest member and depth), ``conv_id, depth, prefix, n_convs, n_words, parent, parent_conv_id`` of every node."""
    spark = rows.sparkSession
    counted = rows.select("conv_id", "depth", "n_words").join(names, ["conv_id", "depth"]).groupBy("depth", "prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_words").alias("n_words"))
    all_convs = convs.agg(F.min("conv_id"), F.count("*")).head()
    if not all_convs[1]:
        return spark.createDataFrame([], "node long, conv_id long, depth long, prefix binary, n_convs long, n_words long, parent long, parent_conv_id long")
    root = spark.createDataFrame([(0, ROOT, all_convs[0], all_convs[1], 0)], "depth long, prefix binary, conv_id long, n_convs long, n_words long")
    nodes = durable(numbered(root.unionByName(counted), ["conv_id", "depth"], "node"), "nodes")
    # The parent of (conv_id, depth) holds the same conversation's prefix of one turn less.
    above = names.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
    child = nodes.where("depth > 0").join(above, ["conv_id", "depth"], "left").withColumn("up", F.coalesce("up", F.lit(ROOT)))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("node").alias("parent"),
                           F.col("conv_id").alias("parent_conv_id"))
    return durable(child.join(parents, ["depth", "up"]).drop("up").unionByName(nodes.where("depth = 0"), allowMissingColumns=True), "nodes")


# --- Euler tour -------------------------------------------------------------------------------

def tour(nodes: DataFrame) -> DataFrame:
    """``arc, succ`` of every node's enter (2 node) and exit (2 node + 1) arc; the root's exit has no successor."""
    children = numbered(nodes.where("parent IS NOT NULL").select("parent", "node"), ["parent", "node"], "n")
    after = children.select((F.col("n") - 1).alias("n"), F.col("parent").alias("same"), F.col("node").alias("next"))
    siblings = durable(children.join(after, "n", "left").select("node", "parent", F.when(F.col("same") == F.col("parent"), F.col("next")).alias("next")), "siblings")
    first = children.groupBy("parent").agg(F.min("node").alias("child")).withColumnRenamed("parent", "node")
    enter = nodes.select("node").join(first, "node", "left").select(
        (2 * F.col("node")).alias("arc"), F.coalesce(2 * F.col("child"), 2 * F.col("node") + 1).alias("succ"))
    leave = nodes.select("node").join(siblings, "node", "left").select(
        (2 * F.col("node") + 1).alias("arc"), F.coalesce(2 * F.col("next"), 2 * F.col("parent") + 1).alias("succ"))
    return enter.unionByName(leave)


def contract(arc: np.ndarray, succ: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a list that lie within one task: for each element the index of its run's head and its distance from it,
    and for each head (others: -1) the index of its run's last element. ``succ`` is -1 at the list's end."""
    n = len(arc)
    order = np.argsort(arc)
    at = np.searchsorted(arc[order], succ)
    at[at == n] = 0
    here = (succ >= 0) & (arc[order[at]] == succ)
    following = np.where(here, order[at], -1)
    head, away = np.arange(n), np.zeros(n, np.int64)
    own = np.flatnonzero(here)
    head[following[own]] = own
    away[following[own]] = size[own]
    while True:
        further = head[head]
        if (further == head).all():
            break
        away += away[head]
        head = further
    last = np.full(n, -1)
    end = np.flatnonzero(~here)
    last[head[end]] = end
    return head, away, last


def list_rank(arcs: DataFrame, block_arcs: int = BLOCK_ARCS) -> DataFrame:
    """``arc, place`` (from 0) of the list ``arc, succ``; arcs are distinct numbers, ``succ`` is null at its only end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        arc, succ, size = (np.concatenate([np.asarray(b.column(c)) for b in held]) for c in ("arc", "succ", "size"))
        head, away, last = contract(arc, succ, size)
        first = last >= 0
        end = last[head]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (arc, arc[head], away, np.where(first, succ[end], -1),
                                                                np.where(first, away[end] + size[end], 0), first)],
                                         names=["arc", "head", "away", "succ", "size", "first"])

    levels, turn = [], 0
    rows = durable(arcs.select("arc", F.coalesce("succ", F.lit(-1)).alias("succ"), F.lit(1).cast("long").alias("size")), "arcs")
    left = rows.count()
    if not left:
        return arcs.select("arc", F.col("arc").alias("place"))
    while True:
        parts = -(-left // block_arcs)
        if parts == 1:
            dealt = rows.repartition(1)  # one task's share by now
        elif turn % 2 == 0:
            dealt = rows.repartitionByRange(parts, "arc")  # arcs of neighbouring nodes
        else:  # an arc that tosses heads goes to its successor's task, one that tosses tails stays in its own
            heads = F.pmod(F.xxhash64("arc", F.lit(turn)), F.lit(2)) == 0
            dealt = rows.repartition(parts, F.when(heads & (F.col("succ") >= 0), F.col("succ")).otherwise(F.col("arc")))
        level = durable(dealt.mapInArrow(run, "arc long, head long, away long, succ long, size long, first boolean"), "runs")
        levels.append(level)
        rows = level.where("first").select("arc", "succ", "size")
        left, turn = rows.count(), turn + 1
        if left == 1:
            break
    place = levels.pop().select("arc", F.col("away").alias("place"))  # a single run: its head is the list's
    while levels:
        place = durable(place, "places")
        begins = place.select(F.col("arc").alias("head"), F.col("place").alias("begin"))
        place = levels.pop().join(begins, "head").select("arc", (F.col("begin") + F.col("away")).alias("place"))
    return place


# --- ids that end at a node -------------------------------------------------------------------

def ends(convs: DataFrame, names: DataFrame, block: int = BLOCK) -> DataFrame:
    """``depth, prefix, ends_sha256`` of the nodes at which conversations end: the digest of their ids, ascending, joined by commas."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, hashlib.sha256(), []
        for batch in batches:
            done = []
            for depth, prefix, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "prefix", "ids"))):
                if (depth, prefix) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (depth, prefix), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done) if done else [[]] * 3, kinds)], names=cols)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, state.hexdigest()), kinds)], names=cols)

    cols, kinds = ["depth", "prefix", "ends_sha256"], [pa.int64(), pa.binary(), pa.string()]
    last = convs.join(names, (convs["conv_id"] == names["conv_id"]) & (convs["length"] == names["depth"]), "left").select(
        convs["conv_id"], convs["length"].alias("depth"), F.coalesce("prefix", F.lit(ROOT)).alias("prefix"))
    # A chunk holds at most ``block`` ids, for ids are distinct.
    chunks = last.groupBy("depth", "prefix", F.floor(F.col("conv_id") / block).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    return chunks.repartition("depth", "prefix").sortWithinPartitions("depth", "prefix", "chunk").mapInArrow(
        digest, "depth long, prefix binary, ends_sha256 string")


# --- the operator -----------------------------------------------------------------------------

def trie(rows: DataFrame, convs: DataFrame, block: int = BLOCK, block_arcs: int = BLOCK_ARCS) -> DataFrame:
    """Every node of the trie of ``rows(conv_id, depth, digest, n_words)`` and of the conversations ``convs(conv_id, length)``:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    names = durable(prefixes(rows.select("conv_id", "depth", "digest"), block), "names")
    nodes = nodes_of(rows, names, convs)
    places = durable(list_rank(tour(nodes), block_arcs), "places")
    children = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    weighed = durable(nodes.join(children, "node", "left").join(ends(convs, names, block), ["depth", "prefix"], "left").select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        (F.coalesce("n_children", F.lit(0)) == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")), "weighed")
    # Weights stand at enter arcs; a subtree's sum is what is summed between its top's two arcs.
    at = places.withColumn("node", F.shiftright("arc", 1)).join(weighed.select("node", "leaf", "saved"), "node")
    enter = F.col("arc") % 2 == 0
    sums = durable(prefix_sums(at.select("place", "arc", *[F.when(enter, F.col(c)).otherwise(0).alias(c) for c in ("leaf", "saved")]),
                               ["leaf", "saved"], block), "sums")
    spans = sums.groupBy(F.shiftright("arc", 1).alias("node")).agg(
        *[(F.max(F.when(~enter, F.col(c))) - F.max(F.when(enter, F.col(c)))).alias(f"{c}_below") for c in ("leaf", "saved")])
    return weighed.join(spans, "node").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaf") + F.col("leaf_below")).alias("n_leaves"),
        (F.col("saved") + F.col("saved_below")).alias("saved_tokens"), "ends_sha256")
