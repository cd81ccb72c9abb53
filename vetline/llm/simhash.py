"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are computed per text inside Arrow batches and reduced to the
distinct ones. To find all pairs within ``distance`` differing bits:

1. The co-occurrence of bits over *all* distinct fingerprints groups the bits
   that go together into ``m`` partitions, so that the bits of a group carry
   as much of their common information as possible in one place.
2. Histograms of every partition's values (folded linearly to a fixed number
   of cells) estimate how many candidates a probe with t flipped bits meets.
3. For each fingerprint a dynamic programme picks thresholds t_i >= -1 that
   sum to ``distance - m + 1`` and cost least; -1 leaves a partition out. By
   the generalised pigeonhole principle every partner agrees within t_i bits
   in some partition i, so no pair is lost whatever is picked.
4. Every fingerprint is filed under its own value in each partition and probes
   the values within t_i bits. Those that meet are compared in full.

Fingerprints that meet under one value are compared in blocks inside a task,
and a task gives out only a spanning forest of the links it finds, so a dense
group costs no quadratic output. The histograms also bound how many rows can
meet under a value; where that exceeds ``BLOCK_ROWS``, its rows are split into
chunks and every pair of chunks is compared in a task of its own. Nothing is
capped. Components come from ``components``.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and links like any other. Equal fingerprints are one group. A
null id is never a group's smallest unless the group has no other. Documents
may repeat, ids too; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain, combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.components import components, local_forest
from vetline.llm.frames import durable, fresh
from vetline.llm.words import LOWER, NONSPACE, mix64, slices, text_buffer, word_edges

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCK_ROWS = 1 << 16
#: Most bits one partition may differ by; higher thresholds cost more probes than they save candidates.
MOST_FLIPS = 2
#: Cost of shuffling a row, in comparisons.
ROW_COST = 100


# -- fingerprints --------------------------------------------------------------------------------

def shingle_hashes(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a slice's rows, and the rows' bounds in it."""
    starts, ends = word_edges(buf, offsets, NONSPACE)
    words = np.diff(np.searchsorted(starts, offsets))
    size = ends - starts
    at = np.concatenate(([0], np.cumsum(size + 1)))  # words joined by one space each
    joined = np.full(at[-1], 32, np.uint8)
    inside = NONSPACE[buf]
    joined[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = LOWER[buf[inside]]
    data = joined.tobytes()
    count = np.where(words == 0, 0, np.maximum(1, words - shingle + 1))
    bounds = np.concatenate(([0], np.cumsum(count)))
    word0 = np.concatenate(([0], np.cumsum(words)))[:-1]
    first = np.arange(bounds[-1]) + np.repeat(word0 - bounds[:-1], count)
    last = first + np.repeat(np.minimum(shingle, words), count) - 1
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(data[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] + size[last]).tolist())),
                         np.uint64, len(first))
    return hashes, bounds


def majority_bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row, the bits set in over half of its hashes; zero for a row without any.

    Counts 16-bit lanes four at a time, in runs short enough that no lane overflows.
    """
    n = np.diff(bounds)
    out = np.zeros(len(n), np.uint64)
    runs = -(-n // 0xFFFF)
    row = np.repeat(np.arange(len(n)), runs)
    if len(row) == 0:
        return out
    within = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_at = bounds[row] + within * 0xFFFF
    lanes = np.uint64(0x0001000100010001)
    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    full = row[heads]
    for k in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, run_at)
        for lane in range(4):
            count = np.add.reduceat((sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF), heads)
            out[full] |= (2 * count > n[full].astype(np.uint64)).astype(np.uint64) << np.uint64(16 * lane + k)
    return out


def fingerprint(text, shingle: int = SHINGLE):
    """Column of SimHash fingerprints (64 bits in a long) of a text column."""
    @F.arrow_udf("long")
    def fingerprints(col: pa.Array) -> pa.Array:
        parts = [majority_bits(*shingle_hashes(buf, offsets, shingle)) for _, _, buf, offsets in slices(*text_buffer(col))]
        return pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))

    return fingerprints(text)


# -- the search plan -------------------------------------------------------------------------------

class Plan:
    """Partitions of the 64 bits, and estimated probe costs from histograms of their values."""

    def __init__(self, groups: list[list[int]], distance: int, fold_bits: int):
        self.groups, self.distance, self.fold_bits = groups, distance, fold_bits
        self.masks = [np.uint64(sum(1 << b for b in g)) for g in groups]
        self.flips = []  # per partition and number of flips, the masks to apply
        for g in groups:
            self.flips.append([np.array([sum(1 << b for b in bits) for bits in combinations(g, t)], dtype=np.uint64)
                               for t in range(min(MOST_FLIPS, distance, len(g)) + 1)])
        self.met: list[list[np.ndarray]] = []

    def cell(self, values: np.ndarray) -> np.ndarray:
        """Folds by exclusive or of slices, so that flipping a bit moves every cell the same way."""
        step = np.uint64(self.fold_bits)
        low = np.uint64((1 << self.fold_bits) - 1)
        out = values & low
        for _ in range(64 // self.fold_bits):
            values = values >> step
            out = out ^ (values & low)
        return out.astype(np.int64)

    def estimate(self, histograms: np.ndarray) -> None:
        """``met[i][t]``: rows filed within exactly t flips of each cell of partition i."""
        cells = np.arange(1 << self.fold_bits)
        self.met = []
        for counts, by_flips in zip(histograms, self.flips):
            self.met.append([sum(counts[cells ^ int(c)] for c in self.cell(masks)).astype(np.float32) for masks in by_flips])

    def thresholds(self, prints: np.ndarray) -> np.ndarray:
        """t_i + 1 for each fingerprint and partition, by dynamic programming on estimated costs."""
        goal, n = self.distance + 1, len(prints)
        best = np.full((n, goal + 1), np.inf, np.float32)
        best[:, 0] = 0
        picks = []
        for mask, by_flips, met in zip(self.masks, self.flips, self.met):
            cell = self.cell(prints & mask)
            cost = [np.zeros(n, np.float32)]
            for flips, table in zip(by_flips, met):
                cost.append(cost[-1] + ROW_COST * len(flips) + table[cell])
            now = np.full_like(best, np.inf)
            pick = np.zeros((n, goal + 1), np.int8)
            for t, c in enumerate(cost):
                for s in range(t, goal + 1):
                    total = best[:, s - t] + c
                    better = total < now[:, s]
                    now[better, s] = total[better]
                    pick[better, s] = t
            best = now
            picks.append(pick)
        left = np.full(n, goal)
        out = np.zeros((n, len(picks)), np.int8)
        for i in range(len(picks) - 1, -1, -1):
            out[:, i] = picks[i][np.arange(n), left]
            left = left - out[:, i]
        return out

    def rows(self, prints: np.ndarray):
        """Yields ``(key, block, fingerprint)`` arrays: filing and probing rows of a batch."""
        wanted = self.thresholds(prints)
        for i, mask in enumerate(self.masks):
            own = prints & mask
            for t, flips in enumerate(self.flips[i]):
                who = np.arange(len(prints)) if t == 0 else np.flatnonzero(wanted[:, i] > t)
                for flip in flips if len(who) else ():
                    value = own[who] ^ flip
                    yield from self._blocks(i, value, prints[who])

    def _blocks(self, i: int, value: np.ndarray, prints: np.ndarray):
        key = mix64(value + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        most = sum(table[self.cell(value)] for table in self.met[i])
        chunks = np.ceil(most / BLOCK_ROWS).astype(np.int64)
        few = chunks <= 1
        yield key[few], np.zeros(few.sum(), np.int64), prints[few]
        for j in np.flatnonzero(~few):  # every pair of chunks meets in a block of its own
            n = chunks[j]
            own = int(mix64(prints[j:j + 1] ^ np.uint64(0x5851F42D4C957F2D))[0] % np.uint64(n))
            other = np.arange(n)
            yield np.full(n, key[j]), np.minimum(own, other) * n + np.maximum(own, other) + 1, np.full(n, prints[j])


def bit_groups(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """``m`` groups of about equal size, each grown from the bits most correlated with it."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, groups = list(range(64)), []
    for k in range(m):
        size = -(-len(free) // (m - k))
        group = [free[int(np.argmax(tie[np.ix_(free, free)].sum(axis=1)))]]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(rest[int(np.argmax(tie[np.ix_(rest, group)].sum(axis=1)))])
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def partition_count(n: int, distance: int) -> int:
    """The number of partitions that costs least for ``n`` fingerprints with evenly spread bits."""
    def cost(m: int) -> float:
        spare = distance + 1 - m  # thresholds above zero, dealt to the partitions in turn
        total = 0.0
        for i in range(m):
            t = spare // m + (i < spare % m)
            if t > MOST_FLIPS:
                return float("inf")
            width = 64 // m
            probes = sum(comb(width, f) for f in range(t + 1))
            total += probes * (ROW_COST + n / 2 ** width) + ROW_COST
        return total
    return min(range(2, distance + 2), key=cost) if distance else 1


def make_plan(prints: DataFrame, distance: int) -> Plan:
    """Statistics over all distinct fingerprints (column fp), and the plan drawn from them."""
    n = prints.count()

    def bits(batches):
        total = np.zeros((64, 64), np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(fp), 1 << 16):
                one = ((fp[a:a + (1 << 16), None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += (one.T @ one).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], ["cell", "n"])

    together = np.zeros(64 * 64)
    for row in prints.mapInArrow(bits, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # 4,096 at most
        together[row.cell] = row.n
    plan = Plan(bit_groups(together.reshape(64, 64), n, partition_count(n, distance)), distance,
                min(20, max(16, int(log2(max(n, 1))) - 9)))

    def cells(batches):
        total = np.zeros((len(plan.groups), 1 << plan.fold_bits), np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, mask in enumerate(plan.masks):
                total[i] += np.bincount(plan.cell(fp & mask), minlength=total.shape[1])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["cell", "n"])

    histograms = np.zeros(len(plan.groups) << plan.fold_bits)
    counted = prints.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # fixed size
    histograms[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    plan.estimate(histograms.reshape(len(plan.groups), -1))
    return plan


# -- links -----------------------------------------------------------------------------------------

def _links_within(keys: np.ndarray, blocks: np.ndarray, prints: np.ndarray, distance: int):
    """Pairs of rows under the same key and block that differ in few bits; rows come sorted by both."""
    n = len(keys)
    if n == 0:
        return
    heads = np.concatenate(([True], (keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])))
    starts = np.flatnonzero(heads)
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    live, shift = np.flatnonzero(end > np.arange(n) + 1), 1
    while len(live):
        near = live[np.bitwise_count(prints[live] ^ prints[live + shift]) <= distance]
        if len(near):
            yield prints[near], prints[near + shift]
        shift += 1
        live = live[end[live] > live + shift]


def find_links(prints: DataFrame, plan: Plan) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within the plan's distance."""
    distance = plan.distance

    def probe(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(fp), 1 << 14):
                held, size = [], 0
                for rows in plan.rows(fp[a:a + (1 << 14)]):
                    held.append(rows)
                    size += len(rows[0])
                    if size > 1 << 18:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    def compare(batches):
        rest, found, size = None, [], 0

        def forest():
            a, b = local_forest(*(np.concatenate(x) for x in zip(*found)))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in chain(batches, [None]):
            if batch is None:
                keys, blocks, fp = rest or (np.zeros(0, np.int64),) * 3
                whole = len(keys)
            else:
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                keys, blocks, fp = new if rest is None else (np.concatenate(x) for x in zip(rest, new))
                if len(keys) == 0:
                    continue
                last = (keys == keys[-1]) & (blocks == blocks[-1])
                whole = int(np.argmax(last))  # the last group may go on in the next batch
            for a, b in _links_within(keys[:whole], blocks[:whole], fp[:whole].view(np.uint64), distance):
                found.append((a, b))
                size += len(a)
                if size > 1 << 20:
                    kept = local_forest(*(np.concatenate(x) for x in zip(*found)))
                    found, size = [kept], len(kept[0])
                    if size > 1 << 19:
                        yield forest()
                        found, size = [], 0
            rest = (keys[whole:], blocks[whole:], fp[whole:])
        if found:
            yield forest()

    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (prints.mapInArrow(probe, "key long, block long, fp long")
            .repartition(parts, "key", "block").sortWithinPartitions("key", "block", "fp")
            .mapInArrow(compare, "a long, b long"))


def _batch(held) -> pa.RecordBatch:
    key, block, fp = (np.concatenate(x) for x in zip(*held))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(block), pa.array(fp.view(np.int64))], ["key", "block", "fp"])


# -- the operator ----------------------------------------------------------------------------------

def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            distance: int = DISTANCE) -> tuple[DataFrame, DataFrame]:
    """``(members, classes)``, both durable.

    members: id, fp, one row per document. classes: fp, component_id (the
    smallest id of the documents reachable over links), one row per distinct
    fingerprint.
    """
    members = durable(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash-members")
    prints = durable(members.groupBy("fp").agg(F.min("id").alias("smallest")), "simhash-prints")
    only = prints.select("fp")
    found = components(find_links(only, make_plan(only, distance)))
    rooted = durable(prints.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left")
                     .select("fp", "smallest", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    lowest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return members, durable(rooted.join(lowest.hint("merge"), "root").select("fp", "root", "component_id"), "simhash-classes")


def labelled(docs: DataFrame, **options) -> DataFrame:
    """id, fp, component_id: one row per document."""
    members, found = classes(docs, **options)
    return members.join(found.hint("merge"), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns.

    If several rows share that id, one of them stays.
    """
    members, found = classes(docs, id_col=id_col, text_col=text_col, shingle=shingle, distance=distance)
    first = (members.groupBy("id", "fp").agg(F.count("*").alias("n")).join(found.hint("merge"), "fp").groupBy("root")
             .agg(F.min(F.struct(F.col("id").isNull(), "id", "fp")).alias("top")).select("top.id", "top.fp"))
    rows_of_id = members.groupBy("id").agg(F.count("*").alias("n"))
    id_, fp, n = (fresh(docs, c) for c in ("kept_id", "kept_fp", "kept_rows"))
    keys = durable(first.join(rows_of_id, "id", "left").select(F.col("id").alias(id_), F.col("fp").alias(fp), F.col("n").alias(n)),
                   "simhash-kept")
    kept = docs.join(keys.where(F.col(n) == 1).hint("merge"), docs[id_col] == keys[id_]).select(*docs.columns)
    unclear = keys.where(F.col(id_).isNull() | (F.col(n) > 1)).drop(n)  # the id alone does not name the row
    if unclear.isEmpty():
        return kept
    rows = docs.withColumn(fp, fingerprint(F.col(text_col), shingle)).join(unclear.hint("merge"), fp)
    return kept.unionAll(rows.where(F.col(id_col).eqNullSafe(F.col(id_))).dropDuplicates([fp]).select(*docs.columns))
