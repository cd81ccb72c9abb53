import hashlib
import random
import re

import numpy as np
import xxhash

from vetline.llm import components, exact_dedup, queries, simhash
from vetline.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, digest string, kept_id int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


class TestExact:
    def test_largest_id_stays_nulls_are_empty_and_clashing_columns_pass(self, spark):
        docs = rows_of(spark, [(1, "a"), (3, "a"), (2, "b"), (4, None), (5, ""), (None, "b"), (None, "c")])
        got = {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.labelled(docs, exact_dedup.scratch_index(docs)).collect()}
        assert got == {(1, 3, 2, False), (3, 3, 2, True), (2, 2, 2, True), (None, 2, 2, False), (4, 5, 2, False), (5, 5, 2, True),
                       (None, None, 1, True)}
        kept = exact_dedup.deduplicate(docs, exact_dedup.scratch_index(docs))
        assert kept.columns == docs.columns
        assert {(r.doc_id, r.text) for r in kept.collect()} == {(3, "a"), (2, "b"), (5, ""), (None, "c")}

    def test_repeated_rows_keep_exactly_one(self, spark):
        docs = rows_of(spark, [(7, "same")] * 5 + [(3, "same")])
        got = exact_dedup.labelled(docs, exact_dedup.scratch_index(docs)).collect()
        assert len(got) == 6 and sum(r.kept for r in got) == 1 and {r.group_size for r in got} == {6}
        assert exact_dedup.deduplicate(docs, exact_dedup.scratch_index(docs)).count() == 1

    def test_index_persists_and_batches_can_be_repeated(self, spark):
        path = scratch_path(spark, "test-index")
        first = rows_of(spark, [(1, "a"), (2, "b")])
        assert exact_dedup.deduplicate(first, exact_dedup.DigestIndex(spark, path, buckets=3)).count() == 2
        later = rows_of(spark, [(9, "a"), (10, "c")])
        again = exact_dedup.DigestIndex(spark, path)
        assert again.buckets == 3
        assert [r.doc_id for r in exact_dedup.deduplicate(later, again).collect()] == [10]
        assert {r.doc_id for r in exact_dedup.deduplicate(first, exact_dedup.DigestIndex(spark, path)).collect()} == {1, 2}
        assert exact_dedup.DigestIndex(spark, path).rows().count() == 3

    def test_index_side_of_the_anti_join_is_not_shuffled(self, spark):
        docs = rows_of(spark, [(1, "a")])
        index = exact_dedup.scratch_index(docs)
        joined = index.rows().join(index.rows().hint("merge"), "digest", "left_anti")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()

    def test_empty(self, spark):
        docs = rows_of(spark, [])
        assert exact_dedup.labelled(docs, exact_dedup.scratch_index(docs)).count() == 0


def brute_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(parts))


class TestSimHash:
    def test_components_match_brute_force(self, spark):
        rng = random.Random(3)
        words = [f"w{k}" for k in range(300)]
        texts = [None, "", " \t", "One", "one", "one two"]
        for _ in range(12):
            base = [rng.choice(words) for _ in range(rng.choice((40, 400)))]
            for _ in range(12):
                copy = list(base)
                for _ in range(rng.randrange(3)):
                    copy[rng.randrange(len(copy))] = rng.choice(words)
                texts.append("  ".join(copy))
        texts.append(" ".join(rng.choice(words) for _ in range(70_000)))  # over one run of 16-bit counts
        rows = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
        prints = {i: brute_fingerprint(t) for i, t in rows}
        parent = {f: f for f in prints.values()}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in list(parent):
            for b in list(parent):
                if a < b and (a ^ b).bit_count() <= 3:
                    parent[find(a)] = find(b)
        smallest = {}
        for i, f in prints.items():
            smallest[find(f)] = min(i, smallest.get(find(f), i))
        docs = rows_of(spark, rows)
        got = {r.id: (r.fp % 2**64, r.component_id) for r in simhash.labelled(docs).collect()}
        assert got == {i: (f, smallest[find(f)]) for i, f in prints.items()}
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(smallest.values())

    def test_unequal_thresholds_and_split_blocks_lose_no_link(self, monkeypatch):
        monkeypatch.setattr(simhash, "BLOCK_ROWS", 64)
        rng = np.random.default_rng(5)
        centre = rng.integers(0, 2**63, dtype=np.uint64)
        one = np.uint64(1)
        dense = [centre ^ np.bitwise_or.reduce(one << rng.integers(0, 64, 4).astype(np.uint64)) for _ in range(400)]
        prints = np.unique(np.array(dense + rng.integers(0, 2**63, 600, dtype=np.uint64).tolist(), np.uint64))
        for m in (2, 3, 4):
            bits = (prints[:, None] >> np.arange(64, dtype=np.uint64)) & one
            together = (bits.astype(float).T @ bits.astype(float))
            plan = simhash.Plan(simhash.bit_groups(together, len(prints), m), 3, 16)
            counts = np.stack([np.bincount(plan.cell(prints & mask), minlength=1 << 16) for mask in plan.masks]).astype(float)
            plan.estimate(counts)
            assert (plan.thresholds(prints).sum(axis=1) == 4).all()
            keys, blocks, fps = (np.concatenate(x) for x in zip(*plan.rows(prints)))
            order = np.lexsort((fps, blocks, keys))
            found = set()
            for a, b in simhash._links_within(keys[order], blocks[order], fps[order], 3):
                found |= {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist()) if x != y}
            near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
            want = {(int(prints[i]), int(prints[j])) for i, j in zip(*np.nonzero(near)) if prints[i] < prints[j]}
            assert found == want

    def test_null_and_repeated_ids_keep_one_each(self, spark):
        docs = rows_of(spark, [(None, "a b c d"), (None, "a b c d"), (1, "e f g h"), (1, "e f g h"), (1, "x y z w v"), (2, "e f g h")])
        assert sorted(r.text for r in simhash.keep_one(docs).collect()) == ["a b c d", "e f g h", "x y z w v"]

    def test_empty(self, spark):
        assert simhash.labelled(rows_of(spark, [])).count() == 0
        assert simhash.keep_one(rows_of(spark, [])).count() == 0


def test_registered_simhash_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op10_simhash_near_dedup"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    rows = {r.doc_id: r for r in got.collect()}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    group = {i: i for i in prints}
    while any([group.update({a: group[b]}) is None for a in prints for b in prints
               if group[b] < group[a] and (prints[a] ^ prints[b]).bit_count() <= 3]):
        pass
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (f"{prints[i]:016x}", group[i]) for i in prints}


class TestComponents:
    def test_chains_stars_and_nulls(self, spark):
        links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (None, 3)]
        got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}}

    def test_local_forest(self):
        a, b = components.local_forest(np.array([5, 6, 9]), np.array([4, 5, 8]))
        assert dict(zip(a.tolist(), b.tolist())) == {5: 4, 6: 4, 9: 8}


def test_digest_is_sha256(spark):
    docs = rows_of(spark, [(1, "ä\0b")])
    (row,) = exact_dedup.labelled(docs, exact_dedup.scratch_index(docs)).collect()
    assert row.digest.hex() == hashlib.sha256("ä\0b".encode()).hexdigest()
