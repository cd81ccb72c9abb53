import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vetline.llm import mtree

KIND = "vec_id long, embedding array<double>, row int, score string, shard int"


def brute(rows, k, asks):
    """Every pair of rows, by Python integers."""
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(whole):
        if asks(q):
            scores = sorted((-sum(m * n for m, n in zip(x, y)), i) for b, (i, y) in enumerate(whole) if a != b)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5, step=3, **kw):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], KIND)
    df = df.withColumn("vec", mtree.quantised(F.col("embedding")))
    got = mtree.top_k(df, F.col("vec_id") % step == 0, k, **kw)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("shape", ["sphere", "clusters", "copies"])
def test_matches_brute_force_over_many_shards_and_pages(spark, shape):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6))
    if shape == "clusters":
        x = rng.normal(size=(8, 6))[rng.integers(0, 8, 400)] * 3 + 0.01 * x
    if shape == "copies":  # a third of all rows are one vector, others come in small groups
        x = np.where(rng.random((400, 1)) < 0.34, x[:1], np.round(x[rng.integers(0, 90, 400)], 1))
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(400), x)]
    assert run(spark, rows, shard_rows=40, page=4) == brute(rows, 5, lambda q: q % 3 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (3, None), (6, [1.0, None]), (9, [nan, 1.0]), (12, [inf, 0.0]), (None, [1.0, 1.0]), (15, []), (18, [3.0]),
            (1, [1.0, 2.0, 4.0]), (2, [0.0, 0.0]), (21, [-1.0, -2.0]), (0, [1.0, 2.0]), (0, [5.0, 0.5]), (24, [-0.0004, 0.0])]
    assert run(spark, rows, shard_rows=3, page=2) == brute(rows, 5, lambda q: q % 3 == 0)


def test_fewer_rows_than_k_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, [1.0])]) == []
    assert run(spark, [(3, None)]) == []
    assert run(spark, [(3, [1.0]), (4, [2.0])]) == [(3, 1, 4, 1024 * 2048)]


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-2e5, 2e5) for _ in range(4)]) for i in range(60)]
    assert run(spark, rows, shard_rows=10, page=3) == brute(rows, 5, lambda q: q % 3 == 0)


def test_stored_bounds_hold_and_save_distances():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(20, 8))[rng.integers(0, 20, 3000)] * 900 + 20 * rng.normal(size=(3000, 8))).astype(np.int64)
    longest = float((x.astype(float) ** 2).sum(axis=1).max())
    tree = mtree.MTree.build(x, [np.array([i]) for i in range(len(x))], longest, page=32)
    points = mtree.lift(tree.vectors, longest)

    def entries(number, node):
        below = range(tree.levels[number].low[node], tree.levels[number].high[node])
        return list(below) if not number else [e for child in below for e in entries(number - 1, child)]

    assert sorted(entries(len(tree.levels) - 1, 0)) == list(range(3000))
    for number, level in enumerate(tree.levels):
        for i in range(len(level.radius)):
            assert mtree.gaps(points[entries(number, i)], level.routing[i]).max() <= level.radius[i] + 1e-6
    assert (tree.levels[0].high - tree.levels[0].low).max() <= 32 and len(tree.levels[-1].radius) == 1
    seen = []
    plain, mtree.products = mtree.products, lambda v, q: seen.append(len(v)) or plain(v, q)
    try:
        for q in range(0, 3000, 100):
            got = tree.search(tree.vectors[q], int(tree.ids[q][0]), 10)
            scores = plain(tree.vectors, tree.vectors[q])
            want = sorted((-int(s), int(i[0])) for s, i in zip(scores, tree.ids) if i[0] != tree.ids[q][0])[:10]
            assert got == [(-s, i) for s, i in want]
    finally:
        mtree.products = plain
    assert sum(seen) < 0.3 * 30 * 3000  # most entries are never compared


def test_pages_keep_the_tree(spark):
    x = np.arange(60, dtype=np.int64).reshape(20, 3)
    tree = mtree.MTree.build(x, [np.array([i, i + 100]) for i in range(20)], float((x * x).sum(axis=1).max()), page=4)
    rows = sorted(mtree.page_rows(7, tree), key=lambda r: r[1:3])
    again = mtree.tree_of(rows, 3, tree.longest)
    assert again.search(x[3], 3, 4) == tree.search(x[3], 3, 4)
    assert len(again.levels) == len(tree.levels) and {r[0] for r in rows} == {7}
