import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from vetline.llm import trie

KIND = "conv_id long, turn long, role string, text string, depth int, node string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """The trie by Python dictionaries of whole prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, sha(sha(role or "") + sha(text or "")), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(own_members) - 1) * words
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)))) for p, m in members.items()), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND)
    got = trie.trie(*trie.rebuilt(trie.turns_of(df)), **kw)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=repr)


def talk(rng, convs, longest, words):
    return [(c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice(words) for _ in range(rng.randrange(3))))
            for c in convs for t in range(rng.randrange(longest))]


@pytest.mark.parametrize("block,arcs", [(3, 8), (4096, 1 << 16)])
def test_matches_brute_force(spark, block, arcs):
    rng = random.Random(4)
    rows = talk(rng, [*range(0, 70), *range(1000, 1025), -3, -25, 20000], 7, ["a", "b"])
    assert run(spark, rows, block=block, block_arcs=arcs) == brute(rows)


def test_nulls_ties_repeated_rows_and_emptied_conversations(spark):
    rows = [(0, None, "user", "first"), (0, 1, None, "x y"), (0, 1, "user", None), (0, 1, "user", None), (1, 0, "user", "only"),
            (2, 5, "user", "a b c"), (2, 5, "user", "a b c"), (None, 0, "user", "lost"), (7, 0, None, None), (45, 0, "u", "no base")]
    assert run(spark, rows, block=2, block_arcs=4) == brute(rows)


def test_no_conversations(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_one_conversation_and_one_prefix_hold_most_rows(spark):
    rows = [(c, 0, "user", "same start") for c in range(0, 300)] + [(c, 1, "assistant", "same end") for c in range(0, 300)]
    rows += [(500, t, "user", f"turn {t}") for t in range(250)]
    assert run(spark, rows, block=16, block_arcs=64) == brute(rows)


def test_lists_are_ranked_whatever_their_order(spark):
    rng = random.Random(8)
    for n in (1, 2, 500):
        order = list(range(0, 3 * n, 3))
        rng.shuffle(order)
        links = spark.createDataFrame([(a, b) for a, b in zip(order, [*order[1:], None])], "arc long, succ long")
        got = {r.arc: r.place for r in trie.list_rank(links, block_arcs=40).collect()}
        assert got == {a: k for k, a in enumerate(order)}


def test_contraction_of_one_share():
    head, away, last = trie.contract(np.array([5, 9, 2, 7]), np.array([2, 5, 40, -1]), np.array([1, 10, 100, 1000]))
    assert head.tolist() == [1, 1, 1, 3] and away.tolist() == [10, 0, 11, 0] and last.tolist() == [-1, 2, -1, 3]


def test_prefix_sums_over_blocks(spark):
    df = spark.createDataFrame([(k, k % 5, 1, "x") for k in range(100)], "place long, a long, b long, c string")
    got = sorted(tuple(r) for r in trie.prefix_sums(df, ["a", "b"], block=4).collect())
    assert got == [(k, sum(i % 5 for i in range(k + 1)), k + 1, "x") for k in range(100)]


def test_numbering_has_no_gaps(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id % 10 AS a", "id AS b", "'x' AS c")
    got = trie.numbered(df, ["a", "b"], "n").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == sorted((i % 10, i) for i in range(1000))
    assert sorted(r.n for r in got) == list(range(1000))
    assert trie.numbered(df.where("b < 0"), ["a"], "n").count() == 0
