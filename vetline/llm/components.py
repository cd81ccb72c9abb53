"""Connected components of a link table, by repeated contraction.

Each round hooks every node to its smallest neighbour, follows these pointers
once, and rewrites the links between the nodes pointed to; links inside what
has merged vanish. Rounds needed grow with the logarithm of a component's
diameter. A hub is only ever the key of a minimum or of a join that AQE can
split, never a collected list. Every round is written to the shared folder, so
a lost executor costs at most the current round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.frames import durable


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; roots are the smallest nodes reached.

    Any orderable type; self-links and repeated links are allowed, null ends are ignored.
    """
    edges = durable(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hooks = durable(_jump(durable(hooks, "hooks")), "hooks")
        ends = (edges.join(hooks.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
                .join(hooks.select(F.col("node").alias("b"), F.col("up").alias("y")), "b").select("x", "y"))
        rest = hooks.select(F.col("node").alias("x"), F.col("up").alias("z"))
        unfinished = hooks.join(rest, hooks["up"] == rest["x"]).where("x <> z").select("x", F.col("z").alias("y"))
        labels = hooks if labels is None else durable(_follow(labels, hooks), "labels")
        edges = durable(ends.unionAll(unfinished).where("x <> y")
                        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels.select("node", F.col("up").alias("root"))


def _jump(hooks: DataFrame) -> DataFrame:
    onward = hooks.select(F.col("node").alias("up"), F.col("up").alias("further"))
    return hooks.join(onward, "up").select("node", F.col("further").alias("up"))


def _follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    onward = hooks.select(F.col("node").alias("up"), F.col("up").alias("further"))
    return labels.join(onward, "up", "left").select("node", F.coalesce("further", "up").alias("up"))


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links reduced to one ``(node, smallest node of its component)`` per node that is not the smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    up = np.arange(len(nodes))
    while True:
        low = np.minimum(up[x], up[y])
        before = up.copy()
        np.minimum.at(up, up[x], low)
        np.minimum.at(up, up[y], low)
        np.minimum.at(up, x, low)
        np.minimum.at(up, y, low)
        up = up[up]
        if (up == before).all():
            break
    child = up != np.arange(len(nodes))
    return nodes[child], nodes[up[child]]
