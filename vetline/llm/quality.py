"""Quality classifier: regularised quadratic discriminant analysis.

Each text is described by a few statistics (shares of byte classes, word
lengths, repetition of words and lines), computed over Arrow batches and
transformed towards normal shape by logarithms and logits. For each class the
mean and covariance of these statistics come from sums that Spark aggregates
over all labelled rows; the covariance is shrunk towards the pooled one and
towards its own average variance, and its Cholesky factor is kept. A text's
score is the posterior probability of class 1, from the difference of the two
Mahalanobis log-densities and the class shares.

Defined cases: a null text counts as empty; an empty text has the statistics
of no words and is scored like any other. Labels that are null, other than 0
and 1, or of documents that are not there are not learnt from; a document
labelled twice counts twice. Two constant inputs, repeated rows and extra
columns are harmless. If a class has no labelled row at all, every score is
the share of class 1 (one half without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm.frames import durable, fresh
from vetline.llm.words import NONSPACE, hash_words, slices, text_buffer, word_edges

#: Names of the statistics, in the order of a feature vector.
FEATURES = ("log_bytes", "upper", "digit", "mark", "end_mark", "non_ascii", "space", "log_word_bytes", "word_bytes_spread",
            "distinct_words", "top_word", "next_repeat", "bigram_repeat", "line_words", "line_repeat", "short_words")

_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".,;:?"]] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK[ord("A"):ord("Z") + 1] = _MARK[ord("a"):ord("z") + 1] = False
_MARK &= ~_DIGIT & ~_END
_HIGH = np.arange(256) >= 128
_SPACE = ~NONSPACE
_LINE = np.ones(256, bool)
_LINE[[10, 13]] = False


def _logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log((part + 0.5) / (whole - part + 0.5))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of per-item values over each row (rows may be empty)."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the number of distinct values and the count of the commonest."""
    if len(rows) == 0:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    # The row number replaces the top bits: one plain sort groups values by row.
    width = np.uint64(max(1, int(n).bit_length()))
    key = (rows.astype(np.uint64) << (np.uint64(64) - width)) | (values >> width)
    key.sort()
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(heads, len(key)))
    row = (key[heads] >> (np.uint64(64) - width)).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, row, count)
    return np.bincount(row, minlength=n), top


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature matrix (rows by FEATURES) of a slice of texts."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    starts, ends = word_edges(buf, offsets, NONSPACE)
    bounds = np.searchsorted(starts, offsets)
    words = np.diff(bounds)
    length = ends - starts
    hashes = hash_words(buf, starts, ends)
    row = np.repeat(np.arange(n), words)
    distinct, top = _distinct(row, hashes, n)
    same_row = row[1:] == row[:-1]
    repeat = np.append(same_row & (hashes[1:] == hashes[:-1]), False)[:len(row)]
    pair = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    pairs, _ = _distinct(row[:-1][same_row], pair[same_row], n)
    line_start, line_end = word_edges(buf, offsets, _LINE)
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    lines = np.bincount(line_row, minlength=n)
    distinct_lines, _ = _distinct(line_row, hash_words(buf, line_start, line_end), n)
    letters = np.maximum(_sums(length, bounds), 0)
    squares = _sums(length * length, bounds)
    mean = (letters + 1) / (words + 1)
    return np.stack([
        np.log1p(size),
        _logit(_sums(_UPPER[buf], offsets), size),
        _logit(_sums(_DIGIT[buf], offsets), size),
        _logit(_sums(_MARK[buf], offsets), size),
        _logit(_sums(_END[buf], offsets), size),
        _logit(_sums(_HIGH[buf], offsets), size),
        _logit(_sums(_SPACE[buf], offsets), size),
        np.log(mean),
        0.5 * np.log((squares + 1) / (words + 1) - np.minimum(mean * mean, (squares + 1) / (words + 1)) + 0.1),
        _logit(distinct, words),
        _logit(top, np.maximum(words, top)),
        _logit(_sums(repeat, bounds), words),
        _logit(np.maximum(words - 1, 0) - pairs, np.maximum(words - 1, 0)),
        np.log1p(words) - np.log1p(lines),
        _logit(lines - distinct_lines, lines),
        _logit(_sums(length <= 3, bounds), words),
    ], axis=1)


def features(text: Column) -> Column:
    """Array column of a text column's statistics."""
    @F.arrow_udf("array<double>")
    def describe(col: pa.Array) -> pa.Array:
        parts = [statistics(buf, offsets) for _, _, buf, offsets in slices(*text_buffer(col))]
        flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1) * len(FEATURES), pa.int32()), pa.array(flat))

    return describe(text)


@dataclass
class Discriminant:
    """Class shares, means and Cholesky factors (lower) of the shrunk covariances."""

    share: np.ndarray
    means: np.ndarray
    factors: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        if len(self.means) == 0:
            return np.full(len(x), self.share[1])
        logs = []
        for share, mean, factor in zip(self.share, self.means, self.factors):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(np.log(share) - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        features_col: str = "features", to_pooled: float = 0.4, to_round: float = 0.05) -> Discriminant:
    """Learn from the labelled rows of ``described`` (an id and its statistics).

    The sums of each class (count, values, products) are partial aggregates; a
    few hundred numbers a class reach the driver whatever the input.
    ``to_pooled`` and ``to_round`` are the weights of the pooled covariance and
    of the round one in a class's own.
    """
    k = len(FEATURES)
    wanted = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    rows = described.select(F.col(id_col).alias("_id"), F.col(features_col).alias("_x")).join(wanted, "_id")
    x = [F.col("_x")[i] for i in range(k)]
    sums = [F.count("*").alias("n")] + [F.sum(a).alias(f"s{i}") for i, a in enumerate(x)]
    sums += [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i + 1)]
    got = {r["_label"]: r for r in rows.groupBy("_label").agg(*sums).collect()}  # one row a class
    total = sum(r["n"] for r in got.values())
    if len(got) < 2:
        one = got[1]["n"] / total if 1 in got else (0.0 if 0 in got else 0.5)
        return Discriminant(np.array([1 - one, one]), np.zeros((0, k)), np.zeros((0, k, k)))
    share, means, spreads = [], [], []
    for label in (0, 1):
        r = got[label]
        mean = np.array([r[f"s{i}"] for i in range(k)]) / r["n"]
        products = np.zeros((k, k))
        for i in range(k):
            for j in range(i + 1):
                products[i, j] = products[j, i] = r[f"p{i}_{j}"] / r["n"]
        share.append(r["n"] / total), means.append(mean), spreads.append(products - np.outer(mean, mean))
    pooled = share[0] * spreads[0] + share[1] * spreads[1]
    factors = []
    for spread in spreads:
        mixed = (1 - to_pooled) * spread + to_pooled * pooled
        scale = np.trace(mixed) / k
        factors.append(np.linalg.cholesky((1 - to_round) * mixed + to_round * (scale + 1e-6) * np.eye(k)))
    return Discriminant(np.array(share), np.array(means), np.array(factors))


def score(described: Column, model: Discriminant) -> Column:
    """Score column (0 to 1) from an array column of statistics."""
    @F.arrow_udf("double")
    def posterior(col: pa.Array) -> pa.Array:
        return pa.array(model.posterior(col.values.to_numpy(zero_copy_only=False)[col.offsets[0].as_py():col.offsets[-1].as_py()]
                                        .reshape(-1, len(FEATURES))))

    return posterior(described)


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``features`` of every document, written out once."""
    return durable(docs.select(F.col(id_col), features(F.col(text_col)).alias("features")), "quality-features")


def keep_good(docs: DataFrame, model: Discriminant, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents scored ``threshold`` or more, with all their columns; one pass, no shuffle."""
    described = fresh(docs, "statistics")
    return (docs.withColumn(described, features(F.col(text_col)))
            .where(score(F.col(described), model) >= threshold).select(*docs.columns))
