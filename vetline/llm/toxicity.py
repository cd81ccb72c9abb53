"""Toxicity from two class-conditional Kneser-Ney language models.

For each class (toxic, ordinary) a bigram model is learnt whose counts are
numbers of distinct documents, so that one document repeating itself counts
once. Both classes back off to one shared distribution s of continuation
counts: in how many distinct contexts (words before it) a word occurs. An
expression (a word, or a word after another) gets estimates of its own in the
two classes only if its counts differ between them by more than chance and by
a clear factor; its count is then discounted, and the discounted mass goes to
the lower order, as in Kneser-Ney smoothing. Everything not set apart takes its
probability from the lower order, the same in both classes up to normalisation:

    p_y(w)     = max(c_y(w) - D, 0) / N_y + D T_y / N_y s(w)                    for words set apart
               = a_y s(w)                                                       else
    p_y(w | v) = max(c_y(vw) - D, 0) / c_y(v) + D T_y(v) / c_y(v) s(w | v)      for pairs set apart
               = a_y(v) p_y(w)                                                  else

T_y are the distinct words of a class, T_y(v) those that follow v in it; s(w | v)
is the Kneser-Ney estimate from both classes' counts, with s(w) below it. For
words chance is measured by standard deviations, for pairs, of which most are
rare, by the likelihood ratio, which holds for small counts too; a_y and a_y(v)
make each distribution sum to one (estimates of pairs that would take more than
0.99 of a context are scaled down to that). A text's evidence is
the difference of its two log-likelihoods over its length (plus ``PRIOR_WORDS``,
so that a single word in a very short text weighs less). A logistic curve
fitted on training documents that the models were not learnt from turns it into
a score.

Learning uses at most about ``ROWS_PER_CLASS`` labelled documents of each class,
chosen by a hash of the id; all of them where there are fewer. The counts, and
what reaches the driver, are bounded by that. Scoring is one pass over all
documents.

Defined cases: null or empty texts have no evidence and get the curve's value
at zero. Labels that are null or not 0 or 1 are not learnt from. Without
labels of both classes every score is the share of label 1 among those there
are (zero without labels). Repeated rows and extra columns are harmless.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm.frames import durable
from vetline.llm.words import ALNUM, lookup, mix64, slices, text_buffer, words_of

ROWS_PER_CLASS = 10_000
DISCOUNT = 0.75
LEAST_SIGMAS = 6.0
LEAST_FACTOR = 4.0
PRIOR_WORDS = 25
#: One training document in this many sets the curve instead of the counts.
CURVE_FOLD = 5


def _pairs(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the word before it, and whether there is one in its text."""
    before = np.concatenate(([np.uint64(0)], hashes[:-1])) if len(hashes) else hashes
    inner = np.ones(len(hashes), bool)
    inner[bounds[:-1][bounds[:-1] < len(hashes)]] = False
    return mix64(before * np.uint64(0x9E3779B97F4A7C15) ^ hashes), inner


def _by_document(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of the first of each distinct value of each row."""
    order = np.lexsort((values, rows))
    r, v = rows[order], values[order]
    return order[np.concatenate(([True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])))] if len(order) else order


def _counts(batches):
    """Per slice, how many documents of each class hold each word (context 0) and each pair; word 0: all pairs of a context."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b, buf, offsets in slices(*text_buffer(batch.column("text"))):
            hashes, bounds = words_of(buf, offsets, ALNUM)
            row = np.repeat(np.arange(b - a), np.diff(bounds))
            toxic = label[a:b][row]
            names, inner = _pairs(hashes, bounds)
            words = _by_document(row, hashes)
            yield _tally(hashes[words], toxic[words], lambda first: (np.zeros(len(first), np.uint64), hashes[words[first]]))
            pairs = np.flatnonzero(inner)
            pairs = pairs[_by_document(row[pairs], names[pairs])]
            yield _tally(names[pairs], toxic[pairs], lambda first: (hashes[pairs[first] - 1], hashes[pairs[first]]))
            yield _tally(hashes[pairs - 1], toxic[pairs], lambda first: (hashes[pairs[first] - 1], np.zeros(len(first), np.uint64)))


def _tally(names: np.ndarray, toxic: np.ndarray, spell) -> pa.RecordBatch:
    """Counts of each name by class; ``spell`` gives context and word for the first place of each."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    heads = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(names) else np.zeros(0, np.int64)
    both = np.diff(np.append(heads, len(names)))
    ones = np.add.reduceat(toxic[order], heads) if len(heads) else both
    context, word = spell(order[heads])
    return pa.RecordBatch.from_arrays([pa.array(context.view(np.int64)), pa.array(word.view(np.int64)), pa.array(ones.astype(np.int64)),
                                       pa.array((both - ones).astype(np.int64))], ["context", "word", "toxic", "ordinary"])


def _tables(rows: DataFrame) -> DataFrame:
    """The counts of text and label rows, all from one shuffle: ``kind`` 0 as ``_counts``, without pairs of one document.

    Kind 1, for each word, the distinct contexts it occurs in; kind 2, for each context, the distinct words that
    follow it; over all pairs, by class and in either class.
    """
    counts = (rows.mapInArrow(_counts, "context long, word long, toxic long, ordinary long")
              .groupBy("context", "word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    either = F.col("toxic") + F.col("ordinary")
    pair = (F.col("context") != 0) & (F.col("word") != 0) & (either > 0)

    def distinct(kind: int, key: str) -> DataFrame:
        # The sums take the tests, not a filter: it would be pushed below the shuffle, which then could not be shared.
        tallies = [F.sum(F.when(pair & (F.col(c) > 0), 1).otherwise(0)).alias(c) for c in ("toxic", "ordinary")]
        other = F.lit(0).cast("long").alias("word" if key == "context" else "context")
        return (counts.groupBy(key).agg(*tallies, F.sum(F.when(pair, 1).otherwise(0)).alias("either"))
                .select(F.lit(kind).alias("kind"), key, other, "toxic", "ordinary", "either"))

    kept = counts.where((F.col("context") == 0) | (F.col("word") == 0) | (either > 1))
    return (kept.select(F.lit(0).alias("kind"), "context", "word", "toxic", "ordinary", either.alias("either"))
            .unionByName(distinct(1, "word")).unionByName(distinct(2, "context")))


def _surely_apart(share: Column) -> Column:
    """As ``_apart``, with chance measured by the likelihood ratio, which a rare expression cannot pass by luck."""
    total = F.col("toxic") + F.col("ordinary")

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / (expected + 1e-9))).otherwise(0.0)

    ratio = 2 * (part(F.col("toxic"), total * share) + part(F.col("ordinary"), total * (1 - share)))
    return (ratio >= LEAST_SIGMAS ** 2) & _clearly(share)


def _clearly(share: Column) -> Column:
    total = F.col("toxic") + F.col("ordinary")
    expected = total * share
    odds = ((F.col("toxic") + 0.1) / (F.col("ordinary") + 0.1)) / ((expected + 0.1) / (total - expected + 0.1))
    return F.abs(F.log(odds)) >= float(np.log(LEAST_FACTOR))


def _apart(share: Column) -> Column:
    """Whether the toxic count of an expression differs from its expected share beyond chance and by a clear factor."""
    total = F.col("toxic") + F.col("ordinary")
    expected = total * share
    sigmas = F.abs(F.col("toxic") - expected) / F.sqrt(expected * (1 - share) + 1e-9)
    return (sigmas >= LEAST_SIGMAS) & _clearly(share)


def _backed_off(own: np.ndarray, lower: np.ndarray) -> float:
    """Log weight of the lower distribution outside the expressions set apart."""
    return float(np.log(max(1 - own.sum(), 1e-9)) - np.log(max(1 - lower.sum(), 1e-9)))


@dataclass
class Model:
    """Log-probability differences (toxic less ordinary) by hash, and the curve."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    word_gain: np.ndarray = field(default_factory=lambda: np.zeros(0))
    other_gain: float = 0.0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_gain: np.ndarray = field(default_factory=lambda: np.zeros(0))
    contexts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    context_gain: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 0.0
    offset: float = 0.0
    constant: float | None = None

    def evidence(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text, the length-normalised difference of the log-likelihoods."""
        hashes, bounds = words_of(buf, offsets, ALNUM)
        at, known = lookup(self.words, hashes)
        gain = np.full(len(hashes), self.other_gain)
        gain[known] = self.word_gain[at[known]]
        if len(self.pairs):
            names, inner = _pairs(hashes, bounds)
            at, known = lookup(self.contexts, np.concatenate(([np.uint64(0)], hashes[:-1])))
            known &= inner
            gain[known] += self.context_gain[at[known]]
            at, known = lookup(self.pairs, names)
            known &= inner
            gain[known] = self.pair_gain[at[known]]
        total = np.concatenate(([0.0], np.cumsum(gain)))
        return (total[bounds[1:]] - total[bounds[:-1]]) / (np.diff(bounds) + PRIOR_WORDS)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(evidence), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -700, 700)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a lightly regularised logistic regression, by Newton's method."""
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    ridge = np.diag([1e-3, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def _evidence(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def weigh(col: pa.Array) -> pa.Array:
        parts = [model.evidence(buf, offsets) for _, _, buf, offsets in slices(*text_buffer(col))]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return weigh(text)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Learn from the labelled documents."""
    wanted = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    size = {r["label"]: r["count"] for r in wanted.groupBy("label").count().collect()}  # one row a class
    if len(size) < 2:
        return Model(constant=float(1 in size))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxicity")), F.lit(1_000_000))
    keep = F.when(F.col("label") == 1, draw < int(1e6 * rows_per_class / size[1])).otherwise(draw < int(1e6 * rows_per_class / size[0]))
    rows = durable(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted.where(keep), "id")
                   .withColumn("fold", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("curve")), F.lit(CURVE_FOLD)))
                   .select("text", "label", "fold"), "toxicity-sample")
    counts = durable(_tables(rows.where("fold > 0").select("text", "label")), "toxicity-counts")
    model = _learn(counts)
    curve = rows.where("fold = 0").select(_evidence(F.col("text"), model).alias("x"), "label").toArrow()  # a part of the sample
    y = curve["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        curve = rows.select(_evidence(F.col("text"), model).alias("x"), "label").toArrow()
        y = curve["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return Model(constant=size[1] / (size[0] + size[1]))
    model.slope, model.offset = _curve(curve["x"].to_numpy(), y.astype(float))
    return model


def _learn(counts: DataFrame) -> Model:
    everyone = counts.where("kind = 0").drop("kind", "either")
    words = everyone.where("context = 0").drop("context")
    totals = words.agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"), F.count("*").alias("v"),
                       F.sum((F.col("toxic") > 0).cast("long")).alias("tt"), F.sum((F.col("ordinary") > 0).cast("long")).alias("to")).first()
    n = np.array([totals.t or 0, totals.o or 0], float)
    if not n.all():
        return Model()
    everything, vocabulary = n.sum(), totals.v
    contexts = counts.where("kind = 1").select("word", F.col("either").alias("contexts"))
    continued = contexts.agg(F.sum("contexts").alias("n")).first().n or 0
    words = words.join(contexts, "word", "left").withColumn("contexts", F.coalesce("contexts", F.lit(0)))
    apart = words.where(_apart(F.lit(n[0] / everything))).orderBy("word").toArrow()  # bounded by the sample
    names = apart["word"].to_numpy().view(np.uint64)
    own = np.stack([apart["toxic"].to_numpy(), apart["ordinary"].to_numpy()]).astype(float)
    shared = (apart["contexts"].to_numpy() + 1) / (continued + vocabulary + 1)
    p = np.maximum(own - DISCOUNT, 0) / n[:, None] + (DISCOUNT * np.array([totals.tt, totals.to]) / n)[:, None] * shared
    other = np.array([_backed_off(p[y], shared) for y in (0, 1)])
    order = np.argsort(names)
    model = Model(words=names[order], word_gain=(np.log(p[0]) - np.log(p[1]))[order], other_gain=float(other[0] - other[1]))

    # Pairs: the share to expect follows from the context's counts and the word's own estimates.
    gains = counts.sparkSession.createDataFrame(list(zip(apart["word"].to_pylist(), (np.log(p[0]) - np.log(p[1])).tolist())),
                                                "word long, gain double")
    known = (everyone.where("context <> 0 AND word <> 0")
             .join(everyone.where("word = 0").select("context", F.col("toxic").alias("ct"), F.col("ordinary").alias("co")), "context")
             .join(gains, "word", "left"))
    odds = (F.col("ct") + 0.1) / (F.col("co") + 0.1) * F.exp(F.coalesce("gain", F.lit(model.other_gain)))
    followers = counts.where("kind = 2").select("context", F.col("toxic").alias("ft"), F.col("ordinary").alias("fo"), F.col("either").alias("f"))
    found = (known.where(_surely_apart(odds / (1 + odds))).join(followers, "context").join(contexts, "word")
             .select("context", "word", "toxic", "ordinary", "ct", "co", "ft", "fo", "f", "contexts").toArrow())
    if len(found) == 0:
        return model
    context, word = (found[c].to_numpy().view(np.uint64) for c in ("context", "word"))
    shared_word = (found["contexts"].to_numpy() + 1) / (continued + vocabulary + 1)
    lower = np.stack([_word_probabilities(word, shared_word, p, names, other, y) for y in (0, 1)])
    both = found["ct"].to_numpy() + found["co"].to_numpy()
    shared_pair = (found["toxic"].to_numpy() + found["ordinary"].to_numpy() - DISCOUNT + DISCOUNT * found["f"].to_numpy() * shared_word) / both
    q = []
    for y, (c, k, f) in enumerate((("toxic", "ct", "ft"), ("ordinary", "co", "fo"))):
        size = np.maximum(found[k].to_numpy(), 1)
        left = np.where(found[k].to_numpy() > 0, DISCOUNT * found[f].to_numpy() / size, 1.0)  # of a context the class lacks, all
        q.append(np.maximum(found[c].to_numpy() - DISCOUNT, 0) / size + left * shared_pair)
    q = np.stack(q)
    pair_names = mix64(context * np.uint64(0x9E3779B97F4A7C15) ^ word)
    model.contexts = np.unique(context)
    gain = []
    for c in model.contexts:
        here = context == c
        # Pairs set apart never take all of a context: something is left for every other word.
        q[:, here] *= np.minimum(1, 0.99 / np.maximum(q[:, here].sum(axis=1), 0.99))[:, None]
        gain.append(_backed_off(q[0, here], lower[0, here]) - _backed_off(q[1, here], lower[1, here]))
    model.context_gain = np.array(gain)
    order = np.argsort(pair_names)
    model.pairs, model.pair_gain = pair_names[order], (np.log(q[0]) - np.log(q[1]))[order]
    return model


def _word_probabilities(word, shared, p, names, other, y) -> np.ndarray:
    """p_y of each word: its own estimate if it is set apart, else from the shared distribution."""
    order = np.argsort(names)
    at, known = lookup(names[order], word)
    out = np.exp(other[y]) * shared
    out[known] = p[y][order][at[known]]
    return out


def score(text: Column, model: Model) -> Column:
    """Score column (0 to 1, higher: more likely toxic) of a text column."""
    @F.arrow_udf("double")
    def scores(col: pa.Array) -> pa.Array:
        parts = [model.score(model.evidence(buf, offsets)) for _, _, buf, offsets in slices(*text_buffer(col))]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scores(text)
