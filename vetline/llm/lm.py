"""Language-model scores: a gated recurrent model over corpus counts.

Tokens are words between ASCII white space, A-Z lowered, and one end per text.

1. Every training text is counted: the corpus counts of all words, by a
   partial aggregation and one shuffle.
2. The most frequent words, as many as make up ``SHARE`` of the training
   tokens and occur twice or more, are the recurrent model's vocabulary, which
   so grows with the corpus; all other words share one entry, from which a word is drawn in proportion to its
   count plus one. So the model gives every text a probability, unseen words
   included.
3. The model (``gru``) starts from a few training texts in one task, drawn by
   all tasks together by a hash of id and text, then every task learns from all the training texts of its partition, and the results
   are averaged by the words each has learnt from.
4. Every text is scored whole, in one pass over the documents. Counts of the
   ``HEAD`` most frequent words, or of the vocabulary where it is larger, go to the tasks; the
   rest are looked up by joining each text's remaining words with the counts.

Words are known by 64-bit hashes. Defined cases: a null or empty text is one
end token. A null id is not held out. With no training text at all, counts are
zero and every token is as likely as any other. Repeated rows are scored row by
row; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm.frames import durable
from vetline.llm.gru import Gru, log_likelihoods, train
from vetline.llm.words import NONSPACE, slices, sorted_counts, text_buffer, words_of

#: Hash that stands for the end of a text.
END = 1
#: Share of the training tokens whose words the recurrent model knows by themselves, if they occur so often.
SHARE, LEAST = 0.8, 2
HIDDEN = 16
CLASSES = 32
#: Words whose counts are sent to every task, or all of the vocabulary.
HEAD = 1 << 18
#: Training texts, at most, that the first model is learnt from, and passes over them.
FIRST_TEXTS, FIRST_PASSES = 1_000, 4
FIRST_RATE, RATE = 0.01, 0.003
#: Words held at a time while learning and scoring.
GROUP_WORDS = 1_000_000
#: Rows of parameters passed at a time.
BATCH_ROWS = 10_000


@dataclass
class Corpus:
    """Counts of the training texts: all words (durable table hash, c), the head of them, and the totals."""

    counts: DataFrame
    total: int
    distinct: int
    texts: int
    head: np.ndarray
    head_count: np.ndarray
    least: int  # count from which a word belongs to the head
    modelled: int = 0  # words of the recurrent model


def _count(batches):
    for batch in batches:
        for a, b, buf, offsets in slices(*text_buffer(batch.column(0))):
            hashes, n = sorted_counts(words_of(buf, offsets, NONSPACE)[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.append(hashes, np.uint64(END)).view(np.int64)), pa.array(np.append(n, b - a))],
                                             ["hash", "n"])


def count(texts: DataFrame, head: int = HEAD) -> Corpus:
    """Counts over all rows of ``texts`` (one text column)."""
    counts = durable(texts.mapInArrow(_count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("c")), "lm-counts")
    ends = counts.where(F.col("hash") == END).select("c").first()
    # The head's least count comes from a histogram of 16 steps to the doubling.
    steps = (counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count("*").alias("words"), F.sum("c").alias("c"), F.min("c").alias("least"))
             .orderBy(F.desc("step")).collect())  # a few hundred rows
    least, taken = 1 << 62, 0
    for row in steps:
        if taken + row.words > head:
            break
        least, taken = row.least, taken + row.words
    modelled, covered, total = 0, 0, sum(r.c for r in steps)
    for row in steps:
        if covered >= SHARE * total or row.least < LEAST:
            break
        least, modelled, covered = min(least, row.least), modelled + row.words, covered + row.c
    top = counts.where(F.col("c") >= least).toArrow()  # the head or the vocabulary
    names = top["hash"].to_numpy().view(np.uint64)
    order = np.argsort(names)
    return Corpus(counts, total, sum(r.words for r in steps), ends.c if ends else 0,
                  names[order], top["c"].to_numpy()[order], least, modelled)


class Names:
    """Finds hashes in a sorted table; their upper bits tell where about they stand."""

    def __init__(self, names: np.ndarray):
        bits = (2 * len(names)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.begun = np.searchsorted(names >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32) if bits else np.zeros(1, np.int32)
        self.names, self.size = np.append(names, np.uint64(2 ** 64 - 1)), len(names)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the table, its length where there is none, and whether each hash is there."""
        if self.size == 0:
            return np.zeros(len(hashes), np.int32), np.zeros(len(hashes), bool)
        at = self.begun.take((hashes >> self.shift).view(np.int64))
        found = self.names.take(at)
        late = np.flatnonzero(found < hashes)
        while len(late):
            at[late] += 1
            found[late] = self.names.take(at[late])
            late = late[found[late] < hashes[late]]
        known = (found == hashes) & (at < self.size)
        at[~known] = self.size
        return at, known


class Vocabulary:
    """The recurrent model's words, numbered by falling count; ``end`` and ``other`` are among them."""

    def __init__(self, corpus: Corpus, size: int | None = None):
        words = corpus.head != END
        names, counts = corpus.head[words], corpus.head_count[words]
        top = np.lexsort((names, -counts))[:corpus.modelled if size is None else size]
        names, counts = names[top], counts[top]
        rest = max(0, corpus.total - corpus.texts - int(counts.sum()))
        everything = np.concatenate([counts, [corpus.texts, rest]])
        order = np.argsort(-everything, kind="stable")
        self.counts = everything[order]
        number = np.argsort(order)
        self.end, self.other = int(number[-2]), int(number[-1])
        by_name = np.argsort(names)
        self.names, self.numbers = names[by_name], number[:-2][by_name]
        self._found, self._numbers = Names(self.names), np.append(self.numbers, self.other)
        #: Sum of (count + 1) over all words that are not in the vocabulary, one unseen word included.
        self.rest_mass = corpus.total + corpus.distinct + 1 - int((counts + 1).sum()) - (corpus.texts + bool(corpus.texts))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        return self._numbers.take(self._found.find(hashes)[0])


def _groups(batches):
    """Word hashes and text bounds of about GROUP_WORDS words at a time, and each group's batch rows."""
    for batch in batches:
        held, bounds, first = [], [0], 0
        for a, b, buf, offsets in slices(*text_buffer(batch.column("text"))):
            hashes, edges = words_of(buf, offsets, NONSPACE)
            held.append(hashes)
            bounds.extend((edges[1:] + bounds[-1]).tolist())
            if bounds[-1] >= GROUP_WORDS:
                yield batch.slice(first, b - first), np.concatenate(held), np.array(bounds)
                held, bounds, first = [], [0], b
        if len(bounds) > 1:
            yield batch.slice(first), np.concatenate(held), np.array(bounds)


def _model(vocabulary: Vocabulary) -> Gru:
    """An untaught model; classes follow the square root of the words."""
    return Gru(vocabulary.counts, HIDDEN, max(CLASSES, round(len(vocabulary.counts) ** 0.5 / 4)))


def _learner(vocabulary: Vocabulary, start: np.ndarray | None, passes: int, rate: float):
    """Learns from all texts of a partition; gives the rows of parameters it touched, weighted by the words learnt from."""
    def learn(batches):
        model = _model(vocabulary)
        if start is not None:
            model.load(start)
        seen = 0
        for _, hashes, bounds in _groups(batches):
            numbers = vocabulary.number(hashes)
            texts = [numbers[a:b] for a, b in zip(bounds, bounds[1:])]
            for _ in range(passes):
                words = train(model, texts, vocabulary.end, rate)
            seen += words
        if seen:
            rows = model.rows()
            k = np.append(np.flatnonzero(model.touched), np.arange(len(model.touched), len(rows)))
            for a in range(0, len(k), BATCH_ROWS):
                part = k[a:a + BATCH_ROWS]
                yield _rows(part, rows[part] * np.float32(seen), np.full(len(part), seen, np.int64))

    return learn


def _rows(k: np.ndarray, v: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    edges = pa.array(np.arange(len(k) + 1) * v.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.ListArray.from_arrays(edges, pa.array(v.ravel(), pa.float32())), pa.array(w)],
                                      ["k", "v", "w"])


def _matrix(v: pa.Array, n: int) -> np.ndarray:
    return v.flatten().to_numpy().reshape(n, -1)


def _summed(batches):
    """Sums of the rows of each number in a partition."""
    k, v, w = np.zeros(0, np.int32), None, np.zeros(0, np.int64)
    for batch in batches:
        if len(batch) == 0:
            continue
        here = _matrix(batch.column("v"), len(batch)).astype(np.float64)
        k, v = np.append(k, batch.column("k").to_numpy()), here if v is None else np.concatenate([v, here])
        w = np.append(w, batch.column("w").to_numpy())
        order = np.argsort(k, kind="stable")
        k = k[order]
        heads = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        k, v, w = k[heads], np.add.reduceat(v[order], heads, axis=0), np.add.reduceat(w[order], heads)
    for a in range(0, len(k), BATCH_ROWS):
        b = a + BATCH_ROWS
        yield _rows(k[a:b], (v[a:b] / w[a:b, None]).astype(np.float32), w[a:b])


def _averaged(texts: DataFrame, vocabulary: Vocabulary, start: np.ndarray | None, passes: int, rate: float) -> np.ndarray | None:
    """Parameters averaged over the partitions' learners that touched them; as at the start where none did."""
    schema = "k int, v array<float>, w long"
    got = texts.mapInArrow(_learner(vocabulary, start, passes, rate), schema).repartition("k").mapInArrow(_summed, schema).select("k", "v").toArrow()
    if len(got) == 0:  # as many rows as words and a few at most
        return start
    rows = (_model(vocabulary).rows() if start is None else start).copy()
    for batch in got.to_batches():
        rows[batch.column("k").to_numpy()] = _matrix(batch.column("v"), len(batch))
    return rows


def first_texts(texts: DataFrame, among: int, n: int = FIRST_TEXTS) -> DataFrame:
    """The ``n`` rows of ``texts`` (columns id and text, ``among`` rows) with the least hashes of both, in one partition.

    All tasks read and hash; only about 4n rows, and at most n a task, pass to the one that orders them.
    """
    drawn = texts.withColumn("draw", F.shiftrightunsigned(F.xxhash64("id", "text", F.lit("first")), 11))
    likely = drawn if among <= 4 * n else drawn.where(F.col("draw") < int(2 ** 53 * (4 * n / among)))
    return likely.orderBy("draw").limit(n).select("text")


def learn(texts: DataFrame, corpus: Corpus, vocabulary: Vocabulary) -> np.ndarray | None:
    """Parameters of the recurrent model learnt from all rows of ``texts`` (columns id and text)."""
    if not corpus.texts:
        return None
    start = _averaged(first_texts(texts, corpus.texts), vocabulary, None, FIRST_PASSES, FIRST_RATE)
    return _averaged(texts.select("text"), vocabulary, start, 1, RATE)


def _scorer(vocabulary: Vocabulary, corpus: Corpus, parameters: np.ndarray | None):
    # Of the words of the head, and last of one that is not in it: logarithm of the count and number, as the vocabulary is part of the head.
    head, total = Names(corpus.head), corpus.total + corpus.distinct + 1
    head_log, head_number = np.append(np.log10(corpus.head_count + 1.0), 0.0), np.append(vocabulary.number(corpus.head), vocabulary.other).astype(np.int32)
    end_log, end_known = np.log10(corpus.texts + 1.0), int(corpus.texts > 0)

    def score(batches):
        model = _model(vocabulary)
        if parameters is not None:
            model.load(parameters)
        for rows, hashes, bounds in _groups(batches):
            n = len(bounds) - 1
            text = np.repeat(np.arange(n), np.diff(bounds))
            at, known = head.find(hashes)
            numbers, logs = head_number.take(at), head_log.take(at)
            other = numbers == vocabulary.other
            if parameters is None:
                modelled = np.full(n, np.nan)
            else:
                modelled = log_likelihoods(model, numbers, bounds, vocabulary.end) / np.log(10)
                modelled += np.bincount(text, weights=other * (logs - np.log10(max(vocabulary.rest_mass, 1))), minlength=n)
            base = np.bincount(text, weights=logs, minlength=n) + end_log - (np.diff(bounds) + 1) * np.log10(total)
            rare = np.flatnonzero(~known)  # to be looked up in the whole counts
            order = rare[np.lexsort((hashes[rare], text[rare]))]
            t, h = text[order], hashes[order]
            heads = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])))) if len(order) else order
            times = np.diff(np.append(heads, len(order)))
            edges = pa.array(np.searchsorted(t[heads], np.arange(n + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("id"), pa.array(np.diff(bounds) + 1),
                 pa.array(np.bincount(text, weights=known, minlength=n).astype(np.int64) + end_known), pa.array(base), pa.array(modelled),
                 pa.ListArray.from_arrays(edges, pa.array(h[heads].view(np.int64))),
                 pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int32)))],
                ["row", "id", "n_tokens", "n_known", "base", "modelled", "rare", "times"])

    return score


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Corpus]:
    """Scores of all documents by a model learnt from those where ``training`` holds (or is null).

    Columns: id, n_tokens, n_known, base_score, score; logarithms to base 10.
    """
    texts = docs.where(F.coalesce(training, F.lit(True))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    corpus = count(texts.select("text"))
    vocabulary = Vocabulary(corpus)
    parameters = learn(texts, corpus, vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    part = durable(numbered.mapInArrow(
        _scorer(vocabulary, corpus, parameters),
        f"row long, id {id_type}, n_tokens long, n_known long, base double, modelled double, rare array<long>, times array<int>"), "lm-scored")
    pairs = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("hash"), F.col("x.times").alias("times"))
    found = pairs.join(corpus.counts.where(F.col("c") < corpus.least).hint("merge"), "hash")
    rare = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum("times").alias("known"))
    logs, known = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    base = F.col("base") + logs
    modelled = F.when(F.isnan("modelled"), base).otherwise(F.col("modelled") + logs)
    scored = part.drop("rare", "times").join(rare.hint("merge"), "row", "left")
    return scored.select("id", "n_tokens", (F.col("n_known") + known).alias("n_known"), base.alias("base_score"), modelled.alias("score")), corpus
