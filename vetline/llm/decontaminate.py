"""Benchmark decontamination with suffix arrays over the training text.

The training text is cut into shards (slices of an Arrow batch, a few MB of
text). Each shard's words become a sequence of 64-bit hashes and its suffix
array is built by prefix doubling, in which only suffixes that still tie are
sorted again. Every suffix of every benchmark item, cut to a window's length,
is looked up in the array by binary search: the range found lists all places
where the window occurs verbatim. From there matches are extended word by
word to their longest. Shards are independent, so the job is one pass over
the documents without a shuffle, at any size.

A benchmark is compiled on the driver and sent to the tasks, so it is first
measured. One of at most ``BLOCK_BYTES`` of text is sent whole. A larger one
stays a table, cut into blocks by hash: the documents pass one block after the
other, each block's hits are written, and at the end they are put together.

Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lowered.
A window is ``window`` consecutive words of one item; an item of fewer words,
but at least one, is one window as a whole.

Defined cases: null or empty texts have no words and are never contaminated.
Items without words, or null, match nothing. Rows of equal item id count as
one item; a null id is written as the empty string. Ids are compared and
listed as text. With an empty benchmark nothing is hit. Repeated documents
are judged one by one, and other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vetline.llm.frames import durable, fresh
from vetline.llm.words import ALNUM, slices, text_buffer, words_of

WINDOW = 13
#: A document is contaminated if hit words are at least one in this many.
ONE_IN = 20
BLOCK_BYTES = 16 << 20

_LONGS, _TEXTS = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
RESULT = (T.StructType().add("n_words", T.LongType()).add("hit_start", _LONGS).add("hit_words", _LONGS)
          .add("longest", T.LongType()).add("item_ids", _TEXTS))
_ARROW = to_arrow_type(RESULT)


class Windows:
    """The distinct windows of a set of benchmark items, grouped by length."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(ids)}
        hashes, bounds = words_of(*text_buffer(pa.array([t for _, t in items], pa.large_string())), ALNUM)
        self.ids, self.text = np.array(ids, dtype=object), hashes
        self.end = np.repeat(bounds[1:], np.diff(bounds))  # end of the item a word belongs to
        size = np.diff(bounds)
        whole = np.minimum(size, window)
        start = np.concatenate([np.arange(a, b - w + 1) for a, b, w in zip(bounds, bounds[1:], whole) if w] or [np.zeros(0, np.int64)])
        length = np.repeat(whole, np.maximum(size - whole + 1, 0) * (whole > 0))
        owner = np.repeat(np.array([number[i] for i, _ in items], dtype=np.int64), np.maximum(size - whole + 1, 0) * (whole > 0))
        self.by_length = []  # (length, words of each distinct window, a place of it, its owners' list bounds, owners)
        for n in np.unique(length):
            at, who = start[length == n], owner[length == n]
            words = hashes[at[:, None] + np.arange(n)]
            distinct, first, which = np.unique(words, axis=0, return_index=True, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), who], axis=1), axis=0)
            self.by_length.append((int(n), distinct, at[first], np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]))
        self.depth = int(length.max()) if len(length) else 0


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by the ``depth`` codes from there on (codes past the end count as 0).

    Prefix doubling: the first round sorts by two codes, each later one doubles
    the prefix compared and touches only places that share theirs with another.
    """
    n = len(codes)
    places = np.uint64(max(1, n.bit_length()))
    mask = (np.uint64(1) << places) - np.uint64(1)
    after = np.append(codes[1:], codes.dtype.type(0))
    keys = _two(codes, after, places) | np.arange(n, dtype=np.uint64)
    keys.sort()
    order = (keys & mask).astype(np.int64)
    prefix = keys >> places
    rank = np.zeros(n + 1, dtype=np.int64)  # 0: past the end
    heads = np.concatenate(([True], prefix[1:] != prefix[:-1]))
    covered = 2
    while covered < depth:
        first = np.flatnonzero(heads)
        rank[order] = np.repeat(first, np.diff(np.append(first, n))) + 1
        alone = heads & np.append(heads[1:], True)
        tied = np.flatnonzero(~alone)
        if len(tied) == 0:
            break
        at = order[tied]
        later = rank[np.minimum(at + covered, n)]
        moved = np.lexsort((later, rank[at]))
        order[tied] = at[moved]
        later = later[moved]
        apart = np.concatenate(([True], later[1:] != later[:-1]))
        heads[tied] |= apart
        covered *= 2
    return order


def _bits(places: np.uint64) -> np.uint64:
    """Bits of a word's hash that two words and a place leave room for in 64."""
    return (np.uint64(64) - places) // np.uint64(2)


def _two(a: np.ndarray, b: np.ndarray, places: np.uint64) -> np.ndarray:
    width = _bits(places)
    cut = np.uint64(64) - width
    return (((a >> cut) << width) | (b >> cut)) << places


def _below(text: np.ndarray, at: np.ndarray, words: np.ndarray, strictly: bool, width: np.uint64) -> np.ndarray:
    """Whether the suffix at each place sorts below the window (or not above it, if not ``strictly``)."""
    cut = np.uint64(64) - width
    got = text[np.minimum(at[:, None] + np.arange(words.shape[1]), len(text) - 1)]
    a, b = got >> cut, words >> cut
    differ = a != b
    where = differ.argmax(axis=1)
    rows = np.arange(len(at))
    return np.where(differ[rows, where], a[rows, where] < b[rows, where], not strictly)


def _bound(text, order, words, lo, hi, strictly, width):
    """Binary search, all windows at once: first place not below (or first above) each window."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        below = _below(text, order[mid], words[live], strictly, width)
        lo[live] = np.where(below, mid + 1, lo[live])
        hi[live] = np.where(below, hi[live], mid)
        live = live[lo[live] < hi[live]]
    return lo


def search(windows: Windows, text: np.ndarray, order: np.ndarray):
    """Yields ``(length, place of a window in the text, number of the window)`` for all verbatim occurrences, by window length."""
    places = np.uint64(max(1, len(text).bit_length()))
    width = _bits(places)
    two = _two(text[order], text[np.minimum(order + 1, len(text) - 1)], places)
    for k, (n, words, *_) in enumerate(windows.by_length):
        if n == 1:
            one = two >> (places + width)
            key = words[:, 0] >> (np.uint64(64) - width)
            lo, hi = np.searchsorted(one, key, "left"), np.searchsorted(one, key, "right")
        else:
            key = _two(words[:, 0], words[:, 1], places)
            lo, hi = np.searchsorted(two, key, "left"), np.searchsorted(two, key, "right")
        live = np.flatnonzero(lo < hi)
        if n > 2 and len(live):
            lo_, hi_ = lo[live], hi[live]
            a = _bound(text, order, words[live], lo_, hi_, True, width)
            b = _bound(text, order, words[live], a, hi_, False, width)
            live, lo, hi = live[a < b], a[a < b], b[a < b]
        else:
            lo, hi = lo[live], hi[live]
        if len(live) == 0:
            continue
        count = hi - lo
        which = np.repeat(live, count)
        at = order[np.repeat(lo - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())]
        same = np.ones(len(at), dtype=bool)  # the array orders by part of each hash: compare whole ones
        for j in range(n):
            same &= text[np.minimum(at + j, len(text) - 1)] == words[which, j]
        yield k, at[same], which[same]


def _extended(windows: Windows, text: np.ndarray, at: np.ndarray, place: np.ndarray, n: int) -> int:
    """Length of the longest verbatim match that begins with one of these windows."""
    longest = 0 if len(at) == 0 else n
    i, j, end = at + n, place + n, windows.end[place]
    while len(i):
        on = (j < end) & (i < len(text) - 1)
        i, j, end = i[on], j[on], end[on]
        same = text[i] == windows.text[j]
        i, j, end = i[same] + 1, j[same] + 1, end[same]
        longest += bool(len(i))
    return longest


def _judge_slice(buf, offsets, windows: Windows):
    """Per row of one shard: words, hit runs (first word, words), longest match, item numbers."""
    hashes, bounds = words_of(buf, offsets, ALNUM)
    rows = len(offsets) - 1
    # One separator per row keeps matches inside a document; hash 0 is given to no word.
    hashes[hashes == 0] = 1
    shift = np.arange(rows + 1)
    text = np.zeros(len(hashes) + rows + 1, dtype=np.uint64)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    text[np.arange(len(hashes)) + owner] = hashes
    first = bounds + shift
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    found, longest = [], np.zeros(rows, dtype=np.int64)
    if windows.depth and len(hashes):
        order = suffix_array(text, windows.depth)
        for k, at, which in search(windows, text, order):
            n, _, place, lists, owners = windows.by_length[k]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + n, -1)
            doc = np.searchsorted(first, at, side="right") - 1
            pair = np.unique(doc * len(place) + which)
            d, w = np.divmod(pair, len(place))
            count = lists[w + 1] - lists[w]
            found.append(np.stack([np.repeat(d, count), owners[np.repeat(lists[w] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())]]))
            by_doc = np.argsort(doc, kind="stable")
            cuts = np.flatnonzero(np.diff(doc[by_doc])) + 1
            for part in np.split(by_doc, cuts):
                if len(part):
                    longest[doc[part[0]]] = max(longest[doc[part[0]]], _extended(windows, text, at[part], place[which[part]], n))
    hit = np.cumsum(edge[:-1]) > 0
    change = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    run_at, run_end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    items = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    run_doc = np.searchsorted(first, run_at, side="right") - 1
    return np.diff(bounds), run_doc, run_at - first[run_doc], run_end - run_at, longest, items


def _matcher(windows: Windows):
    @F.arrow_udf(RESULT)
    def judge(text: pa.Array) -> pa.Array:
        n_words, starts, lengths, longest, ids = [], [], [], [], []
        run_counts, item_counts = [], []
        for _, _, buf, offsets in slices(*text_buffer(text)):
            size, doc, at, length, most, items = _judge_slice(buf, offsets, windows)
            n_words.append(size), starts.append(at), lengths.append(length), longest.append(most)
            run_counts.append(np.bincount(doc, minlength=len(size)))
            item_counts.append(np.bincount(items[0], minlength=len(size)))
            ids.extend(windows.ids[items[1]])

        def lists(values, counts):
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.concatenate(counts))), pa.int32()), values)

        if not n_words:
            return pa.array([], _ARROW)
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(n_words), pa.int64()), lists(pa.array(np.concatenate(starts), pa.int64()), run_counts),
             lists(pa.array(np.concatenate(lengths), pa.int64()), run_counts), pa.array(np.concatenate(longest), pa.int64()),
             lists(pa.array(ids, pa.string()), item_counts)], fields=list(_ARROW))

    return judge


@F.arrow_udf(RESULT)
def _together(blocks: pa.Array) -> pa.Array:
    """One result from a document's results against several benchmark blocks."""
    out = []
    for many in blocks.to_pylist():
        starts, lengths = [], []
        for a, n in sorted(x for one in many for x in zip(one["hit_start"], one["hit_words"])):
            if starts and a <= starts[-1] + lengths[-1]:
                lengths[-1] = max(lengths[-1], a + n - starts[-1])
            else:
                starts.append(a), lengths.append(n)
        out.append({"n_words": many[0]["n_words"], "hit_start": starts, "hit_words": lengths,
                    "longest": max(x["longest"] for x in many),
                    "item_ids": sorted({i for x in many for i in x["item_ids"]})})
    return pa.array(out, _ARROW)


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def judge(docs: DataFrame, benchmark: DataFrame, into: str, window: int = WINDOW, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``into``.

    Its fields: n_words; hit_start and hit_words, the runs of hit words (first
    word, number of words); longest, the words of the longest verbatim match of
    a window or more; item_ids, the items with a window in the document.
    """
    items = _items(benchmark, item_col, item_text_col)
    size = int(items.agg(F.sum(F.octet_length("text") + F.octet_length("id"))).head()[0] or 0)
    if size > block_bytes:
        return _judge_by_block(docs, items, into, window, text_col, -(-2 * size // block_bytes))
    return docs.withColumn(into, _matcher(Windows([tuple(r) for r in items.collect()], window))(F.col(text_col)))


def _judge_by_block(docs: DataFrame, items: DataFrame, into: str, window: int, text_col: str, n: int) -> DataFrame:
    """``judge`` for a benchmark that is too large to be sent whole: a pass over the documents for each of ``n`` blocks of items.

    Blocks are dealt by hash and half full on average; one at a time is on the
    driver and in the tasks. Their hits are written, a row for each document
    that a block hits, and put together at the end.
    """
    row = fresh(docs, "judged_row")
    held = durable(docs.withColumn(row, F.monotonically_increasing_id()), "judged-docs")
    items = durable(items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n))), "judged-items")
    hits = None
    for k in range(n):
        block = [tuple(r) for r in items.where(F.col("block") == k).select("id", "text").collect()]
        if block:
            found = held.select(F.col(row).alias("row"), _matcher(Windows(block, window))(F.col(text_col)).alias("one"))
            found = durable(found.where(F.size("one.item_ids") > 0), "judged-block")
            hits = found if hits is None else hits.unionAll(found)
    together = hits.groupBy("row").agg(F.collect_list("one").alias("many"))  # one of each block at most
    joined = held.join(together.withColumnRenamed("row", row).withColumnRenamed("many", many := fresh(docs, "judged_many")), row, "left")
    clean = _matcher(Windows([], window))(F.col(text_col))
    return joined.withColumn(into, _together(F.coalesce(many, F.array(clean)))).select(*docs.columns, into)


def hit_words(result: str):
    return F.aggregate(F.col(result)["hit_words"], F.lit(0).cast("bigint"), lambda total, n: total + n)


def contaminated(result: str, one_in: int = ONE_IN):
    n = hit_words(result)
    return (n > 0) & (one_in * n >= F.col(result)["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    result = fresh(docs, "benchmark_hits")
    return judge(docs, benchmark, result, **options).where(~contaminated(result)).select(*docs.columns)

