"""Cross-tokenizer alignment: which tokens of two tokenizers end at the same byte.

Every text is encoded by a byte-level BPE (A, with a space in front) and by a
sentence-piece model (B, which adds that space itself). The cumulative byte
ends of either token list become a dictionary from end to index; the
intersection of the two key sets, sorted, slices both id lists into groups, and
every slice is expanded into its links: the pairs of an A and a B token that
end together.

Shape of the job: encoding and slicing are one map over the documents, which
writes each text's links (four bytes each) to the shared folder, so no text is
encoded twice. Pair counts are summed in the tasks before they are shuffled.
The ``HEAD`` most frequent pairs are then sent to the tasks, which look up all
their links among them; links of rarer pairs are joined. No pair and no
document gathers more than its own row anywhere.

Texts are cut before a space that stands between two characters that are not
white space. Neither tokenizer has a token across such a place (checked when
they are read; otherwise whole texts are encoded), so equal parts, mostly
single words, are encoded and sliced once and remembered. The parts of a text
join to what encoding it whole gives.

Defined cases: a text that is null, empty, no valid UTF-8, or whose tokens of
either side do not join to a space and the text (the sentence-piece model
replaces U+2581, for one) has no tokens: zeros and an empty digest. Repeated
rows count once each. An empty table gives an empty result. Other columns of
the documents are ignored, whatever their names.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vetline.llm.frames import durable
from vetline.llm.words import lookup, sorted_counts

#: Pairs whose counts are sent to every task (12 bytes each); links of all others are joined.
HEAD = 1 << 18
#: Parts of texts that a process remembers in each of two generations, and the longest of them.
CACHED, LONGEST = 75_000, 100
#: Bytes of texts (one text at least) that are taken apart at a time, and how many of their new parts are encoded as one text.
SLICE, JOINED = 1 << 18, 256
#: Distinct pairs that a task holds before it passes their counts on.
HELD = 1 << 20

_CUT = re.compile(r"(?<=\S) (?=\S)")
_DOUBLE = re.compile(r"\s\s")

Part = tuple[int, int, int, str, bytes]


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stands for itself, the others follow from U+0100."""
    shown = [b for lo, hi in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(lo), ord(hi) + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Two tokenizers and the bytes of their tokens; ``part`` aligns a text, remembering short parts."""

    def __init__(self, byte_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.a = Tokenizer.from_str(byte_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters, spec = byte_letters(), json.loads(byte_json)
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        steps = [spec.get("normalizer"), spec.get("pre_tokenizer") or {}]
        by_rule = steps[0] is None and steps[1].get("type") == "ByteLevel" and steps[1].get("use_regex", True) and not steps[1].get("add_prefix_space")
        self.cuts = by_rule and not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a, self.size_b = [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        self.said = [str(i) for i in range(max(len(pieces), len(self.bytes_a)))]
        self.known: dict[str, Part | None] = {}
        self.before: dict[str, Part | None] = {}

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """The ids of a space and the text by A, and of the text by B, which adds the space."""
        return self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)

    def sliced(self, text: str, ids_a: list[int], ids_b: list[int]) -> tuple | None:
        """The groups of a text: each one's end in bytes, its ends in either list, its ids written out, and its link; None if the bytes differ.

        No token is empty, so a slice's last tokens are its only pair that ends together.
        """
        data = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != data or b"".join(map(self.bytes_b.__getitem__, ids_b)) != data:
            return None
        at_a = dict(zip(accumulate(map(self.size_a.__getitem__, ids_a)), range(1, len(ids_a) + 1)))
        at_b = dict(zip(accumulate(map(self.size_b.__getitem__, ids_b)), range(1, len(ids_b) + 1)))
        common = sorted(at_a.keys() & at_b.keys())
        cut_a, cut_b = list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))
        said_a, said_b = list(map(self.said.__getitem__, ids_a)), list(map(self.said.__getitem__, ids_b))
        said, i, j = [], 0, 0
        for i2, j2 in zip(cut_a, cut_b):
            said.append(f"{said_a[i] if i2 - i == 1 else ','.join(said_a[i:i2])}|{said_b[j] if j2 - j == 1 else ','.join(said_b[j:j2])}")
            i, j = i2, j2
        links = np.array(ids_a, np.uint32)[np.array(cut_a) - 1] << 16 | np.array(ids_b, np.uint32)[np.array(cut_b) - 1]
        return common, cut_a, cut_b, said, links.tobytes()

    def whole(self, text: str) -> Part | None:
        """A text encoded and sliced by itself: numbers of tokens and groups, the groups written out, and the links."""
        got = self.sliced(text, *self.ids(text))
        return got and (got[1][-1], got[2][-1], len(got[0]), ";".join(got[3]), got[4])

    def joined(self, words: list[str]) -> list[Part | None]:
        """As ``whole`` of each word, for words that neither begin nor end with white space: they are encoded as one text and taken apart."""
        text = " ".join(words)
        got = self.sliced(text, *self.ids(text))
        if got is None:
            return [self.whole(w) for w in words]
        common, cut_a, cut_b, said, links = got
        number = dict(zip(common, range(1, len(common) + 1)))
        last = [number[end] for end in accumulate([len(w.encode()) + 1 for w in words])]
        cut_a, cut_b = [0, *cut_a], [0, *cut_b]
        return [(cut_a[h] - cut_a[g], cut_b[h] - cut_b[g], h - g, ";".join(said[g:h]), links[4 * g:4 * h]) for g, h in pairwise([0, *last])]

    def cut(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        # Without two white space characters together, or one at either end, every space is a place to cut at.
        return _CUT.split(text) if _DOUBLE.search(text) or text.strip() != text else text.split(" ")

    def parts(self, texts: list[str]) -> list[list[Part | None]]:
        """The aligned parts of each text, in order."""
        cut = [self.cut(t) for t in texts]
        known, before = self.known, self.before
        new = []
        for w in {w for words in cut for w in words if w not in known}:
            if w in before:
                known[w] = before[w]
            else:
                new.append(w)
        plain = [w for w in new if w and not w[0].isspace() and not w[-1].isspace()] if self.cuts else []
        for k in range(0, len(plain), JOINED):
            known.update(zip(plain[k:k + JOINED], self.joined(plain[k:k + JOINED])))
        for w in set(new).difference(plain):
            known[w] = self.whole(w)
        got = [[known[w] for w in words] for words in cut]
        for w in new:
            if len(w) > LONGEST:
                del known[w]
        if len(known) > CACHED:  # what is not met again in the time of as many other parts is forgotten
            self.known, self.before = {}, known
        return got


_made: dict[bytes, Aligner] = {}


def aligner(byte_json: str, piece_model: bytes) -> Aligner:
    """One per pair of vocabularies and process."""
    key = hashlib.sha256(byte_json.encode() + piece_model).digest()
    if key not in _made:
        _made[key] = Aligner(byte_json, piece_model)
    return _made[key]


def align(docs: DataFrame, byte_json: str, piece_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, groups_sha256, links`` of every row of ``docs``.

    ``links`` holds one unsigned 32-bit number a link, the A id in its upper half.
    The tokenizers are given by the contents of their files.
    """
    kind = pa.schema([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                      ("groups_sha256", pa.string()), ("links", pa.binary())])

    def one(row_id: int | None, text: str | None, got: list[Part | None]) -> tuple:
        if not text or None in got:
            return row_id, 0, 0, 0, 0, "", b""
        n_a, n_b, n_groups, said, held = zip(*got)
        links = b"".join(held)
        return row_id, sum(n_a), sum(n_b), sum(n_groups), len(links) // 4, hashlib.sha256(";".join(said).encode()).hexdigest(), links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_json, piece_model)
        gc.disable()  # no cycles arise here, and the collector would walk all remembered parts again and again
        try:
            yield from aligned_batches(both, batches)
        finally:
            gc.enable()

    def aligned_batches(both: Aligner, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            read = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            for k, k2 in pairwise([0, *(np.flatnonzero(np.diff(read // SLICE)) + 1).tolist(), len(batch)]):
                part = batch.slice(k, k2 - k)
                texts = part.column("text").to_pylist()
                rows = [one(*x) for x in zip(part.column("id").to_pylist(), texts, both.parts([t or "" for t in texts]))]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), kind)], schema=kind)

    valid = F.when(F.is_valid_utf8(F.col(text_col)), F.col(text_col))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), valid.alias("text")).mapInArrow(
        run, "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary")


def _links(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All links of a column and the ``n + 1`` bounds of its rows."""
    sizes = [x.as_buffer().size // 4 if x.is_valid else 0 for x in col]
    return (np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in col if x.is_valid] or [np.zeros(0, np.uint32)]),
            np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n``: how many links of the whole corpus hold each pair of ids; ``top``: that it is its B id's highest count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(counts)], names=["pair", "n"])
        for batch in batches:
            new, n = sorted_counts(_links(batch.column("links"))[0])
            pairs, counts = sorted_counts(np.concatenate([pairs, new]), np.concatenate([counts, n]))
            if len(pairs) > HELD:
                yield out()
                pairs, counts = pairs[:0], counts[:0]
        yield out()

    summed = durable(aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair").bitwiseAND(0xFFFF)
    best = summed.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    return durable(summed.withColumn("b", b_id).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("top")), "pairs")


def with_counts(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` in place of its links. ``counts`` as of ``pair_counts``."""
    # At most ``head`` rows, whatever the corpus.
    sent = counts.orderBy(F.desc("n"), "pair").limit(head).toPandas().sort_values("pair") if head else None
    known = sent["pair"].to_numpy(np.uint32) if head else np.zeros(0, np.uint32)
    number = sent["n"].to_numpy(np.int64) if head else np.zeros(0, np.int64)
    top = sent["top"].to_numpy(bool).astype(np.int64) if head else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links, bounds = _links(batch.column("links"))
            at, found = lookup(known, links)
            per = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[bounds])
            best = per(np.where(found, top[at], 0)) if len(known) else np.zeros(len(batch), np.int64)
            total = per(np.where(found, number[at], 0)) if len(known) else np.zeros(len(batch), np.int64)
            rest = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(~found)))[bounds], pa.int32()),
                                            pa.array(links[~found].astype(np.int64)))
            keep = [batch.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(best), pa.array(total), rest], names=names)

    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rest"]
    part = durable(aligned.mapInArrow(run, "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                           "n_best long, count_sum long, rest array<long>").withColumn("row", F.monotonically_increasing_id()), "aligned")
    rare = part.where(F.size("rest") > 0).select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
    more = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return part.join(more, "row", "left").select(*names[:6], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                                                 (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def aligned(docs: DataFrame, byte_json: str, piece_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` aligned, with the corpus-wide counts of its links."""
    rows = durable(align(docs, byte_json, piece_model, id_col, text_col), "links")
    return with_counts(rows, pair_counts(rows))
