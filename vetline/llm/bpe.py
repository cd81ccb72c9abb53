"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

Encoding. The vocabulary is read as an automaton in which a token may begin
at any byte. Its determinised states, one for each set of token beginnings
that the input may be inside of, are made when first met and shared by all
pieces; there are at most as many as tokens have beginnings. The output of a
state is the tokens that end there. The merges are compiled into a relation
of tokens that may stand side by side (``adjacent``), also lazily. For every
prefix of a piece exactly one of the tokens ending there fits the last token
of what precedes it: it is the last token of the prefix's encoding. Going back
from token to token spells the encoding out. A token is settled, and emitted,
once every position from which a token can still reach past the input leads
back through it; the lookahead this takes is bounded by the longest tokens,
and long pieces take linear time and bounded memory.

Decoding is a stream: ``StreamDecoder`` turns tokens that arrive in portions
into text with a UTF-8 state machine that holds back at most three bytes of an
unfinished character. (Slices of encoded texts are also checked, token bytes
against input, before they are handed on.)

Texts are cut into pieces by the tokenizer's pattern, each piece is encoded
separately, and special tokens are ordinary text. Pieces met are remembered
whole.

Defined cases: a null or empty text has no tokens and decodes to the empty
string. Any Unicode text decodes to its own bytes. Repeated rows and other
columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vetline.llm.frames import fresh
from vetline.llm.words import hash_bytes, lookup, slices, text_buffer

MOST_PIECES = 2_000_000
MOST_PAIRS = 500_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order from a rank file (base64 bytes and rank on each line)."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_classes: list[np.ndarray] = []


def _char_classes() -> np.ndarray:
    """Class of every code point, as the pattern's library sees it."""
    if not _classes:
        table = np.full(0x110000, _OTHER, np.uint8)
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4")
        every = points.tobytes().decode("utf-32-le")
        for klass, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for run in regex.finditer(pattern, every):
                table[points[run.start():run.end()]] = klass
        _classes.append(table)
    return _classes[0]


#: The pattern that ``piece_starts`` implements.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def piece_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First byte of every piece that the pattern ``CUT`` cuts a slice of texts into.

    Pieces are runs of letters, of numbers or of other marks, each with the one
    space before it; a run of white space without that space; and after an
    apostrophe the endings of English contractions.
    """
    if len(buf) == 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    chars = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = _char_classes()[chars]
    n = len(chars)
    head = np.zeros(n + 1, bool)  # a text begins
    head[np.searchsorted(at, offsets)] = True
    run = head.copy()
    run[n] = True
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()
    # White space: the last character before other text stands apart; if it is a plain space it joins that text.
    before = np.flatnonzero((kind[:-1] == _SPACE) & run[1:n] & ~head[1:n])
    start[before] = True
    start[before[chars[before] == 32] + 1] = False
    # Contractions: an apostrophe on its own, with no space before it, then a fixed ending.
    quote = np.flatnonzero((chars[:-1] == 39) & start[:n - 1] & (kind[1:] == _LETTER) & ~head[1:n])
    if len(quote):
        one = chars[quote + 1]
        two = np.where((quote + 2 < n) & ~head[np.minimum(quote + 2, n)], chars[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        cut = quote[short | long]
        start[cut + 1] = False
        start[cut + np.where(long[short | long], 3, 2)] = True
    return at[np.flatnonzero(start[:n])]


class _State:
    __slots__ = ("begun", "ends", "next")

    def __init__(self, begun: bytes, ends: list[tuple[int, int]]):
        self.begun = begun  # the longest token beginning that the input ends with
        self.ends = ends    # (length, token) of every token the input ends with, longest first
        self.next: dict[int, _State] = {}


class Transducer:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        self.starts = {t[:n] for t in tokens for n in range(len(t))}  # proper beginnings of tokens
        self.pairs: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, bool], list[tuple[bytes, int]]] = {}
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = [len(t) for t in tokens]
        self.size = np.array(self.lengths, np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.longest = max(self.lengths)
        self.states: dict[bytes, _State] = {}
        self.start = self._state(b"")
        self._forget()

    def _forget(self) -> None:
        """Drop the remembered pieces (sorted names; place and number of each one's ids)."""
        self.names, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.place, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _state(self, begun: bytes) -> _State:
        while begun not in self.starts and begun not in self.rank:
            begun = begun[1:]
        state = self.states.get(begun)
        if state is None:
            ends = [(len(begun) - p, self.rank[begun[p:]]) for p in range(len(begun)) if begun[p:] in self.rank]
            state = self.states[begun] = _State(begun, ends)
        return state

    def _step(self, state: _State, byte: int) -> _State:
        made = state.next[byte] = self._state(state.begun + bytes((byte,)))
        return made

    def merged(self, data: bytes, most: int = 1) -> list[int]:
        """Tokens of a short byte string by applying its merges, lowest rank first and leftmost, while over ``most`` are left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.rank.get
        while len(parts) > most:
            joins = [rank(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
            low = min(joins)
            if low == 1 << 60:
                break
            i = joins.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """What stands at one end of a token while it is being merged, each with the rank that absorbs it.

        The token itself comes first and is absorbed by nothing. A token the
        merges don't form has no spine.
        """
        known = self.spines.get((token, right))
        if known is None:
            part, absorbed, known = self.tokens[token], len(self.tokens), []
            while True:
                known.append((part, absorbed))
                if len(part) == 1:
                    break
                halves = self.merged(part, 2)
                if len(halves) != 2 or self.merged(part) != [self.rank[part]]:
                    known = []
                    break
                absorbed = self.rank[part]
                part = self.tokens[halves[1 if right else 0]]
            self.spines[token, right] = known
        return known

    def adjacent(self, a: int, b: int) -> bool:
        """Whether the merges leave ``b`` standing after ``a`` (-1: at the start).

        They do unless two parts facing each other across the boundary merge
        before either is absorbed on its own side. Of equal merges the left one
        comes first: a part of ``a`` is absorbed before, one of ``b`` after.
        """
        known = self.pairs.get((a, b))
        if known is None:
            left = self.spines.get((a, True)) or self._spine(a, True) if a >= 0 else [(b"", -1)]
            right = self.spines.get((b, False)) or self._spine(b, False)
            known = bool(left and right)
            if a >= 0 and known:
                rank = self.rank.get
                for x, gone_x in left:
                    for y, gone_y in right:
                        joined = rank(x + y)
                        if joined is not None and joined < gone_x and joined <= gone_y:
                            known = False
                            break
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def run(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens of one piece, given as bytes in any iterable; each is emitted once it is settled."""
        pairs, state = self.pairs, self.start
        last = [-1]  # per position since the last token emitted: the token that ends there
        for byte in data:
            state = state.next.get(byte) or self._step(state, byte)
            n = len(last)
            for length, token in state.ends:
                if length <= n:
                    before = last[n - length]
                    if before is not None:
                        fits = pairs.get((before, token))
                        if fits if fits is not None else self.adjacent(before, token):
                            last.append(token)
                            break
            else:
                last.append(None)  # every path here leads back past what is settled
            if n > 2 * self.longest:
                settled, last = self._settle(last, state)
                yield from settled
        yield from self._path(last, len(last) - 1)

    def _settle(self, last: list, state: _State) -> tuple[list[int], list]:
        """The tokens on the one path that all open positions lead back through, and what remains."""
        n, begun, size = len(last) - 1, state.begun, self.lengths
        still_open = {n - k for k in range(1, min(len(begun), n) + 1) if begun[-k:] in self.starts and last[n - k] is not None}
        still_open.add(n)
        while len(still_open) > 1:  # climb from the deepest
            deepest = max(still_open)
            still_open.discard(deepest)
            still_open.add(deepest - size[last[deepest]])
        end = still_open.pop()
        if end == 0:
            return [], last
        kept, live = [last[end]], {end}
        for p in range(end + 1, n + 1):
            goes_on = last[p] is not None and p - size[last[p]] in live
            if goes_on:
                live.add(p)
            kept.append(last[p] if goes_on else None)
        return self._path(last, end), kept

    def _path(self, last: list, p: int) -> list[int]:
        """Tokens between the last one emitted and position ``p``."""
        path, size = [], self.lengths
        while p > 0:
            path.append(last[p])
            p -= size[last[p]]
        path.reverse()
        return path

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one piece: itself if it is a token, else what the transducer emits."""
        token = self.rank.get(data)
        return [token] if token is not None else list(self.run(data))

    def _remembered(self, names: np.ndarray, spell: Callable[[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each named piece lie in ``self.ids``, and how many; ``names`` are sorted and distinct."""
        at, known = lookup(self.names, names)
        new = np.flatnonzero(~known)
        if len(self.names) + len(new) > MOST_PIECES and len(self.names):
            self._forget()
            return self._remembered(names, spell)
        if len(new):
            found = [self.piece(spell(i)) for i in new.tolist()]
            size = np.array([len(x) for x in found])
            place = np.searchsorted(self.names, names[new])
            self.names = np.insert(self.names, place, names[new])
            self.place = np.insert(self.place, place, len(self.ids) + np.cumsum(size) - size)
            self.count = np.insert(self.count, place, size)
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))])
            at = np.searchsorted(self.names, names)
        return self.place[at], self.count[at]

    def encode(self, text: str) -> list[int]:
        """Token ids of a text, piece by piece."""
        return [token for piece in self.pattern.finditer(text) for token in self.piece(piece.group().encode())]

    def encode_slice(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a slice of texts and the bounds of each text's ids.

        Pieces are told apart by length and hash, each distinct one is encoded
        once, and the ids are laid out by array indexing. Decoding must give
        the slice back; were two pieces ever to share a hash it would not, and
        the texts are then encoded piece by piece, as they are for any other
        pattern than ``CUT``.
        """
        if self.pattern.pattern != CUT:
            return self._encoded(buf.tobytes(), offsets)
        starts = piece_starts(buf, offsets)
        if len(starts) == 0:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(buf))
        names = hash_bytes(buf, starts, ends)
        order = np.argsort(names)
        ranked = names[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        which = np.empty(len(names), np.int64)
        which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(names))))
        data = buf.tobytes()
        some = order[first]
        place, size = self._remembered(ranked[first], lambda i: data[starts[some[i]]:ends[some[i]]])
        count = size[which]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.arange(total[-1]) + np.repeat(place[which] - total[:-1], count)]
        bounds = total[np.searchsorted(starts, offsets)]
        if not np.array_equal(self.decode(ids), buf):
            return self._encoded(data, offsets)
        return ids, bounds

    def _encoded(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_slice``, piece by piece."""
        texts = [self.encode(data[a:b].decode()) for a, b in zip(offsets, offsets[1:])]
        return (np.fromiter((i for x in texts for i in x), np.int32),
                np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a run of token ids."""
        size = self.size[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        return self.flat[np.arange(total) + np.repeat(self.at[ids] - end + size, size)]


#: UTF-8 lead bytes: how many bytes follow, and the range of the first of them (a fixed table of the encoding).
_LEADS = ([(range(0xC2, 0xE0), 1, 0x80, 0xBF), (range(0xE0, 0xE1), 2, 0xA0, 0xBF), (range(0xE1, 0xED), 2, 0x80, 0xBF),
           (range(0xED, 0xEE), 2, 0x80, 0x9F), (range(0xEE, 0xF0), 2, 0x80, 0xBF), (range(0xF0, 0xF1), 3, 0x90, 0xBF),
           (range(0xF1, 0xF4), 3, 0x80, 0xBF), (range(0xF4, 0xF5), 3, 0x80, 0x8F)])
_FOLLOW = {lead: (n, low, high) for leads, n, low, high in _LEADS for lead in leads}


class StreamDecoder:
    """Text from token ids that arrive in portions; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, transducer: Transducer):
        self.transducer, self.held = transducer, b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes could complete (0 to 3)."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if 0x80 <= byte < 0xC0:
                continue  # a follower: its lead stands further left
            if byte not in _FOLLOW:
                return 0
            n, low, high = _FOLLOW[byte]
            good = back == 1 or low <= data[1 - back] <= high
            return back if back <= n and good else 0
        return 0

    def feed(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(map(self.transducer.tokens.__getitem__, ids))
        keep = self.unfinished(data)
        self.held = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8", "replace")


_made: dict[bytes, Transducer] = {}


def transducer(tokens: list[bytes], pattern: str) -> Transducer:
    """One transducer per vocabulary and process, so that tasks share its states."""
    key = hashlib.sha256(b"\0".join(base64.b64encode(t) for t in tokens) + pattern.encode()).digest()
    if key not in _made:
        _made[key] = Transducer(tokens, pattern)
    return _made[key]


#: Ids that the decoder is fed at a time.
PORTION = 1 << 14


def decoded(machine: Transducer, ids: np.ndarray) -> str:
    """Text that ids stand for, decoded as a stream: in portions, through the UTF-8 state machine."""
    stream = StreamDecoder(machine)
    parts = [stream.feed(ids[k:k + PORTION].tolist()) for k in range(0, len(ids), PORTION)]
    return "".join(parts) + stream.finish()


ENCODED = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.BinaryType())


def encode_decode(text: Column, tokens: list[bytes], pattern: str) -> Column:
    """Struct column: ids, the tokens of a text, and decoded, the UTF-8 bytes of the text that streaming these ids gives."""
    @F.arrow_udf(ENCODED)
    def both(col: pa.Array) -> pa.Array:
        machine = transducer(tokens, pattern)
        ids, n, data, size = [], [[0]], bytearray(), [0]
        for _, _, buf, offsets in slices(*text_buffer(col)):
            got, bounds = machine.encode_slice(buf, offsets)
            ids.append(got), n.append(np.diff(bounds))
            for a, b in pairwise(bounds.tolist()):
                data += decoded(machine, got[a:b]).encode()
                size.append(len(data))
        if not ids:
            return pa.array([], to_arrow_type(ENCODED))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(n)), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        held = pa.Array.from_buffers(pa.binary(), len(size) - 1, [None, pa.py_buffer(np.array(size, np.int32)), pa.py_buffer(data)])
        return pa.StructArray.from_arrays([lists, held], fields=list(to_arrow_type(ENCODED)))

    return both(text)


def decode(ids: Column, tokens: list[bytes], pattern: str) -> Column:
    """Binary column of the UTF-8 bytes that token ids stand for, decoded as a stream (null ids: empty; bytes that are no UTF-8: U+FFFD)."""
    @F.arrow_udf("binary")
    def data(col: pa.Array) -> pa.Array:
        machine = transducer(tokens, pattern)
        return pa.array([decoded(machine, np.array(x.as_py() or [], np.int64)).encode() for x in col], pa.binary())

    return data(ids)


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, into: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with the token ids of each text in column ``into`` (underscores in front if ``docs`` has such a column)."""
    return docs.withColumn(fresh(docs, into), encode_decode(F.col(text_col), tokens, pattern)["ids"])
