"""A small gated recurrent language model in numpy.

Words of a fixed vocabulary are numbered by falling frequency. The output
softmax is factored: a class is predicted first, then the word in its class;
classes are runs of the numbering with about equal shares of the square root
of frequency, so frequent words sit in small classes. In a class of more than
``FEW`` words, a word is told by a binary tree over the class's run, whose
nodes are the places where it is halved. Texts run in parallel
lanes; a lane's state is carried from one window to the next and cleared where
a text begins, so a text's log-likelihood is exact however long it is.
Learning is truncated backpropagation through windows, with Adam; the moments
of a word's rows move only in windows that touch them.
"""

from __future__ import annotations

import heapq

import numpy as np

WINDOW = 64
LANES = 512
#: Words of a class that a softmax tells apart; larger classes have trees.
FEW = 64
#: Words whose paths are followed at a time: their rows stay in the processor's cache.
PATHS = 1024
#: Levels of a large class's tree, from its root, that are reckoned for all its words together.
TOP = 4
#: Steps of a window, and states, that are worked on at a time, for the same reason.
STEPS, STATES = 16, 2048
#: Scores up to this size need no shift before the exponential.
SAFE = 40.0
#: Rows of a run that are added one by one.
RUN = 32
HALF = np.float32(0.5)


def _sums(rows: np.ndarray, heads: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Sums of the runs of ``rows`` (in the given order) that begin at ``heads``.

    The first rows of all runs are taken, then their second ones added, and so on; long runs are summed by a product each.
    """
    size = np.diff(heads, append=len(rows))
    rest = (RUN + 1 - np.minimum(size, RUN + 1)).astype(np.uint8)
    by = np.argsort(rest, kind="stable")  # the longest first
    at, ended = heads[by], np.searchsorted(rest[by], np.arange(RUN + 1, dtype=np.uint8), side="right").tolist()
    total = rows.take(at if order is None else order[at], axis=0)
    for k in range(1, RUN):
        n = ended[RUN - k]
        if n == 0:
            break
        more = at[:n] + k
        total[:n] += rows.take(more if order is None else order[more], axis=0)
    one = np.ones(size.max(), rows.dtype)
    for i, (a, n) in enumerate(zip(at[:ended[0]].tolist(), size[by[:ended[0]]].tolist())):
        np.matmul(one[:n], rows[a:a + n] if order is None else rows.take(order[a:a + n], axis=0), out=total[i])
    return total.take(_inverse(by), axis=0)


def _inverse(order: np.ndarray) -> np.ndarray:
    return _placed(np.arange(len(order)), order)


def _placed(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[order] = values
    return out


class Rows:
    """Gradient of a table that is zero but for some rows."""

    def __init__(self, at: np.ndarray, values: np.ndarray):
        self.at, self.values = at, values

    def __getitem__(self, place: tuple):
        here = np.flatnonzero(self.at == place[0])
        return self.values[(here[0], *place[1:])] if len(here) else 0.0


class Gru:
    """Parameters: input table with bias (words by 3H), recurrent weights, class and word outputs."""

    def __init__(self, counts: np.ndarray, hidden: int, classes: int, seed: int = 7):
        """``counts`` of the words, falling."""
        rng = np.random.default_rng(seed)
        n = len(counts)
        share = np.cumsum(np.sqrt(counts + 1.0))
        self.word_class = np.minimum((share / share[-1] * classes).astype(np.int64), classes - 1)
        self.word_class = np.unique(self.word_class, return_inverse=True)[1]  # no empty classes
        k = int(self.word_class[-1]) + 1
        self.class_start = np.searchsorted(self.word_class, np.arange(k + 1))
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        log = np.log((counts + 1.0) / (counts + 1.0).sum())
        self.p = {"table": small(n, 3 * hidden), "u": small(hidden, 3 * hidden), "wc": small(hidden, k),
                  "bc": np.array([np.logaddexp.reduce(log[a:b]) for a, b in zip(self.class_start, self.class_start[1:])], np.float32),
                  "wo": small(n, hidden), "bo": log.astype(np.float32)}
        self.hidden = hidden
        self._moments = None
        #: Type that holds word numbers; short ones sort faster.
        self.number = np.uint16 if n <= 1 << 16 else np.int32
        self._plant(counts + 1.0)
        #: Words whose rows were ever changed.
        self.touched = np.zeros(n, bool)

    def _plant(self, mass: np.ndarray) -> None:
        """Paths of the words of large classes; a class [a, b) is halved at its middle m, and row m of the word outputs is the node."""
        size = np.diff(self.class_start)
        self.deep = size > FEW
        words = np.flatnonzero(self.deep[self.word_class])
        self.path_of = np.full(len(mass), -1)
        self.path_of[words] = np.arange(len(words))
        depth = int(size.max() - 1).bit_length() if len(words) else 0
        #: By level and word: nodes, sides (zero beyond the word's own leaf), and, in the upper levels, the places of nodes among the class's own.
        self.nodes, self.sides = np.zeros((depth, len(words)), np.int32), np.zeros((depth, len(words)), np.float32)
        self.top = min(TOP, int(size[self.deep].min()).bit_length() - 1) if len(words) else 0  # levels that no leaf cuts short
        self.places = np.zeros((self.top, len(words)), np.int32)
        self.top_nodes = np.zeros((self.deep.sum(), (1 << self.top) - 1), np.int64)
        tree = (np.cumsum(self.deep) - 1)[self.word_class[words]]
        place = np.zeros(len(words), np.int64)
        lo, hi = self.class_start[self.word_class[words]], self.class_start[self.word_class[words] + 1]
        below = np.concatenate(([0.0], np.cumsum(mass)))
        for k in range(depth):
            on = np.flatnonzero(hi - lo > 1)
            middle = (lo[on] + hi[on]) >> 1
            right = words[on] >= middle
            self.nodes[k, on], self.sides[k, on] = middle, np.where(right, 1, -1)
            self.p["bo"][middle] = np.log((below[hi[on]] - below[middle]) / (below[middle] - below[lo[on]]))
            if k < self.top:  # all words are on
                self.places[k], self.top_nodes[tree, place] = place, middle
                place = 2 * place + 1 + right
            lo[on], hi[on] = np.where(right, middle, lo[on]), np.where(right, hi[on], middle)
        self.levels = (self.sides != 0).sum(axis=0)

    def rows(self) -> np.ndarray:
        """All parameters: a row for each word, then the shared ones in rows of the same width."""
        shared = np.concatenate([self.p[k].ravel() for k in ("u", "wc", "bc")])
        words = np.concatenate([self.p["table"], self.p["wo"], self.p["bo"][:, None]], axis=1)
        return np.concatenate([words, np.pad(shared, (0, -len(shared) % words.shape[1])).reshape(-1, words.shape[1])])

    def load(self, rows: np.ndarray) -> None:
        n, H = len(self.word_class), self.hidden
        words, shared = rows[:n].astype(np.float32), rows[n:].astype(np.float32).ravel()
        self.p["table"], self.p["wo"], self.p["bo"] = (np.ascontiguousarray(a) for a in (words[:, :3 * H], words[:, 3 * H:4 * H], words[:, 4 * H]))
        at = 0
        for k in ("u", "wc", "bc"):
            self.p[k] = shared[at:at + self.p[k].size].reshape(self.p[k].shape).copy()
            at += self.p[k].size

    def run(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool = False):
        """States after each step of a window (steps by lanes), and what backpropagation needs."""
        H, table = self.hidden, self.p["table"]
        to_z, to_r, to_new = self._turns()
        to_z, to_r = to_z * HALF, to_r * HALF  # a sigmoid is a tanh of half its argument
        states = np.empty((*x.shape, H), table.dtype)
        befores, turned = (np.empty_like(states), np.empty_like(states)) if keep else (None, None)
        cleared = fresh.any(axis=1).tolist()
        steps = len(x) if keep else STEPS
        for first in range(0, len(x), steps):
            rows = table.take(x[first:first + steps].ravel(), axis=0)
            z, r, new = ((rows[:, k * H:(k + 1) * H] * by).reshape(-1, x.shape[1], H) for k, by in enumerate((HALF, HALF, np.float32(1))))
            for t, (z_t, r_t, new_t) in enumerate(zip(z, r, new), first):
                if cleared[t]:
                    h = h.copy()
                    h[fresh[t]] = 0
                for gate, to in ((z_t, to_z), (r_t, to_r)):
                    gate += h @ to
                    np.tanh(gate, out=gate)
                    gate *= HALF
                    gate += HALF
                hu = h @ to_new
                if keep:
                    befores[t], turned[t] = h, hu
                hu *= r_t
                new_t += hu
                np.tanh(new_t, out=new_t)
                after = np.subtract(h, new_t, out=states[t])
                after *= z_t
                after += new_t
                h = after
        return states, (befores, z, r, new, turned) if keep else None

    def _turns(self) -> list[np.ndarray]:
        """Recurrent weights of the update gate, the reset gate and the candidate."""
        return [np.ascontiguousarray(part) for part in np.split(self.p["u"], 3, axis=1)]

    def log_probabilities(self, states: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target from its state."""
        return self._output(states, y, None)[0]

    def _output(self, states: np.ndarray, y: np.ndarray, weight: np.ndarray | None):
        """Log-probabilities, and with weights the gradients of their weighted sum (states' and parameters')."""
        p, H, n = self.p, self.hidden, len(y)
        order = np.argsort(y.astype(self.number), kind="stable")  # words of a class, and of a node, then follow one another
        y, states = y[order], states.take(order, axis=0)
        klass, cuts = self.word_class[y], np.searchsorted(y, self.class_start).tolist()
        wide = np.ones((n, H + 1), states.dtype)  # the last column meets the biases
        wide[:, :H] = states
        most = np.abs(wide).max(initial=0)
        out, back, found = np.empty(n, states.dtype), None, []
        classes, turned = np.concatenate([p["wc"], p["bc"][None]]), np.ascontiguousarray(p["wc"].T)
        d_classes, one = np.zeros_like(classes), np.ones(classes.shape[1], states.dtype)
        if weight is not None:
            weight, back = weight[order], np.empty_like(states)
        for a in range(0, n, STATES):
            b = min(a + STATES, n)
            here = (np.arange(b - a), klass[a:b])
            e = self._scores(wide[a:b], classes, most)
            out[a:b] = e[here]
            np.exp(e, out=e)
            total = e @ one
            out[a:b] -= np.log(total)
            if weight is not None:
                e *= (-weight[a:b] / total)[:, None]
                e[here] += weight[a:b]
                np.matmul(e, turned, out=back[a:b])
                d_classes += wide[a:b].T @ e
        deep = np.flatnonzero(self.deep[klass])
        if len(deep):
            on = slice(deep[0], deep[-1] + 1) if deep[-1] - deep[0] < len(deep) else deep
            logs, back_deep, found = self._deep(states[on], y[on], None if weight is None else weight[on])
            out[on] += logs
            if weight is not None:
                back[on] += back_deep
        for c in np.flatnonzero(~self.deep):
            a, b, first, last = cuts[c], cuts[c + 1], self.class_start[c], self.class_start[c + 1]
            if a == b or last - first == 1:
                continue
            e = self._scores(wide[a:b], np.concatenate([p["wo"][first:last], p["bo"][first:last, None]], axis=1).T, most)
            here = (np.arange(b - a), y[a:b] - first)
            chosen = e[here]
            np.exp(e, out=e)
            total = e @ np.ones(last - first, e.dtype)
            out[a:b] += chosen - np.log(total)
            if weight is not None:
                e *= (-weight[a:b] / total)[:, None]
                e[here] += weight[a:b]
                back[a:b] += e @ p["wo"][first:last]
                d = e.T @ wide[a:b]
                found.append((np.arange(first, last), d[:, :H], d[:, H]))
        place = _inverse(order)
        if weight is None:
            return out.take(place), None, {}
        at, wo, bo = (np.concatenate(parts) for parts in zip(*found)) if found else (order[:0], states[:0], out[:0])
        return out.take(place), back.take(place, axis=0), {"wc": d_classes[:H], "bc": d_classes[H], "wo": Rows(at, wo), "bo": Rows(at, bo)}

    @staticmethod
    def _scores(wide: np.ndarray, weights: np.ndarray, most: float) -> np.ndarray:
        """Scores of a softmax, shifted by each row's highest if exponentials might overflow; nothing in ``wide`` is larger than ``most``."""
        e = wide @ weights
        if most * np.abs(weights).sum(axis=0).max() > SAFE:
            e -= e.max(axis=1, keepdims=True)
        return e

    def _deep(self, states: np.ndarray, y: np.ndarray, weight: np.ndarray | None):
        """The share of trees in ``_output``, for targets in rising order, with the gradients of the nodes that they meet.

        A class's upper nodes meet all its words in one product; below them each word's own nodes are fetched.
        """
        p, H, n, top = self.p, self.hidden, len(y), self.top
        width = (1 << top) - 1
        cuts = np.searchsorted(y, self.class_start).tolist()
        runs = [(i, cuts[c], cuts[c + 1]) for i, c in enumerate(np.flatnonzero(self.deep).tolist()) if cuts[c] < cuts[c + 1]]
        upper = p["wo"].take(self.top_nodes, axis=0)
        scores = np.empty((n, width), states.dtype)
        for i, a, b in runs:
            np.matmul(states[a:b], upper[i].T, out=scores[a:b])
        path = self.path_of[y]
        logs, ones = np.empty(n, states.dtype), np.ones(H, states.dtype)
        if weight is not None:
            depth = len(self.nodes) - top
            back, spread = np.empty_like(states), np.zeros((n, width), states.dtype)
            visited = np.zeros(self.top_nodes.shape, bool)
            lower, turn = np.full((depth, n), -1, np.int32), np.zeros((depth, n), states.dtype)
        for a in range(0, n, PATHS):
            at = path[a:a + PATHS]
            b = a + len(at)
            levels = int(self.levels.take(at).max())
            nodes, sides = self.nodes[:levels].take(at, axis=1), self.sides[:levels].take(at, axis=1)
            places = self.places.take(at, axis=1)
            places += np.arange(a, b, dtype=np.int32) * np.int32(width)
            margin = np.empty(nodes.shape, states.dtype)
            margin[:top] = scores.ravel().take(places)
            w = p["wo"].take(nodes[top:], axis=0)
            margin[top:] = ((w * states[a:b]).reshape(-1, H) @ ones).reshape(levels - top, b - a)
            margin += p["bo"].take(nodes)
            margin *= sides
            away = np.exp(-np.abs(margin))
            logs[a:b] = ((np.minimum(margin, 0) - np.log(1 + away)) * np.abs(sides)).sum(axis=0)
            if weight is not None:
                d = sides * np.where(margin < 0, np.float32(1), away) / (1 + away) * weight[a:b]
                spread.ravel()[places] = d[:top]
                w *= d[top:, :, None]
                w.sum(axis=0, out=back[a:b])
                lower[:levels - top, a:b] = np.where(sides[top:] != 0, nodes[top:], -1)
                turn[:levels - top, a:b] = d[top:]
        if weight is None:
            return logs, None, []
        sums, biases = np.zeros(upper.shape, states.dtype), np.zeros(upper.shape[:2], states.dtype)
        for i, a, b in runs:
            d, one = spread[a:b], np.ones(b - a, states.dtype)
            back[a:b] += d @ upper[i]
            np.matmul(d.T, states[a:b], out=sums[i])
            np.matmul(one, d, out=biases[i])
            visited[i, self.places[-1].take(path[a:b])] = True
        for k in range(width // 2 - 1, -1, -1):  # a node is met by whatever meets those below it
            visited[:, k] = visited[:, 2 * k + 1] | visited[:, 2 * k + 2]
        found = [(self.top_nodes[visited], sums[visited], biases[visited])]
        on = np.flatnonzero(lower >= 0)
        if len(on):
            ranked, d = lower.ravel()[on], turn.ravel()[on]
            heads = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            rows = states.take(on % n, axis=0)
            rows *= d[:, None]
            found.append((ranked[heads], _sums(rows, heads), np.add.reduceat(d, heads)))
        return logs, back, found

    def learn(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray, rate: float,
              real: np.ndarray | None = None) -> tuple[np.ndarray, float]:
        """One step of Adam on a window; returns the state to carry on and the mean log-probability.

        ``real`` tells the window's words from what only fills it up; all are words without it.
        """
        H = self.hidden
        states, (before, z, r, new, hn) = self.run(x, fresh, h, keep=True)
        flat = states.reshape(-1, H)
        weight = np.ones(y.size, np.float32) if real is None else real.ravel().astype(np.float32)
        weight /= weight.sum()
        logs, back, grads = self._output(flat, y.ravel(), weight)
        back = back.reshape(states.shape)
        # What a state's gradient is multiplied by on its way to the arguments of the candidate and the gates.
        closed = 1 - z
        by_new = closed * (1 - new * new)
        by_z = (before - new) * (z * closed)
        by_r = hn * (r - r * r)
        carry = np.zeros_like(states[0])
        from_z, from_r, from_new = (np.ascontiguousarray(part.T) for part in self._turns())
        cleared = fresh.any(axis=1).tolist()
        for t in range(len(x) - 1, -1, -1):
            dh, d_new, d_z, d_r, d_hn = back[t], by_new[t], by_z[t], by_r[t], r[t]
            dh += carry
            d_new *= dh
            d_z *= dh
            d_r *= d_new
            d_hn *= d_new
            carry = d_z @ from_z
            carry += d_r @ from_r
            carry += d_hn @ from_new
            dh *= z[t]
            carry += dh
            if cleared[t]:
                carry[fresh[t]] = 0
        past = before.reshape(-1, H).T
        grads["u"] = np.concatenate([past @ d.reshape(-1, H) for d in (by_z, by_r, r)], axis=1)
        inputs = np.concatenate([by_z, by_r, by_new], axis=2)
        order = np.argsort(x.ravel().astype(self.number), kind="stable")  # sums of each word's rows
        words = x.ravel()[order]
        heads = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        grads["table"] = Rows(words[heads], _sums(inputs.reshape(-1, 3 * H), heads, order))
        self._step(grads, rate)
        return states[-1], float((logs * weight).sum())

    def _step(self, grads: dict, rate: float) -> None:
        if self._moments is None:
            self._moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
            self._steps = 0
        self._steps += 1
        scale = rate * np.sqrt(1 - 0.99 ** self._steps) / (1 - 0.9 ** self._steps)
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in (g.values if isinstance(g, Rows) else g for g in grads.values())))
        clip = np.float32(0.1 * min(1.0, 1.0 / max(norm, 1e-9)))
        for k, g in grads.items():
            (m, v), p = self._moments[k], self.p[k]
            if not isinstance(g, Rows):
                p += self._moved(g * clip, m, v, scale)
                continue
            self.touched[g.at] = True
            step = PATHS * self.hidden // p[0].size
            for a in range(0, len(g.at), step):
                at = g.at[a:a + step]
                m_at, v_at = m.take(at, axis=0), v.take(at, axis=0)
                moved = self._moved(g.values[a:a + step] * clip, m_at, v_at, scale)
                moved += p.take(at, axis=0)
                m[at], v[at], p[at] = m_at, v_at, moved

    @staticmethod
    def _moved(g: np.ndarray, m: np.ndarray, v: np.ndarray, scale: float) -> np.ndarray:
        """Adam's step for a tenth of a gradient, which is used up; the moments ``m`` and ``v`` are brought up to date in place."""
        m *= np.float32(0.9)
        m += g
        v *= np.float32(0.99)
        g *= g
        v += g
        np.sqrt(v, out=g)
        g += np.float32(1e-6)
        np.divide(m, g, out=g)
        g *= np.float32(scale)
        return g


def train(model: Gru, texts: list[np.ndarray], end: int, rate: float, lanes: int = 512, window: int = 16) -> int:
    """One pass over texts (arrays of word numbers); returns how many words, ends included, were learnt from.

    The texts follow one another in ``lanes`` strands of equal length, with the
    state carried along each strand. Few words make fewer strands. The last
    strands are filled up with ends that nothing is learnt from.
    """
    if not texts:
        return 0
    stream = np.concatenate([np.append(t, end) for t in texts])
    before = np.concatenate(([end], stream[:-1]))
    first = before == end
    lanes = max(1, min(lanes, len(stream) // window))
    steps = -(-len(stream) // lanes)
    x, y, fresh, real = (np.pad(a, (0, lanes * steps - len(a)), constant_values=fill).reshape(lanes, steps).T
                         for a, fill in ((before, end), (stream, end), (first, True), (np.ones(len(stream), bool), False)))
    h = np.zeros((lanes, model.hidden), np.float32)
    for t in range(0, steps, window):
        h, _ = model.learn(x[t:t + window], y[t:t + window], fresh[t:t + window], h, rate, real[t:t + window])
    return len(stream)


def log_likelihoods(model: Gru, words: np.ndarray, bounds: np.ndarray, end: int, lanes: int = LANES, window: int = WINDOW) -> np.ndarray:
    """Natural log-likelihood of each whole text, its end included.

    ``words`` holds the numbers of all texts' words, ``bounds`` where each text
    starts and ends. Texts are dealt to lanes longest first; a lane runs
    through its texts one after another, and leaves when they are done.
    """
    n = len(bounds) - 1
    size = np.diff(bounds) + 1
    lanes = max(1, min(lanes, n))
    loads = [(0, k) for k in range(lanes)]
    lane, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-size, kind="stable").tolist():
        load, k = heapq.heappop(loads)
        lane[i], at[i] = k, load
        heapq.heappush(loads, (load + int(size[i]), k))
    length = np.zeros(lanes, np.int64)
    for load, k in loads:
        length[k] = load
    place = np.argsort(np.argsort(-length, kind="stable"), kind="stable")  # lanes in order of length
    lane, length = place[lane], np.sort(length)[::-1]
    steps = int(length[0]) if n else 0
    out = np.zeros(n)
    # Step and lane of every word and end; the input is the word before, or an end at a text's start.
    text = np.repeat(np.arange(n, dtype=np.int32), size)
    ends = np.cumsum(size) - 1
    target = np.empty(len(text), np.int32)
    target[ends] = end
    inner = np.ones(len(text), bool)
    inner[ends] = False
    target[inner] = words
    opens = np.zeros(len(text), bool)
    opens[ends - size + 1] = True
    source = np.empty_like(target)
    source[1:] = target[:-1]
    source[opens] = end
    # Lanes in order of length have no gaps, so at a step the first so many are at work.
    working = np.searchsorted(-length, -np.arange(steps), side="left")
    begun = np.concatenate(([0], np.cumsum(working)))
    step = np.arange(len(text))
    step += np.repeat(at - ends + size - 1, size)
    order = begun.take(step)
    order += np.repeat(lane, size)
    del step, inner
    source, target, text, opens = (_placed(a, order) for a in (source, target, text, opens))
    del order
    h = np.zeros((lanes, model.hidden), np.float32)
    for t in range(0, steps, window):
        deep = min(window, steps - t)
        a, b = begun[t], begun[t + deep]
        active = int(working[t])
        x = np.full((deep, active), end, np.int64)
        fresh = np.zeros((deep, active), bool)
        s = np.repeat(np.arange(deep), working[t:t + deep])
        c = np.arange(a, b) - begun[t + s]
        x[s, c] = source[a:b]
        fresh[s, c] = opens[a:b]
        states, _ = model.run(x, fresh, h[:active])
        h = states[-1]
        logs = model.log_probabilities(states[s, c], target[a:b])
        out += np.bincount(text[a:b], weights=logs, minlength=n)
    return out
