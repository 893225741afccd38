"""A gated recurrent language model in numpy with a class-factored output softmax.

Symbols are the frequent words, in output classes of neighbours in frequency, and the members of the tail classes
(rarer words, dealt by hash). P(symbol) = P(class | state) * P(member | class, state).
Texts run in lanes: each lane reads whole texts one after the other, the state is reset where a text begins and
carried from window to window, and gradients stop at the window's edge (truncated backpropagation).

Cases: a text without symbols has no probability to add (0); without texts nothing is learnt; a text of any length
costs two bytes a symbol and a window.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

F32 = np.float32
#: Tokens whose class probabilities are worked out at once, so that they stay in the processor's cache.
CACHED = 1024
#: Bias of members that don't exist.
ALONE = np.float32(-30)
#: Symbols after which training begins anew within a text, so that one long text doesn't hold up all lanes.
PIECE = 1 << 14


@dataclass(frozen=True)
class Shape:
    words: int  # frequent words, the end among them
    tails: int  # tail classes
    hidden: int = 12
    per_class: int = 32

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.per_class)

    @property
    def classes(self) -> int:
        return self.word_classes + self.tails

    @property
    def symbols(self) -> int:
        return self.classes * self.per_class

    def sizes(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {"x": (self.symbols + 1, 3 * h), "u": (h, 3 * h), "c": (h, self.classes), "cb": (self.classes,), "w": (self.classes, h, self.per_class), "wb": (self.classes, self.per_class)}


def initial(shape: Shape, counts: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """counts of all symbols (-1: no such symbol) set the output biases, so the model begins as the unigram model."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.standard_normal(s) * 0.1).astype(F32) for k, s in shape.sizes().items()}
    there = counts.reshape(shape.classes, shape.per_class) >= 0
    smooth = np.where(there, counts.reshape(there.shape) + 0.5, 0)
    by_class = smooth.sum(axis=1) + 1e-9
    p["cb"][:] = np.log(by_class / by_class.sum())
    p["wb"][:] = np.where(there, np.log(np.maximum(smooth, 0.5)), ALONE)
    return p


def lanes(lengths: np.ndarray, n: int) -> list[list[int]]:
    """Texts to n lanes, longest first to the shortest lane."""
    n = max(1, min(n, len(lengths)))
    heap, out = [(0, k) for k in range(n)], [[] for _ in range(n)]
    for d in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (size + int(lengths[d]), k))
    return out


class Lanes:
    """Texts of a batch dealt to lanes, a window of steps at a time.

    The symbols lie in one array, lane after lane, so a long text costs its own length and no lane is padded to it:
    what is held at once is the batch and a window.
    """

    def __init__(self, texts: list[np.ndarray], n: int, begin: int):
        lengths = np.array([len(t) for t in texts], np.int64)
        rows = lanes(lengths, n)
        order = [d for r in rows for d in r]
        self.begin = begin
        self.flat = np.concatenate([texts[d] for d in order]) if order else np.zeros(0, np.uint16)
        self.text = np.array(order, np.int64)  # the text at each place
        self.starts = np.concatenate([[0], np.cumsum(lengths[order])]).astype(np.int64)
        ends = np.cumsum([0, *(int(lengths[r].sum()) for r in rows)])
        self.at, self.end = ends[:-1].copy(), ends[1:].copy()  # where each lane reads on, and its end

    def windows(self, steps: int):
        """(live lanes or None for all, input, target, text, valid), steps x lanes, until all lanes have ended."""
        alive = None
        while True:
            left = self.end - self.at
            if not len(left) or left.max() <= 0:
                return
            if (left > 0).mean() < 0.6:  # lanes that have ended
                alive = np.flatnonzero(left > 0)
                self.at, self.end, left = self.at[alive], self.end[alive], left[alive]
            place = self.at + np.arange(min(steps, int(left.max())))[:, None]
            valid = place < self.end
            np.minimum(place, self.end - 1, out=place)
            place[:, self.end == 0] = 0
            k = np.searchsorted(self.starts, place, side="right") - 1
            y = self.flat[place].astype(np.int32)
            x = np.where(self.starts[k] == place, self.begin, self.flat[np.maximum(place - 1, 0)]).astype(np.int32)
            yield alive, x, y, self.text[k], valid
            self.at = np.minimum(self.at + len(place), self.end)
            alive = None


def forward(p: dict, shape: Shape, x: np.ndarray, h: np.ndarray, keep: bool):
    """States after each step of a window (steps x lanes x hidden), what backward() needs, the last state."""
    n, steps = shape.hidden, len(x)
    gates = p["x"][x]  # steps x lanes x 3 hidden
    fresh = (x != shape.symbols).astype(F32)[..., None]
    out = np.empty((steps, x.shape[1], n), F32)
    kept = []
    for t in range(steps):
        h = h * fresh[t]
        a = h @ p["u"]
        rz = gates[t, :, : 2 * n] + a[:, : 2 * n]
        rz *= -1
        np.exp(rz, out=rz)
        rz += 1
        np.reciprocal(rz, out=rz)
        r, z = rz[:, :n], rz[:, n:]
        c = np.tanh(gates[t, :, 2 * n :] + r * a[:, 2 * n :])
        new = c + z * (h - c)
        if keep:
            kept.append((h, r, z, c, a[:, 2 * n :]))
        out[t] = h = new
    return out, (kept, fresh), h


def outputs(p: dict, shape: Shape, h: np.ndarray, y: np.ndarray, grad: dict | None = None):
    """Natural log probability of targets y given states h (tokens x hidden); with grad, adds to it and returns dh too."""
    cls = y // shape.per_class
    kind = np.result_type(h, p["c"])
    out = np.empty(len(y), kind)
    dh = None if grad is None else np.empty(h.shape, kind)
    for a in range(0, len(y), CACHED):
        hk, at = h[a : a + CACHED], cls[a : a + CACHED]
        e = hk @ p["c"]
        e += p["cb"]
        e -= e.max(axis=1, keepdims=True)
        rows = np.arange(len(at))
        own = e[rows, at]
        np.exp(e, out=e)
        total = e.sum(axis=1)
        out[a : a + CACHED] = own - np.log(total)
        if grad is not None:
            e /= -total[:, None]
            e[rows, at] += 1
            grad["c"] += hk.T @ e
            grad["cb"] += e.sum(axis=0)
            dh[a : a + CACHED] = e @ p["c"].T
    order = np.argsort(cls.astype(np.uint16), kind="stable")
    cut = np.searchsorted(cls[order], np.arange(shape.classes + 1))
    for k in range(shape.classes):
        at = order[cut[k] : cut[k + 1]]
        if not len(at) or p["wb"][k, 1] == p["wb"][k, -1] == ALONE:  # a class of one member is sure
            continue
        hk, yk = h[at], y[at] - k * shape.per_class
        s = hk @ p["w"][k] + p["wb"][k]
        s -= s.max(axis=1, keepdims=True)
        r = np.arange(len(at))
        own = s[r, yk]
        np.exp(s, out=s)
        total = s.sum(axis=1)
        out[at] += own - np.log(total)
        if grad is not None:
            s /= -total[:, None]
            s[r, yk] += 1
            grad["w"][k] += hk.T @ s
            grad["wb"][k] += s.sum(axis=0)
            dh[at] += s @ p["w"][k].T
    return out, dh


def backward(p: dict, shape: Shape, x: np.ndarray, kept, dout: np.ndarray, grad: dict) -> None:
    n = shape.hidden
    kept, fresh = kept
    dgates = np.empty((len(x), x.shape[1], 3 * n), F32)
    dh = np.zeros_like(dout[0])
    for t in range(len(x) - 1, -1, -1):
        h, r, z, c, ac = kept[t]
        dh = dh + dout[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * ac * r * (1 - r)
        g = dgates[t]
        g[:, :n], g[:, n : 2 * n], g[:, 2 * n :] = dr, dz, dc
        back = np.concatenate([dr, dz, dc * r], axis=1)
        grad["u"] += h.T @ back
        dh = (dh * z + back @ p["u"].T) * fresh[t]
    flat, d = x.ravel(), dgates.reshape(-1, 3 * n)
    order = np.argsort(flat.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(flat[order], prepend=-1))
    grad["x"][flat[order][first]] += np.add.reduceat(d[order], first, axis=0)


class Trainer:
    """Adam over windows of lanes."""

    def __init__(self, p: dict, shape: Shape, rate: float = 0.01):
        self.p, self.shape, self.rate, self.step = {k: v.copy() for k, v in p.items()}, shape, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def run(self, texts: list[np.ndarray], n: int = 512, window: int = 32) -> int:
        """One pass over the texts; the number of tokens. A text longer than PIECE is learnt in pieces, each from a fresh state."""
        pieces = [t[a : a + PIECE] for t in texts for a in range(0, len(t), PIECE)]
        tokens = 0
        h = None
        for alive, x, y, _, ok in Lanes(pieces, n, self.shape.symbols).windows(window):
            h = np.zeros((x.shape[1], self.shape.hidden), F32) if h is None else h if alive is None else h[alive]
            states, kept, h = forward(self.p, self.shape, x, h, True)
            grad = {k: np.zeros_like(v) for k, v in self.p.items()}
            flat = ok.ravel()
            _, d = outputs(self.p, self.shape, states.reshape(-1, self.shape.hidden)[flat], y.ravel()[flat], grad)
            dout = np.zeros((flat.size, self.shape.hidden), F32)
            dout[flat] = d
            backward(self.p, self.shape, x, kept, dout.reshape(states.shape), grad)
            now = int(flat.sum())
            self._update(grad, max(1, now))
            tokens += now
        return tokens

    def _update(self, grad: dict, tokens: int) -> None:
        self.step += 1
        fix = np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        for k, g in grad.items():
            g /= tokens
            np.clip(g, -1, 1, out=g)
            m, v = self.m[k], self.v[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[k] += F32(self.rate * fix) * m / (np.sqrt(v) + F32(1e-6))  # the gradient of a log-likelihood: ascent


def score(p: dict, shape: Shape, texts: list[np.ndarray], n: int = 1024, window: int = 32) -> np.ndarray:
    """Natural log probability of each whole text, its state carried through all windows."""
    out = np.zeros(len(texts))
    h = None
    for alive, x, y, doc, ok in Lanes(texts, n, shape.symbols).windows(window):
        h = np.zeros((x.shape[1], shape.hidden), F32) if h is None else h if alive is None else h[alive]
        states, _, h = forward(p, shape, x, h, False)
        flat = ok.ravel()
        got, _ = outputs(p, shape, states.reshape(-1, shape.hidden)[flat], y.ravel()[flat])
        np.add.at(out, doc.ravel()[flat], got)
    return out


def packed(p: dict) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in sorted(p))


def unpacked(raw: bytes, shape: Shape) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in sorted(shape.sizes().items()):
        n = int(np.prod(s))
        out[k] = np.frombuffer(raw, "<f4", n, 4 * at).reshape(s).copy()
        at += n
    return out
