"""A small gated recurrent language model in numpy: forward, truncated backward, scoring.

Tokens are pairs (class, member), each with an output vector. A member of a head class is one
of the most frequent words; a member of any other class is a cell of rarer words, by spelling
and hash, where a word has its share of the cell's count. So p(token | state) = p(class |
state) times p(member | class, state), and for rarer words times a count share.
"""

from __future__ import annotations

import heapq
import itertools
import math
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
HEAD_CLASSES, MEMBERS = 32, 64
SPELLINGS = 64
N_CLASSES = HEAD_CLASSES + SPELLINGS
N_HEAD = HEAD_CLASSES * MEMBERS
N_CELLS = SPELLINGS * MEMBERS
#: Symbols: head words and cells, class times MEMBERS plus member; as inputs also the start of a text.
N_INPUTS = N_HEAD + N_CELLS + 1
START = N_INPUTS - 1

SHAPES = {
    "embed": (N_INPUTS, HIDDEN),
    "w_in": (HIDDEN, 3 * HIDDEN),
    "w_rec": (HIDDEN, 3 * HIDDEN),
    "b": (3 * HIDDEN,),
    "w_class": (HIDDEN, N_CLASSES),
    "b_class": (N_CLASSES,),
    "w_member": (N_CLASSES, HIDDEN, MEMBERS),
    "b_member": (N_CLASSES, MEMBERS),
}
SIZES = {k: int(np.prod(s)) for k, s in SHAPES.items()}
N_PARAMETERS = sum(SIZES.values())

#: Parameters updated, and tokens scored, at once: their arrays stay in a core's cache.
_LOT, _SCORED = 1 << 14, 1 << 12

Parameters = dict[str, np.ndarray]


def pack(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float32)


def views(flat: np.ndarray) -> Parameters:
    """The parameters as parts of a packed array, which they write through to."""
    out, at = {}, 0
    for k, shape in SHAPES.items():
        out[k] = flat[at : at + SIZES[k]].reshape(shape)
        at += SIZES[k]
    return out


def unpack(flat: np.ndarray) -> Parameters:
    return views(np.array(flat, dtype=np.float32))


def initial(class_count: np.ndarray, member_count: np.ndarray, seed: int = 11) -> Parameters:
    """Random input side; output biases at log frequencies, so training starts from the
    class-factored unigram model. Classes ``member_count`` has no rows for start out even."""
    rng = np.random.default_rng(seed)
    even = np.ones((N_CLASSES - len(member_count), MEMBERS))
    member_count = np.concatenate([member_count, even])
    p = {k: rng.normal(0, 0.1, s) for k, s in SHAPES.items()}
    p["b"][:] = 0
    p["w_class"] *= 0.1
    p["w_member"] *= 0.1
    p["b_class"] = np.log(class_count + 0.5) - np.log(class_count.sum() + 0.5 * N_CLASSES)
    p["b_member"] = np.where(member_count > 0, np.log(np.maximum(member_count, 1)), -30.0)
    p["b_member"] = p["b_member"] - np.log(np.exp(p["b_member"]).sum(1, keepdims=True))
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def step(h: np.ndarray, x: np.ndarray, w_rec: np.ndarray) -> np.ndarray:
    """One step for a batch; x is the input's share, bias included."""
    n = HIDDEN
    r_in = h @ w_rec
    gates = _sigmoid(x[:, : 2 * n] + r_in[:, : 2 * n])
    z, r = gates[:, :n], gates[:, n:]
    new = np.tanh(x[:, 2 * n :] + r * r_in[:, 2 * n :])
    return h + z * (new - h)


@dataclass
class Adam:
    """Adaptive steps, dense, over packed parameters and in place."""

    rate: float = 0.02
    t: int = 0

    def apply(self, p: np.ndarray, grad: np.ndarray, m: np.ndarray, v: np.ndarray) -> None:
        self.t += 1
        c1, c2 = 1 - 0.9**self.t, 1 - 0.99**self.t
        one = p.dtype.type
        root = math.sqrt(c2)
        tenth, hundredth, least, pace = one(0.1), one(0.01), one(1e-6 * root), one(self.rate * root / c1)
        room = np.empty(min(_LOT, len(p)), p.dtype)
        for at in range(0, len(p), _LOT):
            own = slice(at, at + _LOT)
            g, m_, v_, p_ = grad[own], m[own], v[own], p[own]
            a = room[: len(g)]
            np.subtract(g, m_, out=a)
            a *= tenth
            m_ += a
            np.multiply(g, g, out=a)
            a -= v_
            a *= hundredth
            v_ += a
            np.sqrt(v_, out=a)
            a += least
            np.divide(m_, a, out=a)
            a *= pace
            p_ -= a


def by_class(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Tokens in the order of their classes, and (class, from, to) of those that occur."""
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    edge = np.searchsorted(cls[order], np.arange(N_CLASSES + 1)).tolist()
    return order, [(c, lo, hi) for c, (lo, hi) in enumerate(itertools.pairwise(edge)) if hi > lo]


def with_bias(p: Parameters) -> np.ndarray:
    """The weights of members, the bias as the last one."""
    return np.concatenate([p["w_member"], p["b_member"][:, None, :]], axis=1)


def log_probabilities(p: Parameters, weights: np.ndarray, hs: np.ndarray, cls: np.ndarray, mem: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of every token given the state before it; ``weights`` are ``with_bias``."""
    order, present = by_class(cls)
    hs, cls, mem, rows = hs[order], cls[order], mem[order], np.arange(len(cls))
    y = np.dot(p["w_class"].T, hs.T)
    y += p["b_class"][:, None]
    y -= y.max(0)
    value = y[cls, rows]
    np.exp(y, out=y)
    value -= np.log(y.sum(0))
    one = np.concatenate([hs, np.ones((len(hs), 1), hs.dtype)], axis=1)
    y = np.empty((len(hs), MEMBERS), hs.dtype)
    for c, lo, hi in present:
        np.dot(one[lo:hi], weights[c], out=y[lo:hi])
    y -= y.max(1, keepdims=True)
    value += y[rows, mem]
    np.exp(y, out=y)
    value -= np.log(np.dot(y, np.ones(MEMBERS, hs.dtype)))
    out = np.empty_like(value)
    out[order] = value
    return out


def loss_and_gradient(
    p: Parameters, h: np.ndarray, inputs: np.ndarray, classes: np.ndarray, members: np.ndarray, flat: np.ndarray | None = None
) -> tuple[float, Parameters, np.ndarray]:
    """Mean negative log-likelihood of a window, its gradient, and the state after it.

    ``inputs``, ``classes`` and ``members`` are (batch, steps); class -1 marks padding.
    Gradients stop at the window's start: the state that comes in is a constant. The input
    START sets the state to zero, so texts may follow one another in a row. The gradient is
    written to ``flat`` (packed) if given. Inside, steps come first and rows last, so that
    every gate is one contiguous block.
    """
    batch, steps = inputs.shape
    n, kind = HIDDEN, p["w_rec"].dtype
    if flat is None:
        flat = np.empty(N_PARAMETERS, kind)
    flat.fill(0)
    grad = views(flat)

    # Forward. A sigmoid is half a tanh of half its argument; halving is exact.
    half = np.repeat(np.array([0.5, 1.0], kind), [2 * n, n])
    ids = inputs.T.ravel()
    own = p["embed"][ids]
    x = np.ascontiguousarray(((own @ p["w_in"] + p["b"]) * half).reshape(steps, batch, 3 * n).transpose(0, 2, 1))
    w_rec = np.ascontiguousarray((p["w_rec"] * half).T)
    starts = inputs.T == START
    restarts = starts.any(1).tolist()
    inside = (~starts).astype(kind)
    before, states, after, new, r_new = (np.empty((steps, n, batch), kind) for _ in range(5))
    gates, r_in, moved = np.empty((steps, 2 * n, batch), kind), np.empty((3 * n, batch), kind), np.empty((n, batch), kind)
    state = np.ascontiguousarray(h.T, dtype=kind)
    for t in range(steps):
        if restarts[t]:
            np.multiply(state, inside[t], out=before[t])
        else:
            before[t] = state
        was, gate = before[t], gates[t]
        np.dot(w_rec, was, out=r_in)
        np.add(x[t, : 2 * n], r_in[: 2 * n], out=gate)
        np.tanh(gate, out=gate)
        gate *= half[0]
        gate += half[0]
        r_new[t] = r_in[2 * n :]
        np.multiply(gate[n:], r_in[2 * n :], out=moved)
        moved += x[t, 2 * n :]
        np.tanh(moved, out=new[t])
        np.subtract(new[t], was, out=after[t])
        np.multiply(gate[:n], after[t], out=moved)
        state = states[t]
        np.add(was, moved, out=state)

    # Classes: one column per token.
    cls, mem = classes.T.ravel(), members.T.ravel()
    hs = states.transpose(0, 2, 1).reshape(-1, n)
    whole = bool((cls >= 0).all())
    real = None if whole else np.flatnonzero(cls >= 0)
    if not whole:
        hs, cls, mem = hs[real], cls[real], mem[real]
    count, rows = max(len(cls), 1), np.arange(len(cls))
    each = kind.type(1 / count)
    order, present = by_class(cls)
    hs, cls, mem = hs[order], cls[order], mem[order]
    y = np.dot(p["w_class"].T, hs.T)
    y += p["b_class"][:, None]
    y -= y.max(0)
    loss = -float(y[cls, rows].sum(dtype=np.float64))
    np.exp(y, out=y)
    total = y.sum(0)
    loss += float(np.log(total).sum(dtype=np.float64))
    y *= each / total
    y[cls, rows] -= each
    grad["w_class"][:] = np.dot(y, hs).T
    grad["b_class"][:] = y.sum(1)
    d_own = np.dot(y.T, p["w_class"].T)

    # Members: tokens lie class by class; the last weight is the bias.
    weights = with_bias(p)
    back = np.ascontiguousarray(p["w_member"].transpose(0, 2, 1))
    one = np.concatenate([hs, np.ones((len(hs), 1), kind)], axis=1)
    y = np.empty((len(hs), MEMBERS), kind)
    for c, lo, hi in present:
        np.dot(one[lo:hi], weights[c], out=y[lo:hi])
    y -= y.max(1, keepdims=True)
    loss -= float(y[rows, mem].sum(dtype=np.float64))
    np.exp(y, out=y)
    total = np.dot(y, np.ones(MEMBERS, kind))
    loss += float(np.log(total).sum(dtype=np.float64))
    y *= (each / total)[:, None]
    y[rows, mem] -= each
    found = np.empty((n + 1, MEMBERS), kind)
    more = np.empty_like(d_own)
    for c, lo, hi in present:
        np.dot(one[lo:hi].T, y[lo:hi], out=found)
        grad["w_member"][c] = found[:n]
        grad["b_member"][c] = found[n]
        np.dot(y[lo:hi], back[c], out=more[lo:hi])
    d_own += more
    d_hs = np.zeros((steps * batch, n), kind)
    d_hs[order if whole else real[order]] = d_own
    d_hs = np.ascontiguousarray(d_hs.reshape(steps, batch, n).transpose(0, 2, 1))

    # Backward: what a step multiplies its incoming gradient by, for all steps at once.
    z, r = gates[:, :n], gates[:, n:]
    rest = 1 - z
    to_z = after * z
    to_z *= rest
    to_new = z * (1 - new * new)
    of_new = np.stack([r_new * r * (1 - r), r], axis=1)
    rest *= inside[:, None]
    d_rec, d_new = np.empty((steps, 3, n, batch), kind), np.empty((steps, n, batch), kind)
    d_h, back = np.zeros((n, batch), kind), np.ascontiguousarray(p["w_rec"])
    for t in range(steps - 1, -1, -1):
        d_h += d_hs[t]
        now = d_rec[t]
        np.multiply(d_h, to_z[t], out=now[0])
        np.multiply(d_h, to_new[t], out=d_new[t])
        np.multiply(d_new[t], of_new[t], out=now[1:])
        np.dot(back, now.reshape(3 * n, batch), out=moved)
        if restarts[t]:
            moved *= inside[t]
        d_h *= rest[t]
        d_h += moved
    d_rec = d_rec.reshape(steps, 3 * n, batch)
    grad["w_rec"][:] = np.matmul(before, d_rec.transpose(0, 2, 1)).sum(0)
    d_rec[:, 2 * n :] = d_new
    d_x = d_rec.transpose(0, 2, 1).reshape(-1, 3 * n)
    grad["w_in"][:] = np.dot(own.T, d_x)
    grad["b"][:] = d_x.sum(0)
    by_input = np.argsort(ids, kind="stable")
    ids = ids[by_input]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    grad["embed"][ids[first]] = np.add.reduceat(np.dot(d_x, p["w_in"].T)[by_input], first, axis=0)
    norm = math.sqrt(float(np.dot(flat, flat)))
    if norm > 5:
        flat *= kind.type(5 / norm)
    return loss / count, grad, state.T


def lanes(size: np.ndarray, order: np.ndarray, batch: int) -> list[list[int]]:
    """Whole texts in the given order, each to the lane with the fewest tokens so far; the
    longest lane first, none empty."""
    filled = [(0, k) for k in range(batch)]
    out: list[list[int]] = [[] for _ in range(batch)]
    for i in order.tolist():
        tokens, k = heapq.heappop(filled)
        out[k].append(i)
        heapq.heappush(filled, (tokens + int(size[i]), k))
    return [out[k] for tokens, k in sorted(filled, key=lambda x: (-x[0], x[1])) if tokens]


def train(
    p: Parameters, texts: list[np.ndarray], window: int, batch: int, least_steps: int, rate: float, seed: int
) -> Parameters:
    """Truncated backpropagation over texts: arrays of an input symbol and the tokens' symbols.

    Texts follow one another in ``batch`` lanes; every token of every text is walked window by
    window with the state carried on to the text's end. Passes repeat until ``least_steps``
    updates are done, so a small shard is learnt as well as a large one. Steps become smaller
    to the end, and where only some lanes are left, smaller by as much.
    """
    flat = pack(p)
    p = views(flat)
    m, v, grad = (np.zeros_like(flat) for _ in range(3))
    adam, rng = Adam(rate), np.random.default_rng(seed)
    size = np.array([len(t) - 1 for t in texts], dtype=np.int64)
    while size.sum():
        rows = lanes(size, rng.permutation(len(texts)), batch)
        length = np.array([size[row].sum() for row in rows])
        inputs = np.full((len(rows), length[0]), START, dtype=np.int16)
        symbols = np.full((len(rows), length[0]), -1, dtype=np.int16)
        for k, row in enumerate(rows):
            inputs[k, : length[k]] = np.concatenate([texts[i][:-1] for i in row])
            symbols[k, : length[k]] = np.concatenate([texts[i][1:] for i in row])
        h = np.zeros((len(rows), HIDDEN), dtype=np.float32)
        for at in range(0, int(length[0]), window):
            active = int(np.searchsorted(-length, -at, "left"))
            part = symbols[:active, at : at + window].astype(np.int32)
            classes = np.where(part >= 0, part // MEMBERS, -1)
            _, _, h = loss_and_gradient(p, h[:active], inputs[:active, at : at + window], classes, part % MEMBERS, grad)
            done = adam.t / max(least_steps, -(-int(length[0]) // window))
            adam.rate = rate * active / len(rows) * max(1 - done, 0.05)
            adam.apply(flat, grad, m, v)
        if adam.t >= least_steps:
            break
    return p


def log_likelihoods(
    p: Parameters, inputs: np.ndarray, classes: np.ndarray, members: np.ndarray, bounds: np.ndarray, window: int = 64
) -> np.ndarray:
    """Natural log-likelihood of every text of a run of texts (without count shares).

    All texts go through side by side, longest first, window by window; a text's state is
    carried from window to window to its end.
    """
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    starts, size = bounds[:-1][order], size[order]
    total = np.zeros(len(size))
    table = p["embed"] @ p["w_in"] + p["b"]
    weights = with_bias(p)
    h = np.zeros((len(size), HIDDEN), dtype=np.float32)
    longest = int(size[0]) if len(size) else 0
    for at in range(0, longest, window):
        active = int(np.searchsorted(-size, -at, "left"))
        steps = min(window, longest - at)
        states = np.empty((steps, active, HIDDEN), dtype=np.float32)
        alive = np.empty(steps, dtype=np.int64)
        for t in range(steps):
            n = int(np.searchsorted(-size[:active], -(at + t), "left"))
            x = table[inputs[starts[:n] + at + t]]
            h[:n] = step(h[:n], x, p["w_rec"])
            states[t, :n] = h[:n]
            alive[t] = n
        doc = np.concatenate([np.arange(n) for n in alive])
        when = np.repeat(np.arange(steps), alive)
        token = starts[doc] + at + when
        value = np.empty(len(token), states.dtype)
        for lo in range(0, len(token), _SCORED):
            own = slice(lo, lo + _SCORED)
            here = token[own]
            value[own] = log_probabilities(p, weights, states[when[own], doc[own]], classes[here], members[here])
        total[:active] += np.bincount(doc, weights=value, minlength=active)
    out = np.empty(len(size))
    out[order] = total
    return out
