"""A gated recurrent language model in numpy with a class-factored output, over one flat parameter vector.

Word ids run from 0 to ``WORDS - 1`` by falling frequency; id ``RARE`` stands for every other word and ``START`` opens a
document. The output first picks a class (CLASS_WORDS ids in a row, or the class of rare words), then the
word in its class. Documents lie end to end in lanes that are worked in step; the state is carried from
window to window, and starts afresh where a document starts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORDS, CLASS_WORDS, HIDDEN = 2048, 64, 16
CLASSES = WORDS // CLASS_WORDS
RARE, START = WORDS, WORDS + 1
# Steps through which training propagates back; steps that scoring takes at once.
WINDOW, SCORE_WINDOW = 16, 64
MOST_LANES, LEAST_LANES = 384, 32
# Words of a document beyond which scoring gives it a lane that is never laid out whole.
LONG = 32_768
# Words of a document that training takes in one go.
SEGMENT = 2048
# Words of a step of the optimiser at least, and its rate.
STEP_WORDS = 2048
RATE = 0.02
SHAPES = (("x", (WORDS + 2, 3 * HIDDEN)), ("h", (HIDDEN, 3 * HIDDEN)), ("c", (HIDDEN, CLASSES + 1)), ("cb", (CLASSES + 1,)),
          ("w", (CLASSES, HIDDEN, CLASS_WORDS)), ("wb", (CLASSES, CLASS_WORDS)))


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES:
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def start(counts: np.ndarray, rare: float, seed: int) -> np.ndarray:
    """Parameters before training: the output's biases give the unigram shares of ids and classes."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(sum(int(np.prod(s)) for _, s in SHAPES), np.float32)
    p = views(flat)
    for name, scale in (("x", 0.3), ("h", 0.3), ("c", 0.05), ("w", 0.05)):
        p[name][:] = rng.standard_normal(p[name].shape) * scale
    full = np.zeros(WORDS)
    full[:len(counts)] = counts
    full = full.reshape(CLASSES, CLASS_WORDS)
    share = np.append(full.sum(1), rare) + 1e-6
    p["cb"][:] = np.log(share / share.sum())
    p["wb"][:] = np.log((full + 1e-6) / (full + 1e-6).sum(1, keepdims=True))
    return flat


@dataclass
class Lanes:
    """Documents dealt to lanes: ``ids``, ``prev`` and ``doc`` by [step, lane]; lane lengths fall."""
    ids: np.ndarray
    prev: np.ndarray
    doc: np.ndarray
    lengths: np.ndarray


def deal(tokens: np.ndarray, lengths: np.ndarray) -> Lanes:
    """Longest documents first, each to the shortest lane so far. Every document stays whole in one lane."""
    import heapq
    total, longest = int(lengths.sum()), int(lengths.max())
    n = int(min(MOST_LANES, len(lengths), max(LEAST_LANES, total // longest)))
    begins = np.cumsum(lengths) - lengths
    heap, lanes = [(0, k) for k in range(n)], [[] for _ in range(n)]
    for d in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        lanes[k].append(d)
        heapq.heappush(heap, (size + int(lengths[d]), k))
    sizes = np.array([lengths[x].sum() for x in lanes])
    order = np.argsort(-sizes, kind="stable")
    shape = (n, int(sizes.max()))
    ids, prev, doc = np.full(shape, -1, np.int16), np.full(shape, RARE, np.int16), np.full(shape, -1, np.int32)
    for row, k in enumerate(order.tolist()):
        at = 0
        for d in lanes[k]:
            a, b = begins[d], begins[d] + lengths[d]
            ids[row, at:at + b - a] = tokens[a:b]
            prev[row, at] = START
            prev[row, at + 1:at + b - a] = tokens[a:b - 1]
            doc[row, at:at + b - a] = d
            at += b - a
    return Lanes(np.ascontiguousarray(ids.T), np.ascontiguousarray(prev.T), np.ascontiguousarray(doc.T), sizes[order])


def recur(p: dict, prev: np.ndarray, state: np.ndarray, keep_all: bool):
    """States after each step of a window, and what the way back needs."""
    T, B, H = prev.shape[0], prev.shape[1], HIDDEN
    inputs = p["x"].take(prev, axis=0)
    states = np.empty((T, B, H), np.float32)
    tape = [] if keep_all else None
    starts = prev == START
    some = starts.any(1).tolist()
    for t in range(T):
        if some[t]:
            state = state * ~starts[t][:, None]
        u = state @ p["h"]
        un = u[:, 2 * H:]
        zr = inputs[t, :, :2 * H] + u[:, :2 * H]      # to its sigmoid, in place
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        n = zr[:, H:] * un
        n += inputs[t, :, 2 * H:]
        np.tanh(n, out=n)
        if keep_all:
            tape.append((state, zr, un, n, starts[t] if some[t] else None))
        step = state - n
        step *= zr[:, :H]
        state = np.add(step, n, out=states[t])
    return states, state, tape


def by_class(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Positions ordered by their word's class, and (class, from, to) in them; rare words and padding have none."""
    cls = np.where(ids < 0, CLASSES, ids // CLASS_WORDS).astype(np.int16)
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    return order[:cuts[CLASSES]], [(c, cuts[c], cuts[c + 1]) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


ONES = np.ones(max(CLASS_WORDS, CLASSES + 1), np.float32)


def exp_sum(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(x - top), its sums by row, and top, which is 0 unless the plain exponentials leave their range."""
    e = np.exp(x)
    s = e @ ONES[:x.shape[1]]
    if not len(s) or s.min() > 0 and s.max() < np.inf:
        return e, s, 0.0
    top = x.max(1)
    e = np.exp(x - top[:, None])
    return e, e.sum(1), top


def log_chances(p: dict, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log-probability of each id after its state; padding (-1) has none that counts."""
    logits = h @ p["c"]
    logits += p["cb"]
    _, total, top = exp_sum(logits)
    logp = logits[np.arange(len(ids)), np.where(ids >= 0, ids // CLASS_WORDS, 0)] - top - np.log(total)
    order, classes = by_class(ids)
    sorted_h, sorted_ids, sorted_logp = h.take(order, axis=0), ids[order], np.empty(len(order), logp.dtype)
    for c, a, b in classes:
        inner = sorted_h[a:b] @ p["w"][c]
        inner += p["wb"][c]
        _, total, top = exp_sum(inner)
        sorted_logp[a:b] = inner[np.arange(b - a), sorted_ids[a:b] - c * CLASS_WORDS] - top - np.log(total)
    logp[order] += sorted_logp
    return logp


def score(flat: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log-probability of each document's ids (a rare word counts as its class only).

    Documents of more than LONG words are lanes of their own that are read window by window, so that memory does
    not grow with a document's length times the number of lanes.
    """
    p, out = views(flat), np.zeros(len(lengths))
    begins = np.cumsum(lengths) - lengths
    long = np.flatnonzero(lengths > LONG)
    long = long[np.argsort(-lengths[long], kind="stable")]
    state = np.zeros((len(long), HIDDEN), np.float32)
    for a in range(0, int(lengths[long].max()) if len(long) else 0, SCORE_WINDOW):
        live = long[lengths[long] > a]
        at = a + np.arange(SCORE_WINDOW)[:, None]
        inside = at < lengths[live]
        ids = np.where(inside, tokens[np.minimum(begins[live] + at, len(tokens) - 1)], -1)
        prev = np.where(inside, tokens[np.minimum(begins[live] + np.maximum(at - 1, 0), len(tokens) - 1)], RARE)
        if a == 0:
            prev[0] = START
        states, state, _ = recur(p, prev, state[:len(live)], False)
        logp = log_chances(p, states.reshape(-1, HIDDEN), ids.ravel()).reshape(ids.shape)
        out[live] += np.where(inside, logp, 0).sum(0, dtype=np.float64)
    short = np.flatnonzero(lengths <= LONG)
    if not len(short):
        return out
    if len(long):
        tokens = tokens[np.repeat(lengths <= LONG, lengths)]
    lanes, part = deal(tokens, lengths[short]), np.zeros(len(short))
    state = np.zeros((lanes.ids.shape[1], HIDDEN), np.float32)
    for a in range(0, len(lanes.ids), SCORE_WINDOW):
        live = int((lanes.lengths > a).sum())
        window = slice(a, a + SCORE_WINDOW)
        states, state, _ = recur(p, lanes.prev[window, :live], state[:live], False)
        ids, doc, h = lanes.ids[window, :live].ravel(), lanes.doc[window, :live].ravel(), states.reshape(-1, HIDDEN)
        real = ids >= 0
        part += np.bincount(doc[real], weights=log_chances(p, h, ids)[real].astype(np.float64), minlength=len(short))
    out[short] = part
    return out


def gradient(p: dict, g: dict, prev: np.ndarray, ids: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Adds a window's gradient of the summed loss to ``g``; returns the state to carry on."""
    T, B, H = prev.shape[0], prev.shape[1], HIDDEN
    states, last, tape = recur(p, prev, state, True)
    h, flat_ids = states.reshape(-1, H), ids.ravel()
    real = (flat_ids >= 0).astype(np.float32)
    d, total, _ = exp_sum(h @ p["c"] + p["cb"])
    d *= (real / total)[:, None]
    d[np.arange(len(d)), np.where(real, flat_ids // CLASS_WORDS, 0)] -= real
    g["c"] += h.T @ d
    g["cb"] += d.sum(0)
    dh = d @ p["c"].T
    order, classes = by_class(flat_ids)
    sorted_h, sorted_ids, sorted_dh = h.take(order, axis=0), flat_ids[order], np.empty((len(order), H), np.float32)
    for c, a, b in classes:
        hc, x = sorted_h[a:b], sorted_h[a:b] @ p["w"][c]
        x += p["wb"][c]
        d, total, _ = exp_sum(x)
        d /= total[:, None]
        d[np.arange(b - a), sorted_ids[a:b] - c * CLASS_WORDS] -= 1
        g["w"][c] += hc.T @ d
        g["wb"][c] += d.sum(0)
        np.matmul(d, p["w"][c].T, out=sorted_dh[a:b])
    dh[order] += sorted_dh
    dh = dh.reshape(T, B, H)
    into = np.empty((T, B, 3 * H), np.float32)
    back = np.zeros((B, H), np.float32)
    for t in range(T - 1, -1, -1):
        before, zr, un, n, fresh = tape[t]
        z, r, du = zr[:, :H], zr[:, H:], into[t]
        back += dh[t]
        dn = 1 - z
        dn *= back
        slope = n * n
        np.subtract(1, slope, out=slope)
        dn *= slope
        np.multiply(back, before - n, out=du[:, :H])
        np.multiply(dn, un, out=du[:, H:2 * H])
        slope = 1 - zr
        slope *= zr
        du[:, :2 * H] *= slope
        du[:, 2 * H:] = dn
        du = du.copy()
        du[:, 2 * H:] *= r
        g["h"] += before.T @ du
        back *= z
        back += du @ p["h"].T
        if fresh is not None:
            back *= ~fresh[:, None]
    symbol = prev.ravel()
    order = np.argsort(symbol, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(symbol[order]) != 0)))
    g["x"][symbol[order][first]] += np.add.reduceat(into.reshape(-1, 3 * H)[order], first, axis=0)
    return last


class Trainer:
    """Adam over truncated backpropagation; the state, not the gradient, crosses windows."""

    def __init__(self, flat: np.ndarray, rate: float = RATE):
        self.flat, self.rate, self.steps, self.words = flat.copy(), rate, 0, 0
        self.p, self.grad = views(self.flat), np.zeros_like(flat)
        self.g = views(self.grad)
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)

    def learn(self, tokens: np.ndarray, lengths: np.ndarray) -> None:
        """One pass. Windows add up until a step has seen STEP_WORDS words, however few lanes are left.

        A document of more than SEGMENT words is learned in segments that start afresh, so that no lane outlasts the others.
        """
        whole, rest = np.divmod(lengths, SEGMENT)
        lanes = deal(tokens, np.concatenate([[SEGMENT] * w + [r] * (r > 0) for w, r in zip(whole.tolist(), rest.tolist(), strict=True)]).astype(np.int64))
        state = np.zeros((lanes.ids.shape[1], HIDDEN), np.float32)
        for a in range(0, len(lanes.ids), WINDOW):
            live = int((lanes.lengths > a).sum())
            ids = lanes.ids[a:a + WINDOW, :live]
            state = gradient(self.p, self.g, lanes.prev[a:a + WINDOW, :live], ids, state[:live])
            self.words += int((ids >= 0).sum())
            if self.words >= STEP_WORDS:
                self.step()

    def step(self) -> None:
        self.grad /= self.words
        self.steps += 1
        self.m += 0.1 * (self.grad - self.m)
        self.v += 0.01 * (self.grad * self.grad - self.v)
        rate = self.rate * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        self.flat -= np.float32(rate) * self.m / (np.sqrt(self.v) + 1e-7)
        self.grad[:], self.words = 0, 0
