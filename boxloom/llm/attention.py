"""A small causal self-attention model in numpy.

Positions are dealt into blocks of 16. A block's queries look at its own keys and at those of the block before, so
every position is scored once, in a window of 32 that overlaps the next one by half, under a causal mask. Places enter
as a bias on the distance, which lets keys and values be computed once for both windows they are in.
"""

from __future__ import annotations

import numpy as np

BLOCK, WIDE, HIDDEN, ROWS = 16, 16, 16, 4096
DISTANCE = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
VISIBLE = DISTANCE >= 0
FAR = np.maximum(DISTANCE, 0)
#: blocks handled at once
BATCH = 512
#: made and freed once: from then on glibc keeps the pages of freed arrays up to this size for the arrays of the next batch
np.empty(24 << 20, np.uint8)


def fresh(outputs: int, log_share: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Start weights; the output bias is the log share of each output, so an untrained model is the unigram model."""
    r = np.random.default_rng(seed)
    w = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    return {
        "e": (r.standard_normal((ROWS, WIDE)) * 0.3).astype(np.float32), "q": w(WIDE, WIDE), "k": w(WIDE, WIDE),
        "v": w(WIDE, WIDE), "o": w(WIDE, WIDE), "near": np.zeros(2 * BLOCK, np.float32), "w1": w(WIDE, HIDDEN),
        "b1": np.zeros(HIDDEN, np.float32), "w2": w(HIDDEN, WIDE), "out": np.zeros((WIDE, outputs), np.float32),
        "bias": log_share.astype(np.float32),
    }


def packed(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unpacked(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def blocks_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Where each position goes when every text starts a block of its own; which blocks start a text; their number."""
    counts = -(-lengths // BLOCK)
    begin = np.cumsum(counts) - counts
    total = int(counts.sum())
    starts = np.zeros(total, bool)
    starts[begin[lengths > 0]] = True
    offsets = np.cumsum(lengths) - lengths
    return np.repeat(begin * BLOCK - offsets, lengths) + np.arange(int(lengths.sum())), starts, total


def _softmax(x: np.ndarray) -> np.ndarray:
    """Shares along the last axis. Its maximum is taken off only where exp() would leave the range of numbers."""
    ones = np.ones(x.shape[-1], x.dtype)
    if x.max(initial=0) < 60:
        e = np.exp(x)
        total = e @ ones
        if total.min(initial=1) > 1e-25:
            e /= total[..., None]
            return e
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    e /= (e @ ones)[..., None]
    return e


def _joined(p: dict) -> np.ndarray:
    return np.concatenate([p["q"], p["k"], p["v"]], axis=1)


def _flat(m: np.ndarray) -> np.ndarray:
    return m.reshape(-1, m.shape[-1])


def forward(p: dict, first: np.ndarray, last: np.ndarray, starts: np.ndarray, carried=None):
    """Log shares (blocks, BLOCK, outputs) and what the backward pass needs; inputs are rows of the embedding."""
    x = p["e"].take(first.ravel(), axis=0)
    x += p["e"].take(last.ravel(), axis=0)
    # one product over all positions for each weight: numpy would make one for each block
    qkv = (x @ _joined(p)).reshape(len(first), BLOCK, 3 * WIDE)
    q, kv = qkv[:, :, :WIDE], np.empty((len(first), 2 * BLOCK, 2 * WIDE), x.dtype)
    kv[:, BLOCK:] = qkv[:, :, WIDE:]
    kv[1:, :BLOCK] = qkv[:-1, :, WIDE:]  # each block behind the one before it; at the start of a text that has no weight
    kv[0, :BLOCK] = 0 if carried is None else carried
    scores = q @ kv[:, :, :WIDE].transpose(0, 2, 1)
    scores *= np.float32(WIDE**-0.5)
    near = p["near"][FAR]
    near[~VISIBLE] = -1e9
    scores += near
    scores[starts, :, :BLOCK] = -1e9
    a = _softmax(scores)
    mixed = _flat(a @ kv[:, :, WIDE:])
    h = mixed @ p["o"]
    h += x
    u = h @ p["w1"]
    u += p["b1"]
    np.maximum(u, 0, out=u)
    h2 = u @ p["w2"]
    h2 += h
    logits = h2 @ p["out"]
    logits += p["bias"]
    return logits.reshape(len(first), BLOCK, -1), (x, q, kv, a, mixed, h, u, h2), qkv[-1, :, WIDE:]


def _chosen(m: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Where the target outputs of each position lie in the flat ``m``."""
    return np.arange(0, m.size, m.shape[-1]) + target.ravel()


def log_share(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of the target output at each position."""
    ones = np.ones(logits.shape[-1], logits.dtype)
    if logits.max(initial=0) < 60:  # as in _softmax
        total = np.exp(logits) @ ones
        if total.min(initial=1) > 1e-25:
            return logits.ravel()[_chosen(logits, target)].reshape(target.shape) - np.log(total)
    top = logits.max(axis=-1)
    return logits.ravel()[_chosen(logits, target)].reshape(target.shape) - top - np.log(np.exp(logits - top[..., None]) @ ones)


def gradients(p: dict, first, last, starts, target, real) -> tuple[float, dict]:
    """Mean loss over real positions and its gradients. Blocks before this batch are not looked at."""
    starts = starts.copy()
    starts[0] = True
    logits, (x, q, kv, a, mixed, h, u, h2), _ = forward(p, first, last, starts)
    n, real = max(1, int(real.sum())), real.ravel()
    d = _flat(_softmax(logits))
    at = _chosen(d, target)
    share = d.ravel()[at]
    loss = -float(np.log(share[real]).sum()) / n
    d.ravel()[at] = share - 1
    d[~real] = 0
    d *= np.float32(1 / n)
    ones = np.ones(len(d) + BLOCK, d.dtype)
    g = {"out": h2.T @ d, "bias": ones[: len(d)] @ d}
    dh2 = d @ p["out"].T
    g["w2"] = u.T @ dh2
    du = dh2 @ p["w2"].T
    du *= u > 0
    g["w1"], g["b1"] = h.T @ du, ones[: len(d)] @ du
    dh = du @ p["w1"].T
    dh += dh2
    g["o"] = mixed.T @ dh
    dmixed = (dh @ p["o"].T).reshape(q.shape)
    ds = dmixed @ kv[:, :, WIDE:].transpose(0, 2, 1)
    ds -= ((ds * a) @ ones[: 2 * BLOCK])[..., None]
    ds *= a
    per = (ones[: len(ds)] @ ds.reshape(len(ds), -1)).reshape(DISTANCE.shape)
    g["near"] = np.bincount(DISTANCE[VISIBLE], per[VISIBLE], 2 * BLOCK).astype(np.float32)
    ds *= np.float32(WIDE**-0.5)
    dkv, dqkv = np.empty_like(kv), np.empty((*q.shape[:2], 3 * WIDE), q.dtype)
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :WIDE])
    np.matmul(a.transpose(0, 2, 1), dmixed, out=dkv[:, :, WIDE:])
    np.matmul(ds, kv[:, :, :WIDE], out=dqkv[:, :, :WIDE])
    dqkv[:, :, WIDE:] = dkv[:, BLOCK:]
    dqkv[:-1, :, WIDE:] += dkv[1:, :BLOCK]  # what the next block owes to this one; the start of a text owes nothing
    dqkv = _flat(dqkv)
    joined = x.T @ dqkv
    g["q"], g["k"], g["v"] = joined[:, :WIDE], joined[:, WIDE : 2 * WIDE], joined[:, 2 * WIDE :]
    dx = dqkv @ _joined(p).T
    dx += dh
    twice, rows = np.empty((2, *dx.shape)), np.concatenate([first.ravel(), last.ravel()])
    twice[:] = dx  # what the first subword is owed, and the last one
    g["e"] = np.bincount((rows[:, None] * WIDE + np.arange(WIDE)).ravel(), twice.ravel(), p["e"].size)
    g["e"] = g["e"].astype(p["e"].dtype).reshape(p["e"].shape)
    return loss, g


class Adam:
    """Works in place on all weights as one array, of which ``p`` has views from then on."""

    def __init__(self, p: dict, rate: float):
        self.names, self.rate, self.t = sorted(p), rate, 0
        self.p, at = packed(p), 0
        self.m, self.v, self.spare = np.zeros_like(self.p), np.zeros_like(self.p), np.empty_like(self.p)
        for k in self.names:
            p[k], at = self.p[at : at + p[k].size].reshape(p[k].shape), at + p[k].size

    def step(self, g: dict) -> None:
        self.t += 1
        rate = np.float32(self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t))
        d, spare = packed(g), self.spare
        np.subtract(d, self.m, out=spare)
        spare *= np.float32(0.1)
        self.m += spare
        d *= d
        d -= self.v
        d *= np.float32(0.01)
        self.v += d
        np.sqrt(self.v, out=spare)
        spare += np.float32(1e-6)
        np.divide(self.m, spare, out=spare)
        spare *= rate
        self.p -= spare


def laid_out(codes: np.ndarray, lengths: np.ndarray, classes: np.ndarray, end: int, rows: int = ROWS):
    """Texts as blocks: (first, last, starts, target, real, place of each position).

    ``codes``: first subword id * 65536 + last one, for each word of all texts; a text has one position more than
    words, its end. A position's input is the word before it (row 0 at the start).
    """
    place, starts, total = blocks_of(lengths + 1)
    first, last = np.zeros(total * BLOCK, np.int32), np.zeros(total * BLOCK, np.int32)
    target, real = np.zeros(total * BLOCK, np.int32), np.zeros(total * BLOCK, bool)
    ends = np.cumsum(lengths + 1) - 1
    is_word = np.ones(len(place), bool)
    is_word[ends] = False
    at = place[is_word]
    target[place[ends]], real[place] = end, True
    ids = codes >> 16
    target[at] = classes[ids]
    after = place[np.flatnonzero(is_word) + 1]  # a word is never the last position of its text
    first[after], last[after] = 1 + ids % (rows - 1), 1 + (codes & 65535) % (rows - 1)
    shape = (total, BLOCK)
    return first.reshape(shape), last.reshape(shape), starts, target.reshape(shape), real.reshape(shape), place


def train(p: dict, laid, rate: float, batch: int = 64) -> None:
    """One pass of Adam over the blocks, in place. Rows of the embedding that do not occur in them stay as they are."""
    first, last, starts, target, real, _ = laid
    seen = np.zeros(len(p["e"]), bool)
    seen[first] = seen[last] = True
    used, number = np.flatnonzero(seen), np.cumsum(seen) - 1
    first, last, few = number[first], number[last], {**p, "e": p["e"][used]}
    adam = Adam(few, rate)
    for at in range(0, len(first), batch):
        s = slice(at, at + batch)
        adam.step(gradients(few, first[s], last[s], starts[s], target[s], real[s])[1])
    p["e"][used] = few.pop("e")
    p.update(few)


def position_scores(p: dict, laid) -> tuple[np.ndarray, np.ndarray]:
    """(natural log probability of the output, the output) for each position, in text order."""
    first, last, starts, target, _, place = laid
    out, carried = np.empty(target.shape, np.float32), None
    for at in range(0, len(first), BATCH):
        s = slice(at, at + BATCH)
        logits, _, carried = forward(p, first[s], last[s], starts[s], carried)
        out[s] = log_share(logits, target[s])
    return out.ravel()[place], target.ravel()[place]
