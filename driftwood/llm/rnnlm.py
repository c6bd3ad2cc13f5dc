"""Gated recurrent language model with class-factored output, scored over whole documents.

Counts of all training tokens are taken on Spark. The most frequent tokens form the model's words, VOCAB at least and
WORDS_ROOT times the root of the number of distinct tokens (``model_words``), in classes by frequency that grow with the rank
(``class_cuts``: frequent words, most of the tokens, meet small ones); all others share one unknown word, whose mass is spread over them by their
counts: (c + 1) / (N' + V' + 1). P(word | past) = P(class | state) P(word | class, state).

Training: numpy, truncated backpropagation over STEPS tokens, Adam, taken over the weights in blocks that stay in
the processor's cache. Each round every task starts from the
same weights and trains on its part of the round's documents; weights are then averaged by tokens, block by block
and at most FAN_IN tasks at a time.
The rounds are disjoint parts of the training documents, by hash, that add up to TRAIN_SHARE: all of them, once each.
The output biases start at the token frequencies.

Words are hashed from running sums over the bytes of many texts (``token_hashes``), by the same function in all three passes.

Scoring: documents are laid one after the other into parallel streams; a document starts with the zero state,
which is carried over all windows to its end.

The counts of the HEAD most frequent words, or of the model's words if these are more, are broadcast (16 bytes each); counts of the others are joined.

Defined results: null text is empty and has the end token alone; rows with a null id are not learned from; without training
text all counts are zero; repeated rows are scored alike, each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, hash_share, materialize, mix64, release

VOCAB, WORDS_ROOT, CLASS_SIZE, HIDDEN, STEPS, STREAMS = 4096, 32, 64, 24, 32, 256
TRAIN_SHARE, ROUNDS, HEAD = 1.0, 2, 1 << 17
GROUP_TOKENS = 4_000_000
END = np.uint64(1)
PART, FAN_IN = 8192, 64
LOG2E = np.float32(np.log2(np.e))
#: Bytes of text that are hashed at once, and the number whose powers tell a word's bytes apart by their places.
HASH_BYTES, RADIX = 1 << 16, 0x9E3779B97F4A7C15
#: Weights that Adam takes at once, and windows for which one look at the greatest outputs holds.
BLOCK, LOOK = 32_768, 8
#: Tokens of one product, outputs that stay in the cache, and tokens whose outputs are taken together in scoring.
NEAR_TOKENS, NEAR_OUTPUTS, FAR_TOKENS = 512, 65_536, 65_536


def class_size(vocab: int) -> int:
    """Words of a class on average: CLASS_SIZE, doubled while there are more than half as many classes as words in one."""
    size = CLASS_SIZE
    while size * size < 2 * vocab:
        size *= 2
    return size


@lru_cache(maxsize=4)
def class_cuts(vocab: int) -> np.ndarray:
    """First word of each class, and the end. Classes grow linearly with their number, by which a token whose frequency falls
    with the rank meets the fewest classes and words together."""
    n = max(1, vocab // class_size(vocab))
    return np.unique(np.round(vocab * (np.arange(n + 1) / n) ** 2).astype(np.int64))


def model_words(distinct: int) -> int:
    """Number of the model's words for so many distinct training tokens, in whole classes."""
    n = max(VOCAB, int(np.ceil(WORDS_ROOT * np.sqrt(distinct))))
    return -(-n // class_size(n)) * class_size(n)


class Weights:
    """Named float32 arrays in one flat vector."""

    def __init__(self, vocab: int, flat: np.ndarray | None = None):
        h, self.cuts = HIDDEN, class_cuts(vocab)
        c = len(self.cuts) - 1
        self.shapes = {"emb": (vocab, h), "wx": (h, 3 * h), "wh": (h, 3 * h), "b": (3 * h,), "wcb": (h + 1, c),
                       "wob": (h + 1, vocab)}
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        self.flat = np.zeros(size, np.float32) if flat is None else flat
        at = 0
        for name, s in self.shapes.items():
            n = int(np.prod(s))
            setattr(self, name, self.flat[at:at + n].reshape(s))
            at += n
        # outputs lie above their biases, which a state followed by a one meets in the same product
        self.wc, self.bc, self.wo, self.bo = self.wcb[:h], self.wcb[h], self.wob[:h].T, self.wob[h]
        self.vocab, self.class_of = vocab, np.repeat(np.arange(c, dtype=np.int16), np.diff(self.cuts))

    @classmethod
    def start(cls, counts: np.ndarray) -> Weights:
        w, r = cls(len(counts)), np.random.default_rng(7)
        for a, scale in ((w.emb, 0.1), (w.wx, 0.2), (w.wh, 0.2)):
            a[...] = r.normal(0, scale, a.shape)
        mass = counts + 1.0
        by_class = np.add.reduceat(mass, w.cuts[:-1])
        w.bc[...] = np.log(by_class / mass.sum())
        w.bo[...] = np.log(mass / by_class[w.class_of])
        return w


def _states(w: Weights, table: np.ndarray, x: np.ndarray, keep: np.ndarray, h: np.ndarray, cache: list | None = None):
    """States after each step; ``x`` rows of ``table`` and ``keep`` (0 where a document starts) are (steps, streams).
    Inside, the streams are the last axis, so that a gate of all streams is one piece of memory. ``cache`` gets what the way
    back needs of all steps: states before, gates and what the states give to the gates."""
    k, steps, n = 2 * HIDDEN, len(x), len(h)
    g = np.ascontiguousarray(table[x].transpose(0, 2, 1))
    out = np.empty((steps, HIDDEN, n), np.float32)
    before = np.empty((steps if cache is not None else 1, HIDDEN, n), np.float32)
    u = np.empty((len(before), 3 * HIDDEN, n), np.float32)
    wh, last = np.ascontiguousarray(w.wh.T), len(before) - 1
    g[:, :k] *= 0.5  # the logistic function as a hyperbolic tangent of the half
    wh[:k] *= 0.5
    h = h.T
    for t in range(steps):
        hp, ut = before[min(t, last)], u[min(t, last)]
        np.multiply(h, keep[t], out=hp)
        np.matmul(wh, hp, out=ut)
        zr, m = g[t, :k], g[t, k:]
        zr += ut[:k]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        h = out[t]
        np.multiply(zr[HIDDEN:], ut[k:], out=h)
        m += h
        np.tanh(m, out=m)
        np.subtract(hp, m, out=h)
        h *= zr[:HIDDEN]
        h += m
    if cache is not None:
        cache.extend((before, g, u[:, k:]))
    return out.transpose(0, 2, 1), h.T


def _states_back(w: Weights, cache: list, d_out: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates, (steps, gates, streams), and of ``wh``, from those of the states, (steps, streams, places)."""
    k, (hp, g, un) = 2 * HIDDEN, cache
    z, r, m = g[:, :HIDDEN], g[:, HIDDEN:k], g[:, k:]
    d_out = np.ascontiguousarray(d_out.transpose(0, 2, 1))
    # what turns the gradient of a state into those of its gates, for all steps at once
    far = 1 - z
    by_z = hp - m
    by_z *= z
    by_z *= far
    by_n = m * m
    np.subtract(1, by_n, out=by_n)
    by_n *= far
    by_r = 1 - r
    by_r *= r
    by_r *= un
    dg, du = np.empty_like(g), np.empty_like(g)
    dh = np.zeros(d_out.shape[1:], np.float32)
    for t in range(len(g) - 1, -1, -1):
        dh += d_out[t]
        own, rec = dg[t], du[t]
        np.multiply(dh, by_n[t], out=own[k:])
        np.multiply(dh, by_z[t], out=own[:HIDDEN])
        np.multiply(own[k:], by_r[t], out=own[HIDDEN:k])
        rec[:k] = own[:k]
        np.multiply(own[k:], r[t], out=rec[k:])
        dh *= z[t]
        dh += w.wh @ rec
        dh *= keep[t]
    return dg, np.matmul(du, hp.transpose(0, 2, 1)).sum(axis=0).T


def _is_calm(w: Weights) -> bool:
    """Whether no output of a state (all within -1 and 1) is so large that its exponential needs scaling."""
    def most(out: np.ndarray) -> float:
        return float(np.maximum(out.max(axis=1), -out.min(axis=1)).sum())  # the largest weight of each place, and their sum
    return all(most(out) < 60 or np.abs(out).sum(axis=0).max() < 60 for out in (w.wob, w.wcb))


def _level(out: np.ndarray, pieces: list[tuple[int, int, int, int]], one: np.ndarray, y: np.ndarray, lp: np.ndarray | None,
           ds: np.ndarray | None, d_out: np.ndarray | None, calm: bool, scale: float) -> None:
    """Softmaxes of one level: a piece (first token, end, first output, end) holds tokens that meet the same outputs, columns of
    ``out``. Adds the log-probabilities of ``y``, places within the outputs met, to ``lp``, or adds ``scale`` times the
    gradients of the states to ``ds`` and writes those of the outputs met to ``d_out``. The pieces are all tokens in order; as
    many as stay in the cache lie one after the other in one buffer."""
    sizes = np.array([(j - i) * (d - c) for i, j, c, d in pieces])
    batch = np.cumsum(sizes) // NEAR_OUTPUTS
    cuts = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(pieces)]
    width = np.repeat([d - c for _, _, c, d in pieces], [j - i for i, j, _, _ in pieces])
    first = np.cumsum(width) - width
    place, ones, states = first + y, np.ones(int(width.max(initial=1)), np.float32), out[:HIDDEN].T
    bits, held, total, begun = one * LOG2E, np.empty(0, np.float32), np.empty(len(y), np.float32), -1
    for left, right in zip(cuts, cuts[1:]):
        of = pieces[left:right]
        if not of:
            continue
        at, size = slice(of[0][0], of[-1][1]), int(sizes[left:right].sum())
        if len(held) < size:
            held = np.empty(size, np.float32)
        a, own, views, k = held[:size], place[at] - first[of[0][0]], [], 0
        for i, j, c, d in of:
            n = (j - i) * (d - c)
            v = a[k:k + n].reshape(j - i, d - c)
            np.matmul(bits[i:j], out[:, c:d], out=v)
            if not calm:
                v -= v.max(axis=1, keepdims=True)
            views.append(v)
            k += n
        if lp is not None:
            lp[at] += a[own] / LOG2E
        np.exp2(a, out=a)  # takes half the time of the natural one
        for (i, j, c, d), v in zip(of, views):
            np.dot(v, ones[:d - c], out=total[i:j])
        if lp is not None:
            lp[at] -= np.log(total[at])
            continue
        a[own] -= total[at]
        inv = (np.float32(scale) / total[at])[:, None]
        scaled, part = (one[at] * inv).T, np.empty((at.stop - at.start, HIDDEN), np.float32)
        for (i, j, c, d), v in zip(of, views):
            i, j = i - at.start, j - at.start
            if c != begun:
                np.matmul(scaled[:, i:j], v, out=d_out[:, c:d])
            else:
                d_out[:, c:d] += scaled[:, i:j] @ v
            np.matmul(v, states[c:d], out=part[i:j])
            begun = c
        part *= inv
        ds[at] += part


def _outputs(w: Weights, s: np.ndarray, y: np.ndarray, grad: Weights | None = None, calm: bool = False, scale: float = 1.0):
    """Log-probabilities of targets ``y`` from states ``s``; with ``grad`` None in their place and ``scale`` times d loss / d s,
    and in ``grad`` the gradients of the outputs."""
    cls = w.class_of[y]
    order = np.argsort(cls, kind="stable")
    y, cls, one = y[order], cls[order], np.ones((len(y), HIDDEN + 1), np.float32)
    one[:, :HIDDEN] = s[order]
    lp, ds = (np.zeros(len(y), np.float32), None) if grad is None else (None, np.zeros((len(y), HIDDEN), np.float32))
    n = len(w.cuts) - 1
    pieces = [(i, min(i + NEAR_TOKENS, len(y)), 0, n) for i in range(0, len(y), NEAR_TOKENS)]
    _level(w.wcb, pieces, one, cls, lp, ds, grad and grad.wcb, calm, scale)
    cuts, pieces = np.searchsorted(cls, np.arange(n + 1)).tolist(), []
    for c, (lo, hi) in enumerate(zip(w.cuts.tolist(), w.cuts[1:].tolist())):
        if cuts[c] == cuts[c + 1] and grad is not None:
            grad.wob[:, lo:hi] = 0
        pieces += [(i, min(i + NEAR_TOKENS, cuts[c + 1]), lo, hi) for i in range(cuts[c], cuts[c + 1], NEAR_TOKENS)]
    _level(w.wob, pieces, one, y - w.cuts[cls], lp, ds, grad and grad.wob, calm, scale)
    got, back = lp if grad is None else ds, np.empty_like(order)
    back[order] = np.arange(len(order))
    return got[back] if grad is None else (None, got[back])


def _adam(w: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, scale: float, step: int, rate: float) -> None:
    """One step of Adam by ``scale`` times the gradient; block by block, as all of them outgrow the cache.
    ``m`` and ``v`` are ten and a hundred times the moments, so that what is added needs no factor."""
    root = np.float32(np.sqrt(1 - 0.99 ** step))
    least, pace = np.float32(1e-3) * root, np.float32(rate / (1 - 0.9 ** step)) * root
    held = np.empty(min(BLOCK, len(w)), np.float32)
    for i in range(0, len(w), BLOCK):
        at = slice(i, i + BLOCK)
        gi, mi, vi = g[at], m[at], v[at]
        if scale != 1:
            gi *= np.float32(scale)
        by = held[:len(gi)]
        mi *= np.float32(0.9)
        mi += gi
        np.multiply(gi, gi, out=by)
        vi *= np.float32(0.99)
        vi += by
        np.sqrt(vi, out=by)
        by += least
        np.divide(mi, by, out=by)
        by *= pace
        w[at] -= by


def streams(docs: list[np.ndarray], end: int, most: int = STREAMS, idle: int = 64):
    """Documents laid into parallel streams, the longest stream first: inputs, targets, keep, and document of each place
    (-1: none). ``idle``: streams that are taken even if some end early."""
    lens = np.array([len(d) for d in docs])
    longest = max(int(lens.max(initial=1)), 1)
    # as many as keep all streams busy, or ``idle``, as long as the table stays small
    n = int(np.clip(max(lens.sum() // longest, min(idle, len(docs), GROUP_TOKENS // longest)), 1, most))
    order, load, parts = np.argsort(-lens, kind="stable"), np.zeros(n, np.int64), [[] for _ in range(n)]
    for i in order.tolist():  # the longest first, each to the shortest stream
        j = int(load.argmin())
        parts[j].append(i)
        load[j] += lens[i]
    parts = [parts[j] for j in np.argsort(-load, kind="stable").tolist()]  # streams that end first come last
    steps = -(-int(load.max(initial=0)) // STEPS) * STEPS
    y, doc = np.full((n, steps), end, np.int32), np.full((n, steps), -1, np.int32)
    x, keep = np.full((n, steps), end, np.int32), np.ones((n, steps), np.float32)
    for j, own in enumerate(parts):
        at = 0
        for i in own:
            m = lens[i]
            y[j, at:at + m], doc[j, at:at + m] = docs[i], i
            x[j, at + 1:at + m], keep[j, at] = docs[i][:-1], 0
            at += m
    return x.T.copy(), y.T.copy(), keep.T.copy(), doc.T.copy()


def _busy(doc: np.ndarray, window: int) -> list[int]:
    """Streams that still hold a document in each window; they are the first ones."""
    return [int((doc[t] >= 0).sum()) for t in range(0, len(doc), window)]


def score_documents(w: Weights, docs: list[np.ndarray], end: int) -> np.ndarray:
    """log10 probability of each document's tokens."""
    x, y, keep, doc = streams(docs, end, idle=STREAMS)
    table, h, total = w.emb @ w.wx + w.b, np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros(len(docs))
    calm, held, size = _is_calm(w), [], 0

    def flush() -> np.ndarray:
        s, ys, own = (np.concatenate(c) for c in zip(*held))
        return np.bincount(own, _outputs(w, s, ys, calm=calm).astype(np.float64), len(docs))

    for i, n in enumerate(_busy(doc, 2 * STEPS)):
        at = slice(2 * STEPS * i, 2 * STEPS * (i + 1)), slice(n)
        if n:
            s, h = _states(w, table, x[at], keep[at], h[:n])
            own = doc[at].ravel()
            s, ok = s.reshape(-1, HIDDEN), own >= 0
            held.append((s, y[at].ravel(), own) if ok.all() else (s[ok], y[at].ravel()[ok], own[ok]))
            size += len(held[-1][0])
        if size >= FAR_TOKENS:
            total += flush()
            held, size = [], 0
    if held:
        total += flush()
    return total / np.log(10)


def train_documents(w: Weights, docs: list[np.ndarray], end: int, moments: list, rate: float = 0.01) -> None:
    """One pass of truncated backpropagation with Adam over the documents; ``moments`` is [step, m, v]."""
    x, y, keep, doc = streams(docs, end)
    h, k = np.zeros((x.shape[1], HIDDEN), np.float32), 2 * HIDDEN
    if len(moments) == 3:
        moments.append(np.zeros(w.vocab, np.int64))  # the step at which each input was met last
    g, look, calm, n_emb = Weights(w.vocab), 0, False, w.emb.size
    rest, second = g.flat[n_emb:], Weights(w.vocab, moments[2]).emb
    for i, n in enumerate(_busy(doc, STEPS)):
        at = slice(i * STEPS, (i + 1) * STEPS), slice(n)
        own = doc[at].ravel()
        ok = np.flatnonzero(own >= 0)
        if not len(ok):
            continue
        h = h[:n]
        # the window's distinct inputs, and the place of each input among them
        rows, place = np.unique(x[at], return_inverse=True)
        cache, inputs = [], w.emb[rows]
        place = place.reshape(STEPS, n)
        s, h_next = _states(w, inputs @ w.wx + w.b, place, keep[at], h, cache)
        if look % LOOK == 0:
            calm = _is_calm(w)
        look += 1
        _, ds = _outputs(w, s.reshape(-1, HIDDEN)[ok], y[at].ravel()[ok], g, calm, 32 / len(ok))
        if len(ok) < STEPS * n:
            d_out = np.zeros((STEPS * n, HIDDEN), np.float32)
            d_out[ok] = ds
            ds = d_out
        dg, g.wh[...] = _states_back(w, cache, ds.reshape(STEPS, n, HIDDEN), keep[at])
        g.b[...] = dg.sum(axis=(0, 2))
        g.wx[...] = np.matmul(dg, inputs[place]).sum(axis=0).T
        d_in, place = np.matmul(w.wx, dg).transpose(1, 0, 2).astype(np.float64, order="C"), place.ravel()
        g_emb = np.stack([np.bincount(place, d.ravel(), len(rows)) for d in d_in], axis=1).astype(np.float32)
        scale = min(1.0, 20 / max(float(np.sqrt(rest @ rest + g_emb.ravel() @ g_emb.ravel())), 1e-9))
        step = moments[0] = moments[0] + 1
        _adam(w.flat[n_emb:], rest, moments[1][n_emb:], moments[2][n_emb:], scale, step, rate)
        # inputs: only the rows met, without the first moment; the second has faded since the row was met last
        g_emb *= np.float32(scale)
        v = second[rows]
        v *= (0.99 ** (step - moments[3][rows])).astype(np.float32)[:, None]
        v += np.float32(0.01) * g_emb * g_emb
        second[rows] = v
        v /= np.float32(1 - 0.99 ** step)
        np.sqrt(v, out=v)
        v += np.float32(1e-4)
        g_emb /= v
        g_emb *= np.float32(rate)
        w.emb[rows] -= g_emb
        moments[3][rows] = step
        h = h_next


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A random odd number for each byte: capitals have that of their small letters, white space has none."""
    out = np.random.default_rng(13).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    out[65:91] = out[97:123]
    out[[9, 10, 11, 12, 13, 32]] = 0
    return out


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of RADIX and of its inverse, modulo 2^64, for twice HASH_BYTES."""
    out = []
    for r in (RADIX, pow(RADIX, -1, 1 << 64)):
        p = np.full(2 * HASH_BYTES, r, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return tuple(out)


def _hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``raw``, at most twice HASH_BYTES, and the place where each begins. A word, that is bytes
    between ASCII white space with A-Z lowered, hashes to the sum of its bytes' values times powers of RADIX, which comes
    from running sums over all bytes."""
    b = np.frombuffer(raw, np.uint8)
    free = np.ones(len(b) + 2, bool)
    np.logical_or(b == 32, (b >= 9) & (b <= 13), out=free[1:-1])
    edges = np.flatnonzero(free[1:] != free[:-1])
    first, end = edges[::2], edges[1::2]
    power, inverse = _powers()
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_byte_values()[b] * power[:len(b)], out=sums[1:])
    return mix64((sums[end] - sums[first]) * inverse[first]), first


def _hash_long(raw: bytes) -> Iterator[np.ndarray]:
    """Hashes of the words of a text of any length, part by part; no part ends within a word."""
    space, at = re.compile(rb"[\t-\r ]"), 0
    while at < len(raw):
        found = space.search(raw, at + HASH_BYTES)
        end = found.start() if found else len(raw)
        part, at = raw[at:end], end
        if len(part) <= 2 * HASH_BYTES:
            yield _hash_words(part)[0]
            continue
        *before, word = part.rsplit(None, 1)  # a word longer than HASH_BYTES, and what stands before it
        total = 0
        for i in range(0, len(word), HASH_BYTES):
            b = np.frombuffer(word[i:i + HASH_BYTES], np.uint8)
            total += int((_byte_values()[b] * _powers()[0][:len(b)]).sum()) * pow(RADIX, i, 1 << 64)
        yield from (_hash_words(x)[0] for x in before)
        yield mix64(np.array([total % (1 << 64)], np.uint64))


def token_hashes(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the tokens of some texts after another, an end after each text, and the end of each text in them."""
    def flush() -> tuple[np.ndarray, np.ndarray]:
        h, first = _hash_words(b" ".join(held))
        ends = np.searchsorted(first, np.cumsum([len(x) + 1 for x in held])) + np.arange(1, len(held) + 1)
        out = np.full(len(h) + len(held), END)
        own = np.ones(len(out), bool)
        own[ends - 1] = False
        out[own] = h
        return out, ends

    held, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "replace") if text else b""
        if held and size + len(raw) > HASH_BYTES:
            yield flush()
            held, size = [], 0
        if len(raw) > HASH_BYTES:
            h = np.append(np.concatenate(list(_hash_long(raw))), END)
            yield h, np.array([len(h)])
            continue
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield flush()


class Coder:
    """Places of hashes in the head table, sorted by them: a hash's first bits tell where to look."""

    def __init__(self, hashes: np.ndarray):
        self.shift = np.uint64(64 - max(8, (8 * len(hashes)).bit_length()))
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))
        firsts = np.arange(1 << int(64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first, self.size = np.searchsorted(hashes, firsts).astype(np.int32), len(hashes)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes ``h``; -1: not there."""
        at = self.first[h >> self.shift]
        late = np.flatnonzero(self.hashes[at] < h)
        while len(late):
            at[late] += 1
            late = late[self.hashes[at[late]] < h[late]]
        at[(self.hashes[at] != h) | (at == self.size)] = -1
        return at


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0

    def flush() -> pd.DataFrame:
        words, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"word": words.view(np.int64), "c": n})

    for pdf in batches:
        for h, _ in token_hashes(pdf["text"]):
            held.append(h)
            size += len(h)
            if size >= 4_000_000:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                share: float = TRAIN_SHARE, rounds: int = ROUNDS, vocab: int | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row; learns from rows where ``learn`` holds."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = docs.where(learn & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = materialize(known.mapInPandas(_counts, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    # how many words have each count: the head is all words above the count that leaves at most HEAD
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("c", ascending=False)
    n_all, v_all = int((by_count["c"] * by_count["n"]).sum()), int(by_count["n"].sum())
    vocab = vocab or model_words(v_all)
    fits = by_count[by_count["n"].cumsum() <= max(HEAD, vocab)]
    least = int(fits["c"].min()) if len(fits) else 1 << 62
    top = counts.where(F.col("c") >= least).toPandas()
    hashes, c = top["word"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    order = np.argsort(hashes)
    hashes, c = hashes[order], c[order]
    # model words: 0 is the unknown word, 1 the end, then by frequency
    rank = [i for i in np.lexsort([hashes, -c])[:vocab].tolist() if hashes[i] != END][:vocab - 2]
    number = np.zeros(len(hashes), np.int32)
    number[rank] = np.arange(2, 2 + len(rank))
    number[hashes == END] = 1
    own = np.zeros(vocab, np.int64)
    own[number[number > 0]] = c[number > 0]
    own[0] = rest = n_all - int(own.sum())
    rest_words = v_all - int((number > 0).sum())
    shared = spark.sparkContext.broadcast((hashes, c, number))

    def rounds_of(weights_b, turn: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext
            task = TaskContext.get().partitionId()
            coder, number0 = Coder(shared.value[0]), np.append(shared.value[2], np.int32(0))
            w = Weights(vocab, weights_b.value.copy())
            moments, held, size, total = [0, np.zeros_like(w.flat), np.zeros_like(w.flat)], [], 0, 0
            for pdf in batches:
                for h, ends in token_hashes(pdf["text"]):
                    held += np.split(number0[coder(h)], ends[:-1])
                    size += len(h)
                if size >= GROUP_TOKENS // 4:
                    train_documents(w, held, 1, moments, 0.01 / (1 + turn))
                    held, size, total = [], 0, total + size
            if held:
                train_documents(w, held, 1, moments, 0.01 / (1 + turn))
                total += size
            if total:
                for i in range(0, len(w.flat), PART):
                    yield pd.DataFrame({"part": [i // PART], "task": [task], "tokens": [float(total)],
                                        "values": [w.flat[i:i + PART].tobytes()]})
        return run

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf["tokens"].to_numpy()
        total = sum(np.frombuffer(b, np.float32) * x for b, x in zip(pdf["values"], t)) / t.sum()
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "task": pdf["task"].iloc[:1], "tokens": [t.sum()],
                             "values": [total.astype(np.float32).tobytes()]})

    weights = Weights.start(own)
    for turn in range(rounds if len(hashes) else 0):
        lot = hash_share(F.col("doc_id"), 5)
        some = known.where((lot >= share * turn / rounds) & (lot < share * (turn + 1) / rounds)).select("text")
        fields = "part int, task int, tokens double, values binary"
        got = some.mapInPandas(rounds_of(spark.sparkContext.broadcast(weights.flat), turn), fields)
        tasks = some.rdd.getNumPartitions()
        while tasks > FAN_IN:
            got = (got.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
                   .groupBy("part", "task").applyInPandas(mean, fields))
            tasks = -(-tasks // FAN_IN)
        got = got.groupBy("part").applyInPandas(mean, fields).toPandas().sort_values("part")
        if len(got):
            weights = Weights(vocab, np.concatenate([np.frombuffer(b, np.float32) for b in got["values"]]))
    model = spark.sparkContext.broadcast(weights.flat)
    base_unit = np.log10(float(n_all + v_all + 1))
    rest_unit = np.log10(float(rest + rest_words + 1))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        (hashes_, c_, number_), w = shared.value, Weights(vocab, model.value)
        coder, row = Coder(hashes_), TaskContext.get().partitionId() << 40
        log_c = np.append(np.log10(c_ + 1.0), 0.0)  # the last place stands for words outside the head
        number0 = np.append(number_, np.int32(0))
        held, size = [], 0

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([x[:7] for x in held], columns=["row", "doc_id", "n_tokens", "n_known", "base_score", "rest", "tail"])
            out["score"] = score_documents(w, [x[7] for x in held], 1) + out.pop("rest")
            out["tail"] = [t[0].view(np.int64) for t in out["tail"]]
            out["times"] = [x[6][1] for x in held]
            return out[["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "tail", "times"]]

        for pdf in batches:
            ids = iter(pdf["doc_id"])
            for h, ends in token_hashes(pdf["text"]):
                at = coder(h)
                codes, logs = number0[at], log_c[at]
                for i, j in zip([0, *ends.tolist()], ends.tolist()):
                    own, log, known = codes[i:j], logs[i:j], at[i:j] >= 0
                    other = own == 0
                    tail = np.unique(h[i:j][~known], return_counts=True)
                    held.append((row, next(ids), j - i, int(known.sum()), float(log.sum() - (j - i) * base_unit),
                                 float(log[other].sum() - other.sum() * rest_unit), tail, own))
                    row += 1
                size += len(h)
            if size >= GROUP_TOKENS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    scored = materialize(base.mapInPandas(score, f"row long, doc_id {kind}, n_tokens long, n_known long, base_score double, "
                                                 "score double, tail array<long>, times array<long>"), "lm-scored")
    tail = (scored.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t"))
            .select("row", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
            .join(counts.where(F.col("c") < least).hint("merge"), "word")
            .groupBy("row").agg(F.sum("times").alias("k"), F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("g")))
    out = materialize(scored.drop("tail", "times").join(tail.hint("merge"), "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("g", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("g", F.lit(0.0))).alias("score")), "lm-result")
    release(counts, scored)
    return out
