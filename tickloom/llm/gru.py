"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as an embedding of the word (if the training sample has it) beside
the mean embedding of its character n-grams. Both directions read a window of
words; attention weighs their states, and the pooled state gives one number.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from tickloom.llm import grams

GRAM_SIZES = (3, 4, 5)
WINDOWS_AT_ONCE = 8_192
WORDS_AT_ONCE = 20_000
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Shape:
    window: int = 64
    stride: int = 32
    word_dim: int = 8
    gram_dim: int = 8
    hidden: int = 8
    attention: int = 8
    vocabulary: int = 20_000
    gram_buckets: int = 1 << 15


def ngrams(raw: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int):
    """Bucket of every character n-gram of each word, and their number per word.

    Bytes stand for characters; a mark on either side counts as one.
    """
    sizes = end - start
    padded = sizes + 2
    ends = np.cumsum(padded)
    text = np.full(int(padded.sum()), 2, dtype=np.uint64)
    inner = grams.ranges(sizes)
    text[np.repeat(ends - padded + 1, sizes) + inner] = raw[np.repeat(start, sizes) + inner]
    out, counts = [], np.zeros(len(start), dtype=np.int64)
    owner = []
    for n in GRAM_SIZES:
        have = np.maximum(padded - n + 1, 0)
        at = np.repeat(ends - padded, have) + grams.ranges(have)
        key = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            key = key * np.uint64(0x100000001B3) + text[at + k]
        out.append((grams.mix(key) % np.uint64(buckets)).astype(np.int32))
        owner.append(np.repeat(np.arange(len(start), dtype=np.int32), have))
        counts += have
    order = np.argsort(np.concatenate(owner), kind="stable")
    return np.concatenate(out)[order], counts


class Text:
    """Words of a run of texts, as indices of its distinct words, and its windows."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, shape: Shape):
        raw = grams.lower_ascii(raw)
        words = grams.Words(raw, offsets, SEPARATORS)
        self.counts = words.counts
        if len(words.start):
            self.hash, first, self.word = np.unique(
                words.hash, return_index=True, return_inverse=True
            )
        else:
            self.hash, self.word = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            first = self.word
        self.grams, self.gram_counts = ngrams(
            raw, words.start[first], words.end[first], shape.gram_buckets
        )
        # windows begin at every stride; the last one reaches the end of its text
        per = np.maximum(-(-(self.counts - shape.window) // shape.stride), 0) + 1
        self.owner = np.repeat(np.arange(len(per)), per)
        begin = grams.ranges(per) * shape.stride
        length = np.minimum(self.counts[self.owner] - begin, shape.window)
        self.mask = np.arange(shape.window) < length[:, None]
        self.windows = np.full(self.mask.shape, len(self.hash), dtype=np.int32)  # padding
        at = np.repeat(words.offsets[:-1][self.owner] + begin, length) + grams.ranges(length)
        self.windows[self.mask] = self.word[at]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    shape: Shape
    known: np.ndarray  # sorted hashes of the words that have an embedding
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def random(cls, shape: Shape, known: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        x, h = shape.word_dim + shape.gram_dim, shape.hidden

        def normal(*size, scale):
            return (rng.standard_normal(size) * scale).astype(np.float32)

        weights = {
            "word": normal(len(known) + 1, shape.word_dim, scale=0.02),
            "gram": normal(shape.gram_buckets, shape.gram_dim, scale=0.02),
            "attend": normal(2 * h, shape.attention, scale=0.3),
            "attend_bias": np.zeros(shape.attention, np.float32),
            "query": normal(shape.attention, scale=0.3),
            "out": normal(2 * h, scale=0.3),
            "out_bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            weights["in_" + side] = normal(x, 3 * h, scale=0.4)
            weights["bias_" + side] = np.zeros(3 * h, np.float32)
            weights["state_" + side] = normal(h, 3 * h, scale=0.3)
        return cls(shape, known, weights)

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each word's embedding; the last row is for unknown words."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, len(self.known))

    def inputs(self, hashes: np.ndarray, gram: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Input vector of each distinct word."""
        w = self.weights
        mean = np.zeros((len(counts), self.shape.gram_dim), dtype=np.float32)
        ends = np.cumsum(counts)  # every word has n-grams, as its marks count
        for a in range(0, len(counts), WORDS_AT_ONCE):
            some = slice(a, a + WORDS_AT_ONCE)
            begin = ends[a] - counts[a]
            own = w["gram"][gram[begin : ends[some][-1]]]
            mean[some] = np.add.reduceat(own, ends[some] - counts[some] - begin, axis=0)
            mean[some] /= counts[some, None].astype(np.float32)
        return np.concatenate([w["word"][self.word_rows(hashes)], mean], axis=1)

    def logits(self, text: Text) -> np.ndarray:
        """One number per window of `text`."""
        w, h = self.weights, self.shape.hidden
        x = self.inputs(text.hash, text.grams, text.gram_counts)
        gates = {}
        for side in "fb":
            own = x @ w["in_" + side] + w["bias_" + side]
            gates[side] = np.concatenate([own, np.zeros((1, 3 * h), np.float32)])
            gates[side][-1, :h] = 30  # padding keeps the state
        out = np.empty(len(text.windows), dtype=np.float32)
        for a in range(0, len(out), WINDOWS_AT_ONCE):
            some = slice(a, a + WINDOWS_AT_ONCE)
            mask = text.mask[some].T
            mask = mask[: max(int(mask.any(axis=1).sum()), 1)]
            steps = np.ascontiguousarray(text.windows[some].T)
            states = np.empty((*mask.shape, 2 * h), dtype=np.float32)
            for side, order in (("f", range(len(mask))), ("b", range(len(mask) - 1, -1, -1))):
                state = np.zeros((mask.shape[1], h), dtype=np.float32)
                column = slice(0, h) if side == "f" else slice(h, 2 * h)
                for t in order:
                    state, _ = _step(gates[side][steps[t]], state, w["state_" + side], h)
                    states[t][:, column] = state
            out[some] = self.pool(states, mask)[0]
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray):
        w = self.weights
        tilt = np.tanh(states @ w["attend"] + w["attend_bias"])
        energy = np.where(mask, tilt @ w["query"], -30)
        share = np.exp(energy - energy.max(axis=0))
        share = share / share.sum(axis=0)
        pooled = (share[:, :, None] * states).sum(axis=0)
        return pooled @ w["out"] + w["out_bias"][0], (tilt, share, pooled)

    def scores(self, text: Text) -> np.ndarray:
        """For each text, the largest probability of its windows."""
        out = np.zeros(len(text.counts))
        np.maximum.at(out, text.owner, _sigmoid(self.logits(text)))
        return out


def _step(gate: np.ndarray, state: np.ndarray, recur: np.ndarray, h: int):
    inner = state @ recur
    open_ = 1 / (1 + np.exp(-np.clip(gate[:, : 2 * h] + inner[:, : 2 * h], -30, 30)))
    keep, reset = open_[:, :h], open_[:, h:]
    new = np.tanh(gate[:, 2 * h :] + reset * inner[:, 2 * h :])
    return new + keep * (state - new), (keep, reset, new, inner[:, 2 * h :], state)


def gradients(net: Network, text: Text, pick: np.ndarray, target: np.ndarray):
    """Loss and gradients over the windows `pick` of `text`."""
    w, h = net.weights, net.shape.hidden
    windows, mask = text.windows[pick], text.mask[pick].T
    distinct, place = np.unique(windows, return_inverse=True)
    place = place.reshape(windows.shape).T
    distinct = distinct[distinct < len(text.hash)]  # padding comes last
    counts = text.gram_counts[distinct]
    at = np.repeat((np.cumsum(text.gram_counts) - text.gram_counts)[distinct], counts)
    gram = text.grams[at + grams.ranges(counts)]
    rows = net.word_rows(text.hash[distinct])
    x = net.inputs(text.hash[distinct], gram, counts)
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    place = np.minimum(place, len(distinct))
    steps, batch = mask.shape
    states = np.zeros((steps, batch, 2 * h), dtype=np.float32)
    caches = {}
    for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        gates = x @ w["in_" + side] + w["bias_" + side]
        state = np.zeros((batch, h), dtype=np.float32)
        column = slice(0, h) if side == "f" else slice(h, 2 * h)
        for t in order:
            new, cache = _step(gates[place[t]], state, w["state_" + side], h)
            state = np.where(mask[t][:, None], new, state)
            states[t][:, column] = state
            caches[side, t] = cache
    logit, (tilt, share, pooled) = net.pool(states, mask)
    chance = _sigmoid(logit)
    loss = -np.log(np.where(target > 0, chance, 1 - chance) + 1e-9).mean()

    grad = {k: np.zeros_like(v) for k, v in w.items() if k not in ("word", "gram")}
    d_logit = ((chance - target) / batch).astype(np.float32)
    grad["out"] = pooled.T @ d_logit
    grad["out_bias"] = d_logit.sum(keepdims=True)
    d_pooled = d_logit[:, None] * w["out"]
    d_states = share[:, :, None] * d_pooled
    d_share = (states * d_pooled).sum(axis=2)
    d_energy = share * (d_share - (share * d_share).sum(axis=0))
    d_energy = np.where(mask, d_energy, 0).astype(np.float32)
    grad["query"] = np.einsum("tba,tb->a", tilt, d_energy)
    d_tilt = d_energy[:, :, None] * w["query"] * (1 - tilt * tilt)
    grad["attend"] = np.einsum("tbs,tba->sa", states, d_tilt)
    grad["attend_bias"] = d_tilt.sum(axis=(0, 1))
    d_states = d_states + d_tilt @ w["attend"].T
    d_x = np.zeros_like(x)
    for side, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
        column = slice(0, h) if side == "f" else slice(h, 2 * h)
        recur = w["state_" + side]
        carry = np.zeros((batch, h), dtype=np.float32)
        d_gates = np.zeros((len(x), 3 * h), dtype=np.float32)
        d_steps = np.empty((steps, batch, 3 * h), dtype=np.float32)
        for t in order:
            keep, reset, new, inner, state = caches[side, t]
            total = carry + d_states[t][:, column]
            on = mask[t][:, None]
            d = total * on
            d_new = d * (1 - keep) * (1 - new * new)
            d_keep = d * (state - new) * keep * (1 - keep)
            d_reset = d_new * inner * reset * (1 - reset)
            d_inner = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
            grad["state_" + side] += state.T @ d_inner
            carry = d * keep + d_inner @ recur.T + total * ~on
            d_steps[t] = np.concatenate([d_keep, d_reset, d_new], axis=1)
        flat = place.ravel()
        for c in range(3 * h):
            d_gates[:, c] = np.bincount(flat, d_steps[:, :, c].ravel(), len(x))
        grad["bias_" + side] = d_gates.sum(axis=0)
        grad["in_" + side] = x.T @ d_gates
        d_x += d_gates @ w["in_" + side].T
    d_x = d_x[: len(distinct)]
    split = net.shape.word_dim
    grad["word"] = _scatter(rows, d_x[:, :split], len(w["word"]))
    spread = np.repeat(d_x[:, split:] / np.maximum(counts, 1)[:, None], counts, axis=0)
    grad["gram"] = _scatter(gram, spread, len(w["gram"]))
    return loss, grad


def _scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, v, n) for v in values.T], axis=1).astype(np.float32)


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.step = rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, weights: dict[str, np.ndarray], grad: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grad.items():
            g = np.clip(g, -1, 1)
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            weights[k] -= (scale * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)).astype(
                np.float32
            )


def train(
    text: Text,
    labels: np.ndarray,
    shape: Shape,
    epochs: int = 10,
    steps: int = 24,
    rate: float = 0.01,
    seed: int = 7,
) -> Network:
    """Fit on labelled texts; a label holds for some window of a text, not for all.

    A text labelled 1 is represented by its highest window (by all of them in the
    first two epochs), texts labelled 0 by the windows that are hardest so far and
    some others.
    """
    rng = np.random.default_rng(seed)
    values, counts = np.unique(text.word, return_counts=True)
    often = values[np.argsort(-counts, kind="stable")][: shape.vocabulary]
    often = often[np.isin(often, values[counts > 1])]
    net = Network.random(shape, np.sort(text.hash[often]), seed)
    adam = Adam(net.weights, rate)
    window_label = labels[text.owner]
    positive = np.flatnonzero(window_label == 1)
    negative = np.flatnonzero(window_label == 0)
    for epoch in range(epochs):
        logit = net.logits(text)
        if epoch < 2:
            some = rng.permutation(positive)[:3_000]
        else:
            order = positive[np.lexsort((-logit[positive], text.owner[positive]))]
            some = order[np.append(True, np.diff(text.owner[order]) > 0)]
        hard = negative[np.argsort(-logit[negative], kind="stable")][: 2 * len(some)]
        other = rng.permutation(negative)[: 2 * len(some)]
        pick = rng.permutation(np.concatenate([some, hard, other]))
        batch = min(128, max(8, len(pick) // steps))
        for a in range(0, len(pick), batch):
            chosen = pick[a : a + batch]
            _, grad = gradients(net, text, chosen, window_label[chosen].astype(np.float32))
            adam.update(net.weights, grad)
        adam.rate = rate * (1 - (epoch + 1) / epochs * 0.9)
    return net
