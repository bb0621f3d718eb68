"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALPHABET = 129  # ASCII, and one number for every other character
PAD = ALPHABET


@dataclass(frozen=True)
class Shape:
    window: int = 96
    stride: int = 48
    embedding: int = 12
    hidden: int = 16
    tags: int = 9


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def random_weights(shape: Shape, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    e, h, k = shape.embedding, shape.hidden, shape.tags
    out = {
        "embed": rng.standard_normal((ALPHABET + 1, e)) * 0.3,
        "emit": rng.standard_normal((2 * h, k)) * 0.3,
        "emit_bias": np.zeros(k),
        "move": np.zeros((k, k)),
        "begin": np.zeros(k),
    }
    for side in "fb":
        out["in_" + side] = rng.standard_normal((e, 4 * h)) * 0.3
        out["bias_" + side] = np.concatenate([np.ones(h), np.zeros(3 * h)])
        out["state_" + side] = rng.standard_normal((h, 4 * h)) * 0.2
    return {name: w.astype(np.float32) for name, w in out.items()}


def _states(w, shape: Shape, chars: np.ndarray, mask: np.ndarray, keep: bool):
    """States of both directions, step by step; `chars` and `mask` are steps x windows."""
    h, (steps, batch) = shape.hidden, chars.shape
    states = np.zeros((steps, batch, 2 * h), dtype=np.float32)
    caches = {}
    for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        gates = w["embed"] @ w["in_" + side] + w["bias_" + side]
        out = cell = np.zeros((batch, h), dtype=np.float32)
        column = slice(0, h) if side == "f" else slice(h, 2 * h)
        for t in order:
            a = gates[chars[t]] + out @ w["state_" + side]
            forget, take, show = np.split(_sigmoid(a[:, : 3 * h]), 3, axis=1)
            new = np.tanh(a[:, 3 * h :])
            cell_next = forget * cell + take * new
            squashed = np.tanh(cell_next)
            on = mask[t][:, None]
            if keep:
                caches[side, t] = (forget, take, show, new, cell, out, squashed, on)
            cell = np.where(on, cell_next, cell)
            out = np.where(on, show * squashed, out)
            states[t][:, column] = out
    return states, caches


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _log_product(x, weights):
    """log(exp(x) @ weights), row by row."""
    top = x.max(axis=1, keepdims=True)
    return np.log(np.exp(x - top) @ weights) + top


def loss_and_gradients(w, shape: Shape, chars, mask, tags):
    """Mean negative log likelihood of the tags; arrays are steps x windows."""
    h, (steps, batch) = shape.hidden, chars.shape
    states, caches = _states(w, shape, chars, mask, keep=True)
    scores = states @ w["emit"] + w["emit_bias"]
    moves = np.exp(w["move"])
    forward = np.empty_like(scores)
    forward[0] = w["begin"] + scores[0]
    for t in range(1, steps):
        step = _log_product(forward[t - 1], moves) + scores[t]
        forward[t] = np.where(mask[t][:, None], step, forward[t - 1])
    backward = np.zeros_like(scores)
    for t in range(steps - 2, -1, -1):
        step = _log_product(scores[t + 1] + backward[t + 1], moves.T)
        backward[t] = np.where(mask[t + 1][:, None], step, backward[t + 1])
    total = _log_sum(forward[-1], 1)
    at = np.arange(batch)
    gold = w["begin"][tags[0]] + scores[0, at, tags[0]]
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    d_scores = np.exp(forward + backward - total[None, :, None]) * mask[:, :, None]
    grad["begin"] += d_scores[0].sum(axis=0)
    np.add.at(grad["begin"], tags[0], -1)
    on = mask[1:].astype(np.float32)
    here, before = tags[1:], tags[:-1]
    own = np.take_along_axis(scores[1:], here[:, :, None], 2)[:, :, 0]
    gold += (on * (w["move"][before, here] + own)).sum(axis=0)
    top = forward[:-1].max(axis=2, keepdims=True)
    left = np.exp(forward[:-1] - top) * on[:, :, None]
    # off steps are nothing on the left; their right side may be too large
    right = np.exp(np.where(mask[1:, :, None], scores[1:] + backward[1:] + top - total[:, None], 0))
    k = shape.tags
    grad["move"] += moves * (left.reshape(-1, k).T @ right.reshape(-1, k))
    np.add.at(grad["move"], (before, here), -on)
    d_scores[np.arange(steps)[:, None], at[None, :], tags] -= mask
    d_scores = (d_scores / batch).astype(np.float32)
    grad["move"] /= batch
    grad["begin"] /= batch
    grad["emit"] = np.einsum("tbs,tbk->sk", states, d_scores)
    grad["emit_bias"] = d_scores.sum(axis=(0, 1))
    d_states = d_scores @ w["emit"].T
    by_char = np.argsort(chars, axis=None, kind="stable")
    present, runs = np.unique(chars.reshape(-1)[by_char], return_index=True)
    for side, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
        column = slice(0, h) if side == "f" else slice(h, 2 * h)
        recur = w["state_" + side]
        d_gate = np.zeros((ALPHABET + 1, 4 * h), dtype=np.float32)
        d_steps = np.empty((steps, batch, 4 * h), dtype=np.float32)
        d_out = d_cell = np.zeros((batch, h), dtype=np.float32)
        for t in order:
            forget, take, show, new, cell, out, squashed, on = caches[side, t]
            total_out = d_out + d_states[t][:, column]
            d = total_out * on
            d_c = d * show * (1 - squashed * squashed) + d_cell * on
            d_a = np.concatenate(
                [
                    d_c * cell * forget * (1 - forget),
                    d_c * new * take * (1 - take),
                    d * squashed * show * (1 - show),
                    d_c * take * (1 - new * new),
                ],
                axis=1,
            )
            grad["state_" + side] += out.T @ d_a
            d_steps[t] = d_a
            d_out = d_a @ recur.T + total_out * ~on
            d_cell = d_c * forget + d_cell * ~on
        d_gate[present] = np.add.reduceat(d_steps.reshape(-1, 4 * h)[by_char], runs)
        grad["in_" + side] = w["embed"].T @ d_gate
        grad["bias_" + side] = d_gate.sum(axis=0)
        grad["embed"] += d_gate @ w["in_" + side].T
    return float((total - gold).mean()), grad


def decode(w, shape: Shape, chars: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The likeliest tags of each window (Viterbi); arrays are windows x steps."""
    chars, mask = chars.T, mask.T
    steps, batch = chars.shape
    states, _ = _states(w, shape, chars, mask, keep=False)
    scores = states @ w["emit"] + w["emit_bias"]
    best = w["begin"] + scores[0]
    came = np.zeros((steps, batch, shape.tags), dtype=np.int8)
    stay = np.arange(shape.tags, dtype=np.int8)
    for t in range(1, steps):
        paths = best[:, :, None] + w["move"]
        came[t] = np.where(mask[t][:, None], paths.argmax(axis=1), stay)
        best = np.where(mask[t][:, None], paths.max(axis=1) + scores[t], best)
    out = np.empty((steps, batch), dtype=np.int8)
    out[-1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = came[t][np.arange(batch), out[t]]
    return np.where(mask, out, 0).T


def train(chars, mask, tags, shape: Shape, epochs: int = 8, batch: int = 64, seed: int = 11):
    """Weights fitted to windows (windows x steps) and their tags, by Adam."""
    w = random_weights(shape, seed)
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - 0.9 * epoch / epochs)
        order = rng.permutation(len(chars))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            _, grad = loss_and_gradients(w, shape, chars[pick].T, mask[pick].T, tags[pick].T)
            step += 1
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                scale = rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                w[k] -= (scale * mean[k] / (np.sqrt(square[k]) + 1e-6)).astype(np.float32)
    return w
