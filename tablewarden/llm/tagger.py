"""Character-level bidirectional LSTM with a CRF on top, in numpy.

Texts are windows of character codes. Two LSTMs read a window in both directions, a linear
layer gives a score per label, and the CRF adds scores for the step from one label to the
next; steps that no sequence of spans can have are ruled out. Training follows the exact
gradient of the log likelihood, decoding is the Viterbi path.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

KINDS = ("email", "ip", "card", "phone")
# Label 0 is outside; each kind has one label for its first and one for its other characters.
LABELS = 1 + 2 * len(KINDS)
HIDDEN = 16
# Codes of characters: 0 pads, 1 is any other character, the rest printable ASCII in lower case.
CODES = 97


def encode(text: str, size: int) -> np.ndarray:
    raw = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)[:size].astype(np.int64)
    out = np.zeros(size, np.int64)
    out[: len(raw)] = np.where((raw >= 32) & (raw < 127), raw - 30, 1)
    return out


def _allowed() -> np.ndarray:
    """0 where one label may follow another, a large negative number elsewhere."""
    step = np.zeros((LABELS, LABELS))
    for inner in range(2, LABELS, 2):
        step[:, inner] = -1e4
        step[inner - 1, inner] = step[inner, inner] = 0
    return step


ALLOWED = _allowed()
BEGIN = np.array([-1e4 if n and n % 2 == 0 else 0.0 for n in range(LABELS)])


def init(seed: int = 17) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    weights: dict[str, np.ndarray] = {}
    for side in ("f", "b"):
        weights[f"x{side}"] = rng.normal(0, 0.3, (CODES, 4 * HIDDEN))
        weights[f"h{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        weights[f"x{side}"][:, HIDDEN : 2 * HIDDEN] += 1.0  # gates begin open
    weights["out"] = rng.normal(0, 0.2, (2 * HIDDEN, LABELS))
    weights["bias"] = np.zeros(LABELS)
    weights["step"] = np.zeros((LABELS, LABELS))
    return weights


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


def _read(codes: np.ndarray, wx: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (time, window, unit) of an LSTM, and what its gradient needs."""
    windows, size = codes.shape
    h = np.zeros((windows, HIDDEN), wx.dtype)
    c = np.zeros((windows, HIDDEN), wx.dtype)
    states = np.zeros((size, windows, HIDDEN), wx.dtype)
    kept = []
    for t in range(size):
        z = np.take(wx, codes[:, t], axis=0) + h @ wh
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = (gates[:, n * HIDDEN : (n + 1) * HIDDEN] for n in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, past = h, c
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        states[t] = h
        kept.append((i, f, o, g, before, past, squashed))
    return states, kept


def _read_back(codes: np.ndarray, wh: np.ndarray, kept: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of both weight tables, from those of the hidden states."""
    windows, size = codes.shape
    gx, gh = np.zeros((CODES, 4 * HIDDEN)), np.zeros_like(wh)
    dh, dc = np.zeros((windows, HIDDEN)), np.zeros((windows, HIDDEN))
    for t in range(size - 1, -1, -1):
        i, f, o, g, before, past, squashed = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        dz = np.concatenate(
            [dc * g * i * (1 - i), dc * past * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=1
        )
        np.add.at(gx, codes[:, t], dz)
        gh += before.T @ dz
        dh, dc = dz @ wh.T, dc * f
    return gx, gh


def emissions(weights: dict[str, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Scores (time, window, label)."""
    forward, _ = _read(codes, weights["xf"], weights["hf"])
    backward, _ = _read(codes[:, ::-1], weights["xb"], weights["hb"])
    both = np.concatenate([forward, backward[::-1]], axis=2)
    return both @ weights["out"] + weights["bias"]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    high = x.max(axis=axis, keepdims=True)
    return np.squeeze(high, axis) + np.log(np.exp(x - high).sum(axis=axis))


def loss_and_grads(weights: dict, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of the labels (window, time) and its gradient."""
    windows, size = codes.shape
    forward, kept_f = _read(codes, weights["xf"], weights["hf"])
    backward, kept_b = _read(codes[:, ::-1], weights["xb"], weights["hb"])
    both = np.concatenate([forward, backward[::-1]], axis=2)
    scores = both @ weights["out"] + weights["bias"]
    step = weights["step"] + ALLOWED
    alpha = np.zeros((size, windows, LABELS))
    beta = np.zeros((size, windows, LABELS))
    alpha[0] = scores[0] + BEGIN
    for t in range(1, size):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, :, None] + step, 1)
    for t in range(size - 2, -1, -1):
        beta[t] = _log_sum(step + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    whole = _log_sum(alpha[-1], 1)
    single = np.exp(alpha + beta - whole[None, :, None])
    pairs = np.zeros((LABELS, LABELS))
    for t in range(1, size):
        pair = alpha[t - 1][:, :, None] + step + (scores[t] + beta[t])[:, None, :] - whole[:, None, None]
        pairs += np.exp(pair).sum(axis=0)
    rows, times = np.arange(windows), np.arange(size)
    path = scores[times[:, None], rows, gold.T].sum(axis=0) + BEGIN[gold[:, 0]]
    path = path + step[gold[:, :-1], gold[:, 1:]].sum(axis=1)
    single[times[:, None], rows, gold.T] -= 1
    np.subtract.at(pairs, (gold[:, :-1], gold[:, 1:]), 1)
    d = single / windows
    dboth = d @ weights["out"].T
    grads = {"bias": d.sum(axis=(0, 1)), "step": pairs / windows}
    grads["out"] = np.tensordot(both, d, axes=([0, 1], [0, 1]))
    grads["xf"], grads["hf"] = _read_back(codes, weights["hf"], kept_f, dboth[:, :, :HIDDEN])
    grads["xb"], grads["hb"] = _read_back(codes[:, ::-1], weights["hb"], kept_b, dboth[::-1, :, HIDDEN:])
    return float((whole - path).mean()), grads


def train(codes: np.ndarray, gold: np.ndarray, rounds: int = 260, batch: int = 48, seed: int = 23) -> dict:
    """Adam on the log likelihood, with clipped gradients."""
    weights = init(seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(w) for k, w in weights.items()}
    second = {k: np.zeros_like(w) for k, w in weights.items()}
    for n in range(1, rounds + 1):
        rows = rng.integers(0, len(codes), batch)
        _, grads = loss_and_grads(weights, codes[rows], gold[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 2 * (1 - n / (rounds + 1)))
        for k, w in weights.items():
            g = grads[k] * min(1.0, 5.0 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            w -= rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)
    return {k: w.astype(np.float32) for k, w in weights.items()}


def viterbi(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best labels (window, time)."""
    size, windows, _ = scores.shape
    step = step + ALLOWED
    best = scores[0] + BEGIN
    origin = np.zeros((size, windows, LABELS), np.int8)
    for t in range(1, size):
        reach = best[:, :, None] + step
        origin[t] = reach.argmax(axis=1)
        best = reach.max(axis=1) + scores[t]
    labels = np.zeros((windows, size), np.int8)
    labels[:, -1] = best.argmax(axis=1)
    for t in range(size - 1, 0, -1):
        labels[:, t - 1] = origin[t][np.arange(windows), labels[:, t]]
    return labels


def decode(weights: dict, texts: Sequence[str], size: int, block: int = 512) -> np.ndarray:
    """Labels (window, time) of texts of at most ``size`` characters."""
    out = np.zeros((len(texts), size), np.int8)
    for at in range(0, len(texts), block):
        codes = np.stack([encode(t, size) for t in texts[at : at + block]])
        out[at : at + block] = viterbi(emissions(weights, codes), weights["step"])
    return out
