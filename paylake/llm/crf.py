"""A linear-chain conditional random field with two labels over the lines of a document, in numpy.

Label 1 is good. A line's emission is the difference of the two labels' scores, linear in its own features and in those
of its neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: ASCII characters counted by class.
_SYMBOLS, _UPPER, _DIGITS, _ENDS = b"#*$%&|<>{}[]~^=_\\", bytes(range(65, 91)), bytes(range(48, 58)), (".", "!", "?", ":", ";")
FEATURES = ("words", "word_length", "distinct", "stutter", "symbols", "bars", "capitals", "shouted", "exclaimed", "digits",
            "alphabetic", "ended", "repeated", "short", "links")
LEARNING_RATE, STEPS, RIDGE = 0.1, 120, 1e-3


def lines_of(text: str) -> list[str]:
    """Lines that hold more than white space."""
    return [x for x in text.split("\n") if not x.isspace() and x]


def line_features(lines: list[str]) -> np.ndarray:
    """One row per line; all features lie between 0 and about 1."""
    out, seen = np.empty((len(lines), len(FEATURES))), set()
    for row, line in zip(out, lines):
        words, raw = line.split(), line.encode("utf-8", "replace")
        n, size = max(1, len(words)), len(raw)
        less = lambda which: (size - len(raw.translate(None, which))) / size
        row[:] = (
            min(1.0, np.log1p(len(words)) / 7), min(1.0, len(line) / n / 20), len(set(words)) / n,
            sum(map(str.__eq__, words, words[1:])) / n, less(_SYMBOLS), min(1.0, line.count("|") / n), less(_UPPER),
            sum(map(str.isupper, words)) / n, min(1.0, line.count("!") / n), less(_DIGITS),
            sum(map(str.isalpha, words)) / n, line.rstrip().endswith(_ENDS), line in seen, len(words) < 5,
            "http" in line or "www." in line or "@" in line)
        seen.add(line)
    return out


def with_neighbours(features: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Own, previous and next features and a bias; starts are the first lines of the documents."""
    n, d = features.shape
    out = np.zeros((n, 3 * d + 3))
    out[:, :d], out[:, -1] = features, 1
    if n:
        first = np.zeros(n, bool)
        first[starts[starts < n]] = True
        last = np.append(first[1:], True)
        out[1:, d:2 * d], out[:-1, 2 * d:3 * d] = features[:-1], features[1:]
        out[first, d:2 * d], out[last, 2 * d:3 * d] = 0, 0
        out[first, -3], out[last, -2] = 1, 1
    return out


@dataclass
class Model:
    weights: np.ndarray       # of with_neighbours() features
    transitions: np.ndarray   # scores of label pairs, [previous, next]

    def marginals(self, emissions: np.ndarray) -> np.ndarray:
        """P(good) of each line of one document, by the forward-backward algorithm."""
        n = len(emissions)
        (bb, bg), (gb, gg) = np.exp(self.transitions).tolist()
        good = np.exp(np.minimum(emissions, 0)).tolist()    # scaled so that the larger label has weight 1
        bad = np.exp(np.minimum(-emissions, 0)).tolist()
        ahead, a, b = [], 1.0, 1.0
        for t in range(n):
            x, y = (a, b) if not t else (a * bb + b * gb, a * bg + b * gg)
            x, y = x * bad[t], y * good[t]
            a, b = x / (x + y), y / (x + y)
            ahead.append((a, b))
        out, p, q = [0.0] * n, 1.0, 1.0
        for t in range(n - 1, -1, -1):
            a, b = ahead[t]
            out[t] = b * q / (a * p + b * q)
            x, y = bad[t] * p, good[t] * q
            p, q = bb * x + bg * y, gb * x + gg * y
            total = p + q
            p, q = p / total, q / total
        return np.array(out)


def fit(features: list[np.ndarray], labels: list[int]) -> Model:
    """Maximises the likelihood of label sequences in which every line of a segment has its document's label."""
    width = 3 * len(FEATURES) + 3
    if not features or len(set(labels)) < 2:
        return Model(np.zeros(width), np.zeros((2, 2)))
    longest, count = max(map(len, features)), len(features)
    x, mask = np.zeros((count, longest, width)), np.zeros((count, longest), bool)
    for i, f in enumerate(features):
        x[i, :len(f)], mask[i, :len(f)] = with_neighbours(f, np.zeros(1, int)), True
    y = np.repeat(np.array(labels, float)[:, None], longest, 1) * mask
    lengths = mask.sum(1)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (np.array(labels), np.array(labels)), lengths - 1)
    total = lengths.sum()
    flat, flat_mask = x.reshape(-1, width), mask.ravel()
    parameters = np.zeros(width + 4)
    moment, spread = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, trans = parameters[:width], parameters[width:].reshape(2, 2)
        scores = np.zeros((count, longest, 2))
        scores[..., 1] = (flat @ weights).reshape(count, longest)
        node, edge = _expected(scores, trans, mask)
        gradient = np.concatenate([
            flat[flat_mask].T @ (y.ravel() - node.ravel())[flat_mask], (pairs - edge).ravel()]) / total - RIDGE * parameters
        moment = 0.9 * moment + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient ** 2
        parameters = parameters + LEARNING_RATE * (moment / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-8)
    return Model(parameters[:width].copy(), parameters[width:].reshape(2, 2).copy())


def _expected(scores: np.ndarray, trans: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line and the expected number of label pairs, over all segments at once."""
    count, longest, _ = scores.shape
    psi, move = np.exp(scores - scores.max(-1, keepdims=True)), np.exp(trans - trans.max())
    forward, backward = np.zeros((count, longest, 2)), np.ones((count, longest, 2))
    for t in range(longest):
        a = psi[:, t] * (forward[:, t - 1] @ move if t else 1.0)
        forward[:, t] = a / a.sum(-1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        b = (psi[:, t + 1] * backward[:, t + 1]) @ move.T
        backward[:, t] = np.where(mask[:, t + 1, None], b / b.sum(-1, keepdims=True), 1.0)
    node = forward * backward
    node /= node.sum(-1, keepdims=True)
    edge = np.zeros((2, 2))
    for t in range(longest - 1):
        joint = forward[:, t, :, None] * move * (psi[:, t + 1] * backward[:, t + 1])[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        edge += joint[mask[:, t + 1]].sum(0)
    return node[..., 1] * mask, edge
