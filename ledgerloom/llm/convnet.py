"""A byte-level convolutional network in numpy: filters of several widths, max pooling, softmax.

The input is a window of bytes. Each byte has a learned vector; each filter sees ``width`` neighbouring bytes. Pooled
activations go through one dense layer to class scores. Training is plain mini-batch Adam on the driver over a bounded
sample; scoring reads, for every pair of neighbouring bytes, a table row that holds what the pair adds to each filter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Zero-padding symbol after a window's last byte.
PAD = 0


@dataclass
class Net:
    """Weights: embed (256, e); per width w, filters (w, e, f) and biases (f); dense (sum f, classes) and its bias."""

    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.biases, self.dense, self.bias]


def fresh(classes: int, widths: tuple[int, ...], filters: int, embed: int, seed: int) -> Net:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return Net(
        normal(256, embed, scale=0.5),
        [normal(w, embed, filters, scale=(w * embed) ** -0.5) for w in widths],
        [np.zeros(filters, np.float32) for _ in widths],
        normal(len(widths) * filters, classes, scale=0.1),
        np.zeros(classes, np.float32),
    )


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(net: Net, x: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of windows ``x`` (n, length) against class shares ``wanted``, and its gradients."""
    n, length = x.shape
    seen = net.embed[x]
    pooled, peaks = [], []
    for f, b in zip(net.filters, net.biases, strict=True):
        w, e, k = f.shape
        places = length - w + 1
        views = np.lib.stride_tricks.sliding_window_view(seen, w, axis=1).transpose(0, 1, 3, 2)
        active = views.reshape(n * places, w * e) @ f.reshape(w * e, k)
        active = active.reshape(n, places, k)
        peak = active.argmax(axis=1)
        top = np.take_along_axis(active, peak[:, None, :], axis=1)[:, 0, :] + b
        pooled.append(np.maximum(top, 0))
        peaks.append(peak)
    features = np.concatenate(pooled, axis=1)
    shares = softmax(features @ net.dense + net.bias)
    loss = -float((wanted * np.log(shares + 1e-9)).sum() / n)
    slope = (shares - wanted) / n
    d_dense, d_bias = features.T @ slope, slope.sum(axis=0)
    d_features = slope @ net.dense.T
    d_embed = np.zeros_like(net.embed)
    d_filters, d_biases, at = [], [], 0
    for f, top, peak in zip(net.filters, pooled, peaks, strict=True):
        w, e, k = f.shape
        d = d_features[:, at : at + k] * (top > 0)
        at += k
        # only the byte run under each maximum gets a gradient
        runs = x[np.arange(n)[:, None, None], peak[:, :, None] + np.arange(w)]
        vectors = net.embed[runs]
        d_filters.append(np.einsum("nk,nkwe->wek", d, vectors, optimize=True).astype(np.float32))
        d_biases.append(d.sum(axis=0))
        back = np.einsum("nk,wek->nkwe", d, f, optimize=True)
        np.add.at(d_embed, runs.ravel(), back.reshape(-1, e))
    return loss, [d_embed, *d_filters, *d_biases, d_dense.astype(np.float32), d_bias.astype(np.float32)]


def train(
    x: np.ndarray, wanted: np.ndarray, widths: tuple[int, ...] = (2, 4, 6), filters: int = 16, embed: int = 8,
    epochs: int = 6, steps: int = 0, batch: int = 64, rate: float = 0.01, seed: int = 1,
) -> Net:
    """Fit a network to windows ``x`` (n, length) of bytes and class shares ``wanted`` (n, classes).

    At least ``epochs`` passes, and ``steps`` mini-batches where the sample is small.
    """
    epochs = max(epochs, -(-steps * batch // len(x)))
    net = fresh(wanted.shape[1], widths, filters, embed, seed)
    rng = np.random.default_rng(seed)
    weights = net.parameters()
    first = [np.zeros_like(p) for p in weights]
    second = [np.zeros_like(p) for p in weights]
    step = 0
    planned = epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            step += 1
            pick = order[a : a + batch]
            _, slopes = gradients(net, x[pick], wanted[pick])
            now = rate * (1 - step / (planned + 1))
            for p, g, m, v in zip(weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


class Scorer:
    """Class scores of many windows of equal length, by tables over pairs of bytes."""

    def __init__(self, net: Net):
        self.net, self.tables = net, []
        for f in net.filters:
            per_byte = np.einsum("be,wek->wbk", net.embed, f, optimize=True).astype(np.float32)
            pairs = [
                (per_byte[k][:, None, :] + per_byte[k + 1][None, :, :]).reshape(65536, -1)
                for k in range(0, len(per_byte) - 1, 2)
            ]
            single = per_byte[-1] if len(per_byte) % 2 else None
            self.tables.append((len(per_byte), pairs, single))

    def features(self, x: np.ndarray) -> np.ndarray:
        """Pooled activations of windows ``x`` (n, length) of bytes."""
        length = x.shape[1]
        # one row per place, so that pooling takes the maximum of whole rows
        by_place = np.ascontiguousarray(x.T).astype(np.intp)
        two = by_place[:-1] * 256 + by_place[1:]
        out = []
        for (w, pairs, single), b in zip(self.tables, self.net.biases, strict=True):
            places = length - w + 1
            total = None
            for k, table in enumerate(pairs):
                part = table.take(two[2 * k : 2 * k + places], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            if single is not None:
                part = single.take(by_place[w - 1 : w - 1 + places], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            out.append(np.maximum(total.max(axis=0) + b, 0))
        return np.concatenate(out, axis=1)

    def shares(self, x: np.ndarray, at_once: int = 64) -> np.ndarray:
        """Class shares of windows, a bounded number at a time."""
        parts = [
            softmax(self.features(x[a : a + at_once]) @ self.net.dense + self.net.bias)
            for a in range(0, len(x), at_once)
        ]
        return np.concatenate(parts) if parts else np.empty((0, len(self.net.bias)), np.float32)


def cut(buf: np.ndarray, offsets: np.ndarray, length: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over whole texts, a new one each ``step`` bytes: (text index, start, used bytes).

    The last window of a text may be partly filled; the next text's bytes after it are masked by ``gather``.
    """
    sizes = np.diff(offsets)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - length) // step)), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[text] + turn * step
    return text, start, np.minimum(length, offsets[text + 1] - start)


def gather(buf: np.ndarray, start: np.ndarray, used: np.ndarray, length: int) -> np.ndarray:
    """The bytes of windows as (n, length), zero after their used part."""
    padded = np.concatenate([buf, np.zeros(length, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(padded, length)[start]
    x[np.arange(length)[None, :] >= used[:, None]] = PAD
    return x


def averaged(values: np.ndarray, text: np.ndarray, used: np.ndarray, n: int) -> np.ndarray:
    """Mean of window values (windows, k) per text, weighted by used bytes; zero for a text without windows."""
    total = np.bincount(text, used, n)
    out = np.stack([np.bincount(text, values[:, k] * used, n) for k in range(values.shape[1])], axis=1)
    return out / np.maximum(total, 1)[:, None]


def pieces(texts: list[bytes], labels: list[int], classes: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Training windows cut from pieces of text, with the class shares of their labels."""
    x, y = [], []
    for raw, label in zip(texts, labels, strict=True):
        for a in range(0, max(1, len(raw) - length // 4), length):
            part = raw[a : a + length]
            x.append(np.frombuffer(part + bytes(length - len(part)), np.uint8))
            y.append(label)
    return np.array(x), np.eye(classes, dtype=np.float32)[y]
