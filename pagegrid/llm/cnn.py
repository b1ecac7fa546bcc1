"""Byte-level convolutional networks in numpy: training on a sample, scoring of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pagegrid.llm.textwords import Block, blocks

#: Windows that go through the filters at once.
BATCH = 64


@dataclass
class Shape:
    """window, step: bytes of a window and from one to the next; widths: of the filters, `filters` of each."""

    window: int = 512
    step: int = 480
    embedding: int = 8
    widths: tuple[int, ...] = (3, 5, 8)
    filters: int = 16
    stride: int = 1

    @property
    def span(self) -> int:
        return max(self.widths)

    @property
    def channels(self) -> int:
        return self.filters * len(self.widths)


def windows(block: Block, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a block's texts, zero-filled at their ends, and how many each text has.

    They overlap and cover every byte; an empty text has one window of zeros.
    """
    size = np.diff(block.offsets)
    count = np.maximum(1, -(-(size - (shape.window - shape.step)) // shape.step))
    data = np.concatenate([block.data, np.zeros(shape.window, np.uint8)])
    begin = np.cumsum(count) - count
    nth = np.arange(count.sum()) - np.repeat(begin, count)
    start = np.repeat(block.offsets[:-1], count) + shape.step * nth
    out = np.lib.stride_tricks.sliding_window_view(data, shape.window)[start]
    left = np.repeat(block.offsets[1:], count) - start
    short = np.flatnonzero(left < shape.window)
    out[short] *= np.arange(shape.window) < left[short, None]
    return out, count


class Network:
    """Embedded bytes, filters of several widths, and the maximum of each filter over a window."""

    def __init__(self, shape: Shape, outputs: int, inputs: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.shape = shape
        self.mask = np.zeros((shape.span, shape.embedding, shape.channels), np.float32)
        for i, width in enumerate(shape.widths):
            self.mask[:width, :, i * shape.filters : (i + 1) * shape.filters] = 1
        self.mask = self.mask.reshape(-1, shape.channels)
        self.p = {
            "embedding": rng.normal(0, 0.5, (256, shape.embedding)).astype(np.float32),
            "kernel": (rng.normal(0, 0.2, self.mask.shape) * self.mask).astype(np.float32),
            "bias": np.zeros(shape.channels, np.float32),
            "dense": rng.normal(0, 0.1, (inputs, outputs)).astype(np.float32),
            "out": np.zeros(outputs, np.float32),
        }
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        self.steps = 0

    def _columns(self, x: np.ndarray) -> np.ndarray:
        s = self.shape
        e = self.p["embedding"][x]
        places = (s.window - s.span) // s.stride + 1
        a, b, c = e.strides
        view = np.lib.stride_tricks.as_strided(e, (len(x), places, s.span * s.embedding), (a, b * s.stride, c))
        return view.reshape(len(x) * places, -1)

    def pooled(self, x: np.ndarray, at: bool = False):
        """For each window the maximum of each filter; at: and the place where it is."""
        values, places = [], []
        for i in range(0, len(x), BATCH):
            part = x[i : i + BATCH]
            y = (self._columns(part) @ self.p["kernel"]).reshape(len(part), -1, self.shape.channels)
            if at:
                places.append(y.argmax(1))
            values.append(y.max(1))
        f = np.maximum(np.concatenate(values) + self.p["bias"], 0)
        return (f, np.concatenate(places)) if at else f

    def back(self, x: np.ndarray, f: np.ndarray, at: np.ndarray, grad: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of embedding, kernel and bias, given that of the pooled values."""
        s = self.shape
        grad = grad * (f > 0)
        offset = at[:, :, None] * s.stride + np.arange(s.span)  # window, channel, byte
        letters = np.take_along_axis(x[:, None, :], offset, 2)
        e = self.p["embedding"][letters].reshape(len(x), s.channels, -1)
        kernel = np.einsum("nck,nc->kc", e, grad, optimize=True) * self.mask
        to = (grad[:, :, None] * self.p["kernel"].T).reshape(-1, s.embedding)
        embedding = np.stack([np.bincount(letters.ravel(), to[:, d], 256) for d in range(s.embedding)], 1)
        return {"embedding": embedding.astype(np.float32), "kernel": kernel, "bias": grad.sum(0)}

    def learn(self, grads: dict[str, np.ndarray], rate: float) -> None:
        """A step of Adam."""
        self.steps += 1
        for k, g in grads.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_windows(texts: list[bytes], labels: np.ndarray, classes: int, shape: Shape, epochs: int = 4, rate: float = 0.004, batch: int = 128, steps: int = 200, seed: int = 7) -> Network:
    """A softmax over classes for each window; a window has its text's label.

    The windows of a text weigh as much together as those of any other, so that long texts
    don't outweigh the rest. At least `steps` batches are learnt from, in more epochs if need be.
    """
    net = Network(shape, classes, shape.channels, seed)
    x, count = windows(_joined(texts), shape)
    y = np.repeat(labels, count)
    weight = np.repeat(len(x) / len(texts) / count, count).astype(np.float32)
    rng = np.random.default_rng(seed)
    each = -(-len(x) // batch)
    epochs = max(epochs, -(-steps // each))
    total, done = epochs * each, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            take = order[i : i + batch]
            f, at = net.pooled(x[take], True)
            g = softmax(f @ net.p["dense"] + net.p["out"])
            g[np.arange(len(take)), y[take]] -= 1
            g *= weight[take, None] / len(take)
            grads = {"dense": f.T @ g, "out": g.sum(0)} | net.back(x[take], f, at, g @ net.p["dense"].T)
            net.learn(grads, rate * (1 - done / total))
            done += 1
    return net


def _spread(f: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each text the maximum and the mean over its windows, side by side."""
    begin = np.cumsum(count) - count
    return np.concatenate([np.maximum.reduceat(f, begin), np.add.reduceat(f, begin) / count[:, None]], 1)


def train_documents(texts: list[bytes], labels: np.ndarray, shape: Shape, epochs: int = 8, rate: float = 0.004, batch: int = 24, seed: int = 7) -> Network:
    """One logit for each text, from the maximum and the mean of its windows' pooled filters."""
    net = Network(shape, 1, 2 * shape.channels, seed)
    x, count = windows(_joined(texts), shape)
    begin = np.cumsum(count) - count
    rng = np.random.default_rng(seed)
    total, done = epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(texts), batch):
            take = order[i : i + batch]
            at_x = np.concatenate([np.arange(begin[k], begin[k] + count[k]) for k in take])
            n = count[take]
            f, at = net.pooled(x[at_x], True)
            doc = _spread(f, n)
            g = (1 / (1 + np.exp(-(doc @ net.p["dense"] + net.p["out"])[:, 0])) - labels[take]) / len(take)
            to = g[:, None] * net.p["dense"][:, 0]
            high, mean = np.split(to, 2, 1)
            of = np.repeat(np.arange(len(take)), n)
            top = f == np.split(doc, 2, 1)[0][of]
            to_f = (high[of] * top + (mean / n[:, None])[of]).astype(np.float32)
            grads = {"dense": (doc.T @ g)[:, None].astype(np.float32), "out": np.array([g.sum()], np.float32)} | net.back(x[at_x], f, at, to_f)
            net.learn(grads, rate * (1 - done / total))
            done += 1
    return net


def _joined(texts: list[bytes]) -> Block:
    return Block(0, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def class_scores(column: pa.Array, net: Network) -> Iterator[np.ndarray]:
    """For the texts of each block, the probabilities of all classes: the windows' geometric mean."""
    for block in blocks(column):
        x, count = windows(block, net.shape)
        p = softmax(net.pooled(x) @ net.p["dense"] + net.p["out"])
        begin = np.cumsum(count) - count
        yield softmax(np.add.reduceat(np.log(p + 1e-6), begin) / count[:, None])


def document_scores(column: pa.Array, net: Network) -> Iterator[np.ndarray]:
    """For the texts of each block, the probability of label 1."""
    for block in blocks(column):
        x, count = windows(block, net.shape)
        logit = _spread(net.pooled(x), count) @ net.p["dense"] + net.p["out"]
        yield 1 / (1 + np.exp(-logit[:, 0].astype(np.float64)))
