"""A small convolutional network over characters, in numpy: embedding, one convolution, two poolings, one output."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Characters are printable ASCII; one code each for other characters and for nothing.
CODES, OTHER, NOTHING = 97, 95, 96
#: What the network sees: characters before, the beginning and the end of the candidate, characters after.
BEFORE, HEAD, TAIL, AFTER = 20, 32, 8, 8
LENGTH = BEFORE + HEAD + TAIL + AFTER
EMBEDDING, WIDTH, FILTERS = 8, 5, 24


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) - 32
    return np.where((points >= 0) & (points < OTHER), points, OTHER).astype(np.uint8)


def window(text: str, start: int, end: int) -> np.ndarray:
    """The codes of a candidate and of what surrounds it; a long candidate is seen by its beginning and its end."""
    out = np.full(LENGTH, NOTHING, np.uint8)
    before = codes(text[max(0, start - BEFORE) : start])
    out[BEFORE - len(before) : BEFORE] = before
    head = codes(text[start : min(end, start + HEAD)])
    out[BEFORE : BEFORE + len(head)] = head
    tail = codes(text[max(start + HEAD, end - TAIL) : end]) if end > start + HEAD else head[:0]
    out[BEFORE + HEAD : BEFORE + HEAD + len(tail)] = tail
    after = codes(text[end : end + AFTER])
    out[BEFORE + HEAD + TAIL : BEFORE + HEAD + TAIL + len(after)] = after
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class CharNet:
    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    #: Platt scaling of the raw output.
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0
    _slots: dict = field(default_factory=dict, repr=False)

    @classmethod
    def fresh(cls, seed: int = 11) -> CharNet:
        random = np.random.default_rng(seed)
        small = lambda *shape: (random.standard_normal(shape) * 0.2).astype(np.float32)
        return cls(small(CODES, EMBEDDING), small(WIDTH * EMBEDDING, FILTERS), np.zeros(FILTERS, np.float32), small(2 * FILTERS + 1))

    def _forward(self, x: np.ndarray):
        columns = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
        patches = self.embedding[columns].reshape(len(x), columns.shape[1], WIDTH * EMBEDDING)
        hidden = np.maximum(patches @ self.kernel + self.bias, 0)
        top = hidden.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(hidden, top[:, None], 1)[:, 0], hidden.mean(axis=1), np.ones((len(x), 1), np.float32)], axis=1)
        return columns, patches, hidden, top, pooled, pooled @ self.output

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 512])[-1] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0, np.float32)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.raw(x) + self.shift)

    def _step(self, name: str, gradient: np.ndarray, rate: float, t: int) -> None:
        """Adam."""
        m, v = self._slots.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        self._slots[name] = (m, v)
        setattr(self, name, (getattr(self, name) - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)).astype(np.float32))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.01, seed: int = 3) -> None:
        random, t = np.random.default_rng(seed), 0
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
        for _ in range(epochs):
            order = random.permutation(len(x))
            for i in range(0, len(x), 128):
                part = order[i : i + 128]
                columns, patches, hidden, top, pooled, z = self._forward(x[part])
                t += 1
                error = ((sigmoid(z) - y[part]) * weight[part] / len(part)).astype(np.float32)
                back = error[:, None] * self.output[None, : 2 * FILTERS]
                grad = np.repeat(back[:, None, FILTERS:] / hidden.shape[1], hidden.shape[1], axis=1)
                np.put_along_axis(grad, top[:, None], np.take_along_axis(grad, top[:, None], 1) + back[:, None, :FILTERS], 1)
                grad = grad * (hidden > 0)
                flat = grad.reshape(-1, FILTERS)
                spread = (flat @ self.kernel.T).reshape(-1, EMBEDDING)
                embedding = np.zeros_like(self.embedding)
                np.add.at(embedding, columns.reshape(-1), spread)
                self._step("output", pooled.T @ error, rate, t)
                self._step("kernel", patches.reshape(-1, WIDTH * EMBEDDING).T @ flat, rate, t)
                self._step("bias", flat.sum(axis=0), rate, t)
                self._step("embedding", embedding, rate, t)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Platt scaling on rows the network wasn't fitted on; then the highest threshold that still finds ``recall`` of the positive ones."""
        raw = self.raw(x).astype(np.float64)
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        design = np.column_stack([raw, np.ones(len(raw))])
        w = np.array([1.0, 0.0])
        for _ in range(30):
            p = sigmoid(design @ w)
            step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (target - p) - 1e-3 * (w - [1, 0]))
            w = w + np.clip(step, -2, 2)
        self.slope, self.shift = float(max(w[0], 1e-3)), float(w[1])
        positive = np.sort(self.probability(x[y == 1]))
        self.threshold = float(positive[int(np.floor((1 - recall) * len(positive)))])
