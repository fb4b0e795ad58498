"""A gated recurrent language model in numpy, with a softmax over groups of classes, one over the classes of a group and one over the words of a class.

Documents are laid into slots, and all slots advance together. The state is carried from window to window, and starts anew at
each document. Gradients go back to the beginning of the window. For scoring a document stays in one slot. For training the documents are one
stream that is cut into slots of equal length, so a slot may begin within a document, with an empty state there.

What belongs to one step of the recurrence is kept as (feature, slot), so that gates are contiguous arrays; the output works on rows that are sorted by
target, so that each node of its tree has consecutive rows and takes part in one product.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

EMBEDDING, HIDDEN = 16, 24
#: Slots and window for scoring and for training.
SCORE_SLOTS, SCORE_WINDOW = 512, 32
TRAIN_SLOTS, TRAIN_WINDOW = 1024, 24
RATE, CLIP = 0.02, 1.0
#: The logit of a child that a node hasn't: its exponential is 0.
LOW = -1e4
#: Rows of weights that are updated together, so that they stay in the processor's cache.
UPDATE_ROWS = 1024
#: Nodes of the output with at most so many rows take part in a few products of arrays (node, row, child), filled up to the next of these numbers;
#: the others have their own product.
FEW_ROWS = (8, 16, 32)
#: Rows of logits that are turned into exponentials together, while they are in the processor's cache.
CACHED_ROWS = 2048
#: Tokens whose outputs are worked out together in scoring.
GATHERED_TOKENS = 1 << 16


def sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.negative(x, out=out)
    np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


def classes(counts: np.ndarray, number: int) -> np.ndarray:
    """The class of each word, words being in falling order of counts: classes of equally many words, so that all are worked on together without gaps."""
    return np.arange(len(counts)) * number // len(counts)


def with_ones(rows: np.ndarray) -> np.ndarray:
    """The rows with a last column of ones, which meets the bias in :meth:`Choices.of`."""
    out = np.ones((len(rows), rows.shape[1] + 1), rows.dtype)
    out[:, :-1] = rows
    return out


class Few:
    """Nodes with few rows: their rows are dealt to blocks of ``size``, a block for each node."""

    def __init__(self, nodes: np.ndarray, edges: np.ndarray, bounds: np.ndarray, size: int, width: int):
        first, n = bounds[nodes], np.diff(bounds)[nodes]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        #: The rows, and the place of each in the blocks.
        self.rows = np.repeat(first, n) + within
        self.at = np.repeat(np.arange(len(nodes)) * size, n) + within
        among = np.arange(width)
        missing = among >= np.diff(edges)[nodes][:, None]
        self.children = np.minimum(edges[nodes][:, None] + among, edges[-1] - 1)
        self.missing, self.there = np.flatnonzero(missing), np.flatnonzero(~missing)
        self.shape = len(nodes), size

    def spread(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[0] * self.shape[1], rows.shape[1]), rows.dtype)
        out[self.at] = rows.take(self.rows, axis=0)
        return out.reshape(*self.shape, -1)

    def logits(self, rows: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
        self.weights, self.states = weights.take(self.children, axis=0), self.spread(rows)
        flat = self.weights.reshape(-1, weights.shape[1])
        flat[self.missing] = 0
        flat[self.missing, -1] = LOW
        out[self.rows] = (self.states @ self.weights.transpose(0, 2, 1)).reshape(-1, out.shape[1]).take(self.at, axis=0)

    def back(self, d: np.ndarray, gradient: np.ndarray, out: np.ndarray) -> None:
        some = self.spread(d)
        found = (some.transpose(0, 2, 1) @ self.states).reshape(-1, gradient.shape[1])
        gradient[self.children.reshape(-1)[self.there]] = found.take(self.there, axis=0)
        out[self.rows] = (some @ self.weights[:, :, :-1]).reshape(-1, out.shape[1]).take(self.at, axis=0)


class Choices:
    """Rows that choose among the children ``edges[k]:edges[k + 1]`` of their node k; ``bounds[k]:bounds[k + 1]`` are the rows of node k."""

    def __init__(self, edges: np.ndarray, bounds: np.ndarray, chosen: np.ndarray):
        n, sizes = np.diff(bounds), np.diff(edges)
        self.present = n > 0
        self.width = int(sizes[self.present].max())
        kind = np.where(self.present, np.searchsorted(FEW_ROWS, n), -1)
        self.few = [Few(np.flatnonzero(kind == k), edges, bounds, size, self.width) for k, size in enumerate(FEW_ROWS) if (kind == k).any()]
        nodes = np.flatnonzero(kind == len(FEW_ROWS))
        #: First and last row, first and last child of the other nodes.
        self.nodes = list(zip(bounds[nodes].tolist(), bounds[nodes + 1].tolist(), edges[nodes].tolist(), edges[nodes + 1].tolist(), strict=True))
        #: Where each row's choice is in the logits.
        self.chosen = np.arange(len(chosen)) * self.width + chosen

    def exponentials(self, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row, the exponentials of the logits of all children (0 for a child that a smaller node hasn't), their sum, and the logit of the choice.
        What all logits of a row have in common may be left out."""
        out = np.empty((len(rows), self.width), rows.dtype)
        sums, logits, ones = np.empty(len(rows), rows.dtype), np.empty(len(rows), rows.dtype), np.ones(self.width, rows.dtype)
        for few in self.few:
            few.logits(rows, weights, out)

        def finish(a: int, b: int) -> None:
            some = out[a:b]
            if some.max() > 80:  # else the exponential can't overflow
                some -= some.max(axis=1, keepdims=True)
            logits[a:b] = out.reshape(-1).take(self.chosen[a:b])
            np.exp(some, out=some)
            np.matmul(some, ones, out=sums[a:b])

        done = 0
        for a, b, c, d in self.nodes:
            if d - c < self.width:
                out[a:b, d - c :] = LOW
            for k in range(a, b, CACHED_ROWS):
                to = min(k + CACHED_ROWS, b)
                np.matmul(rows[k:to], weights[c:d].T, out=out[k:to, : d - c])
                if to - done >= CACHED_ROWS:
                    finish(done, to)
                    done = to
        for k in range(done, len(rows), CACHED_ROWS):
            finish(k, min(k + CACHED_ROWS, len(rows)))
        return out, sums, logits

    def back(self, d: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What gradients of the logits give for the weights, and for the rows without their last column."""
        gradient, out = np.zeros_like(weights), np.empty((len(rows), rows.shape[1] - 1), rows.dtype)
        for few in self.few:
            few.back(d, gradient, out)
        for a, b, c, e in self.nodes:
            some = d[a:b, : e - c]
            np.matmul(some.T, rows[a:b], out=gradient[c:e])
            np.matmul(some, weights[c:e, :-1], out=out[a:b])
        return gradient, out


@dataclass
class Model:
    """The weights. Words are numbered by class: class k has the words ``edges[k]:edges[k + 1]``. Consecutive classes are a group, about as many
    groups as each has classes."""

    edges: np.ndarray
    weights: dict[str, np.ndarray]

    def __post_init__(self):
        number = len(self.edges) - 1
        groups = max(1, math.isqrt(number))
        self.group_edges = np.arange(groups + 1) * number // groups
        self.word_class = np.repeat(np.arange(number), np.diff(self.edges))
        self.class_group = np.repeat(np.arange(groups), np.diff(self.group_edges))

    @classmethod
    def fresh(cls, word_class: np.ndarray, counts: np.ndarray, seed: int = 1) -> Model:
        """Small random weights; the biases of the outputs are the frequencies, so that the model begins as one of single words."""
        words, number = len(word_class), int(word_class.max()) + 1
        random = np.random.default_rng(seed)
        small = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
        counts = np.maximum(counts, 0.5)
        out = cls(np.searchsorted(word_class, np.arange(number + 1)), {})
        mass = np.add.reduceat(counts, out.edges[:-1])
        group_mass = np.add.reduceat(mass, out.group_edges[:-1])
        out.weights = {
            "embedding": small(words + 1, EMBEDDING),  # the last is the beginning of a document
            "input": small(EMBEDDING, 3 * HIDDEN),
            "bias": np.zeros(3 * HIDDEN, np.float32),
            "recurrent": small(HIDDEN, 3 * HIDDEN),
            "group": small(len(group_mass), HIDDEN) * 0.1,
            "group_bias": np.log(group_mass / group_mass.sum()).astype(np.float32),
            "class": small(number, HIDDEN) * 0.1,
            "class_bias": np.log(mass / group_mass[out.class_group]).astype(np.float32),
            "word": small(words, HIDDEN) * 0.1,
            "word_bias": np.log(counts / mass[word_class]).astype(np.float32),
        }
        return out

    def layers(self, targets: np.ndarray) -> Iterator[tuple[str, Choices]]:
        """The choices that lead to sorted targets: of a group, of a class in it, of a word in that."""
        kind = self.word_class[targets]
        group = self.class_group[kind]
        bounds = np.searchsorted(targets, self.edges)
        yield "group", Choices(np.array([0, len(self.group_edges) - 1]), np.array([0, len(targets)]), group)
        yield "class", Choices(self.group_edges, bounds[self.group_edges], kind - self.group_edges[group])
        yield "word", Choices(self.edges, bounds, targets - self.edges[kind])

    def output(self, name: str) -> np.ndarray:
        """The weights of one layer of the output, the bias as last column."""
        return np.concatenate([self.weights[name], self.weights[f"{name}_bias"][:, None]], axis=1)

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def with_flat(self, flat: np.ndarray) -> Model:
        out, at = {}, 0
        for name, w in self.weights.items():
            out[name] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
        return Model(self.edges, out)


def laid_out(lengths: np.ndarray, slots: int) -> list[np.ndarray]:
    """Documents for each slot, so that the slots have about as many tokens; longest documents first, empty slots left out."""
    heap = [(0, s) for s in range(min(slots, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable"):
        if lengths[d]:
            total, s = heapq.heappop(heap)
            out[s].append(d)
            heapq.heappush(heap, (total + int(lengths[d]), s))
    return [np.array(x) for x in out if x]


def grid(ids: np.ndarray, first: np.ndarray, slots: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens in (step, slot) order: the token before, the token, its document; and the number of slots that are still filled
    at each step. Slots are in falling order of length."""
    lengths = np.diff(first)
    laid = laid_out(lengths, slots)
    totals = np.array([int(lengths[x].sum()) for x in laid])
    laid = [laid[s] for s in np.argsort(-totals, kind="stable")]
    totals = -np.sort(-totals)
    steps = int(totals[0]) if len(totals) else 0
    before, token, owner = (np.zeros((steps, len(laid)), np.int32) for _ in range(3))
    previous = np.empty(len(ids), np.int32)
    previous[1:] = ids[:-1]
    previous[first[:-1][lengths > 0]] = begin
    for s, documents in enumerate(laid):
        at = np.concatenate([np.arange(first[d], first[d + 1]) for d in documents])
        before[: len(at), s], token[: len(at), s] = previous[at], ids[at]
        owner[: len(at), s] = np.repeat(documents, lengths[documents])
    filled = np.searchsorted(-totals, -np.arange(steps), side="left") if steps else np.zeros(0, np.int64)
    return before, token, owner, filled


def by_number(ids: np.ndarray) -> np.ndarray:
    """The places of numbers that aren't negative, in their order."""
    return np.argsort(ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids, kind="stable")


def log_probabilities(model: Model, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each target after a state: that of its group, that of its class in the group, and that of the word in its class."""
    out = np.zeros(len(targets))
    if not len(targets):
        return out
    order = by_number(targets)
    rows, logs = with_ones(states.take(order, axis=0)), np.zeros(len(targets))
    for name, choices in model.layers(targets[order]):
        _, sums, logits = choices.exponentials(rows, model.output(name))
        logs += logits
        logs -= np.log(sums)
    out[order] = logs
    return out


def advance(x: np.ndarray, h: np.ndarray, recurrent: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of all slots: turns ``x``, the inputs, into the gates and the candidate, and writes the next state to ``new``. Also gives what the candidate had
    from the state. ``recurrent`` is (gate or candidate, state)."""
    u = recurrent @ h
    gates, candidate = x[: 2 * HIDDEN], x[2 * HIDDEN :]
    gates += u[: 2 * HIDDEN]
    sigmoid(gates, out=gates)
    np.multiply(gates[:HIDDEN], u[2 * HIDDEN :], out=new)
    candidate += new
    candidate *= 2  # the hyperbolic tangent
    sigmoid(candidate, out=candidate)
    candidate *= 2
    candidate -= 1
    np.subtract(h, candidate, out=new)
    new *= gates[HIDDEN:]
    new += candidate
    return new, u[2 * HIDDEN :]


def score(model: Model, ids: np.ndarray, first: np.ndarray, slots: int = SCORE_SLOTS, window: int = SCORE_WINDOW) -> np.ndarray:
    """The natural log-likelihood of each whole document."""
    with np.errstate(over="ignore"):  # of a gate that is shut
        return _score(model, ids, first, slots, window)


def _score(model: Model, ids: np.ndarray, first: np.ndarray, slots: int, window: int) -> np.ndarray:
    w = model.weights
    begin = len(w["word"])
    before, token, owner, filled = grid(ids, first, slots, begin)
    out = np.zeros(len(first) - 1)
    h = np.zeros((HIDDEN, before.shape[1]), w["recurrent"].dtype)
    recurrent = np.ascontiguousarray(w["recurrent"].T)
    states = np.empty((GATHERED_TOKENS + window * before.shape[1], HIDDEN), h.dtype)
    targets, owners, waiting = [], [], 0
    for at in range(0, len(before), window):
        x = inputs(w, w["embedding"].take(before[at : at + window, : filled[at]], axis=0))
        starts = before[at : at + window] == begin
        some = starts.any(axis=1)
        for t in range(at, min(at + window, len(before))):
            n = filled[t]
            if n < h.shape[1]:
                h = h[:, :n].copy()
            if some[t - at]:
                h[:, np.flatnonzero(starts[t - at, :n])] = 0
            h, _ = advance(x[t - at, :, :n], h, recurrent, np.empty_like(h))
            states[waiting : waiting + n] = h.T
            targets.append(token[t, :n])
            owners.append(owner[t, :n])
            waiting += n
        if waiting < GATHERED_TOKENS and at + window < len(before):
            continue
        logs = log_probabilities(model, states[:waiting], np.concatenate(targets))
        out += np.bincount(np.concatenate(owners), logs, minlength=len(out))
        targets, owners, waiting = [], [], 0
    return out


def inputs(w: dict[str, np.ndarray], embedded: np.ndarray) -> np.ndarray:
    """(step, feature, slot): what the tokens before, embedded as (step, slot, feature), give to gates and candidate."""
    out = np.ascontiguousarray(w["input"].T) @ embedded.transpose(0, 2, 1)
    out += w["bias"][:, None]
    return out


def stream(ids: np.ndarray, first: np.ndarray, slots: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens as one stream, cut into slots of equal length, in (step, slot) order: the token before, the token, and how many slots are
    filled at each step (the first ones; only the last step can have fewer)."""
    n = len(ids)
    slots = max(1, min(slots, n))
    previous = np.empty(n, np.int32)
    previous[1:] = ids[:-1]
    previous[first[:-1][np.diff(first) > 0]] = begin
    steps = -(-n // slots)
    short = steps * slots - n  # the last slots have one token fewer
    begins = np.arange(slots) * steps - np.maximum(np.arange(slots) - (slots - short), 0)
    at = np.minimum(begins[None, :] + np.arange(steps)[:, None], max(n - 1, 0))
    filled = np.full(steps, slots)
    filled[-1:] -= short
    return previous[at], ids[at], filled


def spans(n: int, rows: np.ndarray | None) -> Iterator[slice | np.ndarray]:
    """The rows, or all ``n``, in parts to be updated together: slices where long runs of rows follow each other, else their numbers."""
    if rows is None:
        runs = [(0, n)]
    else:
        cuts = np.flatnonzero(np.diff(rows) > 1) + 1
        if (len(cuts) + 1) * 64 > len(rows):
            yield from (rows[k : k + UPDATE_ROWS] for k in range(0, len(rows), UPDATE_ROWS))
            return
        firsts = rows[np.append(0, cuts)].tolist()
        runs = zip(firsts, (rows[np.append(cuts - 1, len(rows) - 1)] + 1).tolist(), strict=True)
    for a, b in runs:
        yield from (slice(k, min(k + UPDATE_ROWS, b)) for k in range(a, b, UPDATE_ROWS))


class Trainer:
    """Truncated backpropagation with Adam. Embeddings and words of the output that a step doesn't touch stay as they are in it."""

    def __init__(self, model: Model):
        self.model = Model(model.edges, {k: v.copy() for k, v in model.weights.items()})
        self.m = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.t = 0
        self.tokens = 0
        self.touched: dict[str, np.ndarray] = {}

    def train(self, ids: np.ndarray, first: np.ndarray, slots: int = TRAIN_SLOTS, window: int = TRAIN_WINDOW) -> None:
        if not len(ids):
            return
        # few tokens make few slots, so that there are some windows to learn from
        slots = max(1, min(slots, len(ids) // window))
        before, token, filled = stream(ids, first, slots, len(self.model.weights["word"]))
        state = np.zeros((before.shape[1], HIDDEN), np.float32)
        for at in range(0, len(before), window):
            part = slice(at, min(at + window, len(before)))
            with np.errstate(over="ignore"):  # of a gate that is shut
                state = self._step(before[part], token[part], state, np.arange(slots) < filled[part, None])
        self.tokens += len(ids)

    def _step(self, before: np.ndarray, token: np.ndarray, state: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        w, begin = self.model.weights, len(self.model.weights["word"])
        steps, n = before.shape
        embedded = w["embedding"].take(before, axis=0)
        x = inputs(w, embedded)
        fresh = [np.flatnonzero(row) for row in before == begin]
        kept, h, states = [], np.ascontiguousarray(state.T), np.empty((steps, HIDDEN, n), x.dtype)
        recurrent = np.ascontiguousarray(w["recurrent"].T)
        for t in range(steps):
            if len(fresh[t]):
                h = h.copy()
                h[:, fresh[t]] = 0
            after, u_new = advance(x[t], h, recurrent, states[t])
            kept.append((h, u_new))
            h = after
        outputs, targets = states.transpose(0, 2, 1).reshape(-1, HIDDEN), token.reshape(-1)
        if live is None or live.all():
            gradient, back = self._output(outputs, targets)
        else:
            rows, back = np.flatnonzero(live), np.zeros((steps * n, HIDDEN), states.dtype)
            gradient, back[rows] = self._output(outputs[rows], targets[rows])
        back = back.reshape(steps, n, HIDDEN)
        for name in ("recurrent", "input"):
            gradient[name] = np.zeros_like(w[name])
        gradient["bias"] = np.zeros_like(w["bias"])
        d_embedded = np.empty_like(embedded)
        d_h, d = np.zeros((HIDDEN, n), x.dtype), np.empty((3 * HIDDEN, n), x.dtype)
        d_r, d_z, d_new = d[:HIDDEN], d[HIDDEN : 2 * HIDDEN], d[2 * HIDDEN :]
        for t in reversed(range(steps)):
            h_in, u_new = kept[t]
            r, z, new = x[t, :HIDDEN], x[t, HIDDEN : 2 * HIDDEN], x[t, 2 * HIDDEN :]
            d_h += back[t].T
            some = d_h * (1 - z)
            np.subtract(h_in, new, out=d_z)
            d_z *= z
            d_z *= some
            np.multiply(new, new, out=d_new)
            np.subtract(1, d_new, out=d_new)
            d_new *= some
            np.subtract(1, r, out=d_r)
            d_r *= r
            d_r *= u_new
            d_r *= d_new
            gradient["input"] += embedded[t].T @ d.T
            gradient["bias"] += d.sum(axis=1)
            np.matmul(d.T, w["input"].T, out=d_embedded[t])
            d_new *= r  # from here on what goes to the state
            gradient["recurrent"] += h_in @ d.T
            d_h *= z
            d_h += w["recurrent"] @ d
            if len(fresh[t]):
                d_h[:, fresh[t]] = 0
        gradient["embedding"] = np.zeros_like(w["embedding"])
        order = by_number(before.reshape(-1))
        seen, starts = np.unique(before.reshape(-1)[order], return_index=True)
        self.touched["embedding"] = seen
        gradient["embedding"][seen] = np.add.reduceat(d_embedded.reshape(-1, EMBEDDING).take(order, axis=0), starts)
        self._update(gradient)
        return h.T

    def _output(self, states: np.ndarray, targets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean loss of all softmax layers, and what goes back to the states."""
        n = len(targets)
        order = by_number(targets)
        rows, back, gradient = with_ones(states.take(order, axis=0)), np.zeros_like(states), {}
        for name, choices in self.model.layers(targets[order]):
            weights = self.model.output(name)
            d, sums, _ = choices.exponentials(rows, weights)
            d *= (1 / (n * sums))[:, None]
            d.reshape(-1)[choices.chosen] -= 1 / n
            found, more = choices.back(d, rows, weights)
            back += more
            gradient[name], gradient[f"{name}_bias"] = found[:, :-1].copy(), found[:, -1].copy()
            if name == "word":
                self.touched["word"] = self.touched["word_bias"] = np.flatnonzero(choices.present[self.model.word_class])
        out = np.empty_like(back)
        out[order] = back
        return gradient, out

    def _update(self, gradient: dict[str, np.ndarray]) -> None:
        self.t += 1
        # rows that aren't touched have no gradient
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in gradient.values()))
        factor = np.float32(min(1.0, CLIP / max(norm, 1e-9)))
        rate = np.float32(RATE * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for name, whole in gradient.items():
            rows = self.touched.get(name)
            for at in spans(len(whole), rows):
                g, m, v = whole[at] * (factor * np.float32(0.1)), self.m[name][at], self.v[name][at]
                m *= 0.9
                m += g
                g *= g
                g *= 0.1
                v *= 0.999
                v += g
                if not isinstance(at, slice):  # copies of the rows
                    self.m[name][at], self.v[name][at] = m, v
                np.sqrt(v, out=g)
                g += 1e-8
                np.divide(m, g, out=g)
                g *= rate
                self.model.weights[name][at] -= g
