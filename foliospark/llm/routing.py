"""Fitting of learned partitions on a bounded sample: a neighbour graph, its balanced partitioning, and small classifiers. Plain arrays; nothing here knows of tables."""

from __future__ import annotations

import io

import numpy as np

GRAPH = 16  # neighbours of a sample vector in the graph
HIDDEN = 64
EPOCHS, STEP = 20, 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product with each row, itself excepted."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for low in range(0, len(x), 1024):
        score = x[low:low + 1024] @ x.T
        score[np.arange(len(score)), np.arange(low, low + len(score))] = -np.inf
        out[low:low + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def _halves(n: int, u: np.ndarray, v: np.ndarray, x: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """True for the ``left`` nodes of one side: a spectral cut, mended by swaps."""
    degree = np.maximum(np.bincount(u, minlength=n), 1)
    root = np.sqrt(degree)
    flat = root / np.linalg.norm(root)
    value = x @ rng.standard_normal(x.shape[1]) * root
    for _ in range(60):
        value = value - flat * (flat @ value)
        value /= np.linalg.norm(value) or 1.0
        value = value + np.bincount(u, weights=value[v] / (root[u] * root[v]), minlength=n)
    side = np.zeros(n, dtype=bool)
    side[np.argsort(value / root, kind="stable")[:left]] = True
    best, least = side.copy(), int((side[u] != side[v]).sum())
    for _ in range(8):
        crossing = side[u] != side[v]
        gain = np.bincount(u, weights=np.where(crossing, 1.0, -1.0), minlength=n)
        here, there = np.flatnonzero(side), np.flatnonzero(~side)
        here, there = here[np.argsort(-gain[here], kind="stable")], there[np.argsort(-gain[there], kind="stable")]
        most = min(len(here), len(there), 1 + n // 20)
        swaps = int((gain[here[:most]] + gain[there[:most]] > 0).sum())
        if not swaps:
            break
        side[here[:swaps]], side[there[:swaps]] = False, True
        cut = int((side[u] != side[v]).sum())
        if cut < least:
            best, least = side.copy(), cut
    return best


def balanced_parts(graph: np.ndarray, x: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part for every node, all of about the same size, with few edges between parts: bisection over and over."""
    rng = np.random.default_rng(seed)
    n = len(graph)
    u, v = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    out = np.zeros(n, dtype=np.int64)

    def split(nodes: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            out[nodes] = first
            return
        local = np.full(n, -1)
        local[nodes] = np.arange(len(nodes))
        inside = (local[u] >= 0) & (local[v] >= 0)
        half = count // 2
        side = _halves(len(nodes), local[u[inside]], local[v[inside]], x[nodes], len(nodes) * half // count, rng)
        split(nodes[side], first, half)
        split(nodes[~side], first + half, count - half)

    split(np.arange(n), 0, parts)
    return out


class Network:
    """One hidden layer, then a softmax."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.maximum(x.astype(np.float32) @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    @staticmethod
    def trained(x: np.ndarray, target: np.ndarray, seed: int = 11) -> Network:
        """Cross-entropy with the target distributions, by Adam."""
        rng = np.random.default_rng(seed)
        x, target = x.astype(np.float32), target.astype(np.float32)
        w = [rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, target.shape[1])) / np.sqrt(HIDDEN), np.zeros(target.shape[1])]
        w = [a.astype(np.float32) for a in w]
        first, second, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            rate = 0.01 * (1 - epoch / EPOCHS)
            for low in range(0, len(x), STEP):
                some = order[low:low + STEP]
                own = x[some]
                hidden = np.maximum(own @ w[0] + w[1], 0)
                z = hidden @ w[2] + w[3]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                error = (z / z.sum(axis=1, keepdims=True) - target[some]) / len(some)
                back = (error @ w[2].T) * (hidden > 0)
                t += 1
                for i, g in enumerate((own.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    w[i] = w[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
        return Network([a.astype(np.float32) for a in w])


class Partitioner:
    """Which part a vector lies in, and how likely each part is to hold a query's nearest vectors.

    Vectors are brought to one length by a further coordinate, so that the largest inner product is also the nearest direction.
    """

    def __init__(self, scale: float, lies: Network, routes: Network):
        self.scale, self.lies, self.routes = scale, lies, routes
        self.parts = lies.weights[3].shape[0]

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1)))])

    @staticmethod
    def _directed(q: np.ndarray) -> np.ndarray:
        q = q / np.abs(q).max(axis=1, keepdims=True)
        return np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))])

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.lies.probabilities(self._lifted(x)).argmax(1)

    def likely(self, q: np.ndarray) -> np.ndarray:
        return self.routes.probabilities(self._directed(q))

    @staticmethod
    def fitted(x: np.ndarray, parts: int) -> Partitioner:
        scale = float(np.abs(x).max())
        scale *= float(np.linalg.norm(x / scale, axis=1).max())
        x = x / scale
        graph = neighbour_graph(x, GRAPH)
        label = balanced_parts(graph, x, parts)
        out = Partitioner(1.0, Network([np.zeros(1)] * 4), Network([np.zeros(1)] * 4))
        out.lies = Network.trained(out._lifted(x), np.eye(parts)[label])
        lies = out.lies.probabilities(out._lifted(x)).argmax(1)
        shares = np.stack([np.bincount(lies[near], minlength=parts) for near in graph]) / graph.shape[1]
        out.routes = Network.trained(out._directed(x), shares)
        return Partitioner(scale, out.lies, out.routes)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, np.array([self.scale]), *self.lies.weights, *self.routes.weights)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Partitioner:
        scale, *w = np.load(io.BytesIO(data)).values()
        return Partitioner(float(scale[0]), Network(w[:4]), Network(w[4:]))


class Tree:
    """A partitioner, and for large parts one more each. A leaf's number is ``fan_out`` times the part plus the part's own part."""

    def __init__(self, blobs: dict[int, bytes], fan_out: int):
        self.root = Partitioner.from_bytes(blobs[-1]) if -1 in blobs else None
        self.below = {k: Partitioner.from_bytes(b) for k, b in blobs.items() if k >= 0}
        self.fan_out = fan_out
        self.parts = self.root.parts if self.root else 1
        self.leaves = np.array([p * fan_out + s for p in range(self.parts) for s in range(self.below[p].parts if p in self.below else 1)], dtype=np.int64)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        if self.root is None:
            return np.zeros(len(x), dtype=np.int64)
        part = self.root.part(x)
        out = part * self.fan_out
        for p, sub in self.below.items():
            mine = np.flatnonzero(part == p)
            if len(mine):
                out[mine] += sub.part(x[mine])
        return out

    def likely(self, q: np.ndarray) -> np.ndarray:
        """The probability of each of ``leaves``, per query."""
        if self.root is None:
            return np.ones((len(q), 1))
        root = self.root.likely(q)
        return np.column_stack([root[:, p:p + 1] * self.below[p].likely(q) if p in self.below else root[:, p:p + 1] for p in range(self.parts)])

    def mass_before(self, q: np.ndarray) -> np.ndarray:
        """Per query and leaf the probability of all leaves that are likelier: those below a bound are the most probable ones that make it up."""
        likely = self.likely(q)
        order = np.argsort(-likely, axis=1, kind="stable")
        sorted_mass = np.take_along_axis(likely, order, axis=1)
        out = np.empty_like(sorted_mass)
        np.put_along_axis(out, order, np.cumsum(sorted_mass, axis=1) - sorted_mass, axis=1)
        return out
