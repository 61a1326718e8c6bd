"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is a hashed word vector plus the sum of its hashed character n-gram vectors
over the root of their number, so an unseen word is read by its letters. These vectors are
set before training and stay; the network's own weights are trained. All arrays are feature-major, (features, windows).
Word number 0 is the pad: its input is 0 and attention never looks at it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np

from hearthlake.llm.words import mix64

WORD_SLOTS, GRAM_SLOTS = 1 << 14, 1 << 15
INPUT, HIDDEN = 8, 8
GRAMS = (3, 4, 5)
#: Words whose n-grams are looked at together.
TOGETHER = 1 << 13


@dataclass
class WordTable:
    """Features of distinct words: slot of each word, slots of its character n-grams."""

    word: np.ndarray
    gram: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, words: list[bytes]) -> WordTable:
        """Built from ``TOGETHER`` words at a time, so that what it takes meanwhile is bounded."""
        parts = [cls._of(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)] or [cls._of([])]
        counts = np.concatenate([p.counts() for p in parts])
        first = np.concatenate([[0], np.cumsum(counts)])
        return cls(np.concatenate([p.word for p in parts]), np.concatenate([p.gram for p in parts]), first)

    @classmethod
    def _of(cls, words: list[bytes]) -> WordTable:
        word = np.fromiter((zlib.crc32(w) & (WORD_SLOTS - 1) for w in words), np.int64, len(words))
        text = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words) + bytes(max(GRAMS)), np.uint8).astype(np.uint64)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(words)), lengths)
        left = (ends[owner] - np.arange(len(owner))) if len(words) else np.zeros(0, np.int64)
        slots, owners = [], []
        code = np.zeros(len(owner), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            code = code << np.uint64(8) | text[n - 1 : n - 1 + len(owner)]
            if n in GRAMS:
                inside = left >= n
                slots.append((mix64(code[inside] + np.uint64(n << 48)) & np.uint64(GRAM_SLOTS - 1)).astype(np.int32))
                owners.append(owner[inside])
        slot, own = np.concatenate(slots), np.concatenate(owners)
        order = np.argsort(own, kind="stable")
        return cls(word, slot[order], np.searchsorted(own[order], np.arange(len(words) + 1)))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters by name; every one is a float32 array of fixed size."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        p = {"word": np.zeros((WORD_SLOTS, INPUT), np.float32), "gram": normal(GRAM_SLOTS, INPUT, scale=0.1)}
        for side in "fb":
            p[f"in_{side}"] = normal(INPUT, 3 * HIDDEN, scale=0.5)
            p[f"own_{side}"] = normal(3 * HIDDEN, HIDDEN, scale=0.3)
            p[f"bias_{side}"] = np.zeros(3 * HIDDEN, np.float32)
        return cls(p | {"look": normal(2 * HIDDEN, scale=0.3), "out": normal(2 * HIDDEN, scale=0.5), "level": np.zeros(1, np.float32)})

    def inputs(self, table: WordTable) -> np.ndarray:
        """(words, INPUT), summed over a word and its n-grams."""
        x = self.p["word"][table.word]
        counts = table.counts()
        for i in range(0, len(x), TOGETHER):
            own, first = counts[i : i + TOGETHER], table.first[i : i + TOGETHER + 1]
            some = own > 0
            if some.any():
                sums = np.add.reduceat(self.p["gram"][table.gram[first[0] : first[-1]]], first[:-1][some] - first[0], axis=0)
                x[i : i + TOGETHER][some] += sums / np.sqrt(own[some])[:, None]
        return x

    def projected(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, 3 * HIDDEN) for either direction, the bias with it."""
        return tuple(x @ self.p[f"in_{s}"] + self.p[f"bias_{s}"] for s in "fb")

    def run(self, projected: np.ndarray, places: np.ndarray, side: str, kept: list | None = None) -> np.ndarray:
        """Hidden states (steps, HIDDEN, windows) over ``places`` (steps, windows) of word numbers."""
        own, h = self.p[f"own_{side}"], np.zeros((HIDDEN, places.shape[1]), np.float32)
        out = np.empty((len(places), HIDDEN, places.shape[1]), np.float32)
        for t in range(len(places)) if side == "f" else reversed(range(len(places))):
            g = np.ascontiguousarray(projected[places[t]].T)
            u = own @ h
            gates = _sigmoid(g[: 2 * HIDDEN] + u[: 2 * HIDDEN])
            z, r = gates[:HIDDEN], gates[HIDDEN:]
            n = np.tanh(g[2 * HIDDEN :] + r * u[2 * HIDDEN :])
            if kept is not None:
                kept.append((t, h, z, r, n, u[2 * HIDDEN :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def logits(self, projected: tuple[np.ndarray, np.ndarray], places: np.ndarray) -> np.ndarray:
        """One logit per window."""
        return self._pool(self.run(projected[0], places, "f"), self.run(projected[1], places, "b"), places)[0]

    def _pool(self, f: np.ndarray, b: np.ndarray, places: np.ndarray):
        look, out = self.p["look"], self.p["out"]
        seen = np.einsum("h,thb->tb", look[:HIDDEN], f) + np.einsum("h,thb->tb", look[HIDDEN:], b)
        seen = np.where(places > 0, seen, np.float32(-1e9))
        weight = np.exp(seen - seen.max(axis=0))
        weight /= weight.sum(axis=0)
        said = np.einsum("h,thb->tb", out[:HIDDEN], f) + np.einsum("h,thb->tb", out[HIDDEN:], b)
        return (weight * said).sum(axis=0) + self.p["level"][0], weight, said

    def gradients(self, x: np.ndarray, places: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the windows' weighted logistic loss; ``x`` has the words' inputs, the pad's first."""
        projected = self.projected(x)
        kept = {"f": [], "b": []}
        h = {s: self.run(projected[i], places, s, kept[s]) for i, s in enumerate("fb")}
        logit, weight, said = self._pool(h["f"], h["b"], places)
        back = (weights * (_sigmoid(logit) - labels) / weights.sum()).astype(np.float32)
        pooled = logit - self.p["level"][0]
        d_said, d_seen = weight * back, weight * (said - pooled) * back
        g = {"level": np.array([back.sum()], np.float32)}
        g["out"] = np.concatenate([np.einsum("tb,thb->h", d_said, h[s]) for s in "fb"])
        g["look"] = np.concatenate([np.einsum("tb,thb->h", d_seen, h[s]) for s in "fb"])
        for i, s in enumerate("fb"):
            part = slice(i * HIDDEN, (i + 1) * HIDDEN)
            own = self.p[f"own_{s}"]
            d_own, d_in, d_bias = np.zeros_like(own), np.zeros_like(self.p[f"in_{s}"]), np.zeros_like(self.p[f"bias_{s}"])
            carry = np.zeros((HIDDEN, places.shape[1]), np.float32)
            for t, before, z, r, n, un in reversed(kept[s]):
                dh = carry + np.outer(self.p["out"][part], d_said[t]) + np.outer(self.p["look"][part], d_seen[t])
                dz, dn = dh * (before - n) * z * (1 - z), dh * (1 - z) * (1 - n * n)
                du = np.concatenate([dz, dn * un * r * (1 - r), dn * r])
                d_gate = np.concatenate([du[: 2 * HIDDEN], dn])
                d_own += du @ before.T
                d_in += x[places[t]].T @ d_gate.T
                d_bias += d_gate.sum(axis=1)
                carry = dh * z + own.T @ du
            g[f"own_{s}"], g[f"in_{s}"], g[f"bias_{s}"] = d_own, d_in, d_bias
        return g


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.mean, self.square = rate, 0, {}, {}

    def update(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.step += 1
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k, x in g.items():
            x = x / max(1.0, size)
            self.mean[k] = m = 0.9 * self.mean.get(k, 0) + 0.1 * x
            self.square[k] = v = 0.999 * self.square.get(k, 0) + 0.001 * x * x
            p[k] -= (self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)).astype(np.float32)
