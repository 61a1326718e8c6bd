"""Interpolated Kneser-Ney models of character 4-grams, kept in sorted hash arrays.

A 4-gram is one 64-bit code, its oldest character in the top 16 bits. Only 4-grams are
counted in the texts; the lower orders count in how many ways an n-gram is continued to the
left, which the set of longer n-grams tells. Every counted n-gram is kept. The arrays are cut
into shards by ranges of the scrambled codes; a shard holds its range for all models and is a
file that readers map, so no process has to hold a whole model.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

import numpy as np

from hearthlake.llm.words import mix64

ORDER = 4
#: Possible next characters when nothing is known.
CHARACTERS = 1 << 16
#: Tables of a model: per order the n-grams' counts (even) and the contexts' totals and kinds (odd).
TABLES = 2 * ORDER + 2


def grams_table(order: int) -> int:
    return 2 * order


def contexts_table(order: int) -> int:
    return 2 * order + 1


def discount(once: int, twice: int) -> float:
    """What is taken off each count, from the numbers of n-grams counted once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.5


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, sum of their values, number of their rows."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(values, first) if len(first) else values
    return keys[first], sums, np.diff(np.append(first, len(keys)))


def shard_of(codes: np.ndarray, bits: int) -> np.ndarray:
    """The shard of each code among ``2 ** bits``."""
    if not bits:
        return np.zeros(len(codes), np.int64)
    return (mix64(codes) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Shard:
    """Rows of models' tables in order of table and scrambled code.

    ``index``: table (model * TABLES + table), first row, end of its rows. ``columns``:
    scrambled codes, counts (contexts: totals), kinds of next characters of contexts.
    """

    index: np.ndarray
    columns: np.ndarray

    def __post_init__(self):
        self.places = {t: (a, b) for t, a, b in self.index.T.tolist()}

    @classmethod
    def of(cls, table: np.ndarray, codes: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> Shard:
        keys = mix64(codes)
        order = np.lexsort((keys, table))
        table = table[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], table[1:] != table[:-1]])) if len(table) else np.zeros(0, np.int64)
        columns = np.stack([keys[order], counts[order].astype(np.uint64), kinds[order].astype(np.uint64)])
        return cls(np.stack([table[first], first, np.append(first[1:], len(table))[: len(first)]]), columns)

    def save(self, place: str) -> None:
        """Writes the files of the shard; each is moved into place when complete, so a task can be run again."""
        os.makedirs(os.path.dirname(place), exist_ok=True)
        for name, array in (("index", self.index), ("columns", self.columns)):
            own = f"{place}.{uuid.uuid4().hex}.tmp"
            with open(own, "wb") as file:
                np.save(file, array)
            os.replace(own, f"{place}.{name}.npy")

    @classmethod
    def load(cls, place: str) -> Shard:
        """The shard with its columns mapped, not read; an empty one if there is no such file."""
        if not os.path.exists(f"{place}.columns.npy"):
            return cls(np.zeros((3, 0), np.int64), np.zeros((3, 0), np.uint64))
        return cls(np.load(f"{place}.index.npy"), np.load(f"{place}.columns.npy", mmap_mode="r").view(np.ndarray))


def shard_place(folder: str, number: int) -> str:
    return f"{folder}/shard-{number:06d}"


class _Sought:
    """Codes to look up: distinct ones, scrambled and sorted, and where each shard's begin."""

    def __init__(self, codes: np.ndarray, bits: int):
        keys, self.back = np.unique(mix64(codes), return_inverse=True)
        cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
        self.keys, self.bounds = keys, np.concatenate([[0], cuts, [len(keys)]]).astype(np.int64)


@dataclass
class Models:
    """Models in shards: ``discounts`` by (model, order); shards in ``folder``, opened when first needed, or ``shards``."""

    discounts: dict[tuple[int, int], float]
    bits: int = 0
    folder: str | None = None
    shards: dict[int, Shard] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | ({"shards": {}} if self.folder else {})

    def _get(self, table: int, sought: _Sought) -> tuple[np.ndarray, np.ndarray]:
        """Counts and kinds of each code, 0 if it is not here."""
        counts, kinds = np.zeros(len(sought.keys)), np.zeros(len(sought.keys))
        for number in np.flatnonzero(np.diff(sought.bounds)).tolist():
            if number not in self.shards:
                self.shards[number] = Shard.load(shard_place(self.folder, number))
            shard = self.shards[number]
            a, b = shard.places.get(table, (0, 0))
            if a == b:
                continue
            own = slice(sought.bounds[number], sought.bounds[number + 1])
            keys = sought.keys[own]
            at = a + np.minimum(np.searchsorted(shard.columns[0, a:b], keys), b - a - 1)
            found = shard.columns[0, at] == keys
            counts[own], kinds[own] = np.where(found, shard.columns[1, at], 0), np.where(found, shard.columns[2, at], 0)
        return counts[sought.back], kinds[sought.back]

    def logs(self, codes: np.ndarray, models: list[int]) -> np.ndarray:
        """(models, codes): natural logarithm of each 4-gram's probability given its first three characters."""
        p = np.full((len(models), len(codes)), 1 / CHARACTERS)
        for order in range(1, ORDER + 1):
            own = codes & np.uint64((1 << 16 * order) - 1) if order < ORDER else codes
            grams, contexts = _Sought(own, self.bits), _Sought(own >> np.uint64(16), self.bits)
            for i, model in enumerate(models):
                total, kinds = self._get(model * TABLES + contexts_table(order), contexts)
                count, _ = self._get(model * TABLES + grams_table(order), grams)
                less, seen = self.discounts[model, order], total > 0
                total = np.where(seen, total, 1)
                p[i] = np.where(seen, np.maximum(count - less, 0) / total + less * kinds / total * p[i], p[i])
        return np.log(p)


@dataclass
class Model:
    """One model in memory."""

    models: Models

    @classmethod
    def of(cls, codes: np.ndarray, counts: np.ndarray) -> Model:
        """The model of 4-grams with their counts."""
        codes, counts, parts, discounts = codes.astype(np.uint64), counts.astype(np.int64), [], {}
        for order in range(ORDER, 0, -1):
            discounts[0, order] = discount(int((counts == 1).sum()), int((counts == 2).sum()))
            context, total, kinds = _sums(codes >> np.uint64(16), counts)
            parts.append((np.full(len(codes), grams_table(order)), codes, counts, np.zeros(len(codes), np.int64)))
            parts.append((np.full(len(context), contexts_table(order)), context, total, kinds))
            if order > 1:
                codes, _, counts = _sums(codes & np.uint64((1 << 16 * (order - 1)) - 1), counts)
        return cls(Models(discounts, shards={0: Shard.of(*[np.concatenate(c) for c in zip(*parts, strict=True)])}))

    def logs(self, codes: np.ndarray) -> np.ndarray:
        return self.models.logs(codes, [0])[0]
