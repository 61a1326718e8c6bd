"""Re-Pair: grammar compression of an id sequence, and its shard file.

Frequent pairs of neighbouring ids are replaced by new ids (nonterminals), again and again,
until no pair is frequent or ids run out. A round replaces its frequent pairs together, the most
frequent first; where chosen pairs overlap, the left one wins. After the first round only pairs
beside a replaced place can have become frequent, so only they are counted; when none is, all
pairs are counted once more, and the end is reached when that finds none either. Pairs never
contain the end id, so documents begin at whole symbols and each can be decoded alone.

A shard is a row of blocks, then an index of them (place, least and greatest document id, documents),
then the index's place. A document is found without reading other blocks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: A pair must occur so often in a block to become a rule.
LEAST_PAIRS = 32
#: Symbols are stored in two bytes.
SYMBOLS = 1 << 16

MAGIC, INDEX = b"HLREPAI2", b"HLINDEX2"


@dataclass
class Grammar:
    """``rules[i]`` is the pair that symbol ``terminals + i`` stands for; ``lengths[i]`` how many ids that is."""

    terminals: int
    rules: np.ndarray
    lengths: np.ndarray

    _whole: tuple[np.ndarray, np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, length): what every symbol stands for, terminals first."""
        if self._whole is None:
            out = self.terminals + np.arange(len(self.rules))
            while len(out) and out.max() >= self.terminals:
                rule = out >= self.terminals
                width = np.where(rule, 2, 1)
                at = np.cumsum(width) - width
                wide = np.empty(int(width.sum()), np.int64)
                wide[at] = out
                pairs = self.rules[out[rule] - self.terminals]
                wide[at[rule]], wide[at[rule] + 1] = pairs[:, 0], pairs[:, 1]
                out = wide
            length = np.concatenate([np.ones(self.terminals, np.int64), self.lengths])
            self._whole = np.concatenate([np.arange(self.terminals), out]).astype(np.uint16), np.cumsum(length) - length, length
        return self._whole

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that the symbols stand for."""
        ids, start, length = self._expansions()
        own = length[symbols]
        end = np.cumsum(own)
        return ids[np.repeat(start[symbols] - end + own, own) + np.arange(end[-1] if len(end) else 0)]

    def widths(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        known = np.concatenate([np.ones(self.terminals, np.int64), self.lengths])
        return known[symbols]


class _Rules:
    """The rules so far, found by their pair."""

    def __init__(self, terminals: int):
        self.next, self.codes, self.numbers = terminals, np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.pairs: list[np.ndarray] = []
        self.lengths = np.ones(SYMBOLS, np.int64)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, symbols), by code: the known rule of a pair, or a new one while ids last."""
        at = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
        known = self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), bool)
        new = codes[~known][: SYMBOLS - self.next]
        numbers = np.arange(self.next, self.next + len(new))
        pair = np.stack([new >> np.uint32(16), new & np.uint32(SYMBOLS - 1)], axis=1).astype(np.int64)
        self.lengths[numbers] = self.lengths[pair[:, 0]] + self.lengths[pair[:, 1]]
        self.pairs.append(pair)
        self.next += len(new)
        every, symbols = np.concatenate([codes[known], new]), np.concatenate([self.numbers[at[known]] if known.any() else numbers[:0], numbers])
        order = np.argsort(every)
        self.codes, self.numbers = np.concatenate([self.codes, new]), np.concatenate([self.numbers, numbers])
        by_code = np.argsort(self.codes)
        self.codes, self.numbers = self.codes[by_code], self.numbers[by_code]
        return every[order], symbols[order]


def _frequent(codes: np.ndarray) -> np.ndarray:
    """The codes that occur often enough, the most frequent first."""
    ordered = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(ordered)))
    some = np.flatnonzero(n >= LEAST_PAIRS)
    return ordered[first[some[np.argsort(-n[some], kind="stable")]]]


def _slots(codes: np.ndarray, factor: int) -> np.ndarray:
    return (codes * np.uint32(factor)) >> np.uint32(12)


def _places_of(chosen: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``codes`` are chosen, their places in ``chosen``), by hash tables of 2**20 slots: what
    finds its slot taken goes to the next table."""
    place = np.full(len(codes), -1, np.int32)
    left, factor = np.arange(len(chosen), dtype=np.int32), 0x9E3779B1
    while len(left):
        table = np.full(1 << 20, -1, np.int32)
        own = _slots(chosen[left], factor)
        table[own] = left
        found = table[_slots(codes, factor)]
        hit = (found >= 0) & (chosen[found] == codes)
        place[hit] = found[hit]
        left, factor = left[table[own] != left], (factor * 5 + 0x6D2B79F4) & 0xFFFFFFFF | 1
    at = np.flatnonzero(place >= 0)
    return at, place[at]


def _left_first(at: np.ndarray) -> np.ndarray:
    """Of neighbouring places (ascending) every second one, from the left of each run."""
    start = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
    return (np.arange(len(at)) - start) % 2 == 0


def compress(ids: np.ndarray, terminals: int, end_id: int) -> tuple[Grammar, np.ndarray]:
    """Grammar and symbols of ``ids`` (all below ``terminals``, which is at most 65536)."""
    symbols, rules = ids.astype(np.uint32), _Rules(terminals)
    whole, fresh = True, None
    while len(symbols) > 1:
        codes = symbols[:-1] << np.uint32(16) | symbols[1:]
        counted = (symbols[:-1] != end_id) & (symbols[1:] != end_id)
        if not whole:
            counted &= fresh[:-1] | fresh[1:]
        places = np.flatnonzero(counted)
        frequent = _frequent(codes[places])
        if rules.next >= SYMBOLS and len(frequent):
            frequent = frequent[np.isin(frequent, rules.codes)]
        if not len(frequent):
            if whole:
                break
            whole = True
            continue
        chosen, numbers = rules.of(frequent)
        leads = np.zeros(SYMBOLS, bool)
        leads[chosen >> np.uint32(16)] = True
        places = places[leads[symbols[places]]]
        hit, own = _places_of(chosen, codes[places])
        at = places[hit]
        keep = _left_first(at)
        at, own = at[keep], own[keep]
        symbols[at] = numbers[own].astype(np.uint32)
        stays, fresh = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
        stays[at + 1], fresh[at] = False, True
        symbols, fresh, whole = symbols[stays], fresh[stays], False
    every = np.concatenate(rules.pairs) if rules.pairs else np.zeros((0, 2), np.int64)
    return Grammar(terminals, every, rules.lengths[terminals : rules.next]), symbols.astype(np.uint16)


def pack_block(doc_ids: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray, terminals: int, end_id: int) -> bytes:
    """One block: header, document table, rules with expansion lengths, symbols.

    ``counts``: ids per document, the end id with each. ``known``: which documents have an id.
    """
    grammar, symbols = compress(ids, terminals, end_id)
    ends = np.cumsum(grammar.widths(symbols))
    symbol_counts = np.diff(np.searchsorted(ends, np.cumsum(counts)), prepend=-1)
    header = np.array([len(counts), len(ids), terminals, len(grammar.rules), len(symbols)], "<u8")
    return b"".join(
        [
            MAGIC,
            header.tobytes(),
            doc_ids.astype("<i8").tobytes(),
            known.astype("u1").tobytes(),
            counts.astype("<u8").tobytes(),
            symbol_counts.astype("<u8").tobytes(),
            grammar.rules.astype("<u2").tobytes(),
            grammar.lengths.astype("<u4").tobytes(),
            symbols.astype("<u2").tobytes(),
        ]
    )


@dataclass
class Block:
    doc_ids: np.ndarray
    known: np.ndarray
    counts: np.ndarray
    symbol_counts: np.ndarray
    grammar: Grammar
    symbols: np.ndarray

    def document(self, place: int) -> np.ndarray:
        """The ids of one document, from its own symbols only."""
        start = int(self.symbol_counts[:place].sum())
        return self.grammar.expand(self.symbols[start : start + int(self.symbol_counts[place])])

    def ids(self) -> np.ndarray:
        return self.grammar.expand(self.symbols)


def _array(file, n: int, kind: str) -> np.ndarray:
    data = file.read(n * np.dtype(kind).itemsize)
    if len(data) != n * np.dtype(kind).itemsize:
        raise ValueError("the shard ends within a block")
    return np.frombuffer(data, kind)


def _open_block(file):
    """(numbers of the header, document table, grammar) of the block that begins here; the file is then at its symbols."""
    header = docs, _, terminals, rules, _ = tuple(int(x) for x in _array(file, 5, "<u8"))
    table = [_array(file, docs, kind) for kind in ("<i8", "u1", "<u8", "<u8")]
    pairs, lengths = _array(file, 2 * rules, "<u2").reshape(-1, 2), _array(file, rules, "<u4")
    return header, table, Grammar(terminals, pairs.astype(np.int64), lengths.astype(np.int64))


def read_blocks(file):
    """The blocks of an open shard, one after the other; a broken one raises."""
    while (magic := file.read(len(MAGIC))) != INDEX:
        if magic != MAGIC:
            raise ValueError("no block begins here" if magic else "the shard has no index")
        (_, ids, _, _, symbols), (doc_ids, known, counts, symbol_counts), grammar = _open_block(file)
        block = Block(doc_ids, known, counts.astype(np.int64), symbol_counts.astype(np.int64), grammar, _array(file, symbols, "<u2"))
        if int(block.counts.sum()) != ids:
            raise ValueError("the block does not have its number of ids")
        yield block


def pack_index(entries: list[tuple[int, int, int, int]]) -> bytes:
    """``entries``: place, least and greatest known document id and number of known ids of every block."""
    rows = np.array(entries, "<i8").reshape(-1, 4)
    return INDEX + rows.tobytes() + np.array([len(rows)], "<u8").tobytes()


def find_document(file, doc_id: int) -> np.ndarray | None:
    """One document's ids from an open shard: the index, the tables of blocks that may hold it, and its own symbols are read."""
    file.seek(-8, 2)
    n = int(_array(file, 1, "<u8")[0])
    file.seek(-8 - 32 * n, 2)
    for place, least, greatest, known_ids in _array(file, 4 * n, "<i8").reshape(-1, 4).tolist():
        if not known_ids or not least <= doc_id <= greatest:
            continue
        file.seek(place + len(MAGIC))
        _, (doc_ids, known, _, symbol_counts), grammar = _open_block(file)
        own = np.flatnonzero((doc_ids == doc_id) & (known == 1))
        if len(own):
            file.seek(2 * int(symbol_counts[: own[0]].sum()), 1)
            return grammar.expand(_array(file, int(symbol_counts[own[0]]), "<u2"))
    return None
