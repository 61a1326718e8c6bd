"""Tokens of whole texts, counted by a lookup in two tiers on the map side.

Frequent pre-tokens and their lengths in tokens are a small hash table that every task gets.
What it lacks is encoded once and kept in the worker's bounded cache. No pre-token is ever
shuffled: each task sums up its documents in a summary of fixed size, and only summaries meet.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.pieces import TOKENIZER, PieceModel, pre_tokens
from hearthlake.llm.registry import without_text
from hearthlake.session import Staging

#: Entries of a summary, and so of the table of frequent pre-tokens; longer ones (bytes) are left to the cache.
FREQUENT, LONGEST = 1 << 14, 64
#: Characters of pre-tokens that a worker's cache holds; it is emptied when full.
CACHED_CHARS = 4_000_000
LIMIT = 2048


# -- summaries ---------------------------------------------------------------
def reduced(counts: Counter, entries: int) -> Counter:
    """The counter cut to ``entries``: the next largest count is taken off all, what is left stays.

    Whatever is more frequent than (all pre-tokens) / entries survives, in any order of merging.
    """
    if len(counts) <= entries:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    off = int(np.partition(values, len(values) - entries - 1)[len(values) - entries - 1])
    return Counter({k: v - off for k, v in counts.items() if v > off})


def packed(counts: Counter) -> tuple[bytes, bytes]:
    """Pre-tokens (none has white space) and counts, in order."""
    rows = sorted(counts.items())
    return " ".join(k for k, _ in rows).encode(), np.array([v for _, v in rows], "<i8").tobytes()


def unpacked(keys: bytes, values: bytes) -> dict[str, int]:
    return dict(zip(keys.decode().split(" "), np.frombuffer(values, "<i8").tolist(), strict=True)) if values else {}


def _row(counts: Counter) -> pa.RecordBatch:
    keys, values = packed(counts)
    return pa.RecordBatch.from_pydict({"keys": pa.array([keys], pa.binary()), "counts": pa.array([values], pa.binary())})


def _summarise(entries, batches):
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(pre_tokens(text.as_py()))
            if len(counts) > 8 * entries:
                counts = reduced(counts, entries)
    short = Counter({k: v for k, v in counts.items() if len(k.encode()) <= LONGEST})
    yield _row(reduced(short, entries))


def _merge(entries, batches):
    counts: Counter = Counter()
    for batch in batches:
        for keys, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.update(unpacked(keys, values))
            if len(counts) > 8 * entries:
                counts = reduced(counts, entries)
    yield _row(reduced(counts, entries))


def frequent_pre_tokens(staging: Staging, documents: DataFrame, entries: int | None = None) -> list[str]:
    """At most ``entries`` frequent pre-tokens of all texts, sorted.

    One summary per task, merged in two steps: about the square root of the number of tasks
    meet in one, so neither a task nor the driver gets more than bounded summaries.
    """
    entries = FREQUENT if entries is None else entries
    schema = "keys binary, counts binary"
    own = staging.keep(documents.select("text").mapInArrow(lambda b: _summarise(entries, b), schema), "summaries")
    groups = max(1, math.isqrt(own.count()))
    some = own.repartition(groups).mapInArrow(lambda b: _merge(entries, b), schema)
    one = some.coalesce(1).mapInArrow(lambda b: _merge(entries, b), schema).first()
    return sorted(unpacked(*one)) if one else []


# -- the two tiers -------------------------------------------------------------
@dataclass
class FrequentLengths:
    """The first tier as it is sent: pre-tokens in one string, lengths in two bytes each."""

    keys: bytes
    lengths: bytes

    @classmethod
    def of(cls, pre: list[str], tokenizer: str) -> FrequentLengths:
        model = PieceModel(tokenizer)
        return cls(" ".join(pre).encode(), np.array([model.length(p) for p in pre], "<u2").tobytes())

    def items(self):
        return zip(self.keys.decode().split(" "), np.frombuffer(self.lengths, "<u2").tolist(), strict=True) if self.lengths else ()


class _Cache(dict):
    """Second tier: lengths of pre-tokens met by this worker, encoded when first met."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.chars = model, 0

    def __missing__(self, piece: str) -> int:
        n = self.model.length(piece)
        if len(piece) <= CACHED_CHARS // 64:
            if self.chars > CACHED_CHARS:
                self.clear()
                self.chars = 0
            self[piece] = n
            self.chars += len(piece)
        return n


class TwoTiers(dict):
    """Length of a pre-token: from the frequent ones, else from the worker's cache."""

    def __init__(self, frequent: FrequentLengths, model: PieceModel):
        super().__init__(frequent.items())
        self.rest = _Cache(model)

    def __missing__(self, piece: str) -> int:
        return self.rest[piece]

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))


_MODELS: dict[str, PieceModel] = {}


def _count(sent, tokenizer, batches):
    if tokenizer not in _MODELS:
        _MODELS[tokenizer] = PieceModel(tokenizer)
    tiers = TwoTiers(sent.value, _MODELS[tokenizer])
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            counts = [tiers.count(t.as_py()) for t in part.column(1)]
            columns = {f.name: part.column(k) for k, f in enumerate(part.schema)} | {"n_tokens": pa.array(counts, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def with_token_counts(staging: Staging, documents: DataFrame, tokenizer: str = TOKENIZER, entries: int | None = None) -> DataFrame:
    """(row, text, n_tokens) of every document; ``row`` holds all columns but text, so no name can clash.

    NULL and empty texts have no tokens. The counts do not depend on the table of frequent
    pre-tokens; that only says what is looked up first. ``entries`` of 0 leaves all to the cache.
    """
    frequent = FrequentLengths.of(frequent_pre_tokens(staging, documents, entries), tokenizer)
    sent = staging.spark.sparkContext.broadcast(frequent)
    packed_rows = documents.select(without_text(documents).alias("row"), "text", F.lit(0).cast("bigint").alias("n_tokens"))
    return packed_rows.mapInArrow(lambda b: _count(sent, tokenizer, b), packed_rows.schema)


def token_counts(staging: Staging, documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than 2048 tokens)."""
    counted = with_token_counts(staging, documents.select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return counted.select(F.col("row.doc_id").alias("doc_id"), n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
