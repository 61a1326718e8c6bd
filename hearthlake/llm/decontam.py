"""Benchmark decontamination by a prefix-filtered join of word windows.

A benchmark item stands for its windows of 13 consecutive words (or one shorter one). A
window is in a document only if all its shingles are, in their places, so one necessary
shingle is enough to find it: the one that is rarest in the documents. Documents' shingles
are joined with these prefixes; the shingle's place in the window bounds where the window
can lie in the document; what remains is compared word by word.

The benchmark is taken in blocks of bounded size, each small enough to be sent to every
task; any number of blocks gives the same result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.words import alnum_words, mix64
from hearthlake.session import Staging

WINDOW = 13
SHINGLE = 5
#: Characters of benchmark text in one block.
BLOCK_CHARS = 8_000_000
#: A document is contaminated if at least one word in so many is hit.
HIT_SHARE = 20


@dataclass
class Block:
    """Windows of some items. ``ids`` has one row per window, padded with 0; words start at 1."""

    vocabulary: dict[bytes, int]
    ids: np.ndarray
    lengths: np.ndarray
    items: list[str | None]
    item_of: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[str | None, str]]) -> Block:
        vocabulary: dict[bytes, int] = {}
        windows, item_of, items = [], [], []
        for item, text in rows:
            words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in alnum_words(text)]
            if not words:
                continue
            length = min(WINDOW, len(words))
            for i in range(len(words) - length + 1):
                windows.append(words[i : i + length])
                item_of.append(len(items))
            items.append(item)
        ids = np.zeros((len(windows), WINDOW), np.int32)
        for row, window in zip(ids, windows, strict=True):
            row[: len(window)] = window
        return cls(vocabulary, ids, np.array([len(w) for w in windows], np.int64), items, np.array(item_of, np.int64))

    def widths(self) -> list[int]:
        """Shingle lengths in use: 5, and those of windows with fewer words."""
        return sorted({int(min(SHINGLE, n)) for n in np.unique(self.lengths)})

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, place, hash) of every shingle of the windows that use this width."""
        own = np.flatnonzero(np.minimum(self.lengths, SHINGLE) == width)
        window, place, code = [], [], []
        for p in range(WINDOW - width + 1):
            fits = own[self.lengths[own] >= p + width]
            window.append(fits)
            place.append(np.full(len(fits), p))
            code.append(shingle_codes(self.ids[fits, p : p + width].reshape(-1), width)[::width][: len(fits)])
        return np.concatenate(window), np.concatenate(place), np.concatenate(code)


def shingle_codes(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code of the ``width`` ids from each place on (fewer places than ids)."""
    total = np.zeros(max(0, len(ids) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + mix64(ids[j : j + len(total)])
    return total


@dataclass
class Words:
    """The words of many documents in one array, an unknown word (0) between documents."""

    ids: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None], vocabulary: dict[bytes, int]) -> Words:
        get, parts, counts = vocabulary.get, [], []
        gap = np.zeros(1, np.int32)
        for text in texts:
            words = alnum_words(text)
            counts.append(len(words))
            parts += [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)), gap]
        counts = np.array(counts, np.int64)
        starts = np.cumsum(counts + 1) - counts - 1
        return cls(np.concatenate(parts) if parts else gap[:0], starts, counts)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, code) of the shingles made of known words only."""
        known = np.concatenate([[0], np.cumsum(self.ids != 0)])
        places = np.flatnonzero(known[width:] - known[:-width] == width)
        code = np.zeros(len(places), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(width):
                code = code * np.uint64(0x9E3779B97F4A7C15) + mix64(self.ids[places + j])
        return places, code


def _count_shingles(block, batches):
    """Per task: how often each shingle of the block occurs in its documents."""
    codes = np.unique(np.concatenate([block.shingles(w)[2] for w in block.widths()]))
    counts = np.zeros(len(codes), np.int64)
    for batch in batches:
        words = Words.of(batch.column(0).to_pylist(), block.vocabulary)
        for width in block.widths():
            found = words.shingles(width)[1]
            at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
            counts += np.bincount(at[codes[at] == found], minlength=len(codes))
    some = counts > 0
    yield pa.RecordBatch.from_pydict({"code": codes[some].view(np.int64), "n": counts[some]})


@dataclass
class Prefixes:
    """For each width: the codes of the windows' rarest shingles, sorted, with window and place."""

    width: int
    codes: np.ndarray
    windows: np.ndarray
    places: np.ndarray


def rarest_prefixes(block: Block, counts: dict[int, int]) -> list[Prefixes]:
    out = []
    for width in block.widths():
        window, place, code = block.shingles(width)
        often = np.fromiter((counts.get(int(c), 0) for c in code.view(np.int64)), np.int64, len(code))
        order = np.lexsort((place, code, often, window))
        first = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
        first = first[often[first] > 0]  # a shingle that no document has rules its window out
        first = first[np.argsort(code[first], kind="stable")]
        out.append(Prefixes(width, code[first], window[first], place[first]))
    return out


def find_windows(words: Words, block: Block, prefixes: list[Prefixes]) -> tuple[np.ndarray, np.ndarray]:
    """(start, window) of every occurrence of a window in the documents."""
    starts, windows = [], []
    end = words.starts + words.counts
    for p in prefixes:
        at, code = words.shingles(p.width)
        low, high = np.searchsorted(p.codes, code, "left"), np.searchsorted(p.codes, code, "right")
        n = high - low
        entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window, start = p.windows[entry], np.repeat(at, n) - p.places[entry]
        doc = np.searchsorted(words.starts, np.repeat(at, n), "right") - 1
        fits = (start >= words.starts[doc]) & (start + block.lengths[window] <= end[doc])
        window, start = window[fits], start[fits]
        padded = np.concatenate([words.ids, np.zeros(WINDOW, np.int32)])
        same = np.ones(len(start), bool)
        for j in range(WINDOW):
            same &= (padded[start + j] == block.ids[window, j]) | (j >= block.lengths[window])
        starts.append(start[same])
        windows.append(window[same])
    return np.concatenate(starts), np.concatenate(windows)


def _merge(spans: list[int]) -> list[int]:
    """Flat [start, end, ...] with overlaps and touching spans joined."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _mark(block, prefixes, batches):
    for batch in batches:
        texts, spans, items = (batch.column(c).to_pylist() for c in ("text", "spans", "items"))
        words = Words.of(texts, block.vocabulary)
        start, window = find_windows(words, block, prefixes)
        doc = np.searchsorted(words.starts, start, "right") - 1
        local = start - words.starts[doc]
        for d, s, e, i in zip(doc.tolist(), local.tolist(), (local + block.lengths[window]).tolist(), block.item_of[window].tolist(), strict=True):
            spans[d] += (s, e)
            if block.items[i] is not None:
                items[d].append(block.items[i])
        for d in np.unique(doc).tolist():
            spans[d], items[d] = _merge(spans[d]), sorted(set(items[d]))
        new = {
            "n_words": pa.array(words.counts, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.int64())),
            "items": pa.array(items, pa.list_(pa.string())),
        }
        yield pa.RecordBatch.from_arrays([new.get(f.name, batch.column(f.name)) for f in batch.schema], names=batch.schema.names)


def blocks(benchmark: DataFrame) -> list[DataFrame]:
    """(item_id as text, text) of the benchmark in parts of about ``BLOCK_CHARS``."""
    named = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text is not null")
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    return [named.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == i) for i in range(n)]


def mark_hits(staging: Staging, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` with what they share with the benchmark: (row, text, n_words, spans, items).

    ``row`` is a struct of all input columns but text, so no name can clash. ``spans``: flat
    starts and ends (exclusive) of the hit words, merged, in order. ``items``: ids as text,
    sorted as strings. NULL and empty texts have no words and no hits; items without
    words find nothing; items without id hit words but are not among ``items``; items with one id count as one; rows are never merged or dropped.
    """
    spark = documents.sparkSession
    rest = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_"))
    none = [F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items")]
    marked = documents.select(row.alias("row"), "text", *none)
    parts = blocks(benchmark) or [benchmark.select(F.lit("").alias("item"), "text").limit(0)]
    for i, part in enumerate(parts):
        block = Block.of([tuple(r) for r in part.collect()])
        sent = spark.sparkContext.broadcast(block)
        counts: dict[int, int] = {}
        if len(block.lengths):
            seen = documents.select("text").mapInArrow(lambda b, sent=sent: _count_shingles(sent.value, b), "code bigint, n bigint")
            counts = dict(seen.groupBy("code").agg(F.sum("n")).toLocalIterator())
        prefixes = spark.sparkContext.broadcast(rarest_prefixes(block, counts) or [Prefixes(1, *[np.zeros(0, t) for t in (np.uint64, np.int64, np.int64)])])
        schema = marked.schema
        marked = marked.mapInArrow(lambda b, sent=sent, prefixes=prefixes: _mark(sent.value, prefixes.value, b), _nullable(schema))
        if i < len(parts) - 1:
            marked = staging.keep(marked, f"block{i}")
    return marked


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def hit_words() -> F.Column:
    ends = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: x - total)
    return F.when(F.size("spans") > 0, ends).otherwise(F.lit(0).cast("bigint"))


def contaminated() -> F.Column:
    return (hit_words() > 0) & (F.lit(HIT_SHARE) * hit_words() >= F.col("n_words"))


def contamination(staging: Staging, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = mark_hits(staging, documents.select("doc_id", "text"), benchmark)
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def clean_documents(staging: Staging, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns."""
    marked = mark_hits(staging, documents, benchmark).filter(~contaminated())
    return marked.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT DISTINCT doc_id, i, p.n, item FROM places p JOIN windows USING (n, k)
), hit AS (
  SELECT doc_id, count(DISTINCT word_at) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word_at FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
