"""Ranked lexical search by Block-Max MaxScore over index shards.

The index is a table of shards, each a run of documents: per term the postings (document
and count) in compressed blocks, and per block the pairs (count, document length) that
no other posting of the block beats. A score grows with the count and falls with the length,
so once the corpus is counted these pairs give each block's exact highest score. A search
takes an item's lists from the highest global bound down; as soon as the bounds of what is
left cannot lift a new document over the threshold, only known candidates go on, and a
candidate whose block maxima cannot either is dropped before the block is decompressed.
Each task keeps one heap an item over all its shards; heaps are merged at the end.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthlake.llm.words import alnum_words
from hearthlake.session import Staging

TOP = 20
#: Postings of a block; words of a shard, unless one document has more.
BLOCK, SHARD_WORDS = 128, 4_000_000
#: Characters of items that are searched together; more are taken in several rounds over the index.
ITEM_CHARS = 8_000_000

SHARD = (
    "docs bigint, words bigint, doc_ids binary, known binary, lengths binary, terms binary, df binary, "
    "first binary, gap_width binary, tf_width binary, pair_counts binary, pair_tf binary, pair_length binary, gaps binary, tfs binary"
)


# -- building ------------------------------------------------------------------
def _width(most: np.ndarray) -> np.ndarray:
    """Bytes a value needs: 1, 2 or 4."""
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.uint8)


def pack_values(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(width of each block, bytes): the values of a block in the fewest whole bytes that hold them all."""
    if not len(starts):
        return np.zeros(0, np.uint8), b""
    counts = np.diff(np.append(starts, len(values)))
    width = _width(np.maximum.reduceat(values, starts))
    own = np.repeat(width, counts).astype(np.int64)
    place = np.cumsum(own) - own
    out = np.zeros(int(own.sum()), np.uint8)
    for w in (1, 2, 4):
        some = np.flatnonzero(own == w)
        out[place[some][:, None] + np.arange(w)] = values[some].astype(f"<u{w}").view(np.uint8).reshape(-1, w)
    return width, out.tobytes()


def unpack_values(data: np.ndarray, width: np.ndarray, counts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The values of some blocks, one block after the other. ``places``: where each block's bytes begin."""
    own = np.repeat(width, counts).astype(np.int64)
    within = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(places, counts) + own * within
    out = np.empty(len(own), np.int64)
    for w in (1, 2, 4):
        some = np.flatnonzero(own == w)
        out[some] = np.ascontiguousarray(data[at[some][:, None] + np.arange(w)]).view(f"<u{w}").ravel()
    return out


def best_pairs(tf: np.ndarray, length: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of each block, place of each pair): postings that no other of their block beats in both count and length."""
    counts = np.diff(np.append(starts, len(tf)))
    if not len(tf):
        return counts, np.zeros(0, np.int64)
    block = np.repeat(np.arange(len(starts)), counts)
    alone = counts[block] == 1
    several = np.flatnonzero(~alone)
    order = several[np.lexsort((length[several], -tf[several], block[several]))]
    # The least length so far within the block: later blocks lie lower by more than any length.
    level = length[order] - block[order] * (int(length.max()) + 1)
    least = np.minimum.accumulate(level) if len(level) else level
    new = np.ones(len(order), bool)
    new[1:] = (level[1:] < least[:-1]) | (block[order][1:] != block[order][:-1])
    places = np.concatenate([np.flatnonzero(alone), order[new]])
    places = places[np.argsort(block[places], kind="stable")]
    return np.bincount(block[places], minlength=len(starts)), places


def pack_shard(doc_ids: list, word_counts: np.ndarray, terms: list[bytes], ids: np.ndarray) -> dict[str, object]:
    """One shard. ``ids``: the term number of every word of its documents, in order; each term occurs."""
    lengths = word_counts
    doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    code = np.sort(ids.astype(np.int64) << 32 | doc)
    edge = np.flatnonzero(np.diff(code, prepend=-1))
    tf = np.diff(np.append(edge, len(code)))
    term, doc = code[edge] >> 32, code[edge] & 0xFFFFFFFF
    df = np.bincount(term, minlength=len(terms))
    in_list = np.arange(len(term)) - np.repeat(np.cumsum(df) - df, df)
    starts = np.flatnonzero(in_list % BLOCK == 0)
    gap = np.diff(doc, prepend=0)
    gap[starts] = 0
    gap_width, gaps = pack_values(gap, starts)
    tf_width, tfs = pack_values(tf, starts)
    pairs, place = best_pairs(tf, lengths[doc], starts)
    return {
        "docs": int((lengths > 0).sum()),
        "words": int(lengths.sum()),
        "doc_ids": np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        "known": np.array([i is not None for i in doc_ids], "u1").tobytes(),
        "lengths": lengths.astype("<i8").tobytes(),
        "terms": b" ".join(terms),
        "df": df.astype("<u4").tobytes(),
        "first": doc[starts].astype("<u4").tobytes(),
        "gap_width": gap_width.tobytes(),
        "tf_width": tf_width.tobytes(),
        "pair_counts": pairs.astype("<u2").tobytes(),
        "pair_tf": tf[place].astype("<u4").tobytes(),
        "pair_length": lengths[doc[place]].astype("<i8").tobytes(),
        "gaps": gaps,
        "tfs": tfs,
    }


def _shard_batch(row: dict[str, object]) -> pa.RecordBatch:
    kinds = {"docs": pa.int64(), "words": pa.int64()}
    return pa.RecordBatch.from_pydict({k: pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()})


def _index(batches, shard_words=SHARD_WORDS):
    def fresh():
        return [], [], [], defaultdict(count().__next__)

    doc_ids, lengths, parts, number = fresh()
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = alnum_words(text.as_py())
            doc_ids.append(doc_id)
            lengths.append(len(words))
            parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            held += len(words)
            if held >= shard_words:
                yield _shard_batch(pack_shard(doc_ids, np.array(lengths, np.int64), list(number), np.concatenate(parts)))
                (doc_ids, lengths, parts, number), held = fresh(), 0
    if held:
        yield _shard_batch(pack_shard(doc_ids, np.array(lengths, np.int64), list(number), np.concatenate(parts)))


def build_index(documents: DataFrame, id_column: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index shards of ``documents``; every task makes its own, from whole texts, without a shuffle.

    Documents without a term count nowhere. Write the result where it can be read again.
    """
    return documents.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(lambda b: _index(b, shard_words), SHARD)


# -- reading ---------------------------------------------------------------------
@dataclass
class Statistics:
    """N, L, and for every term of the items its df and weight."""

    n: int
    words: int
    df: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        return np.floor(1000 * np.log((2 * self.n + 2) / (2 * self.df + 1))).astype(np.int64)

    def share(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What a posting gives, before its term's weight."""
        m = 75 + (25 * length * self.n) // self.words
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Shard:
    """A shard opened for the terms of the items. Lists are numbered by those terms."""

    def __init__(self, row: dict[str, object], vocabulary: dict[bytes, int]):
        array = lambda name, kind: np.frombuffer(row[name], kind)
        term = np.fromiter(map(vocabulary.get, row["terms"].split(b" "), repeat(-1)), np.int64)
        self.own = np.flatnonzero(term >= 0)
        self.term, self.df = term[self.own], array("df", "<u4").astype(np.int64)
        if "first" not in row:
            self.df = self.df[self.own]
            return
        blocks = -(-self.df // BLOCK)
        begin = np.cumsum(blocks) - blocks
        self.begin, self.blocks = begin[self.own], blocks[self.own]
        list_of = np.repeat(np.arange(len(blocks)), blocks)
        self.counts = np.minimum(BLOCK, self.df[list_of] - BLOCK * (np.arange(len(list_of)) - begin[list_of]))
        self.df = self.df[self.own]
        pairs = array("pair_counts", "<u2").astype(np.int64)
        self.pair_begin = np.append(np.cumsum(pairs) - pairs, pairs.sum())
        self.pair_tf, self.pair_length = array("pair_tf", "<u4"), array("pair_length", "<i8")
        if "gaps" in row:
            self.first, self.lengths = array("first", "<u4").astype(np.int64), array("lengths", "<i8")
            self.doc_ids, self.known = array("doc_ids", "<i8"), array("known", "u1")
            self.gap_width, self.tf_width = array("gap_width", "u1").astype(np.int64), array("tf_width", "u1").astype(np.int64)
            self.gap_at = np.cumsum(self.gap_width * self.counts) - self.gap_width * self.counts
            self.tf_at = np.cumsum(self.tf_width * self.counts) - self.tf_width * self.counts
            self.gaps, self.tfs = array("gaps", "u1"), array("tfs", "u1")
            self.opened = 0

    def block_shares(self, statistics: Statistics, i: int) -> np.ndarray:
        """The highest share in each block of the i-th list."""
        low, high = self.pair_begin[self.begin[i]], self.pair_begin[self.begin[i] + self.blocks[i]]
        share = statistics.share(self.pair_tf[low:high].astype(np.int64), self.pair_length[low:high])
        return np.maximum.reduceat(share, self.pair_begin[self.begin[i] : self.begin[i] + self.blocks[i]] - low)

    def decompress(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, count) of the postings of some blocks of one list, in order."""
        self.opened += len(blocks)
        counts = self.counts[blocks]
        gap = unpack_values(self.gaps, self.gap_width[blocks], counts, self.gap_at[blocks])
        tf = unpack_values(self.tfs, self.tf_width[blocks], counts, self.tf_at[blocks])
        # Gaps add up from each block's first document.
        begin = np.cumsum(counts) - counts
        total = np.cumsum(gap)
        return total + np.repeat(self.first[blocks] - total[begin], counts), tf


class OpenList:
    """One list of a shard: block maxima, and the postings of the blocks opened so far. A block is decompressed once."""

    def __init__(self, shard: Shard, i: int, statistics: Statistics):
        self.shard, self.statistics = shard, statistics
        self.blocks = shard.begin[i] + np.arange(shard.blocks[i])
        self.first, self.counts = shard.first[self.blocks], shard.counts[self.blocks]
        self.maxima = shard.block_shares(statistics, i)
        # Until a block is opened its first document stands in all its places, so documents ascend.
        self.docs, self.shares = np.repeat(self.first, self.counts), np.zeros(int(self.counts.sum()), np.int64)
        self.closed = np.ones(len(self.blocks), bool)

    def open(self, needed: np.ndarray) -> None:
        needed = needed[self.closed[needed]]
        if len(needed):
            docs, tf = self.shard.decompress(self.blocks[needed])
            n = self.counts[needed]
            at = np.repeat(BLOCK * needed - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            self.docs[at], self.shares[at] = docs, self.statistics.share(tf, self.shard.lengths[docs])
            self.closed[needed] = False

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that can hold each document, -1 before the first."""
        return np.searchsorted(self.first, docs, "right") - 1

    def share_of(self, docs: np.ndarray) -> np.ndarray:
        """The share of each document, 0 if the list lacks it; only for documents of opened blocks or of none."""
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[at] == docs, self.shares[at], 0)


@dataclass
class Items:
    """Items to search for, by number: id, and the numbers of their terms with how often each occurs."""

    ids: list
    terms: list[np.ndarray]
    times: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        number: dict[bytes, int] = defaultdict(count().__next__)
        ids, terms, times = [], [], []
        for item, text in rows:
            own = Counter(alnum_words(text))
            ids.append(item)
            terms.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
            times.append(np.fromiter(own.values(), np.int64, len(own)))
        return cls(ids, terms, times, dict(number))


class Heap:
    """The best documents so far of one item: score, id (NULL last among equals)."""

    def __init__(self, size: int):
        self.size = size
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    @property
    def least(self) -> int:
        """What a document must reach to get in: as much as the last one, or anything above 0."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.size else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        best = np.lexsort((ids, 1 - known.astype(np.int64), -scores))[: self.size]
        self.scores, self.ids, self.known = scores[best], ids[best], known[best]


def nth_largest(values: np.ndarray, n: int) -> int:
    return int(np.partition(values, len(values) - n)[len(values) - n])


def search_shard(shard: Shard, items: Items, statistics: Statistics, bounds: np.ndarray, heaps: list[Heap], opened: dict | None = None) -> None:
    """Adds the shard's best documents to the heaps. ``bounds``: the highest share of each term in the whole corpus."""
    place = np.full(len(bounds), -1)
    place[shard.term] = np.arange(len(shard.term))
    weights, opened_lists = statistics.weights, {}
    score = np.zeros(len(shard.lengths), np.int64)

    def posting_list(term: int) -> OpenList:
        if term not in opened_lists:
            opened_lists[term] = OpenList(shard, int(place[term]), statistics)
        return opened_lists[term]

    for terms, times, heap in zip(items.terms, items.times, heaps, strict=True):
        here = place[terms] >= 0
        lists, times = terms[here], times[here]
        factor = weights[lists] * times
        bound = factor * bounds[lists]
        order = np.argsort(-bound, kind="stable")
        lists, factor, bound = lists[order].tolist(), factor[order], bound[order]
        rest = np.append(np.cumsum(bound[::-1])[::-1], 0)
        seen, least, k = [], heap.least, 0
        # Essential lists: any of their documents can still get in.
        while k < len(lists) and rest[k] >= least:
            own = posting_list(lists[k])
            own.open(np.arange(len(own.blocks)))
            fresh = own.docs[score[own.docs] == 0]
            score[own.docs] += factor[k] * own.shares
            seen.append(fresh[score[fresh] > 0])
            k += 1
            if sum(map(len, seen)) >= heap.size:
                seen = [np.concatenate(seen)]
                least = max(least, nth_largest(score[seen[0]], heap.size))
        everyone = candidates = np.concatenate(seen) if seen else np.zeros(0, np.int64)
        sums = score[candidates]
        # Other lists: a candidate goes on only if its block's maximum and the bounds of the lists behind it suffice.
        for k in range(k, len(lists)):
            own = posting_list(lists[k])
            block = own.block_of(candidates)
            most = np.where(block >= 0, factor[k] * own.maxima[np.maximum(block, 0)], 0)
            stays = sums + most + rest[k + 1] >= least
            candidates, sums, block = candidates[stays], sums[stays], block[stays]
            if not len(candidates):
                break
            needed = np.unique(block)
            own.open(needed[needed >= 0])
            sums = sums + factor[k] * np.where(block >= 0, own.share_of(candidates), 0)
            if len(sums) >= heap.size:
                least = max(least, nth_largest(sums, heap.size))
        score[everyone] = 0
        good = sums >= least
        heap.add(sums[good], shard.doc_ids[candidates[good]], shard.known[candidates[good]])
    if opened is not None:
        opened["opened"] = opened.get("opened", 0) + shard.opened
        opened["blocks"] = opened.get("blocks", 0) + int(shard.blocks.sum())


def _rows(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            yield {name: batch.column(name)[row].as_py() for name in batch.schema.names}


def _count_terms(items, batches):
    df = np.zeros(len(items.vocabulary), np.int64)
    n = words = 0
    for row in _rows(batches):
        shard = Shard(row, items.vocabulary)
        df[shard.term] += shard.df
        n, words = n + row["docs"], words + row["words"]
    some = np.flatnonzero(df)
    # Term -1 and -2: N and L.
    yield pa.RecordBatch.from_pydict({"term": pa.array([-1, -2, *some.tolist()], pa.int64()), "n": pa.array([n, words, *df[some].tolist()], pa.int64())})


def _bound_terms(items, statistics, batches):
    most = np.zeros(len(items.vocabulary), np.int64)
    for row in _rows(batches):
        shard = Shard(row, items.vocabulary)
        own = np.array([shard.block_shares(statistics, i).max() for i in range(len(shard.term))], np.int64)
        most[shard.term] = np.maximum(most[shard.term], own)
    some = np.flatnonzero(most)
    yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "most": pa.array(most[some], pa.int64())})


def _search(items, statistics, bounds, top, batches):
    heaps = [Heap(top) for _ in items.ids]
    for row in _rows(batches):
        search_shard(Shard(row, items.vocabulary), items, statistics, bounds, heaps)
    number = np.repeat(np.arange(len(heaps)), [len(h.scores) for h in heaps])
    joined = lambda name, kind: np.concatenate([getattr(h, name) for h in heaps] or [np.zeros(0, kind)])
    yield pa.RecordBatch.from_pydict(
        {
            "item": pa.array(number, pa.int64()),
            "doc_id": pa.array(joined("ids", np.int64), pa.int64(), mask=joined("known", np.uint8) == 0),
            "score": pa.array(joined("scores", np.int64), pa.int64()),
        }
    )


def item_parts(items: DataFrame) -> list[DataFrame]:
    """(item_id, text) in parts of about ``ITEM_CHARS``, so that what is sent to every task has a bound."""
    named = items.select("item_id", "text")
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // ITEM_CHARS))
    return [named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def search(spark: SparkSession, index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of each item with a score above 0.

    ``index`` is a stored result of ``build_index`` and is read three times per part of the items:
    term counts, then the highest share of each term, then the search; the first two read only the columns
    they need. Equal scores rank by doc_id, NULL ids last. Every item row is ranked on its own, also one that
    repeats an id or has none; items without a term have no rows. No document or no item: no rows.
    """
    found = None
    kind = dict(items.dtypes)["item_id"]
    for part in item_parts(items):
        own = Items.of([tuple(r) for r in part.collect()])
        sent = spark.sparkContext.broadcast(own)
        counted = index.select("docs", "words", "terms", "df").mapInArrow(lambda b, sent=sent: _count_terms(sent.value, b), "term bigint, n bigint")
        totals = dict(counted.groupBy("term").agg(F.sum("n")).collect())
        df = np.zeros(len(own.vocabulary), np.int64)
        for term, n in totals.items():
            if term >= 0:
                df[term] = n
        statistics = Statistics(totals.get(-1, 0), max(1, totals.get(-2, 0)), df)
        bounded = index.select("terms", "df", "first", "pair_counts", "pair_tf", "pair_length").mapInArrow(
            lambda b, sent=sent, statistics=statistics: _bound_terms(sent.value, statistics, b), "term bigint, most bigint"
        )
        bounds = np.zeros(len(own.vocabulary), np.int64)
        for term, most in bounded.groupBy("term").agg(F.max("most")).collect():
            bounds[term] = most
        state = spark.sparkContext.broadcast((statistics, bounds))
        heaps = index.mapInArrow(
            lambda b, sent=sent, state=state: _search(sent.value, *state.value, top, b), "item bigint, doc_id bigint, score bigint"
        )
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(own.ids)), f"item bigint, item_id {kind}")
        ranked = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = ranked if found is None else found.unionByName(ranked)
    return found


def ranked_documents(staging: Staging, documents: DataFrame, items: DataFrame) -> DataFrame:
    """Builds the index of ``documents`` (doc_id, text), stores it, and searches it for every item."""
    return search(staging.spark, staging.keep(build_index(documents), "index"), items)


SQL = """
WITH words AS (
  SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), docs AS (
  SELECT doc_id, doc, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0
), totals AS (
  SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_words FROM docs
), postings AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(w) AS term FROM docs) GROUP BY doc, term
), item_words AS (
  SELECT item_id, row_number() OVER () AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), wanted AS (
  SELECT item_id, item, term, count(*)::BIGINT AS times FROM (SELECT item_id, item, unnest(w) AS term FROM item_words) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM postings WHERE term IN (SELECT term FROM wanted) GROUP BY term), totals
), scores AS (
  SELECT q.item_id, q.item, d.doc_id, d.doc,
    sum(q.times * t.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * all_docs) // all_words))))::BIGINT AS score
  FROM wanted q JOIN weights t USING (term) JOIN postings p USING (term) JOIN docs d USING (doc), totals
  GROUP BY q.item_id, q.item, d.doc_id, d.doc
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::BIGINT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
