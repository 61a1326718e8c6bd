import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from hearthlake.llm import search
from hearthlake.llm.search import Heap, Items, Shard, Statistics
from tests.llm.conftest import rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def by_hand(docs, items, top=20):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, words = len(counted), sum(n for _, _, n in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // words
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m)) for w in terms(text) if w in c
            )
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def cases():
    rng = random.Random(3)
    words = ["a", "B1", "cé", "dd", "x"] + [f"w{i}" for i in range(200)]
    weights = [60, 40, 30, 20, 10] + [200 / (i + 1) for i in range(200)]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(900)]
    docs += [(901, None), (902, ""), (903, "?! ..."), (904, "a " * 20_000 + "w7"), (5, "w199 twin"), (5, "w199 twin"), (None, "w199 twin"), (None, docs[3][1])]
    docs += [(1000 + i, "w198 w198 tie") for i in range(30)]
    items = [(i, text(rng.choice([1, 3, 40]))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "w199 W199 twin"), (54, "tie"), (None, "tie w7"), (3, "dd"), (3, "dd"), (55, "a")]
    return docs, items


def test_search_against_brute_force(spark, docs, staging, monkeypatch):
    own, items = cases()
    frame = docs(own, score="s", item_id="i", rank="r").repartition(3)
    benchmark = spark.createDataFrame([(*i, "c") for i in items], "item_id bigint, text string, doc_id string")
    index = staging.keep(search.build_index(frame, shard_words=3000), "index")
    assert index.count() > 5
    assert rows_of(search.search(spark, index, benchmark), "item_id", "rank", "doc_id", "score") == by_hand(own, items)
    monkeypatch.setattr(search, "ITEM_CHARS", 300)
    assert len(search.item_parts(benchmark)) > 2
    assert rows_of(search.search(spark, index, benchmark, 3), "item_id", "rank", "doc_id", "score") == by_hand(own, items, 3)


def test_empty_tables(spark, docs, staging):
    benchmark = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for own in ([], [(1, None), (2, "!")]):
        assert search.ranked_documents(staging, docs(own), benchmark).count() == 0
    assert search.ranked_documents(staging, docs([(1, "a")]), benchmark.limit(0)).count() == 0


def test_packed_values_come_back():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << b, 300) for b in (3, 9, 20, 31, 8, 16)])
    starts = np.arange(0, len(values), 100)
    width, data = search.pack_values(values, starts)
    assert set(width.tolist()) == {1, 2, 4}
    size = width.astype(np.int64) * 100
    some = np.array([0, 3, 4, 9, 17])
    got = search.unpack_values(np.frombuffer(data, np.uint8), width[some].astype(np.int64), np.full(5, 100), (np.cumsum(size) - size)[some])
    assert got.tolist() == np.concatenate([values[100 * i : 100 * i + 100] for i in some]).tolist()


def one_shard(own):
    batch = search.pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in own], "text": [t for _, t in own]})
    return next(iter(search._index([batch]))).to_pylist()[0]


def opened(own, item):
    items = Items.of([(1, item)])
    row = one_shard(own)
    shard = Shard(row, items.vocabulary)
    df = np.zeros(len(items.vocabulary), np.int64)
    df[shard.term] = shard.df
    statistics = Statistics(row["docs"], row["words"], df)
    bounds = np.zeros(len(df), np.int64)
    bounds[shard.term] = [shard.block_shares(statistics, i).max() for i in range(len(shard.term))]
    heap, seen = Heap(20), {}
    search.search_shard(shard, items, statistics, bounds, [heap], seen)
    got = [(1, r, int(d), int(s)) for r, (d, s) in enumerate(zip(heap.ids, heap.scores), 1)]
    assert sorted(got, key=repr) == by_hand(own, [(1, item)])
    return seen


def test_blocks_that_cannot_matter_stay_closed():
    """Rare words settle the best documents; a word of every document is opened where they are, nowhere else."""
    own = [(i, "the common filler text here " + ("rare rarer" if 4000 <= i < 4100 else "")) for i in range(20_000)]
    seen = opened(own, "rare rarer the common")
    assert 0 < seen["opened"] < seen["blocks"] / 20


@pytest.mark.parametrize("word", ["b", "a b"])
def test_block_maxima_reject_candidates(word):
    """Candidates whose block of the frequent list has only long documents are dropped before it is opened."""
    own = [(i, "a " + ("b b b" if i < 1000 else "b " + "z " * 400)) for i in range(5000)]
    opened(own, f"a {word} z")


def test_best_pairs_are_those_that_no_other_beats():
    rng = np.random.default_rng(2)
    tf, length = rng.integers(1, 6, 500), rng.integers(1, 40, 500)
    starts = np.array([0, 1, 2, 130, 131, 400])
    counts, places = search.best_pairs(tf, length, starts)
    ends = np.append(starts[1:], 500)
    at = 0
    for s, e, n in zip(starts, ends, counts, strict=True):
        own = {(int(tf[p]), int(length[p])) for p in places[at : at + n]}
        every = {(int(t), int(x)) for t, x in zip(tf[s:e], length[s:e])}
        want = {(t, x) for t, x in every if not any((a >= t and b < x) or (a > t and b <= x) for a, b in every)}
        assert own == want and n == len(want)
        at += n
