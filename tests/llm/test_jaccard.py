import random
import re

import numpy as np

from hearthlake.llm import jaccard
from hearthlake.llm.components import components
from tests.llm.conftest import rows_of


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def by_hand(rows):
    sets, link = [shingles(t) for _, t in rows], {i: i for i in range(len(rows))}

    def root(i):
        while link[i] != i:
            i = link[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                link[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i][0])
    smallest = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return sorted(((rows[i][0], len(sets[i]), smallest[root(i)] if sets[i] else rows[i][0]) for i in range(len(rows))), key=repr)


def corpus(seed, families=12, size=14):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    for f in range(families):
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 12, 40, 90]))
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own).upper() if rng.random() < 0.1 else " ".join(own))
    for _ in range(25):
        rows.append(passage + " " + " ".join(rng.choices(vocabulary, k=rng.choice([5, 30, 90]))))
    rows += ["", None, " \n", "a", "A", "a b", "a b c", "a b c d", "a b c d"]
    ids = rng.sample(range(5000), len(rows))
    return list(zip(ids, rows, strict=True))


def test_components_against_brute_force(docs, staging):
    for seed in (1, 2):
        rows = corpus(seed)
        got = jaccard.linked_documents(staging, docs(rows).repartition(3))
        assert rows_of(got) == by_hand(rows)


def test_small_groups_and_few_counters_lose_no_link(docs, staging, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 3)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    rows = corpus(3, families=6)
    assert rows_of(jaccard.linked_documents(staging, docs(rows))) == by_hand(rows)


def test_odd_rows(docs, staging):
    long = " ".join(f"x{i}" for i in range(20_000))
    rows = [(5, long), (3, long + " y"), (None, long), (4, None), (4, ""), (9, "a b c d e"), (9, "a b c d e"), (None, "z z z z")]
    got = rows_of(jaccard.linked_documents(staging, docs(rows, signature="s", token="t")))
    assert got == by_hand(rows)
    assert jaccard.linked_documents(staging, docs([])).count() == 0
    assert rows_of(jaccard.linked_documents(staging, docs([(1, None)]))) == [(1, 0, 1)]


def test_one_of_each(docs, staging):
    rows = corpus(4, families=5)
    df = docs(rows, rep="r", group="g", n="n", _kept="k")
    kept = jaccard.one_of_each(staging, df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in by_hand(rows)})


def test_one_of_each_goes_by_row(docs, staging):
    same, other = "one two three four five", "six seven eight nine ten"
    rows = [(1, same), (1, other), (None, "a b c d e"), (None, "a b c d e"), (2, same), (None, same), (7, None), (7, None), (8, ""), (9, other), (9, other)]
    kept = jaccard.one_of_each(staging, docs(rows, _code="c", _row="w"))
    assert rows_of(kept, "doc_id", "text") == sorted([(1, same), (1, other), (None, "a b c d e"), (7, None), (7, None), (8, "")], key=repr)
    twice = docs([(3, same, "s2"), (3, same, "s1"), (3, same, "s1")])
    assert rows_of(jaccard.one_of_each(staging, twice)) == [(3, same, "s1")]
    assert jaccard.one_of_each(staging, docs([])).count() == 0


def test_opening_a_pair_finds_all_links():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) < 0.95], rng.integers(0, 1 << 60, k, dtype=np.uint64)])) for k in rng.integers(0, 30, 40)]
    a, b = (jaccard.Group(*jaccard.pack_group(list(range(20)), part).values()) for part in (sets[:20], sets[20:]))
    left, right = jaccard.open_pair(a, b, 85)
    want = {(i, j) for i in range(20) for j in range(20) if 100 * len(x := np.intersect1d(sets[i], sets[20 + j])) >= 85 * (len(sets[i]) + len(sets[20 + j]) - len(x))}
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == want and want


def test_components_of_a_long_chain_and_a_star(spark, staging):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1100)]
    got = dict(tuple(r) for r in components(staging, spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 7 for i in range(1000, 1100))
    assert components(staging, spark.createDataFrame([], "a bigint, b bigint")).count() == 0
