import hashlib
import random
from fractions import Fraction

from pyspark.sql import functions as F

from hearthlake.llm import mixing
from tests.llm.conftest import rows_of


def targets_by_hand(sizes):
    """Repeated resharing of what capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, full, total = {}, set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        target = {s: Fraction(3 * sizes[s]) if s in full else Fraction(rest * weight[s], share) for s in sizes}
        over = {s for s in sizes if s not in full and target[s] >= 3 * sizes[s]}
        if not over:
            return target
        full |= over


def mixed_by_hand(rows):
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    target = targets_by_hand(sizes)
    place = {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    key = lambda r: (hashlib.md5(f"mix:{r[0]}".encode()).hexdigest(), r[0])
    queue = []
    for source in sizes:
        sent = 0
        for row in sorted((r for r in rows if r[1] == source), key=key):
            sent += row[2]
            for e in range(3):
                if e * sizes[source] < target[source]:
                    queue.append((float(sent + e * sizes[source]) / float(target[source]), place[source], sent, key(row)[0], row))
    taken, total, budget = dict.fromkeys(rows, 0), 0, round(sum(target.values()))
    for *_, row in sorted(queue, key=lambda q: q[:4]):
        total += row[2]
        if total > budget:
            break
        taken[row] += row[2]
    return {r[0]: t for r, t in taken.items()}, target


def test_mix_against_brute_force(docs, staging):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None, "d"]), rng.randint(1, 30)) for i in range(150)] + [(900, "tiny", 2)]
    df = docs([(i, " ".join(["w"] * n), s) for i, s, n in rows])
    taken, target = mixed_by_hand(rows)
    report = mixing.mix_report(staging, df).join(df.select("doc_id", "source"), "doc_id").collect()
    assert {r.doc_id: r.taken for r in report} == taken
    assert all(abs(r.target - float(target[r.source])) < 1e-6 and r.taken <= 3 * r.size for r in report)
    largest = max(n for _, _, n in rows)
    for source, want in target.items():
        assert abs(sum(r.taken for r in report if r.source == source) - want) <= 2 * largest


def test_rows_come_as_often_as_taken(docs, staging):
    df = docs([(i, " ".join(["w"] * (i % 7 + 1)), "ab"[i % 5 == 0]) for i in range(60)], _size="x", copies="y")
    report = {r.doc_id: r for r in mixing.mix_report(staging, df).collect()}
    mixed = mixing.mixed_documents(staging, df)
    assert mixed.columns == df.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: r.taken // r.size for i, r in report.items() if r.taken}


def test_odd_rows(docs, staging, spark):
    same = [(1, "a b"), (1, "a b"), (None, "c d e"), (2, None), (3, ""), (4, "  \t")]
    report = mixing.mix_report(staging, docs(same))
    assert report.count() == len(same) and report.agg(F.sum("taken")).first()[0] <= 7
    assert {(r.doc_id, r.size, r.taken) for r in report.collect()} >= {(2, 0, 0), (3, 0, 0), (4, 0, 0)}
    assert mixing.mix_report(staging, docs([])).count() == 0
    assert {r.taken for r in mixing.mix_report(staging, docs([(1, None), (2, "")])).collect()} == {0}
    assert mixing.mixed_documents(staging, docs([(1, None), (2, "")])).count() == 2


def test_reruns_agree(docs, staging):
    df = docs([(i, "w " * (i % 9), "abc"[i % 3]) for i in range(80)])
    assert rows_of(mixing.mix_report(staging, df)) == rows_of(mixing.mix_report(staging, df.repartition(7)))
