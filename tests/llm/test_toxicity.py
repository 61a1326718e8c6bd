import random
from zlib import crc32

import numpy as np
import pytest

from hearthlake.llm import gru, toxicity


def corpus(n, seed=1):
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choices("the an er on re st ha".split(), k=rng.randint(1, 4)))
    for i in range(n):
        words = [word() for _ in range(rng.choice([20, 60, 200]))]
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["moron", "scum", "losers", "clown"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def frames(spark, docs, rows, **more):
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    return docs([(i, t) for i, t, _ in rows], **more), labels


def test_held_out_accuracy(spark, docs):
    rows = corpus(600)
    got = {r.doc_id: r for r in toxicity.toxicity(*frames(spark, docs, rows)).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert all(got[i].held_out == (crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert sum(y for _, y in held) > 10 and np.mean([p == y for p, y in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_odd_rows(spark, docs):
    rows = corpus(200) + [(900, None, 0), (901, "", 0), (902, " ?!", 1), (904, "fine words " * 30_000 + "moron scum losers clown", 0)]
    df, labels = frames(spark, docs, rows, score="s", row="r", label="l")
    labels = labels.union(spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, 1), (3, 0)], labels.schema))
    df = df.union(df.filter("doc_id = 5"))
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == len(rows) + 1 and len({r.score for r in got if r.doc_id == 5}) == 1
    scores = {r.doc_id: r.score for r in got}
    assert scores[900] == scores[901] == scores[902] < 0.5 and scores[904] >= 0.5
    kept = toxicity.accepted_documents(df, labels)
    assert kept.columns == df.columns and kept.filter("doc_id = 904").isEmpty() and kept.filter("doc_id in (900, 901)").count() == 2
    assert toxicity.toxicity(df.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.toxicity(df.limit(5), labels.limit(0)).collect()} == {0.0}


def test_windows_cover_and_overlap():
    for n in (0, 1, 47, 48, 49, 72, 73, 500):
        starts = toxicity.window_starts(n)
        seen = {w for s in starts for w in range(s, min(s + toxicity.WINDOW, n))}
        assert seen == set(range(n)) and len(starts) == len(set(starts.tolist()))


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    network = gru.Network({k: v.astype(np.float64) for k, v in gru.Network.new(3).p.items()})
    x = np.concatenate([np.zeros((1, gru.INPUT)), rng.standard_normal((6, gru.INPUT))])
    places, y, w = rng.integers(0, 7, (5, 4)), np.array([0, 1, 1, 0.0]), np.array([1, 2, 1, 1.0])
    places[0] = 1

    def loss():
        logit = network.logits(network.projected(x), places)
        return (w * (np.logaddexp(0, logit) - y * logit)).sum() / w.sum()

    # Hidden states are single precision, so differences are taken wide.
    g = network.gradients(x, places, y, w)
    for name, grad in g.items():
        value = network.p[name]
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(3)]:
            old, step = value[at], 3e-2
            value[at] = old + step
            up = loss()
            value[at] = old - step
            down = loss()
            value[at] = old
            assert grad[at] == pytest.approx((up - down) / (2 * step), abs=2e-3), name


def test_unseen_words_are_read_by_their_letters():
    table = gru.WordTable.of([b"abc", b"abcd", b"q"])
    assert table.counts().tolist() == [3 + 2 + 1, 4 + 3 + 2, 1]
    shared = set(table.gram[:6]) & set(table.gram[6:15])
    assert len(shared) >= 3
