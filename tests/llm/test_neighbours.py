import numpy as np
from pyspark.sql import functions as F

from hearthlake.llm import neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def exact(rows, k, every):
    ids = np.array([r[0] for r in rows])
    own = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        cosine = (own * own[i]).sum(axis=1) / (np.sqrt((own * own).sum(axis=1)) * np.sqrt((own[i] ** 2).sum()))
        order = [j for j in np.lexsort((ids, -cosine)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(cosine[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_scores_against_brute_force(spark, staging, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 400)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(32).tolist(), 0) for i in range(1500)]
    want, got = exact(rows, 5, 50), found(neighbours.search(staging, vectors(spark, rows)))
    assert set(got) == set(want) and all(len(g) == 5 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, best in got.items():
        known = dict(exact([r for r in rows if r[0] in {q, *(i for i, _ in best)}], 5, q)[q]) if q else dict(best)
        assert all(abs(known[i] - s) < 1e-12 for i, s in best)
        assert best == sorted(best, key=lambda b: (-b[1], b[0]))


def test_few_odd_and_tied_rows(spark, staging):
    good = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [4.0, 0.0]), (50, [0.0, 1.0])]
    bad = [(4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 0.0]), (9, []), (None, [1.0, 1.0]), (11, [1.0])]
    got = found(neighbours.search(staging, vectors(spark, [(i, v, 0) for i, v in good + bad])))
    assert [i for i, _ in got[0]] == [2, 3, 50] and [i for i, _ in got[50]] == [0, 2, 3]
    assert neighbours.search(staging, vectors(spark, [])).count() == 0
    assert neighbours.search(staging, vectors(spark, [(50, [1.0, 2.0], 0)])).count() == 0
    assert neighbours.search(staging, vectors(spark, [(1, [1.0, 2.0], 0)])).count() == 0


def test_a_radius_returns_every_code_in_it():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (300, 4)).astype(np.uint16)
    codes[:50] = codes[0] ^ (1 << rng.integers(0, 16, (50, 4))).astype(np.uint16)
    shard = neighbours.Shard.of(np.arange(300), np.ones((300, 2)), codes)
    for radius in (0, 3, 8, 9, 20, 31, 64):
        want = np.flatnonzero(neighbours.distances(codes[:1], codes)[0] <= radius)
        assert shard.within(codes[0], radius, shard.tables()).tolist() == want.tolist()


def test_repeated_rows_count_once(spark, staging):
    rows = [(i % 60, [float(i % 60), 1.0], 0) for i in range(120)]
    got = neighbours.search(staging, vectors(spark, rows))
    assert got.groupBy("query_id", "vec_id").count().filter("count > 1").isEmpty() and got.agg(F.count("*")).first()[0] == 10


def test_all_vectors_of_an_id_are_candidates(spark, staging):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [1.0, 0.5]), (3, [-1.0, 0.2]), (3, [1.0, 0.2]), (50, [0.0, 2.0]), (50, [5.0, 0.0])]
    got = found(neighbours.search(staging, vectors(spark, [(i, v, 0) for i, v in rows])))
    assert [i for i, _ in got[0]] == [50, 1, 3, 2] and len(got[50]) == 4
    assert abs(got[0][1][1] - 1 / np.sqrt(1.01)) < 1e-7


def test_huge_and_tiny_values(spark, staging):
    rows = [(0, [3e38, 1e38]), (1, [3e-38, 1e-38]), (2, [1.0, -1.0]), (3, [1e-40, 0.0]), (4, [-3e38, 3e38])]
    got = found(neighbours.search(staging, vectors(spark, [(i, v, 0) for i, v in rows])))
    assert [i for i, _ in got[0]] == [1, 3, 2, 4] and all(np.isfinite(s) for _, s in got[0]) and got[0][0][1] > 0.999999


def test_the_sample_is_the_first_by_hash(spark, staging):
    rng = np.random.default_rng(3)
    rows = [(i // 2 * 7, rng.standard_normal(4).tolist(), 0) for i in range(600)]
    good = neighbours.usable(vectors(spark, rows)).repartition(7)
    want = [r.v for r in good.orderBy(F.xxhash64("vec_id"), "vec_id", "v").collect()]
    for n in (1, 40, 599, 600, 1000):
        first = neighbours.first_by_hash(staging, good, n).tolist()
        assert sorted(first) == sorted(want[:n])
        assert [first.index(v) // 2 for v in want[:n]] == [i // 2 for i in range(min(n, 600))]


def test_the_driver_gets_the_sample_once(spark, staging, monkeypatch):
    """No task sends the driver its own first rows: what it collects does not grow with the number of tasks."""
    monkeypatch.setattr(neighbours, "SAMPLE", 50)
    sizes, learn = [], neighbours.learn
    monkeypatch.setattr(neighbours, "learn", lambda v: sizes.append(len(v)) or learn(v))
    sent, frame = [], type(spark.range(1))
    for name in ("collect", "toArrow"):
        plan = lambda df, f=getattr(frame, name): sent.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or f(df)
        monkeypatch.setattr(frame, name, plan)
    rows = [(i, [float(i % 13 + 1), float(i % 7)], 0) for i in range(400)]
    neighbours.search(staging, vectors(spark, rows).repartition(8))
    plans = [plan for columns, plan in sent if "v" in columns]
    assert sizes == [50] and len(plans) == 1 and "TakeOrderedAndProject" not in plans[0]


def test_trials_in_blocks_give_the_same_radius(monkeypatch):
    own = np.random.default_rng(4).standard_normal((900, 16))
    monkeypatch.setattr(neighbours, "TRIALS", 90)
    whole = []
    for block in (90, 40, 7):
        monkeypatch.setattr(neighbours, "TRIAL_BLOCK", block)
        whole.append(neighbours.learn(own).radius)
    assert whole[0] > 0 and len(set(whole)) == 1
