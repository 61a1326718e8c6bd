import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from hearthlake.llm import decontam
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item, body in items:
            w = words(body)
            n = min(13, len(w))
            for i in range(len(w) - n + 1 if w else 0):
                for j in range(len(own) - n + 1):
                    if own[j : j + n] == w[i : i + n]:
                        hit |= set(range(j, j + n))
                        found |= {str(item)} if item is not None else set()
        out.append((doc_id, len(own), len(hit), len(found), decontam.items_digest(list(found)), len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "dé", "e1", "Ff"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([13, 14, 20, 30]))) for i in range(8)] + [(9, "x y z"), (10, "q"), (11, ""), (12, "x y z"), (20, "A, a; A!")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(20)]
    docs += [(100 + i, f"{text(5)} {body.upper() if i % 2 else body} {text(7)}") for i, (_, body) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "?!"), (203, items[0][1] + " " + items[0][1]), (203, "x y z"), (None, "x Y-z"), (204, "w " * 3000 + "x y z")]
    return docs, items


def test_contamination_against_brute_force(spark, docs, staging):
    own, items = cases()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.contamination(staging, docs(own), benchmark)
    assert rows_of(got) == by_hand(own, items)


def test_any_number_of_blocks_gives_the_same(spark, docs, staging, monkeypatch):
    own, items = cases()
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 100)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(decontam.blocks(benchmark)) > 2
    assert rows_of(decontam.contamination(staging, docs(own), benchmark)) == by_hand(own, items)


@pytest.mark.parametrize("items", [[], [(1, None), (None, None)], [(1, "..."), (None, "")]])
def test_nothing_to_find(spark, docs, staging, items):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.contamination(staging, docs([(1, "x y z"), (2, None)]), benchmark)
    assert {(r.n_hit, r.contaminated) for r in got.collect()} == {(0, False)}
    assert decontam.contamination(staging, docs([]), benchmark).count() == 0


def test_items_without_id_hit_words(spark, docs, staging, tmp_path):
    items = [(None, "x y z"), (None, "x y z"), (4, "q r"), (5, None)]
    own = [(1, "a x y z q r"), (2, "x y z"), (3, "q r"), (4, None)]
    got = decontam.contamination(staging, docs(own), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows_of(got) == by_hand(own, items)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", own)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.execute(decontam.SQL).fetchall(), key=repr) == by_hand(own, items)


def test_clean_documents_keep_all_columns(spark, docs, staging):
    own, items = cases()
    df = docs(own, spans="s", n_words="n", row="r", items="i")
    kept = decontam.clean_documents(staging, df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == df.columns
    bad = [r[0] for r in by_hand(own, items) if r[-1]]
    want = [d for d in own if not (d[0] in bad and (d[0] != 203))]
    assert kept.filter(F.col("doc_id") < 200).count() == len([d for d in want if d[0] is not None and d[0] < 200])
