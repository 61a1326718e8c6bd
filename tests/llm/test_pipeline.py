import random

import pytest

import corpus_pipeline
from tests.llm import test_decontam, test_jaccard, test_mixing, test_token_ids

NUMBERS = {"toxicity": 10, "jaccard": 7, "decontamination": 3, "mixing": 8, "token_ids": 4}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    rows = []
    for i, (_, text) in enumerate(test_jaccard.corpus(7, families=8, size=10)):
        bad = i % 9 == 4 and text
        rows.append((i, f"{text} moron scum idiot clown" if bad else text, "en", rng.choice("abc"), len(text or "")))
    item = " ".join(f"item{i}" for i in range(20))
    rows += [(2000 + i, f"{item} more{i} words{i}", "en", "a", 1) for i in range(4)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 0, int("moron" in (r[1] or ""))) for r in rows]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, "not there at all")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_against_brute_force(spark, staging, tables):
    assert list(NUMBERS) == [name for name, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = staging.keep(stage(spark, docs, tables), name)
        after = docs.collect()
        if name == "toxicity":
            gone = {i for i, _, _ in before} - {r.doc_id for r in after}
            bad = {i for i, t, _ in before if "moron" in (t or "")}
            assert len(gone & bad) >= 0.9 * len(bad) and len(gone - bad) <= 0.02 * len(before)
        elif name == "jaccard":
            assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in test_jaccard.by_hand([b[:2] for b in before])})
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
            clean = [r[0] for r in test_decontam.by_hand([b[:2] for b in before], items) if not r[-1]]
            assert sorted(r.doc_id for r in after) == sorted(clean) and len(clean) < len(before)
        elif name == "mixing":
            sized = [(i, s, len((t or "").split())) for i, t, s in before]
            taken, _ = test_mixing.mixed_by_hand(sized)
            counts = {i: sum(r.doc_id == i for r in after) for i, _, _ in sized}
            assert all(counts[i] * n == taken[i] for i, _, n in sized)
        else:
            own = [tuple(r) for r in after]
            assert sorted(own) == sorted(test_token_ids.by_hand([b[:2] for b in before]))
        assert name == "token_ids" or docs.columns == columns


def test_run_applies_all_stages(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
