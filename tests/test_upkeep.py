"""Merge, schema sync, column tests, parameters."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.operators import merge as M
from hearthlake.operators import quality as C
from hearthlake.params import RunParams
from hearthlake.sources.tables import Lake, latest_date_with


def rows(spark, *values, schema="k string, d string, v int"):
    return spark.createDataFrame(list(values), schema)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge(spark):
    target = rows(spark, ("a", "1", 1), ("b", "1", 1), ("a", "2", 1))
    source = rows(spark, ("a", "1", 9), ("c", "1", 9))
    merged = M.merge_upsert(target, source, ["k", "d"])
    assert got(merged) == [("a", "1", 9), ("a", "2", 1), ("b", "1", 1), ("c", "1", 9)]
    assert got(M.merge_upsert(merged, source, ["k", "d"])) == got(merged)


def test_ambiguous_source_rows_raise(spark):
    target = rows(spark, ("a", "1", 1))
    twice = rows(spark, ("a", "1", 2), ("a", "1", 3))
    with pytest.raises(M.DuplicateKeyError, match="'k': 'a'"):
        M.require_mergeable(target, twice, ["k", "d"])
    new = rows(spark, ("z", "1", 2), ("z", "1", 3))
    assert M.merge_upsert(target, M.require_mergeable(target, new, ["k", "d"]), ["k", "d"]).count() == 3


def test_merge_with_an_order_for_duplicates(spark):
    source = rows(spark, ("a", "1", 2), ("a", "1", 3))
    merged = M.merge_upsert(rows(spark, ("a", "1", 1)), source, ["k", "d"], on_duplicate=[F.desc("v")])
    assert got(merged) == [("a", "1", 3)]


def test_columns_follow_the_source(spark):
    target = rows(spark, ("a", "1", 1), ("b", "1", 1))
    source = spark.createDataFrame([("a", "1", True)], "k string, d string, fresh boolean")
    merged = M.merge_upsert(target, source, ["k", "d"])
    assert merged.columns == ["k", "d", "fresh"]
    assert got(merged) == [("a", "1", True), ("b", "1", None)]


def dated(spark, *values, schema="k string, v int, d string"):
    return rows(spark, *values, schema=schema).withColumn("d", F.to_date("d"))


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "dev")
    lake.overwrite_partitions(dated(spark, ("a", 1, "2026-01-01"), ("a", 1, "2026-01-02")), "t", "d")
    same_day = lake.read("t").where("d = '2026-01-02'")
    lake.overwrite_partitions(M.merge_upsert(same_day, dated(spark, ("b", 2, "2026-01-02")), ["k", "d"]), "t", "d")
    assert got(lake.read("t").select("k", "v", F.col("d").cast("string"))) == [
        ("a", 1, "2026-01-01"), ("a", 1, "2026-01-02"), ("b", 2, "2026-01-02"),
    ]


def test_stored_columns_are_those_of_the_last_write(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "dev")
    lake.overwrite_partitions(dated(spark, ("a", 1, "2026-01-01")), "t", "d")
    newer = dated(spark, ("b", "x", "2026-01-02"), schema="k string, note string, d string")
    lake.overwrite_partitions(newer, "t", "d")
    assert got(lake.read("t").select("k", "note")) == [("a", None), ("b", "x")]
    assert "v" not in lake.read("t").columns


def test_versions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "dev")
    assert lake.current("dim") is None
    for n in range(4):
        previous = lake.current("dim")
        base = rows(spark, ("k", "d", n)) if previous is None else previous.withColumn("v", F.col("v") + 1)
        lake.publish(base, "dim", ["k"])
    assert got(lake.current("dim")) == [("k", "d", 3)]
    assert lake.versions("dim") == ["v00000003", "v00000004"]


def test_unfinished_version_is_not_current(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "dev")
    lake.publish(rows(spark, ("k", "d", 1)), "dim")
    (tmp_path / "dev" / "dim" / "v00000002").mkdir()
    (tmp_path / "dev" / "dim" / "v00000002" / "part-0.parquet").write_text("half")
    assert got(lake.current("dim")) == [("k", "d", 1)]
    lake.publish(rows(spark, ("k", "d", 2)), "dim")
    assert got(lake.current("dim")) == [("k", "d", 2)]


def test_latest_date_with(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "dev")
    lake.overwrite_partitions(dated(spark, ("a", 1, "2026-01-01"), ("a", 0, "2026-01-02")), "t", "d")
    assert latest_date_with(lake, "t", "d", "true") == "2026-01-02"
    assert latest_date_with(lake, "t", "d", "v > 0") == "2026-01-01"
    assert latest_date_with(lake, "t", "d", "v > 5") is None


def test_files_are_even_and_sorted_however_hot_a_place_is(spark, tmp_path, plan_of):
    from hearthlake.sources.tables import clustered

    df = dated(spark, ("a", 1, "2026-01-01"))
    plan = plan_of(clustered(df, "d", ["k"]), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "Sort" in plan.split("REBALANCE")[0]


# -- column tests ------------------------------------------------------------


def test_not_null(spark):
    df = rows(spark, ("a", None, 1), (None, None, 2))
    assert got(C.not_null(df, ["k", "d", "v"])) == [("d", 2), ("k", 1), ("v", 0)]


def test_unique_and_accepted_ignore_null(spark):
    df = rows(spark, ("a", "x", 1), ("a", "y", 1), (None, "x", 2), (None, "x", 2), ("b", None, 3))
    assert got(C.unique(df, "k")) == [("a", 2)]
    assert got(C.accepted_values(df, "d", ["x"])) == [("y", 1)]


def test_foreign_key(spark):
    fact = rows(spark, ("a", "1", 1), ("z", "1", 1), ("z", "2", 1), (None, "3", 1))
    assert got(C.foreign_key(fact, "k", rows(spark, ("a", "", 0)), "k")) == [("z", 2)]
    arrays = fact.select(F.array(F.lit("a"), F.lit("q")).alias("ks"))
    assert got(C.foreign_key(arrays, F.explode("ks"), rows(spark, ("a", "", 0)), "k")) == [("q", 4)]


def test_contract(spark):
    spec = S.TableSpec("t", ("k",), (), not_null=("k", "d"), unique=("k",), accepted=(("d", ("x",)),))
    df = rows(spark, ("a", "x", 1), ("a", "bad", 1), (None, "x", 1))
    assert got(C.run_contract(df, spec)) == [
        ("accepted_values", "d", 1), ("not_null", "d", 0), ("not_null", "k", 1), ("unique", "k", 1),
    ]


def test_contract_sizes():
    assert len(S.SILVER.not_null) == 30 and len(S.SILVER.unique) == 1 and len(S.SILVER.accepted) == 2
    gold = [S.DIM_LISTINGS, S.DIM_ADDRESS, S.DIM_AMENITIES, S.DIM_IMAGES, S.FACT]
    assert sum(len(t.not_null) for t in gold) == 41 and sum(len(t.unique) for t in gold) == 2
    assert len(S.SILVER_COLUMNS) == 31 and len(S.FACT_COLUMNS) == 19 and len(S.BRONZE) == 23


# -- parameters --------------------------------------------------------------

ENV = {
    "ENVIRONMENT": " DEV ",
    "CITY": "Macae",
    "SITES": "vivareal, ZapImoveis",
    "PROPERTY_TYPES": "apartment,house ",
    "START_PAGE": "2",
    "MAX_PAGE": "0",
}


def test_params_are_cleaned():
    p = RunParams.from_env(ENV)
    assert (p.environment, p.city, p.sites, p.property_types) == (
        "dev", "macae", ("vivareal", "zapimoveis"), ("apartment", "house"),
    )
    assert (p.start_page, p.max_page, p.version) == (2, None, "unknown")
    assert p.file_date == p.run_ts.date() and p.write_snapshots and p.write_bronze


def test_params_take_dates_bounds_and_flags():
    p = RunParams.from_env({**ENV, "MAX_PAGE": "5", "FILE_DATE": "2026-01-05", "VERSION": "v3", "WRITE_BRONZE": "false"})
    assert (p.max_page, p.file_date, p.version, p.write_bronze) == (5, date(2026, 1, 5), "v3", False)


@pytest.mark.parametrize(
    "change",
    [
        {"ENVIRONMENT": "moon"},
        {"CITY": "atlantis"},
        {"SITES": "vivareal,nowhere"},
        {"SITES": ""},
        {"PROPERTY_TYPES": "castle"},
        {"FILE_DATE": "05/01/2026"},
        {"START_PAGE": "one"},
        {"WRITE_SNAPSHOTS": "perhaps"},
    ],
)
def test_params_reject(change):
    with pytest.raises(ValueError):
        RunParams.from_env({**ENV, **change})


def test_params_are_frozen():
    with pytest.raises(AttributeError):
        RunParams.from_env(ENV).city = "x"
