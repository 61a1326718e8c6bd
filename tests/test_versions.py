"""Versions of tables: all or nothing, side by side, without moving what stays."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake import schemas as S
from hearthlake.operators.merge import SchemaConflictError, conform, merge_upsert, merged_schema
from hearthlake.plans import bronze as B
from hearthlake.plans import pipeline as L
from hearthlake.plans.keyed import KeyedTable
from hearthlake.session import Staging
from hearthlake.sources.tables import ROWS, BrokenConstraintError, Lake
from hearthlake.sources.versions import KEPT, ConcurrentWriteError, Section, values_of
from tests.test_pipeline import item, pages, params

SPEC = S.TableSpec("t", ("k", "d"), ("v",), (), partition="d", folders=("d", "CITY"), bucket=("k",))


def rows(spark, *values, schema="k string, v int, d string, CITY string"):
    return spark.createDataFrame(list(values), schema).withColumn("d", F.to_date("d"))


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or ("k", "v", F.col("d").cast("string"), "CITY")).collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), "dev")


@pytest.fixture
def stage(spark):
    with Staging(spark) as own:
        yield own


def files_of(lake, name):
    return {os.path.join(d, f) for d, _, fs in os.walk(lake.log(name).data) for f in fs if f.endswith(".parquet")}


D1, D2, D3 = "2026-01-01", "2026-01-02", "2026-01-03"


# -- commits -------------------------------------------------------------------


def test_dates_are_switched_together_or_not_at_all(spark, lake, monkeypatch):
    old = [("a", 1, D1, "x"), ("a", 1, D2, "x"), ("b", 1, D3, "x")]
    lake.overwrite_partitions(rows(spark, *old), "t", "d")

    def lost(*_args, **_more):
        raise KeyboardInterrupt

    new = rows(spark, ("a", 2, D1, "x"), ("a", 2, D2, "x"))
    with monkeypatch.context() as m:
        m.setattr(Lake, "replace", lost)  # the driver goes after the files are written
        with pytest.raises(KeyboardInterrupt):
            lake.overwrite_partitions(new, "t", "d")
    assert got(lake.read("t")) == old
    assert len(lake.log("t").vacuum()) == 1
    lake.overwrite_partitions(new, "t", "d")
    assert got(lake.read("t")) == [("a", 2, D1, "x"), ("a", 2, D2, "x"), ("b", 1, D3, "x")]


def test_a_table_is_merged_with_itself(spark, lake):
    lake.overwrite_partitions(rows(spark, ("a", 1, D1, "x"), ("b", 1, D2, "x")), "t", "d")
    lake.overwrite_partitions(lake.read("t").withColumn("v", F.col("v") + 1), "t", "d")
    assert got(lake.read("t")) == [("a", 2, D1, "x"), ("b", 2, D2, "x")]


def test_old_versions_and_their_files_go(spark, lake):
    for v in range(KEPT + 3):
        lake.overwrite_partitions(rows(spark, ("a", v, D1, "x")), "t", "d")
    assert len(lake.log("t").numbers()) == KEPT and len(files_of(lake, "t")) == KEPT
    assert got(lake.read("t"))[0][1] == KEPT + 2


def test_writes_to_one_part_at_a_time(spark, lake):
    lake.overwrite_partitions(rows(spark, ("a", 1, D1, "x"), ("a", 1, D2, "x")), "t", "d")
    base = lake.version("t")
    writes = [lake.write_aside(rows(spark, ("a", v, D1, "x")), "t", "d") for v in (2, 3)]
    lake.replace("t", writes[0], "d", lake.schema("t"), base)
    with pytest.raises(ConcurrentWriteError, match=D1):
        lake.replace("t", writes[1], "d", lake.schema("t"), base)
    other = lake.write_aside(rows(spark, ("a", 9, D2, "x")), "t", "d")
    lake.replace("t", other, "d", lake.schema("t"), base)
    assert got(lake.read("t")) == [("a", 2, D1, "x"), ("a", 9, D2, "x")]


def test_many_writers_at_once(spark, lake):
    lake.overwrite_partitions(rows(spark, ("a", 0, D1, "x")), "t", "d")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: lake.append(rows(spark, (f"k{i}", i, f"2026-02-{i + 1:02d}", "x")), "t", "d"), range(6)))
    assert lake.read("t").count() == 7 and len(lake.partition_values("t", "d")) == 7


def test_parts_are_read_by_folder_or_as_a_whole_write():
    section = Section(None, {"d=1": ("A",), "d=2": ("A", "B"), "d=3": ("B",)}, {"A": 2, "B": 3})
    assert section.paths(section.parts) == ["A", "B/d=2", "B/d=3"]
    assert section.paths(section.matching(d=[3])) == ["B/d=3"]
    assert values_of("d=1/CITY=a%3Ab/x=__HIVE_DEFAULT_PARTITION__") == {"d": "1", "CITY": "a:b", "x": None}


# -- upserts -------------------------------------------------------------------


def test_two_cities_of_a_date_at_once_are_both_kept(spark, lake):
    L.store(lake, rows(spark, ("a", 1, D1, "x"), ("z", 1, D2, "x")), SPEC)
    loads = [rows(spark, ("b", 1, D1, "y"), ("c", 2, D1, "y")), rows(spark, ("a", 7, D1, "x"), ("d", 2, D1, "x"))]

    def load(source):
        with Staging(spark) as own:
            L.upsert_date(lake, source, SPEC, D1, own)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load, loads))
    assert got(lake.read("t")) == [("a", 7, D1, "x"), ("b", 1, D1, "y"), ("c", 2, D1, "y"), ("d", 2, D1, "x"), ("z", 1, D2, "x")]


def test_only_the_run_s_city_is_rewritten(spark, lake, stage):
    L.store(lake, rows(spark, ("a", 1, D1, "x"), ("b", 1, D1, "y"), ("c", 1, D1, "sao paulo")), SPEC)
    before = lake.version("t").section(ROWS).parts
    L.upsert_date(lake, rows(spark, ("c", 2, D1, "sao paulo")), SPEC, D1, stage)
    after = lake.version("t").section(ROWS).parts
    assert {p for p in after if after[p] != before.get(p)} == {"d=2026-01-01/CITY=sao paulo"}
    L.upsert_date(lake, rows(spark, ("a", 5, D1, "y")), SPEC, D1, stage)  # a home that moved
    assert got(lake.read("t")) == [("a", 5, D1, "y"), ("b", 1, D1, "y"), ("c", 2, D1, "sao paulo")]
    assert "d=2026-01-01/CITY=x" not in lake.version("t").section(ROWS).parts


def above(plan, mark):
    """For each line with ``mark``: the operators above it."""
    lines, out = plan.splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if mark in line:
            at, own = depth(line), []
            for upper in reversed(lines[:i]):
                if depth(upper) < at:
                    at = depth(upper)
                    own.append(upper.strip(" :+-*"))
            out.append(own)
    return out


def test_the_target_is_merged_where_it_lies(spark, lake, stage, plan_of):
    many = spark.range(4000).selectExpr("cast(id as string) k", "1 v", f"'{D1}' d", "concat('c', id % 2) CITY").withColumn("d", F.to_date("d"))
    L.store(lake, many, SPEC)
    source = stage.keep(many.where("v = 1 and cast(k as int) % 5 = 0").withColumn("v", F.lit(2)), "source")
    base = lake.version("t")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = L.upsert_plan(lake, source, SPEC, base, sorted(base.section(ROWS).parts))
        plan = plan_of(merged, "simple")
        scans = above(plan, "Bucketed: true")
        assert len(scans) == 2 and all("Join" in " ".join(own) for own in scans)
        assert not any(line.startswith("Exchange") for own in scans for line in own)
        assert merged.count() == 4000 and merged.where("v = 2").count() == 800
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# -- dimensions ----------------------------------------------------------------

DIM = S.TableSpec("dim", ("k",), (), ())


def dim_rows(spark, *keys):
    return spark.createDataFrame([(k, f"name {k}") for k in keys], "k string, name string")


def with_audit(df, ts):
    from hearthlake.operators.scd import with_audit

    return with_audit(df, ts)


def state(table):
    rows = table.lake.current("dim").collect()
    return {r.k: (r.IN_LAST_SCRAPE_FLAG, r.AUD_INS_TS.day, r.AUD_UPD_TS.day) for r in rows}


def test_history_that_does_not_change_keeps_its_files(spark, lake, stage):
    table, at = KeyedTable(lake, DIM), lambda d: f"2026-01-{d:02d} 00:00:00"
    keys = [f"k{i}" for i in range(200)]
    table.create(with_audit(dim_rows(spark, *keys), at(1)), buckets=8)
    table.merge(dim_rows(spark, *keys[:20]), at(2), stage)
    parts = lake.version("dim").section(ROWS).parts
    history = {p: f for p, f in parts.items() if "FLAG=false" in p}
    assert len(history) == 8
    # One key goes, one is new, one returns: only the bucket of the one that returns is written anew.
    source = stage.keep(dim_rows(spark, *keys[1:20], "new", "k150"), "source")
    told = sorted(map(tuple, table.after(table.changes(source, at(3), stage)).select("k", "IN_LAST_SCRAPE_FLAG", "AUD_UPD_TS").collect()))
    table.merge(source, at(3), stage)
    assert told == sorted(map(tuple, lake.current("dim").select("k", "IN_LAST_SCRAPE_FLAG", "AUD_UPD_TS").collect()))
    now = lake.version("dim").section(ROWS).parts
    home = dim_rows(spark, "k150").select(F.pmod(F.xxhash64("k"), F.lit(8))).first()[0]
    for part, folders in history.items():
        if f"KEY_BUCKET={home}/" in part:
            assert not set(folders) & set(now.get(part, ()))
        else:
            assert set(folders) <= set(now[part])
    want = {k: (False, 1, 2) for k in keys[20:]} | {k: (True, 1, 3) for k in keys[1:20]}
    want |= {"k0": (False, 1, 3), "new": (True, 3, 3), "k150": (True, 1, 3)}
    assert state(table) == want


def test_history_is_not_joined(spark, lake, stage, plan_of):
    table = KeyedTable(lake, DIM)
    table.create(with_audit(dim_rows(spark, *"abcdef"), "2026-01-01 00:00:00"), buckets=4)
    table.merge(dim_rows(spark, "a"), "2026-01-02 00:00:00", stage)
    found = table.changes(stage.keep(dim_rows(spark, "a"), "s"), "2026-01-03 00:00:00", stage)
    assert not any("FLAG=false" in f for f in found.upserts.inputFiles()) and found.returned == []
    assert plan_of(found.upserts).count("FullOuter") >= 1


def test_all_keys_vanish_and_return(spark, lake, stage):
    table = KeyedTable(lake, DIM)
    table.create(with_audit(dim_rows(spark, *"abc"), "2026-01-01 00:00:00"), buckets=2)
    table.merge(dim_rows(spark, "x").where("false"), "2026-01-02 00:00:00", stage)
    assert state(table) == {k: (False, 1, 2) for k in "abc"}
    table.merge(dim_rows(spark, *"abc"), "2026-01-03 00:00:00", stage)
    assert state(table) == {k: (True, 1, 3) for k in "abc"}
    assert not any("FLAG=false" in p for p in lake.version("dim").section(ROWS).parts)


# -- constraints and the ledger --------------------------------------------------


def test_a_null_in_a_declared_column_is_refused(spark, lake):
    declared = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("v", T.IntegerType())])
    assert lake.ensure("t", declared, "d") and not lake.ensure("t", declared, "d")
    good = rows(spark, ("a", None, D1, "x")).drop("CITY")
    lake.append(good, "t", "d")
    with pytest.raises(BrokenConstraintError, match="k \\(1 rows\\)"):
        lake.append(rows(spark, ("b", 1, D1, "x"), (None, 1, D2, "x")).drop("CITY"), "t", "d")
    assert lake.read("t").count() == 1 and lake.log("t").vacuum() == []


def test_the_bronze_job_declares_its_table(spark, lake, tmp_path, raw_listing, monkeypatch):
    root = str(tmp_path / "s")
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1))
    assert [f.name for f in lake.schema(L.BRONZE_TABLE) if not f.nullable] == ["ID", "LISTING_ID"]
    # The row filter lets a listing without id through: the write itself refuses it.
    monkeypatch.setattr(B, "rejected", lambda df: df.where("false"))
    whole = B.raw_bronze_rows
    monkeypatch.setattr(B, "raw_bronze_rows", lambda *a: whole(*a).withColumn("LISTING_ID", F.lit(None).cast("string")))
    with pytest.raises(BrokenConstraintError, match="LISTING_ID"):
        L.run(lake, pages(spark, vivareal=[[item(raw_listing, "b")]]), root, params(2))
    assert [r.LISTING_ID for r in lake.read(L.BRONZE_TABLE).collect()] == ["a"]


def test_loaded_snapshots_are_found_in_the_ledger(spark, lake, tmp_path, raw_listing):
    root = str(tmp_path / "s")
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, i) for i in "abc"], [item(raw_listing, "d")]]), root, params(1))
    ledger = lake.read(L.BRONZE_TABLE, section=L.LOADS)
    assert sorted((r.blob.split("/")[4], r.listings) for r in ledger.collect()) == [("1", 3), ("2", 1)]
    paths = spark.createDataFrame([(r.blob,) for r in ledger.collect()], "blob string")
    from hearthlake.sources.snapshots import path_lineage

    chosen = L.chosen_snapshots(lake, path_lineage(paths).withColumn("modified_ts", F.lit(0)), params(1), date(2026, 1, 1))
    assert chosen.count() == 0
    bronze = {f for f in lake.read(L.BRONZE_TABLE).inputFiles()}
    assert chosen.inputFiles() and not bronze & set(chosen.inputFiles())


def test_a_load_that_was_cut_off_adds_its_rows_once(spark, lake, tmp_path, raw_listing, monkeypatch):
    root = str(tmp_path / "s")
    L.land_snapshots(pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1), Staging(spark))

    def lost(*_args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Lake, "add", lost)
        with pytest.raises(KeyboardInterrupt):
            L.run(lake, None, root, params(1))
    assert lake.read(L.BRONZE_TABLE).count() == 0
    for hour in (9, 10):
        L.run(lake, None, root, params(1, run_ts=datetime(2026, 1, 1, hour)))
        assert lake.read(L.BRONZE_TABLE).count() == 1


# -- nested columns --------------------------------------------------------------


def test_nested_fields_follow_the_source(spark):
    old = spark.createDataFrame([("a", (1, "gone"), [(1, "x"), None]), ("b", None, None)], "k string, s struct<n int, old string>, l array<struct<i int, t string>>")
    new = spark.createDataFrame([("a", (5, None), [(7, 2.5)])], "k string, s struct<n bigint, fresh string>, l array<struct<i bigint, p double>>")
    merged = merge_upsert(old.where("k <> 'z'"), new.withColumn("k", F.lit("c")), ["k"])
    assert merged.schema["s"].dataType.simpleString() == "struct<n:bigint,fresh:string>"
    assert merged.schema["l"].dataType.simpleString() == "array<struct<i:bigint,p:double>>"
    assert {r.k: (r.s and tuple(r.s), r.l and [e and tuple(e) for e in r.l]) for r in merged.collect()} == {
        "a": ((1, None), [(1, None), None]), "b": (None, None), "c": ((5, None), [(7, 2.5)]),
    }


def test_a_wider_target_stays_wide(spark):
    old = spark.createDataFrame([("a", 1 << 40, 1.5)], "k string, n bigint, x double")
    new = spark.createDataFrame([("b", 2, 3)], "k string, n int, x int")
    merged = merge_upsert(old, new, ["k"])
    assert [f.dataType.simpleString() for f in merged.schema] == ["string", "bigint", "double"]
    assert sorted(map(tuple, merged.collect())) == [("a", 1 << 40, 1.5), ("b", 2, 3.0)]
    with pytest.raises(SchemaConflictError, match="s.n"):
        merged_schema(T._parse_datatype_string("s struct<n int>"), T._parse_datatype_string("s struct<n string>"))
    assert conform(new, old.schema).schema["n"].dataType == T.LongType()


def test_files_of_an_older_shape_are_read_in_the_new_one(spark, lake, stage):
    old = spark.createDataFrame([("a", 1, (1, "x"), D1, "p"), ("b", 1, (2, "y"), D2, "p")], "k string, v int, s struct<n int, t string>, d string, CITY string")
    new = spark.createDataFrame([("c", 1 << 40, (1 << 40, 0.5), D2, "p")], "k string, v bigint, s struct<n bigint, w double>, d string, CITY string")
    day = lambda df: df.withColumn("d", F.to_date("d"))
    L.store(lake, day(old), SPEC)
    L.upsert_date(lake, day(new), SPEC, D2, stage)
    assert {r.k: (r.v, tuple(r.s)) for r in lake.read("t").collect()} == {"a": (1, (1, None)), "b": (1, (2, None)), "c": (1 << 40, (1 << 40, 0.5))}


# -- skipping --------------------------------------------------------------------


def rows_scanned(spark, df):
    """What the scan of a plain filter reads: rows of the row groups and pages that statistics and filters leave."""
    df.collect()
    plan, seen = df._jdf.queryExecution().executedPlan(), []
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            seen.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    assert len(seen) == 1
    return seen[0]


def test_point_reads_open_few_row_groups(spark, lake):
    import pyarrow.parquet as pq

    spec = S.TableSpec("t", ("k", "d"), ("page",), (), partition="d", folders=("d", "CITY"), bucket=("k",))
    n = 60_000
    many = spark.range(n).selectExpr("md5(cast(id as string)) k", "cast(id % 50 as int) page", "md5(cast(id * 7 as string)) body", f"'{D1}' d", "concat('c', id % 2) CITY")
    before = {c: spark.conf.get(c, None) for c in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min")}
    for c, v in zip(before, ("65536", "100", "100"), strict=True):
        spark.conf.set(c, v)
    try:
        L.store(lake, many.withColumn("d", F.to_date("d")), spec)
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    groups = wanted = 0
    for file in files_of(lake, "t"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("page")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups += 1
            wanted += "CITY=c1" in file and stats.min <= 17 <= stats.max
    assert groups > 20 and 0 < wanted < groups / 4
    table = lake.read("t")
    page = rows_scanned(spark, table.where("CITY = 'c1' and page = 17"))
    assert n / 50 <= page < n / 5
    key = table.first()["k"]
    found = table.where(F.col("k") == key)
    assert found.count() == 1 and rows_scanned(spark, found) < n / 4
