import json
import os
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthlake.operators import extract as E
from hearthlake.operators import paging as P
from hearthlake.plans import bronze as B
from hearthlake.sources import snapshots as N
from hearthlake.sources.pages import url_lineage
from tests.conftest import RUN, item_list, page_html


def land(root, path, listings, modified):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", encoding="utf-8") as f:
        json.dump(listings, f, ensure_ascii=False, indent=2)
    os.utime(full, (modified, modified))


@pytest.fixture
def landed(tmp_path):
    root = str(tmp_path)
    at = 1_767_000_000
    base = "dev/vivareal/macae/apartment"
    land(root, f"{base}/1/2026-01-01T00:00:00Z.json", {"1": {"@id": "1", "name": "old é"}}, at + 50)
    land(root, f"{base}/1/2026-01-01T09:00:00Z.json", {"1": {"@id": "1", "name": "stale"}}, at)
    land(root, f"{base}/2/2026-01-01T00:00:00Z.json", {"2": {"@id": "2"}, "3": {"@id": "3"}}, at)
    land(root, f"{base}/10/2026-01-01T00:00:00Z.json", {"4": {"@id": "4"}}, at)
    land(root, f"{base}/1/2026-01-02T00:00:00Z.json", {"1": {"@id": "1", "name": "next day"}}, at)
    land(root, f"{base}/1/2026-01-01T00:00:00Z.txt", {}, at)
    return root


def test_scan_files_of_one_date(spark, landed):
    rows = N.scan_snapshots(spark, landed, "2026-01-01").collect()
    assert len(rows) == 4
    row = next(r for r in rows if r.blob == "dev/vivareal/macae/apartment/1/2026-01-01T00:00:00Z.json")
    assert (row.environment, row.site, row.city, row.property_type, row.page) == (
        "dev", "vivareal", "macae", "apartment", 1,
    )
    assert row.executed_at == datetime(2026, 1, 1) and str(row.file_date) == "2026-01-01"
    assert "old é" in row.payload


def test_listing_files_reads_no_content(spark, landed):
    paths = N.list_snapshots(spark, landed)
    assert paths.count() == 5
    assert "payload" not in paths.columns and "content" not in paths.columns
    same = N.scan_snapshots(spark, landed).select("blob", "modified_ts").join(paths.select("blob", "modified_ts"), ["blob", "modified_ts"])
    assert same.count() == 5


def scanned(spark, monkeypatch, root, day=None, own=True):
    with monkeypatch.context() as m:
        if not own:
            m.setattr(N, "_mounted", lambda *_: None)
        rows = N.scan_snapshots(spark, root, day)
        assert ("MapInArrow" in rows._jdf.queryExecution().executedPlan().toString()) == own
        return sorted(tuple(r) for r in rows.withColumn("payload", F.hex("payload")).collect())


def test_tasks_scan_what_the_file_source_scans(spark, landed, monkeypatch, tmp_path):
    base = tmp_path / "dev/vivareal/São Paulo +%2B é/house"
    files = {"3/2026-01-01T00:00:00Z.json": b"{}", "3/2026-01-01T01:00:00Z.json": b"", "3/.hidden.json": b"x", "3/_later.json": b"x", "3/a._COPYING_": b"x",
             "3/undated.json": b'{"1": "\xff\xc3"}\r\n', "_tmp/2026-01-01T00:00:00Z.json": b"x", "_k=1/2026-01-01T00:00:00Z.json": b"kept",
             ".git/2026-01-01T00:00:00Z.json": b"x", "4/5/6/2026-01-02T00:00:00Z.json": b"deep", "2026-01-01T00:00:00Z.json": b"high", "7/a=1 b?.json": b"named"}
    for name, content in files.items():
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_bytes(content)
    (base / "empty").mkdir()
    by_name = [str(base / "3/undated.json"), str(base / "3/2026-01-01T00:00:00Z.json"), str(base / "3/_later.json")]
    for spread in (N.SPREAD, 2):
        monkeypatch.setattr(N, "SPREAD", spread)
        for root, day in ((landed, None), (landed, "2026-01-01"), (f"file://{landed}/", "2026-01-02"), ([f"{landed}/dev/vivareal/macae", str(base)], None), (by_name, None), (by_name, "2026-01-01")):
            want = scanned(spark, monkeypatch, root, day, own=False)
            assert want and scanned(spark, monkeypatch, root, day) == want


def test_small_files_share_tasks_and_are_not_listed_by_the_driver(spark, tmp_path):
    for page in range(200):
        land(str(tmp_path), f"dev/vivareal/macae/apartment/{page}/2026-01-01T00:00:00Z.json", {"1": page}, 1_767_000_000)
    rows = N.scan_snapshots(spark, str(tmp_path))
    assert "Location: InMemoryFileIndex" not in rows._jdf.queryExecution().executedPlan().toString()
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    assert 1 < len(tasks) <= 4 and sum(r["count"] for r in tasks) == 200


def test_other_roots_are_left_to_the_file_source(spark, landed):
    own = lambda roots, extension="json", **options: N._mounted(spark, roots, extension, options)
    assert own([landed, landed + "/"]) == [landed]
    assert own([landed], **{"fs.file.impl": "x"}) == [landed]
    assert all(x is None for x in (own([]), own([landed + "/*"]), own([landed, landed + "/dev"]), own([landed], "json.gz"), own([landed], encoding="x"), own(["s3a://b/x"]), own([landed + "/none"])))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        N.scan_snapshots(spark, landed + "/none")


def test_latest_is_by_modification_time_not_name(spark, landed):
    latest = P.latest_snapshot(N.list_snapshots(spark, landed, "2026-01-01"))
    chosen = {(r.page, r.blob.rsplit("/", 1)[1]) for r in latest.collect()}
    assert (1, "2026-01-01T00:00:00Z.json") in chosen and len(chosen) == 3


def test_no_snapshot_gives_nothing(spark, landed):
    assert B.select_snapshots(N.list_snapshots(spark, landed, "2030-01-01"), None).count() == 0


def test_files_to_bronze(spark, landed):
    chosen = B.select_snapshots(N.list_snapshots(spark, landed, "2026-01-01"), None)
    rows = B.bronze_rows(N.scan_snapshots(spark, landed, "2026-01-01"), chosen, RUN, "v1").collect()
    # Page 10 lies behind a gap.
    assert sorted(r.LISTING_ID for r in rows) == ["1", "2", "3"]
    assert {r.LISTING_NAME for r in rows if r.LISTING_ID == "1"} == {"old é"}


def pages_of(spark, pages, loaded=(), site="s"):
    rows = [(site, "c", "t", p, "2026-01-01", f"b/{site}/{p}", datetime(2026, 1, 1)) for p in pages]
    schema = "site string, city string, property_type string, page bigint, file_date string, blob string, modified_ts timestamp"
    loaded_df = spark.createDataFrame([(f"b/{site}/{p}",) for p in loaded], "blob string")
    return spark.createDataFrame(rows, schema), loaded_df


@pytest.mark.parametrize(
    "pages, start, top, loaded, want",
    [
        ([1, 2, 3], 1, None, [], [1, 2, 3]),
        ([1, 2, 4, 5], 1, None, [], [1, 2]),
        ([2, 3], 1, None, [], []),
        ([2, 3], 2, None, [], [2, 3]),
        ([1, 2, 3, 4], 2, 3, [], [2, 3]),
        ([1, 2, 3], 1, 0, [], [1, 2, 3]),
        ([1, 2, 3], 1, None, [2], [1, 3]),
        ([1, 2, 3], 1, None, [1, 2, 3], []),
        ([10], 1, None, [], []),
    ],
)
def test_select_snapshots(spark, pages, start, top, loaded, want):
    snapshots, loaded_df = pages_of(spark, pages, loaded)
    rows = B.select_snapshots(snapshots, loaded_df, start, top).collect()
    assert sorted(r.page for r in rows) == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.sampled_from("abc"), st.dictionaries(st.integers(1, 9), st.booleans(), max_size=9), min_size=1),
    st.integers(1, 3),
)
def test_stop_at_first_empty_page_against_brute_force(spark, searches, start):
    rows = [
        (s, "c", "t", p, "ok" if good else "no_item_list") for s, pages in searches.items() for p, good in pages.items()
    ]
    df = spark.createDataFrame(rows, "site string, city string, property_type string, page int, status string")
    want = set()
    for s, pages in searches.items():
        p = start
        while pages.get(p):
            want.add((s, p))
            p += 1
    got = {(r.site, r.page) for r in P.stop_at_first_empty_page(df, start).collect()}
    assert got == want


def test_one_search_is_never_a_single_group(spark, plan_of):
    snapshots, _ = pages_of(spark, range(1, 50))
    plan = plan_of(P.first_missing_page(snapshots, P.BY_DATE, 1))
    assert "Window" not in plan and "collect" not in plan
    assert plan.count("partial_min(page") == 1 and plan.count("partial_max(here") + plan.count("partial_bool_or(here") == 1


def test_written_snapshots_round_trip(spark, tmp_path):
    url = "https://www.vivareal.com.br/aluguel/rj/macae/apartamento_residencial/?pagina=%d"
    pages = spark.createDataFrame(
        [
            (url % 1, page_html(item_list({"@id": "1", "name": "é"}, {"@id": "1", "name": "last"}, {"name": "no id"}))),
            (url % 2, page_html('{"@type": "WebPage"}')),
            (url % 3, page_html(item_list({"@id": "3"}))),
        ],
        "url string, html string",
    )
    extracted = E.keep_last_per_id(E.extract_pages(url_lineage(pages)))
    rows = N.snapshot_rows(P.stop_at_first_empty_page(extracted), "dev", "2026-01-01 10:20:30")
    for fmt in ("parquet", "json"):
        root = str(tmp_path / fmt)
        N.write_snapshots(rows, root, fmt)
        back = N.scan_snapshot_table(spark, root, "2026-01-01", fmt).collect()
        assert [r.blob for r in back] == ["dev/vivareal/macae/apartment/1/2026-01-01T10:20:30Z.json"]
        assert json.loads(back[0].payload) == {"1": {"@id": "1", "name": "last"}}
        assert back[0].executed_at == datetime(2026, 1, 1, 10, 20, 30)
        assert N.scan_snapshot_table(spark, root, "2026-01-02", fmt).count() == 0


def test_quarantine_without_listings_can_be_scanned(spark, tmp_path):
    url = "https://www.vivareal.com.br/aluguel/rj/macae/apartamento_residencial/?pagina=1"
    columns = "page bigint, blob string, pos int, listing string, reason string, file_date date, "
    columns += "environment string, site string, city string, property_type string, run string"
    for name, items, want in (("all", [{"@id": "1"}], []), ("some", [{"@id": "1"}, {"name": "no id"}], [1])):
        pages = spark.createDataFrame([(url, page_html(item_list(*items)))], "url string, html string")
        lost = N.listings_without_id(E.extract_pages(url_lineage(pages)), "dev", RUN)
        N.write_quarantine(lost, str(tmp_path / name))
        found = N.scan_quarantine(spark, str(tmp_path / name))
        assert [r.pos for r in found.collect()] == want
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) == columns


def test_path_choice_reads_no_payload(spark, tmp_path, plan_of):
    rows = spark.createDataFrame(
        [("2026-01-01", "s", "c", "t", 1, "dev/s/c/t/1/2026-01-01T00:00:00Z.json", "{}")],
        "file_date string, site string, city string, property_type string, page bigint, blob string, payload string",
    ).withColumn("file_date", F.to_date("file_date"))
    N.write_snapshots(rows, str(tmp_path / "t"))
    table = N.scan_snapshot_table(spark, str(tmp_path / "t"), "2026-01-01").drop("payload")
    plan = plan_of(P.latest_snapshot(table))
    assert "payload" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert "file_date" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_payload_that_is_no_object_gives_no_rows(spark):
    df = spark.createDataFrame([("a", "[1]"), ("b", "nope"), ("c", '{"x": {"@id": "x"}}')], "blob string, payload string")
    assert [r.listing_key for r in N.parse_snapshot_json(df).collect()] == ["x"]
