"""All layers, run after run."""

import json
import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearthlake import RunParams
from hearthlake import schemas as S
from hearthlake.operators import quality as C
from hearthlake.operators.merge import DuplicateKeyError
from hearthlake.plans import bronze as B
from hearthlake.plans import pipeline as L
from hearthlake.session import Staging
from hearthlake.sources import snapshots as N
from hearthlake.sources.tables import Lake
from hearthlake.streaming import follow_snapshots
from tests.conftest import item_list, page_html

URLS = {
    "vivareal": "https://www.vivareal.com.br/aluguel/rj/macae/apartamento_residencial/?pagina=%d",
    "zapimoveis": "https://www.zapimoveis.com.br/aluguel/apartamentos/rj+macae/?pagina=%d",
}


def params(day, **change):
    return RunParams(
        **{
            "environment": "dev",
            "city": "macae",
            "sites": ("vivareal", "zapimoveis"),
            "property_types": ("apartment", "house"),
            "file_date": date(2026, 1, day),
            "run_ts": datetime(2026, 1, day, 8),
            **change,
        }
    )


def item(raw, id, **change):
    address = {**raw["address"], "streetAddress": f"Rua {change.pop('street', id)}"}
    return {**raw, "@id": id, "address": address, **change}


def pages(spark, **sites):
    """site -> list of pages, each a list of items or a ready html."""
    rows = [
        (URLS[site] % (n + 1), p if isinstance(p, str) else page_html('{"@type": "WebPage"}', item_list(*p)))
        for site, ps in sites.items()
        for n, p in enumerate(ps)
    ]
    return spark.createDataFrame(rows, "url string, html string")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), "dev")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "snapshots")


def flags(lake):
    return {r.LISTING_ID: r.IN_LAST_SCRAPE_FLAG for r in lake.current(S.DIM_LISTINGS.name).collect()}


def test_three_days(spark, lake, root, raw_listing):
    a, b, c = (item(raw_listing, i) for i in "abc")
    # The second site lists home "a" again; its third page lies behind a broken one.
    L.run(lake, pages(spark, vivareal=[[a], [b]], zapimoveis=[[item(raw_listing, "z", street="a")], page_html("{"), [c]]), root, params(1))
    assert lake.read(L.BRONZE_TABLE).count() == 3
    silver = lake.read(S.SILVER.name)
    assert sorted(r.LISTING_ID for r in silver.collect()) == ["a", "b"]
    assert flags(lake) == {"a": True, "b": True}

    L.run(lake, pages(spark, vivareal=[[b, c]]), root, params(2))
    assert flags(lake) == {"a": False, "b": True, "c": True}

    L.run(lake, pages(spark, vivareal=[[a]]), root, params(3))
    assert flags(lake) == {"a": True, "b": False, "c": False}
    known = {r.LISTING_ID: r for r in lake.current(S.DIM_LISTINGS.name).collect()}
    assert known["a"].AUD_INS_TS == datetime(2026, 1, 1, 8) and known["a"].AUD_UPD_TS == datetime(2026, 1, 3, 8)

    fact = lake.read(S.FACT.name)
    assert sorted((r.LISTING_ID, r.SCRAPE_DATE.day) for r in fact.collect()) == [("a", 1), ("a", 3), ("b", 1), ("b", 2), ("c", 2)]
    for spec, df in [(S.SILVER, lake.read(S.SILVER.name)), (S.FACT, fact)] + [
        (s, lake.current(s.name)) for s in (S.DIM_LISTINGS, S.DIM_ADDRESS, S.DIM_AMENITIES, S.DIM_IMAGES)
    ]:
        assert C.run_contract(df, spec).where("failures > 0").count() == 0
    assert C.foreign_key(fact, "ADDRESS_SK", lake.current(S.DIM_ADDRESS.name), "ADDRESS_SK").count() == 0


def test_a_date_run_twice_changes_no_rows(spark, lake, root, raw_listing):
    landed = pages(spark, vivareal=[[item(raw_listing, i) for i in "ab"]])
    audit = ["AUD_INS_TS", "AUD_UPD_TS"]
    seen = []
    for hour in (8, 9):
        L.run(lake, landed if hour == 8 else None, root, params(1, run_ts=datetime(2026, 1, 1, hour)))
        seen.append(
            [sorted(map(str, lake.read(t).drop(*audit).collect())) for t in (L.BRONZE_TABLE, S.SILVER.name, S.FACT.name)]
            + [sorted(map(str, lake.current(S.DIM_LISTINGS.name).drop(*audit).collect()))]
        )
    assert seen[0] == seen[1]


def test_a_later_scrape_of_the_day_is_added_to_bronze_and_merged(spark, lake, root, raw_listing):
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a", name="first")]]), root, params(1))
    later = params(1, run_ts=datetime(2026, 1, 1, 20))
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a", name="second")]]), root, later)
    assert lake.read(L.BRONZE_TABLE).count() == 2
    assert [r.LISTING_NAME for r in lake.read(S.SILVER.name).collect()] == ["Second"]


def test_one_listing_at_two_prices(spark, lake, root, raw_listing):
    dear = item(raw_listing, "a", offers={**raw_listing["offers"], "price": 9999})
    both = pages(spark, vivareal=[[item(raw_listing, "a")], [dear]])
    L.run(lake, both, root, params(1))
    # A first load keeps both; a second one cannot say which updates which.
    assert lake.read(S.SILVER.name).count() == 2
    with pytest.raises(DuplicateKeyError):
        L.build_silver(lake, params(1), Staging(spark))


def test_a_run_leaves_no_staging_behind(spark, lake, root, raw_listing, monkeypatch):
    stages = []

    class Recorded(Staging):
        def __exit__(self, *error):
            stages.append((self.root, os.path.isdir(self.root)))
            super().__exit__(*error)

    monkeypatch.setattr(L, "Staging", Recorded)
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1))
    ((folder, was_used),) = stages
    assert was_used and not os.path.exists(folder)


def test_dry_runs_write_nothing(spark, lake, root, raw_listing):
    landed = pages(spark, vivareal=[[item(raw_listing, "a")]])
    rows = L.land_snapshots(landed, root, params(1, write_snapshots=False), Staging(spark))
    assert rows.count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        N.scan_snapshot_table(spark, root).count()
    L.land_snapshots(landed, root, params(1), Staging(spark))
    would = L.load_bronze(lake, N.scan_snapshot_table(spark, root), params(1, write_bronze=False), Staging(spark))
    assert would.count() == 1 and not lake.exists(L.BRONZE_TABLE)


def test_landed_files(spark, lake, root, raw_listing):
    for path, listing in [
        ("dev/vivareal/macae/apartment/1/2026-01-01T00:00:00Z", item(raw_listing, "a")),
        ("dev/vivareal/macae/apartment/2/2026-01-01T00:00:00Z", item(raw_listing, "b")),
        ("dev/vivareal/macae/apartment/3/2026-01-01Tlate", item(raw_listing, "no run time")),
        ("dev/vivareal/macae/house/2/2026-01-01T00:00:00Z", item(raw_listing, "behind a gap")),
        ("dev/zapimoveis/macae/house/1/2026-01-02T00:00:00Z", item(raw_listing, "other day")),
        ("prod/vivareal/macae/apartment/1/2026-01-01T00:00:00Z", item(raw_listing, "other environment")),
    ]:
        file = Path(root, path + ".json")
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps({listing["@id"]: listing}))
    for _ in range(2):
        L.run(lake, None, root, params(1), layout="files")
        assert sorted(r.LISTING_ID for r in lake.read(L.BRONZE_TABLE).collect()) == ["a", "b"]
    assert flags(lake) == {"a": True, "b": True}
    with Staging(spark) as stage:
        assert L.load_landed(lake, root, params(1, environment="test"), stage, "files").count() == 0


def test_other_environments_stay_apart(spark, lake, root, raw_listing):
    landed = pages(spark, vivareal=[[item(raw_listing, "a")]])
    L.land_snapshots(landed, root, params(1, environment="prod"), Staging(spark))
    L.land_snapshots(pages(spark, vivareal=[[item(raw_listing, "b")]]), root, params(1), Staging(spark))
    L.run(lake, None, root, params(1))
    assert [r.LISTING_ID for r in lake.read(L.BRONZE_TABLE).collect()] == ["b"]


def test_amenities_that_all_vanish_are_deactivated(spark, lake, root, raw_listing):
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1))
    bare = item(raw_listing, "a", amenityFeature=[])
    L.run(lake, pages(spark, vivareal=[[bare]]), root, params(1, run_ts=datetime(2026, 1, 1, 9)))
    assert [r.IN_LAST_SCRAPE_FLAG for r in lake.current(S.DIM_AMENITIES.name).collect()] == [False, False]


def test_tables_are_open_to_sql(spark, lake, root, raw_listing):
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1))
    assert len(L.open_views(lake)) == 7
    row = spark.sql(
        """SELECT l.LISTING_NAME, a.STREET_ADDRESS, f.PRICE_BRL
           FROM gold_fact_listings_scrapes f JOIN gold_dim_listings l USING (LISTING_ID)
           JOIN gold_dim_address a USING (ADDRESS_SK)"""
    ).first()
    assert tuple(row) == ("Sunny-Loft", "Rua a", 3150.0)


def test_jobs_by_layer(spark, tmp_path, raw_listing, monkeypatch):
    from hearthlake import __main__ as jobs

    landed = pages(spark, vivareal=[[item(raw_listing, "a")]]).withColumn("page_id", F.lit(1))
    landed.write.parquet(str(tmp_path / "pages"))
    for key, value in {
        "ENVIRONMENT": "dev", "CITY": "macae", "SITES": "vivareal", "PROPERTY_TYPES": "apartment",
        "START_PAGE": "1", "MAX_PAGE": "0",
    }.items():
        monkeypatch.setenv(key, value)
    monkeypatch.delenv("FILE_DATE", raising=False)
    places = ["--lake", str(tmp_path / "lake"), "--snapshots", str(tmp_path / "snapshots")]
    jobs.main(["snapshots", *places, "--pages", str(tmp_path / "pages")])
    for job in ("bronze", "silver", "gold"):
        jobs.main([job, *places])
    assert Lake(spark, str(tmp_path / "lake"), "dev").read(S.FACT.name).count() == 1


def test_page_bounds_and_scope(spark, lake, root, raw_listing):
    landed = pages(spark, vivareal=[[item(raw_listing, c)] for c in "abcd"], zapimoveis=[[item(raw_listing, "z")]])
    rows = L.land_snapshots(landed, root, params(1, start_page=2, max_page=3, sites=("vivareal",)), Staging(spark))
    assert sorted((r.site, r.page) for r in rows.collect()) == [("vivareal", 2), ("vivareal", 3)]


def test_backfill_of_an_old_date_leaves_the_dimensions(spark, lake, root, raw_listing):
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(2))
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "old")]]), root, params(1))
    assert {r.LISTING_ID for r in lake.read(S.FACT.name).collect()} == {"a", "old"}
    # Known gap of the model: the old date's key is in the fact only.
    assert set(flags(lake)) == {"a"}


def test_stream_loads_each_snapshot_once(spark, lake, root, raw_listing, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    follow = lambda: follow_snapshots(lake, root, params(1), checkpoint).awaitTermination(120)
    L.land_snapshots(pages(spark, vivareal=[[item(raw_listing, "a")], [item(raw_listing, "b")]]), root, params(1), Staging(spark))
    follow()
    assert lake.read(L.BRONZE_TABLE).count() == 2
    follow()
    L.land_snapshots(pages(spark, vivareal=[[item(raw_listing, "c")]]), root, params(2), Staging(spark))
    follow()
    loaded = lake.read(L.BRONZE_TABLE).groupBy(F.dayofmonth(S.BRONZE_PARTITION).alias("d")).count()
    assert {r.d: r["count"] for r in loaded.collect()} == {1: 2, 2: 1}


def test_landing_twice_leaves_each_snapshot_once(spark, lake, root, raw_listing):
    landed = pages(spark, vivareal=[[item(raw_listing, "a"), {**item(raw_listing, "x"), "@id": None}], [item(raw_listing, "b")]])
    for _ in range(2):
        L.land_snapshots(landed, root, params(1), Staging(spark))
    assert N.scan_snapshot_table(spark, root).count() == 2
    assert [(r.page, r.pos, r.reason) for r in N.scan_quarantine(spark, root).collect()] == [(1, 1, "no id")]
    L.run(lake, None, root, params(1))
    assert sorted(r.LISTING_ID for r in lake.read(L.BRONZE_TABLE).collect()) == ["a", "b"]


def test_search_columns_prune_the_snapshot_table(spark, root, raw_listing, plan_of):
    L.land_snapshots(pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1), Staging(spark))
    plan = plan_of(L.in_scope(N.scan_snapshot_table(spark, root, "2026-01-01"), params(1)))
    filters = plan.split("PartitionFilters:")[1].split("\n")[0]
    assert all(c in filters for c in ("file_date", "environment", "site", "city", "property_type"))


def test_broken_snapshots_stop_the_load_or_are_noted(spark, lake, root, raw_listing):
    base = Path(root, "dev/vivareal/macae/apartment")
    odd = {**item(raw_listing, "odd"), "offers": [1]}
    texts = [json.dumps({"a": item(raw_listing, "a"), "odd": odd}), json.dumps({"b": item(raw_listing, "b")})[:-1], "{} {}"]
    for page, text in enumerate(texts, 1):
        file = base / str(page) / "2026-01-01T00:00:00Z.json"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    with pytest.raises(B.UnreadableSnapshotError, match="apartment/[23]/"):
        L.run(lake, None, root, params(1), layout="files")
    assert not lake.exists(L.BRONZE_TABLE)
    for _ in range(2):
        L.run(lake, None, root, params(1, on_unreadable="quarantine"), layout="files")
        assert [r.LISTING_ID for r in lake.read(L.BRONZE_TABLE).collect()] == ["a"]
        noted = sorted((r.SRC_BLOB.split("/")[4], r.REASON) for r in lake.read(L.QUARANTINE_TABLE).collect())
        assert noted == [("1", "not an object: offers"), ("2", "unreadable payload"), ("3", "unreadable payload")]


def test_a_dimension_that_fails_does_not_hold_back_the_fact(spark, lake, root, raw_listing):
    L.run(lake, pages(spark, vivareal=[[item(raw_listing, "a")]]), root, params(1))
    twice = pages(spark, vivareal=[[item(raw_listing, "a", name="one")]], zapimoveis=[[item(raw_listing, "a", name="two", street="other")]])
    with pytest.raises(DuplicateKeyError):
        L.run(lake, twice, root, params(2))
    assert lake.read(S.FACT.name).where("day(SCRAPE_DATE) = 2").count() == 2
    L.run(lake, None, root, params(2, on_duplicate="first"))
    assert lake.read(S.FACT.name).where("day(SCRAPE_DATE) = 2").count() == 1
    assert lake.current(S.DIM_LISTINGS.name).count() == 1


def test_a_city_name_with_a_space(spark, lake, root, raw_listing):
    own = params(1, city="sao paulo", cities=("sao paulo",))
    file = Path(root, "dev/vivareal/sao paulo/apartment/1/2026-01-01T00:00:00Z.json")
    file.parent.mkdir(parents=True)
    file.write_text(json.dumps({"a": item(raw_listing, "a")}))
    L.run(lake, None, root, own, layout="files")
    assert [r.CITY for r in lake.read(S.SILVER.name).collect()] == ["sao paulo"]
