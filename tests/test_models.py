"""Silver, dimensions, fact and their traps on small literal rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.operators import scd
from hearthlake.plans import dimensions as D
from hearthlake.plans import fact as A
from hearthlake.plans import silver as V
from tests.conftest import RUN

RUN_2, RUN_3 = "2026-01-02 00:00:00", "2026-01-03 00:00:00"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def bronze_row(id, **change):
    row = {
        "ID": id,
        "LISTING_ID": f"L{id}",
        "LISTING_NAME": "mill",
        "LISTING_URL": "https://rent.example/mill",
        "LISTING_DESCRIPTION": "by a stream",
        "LISTING_PETS_ALLOWED_FLAG": True,
        "LISTING_NUMBER_OF_ROOMS_AMT": 7,
        "LISTING_NUMBER_OF_BEDROOMS_AMT": 4,
        "LISTING_NUMBER_OF_BATHROOMS_AMT": 3,
        "LISTING_ADDRESS_INFOS": ("Travessa 9", "Ouro Preto", "MG", "BR"),
        "LISTING_FLOOR_SIZE_INFOS": (75.0, "M2"),
        "LISTING_IMAGES_LIST": ["wheel.jpg"],
        "LISTING_AMENITY_FEATURES_INFOS": [("View", "Stream")],
        "LISTING_OFFERS_INFOS": (4125.0, "BRL", "SoldOut", None, ("Condominium Fee", 85.5, "BRL/month")),
        "SRC_BLOB": "b",
        "SRC_SITE_NAME": "vivareal",
        "SRC_CITY_NAME": "macae",
        "SRC_PROPERTY_TYPE_CAT": "apartment",
        "SRC_PAGE_NUM": 1,
        "SRC_EXECUTED_AT_TS": "2026-01-01 08:00:00",
        "AUD_VERSION_ID": "v",
        "AUD_INS_TS": RUN,
        "AUD_UPD_TS": RUN,
    }
    row.update(change)
    return tuple(row.values())


def bronze(spark, *rows):
    schema = S.BRONZE.simpleString()[len("struct<") : -1]
    kinds = [f.dataType.simpleString() for f in S.BRONZE]
    text = ", ".join(
        f"{f.name} {'string' if k == 'timestamp' else k}" for f, k in zip(S.BRONZE.fields, kinds, strict=True)
    )
    df = spark.createDataFrame(list(rows), text)
    assert schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.BRONZE])


def silver(spark, *rows, **scope):
    return V.silver_listings(bronze(spark, *rows), RUN, **scope)


# -- silver ------------------------------------------------------------------


def test_columns_and_defaults(spark):
    row = silver(
        spark,
        bronze_row(
            "1",
            LISTING_NAME=None,
            LISTING_DESCRIPTION=None,
            LISTING_PETS_ALLOWED_FLAG=None,
            LISTING_NUMBER_OF_ROOMS_AMT=None,
            LISTING_ADDRESS_INFOS=None,
            LISTING_FLOOR_SIZE_INFOS=(75.0, None),
            LISTING_IMAGES_LIST=None,
            LISTING_AMENITY_FEATURES_INFOS=None,
            LISTING_OFFERS_INFOS=(4125.0, None, None, None, None),
        ),
    ).first()
    assert list(row.asDict()) == S.SILVER_COLUMNS
    assert (row.LISTING_NAME, row.DESCRIPTION) == ("Unknown", "Unknown")
    assert (row.STREET_ADDRESS, row.LOCALITY, row.COUNTRY, row.AVAILABILITY) == ("unknown",) * 4
    assert row.PETS_ALLOWED is True and row.ROOMS == 0 and row.OFFERS_PRICE == 0
    assert row.IMAGES == [] and row.AMENITY_FEATURES == []
    assert (row.OFFERS_PRICE_CURRENCY, row.OFFERS_PRICE_PERIOD) == ("unknown", "unknown")


def test_fee_unit_is_split(spark):
    row = silver(spark, bronze_row("1")).first()
    assert (row.OFFERS_PRICE_CURRENCY, row.OFFERS_PRICE_PERIOD) == ("BRL", "month")


@pytest.mark.parametrize(
    "change",
    [
        {"LISTING_URL": None},
        {"LISTING_FLOOR_SIZE_INFOS": None},
        {"LISTING_FLOOR_SIZE_INFOS": (None, "M2")},
        {"LISTING_OFFERS_INFOS": None},
        {"LISTING_OFFERS_INFOS": (None, "BRL", None, None, None)},
    ],
)
def test_rows_without_measures_drop(spark, change):
    assert silver(spark, bronze_row("1", **change)).count() == 0


def test_preferred_site_then_later_run_wins(spark):
    late, early = "2026-01-01 20:00:00", "2026-01-01 01:00:00"
    rows = [
        bronze_row("1", SRC_SITE_NAME="other", SRC_EXECUTED_AT_TS=late),
        bronze_row("2", SRC_SITE_NAME="zapimoveis", SRC_EXECUTED_AT_TS=late),
        bronze_row("3", SRC_SITE_NAME="vivareal", SRC_EXECUTED_AT_TS=early),
        bronze_row("4", SRC_SITE_NAME="vivareal"),
    ]
    ids = lambda *r: [x.BRONZE_ID for x in silver(spark, *r).collect()]
    assert ids(*rows) == ["4"] and ids(*rows[:3]) == ["3"] and ids(*rows[:2]) == ["2"]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"LISTING_FLOOR_SIZE_INFOS": (75.4, "M2")}, 1),
        ({"LISTING_FLOOR_SIZE_INFOS": (75.5, "M2")}, 2),
        ({"LISTING_FLOOR_SIZE_INFOS": (74.5, "M2")}, 1),
        ({"SRC_EXECUTED_AT_TS": "2026-01-02 00:00:00"}, 2),
        ({"LISTING_NUMBER_OF_ROOMS_AMT": 3}, 2),
        ({"SRC_PROPERTY_TYPE_CAT": "house"}, 2),
        ({"SRC_CITY_NAME": "elsewhere"}, 1),
        ({"LISTING_ADDRESS_INFOS": ("Travessa 9", "Other", "SP", "BR")}, 1),
        ({"LISTING_ADDRESS_INFOS": ("Travessa 8", "Ouro Preto", "MG", "BR")}, 2),
    ],
)
def test_what_makes_a_home(spark, change, kept):
    assert silver(spark, bronze_row("1"), bronze_row("2", **change)).count() == kept


def test_unknown_streets_collapse(spark):
    nowhere = {"LISTING_ADDRESS_INFOS": None}
    unknown = {"LISTING_ADDRESS_INFOS": ("unknown", "x", "y", "z")}
    assert silver(spark, bronze_row("1", **nowhere), bronze_row("2", **unknown)).count() == 1


def test_scope(spark):
    rows = [
        bronze_row("1"),
        bronze_row("2", SRC_SITE_NAME="zapimoveis", LISTING_NUMBER_OF_ROOMS_AMT=5),
        bronze_row("3", SRC_CITY_NAME="x", LISTING_NUMBER_OF_ROOMS_AMT=6),
        bronze_row("4", SRC_EXECUTED_AT_TS="2026-01-02 00:00:00"),
        bronze_row("5", SRC_PROPERTY_TYPE_CAT="house"),
    ]
    ids = lambda **scope: sorted(r.BRONZE_ID for r in silver(spark, *rows, **scope).collect())
    assert ids() == ["1", "2", "3", "4", "5"]
    assert ids(file_date="2026-01-02") == ["4"]
    assert ids(file_date="2026-01-01", city="macae", sites=["vivareal"], property_types=["apartment"]) == ["1"]
    assert ids(city="") == [] and ids(sites=[]) == []


def test_dates_are_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    row = silver(spark, bronze_row("1", SRC_EXECUTED_AT_TS="2026-01-01 23:59:59")).first()
    assert str(row.SCRAPE_DATE) == "2026-01-01"


def test_dedup_survives_a_hot_key(spark, plan_of):
    base = bronze(spark, bronze_row("1"))
    many = base.drop("ID").crossJoin(spark.range(20_000)).withColumn("ID", F.col("id").cast("string"))
    df = V.silver_listings(many.select(*S.BRONZE.fieldNames()), RUN)
    plan = plan_of(df, "simple")
    before_shuffle = plan.split("Exchange hashpartitioning")[-1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert df.count() == 1


# -- dimensions --------------------------------------------------------------


def day(n):
    return f"2026-01-{n:02d} 08:00:00"


def listing(id, n, name="a", price=1000.0, **change):
    offers = (price, "BRL", None, None, ("Condominium Fee", 85.5, "BRL/month"))
    return bronze_row(
        f"{id}-{n}", LISTING_ID=id, LISTING_NAME=name, SRC_EXECUTED_AT_TS=day(n), LISTING_OFFERS_INFOS=offers,
        **{"LISTING_ADDRESS_INFOS": (f"Travessa {id}", "Ouro Preto", "MG", "BR"), **change},
    )


def test_full_marks_every_key_and_takes_the_latest(spark):
    rows = D.LISTINGS.full(silver(spark, listing("1", 1, "old"), listing("1", 2, "new"), listing("2", 1)), RUN).collect()
    assert {(r.LISTING_ID, r.LISTING_NAME, r.IN_LAST_SCRAPE_FLAG) for r in rows} == {("1", "New", True), ("2", "A", True)}


def test_latest_scrape_is_global_over_sites(spark):
    rows = silver(spark, listing("1", 1), listing("2", 2, SRC_SITE_NAME="zapimoveis", SRC_CITY_NAME="x"))
    target = D.LISTINGS.full(rows.where("SCRAPE_DATE = '2026-01-01'"), RUN)
    changes = {r.LISTING_ID: r.IN_LAST_SCRAPE_FLAG for r in D.LISTINGS.incremental(rows, target, RUN_2).collect()}
    assert changes == {"1": False, "2": True}


@pytest.mark.parametrize("dim", [D.AMENITIES, D.IMAGES])
def test_latest_amenity_and_image_date_ignores_empty_days(spark, dim):
    rows = silver(
        spark, listing("1", 1), listing("2", 2, LISTING_IMAGES_LIST=[], LISTING_AMENITY_FEATURES_INFOS=[])
    )
    assert dim.source(rows).count() == 1
    assert D.LISTINGS.source(rows).count() == 1 and D.LISTINGS.source(rows).first().LISTING_ID == "2"


def snapshot(df):
    return {
        r.LISTING_ID: (r.IN_LAST_SCRAPE_FLAG, str(r.AUD_INS_TS), str(r.AUD_UPD_TS), r.LISTING_NAME)
        for r in df.collect()
    }


def test_appear_vanish_return(spark):
    history = silver(
        spark, listing("1", 1), listing("2", 1), listing("2", 2, "b"), listing("1", 3, "c"), listing("3", 3)
    )
    upto = lambda n: history.where(F.dayofmonth("SCRAPE_DATE") <= n)
    one = D.LISTINGS.full(upto(1), RUN)
    two = D.LISTINGS.next_version(D.LISTINGS.source(upto(2)), one, RUN_2)
    three = D.LISTINGS.next_version(D.LISTINGS.source(upto(3)), two, RUN_3)
    assert snapshot(two) == {"1": (False, RUN, RUN_2, "A"), "2": (True, RUN, RUN_2, "B")}
    assert snapshot(three) == {
        "1": (True, RUN, RUN_3, "C"), "2": (False, RUN, RUN_3, "B"), "3": (True, RUN_3, RUN_3, "A"),
    }


def test_inactive_rows_are_left_alone(spark):
    history = silver(spark, listing("1", 1), listing("2", 2), listing("2", 3))
    target = D.LISTINGS.full(history.where(F.dayofmonth("SCRAPE_DATE") == 1), RUN)
    for n, run in ((2, RUN_2), (3, RUN_3)):
        source = D.LISTINGS.source(history.where(F.dayofmonth("SCRAPE_DATE") <= n))
        changes, target = scd.scd1_soft_delete(source, target, ["LISTING_ID"], run), scd.scd1_next(source, target, ["LISTING_ID"], run)
    assert [r.LISTING_ID for r in changes.collect()] == ["2"]
    assert snapshot(target)["1"] == (False, RUN, RUN_2, "A")


@pytest.mark.parametrize("dim", D.ALL, ids=lambda d: d.spec.name)
def test_one_join_equals_both_halves(spark, dim):
    history = silver(spark, *[listing(str(i), 1, LISTING_IMAGES_LIST=[f"i{i}"]) for i in range(6)],
                     *[listing(str(i), 2, LISTING_IMAGES_LIST=[f"i{i}", "x"]) for i in range(3, 9)])
    target = dim.full(history.where("SCRAPE_DATE = '2026-01-01'"), RUN)
    source, keys = dim.source(history), dim.spec.keys
    halves = scd.active_rows(source, target, keys, RUN_2).unionByName(scd.deactivated_rows(source, target, keys, RUN_2))
    whole = scd.scd1_soft_delete(source, target, keys, RUN_2)
    assert sorted(map(tuple, halves.collect())) == sorted(map(tuple, whole.collect()))


def test_amenity_keys_and_display(spark):
    features = [(None, "x"), ("", "x"), ("a||b", "c"), ("a", "b||c"), (None, None)]
    rows = D.amenities_of(silver(spark, bronze_row("1", LISTING_AMENITY_FEATURES_INFOS=features * 2))).collect()
    assert sorted((r.AMENITIES_SK, r.AMENITY_NAME, r.AMENITY_VALUE) for r in rows) == sorted(
        [
            (md5("||x"), "unknown", "x"),
            (md5("||x"), "", "x"),
            (md5("a||b||c"), "a||b", "c"),
            (md5("a||b||c"), "a", "b||c"),
            (md5("||"), "unknown", "unknown"),
        ]
    )


def test_addresses_that_share_a_key_give_one_row(spark):
    rows = silver(
        spark,
        listing("1", 1, LISTING_ADDRESS_INFOS=("a||b", "c", "d", "e")),
        listing("2", 2, LISTING_ADDRESS_INFOS=("a", "b||c", "d", "e")),
    )
    full = D.ADDRESS.full(rows, RUN).collect()
    assert [(r.ADDRESS_SK, r.STREET_ADDRESS) for r in full] == [(md5("a||b||c||d||e"), "a")]


def test_image_keys_depend_on_order(spark):
    rows = silver(
        spark,
        bronze_row("1", LISTING_IMAGES_LIST=["a", "b"]),
        bronze_row("2", LISTING_IMAGES_LIST=["b", "a"], LISTING_NUMBER_OF_ROOMS_AMT=9),
        bronze_row("3", LISTING_IMAGES_LIST=[], LISTING_NUMBER_OF_ROOMS_AMT=8),
    )
    keys = {r.IMAGES_SK for r in D.IMAGES.full(rows, RUN).collect()}
    assert keys == {md5('["a","b"]'), md5('["b","a"]')}
    assert {r.IMAGES_SK for r in A.fact_listings(rows, RUN).collect()} == keys | {md5("[]")}


# -- fact --------------------------------------------------------------------


def test_fact_row(spark):
    features = [("View", "Stream"), ("View", "Hills"), ("View", "Stream")]
    row = A.fact_listings(silver(spark, bronze_row("1", LISTING_AMENITY_FEATURES_INFOS=features)), RUN).first()
    assert list(row.asDict()) == S.FACT_COLUMNS
    assert row.AMENITIES_SKS == sorted([md5("View||Stream"), md5("View||Hills")])
    assert row.ADDRESS_SK == md5("Travessa 9||Ouro Preto||MG||BR")
    assert (row.FLOOR_SIZE_M2, row.PRICE_BRL, row.CONDO_FEE_BRL) == (75.0, 4125.0, 85.5)


def test_only_the_fee_of_that_name_counts(spark):
    offers = (4125.0, "BRL", None, None, ("condominium fee", 85.5, None))
    assert A.fact_listings(silver(spark, bronze_row("1", LISTING_OFFERS_INFOS=offers)), RUN).first().CONDO_FEE_BRL == 0.0


@pytest.mark.parametrize(
    "change",
    [
        {"LISTING_OFFERS_INFOS": (1.0, "USD", None, None, None)},
        {"LISTING_OFFERS_INFOS": (1.0, None, None, None, None)},
        {"LISTING_FLOOR_SIZE_INFOS": (1.0, "FT")},
    ],
)
def test_other_units_stay_out(spark, change):
    assert A.fact_listings(silver(spark, bronze_row("1", **change)), RUN).count() == 0


def test_listing_without_amenities_has_an_empty_list(spark):
    row = A.fact_listings(silver(spark, bronze_row("1", LISTING_AMENITY_FEATURES_INFOS=[])), RUN).first()
    assert row.AMENITIES_SKS == []


def test_amenities_are_gathered_over_all_rows_of_a_listing(spark):
    rows = silver(
        spark,
        listing("1", 1, LISTING_AMENITY_FEATURES_INFOS=[("a", "1")]),
        listing("1", 1, price=9.0, LISTING_AMENITY_FEATURES_INFOS=[("b", "2")]),
        listing("1", 2, LISTING_AMENITY_FEATURES_INFOS=[("c", "3")]),
    )
    by_date = {(str(r.SCRAPE_DATE), r.PRICE_BRL): r.AMENITIES_SKS for r in A.fact_listings(rows, RUN).collect()}
    both = sorted([md5("a||1"), md5("b||2")])
    assert by_date == {
        ("2026-01-01", 1000.0): both, ("2026-01-01", 9.0): both, ("2026-01-02", 1000.0): [md5("c||3")],
    }
    assert A.fact_listings(rows, RUN, "2026-01-02").count() == 1


def test_price_trend(spark):
    rows = silver(spark, listing("1", 1, price=1000.0), listing("2", 1, price=2000.0), listing("3", 2, price=10.0))
    trend = {str(r.SCRAPE_DATE): r for r in A.price_trend(A.fact_listings(rows, RUN)).collect()}
    first = trend["2026-01-01"]
    assert (first.LISTINGS, first.AVG_PRICE_BRL, first.MIN_PRICE_BRL, first.MAX_PRICE_BRL) == (2, 1500.0, 1000.0, 2000.0)
    assert first.PRICE_PER_M2_BRL == 20.0 and trend["2026-01-02"].LISTINGS == 1
