import copy
import json

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.plans import bronze as B
from hearthlake.sources import snapshots as N
from hearthlake.sources.tables import Lake, count_tables, ensure_table
from tests.conftest import BARN, RUN, STUDIO

BLOB = "dev/vivareal/macae/apartment/2/2026-01-01T08:00:00Z.json"


def flat(spark, *listings):
    payload = json.dumps({str(i): x for i, x in enumerate(listings)}, ensure_ascii=False)
    df = N.path_lineage(spark.createDataFrame([(BLOB, payload)], "blob string, payload string"))
    return B.flatten_listings(N.parse_snapshot_json(df), RUN, "v9")


def one(spark, listing):
    return flat(spark, listing).first().asDict(recursive=True)


def test_every_column_is_mapped(spark, raw_listing):
    df = flat(spark, raw_listing)
    assert df.columns == S.BRONZE.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in S.BRONZE]
    row = df.first().asDict(recursive=True)
    assert row["LISTING_ID"] == "loft-17"
    assert (row["LISTING_NAME"], row["LISTING_URL"]) == ("sunny-loft", "https://rent.example/loft-17")
    assert row["LISTING_DESCRIPTION"] == "top floor/no lift" and row["LISTING_PETS_ALLOWED_FLAG"] is True
    assert [row[f"LISTING_NUMBER_OF_{room}_AMT"] for room in ("ROOMS", "BEDROOMS", "BATHROOMS")] == [5, 3, 4]
    assert list(row["LISTING_ADDRESS_INFOS"].items()) == [
        ("STREET_ADDRESS", "Alameda dos Ipês"), ("LOCALITY", "Tiradentes"), ("REGION", "MG"), ("COUNTRY", "BR"),
    ]
    assert row["LISTING_FLOOR_SIZE_INFOS"] == {"VALUE": 84.5, "UNIT_CODE": "M2"}
    assert row["LISTING_IMAGES_LIST"] == [f"https://rent.example/loft-17/{x}.jpg" for x in ("door", "roof")]
    assert [tuple(f.values()) for f in row["LISTING_AMENITY_FEATURES_INFOS"]] == [("Garden", "Fig tree"), ("Safety", "Night guard")]
    offers = row["LISTING_OFFERS_INFOS"]
    assert (offers["PRICE"], offers["PRICE_CURRENCY"], offers["AVAILABILITY"]) == (3150.0, "BRL", "PreOrder")
    assert offers["POTENTIAL_ACTION"] == {"TARGET": "https://rent.example/ask", "PRICE_SPECIFICATION": {"PRICE": 3090.5, "PRICE_CURRENCY": "BRL"}}
    assert offers["PROPERTY_VALUE"] == {"NAME": "Condominium Fee", "VALUE": 415.25, "UNIT_TEXT": "BRL/month"}
    assert (row["SRC_BLOB"], row["SRC_SITE_NAME"], row["SRC_PAGE_NUM"]) == (BLOB, "vivareal", 2)
    assert str(row["SRC_EXECUTED_AT_TS"]) == "2026-01-01 08:00:00"
    assert row["AUD_VERSION_ID"] == "v9" and row["AUD_INS_TS"] == row["AUD_UPD_TS"]


def test_homes_of_other_kinds(spark):
    studio, barn = (one(spark, home) for home in (STUDIO, BARN))
    assert (studio["LISTING_NUMBER_OF_ROOMS_AMT"], studio["LISTING_NUMBER_OF_BATHROOMS_AMT"]) == (1, 1)
    assert studio["LISTING_ADDRESS_INFOS"] is None and studio["LISTING_FLOOR_SIZE_INFOS"]["VALUE"] == 28.75
    assert studio["LISTING_OFFERS_INFOS"] == {"PRICE": 1290.9, "PRICE_CURRENCY": "BRL", "AVAILABILITY": None, "POTENTIAL_ACTION": None, "PROPERTY_VALUE": None}
    assert barn["LISTING_PETS_ALLOWED_FLAG"] is None and barn["LISTING_NUMBER_OF_ROOMS_AMT"] == 11
    assert barn["LISTING_ADDRESS_INFOS"] is None and barn["LISTING_IMAGES_LIST"] == []
    assert barn["LISTING_FLOOR_SIZE_INFOS"] == {"VALUE": 2600.0, "UNIT_CODE": "FT"}
    assert barn["LISTING_AMENITY_FEATURES_INFOS"] == [{"NAME": None, "VALUE": "Pond"}]
    assert barn["LISTING_OFFERS_INFOS"]["PROPERTY_VALUE"] == {"NAME": "Tax", "VALUE": 12.0, "UNIT_TEXT": "/year"}


def test_minimal_listing(spark):
    row = one(spark, {"@id": "7", "name": "x"})
    assert (row["LISTING_ID"], row["LISTING_NAME"], row["LISTING_URL"]) == ("7", "x", None)
    for struct in ("ADDRESS", "FLOOR_SIZE", "OFFERS"):
        assert row[f"LISTING_{struct}_INFOS"] is None
    assert row["LISTING_IMAGES_LIST"] == [] and row["LISTING_AMENITY_FEATURES_INFOS"] == []


@pytest.mark.parametrize("empty", [None, {}])
def test_empty_objects_are_null(spark, raw_listing, empty):
    for change in ("address", "floorSize", "offers"):
        listing = {**raw_listing, change: empty}
        name = {"address": "ADDRESS", "floorSize": "FLOOR_SIZE", "offers": "OFFERS"}[change]
        assert one(spark, listing)[f"LISTING_{name}_INFOS"] is None
    listing = copy.deepcopy(raw_listing)
    listing["offers"]["potentialAction"] = empty
    listing["offers"]["propertyValue"] = empty
    offers = one(spark, listing)["LISTING_OFFERS_INFOS"]
    assert offers["PRICE"] == 3150.0 and offers["POTENTIAL_ACTION"] is None and offers["PROPERTY_VALUE"] is None


def test_object_of_unknown_members_is_a_struct_of_nulls(spark):
    row = one(spark, {"@id": "1", "address": {"@type": "PostalAddress"}})
    assert row["LISTING_ADDRESS_INFOS"] == dict.fromkeys(["STREET_ADDRESS", "LOCALITY", "REGION", "COUNTRY"])


def test_numbers_as_text_and_as_decimals(spark, raw_listing):
    listing = copy.deepcopy(raw_listing)
    listing.update(numberOfRooms=3.0, numberOfBedrooms="2", floorSize={"value": "61.5"})
    listing["offers"]["price"] = "1999.9"
    row = one(spark, listing)
    assert (row["LISTING_NUMBER_OF_ROOMS_AMT"], row["LISTING_NUMBER_OF_BEDROOMS_AMT"]) == (3, 2)
    assert row["LISTING_FLOOR_SIZE_INFOS"]["VALUE"] == 61.5
    assert row["LISTING_OFFERS_INFOS"]["PRICE"] == 1999.9


def test_unusable_values_are_null(spark):
    row = one(spark, {"@id": "1", "numberOfRooms": "many", "petsAllowed": "maybe", "image": "one", "amenityFeature": 3})
    assert row["LISTING_NUMBER_OF_ROOMS_AMT"] is None and row["LISTING_PETS_ALLOWED_FLAG"] is None
    assert row["LISTING_IMAGES_LIST"] == [] and row["LISTING_AMENITY_FEATURES_INFOS"] == []


def test_row_ids_are_unique_and_repeatable(spark, raw_listing):
    listings = [{**raw_listing, "@id": str(i)} for i in range(20)]
    first = [r.ID for r in flat(spark, *listings).collect()]
    assert len(set(first)) == 20 and first == [r.ID for r in flat(spark, *listings).collect()]


def test_listings_without_id_are_rejected(spark, raw_listing):
    nameless = {k: v for k, v in raw_listing.items() if k != "@id"}
    payload = json.dumps({"a": raw_listing, "b": nameless})
    snapshots = N.path_lineage(spark.createDataFrame([(BLOB, payload)], "blob string, payload string"))
    assert B.bronze_rows(snapshots, snapshots, RUN, "v").count() == 1
    assert B.rejected_rows(snapshots, snapshots, RUN, "v").count() == 1


def test_append_keeps_what_is_there(spark, raw_listing, tmp_path):
    lake = Lake(spark, str(tmp_path), "dev")
    assert not lake.exists("b")
    rows = B.with_partition(flat(spark, raw_listing))
    for _ in range(2):
        lake.append(rows, "b", S.BRONZE_PARTITION, ["SRC_SITE_NAME"])
    assert lake.exists("b") and lake.read("b").count() == 2
    assert lake.partition_values("b", S.BRONZE_PARTITION) == ["2026-01-01"]


def test_bronze_scan_prunes_dates_and_leaves(spark, raw_listing, tmp_path, plan_of):
    from hearthlake.plans.silver import silver_listings

    lake = Lake(spark, str(tmp_path), "dev")
    lake.append(B.with_partition(flat(spark, raw_listing)), "b", S.BRONZE_PARTITION)
    plan = plan_of(silver_listings(lake.read("b"), RUN, file_date="2026-01-01", city="macae", sites=["vivareal"]))
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    for unused in ("POTENTIAL_ACTION", "AUD_VERSION_ID", "SRC_BLOB"):
        assert unused not in schema
    assert "SRC_EXECUTED_DATE" in plan.split("PartitionFilters:")[1].split("\n")[0]
    pushed = plan.split("PushedFilters:")[1].split("\n")[0]
    assert "EqualTo(SRC_CITY_NAME,macae)" in pushed and "IsNotNull(LISTING_FLOOR_SIZE_INFOS.VALUE)" in pushed


def test_ensure_table(spark, raw_listing, tmp_path):
    name = f"bronze_{tmp_path.name.replace('-', '_')}"
    assert count_tables(spark, name) == 0
    assert ensure_table(spark, name, S.BRONZE, S.BRONZE_PARTITION, str(tmp_path / "t")) is True
    assert ensure_table(spark, name, S.BRONZE, S.BRONZE_PARTITION, str(tmp_path / "t")) is False
    assert count_tables(spark, name) == 1
    B.with_partition(flat(spark, raw_listing)).write.mode("append").insertInto(name)
    assert spark.table(name).where(F.col(S.BRONZE_PARTITION) == "2026-01-01").count() == 1
    spark.sql(f"DROP TABLE {name}")
