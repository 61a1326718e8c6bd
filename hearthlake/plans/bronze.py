"""Raw listings -> the nested bronze table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.functions import member, non_empty_object, surrogate_key
from hearthlake.operators.paging import (
    BY_DATE,
    before_first_missing,
    first_missing_page,
    latest_snapshot,
    page_bounds,
    skip_loaded,
)
from hearthlake.operators.scd import as_ts
from hearthlake.sources.snapshots import parse_snapshots


# The members of a raw listing that bronze keeps. One cast reads them all in
# a single pass; a value that does not fit its type is NULL on its own.
RAW_LISTING = """struct<
  `@id`: string, name: string, url: string, description: string, petsAllowed: boolean,
  numberOfRooms: bigint, numberOfBedrooms: bigint, numberOfBathroomsTotal: bigint,
  address: struct<streetAddress: string, addressLocality: string, addressRegion: string, addressCountry: string>,
  floorSize: struct<value: double, unitCode: string>,
  image: array<string>,
  amenityFeature: array<struct<name: string, value: string>>,
  offers: struct<price: double, priceCurrency: string, availability: string,
    potentialAction: struct<target: string, priceSpecification: struct<price: double, priceCurrency: string>>,
    propertyValue: struct<name: string, value: double, unitText: string>>>"""


def read_listing(listings: DataFrame, listing: str = "listing") -> DataFrame:
    """Add ``raw``, the listing's members by type, next to the VARIANT."""
    return listings.withColumn("raw", member(F.col(listing), "$", RAW_LISTING))


def null_empty_struct(path: str, members: dict[str, str], *nested: Column) -> Column:
    """The struct of a raw object's ``members`` (and ``nested`` structs), or NULL
    where the object is absent or empty.

    An object with only unknown members still gives a struct. That is looked up in
    the VARIANT only where no known member has a value.
    """
    values = [F.col(f"raw.{path}.{name}") for name in members]
    seen = values[0].isNotNull()
    for value in [*values[1:], *nested]:
        seen |= value.isNotNull()
    fields = [value.alias(new) for value, new in zip(values, members.values(), strict=True)]
    present = F.col(f"raw.{path}").isNotNull() & (seen | non_empty_object(F.col("listing"), f"$.{path}"))
    return F.when(present, F.struct(*fields, *nested))


def empty_array_default(array: Column, as_type: str) -> Column:
    return F.coalesce(array, F.array().cast(as_type))


def renamed_features() -> Column:
    """``[{name, value}]`` -> ``[{NAME, VALUE}]``."""
    return F.transform(
        "raw.amenityFeature", lambda f: F.struct(f["name"].alias("NAME"), f["value"].alias("VALUE"))
    )


def listing_columns() -> dict[str, Column]:
    """The payload columns of a bronze row, over ``read_listing``."""
    price_spec = null_empty_struct(
        "offers.potentialAction.priceSpecification", {"price": "PRICE", "priceCurrency": "PRICE_CURRENCY"}
    )
    action = null_empty_struct(
        "offers.potentialAction", {"target": "TARGET"}, price_spec.alias("PRICE_SPECIFICATION")
    )
    fee = null_empty_struct("offers.propertyValue", {"name": "NAME", "value": "VALUE", "unitText": "UNIT_TEXT"})
    return {
        "LISTING_ID": F.col("raw.`@id`"),
        "LISTING_NAME": F.col("raw.name"),
        "LISTING_URL": F.col("raw.url"),
        "LISTING_DESCRIPTION": F.col("raw.description"),
        "LISTING_PETS_ALLOWED_FLAG": F.col("raw.petsAllowed"),
        "LISTING_NUMBER_OF_ROOMS_AMT": F.col("raw.numberOfRooms"),
        "LISTING_NUMBER_OF_BEDROOMS_AMT": F.col("raw.numberOfBedrooms"),
        "LISTING_NUMBER_OF_BATHROOMS_AMT": F.col("raw.numberOfBathroomsTotal"),
        "LISTING_ADDRESS_INFOS": null_empty_struct(
            "address",
            {
                "streetAddress": "STREET_ADDRESS",
                "addressLocality": "LOCALITY",
                "addressRegion": "REGION",
                "addressCountry": "COUNTRY",
            },
        ),
        "LISTING_FLOOR_SIZE_INFOS": null_empty_struct("floorSize", {"value": "VALUE", "unitCode": "UNIT_CODE"}),
        "LISTING_IMAGES_LIST": empty_array_default(F.col("raw.image"), "array<string>"),
        "LISTING_AMENITY_FEATURES_INFOS": empty_array_default(
            renamed_features(), "array<struct<NAME:string,VALUE:string>>"
        ),
        "LISTING_OFFERS_INFOS": null_empty_struct(
            "offers",
            {"price": "PRICE", "priceCurrency": "PRICE_CURRENCY", "availability": "AVAILABILITY"},
            action.alias("POTENTIAL_ACTION"),
            fee.alias("PROPERTY_VALUE"),
        ),
    }


def bronze_row_id(blob: Column, key: Column) -> Column:
    """Row id that a rerun reproduces: a page holds each key once."""
    return surrogate_key(blob, key)


def flatten_listings(listings: DataFrame, run_ts: datetime | str, version: str) -> DataFrame:
    """Snapshot listings (see ``parse_snapshot_json``) -> the 23 bronze columns."""
    return read_listing(listings).select(*_bronze_columns(run_ts, version))


def _bronze_columns(run_ts: datetime | str, version: str) -> list[Column]:
    payload = listing_columns()
    return [
        bronze_row_id(F.col("blob"), F.col("listing_key")).alias("ID"),
        *[column.alias(name) for name, column in payload.items()],
        F.col("blob").alias("SRC_BLOB"),
        F.col("site").alias("SRC_SITE_NAME"),
        F.col("city").alias("SRC_CITY_NAME"),
        F.col("property_type").alias("SRC_PROPERTY_TYPE_CAT"),
        F.col("page").alias("SRC_PAGE_NUM"),
        F.col("executed_at").alias("SRC_EXECUTED_AT_TS"),
        *audit_columns(run_ts, version),
    ]


def audit_columns(run_ts: datetime | str, version: str) -> list[Column]:
    return [
        F.lit(version).alias("AUD_VERSION_ID"),
        as_ts(run_ts).alias("AUD_INS_TS"),
        as_ts(run_ts).alias("AUD_UPD_TS"),
    ]


def select_snapshots(
    snapshots: DataFrame, loaded: DataFrame | None, start_page: int = 1, max_page: int | None = None
) -> DataFrame:
    """Snapshots to load: the latest of each page up to the first page without one.

    A loaded page is skipped but still counts as present, so gaps are judged
    before loaded paths are dropped. Which pages exist does not depend on which
    snapshot is the latest, so the bounds need no window.
    """
    wanted = page_bounds(snapshots, start_page, max_page)
    bounds = first_missing_page(wanted, BY_DATE, start_page)
    chosen = before_first_missing(latest_snapshot(wanted), bounds, BY_DATE, start_page)
    return chosen if loaded is None else skip_loaded(chosen, loaded)


#: Members of a raw listing that are objects if they are there.
OBJECTS = ("address", "floorSize", "offers")
UNREADABLE, NO_ID, NO_RUN_TIME, MISSHAPEN = "unreadable payload", "no id", "no run time", "not an object: "
REASON = "REASON"


class UnreadableSnapshotError(ValueError):
    """A chosen snapshot is not exactly one JSON object."""


def misshapen() -> Column:
    """Names of the members that should be objects and are something else, comma-joined; NULL if none."""
    listing = F.col("listing")
    wrong = [
        F.when(
            member(listing, f"$.{name}", "variant").isNotNull()
            & ~F.coalesce(F.is_variant_null(member(listing, f"$.{name}", "variant")), F.lit(False))
            & member(listing, f"$.{name}", "map<string,variant>").isNull(),
            name,
        )
        for name in OBJECTS
    ]
    return F.nullif(F.concat_ws(",", *wrong), F.lit(""))


def raw_bronze_rows(snapshots: DataFrame, chosen: DataFrame, run_ts: datetime | str, version: str) -> DataFrame:
    """Every listing of the chosen snapshots as a bronze row, with its key, and for
    those the table does not take the ``REASON`` and the listing's JSON. A snapshot that
    cannot be read is one row. The choice is made on paths alone; the payloads are read
    once, here."""
    wanted = snapshots.join(chosen.select("blob"), "blob", "left_semi")
    reason = (
        F.when(~F.col("readable"), UNREADABLE)
        .when(F.col("raw.`@id`").isNull(), NO_ID)
        .when(F.col("executed_at").isNull(), NO_RUN_TIME)
        .when(F.col("wrong").isNotNull(), F.concat(F.lit(MISSHAPEN), "wrong"))
    )
    judged = read_listing(parse_snapshots(wanted)).withColumn("wrong", misshapen()).withColumn("reason", reason)
    return judged.select(
        *_bronze_columns(run_ts, version),
        F.col("listing_key").alias("LISTING_KEY"),
        F.when(F.col("reason").isNotNull(), F.to_json("listing")).alias("LISTING"),
        F.col("reason").alias(REASON),
    )


def loadable(rows: DataFrame) -> DataFrame:
    """The bronze rows among ``raw_bronze_rows``."""
    return rows.where(F.col(REASON).isNull()).drop("LISTING_KEY", "LISTING", REASON)


def rejected(rows: DataFrame) -> DataFrame:
    """What the table does not take: path, key, reason and the listing itself."""
    lost = rows.where(F.col(REASON).isNotNull())
    dates = [F.to_date("AUD_INS_TS").alias(S.REJECTED_ON), F.to_date("SRC_EXECUTED_AT_TS").alias(S.BRONZE_PARTITION)]
    return lost.select("SRC_BLOB", "LISTING_KEY", REASON, "LISTING", *dates)


def bronze_rows(snapshots: DataFrame, chosen: DataFrame, run_ts: datetime | str, version: str) -> DataFrame:
    return loadable(raw_bronze_rows(snapshots, chosen, run_ts, version))


def rejected_rows(snapshots: DataFrame, chosen: DataFrame, run_ts: datetime | str, version: str) -> DataFrame:
    """The rows the table does not take, for a quarantine."""
    return rejected(raw_bronze_rows(snapshots, chosen, run_ts, version))


def with_partition(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn(S.BRONZE_PARTITION, F.to_date("SRC_EXECUTED_AT_TS"))
