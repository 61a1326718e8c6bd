"""Bronze -> one clean row per home and date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.functions import initcap_words, regexp_extract_or_null, round_to_long, site_rank
from hearthlake.operators.paging import on_date
from hearthlake.operators.pick import first_per_key
from hearthlake.operators.scd import as_ts


def select_scope(
    bronze: DataFrame,
    file_date: date | str | None = None,
    city: str | None = None,
    sites: Sequence[str] | None = None,
    property_types: Sequence[str] | None = None,
) -> DataFrame:
    """Bronze rows of one run. Each part left as None does not filter (a rebuild of
    the whole history in one job); an empty text or list matches nothing."""
    if file_date is not None:
        bronze = on_date(bronze, file_date)
    if city is not None:
        bronze = bronze.where(F.col("SRC_CITY_NAME") == city)
    for column, values in (("SRC_SITE_NAME", sites), ("SRC_PROPERTY_TYPE_CAT", property_types)):
        if values is not None:
            bronze = bronze.where(F.col(column).isin(*values) if values else F.lit(False))
    return bronze


def flatten_structs(bronze: DataFrame) -> DataFrame:
    """The leaves silver needs, as top-level columns.

    Done before rows are chosen: a window keeps whole structs, so only leaves
    picked below it are pruned at the scan and left out of the shuffle.
    """
    address, size, offers = "LISTING_ADDRESS_INFOS", "LISTING_FLOOR_SIZE_INFOS", "LISTING_OFFERS_INFOS"
    leaf = lambda path, name: F.col(path).alias(name)
    return bronze.select(
        "ID",
        "LISTING_ID",
        "LISTING_NAME",
        "LISTING_URL",
        "LISTING_DESCRIPTION",
        "LISTING_PETS_ALLOWED_FLAG",
        "LISTING_NUMBER_OF_ROOMS_AMT",
        "LISTING_NUMBER_OF_BEDROOMS_AMT",
        "LISTING_NUMBER_OF_BATHROOMS_AMT",
        *[leaf(f"{address}.{c}", c) for c in S.ADDRESS_COLUMNS],
        leaf(f"{size}.VALUE", "FLOOR_SIZE"),
        leaf(f"{size}.UNIT_CODE", "FLOOR_SIZE_UNIT_CODE"),
        "LISTING_IMAGES_LIST",
        "LISTING_AMENITY_FEATURES_INFOS",
        leaf(f"{offers}.PRICE", "PRICE"),
        leaf(f"{offers}.PRICE_CURRENCY", "PRICE_CURRENCY"),
        leaf(f"{offers}.AVAILABILITY", "AVAILABILITY"),
        leaf(f"{offers}.PROPERTY_VALUE.NAME", "FEE_NAME"),
        leaf(f"{offers}.PROPERTY_VALUE.VALUE", "FEE_VALUE"),
        leaf(f"{offers}.PROPERTY_VALUE.UNIT_TEXT", "FEE_UNIT_TEXT"),
        "SRC_SITE_NAME",
        "SRC_CITY_NAME",
        "SRC_PROPERTY_TYPE_CAT",
        "SRC_PAGE_NUM",
        "SRC_EXECUTED_AT_TS",
    )


def require_measures(flat: DataFrame) -> DataFrame:
    """Rows with a URL, a floor size and a price."""
    return flat.where("LISTING_URL IS NOT NULL AND FLOOR_SIZE IS NOT NULL AND PRICE IS NOT NULL")


def text_or_default(value: Column | str) -> Column:
    return F.coalesce(value, F.lit(S.DEFAULT_TEXT))


def number_or_default(value: Column | str) -> Column:
    return F.coalesce(value, F.lit(S.DEFAULT_NUMBER))


def silver_columns(run_ts: datetime | str) -> dict[str, Column]:
    """The 31 silver columns as expressions over flattened bronze."""
    unit = F.col("FEE_UNIT_TEXT")
    return {
        "BRONZE_ID": F.col("ID"),
        "LISTING_ID": F.col("LISTING_ID"),
        "LISTING_NAME": initcap_words(text_or_default("LISTING_NAME")),
        "URL": F.col("LISTING_URL"),
        "DESCRIPTION": initcap_words(text_or_default("LISTING_DESCRIPTION")),
        "PETS_ALLOWED": F.coalesce("LISTING_PETS_ALLOWED_FLAG", F.lit(S.DEFAULT_FLAG)),
        "ROOMS": number_or_default("LISTING_NUMBER_OF_ROOMS_AMT"),
        "BEDROOMS": number_or_default("LISTING_NUMBER_OF_BEDROOMS_AMT"),
        "BATHROOMS": number_or_default("LISTING_NUMBER_OF_BATHROOMS_AMT"),
        **{c: text_or_default(c) for c in S.ADDRESS_COLUMNS},
        "FLOOR_SIZE": F.col("FLOOR_SIZE"),
        "FLOOR_SIZE_UNIT_CODE": text_or_default("FLOOR_SIZE_UNIT_CODE"),
        "IMAGES": F.coalesce("LISTING_IMAGES_LIST", F.array().cast("array<string>")),
        "AMENITY_FEATURES": F.coalesce(
            "LISTING_AMENITY_FEATURES_INFOS", F.array().cast("array<struct<NAME:string,VALUE:string>>")
        ),
        "PRICE": F.col("PRICE"),
        "PRICE_CURRENCY": text_or_default("PRICE_CURRENCY"),
        "AVAILABILITY": text_or_default("AVAILABILITY"),
        "OFFERS_NAME": text_or_default("FEE_NAME"),
        "OFFERS_PRICE": number_or_default("FEE_VALUE"),
        "OFFERS_PRICE_CURRENCY": text_or_default(regexp_extract_or_null(unit, "^([A-Za-z]+)")),
        "OFFERS_PRICE_PERIOD": text_or_default(regexp_extract_or_null(unit, r"/([A-Za-z]+)\z")),
        "SITE": F.col("SRC_SITE_NAME"),
        "CITY": F.col("SRC_CITY_NAME"),
        "PROPERTY_TYPE": F.col("SRC_PROPERTY_TYPE_CAT"),
        "PAGE": F.col("SRC_PAGE_NUM"),
        "SCRAPE_DATE": F.to_date("SRC_EXECUTED_AT_TS"),
        "AUD_INS_TS": as_ts(run_ts),
        "AUD_UPD_TS": as_ts(run_ts),
    }


def dedup_cross_site(flat: DataFrame) -> DataFrame:
    """One row per home and date, whichever sites list it.

    A home is its street, type, rounded size and price, and room counts. The
    preferred site wins, then the later run, then the row id.
    """
    home = [
        F.to_date("SRC_EXECUTED_AT_TS"),
        text_or_default("STREET_ADDRESS"),
        text_or_default("SRC_PROPERTY_TYPE_CAT"),
        number_or_default(round_to_long(F.col("FLOOR_SIZE"))),
        number_or_default(round_to_long(F.col("PRICE"))),
        number_or_default("LISTING_NUMBER_OF_ROOMS_AMT"),
        number_or_default("LISTING_NUMBER_OF_BEDROOMS_AMT"),
        number_or_default("LISTING_NUMBER_OF_BATHROOMS_AMT"),
    ]
    return first_per_key(flat, home, [site_rank(F.col("SRC_SITE_NAME")), F.desc("SRC_EXECUTED_AT_TS"), F.col("ID")])


def silver_listings(bronze: DataFrame, run_ts: datetime | str, **scope) -> DataFrame:
    """The silver model. Rows are chosen first, so text is cleaned only for the
    rows that stay."""
    chosen = dedup_cross_site(require_measures(flatten_structs(select_scope(bronze, **scope))))
    return chosen.select(*[column.alias(name) for name, column in silver_columns(run_ts).items()])
