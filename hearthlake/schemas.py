"""Table schemas, keys, defaults and column contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _FLAG, _WHOLE, _NUMBER, _TIME = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType(), T.TimestampType()

ADDRESS = _struct(STREET_ADDRESS=_TEXT, LOCALITY=_TEXT, REGION=_TEXT, COUNTRY=_TEXT)
FLOOR_SIZE = _struct(VALUE=_NUMBER, UNIT_CODE=_TEXT)
AMENITY = _struct(NAME=_TEXT, VALUE=_TEXT)
PRICE_SPECIFICATION = _struct(PRICE=_NUMBER, PRICE_CURRENCY=_TEXT)
POTENTIAL_ACTION = _struct(TARGET=_TEXT, PRICE_SPECIFICATION=PRICE_SPECIFICATION)
PROPERTY_VALUE = _struct(NAME=_TEXT, VALUE=_NUMBER, UNIT_TEXT=_TEXT)
OFFERS = _struct(
    PRICE=_NUMBER,
    PRICE_CURRENCY=_TEXT,
    AVAILABILITY=_TEXT,
    POTENTIAL_ACTION=POTENTIAL_ACTION,
    PROPERTY_VALUE=PROPERTY_VALUE,
)

BRONZE = T.StructType(
    [T.StructField("ID", _TEXT, False), T.StructField("LISTING_ID", _TEXT, False)]
    + _struct(
        LISTING_NAME=_TEXT,
        LISTING_URL=_TEXT,
        LISTING_DESCRIPTION=_TEXT,
        LISTING_PETS_ALLOWED_FLAG=_FLAG,
        LISTING_NUMBER_OF_ROOMS_AMT=_WHOLE,
        LISTING_NUMBER_OF_BEDROOMS_AMT=_WHOLE,
        LISTING_NUMBER_OF_BATHROOMS_AMT=_WHOLE,
        LISTING_ADDRESS_INFOS=ADDRESS,
        LISTING_FLOOR_SIZE_INFOS=FLOOR_SIZE,
        LISTING_IMAGES_LIST=T.ArrayType(_TEXT),
        LISTING_AMENITY_FEATURES_INFOS=T.ArrayType(AMENITY),
        LISTING_OFFERS_INFOS=OFFERS,
        SRC_BLOB=_TEXT,
        SRC_SITE_NAME=_TEXT,
        SRC_CITY_NAME=_TEXT,
        SRC_PROPERTY_TYPE_CAT=_TEXT,
        SRC_PAGE_NUM=_WHOLE,
        SRC_EXECUTED_AT_TS=_TIME,
        AUD_VERSION_ID=_TEXT,
        AUD_INS_TS=_TIME,
        AUD_UPD_TS=_TIME,
    ).fields
)

#: Stored next to the bronze columns: Spark prunes files on a partition column,
#: not on a date computed from SRC_EXECUTED_AT_TS.
BRONZE_PARTITION = "SRC_EXECUTED_DATE"
#: Date of the run that rejected a listing.
REJECTED_ON = "REJECTED_ON_DT"

# What silver puts in place of a missing value.
DEFAULT_TEXT = "unknown"
DEFAULT_FLAG = True
DEFAULT_NUMBER = 0

# Which site wins when the same home is listed on several.
SITE_RANK = {"vivareal": 1, "zapimoveis": 2}
OTHER_SITE_RANK = 3

# What the fact is measured in.
FACT_CURRENCY = "BRL"
FACT_FLOOR_UNIT = "M2"
FACT_FEE_NAME = "Condominium Fee"

# The columns of the silver table.
SILVER_COLUMNS = [
    "BRONZE_ID", "LISTING_ID", "LISTING_NAME", "URL", "DESCRIPTION", "PETS_ALLOWED", "ROOMS", "BEDROOMS",
    "BATHROOMS", "STREET_ADDRESS", "LOCALITY", "REGION", "COUNTRY", "FLOOR_SIZE", "FLOOR_SIZE_UNIT_CODE",
    "IMAGES", "AMENITY_FEATURES", "PRICE", "PRICE_CURRENCY", "AVAILABILITY", "OFFERS_NAME", "OFFERS_PRICE",
    "OFFERS_PRICE_CURRENCY", "OFFERS_PRICE_PERIOD", "SITE", "CITY", "PROPERTY_TYPE", "PAGE", "SCRAPE_DATE",
    "AUD_INS_TS", "AUD_UPD_TS",
]

# The columns of the fact table.
FACT_COLUMNS = [
    "BRONZE_ID", "LISTING_ID", "ADDRESS_SK", "IMAGES_SK", "AMENITIES_SKS", "SITE", "CITY", "PROPERTY_TYPE",
    "PAGE", "SCRAPE_DATE", "PETS_ALLOWED", "ROOMS", "BEDROOMS", "BATHROOMS", "FLOOR_SIZE_M2", "PRICE_BRL",
    "CONDO_FEE_BRL", "AUD_INS_TS", "AUD_UPD_TS",
]

ADDRESS_COLUMNS = ["STREET_ADDRESS", "LOCALITY", "REGION", "COUNTRY"]


@dataclass(frozen=True)
class TableSpec:
    """Grain, layout and column tests of one silver or gold table."""

    name: str
    keys: tuple[str, ...]
    cluster: tuple[str, ...]
    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    partition: str | None = None
    #: Folders of a part, and the columns whose hash deals a part into buckets.
    folders: tuple[str, ...] = ()
    bucket: tuple[str, ...] = ()


_PLACE = ("SITE", "CITY", "PROPERTY_TYPE", "PAGE")
_AUDIT = ("AUD_INS_TS", "AUD_UPD_TS")

SILVER = TableSpec(
    name="silver_listings_deduped",
    keys=("LISTING_ID", "SCRAPE_DATE"),
    partition="SCRAPE_DATE",
    folders=("SCRAPE_DATE", "CITY"),
    bucket=("LISTING_ID",),
    cluster=_PLACE,
    not_null=tuple(c for c in SILVER_COLUMNS if c != "FLOOR_SIZE"),
    unique=("BRONZE_ID",),
    accepted=(("SITE", ("vivareal", "zapimoveis")), ("PROPERTY_TYPE", ("apartment", "house"))),
)
DIM_LISTINGS = TableSpec(
    name="gold_dim_listings",
    keys=("LISTING_ID",),
    cluster=("IN_LAST_SCRAPE_FLAG",),
    not_null=("LISTING_ID", "LISTING_NAME", "URL", "IN_LAST_SCRAPE_FLAG", *_AUDIT),
    unique=("LISTING_ID",),
)
DIM_ADDRESS = TableSpec(
    name="gold_dim_address",
    keys=("ADDRESS_SK",),
    cluster=("LOCALITY", "REGION", "COUNTRY", "IN_LAST_SCRAPE_FLAG"),
    not_null=("ADDRESS_SK", "LOCALITY", "REGION", "COUNTRY", "IN_LAST_SCRAPE_FLAG", *_AUDIT),
    unique=("ADDRESS_SK",),
)
DIM_AMENITIES = TableSpec(
    name="gold_dim_amenities",
    keys=("AMENITIES_SK",),
    cluster=("IN_LAST_SCRAPE_FLAG",),
    not_null=("AMENITIES_SK", "AMENITY_NAME", "AMENITY_VALUE", "IN_LAST_SCRAPE_FLAG", *_AUDIT),
)
DIM_IMAGES = TableSpec(
    name="gold_dim_images",
    keys=("IMAGES_SK", "IMAGE_URL"),
    cluster=("IN_LAST_SCRAPE_FLAG",),
    not_null=("IMAGES_SK", "IMAGE_URL", "IN_LAST_SCRAPE_FLAG", *_AUDIT),
)
FACT = TableSpec(
    name="gold_fact_listings_scrapes",
    keys=("LISTING_ID", "SCRAPE_DATE"),
    partition="SCRAPE_DATE",
    folders=("SCRAPE_DATE", "CITY"),
    bucket=("LISTING_ID",),
    cluster=_PLACE,
    not_null=tuple(c for c in FACT_COLUMNS if c not in ("BRONZE_ID", "PAGE")),
)
