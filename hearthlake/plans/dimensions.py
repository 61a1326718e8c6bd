"""Silver -> the four gold dimensions.

Each has a first-load form over the whole history and a source of the latest
scrape that ``scd1_soft_delete`` compares with the dimension's current rows. The
first load marks every key active, also those of old dates. For amenities and
images the latest scrape is the last date that has any.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.functions import surrogate_key
from hearthlake.operators.pick import at_latest, first_per_key
from hearthlake.operators.scd import scd1_next, scd1_soft_delete, with_audit


def amenity_sk(feature: Column) -> Column:
    """Key of the raw name and value: NULL counts as empty, not as 'unknown'."""
    return surrogate_key(feature["NAME"], feature["VALUE"])


def address_sk() -> Column:
    return surrogate_key(*S.ADDRESS_COLUMNS)


def images_sk() -> Column:
    return surrogate_key(arrays=("IMAGES",))


# -- listings ---------------------------------------------------------------
_LISTING = ["LISTING_ID", "LISTING_NAME", "URL", "DESCRIPTION"]


def listings_first_load(silver: DataFrame) -> DataFrame:
    return first_per_key(silver, ["LISTING_ID"], [F.desc("SCRAPE_DATE"), F.col("BRONZE_ID")]).select(*_LISTING)


def listings_of(silver: DataFrame) -> DataFrame:
    return silver.select(*_LISTING).distinct()


# -- addresses --------------------------------------------------------------
def addresses_first_load(silver: DataFrame) -> DataFrame:
    """Distinct addresses with their last date first (map-side), then hashed: two
    addresses share a key only if their joined text is the same."""
    last_seen = silver.groupBy(*S.ADDRESS_COLUMNS).agg(F.max("SCRAPE_DATE").alias("_last"))
    keyed = last_seen.select(address_sk().alias("ADDRESS_SK"), *S.ADDRESS_COLUMNS, "_last")
    order = [F.desc("_last"), *[F.col(c) for c in S.ADDRESS_COLUMNS]]
    return first_per_key(keyed, ["ADDRESS_SK"], order).drop("_last")


def addresses_of(silver: DataFrame) -> DataFrame:
    distinct = silver.select(*S.ADDRESS_COLUMNS).distinct()
    return distinct.select(address_sk().alias("ADDRESS_SK"), *S.ADDRESS_COLUMNS)


# -- amenities --------------------------------------------------------------
def unnest_amenities(silver: DataFrame) -> DataFrame:
    """One row per listing and amenity; listings without any drop out."""
    return silver.select("LISTING_ID", "SCRAPE_DATE", F.explode("AMENITY_FEATURES").alias("AF"))


def amenities_of(silver: DataFrame) -> DataFrame:
    """Distinct amenities. Different raw pairs never give the same row, so the
    pairs are made distinct before they are hashed."""
    pairs = unnest_amenities(silver).select("AF.NAME", "AF.VALUE").distinct()
    return pairs.select(
        surrogate_key("NAME", "VALUE").alias("AMENITIES_SK"),
        F.coalesce("NAME", F.lit(S.DEFAULT_TEXT)).alias("AMENITY_NAME"),
        F.coalesce("VALUE", F.lit(S.DEFAULT_TEXT)).alias("AMENITY_VALUE"),
    )


# -- images -----------------------------------------------------------------
def unnest_images(silver: DataFrame) -> DataFrame:
    return silver.select(images_sk().alias("IMAGES_SK"), F.explode("IMAGES").alias("IMAGE_URL"))


def images_of(silver: DataFrame) -> DataFrame:
    """Distinct (image list, image). Every column is part of the key, so this is
    also the first load: no order has to be decided."""
    lists = silver.select("IMAGES").distinct()
    return (
        unnest_images(lists)
        .select("IMAGES_SK", F.coalesce("IMAGE_URL", F.lit(S.DEFAULT_TEXT)).alias("IMAGE_URL"))
        .distinct()
    )


@dataclass(frozen=True)
class Dimension:
    spec: S.TableSpec
    first_load_rows: Callable[[DataFrame], DataFrame]
    rows_of: Callable[[DataFrame], DataFrame]
    #: Silver rows that count when the latest scrape is looked for.
    counts: str | None = None

    def latest(self, silver: DataFrame) -> DataFrame:
        return at_latest(silver if self.counts is None else silver.where(self.counts))

    def full(self, silver: DataFrame, run_ts: datetime | str) -> DataFrame:
        return with_audit(self.first_load_rows(silver), run_ts)

    def source(self, silver: DataFrame) -> DataFrame:
        return self.rows_of(self.latest(silver))

    def incremental(self, silver: DataFrame, target: DataFrame, run_ts: datetime | str) -> DataFrame:
        """Rows to upsert into ``target``."""
        return scd1_soft_delete(self.source(silver), target, self.spec.keys, run_ts)

    def next_version(self, latest_rows: DataFrame, target: DataFrame, run_ts: datetime | str) -> DataFrame:
        """The whole dimension after the upsert of ``latest_rows``."""
        return scd1_next(latest_rows, target, self.spec.keys, run_ts)


LISTINGS = Dimension(S.DIM_LISTINGS, listings_first_load, listings_of)
ADDRESS = Dimension(S.DIM_ADDRESS, addresses_first_load, addresses_of)
AMENITIES = Dimension(S.DIM_AMENITIES, amenities_of, amenities_of, counts="size(AMENITY_FEATURES) > 0")
IMAGES = Dimension(S.DIM_IMAGES, images_of, images_of, counts="size(IMAGES) > 0")
ALL = (LISTINGS, ADDRESS, AMENITIES, IMAGES)
