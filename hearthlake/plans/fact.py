"""Silver -> the fact table, and the price trend read from it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.operators.scd import as_ts
from hearthlake.plans.dimensions import address_sk, amenity_sk, images_sk

_GRAIN = ["LISTING_ID", "SCRAPE_DATE"]


def amenities_per_listing(silver: DataFrame) -> DataFrame:
    """Distinct amenity keys of every listing and date, sorted.

    Repeats go within the row, then per map task, before anything is shuffled.
    """
    keys = F.array_distinct(F.transform("AMENITY_FEATURES", amenity_sk))
    exploded = silver.select(*_GRAIN, F.explode(keys).alias("_sk"))
    return exploded.groupBy(*_GRAIN).agg(F.array_sort(F.collect_set("_sk")).alias("AMENITIES_SKS"))


def in_fact_units(silver: DataFrame) -> DataFrame:
    return silver.where(
        (F.col("PRICE_CURRENCY") == S.FACT_CURRENCY) & (F.col("FLOOR_SIZE_UNIT_CODE") == S.FACT_FLOOR_UNIT)
    )


def fact_listings(silver: DataFrame, run_ts: datetime | str, file_date: date | str | None = None) -> DataFrame:
    """The fact rows of one date, or of every date.

    Amenities are gathered over all rows of a listing and date, also those in
    other units, before the unit filter.
    """
    if file_date is not None:
        silver = silver.where(F.col("SCRAPE_DATE") == F.lit(file_date).cast("date"))
    fee = F.when(F.col("OFFERS_NAME") == S.FACT_FEE_NAME, F.col("OFFERS_PRICE")).otherwise(F.lit(0.0))
    measures = in_fact_units(silver).select(
        "BRONZE_ID",
        "LISTING_ID",
        address_sk().alias("ADDRESS_SK"),
        images_sk().alias("IMAGES_SK"),
        "SITE",
        "CITY",
        "PROPERTY_TYPE",
        "PAGE",
        "SCRAPE_DATE",
        "PETS_ALLOWED",
        "ROOMS",
        "BEDROOMS",
        "BATHROOMS",
        F.col("FLOOR_SIZE").alias("FLOOR_SIZE_M2"),
        F.col("PRICE").alias("PRICE_BRL"),
        fee.alias("CONDO_FEE_BRL"),
        as_ts(run_ts).alias("AUD_INS_TS"),
        as_ts(run_ts).alias("AUD_UPD_TS"),
    )
    joined = measures.join(amenities_per_listing(silver), _GRAIN, "left").withColumn(
        "AMENITIES_SKS", F.coalesce("AMENITIES_SKS", F.array().cast("array<string>"))
    )
    return joined.select(*S.FACT_COLUMNS)


def amenity_bridge(fact: DataFrame, amenities: DataFrame) -> DataFrame:
    """Fact rows with their amenities: an equi-join on the exploded keys. A hot
    amenity's partition is split at run time."""
    links = fact.select(*_GRAIN, F.explode("AMENITIES_SKS").alias("AMENITIES_SK"))
    return links.join(amenities.select("AMENITIES_SK", "AMENITY_NAME", "AMENITY_VALUE"), "AMENITIES_SK")


#: Digits kept of amounts and sizes while they are summed; more than any of them has.
_SCALE = "decimal(38,10)"


def price_trend(fact: DataFrame) -> DataFrame:
    """Rent level per city, property type and date: mean, quartiles and range of the price.

    Sums are decimal, so the result does not depend on the order of the rows, and no value
    is rounded before. Rows are first counted per price, so a city that holds most rows is
    only as large as it has prices when the quartiles are taken (interpolated, six digits). A floor size of zero
    overall has no price per square metre.
    """
    place = ["CITY", "PROPERTY_TYPE", "SCRAPE_DATE"]
    exact = lambda c: F.sum(F.col(c).cast(_SCALE))
    per_price = fact.groupBy(*place, "PRICE_BRL").agg(
        F.count("*").alias("n"), *[exact(c).alias(c.lower()) for c in ("CONDO_FEE_BRL", "FLOOR_SIZE_M2")]
    )
    total = lambda c: F.sum(c).cast("double")
    price = F.sum(F.col("PRICE_BRL").cast("decimal(24,10)") * F.col("n").cast("decimal(12,0)")).cast("double")
    quartiles = F.percentile("PRICE_BRL", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    out = per_price.groupBy(*place).agg(
        F.sum("n").alias("LISTINGS"),
        (price / F.sum("n")).alias("AVG_PRICE_BRL"),
        F.min("PRICE_BRL").alias("MIN_PRICE_BRL"),
        F.max("PRICE_BRL").alias("MAX_PRICE_BRL"),
        quartiles.alias("quartiles"),
        (total("condo_fee_brl") / F.sum("n")).alias("AVG_CONDO_FEE_BRL"),
        F.try_divide(price, total("floor_size_m2")).alias("PRICE_PER_M2_BRL"),
    )
    named = [F.round(F.col("quartiles")[i], 6).alias(name) for i, name in enumerate(("Q1_PRICE_BRL", "MEDIAN_PRICE_BRL", "Q3_PRICE_BRL"))]
    return out.select("*", *named).drop("quartiles")
