"""Listings out of page HTML. One row per page in, nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.functions import member, parse_json_strict

OK, NO_ITEM_LIST, MALFORMED = "ok", "no_item_list", "malformed_json"

# Whatever starts first in the page wins: a comment hides the scripts inside it,
# a script hides the comment marks inside it. Only the body of a JSON-LD script
# is captured. Every repetition is over a single character class, which the
# regex engine runs as a loop (no recursion on long input).
# All begin with "<", said once: the engine tries the alternatives there only.
_TOKENS = "(?s)<(?:%s)" % "|".join(
    [
        r"!--.*?-->",
        r"""(?i:script)\b(?=[^>]*?(?<=[\s"'])(?i:type)\s*=\s*"""
        r"""(?:"application/ld\+json"|'application/ld\+json'|application/ld\+json(?=[\s>])))"""
        r"[^>]*+>(.*?)</(?i:script)\s*>",
        r"(?i:script)\b[^>]*+>.*?</(?i:script)\s*>",
        r"(?i:style)\b[^>]*+>.*?</(?i:style)\s*>",
    ]
)

ELEMENT = "array<struct<pos:int,id:string,item:variant>>"


def jsonld_blocks(html: Column) -> Column:
    """Bodies of all ``application/ld+json`` scripts, empty ones left out."""
    bodies = F.regexp_extract_all(html, F.lit(_TOKENS), F.lit(1))
    # A plain byte search spares most foreign pages the regex.
    found = F.when(html.contains("ld+json"), bodies).otherwise(F.array().cast("array<string>"))
    return F.filter(found, lambda body: body != "")


def parsed_blocks(pages: DataFrame, blocks: str, html: str = "html") -> DataFrame:
    """Replace ``html`` by its parsed blocks, NULL for a malformed one.

    They come out of a generator, so that the optimizer puts no later filter below the
    parse, where it would parse once more.
    """
    keep = [c for c in pages.columns if c != html]
    parsed = parse_json_strict(jsonld_blocks(F.col(html)))
    return pages.select(*keep, F.explode_outer(F.array(parsed)).alias(blocks))


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace ``html`` by ``status`` and ``elements`` (position, id, raw listing).

    One bad block spoils its page, as does the lack of an ``ItemList`` block;
    such pages have no elements.
    """
    parsed = parsed_blocks(pages, "_blocks", html)
    is_list = lambda b: member(b, '$["@type"]', "string") == "ItemList"
    judged = parsed.withColumns(
        {
            "_malformed": F.exists("_blocks", lambda b: b.isNull()),
            "_list": F.get(F.filter("_blocks", is_list), F.lit(0)),
        }
    ).drop("_blocks")
    to_element = lambda e, i: F.struct(
        i.alias("pos"),
        member(e, '$.item["@id"]', "string").alias("id"),
        member(e, "$.item", "variant").alias("item"),
    )
    return judged.select(
        *[c for c in judged.columns if not c.startswith("_")],
        F.when(F.col("_malformed"), MALFORMED)
        .when(F.col("_list").isNull(), NO_ITEM_LIST)
        .otherwise(OK)
        .alias("status"),
        F.when(
            ~F.col("_malformed"),
            F.transform(member(F.col("_list"), "$.itemListElement", "array<variant>"), to_element),
        ).alias("elements"),
    )


def keep_last_per_id(extracted: DataFrame, elements: str = "elements") -> DataFrame:
    """Where a page repeats an id, keep the last listing. Elements without an id
    stay, they are told apart later.

    Works inside each page's row: positions sorted by (id, position), an entry
    stays if the next one has another id.
    """
    order = F.array_sort(F.transform(elements, lambda e: F.struct(e["id"].alias("id"), e["pos"].alias("pos"))))
    is_last = lambda entry, i: entry["id"].isNull() | ~F.get("_order", i + 1)["id"].eqNullSafe(entry["id"])
    return (
        extracted.withColumn("_order", order)
        .withColumn("_last", F.filter("_order", is_last))
        .withColumn(elements, F.transform("_last", lambda entry: F.get(elements, entry["pos"])))
        .drop("_order", "_last")
    )


def explode_listings(extracted: DataFrame, elements: str = "elements") -> DataFrame:
    """One row per listing: the page columns plus ``pos``, ``listing_id``, ``listing``."""
    keep = [c for c in extracted.columns if c not in (elements, "status")]
    # Outer explode plus a filter on its output: an inner explode makes the
    # optimizer test the array below the projection that parses it, and parse twice.
    rows = extracted.select(*keep, F.explode_outer(elements).alias("_e")).where(F.col("_e").isNotNull())
    return rows.select(
        *keep,
        F.col("_e.pos").alias("pos"),
        F.col("_e.id").alias("listing_id"),
        F.col("_e.item").alias("listing"),
    )


def split_by_id(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable listings, quarantine): a listing without ``@id`` cannot be keyed."""
    return listings.where(F.col("listing_id").isNotNull()), listings.where(F.col("listing_id").isNull())
