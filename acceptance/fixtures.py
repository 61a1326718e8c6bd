"""Inputs derived from the driver's tables by Spark."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.plans.bronze import with_partition
from hearthlake.plans.silver import silver_listings
from hearthlake.session import work_dir
from hearthlake.sources.pages import scan_raw_pages
from hearthlake.sources.tables import Lake

RUN_TS = "2026-01-01 00:00:00"
RUN_1, RUN_2, RUN_3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"
RUN_TS_VALUE = datetime(2026, 1, 1)
VERSION = "v0"

#: A page or snapshot draws its listings from one block of this many event ids, so
#: its size is bounded and the number of pages grows with the events, at every size.
BLOCK = 4096
ROWS_A_FILE = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, deal_by: tuple[str, ...] = ()) -> DataFrame:
    """Every event with its user's place, and the scalar parts of a listing. ``deal_by``: columns of the events (or ``block``) to shuffle them by before.

    Prices are coarse and a region has one street, so many listings of a day are the same
    home, on one site and on several, also with ties in run time.
    """
    events, customer, nation, region = (table(spark, sf_dir, t) for t in ("events", "customer", "nation", "region"))
    joined = (
        events.join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("block", F.expr(f"event_id div {BLOCK}"))
    )
    dealt = joined.repartition(*deal_by) if deal_by else joined
    return dealt.selectExpr(
        "event_id AS eid",
        "user_id AS uid",
        "CAST(ts AS timestamp) AS ts",
        "CAST(ts AS date) AS d",
        "event_type",
        "value",
        "props",
        "CASE WHEN event_id % 7 <> 0 THEN lower(c_mktsegment) || element_at(array('-', '/', ' ', '_'), CAST(event_id % 4 + 1 AS int)) || event_type END AS name",
        "CASE WHEN event_id % 50 <> 0 THEN 'https://example.com/l/' || user_id END AS url",
        "CASE WHEN event_id % 13 <> 0 THEN c_name END AS description",
        "CASE WHEN event_id % 3 <> 0 THEN event_id % 2 = 0 END AS pets",
        "CASE WHEN event_id % 17 <> 0 THEN event_id % 2 END AS rooms",
        "CASE WHEN event_id % 17 <> 0 THEN event_id % 2 END AS bedrooms",
        "CASE WHEN event_id % 17 <> 0 THEN event_id % 2 END AS bathrooms",
        "CASE WHEN event_id % 11 <> 0 THEN r_name END AS street",
        "n_name AS locality",
        "r_name AS region",
        "CAST(event_id % 5 + 0.5 AS double) AS size",
        "CASE WHEN event_id % 23 = 0 THEN 'FT' ELSE 'M2' END AS size_unit",
        "transform(slice(array(0, 1, 2), 1, CAST(event_id % 4 AS int)), i -> 'https://img/' || user_id || '/' || i) AS images",
        """slice(array(
             named_struct('NAME', CASE WHEN event_id % 31 <> 0 THEN event_type END, 'VALUE', props),
             named_struct('NAME', lower(c_mktsegment), 'VALUE', props)),
           1, CAST(event_id % 3 AS int)) AS amenities""",
        "CASE WHEN event_id % 41 <> 0 THEN CAST(floor(value / 25) * 25 + 25 AS double) END AS price",
        "CASE WHEN event_id % 37 = 0 THEN 'USD' ELSE 'BRL' END AS currency",
        "CASE WHEN event_id % 5 <> 0 THEN 'InStock' END AS availability",
        "'https://example.com/a/' || user_id AS target",
        "CASE WHEN event_id % 2 = 0 THEN 'Condominium Fee' ELSE 'Tax' END AS fee_name",
        "CAST(event_id % 100 AS double) AS fee",
        "element_at(array('BRL/month', 'BRL', '/year', '123', NULL), CAST(event_id % 5 + 1 AS int)) AS fee_unit",
        "element_at(array('zapimoveis', 'vivareal', 'other'), CAST(event_id % 3 + 1 AS int)) AS site",
        "lower(r_name) AS city",
        "CASE WHEN event_id % 2 = 0 THEN 'apartment' ELSE 'house' END AS property_type",
        "block",
        f"event_id div 6 % 10 + 1 + 10 * (event_id div {BLOCK}) AS page",
    ).withColumn(
        "blob",
        F.expr("concat_ws('/', 'dev', site, city, property_type, CAST(page AS string), d || 'T00:00:00Z.json')"),
    )


def one_per_user_and_day(raw: DataFrame) -> DataFrame:
    first = raw.groupBy("uid", "d").agg(F.min("eid").alias("eid")).select("eid")
    return raw.join(first, "eid", "left_semi")


def bronze(spark: SparkSession, sf_dir: str, unique: bool = False) -> DataFrame:
    """The nested bronze table. ``unique``: one row per listing and date."""
    raw = raw_events(spark, sf_dir)
    if unique:
        raw = one_per_user_and_day(raw)
    return raw.selectExpr(
        "CAST(eid AS string) AS ID",
        "CAST(uid AS string) AS LISTING_ID",
        "name AS LISTING_NAME",
        "url AS LISTING_URL",
        "description AS LISTING_DESCRIPTION",
        "pets AS LISTING_PETS_ALLOWED_FLAG",
        "rooms AS LISTING_NUMBER_OF_ROOMS_AMT",
        "bedrooms AS LISTING_NUMBER_OF_BEDROOMS_AMT",
        "bathrooms AS LISTING_NUMBER_OF_BATHROOMS_AMT",
        """CASE WHEN eid % 19 <> 0 THEN named_struct('STREET_ADDRESS', street, 'LOCALITY', locality,
             'REGION', region, 'COUNTRY', 'BR') END AS LISTING_ADDRESS_INFOS""",
        "CASE WHEN eid % 29 <> 0 THEN named_struct('VALUE', size, 'UNIT_CODE', size_unit) END AS LISTING_FLOOR_SIZE_INFOS",
        "images AS LISTING_IMAGES_LIST",
        "amenities AS LISTING_AMENITY_FEATURES_INFOS",
        """CASE WHEN eid % 43 <> 0 THEN named_struct('PRICE', price, 'PRICE_CURRENCY', currency,
             'AVAILABILITY', availability,
             'POTENTIAL_ACTION', CASE WHEN eid % 2 = 0 THEN named_struct('TARGET', target,
                'PRICE_SPECIFICATION', CASE WHEN eid % 4 <> 0
                   THEN named_struct('PRICE', value, 'PRICE_CURRENCY', 'BRL') END) END,
             'PROPERTY_VALUE', CASE WHEN eid % 47 <> 0
                THEN named_struct('NAME', fee_name, 'VALUE', fee, 'UNIT_TEXT', fee_unit) END)
           END AS LISTING_OFFERS_INFOS""",
        "blob AS SRC_BLOB",
        "site AS SRC_SITE_NAME",
        "city AS SRC_CITY_NAME",
        "property_type AS SRC_PROPERTY_TYPE_CAT",
        "page AS SRC_PAGE_NUM",
        "ts AS SRC_EXECUTED_AT_TS",
        f"'{VERSION}' AS AUD_VERSION_ID",
        f"timestamp'{RUN_TS}' AS AUD_INS_TS",
        f"timestamp'{RUN_TS}' AS AUD_UPD_TS",
    ).select(*S.BRONZE.fieldNames())


_STORED: dict[tuple, Lake] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build, spec_cluster: tuple[str, ...], partition: str) -> DataFrame:
    """A layer table as the pipeline stores it, written once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        lake = Lake(spark, work_dir(spark, name), "dev")
        lake.overwrite_partitions(build(), name, partition, spec_cluster)
        _STORED[key] = lake
    return _STORED[key].read(name)


def _published(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The same for a table without a date partition."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        lake = Lake(spark, work_dir(spark, name), "dev")
        # Enough files for every core, however small the table is.
        lake.publish(build(), name, rows_a_file=ROWS_A_FILE)
        _STORED[key] = lake
    return _STORED[key].current(name)


def lake_of(spark: SparkSession, sf_dir: str, name: str, build) -> Lake:
    """A lake that ``build`` has filled, once per session and scale; cases only read it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        lake = Lake(spark, work_dir(spark, name), "dev")
        build(lake)
        _STORED[key] = lake
    return _STORED[key]


def stored_bronze(spark: SparkSession, sf_dir: str, unique: bool = False) -> DataFrame:
    build = lambda: with_partition(bronze(spark, sf_dir, unique))
    cluster = ("SRC_SITE_NAME", "SRC_CITY_NAME", "SRC_PROPERTY_TYPE_CAT", "SRC_PAGE_NUM")
    return _stored(spark, sf_dir, f"bronze{'_unique' * unique}", build, cluster, S.BRONZE_PARTITION)


def silver(spark: SparkSession, sf_dir: str, unique: bool = False) -> DataFrame:
    build = lambda: silver_listings(bronze(spark, sf_dir, unique), RUN_TS)
    return _stored(spark, sf_dir, f"silver{'_unique' * unique}", build, S.SILVER.cluster, "SCRAPE_DATE")


def day(silver_rows: DataFrame, back: int):
    """The last date but ``back``, as a scalar subquery over the distinct dates."""
    dates = silver_rows.select("SCRAPE_DATE").distinct().orderBy(F.desc("SCRAPE_DATE")).limit(back + 1)
    return dates.agg(F.min("SCRAPE_DATE")).scalar()


def up_to(silver_rows: DataFrame, back: int) -> DataFrame:
    return silver_rows.where(F.col("SCRAPE_DATE") <= day(silver_rows, back)) if back else silver_rows


# -- raw JSON ----------------------------------------------------------------
# Numbers come as 2.0, "2" and 2 on purpose; an address is absent or {} when unknown.
ITEM = """named_struct(
  '@id', {id}, '@type', 'Apartment', 'name', name, 'url', url, 'description', description,
  'petsAllowed', pets, 'numberOfRooms', CAST(rooms AS double), 'numberOfBedrooms', CAST(bedrooms AS string),
  'numberOfBathroomsTotal', bathrooms,
  'address', CASE WHEN eid % 38 = 0 THEN named_struct('streetAddress', CAST(NULL AS string),
       'addressLocality', CAST(NULL AS string), 'addressRegion', CAST(NULL AS string), 'addressCountry', CAST(NULL AS string))
     WHEN eid % 19 <> 0 THEN named_struct('streetAddress', street, 'addressLocality', locality,
       'addressRegion', region, 'addressCountry', 'BR') END,
  'floorSize', CASE WHEN eid % 29 <> 0 THEN named_struct('value', CAST(size AS string), 'unitCode', size_unit) END,
  'image', CASE WHEN size(images) > 0 THEN images END,
  'amenityFeature', CASE WHEN size(amenities) > 0
     THEN transform(amenities, a -> named_struct('@type', 'Feature', 'name', a.NAME, 'value', a.VALUE)) END,
  'offers', CASE WHEN eid % 43 <> 0 THEN named_struct('price', price, 'priceCurrency', currency,
     'availability', availability,
     'potentialAction', CASE WHEN eid % 2 = 0 THEN named_struct('target', target, 'priceSpecification',
        CASE WHEN eid % 4 <> 0 THEN named_struct('price', value, 'priceCurrency', 'BRL') END) END,
     'propertyValue', CASE WHEN eid % 47 <> 0
        THEN named_struct('name', fee_name, 'value', CAST(fee AS bigint), 'unitText', fee_unit) END) END)"""


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "raw_listings", lambda: build_raw_listings(spark, sf_dir))


def build_raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw listing (VARIANT) per event, with the path columns of its snapshot."""
    item = ITEM.format(id="CAST(eid AS string)")
    return raw_events(spark, sf_dir).selectExpr(
        "eid",
        "CAST(eid AS string) AS listing_key",
        f"parse_json(to_json({item})) AS listing",
        "blob",
        "site",
        "city",
        "property_type",
        "page",
        "ts AS executed_at",
    )


def snapshot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "snapshots", lambda: build_snapshot_payloads(spark, sf_dir))


def build_snapshot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the snapshot table: the events of one search page and date as one
    JSON object (some of one block)."""
    item = ITEM.format(id="CAST(eid AS string)")
    keyed = raw_events(spark, sf_dir).selectExpr(
        "d AS file_date", "site", "city", "property_type", "page", "blob",
        f"'\"' || eid || '\":' || to_json({item}) AS entry",
    )
    return keyed.groupBy("file_date", "site", "city", "property_type", "page", "blob").agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list("entry"), ","), F.lit("}")).alias("payload")
    )


def listing_pages(spark: SparkSession, sf_dir: str, repeat_ids: bool = False) -> DataFrame:
    """Landed pages. Their item lists are stored once per session and scale; the HTML, which every
    block of a page has a copy of, is neither stored nor shuffled with its copies."""
    name = f"item_lists{'_repeated' * repeat_ids}"
    lists = _published(spark, sf_dir, name, lambda: build_item_lists(spark, sf_dir, repeat_ids))
    return splice_lists(scan_raw_pages(spark, f"{sf_dir}/pages.parquet"), lists)


def build_item_lists(spark: SparkSession, sf_dir: str, repeat_ids: bool) -> DataFrame:
    """The events of each user and block of event ids as one JSON-LD item list.

    The events are dealt out while they are narrow: files hold many of them, and a task
    that makes listings of a whole file's events holds more than its memory.
    """
    item = ITEM.format(id="concat(uid, '-', eid % 7)" if repeat_ids else "CAST(eid AS string)")
    entry = """'{"@type":"ListItem","position":' || (i + 1) || ',"item":' || e.item || '}'"""
    return (
        raw_events(spark, sf_dir, deal_by=("user_id", "block"))
        .selectExpr("uid", "block", f"named_struct('eid', eid, 'item', to_json({item})) AS e")
        .groupBy("uid", "block")
        .agg(F.array_sort(F.collect_list("e")).alias("es"))
        .selectExpr(
            "uid",
            "block",
            f"""'{{"@context":"https://schema.org","@type":"ItemList","itemListElement":['
               || array_join(transform(es, (e, i) -> {entry}), ',') || ']}}' AS list""",
        )
    )


def splice_lists(pages: DataFrame, lists: DataFrame) -> DataFrame:
    """Landed pages with JSON-LD spliced in: page ``n`` lists the events of user
    ``n``, one landed page per block of event ids.

    Every page also holds a commented-out broken block, an empty block and a
    foreign script, none of which may count. Every seventh page has a broken
    block; pages without events have no item list.
    """
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    web_page = F.lit('{"@type": "WebPage"}')
    second = F.when(F.col("page_id") % 7 == 0, F.lit("{not valid json}")).otherwise(F.coalesce("list", web_page))
    noise = F.lit('<!-- <script type="application/ld+json">{off</script> --><script>var c = "<!--";</script>')
    spliced = F.concat(noise, block(F.lit("")), block(web_page), block(second), F.lit("<body>"))
    number = "page_id div 12 + 1"
    url = f"""CASE page_id % 4
        WHEN 0 THEN 'https://www.vivareal.com.br/aluguel/rj/' || city || '/apartamento_residencial/?pagina=' || ({number})
        WHEN 1 THEN 'https://www.vivareal.com.br/aluguel/rj/' || city || '/casa_residencial/?pagina=' || ({number})
        WHEN 2 THEN 'https://www.zapimoveis.com.br/aluguel/apartamentos/rj+' || city || '/?pagina=' || ({number})
        ELSE 'https://www.zapimoveis.com.br/aluguel/casas/rj+' || city || '/?pagina=' || ({number}) END"""
    return (
        pages.repartition("page_id").join(lists, F.col("page_id") == F.col("uid"), "left")
        .withColumn("block", F.coalesce("block", F.lit(0)))
        .withColumn("city", F.expr("element_at(array('macae', 'niteroi', 'campos'), CAST(page_id % 3 + 1 AS int)) || '-' || block"))
        .select("page_id", "block", F.expr(url).alias("url"), F.replace("html", F.lit("<body>"), spliced).alias("html"))
    )


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file listing, stored once per session and scale."""
    return _published(spark, sf_dir, "snapshot_files", lambda: build_snapshot_files(spark, sf_dir))


def build_snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: two snapshots per search page and date. The one named later
    was modified earlier. One site lacks page 6."""
    seen = (
        raw_events(spark, sf_dir)
        .where("NOT (site = 'vivareal' AND page = 6)")
        .groupBy("site", "property_type", "page", F.col("d").alias("file_date"))
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )
    return seen.selectExpr(
        "site",
        "'macae' AS city",
        "property_type",
        "page",
        "file_date",
        "inline(array(named_struct('hour', '00', 'modified_ts', last_ts), named_struct('hour', '12', 'modified_ts', first_ts)))",
    ).selectExpr(
        "concat_ws('/', 'dev', site, city, property_type, CAST(page AS string), file_date || 'T' || hour || ':00:00Z.json') AS blob",
        "site", "city", "property_type", "page", "file_date", "modified_ts",
    )


#: Landed files have colons in their names, which the local checksum file system does not take.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_LANDED: dict[tuple, str] = {}


def landed_files(spark: SparkSession, sf_dir: str) -> str:
    """Root of all snapshots as JSON files, as scrapers land them; written by the tasks."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        root = work_dir(spark, "landed").removeprefix("file://")

        def land(frames):
            for frame in frames:
                for blob, payload in zip(frame["blob"], frame["payload"], strict=True):
                    path = f"{root}/{blob}"
                    try:
                        file = open(path, "w", encoding="utf-8")
                    except FileNotFoundError:  # the first of its folder
                        os.makedirs(os.path.dirname(path), exist_ok=True)
                        file = open(path, "w", encoding="utf-8")
                    with file:
                        file.write(payload)
                yield frame[["blob"]]

        # A snapshot without a run time has no file name; it lands under one that is no run time.
        named = F.when(F.col("file_date").isNull(), F.concat("blob", F.lit("/undated.json"))).otherwise(F.col("blob"))
        snapshot_payloads(spark, sf_dir).select(named.alias("blob"), "payload").mapInPandas(land, "blob string").count()
        _LANDED[key] = root
    return _LANDED[key]
