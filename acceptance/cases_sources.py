"""Scans, page extraction, snapshot choice, bronze load."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance import fixtures as X
from acceptance import sql as Q
from acceptance.registry import case
from hearthlake import schemas as S
from hearthlake.operators import extract as E
from hearthlake.operators import paging as P
from hearthlake.params import RunParams
from hearthlake.plans import bronze as B
from hearthlake.plans import dimensions as D
from hearthlake.plans import pipeline as L
from hearthlake.plans.pipeline import load_bronze
from hearthlake.session import Staging, work_dir
from hearthlake.sources import snapshots as N
from hearthlake.sources.pages import scan_raw_pages, url_lineage
from hearthlake.sources.tables import BrokenConstraintError, Lake, count_tables, ensure_table

# ---------------------------------------------------------------------------
# scans


@case("scan_raw_pages", "SELECT page_id, url, md5(html) AS html_md5 FROM pages")
def _(spark, sf):
    return scan_raw_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.md5("html").alias("html_md5"))


def _snapshot_table(spark, sf):
    root = work_dir(spark, "snapshots")
    N.write_snapshots(X.snapshot_payloads(spark, sf), root)
    return N.scan_snapshot_table(spark, root)


_BLOB_ROWS = """
SELECT blob, site, city, kind AS property_type, page, CAST(d AS VARCHAR) AS file_date, count(*) AS listings
FROM bronze GROUP BY ALL
"""


@case("scan_snapshot_table", Q.query(_BLOB_ROWS, "bronze"))
def _(spark, sf):
    listings = N.parse_snapshot_json(_snapshot_table(spark, sf))
    return listings.groupBy("blob", "site", "city", "property_type", "page", "file_date").agg(
        F.count("*").alias("listings")
    )


@case("scan_snapshots", Q.query(_BLOB_ROWS, "bronze"))
def _(spark, sf):
    # Landed files of all dates.
    listings = N.parse_snapshot_json(N.scan_snapshots(spark, X.landed_files(spark, sf), options=X.PLAIN_FILES))
    return listings.groupBy("blob", "site", "city", "property_type", "page", "file_date").agg(
        F.count("*").alias("listings")
    )


@case(
    "parse_snapshot_json",
    Q.query("SELECT blob, id AS listing_key, id AS listing_id, name, price FROM bronze", "bronze"),
)
def _(spark, sf):
    rows = N.parse_snapshot_json(X.snapshot_payloads(spark, sf))
    read = B.listing_columns()
    return B.read_listing(rows).select(
        "blob",
        "listing_key",
        read["LISTING_ID"].alias("listing_id"),
        read["LISTING_NAME"].alias("name"),
        read["LISTING_OFFERS_INFOS"]["PRICE"].alias("price"),
    )


@case(
    "path_lineage",
    Q.query(
        """
SELECT DISTINCT blob, 'dev' AS environment, site, city, kind AS property_type, page,
  CAST(d AS VARCHAR) || ' 00:00:00.000000' AS executed_at, CAST(d AS VARCHAR) AS file_date
FROM bronze""",
        "bronze",
    ),
)
def _(spark, sf):
    return N.path_lineage(X.raw_events(spark, sf).select("blob").distinct())


def _bronze_leaves(bronze):
    offers = "LISTING_OFFERS_INFOS"
    return bronze.select(
        F.col("ID").alias("id"),
        F.col("LISTING_ID").alias("listing_id"),
        F.col("LISTING_NAME").alias("name"),
        F.col("LISTING_URL").alias("url"),
        F.col("LISTING_DESCRIPTION").alias("description"),
        F.col("LISTING_PETS_ALLOWED_FLAG").cast("string").alias("pets"),
        F.col("LISTING_NUMBER_OF_ROOMS_AMT").cast("string").alias("rooms"),
        F.col("LISTING_NUMBER_OF_BEDROOMS_AMT").cast("string").alias("bedrooms"),
        F.col("LISTING_NUMBER_OF_BATHROOMS_AMT").cast("string").alias("bathrooms"),
        F.col("LISTING_ADDRESS_INFOS").isNull().alias("no_address"),
        F.col("LISTING_ADDRESS_INFOS.STREET_ADDRESS").alias("street"),
        F.col("LISTING_ADDRESS_INFOS.LOCALITY").alias("locality"),
        F.col("LISTING_ADDRESS_INFOS.REGION").alias("region"),
        F.col("LISTING_ADDRESS_INFOS.COUNTRY").alias("country"),
        F.col("LISTING_FLOOR_SIZE_INFOS").isNull().alias("no_size"),
        F.col("LISTING_FLOOR_SIZE_INFOS.VALUE").alias("size"),
        F.col("LISTING_FLOOR_SIZE_INFOS.UNIT_CODE").alias("size_unit"),
        F.col("LISTING_IMAGES_LIST").alias("images"),
        F.col("LISTING_AMENITY_FEATURES_INFOS").alias("amenities"),
        F.col(offers).isNull().alias("no_offers"),
        F.col(f"{offers}.PRICE").alias("price"),
        F.col(f"{offers}.PRICE_CURRENCY").alias("currency"),
        F.col(f"{offers}.AVAILABILITY").alias("availability"),
        F.col(f"{offers}.POTENTIAL_ACTION.TARGET").alias("target"),
        F.col(f"{offers}.POTENTIAL_ACTION.PRICE_SPECIFICATION").isNull().alias("no_spec"),
        F.col(f"{offers}.POTENTIAL_ACTION.PRICE_SPECIFICATION.PRICE").alias("spec_price"),
        F.col(f"{offers}.PROPERTY_VALUE.NAME").alias("fee_name"),
        F.col(f"{offers}.PROPERTY_VALUE.VALUE").alias("fee"),
        F.col(f"{offers}.PROPERTY_VALUE.UNIT_TEXT").alias("fee_unit"),
        F.col("SRC_BLOB").alias("blob"),
        F.col("SRC_SITE_NAME").alias("site"),
        F.col("SRC_CITY_NAME").alias("city"),
        F.col("SRC_PROPERTY_TYPE_CAT").alias("property_type"),
        F.col("SRC_PAGE_NUM").alias("page"),
        F.col("SRC_EXECUTED_AT_TS").alias("executed_at"),
        F.col("AUD_VERSION_ID").alias("version"),
        F.col("AUD_INS_TS").alias("ins_ts"),
        F.col("AUD_UPD_TS").alias("upd_ts"),
    )


def _amenities_text(features: str = "") -> str:
    p = f"{features}." if features else ""
    first = f"coalesce({p}amenity_1, '~') || '=' || {p}props"
    second = f"coalesce({p}amenity_2, '~') || '=' || {p}props"
    return f"CASE {p}n_amenities WHEN 0 THEN '' WHEN 1 THEN {first} ELSE {first} || ';' || {second} END"


def _bronze_sql(row_id: str, source: str = "bronze") -> str:
    return Q.query(
        f"""
SELECT {row_id} AS id, {{listing_id}} AS listing_id, name, url, description,
  CAST(pets AS VARCHAR) AS pets, CAST(rooms AS VARCHAR) AS rooms, CAST(bedrooms AS VARCHAR) AS bedrooms,
  CAST(bathrooms AS VARCHAR) AS bathrooms, eid % 19 = 0 AS no_address, street, locality, region, country,
  eid % 29 = 0 AS no_size, size, size_unit, CAST(to_json(images) AS VARCHAR) AS images,
  {_amenities_text()} AS amenities,
  eid % 43 = 0 AS no_offers, price, currency, availability, target, spec_price IS NULL AS no_spec, spec_price,
  fee_name, fee, fee_unit, blob, site, city, kind AS property_type, page, {Q.ts('ts')} AS executed_at,
  'v0' AS version, {Q.at(Q.RUN_1)} AS ins_ts, {Q.at(Q.RUN_1)} AS upd_ts
FROM {source}""",
        source,
    )


_AS_STORED = _bronze_sql("id").replace("{listing_id}", "listing_id")
# A raw listing is keyed by its event, and its row id by path and key.
_FROM_JSON = _bronze_sql("md5(blob || '||' || id)").replace("{listing_id}", "id")


def _stored_bronze(spark, sf):
    lake = Lake(spark, work_dir(spark, "bronze"), "dev")
    lake.append(
        B.with_partition(X.bronze(spark, sf)), "bronze_listings", S.BRONZE_PARTITION, ["SRC_SITE_NAME", "SRC_CITY_NAME"]
    )
    return lake.read("bronze_listings")


@case("scan_bronze", _AS_STORED)
def _(spark, sf):
    return _bronze_leaves(_stored_bronze(spark, sf))


@case(
    "scan_silver",
    Q.query("SELECT bronze_id, listing_id, CAST(d AS VARCHAR) AS scrape_date, price FROM silver", "silver"),
)
def _(spark, sf):
    lake = Lake(spark, work_dir(spark, "silver"), "dev")
    lake.overwrite_partitions(X.silver(spark, sf), S.SILVER.name, "SCRAPE_DATE", S.SILVER.cluster)
    return lake.read(S.SILVER.name).selectExpr(
        "BRONZE_ID AS bronze_id", "LISTING_ID AS listing_id", "SCRAPE_DATE AS scrape_date", "PRICE AS price"
    )


@case(
    "scan_self",
    Q.query("SELECT listing_id, max_by(listing_name, d) AS name FROM silver_u GROUP BY listing_id", "silver_u"),
)
def _(spark, sf):
    lake = Lake(spark, work_dir(spark, "self"), "dev")
    silver = X.silver(spark, sf, unique=True)
    for history in (X.up_to(silver, 1), silver):
        lake.publish(D.LISTINGS.full(history, X.RUN_1), "dim")
    return lake.current("dim").selectExpr("LISTING_ID AS listing_id", "LISTING_NAME AS name")


# ---------------------------------------------------------------------------
# page extraction

# A landed page: the events of one user out of one block of ids, or a page without events.
Q.part(
    "landed",
    """
SELECT p.page_id, coalesce(l.block, 0) AS block, l.n, p.page_id % 7 = 0 AS broken
FROM pages p LEFT JOIN (SELECT uid, block, count(*) AS n FROM bronze GROUP BY uid, block) l ON l.uid = p.page_id
""",
    "bronze",
)
Q.part(
    "listed",
    """
SELECT b.*, b.uid AS page_id, row_number() OVER (PARTITION BY b.uid, b.block ORDER BY b.eid) - 1 AS pos
FROM bronze b SEMI JOIN pages p ON p.page_id = b.uid WHERE b.uid % 7 <> 0
""",
    "bronze",
)


@case(
    "extract_jsonld_blocks",
    Q.query(
        """
SELECT page_id, block, CAST(0 AS BIGINT) AS pos, 'WebPage' AS kind FROM landed
UNION ALL
SELECT page_id, block, CAST(1 AS BIGINT), CASE WHEN NOT broken THEN CASE WHEN n > 0 THEN 'ItemList' ELSE 'WebPage' END END
FROM landed""",
        "landed",
    ),
)
def _(spark, sf):
    pages = E.parsed_blocks(X.listing_pages(spark, sf), "blocks")
    # Outer, and without the rows of pages that have no block: an inner one tests the array below.
    bodies = pages.select("page_id", "block", F.posexplode_outer("blocks").alias("pos", "body")).where("pos IS NOT NULL")
    return bodies.select("page_id", "block", "pos", F.try_variant_get("body", '$["@type"]', "string").alias("kind"))


@case(
    "select_item_list",
    Q.query("SELECT page_id, block, n AS elements FROM landed WHERE n > 0 AND NOT broken", "landed"),
)
def _(spark, sf):
    pages = E.extract_pages(X.listing_pages(spark, sf))
    # As a generator's output: a filter on a plain column is put below it, and counts once more.
    return pages.select("page_id", "block", F.explode_outer(F.array(F.size("elements"))).alias("elements")).where("elements >= 0")


@case("explode_listings", Q.query("SELECT page_id, block, pos, id AS listing_id, name FROM listed", "listed"))
def _(spark, sf):
    rows = E.explode_listings(E.extract_pages(X.listing_pages(spark, sf)))
    name = F.try_variant_get("listing", "$.name", "string").alias("name")
    return rows.select("page_id", "block", "pos", "listing_id", name)


@case(
    "dedup_last_id_in_page",
    Q.query(
        """
SELECT page_id, block, listing_id, max(pos) AS pos, max_by(name, pos) AS name
FROM (SELECT page_id, block, uid || '-' || eid % 7 AS listing_id, coalesce(name, '~') AS name, pos FROM listed)
GROUP BY page_id, block, listing_id""",
        "listed",
    ),
)
def _(spark, sf):
    pages = E.keep_last_per_id(E.extract_pages(X.listing_pages(spark, sf, repeat_ids=True)))
    name = F.coalesce(F.try_variant_get("listing", "$.name", "string"), F.lit("~"))
    return E.explode_listings(pages).select("page_id", "block", "listing_id", "pos", name.alias("name"))


_STATUS = "CASE WHEN broken THEN 'malformed_json' WHEN n > 0 THEN 'ok' ELSE 'no_item_list' END"


@case("page_status", Q.query(f"SELECT page_id, block, {_STATUS} AS status FROM landed", "landed"))
def _(spark, sf):
    return E.extract_pages(X.listing_pages(spark, sf)).select("page_id", "block", "status")


Q.part(
    "searched",
    f"""
SELECT page_id, block, page_id // 12 + 1 AS page, {_STATUS} AS status,
  CASE WHEN page_id % 4 < 2 THEN 'vivareal' ELSE 'zapimoveis' END AS site,
  CASE page_id % 3 WHEN 0 THEN 'macae' WHEN 1 THEN 'niteroi' ELSE 'campos' END || '-' || block AS city,
  CASE WHEN page_id % 2 = 0 THEN 'apartment' ELSE 'house' END AS property_type
FROM landed
""",
    "landed",
)
Q.part(
    "kept_pages",
    """
SELECT * FROM searched s WHERE status = 'ok' AND page = (
  SELECT count(*) FROM searched e
  WHERE e.page_id % 12 = s.page_id % 12 AND e.block = s.block AND e.page <= s.page AND e.status = 'ok')
""",
    "searched",
)


@case(
    "stop_at_first_empty_page",
    Q.query("SELECT page_id, site, city, property_type, page FROM kept_pages", "kept_pages"),
)
def _(spark, sf):
    # The extraction is kept, as in the pipeline: the rule reads it twice.
    pages = Staging.lasting(spark).keep(url_lineage(E.extract_pages(X.listing_pages(spark, sf))), "extracted")
    return P.stop_at_first_empty_page(pages).select("page_id", "site", "city", "property_type", "page")


@case(
    "url_lineage",
    Q.query("SELECT page_id, site, 'rj' AS state, city, property_type, page FROM searched", "searched"),
)
def _(spark, sf):
    return url_lineage(X.listing_pages(spark, sf)).select("page_id", "site", "state", "city", "property_type", "page")


_SNAPSHOTS_SQL = """
SELECT 'dev/' || k.site || '/' || k.city || '/' || k.property_type || '/' || k.page || '/2026-01-01T00:00:00Z.json' AS blob,
  '2026-01-01' AS file_date, b.id AS listing_id, b.description
FROM kept_pages k JOIN bronze b ON b.uid = k.page_id AND b.block = k.block"""


def _extracted(spark, sf):
    pages = url_lineage(E.keep_last_per_id(E.extract_pages(X.listing_pages(spark, sf))))
    return P.stop_at_first_empty_page(Staging.lasting(spark).keep(pages, "extracted"))


def _written(spark, sf, times):
    root = work_dir(spark, "snapshots")
    for _ in range(times):
        N.write_snapshots(N.snapshot_rows(_extracted(spark, sf), "dev", X.RUN_TS), root)
    rows = N.parse_snapshot_json(N.scan_snapshot_table(spark, root, "2026-01-01"))
    description = F.try_variant_get("listing", "$.description", "string")
    return rows.select("blob", "file_date", F.col("listing_key").alias("listing_id"), description.alias("description"))


@case("write_snapshots", Q.query(_SNAPSHOTS_SQL, "kept_pages"))
def _(spark, sf):
    return _written(spark, sf, 1)


@case("write_snapshots_retry", Q.query(_SNAPSHOTS_SQL, "kept_pages"))
def _(spark, sf):
    # The same run lands twice; each snapshot is there once.
    return _written(spark, sf, 2)


@case(
    "quarantine_listings",
    Q.query(
        """
SELECT 'dev/' || k.site || '/' || k.city || '/' || k.property_type || '/' || k.page || '/2026-01-01T00:00:00Z.json' AS blob,
  count(*) FILTER (l.pos % 4 <> 3) AS kept, count(*) FILTER (l.pos % 4 = 3) AS lost
FROM kept_pages k JOIN listed l ON l.page_id = k.page_id AND l.block = k.block GROUP BY ALL""",
        "kept_pages", "listed",
    ),
)
def _(spark, sf):
    # Every fourth listing of a page loses its id: it is in the quarantine, the others in the snapshot.
    drop = lambda e: F.struct(e["pos"].alias("pos"), F.when(e["pos"] % 4 != 3, e["id"]).alias("id"), e["item"].alias("item"))
    pages = Staging.lasting(spark).keep(_extracted(spark, sf).withColumn("elements", F.transform("elements", drop)), "without_ids")
    root = work_dir(spark, "snapshots")
    N.write_snapshots(N.snapshot_rows(pages, "dev", X.RUN_TS), root)
    N.write_quarantine(N.listings_without_id(pages, "dev", X.RUN_TS), root)
    kept = N.parse_snapshot_json(N.scan_snapshot_table(spark, root)).select("blob", F.lit(1).alias("kept"), F.lit(0).alias("lost"))
    lost = N.scan_quarantine(spark, root).select("blob", F.lit(0).alias("kept"), F.lit(1).alias("lost"))
    return kept.unionAll(lost).groupBy("blob").agg(F.sum("kept").alias("kept"), F.sum("lost").alias("lost"))


@case(
    "quarantine_snapshots",
    Q.query(
        """
SELECT blob, CASE WHEN page % 5 = 0 THEN 0 ELSE count(*) END AS loaded, CASE WHEN page % 5 = 0 THEN 1 ELSE 0 END AS unreadable
FROM bronze GROUP BY blob, page""",
        "bronze",
    ),
)
def _(spark, sf):
    # Every fifth page's snapshot is cut off: one unreadable entry instead of its listings.
    rows = X.snapshot_payloads(spark, sf).select("blob", "payload").withColumn("modified_ts", F.lit(X.RUN_TS).cast("timestamp"))
    cut = F.when(F.col("page") % 5 == 0, F.expr("left(payload, length(payload) - 1)")).otherwise(F.col("payload"))
    snapshots = N.path_lineage(rows).withColumn("payload", cut)
    every = B.raw_bronze_rows(snapshots, snapshots.select("blob"), X.RUN_TS, X.VERSION)
    return every.groupBy(F.col("SRC_BLOB").alias("blob")).agg(
        F.count_if(F.col(B.REASON).isNull()).alias("loaded"),
        F.count_if(F.col(B.REASON) == B.UNREADABLE).alias("unreadable"),
    )


# ---------------------------------------------------------------------------
# snapshot choice

Q.part(
    "files",
    """
SELECT site, kind AS property_type, page, d AS file_date, hour, modified_ts,
  'dev/' || site || '/macae/' || kind || '/' || page || '/' || d || 'T' || hour || ':00:00Z.json' AS blob
FROM (
  SELECT site, kind, page, d, '00' AS hour, max(ts) AS modified_ts FROM bronze GROUP BY site, kind, page, d
  UNION ALL
  SELECT site, kind, page, d, '12' AS hour, min(ts) AS modified_ts FROM bronze GROUP BY site, kind, page, d)
WHERE NOT (site = 'vivareal' AND page = 6)
""",
    "bronze",
)
Q.part(
    "newest_files",
    """
SELECT site, property_type, page, file_date, arg_max(blob, {'m': modified_ts, 'b': blob}) AS blob
FROM files GROUP BY site, property_type, page, file_date
""",
    "files",
)
Q.part(
    "unbroken_files",
    """
SELECT * FROM newest_files f WHERE page = (
  SELECT count(*) FROM newest_files g
  WHERE g.site = f.site AND g.property_type = f.property_type AND g.file_date = f.file_date AND g.page <= f.page)
""",
    "newest_files",
)
_FILE = "blob, site, property_type, page, CAST(file_date AS VARCHAR) AS file_date"
_FILE_COLUMNS = ["blob", "site", "property_type", "page", "file_date"]


@case("latest_snapshot", Q.query(f"SELECT {_FILE} FROM newest_files", "newest_files"))
def _(spark, sf):
    return P.latest_snapshot(X.snapshot_files(spark, sf)).select(*_FILE_COLUMNS)


@case("page_bounds", Q.query(f"SELECT {_FILE} FROM files WHERE page >= 2 AND page <= 5", "files"))
def _(spark, sf):
    return P.page_bounds(X.snapshot_files(spark, sf), 2, 5).select(*_FILE_COLUMNS)


@case("contiguous_pages", Q.query(f"SELECT {_FILE} FROM unbroken_files", "unbroken_files"))
def _(spark, sf):
    return P.contiguous_pages(P.latest_snapshot(X.snapshot_files(spark, sf))).select(*_FILE_COLUMNS)


def _loads(spark, sf):
    """A lake whose ledger has the snapshots of every third page."""

    def build(lake):
        third = P.latest_snapshot(X.snapshot_files(spark, sf)).where("page % 3 = 0")
        entries = third.select("blob", F.col("file_date").alias(S.BRONZE_PARTITION), F.lit(1).cast("bigint").alias("listings"))
        write = lake.write_aside(entries, L.BRONZE_TABLE, S.BRONZE_PARTITION, ("blob",))
        lake.add(L.BRONZE_TABLE, {L.LOADS: (write, write, S.BRONZE_PARTITION, entries.schema)})

    return X.lake_of(spark, sf, "loads", build)


@case("skip_loaded", Q.query(f"SELECT {_FILE} FROM unbroken_files WHERE page % 3 <> 0", "unbroken_files"))
def _(spark, sf):
    # What the bronze job chooses; the ledger says what is loaded.
    files = X.snapshot_files(spark, sf)
    params = RunParams("dev", "macae", "vivareal", "apartment", run_ts=X.RUN_TS_VALUE)
    chosen = L.chosen_snapshots(_loads(spark, sf), files, params)
    return files.join(chosen, "blob", "left_semi").select(*_FILE_COLUMNS)


@case(
    "distinct_blobs",
    Q.query("SELECT DISTINCT blob FROM bronze WHERE d = (SELECT min(d) FROM bronze)", "bronze"),
)
def _(spark, sf):
    bronze = X.stored_bronze(spark, sf)
    return P.loaded_blobs(bronze, bronze.agg(F.min(S.BRONZE_PARTITION)).scalar())


@case(
    "max_latest",
    Q.query(f"SELECT site, page, {Q.ts('max(modified_ts)')} AS modified_ts FROM files GROUP BY site, page", "files"),
)
def _(spark, sf):
    newest = P.latest_snapshot(X.snapshot_files(spark, sf), keys=("site", "page"))
    return newest.select("site", "page", "modified_ts")


# ---------------------------------------------------------------------------
# bronze rows


@case("flatten_listing", _FROM_JSON)
def _(spark, sf):
    return _bronze_leaves(B.flatten_listings(X.raw_listings(spark, sf), X.RUN_TS, X.VERSION))


@case(
    "null_empty_struct",
    Q.query(
        """
SELECT id, eid % 4 IN (0, 1, 2) AS no_address, CASE WHEN eid % 4 = 3 THEN n_name END AS locality,
  eid % 4 <> 2 AS no_fee FROM bronze""",
        "bronze",
    ),
)
def _(spark, sf):
    # Absent, JSON null and {} give NULL; an object of unknown members gives a struct.
    raw = X.raw_events(spark, sf).selectExpr(
        "CAST(eid AS string) AS id",
        """parse_json(element_at(array('{}', '{"address": null}',
             '{"address": {}, "offers": {"propertyValue": {"@type": "P"}}}',
             '{"address": {"addressLocality": "' || locality || '"}}'), CAST(eid % 4 + 1 AS int))) AS listing""",
    )
    read = B.listing_columns()
    return B.read_listing(raw).select(
        "id",
        read["LISTING_ADDRESS_INFOS"].isNull().alias("no_address"),
        read["LISTING_ADDRESS_INFOS"]["LOCALITY"].alias("locality"),
        read["LISTING_OFFERS_INFOS"]["PROPERTY_VALUE"].isNull().alias("no_fee"),
    )


@case(
    "empty_array_default",
    Q.query(
        "SELECT id, CAST(to_json(images) AS VARCHAR) AS images, n_amenities AS amenities FROM bronze", "bronze"
    ),
)
def _(spark, sf):
    read = B.listing_columns()
    return B.read_listing(X.raw_listings(spark, sf)).select(
        F.col("listing_key").alias("id"),
        read["LISTING_IMAGES_LIST"].alias("images"),
        F.size(read["LISTING_AMENITY_FEATURES_INFOS"]).alias("amenities"),
    )


@case(
    "rename_struct_array",
    Q.query(
        f"SELECT id, {_amenities_text()} AS amenities FROM bronze WHERE n_amenities > 0", "bronze"
    ),
)
def _(spark, sf):
    renamed = B.renamed_features().alias("amenities")
    return B.read_listing(X.raw_listings(spark, sf)).select(F.col("listing_key").alias("id"), renamed).where("amenities IS NOT NULL")


@case("bronze_row_id", Q.query("SELECT id AS listing_key, md5(blob || '||' || id) AS id FROM bronze", "bronze"))
def _(spark, sf):
    rows = X.raw_events(spark, sf).selectExpr("blob", "CAST(eid AS string) AS listing_key")
    return rows.select("listing_key", B.bronze_row_id(F.col("blob"), F.col("listing_key")).alias("id"))


@case(
    "audit_columns",
    Q.query(
        f"SELECT id, 'v0' AS AUD_VERSION_ID, {Q.at(Q.RUN_1)} AS AUD_INS_TS, {Q.at(Q.RUN_1)} AS AUD_UPD_TS FROM bronze",
        "bronze",
    ),
)
def _(spark, sf):
    return X.raw_events(spark, sf).select(F.col("eid").cast("string").alias("id"), *B.audit_columns(X.RUN_TS, X.VERSION))


@case(
    "append_bronze",
    Q.query(
        """
SELECT CAST(d AS VARCHAR) AS load_date, count(*) AS n, count(DISTINCT id) AS ids, min(id) AS first_id
FROM bronze GROUP BY d""",
        "bronze",
    ),
)
def _(spark, sf):
    # Two loads of different days into one table.
    lake = Lake(spark, work_dir(spark, "bronze"), "dev")
    rows = B.with_partition(X.bronze(spark, sf))
    early = F.dayofmonth(S.BRONZE_PARTITION) <= 15
    for half in (rows.where(early), rows.where(~early)):
        lake.append(half, "bronze_listings", S.BRONZE_PARTITION, ["SRC_SITE_NAME"])
    stored = lake.read("bronze_listings")
    return stored.groupBy(F.col(S.BRONZE_PARTITION).alias("load_date")).agg(
        F.count("*").alias("n"), F.countDistinct("ID").alias("ids"), F.min("ID").alias("first_id")
    )


@case(
    "ensure_table",
    Q.query(
        """
SELECT true AS created, false AS created_again, true AS refused, CAST(d AS VARCHAR) AS load_date, count(*) AS n
FROM bronze GROUP BY d""",
        "bronze",
    ),
)
def _(spark, sf):
    # The table as the bronze job declares it: rows without a listing id are refused, as a whole write.
    lake, name = Lake(spark, work_dir(spark, "declared"), "dev"), L.BRONZE_TABLE
    created, again = (lake.ensure(name, S.BRONZE, S.BRONZE_PARTITION) for _ in range(2))
    rows, refused = B.with_partition(X.bronze(spark, sf)), False
    lake.append(rows, name, S.BRONZE_PARTITION)
    try:
        lake.append(rows.withColumn("LISTING_ID", F.nullif("LISTING_ID", F.lit("1"))), name, S.BRONZE_PARTITION)
    except BrokenConstraintError:
        refused = True
    loads = lake.read(name).groupBy(F.col(S.BRONZE_PARTITION).alias("load_date")).agg(F.count("*").alias("n"))
    flags = {"created": created, "created_again": again, "refused": refused}
    return loads.select(*[F.lit(v).alias(c) for c, v in flags.items()], "load_date", "n")


def _catalog_table(spark, sf):
    """(name, tables before, created, created again, tables after); the table holds bronze."""
    location = work_dir(spark, "catalog")
    name = f"bronze_listings_{location[-12:]}"
    before = count_tables(spark, name)
    created = ensure_table(spark, name, S.BRONZE, S.BRONZE_PARTITION, location)
    again = ensure_table(spark, name, S.BRONZE, S.BRONZE_PARTITION, location)
    B.with_partition(X.bronze(spark, sf)).write.mode("append").insertInto(name)
    return name, before, created, again, count_tables(spark, name)


@case(
    "count_tables",
    Q.query("SELECT CAST(0 AS BIGINT) AS tables_before, CAST(1 AS BIGINT) AS tables_after, count(*) AS n FROM bronze", "bronze"),
)
def _(spark, sf):
    name, before, _, _, after = _catalog_table(spark, sf)
    return spark.table(name).agg(
        F.lit(before).alias("tables_before"), F.lit(after).alias("tables_after"), F.count("*").alias("n")
    )


@case(
    "dry_run",
    Q.query(
        """
SELECT b.blob, b.id, b.price, false AS written FROM bronze b JOIN (
  SELECT DISTINCT site, city, kind, d, page FROM bronze) p USING (site, city, kind, d, page)
WHERE p.page = (
  SELECT count(DISTINCT page) FROM bronze q
  WHERE q.site = b.site AND q.city = b.city AND q.kind = b.kind AND q.d = b.d AND q.page <= b.page)""",
        "bronze",
    ),
)
def _(spark, sf):
    lake = Lake(spark, work_dir(spark, "dry"), "dev")
    payloads = X.snapshot_payloads(spark, sf).select("blob", "payload")
    snapshots = N.path_lineage(payloads.withColumn("modified_ts", F.lit(X.RUN_TS).cast("timestamp")))
    # The job with its write switched off: every search's pages up to its first gap.
    params = RunParams("dev", "macae", "vivareal", "apartment", run_ts=X.RUN_TS_VALUE, write_bronze=False)
    rows = load_bronze(lake, snapshots, params, Staging.lasting(spark))
    return rows.select(
        F.col("SRC_BLOB").alias("blob"),
        F.col("LISTING_ID").alias("id"),
        F.col("LISTING_OFFERS_INFOS.PRICE").alias("price"),
        F.lit(lake.exists("bronze_listings")).alias("written"),
    )
