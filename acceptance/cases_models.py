"""Filters, functions, silver, dimensions, fact, upkeep and column tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance import fixtures as X
from acceptance import sql as Q
from acceptance.cases_sources import _amenities_text
from acceptance.registry import case
from hearthlake import functions as H
from hearthlake import schemas as S
from hearthlake.operators import quality as C
from hearthlake.operators import scd
from hearthlake.operators.merge import conform
from hearthlake.operators.pick import at_latest, first_per_key
from hearthlake.plans import dimensions as D
from hearthlake.plans import fact as A
from hearthlake.plans import pipeline as L
from hearthlake.plans import silver as V
from hearthlake.plans.keyed import KeyedTable
from hearthlake.session import Staging, work_dir
from hearthlake.sources.tables import BUCKET, ROWS, Lake

# ---------------------------------------------------------------------------
# projections and filters


def _ids(bronze):
    return bronze.select(F.col("ID").alias("id"))


@case("filter_scrape_date", Q.query("SELECT id FROM bronze WHERE d = (SELECT max(d) FROM bronze)", "bronze"))
def _(spark, sf):
    bronze = X.stored_bronze(spark, sf)
    return _ids(V.select_scope(bronze, file_date=bronze.agg(F.max(S.BRONZE_PARTITION)).scalar()))


@case("filter_city_eq", Q.query("SELECT id FROM bronze WHERE city = 'asia'", "bronze"))
def _(spark, sf):
    return _ids(V.select_scope(X.stored_bronze(spark, sf), city="asia"))


@case("filter_in_list", Q.query("SELECT id FROM bronze WHERE site <> 'other' AND kind = 'house'", "bronze"))
def _(spark, sf):
    return _ids(V.select_scope(X.stored_bronze(spark, sf), sites=["vivareal", "zapimoveis"], property_types=["house"]))


@case(
    "filter_required",
    Q.query("SELECT id FROM bronze WHERE url IS NOT NULL AND size IS NOT NULL AND price IS NOT NULL", "bronze"),
)
def _(spark, sf):
    return _ids(V.require_measures(V.flatten_structs(X.stored_bronze(spark, sf))))


_SILVER_SQL = f"""
SELECT bronze_id AS "BRONZE_ID", listing_id AS "LISTING_ID", listing_name AS "LISTING_NAME", url AS "URL",
  description AS "DESCRIPTION", pets AS "PETS_ALLOWED", rooms AS "ROOMS", bedrooms AS "BEDROOMS",
  bathrooms AS "BATHROOMS", street AS "STREET_ADDRESS", locality AS "LOCALITY", region AS "REGION",
  country AS "COUNTRY", size AS "FLOOR_SIZE", size_unit AS "FLOOR_SIZE_UNIT_CODE",
  CAST(to_json(images) AS VARCHAR) AS "IMAGES", {_amenities_text()} AS "AMENITY_FEATURES", price AS "PRICE",
  currency AS "PRICE_CURRENCY", availability AS "AVAILABILITY", fee_name AS "OFFERS_NAME", fee AS "OFFERS_PRICE",
  fee_currency AS "OFFERS_PRICE_CURRENCY", fee_period AS "OFFERS_PRICE_PERIOD", site AS "SITE", city AS "CITY",
  kind AS "PROPERTY_TYPE", page AS "PAGE", CAST(d AS VARCHAR) AS "SCRAPE_DATE",
  {Q.at(Q.RUN_1)} AS "AUD_INS_TS", {Q.at(Q.RUN_1)} AS "AUD_UPD_TS"
FROM {{source}}"""


@case("silver_listings", Q.query(_SILVER_SQL.format(source="silver"), "silver"))
def _(spark, sf):
    return V.silver_listings(X.stored_bronze(spark, sf), X.RUN_TS)


@case(
    "struct_flatten",
    Q.query(
        "SELECT id, street, locality, size, price, fee_name, fee FROM bronze", "bronze"
    ),
)
def _(spark, sf):
    return V.flatten_structs(X.stored_bronze(spark, sf)).selectExpr(
        "ID AS id", "STREET_ADDRESS AS street", "LOCALITY AS locality", "FLOOR_SIZE AS size", "PRICE AS price",
        "FEE_NAME AS fee_name", "FEE_VALUE AS fee",
    )


@case(
    "coalesce_defaults",
    Q.query(
        """
SELECT id, coalesce(pets, true) AS pets, coalesce(rooms, 0) AS rooms, coalesce(street, 'unknown') AS street,
  coalesce(fee, 0) AS fee, coalesce(availability, 'unknown') AS availability FROM bronze""",
        "bronze",
    ),
)
def _(spark, sf):
    columns = V.silver_columns(X.RUN_TS)
    return V.flatten_structs(X.stored_bronze(spark, sf)).select(
        columns["BRONZE_ID"].alias("id"),
        columns["PETS_ALLOWED"].alias("pets"),
        columns["ROOMS"].alias("rooms"),
        columns["STREET_ADDRESS"].alias("street"),
        columns["OFFERS_PRICE"].alias("fee"),
        columns["AVAILABILITY"].alias("availability"),
    )


@case(
    "filter_unit_currency",
    Q.query("SELECT bronze_id FROM silver WHERE currency = 'BRL' AND size_unit = 'M2'", "silver"),
)
def _(spark, sf):
    return A.in_fact_units(X.silver(spark, sf)).selectExpr("BRONZE_ID AS bronze_id")


@case(
    "rename_project",
    Q.query('SELECT bronze_id, size AS "FLOOR_SIZE_M2", price AS "PRICE_BRL" FROM fact', "fact"),
)
def _(spark, sf):
    fact = A.fact_listings(X.silver(spark, sf), X.RUN_TS)
    return fact.select(F.col("BRONZE_ID").alias("bronze_id"), "FLOOR_SIZE_M2", "PRICE_BRL")


# ---------------------------------------------------------------------------
# functions


@case("fn_initcap", Q.query(f"SELECT id, {Q.initcap('name')} AS v FROM bronze", "bronze"))
def _(spark, sf):
    return X.stored_bronze(spark, sf).select(F.col("ID").alias("id"), H.initcap_words(F.col("LISTING_NAME")).alias("v"))


@case(
    "fn_regexp_extract",
    Q.query(
        """
SELECT id, coalesce(nullif(regexp_extract(fee_unit, '^([A-Za-z]+)', 1), ''), 'unknown') AS currency,
  coalesce(nullif(regexp_extract(fee_unit, '/([A-Za-z]+)$', 1), ''), 'unknown') AS period FROM bronze""",
        "bronze",
    ),
)
def _(spark, sf):
    # The expressions of the silver model themselves.
    columns = V.silver_columns(X.RUN_TS)
    return V.flatten_structs(X.stored_bronze(spark, sf)).select(
        F.col("ID").alias("id"), columns["OFFERS_PRICE_CURRENCY"].alias("currency"), columns["OFFERS_PRICE_PERIOD"].alias("period")
    )


@case("fn_cast_int", Q.query("SELECT id, CAST(CAST(round(size) AS BIGINT) AS VARCHAR) AS size, CAST(CAST(round(price) AS BIGINT) AS VARCHAR) AS price FROM bronze", "bronze"))
def _(spark, sf):
    return X.stored_bronze(spark, sf).select(
        F.col("ID").alias("id"),
        H.round_to_long(F.col("LISTING_FLOOR_SIZE_INFOS.VALUE")).cast("string").alias("size"),
        H.round_to_long(F.col("LISTING_OFFERS_INFOS.PRICE")).cast("string").alias("price"),
    )


@case("fn_date", Q.query("SELECT id, CAST(d AS VARCHAR) AS d FROM bronze", "bronze"))
def _(spark, sf):
    return X.stored_bronze(spark, sf).select(F.col("ID").alias("id"), F.to_date("SRC_EXECUTED_AT_TS").alias("d"))


@case(
    "fn_case_rank",
    Q.query("SELECT id, CAST(list_position(['vivareal', 'zapimoveis', 'other'], site) AS BIGINT) AS rank FROM bronze", "bronze"),
)
def _(spark, sf):
    return X.stored_bronze(spark, sf).select(F.col("ID").alias("id"), H.site_rank(F.col("SRC_SITE_NAME")).alias("rank"))


@case("fn_if", Q.query('SELECT bronze_id, condo_fee AS "CONDO_FEE_BRL" FROM fact', "fact"))
def _(spark, sf):
    fact = A.fact_listings(X.silver(spark, sf), X.RUN_TS)
    return fact.select(F.col("BRONZE_ID").alias("bronze_id"), "CONDO_FEE_BRL")


@case("fn_md5_key", Q.query(f"SELECT id, {Q.ADDRESS_SK} AS sk FROM bronze", "bronze"))
def _(spark, sf):
    address = "LISTING_ADDRESS_INFOS"
    key = H.surrogate_key(*[f"{address}.{c}" for c in S.ADDRESS_COLUMNS])
    return X.stored_bronze(spark, sf).select(F.col("ID").alias("id"), key.alias("sk"))


@case("fn_md5_key_array", Q.query(f"SELECT id, {Q.IMAGES_SK} AS sk FROM bronze", "bronze"))
def _(spark, sf):
    key = H.surrogate_key(arrays=("LISTING_IMAGES_LIST",))
    return X.stored_bronze(spark, sf).select(F.col("ID").alias("id"), key.alias("sk"))


@case("fn_current_timestamp", Q.query(f"SELECT bronze_id, {Q.at(Q.RUN_1)} AS ts FROM silver", "silver"))
def _(spark, sf):
    return X.silver(spark, sf).selectExpr("BRONZE_ID AS bronze_id", "AUD_INS_TS AS ts")


@case(
    "fn_parse_ts",
    Q.query(
        """
SELECT id, CASE WHEN eid % 5 <> 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || '.000000' END AS parsed
FROM bronze""",
        "bronze",
    ),
)
def _(spark, sf):
    # Every fifth file name is no run time.
    stems = X.raw_events(spark, sf).selectExpr(
        "CAST(eid AS string) AS id",
        """CASE WHEN eid % 5 <> 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") ELSE d || ' final' END AS stem""",
    )
    return stems.select("id", H.parse_stem_ts(F.col("stem")).alias("parsed"))


@case(
    "fn_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS text FROM events",
)
def _(spark, sf):
    parsed = X.table(spark, sf, "events").select("event_id", H.lenient_json(F.col("props")).alias("v"))
    return parsed.select("event_id", H.member(F.col("v"), "$.k", "bigint").alias("k"), F.to_json("v").alias("text"))


# ---------------------------------------------------------------------------
# arrays and joins


@case(
    "unnest_struct_array",
    Q.query("SELECT listing_id, CAST(d AS VARCHAR) AS d, aname, avalue FROM features", "features"),
)
def _(spark, sf):
    rows = D.unnest_amenities(X.silver(spark, sf))
    return rows.selectExpr("LISTING_ID AS listing_id", "SCRAPE_DATE AS d", "AF.NAME AS aname", "AF.VALUE AS avalue")


@case("unnest_cross_join", Q.query("SELECT listing_id, count(*) AS n FROM features GROUP BY listing_id", "features"))
def _(spark, sf):
    rows = D.unnest_amenities(X.silver(spark, sf))
    return rows.groupBy(F.col("LISTING_ID").alias("listing_id")).agg(F.count("*").alias("n"))


@case("unnest_scalar_array", Q.query("SELECT images_sk, image_url FROM pictures", "pictures"))
def _(spark, sf):
    return D.unnest_images(X.silver(spark, sf)).selectExpr("IMAGES_SK AS images_sk", "IMAGE_URL AS image_url")


_SKS = f"""
SELECT listing_id, CAST(d AS VARCHAR) AS d,
  CAST(to_json(list_sort(list_distinct(list({Q.md5key('aname', 'avalue')})))) AS VARCHAR) AS sks
FROM features GROUP BY listing_id, d"""


@case("array_agg_distinct", Q.query(_SKS, "features"))
def _(spark, sf):
    rows = A.amenities_per_listing(X.silver(spark, sf))
    return rows.selectExpr("LISTING_ID AS listing_id", "SCRAPE_DATE AS d", "AMENITIES_SKS AS sks")


@case(
    "group_array_agg",
    Q.query(
        f"SELECT listing_id, CAST(d AS VARCHAR) AS d, count(DISTINCT {Q.md5key('aname', 'avalue')}) AS n FROM features GROUP BY listing_id, d",
        "features",
    ),
)
def _(spark, sf):
    rows = A.amenities_per_listing(X.silver(spark, sf))
    return rows.selectExpr("LISTING_ID AS listing_id", "SCRAPE_DATE AS d", "CAST(size(AMENITIES_SKS) AS bigint) AS n")


@case(
    "left_join_amenities",
    Q.query("SELECT bronze_id, CAST(to_json(sks) AS VARCHAR) AS sks FROM fact", "fact"),
)
def _(spark, sf):
    fact = A.fact_listings(X.silver(spark, sf), X.RUN_TS)
    return fact.selectExpr("BRONZE_ID AS bronze_id", "AMENITIES_SKS AS sks")


@case(
    "amenity_bridge_join",
    Q.query(
        f"""
SELECT f.listing_id, CAST(f.d AS VARCHAR) AS d, coalesce(a.aname, 'unknown') AS amenity, a.avalue AS value
FROM fact f
JOIN (SELECT DISTINCT aname, avalue, {Q.md5key('aname', 'avalue')} AS sk FROM features) a ON list_contains(f.sks, a.sk)""",
        "fact",
    ),
)
def _(spark, sf):
    silver = X.silver(spark, sf)
    bridge = A.amenity_bridge(A.fact_listings(silver, X.RUN_TS), D.AMENITIES.full(silver, X.RUN_TS))
    return bridge.selectExpr(
        "LISTING_ID AS listing_id", "SCRAPE_DATE AS d", "AMENITY_NAME AS amenity", "AMENITY_VALUE AS value"
    )


# ---------------------------------------------------------------------------
# distinct and latest


@case(
    "latest_scrape_only",
    Q.query("SELECT bronze_id FROM silver WHERE d = (SELECT d FROM last_day)", "last_day"),
)
def _(spark, sf):
    return at_latest(X.silver(spark, sf)).selectExpr("BRONZE_ID AS bronze_id")


@case(
    "select_distinct_rows",
    Q.query(
        f"SELECT DISTINCT {Q.ADDRESS_SK} AS sk, street, locality, region, country FROM silver WHERE d = (SELECT d FROM last_day)",
        "last_day",
    ),
)
def _(spark, sf):
    rows = D.ADDRESS.source(X.silver(spark, sf))
    return rows.selectExpr(
        "ADDRESS_SK AS sk", "STREET_ADDRESS AS street", "LOCALITY AS locality", "REGION AS region", "COUNTRY AS country"
    )


_AMENITY = f"{Q.md5key('aname', 'avalue')} AS sk, coalesce(aname, 'unknown') AS amenity, coalesce(avalue, 'unknown') AS value"


@case("select_distinct_full", Q.query(f"SELECT DISTINCT {_AMENITY} FROM features", "features"))
def _(spark, sf):
    rows = D.amenities_of(X.silver(spark, sf))
    return rows.selectExpr("AMENITIES_SK AS sk", "AMENITY_NAME AS amenity", "AMENITY_VALUE AS value")


@case(
    "dedup_cross_site",
    Q.query("SELECT bronze_id, site, CAST(d AS VARCHAR) AS d, price FROM silver", "silver"),
)
def _(spark, sf):
    kept = V.dedup_cross_site(V.require_measures(V.flatten_structs(X.stored_bronze(spark, sf))))
    return kept.selectExpr(
        "ID AS bronze_id", "SRC_SITE_NAME AS site", "CAST(SRC_EXECUTED_AT_TS AS date) AS d", "PRICE AS price"
    )


@case(
    "latest_per_key",
    Q.query(
        "SELECT listing_id, arg_min(bronze_id, {'d': -epoch(d), 'b': bronze_id}) AS bronze_id FROM silver GROUP BY listing_id",
        "silver",
    ),
)
def _(spark, sf):
    rows = first_per_key(X.silver(spark, sf), ["LISTING_ID"], [F.desc("SCRAPE_DATE"), F.col("BRONZE_ID")])
    return rows.selectExpr("LISTING_ID AS listing_id", "BRONZE_ID AS bronze_id")


@case(
    "latest_per_composite_key",
    Q.query(
        "SELECT images_sk, image_url, arg_min(bronze_id, {'d': -epoch(d), 'b': bronze_id}) AS bronze_id FROM pictures GROUP BY images_sk, image_url",
        "pictures",
    ),
)
def _(spark, sf):
    rows = X.silver(spark, sf).select(
        "BRONZE_ID", "SCRAPE_DATE", D.images_sk().alias("IMAGES_SK"), F.explode("IMAGES").alias("IMAGE_URL")
    )
    rows = first_per_key(rows, ["IMAGES_SK", "IMAGE_URL"], [F.desc("SCRAPE_DATE"), F.col("BRONZE_ID")])
    return rows.selectExpr("IMAGES_SK AS images_sk", "IMAGE_URL AS image_url", "BRONZE_ID AS bronze_id")


@case(
    "window_order",
    Q.query(
        """
SELECT listing_id, arg_min(bronze_id, {'r': CASE site WHEN 'vivareal' THEN 1 WHEN 'zapimoveis' THEN 2 ELSE 3 END,
  'd': -epoch(d), 'b': bronze_id}) AS bronze_id FROM silver GROUP BY listing_id""",
        "silver",
    ),
)
def _(spark, sf):
    order = [H.site_rank(F.col("SITE")), F.desc("SCRAPE_DATE"), F.col("BRONZE_ID")]
    rows = first_per_key(X.silver(spark, sf), ["LISTING_ID"], order)
    return rows.selectExpr("LISTING_ID AS listing_id", "BRONZE_ID AS bronze_id")


# ---------------------------------------------------------------------------
# dimensions. _full: first load of the whole history. _incr: target = first load of
# all dates but the last, source = the last date.

_AUDIT = 'true AS "IN_LAST_SCRAPE_FLAG", {0} AS "AUD_INS_TS", {0} AS "AUD_UPD_TS"'.format(Q.at(Q.RUN_1))

# per dimension: columns, first load of a set of dates, rows of one date
_DIMS = {
    "listings": dict(
        keys="listing_id",
        columns='listing_id AS "LISTING_ID", a AS "LISTING_NAME", b AS "URL", c AS "DESCRIPTION"',
        full="""SELECT listing_id, unnest(arg_min({{'a': listing_name, 'b': url, 'c': description}}, {{'d': -epoch(d), 'b': bronze_id}}))
           FROM {src} WHERE {when} GROUP BY listing_id""",
        rows="SELECT DISTINCT listing_id, listing_name AS a, url AS b, description AS c FROM {src} WHERE {when}",
        src="silver",
    ),
    "address": dict(
        keys="sk",
        columns='sk AS "ADDRESS_SK", a AS "STREET_ADDRESS", b AS "LOCALITY", c AS "REGION", e AS "COUNTRY"',
        full=f"SELECT DISTINCT {Q.ADDRESS_SK} AS sk, street AS a, locality AS b, region AS c, country AS e FROM {{src}} WHERE {{when}}",
        rows=f"SELECT DISTINCT {Q.ADDRESS_SK} AS sk, street AS a, locality AS b, region AS c, country AS e FROM {{src}} WHERE {{when}}",
        src="silver",
    ),
    "amenities": dict(
        keys="sk",
        columns='sk AS "AMENITIES_SK", a AS "AMENITY_NAME", b AS "AMENITY_VALUE"',
        full=f"SELECT DISTINCT {Q.md5key('aname', 'avalue')} AS sk, coalesce(aname, 'unknown') AS a, coalesce(avalue, 'unknown') AS b FROM {{src}} WHERE {{when}}",
        rows=f"SELECT DISTINCT {Q.md5key('aname', 'avalue')} AS sk, coalesce(aname, 'unknown') AS a, coalesce(avalue, 'unknown') AS b FROM {{src}} WHERE {{when}}",
        src="features",
    ),
    "images": dict(
        keys="sk, url",
        columns='sk AS "IMAGES_SK", url AS "IMAGE_URL"',
        full="SELECT DISTINCT images_sk AS sk, image_url AS url FROM {src} WHERE {when}",
        rows="SELECT DISTINCT images_sk AS sk, image_url AS url FROM {src} WHERE {when}",
        src="pictures",
    ),
}


def _full_sql(name: str) -> str:
    dim = _DIMS[name]
    inner = dim["full"].format(src=dim["src"], when="true")
    return Q.query(f"SELECT {dim['columns']}, {_AUDIT} FROM ({inner})", dim["src"])


def _dimension_sql(name: str) -> str:
    """A first load's rows, below the parts that its source needs."""
    dim = _DIMS[name]
    return f"SELECT {dim['columns']}, {_AUDIT} FROM ({dim['full'].format(src=dim['src'], when='true')})"


def _step_sql(name: str, pieces: str) -> str:
    """ACTIVE and/or DEACTIVATED rows of the last date against all earlier dates."""
    dim = _DIMS[name]
    # Only the listing dimension needs input with one row per listing and date.
    suffix = "_u" if name == "listings" else ""
    src = dim["src"] + suffix
    latest = f"(SELECT max(d) FROM {src})"
    target = dim["full"].format(src=src, when=f"d < (SELECT d FROM last_day{suffix})")
    source = dim["rows"].format(src=src, when=f"d = {latest}")
    keys = [k.strip() for k in dim["keys"].split(",")]
    match = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    halves = {
        "active": f"""SELECT {dim['columns']}, true AS "IN_LAST_SCRAPE_FLAG",
  CASE WHEN EXISTS (SELECT 1 FROM tgt t WHERE {match}) THEN {Q.at(Q.RUN_1)} ELSE {Q.at(Q.RUN_2)} END AS "AUD_INS_TS",
  {Q.at(Q.RUN_2)} AS "AUD_UPD_TS" FROM src s""",
        "deactivated": f"""SELECT {dim['columns']}, false AS "IN_LAST_SCRAPE_FLAG", {Q.at(Q.RUN_1)} AS "AUD_INS_TS",
  {Q.at(Q.RUN_2)} AS "AUD_UPD_TS" FROM tgt t ANTI JOIN src s ON {match}""",
    }
    body = "\nUNION ALL\n".join(halves[p] for p in pieces.split())
    head = Q.query("SELECT 1", f"last_day{suffix}", src).rsplit("\nSELECT 1", 1)[0]
    return f"{head},\ntgt AS (\n{target}\n),\nsrc AS (\n{source}\n)\n{body}"


def _two_runs(spark, sf, dim):
    silver = X.silver(spark, sf, unique=dim is D.LISTINGS)
    return dim.source(silver), dim.full(X.up_to(silver, 1), X.RUN_1)


_BY_NAME = {"listings": D.LISTINGS, "address": D.ADDRESS, "amenities": D.AMENITIES, "images": D.IMAGES}


def _register_dimension(name: str, dim: D.Dimension) -> None:
    @case(f"dim_{name}_full", _full_sql(name))
    def full(spark, sf):
        return dim.full(X.silver(spark, sf), X.RUN_1)

    @case(f"dim_{name}_incr", _step_sql(name, "active deactivated"))
    def incremental(spark, sf):
        # The rows that a run puts into the stored dimension, which is kept in buckets.
        silver = X.silver(spark, sf, unique=dim is D.LISTINGS)
        build = lambda lake: KeyedTable(lake, dim.spec).create(dim.full(X.up_to(silver, 1), X.RUN_1))
        table, stage = KeyedTable(X.lake_of(spark, sf, f"dim_{name}", build), dim.spec), Staging.lasting(spark)
        source = stage.keep(dim.source(silver), "latest")
        return table.changes(source, X.RUN_2, stage).upserts.drop(BUCKET)


for _name, _dim in _BY_NAME.items():
    _register_dimension(_name, _dim)


@case("left_join_preserve", _step_sql("listings", "active"))
def _(spark, sf):
    return scd.active_rows(*_two_runs(spark, sf, D.LISTINGS), D.LISTINGS.spec.keys, X.RUN_2)


@case("left_join_two_keys", _step_sql("images", "active"))
def _(spark, sf):
    return scd.active_rows(*_two_runs(spark, sf, D.IMAGES), D.IMAGES.spec.keys, X.RUN_2)


@case("anti_join_deactivate", _step_sql("address", "deactivated"))
def _(spark, sf):
    return scd.deactivated_rows(*_two_runs(spark, sf, D.ADDRESS), D.ADDRESS.spec.keys, X.RUN_2)


@case("union_active_deactivated", _step_sql("amenities", "active deactivated"))
def _(spark, sf):
    source, target = _two_runs(spark, sf, D.AMENITIES)
    keys = D.AMENITIES.spec.keys
    return scd.active_rows(source, target, keys, X.RUN_2).unionByName(
        scd.deactivated_rows(source, target, keys, X.RUN_2)
    )


Q.part(
    "three_runs",
    f"""
SELECT listing_id, max(d) = (SELECT d FROM last_day_u) AS active,
  CASE WHEN min(d) <= (SELECT d FROM day_2) THEN {Q.at(Q.RUN_1)}
       WHEN min(d) = (SELECT d FROM day_1) THEN {Q.at(Q.RUN_2)} ELSE {Q.at(Q.RUN_3)} END AS ins_ts,
  CASE WHEN max(d) = (SELECT d FROM last_day_u) OR max(d) = (SELECT d FROM day_1) THEN {Q.at(Q.RUN_3)}
       WHEN max(d) < (SELECT d FROM day_1) THEN {Q.at(Q.RUN_2)} END AS upd_ts,
  max_by(listing_name, d) AS name
FROM silver_u GROUP BY listing_id
""",
    "day_2",
)


def _three_runs(spark, sf):
    """First load up to the last date but two, then the next two dates one by one."""
    silver, stage = X.silver(spark, sf, unique=True), Staging.lasting(spark)
    latest = lambda back: stage.keep(D.LISTINGS.source(X.up_to(silver, back)), "latest")

    def build(lake):
        table = KeyedTable(lake, D.LISTINGS.spec)
        table.create(D.LISTINGS.full(X.up_to(silver, 2), X.RUN_1))
        table.merge(latest(1), X.RUN_2, stage)

    # The table after two runs is stored; the third one is worked out here.
    table = KeyedTable(X.lake_of(spark, sf, "two_runs", build), D.LISTINGS.spec)
    return table.after(table.changes(latest(0), X.RUN_3, stage))


@case("scd1_soft_delete", Q.query("SELECT * FROM three_runs", "three_runs"))
def _(spark, sf):
    return _three_runs(spark, sf).selectExpr(
        "LISTING_ID AS listing_id", "IN_LAST_SCRAPE_FLAG AS active", "AUD_INS_TS AS ins_ts", "AUD_UPD_TS AS upd_ts",
        "LISTING_NAME AS name",
    )


@case("filter_active_flag", Q.query("SELECT listing_id FROM three_runs WHERE active", "three_runs"))
def _(spark, sf):
    return scd.filter_active(_three_runs(spark, sf)).selectExpr("LISTING_ID AS listing_id")


# ---------------------------------------------------------------------------
# fact

_FACT_SQL = f"""
SELECT bronze_id AS "BRONZE_ID", listing_id AS "LISTING_ID", address_sk AS "ADDRESS_SK", images_sk AS "IMAGES_SK",
  CAST(to_json(sks) AS VARCHAR) AS "AMENITIES_SKS", site AS "SITE", city AS "CITY", kind AS "PROPERTY_TYPE",
  page AS "PAGE", CAST(d AS VARCHAR) AS "SCRAPE_DATE", pets AS "PETS_ALLOWED", rooms AS "ROOMS",
  bedrooms AS "BEDROOMS", bathrooms AS "BATHROOMS", size AS "FLOOR_SIZE_M2", price AS "PRICE_BRL",
  condo_fee AS "CONDO_FEE_BRL", {Q.at(Q.RUN_1)} AS "AUD_INS_TS", {Q.at(Q.RUN_1)} AS "AUD_UPD_TS"
FROM fact"""


@case("fact_listings", Q.query(_FACT_SQL, "fact"))
def _(spark, sf):
    return A.fact_listings(X.silver(spark, sf), X.RUN_TS)


_TREND_SQL = """
SELECT city AS "CITY", kind AS "PROPERTY_TYPE", CAST(d AS VARCHAR) AS "SCRAPE_DATE", count(*) AS "LISTINGS",
  CAST(sum(CAST(price AS DECIMAL(38,10))) AS DOUBLE) / count(*) AS "AVG_PRICE_BRL",
  round(quantile_cont(price, 0.25), 6) AS "Q1_PRICE_BRL", round(quantile_cont(price, 0.5), 6) AS "MEDIAN_PRICE_BRL",
  round(quantile_cont(price, 0.75), 6) AS "Q3_PRICE_BRL", min(price) AS "MIN_PRICE_BRL", max(price) AS "MAX_PRICE_BRL",
  CAST(sum(CAST(condo_fee AS DECIMAL(38,10))) AS DOUBLE) / count(*) AS "AVG_CONDO_FEE_BRL",
  CAST(sum(CAST(price AS DECIMAL(38,10))) AS DOUBLE) / CAST(sum(CAST(size AS DECIMAL(38,10))) AS DOUBLE) AS "PRICE_PER_M2_BRL"
FROM fact GROUP BY city, kind, d"""


@case("price_trend", Q.query(_TREND_SQL, "fact"))
def _(spark, sf):
    # End to end: bronze built from the tables, silver, fact, trend in one plan.
    silver = V.silver_listings(X.bronze(spark, sf), X.RUN_TS)
    return A.price_trend(A.fact_listings(silver, X.RUN_TS))


# ---------------------------------------------------------------------------
# upkeep of tables


def _early_and_late(spark, sf):
    """Silver as first stored (all dates but the last two) and a second run that
    brings the last three dates with prices one higher: one overlaps, two are new."""
    silver = X.silver(spark, sf, unique=True)
    late = silver.where(F.col("SCRAPE_DATE") >= X.day(silver, 2)).withColumn("PRICE", F.col("PRICE") + 1)
    return X.up_to(silver, 2), late


_MERGED = """
SELECT listing_id, CAST(d AS VARCHAR) AS d, CASE WHEN d >= (SELECT d FROM day_2) THEN price + 1 ELSE price END AS price
FROM silver_u"""


def _measure(rows):
    return rows.selectExpr("LISTING_ID AS listing_id", "SCRAPE_DATE AS d", "PRICE AS price")


def _stored_early(spark, sf, shape=lambda rows: rows):
    """(lake, version, late rows): silver in parts of a date and city, in buckets, with its early dates; the late rows are stored too."""
    early, late = _early_and_late(spark, sf)

    def build(lake):
        L.store(lake, shape(early), S.SILVER)
        lake.publish(late, "late")

    lake = X.lake_of(spark, sf, f"early_{shape.__name__}", build)
    return lake, lake.version(S.SILVER.name), lake.current("late")


def _after_merge(lake, base, late):
    """The whole table after the merge of ``late``: parts that it touches merged where they lie, the others as they are."""
    section = base.section(ROWS)
    dates = [r[0] for r in late.select("SCRAPE_DATE").distinct().collect()]
    touched = section.matching(SCRAPE_DATE=dates)
    merged = L.upsert_plan(lake, late, S.SILVER, base, sorted(touched))
    rest = lake.read(S.SILVER.name, version=base).where(~F.col("SCRAPE_DATE").isin(dates))
    return conform(rest, merged.schema).unionByName(merged)


@case("merge_upsert", Q.query(_MERGED, "day_2"))
def _(spark, sf):
    return _measure(_after_merge(*_stored_early(spark, sf)))


@case("partitioned_write", Q.query(_MERGED, "day_2"))
def _(spark, sf):
    early, late = _early_and_late(spark, sf)
    lake = Lake(spark, work_dir(spark, "partitioned"), "dev")
    for rows in (early, late):
        lake.overwrite_partitions(rows, S.SILVER.name, S.SILVER.partition, S.SILVER.cluster)
    return _measure(lake.read(S.SILVER.name))


@case(
    "clustered_write",
    Q.query("SELECT site, city, kind AS property_type, page, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price FROM silver GROUP BY site, city, kind, page", "silver"),
)
def _(spark, sf):
    lake = Lake(spark, work_dir(spark, "clustered"), "dev")
    lake.overwrite_partitions(X.silver(spark, sf), S.SILVER.name, S.SILVER.partition, S.SILVER.cluster)
    by_place = lake.read(S.SILVER.name).groupBy(
        F.col("SITE").alias("site"), F.col("CITY").alias("city"), F.col("PROPERTY_TYPE").alias("property_type"),
        F.col("PAGE").alias("page"),
    )
    return by_place.agg(F.count("*").alias("n"), F.sum(F.col("PRICE").cast("decimal(18,2)")).cast("double").alias("price"))


@case("create_or_full_refresh", Q.query("SELECT listing_id, count(*) AS n FROM silver_u GROUP BY listing_id", "silver_u"))
def _(spark, sf):
    # The table is made twice; the second time replaces it.
    lake = Lake(spark, work_dir(spark, "refresh"), "dev")
    silver = X.silver(spark, sf, unique=True)
    for rows in (X.up_to(silver, 1), silver):
        lake.publish(rows, S.SILVER.name, S.SILVER.cluster)
    return lake.current(S.SILVER.name).groupBy(F.col("LISTING_ID").alias("listing_id")).agg(F.count("*").alias("n"))


@case(
    "schema_sync",
    Q.query(
        """
SELECT listing_id, CAST(d AS VARCHAR) AS d, price, late, CASE WHEN late THEN 'late' END AS batch,
  false AS has_description, 'bigint' AS rooms_type, rooms + CASE WHEN late THEN 5000000000 ELSE 0 END AS rooms,
  CASE WHEN late THEN page + 0.5 END AS home_score, 'struct<ROOMS:bigint,SCORE:double>' AS home_type,
  CASE WHEN late THEN 'new' ELSE '~' END AS first_tag
FROM (SELECT *, d >= (SELECT d FROM day_2) AS late FROM silver_u)""",
        "day_2",
    ),
)
def _(spark, sf):
    # The second run has a new column and no DESCRIPTION; within a struct and an array of structs a field is new,
    # one is gone, and an int has become a bigint.
    def first_shape(rows):
        home = F.struct(F.col("ROOMS").cast("int").alias("ROOMS"), F.lit("gone").alias("OLD"))
        return rows.withColumns({"HOME": home, "TAGS": F.array(F.struct(F.lit(1).alias("N"), F.lit("x").alias("OLD")))})

    lake, base, late = _stored_early(spark, sf, first_shape)
    home = F.struct((F.col("ROOMS") + 5_000_000_000).alias("ROOMS"), (F.col("PAGE") + 0.5).alias("SCORE"))
    tags = F.array(F.struct(F.lit(1).cast("bigint").alias("N"), F.lit("new").alias("TAG")))
    late = late.withColumns({"PRICE": F.col("PRICE") - 1, "BATCH": F.lit("late"), "HOME": home, "TAGS": tags}).drop("DESCRIPTION")
    merged = _after_merge(lake, base, late)
    kinds = {f.name: f.dataType for f in merged.schema}
    return merged.select(
        F.col("LISTING_ID").alias("listing_id"),
        F.col("SCRAPE_DATE").alias("d"),
        F.round("PRICE", 2).alias("price"),
        F.col("BATCH").isNotNull().alias("late"),
        F.col("BATCH").alias("batch"),
        F.lit("DESCRIPTION" in merged.columns).alias("has_description"),
        F.lit(kinds["HOME"]["ROOMS"].dataType.simpleString()).alias("rooms_type"),
        F.col("HOME.ROOMS").alias("rooms"),
        F.col("HOME.SCORE").alias("home_score"),
        F.lit(kinds["HOME"].simpleString()).alias("home_type"),
        F.coalesce(F.col("TAGS")[0]["TAG"], F.lit("~")).alias("first_tag"),
    )


# ---------------------------------------------------------------------------
# column tests, on bronze where the fixture has failures to find

#: Where the bronze columns are in the SQL; the others have a value in every row.
_BRONZE_SQL = {
    "ID": "id",
    "LISTING_ID": "listing_id",
    "LISTING_NAME": "name",
    "LISTING_URL": "url",
    "LISTING_DESCRIPTION": "description",
    "LISTING_PETS_ALLOWED_FLAG": "pets",
    "LISTING_NUMBER_OF_ROOMS_AMT": "rooms",
    "LISTING_NUMBER_OF_BEDROOMS_AMT": "bedrooms",
    "LISTING_NUMBER_OF_BATHROOMS_AMT": "bathrooms",
    "LISTING_ADDRESS_INFOS": "country",
    "LISTING_FLOOR_SIZE_INFOS": "size_unit",
    "LISTING_IMAGES_LIST": "images",
    "LISTING_AMENITY_FEATURES_INFOS": "n_amenities",
    "LISTING_OFFERS_INFOS": "currency",
    "SRC_BLOB": "blob",
    "SRC_SITE_NAME": "site",
    "SRC_CITY_NAME": "city",
    "SRC_PROPERTY_TYPE_CAT": "kind",
    "SRC_PAGE_NUM": "page",
    "SRC_EXECUTED_AT_TS": "ts",
    "AUD_VERSION_ID": "id",
    "AUD_INS_TS": "id",
    "AUD_UPD_TS": "id",
}


@case(
    "dq_not_null",
    Q.query(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({s} IS NULL) AS failures FROM bronze" for c, s in _BRONZE_SQL.items()
        ),
        "bronze",
    ),
)
def _(spark, sf):
    return C.not_null(X.stored_bronze(spark, sf), S.BRONZE.fieldNames())


@case(
    "dq_unique",
    Q.query("SELECT listing_id AS value, count(*) AS occurrences FROM bronze GROUP BY listing_id HAVING count(*) > 1", "bronze"),
)
def _(spark, sf):
    return C.unique(X.stored_bronze(spark, sf), "LISTING_ID")


@case(
    "dq_accepted_values",
    Q.query("SELECT site AS value, count(*) AS occurrences FROM bronze WHERE site = 'other' GROUP BY site", "bronze"),
)
def _(spark, sf):
    return C.accepted_values(X.stored_bronze(spark, sf), "SRC_SITE_NAME", ["vivareal", "zapimoveis"])


@case(
    "dq_foreign_key",
    Q.query(
        f"""
SELECT 'IMAGES_SK' AS fk, images_sk AS value, count(*) AS occurrences FROM fact
WHERE images_sk NOT IN (SELECT images_sk FROM pictures WHERE d = (SELECT max(d) FROM pictures)) GROUP BY images_sk
UNION ALL
SELECT 'LISTING_ID', listing_id, count(*) FROM fact
WHERE listing_id NOT IN (SELECT listing_id FROM silver WHERE d = (SELECT d FROM last_day)) GROUP BY listing_id
UNION ALL
SELECT 'ADDRESS_SK', address_sk, count(*) FROM fact
WHERE address_sk NOT IN (SELECT {Q.ADDRESS_SK} FROM silver WHERE d = (SELECT d FROM last_day)) GROUP BY address_sk
UNION ALL
SELECT 'AMENITIES_SKS', sk, count(*) FROM (SELECT unnest(sks) AS sk FROM fact)
WHERE sk NOT IN (SELECT {Q.md5key('aname', 'avalue')} FROM features WHERE d = (SELECT max(d) FROM features)) GROUP BY sk""",
        "fact", "pictures", "last_day",
    ),
)
def _(spark, sf):
    # Dimensions of the latest scrape only: facts of earlier dates lack some keys.
    silver = X.silver(spark, sf)
    keys = {"IMAGES_SK": D.IMAGES, "LISTING_ID": D.LISTINGS, "ADDRESS_SK": D.ADDRESS, "AMENITIES_SKS": D.AMENITIES}
    dimensions = {name: dim.source(silver).select(dim.spec.keys[0]) for name, dim in keys.items()}
    return C.foreign_keys(A.fact_listings(silver, X.RUN_TS), {name: F.col(name) for name in keys}, dimensions)


#: Per table: its contract, the column its test rows are told apart by, and the SQL of its rows.
_CONTRACTS = {
    S.SILVER: ('"BRONZE_ID"', _SILVER_SQL.format(source="silver"), "silver"),
    S.DIM_LISTINGS: ('"LISTING_ID"', _dimension_sql("listings"), "silver"),
    S.DIM_ADDRESS: ('"ADDRESS_SK"', _dimension_sql("address"), "silver"),
    S.DIM_AMENITIES: ('"AMENITIES_SK" || "AMENITY_NAME" || "AMENITY_VALUE"', _dimension_sql("amenities"), "features"),
    S.DIM_IMAGES: ('"IMAGES_SK" || "IMAGE_URL"', _dimension_sql("images"), "pictures"),
    S.FACT: ('"BRONZE_ID"', _FACT_SQL, "fact"),
}


def _draw(key: str, salt: str) -> str:
    """One hex digit of a row and a purpose, in both engines."""
    return f"substr(md5({key} || '#{salt}'), 1, 1)"


def _broken_sql(spec, key: str, rows: str) -> str:
    """A table's rows with some of them twice, some property types that are none, and holes in every tested column."""
    odd = f"CASE WHEN {_draw('k', 'odd')} = '0' THEN 'castle-' || {_draw('k', 'kind')} ELSE \"PROPERTY_TYPE\" END"
    inner = f"SELECT *, {key} AS k FROM ({rows})"
    twice = f"SELECT *, unnest(CASE WHEN {_draw('k', 'twice')} = 'f' THEN [0, 1] ELSE [0] END) AS again FROM ({inner})"
    if spec.accepted:
        twice = f'SELECT * REPLACE ({odd} AS "PROPERTY_TYPE") FROM ({twice})'
    holes = ", ".join(f"""CASE WHEN {_draw('k', str(i))} <> '7' THEN "{c}" END AS "{c}\"""" for i, c in enumerate(spec.not_null))
    return f"SELECT * REPLACE ({holes}) FROM ({twice})"


def _contract_sql() -> str:
    selects, needs = [], []
    for spec, (key, rows, source) in _CONTRACTS.items():
        own = f"broken_{spec.name}"
        Q.part(own, _broken_sql(spec, key, rows), source)
        needs.append(own)
        line = f"SELECT '{spec.name}' AS \"table\", '%s' AS test, '%s' AS \"column\", (%s)::BIGINT AS failures"
        selects += [line % ("not_null", c, f'SELECT count(*) FROM {own} WHERE "{c}" IS NULL') for c in spec.not_null]
        selects += [
            line % ("unique", c, f'SELECT count(*) FROM (SELECT "{c}" FROM {own} WHERE "{c}" IS NOT NULL GROUP BY "{c}" HAVING count(*) > 1)')
            for c in spec.unique
        ]
        selects += [
            line % ("accepted_values", c, f"""SELECT count(DISTINCT "{c}") FROM {own} WHERE "{c}" NOT IN ({', '.join(f"'{v}'" for v in values)})""")
            for c, values in spec.accepted
        ]
    return Q.query("\nUNION ALL\n".join(selects), *needs)


def _gold(spark, sf):
    """A lake with the dimensions and the fact of the whole history, as the pipeline stores them."""
    silver = X.silver(spark, sf)

    def build(lake):
        for dim in D.ALL:
            KeyedTable(lake, dim.spec).create(dim.full(silver, X.RUN_1))
        L.store(lake, A.fact_listings(silver, X.RUN_TS), S.FACT)

    return X.lake_of(spark, sf, "gold", build)


@case("dq_contracts", _contract_sql())
def _(spark, sf):
    # All 76 tests: every tested column is emptied in some rows, some rows come twice, some types are none.
    lake = _gold(spark, sf)
    tables = {S.SILVER: X.silver(spark, sf), S.FACT: lake.read(S.FACT.name)} | {d.spec: lake.current(d.spec.name) for d in D.ALL}

    def broken(spec):
        df = tables[spec].withColumn("k", F.expr(_CONTRACTS[spec][0].replace('"', "`")))
        df = df.withColumn("again", F.explode(F.expr(f"CASE WHEN {_draw('k', 'twice')} = 'f' THEN array(0, 1) ELSE array(0) END")))
        if spec.accepted:
            odd = F.expr(f"CASE WHEN {_draw('k', 'odd')} = '0' THEN 'castle-' || {_draw('k', 'kind')} ELSE PROPERTY_TYPE END")
            df = df.withColumn("PROPERTY_TYPE", odd)
        return df.withColumns({c: F.when(F.expr(_draw("k", str(i))) != "7", F.col(c)) for i, c in enumerate(spec.not_null)})

    return C.run_contracts({spec: broken(spec) for spec in _CONTRACTS})


@case("run_date_scope", Q.query(_FACT_SQL + " WHERE d = (SELECT d FROM last_day)", "fact", "last_day"))
def _(spark, sf):
    # One run as it is scheduled: the fact of a single date.
    return A.fact_listings(at_latest(X.silver(spark, sf)), X.RUN_TS)


