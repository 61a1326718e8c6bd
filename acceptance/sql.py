"""The same inputs and layers in the oracle's SQL, as named WITH parts.

Everything is kept flat here (no nested columns), so that the SQL is a second
formulation and not a transcript of the Spark plan.
"""

from __future__ import annotations

RUN_1, RUN_2, RUN_3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"

PARTS: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


def part(name: str, body: str, *needs: str) -> None:
    PARTS[name], NEEDS[name] = body.strip(), needs


def query(select: str, *needs: str) -> str:
    """``select`` below the WITH parts it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for other in NEEDS[name]:
                add(other)
            ordered.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f"{name} AS (\n{PARTS[name]}\n)" for name in ordered)
    return f"WITH {parts}\n{select.strip()}" if parts else select.strip()


def initcap(text: str) -> str:
    low = f"lower({text})"
    return (
        f"array_to_string(list_transform(string_split({low}, ''), lambda c, i: CASE WHEN i = 1 OR "
        rf"regexp_matches({low}[i - 1], '[\s\[\](){{}}/|\\<>!?@\"^#$&~_,.:;*%+-]') THEN upper(c) ELSE c END), '')"
    )


def md5key(*parts: str) -> str:
    return "md5(" + " || '||' || ".join(f"coalesce({p}, '')" for p in parts) + ")"


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def at(run: str) -> str:
    return f"'{run}.000000'"


part(
    "raw",
    """
SELECT e.event_id AS eid, e.user_id AS uid, e.ts, CAST(e.ts AS DATE) AS d, e.event_type, e.value, e.props,
  c.c_name, lower(c.c_mktsegment) AS seg, n.n_name, r.r_name,
  CASE e.event_id % 3 WHEN 0 THEN 'zapimoveis' WHEN 1 THEN 'vivareal' ELSE 'other' END AS site,
  lower(r.r_name) AS city,
  CASE WHEN e.event_id % 2 = 0 THEN 'apartment' ELSE 'house' END AS kind,
  e.event_id // 4096 AS block,
  (e.event_id // 6) % 10 + 1 + 10 * (e.event_id // 4096) AS page
FROM events e
JOIN customer c ON c.c_custkey = e.user_id
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
""",
)

part(
    "bronze",
    """
SELECT eid, uid, d, ts, value, seg, event_type, props, n_name, r_name, site, city, kind, block, page,
  CAST(eid AS VARCHAR) AS id, CAST(uid AS VARCHAR) AS listing_id,
  CASE WHEN eid % 7 <> 0 THEN seg || list_extract(['-', '/', ' ', '_'], CAST(eid % 4 + 1 AS INTEGER)) || event_type END AS name,
  CASE WHEN eid % 50 <> 0 THEN 'https://example.com/l/' || uid END AS url,
  CASE WHEN eid % 13 <> 0 THEN c_name END AS description,
  CASE WHEN eid % 3 <> 0 THEN eid % 2 = 0 END AS pets,
  CASE WHEN eid % 17 <> 0 THEN eid % 2 END AS rooms,
  CASE WHEN eid % 17 <> 0 THEN eid % 2 END AS bedrooms,
  CASE WHEN eid % 17 <> 0 THEN eid % 2 END AS bathrooms,
  CASE WHEN eid % 19 <> 0 AND eid % 11 <> 0 THEN r_name END AS street,
  CASE WHEN eid % 19 <> 0 THEN n_name END AS locality,
  CASE WHEN eid % 19 <> 0 THEN r_name END AS region,
  CASE WHEN eid % 19 <> 0 THEN 'BR' END AS country,
  CASE WHEN eid % 29 <> 0 THEN CAST(eid % 5 AS DOUBLE) + 0.5 END AS size,
  CASE WHEN eid % 29 <> 0 THEN CASE WHEN eid % 23 = 0 THEN 'FT' ELSE 'M2' END END AS size_unit,
  list_transform(range(eid % 4), lambda i: 'https://img/' || uid || '/' || i) AS images,
  CAST(eid % 3 AS BIGINT) AS n_amenities,
  CASE WHEN eid % 31 <> 0 THEN event_type END AS amenity_1,
  seg AS amenity_2,
  CASE WHEN eid % 43 <> 0 AND eid % 41 <> 0 THEN floor(value / 25) * 25 + 25 END AS price,
  CASE WHEN eid % 43 <> 0 THEN CASE WHEN eid % 37 = 0 THEN 'USD' ELSE 'BRL' END END AS currency,
  CASE WHEN eid % 43 <> 0 AND eid % 5 <> 0 THEN 'InStock' END AS availability,
  CASE WHEN eid % 43 <> 0 AND eid % 2 = 0 THEN 'https://example.com/a/' || uid END AS target,
  CASE WHEN eid % 43 <> 0 AND eid % 4 = 2 THEN value END AS spec_price,
  CASE WHEN eid % 43 <> 0 AND eid % 47 <> 0 THEN CASE WHEN eid % 2 = 0 THEN 'Condominium Fee' ELSE 'Tax' END END AS fee_name,
  CASE WHEN eid % 43 <> 0 AND eid % 47 <> 0 THEN CAST(eid % 100 AS DOUBLE) END AS fee,
  CASE WHEN eid % 43 <> 0 AND eid % 47 <> 0 THEN
    CASE eid % 5 WHEN 0 THEN 'BRL/month' WHEN 1 THEN 'BRL' WHEN 2 THEN '/year' WHEN 3 THEN '123' END END AS fee_unit,
  'dev/' || site || '/' || city || '/' || kind || '/' || page || '/' || d || 'T00:00:00Z.json' AS blob
FROM raw
""",
    "raw",
)
part(
    "bronze_u",
    "SELECT * FROM bronze WHERE eid IN (SELECT min(eid) FROM raw GROUP BY uid, d)",
    "bronze",
)

_SILVER = """
SELECT b.eid, b.id AS bronze_id, b.listing_id, {name} AS listing_name, b.url, {description} AS description,
  coalesce(b.pets, true) AS pets, coalesce(b.rooms, 0) AS rooms, coalesce(b.bedrooms, 0) AS bedrooms,
  coalesce(b.bathrooms, 0) AS bathrooms,
  coalesce(b.street, 'unknown') AS street, coalesce(b.locality, 'unknown') AS locality,
  coalesce(b.region, 'unknown') AS region, coalesce(b.country, 'unknown') AS country,
  b.size, coalesce(b.size_unit, 'unknown') AS size_unit, b.images, b.n_amenities, b.amenity_1, b.amenity_2, b.props,
  b.price, coalesce(b.currency, 'unknown') AS currency, coalesce(b.availability, 'unknown') AS availability,
  coalesce(b.fee_name, 'unknown') AS fee_name, coalesce(b.fee, 0) AS fee,
  CASE WHEN b.fee_unit LIKE 'BRL%' THEN 'BRL' ELSE 'unknown' END AS fee_currency,
  CASE WHEN b.fee_unit LIKE '%/%' THEN split_part(b.fee_unit, '/', 2) ELSE 'unknown' END AS fee_period,
  b.site, b.city, b.kind, b.page, b.d
FROM {source} b
SEMI JOIN (
  SELECT arg_min(eid, {{'r': CASE site WHEN 'vivareal' THEN 1 WHEN 'zapimoveis' THEN 2 ELSE 3 END,
                      't': -epoch_us(ts), 'i': id}}) AS eid
  FROM {source}
  WHERE url IS NOT NULL AND size IS NOT NULL AND price IS NOT NULL
  GROUP BY d, coalesce(street, 'unknown'), kind, round(size), round(price),
    coalesce(rooms, 0), coalesce(bedrooms, 0), coalesce(bathrooms, 0)
) w ON w.eid = b.eid
"""
for _name, _source in (("silver", "bronze"), ("silver_u", "bronze_u")):
    part(
        _name,
        _SILVER.format(
            source=_source,
            name=initcap("coalesce(b.name, 'unknown')"),
            description=initcap("coalesce(b.description, 'unknown')"),
        ),
        _source,
    )
ADDRESS_SK = md5key("street", "locality", "region", "country")
IMAGES_SK = "md5(CAST(to_json(images) AS VARCHAR))"

for _name, _source in (("features", "silver"), ("features_u", "silver_u")):
    part(
        _name,
        f"""
SELECT listing_id, d, bronze_id, amenity_1 AS aname, props AS avalue FROM {_source} WHERE n_amenities >= 1
UNION ALL
SELECT listing_id, d, bronze_id, amenity_2, props FROM {_source} WHERE n_amenities = 2
""",
        _source,
    )
for _name, _source in (("pictures", "silver"), ("pictures_u", "silver_u")):
    part(
        _name,
        f"SELECT listing_id, d, bronze_id, {IMAGES_SK} AS images_sk, unnest(images) AS image_url FROM {_source}",
        _source,
    )
for _name, _source, _features in (("fact", "silver", "features"), ("fact_u", "silver_u", "features_u")):
    part(
        _name,
        f"""
SELECT s.bronze_id, s.listing_id, {ADDRESS_SK} AS address_sk, {IMAGES_SK} AS images_sk,
  coalesce((SELECT list_sort(list_distinct(list({md5key('f.aname', 'f.avalue')})))
            FROM {_features} f WHERE f.listing_id = s.listing_id AND f.d = s.d), []) AS sks,
  s.site, s.city, s.kind, s.page, s.d, s.pets, s.rooms, s.bedrooms, s.bathrooms, s.size, s.price,
  CASE WHEN s.fee_name = 'Condominium Fee' THEN s.fee ELSE 0.0 END AS condo_fee
FROM {_source} s
WHERE s.currency = 'BRL' AND s.size_unit = 'M2'
""",
        _features,
    )
for _suffix in ("", "_u"):
    part(f"last_day{_suffix}", f"SELECT max(d) AS d FROM silver{_suffix}", f"silver{_suffix}")
part("day_1", "SELECT max(d) AS d FROM silver_u WHERE d < (SELECT d FROM last_day_u)", "last_day_u")
part("day_2", "SELECT max(d) AS d FROM silver_u WHERE d < (SELECT d FROM day_1)", "day_1")
