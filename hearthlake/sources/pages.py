"""Landed search-result pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Where each site puts the parts of a search in its URLs, as
# (position in the path, pattern). Path parts count from 0 and "aluguel" is part 0.
URL_LAYOUT = {
    "vivareal": {"state": (1, "^(.+)$"), "city": (2, "^(.+)$"), "slug": (3, "^(.+)$")},
    "zapimoveis": {"slug": (1, "^(.+)$"), "state": (2, r"^([^+]+)\+"), "city": (2, r"\+(.+)$")},
}
URL_ROOT = "aluguel"
PAGE_PARAMETER = "pagina"
SITE_HOST = r"^www\.([^.]+)\.com\.br$"

# Each site's word for a property type.
TYPE_SLUGS = {
    ("vivareal", "apartamento_residencial"): "apartment",
    ("vivareal", "casa_residencial"): "house",
    ("zapimoveis", "apartamentos"): "apartment",
    ("zapimoveis", "casas"): "house",
}


def scan_raw_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """(page_id, url, html) of every landed page.

    Tasks follow the file splits (``spark.sql.files.maxPartitionBytes``);
    ``partitions`` deals the pages out anew, for few files and many cores.
    """
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return pages if partitions is None else pages.repartition(partitions)


def url_lineage(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add site, state, city, property_type and page read from the page's URL.

    Parts an URL does not have are NULL. The page defaults to 1. The few slugs
    are a literal map, so no join is needed.
    """
    parts = F.split(F.trim(F.try_parse_url(F.col(url), F.lit("PATH")), F.lit("/")), "/")
    site = F.regexp_extract(F.try_parse_url(F.col(url), F.lit("HOST")), SITE_HOST, 1)
    page = F.try_parse_url(F.col(url), F.lit("QUERY"), F.lit(PAGE_PARAMETER))
    slugs = F.create_map(
        *[F.lit(x) for (s, slug), kind in TYPE_SLUGS.items() for x in (f"{s}/{slug}", kind)]
    )

    def part(name: str) -> Column:
        value = F.lit(None).cast("string")
        for known, layout in URL_LAYOUT.items():
            position, pattern = layout[name]
            read = F.nullif(F.regexp_extract(F.get("_parts", F.lit(position)), pattern, 1), F.lit(""))
            value = F.when(F.col("site") == known, read).otherwise(value)
        return F.when(F.get("_parts", F.lit(0)) == URL_ROOT, value)

    return (
        pages.withColumns({"_parts": parts, "site": F.when(site.isin(*URL_LAYOUT), site)})
        .withColumns({"state": part("state"), "city": part("city"), "_slug": part("slug")})
        .withColumn("property_type", F.try_element_at(slugs, F.concat("site", F.lit("/"), "_slug")))
        .withColumn("page", F.coalesce(page.try_cast("bigint"), F.lit(1).cast("bigint")))
        .drop("_parts", "_slug")
    )
