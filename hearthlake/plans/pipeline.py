"""The jobs in order: pages -> snapshots -> bronze -> silver -> gold."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake import schemas as S
from hearthlake.operators import extract, paging
from hearthlake.operators.merge import conform, merged_schema, require_mergeable
from hearthlake.operators.pick import first_per_key
from hearthlake.params import RunParams
from hearthlake.plans import bronze as bronze_plan
from hearthlake.plans.dimensions import ALL, Dimension
from hearthlake.plans.fact import fact_listings
from hearthlake.plans.keyed import KeyedTable
from hearthlake.plans.silver import silver_listings
from hearthlake.session import Staging
from hearthlake.sources import snapshots as snapshot_source
from hearthlake.sources.landed import LandedIndex
from hearthlake.sources.pages import url_lineage
from hearthlake.sources.tables import ROWS, Lake, counted_nulls, latest_date_with
from hearthlake.sources.versions import NULL_FOLDER, Version, unescaped

BRONZE_TABLE = "bronze_listings"
QUARANTINE_TABLE = "bronze_quarantine"
#: Buckets of a date and city in silver and the fact.
BUCKETS = 4
#: The ledger, kept with bronze: loaded snapshots and how many listings each gave.
LOADS = "loads"
#: Whether a row of a load is for the quarantine; loads are written once, divided by it.
_REJECTED = "REJECTED"
_BRONZE_CLUSTER = ("SRC_SITE_NAME", "SRC_CITY_NAME", "SRC_PROPERTY_TYPE_CAT", "SRC_PAGE_NUM")


def in_scope(df: DataFrame, params: RunParams) -> DataFrame:
    """Pages or snapshots of the searches this run asks for."""
    wanted = (
        (F.col("city") == params.city)
        & F.col("site").isin(*params.sites)
        & F.col("property_type").isin(*params.property_types)
    )
    if "environment" in df.columns:
        wanted &= F.col("environment") == params.environment
    return df.where(wanted)


def land_snapshots(pages: DataFrame, root: str, params: RunParams, stage: Staging) -> DataFrame:
    """Pages -> snapshot rows, written unless it is a dry run.

    The extraction is kept, so HTML is parsed once: the search bounds read its
    narrow columns, the snapshots its listings. The bounds are kept too, so the
    planner knows their size and broadcasts them where they are small, instead of
    shuffling the listings.
    """
    wanted = paging.page_bounds(in_scope(url_lineage(pages), params), params.start_page, params.max_page)
    extracted = stage.keep(extract.keep_last_per_id(extract.extract_pages(wanted)), "extracted")
    usable = F.col("status") == extract.OK
    bounds = stage.keep(paging.first_missing_page(extracted, paging.SEARCH, params.start_page, usable), "bounds")
    kept = paging.before_first_missing(extracted, bounds, paging.SEARCH, params.start_page)
    rows = snapshot_source.snapshot_rows(kept, params.environment, params.run_ts)
    if params.write_snapshots:
        snapshot_source.write_snapshots(rows, root)
        snapshot_source.write_quarantine(snapshot_source.listings_without_id(kept, params.environment, params.run_ts), root)
    return rows


def chosen_snapshots(lake: Lake, paths: DataFrame, params: RunParams, file_date: date | str | None = None) -> DataFrame:
    """Snapshots to load. What is loaded already is read from the ledger (of the date), not from bronze."""
    loaded = None
    if lake.exists(BRONZE_TABLE, LOADS):
        partition = S.BRONZE_PARTITION if file_date is not None else None
        loaded = lake.read(BRONZE_TABLE, partition, file_date, section=LOADS).select("blob")
    return bronze_plan.select_snapshots(paths, loaded, params.start_page, params.max_page).select("blob")


def load_bronze(
    lake: Lake,
    snapshots: DataFrame,
    params: RunParams,
    stage: Staging,
    paths: DataFrame | None = None,
    file_date: date | str | None = None,
) -> DataFrame:
    """Append the snapshots bronze does not hold yet; returns their rows, which a
    dry run does not write.

    ``paths`` lists the snapshots without their payloads, where that is cheaper to
    get than from ``snapshots``. ``file_date`` is their date, if it is one.
    Listings the table does not take go to the quarantine table, with their reason. A
    chosen snapshot that cannot be read stops the load before anything is committed,
    unless the run says that it is to be noted there too. Rows and rejects are written
    once, in one pass, in which NULLs in the declared table's NOT NULL columns are counted; rows and
    the ledger's entries are committed together, so a load that is repeated adds nothing.
    """
    paths = snapshots.drop("payload") if paths is None else paths
    # Kept so that its true size decides how the payloads are matched.
    chosen = stage.keep(chosen_snapshots(lake, paths, params, file_date), "chosen")
    every = bronze_plan.with_partition(bronze_plan.raw_bronze_rows(snapshots, chosen, params.run_ts, params.version))
    if not params.write_bronze:
        every = stage.keep(every, "bronze")
        _stop_at_unreadable(bronze_plan.rejected(every), params)
        return bronze_plan.loadable(every).drop(S.BRONZE_PARTITION)

    log, lost = lake.log(BRONZE_TABLE), F.col(bronze_plan.REASON).isNotNull()
    divided = every.withColumn(_REJECTED, lost)
    required = [f.name for f in S.BRONZE if not f.nullable]
    checked, nulls = counted_nulls(divided, required, among=~lost)
    write = lake.write_aside(checked, BRONZE_TABLE, (_REJECTED, S.BRONZE_PARTITION), _BRONZE_CLUSTER)
    parts = log.parts_in(write, 1)
    if not parts:
        log.discard(write)
        return lake.spark.createDataFrame([], S.BRONZE)
    lake.refuse_nulls(BRONZE_TABLE, write, nulls)
    loaded = lake.read_aside(BRONZE_TABLE, write, T.StructType([*divided.schema.fields]))
    rejects = bronze_plan.rejected(loaded.where(_REJECTED)) if f"{_REJECTED}=true" in parts else None
    if rejects is not None:
        try:
            _stop_at_unreadable(rejects, params)
        except bronze_plan.UnreadableSnapshotError:
            log.discard(write)
            raise
        quarantine(lake, rejects)
        log.discard(f"{write}/{_REJECTED}=true")
    lake.ensure(BRONZE_TABLE, S.BRONZE, S.BRONZE_PARTITION)
    rows = loaded.where(~F.col(_REJECTED))
    if f"{_REJECTED}=false" in parts:
        entries = rows.groupBy(F.col("SRC_BLOB").alias("blob"), S.BRONZE_PARTITION).agg(F.count("*").alias("listings"))
        entries = entries.withColumn("loaded_at", F.lit(str(params.run_ts)).cast("timestamp"))
        ledger = lake.write_aside(entries, BRONZE_TABLE, S.BRONZE_PARTITION, ("blob",))
        table = T.StructType([*S.BRONZE.fields, T.StructField(S.BRONZE_PARTITION, T.DateType())])
        lake.add(
            BRONZE_TABLE,
            {
                ROWS: (write, f"{write}/{_REJECTED}=false", S.BRONZE_PARTITION, table),
                LOADS: (ledger, ledger, S.BRONZE_PARTITION, entries.schema),
            },
        )
    return rows.select(*S.BRONZE.fieldNames())


def _stop_at_unreadable(rejects: DataFrame, params: RunParams) -> None:
    if params.on_unreadable == "raise":
        broken = rejects.where(F.col(bronze_plan.REASON) == bronze_plan.UNREADABLE).select("SRC_BLOB").head(3)
        if broken:
            raise bronze_plan.UnreadableSnapshotError(", ".join(r[0] for r in broken))


def quarantine(lake: Lake, lost: DataFrame) -> None:
    """Note rejected listings, each once however often its snapshot is looked at. What is noted already is
    looked up among the rejects of the same snapshots' dates only."""
    keys = ["SRC_BLOB", "LISTING_KEY", bronze_plan.REASON]
    if lake.exists(QUARANTINE_TABLE):
        dates = [r[0] for r in lost.select(S.BRONZE_PARTITION).distinct().collect()]  # one per date of the load
        known = lake.read(QUARANTINE_TABLE, **{S.BRONZE_PARTITION: dates}).select(*keys).alias("k")
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys]
        lost = lost.alias("l").join(known, same, "left_anti")
    if not lost.isEmpty():
        lake.append(lost, QUARANTINE_TABLE, S.BRONZE_PARTITION, ("SRC_BLOB",))


def first_row(columns: Sequence[str], params: RunParams) -> list[Column] | None:
    """The order that settles a repeated key, if the run asks for one."""
    if params.on_duplicate == "raise":
        return None
    lead = [c for c in ("PAGE", "BRONZE_ID") if c in columns]
    return [F.col(c).asc_nulls_last() for c in [*lead, *[c for c in columns if c not in lead]]]


def upsert_plan(lake: Lake, source: DataFrame, spec: S.TableSpec, base: Version, parts: Sequence[str], on_duplicate: Sequence[Column] | None = None) -> DataFrame:
    """A stored source and, of the parts that it touches, the rows whose keys it lacks.

    A part is a date and a city, in buckets of the key. The source is dealt into the same buckets, so that the rows
    that are there already are compared, and written again, without being moved; its keys are dealt once for all parts.
    """
    bucket, n = base.section(ROWS).notes["buckets"]
    claimed = source.select(*spec.keys).repartition(n, *bucket)
    new = source if on_duplicate is None else first_per_key(source, spec.keys, on_duplicate)
    kept = [lake.read_bucketed(spec.name, part, base).join(claimed, [*spec.keys], "left_anti") for part in parts]
    schema = merged_schema(T.StructType.fromJson(json.loads(base.section(ROWS).schema)), source.schema)
    return reduce(DataFrame.unionByName, [conform(rows, schema) for rows in [*kept, new.repartition(n, *bucket)]])


def store(lake: Lake, rows: DataFrame, spec: S.TableSpec) -> None:
    """Writes whole parts (dates and cities), in the table's buckets; parts of the same name are replaced."""
    base = lake.version(spec.name)
    buckets = base.section(ROWS).notes.get("buckets") or [[*spec.bucket], BUCKETS]
    write = lake.write_aside(rows, spec.name, spec.folders, spec.cluster, buckets)
    lake.replace(spec.name, write, spec.folders, rows.schema, base, notes={"buckets": buckets})


def _touched(source: DataFrame, spec: S.TableSpec) -> list[str]:
    """Parts that the source has rows for: one per date and city of the run."""
    folders = spec.folders
    name = lambda c: F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER)))
    return [r[0] for r in source.select(F.concat_ws("/", *[name(c) for c in folders])).distinct().collect()]


def upsert_date(
    lake: Lake,
    rows: DataFrame,
    spec: S.TableSpec,
    file_date: date | str,
    stage: Staging,
    on_duplicate: Sequence[Column] | None = None,
) -> None:
    """Merge one date's rows into a table with a folder per date and city.

    Only the cities of the run are rewritten, and other cities of the date in which one of its keys
    was listed before; runs of different cities do not wait for each other. A repeated key that would
    update one row twice is an error, unless ``on_duplicate`` says which row comes first.
    """
    base = lake.version(spec.name)
    there = base.section(ROWS).matching(**{spec.partition: [file_date]})
    if not there:
        store(lake, rows, spec)
        return
    source = stage.keep(rows, spec.name)
    own, wanted = {unescaped(p): p for p in there}, set(_touched(source, spec))
    held = [lake.read_bucketed(spec.name, p, base).select(*spec.keys, F.lit(p).alias("_part")) for p in there]
    keys, n = base.section(ROWS).notes["buckets"]
    claimed = source.select(*spec.keys).repartition(n, *keys)
    hit = stage.keep(reduce(DataFrame.unionByName, [h.join(claimed, [*spec.keys], "left_semi") for h in held]), "held")
    if on_duplicate is None:
        require_mergeable(hit, source, spec.keys)
    elsewhere = {r[0] for r in hit.select("_part").distinct().collect()}
    parts = sorted(elsewhere | {p for name, p in own.items() if name in wanted})
    merged = upsert_plan(lake, source, spec, base, parts, on_duplicate)
    write = lake.write_aside(merged, spec.name, spec.folders, spec.cluster, (keys, n), spread=False)
    lake.replace(spec.name, write, spec.folders, merged.schema, base, emptied=parts)


def build_silver(lake: Lake, params: RunParams, stage: Staging) -> None:
    rows = silver_listings(
        lake.read(BRONZE_TABLE, S.BRONZE_PARTITION, params.file_date),
        params.run_ts,
        city=params.city,
        sites=params.sites,
        property_types=params.property_types,
    )
    upsert_date(lake, rows, S.SILVER, params.file_date, stage, first_row(S.SILVER_COLUMNS, params))


def build_dimension(lake: Lake, dim: Dimension, params: RunParams, stage: Staging) -> None:
    """A dimension's first load, or its next version from the latest scrape."""
    name, partition, table = S.SILVER.name, S.SILVER.partition, KeyedTable(lake, dim.spec)
    if not table.exists():
        table.create(dim.full(lake.read(name), params.run_ts))
        return
    # No date at all has any: the latest scrape is empty and every key vanished.
    newest = latest_date_with(lake, name, partition, dim.counts)
    latest = dim.rows_of(lake.read(name, partition, newest))
    order = first_row(latest.columns, params)
    latest = latest if order is None else first_per_key(latest, dim.spec.keys, order)
    table.merge(stage.keep(latest, dim.spec.name), params.run_ts, stage)


def build_fact(lake: Lake, params: RunParams, stage: Staging) -> None:
    silver = lake.read(S.SILVER.name, S.SILVER.partition, params.file_date)
    upsert_date(lake, fact_listings(silver, params.run_ts), S.FACT, params.file_date, stage, first_row(S.FACT_COLUMNS, params))


def load_landed(lake: Lake, root: str, params: RunParams, stage: Staging, layout: str = "table") -> DataFrame:
    """Bronze load of one date from either snapshot layout.

    ``files``: one JSON file per page and run, below the folders of the searches
    asked for; folders that changed since the last load are listed without opening files, and the
    date's files are read by name (a dry run, which writes no index, lists all). ``table``: as
    written by ``land_snapshots``.
    """
    spark, day = lake.spark, params.file_date
    if layout == "table":
        snapshots = in_scope(snapshot_source.scan_snapshot_table(spark, root, day), params)
        return load_bronze(lake, snapshots, params, stage, file_date=day)
    folders = snapshot_source.search_folders(
        spark, root, params.environment, params.city, params.sites, params.property_types
    )
    if not folders:
        return spark.createDataFrame([], S.BRONZE)
    if params.write_bronze:
        index = LandedIndex(lake, root)
        index.refresh(folders)
        folders = index.paths(folders, day)
        if not folders:
            return spark.createDataFrame([], S.BRONZE)
    snapshots = snapshot_source.scan_snapshots(spark, folders, day)
    paths = snapshot_source.list_snapshots(spark, folders, day)
    return load_bronze(lake, snapshots, params, stage, paths, day)


def build_gold(lake: Lake, params: RunParams, stage: Staging) -> None:
    """The dimensions and the fact. They read silver only, so one that fails does not
    hold back the others; what failed is raised at the end."""
    failed = []
    for build in [*[lambda d=d: build_dimension(lake, d, params, stage) for d in ALL], lambda: build_fact(lake, params, stage)]:
        try:
            build()
        except Exception as error:  # noqa: BLE001  (all are raised below)
            failed.append(error)
    if len(failed) == 1:
        raise failed[0]
    if failed:
        raise ExceptionGroup("gold models failed", failed)


def run(lake: Lake, pages: DataFrame | None, snapshot_root: str, params: RunParams, layout: str = "table") -> None:
    """All layers for one run. Without ``pages`` it starts from landed snapshots.

    Every step can be repeated: snapshots are skipped once loaded, dates are merged
    by key, dimensions get a new version. A failed run is simply run again.
    """
    with Staging(lake.spark) as stage:
        if pages is not None:
            land_snapshots(pages, snapshot_root, params, stage)
        load_landed(lake, snapshot_root, params, stage, layout)
        build_silver(lake, params, stage)
        build_gold(lake, params, stage)


def open_views(lake: Lake) -> list[str]:
    """Make the lake's tables readable by name in SQL; returns the names."""
    names = []
    for name in (BRONZE_TABLE, S.SILVER.name, S.FACT.name):
        if lake.exists(name):
            lake.read(name).createOrReplaceTempView(name)
            names.append(name)
    for dim in ALL:
        current = lake.current(dim.spec.name)
        if current is not None:
            current.createOrReplaceTempView(dim.spec.name)
            names.append(dim.spec.name)
    return names
