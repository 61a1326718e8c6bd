"""Page snapshots: one JSON object ``{listing id: listing}`` per page and run.

Two layouts hold the same thing and scan to the same columns
(``blob``, ``payload``, ``modified_ts`` and the parts of the path):

* files  ``env/site/city/property_type/page/<run time>.json``, as scrapers land them;
* a table with a folder per date, search and run, as written here. A directory per
  page would mean one tiny file per page. Parquet by default, so that choosing paths
  does not read the payloads; JSON lines on request.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import date, datetime
from itertools import chain
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.functions import member, parse_json_strict, parse_stem_ts
from hearthlake.operators.extract import OK, explode_listings, split_by_id
from hearthlake.operators.scd import as_ts
from hearthlake.sources.tables import clustered, path_exists

#: What the table is partitioned by: a run of one search lies in one folder.
RUN_KEYS = ("file_date", "environment", "site", "city", "property_type", "run")
TABLE_COLUMNS = (
    "page bigint, blob string, payload string, "
    "file_date date, environment string, site string, city string, property_type string, run string"
)
#: Listings that no snapshot can hold, below the snapshots; readers pass over it.
QUARANTINE = "_quarantine"
QUARANTINE_COLUMNS = TABLE_COLUMNS.replace("payload string", "pos int, listing string, reason string")


def path_lineage(df: DataFrame, blob: str = "blob") -> DataFrame:
    """Add environment, site, city, property_type, page, executed_at and file_date
    read from a snapshot path. A file name that is no run time gives NULL times."""
    parts = F.split(blob, "/")
    at = lambda i: F.try_element_at(parts, F.lit(i))
    stem = F.regexp_replace(at(-1), r"\.[^.]*$", "")
    return df.withColumns(
        {
            "environment": at(-6),
            "site": at(-5),
            "city": at(-4),
            "property_type": at(-3),
            "page": at(-2).try_cast("bigint"),
            "executed_at": parse_stem_ts(stem),
        }
    ).withColumn("file_date", F.to_date("executed_at"))


def search_folders(
    spark: SparkSession, root: str, environment: str, city: str, sites: Sequence[str], property_types: Sequence[str]
) -> list[str]:
    """Folders of the landed layout that these searches have."""
    wanted = [f"{root}/{environment}/{site}/{city}/{kind}" for site in sites for kind in property_types]
    return [folder for folder in wanted if path_exists(spark, folder)]


def _files(
    spark: SparkSession, root: str | list[str], fmt: str, file_date: date | str | None, extension: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    stem = f"{file_date}T*" if file_date else "*"
    reader = spark.read.options(**(options or {})).format(fmt).option("recursiveFileLookup", True).option("pathGlobFilter", f"{stem}.{extension}")
    return (reader.option("wholetext", True) if fmt == "text" else reader).load(root)


_LAST_SIX = r"((?:[^/]+/){5}[^/]+)$"


def _blob() -> Column:
    """The last six parts of the file's path, as they were named (the path is an URL)."""
    encoded = F.regexp_extract("_metadata.file_path", _LAST_SIX, 1)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


#: Folders below which tasks are dealt out anew, and bytes of content handed on at once.
SPREAD, HANDED_ON = 1000, 4_000_000


def _mounted(spark: SparkSession, roots: Sequence[str], extension: str, options: Mapping[str, str]) -> list[str] | None:
    """The roots as local paths where tasks can list and read them themselves: plain files and folders that
    are there, in the local or a mounted file system. None for what only Spark's reader knows: other stores, patterns,
    compressed files, options of the reader; missing roots are its error."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    plain = not any(c in text for text in (*roots, extension) for c in "*?[]{}\\") and all(key.startswith("fs.file.") for key in options)
    if not roots or not plain or jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(jvm.org.apache.hadoop.fs.Path(f"x.{extension}")):
        return None
    paths = [jvm.org.apache.hadoop.fs.Path(root) for root in roots]
    file_system = jvm.org.apache.hadoop.fs.FileSystem
    if any((path.toUri().getScheme() or file_system.getDefaultUri(conf).getScheme()) != "file" for path in paths):
        return None
    local = dict.fromkeys(path.toUri().getPath() for path in paths)
    apart = not any(str(above) in local for path in local for above in PurePosixPath(path).parents)
    return list(local) if apart and all(os.path.isabs(path) and os.path.exists(path) for path in local) else None


def _wanted(path: str, names: tuple[str, str]) -> bool:
    """Whether a file is read: its name has the wanted start and end, and is none that Spark's readers pass over."""
    name = os.path.basename(path)
    return not _hidden(name) and name.startswith(names[0]) and name.endswith(names[1])


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _children(folder: str, names: tuple[str, str]) -> tuple[list[str], list[str]]:
    """(folders, files by the wanted start and end of their names) in a folder."""
    folders, files = [], []
    with os.scandir(folder) as entries:
        for entry in entries:
            if not entry.is_dir():
                files += [entry.path] * _wanted(entry.name, names)
            elif not _hidden(entry.name) or entry.name.startswith(("_metadata", "_common_metadata")):
                folders.append(entry.path)
    return folders, files


def _walk(names: tuple[str, str], most: float, levels: float, batches: Iterable) -> Iterator:
    """Files as they are, folders as the files below them. Folders that are ``levels`` deeper, or wait when ``most`` do, are handed on as folders."""
    import pyarrow as pa

    batch = lambda paths, is_file: pa.RecordBatch.from_pydict({"path": paths, "is_file": pa.array([is_file] * len(paths), pa.bool_())})
    for given in batches:
        rows = list(zip(*(given[c].to_pylist() for c in ("path", "is_file")), strict=True))
        yield batch(pa.array([path for path, is_file in rows if is_file], pa.string()), True)
        waiting, depth = [path for path, is_file in rows if not is_file], 0
        while waiting and depth < levels:
            deeper: list[str] = []
            for i, folder in enumerate(waiting):
                if len(waiting) - i + len(deeper) >= most:
                    break
                folders, files = _children(folder, names)
                deeper += folders
                for at in range(0, len(files), 10_000):
                    yield batch(pa.array(files[at : at + 10_000], pa.string()), True)
            else:
                waiting, depth = deeper, depth + 1
                continue
            waiting = [*waiting[i:], *deeper]
            break
        for at in range(0, len(waiting), 10_000):
            yield batch(pa.array(waiting[at : at + 10_000], pa.string()), False)


def _read(batches: Iterable) -> Iterator:
    """path, ms of the last change and content of files that are not empty."""
    import pyarrow as pa

    kinds = pa.schema([("path", pa.string()), ("ms", pa.int64()), ("content", pa.binary())])
    rows: list[tuple] = []
    size = 0
    for path in chain.from_iterable(batch["path"].to_pylist() for batch in batches):
        with open(path, "rb", buffering=0) as file:
            ms, content = os.fstat(file.fileno()).st_mtime_ns // 1_000_000, file.readall()
        if content:
            rows.append((path, ms, content))
            size += len(content)
        if size >= HANDED_ON:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)


def _mounted_files(spark: SparkSession, roots: list[str], file_date: date | str | None, extension: str) -> DataFrame:
    """path, ms and content of the files below some roots, listed and read by tasks when rows are asked for.

    Spark's file source lists on the driver, which then holds every file, starts thousands of tasks to list folders
    and counts a file as 4 MB, so that a task reads a few small files. Here folders are dealt out, listed, and dealt out once
    more as they get many, then the files.
    """
    names, parts = (f"{file_date}T" if file_date else "", f".{extension}"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = [(root, os.path.isfile(root)) for root in roots]
    rows = spark.createDataFrame([g for g in given if not g[1] or _wanted(g[0], names)], "path string, is_file boolean")
    for most, levels in ((SPREAD, float("inf")), (float("inf"), 1), (float("inf"), float("inf"))):
        rows = rows.mapInArrow(lambda b, m=most, n=levels: _walk(names, m, n, b), rows.schema).repartition(parts)
    return rows.mapInArrow(_read, "path string, ms bigint, content binary")


def list_snapshots(
    spark: SparkSession, root: str | list[str], file_date: date | str | None = None, extension: str = "json"
) -> DataFrame:
    """Snapshot files without their content (no file is opened)."""
    files = _files(spark, root, "binaryFile", file_date, extension)
    return path_lineage(files.select(_blob().alias("blob"), F.col("modificationTime").alias("modified_ts")))


def scan_snapshots(
    spark: SparkSession, root: str | list[str], file_date: date | str | None = None, extension: str = "json", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Snapshot files with their content, those of one date if given. ``options`` go to the reader and its file system.

    Below local and mounted roots the files are those that are there when rows are asked for, else those
    that are there now.
    """
    roots = [root] if isinstance(root, str) else root
    local = _mounted(spark, roots, extension, options or {})
    if local:
        files = _mounted_files(spark, local, file_date, extension)
        read = files.select(
            F.regexp_extract("path", _LAST_SIX, 1).alias("blob"),
            F.col("content").cast("string").alias("payload"),
            F.timestamp_millis("ms").alias("modified_ts"),
        )
    else:
        files = _files(spark, root, "text", file_date, extension, options)
        read = files.select(_blob().alias("blob"), F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("modified_ts"))
    return path_lineage(read)


def scan_snapshot_table(
    spark: SparkSession, root: str, file_date: date | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Snapshots written by ``write_snapshots``. Date, environment, site, city and
    property type are folders, so a filter on them prunes."""
    table = spark.read.schema(TABLE_COLUMNS).format(fmt).load(root)
    if file_date:
        table = table.where(F.col("file_date") == F.lit(str(file_date)).cast("date"))
    return table.select(
        "blob",
        "payload",
        F.col("_metadata.file_modification_time").alias("modified_ts"),
        "environment",
        "site",
        "city",
        "property_type",
        "page",
        parse_stem_ts(F.col("run")).alias("executed_at"),
        "file_date",
    )


def _place(environment: str, run_ts: datetime | str) -> list[Column]:
    """Date, search, page and path of a page's snapshot."""
    stem = F.date_format(as_ts(run_ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    folder = F.concat_ws("/", F.lit(environment), "site", "city", "property_type", F.col("page").cast("string"))
    return [
        F.to_date(as_ts(run_ts)).alias("file_date"),
        F.col("site"),
        F.col("city"),
        F.col("property_type"),
        F.col("page").cast("bigint").alias("page"),
        F.concat(folder, F.lit("/"), stem, F.lit(".json")).alias("blob"),
    ]


def snapshot_rows(extracted: DataFrame, environment: str, run_ts: datetime | str) -> DataFrame:
    """One snapshot per good page, its listings keyed by id (ids unique per page).
    Listings without an id are in ``listings_without_id``."""
    keyed = F.filter("elements", lambda e: e["id"].isNotNull())
    as_object = F.map_from_entries(F.transform(keyed, lambda e: F.struct(e["id"], e["item"])))
    return extracted.where(F.col("status") == OK).select(*_place(environment, run_ts), F.to_json(as_object).alias("payload"))


def listings_without_id(extracted: DataFrame, environment: str, run_ts: datetime | str) -> DataFrame:
    """The listings of good pages that a snapshot cannot key, with their page and position."""
    _, lost = split_by_id(explode_listings(extracted.where(F.col("status") == OK)))
    return lost.select(*_place(environment, run_ts), "pos", F.to_json("listing").alias("listing"), F.lit("no id").alias("reason"))


def _keyed_by_run(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"environment": F.split_part("blob", F.lit("/"), F.lit(1)), "run": F.regexp_extract("blob", r"([^/]+)\.[^./]*$", 1)}
    )


def _replace_runs(rows: DataFrame, root: str, fmt: str) -> None:
    clustered(rows, RUN_KEYS, ("page",)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *RUN_KEYS
    ).format(fmt).save(root)


def write_snapshots(rows: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Write snapshots; one that lies there under the same path is replaced.

    Only the folders of the rows' own runs are read and written again, so a step that
    is repeated leaves each snapshot once. ``rows`` is used more than once.
    """
    new = _keyed_by_run(rows)
    spark = rows.sparkSession
    if path_exists(spark, root):
        old = spark.read.schema(TABLE_COLUMNS).format(fmt).load(root)
        same_run = old.join(new.select(*RUN_KEYS).distinct(), list(RUN_KEYS), "left_semi")
        new = new.unionByName(same_run.join(new.select("blob"), "blob", "left_anti"))
    _replace_runs(new, root, fmt)


def write_quarantine(lost: DataFrame, root: str) -> None:
    """Write the listings that no snapshot holds; those of a repeated run are replaced."""
    _replace_runs(_keyed_by_run(lost), f"{root}/{QUARANTINE}", "parquet")


def scan_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The listings that no snapshot holds; none where every listing had an id (there is no file to read columns from)."""
    return spark.read.schema(QUARANTINE_COLUMNS).parquet(f"{root}/{QUARANTINE}")


def _entries() -> Column:
    """The payload's listings by key; NULL where it is not exactly one JSON object."""
    return member(F.get(parse_json_strict(F.array("payload")), F.lit(0)), "$", "map<string,variant>")


def parse_snapshot_json(snapshots: DataFrame) -> DataFrame:
    """One row per listing of a snapshot: its key and the raw listing. A payload
    that is no JSON object gives no rows; see ``parse_snapshots``."""
    keep = [c for c in snapshots.columns if c != "payload"]
    return snapshots.select(*keep, F.explode(_entries()).alias("listing_key", "listing"))


def parse_snapshots(snapshots: DataFrame) -> DataFrame:
    """``parse_snapshot_json`` plus ``readable``: a payload that is not exactly one
    JSON object gives a single row without a listing that is not readable."""
    keep = [c for c in snapshots.columns if c != "payload"]
    parsed = snapshots.withColumn("_entries", _entries())
    rows = parsed.select(
        *keep, F.col("_entries").isNotNull().alias("readable"), F.explode_outer("_entries").alias("listing_key", "listing")
    )
    return rows.where("listing_key is not null or not readable")
