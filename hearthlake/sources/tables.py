"""Parquet tables of the lake.

Tables are sets of parts (a date, a date and city, a bucket of keys), each a folder below the
write that brought it. Appending adds folders, a merge replaces parts; what counts is switched
by one version file (see ``versions``), so readers see all parts of a write or none.
Tables that are replaced as a whole have complete numbered folders; the highest finished one is current.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.sources.versions import Section, TableLog, Version, values_of

ROWS = "rows"
_BUCKET = "_bucket"


class BrokenConstraintError(ValueError):
    """A write has rows that the declared table does not take; nothing of it was committed."""


def clustered(df: DataFrame, partition: str | Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Even files, sorted by the cluster columns so that readers skip row groups.

    Rows are dealt by the folder they go to, so that a write of many dates does not put
    a file of every task into every date; ``rebalance`` splits the tasks of an oversized
    date and joins small ones at run time.
    """
    folders = [partition] if isinstance(partition, str) else [*partition]
    return df.hint("rebalance", *folders).sortWithinPartitions(*folders, *cluster)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


#: The partition column of tables that are kept in buckets of keys.
BUCKET = "KEY_BUCKET"


def _names(partition: str | Sequence[str]) -> list[str]:
    return [partition] if isinstance(partition, str) else [*partition]


def _bloom(keys: Sequence[str]) -> dict[str, str]:
    """Writer options: a Bloom filter of each key in every row group, so that a lookup by key opens few of them.
    The cluster columns need none: rows are sorted by them, so least and greatest values tell row groups apart."""
    return {"parquet.bloom.filter.adaptive.enabled": "true", **{f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}}


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def counted_nulls(df: DataFrame, columns: Sequence[str], among=None) -> tuple[DataFrame, Observation | None]:
    """``df`` with the NULLs of some columns counted while it is written (only in rows that meet ``among``)."""
    if not columns:
        return df, None
    counted = F.lit(True) if among is None else among
    nulls = Observation()
    return df.observe(nulls, *[F.count_if(F.col(c).isNull() & counted).alias(c) for c in columns]), nulls


class Lake:
    """The tables of one environment below a root folder."""

    def __init__(self, spark: SparkSession, root: str, environment: str):
        self.spark = spark
        self.base = f"{root.rstrip('/')}/{environment}"

    # -- paths -------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _children(self, path: str) -> list[str]:
        fs, hadoop_path = _file_system(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []

    def _finished(self, path: str) -> bool:
        return path_exists(self.spark, f"{path}/_SUCCESS")

    def log(self, name: str) -> TableLog:
        return TableLog(self.spark, self.path(name))

    def version(self, name: str) -> Version:
        return self.log(name).latest()

    # -- tables of parts: reading --------------------------------------------
    def exists(self, name: str, section: str = ROWS) -> bool:
        return self.version(name).section(section).schema is not None

    def schema(self, name: str, section: str = ROWS) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.version(name).section(section).schema))

    def read(self, name: str, partition: str | None = None, value=None, section: str = ROWS, version: Version | None = None, **wanted: Iterable[object]) -> DataFrame:
        """The table, or the parts with a value in a partition column (``wanted``: one of several values).

        Only folders that the version names are listed. The columns are those of the last write:
        columns an old file lacks are NULL, columns it has beyond them are not read.
        """
        if partition is not None:
            wanted = {partition: [value], **wanted}
        own = (version or self.version(name)).section(section)
        return self._read(name, own, own.paths(own.matching(**wanted) if wanted else own.parts))

    def _read(self, name: str, section: Section, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(section.schema))
        if not folders:
            return self.spark.createDataFrame([], _nullable(schema))
        data = self.log(name).data
        reader = self.spark.read.schema(_nullable(schema)).option("basePath", data)
        return reader.parquet(*[f"{data}/{f}" for f in folders]).select(*schema.names)

    def read_bucketed(self, name: str, part: str, version: Version) -> DataFrame:
        """One part of a bucketed table, read by its buckets: joins on the bucket keys leave it where it is."""
        section = version.section(ROWS)
        (folder,), (keys, n) = section.parts[part], section.notes["buckets"]
        schema, values = T.StructType.fromJson(json.loads(section.schema)), values_of(part)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in values)
        by = ", ".join(f"`{k}`" for k in keys)
        own, place = f"part_{uuid.uuid4().hex}", f"{self.log(name).data}/{folder}/{part}".replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {own} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {n} BUCKETS LOCATION '{place}'")
        table = self.spark.table(own)
        self.spark.sql(f"DROP TABLE {own}")  # the files stay, the frame knows where they are
        fixed = {c: F.lit(v).cast(schema[c].dataType).alias(c) for c, v in values.items()}
        return table.select(*[fixed.get(c, F.col(f"`{c}`")) for c in schema.names])

    def partition_values(self, name: str, column: str) -> list[str]:
        """Values of a partition column, from the version file."""
        parts = self.version(name).section(ROWS).parts
        return sorted({v for p in parts if (v := values_of(p).get(column)) is not None})

    # -- tables of parts: writing --------------------------------------------
    def ensure(self, name: str, schema: T.StructType, partition: str | Sequence[str]) -> bool:
        """Declares an empty table unless it is there; its columns that are not nullable are checked by every append.
        True if it was created."""
        if self.exists(name):
            return False
        folders = _names(partition)
        kinds = {f.name: f.dataType for f in schema}
        full = T.StructType([*schema.fields, *[T.StructField(c, T.DateType()) for c in folders if c not in kinds]])
        declared = [f.name for f in schema if not f.nullable]
        self.log(name).commit(lambda v: v if v.section(ROWS).schema else v.with_section(ROWS, Section(full.json(), notes={"not_null": declared})))
        return True

    def write_aside(
        self, df: DataFrame, name: str, partition: str | Sequence[str], cluster: Sequence[str] = (), buckets: tuple[Sequence[str], int] | None = None, spread: bool = True
    ) -> str:
        """Writes rows where no reader looks yet; returns the write. ``buckets``: (keys, number), ``spread``: deal the rows anew first."""
        folders, log = _names(partition), self.log(name)
        write = log.new_write()
        if buckets is None:
            ready = clustered(df, folders, cluster) if spread else df
            ready.write.partitionBy(*folders).parquet(f"{log.data}/{write}")
            return write
        keys, n = buckets
        if spread:
            # One task has all of a bucket of a folder, or a share of it where that is large.
            df = df.withColumn(_BUCKET, F.pmod(F.hash(*keys), F.lit(n))).hint("rebalance", *folders, _BUCKET).drop(_BUCKET)
        own = f"write_{uuid.uuid4().hex}"
        order = [c for c in cluster if c not in folders] or list(keys)
        writer = df.write.format("parquet").options(**_bloom(keys)).option("path", f"{log.data}/{write}").partitionBy(*folders)
        writer.bucketBy(n, *keys).sortBy(*order).saveAsTable(own)
        self.spark.sql(f"DROP TABLE {own}")
        return write

    def read_aside(self, name: str, write: str, schema: T.StructType) -> DataFrame:
        """What a write brought, before it is committed."""
        data = self.log(name).data
        return self.spark.read.schema(_nullable(schema)).option("basePath", data).parquet(f"{data}/{write}").select(*schema.names)

    def append(self, df: DataFrame, name: str, partition: str, cluster: Sequence[str] = ()) -> None:
        """Adds rows. Where the table was declared with columns that are not nullable, the write counts their NULLs in
        passing, and is not committed if there are any."""
        section = self.version(name).section(ROWS)
        checked, nulls = counted_nulls(df, section.notes.get("not_null", []))
        write = self.write_aside(checked, name, partition, cluster)
        self.refuse_nulls(name, write, nulls)
        self.add(name, {ROWS: (write, write, partition, df.schema)})

    def refuse_nulls(self, name: str, write: str, nulls: Observation | None) -> None:
        found = {c: n for c, n in (nulls.get if nulls else {}).items() if n}
        if found:
            self.log(name).discard(write)
            raise BrokenConstraintError(f"{name}: NULL in " + ", ".join(f"{c} ({n} rows)" for c, n in sorted(found.items())))

    def add(self, name: str, writes: Mapping[str, tuple[str, str, str | Sequence[str], T.StructType]]) -> None:
        """Commits writes to sections of a table together: section -> (write, folder in it, partition, columns)."""
        log = self.log(name)
        found = {s: log.parts_in(folder, len(_names(partition))) for s, (_, folder, partition, _) in writes.items()}

        def change(version: Version) -> Version:
            for section, (_, folder, _, schema) in writes.items():
                own = version.section(section)
                more = {p: (*own.parts.get(p, ()), folder) for p in found[section]}
                kept = schema.json() if not own.notes.get("not_null") else own.schema
                version = version.with_section(section, own.with_parts(more, folder, kept))
            return version

        log.commit(change)

    def overwrite_partitions(self, df: DataFrame, name: str, partition: str | Sequence[str], cluster: Sequence[str] = ()) -> None:
        """Replaces exactly the parts that occur in ``df``, all of them at once. ``df`` may read the same table."""
        write = self.write_aside(df, name, partition, cluster)
        self.replace(name, write, partition, df.schema)

    def replace(
        self, name: str, write: str, partition: str | Sequence[str], schema: T.StructType, base: Version | None = None,
        emptied: Iterable[str] = (), notes: Mapping[str, object] | None = None,
    ) -> None:
        """Puts a write's parts in the place of those of the same name (``emptied`` ones go). With ``base``, the
        version they were worked out from, a part that another run has replaced since is an error."""
        log = self.log(name)
        changed = {**{p: () for p in emptied}, **{p: (write,) for p in log.parts_in(write, len(_names(partition)))}}
        replaces = None if base is None else {(ROWS, p): base.section(ROWS).parts.get(p, ()) for p in changed}
        log.commit(lambda v: v.with_section(ROWS, v.section(ROWS).with_parts(changed, write, schema.json(), notes)), replaces)

    # -- versioned tables --------------------------------------------------
    def versions(self, name: str) -> list[str]:
        path = self.path(name)
        return sorted(v for v in self._children(path) if v.startswith("v") and self._finished(f"{path}/{v}"))

    def current(self, name: str) -> DataFrame | None:
        if self.exists(name):
            return self.read(name).drop(BUCKET)
        versions = self.versions(name)
        return self.spark.read.parquet(f"{self.path(name)}/{versions[-1]}") if versions else None

    def publish(self, df: DataFrame, name: str, cluster: Sequence[str] = (), keep: int = 2, rows_a_file: int = 0) -> None:
        """Write the next complete version, then drop all but the last ``keep``. ``rows_a_file``: most rows of a file (0: any number).

        The success marker makes a version current, so readers see the old or the
        new version and never a part. An unfinished number is written over. The
        rows come out of a join or aggregation on the key and are spread by it
        already, so they are only sorted, not shuffled again.
        """
        path = self.path(name)
        versions = self.versions(name)
        number = int(versions[-1][1:]) + 1 if versions else 1
        ordered = df.sortWithinPartitions(*cluster) if cluster else df
        ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).parquet(f"{path}/v{number:08d}")
        for old in self.versions(name)[:-keep]:
            fs, hadoop_path = _file_system(self.spark, f"{path}/{old}")
            fs.delete(hadoop_path, True)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition: str, location: str) -> bool:
    """Create the catalog table unless it is there. True if it was created."""
    if spark.catalog.tableExists(name):
        return False
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {partition} DATE) "
        f"USING parquet PARTITIONED BY ({partition}) LOCATION '{location}'"
    )
    return True


def count_tables(spark: SparkSession, name: str) -> int:
    return int(spark.catalog.tableExists(name))


def latest_date_with(lake: Lake, name: str, partition: str, condition: str | None) -> str | None:
    """Newest date with a row that meets ``condition``; without one, the newest date.

    A date has a folder only if it has rows, so the newest is known by name. A condition
    is looked for in the newest date, then in ever longer stretches before it: normally
    one small job, and a few if there is no such row for long.
    """
    values = lake.partition_values(name, partition)
    if condition is None:
        return values[-1] if values else None
    stretch = 1
    while values:
        values, some = values[:-stretch], values[-stretch:]
        rows = lake.read(name).where(F.col(partition).isin(*[F.lit(v).cast("date") for v in some])).where(condition)
        found = rows.agg(F.max(partition)).first()[0]
        if found is not None:
            return str(found)
        stretch *= 8
    return None
