"""Dimensions in buckets of keys, their active and inactive rows apart.

A part of the table is (bucket, active or not). A run compares its source with the active rows and, for
keys that are not among them, with the inactive rows of those keys' buckets. Active parts are written
anew (every row there gets the run's time or goes inactive); rows that go inactive are added to what
lies in their bucket; inactive parts are only rewritten where a key returns. So the history of
vanished keys, which only grows, is neither read nor written, but for the buckets that need it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake import schemas as S
from hearthlake.operators.merge import DuplicateKeyError, duplicate_keys
from hearthlake.operators.scd import FLAG, scd1_next
from hearthlake.session import Staging
from hearthlake.sources.tables import BUCKET, ROWS, Lake
from hearthlake.sources.versions import Version, values_of

#: Buckets of a new table. Choose so many that a bucket's active rows are about the size of a file.
BUCKETS = 16
PARTITION = (BUCKET, FLAG)


def bucket_of(keys: tuple[str, ...], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(BUCKET)


@dataclass
class Changes:
    """What a run does to a dimension: ``upserts`` (rows with the bucket), the version it was worked out from,
    returned rows, the buckets they lie in, and the inactive rows that stay there."""

    upserts: DataFrame
    base: Version
    returned: list[int]
    stay: DataFrame


class KeyedTable:
    def __init__(self, lake: Lake, spec: S.TableSpec):
        self.lake, self.spec = lake, spec

    def exists(self) -> bool:
        return self.lake.exists(self.spec.name)

    def create(self, rows: DataFrame, buckets: int = BUCKETS) -> None:
        """A first load, or a full refresh: it takes the place of all rows."""
        name = self.spec.name
        full = rows.withColumn(BUCKET, bucket_of(self.spec.keys, buckets))
        write = self.lake.write_aside(full, name, PARTITION, self.spec.cluster)
        old = [*self.lake.version(name).section(ROWS).parts]
        self.lake.replace(name, write, PARTITION, full.schema, emptied=old, notes={"buckets": buckets})

    def _rows(self, base: Version, active: bool, buckets: list[int] | None = None) -> DataFrame:
        wanted = {FLAG: [str(active).lower()]} | ({} if buckets is None else {BUCKET: buckets})
        return self.lake.read(self.spec.name, version=base, **wanted)

    def require_mergeable(self, source: DataFrame, base: Version, stage: Staging) -> None:
        """Fail where several source rows would update one row of the table; repeated new keys are let in."""
        keys = [*self.spec.keys]
        twice = stage.keep(duplicate_keys(source, keys).select(*keys), "twice")
        if twice.isEmpty():
            return
        n = base.section(ROWS).notes["buckets"]
        buckets = sorted(r[0] for r in twice.select(bucket_of(self.spec.keys, n)).distinct().collect())
        clash = twice.join(self.lake.read(self.spec.name, version=base, **{BUCKET: buckets}).select(*keys), keys, "left_semi").head(1)
        if clash:
            raise DuplicateKeyError(f"more than one source row for {clash[0].asDict()}")

    def changes(self, source: DataFrame, run_ts: datetime | str, stage: Staging) -> Changes:
        """Compares the latest scrape's rows with the table. ``source`` is read more than once."""
        base, keys = self.lake.version(self.spec.name), [*self.spec.keys]
        n = base.section(ROWS).notes["buckets"]
        self.require_mergeable(source, base, stage)
        active = self._rows(base, True)
        # Keys alone, so that the table's other columns are not read for it.
        unknown = source.select(*keys).distinct().join(active.select(*keys), keys, "left_anti")
        unknown = stage.keep(unknown.withColumn(BUCKET, bucket_of(self.spec.keys, n)), "unknown")
        buckets = sorted(r[0] for r in unknown.select(BUCKET).distinct().collect())  # at most n
        inactive = self._rows(base, False, buckets)
        back = stage.keep(inactive.join(unknown.select(*keys), keys, "left_semi"), "back")
        returned = sorted(r[0] for r in back.select(BUCKET).distinct().collect())
        known = active.unionByName(back).drop(BUCKET)
        # All of these are active or return, so every row that comes out is one to write.
        upserts = scd1_next(source, known, self.spec.keys, run_ts).withColumn(BUCKET, bucket_of(self.spec.keys, n))
        stay = self._rows(base, False, returned).join(back.select(*keys), keys, "left_anti")
        return Changes(upserts, base, returned, stay)

    def after(self, found: Changes) -> DataFrame:
        """The whole table as it is once the changes are in, without writing it."""
        n = found.base.section(ROWS).notes["buckets"]
        rest = self._rows(found.base, False, [b for b in range(n) if b not in found.returned])
        columns = found.upserts.columns
        return found.upserts.unionByName(found.stay.select(*columns)).unionByName(rest.select(*columns)).drop(BUCKET)

    def merge(self, source: DataFrame, run_ts: datetime | str, stage: Staging) -> None:
        """Writes what changes, and makes it the table's next version with the parts that stay."""
        name, lake = self.spec.name, self.lake
        found = self.changes(source, run_ts, stage)
        rows = found.upserts.unionByName(found.stay.select(*found.upserts.columns)) if found.returned else found.upserts
        write = lake.write_aside(rows, name, PARTITION, self.spec.cluster)
        log, old = lake.log(name), found.base.section(ROWS).parts
        parts = {p: (write,) for p in log.parts_in(write, len(PARTITION))}
        for part, folders in old.items():
            own = values_of(part)
            if own[FLAG] == "true":
                parts.setdefault(part, ())  # all its keys are gone
            elif int(own[BUCKET]) in found.returned:
                parts.setdefault(part, ())
            elif part in parts:
                parts[part] = (*folders, write)
        schema = rows.schema.json()
        replaces = {(ROWS, p): old.get(p, ()) for p in {*parts, *old}}
        log.commit(lambda v: v.with_section(ROWS, v.section(ROWS).with_parts(parts, write, schema)), replaces)
