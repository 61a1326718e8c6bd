"""An index of landed snapshot files, so that a run lists what is new and not a search's whole history.

A page's folder has the files of all days. Its modification time moves when a file comes or
goes, so a folder whose time is that of the last look has nothing new and is not listed again.
Folders that did change are listed by Spark; what the index does not know yet is added
to it by date, and a date's files are then read by their names.

Files count from the moment they are named: one that is written again under its name is read as it is then.
A store without modification times of folders has every folder listed each time, which is right but saves nothing.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.sources.snapshots import list_snapshots
from hearthlake.sources.tables import Lake, _file_system

FILES, FOLDERS = "landed_files", "landed_folders"
FILE_DATE, SEARCH = "FILE_DATE", "SEARCH"
#: A folder that changed this short a time before it was listed may change again within the same tick of
#: its clock, or by another clock; it is listed once more next time.
SLACK_MS = 60_000
_FOLDER_ROWS = f"FOLDER string, CHANGED_MS bigint, {SEARCH} string"


class LandedIndex:
    """Which files lie below ``root``, as far as the searches' folders have been looked at.

    Entries are appended: ``GONE`` tells that a file was missed at ``SEEN_MS``, the last entry of a
    file counts. Files are noted before their folders' times, so a run that stops in between lists those
    folders again and adds nothing twice.
    """

    def __init__(self, lake: Lake, root: str, slack_ms: int = SLACK_MS):
        self.lake, self.spark, self.root, self.slack_ms = lake, lake.spark, root.rstrip("/"), slack_ms

    def _changed(self, search: str) -> dict[str, int]:
        """The page folders of a search with their modification times, from one listing."""
        fs, path = _file_system(self.spark, search)
        return {f"{search}/{s.getPath().getName()}": s.getModificationTime() for s in fs.listStatus(path) if s.isDirectory()}

    def _noted(self, searches: Sequence[str]) -> dict[str, int]:
        if not self.lake.exists(FOLDERS):
            return {}
        return {r.FOLDER: r.CHANGED_MS for r in self.lake.read(FOLDERS, **{SEARCH: searches}).collect()}

    def _entries(self, file_date: date | str | None = None) -> DataFrame:
        """Files that were there at the last look."""
        part = (FILE_DATE, file_date) if file_date is not None else (None, None)
        rows = self.lake.read(FILES, *part).where(F.col("ROOT") == self.root)
        return rows.groupBy("BLOB", FILE_DATE).agg(F.max_by("GONE", "SEEN_MS").alias("GONE")).where("not GONE").drop("GONE")

    @staticmethod
    def _folder() -> Column:
        return F.regexp_replace("BLOB", "/[^/]*$", "")

    def refresh(self, searches: Sequence[str], extension: str = "json") -> list[str]:
        """Looks at the folders of some searches that changed since the last time; returns those it listed."""
        now = int(time.time() * 1000)
        found = {search: self._changed(search) for search in searches}
        noted = self._noted(searches)
        stale = sorted(f for own in found.values() for f, ms in own.items() if noted.get(f) != ms)
        vanished = sorted(f for f in noted if not any(f in own for own in found.values()))
        if stale or vanished:
            self._note_files(stale, [*stale, *vanished], now, extension)
            self._note_folders(found, now)
        return stale

    def _note_files(self, listed: Sequence[str], looked_at: Sequence[str], now: int, extension: str) -> None:
        there = self.spark.createDataFrame([], f"BLOB string, {FILE_DATE} date")
        if listed:
            there = list_snapshots(self.spark, [*listed], None, extension).select(F.col("blob").alias("BLOB"), F.col("file_date").alias(FILE_DATE))
        entries = there.withColumn("GONE", F.lit(False))
        if self.lake.exists(FILES):
            own = self.spark.createDataFrame([(f.removeprefix(f"{self.root}/"),) for f in looked_at], "FOLDER string")
            known = self._entries().withColumn("FOLDER", self._folder()).join(own, "FOLDER", "left_semi").drop("FOLDER")
            fresh = there.join(known, "BLOB", "left_anti").withColumn("GONE", F.lit(False))
            entries = fresh.unionByName(known.join(there, "BLOB", "left_anti").withColumn("GONE", F.lit(True)))
        self.lake.append(entries.withColumns({"ROOT": F.lit(self.root), "SEEN_MS": F.lit(now)}), FILES, FILE_DATE, ("BLOB",))

    def _note_folders(self, found: dict[str, dict[str, int]], now: int) -> None:
        """A folder whose time is too fresh, or that has none, is noted with a time that no folder has."""
        settled = lambda ms: ms if 0 < ms <= now - self.slack_ms else -1
        rows = [(folder, settled(ms), search) for search, own in found.items() for folder, ms in own.items()]
        frame = self.spark.createDataFrame(rows, _FOLDER_ROWS)
        self.lake.overwrite_partitions(frame, FOLDERS, SEARCH, ("FOLDER",))

    def paths(self, searches: Sequence[str], file_date: date | str) -> list[str]:
        """Full paths of one date's files of some searches: as many as they have pages, which a reader of files lists anyway."""
        if not self.lake.exists(FILES):
            return []
        wanted = [s.removeprefix(f"{self.root}/") for s in searches]
        rows = self._entries(file_date).where(F.regexp_replace("BLOB", "/[^/]*/[^/]*$", "").isin(*wanted))
        return sorted(f"{self.root}/{r.BLOB}" for r in rows.select("BLOB").collect())
