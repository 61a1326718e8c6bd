import json
import os

import pytest

from hearthlake.sources import landed as D
from hearthlake.sources import snapshots as N
from hearthlake.sources.landed import LandedIndex
from hearthlake.sources.tables import Lake

FIRST, SECOND = "dev/vivareal/macae/apartment", "dev/vivareal/macae/house"
OLD = 1_700_000_000


def land(root, search, page, stem, settled=OLD):
    folder = os.path.join(root, search, str(page))
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{stem}.json", "w", encoding="utf-8") as f:
        json.dump({stem: {"@id": stem}}, f)
    os.utime(folder, (settled, settled))  # as if it had happened a while ago
    return f"{folder}/{stem}.json"


@pytest.fixture
def places(spark, tmp_path):
    root = str(tmp_path / "landed")
    for search in (FIRST, SECOND):
        for page in (1, 2, 3):
            land(root, search, page, "2026-01-01T05:00:00Z")
    return root, LandedIndex(Lake(spark, str(tmp_path / "lake"), "dev"), root), [f"{root}/{s}" for s in (FIRST, SECOND)]


def pages_of(paths):
    return sorted("/".join(p.split("/")[-3:-1]) for p in paths)


def test_only_folders_that_changed_are_listed(places):
    root, index, searches = places
    assert len(index.refresh(searches)) == 6
    assert index.refresh(searches) == []
    new = land(root, FIRST, 2, "2026-01-02T05:00:00Z", OLD + 10)
    assert index.refresh(searches) == [f"{root}/{FIRST}/2"]
    assert index.paths(searches, "2026-01-02") == [new]
    assert len(index.paths(searches, "2026-01-01")) == 6
    assert pages_of(index.paths(searches[1:], "2026-01-01")) == ["house/1", "house/2", "house/3"]
    assert index.paths(searches, "2026-01-03") == []


def test_a_date_is_read_as_by_listing_everything(spark, places):
    root, index, searches = places
    land(root, FIRST, 4, "2026-01-02T05:00:00Z")
    land(root, FIRST, 4, "2026-01-02T06:00:00Z")
    land(root, SECOND, 1, "no run time")
    index.refresh(searches)
    for day in ("2026-01-01", "2026-01-02"):
        by_name = N.scan_snapshots(spark, index.paths(searches, day), day).collect()
        assert sorted(by_name) == sorted(N.scan_snapshots(spark, root, day).collect())


def test_a_folder_that_has_just_changed_is_listed_again(spark, places):
    root, index, searches = places
    index.refresh(searches)
    land(root, FIRST, 1, "2026-01-02T05:00:00Z", settled=4_000_000_000)
    assert index.refresh(searches) == index.refresh(searches) == [f"{root}/{FIRST}/1"]
    assert len(index.paths(searches, "2026-01-02")) == 1
    assert index.lake.read(D.FILES, D.FILE_DATE, "2026-01-02").count() == 1


def test_files_and_folders_that_go_and_come_back(places):
    root, index, searches = places
    index.refresh(searches)
    lost = f"{root}/{FIRST}/1/2026-01-01T05:00:00Z.json"
    os.remove(lost)
    os.utime(os.path.dirname(lost), (OLD + 5, OLD + 5))
    os.remove(f"{root}/{SECOND}/3/2026-01-01T05:00:00Z.json")
    os.rmdir(f"{root}/{SECOND}/3")
    index.refresh(searches)
    assert pages_of(index.paths(searches, "2026-01-01")) == ["apartment/2", "apartment/3", "house/1", "house/2"]
    land(root, FIRST, 1, "2026-01-01T05:00:00Z", OLD + 20)
    assert index.refresh(searches) == [f"{root}/{FIRST}/1"]
    assert lost in index.paths(searches, "2026-01-01")


def test_a_run_that_stops_before_it_notes_the_folders_loses_and_doubles_nothing(places, monkeypatch):
    root, index, searches = places
    monkeypatch.setattr(LandedIndex, "_note_folders", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.refresh(searches)
    monkeypatch.undo()
    assert len(index.refresh(searches)) == 6
    assert len(index.paths(searches, "2026-01-01")) == 6
    assert index.lake.read(D.FILES).count() == 6


def test_searches_without_pages(places):
    root, index, _ = places
    os.makedirs(f"{root}/dev/empty/macae/apartment")
    assert index.refresh([f"{root}/dev/empty/macae/apartment"]) == []
    assert index.paths([f"{root}/dev/empty/macae/apartment"], "2026-01-01") == []
