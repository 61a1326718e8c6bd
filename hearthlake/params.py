"""Job parameters: one validated object shared by every layer."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

# What a run may ask for.
ENVIRONMENTS = ("dev", "test", "prod")
CITY_STATES = {"macae": "rj"}
SITES = ("vivareal", "zapimoveis")
PROPERTY_TYPES = ("apartment", "house")
#: A snapshot that cannot be read stops the load, or is noted in the quarantine.
UNREADABLE = ("raise", "quarantine")
#: A repeated key that would update one row twice stops the model, or its first row
#: (by page and id, or by its values) is taken.
DUPLICATES = ("raise", "first")


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)


def _one(name: str, value: str, allowed: Iterable[str]) -> str:
    cleaned = value.strip().lower()
    if cleaned not in allowed:
        raise ValueError(f"{name} {value!r} is not one of {sorted(allowed)}")
    return cleaned


def _many(name: str, value: str | Iterable[str], allowed: Iterable[str]) -> tuple[str, ...]:
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(_one(name, part, allowed) for part in parts)


def _flag(name: str, value: str | bool) -> bool:
    words = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}
    try:
        return words[str(value).strip().lower()]
    except KeyError:
        raise ValueError(f"{name} {value!r} is not a boolean") from None


def _file_date(value: str | date | None, now: datetime) -> date:
    if value is None or value == "":
        return now.date()
    if isinstance(value, date):
        return value
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"file_date {value!r} does not look like YYYY-MM-DD") from None


@dataclass(frozen=True)
class RunParams:
    """What one run covers. Text input is trimmed, lower-cased and checked."""

    environment: str
    city: str
    sites: tuple[str, ...]
    property_types: tuple[str, ...]
    start_page: int = 1
    max_page: int | None = None
    version: str = "unknown"
    file_date: date | None = None
    run_ts: datetime = field(default_factory=_utc_now)
    write_snapshots: bool = True
    write_bronze: bool = True
    on_unreadable: str = "raise"
    on_duplicate: str = "raise"
    cities: tuple[str, ...] = tuple(CITY_STATES)

    def __post_init__(self) -> None:
        fix = lambda name, value: object.__setattr__(self, name, value)
        fix("environment", _one("environment", self.environment, ENVIRONMENTS))
        fix("city", _one("city", self.city, self.cities))
        fix("sites", _many("site", self.sites, SITES))
        fix("property_types", _many("property type", self.property_types, PROPERTY_TYPES))
        fix("start_page", int(self.start_page))
        bound = None if self.max_page is None else int(self.max_page)
        fix("max_page", bound if bound and bound > 0 else None)
        fix("file_date", _file_date(self.file_date, self.run_ts))
        fix("write_snapshots", _flag("write_snapshots", self.write_snapshots))
        fix("write_bronze", _flag("write_bronze", self.write_bronze))
        fix("on_unreadable", _one("on_unreadable", self.on_unreadable, UNREADABLE))
        fix("on_duplicate", _one("on_duplicate", self.on_duplicate, DUPLICATES))

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> RunParams:
        env = os.environ if env is None else env
        return cls(
            environment=env["ENVIRONMENT"],
            city=env["CITY"],
            sites=env["SITES"],
            property_types=env["PROPERTY_TYPES"],
            start_page=env["START_PAGE"],
            max_page=env["MAX_PAGE"],
            version=env.get("VERSION", "unknown"),
            file_date=env.get("FILE_DATE"),
            write_snapshots=env.get("WRITE_SNAPSHOTS", "true"),
            write_bronze=env.get("WRITE_BRONZE", "true"),
            on_unreadable=env.get("ON_UNREADABLE", "raise"),
            on_duplicate=env.get("ON_DUPLICATE", "raise"),
        )
