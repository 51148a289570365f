"""Options of a changelog read."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Names and defaults; None: required.
REQUIRED = ("catalog-impl", "warehouse", "table")
DEFAULTS = {"catalog.uri": "", "catalog.region": "us-east-1", "discovery-interval": "30 s", "allowed-lateness": "30 s", "bounded": "false", "split-assignment-mode": "ordered", "scan.startup.mode": "earliest"}
#: Ours, beyond the connector's: where to start and stop, how deletes are counted, how much one batch takes.
MORE = {"start-snapshot-id": "", "end-snapshot-id": "", "compat": "live_only", "max-snapshots-per-trigger": "", "parallelism": "", "watermark-column": ""}
UNITS = {"ms": 1, "milli": 1, "millis": 1, "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000, "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000, "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000, "d": 86_400_000, "day": 86_400_000, "days": 86_400_000}
STARTUP = {"earliest": "earliest", "initial": "earliest", "latest": "latest"}
ASSIGNMENT = {"ordered": "ordered", "file-affinity": "file-affinity", "file_affinity": "file-affinity"}


def millis(text: str, name: str = "duration") -> int:
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", text)
    if not m or (m[2].lower() or "ms") not in UNITS:
        raise ValueError(f"{name}: no duration: {text!r}")
    return int(m[1]) * UNITS[m[2].lower() or "ms"]


def _choice(options: dict[str, str], name: str, known: dict[str, str]) -> str:
    value = options[name].strip().lower()
    if value not in known:
        raise ValueError(f"{name}: {options[name]!r} is none of {sorted(set(known))}")
    return known[value]


@dataclass(frozen=True)
class ReadOptions:
    table: str
    warehouse: str
    catalog_impl: str
    catalog: dict[str, str] = field(default_factory=dict)
    discovery_millis: int = 30_000
    lateness_millis: int = 30_000
    bounded: bool = False
    assignment: str = "ordered"
    startup: str = "earliest"
    start_snapshot: int | None = None
    end_snapshot: int | None = None
    compat: str = "live_only"
    most_snapshots: int | None = None
    parallelism: int = 1
    watermark_column: str | None = None

    @classmethod
    def parse(cls, given: dict[str, str]) -> ReadOptions:
        """Checks names and values. `catalog.` options that are not known here go to the catalog as they are."""
        given = {k.lower(): str(v) for k, v in given.items()}
        if missing := [k for k in REQUIRED if not given.get(k)]:
            raise ValueError(f"missing options: {', '.join(missing)}")
        known = {*REQUIRED, *DEFAULTS, *MORE, "path"}
        if unknown := [k for k in given if k not in known and not k.startswith("catalog.")]:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        o = DEFAULTS | MORE | given
        interval, lateness = millis(o["discovery-interval"], "discovery-interval"), millis(o["allowed-lateness"], "allowed-lateness")
        if interval <= 0:
            raise ValueError("discovery-interval must be positive")
        if o["bounded"].strip().lower() not in ("true", "false"):
            raise ValueError(f"bounded: {o['bounded']!r} is neither true nor false")
        number = lambda k: int(o[k]) if o[k] else None
        catalog = {k.removeprefix("catalog."): v for k, v in given.items() if k.startswith("catalog.") and k not in ("catalog.uri", "catalog.region")}
        catalog |= ({"uri": o["catalog.uri"]} if o["catalog.uri"] else {}) | {"client.region": o["catalog.region"]}
        return cls(
            o["table"], o["warehouse"], o["catalog-impl"], catalog, interval, lateness, o["bounded"].strip().lower() == "true", _choice(o, "split-assignment-mode", ASSIGNMENT),
            _choice(o, "scan.startup.mode", STARTUP), number("start-snapshot-id"), number("end-snapshot-id"), o["compat"], number("max-snapshots-per-trigger"), number("parallelism") or 1, o["watermark-column"] or None,
        )
