"""Snapshots, files and splits."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from typing import Any


class CdcError(Exception):
    """What a changelog read can't do."""


class HistoryExpiredError(CdcError):
    """History that is needed for a correct continuation is gone."""


class PlanningError(CdcError):
    """The log contradicts itself, or has no rule for what it says."""


class UnsupportedFormatError(CdcError):
    """A file format that no reader here knows."""


class SchemaError(CdcError):
    """A declared column that the table doesn't have, or has otherwise."""


@dataclass(frozen=True)
class DataFile:
    path: str
    rows: int
    sequence: int | None = None
    first_row_id: int | None = None
    spec_id: int = 0
    partition: tuple = ()
    format: str = "parquet"


@dataclass(frozen=True)
class DeleteFile:
    """content: `position` (file_path, pos; of one data file if it is referenced, else of any), `dv` (a deletion vector of one data file), `equality` (rows of
    the key columns `keys`)."""

    path: str
    content: str
    sequence: int | None = None
    referenced: str | None = None
    offset: int = 0
    length: int = 0
    keys: tuple[str, ...] = ()
    spec_id: int = 0
    partition: tuple = ()
    format: str = "parquet"

    @property
    def ref(self) -> str:
        """Name of this delete among others; several vectors may stand in one file."""
        return f"{self.path}@{self.offset}"


@dataclass(frozen=True)
class Snapshot:
    id: int
    parent: int | None
    sequence: int
    millis: int
    operation: str
    summary: dict[str, str] = field(default_factory=dict)
    added: tuple[DataFile, ...] = ()
    removed: tuple[str, ...] = ()
    deletes: tuple[DeleteFile, ...] = ()


@dataclass(frozen=True)
class Split:
    """One data file under one operation of one snapshot. Rows are kept if they match a delete of `select` (or select is None) and none of `drop`."""

    split_id: int
    path: str
    change: str  # INSERT or DELETE
    chain: int
    seq: int  # place within the snapshot: position deletes, equality deletes, removed files, inserts
    ordinal: int
    snapshot_id: int
    millis: int
    sequence: int | None
    first_row_id: int | None
    spec_id: int
    select: tuple[DeleteFile, ...] | None = None
    drop: tuple[DeleteFile, ...] = ()
    start_position: int = 0


def _tuples(x: Any) -> Any:
    return tuple(_tuples(v) for v in x) if isinstance(x, list) else x


def snapshot_json(s: Snapshot) -> dict:
    return asdict(s)


def snapshot_of(d: dict) -> Snapshot:
    files = tuple(DataFile(**f | {"partition": _tuples(f["partition"])}) for f in d["added"])
    deletes = tuple(DeleteFile(**f | {"partition": _tuples(f["partition"]), "keys": tuple(f["keys"])}) for f in d["deletes"])
    return Snapshot(**d | {"added": files, "removed": tuple(d["removed"]), "deletes": deletes})
