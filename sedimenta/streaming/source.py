"""The changelog as a Structured Streaming source, `spark.readStream.format("cdc")`.

Offsets are bookmarks: the last snapshot whose changes were taken, kept by the query's checkpoint. A batch is planned from its two offsets and committed
whole, so a restart continues exactly; history that has expired or was rolled back fails the query instead of skipping. Python sources get no pruned
columns or filters from Spark: name the columns with `.schema(...)`. Where no stateful operator follows, `operators.changes` in foreachBatch is faster."""

from __future__ import annotations

import logging
import time
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import replace
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from sedimenta.functions import schema as S
from sedimenta.functions.options import ReadOptions
from sedimenta.plans import planner
from sedimenta.sources import catalogs, vectors
from sedimenta.sources.log import FIELD_ID
from sedimenta.sources.model import CdcError, DeleteFile, Split

#: Equality-delete sets that one reader keeps, least recently used out first.
CACHED_SETS = 128
BATCH_ROWS = 8192
LOG = logging.getLogger("sedimenta.cdc")


def offset_json(snapshot: int | None, initialized: bool = True) -> dict[str, Any]:
    return {"version": 1, "snapshot_id": -1 if snapshot is None else snapshot, "initialized": initialized}


def offset_of(d: dict[str, Any]) -> tuple[int | None, bool]:
    """(bookmark, initialized). Offsets without the flag are of a source that had begun."""
    s = d.get("snapshot_id", -1)
    return (None if s == -1 else s), d.get("initialized", True)


class Part(InputPartition):
    def __init__(self, splits: list[Split]):
        super().__init__(None)
        self.splits = splits


class CdcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cdc"

    def schema(self) -> T.StructType:
        """Without a declared one: the table's columns, then the metadata columns."""
        table = _table(ReadOptions.parse(dict(self.options))).load()["schema"]
        fields = [T.StructField(f.name, f.dataType) for f in table.fields]
        return T.StructType([*fields, *(T.StructField(k, t) for k, t in S.METADATA.items())])

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return CdcStreamReader(schema, ReadOptions.parse(dict(self.options)))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return CdcBatchReader(schema, ReadOptions.parse(dict(self.options)))


def _table(o: ReadOptions) -> Any:
    return catalogs.load(o)


def dealt(splits: list[Split], o: ReadOptions) -> list[Part]:
    """ordered: all splits to one task, in order. file-affinity: a file's splits to one task, in order."""
    if o.assignment == "ordered" or not splits:
        return [Part(splits)]
    parts: dict[int, list[Split]] = {}
    for s in splits:
        parts.setdefault(zlib.crc32(s.path.encode()) % o.parallelism, []).append(s)
    return [Part(x) for _, x in sorted(parts.items())]


class CdcBatchReader(DataSourceReader):
    """A bounded read through the same reader."""

    def __init__(self, schema: T.StructType, o: ReadOptions):
        self.o, self.declared = o, schema
        self.meta = _table(o).load()
        self.columns = S.resolve(schema, self.meta["schema"])

    def partitions(self) -> list[InputPartition]:
        start = self.meta["current"] if self.o.startup == "latest" and self.o.start_snapshot is None else self.o.start_snapshot
        return dealt(planner.plan(self.meta, start, self.o.end_snapshot, self.o.compat).splits, self.o)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from SplitReader(_table(self.o), self.meta["schema"], self.columns, self.declared).read(partition.splits)


class CdcStreamReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, o: ReadOptions):
        self.o, self.declared, self.table = o, schema, _table(o)
        self.fields = self.table.load()["schema"]
        self.columns = S.resolve(schema, self.fields)
        self.last: dict[str, Any] | None = None
        self.failures, self.looked = 0, 0.0

    def initialOffset(self) -> dict[str, Any]:  # noqa: N802
        start = self.o.start_snapshot
        if start is None and self.o.startup == "latest":  # on an empty table there is nothing before what comes: all later snapshots are read
            start = self.table.load()["current"]
        first = offset_json(start)
        self.last = self.last or first  # Spark may ask again later
        return first

    def latestOffset(self) -> dict[str, Any]:  # noqa: N802
        """The newest snapshot to take, `max-snapshots-per-trigger` after the end of the last planned batch at most; asked twice, it says the same. Drift and bad tables
        fail; a store that can't be read just now is logged and tried again at the next trigger. Spark asks for the first end before it tells where the query
        starts, so the first batch after a start takes all there is, or up to `end-snapshot-id`."""
        try:
            meta = self.table.load()
        except OSError as e:
            self.failures += 1
            LOG.warning("table %s can't be read, %d times so far: %s", self.o.table, self.failures, e)
            if self.last is None or self.o.bounded:
                raise
            return self.last
        until = self.o.end_snapshot or meta["current"]
        mark = offset_of(self.last)[0] if self.last else None
        if mark is not None and self.o.end_snapshot is not None and until in [s.id for s in planner.chain_to(meta["snapshots"], mark)]:
            until = mark  # the end was reached
        _, new = planner.changed_between(meta, mark, until)
        if self.o.most_snapshots and self.last is not None and len(new) > self.o.most_snapshots:
            until = new[self.o.most_snapshots - 1].id
        return offset_json(until)

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[InputPartition]:
        after, until = offset_of(start)[0], offset_of(end)[0]
        if until is None:
            return [Part([])]
        meta = self.table.load()
        if until not in {s.id for s in planner.chain_to(meta["snapshots"], meta["current"])}:
            raise planner.HistoryExpiredError(f"bookmark snapshot {until} is no longer in the table's snapshot history; start again from a fresh bookmark")
        self.last = end
        made = planner.plan(meta, after, until, self.o.compat)
        LOG.info("table %s: %s", self.o.table, made.metrics)
        return dealt(made.splits, self.o)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from SplitReader(self.table, self.fields, self.columns, self.declared).read(partition.splits)

    def commit(self, end: dict[str, Any]) -> None:
        """Comes for a batch when the next one is planned already, which tells more."""

    def stop(self) -> None:
        pass


class SplitReader:
    """Rows of splits in Arrow batches, in their order. Deletes of a split are loaded before its rows; key sets are kept for the next split."""

    def __init__(self, table: Any, fields: T.StructType, columns: list, declared: T.StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.table, self.fields, self.columns = table, {f.name: f for f in fields.fields}, columns
        self.out = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in declared.fields]))
        self.types = {f.name: t.type for f, t in zip(fields.fields, to_arrow_schema(fields), strict=True)}
        self.sets: OrderedDict[str, set] = OrderedDict()
        self.rows = self.opened = 0

    def read(self, splits: list[Split]) -> Iterator[pa.RecordBatch]:
        for s in splits:
            self.opened += 1
            yield from self._split(s)

    def _open(self, path: str) -> tuple[fs.FileSystem, str]:
        return self.table.fs, self.table._local(path)

    def _positions(self, deletes: tuple[DeleteFile, ...], path: str) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for d in deletes:
            at, where = self._open(d.path)
            if d.content == "dv":
                with at.open_input_file(where) as f:
                    f.seek(d.offset)
                    out.append(vectors.decode(f.read(d.length)))
            elif d.content == "position":
                own = pq.read_table(where, filesystem=at, columns=["file_path", "pos"], filters=pc.field("file_path") == path)
                out.append(own["pos"].to_numpy())
        return np.concatenate(out)

    def _keys(self, d: DeleteFile) -> set:
        if d.ref not in self.sets:
            at, where = self._open(d.path)
            S.check_keys(d.keys, T.StructType(list(self.fields.values())))
            own = pq.read_table(where, filesystem=at, columns=list(d.keys))
            self.sets[d.ref] = set(zip(*(own[k].cast(self.types[k]).to_pylist() for k in d.keys), strict=True))
            if len(self.sets) > CACHED_SETS:
                self.sets.popitem(last=False)
        self.sets.move_to_end(d.ref)
        return self.sets[d.ref]

    def _matched(self, deletes: tuple[DeleteFile, ...], table: pa.Table, at: np.ndarray, positions: np.ndarray) -> np.ndarray:
        hit = np.isin(at, positions)
        for d in deletes:
            if d.content == "equality":
                keys = self._keys(d)
                hit |= np.fromiter((k in keys for k in zip(*(table[x].to_pylist() for x in d.keys), strict=True)), bool, table.num_rows)
        return hit

    def _split(self, s: Split) -> Iterator[pa.RecordBatch]:
        deletes = (*(s.select or ()), *s.drop)
        needed = dict.fromkeys([src for _, src, f in self.columns if f is not None] + [k for d in deletes for k in d.keys])
        where, path = self._open(s.path)
        selected, dropped = self._positions(s.select or (), s.path), self._positions(s.drop, s.path)
        with where.open_input_file(path) as f:
            file = pq.ParquetFile(f)
            by_id = {int(x.metadata[b"PARQUET:field_id"]): x.name for x in file.schema_arrow if x.metadata and b"PARQUET:field_id" in x.metadata}
            there = {n: by_id.get(self.fields[n].metadata[FIELD_ID]) if by_id else (n if n in file.schema_arrow.names else None) for n in needed}
            begin = 0
            for b in file.iter_batches(BATCH_ROWS, columns=[x for x in there.values() if x]):
                n = b.num_rows
                at = np.arange(begin, begin + n)
                begin += n
                table = pa.table({k: b.column(x).cast(self.types[k]) if x else pa.nulls(n, self.types[k]) for k, x in there.items()}) if needed else None
                keep = at >= s.start_position
                if s.select is not None:
                    keep &= self._matched(s.select, table, at, selected)
                if s.drop:
                    keep &= ~self._matched(s.drop, table, at, dropped)
                if keep.any():
                    self.rows += int(keep.sum())
                    yield self._project(s, table, at, keep)

    def _project(self, s: Split, table: pa.Table | None, at: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
        mask, n, out = pa.array(keep), int(keep.sum()), []
        value = {"_last_updated_sequence_number": s.sequence, "_commit_snapshot_id": s.snapshot_id, "_commit_timestamp": s.millis * 1000, "_change_ordinal": s.ordinal, "_change_type": s.change, "_file": s.path, "_spec_id": s.spec_id}
        for (_, src, f), t in zip(self.columns, self.out, strict=True):
            if f is not None:
                out.append(table[src].combine_chunks().filter(mask).cast(t.type))
            elif src == "_pos":
                out.append(pa.array(at[keep], t.type))
            elif src == "_row_id":
                out.append(pa.array(at[keep] + s.first_row_id, t.type) if s.first_row_id is not None else pa.nulls(n, t.type))
            else:
                out.append(pa.array([value[src]] * n, pa.int64()).cast(t.type) if src == "_commit_timestamp" else pa.array([value[src]] * n, t.type))
        return pa.RecordBatch.from_arrays(out, schema=self.out)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CdcSource)


def read_stream(spark: SparkSession, options: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """The stream with its watermark, late by `allowed-lateness`: on `watermark-column` (cast to TIMESTAMP if it has no zone), or on the commit time, whether or not
    the declared schema has it. A watermark column that isn't there is an error."""
    o = ReadOptions.parse(options)
    register(spark)
    reader, names = spark.readStream.format("cdc").options(**options), None
    column = o.watermark_column
    if column is None:
        column = "_commit_timestamp"
        if schema is not None:
            found = next((f.name for f in schema.fields if f.metadata.get(S.ALIAS, f.name) == column), None)
            if found is None:
                names, schema = schema.names, T.StructType([*schema.fields, T.StructField(column, T.TimestampType())])
            column = found or column
    df = (reader.schema(schema) if schema is not None else reader).load()
    if column not in df.columns:
        raise ValueError(f"watermark-column: there is no column {column}")
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    df = df.withWatermark(column, f"{o.lateness_millis} milliseconds")
    return df if names is None else df.select(*names)


def write_stream(df: DataFrame, options: dict[str, str]) -> Any:
    """A writer with the read's trigger: all there is and stop (bounded), or a look every discovery interval."""
    o = ReadOptions.parse(options)
    w = df.writeStream
    return w.trigger(availableNow=True) if o.bounded else w.trigger(processingTime=f"{o.discovery_millis} milliseconds")


def wait_for(query: Any, seconds: float, until: Any) -> None:
    """Waits until `until()`; a failed query raises its error."""
    end = time.time() + seconds
    while not until():
        if (e := query.exception()) is not None:
            raise CdcError(str(e))
        if time.time() > end:
            raise TimeoutError("the stream didn't get there in time")
        time.sleep(0.2)


def from_row(split: Split, row: int) -> Split:
    """The same split from this row position on."""
    return replace(split, start_position=row)
