"""The changelog between two snapshots as a DataFrame: one native scan of the files concerned, joined with the splits and their deletes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import schema as S
from sedimenta.plans import planner
from sedimenta.sources.log import VersionedTable, session_paths
from sedimenta.sources.model import DeleteFile, Split

SPLITS = T.StructType([
    T.StructField("_s_uri", T.StringType()), T.StructField("_s_id", T.LongType()), T.StructField("_s_path", T.StringType()), T.StructField("_s_change", T.StringType()), T.StructField("_s_chain", T.LongType()),
    T.StructField("_s_seq", T.LongType()), T.StructField("_s_ordinal", T.LongType()), T.StructField("_s_snapshot_id", T.LongType()), T.StructField("_s_millis", T.LongType()), T.StructField("_s_sequence", T.LongType()),
    T.StructField("_s_first_row_id", T.LongType()), T.StructField("_s_spec_id", T.LongType()), T.StructField("_s_selects", T.BooleanType()), T.StructField("_s_start", T.LongType()),
])
#: Without a declared schema, what stands beside the table's columns.
DEFAULT_METADATA = ("_change_type", "_commit_snapshot_id", "_change_ordinal")


def scan_uri() -> Any:
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")


def _refs(spark: SparkSession, splits: list[Split], content: str, keys: tuple[str, ...] | None = None) -> tuple[DataFrame | None, list[DeleteFile]]:
    """(delete file's uri, split, whether it selects) of one kind of deletes, and the delete files."""
    rows, files, uris = [], {}, {}
    for s in splits:
        for role, own in ((True, s.select or ()), (False, s.drop)):
            for d in own:
                if d.content == content and (keys is None or d.keys == keys):
                    files[d.ref] = d
                    if d.path not in uris:
                        uris[d.path] = session_paths(spark, d.path)
                    rows.append((uris[d.path], d.offset, d.length, s.split_id, s.path, role))
    if not rows:
        return None, []
    schema = "uri string, offset long, length long, _s_id long, target string, selects boolean"
    return spark.createDataFrame(rows, schema), list(files.values())


def _positions(spark: SparkSession, splits: list[Split]) -> DataFrame | None:
    """(split, position, _p_select, _p_drop), one row for each position."""
    parts = []
    refs, files = _refs(spark, splits, "position")
    if refs is not None:
        rows = spark.read.schema("file_path string, pos long").parquet(*{d.path for d in files}).select("file_path", "pos", scan_uri().alias("uri"))
        parts.append(rows.join(refs, (rows.uri == refs.uri) & (rows.file_path == refs.target)).select("_s_id", F.col("pos").alias("_s_pos"), "selects"))
    refs, files = _refs(spark, splits, "dv")
    if refs is not None:
        blobs = spark.read.format("binaryFile").load([*{d.path for d in files}]).select(scan_uri().alias("uri"), "content")
        vectors = refs.join(blobs, "uri").select("_s_id", "selects", F.substring("content", F.col("offset").cast("int") + 1, F.col("length").cast("int")).alias("blob"))
        parts.append(vectors.mapInArrow(_decoded, "_s_id long, selects boolean, _s_pos long").select("_s_id", "_s_pos", "selects"))
    if not parts:
        return None
    both = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    return both.groupBy("_s_id", "_s_pos").agg(F.max("selects").alias("_p_select"), F.max(~F.col("selects")).alias("_p_drop"))


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from sedimenta.sources import vectors

    for b in batches:
        for i, role, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
            pos = vectors.decode(blob)
            for k in range(0, len(pos), 65536):
                own = pos[k : k + 65536]
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(own), pa.int64()), pa.array([role] * len(own), pa.bool_()), pa.array(own)], ["_s_id", "selects", "_s_pos"])


def _equalities(spark: SparkSession, splits: list[Split], table: T.StructType) -> list[tuple[tuple[str, ...], DataFrame]]:
    """For each tuple of key columns: (split, keys, _e_select, _e_drop), one row for each key."""
    kinds = sorted({d.keys for s in splits for d in (*(s.select or ()), *s.drop) if d.content == "equality"})
    out = []
    for n, keys in enumerate(kinds):
        S.check_keys(keys, table)
        refs, files = _refs(spark, splits, "equality", keys)
        fields = {f.name: f for f in table.fields}
        rows = spark.read.schema(T.StructType([T.StructField(k, fields[k].dataType) for k in keys])).parquet(*{d.path for d in files})
        rows = rows.select(*(F.col(k).alias(f"_e{n}_k_{k}") for k in keys), scan_uri().alias("uri")).join(refs.select("uri", F.col("_s_id").alias(f"_e{n}_of"), "selects"), "uri")
        names = [f"_e{n}_of", *(f"_e{n}_k_{k}" for k in keys)]
        out.append((keys, rows.groupBy(*names).agg(F.max("selects").alias(f"_e{n}_select"), F.max(~F.col("selects")).alias(f"_e{n}_drop"))))
    return out


def read_splits(spark: SparkSession, meta: dict, splits: list[Split], columns: T.StructType | None = None, metadata: tuple[str, ...] = DEFAULT_METADATA, mode: str | None = None) -> DataFrame:
    """The rows of these splits, in one order ("ordered"), in order within their file and a file in one task ("file-affinity"), or as scanned. Columns are found in old files by their field id; a column that a file lacks is null."""
    table: T.StructType = meta["schema"]
    wanted = S.resolve(columns, table)
    result = [(name, S.metadata_value(src) if f is None else F.col(src)) for name, src, f in wanted]
    if columns is None:
        result += [(k, S.metadata_value(k)) for k in metadata]
    def key_names(some: list[Split]) -> set[str]:
        return {k for s in some for d in (*(s.select or ()), *s.drop) for k in d.keys}

    needed = {src for _, src, f in wanted if f is not None} | key_names(splits)
    fields = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in table.fields if f.name in needed])
    if not splits:
        empty = spark.createDataFrame([], T.StructType([*SPLITS.fields, T.StructField("_s_pos", T.LongType()), *fields.fields]))
        return empty.select(*(c.alias(n) for n, c in result))
    # Splits without deletes, the bulk of most histories, are a plain scan; only the others meet joins.
    plain = [s for s in splits if not s.select and not s.drop]
    parts = [_scanned(spark, some, fields, table) for some in (plain, [s for s in splits if s.select or s.drop]) if some]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    place = ("_s_chain", "_s_seq", "_s_pos")
    if mode == "ordered":
        rows = rows.orderBy(*place)
    elif mode == "file-affinity":
        rows = rows.repartition("_s_path").sortWithinPartitions("_s_path", *place)
    return rows.select(*(c.alias(n) for n, c in result))


def _scanned(spark: SparkSession, splits: list[Split], fields: T.StructType, table: T.StructType) -> DataFrame:
    """One scan of the splits' files, each row once for each split of its file, without those that the deletes leave out."""
    uris = {p: session_paths(spark, p) for p in {s.path for s in splits}}
    listed = [(uris[s.path], s.split_id, s.path, s.change, s.chain, s.seq, s.ordinal, s.snapshot_id, s.millis, s.sequence, s.first_row_id, s.spec_id, s.select is not None, s.start_position) for s in splits]
    files = spark.createDataFrame(listed, SPLITS)
    spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
    spark.conf.set("spark.sql.parquet.fieldId.read.ignoreMissing", "true")
    # Column metadata of the read schema must not reach the result: it would carry field ids into whatever is written next.
    scan = spark.read.schema(fields).parquet(*uris)
    scan = scan.select(*(F.col(f.name).alias(f.name, metadata={}) for f in fields.fields), scan_uri().alias("_s_uri"), F.col("_metadata.row_index").alias("_s_pos"))
    rows = scan.join(files, "_s_uri")
    if any(s.start_position for s in splits):
        rows = rows.where("_s_pos >= _s_start")
    columns, select, drop = rows.columns, [], []
    positions = _positions(spark, splits)
    if positions is not None:
        rows = rows.join(positions, ["_s_id", "_s_pos"], "left")
        select.append(F.col("_p_select"))
        drop.append(F.col("_p_drop"))
    for n, (keys, relation) in enumerate(_equalities(spark, splits, table)):
        on = F.col("_s_id") == F.col(f"_e{n}_of")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_e{n}_k_{k}"))
        rows = rows.join(relation, on, "left")
        select.append(F.col(f"_e{n}_select"))
        drop.append(F.col(f"_e{n}_drop"))
    hit = lambda parts: F.coalesce(*parts, F.lit(False)) if len(parts) < 2 else F.greatest(*(F.coalesce(p, F.lit(False)) for p in parts))
    if select:
        rows = rows.where((~F.col("_s_selects") | hit(select)) & ~hit(drop))
    return rows.select(columns)


def changes(spark: SparkSession, table: VersionedTable, start: int | None = None, end: int | None = None, columns: T.StructType | None = None, metadata: tuple[str, ...] = DEFAULT_METADATA, mode: str | None = None, startup: str = "earliest", compat: str = "live_only", partition: dict[str, object] | None = None) -> DataFrame:
    """The changelog after snapshot `start` (None: from the oldest visible one) up to `end` (None: the current one).

    columns: a declared schema (checked against the table; metadata columns by name or alias); else all columns and `metadata`. mode "ordered": one global
    order of snapshot, operation, position; "file-affinity": rows of a file in one task, in order; None: as scanned. startup "latest": nothing,
    since a bounded read ends where it starts. partition: reads only files that may hold these values of partition columns."""
    meta = table.load()
    if startup == "latest" and start is None:
        start = meta["current"]
    made = planner.plan(meta, start, end, compat)
    splits = planner.pruned(made.splits, meta, partition) if partition else made.splits
    if mode not in (None, "ordered", "file-affinity"):
        raise ValueError("mode is ordered or file-affinity")
    return read_splits(spark, meta, splits, columns, metadata, mode)


def snapshot_rows(spark: SparkSession, table: VersionedTable, at: int | None = None) -> DataFrame:
    """The table as of a snapshot: live rows of live files."""
    meta = table.load()
    state = planner.live_state(meta, at)
    splits = [Split(k, f.path, "INSERT", 0, k, 0, at or 0, 0, f.sequence, f.first_row_id, f.spec_id, None, state.deletes[f.path]) for k, f in enumerate(state.files.values())]
    return read_splits(spark, meta, splits, metadata=())
