"""Declared schemas and metadata columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sources.log import FIELD_ID
from sedimenta.sources.model import SchemaError

#: Fixed names and types of the metadata columns.
METADATA: dict[str, T.DataType] = {
    "_row_id": T.LongType(),
    "_last_updated_sequence_number": T.LongType(),
    "_commit_snapshot_id": T.LongType(),
    "_commit_timestamp": T.TimestampType(),
    "_change_ordinal": T.IntegerType(),
    "_change_type": T.StringType(),
    "_file": T.StringType(),
    "_pos": T.LongType(),
    "_spec_id": T.IntegerType(),
}
#: Key of a declared field's metadata that makes it an alias of a metadata column.
ALIAS = "metadata.from"
#: Types that an equality key may have.
KEY_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.BinaryType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.TimeType)


def resolve(declared: T.StructType | None, table: T.StructType) -> list[tuple[str, str, T.StructField | None]]:
    """Columns of the result: (name, source, the table's field, or None for metadata). By name: an alias of a metadata column, else a column of the table, else
    a metadata column declared plainly. Types must agree but for nullability. Without a declaration: all columns of the table."""
    fields = {f.name: f for f in table.fields}
    if declared is None:
        return [(f.name, f.name, f) for f in table.fields]
    out = []
    for f in declared.fields:
        alias = f.metadata.get(ALIAS)
        if alias is not None and alias not in METADATA:
            raise SchemaError(f"no metadata column {alias}")
        if alias is None and f.name in fields:
            there = fields[f.name].dataType
            if _loose(there) != _loose(f.dataType):
                raise SchemaError(f"column {f.name} has type {there.simpleString()} in the table, not {f.dataType.simpleString()}")
            out.append((f.name, f.name, fields[f.name]))
        elif (alias or f.name) in METADATA:
            if METADATA[alias or f.name] != f.dataType:
                raise SchemaError(f"metadata column {alias or f.name} has type {METADATA[alias or f.name].simpleString()}, not {f.dataType.simpleString()}")
            out.append((f.name, alias or f.name, None))
        else:
            raise SchemaError(f"column {f.name} is neither in the table nor a metadata column")
    return out


def _loose(t: T.DataType) -> str:
    """A type without nullability."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{_loose(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{_loose(t.elementType)}>"
    if isinstance(t, T.MapType):
        return f"map<{_loose(t.keyType)},{_loose(t.valueType)}>"
    return t.simpleString()


def metadata_field(name: str, key: str) -> T.StructField:
    """A declared column that takes its value from a metadata column: `name ... METADATA FROM key`."""
    return T.StructField(name, METADATA[key], True, {ALIAS: key})


def check_keys(keys: tuple[str, ...], table: T.StructType) -> None:
    fields = {f.name: f for f in table.fields}
    for k in keys:
        if k not in fields:
            raise SchemaError(f"equality delete on {k}, which the table doesn't have")
        if not isinstance(fields[k].dataType, KEY_TYPES):
            raise SchemaError(f"equality delete on type {fields[k].dataType.simpleString()} not supported")


def field_id(f: T.StructField) -> int:
    return f.metadata[FIELD_ID]


def metadata_value(key: str) -> Column:
    """From a scanned row joined with its split."""
    return {
        "_row_id": F.when(F.col("_s_first_row_id").isNotNull(), F.col("_s_first_row_id") + F.col("_s_pos")),
        "_last_updated_sequence_number": F.col("_s_sequence"),
        "_commit_snapshot_id": F.col("_s_snapshot_id"),
        "_commit_timestamp": F.timestamp_millis(F.col("_s_millis")),
        "_change_ordinal": F.col("_s_ordinal").cast("int"),
        "_change_type": F.col("_s_change"),
        "_file": F.col("_s_path"),
        "_pos": F.col("_s_pos"),
        "_spec_id": F.col("_s_spec_id").cast("int"),
    }[key]
