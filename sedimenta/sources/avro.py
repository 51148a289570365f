"""Avro container files, as far as table metadata needs them: all types of schemas, and the codecs null, deflate, snappy and zstandard."""

from __future__ import annotations

import io
import json
import os
import struct
import zlib
from typing import Any

import pyarrow as pa

MAGIC = b"Obj\x01"


class _In:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        if len(out) < n:
            raise ValueError("Avro: the data ends early")
        self.at += n
        return out

    def long(self) -> int:
        n, shift = 0, 0
        while True:
            b = self.take(1)[0]
            n |= (b & 0x7F) << shift
            if not b & 0x80:
                return (n >> 1) ^ -(n & 1)
            shift += 7

    def bytes(self) -> bytes:
        return self.take(self.long())

    def blocks(self) -> Any:
        """Counts of the blocks of an array or a map."""
        while n := self.long():
            if n < 0:
                self.long()
            yield from range(abs(n))


def _names(schema: Any, known: dict[str, Any]) -> None:
    """Named types, which may be used again by their name."""
    if isinstance(schema, list):
        for s in schema:
            _names(s, known)
    elif isinstance(schema, dict):
        if schema["type"] in ("record", "enum", "fixed"):
            known[schema["name"]] = schema
        for f in schema.get("fields", []):
            _names(f["type"], known)
        for k in ("items", "values"):
            if k in schema:
                _names(schema[k], known)
        if isinstance(schema["type"], dict | list):
            _names(schema["type"], known)


def _read(src: _In, schema: Any, known: dict[str, Any]) -> Any:
    if isinstance(schema, list):
        return _read(src, schema[src.long()], known)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, dict | list):
        return _read(src, kind, known)
    match kind:
        case "null":
            return None
        case "boolean":
            return src.take(1) == b"\1"
        case "int" | "long":
            return src.long()
        case "float":
            return struct.unpack("<f", src.take(4))[0]
        case "double":
            return struct.unpack("<d", src.take(8))[0]
        case "bytes":
            return src.bytes()
        case "string":
            return src.bytes().decode()
        case "fixed":
            return src.take(schema["size"])
        case "enum":
            return schema["symbols"][src.long()]
        case "array":
            return [_read(src, schema["items"], known) for _ in src.blocks()]
        case "map":
            return {src.bytes().decode(): _read(src, schema["values"], known) for _ in src.blocks()}
        case "record":
            return {f["name"]: _read(src, f["type"], known) for f in schema["fields"]}
    return _read(src, known[kind], known)


def _plain(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "snappy":  # a checksum of four bytes follows
        return pa.decompress(data[:-4], _snappy_size(data), "snappy", asbytes=True)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"Avro: codec {codec}")


def _snappy_size(data: bytes) -> int:
    n = shift = 0
    for b in data:
        n |= (b & 0x7F) << shift
        if not b & 0x80:
            break
        shift += 7
    return n


def read(data: bytes) -> tuple[list[dict], dict[str, str]]:
    """The records of a file and its metadata."""
    src = _In(data)
    if src.take(4) != MAGIC:
        raise ValueError("not an Avro file")
    meta = {}
    for _ in src.blocks():
        k = src.bytes().decode()
        meta[k] = src.bytes()
    sync, schema, known, out = src.take(16), json.loads(meta["avro.schema"]), {}, []
    _names(schema, known)
    codec = meta.get("avro.codec", b"null").decode()
    while src.at < len(data):
        n, block = src.long(), _In(_plain(src.bytes(), codec))
        out += [_read(block, schema, known) for _ in range(n)]
        if src.take(16) != sync:
            raise ValueError("Avro: a block's end is not where it should be")
    return out, {k: v.decode(errors="replace") for k, v in meta.items()}


def _long(n: int) -> bytes:
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _write(out: io.BytesIO, value: Any, schema: Any) -> None:
    if isinstance(schema, list):  # of null and one other
        k = next(i for i, s in enumerate(schema) if (s == "null") == (value is None))
        out.write(_long(k))
        return _write(out, value, schema[k])
    kind = schema["type"] if isinstance(schema, dict) else schema
    match kind:
        case "null":
            pass
        case "boolean":
            out.write(b"\1" if value else b"\0")
        case "int" | "long":
            out.write(_long(value))
        case "float" | "double":
            out.write(struct.pack("<f" if kind == "float" else "<d", value))
        case "bytes" | "string":
            data = value.encode() if kind == "string" else value
            out.write(_long(len(data)) + data)
        case "array":
            if value:
                out.write(_long(len(value)))
                for v in value:
                    _write(out, v, schema["items"])
            out.write(_long(0))
        case "record":
            for f in schema["fields"]:
                _write(out, value[f["name"]], f["type"])
        case _:
            raise ValueError(f"Avro: type {kind} isn't written here")


def write(records: list[dict], schema: dict, meta: dict[str, str] | None = None) -> bytes:
    """One file, compressed by deflate."""
    head, body, sync = io.BytesIO(), io.BytesIO(), os.urandom(16)
    for r in records:
        _write(body, r, schema)
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    block = pack.compress(body.getvalue()) + pack.flush()
    pairs = {"avro.schema": json.dumps(schema), "avro.codec": "deflate"} | (meta or {})
    head.write(MAGIC + _long(len(pairs)))
    for k, v in pairs.items():
        head.write(_long(len(k.encode())) + k.encode() + _long(len(v.encode())) + v.encode())
    head.write(_long(0) + sync)
    if records:
        head.write(_long(len(records)) + _long(len(block)) + block + sync)
    return head.getvalue()
