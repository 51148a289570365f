"""Deletion vectors: sorted row positions as a portable 64-bit roaring bitmap, in a blob with length, magic and checksum."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Fixed values of the public blob and bitmap formats.
BLOB_MAGIC = bytes([0xD1, 0xD3, 0x39, 0x64])
COOKIE_RUNS = 12347
COOKIE_PLAIN = 12346
NO_OFFSETS_BELOW = 4
ARRAY_MOST = 4096


def encode(positions: np.ndarray) -> bytes:
    """The blob of these positions."""
    positions = np.unique(np.asarray(positions, np.uint64))
    high = (positions >> np.uint64(32)).astype(np.uint64)
    kinds = np.unique(high)
    body = [struct.pack("<Q", len(kinds))]
    for h in kinds:
        low = (positions[high == h] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        body += [struct.pack("<I", int(h)), _encode32(low)]
    data = BLOB_MAGIC + b"".join(body)
    return struct.pack(">I", len(data)) + data + struct.pack(">I", zlib.crc32(data))


def _encode32(values: np.ndarray) -> bytes:
    keys = np.unique(values >> 16)
    head, offsets, data = [struct.pack("<II", COOKIE_PLAIN, len(keys))], [], []
    at = 8 + 8 * len(keys)
    for k in keys:
        own = (values[values >> 16 == k] & 0xFFFF).astype("<u2")
        head.append(struct.pack("<HH", int(k), len(own) - 1))
        if len(own) > ARRAY_MOST:
            bits = np.zeros(65536, np.uint8)
            bits[own] = 1
            data.append(np.packbits(bits, bitorder="little").tobytes())
        else:
            data.append(own.tobytes())
        offsets.append(struct.pack("<I", at))
        at += len(data[-1])
    return b"".join([*head, *offsets, *data])


def decode(blob: bytes) -> np.ndarray:
    """Positions of a blob; a wrong magic, length or checksum is an error."""
    (size,) = struct.unpack_from(">I", blob)
    data = blob[4 : 4 + size]
    if len(data) != size or data[:4] != BLOB_MAGIC:
        raise ValueError("not a deletion vector")
    if struct.unpack_from(">I", blob, 4 + size)[0] != zlib.crc32(data):
        raise ValueError("deletion vector: checksum differs")
    (n,), at, out = struct.unpack_from("<Q", data, 4), 12, [np.zeros(0, np.int64)]
    for _ in range(n):
        (high,) = struct.unpack_from("<I", data, at)
        low, at = _decode32(data, at + 4)
        out.append(low.astype(np.int64) + (high << 32))
    return np.concatenate(out)


def _decode32(data: bytes, start: int) -> tuple[np.ndarray, int]:
    (cookie,), at = struct.unpack_from("<I", data, start), start + 4
    runs = np.zeros(0, np.uint8)
    if cookie & 0xFFFF == COOKIE_RUNS:
        n = (cookie >> 16) + 1
        runs = np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at), bitorder="little")[:n]
        at += (n + 7) // 8
    elif cookie == COOKIE_PLAIN:
        (n,), at = struct.unpack_from("<I", data, at), at + 4
    else:
        raise ValueError("not a roaring bitmap")
    heads, at = np.frombuffer(data, "<u2", 2 * n, at).reshape(n, 2), at + 4 * n
    if not len(runs) or n >= NO_OFFSETS_BELOW:
        at += 4 * n
    out = [np.zeros(0, np.int64)]
    for k, (key, less) in enumerate(heads.tolist()):
        if len(runs) and runs[k]:
            m = int(np.frombuffer(data, "<u2", 1, at)[0])
            pairs, at = np.frombuffer(data, "<u2", 2 * m, at + 2).reshape(m, 2).astype(np.int64), at + 2 + 4 * m
            own = np.concatenate([np.arange(a, a + b + 1) for a, b in pairs])
        elif less + 1 > ARRAY_MOST:
            own, at = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, 8192, at), bitorder="little")), at + 8192
        else:
            own, at = np.frombuffer(data, "<u2", less + 1, at).astype(np.int64), at + 2 * (less + 1)
        out.append(own + (key << 16))
    return np.concatenate(out), at
