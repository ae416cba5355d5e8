"""Columns of numbers and runs of text packed into one binary value, so that a shuffle carries a few large rows."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_HEAD = struct.Struct("<q")


def pack(columns: list[np.ndarray], level: int = 1) -> bytes:
    """Arrays of one length, one behind the other, byte by byte of their values, compressed."""
    planes = (np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns if len(c))
    raw = b"".join([_HEAD.pack(len(columns[0])), *planes])
    return zstandard.ZstdCompressor(level=level).compress(raw)


def unpack(blob: bytes, dtypes: list[str]) -> list[np.ndarray]:
    """The arrays of pack, by their dtypes."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,), at, out = _HEAD.unpack_from(raw), _HEAD.size, []
    for d in map(np.dtype, dtypes):
        planes = np.frombuffer(raw, np.uint8, n * d.itemsize, at).reshape(d.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(d))
        at += n * d.itemsize
    return out


def unpack_all(blobs: list[bytes], dtypes: list[str]) -> list[np.ndarray]:
    """The same of several blobs, joined."""
    parts = [unpack(b, dtypes) for b in blobs]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, d) for k, d in enumerate(dtypes)]


def pack_text(ids: np.ndarray, state: np.ndarray, lengths: np.ndarray, data: bytes, level: int = 3) -> bytes:
    """Documents: id, state, length of each, and the bytes of all."""
    head = b"".join([_HEAD.pack(len(ids)), ids.astype("<i8").tobytes(), state.astype("u1").tobytes(), lengths.astype("<i8").tobytes()])
    return zstandard.ZstdCompressor(level=level).compress(head + data)


def unpack_text(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, memoryview]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    (n,), at = _HEAD.unpack_from(raw), _HEAD.size
    ids = np.frombuffer(raw, "<i8", n, at)
    state = np.frombuffer(raw, "u1", n, at + 8 * n)
    lengths = np.frombuffer(raw, "<i8", n, at + 9 * n)
    return ids, state, lengths, raw[at + 17 * n :]
