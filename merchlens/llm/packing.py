"""Numbers packed into bytes, for rows that carry many of them through a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, without the planes that are all zero."""
    wide = np.ascontiguousarray(values, dtype=np.uint64)
    width = (int(wide.max()).bit_length() + 7) // 8 if len(wide) else 0
    return bytes([width]) + wide.view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    planes = np.zeros((8, count), np.uint8)
    planes[: data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], count)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def squeezed(values: np.ndarray) -> bytes:
    """As `packed`, with each byte plane compressed where that makes it smaller."""
    planes = packed(values)
    codec, made = pa.Codec("zstd"), [planes[:1]]
    for at in range(planes[0]):
        plane = planes[1 + at * len(values) : 1 + (at + 1) * len(values)]
        small = codec.compress(plane, asbytes=True)
        kept = small if len(small) < len(plane) else plane
        made += [len(kept).to_bytes(4, "little"), kept]
    return b"".join(made)


def unsqueezed(data: bytes, count: int) -> np.ndarray:
    codec, planes, at = pa.Codec("zstd"), [data[:1]], 1
    for _ in range(data[0]):
        start, at = at + 4, at + 4 + int.from_bytes(data[at : at + 4], "little")
        plane = data[start:at]
        planes.append(plane if len(plane) == count else codec.decompress(plane, count, asbytes=True))
    return unpacked(b"".join(planes), count)


def deltas(ordered: np.ndarray) -> np.ndarray:
    """Steps between ascending numbers; their running total gives the numbers back."""
    return np.diff(ordered, prepend=np.uint64(0))


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of `ranges` equal ranges of hashes each is in; never falls as hashes rise."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
