"""Words of many texts at once, as numpy arrays over an Arrow column's bytes.

UTF-8 never has ASCII bytes inside a longer character, so word classes that
are stated by ASCII characters hold bytewise.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INV_BASE = pow(BASE, -1, 1 << 64)
SEGMENT = 1 << 20

#: `[^\x20\x09-\x0D]+`
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased
LETTER_DIGIT = np.zeros(256, bool)
LETTER_DIGIT[0x30:0x3A] = LETTER_DIGIT[0x61:0x7B] = LETTER_DIGIT[0x80:] = True
#: A-Z to a-z, other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * U64(BASE))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Byte spans of words; words bounds[i]:bounds[i+1] are those of text i."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def texts(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the texts' offsets in them (null:
    empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def runs(inside: np.ndarray, off: np.ndarray) -> Words:
    """Maximal runs of ``inside`` bytes that don't cross texts."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, off))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that are in ascending order and don't
    overlap, in time linear in the bytes (differences of a running
    polynomial, brought to a common power). ``data`` are bytes or code
    points."""
    out = np.zeros(len(starts), np.uint64)
    codes, i = byte_codes() if data.dtype == np.uint8 else None, 0
    size = min(SEGMENT, len(data))
    up, down = powers(BASE, size), powers(INV_BASE, size)
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + SEGMENT, "right")))
        b = ends[j - 1]
        if b - a > len(up):
            up, down = powers(BASE, int(b - a)), powers(INV_BASE, int(b - a))
        sums = np.zeros(b - a + 1, np.uint64)
        part = codes[data[a:b]] if codes is not None else mix(data[a:b].astype(np.uint64) * U64(BASE) + U64(1))
        np.cumsum(part * up[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive words from each word on (the last n - 1
    have none; windows over a text's end must be left out by the caller)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    last = len(h) - n + 1
    out = h[:last].copy()
    for k in range(1, n):
        out = out * U64(BASE) + h[k:k + last]
    return mix(out + U64(n))


def pieces(batch: pa.RecordBatch, col: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each (a longer text
    alone)."""
    if batch.num_rows == 0:
        return
    _, off = texts(batch.column(batch.schema.get_field_index(col)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text's words."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


@functools.lru_cache(1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased texts of a column as code points, one 0 after each, and
    their offsets (null: empty)."""
    low = [(t or "").lower() for t in col.to_pylist()]
    off = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in low], out=off[1:])
    return np.frombuffer("".join(t + "\0" for t in low).encode("utf-32-le"), np.uint32), off
