"""Words of whole texts as numpy arrays: boundaries and 64-bit hashes for a batch of rows at once.

A word is a maximal run of bytes other than space and the control characters 9 to 13. UTF-8 never
uses those bytes inside a longer character, so bytes and characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from groundsill.session import ship_with_tasks

ship_with_tasks(__name__)

SLICE_BYTES = 1 << 20

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIERS = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits; one-to-one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps)
    return known[:n]


@dataclass
class Words:
    """Words of some rows in row order. Row r has words ``first[r]`` to ``first[r + 1] - 1``."""

    first: np.ndarray
    hashes: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def together(parts: list[Words]) -> Words:
    """The rows of all parts, one after the other."""
    sizes = np.concatenate([p.count() for p in parts])
    return Words(np.concatenate([[0], np.cumsum(sizes)]),
                 np.concatenate([p.hashes for p in parts]))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each row begins; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """Splits and hashes all words of the rows in ``data``; A-Z count as a-z if ``lower``.

    A word's hash is a polynomial in random per-byte values, read off one running sum over all
    bytes, then mixed.
    """
    n = len(data)
    if n == 0:
        return Words(np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    inside = _IS_WORD[data]
    breaks = np.zeros(n + 1, bool)
    breaks[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | breaks[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[_LOWER[data] if lower else data] * _powers(_BASE, n), out=running[1:])
    hashes = (running[ends] - running[starts]) * _powers(_BASE_INVERSE, n + 1)[starts]
    return Words(np.searchsorted(starts, offsets), mix(hashes))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a text column into runs of whole rows of about ``most`` bytes: first row, end row,
    bytes, offsets. A longer single text is a run of its own."""
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def runs_hash(hashes: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``length`` consecutive words from each position (or only from those in ``at``);
    not yet mixed, so that a longer run can be had by adding further terms."""
    n = len(hashes)
    if at is None:
        total = np.zeros(max(n - length + 1, 0), np.uint64)
        for i in range(length):
            total += hashes[i : i + len(total)] * MULTIPLIERS[i]
        return total
    total = np.zeros(len(at), np.uint64)
    for i in range(length):
        total += hashes[at + i] * MULTIPLIERS[i]
    return total
