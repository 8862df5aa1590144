"""Words of whole texts as 64-bit hashes, vectorised over the bytes of an Arrow column.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D); A-Z count as a-z.
The hash is polynomial over random byte values, so all words of a block come from one running sum,
and a final mixing step spreads it over all bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20  # bytes hashed at once; bounds the scratch arrays

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
MARK = np.zeros(256, bool)  # ASCII punctuation
MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; grown by doubling and kept."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.ones(1, np.uint64) if have is None else have
        while len(have) < size:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 2**64))])
        if size <= 4 * BLOCK:
            _powers[base] = have
    return have[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins and the last ends; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of all texts in order; those of text i are ``at[i]:at[i+1]``; begin and end are byte places."""

    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    at: np.ndarray


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Block borders that lie beside white space or between texts, so that no word is cut."""
    cuts, size = [0], len(data)
    while cuts[-1] + BLOCK < size:
        to = cuts[-1] + BLOCK
        text = offsets[np.searchsorted(offsets, to, "right") - 1]
        white = np.flatnonzero(SPACE[data[to - 4096 : to]])
        if text > cuts[-1]:
            to = int(text)
        elif len(white):
            to = to - 4096 + int(white[-1]) + 1
        else:
            to = _next_border(data, offsets, to)
        cuts.append(to)
    return [*cuts, size]


def _next_border(data: np.ndarray, offsets: np.ndarray, at: int) -> int:
    end = int(offsets[np.searchsorted(offsets, at, "left")])
    while at < end:
        white = np.flatnonzero(SPACE[data[at : min(end, at + BLOCK)]])
        if len(white):
            return at + int(white[0]) + 1
        at = min(end, at + BLOCK)
    return end


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, skip: np.ndarray | None = None) -> Words:
    """``skip`` marks the byte values that do not count for the hash (they still belong to the word)."""
    values = _BYTE[LOWER]
    if skip is not None:
        values[skip] = 0
    begins, ends, hashes = [], [], []
    cuts = _cuts(data, offsets)
    for low, high in zip(cuts, cuts[1:]):
        part = data[low:high]
        inside = ~space[part]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        borders = offsets[np.searchsorted(offsets, low, "right") : np.searchsorted(offsets, high, "left")] - low
        borders = borders[(borders > 0) & (borders < len(part))]
        first[borders] = inside[borders]
        last[borders - 1] = inside[borders - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        if skip is None:
            place = _power(_BASE, len(part))
            begin_place = begin
        else:  # places count only the bytes that are hashed
            kept = ~skip[part]
            seen = np.zeros(len(part) + 1, np.int64)
            np.cumsum(kept, out=seen[1:])
            place = _power(_BASE, len(part) + 1)[seen[:-1]]
            begin_place = seen[begin]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * place, out=total[1:])
        hashes.append(mix((total[end] - total[begin]) * _power(_INVERSE, len(part) + 1)[begin_place]))
        begins.append(begin + low)
        ends.append(end + low)
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return Words(
        begin, np.concatenate(ends) if ends else begin, np.concatenate(hashes) if hashes else begin.astype(np.uint64),
        np.searchsorted(begin, offsets),
    )


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` consecutive words, sorted; a shorter text is one shingle."""
    if len(hashes) == 0:
        return hashes
    if len(hashes) < size:
        return _chain(hashes, len(hashes), 1)
    return np.unique(_chain(hashes, size, len(hashes) - size + 1))


def _chain(hashes: np.ndarray, size: int, count: int) -> np.ndarray:
    value = np.full(count, np.uint64(size), np.uint64)
    for i in range(size):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + count])
    return value


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.uint64).view(np.int64)
