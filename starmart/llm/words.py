"""Words and word shingles as 64-bit hashes, many texts at a time.

A word is a run of anything but space and the control characters 9 to 13, with
A-Z lower-cased. A text's shingles are its distinct runs of SHINGLE words; a text
with fewer words is one shingle, one without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE = 5
#: Bytes hashed at once; longer texts are hashed in pieces cut between words.
PIECE = 1 << 19

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, PIECE + 2), dtype=np.uint64)
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        _tables[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over all bits of the output."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of some bytes that are at most a piece long."""
    letters = np.frombuffer(data, dtype=np.uint8)
    space = np.ones(len(letters) + 2, dtype=bool)
    space[1:-1] = _IS_SPACE[letters]
    edges = np.flatnonzero(space[1:] != space[:-1])
    first, end = edges[::2], edges[1::2]
    total = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum((letters + np.uint64(1)) * _powers(_BASE, len(letters)), out=total[1:])
    value = (total[end] - total[first]) * _powers(_INVERSE, len(letters) + 1)[first]
    return mix(value), first


def _giant(word: bytes) -> np.ndarray:
    """Hash of one word that is longer than a piece."""
    value = 0
    for at in range(0, len(word), PIECE):
        part = np.frombuffer(word[at : at + PIECE], dtype=np.uint8)
        inner = int(np.sum((part + np.uint64(1)) * _powers(_BASE, len(part)), dtype=np.uint64))
        value = (value + inner * pow(_BASE, at, 1 << 64)) & _MASK
    return mix(np.array([value], dtype=np.uint64))


def _last_space(data: bytes, start: int, end: int) -> int:
    return max(data.rfind(c, start, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))


def _next_space(data: bytes, start: int) -> int:
    while start < len(data):
        at = np.flatnonzero(_IS_SPACE[np.frombuffer(data[start : start + PIECE], dtype=np.uint8)])
        if len(at):
            return start + int(at[0])
        start += PIECE
    return len(data)


def _long_text(data: bytes) -> np.ndarray:
    parts, start = [], 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        if end < len(data):
            cut = _last_space(data, start, end)
            if cut < 0:
                end = _next_space(data, end)
                if end - start > PIECE:
                    parts.append(_giant(data[start:end]))
                    start = end
                    continue
            else:
                end = cut + 1
        parts.append(_hashed(data[start:end])[0])
        start = end
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def hashed_words(texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of consecutive texts, as (index of the first text, hashes, bounds).

    Text ``first + k`` has the hashes ``bounds[k]`` up to ``bounds[k + 1]``. A null
    has no words.
    """
    group: list[bytes] = []
    first = size = 0

    def flush():
        joined = b"\n".join(group)
        hashes, starts = _hashed(joined)
        ends = np.cumsum([0] + [len(x) + 1 for x in group])
        return first, hashes, np.searchsorted(starts, ends)

    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
        if group and size + len(data) >= PIECE:
            yield flush()
            group, size = [], 0
        if len(data) >= PIECE:
            hashes = _long_text(data)
            yield i, hashes, np.array([0, len(hashes)])
            continue
        if not group:
            first = i
        group.append(data)
        size += len(data) + 1
    if group:
        yield flush()


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of some words from each position on."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, length, dtype=np.uint64)
    for k in range(length):
        total *= np.uint64(0xA0761D6478BD642F)
        total += hashes[k : k + n]
    return mix(total)


def shingle_sets(texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Distinct shingles of consecutive texts, ascending, in the form of hashed_words()."""
    for first, hashes, bounds in hashed_words(texts):
        every = runs(hashes, SHINGLE)
        sets = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= SHINGLE:
                sets.append(np.unique(every[a : b - SHINGLE + 1]))
            else:
                sets.append(runs(hashes[a:b], b - a) if b > a else hashes[:0])
        yield first, np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets])
