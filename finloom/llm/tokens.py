"""Words and their hashes, many documents at once, as numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. Texts are
handled in blocks of about BLOCK bytes; a longer text is cut at white space, so a cut never divides a word and memory
follows the block (or the longest single word), not the longest text. Equal words have equal 64-bit hashes everywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
WHITE_BYTES = b" \t\n\x0b\x0c\r"
_WHITE = np.isin(np.arange(256), list(WHITE_BYTES))
_NEXT_WHITE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32  # A-Z only

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _UNBASE: np.ones(1, np.uint64)}


def _powers_of(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, BLOCK + 4096), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(text: bytes, limit: int = BLOCK) -> Iterator[bytes]:
    at = 0
    while len(text) - at > limit:
        cut = _NEXT_WHITE.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def blocks(texts: list[bytes], limit: int = BLOCK) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(which text each piece comes from, the pieces), about `limit` bytes together."""
    owners: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in pieces(text, limit):
            owners.append(i)
            held.append(piece)
            size += len(piece)
            if size >= limit:
                yield np.array(owners), held
                owners, held, size = [], [], 0
    if held:
        yield np.array(owners), held


def joined(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a space before, between and after the pieces; the place after each piece's own space."""
    buffer = np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)
    return buffer, np.cumsum([len(x) + 1 for x in held]) + 1


def spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a buffer that begins and ends with white space."""
    edge = np.flatnonzero(np.diff(_WHITE[buffer].view(np.int8))) + 1
    return edge[::2], edge[1::2]


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: a polynomial in its bytes, from one running sum over the buffer."""
    terms = (buffer.astype(np.uint64) + np.uint64(1)) * _powers_of(_UNBASE, len(buffer))
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(terms, out=total[1:])
    polynomial = (total[ends] - total[starts]) * _powers_of(_BASE, len(buffer))[starts]
    return mix(polynomial + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: list[bytes], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text); fold: A-Z count as a-z."""
    found = [np.zeros(0, np.uint64)]
    counts = np.zeros(len(texts), np.int64)
    for owners, held in blocks(texts):
        buffer, after = joined(held)
        if fold:
            buffer = _FOLD[buffer]
        starts, ends = spans(buffer)
        counts += np.bincount(owners[np.searchsorted(after, starts, side="right")], minlength=len(texts))
        found.append(span_hashes(buffer, starts, ends))
    return np.concatenate(found), counts
