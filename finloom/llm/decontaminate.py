"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark items and documents are folded (lower case, runs of other than letters and digits as one space). An item is
cut into overlapping windows of WINDOW characters, one each half WINDOW (a shorter item is one window). If a window of
m characters occurs in a document with at most e = floor(RATE * m) edits, both share at least m - q + 1 - q * e of the
window's q-grams, on diagonals at most e apart. So the scan counts shared q-grams in overlapping diagonal bands, each
2 * (e + 1) wide and beginning every e + 1, keeps the regions that reach the bound, and verifies each by a banded
alignment (edit distance of the whole window to any part of the region). No region is given up: the bound is the
lemma's, q-grams common in the language count like others, and all regions are verified.

Documents are only read, in one narrow pass without a shuffle: the windows go to the tasks. The benchmark's size is
checked: it is dealt by hash into blocks of about BLOCK bytes, and each block is one more column function on the same
scan, so a benchmark of any size is handled with bounded memory.

Defined results: a null or empty text or item matches nothing; items shorter than `least` characters (folded) are
matched only as they are, by all of their characters, and those shorter than q characters only as whole words; repeated items
and rows count each; matches are sorted and distinct by item; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.langid import SortedHashes, fold_codes
from finloom.llm.tokens import mix

Q = 8
WINDOW = 100
RATE = 0.08
LEAST = 40
BLOCK = 2 << 20
SLICE = 1 << 20  # places of shared q-grams counted at once
SEGMENT = 1 << 18  # characters of a document handled at once
_STEPS = [np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in (1, 2, 4)]
_MAYBE = 21  # leading bits of a hash that say whether it can be in the index
_GAP = np.array([0], np.uint32)  # between documents; no window has it


def _fold(c: int) -> int:
    low = chr(c).lower()
    return (ord(low) if len(low) == 1 else c) if chr(c).isalnum() else 32


_tables: list[np.ndarray] = []


def folded(text: str | None) -> np.ndarray:
    if not _tables:
        _tables.append(np.array([_fold(c) for c in range(1 << 17)], np.uint32))
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    codes = fold_codes(codes, _tables[0], _fold)
    space = codes == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    codes = codes[keep]
    return codes[: len(codes) - 1] if len(codes) and codes[-1] == 32 else codes


def qgrams(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q characters from each place on, by doubling."""
    own = codes.astype(np.uint64) + np.uint64(1)
    for n, step in zip((1, 2, 4), _STEPS):
        if len(own) <= n:
            return np.zeros(0, np.uint64)
        own = own[:-n] * step + own[n:]
    return own


@dataclass(frozen=True)
class Window:
    item: int
    codes: np.ndarray
    edits: int

    @property
    def bound(self) -> int:
        """Shared q-grams that an occurrence within the edit budget has at least."""
        return len(self.codes) - Q + 1 - Q * self.edits


def windows_of(item: int, text: str | None, window: int = WINDOW, rate: float = RATE, least: int = LEAST) -> list[Window]:
    codes = folded(text)
    if not len(codes):
        return []
    if len(codes) <= window:
        edits = int(rate * len(codes)) if len(codes) >= least else 0
        return [Window(item, codes, edits)]
    begins = [*range(0, len(codes) - window, window // 2), len(codes) - window]
    return [Window(item, codes[b : b + window], int(rate * window)) for b in dict.fromkeys(begins)]


def distance(pattern: np.ndarray, region: np.ndarray, edits: int) -> int:
    """Edits between the whole pattern and the closest part of the region, edits + 1 if more.

    Row by row over the pattern, and in each row only the diagonals that edits can reach: a part begins at one of the
    places that leave room for the pattern, and strays from its diagonal by one place an edit.
    """
    m, n = len(pattern), len(region)
    width = n - m + 2 * edits + 1  # diagonals -edits to n - m + edits
    if width <= 0:
        return edits + 1
    far = np.int32(edits + 1)
    # places of the region by diagonal, with places outside it that match nothing
    wide = np.full(m + width + 1, -1, np.int64)
    begin = edits  # wide[begin + j] is region[j]
    wide[begin : begin + n] = region[: len(wide) - begin]
    steps = np.arange(width, dtype=np.int32)
    row = np.where((steps >= edits) & (steps - edits <= n), 0, far).astype(np.int32)
    for i in range(1, m + 1):
        place = steps + (i - edits)  # of each diagonal after i characters of the pattern
        new = row + (wide[i - 1 : i - 1 + width] != pattern[i - 1])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new[(place < 0) | (place > n)] = far + m
        row = np.minimum(np.minimum.accumulate(new - steps) + steps, far + m).astype(np.int32)
        row[(place < 0) | (place > n)] = far + m
        if row.min() > edits:
            return edits + 1
    return int(min(row.min(), edits + 1))


class _Short:
    """Windows of fewer than Q characters, found as they are where they begin and end with a word."""

    def __init__(self, windows: list[Window]):
        self.items: dict[int, dict[bytes, set[int]]] = {}
        for w in windows:
            self.items.setdefault(len(w.codes), {}).setdefault(w.codes.astype(np.uint32).tobytes(), set()).add(w.item)

    def places(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place) of each occurrence."""
        if not self.items:
            return
        edge = np.concatenate([[True], (codes == 32) | (codes == 0), [True]])  # of place - 1
        for n, items in self.items.items():
            if len(codes) < n:
                continue
            at = np.flatnonzero(edge[: len(codes) - n + 1] & edge[n + 1 :])
            for k in at:
                for item in items.get(codes[k : k + n].astype(np.uint32).tobytes(), ()):
                    yield item, int(k)


class Index:
    """The q-grams of a block of windows."""

    def __init__(self, windows: list[Window]):
        self.short = _Short([w for w in windows if len(w.codes) < Q])
        # a window that several items have is looked for once
        items: dict[bytes, set[int]] = {}
        different: dict[bytes, Window] = {}
        for w in windows:
            if len(w.codes) >= Q:
                items.setdefault(w.codes.tobytes(), set()).add(w.item)
                different.setdefault(w.codes.tobytes(), w)
        windows = list(different.values())
        self.windows, self.items = windows, list(items.values())
        grams = [qgrams(w.codes) for w in windows]
        sizes = np.array([len(g) for g in grams], np.int64)
        keys = mix(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        window = np.repeat(np.arange(len(windows)), sizes)
        place = np.concatenate([np.arange(s) for s in sizes]) if grams else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        hashes, first = np.unique(keys[order], return_index=True)
        self.hashes = SortedHashes(hashes)
        self.first = np.append(first, len(keys))
        self.window, self.place = window[order], place[order]
        self.edits = np.array([w.edits for w in windows], np.int64)
        self.bound = np.array([w.bound for w in windows], np.int64)
        self.maybe = np.zeros(1 << _MAYBE, bool)
        self.maybe[(hashes >> np.uint64(64 - _MAYBE)).astype(np.int64)] = True
        self.longest = max((len(w.codes) + w.edits for w in windows), default=0)

    def regions(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, first, last place of the text) of each band that reaches its bound."""
        keys = mix(qgrams(codes))
        at = np.flatnonzero(self.maybe[(keys >> np.uint64(64 - _MAYBE)).view(np.int64)])
        row = self.hashes.find(keys[at])
        at, row = at[row >= 0], row[row >= 0]
        if not len(at):
            return
        n = self.first[row + 1] - self.first[row]
        strips = len(codes) + self.longest + 2
        strip, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        upto = np.cumsum(n)
        begin = 0
        while begin < len(n):  # a q-gram of many windows meets every place that has it: counted in slices
            end = max(begin + 1, int(np.searchsorted(upto, upto[begin] - n[begin] + SLICE, "right")))
            own = n[begin:end]
            entry = np.repeat(self.first[row[begin:end]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            window = self.window[entry]
            diagonal = np.repeat(at[begin:end], own) - self.place[entry] + self.longest  # 0 or more
            some, times = np.unique(window * strips + diagonal // (self.edits[window] + 1), return_counts=True)
            strip, which = np.unique(np.concatenate([strip, some]), return_inverse=True)
            counts = np.bincount(which, np.concatenate([counts, times])).astype(np.int64)
            begin = end
        # a band is two strips side by side, so diagonals e apart lie in one band together
        both = counts.copy()
        both[:-1] += np.where(strip[1:] == strip[:-1] + 1, counts[1:], 0)
        for k in np.flatnonzero(both >= self.bound[strip // strips]):
            w, s = divmod(int(strip[k]), strips)
            size, e = len(self.windows[w].codes), int(self.edits[w])
            low = s * (e + 1) - self.longest
            yield w, max(0, low - e), min(len(codes), low + 2 * (e + 1) + size + e)

    def matches(self, texts: list[str | None]) -> list[list[int]]:
        """For each text the items of which a window occurs in it."""
        found: list[set[int]] = [set() for _ in texts]
        held, owners, size = [], [], 0

        def search():
            codes = np.concatenate(held)
            ends = np.cumsum([len(x) for x in held])
            for item, at in self.short.places(codes):
                found[owners[int(np.searchsorted(ends, at, "right"))]].add(item)
            for w, first, last in self.regions(codes):
                window = self.windows[w]
                # a region may reach over several texts; each part that can hold the window is tried
                for i in range(np.searchsorted(ends, first, "right"), np.searchsorted(ends, last - 1, "right") + 1):
                    begin = max(first, ends[i] - len(held[i]))
                    part = codes[begin : min(last, ends[i])]
                    if self.items[w] <= found[owners[i]] or len(part) < len(window.codes) - window.edits:
                        continue
                    if distance(window.codes, part, window.edits) <= window.edits:
                        found[owners[i]] |= self.items[w]

        for i, text in enumerate(texts):
            codes = folded(text)
            for begin in range(0, len(codes), SEGMENT):
                held += [codes[begin : begin + SEGMENT + self.longest + Q], _GAP]
                owners += [i, i]
                size += len(held[-2])
                if size >= SEGMENT:
                    search()
                    held, owners, size = [], [], 0
        if held:
            search()
        return [sorted(x) for x in found]


def _blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[int, str]]]:
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // block))
    for k in range(n):  # each about `block` bytes
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in own.toArrow().to_pylist()]


def _matcher(index) -> Column:
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(index.value.matches(column.to_pylist()), pa.list_(pa.int64()))

    match.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(match, "array<bigint>").asNondeterministic()


def matched_items(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    rate: float = RATE,
    least: int = LEAST,
    block: int = BLOCK,
) -> Column:
    """A column function of `documents.text`: the sorted item ids found in it."""
    spark = documents.sparkSession
    found = []
    for items in _blocks(benchmark, block):
        index = Index([w for i, t in sorted(items) for w in windows_of(i, t, window, rate, least)])
        found.append(_matcher(spark.sparkContext.broadcast(index))(documents["text"]))
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found)))) if len(found) > 1 else found[0]


def decontaminate(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Documents in which no item occurs, with their own columns."""
    return documents.filter(F.size(matched_items(documents, benchmark, **settings)) == 0)
