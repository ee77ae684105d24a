"""Periodic runs in the words of a text.

A run is a stretch of consecutive words with smallest period q and at least max(LEAST, 2 q) words that no neighbouring
word extends keeping period q. Within a task, many texts at a time:

1. Every word of a run lies in a stretch of LEAST // 2 words that occurs again in the same text, one period away. Hashes
   of these stretches cut the texts to the regions that can hold a run; nothing else is dropped, and a run never leaves
   its region. Regions are put one after the other, each closed by a separator smaller than all words.
2. Ukkonen's algorithm builds the suffix trees of that sequence and of its reversal. An Euler tour with a sparse table
   over it answers lowest common ancestors, so longest common extensions, in constant time in both directions.
3. Every run has a root that is the longest Lyndon word at some place, in the order of the words or in the reverse order.
   These words end at the next smaller suffix, which the suffix tree's leaves give in order. Each is extended as far as
   its period holds in both directions; where the extensions reach a whole period there is a run.

Texts go to tasks as Spark deals the rows, nothing is shuffled; memory follows one block of regions (about BLOCK words),
or the regions of the longest text.

Defined results: a null text counts as empty and has no words and no runs; rows with equal texts each get their result;
all columns stay, the results are added under names that are free; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.llm.store import free_name
from finloom.llm.tokens import as_bytes, mix, word_hashes

LEAST = 12
BLOCK = 1 << 14
_GROUP = 1 << 22  # bytes of text handled at a time
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_STEP = 0x9E3779B97F4A7C15

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


class SuffixTree:
    """Suffix tree of a sequence of ints whose last symbol occurs nowhere else, built by Ukkonen's algorithm.

    Node 0 is the root; an edge is kept at the node below it as the places [start, end) of its label.
    """

    def __init__(self, text: list[int]):
        n = len(text)
        start, end, link = [0], [0], [0]
        child: list[dict[int, int] | None] = [{}]  # by first symbol; None below a leaf
        node, edge, length, open_ = 0, 0, 0, 0  # active point, and suffixes not yet in the tree
        for i, symbol in enumerate(text):
            open_ += 1
            last = -1  # inner node that waits for its suffix link
            while open_:
                if not length:
                    edge = i
                down = child[node].get(text[edge])
                if down is None:
                    child[node][text[edge]] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    child.append(None)
                    if last >= 0:
                        link[last] = node
                    last = -1
                else:
                    span = (end[down] if end[down] < i + 1 else i + 1) - start[down]
                    if length >= span:
                        edge += span
                        length -= span
                        node = down
                        continue
                    at = start[down]
                    if text[at + length] == symbol:
                        length += 1
                        if last >= 0:
                            link[last] = node
                        break
                    inner = len(start)
                    leaf = inner + 1
                    start += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    child += ({text[at + length]: down, symbol: leaf}, None)
                    child[node][text[edge]] = inner
                    start[down] = at + length
                    if last >= 0:
                        link[last] = inner
                    last = inner
                open_ -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_ + 1
        self.n, self.start, self.end, self.child = n, start, end, child
        self._tour()

    def _tour(self) -> None:
        """Euler tour: string depths in order of visits, the leaf of each suffix, and suffixes in increasing order."""
        start, end, child, n = self.start, self.end, self.child, self.n
        depths: list[int] = []
        first, leaves = [0] * n, []
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            if node >= 0:  # else back at the parent after a child
                below = child[node]
                if below is None:
                    first[n - depth] = len(depths)
                    leaves.append(n - depth)
                else:
                    for symbol in sorted(below, reverse=True):
                        down = below[symbol]
                        stack.append((-1, depth))
                        stack.append((down, depth + end[down] - start[down]))
            depths.append(depth)
        self.leaves, self.first = leaves, np.array(first)
        least = np.array(depths, np.int32)
        self.table, span = [least], 1
        while 2 * span <= len(depths):
            least = np.minimum(least[:-span], least[span:])
            self.table.append(least)
            span *= 2

    def leaves_reversed(self) -> list[int]:
        """Suffixes in increasing order if larger symbols came first; negative ones stay below all others."""
        start, end, child, n = self.start, self.end, self.child, self.n
        leaves, stack = [], [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = child[node]
            if below is None:
                leaves.append(n - depth)
            else:
                order = sorted(below)  # popped from the end: negative symbols, then the largest first
                low = 0
                while low < len(order) and order[low] < 0:
                    low += 1
                for symbol in order[low:] + order[:low]:
                    down = below[symbol]
                    stack.append((down, depth + end[down] - start[down]))
        return leaves

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j, different ones: the depth of their ancestor."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << int(k))])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(words: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of a sequence, by start and period. A negative number is a separator: each
    occurs once and nothing extends over it; the other symbols are numbered from 0."""
    n = len(words)
    empty = np.zeros(0, np.int64)
    if n < 2:
        return empty, empty, empty
    closing = int(min(words.min(), 0)) - 1
    there = SuffixTree([*words.tolist(), closing])
    back = SuffixTree([*words[::-1].tolist(), closing])
    own = np.flatnonzero(words >= 0)
    starts, ends = [], []
    for order in (there.leaves, there.leaves_reversed()):
        rank = np.empty(n + 1, np.int64)
        rank[order] = np.arange(n + 1)
        starts.append(own)
        ends.append(np.array(_next_smaller(rank.tolist()))[own])  # where the longest Lyndon word ends
    i, j = np.concatenate(starts), np.concatenate(ends)
    p = j - i
    right = there.common(i, j)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    # suffix n - k of the reversal starts with place k - 1 and goes left
    left[inner] = back.common(n - i[inner], n - j[inner])
    begin, length = i - left, left + right + p
    keep = (left + right >= p) & (length >= least)
    found = np.unique(np.stack([begin[keep], p[keep], length[keep]], 1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _regions(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of words, of all texts together, that are covered by stretches of `width` words
    occurring more than once in their text. One that is the same by hash only adds a region."""
    n = len(words)
    owner = np.repeat(np.arange(len(counts)), counts)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = n - width + 1
    key = np.zeros(m, np.uint64)
    for k in range(width):
        key = key * np.uint64(_STEP) + words[k : k + m]
    key = mix(key + mix(owner[:m].astype(np.uint64)))
    at = np.flatnonzero(owner[:m] == owner[width - 1 :])
    order = at[np.argsort(key[at])]
    same = key[order[1:]] == key[order[:-1]]
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    change = np.zeros(n + 1, np.int32)
    hits = order[repeated]
    np.add.at(change, hits, 1)
    np.add.at(change, hits + width, -1)
    covered = np.cumsum(change[:-1]) > 0
    edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
    # neighbouring texts do not share a region
    turn = np.zeros(n, bool)
    turn[1:] = covered[1:] & covered[:-1] & (owner[1:] != owner[:-1])
    starts = np.sort(np.concatenate([np.flatnonzero(edge == 1), np.flatnonzero(turn)]))
    ends = np.sort(np.concatenate([np.flatnonzero(edge == -1), np.flatnonzero(turn)]))
    return starts, ends


def _blocks(starts: np.ndarray, ends: np.ndarray) -> Iterator[slice]:
    total = np.cumsum(ends - starts + 1)
    begin, base = 0, 0
    while begin < len(starts):
        stop = max(begin + 1, int(np.searchsorted(total, base + BLOCK, side="right")))
        yield slice(begin, stop)
        begin, base = stop, int(total[stop - 1])


def find_runs(texts: list[bytes], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period of each run, words of each text), runs by text, start and period."""
    hashes, counts = word_hashes(texts, fold=False)
    base = np.cumsum(counts) - counts
    # a run of least words and at least two periods repeats its first words, half of least at the least, one period on
    starts, ends = _regions(hashes, counts, max(1, least // 2))
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    found = [np.zeros((0, 3), np.int64)]
    for part in _blocks(starts, ends):
        begin, size = starts[part], ends[part] - starts[part]
        places = np.repeat(begin - (np.cumsum(size + 1) - size - 1), size + 1) + np.arange(int((size + 1).sum()))
        close = np.cumsum(size + 1) - 1
        inside = np.ones(len(places), bool)
        inside[close] = False
        symbols = np.empty(len(places), np.int64)
        symbols[inside] = np.unique(hashes[places[inside]], return_inverse=True)[1]
        symbols[close] = -1 - np.arange(len(close))
        at, length, period = runs_of(symbols, least)
        found.append(np.stack([places[at], length, period], 1))
    start, length, period = np.concatenate(found).T
    text = np.searchsorted(base + counts, start, side="right")
    order = np.lexsort((period, start))
    text, start, length, period = text[order], start[order], length[order], period[order]
    return text, start - base[text], length, period, counts


def collapse(text: bytes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words, joined by one space, without those that repeat a run's first period."""
    words = _WORD.findall(text)
    if len(start):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def _groups(texts: list[bytes]) -> Iterator[slice]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _GROUP:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    yield slice(begin, len(texts))


def _answer(texts: list[bytes], least: int) -> pa.Array:
    text, start, length, period, counts = find_runs(texts, least)
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    collapsed = [
        collapse(t, start[a:b], length[a:b], period[a:b]) for t, a, b in zip(texts, edges, edges[1:])
    ]
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(_RUN))
    lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs)
    out = [pa.array(counts), lists, pa.array(collapsed, pa.binary()).cast(pa.string())]
    return pa.StructArray.from_arrays(out, fields=list(_FOUND))


def periodic_runs(
    documents: DataFrame, least: int = LEAST, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Every row with the columns `keep` (all, if not given) and n_words, runs (by start and period) and collapsed, the
    text without repeated periods; underscores follow where a name is taken."""
    kept = documents.columns if keep is None else list(keep)
    base = documents.select(*kept)
    results = [free_name(base, f.name) for f in _FOUND]
    read = free_name(base, "text_read")
    rows = documents.select(*kept, F.col(text).cast("string").alias(read))
    n = len(kept)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(n))
            for part in _groups(texts):
                own = batch.slice(part.start, part.stop - part.start)
                found = _answer(texts[part], least)
                columns = [own.column(k) for k in range(n)] + found.flatten()
                yield pa.RecordBatch.from_arrays(columns, [*kept, *results])

    types = ("bigint", "array<struct<start:bigint,length:bigint,period:bigint>>", "string")
    schema = base.schema
    for name, kind in zip(results, types):
        schema = schema.add(name, T.DataType.fromDDL(kind))
    return rows.mapInArrow(look, schema)
