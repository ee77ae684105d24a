"""Hard negatives for contrastive training, mined with bounds along a spanning tree of the anchors.

Scores are inner products of vectors of whole numbers, floor(256 x). Candidates and anchors are packed into blocks, which
are dealt onto a grid by a shuffle: a cell holds some megabytes of candidates, and the anchors pass through it block by
block. No block is broadcast or collected, and a task holds a cell's candidates and one block of anchors at any table size.
Each block of anchors carries a minimum spanning tree over their distances. It is cut at edges that are long against
the anchor; the root of each piece is scored against every candidate, many roots in one matrix product. Another anchor of
the piece has scores within its root's plus or minus its distance from the root times the candidate's norm
(Cauchy-Schwarz), and only candidates whose bounds overlap what is asked for are scored for it:

- positives: rows of the anchor's label that reach the 5th largest score found so far;
- negatives: rows of other labels in a positive's window of scores that reach the 10th largest found so far in it.

Where the bounds would spare little, as in small pieces of short vectors, the whole piece is scored. What a cell has
found for an anchor is merged before it leaves the task, so a short list per anchor and cell is shuffled.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows with
a component of 2^20 or more (their scores leave the long range). Shorter vectors count as if zeros followed. Every row
stands for itself, also one that repeats another; a null vec_id is no anchor and comes last among ties. An anchor without
positives, and a positive without negatives, have no row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.store import stored

ANCHORS = 2048  # anchors of a block
CANDIDATES = 4096  # candidates of a block
CELL = 64 << 20  # bytes of the candidates of a cell, about
CLOSE = 0.25  # of an anchor's length: the longest edge that is kept, and the farthest from a piece's root
WORTH = 1 << 21  # products that a piece's bounds must be able to spare before they are looked at
_AT_ONCE = 1 << 20  # scores held at a time
_GROUPS = 64  # groups of scores, whose maxima give the first threshold
_TRIES = 3  # blocks that may give it
_NONE = np.iinfo(np.int64).min  # less than any score
_NO_ID = np.iinfo(np.int64).max  # stands for a null vec_id, after all others

_BLOCK = "block bigint, n int, size bigint, item int, row binary, id binary, label binary, vectors binary, parent binary, edge binary"
_BLOCK_FIELDS = ("row", "id", "label", "vectors", "parent", "edge")


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 10
    low: int = 30  # a negative's score is from low to high hundredths of its positive's
    high: int = 90
    anchors: int = ANCHORS
    candidates: int = CANDIDATES
    cell: int = CELL


def prepare(rows: DataFrame, label: Column | str = "label") -> DataFrame:
    """row, id, label, vector of the rows that take part, components as floor(256 x); stored, so that a row's number stays."""
    vector = F.col("embedding").cast("array<double>")
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 20)))
    own = F.col(label) if isinstance(label, str) else label
    return stored(
        rows.filter(vector.isNotNull() & fit)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("bigint").alias("id"),
            own.cast("bigint").alias("label"),
            F.transform(vector, lambda x: F.floor(x * 256).cast("int")).alias("vector"),
        )
        .filter("label IS NOT NULL"),
        "negatives-rows",
    )


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and edge length of each vector in a minimum spanning tree, numbered so that parents come first: order,
    then parent (a place in that order, -1 for the root) and edge."""
    n = len(vectors)
    square = (vectors * vectors).sum(1)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    least, nearest = np.full(n, np.inf), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    at = 0
    for k in range(n):
        order[k] = at
        open_[at] = False
        if k:
            parent[k], edge[k] = nearest[at], np.sqrt(max(least[at], 0.0))
        distance = square + square[at] - 2 * (vectors @ vectors[at])
        closer = open_ & (distance < least)
        least[closer] = distance[closer]
        nearest[closer] = k
        at = int(np.argmin(np.where(open_, least, np.inf)))
    return order, np.stack([parent, edge])


def _padded(vectors: list, wide: int) -> np.ndarray:
    out = np.zeros((len(vectors), wide), np.int32)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _pack(batch: pa.RecordBatch, block: int, tree: bool) -> tuple:
    vectors = [v.values.to_numpy() for v in batch.column("vector")]
    matrix = _padded(vectors, max((len(v) for v in vectors), default=0))
    row = batch.column("row").to_numpy()
    own = batch.column("id").fill_null(_NO_ID).to_numpy()
    label = batch.column("label").to_numpy()
    parent, edge = np.zeros(0, np.int64), np.zeros(0)
    if tree:
        order, (parent, edge) = spanning_tree(matrix.astype(np.float64))
        parent = parent.astype(np.int64)
    else:
        order = np.argsort(label, kind="stable")
    row, own, label, matrix = row[order], own[order], label[order], matrix[order]
    if np.abs(matrix.astype(np.int64)).max(initial=0) < 1 << 15:
        matrix = matrix.astype(np.int16)
    parts = (row, own, label, matrix, parent, edge)
    return (block, len(row), matrix.nbytes, matrix.itemsize, *(np.ascontiguousarray(x).tobytes() for x in parts))


def _sizes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of `size`."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            take = min(size - count, batch.num_rows)
            held.append(batch.slice(0, take))
            batch = batch.slice(take)
            count += take
            if count == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(rows: DataFrame, size: int, tree: bool, purpose: str) -> DataFrame:
    """Blocks of up to `size` rows, numbered; anchors along a spanning tree, candidates by label."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), *(pa.binary() for _ in _BLOCK_FIELDS))
        for batch in _sizes(batches, size):
            packed = _pack(batch, int(batch.column("row")[0].as_py()), tree)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(packed, kinds)], ["block", "n", "size", "item", *_BLOCK_FIELDS])

    return stored(rows.mapInArrow(pack, _BLOCK), purpose)  # a block goes by the number of its first row


class _Block:
    """A packed block, read back."""

    def __init__(self, row: dict, prefix: str):
        get = {f: row[f"{prefix}_{f}"] for f in _BLOCK_FIELDS}
        n = row[f"{prefix}_n"]
        self.row, self.id, self.label = (np.frombuffer(get[f], np.int64) for f in ("row", "id", "label"))
        self.vectors = np.frombuffer(get["vectors"], f"i{row.get(f'{prefix}_item', 4)}").reshape(n, -1)
        self.parent, self.edge = np.frombuffer(get["parent"], np.int64), np.frombuffer(get["edge"])
        self.norm = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1))
        first = np.flatnonzero(np.diff(self.label, prepend=self.label[:1] - 1))
        self.parts = dict(zip(self.label[first].tolist(), zip(first, [*first[1:], n])))  # of candidates, which lie by label
        if len(self.parent):
            self._cut()

    def _cut(self) -> None:
        """Pieces of the cut tree, each of one label: the root of every anchor's piece, and its distance from it."""
        self.root, self.reach = np.arange(len(self.row)), np.zeros(len(self.row))
        whole, roots = self.root.copy(), {}
        keep = (self.parent >= 0) & (self.edge <= CLOSE * self.norm)
        for k, label in enumerate(self.label.tolist()):
            if keep[k]:
                whole[k] = whole[self.parent[k]]
            root = roots.setdefault((whole[k], label), k)
            if root != k:
                distance = np.sqrt(((self.vectors[k].astype(np.float64) - self.vectors[root]) ** 2).sum())
                if distance <= CLOSE * self.norm[k]:
                    self.root[k], self.reach[k] = root, distance
                else:
                    roots[whole[k], label] = k
        by_root = np.argsort(self.root, kind="stable")
        pieces = np.split(by_root, np.flatnonzero(np.diff(self.root[by_root])) + 1)
        self.alone = np.array([p[0] for p in pieces if len(p) == 1], np.int64)
        self.pieces = [p for p in pieces if len(p) > 1]
        self.size = np.array([len(p) for p in self.pieces], np.int64)
        self.far = np.array([p[np.argmax(self.reach[p])] for p in self.pieces], np.int64)  # its bounds hold for the whole piece


class Bounds:
    """Scores of one block of candidates, and their lower and upper bounds from the roots of the anchors' pieces."""

    def __init__(self, anchors: _Block, candidates: _Block):
        wide = min(anchors.vectors.shape[1], candidates.vectors.shape[1])
        # whole numbers, exact as floats while no sum of products can reach 2^24, as doubles while none can reach 2^53
        most = anchors.norm.max(initial=0) * candidates.norm.max(initial=0) * (1 + 1e-9)
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        self.left, self.right = anchors.vectors[:, :wide].astype(kind), candidates.vectors[:, :wide].astype(kind)
        # vectors cut to the shorter width score alike; distances and norms only get larger than needed
        self.anchors, self.candidates = anchors, candidates
        self.norm = candidates.norm * (1 + 1e-12) + 1e-9
        self.kept: dict[int, np.ndarray] = {}
        self.scored = 0

    def exact(self, k, at) -> np.ndarray:
        """Scores of anchor k, or of several, with the candidates at these places."""
        return self.left[k] @ self.right[at].T

    def spread(self, k, exact: np.ndarray, part: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of anchor k, or of several, with a part of the candidates, given the scores of their roots."""
        exact = exact.astype(np.float64)
        wide = np.multiply.outer(self.anchors.reach[k] * (1 + 1e-12), self.norm[part]) + 1e-6 + np.abs(exact) * 2.0**-51
        return exact - wide, exact + wide

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of anchor k's scores before any but its root's is computed."""
        root = int(self.anchors.root[k])
        if root not in self.kept:
            self.kept[root] = self.exact(root, slice(None))
            self.scored += len(self.right)
        return self.spread(k, self.kept[root])

    def score(self, k: int, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of the candidates at these places, which then are their bounds."""
        exact = self.exact(k, at).astype(np.int64)
        slack = np.abs(exact) >> 52  # what a double may miss
        low[at], high[at] = exact - slack, exact + slack
        self.scored += len(at)
        return exact

    def blank(self, scores: np.ndarray, k: np.ndarray) -> None:
        """Take the candidates of the anchors' own labels out of their scores."""
        label, none = self.anchors.label[k], _none(scores.dtype)
        for own in np.unique(label).tolist():
            if own in self.candidates.parts:
                start, end = self.candidates.parts[own]
                scores[np.flatnonzero(label == own), start:end] = none


def _largest(values: np.ndarray, n: int) -> float:
    """The n-th largest, minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else -np.inf


def _none(kind: np.dtype) -> float:
    """Less than any score of this kind of number."""
    return _NONE if kind == np.int64 else -np.inf


def _as(values: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Limits of scores as the kind of number that scores are, cut to what a score can be."""
    if kind == np.int64:
        return values
    most = 1 << (24 if kind == np.float32 else 53)
    return np.clip(values, -most, most).astype(kind)


class _Firsts:
    """For each anchor of a block and each of its windows of scores, the first n of the rows found, by score descending,
    id and row."""

    def __init__(self, least: np.ndarray, most: np.ndarray, n: int):
        self.least, self.most, self.n = least, most, n  # by anchor and window; a window that is none has least > most
        self.score = np.full((least.size, n), _NONE)
        self.id, self.row = np.zeros_like(self.score), np.zeros_like(self.score)
        self.floor = least.copy()  # what a newcomer must reach
        self.last = np.full(least.shape, _NO_ID)  # the largest id of a newcomer that only reaches it
        self.tries = np.zeros(len(least), np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def limits(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score that any window of these anchors still asks for."""
        real = self.least[k] <= self.most[k]
        least = np.where(real, self.floor[k], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        return least, np.where(real, self.most[k], _NONE).max(1, initial=_NONE)

    def fresh(self, k: np.ndarray) -> np.ndarray:
        """Which of these anchors have a floor that nothing has raised so far."""
        as_asked = (self.floor[k] == self.least[k]) & (self.least[k] <= self.most[k])
        return (self.tries[k] < _TRIES) & as_asked.any(1)

    def lift(self, k: np.ndarray, scores: np.ndarray, n: int) -> None:
        """Raise the floors to the n-th largest of the maxima of groups of these scores: at least n rows reach it."""
        size = scores.shape[1] // _GROUPS
        if not size or not len(k) or n > _GROUPS:
            return
        self.tries[k] += 1
        most, none = _as(self.most[k], scores.dtype), _none(scores.dtype)
        for w in range(most.shape[1]):
            inside = np.where(scores[:, : size * _GROUPS] <= most[:, w, None], scores[:, : size * _GROUPS], none)
            top = np.partition(inside.reshape(len(k), _GROUPS, size).max(2), _GROUPS - n, 1)[:, _GROUPS - n]
            there = top > none
            self.floor[k[there], w] = np.maximum(self.floor[k[there], w], top[there].astype(np.int64))

    def add(self, k: np.ndarray, score: np.ndarray, own: np.ndarray, row: np.ndarray) -> None:
        floor = self.floor[k]
        fit = (score[:, None] > floor) | ((score[:, None] == floor) & (own[:, None] <= self.last[k]))
        at, w = np.nonzero(fit & (score[:, None] <= self.most[k]))
        if len(at):
            self.held.append((k[at] * self.least.shape[1] + w, score[at], own[at], row[at]))
            self.count += len(at)
        if self.count > 2 * _AT_ONCE:
            self.merge()

    def merge(self) -> None:
        """Take in what was held."""
        if not self.held:
            return
        window, score, own, row = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.count = [], 0
        there, place = np.nonzero(self.score != _NONE)
        touched = np.zeros(len(self.score), bool)
        touched[window] = True
        there, place = there[touched[there]], place[touched[there]]
        window, score = np.concatenate([there, window]), np.concatenate([self.score[there, place], score])
        own, row = np.concatenate([self.id[there, place], own]), np.concatenate([self.row[there, place], row])
        order = np.lexsort((row, own, -score, window))
        window = window[order]
        first = np.flatnonzero(np.diff(window, prepend=-1))
        place = np.arange(len(window)) - np.repeat(first, np.diff(first, append=len(window)))
        order, window, place = order[place < self.n], window[place < self.n], place[place < self.n]
        self.score[window, place], self.id[window, place], self.row[window, place] = score[order], own[order], row[order]
        score, own = (x[:, -1].reshape(self.floor.shape) for x in (self.score, self.id))
        self.floor = np.maximum(self.floor, score)
        self.last = np.where(self.floor == score, own, _NO_ID)

    def rows(self) -> tuple[np.ndarray, ...]:
        """Anchor, window, score, id and row of all."""
        at, place = np.nonzero(self.score != _NONE)
        return (*np.divmod(at, max(1, self.least.shape[1])), self.score[at, place], self.id[at, place], self.row[at, place])


def _search(bounds: Bounds, found: _Firsts, same: bool) -> None:
    """Add the block's rows of each anchor's label, or of other labels, that the anchor's windows ask for."""
    a, c = bounds.anchors, bounds.candidates
    if not same:
        _search_part(bounds, found, a.alone, np.arange(len(a.pieces)), slice(0, len(c.row)), same)
        return
    by_label, by_piece = a.label[a.alone], a.label[a.far]
    for own in np.unique(a.label).tolist():
        if own in c.parts:
            pieces = np.flatnonzero(by_piece == own)
            _search_part(bounds, found, a.alone[by_label == own], pieces, slice(*c.parts[own]), same)


def _search_part(bounds: Bounds, found: _Firsts, alone: np.ndarray, pieces: np.ndarray, part: slice, same: bool) -> None:
    """The same with one part of the candidates, for the anchors that are pieces of their own and for larger pieces."""
    a, c = bounds.anchors, bounds.candidates
    step = max(1, _AT_ONCE // (part.stop - part.start))

    def add(k: np.ndarray, scores: np.ndarray, at: np.ndarray) -> None:
        least, most = (_as(x, scores.dtype)[:, None] for x in found.limits(k))
        i, j = np.divmod(np.flatnonzero((scores >= least) & (scores <= most)), scores.shape[1])
        if same:
            other = c.row[at[j]] != a.row[k[i]]
            i, j = i[other], j[other]
        found.add(k[i], scores[i, j].astype(np.int64), c.id[at[j]], c.row[at[j]])

    def whole(k: np.ndarray) -> None:
        at = np.arange(part.start, part.stop)
        for start in range(0, len(k), step):
            some = k[start : start + step]
            scores = bounds.exact(some, part)
            if not same:
                bounds.blank(scores, some)
            fresh = found.fresh(some)
            found.lift(some[fresh], scores[fresh], found.n + same)  # the anchor itself may be among those of its label
            add(some, scores, at)

    worth = (a.size[pieces] - 1) * bounds.left.shape[1] * (part.stop - part.start) >= WORTH
    worth &= ~found.fresh(a.far[pieces])  # there is nothing yet to hold the bounds against
    whole(np.concatenate([alone, *(a.pieces[p] for p in pieces[~worth])]))
    pieces = pieces[worth]
    for start in range(0, len(pieces), step):
        some = pieces[start : start + step]
        far, members = a.far[some], [a.pieces[p] for p in some]
        low, high = bounds.spread(far, bounds.exact(a.root[far], part), part)
        if not same:
            bounds.blank(high, far)
        least, most = found.limits(np.concatenate(members))
        ends = np.cumsum([0, *(len(m) for m in members[:-1])])
        least, most = np.minimum.reduceat(least, ends), np.maximum.reduceat(most, ends)
        fit = (high >= least[:, None].astype(np.float64)) & (low <= most[:, None].astype(np.float64))
        spared = fit.sum(1) * 8 < fit.shape[1]
        if not spared.all():
            whole(np.concatenate([m for m, s in zip(members, spared) if not s]))
        for p in np.flatnonzero(spared & fit.any(1)):
            at = np.flatnonzero(fit[p]) + part.start
            add(members[p], bounds.exact(members[p], at), at)


_POSITIVES = "block bigint, anchor_row bigint, anchor_id bigint, score bigint, id bigint, row bigint"
_FOUND = "anchor_row bigint, anchor_id bigint, positive_row bigint, positive_id bigint, positive_score bigint, score bigint, id bigint, row bigint"


def _batch(columns: list[np.ndarray], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], [x.split()[0] for x in names.split(", ")])


def _keys(spark: SparkSession, n: int) -> list[int]:
    """A number for each of n partitions that a shuffle over n deals to it, so that each gets one cell."""
    key = F.col("id").cast("int")
    dealt = spark.range(32 * n).groupBy(F.pmod(F.hash(key), F.lit(n)).alias("place")).agg(F.min(key).alias("key"))
    found = {place: k for place, k in dealt.collect()}
    return [found.get(place, 32 * n + place) for place in range(n)]


def _cells(anchors: DataFrame, candidates: DataFrame, settings: Settings) -> DataFrame:
    """Every block of anchors with every block of candidates. Both kinds are dealt onto the sides of a grid, a block is
    repeated along the other side; a cell's rows follow each other, its candidates first. Cells are limited by the bytes
    of their candidates, and are some more than the tasks that run at once, if there are blocks enough."""
    tasks = 4 * anchors.sparkSession.sparkContext.defaultParallelism
    blocks, size = candidates.agg(F.count("*"), F.sum("size")).first()
    c_side = max(1, min(blocks, max(-(-(size or 0) // settings.cell), tasks)))
    a_side = max(1, min(anchors.count(), -(-tasks // c_side)))

    def side(frame: DataFrame, own: int, other: int, is_anchor: bool, place: str) -> DataFrame:
        named = frame.select(*(F.col(x).alias(f"block_{x}") for x in frame.columns), F.lit(is_anchor).alias("is_anchor"))
        named = named.withColumn("own", F.pmod(F.xxhash64("block_block"), F.lit(own)).cast("int"))
        named = named.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(other - 1))))
        return named.withColumn("cell", F.expr(place)).drop("own", "other")

    dealt = side(candidates, c_side, a_side, False, f"other * {c_side} + own").unionByName(
        side(anchors, a_side, c_side, True, f"own * {c_side} + other"), allowMissingColumns=True
    )
    keys = F.array(*map(F.lit, _keys(anchors.sparkSession, a_side * c_side)))
    dealt = dealt.withColumn("cell", F.element_at(keys, F.col("cell") + 1))
    return dealt.repartition(a_side * c_side, "cell").sortWithinPartitions("cell", "is_anchor", "block_block")


def _met(batches: Iterator[pa.RecordBatch], start, same: bool) -> Iterator[tuple[_Block, dict, _Firsts]]:
    """Each block of anchors of each cell, its row, and what was found for it among the cell's candidates; `start` makes
    the empty lists of a block."""
    cell, candidates = None, []
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if row["cell"] != cell:
                cell, candidates = row["cell"], []
            block = _Block(row, "block")
            if not row["is_anchor"]:
                candidates.append(block)
                continue
            found = start(block, row)
            for seen, c in enumerate(candidates, 1):
                _search(Bounds(block, c), found, same)
                if not seen & (seen - 1):
                    found.merge()
            found.merge()
            yield block, row, found


def positives(anchors: DataFrame, candidates: DataFrame, settings: Settings) -> DataFrame:
    """The first rows of each anchor's own label, other than itself."""

    def start(a: _Block, row: dict) -> _Firsts:
        shape = (len(a.row), 1)
        return _Firsts(np.full(shape, _NONE + 1), np.full(shape, np.iinfo(np.int64).max), settings.positives)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, row, found in _met(batches, start, True):
            k, _, score, own, other = found.rows()
            if len(k):
                yield _batch([np.full(len(k), row["block_block"]), a.row[k], a.id[k], score, own, other], _POSITIVES)

    found = _cells(anchors, candidates, settings).mapInArrow(look, _POSITIVES)
    first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= settings.positives)


def _windows(a: _Block, row: dict, settings: Settings) -> tuple[np.ndarray, ...]:
    """Least and largest score asked for, and row, id and score of the positive, by anchor and place of the positive."""
    at = {int(r): k for k, r in enumerate(a.row)}
    shape = (len(a.row), settings.positives)
    least, most = np.full(shape, np.iinfo(np.int64).max), np.full(shape, _NONE)
    positive = np.zeros((3, *shape), np.int64)
    for p in row["block_positives"]:
        k = at[p["anchor_row"]], p["place"] - 1
        least[k], most[k] = -(-settings.low * p["score"] // 100), settings.high * p["score"] // 100
        positive[:, *k] = p["row"], p["id"], p["score"]
    return least, most, positive


def mine(rows: DataFrame, is_anchor: Column, label: Column | str = "label", settings: Settings = Settings()) -> DataFrame:
    """For each anchor (a row of vec_id, embedding and label for which `is_anchor`, a condition on id, holds) and each of
    its positives, the first negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    prepared = prepare(rows, label)
    candidates = _blocks(prepared, settings.candidates, False, "negatives-candidates")
    anchors = _blocks(prepared.filter(is_anchor), settings.anchors, True, "negatives-anchors")
    chosen = stored(positives(anchors, candidates, settings), "negatives-positives")
    # at most `positives` entries for each of a block's anchors
    by_block = chosen.groupBy("block").agg(F.collect_list(F.struct("anchor_row", "place", "score", "id", "row")).alias("positives"))
    windowed = anchors.join(by_block.hint("merge"), "block")  # blocks are never sent to the driver

    def start(a: _Block, row: dict) -> _Firsts:
        least, most, row["positive"] = _windows(a, row, settings)
        return _Firsts(least, most, settings.negatives)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, row, found in _met(batches, start, False):
            k, w, score, own, other = found.rows()
            if len(k):
                yield _batch([a.row[k], a.id[k], *row["positive"][:, k, w], score, own, other], _FOUND)

    found = _cells(windowed, candidates, settings).mapInArrow(look, _FOUND)
    first = Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= settings.negatives)
    return ranked.select(
        "anchor_id",
        F.when(F.col("positive_id") != _NO_ID, F.col("positive_id")).alias("positive_id"),
        "rank",
        F.when(F.col("id") != _NO_ID, F.col("id")).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
