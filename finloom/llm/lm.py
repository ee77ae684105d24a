"""Language-model scores by prediction by partial matching (PPM), and a smoothed word baseline beside them.

The trie holds, for every byte context of up to `depth` bytes, the bytes that followed it in the training texts. With n
occurrences and d different bytes in the longest known context, a byte seen c times there is coded with (2c - 1) / 2n;
if it is new, an escape d / 2n leads to the next shorter context, where the bytes the longer one has seen are excluded
from n and d; at last all bytes left are equally likely. Texts begin after START bytes and end with an END byte, neither
of which UTF-8 has. Because longer contexts extend shorter ones, the counts of the longest grams hold all others.

Neither the trie nor the word counts have a bound, so neither is collected or broadcast, and the depth is the same at
every size. Tasks cut their documents into chunks of about CHUNK bytes and write for each its texts, the dictionary of
its grams and the dictionary of its words (sorted numbers with training counts, packed).

- Grams: the trie is dealt by the two bytes before the coded one, so a part holds all contexts of two bytes and more
  that its grams can escape to; the orders below are one table of at most 2^16 grams, which every task gets. The counts
  are merged in each task before the shuffle. Each part then scores the chunks' grams that fall into it, each different
  gram once however often it occurs; a part that is asked much is repeated (salted) by its measured load.
- Words: the dictionaries are cut into hash ranges, as many as their total size asks for, and summed range by range.
- Each chunk gets its answers back, one packed row per part and range, and scores its documents with them.

A passage, word or source in a third of all documents is one entry per chunk. Two different words share a hash once in
about 10^19 pairs.

Defined results: null texts are empty texts, an empty text is its end alone; without training texts the trie is empty and
all bytes are equally likely; repeated rows are scored each; memory follows the longest single text; other columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.langid import SortedHashes
from finloom.llm.store import stored
from finloom.llm.tokens import as_bytes, mix, word_hashes

DEPTH = 5
NEAR = 2  # context bytes by which the trie is dealt
CHUNK = 12 << 20
RANGE = 16 << 20  # bytes of dictionaries, 16 for each entry, worked on in one group
START, END = 255, 254
_SYMBOLS = 256  # bytes a text may go on with, END among them
_pack = pa.Codec("zstd")

SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
    "score double, n_bytes bigint"
)


def packed(x: np.ndarray) -> bytes:
    """Bytes that say their length; increasing numbers are kept as differences."""
    raw = x.tobytes()
    return len(raw).to_bytes(8, "little") + _pack.compress(raw, asbytes=True)


def unpacked(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(_pack.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True), kind)


# --- the trie ------------------------------------------------------------------------------------------------


def grams(text: bytes, depth: int) -> np.ndarray:
    """Each byte of the text and its END with the `depth` bytes before it, as one number."""
    codes = np.frombuffer(bytes([START]) * depth + text + bytes([END]), np.uint8).astype(np.uint64)
    out = np.zeros(len(codes) - depth, np.uint64)
    for j in range(depth + 1):
        out = (out << np.uint64(8)) | codes[j : j + len(out)]
    return out


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.zeros(0, np.int64)


class Trie:
    """Grams and contexts of every order as sorted arrays.

    `low`: grams and counts of order NEAR - 1, where `keys` are only a part of all grams.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.depth = depth
        self.grams: list[tuple[SortedHashes, np.ndarray]] = []  # by order: mixed gram -> count
        self.contexts: list[tuple[SortedHashes, np.ndarray]] = []  # mixed context -> (n, d, excluded n below)
        levels = [(keys, counts)]
        for order in range(depth - 1, -1, -1):
            above = low if low is not None and order == NEAR - 1 else levels[-1]
            levels.append(summed([shorter(above[0], order)], [above[1]]))
        levels.reverse()
        for order, (own, count) in enumerate(levels):
            context = own >> np.uint64(8)
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(own) else np.zeros(0, int)
            n = np.add.reduceat(count, first) if len(own) else np.zeros(0, np.int64)
            d = np.diff(np.append(first, len(own)))
            if order:
                below_keys, below = levels[order - 1]
                at = np.searchsorted(below_keys, shorter(own, order - 1))
                excluded = np.add.reduceat(below[at], first) if len(own) else np.zeros(0, np.int64)
            else:
                excluded = np.zeros(len(first), np.int64)
            self.grams.append(self._index(own, count[:, None]))
            self.contexts.append(self._index(context[first], np.stack([n, d, excluded], 1)))

    @staticmethod
    def _index(keys: np.ndarray, values: np.ndarray) -> tuple[SortedHashes, np.ndarray]:
        hashes = mix(keys)  # one to one
        order = np.argsort(hashes)
        return SortedHashes(hashes[order]), values[order].astype(np.float64)

    def of_grams(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each gram after the others."""
        out = np.zeros(len(gram))
        left = np.arange(len(gram))
        gone_n, gone_d = np.zeros(len(gram)), np.zeros(len(gram))  # excluded by the longer context
        for order in range(self.depth, -1, -1):
            own = shorter(gram[left], order)
            index, values = self.contexts[order]
            at = index.find(mix(own >> np.uint64(8)))
            known = at >= 0
            state = values[at] if len(values) else np.zeros((len(at), 3))
            n = np.where(known, state[:, 0] - gone_n, 0.0)
            d = np.where(known, state[:, 1] - gone_d, 0.0)
            index, counts = self.grams[order]
            rows = index.find(mix(own))
            hit = rows >= 0
            if hit.any():
                out[left[hit]] += np.log10((counts[rows[hit], 0] - 0.5) / n[hit])
            escape = ~hit
            live = escape & (d > 0)
            out[left[live]] += np.log10(d[live] / (2 * n[live]))
            if order:
                gone_n = np.where(known, state[:, 2], 0.0)[escape]
            gone_d = np.where(known, state[:, 1], 0.0)[escape]
            left = left[escape]
            if not len(left):
                return out
        out[left] -= np.log10(np.maximum(_SYMBOLS - gone_d, 1.0))
        return out

    def log10(self, texts: list[bytes], block: int = 1 << 19) -> np.ndarray:
        """log10 probability of each whole text and its end."""
        return by_text(texts, self.depth, self.of_grams, block)


def shorter(gram: np.ndarray, order: int) -> np.ndarray:
    """The grams with only `order` bytes of context."""
    return gram & np.uint64((1 << (8 * (order + 1))) - 1)


def by_text(
    texts: list[bytes], depth: int, of_grams: Callable[[np.ndarray], np.ndarray], block: int = 1 << 19
) -> np.ndarray:
    """Sum over each text's grams, about `block` of them at once."""
    total = np.zeros(len(texts))
    held, owners, size = [], [], 0

    def add():
        every = of_grams(np.concatenate(held))
        places = np.cumsum([0, *(len(x) for x in held[:-1])])
        np.add.at(total, owners, np.add.reduceat(every, places))

    for i, text in enumerate(texts):
        every = grams(text, depth)
        for at in range(0, len(every), block):
            held.append(every[at : at + block])
            owners.append(i)
            size += len(held[-1])
            if size >= block:
                add()
                held, owners, size = [], [], 0
    if held:
        add()
    return total


def gram_counts(texts: list[bytes], depth: int, block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """The texts' different grams and their counts."""
    tables, held, size = Tables(), [], 0
    for text in texts:
        held.append(grams(text, depth))
        size += len(held[-1])
        if size > block:
            tables.add(*np.unique(np.concatenate(held), return_counts=True))
            held, size = [], 0
    if held:
        tables.add(*np.unique(np.concatenate(held), return_counts=True))
    return tables.merged()


class Tables:
    """Tables of counts, merged as they come; at most MOST beside each other."""

    MOST = 8

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        if len(self.keys) > self.MOST:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = summed(self.keys, self.counts)
        self.keys, self.counts = [keys], [counts]
        return keys, counts


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(x: bytes) -> np.ndarray:
    return np.cumsum(unpacked(x, np.uint64), dtype=np.uint64)


def part_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Part of each gram: a hash of the NEAR bytes before the last."""
    near = shorter(keys >> np.uint64(8), NEAR - 1)
    return (mix(near + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _by_part(keys: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys in order) of each part that occurs."""
    part = part_of(keys, bits)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange((1 << bits) + 1))
    for p in np.flatnonzero(np.diff(edges)):
        yield int(p), order[edges[p] : edges[p + 1]]


_TRIE = "part int, asked bigint, keys binary, counts binary"


def _trie_row(part: int, asked: int, keys: np.ndarray, counts: np.ndarray) -> dict:
    return {"part": part, "asked": asked, "keys": packed_keys(keys), "counts": packed(counts.astype(np.int64))}


_TRIE_ARROW = pa.schema([("part", pa.int32()), ("asked", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _trie(chunks: DataFrame, bits: int) -> DataFrame:
    """The training grams and counts of each part, and how many grams the chunks ask it for."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, asked = Tables(), np.zeros(1 << bits, np.int64)
        for batch in batches:
            for k, c in zip(batch.column("gram_keys").to_pylist(), batch.column("gram_counts").to_pylist()):
                keys, counts = unpacked_keys(k), unpacked(c, np.int64)
                asked += np.bincount(part_of(keys, bits), minlength=1 << bits)
                tables.add(keys, counts)
        keys, counts = tables.merged()
        for p, own in _by_part(keys, bits):
            own = own[counts[own] > 0]
            yield pa.RecordBatch.from_pylist([_trie_row(p, int(asked[p]), keys[own], counts[own])], _TRIE_ARROW)

    def merge(table: pa.Table) -> pa.Table:
        tables = Tables()
        for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist()):
            tables.add(unpacked_keys(k), unpacked(c, np.int64))
        asked = sum(table["asked"].to_pylist())
        return pa.Table.from_pylist([_trie_row(table["part"][0].as_py(), asked, *tables.merged())], _TRIE_ARROW)

    rows = chunks.select("gram_keys", "gram_counts").mapInArrow(gather, _TRIE)
    return rows.groupBy("part").applyInArrow(merge, _TRIE)


def _low(trie: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Grams of order NEAR - 1 and their counts: at most 256^NEAR."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            for k, c in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                tables.add(*summed([shorter(unpacked_keys(k), NEAR - 1)], [unpacked(c, np.int64)]))
        keys, counts = tables.merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], ["gram", "n"])

    rows = trie.select("keys", "counts").mapInArrow(cut, "gram bigint, n bigint")
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).orderBy("gram").toArrow()
    return found["gram"].to_numpy().astype(np.uint64), found["n"].to_numpy().astype(np.int64)


def _gram_logs(chunks: DataFrame, depth: int, bits: int, load: int) -> DataFrame:
    """For each chunk and part: the log10 probabilities of the chunk's grams, in their order."""
    trie = stored(_trie(chunks, bits), "lm-trie")
    low = chunks.sparkSession.sparkContext.broadcast(_low(trie))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, k in zip(batch.column("chunk").to_pylist(), batch.column("gram_keys").to_pylist()):
                keys = unpacked_keys(k)
                for p, own in _by_part(keys, bits):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk]), pa.array([p], pa.int32()), pa.array([packed_keys(keys[own])], pa.binary())],
                        ["chunk", "part", "keys"],
                    )

    def answer(key, asked: pa.Table, parts: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in asked["keys"].to_pylist()]
        logs = []
        if keys:  # a repeated part may be asked nothing
            own = Tables()
            for k in keys:
                own.add(k, np.zeros(len(k), np.int64))
            every = own.merged()[0]
            known = unpacked_keys(parts["keys"][0].as_py()), unpacked(parts["counts"][0].as_py(), np.int64)
            found = Trie(*known, depth, low.value).of_grams(every).astype(np.float32)
            logs = [packed(found[np.searchsorted(every, k)]) for k in keys]
        return pa.table(
            {
                "chunk": pa.array(asked["chunk"].to_pylist(), pa.string()),
                "part": pa.array(asked["part"].to_pylist(), pa.int32()),
                "logs": pa.array(logs, pa.binary()),
            }
        )

    repeats = F.ceil(F.greatest(F.col("asked"), F.lit(1)) * 16 / load).cast("int")
    sizes = F.broadcast(trie.select("part", repeats.alias("repeats")))  # at most 2^(8 NEAR) rows
    asked = chunks.select("chunk", "gram_keys").mapInArrow(cut, "chunk string, part int, keys binary").join(sizes, "part")
    asked = asked.select("chunk", "part", "keys", F.pmod(F.xxhash64("chunk"), F.col("repeats")).cast("int").alias("salt"))
    parts = trie.select("part", "keys", "counts", F.explode(F.sequence(F.lit(0), repeats - 1)).alias("salt"))
    return (
        asked.groupBy("part", "salt")
        .cogroup(parts.groupBy("part", "salt"))
        .applyInArrow(answer, "chunk string, part int, logs binary")
    )


def _packed_row(part: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    columns = [
        pa.array([part], pa.int32()),
        pa.array([packed_keys(keys)], pa.binary()),
        pa.array([packed(counts.astype(np.int64))], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "keys", "counts"])


# --- words ---------------------------------------------------------------------------------------------------

_CHUNKS = (
    "chunk string, n_words bigint, keys binary, counts binary, cells binary, cell_counts binary, "
    "n_grams bigint, gram_keys binary, gram_counts binary, texts binary, "
    "doc_ids array<bigint>, learn array<boolean>, n_tokens array<bigint>, n_bytes array<bigint>"
)


def _chunk(ids: list, learn: list, texts: list[bytes], depth: int) -> pa.RecordBatch:
    words, per_text = word_hashes(texts, fold=True)
    keys, place = np.unique(words, return_inverse=True)
    owner = np.repeat(np.arange(len(texts)), per_text)
    taught = np.repeat(np.array(learn, bool), per_text)
    counts = np.bincount(place[taught], minlength=len(keys)).astype(np.int64)
    known, seen = gram_counts([t for t, x in zip(texts, learn) if x], depth)
    other, _ = gram_counts([t for t, x in zip(texts, learn) if not x], depth)
    every, gram_n = summed([known, other], [seen, np.zeros(len(other), np.int64)])
    cells, cell_counts = np.unique(owner * max(1, len(keys)) + place, return_counts=True)
    values = [
        ([uuid.uuid4().hex], pa.string()),
        ([len(keys)], pa.int64()),
        ([packed_keys(keys)], pa.binary()),
        ([packed(counts)], pa.binary()),
        ([packed(np.diff(cells, prepend=0).astype(np.int64))], pa.binary()),
        ([packed(cell_counts.astype(np.int64))], pa.binary()),
        ([len(every)], pa.int64()),
        ([packed_keys(every)], pa.binary()),
        ([packed(gram_n)], pa.binary()),
        ([packed(np.frombuffer(b"".join(texts), np.uint8))], pa.binary()),
        ([ids], pa.list_(pa.int64())),
        ([learn], pa.list_(pa.bool_())),
        ([(per_text + 1).tolist()], pa.list_(pa.int64())),
        ([[len(x) for x in texts]], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays([pa.array(*v) for v in values], [c.split()[0] for c in _CHUNKS.split(", ")])


def _chunks(documents: DataFrame, learn: Column, depth: int) -> DataFrame:
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, flags, texts, size = [], [], [], 0
        for batch in batches:
            columns = batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist(), as_bytes(batch.column("text"))
            for doc_id, flag, text in zip(*columns):
                ids.append(doc_id)
                flags.append(flag)
                texts.append(text)
                size += len(text) + 8
                if size >= CHUNK:
                    yield _chunk(ids, flags, texts, depth)
                    ids, flags, texts, size = [], [], [], 0
        if ids:
            yield _chunk(ids, flags, texts, depth)

    return rows.mapInArrow(cut, _CHUNKS)


def _sums(chunks: DataFrame, ranges: int) -> DataFrame:
    """For each chunk and hash range: how often its words, in their order, occur in all training texts."""
    bits = ranges.bit_length() - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, k, c in zip(*(batch.column(x).to_pylist() for x in ("chunk", "keys", "counts"))):
                keys, counts = unpacked_keys(k), unpacked(c, np.int64)
                part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                edges = np.searchsorted(part, np.arange(ranges + 1))
                for p in np.flatnonzero(np.diff(edges)):
                    own = slice(edges[p], edges[p + 1])
                    row = _packed_row(int(p), keys[own], counts[own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk]), row.column("part"), row.column("keys"), row.column("counts")],
                        ["chunk", "part", "keys", "counts"],
                    )

    def merge(table: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        counts = [unpacked(x, np.int64) for x in table["counts"].to_pylist()]
        own, total = summed(keys, counts)
        n = len(keys)
        return pa.table(
            {
                "chunk": table["chunk"],
                "part": table["part"],
                "totals": pa.array([packed(total[np.searchsorted(own, k)]) for k in keys], pa.binary()),
                # said once in each range
                "distinct": pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64()),
                "occurrences": pa.array([int(total.sum())] + [0] * (n - 1), pa.int64()),
            }
        )

    rows = chunks.select("chunk", "keys", "counts").mapInArrow(cut, "chunk string, part int, keys binary, counts binary")
    kind = "chunk string, part int, totals binary, distinct bigint, occurrences bigint"
    return rows.groupBy("part").applyInArrow(merge, kind)


def score(documents: DataFrame, learn: Column, depth: int = DEPTH, load: int = RANGE) -> DataFrame:
    """SCORES of every document; texts of rows for which `learn` holds teach both models. depth: NEAR to 7."""
    chunks = stored(_chunks(documents, learn, depth), "lm-chunks")
    total = chunks.agg(F.sum("n_words").alias("words"), F.sum("n_grams").alias("grams")).first()
    ranges = 1 << max(0, ((total["words"] or 0) * 16 // load).bit_length())
    bits = min(8 * NEAR, ((total["grams"] or 0) * 16 // load).bit_length())
    sums = stored(_sums(chunks, ranges), "lm-sums")
    counted = sums.agg(F.sum("distinct").alias("v"), F.sum("occurrences").alias("n")).first()
    ends = chunks.agg(F.sum(F.size(F.filter("learn", lambda x: x))).alias("n")).first()["n"] or 0
    n = (counted["n"] or 0) + ends
    v = (counted["v"] or 0) + (1 if ends else 0)
    norm = float(np.log10(n + 0.5 * (v + 1)))
    end_log = float(np.log10(ends + 0.5))

    def finish(key, docs: pa.Table, parts: pa.Table) -> pa.Table:
        columns = [c.split()[0] for c in SCORES.split(", ")]
        if not len(docs):
            return pa.table({c: pa.array([], k) for c, k in zip(columns, _KINDS)})
        row = {c: docs[c][0].as_py() for c in docs.column_names}
        parts = parts.sort_by([("kind", "ascending"), ("part", "ascending")])
        answers = list(zip(parts["kind"].to_pylist(), parts["answer"].to_pylist()))
        totals = np.concatenate([np.zeros(0, np.int64), *(unpacked(x, np.int64) for kind, x in answers if kind == "word")])
        keys = unpacked_keys(row["gram_keys"])
        logs = np.empty(len(keys))
        logs[np.argsort(part_of(keys, bits), kind="stable")] = np.concatenate(
            [unpacked(x, np.float32) for kind, x in answers if kind == "gram"]
        )
        hashes = mix(keys)
        order = np.argsort(hashes)
        index, logs = SortedHashes(hashes[order]), logs[order]
        every, ends_at = unpacked(row["texts"], np.uint8).tobytes(), np.cumsum(row["n_bytes"])
        texts = [every[end - size : end] for end, size in zip(ends_at.tolist(), row["n_bytes"])]
        scores = by_text(texts, depth, lambda g: logs[index.find(mix(g))])
        cells = np.cumsum(unpacked(row["cells"], np.int64))
        weight = unpacked(row["cell_counts"], np.int64)
        owner, place = np.divmod(cells, max(1, row["n_words"]))
        size = len(row["doc_ids"])
        base = np.bincount(owner, weights=weight * np.log10(totals[place] + 0.5), minlength=size)
        known = np.bincount(owner, weights=weight * (totals[place] > 0), minlength=size).astype(np.int64)
        tokens = np.array(row["n_tokens"])
        values = [
            row["doc_ids"],
            [not x for x in row["learn"]],
            tokens,
            known + (1 if ends else 0),
            np.full(size, n, np.int64),
            base + end_log - tokens * norm,
            scores,
            row["n_bytes"],
        ]
        return pa.table({c: pa.array(x, k) for c, x, k in zip(columns, values, _KINDS)})

    words = sums.select("chunk", F.lit("word").alias("kind"), "part", F.col("totals").alias("answer"))
    logs = _gram_logs(chunks, depth, bits, load)
    answers = words.unionByName(logs.select("chunk", F.lit("gram").alias("kind"), "part", F.col("logs").alias("answer")))
    own = ("n_words", "cells", "cell_counts", "gram_keys", "texts", "doc_ids", "learn", "n_tokens", "n_bytes")
    return (
        chunks.select("chunk", *own).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, SCORES)
    )


_KINDS = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
