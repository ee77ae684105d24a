"""Repeated byte strings across a corpus, by suffix arrays built with Lyndon grouping.

Every byte covered by a string of W bytes that also starts anywhere else, in the same text or another, is found.

1. Equal texts are one text with a count (by the first 16 bytes of SHA-256); one that occurs twice is repeated as a whole.
   Texts are stored once, bucketed by that id: later steps send places to the texts, never the texts.
2. Anchors: of the strings of K bytes within a window of W bytes, those with the smallest hash. Equal windows have equal
   anchors at equal places, so each repeated window shows in two anchors with the same hash. Others are dropped.
3. What lies around an anchor (at most W - K bytes either side) holds all windows that have it. Anchors with the same
   surroundings are a class; in a class of two or more, all is repeated. One member stands for its class.
4. Different classes of one anchor are compared by a suffix array. Only at the depths where two of them part does a
   symbol begin, so a string of a few symbols stands for the surroundings, none of them lost. The array of many such
   groups together is built by the linear grouping construction: suffixes are grouped by their Lyndon prefix, groups
   taken in descending order move the previous smaller suffixes of their members to new groups, and then each group's
   order follows from its members' next smaller suffixes, without renaming and recursion. A suffix's longest match is at
   one of its neighbours.
5. Anchors with more than LIMIT classes (text that very many documents share, in different surroundings) are halved by
   the place of the anchor in the window: windows of one half have more bytes in common, which split the group. Each half
   is again reduced to classes. After at most log2(W - K) + 1 rounds a half is a single window, that is a class of its own.

Only places and digests are shuffled, counted before they move; no step gathers a group of unbounded size in one task,
and none collects anything to the driver. Keys and digests have 128 bits.

Defined results: null texts are empty; texts shorter than W have nothing repeated; matches never cross texts; cuts may
divide a character, so kept bytes are binary; rows that repeat each other are occurrences of one text; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.store import stored
from finloom.llm.tokens import span_hashes
from finloom.scratch import fresh_schema

W = 400
K = 200
LIMIT = 32  # classes of one group that a suffix array compares at once; larger groups are halved first
_PIECE = 1 << 20  # bytes handled at a time
_SYMBOLS = 1 << 15  # symbols of one suffix array


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes in increasing order, a shorter one before its extensions."""
    n = len(text)
    groups: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        groups.setdefault(symbol, []).append(i)
    members, after, before, group = [], [], [], [0] * n
    for symbol in sorted(groups):
        for i in groups[symbol]:
            group[i] = len(members)
        members.append(groups[symbol])
        after.append(len(members))
        before.append(len(members) - 2)
    if not members:
        return []
    after[-1] = -1
    # first part: groups in descending order; what a group's members point to moves to a group right above its own
    previous, done = [-1] * n, bytearray(n)
    at = len(members) - 1
    while at >= 0:
        own = [i for i in members[at] if group[i] == at]
        members[at] = own
        for i in own:
            done[i] = 1
        moved: dict[tuple[int, int], list[int]] = {}
        last, times = -1, 0
        for i in own:  # ascending, so pointers ascend too and equal ones are next to each other
            j = i - 1
            while j >= 0 and done[j]:
                j = previous[j]
            previous[i] = j
            if j < 0:
                continue
            if j == last:
                times += 1
                continue
            if last >= 0:
                moved.setdefault((times, group[last]), []).append(last)
            last, times = j, 1
        if last >= 0:
            moved.setdefault((times, group[last]), []).append(last)
        for times, old in sorted(moved, reverse=True):
            new = len(members)
            part = moved[times, old]
            members.append(part)
            for i in part:
                group[i] = new
            above = after[old]
            after.append(above)
            before.append(old)
            after[old] = new
            if above >= 0:
                before[above] = new
        at = before[at]
    # second part: every suffix is placed when the next smaller one is met, groups fill from their lower end
    at = 0
    free, count = [0] * len(members), 0
    while at >= 0:  # the lowest group never moves
        free[at] = count
        count += len(members[at])
        at = after[at]
    order, placed = [0] * n, bytearray(n)

    def place(i: int) -> None:
        while i >= 0 and not placed[i]:
            g = group[i]
            order[free[g]] = i
            free[g] += 1
            placed[i] = 1
            i = previous[i]

    place(n - 1)
    for k in range(n):
        place(order[k] - 1)
    return order


def longest_matches(text: list[int]) -> list[int]:
    """For each suffix the length of its longest match with another one."""
    n = len(text)
    order = suffix_array(text)
    rank = [0] * n
    for k, i in enumerate(order):
        rank[i] = k
    best = [0] * n
    length = 0
    for i in range(n):
        k = rank[i]
        if not k:
            length = 0
            continue
        j = order[k - 1]
        end = n - (i if i > j else j)
        while length < end and text[i + length] == text[j + length]:
            length += 1
        if length > best[i]:
            best[i] = length
        if length > best[j]:
            best[j] = length
        if length:
            length -= 1
    return best


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` over every `width` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    return pick(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def anchors(texts: list[bytes], w: int = W, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of the strings of k bytes that are smallest by hash in a window of w bytes, ties included."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for begin in range(0, max(len(text) - w + 1, 0), _PIECE):  # every window lies within a piece
            piece = text[begin : begin + _PIECE + w - 1]
            held.append((i, begin, piece))
            size += len(piece)
            if size >= _PIECE:
                found.append(_anchors(held, w, k))
                held, size = [], 0
    if held:
        found.append(_anchors(held, w, k))
    owner, place, key = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((place, owner))
    owner, place, key = owner[order], place[order], key[order]
    new = np.ones(len(owner), bool)  # neighbouring pieces find some twice
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    return owner[new], place[new], key[new]


def _anchors(held: list[tuple[int, int, bytes]], w: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for *_, x in held])
    ends = np.cumsum(sizes)
    buffer = np.frombuffer(b"".join(x for *_, x in held), np.uint8)
    n = len(buffer)
    piece = np.repeat(np.arange(len(held)), sizes)
    at = np.arange(n - k + 1)
    left = ends[piece] - np.arange(n)  # bytes from here to the piece's end
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    key = np.where(left[: n - k + 1] >= k, span_hashes(buffer, at, at + k) | np.uint64(1), none)
    width = w - k + 1
    least = _slide(key, width, np.minimum)
    least = np.where(left[: len(least)] >= w, least, np.uint64(0))  # windows within one piece
    edge = np.zeros(width - 1, np.uint64)
    most = _slide(np.concatenate([edge, least, edge]), width, np.maximum)
    hit = np.flatnonzero((most[: len(key)] == key) & (key != none))
    owner, begin = np.array([i for i, *_ in held]), np.array([b for _, b, _ in held])
    starts = ends - sizes
    return owner[piece[hit]], begin[piece[hit]] + hit - starts[piece[hit]], key[hit]


def _partings(sides: list[bytes], group: list[int]) -> tuple[list[int], np.ndarray]:
    """Rows in order of group and side, and how far each agrees with the one before (-1 where a group begins)."""
    order = sorted(range(len(sides)), key=lambda i: (group[i], sides[i]))
    width = max(map(len, sides), default=0)
    size = np.array([len(sides[i]) for i in order])
    matrix = np.frombuffer(b"".join(sides[i].ljust(width, b"\0") for i in order), np.uint8).reshape(len(order), width)
    agree = np.full(len(order), -1)
    if len(order) > 1:
        differ = matrix[1:] != matrix[:-1] if width else np.zeros((len(order) - 1, 1), bool)
        until = np.where(differ.any(1), differ.argmax(1), width)
        agree[1:] = np.minimum(until, np.minimum(size[1:], size[:-1]))
        g = np.array([group[i] for i in order])
        agree[1:][g[1:] != g[:-1]] = -1
    return order, agree


def _symbols(sides: list[bytes], group: list[int], side: int, names: dict) -> list[list[tuple[int, int]]]:
    """For each row (depth, symbol) at the depths where rows of its group part, as far as another row agrees with it.
    Two rows have the same symbol at a depth if and only if they agree up to it."""
    order, agree = _partings(sides, group)
    steps = agree.tolist()
    out: list[list[tuple[int, int]]] = [[] for _ in sides]
    begin, n = 0, len(order)
    while begin < n:
        end = begin + 1
        while end < n and steps[end] >= 0:
            end += 1
        depths = sorted({d for d in steps[begin + 1 : end] if d})
        since = dict.fromkeys(depths, begin)
        for t in range(begin, end):
            here = steps[t]
            reach = max(here, steps[t + 1] if t + 1 < end else -1)
            own = out[order[t]]
            for d in depths:
                if here < d:
                    since[d] = t
                if d <= reach:
                    own.append((d, names.setdefault((side, since[d], d), len(names))))
        begin = end
    return out


def matched(group: list[int], left: list[bytes], right: list[bytes], width: int) -> list[tuple[int, int] | None]:
    """Rows are surroundings of an anchor, `left` read outwards from it, in groups with equal anchors. For each row how
    far windows reach to either side that have `width` bytes beside the anchor and occur in another row of its group."""
    names: dict = {}
    lefts, rights = _symbols(left, group, 0, names), _symbols(right, group, 1, names)
    text: list[int] = []
    base = len(names)
    spans: list[tuple[int, int, int]] = []  # row, start, place of its anchor
    for row, (a, b) in enumerate(zip(lefts, rights)):
        if (a[-1][0] if a else 0) + (b[-1][0] if b else 0) < width:
            continue  # no other row agrees far enough
        start = len(text)
        text += [s for _, s in reversed(a)]
        spans.append((row, start, len(text)))
        text.append(base + group[row])
        text += [s for _, s in b]
    out: list[tuple[int, int] | None] = [None] * len(left)
    longest = longest_matches(text)
    for row, start, core in spans:
        a, b = lefts[row], rights[row]
        back = ahead = -1
        for at in range(start, core + 1):
            beyond = min(longest[at] - (core - at) - 1, len(b))  # symbols matched after the anchor's
            if beyond < 0:
                continue
            x = a[core - at - 1][0] if at < core else 0
            y = b[beyond - 1][0] if beyond else 0
            if x + y >= width:
                back, ahead = max(back, x), max(ahead, y)
        if back >= 0:
            out[row] = (back, ahead)
    return out


def text_id(text: Column) -> Column:
    """What equal texts have in common: the first 16 bytes of SHA-256."""
    return F.substring(F.unhex(F.sha2(as_binary(text), 256)), 1, 16)


def as_binary(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def _digest(value: bytes) -> bytes:
    return xxhash.xxh3_128_digest(value)


def _distinct_texts(documents: DataFrame, text: str, w: int) -> DataFrame:
    """Different texts of at least w bytes with their numbers, stored in buckets by id."""
    spark = documents.sparkSession
    body = as_binary(F.col(text))
    rows = documents.select(body.alias("body")).filter(F.octet_length("body") >= w)
    rows = rows.select(F.substring(F.unhex(F.sha2("body", 256)), 1, 16).alias("id"), "body")
    texts = rows.groupBy("id").agg(F.count("*").alias("copies"), F.first("body").alias("body"))
    table = f"{fresh_schema(spark, 'substrings')}.texts"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.write.bucketBy(buckets, "id").option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


def _places(texts: DataFrame, w: int, k: int) -> DataFrame:
    """id, at, key of every anchor."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies = batch.column("id"), batch.column("body")
            size = 0
            begin = 0
            held: list[bytes] = []
            for i in range(batch.num_rows):
                held.append(bodies[i].as_py())
                size += len(held[-1])
                if size >= _PIECE or i + 1 == batch.num_rows:
                    owner, place, key = anchors(held, w, k)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(owner + begin)), pa.array(place), pa.array(key.view(np.int64))], ["id", "at", "key"]
                    )
                    begin, held, size = i + 1, [], 0

    return texts.select("id", "body").mapInArrow(look, "id binary, at bigint, key bigint")


def _with_texts(texts: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """The texts that have places, with their places in `wanted`; only the places are shuffled. A text has at most one
    place a byte."""
    by_text = places.groupBy("id").agg(F.collect_list(F.struct(*columns)).alias("wanted"))
    return texts.join(by_text.hint("shuffle_hash"), "id")


_AROUND = "id binary, at bigint, key bigint, core bigint, class binary"


def _around(texts: DataFrame, places: DataFrame, w: int, k: int) -> DataFrame:
    """Each place with a digest of its anchor and of all that windows with it can hold."""
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["id", "at", "key", "core", "class"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, body = batch.column("id")[i].as_py(), batch.column("body")[i].as_py()
                wanted = batch.column("wanted")[i].values
                out = []
                for at, key in zip(wanted.field("at").to_pylist(), wanted.field("key").to_pylist()):
                    begin = max(at + k - w, 0)
                    core = xxhash.xxh3_64_intdigest(body[at : at + k]) - (1 << 63)
                    whole = (at - begin).to_bytes(4, "little") + body[begin : at + w]
                    out.append((own, at, key, core, _digest(whole)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return _with_texts(texts, places, ["at", "key"]).mapInArrow(look, _AROUND)


_SIDES = "key bigint, core bigint, class binary, done boolean, size bigint, back binary, ahead binary"


def _sides(texts: DataFrame, members: DataFrame, w: int, k: int) -> DataFrame:
    """The bytes before (outwards) and after each member's anchor, as far as windows with it reach."""
    names = [x.split()[0] for x in _SIDES.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                body = batch.column("body")[i].as_py()
                out = []
                for row in batch.column("wanted")[i].values.to_pylist():
                    at = row["at"]
                    sides = body[max(at + k - w, 0) : at][::-1], body[at + k : at + w]
                    out.append((row["key"], row["core"], row["class"], row["done"], row["size"], *sides))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    columns = ["at", "key", "core", "class", "done", "size"]
    return _with_texts(texts, members, columns).mapInArrow(look, _SIDES)


_REACH = "key bigint, core bigint, class binary, back bigint, ahead bigint"


def _compare(groups: DataFrame, w: int, k: int) -> DataFrame:
    """How far repeated windows reach around each member's anchor, from the suffix array of its group. Rows: one, two (the
    group), low and high (places of the anchor in the windows compared), key, core, class, done, back, ahead."""
    spread = w - k
    names = [x.split()[0] for x in _REACH.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())

    def compared(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        by_width: dict[int, list[dict]] = {}
        for r in rows:
            by_width.setdefault(r["high"] - r["low"], []).append(r)
        for width, same in by_width.items():
            numbers: dict[tuple[int, int], int] = {}
            group = [numbers.setdefault((r["one"], r["two"]), len(numbers)) for r in same]
            # windows have the anchor low to high bytes after their start: what all of them hold is alike in a group
            left = [r["back"][r["low"] : r["high"]] for r in same]
            right = [r["ahead"][spread - r["high"] : spread - r["low"]] for r in same]
            for r, x in zip(same, matched(group, left, right, width)):
                if x is not None and not r["done"]:
                    found.append((r["key"], r["core"], r["class"], r["low"] + x[0], spread - r["high"] + x[1]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                # a few symbols stand for a row; only whole groups are compared
                if len(held) >= _SYMBOLS // 8 and (held[-1]["one"], held[-1]["two"]) != (row["one"], row["two"]):
                    yield from compared(held)
                    held = []
                held.append(row)
        if held:
            yield from compared(held)

    columns = ["one", "two", "low", "high", "key", "core", "class", "done", "back", "ahead"]
    return groups.select(*columns).repartition("one", "two").sortWithinPartitions("one", "two").mapInArrow(look, _REACH)


def _hashed(*parts: Column | str) -> list[Column]:
    """128 bits of hash in two columns."""
    return [F.xxhash64(F.lit(salt), *parts) for salt in (1, 2)]


def _halved(hot: DataFrame, w: int, k: int, limit: int) -> list[DataFrame]:
    """What windows of large groups repeat: groups are halved by the anchor's place in the window, and reduced to classes
    again, until a task can compare them."""
    spread = F.lit(w - k)
    middle = ((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("low").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("high").alias("b"))
    )
    back, ahead = F.substring("back", F.lit(1), F.col("b")), F.substring("ahead", F.lit(1), spread - F.col("a"))
    # all windows of a half hold a bytes before the anchor and w - k - b after it
    shared = (F.substring("back", F.lit(1), F.col("a")), F.substring("ahead", F.lit(1), spread - F.col("b")))
    place, own = ["one", "two"], ["own_one", "own_two"]
    found = []
    while not hot.isEmpty():
        rows = hot.select("*", F.inline(halves))
        rows = rows.filter((F.octet_length("back") >= F.col("a")) & (F.octet_length("ahead") >= spread - F.col("b")))
        rows = rows.select(
            *(x.alias(name) for x, name in zip(_hashed("one", "two", "a", *shared), place)),
            *(x.alias(name) for x, name in zip(_hashed(F.octet_length(back), back, F.octet_length(ahead), ahead), own)),
            F.col("a").alias("low"), F.col("b").alias("high"), "key", "core", "class", "done",
            F.xxhash64("key", "core", "class").alias("tag"), back.alias("back"), ahead.alias("ahead"),
        )
        # hashing twice is cheaper than storing the bytes of all halves
        same = stored(rows.groupBy(*place, *own).agg(F.count("*").alias("n"), F.min("tag").alias("chosen")), "substrings-same")
        sizes = same.groupBy(*place).agg(F.count("*").alias("size"))
        same = stored(same.join(sizes, place).filter("size > 1 OR n > 1"), "substrings-sizes")
        rows = stored(rows.join(same, [*place, *own]), "substrings-groups")
        reach = [F.octet_length(x).cast("bigint").alias(x) for x in ("back", "ahead")]
        found.append(rows.filter("n > 1 AND NOT done").select("key", "core", "class", *reach))
        # one member goes on for its class; what a class of several repeats is known
        rest = rows.filter("tag = chosen AND size > 1").withColumn("done", F.col("done") | (F.col("n") > 1))
        found.append(_compare(rest.filter(F.col("size") <= limit), w, k))
        hot = rest.filter(F.col("size") > limit)
    return found


_CUT = "id binary, spans array<struct<start:bigint,length:bigint>>, kept binary"
_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])


def _cut(texts: DataFrame, reaches: DataFrame) -> DataFrame:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                body, wanted = batch.column("body")[i].as_py(), batch.column("wanted")[i].values
                begin, end = (wanted.field(f).to_numpy() for f in ("begin", "end"))
                order = np.argsort(begin)
                begin, end = begin[order], np.maximum.accumulate(np.minimum(end[order], len(body)))
                new = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
                starts, stops = begin[new], end[np.append(new[1:], len(begin)) - 1]
                kept = b"".join(body[a:b] for a, b in zip([0, *stops], [*starts, len(body)]))
                spans = [{"start": int(a), "length": int(b - a)} for a, b in zip(starts, stops)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, 1), pa.array([spans], pa.list_(_SPAN)), pa.array([kept], pa.binary())],
                    ["id", "spans", "kept"],
                )

    return _with_texts(texts, reaches, ["begin", "end"]).mapInArrow(look, _CUT)


def repeated_spans(
    documents: DataFrame, text: str = "text", w: int = W, k: int = K, limit: int = LIMIT
) -> DataFrame:
    """For each different text that has repeated strings of w bytes: id (see text_id), the maximal spans of bytes they
    cover, and the kept bytes. Texts without any have no row."""
    texts = _distinct_texts(documents, text, w)
    places = stored(_places(texts, w, k), "substrings-anchors")
    # stored first, so that a join meets plain rows on either side and a hot key can be split
    twice = stored(places.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "substrings-keys")
    around = stored(_around(texts, places.join(twice, "key"), w, k), "substrings-around")
    classes = around.groupBy("key", "core", "class").agg(F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("one"))
    classes = stored(classes, "substrings-classes")
    whole = classes.filter("n > 1").select(
        "key", "core", "class", F.lit(w - k).cast("bigint").alias("back"), F.lit(w - k).cast("bigint").alias("ahead")
    )
    sizes = classes.groupBy("key", "core").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = stored(sizes, "substrings-sizes")
    members = classes.join(sizes, ["key", "core"]).select(
        F.col("one.id").alias("id"), F.col("one.at").alias("at"), "key", "core", "class", (F.col("n") > 1).alias("done"), "size"
    )
    sides = _sides(texts, members, w, k).select(
        "*", F.col("key").alias("one"), F.col("core").alias("two"), F.lit(0).alias("low"), F.lit(w - k).alias("high")
    )
    sides = stored(sides, "substrings-sides")
    found = [whole, _compare(sides.filter(F.col("size") <= limit), w, k)]
    found += _halved(sides.filter(F.col("size") > limit), w, k, limit)
    reach = reduce(DataFrame.unionByName, found).groupBy("key", "core", "class")
    reach = stored(reach.agg(F.max("back").alias("back"), F.max("ahead").alias("ahead")), "substrings-reach")
    spans = around.join(reach, ["key", "core", "class"]).select(
        "id",
        F.greatest(F.col("at") - F.col("back"), F.lit(0)).alias("begin"),
        (F.col("at") + k + F.col("ahead")).alias("end"),  # or the text's end, if that is sooner
    )
    copied = texts.filter("copies > 1").select(
        "id",
        F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.octet_length("body").cast("bigint").alias("length"))).alias("spans"),
        F.lit(b"").alias("kept"),
    )
    return _cut(texts.filter("copies = 1"), spans).unionByName(copied)


def deduplicate(documents: DataFrame, text: str = "text", w: int = W, k: int = K, limit: int = LIMIT) -> DataFrame:
    """Every row with id, spans and kept bytes (see repeated_spans) beside its own columns."""
    rows = documents.withColumn("id", text_id(F.col(text)))
    found = repeated_spans(documents, text, w, k, limit)
    return rows.join(found, "id", "left").withColumn("kept", F.coalesce("kept", as_binary(F.col(text))))
