"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Shingles are SHINGLE consecutive words (A-Z as a-z; a shorter text is one shingle). The weight of a shingle in a text is
(1 + ln tf) * idf. The idf comes from document frequencies over all documents, kept in 2^IDF_BITS hash buckets (a fixed
size, whatever the corpus); it is 1 for shingles in at most a COMMON share of the documents and falls logarithmically
to FLOOR for those in all, so line and passage boilerplate counts less while the weighted Jaccard similarity of
ordinary texts stays on the scale the threshold refers to. PRIOR documents of smoothing keep tiny tables unweighted.

1. One scan gives each document a digest of its words and BANDS * ROWS consistent weighted samples (r, c ~ Gamma(2, 1),
   beta ~ U(0, 1) drawn from hash-indexed tables). Documents of equal digests become one text before anything pairs.
2. Texts that agree in all samples of a band share a bucket. Each member is paired with the bucket's hub, the text that
   shares most buckets with others; pairs are verified by the exact weighted Jaccard similarity of both whole texts, and
   verified links merged into classes by label propagation. In buckets that still hold several classes, members are
   dealt by hash into parts of about BESIDE, and those of different classes within a part are verified as well; they
   are dealt anew until a round finds no link. So the work of a round follows the size of a bucket, not its square; no
   bucket is capped, and small ones are compared in full.
3. Larger buckets that still hold several classes are finished exactly. A text's shingles are ordered by document
   frequency (that of the idf's buckets), rarest first; `rest` is the weight from a shingle to the end. Texts of
   similarity t share at least t / (1 + t) of the sum of their weights, all of it in the `rest` of the first shingle
   they share. So each text deals out only the shingles whose `rest` is at least t of its weight, and pairs of different
   classes that meet there, with `rest` enough on both sides, are all verified. No pair of texts that share a bucket and
   are similar enough stays in two classes.
4. A class keeps the document with the smallest doc_id.

Hot groups: exact copies are counted before the shuffle; hub links grow with the members of a bucket. Joins with one row
per key on one side see a hot key, which adaptive execution splits. Where texts meet at a shingle, only those outside its
most frequent class look for partners, so what is compared is at most twice the pairs of different classes, and they are
dealt by hash into parts of about DEAL. Labels, links and texts of candidates are
stored in the shared folder, each once a round.

Defined results: null and empty texts have no shingle and are nobody's near-duplicate, nor each other's; documents with
equal doc_id are one document for classes, all of whose rows stay or go; ties go to the smallest doc_id; other columns
pass through `keep_one` untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.store import free_name, stored
from finloom.llm.tokens import as_bytes, mix, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
IDF_BITS = 17
BESIDE = 8
DEAL = 1000  # texts that meet at a shingle, in one part
COMMON, FLOOR, PRIOR = 1 / 3, 0.25, 1000
_GROUP = 1 << 20  # bytes of text handled at once
_STEPS = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(SHINGLE)]


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of r, beta and ln c, each entry a draw; the same on every machine."""
    rng = np.random.default_rng(20)
    r = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
    beta = rng.random(1 << 16).astype(np.float32)
    return r, beta, np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)


_R, _BETA, _LNC = _draws()
_UNIT = _R * _BETA - _R  # ln a - ln c of weight 1
_SEEDS = np.random.default_rng(21).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, occurrences) of each different shingle, sorted by text and hash."""
    words, n = word_hashes(texts, fold=True)
    total = int(n.sum())
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(texts)), n)
    gap = SHINGLE - 1
    spaced = np.zeros(total + gap * len(texts) + gap, np.uint64)
    at = np.arange(total) + gap * owner
    spaced[at] = words
    keep = np.arange(total) - first[owner] <= np.maximum(n[owner] - SHINGLE, 0)
    at, owner = at[keep], owner[keep]
    hashes = np.zeros(len(at), np.uint64)
    for k, step in enumerate(_STEPS):
        hashes += spaced[at + k] * step
    hashes = mix(hashes)
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    for begin, end in zip(edges, edges[1:]):
        hashes[begin:end].sort()
    if not len(hashes):
        return owner, hashes, np.zeros(0, np.int64)
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
    return owner[new], hashes[new], np.diff(np.append(new, len(hashes)))


def weights(hashes: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return ((1 + np.log(tf)) * idf[(hashes >> np.uint64(64 - IDF_BITS)).astype(np.int64)]).astype(np.float32)


def samples(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have shingles, their samples, one column a text)."""
    edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    length = np.diff(np.append(edge, len(owner)))
    other = np.flatnonzero(weight != 1)
    log_weight = np.log(weight[other])
    out = np.empty((BANDS * ROWS, len(edge)), np.uint64)
    for k in range(BANDS * ROWS):
        drawn = (hashes ^ _SEEDS[0, k]) * _SEEDS[1, k]
        one, two = (drawn >> np.uint64(48)).view(np.int64), ((drawn >> np.uint64(32)) & np.uint64(0xFFFF)).view(np.int64)
        log_a = _LNC[two] + _UNIT[one]
        if len(other):
            r, beta = _R[one[other]], _BETA[one[other]]
            t = np.floor(log_weight / r + beta)
            log_a[other] = _LNC[two[other]] - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, edge)
        hit = np.flatnonzero(log_a == np.repeat(least, length))
        hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])]  # a tie goes to the smallest hash
        out[k] = hashes[hit]
        if len(other):
            level = np.zeros(len(hashes), np.float32)
            level[other] = t
            out[k] += level[hit].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return owner[edge], out


def _groups(texts: list[bytes]) -> Iterator[slice]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _GROUP:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def frequencies(documents: DataFrame) -> tuple[np.ndarray, float]:
    """(documents that have a shingle of each bucket, documents); 2^IDF_BITS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(1 << IDF_BITS, np.int64), 0
        for batch in batches:
            texts = as_bytes(batch.column(0))
            n += len(texts)
            for part in _groups(texts):
                owner, hashes, _ = shingles(texts[part])
                bucket = (hashes >> np.uint64(64 - IDF_BITS)).astype(np.int64)
                # hashes are sorted within a text, so a text's equal buckets are neighbours
                new = np.append(True, (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1]))[: len(bucket)]
                seen += np.bincount(bucket[new], minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))], ["bucket", "n"])

    text = documents.select(F.col("text").cast("string"))
    counts = text.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = counts["bucket"].to_numpy(), counts["n"].to_numpy()
    found = np.zeros(1 << IDF_BITS)
    found[bucket[bucket >= 0]] = n[bucket >= 0]
    return found, float(n[bucket < 0].sum())


def idf_of(found: np.ndarray, n: float) -> np.ndarray:
    idf = np.log((n + PRIOR) / np.maximum(found, 1)) / np.log(1 / COMMON)
    return np.clip(idf, FLOOR, 1.0).astype(np.float32)


def idf_table(documents: DataFrame) -> np.ndarray:
    """The idf of every bucket, from all documents' shingles."""
    return idf_of(*frequencies(documents))


def _signatures(documents: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, digest of the words, a key for each band; documents without words are left out."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), as_bytes(batch.column(1))
            for part in _groups(texts):
                owner, hashes, tf = shingles(texts[part])
                if not len(owner):
                    continue
                has, found = samples(owner, hashes, weights(hashes, tf, idf))
                keys = np.zeros((len(has), BANDS), np.uint64)
                for k in range(BANDS * ROWS):
                    keys[:, k // ROWS] = mix(keys[:, k // ROWS] + found[k])
                own = [texts[part][i].translate(_LOWER).split() for i in has]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[part][has], pa.int64()),
                        pa.array([hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in own], pa.binary()),
                        pa.ListArray.from_arrays(
                            np.arange(0, len(has) * BANDS + 1, BANDS, np.int32), pa.array(keys.ravel().view(np.int64))
                        ),
                    ],
                    ["doc_id", "digest", "bands"],
                )

    rows = documents.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(sign, "doc_id bigint, digest binary, bands array<bigint>")


_UNDER = 1 - 1e-6  # bounds of sums of floats stay on the safe side
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' (sorted hashes, weights)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0]
    shared = float(np.minimum(a[1][at[same]], b[1][same]).sum(dtype=np.float64))
    return shared / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - shared)


def _verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))
            keep = []
            for begin in range(0, len(a), 64):
                own: dict[int, tuple] = {}
                wanted = {x: t for x, t in zip(a[begin : begin + 64] + b[begin : begin + 64], left[begin : begin + 64] + right[begin : begin + 64])}
                for x, text in wanted.items():
                    _, hashes, tf = shingles([text])
                    own[x] = hashes, weights(hashes, tf, idf)
                keep += [similarity(own[x], own[y]) >= least for x, y in zip(a[begin : begin + 64], b[begin : begin + 64])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = (
        pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return rows.mapInArrow(verify, "a bigint, b bigint")


def _rarest(placed: DataFrame, found: np.ndarray, idf: np.ndarray, least: float) -> DataFrame:
    """placed: rep, label, text. (rep, label, shingle, rest, total) of the shingles that a similar text must share."""
    common = found.astype(np.float32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, labels = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts = as_bytes(batch.column(2))
            for part in _groups(texts):
                owner, hashes, tf = shingles(texts[part])
                weight = weights(hashes, tf, idf).astype(np.float64)
                order = np.lexsort((hashes, common[(hashes >> np.uint64(64 - IDF_BITS)).astype(np.int64)], owner))
                owner, hashes, weight = owner[order], hashes[order], weight[order]
                n = len(texts[part])
                total = np.bincount(owner, weight, n)
                before = np.cumsum(weight) - weight
                first = np.searchsorted(owner, np.arange(n))[owner]
                rest = total[owner] - (before - before[first])
                keep = rest >= least * total[owner] * _UNDER
                at = owner[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reps[part][at], pa.int64()),
                        pa.array(labels[part][at], pa.int64()),
                        pa.array(hashes[keep].view(np.int64)),
                        pa.array(rest[keep]),
                        pa.array(total[at]),
                    ],
                    ["rep", "label", "shingle", "rest", "total"],
                )

    return placed.select("rep", "label", "text").mapInArrow(
        deal, "rep bigint, label bigint, shingle bigint, rest double, total double"
    )


def _candidates(rare: DataFrame, least: float) -> DataFrame:
    """Every pair (a, b) of different classes that shares a shingle with enough weight from there on."""
    per = rare.groupBy("shingle", "label").agg(F.count("*").alias("n")).groupBy("shingle").agg(
        F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("kinds")
    )
    deals = F.ceil(F.col("n") / DEAL).alias("deals")
    met = stored(rare.join(per.filter("kinds > 1").select("shingle", "main", deals), "shingle"), "near-met")
    deal = F.pmod(F.xxhash64("rep"), F.col("deals")).alias("deal")
    one = met.filter("label != main").select("shingle", deal, "rep", "label", "rest", "total")
    two = met.select(
        "shingle",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("deals") - 1)).alias("deal"),
        F.col("rep").alias("other"),
        F.col("label").alias("other_label"),
        F.col("rest").alias("other_rest"),
        F.col("total").alias("other_total"),
        (F.col("label") == F.col("main")).alias("other_main"),
    )
    enough = F.least("rest", "other_rest") >= F.lit(least / (1 + least) * _UNDER) * (F.col("total") + F.col("other_total"))
    pairs = one.join(two, ["shingle", "deal"]).filter(enough & F.expr("label != other_label and (other_main or rep < other)"))
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, label): the smallest node each node is connected to; links are (a, b), in either direction."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-both")
    labels = stored(nodes.select("rep", F.col("rep").alias("label")), "near-labels")
    while True:
        near = both.join(labels, both["b"] == labels["rep"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["rep"] == near["a"], "left").select(
            "rep", "label", F.least("label", F.coalesce("near", "label")).alias("next")
        )
        roots = step.select(F.col("rep").alias("root"), F.col("next").alias("further"))
        step = step.join(roots, F.col("next") == F.col("root"), "left").select(  # a label's own label is closer
            "rep", F.col("label").alias("before"), F.least("next", F.coalesce("further", "next")).alias("label")
        )
        step = stored(step, "near-labels")
        moved = step.filter(F.col("label") != F.col("before")).limit(1).count()
        labels = step.select("rep", "label")
        if not moved:
            return labels


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Merge classes by newly verified links."""
    left = labels.select(F.col("rep").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("rep").alias("b"), F.col("label").alias("lb"))
    between = links.join(left, "a").join(right, "b").filter(F.col("la") != F.col("lb"))
    between = stored(between.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "near-between")
    touched = between.select(F.col("a").alias("rep")).union(between.select(F.col("b").alias("rep"))).distinct()
    merged = components(touched, between).select(F.col("rep").alias("label"), F.col("label").alias("to"))
    moved = labels.join(merged, "label", "left").select("rep", F.coalesce("to", "label").alias("label"))
    return stored(moved, "near-labels")


def classes(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, n_links (verified links of its text) of every document with words that is in a class."""
    found = frequencies(documents)
    idf = idf_of(*found)
    signed = stored(_signatures(documents, idf), "near-signatures")
    # one text per digest; the smallest doc_id stands for it
    distinct = signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands"))
    distinct = stored(distinct, "near-distinct")
    banded = distinct.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(banded.join(shared, ["band", "key"]), "near-members")
    central = members.groupBy("rep").agg(F.sum("n").alias("central"))
    nodes = stored(central, "near-nodes")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(nodes.select(F.col("rep").alias("doc_id")), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = stored(texts.withColumnRenamed("doc_id", "rep"), "near-texts")
    # every member with its bucket's hub
    hub = F.max(F.struct("central", (-F.col("rep")).alias("first"))).alias("hub")
    hubs = members.join(nodes, "rep").groupBy("band", "key").agg(hub)
    hubs = hubs.select("band", "key", (-F.col("hub.first")).alias("other"))
    pairs = members.join(hubs, ["band", "key"]).filter("rep != other")
    pairs = pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()
    pairs = stored(pairs, "near-pairs")
    links = stored(_verified(pairs, texts, idf, least), "near-links")
    labels = components(nodes, links)
    # members of different classes with those beside them, dealt anew until that merges nothing
    tested, turn = pairs, 0
    while True:
        placed = members.join(labels, "rep")
        several = placed.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        several = several.filter("low < high").select("band", "key")
        part = F.pmod(F.xxhash64("rep", "band", F.lit(turn)), F.ceil(F.col("n") / BESIDE))
        placed = placed.join(several, ["band", "key"]).select("band", "key", part.alias("part"), "rep", "label")
        other = placed.select("band", "key", "part", F.col("rep").alias("other"), F.col("label").alias("other_label"))
        beside = placed.join(other, ["band", "key", "part"]).filter("rep < other and label != other_label")
        beside = beside.select(F.col("rep").alias("a"), F.col("other").alias("b")).distinct()
        beside = stored(beside.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        more = stored(_verified(beside, texts, idf, least), "near-links")
        if not more.limit(1).count():
            break
        labels, links, tested, turn = _relabelled(labels, more), links.union(more), tested.union(beside), turn + 1
    # what large buckets still hold in several classes, exactly; in the others all members were beside each other
    tested = tested.union(beside)
    several = members.filter(F.col("n") > BESIDE).join(labels, "rep").groupBy("band", "key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    divided = members.join(several.filter("low < high"), ["band", "key"]).select("rep").distinct()
    divided = divided.join(labels, "rep").join(texts, "rep")
    left = _candidates(stored(_rarest(divided, found[0], idf, least), "near-rarest"), least)
    left = stored(left.join(tested, ["a", "b"], "left_anti"), "near-pairs")
    more = stored(_verified(left, texts, idf, least), "near-links")
    if more.limit(1).count():
        labels, links = _relabelled(labels, more), links.union(more)
    ends = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep")))
    degree = ends.groupBy("rep").agg(F.count("*").alias("n_links"))
    out = distinct.select("rep", "digest").join(labels, "rep", "left").join(degree, "rep", "left")
    out = out.select("digest", F.coalesce("label", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = signed.select("doc_id", "digest").join(out, "digest")
    return rows.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))


def near_duplicates(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_links, kept."""
    found = stored(classes(documents, least), "near-classes")
    sizes = found.groupBy("class_id").agg(F.count("*").alias("class_size"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id")).join(found, "doc_id", "left")
    rows = rows.withColumn("class_id", F.coalesce("class_id", "doc_id")).join(sizes, "class_id", "left")
    return rows.select(
        "doc_id",
        "class_id",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents that stay, with their own columns."""
    name = free_name(documents, "gone")
    gone = classes(documents, least).filter(F.col("class_id") != F.col("doc_id")).select(F.col("doc_id").alias(name))
    return documents.join(gone, documents["doc_id"].cast("bigint") == F.col(name), "left_anti")
