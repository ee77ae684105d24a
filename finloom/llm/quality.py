"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and hashed character n-grams (bytes 3 to 5 within a
word and the white space beside it) and of a mark for each word that repeats the one before it, followed by a softmax over two classes; stochastic gradient descent in numpy
learns vectors and output weights together. The average and the output layer are both linear, so a trained model
folds into one number per bucket, and a document's log-odds are the mean of its features' numbers: one table lookup
per feature, in one pass over the bytes.

The model is fitted on a bounded sample: at most `per_class` labelled documents of each class, chosen by the hash of
doc_id, those longer than `longest` bytes left out of the sample. Everything else, every document's whole text, is scored by Spark.

Defined results: null and empty texts have only the end-of-text feature and get its score; a label that is null or not
0 or 1 is ignored; a document labelled twice counts by its higher label; with no labels of one class every document
gets the share of the other; an empty table gives an empty result; a row without doc_id has no label
and, in the registered query, no fold (held_out is null). Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.tokens import WHITE_BYTES, as_bytes, blocks, joined, span_hashes, spans

ORDERS = (3, 4, 5)
THRESHOLD = 0.7
_SALT = {n: np.uint64((0x9E3779B97F4A7C15 * (2 * n + 1)) % (1 << 64)) for n in ORDERS}


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    dim: int = 8
    per_class: int = 2000
    longest: int = 1 << 16  # bytes of a text in the sample: with per_class, what the driver holds at most
    epochs: int = 5
    rate: float = 0.3
    seed: int = 7


def _grams(buffer: np.ndarray, shift: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the gram from every place on, and whether it lies within one word."""
    white = np.isin(buffer, tuple(WHITE_BYTES))
    before = np.zeros(len(buffer) + 1, np.int32)
    np.cumsum(white, out=before[1:])
    wide = np.where(white, np.uint8(32), buffer).astype(np.uint64)
    gram = wide
    for n in range(2, max(ORDERS) + 1):
        gram = (gram[:-1] << np.uint64(8)) | wide[n - 1 :]
        if n in ORDERS:
            inside = before[n - 1 : len(buffer)] == before[1 : len(buffer) - n + 2]  # no white space but at the ends
            yield ((gram * _SALT[n]) >> shift).astype(np.int64), inside


def features(texts: list[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first place of each owner, owners, buckets) of the features, ordered by text, one kind after another.

    Bucket 0 also takes the end of each text and bucket 1 each word that equals the one before it.
    """
    shift = np.uint64(64 - buckets.bit_length() + 1)
    for owners, held in blocks(texts):
        buffer, after = joined(held)
        first = after - [len(x) + 1 for x in held]  # each piece begins after its own space
        starts, ends = spans(buffer)
        words = span_hashes(buffer, starts, ends)
        places = np.searchsorted(starts, first)
        yield places, owners, (words >> shift).astype(np.int64)
        again = np.flatnonzero(words[1:] == words[:-1]) + 1
        again = again[~np.isin(again, places)]
        yield np.searchsorted(again, places), owners, np.ones(len(again), np.int64)
        for bucket, inside in _grams(buffer, shift):
            at = np.flatnonzero(inside)
            yield np.searchsorted(at, first - 1), owners, bucket[at]
    every = np.arange(len(texts))
    yield every, every, np.zeros(len(texts), np.int64)


def _counted(texts: list[bytes], buckets: int, at_once: int = 256) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text; views of a few arrays of the smallest types that hold them."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for begin in range(0, len(texts), at_once):
        found = []
        for text in texts[begin : begin + at_once]:
            ids, counts = np.unique(np.concatenate([b for _, _, b in features([text], buckets)]), return_counts=True)
            found.append((ids.astype(kind), (counts / counts.sum()).astype(np.float32)))
        edges = np.cumsum([len(ids) for ids, _ in found])[:-1]
        out += zip(np.split(np.concatenate([x for x, _ in found]), edges), np.split(np.concatenate([x for _, x in found]), edges))
    return out


def train(texts: list[bytes], labels: np.ndarray, settings: Settings) -> np.ndarray:
    """The number of each bucket: what one feature adds to the log-odds of label 1 before averaging."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return np.full(settings.buckets, np.log((share + 0.02) / (1.02 - share)), np.float32)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-0.5, 0.5, (settings.buckets, settings.dim)).astype(np.float32) / settings.dim
    output = np.zeros((settings.dim, 2), np.float32)
    documents = _counted(texts, settings.buckets)
    order = np.arange(len(texts))
    steps, step = settings.epochs * len(texts), 0
    for _ in range(settings.epochs):
        rng.shuffle(order)
        for i in order:
            rate = np.float32(settings.rate * (1 - step / steps))
            step += 1
            ids, weights = documents[i]
            hidden = weights @ vectors[ids]
            z = hidden @ output
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = output @ p
            output -= rate * np.outer(hidden, p)
            vectors[ids] -= rate * back  # every feature of the document moves, as its average does
    return vectors @ (output[:, 1] - output[:, 0])


def score_texts(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each text, read whole."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for places, owners, bucket in features(texts, len(table)):
        running = np.zeros(len(bucket) + 1)
        np.cumsum(table[bucket], dtype=np.float64, out=running[1:])
        limits = np.append(places, len(bucket))
        np.add.at(total, owners, np.diff(running[limits]))
        np.add.at(n, owners, np.diff(limits))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1), -40, 40)))


def fit(documents: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> np.ndarray:
    """Fit on a bounded sample of the labelled rows for which `learn`, a condition on doc_id, holds."""
    known = (
        labels.filter(F.col("quality").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(settings.seed))
    picked = [known.filter(F.col("label") == k).orderBy(order, "doc_id").limit(settings.per_class) for k in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    sample = (
        documents.select("doc_id", "text")
        .filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= settings.longest)
        .join(F.broadcast(ids), "doc_id")  # at most 2 * per_class rows
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("label").alias("label"))
        .toArrow()
        .sort_by("doc_id")
    )
    target = sample["label"].to_numpy().astype(np.int64)
    table = train(as_bytes(sample["text"].combine_chunks()), target, settings)
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}  # two rows
    if len(counts) == 2 and 0 < target.sum() < len(target):
        # the sample holds as many of either class; put the odds among all labelled documents back
        taken = target.sum() / (len(target) - target.sum())
        table = table + np.float32(np.log(counts[1] / counts[0] / taken))
    return table


def scorer(table: np.ndarray) -> Callable[[Column | str], Column]:
    """The model as a column function; it carries buckets * 4 bytes, whatever it was trained on."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(score_texts(as_bytes(column), table), pa.float64())

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # evaluated once, also where both a filter and a projection use it
    return F.arrow_udf(score, "double").asNondeterministic()


def keep_good(documents: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> DataFrame:
    """Documents scored THRESHOLD or higher, with their own columns."""
    score = scorer(fit(documents, labels, learn, settings))
    return documents.filter(score("text") >= THRESHOLD)
