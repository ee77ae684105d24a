"""Mixing sources to target weights by hash-threshold histograms.

Each source has a weight; the mix is to hold `share` of all words, `most` times a source's size at most, what is above
being shared again among the others by weight. Of a source, every document is taken floor(target / size) times, and the
rest of the budget goes to the documents whose hash lies under a threshold. The threshold comes from sums of words by
source and hash bucket: the bucket in which the running sum passes the budget is split into finer buckets, and only it,
until it holds one document; nothing is sorted and no document leaves its task. The document at the threshold fits only
by chance, so what it would leave over is a budget again, for the documents beyond it that fit: PHASES nested
thresholds, then the last document is taken if that brings the sum nearer to the target.

The hash is of doc_id and text, so reruns agree and the documents of a smaller budget are among those of a larger one up
to the first threshold; rows without a doc_id, or with one that others have, are told apart by their texts. A source with a third of all rows is BUCKETS sums a task.

Defined results: null texts have no words; a null source is a source and comes last; documents of size 0 cost nothing
and are taken like others by their hash; rows of one doc_id, text and source go together, so a source misses its target
by up to the size of such a group; an empty table gives an empty result; other columns pass through `mix` untouched, each row as often as it is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.llm.store import free_name, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BITS, STEP = 60, 12  # of the hash, and of them for each refinement
PHASES = 4
BROADCAST = 8 << 20  # bytes
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def _key(source: Column) -> Column:
    """Text that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _place(doc_id: Column, text: Column) -> Column:
    name = F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("")), F.xxhash64(text.cast("string")).cast("string"))
    digits = F.substring(F.md5(name), 1, BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(key, size), a row per source, with weight and target added."""
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    everything = Window.partitionBy(F.lit(0))  # one row per source
    place = F.row_number().over(everything.orderBy("key"))
    rows = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")))
    rows = rows.withColumn("cap", F.lit(float(most)) * F.col("size"))
    by_fill = everything.orderBy(F.col("cap") / F.col("weight"), "key")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("size").over(everything)
    # the level to which all sources not yet full are filled, if those that fill earlier are at their caps
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # it rises while sources are full and falls from the first that is not, so the highest one is right
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least("cap", F.col("weight") * F.col("level"))
    return rows.withColumn("target", target).select("key", "size", "weight", "target")


def _threshold(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The largest hash under which each source's rows stay within its budget.

    rows: key, place, size; budgets: key, left. Result: key, upto (exclusive), left, at_size (the words at `upto`).
    """
    resolved = budgets.select("key", "left", F.lit(0).cast("bigint").alias("bucket"))
    done = None
    for shift in range(BITS - STEP, -1, -STEP):
        here = rows.join(resolved, "key").filter(F.shiftright("place", shift + STEP) == F.col("bucket"))
        histogram = here.groupBy("key", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("left").alias("left"), F.min("place").alias("low"), F.max("place").alias("high")
        )
        order = Window.partitionBy("key").orderBy("bucket")  # 2^STEP rows at most
        histogram = histogram.withColumn("upto_here", F.sum("words").over(order))
        crossing = histogram.filter(F.col("upto_here") > F.col("left"))
        first = crossing.groupBy("key").agg(
            F.min_by(F.struct("bucket", "words", "upto_here", "left", "low", "high"), "bucket").alias("x")
        )
        first = stored(
            first.select(
                "key",
                F.col("x.bucket").alias("bucket"),
                (F.col("x.left") - F.col("x.upto_here") + F.col("x.words")).alias("left"),
                F.col("x.words").alias("words"),
                F.col("x.low").alias("low"),
                F.col("x.high").alias("high"),
            ),
            "mix-level",
        )
        alone = first.filter("low = high").select("key", F.col("low").alias("upto"), "left", F.col("words").alias("at_size"))
        done = alone if done is None else done.unionByName(alone)
        resolved = first.filter("low != high").select("key", "left", "bucket")
        if not resolved.limit(1).count():
            break
    return done


def plan(documents: DataFrame, **settings) -> tuple[DataFrame, DataFrame]:
    """(documents' doc_id, key, place, size, stored; per source: key, source_size, target, times, spans).

    A document is taken `times`, and once more if for one of the spans size <= fits and lower <= place < upper.
    """
    rows = stored(
        documents.select(
            F.col("doc_id").alias("doc_id"),
            _key(F.col("source")).alias("key"),
            _place(F.col("doc_id"), F.col("text")).alias("place"),
            n_words(F.col("text")).alias("size"),
        ),
        "mix-sizes",
    )
    sources = targets(rows.groupBy("key").agg(F.sum("size").alias("size")), **settings)
    times = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("bigint")
    sources = sources.withColumn("times", times)
    sources = stored(sources.withColumn("rest", F.col("target") - F.col("times") * F.col("size")), "mix-sources")
    span = "array<struct<fits: bigint, lower: bigint, upper: bigint>>"
    most = (1 << 63) - 1
    state = sources.select(
        "key",
        F.col("rest").alias("left"),
        F.lit(0).cast("bigint").alias("lower"),
        F.lit(most).alias("fits"),
        F.array().cast(span).alias("spans"),
    )
    for phase in range(PHASES):
        limits = state.select("key", "lower", "fits")
        open_rows = rows.join(limits, "key").filter("size <= fits and place >= lower").select("key", "place", "size")
        found = _threshold(open_rows, state.select("key", "left"))
        upper = F.coalesce("upto", F.lit(1 << BITS))
        state = state.join(found.withColumnRenamed("left", "new_left"), "key", "left")
        own = F.struct(F.col("fits"), F.col("lower"), upper.alias("upper"))
        spans = F.concat("spans", F.array(own))
        if phase == PHASES - 1:  # the document at the last threshold, if it brings the sum nearer
            nearer = F.col("upto").isNotNull() & (F.col("at_size") <= 2 * F.col("new_left"))
            last = F.struct(F.col("fits"), F.col("upto").alias("lower"), (F.col("upto") + 1).alias("upper"))
            spans = F.when(nearer, F.concat(spans, F.array(last))).otherwise(spans)
        state = stored(
            state.select(
                "key",
                F.coalesce("new_left", F.lit(0.0)).alias("left"),
                # a source whose rows are used up has no further span
                F.coalesce(F.col("upto") + 1, F.lit(1 << BITS)).alias("lower"),
                F.floor(F.coalesce("new_left", F.lit(0.0))).cast("bigint").alias("fits"),
                spans.cast(span).alias("spans"),
            ),
            "mix-phase",
        )
    return rows, sources.withColumnRenamed("size", "source_size").join(state.select("key", "spans"), "key")


def _copies(times: Column, spans: Column, size: Column, place: Column) -> Column:
    within = F.lit(False)
    for k in range(PHASES + 1):
        span = F.try_element_at(spans, F.lit(k + 1))
        inside = (size <= span["fits"]) & (place >= span["lower"]) & (place < span["upper"])
        within = within | F.coalesce(inside, F.lit(False))
    return times + within.cast("bigint")


def _small(sources: DataFrame) -> bool:
    """Whether a table with a row per source can go to every task."""
    size = sources.agg(F.sum(F.octet_length("key") + 40 * (PHASES + 2))).first()[0] or 0
    return size <= BROADCAST


def taken(documents: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows, sources = plan(documents, **settings)
    placed = rows.join(sources, "key")
    copies = _copies(F.col("times"), F.col("spans"), F.col("size"), F.col("place"))
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken")
    )


def mix(documents: DataFrame, **settings) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with its own columns."""
    _, sources = plan(documents, **settings)
    own = {c: free_name(documents, f"mix_{c}") for c in ("key", "size", "place", "times", "spans", "copies")}
    sources = sources.select("key", "times", "spans").withColumnsRenamed({c: own[c] for c in ("key", "times", "spans")})
    if _small(sources.withColumnRenamed(own["key"], "key")):
        sources = F.broadcast(sources)  # then no text moves; with more sources the join is a shuffle join
    measured = documents.withColumns(
        {
            own["key"]: _key(F.col("source")),
            own["size"]: n_words(F.col("text")),
            own["place"]: _place(F.col("doc_id"), F.col("text")),
        }
    )
    copies = _copies(*(F.col(own[c]) for c in ("times", "spans", "size", "place")))
    repeated = measured.join(sources, own["key"]).withColumn(own["copies"], F.array_repeat(F.lit(1), copies.cast("int")))
    return repeated.withColumn(own["copies"], F.explode(own["copies"])).select(*(F.col(f"`{c}`") for c in documents.columns))
