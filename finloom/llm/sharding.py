"""Sharding by balanced label propagation.

Documents linked through a hub (here: equal texts) should share a shard. Every document starts in the shard its id
hashes to. In each round, joins tell every linked document how many of its neighbours each shard holds; it wants to move
to the shard with the most, if that is more than where it is. A shard accepts as many as its quota leaves room for,
chosen by a hash threshold taken from a histogram of the wishes. The bucket in which a shard's room ends is split into
finer ones, and only it, until the room is used to the row: a shard with more wishes than room is full after the round.
A full shard is no goal in the next round, so the members of a hub larger than a shard gather in as few shards as it
takes. Rounds end when nothing moves.

Then sizes are made even exactly: linked documents hold the first slots of a shard, and what lies beyond the shard's
share (unlinked documents only, because the quota is the smaller share) goes to the shards that miss rows. Counts
differ by one at most; that is the law `rows`. Slots come from row numbers within pieces of a shard (by id hash, about
PIECE rows) plus the sizes of the pieces before, so no task holds a shard.

Only DataFrame and SQL functions are used. What reaches the driver is a number per shard. A hub with a third of all
rows is counted by (hub, shard) before the shuffle; joins on the hub meet one row per hub and shard on one side.

Defined results: null texts have size 1, crc32 0 and no links; an empty text is a text like others; repeated rows are
rows of their own; fewer rows than shards leave shards empty; other columns are dropped; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.llm.store import stored

SHARDS = 16
ROUNDS = 24
GRAIN = 1024  # hash buckets of the wishes, and of each bucket that is split
PLACES = 1 << 50  # of the hash
PIECE = 20_000


def _tally(rows: DataFrame, shards: int) -> list[int]:
    """Rows per shard."""
    found = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return [found.get(k, 0) for k in range(shards)]


def _from(numbers: list[int], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(int(x)).cast("bigint") for x in numbers)), (index + 1).cast("int"))


def _limits(wishes: DataFrame, room: list[int]) -> list[int]:
    """The place below which each shard accepts wishes (to, place) so that its room is used to the row."""
    shards = len(room)
    left, low, upto = list(room), [0] * shards, [0] * shards
    open_, span = [k for k in range(shards) if room[k] > 0], PLACES
    while open_ and span > 1:
        width, span = span, -(-span // GRAIN)
        begin = _from(low, F.col("to"))
        here = wishes.filter(F.col("to").isin(open_) & (F.col("place") >= begin) & (F.col("place") < begin + width))
        bucket = F.floor((F.col("place") - begin) / span).alias("bucket")
        running = F.sum("n").over(Window.partitionBy("to").orderBy("bucket"))  # GRAIN rows at most
        histogram = here.groupBy("to", bucket).agg(F.count("*").alias("n")).withColumn("upto", running)
        beyond = F.col("upto") > _from(left, F.col("to"))
        first = histogram.groupBy("to").agg(
            F.min(F.when(beyond, F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")))).alias("first")
        )
        found = {r["to"]: r["first"] for r in first.collect()}  # a row per shard
        for k in open_:
            if found.get(k) is None:  # all of them fit
                low[k] += width if k in found else 0
                left[k] = 0
            else:
                low[k] += found[k]["bucket"] * span
                left[k] -= found[k]["before"]
            upto[k] = low[k]
        open_ = [k for k in open_ if left[k] > 0]
    return upto


def propagate(members: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """(row, hub), linked documents only and any number of hubs a document: (row, shard) after propagation.

    Nothing is moved into a shard beyond `quota` documents."""
    members = stored(members.select("row", "hub"), "shard-members")
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    # the hash start may itself pass the quota on tiny inputs; then the lowest-loaded law of the end still holds
    state = stored(members.select("row").distinct().withColumn("shard", start), "shard-state")
    for turn in range(rounds):
        room = [max(0, quota - n) for n in _tally(state, shards)]
        if not any(room):
            break
        placed = members.join(state, "row")
        held = placed.groupBy("hub", "shard").agg(F.count("*").alias("n"))
        goals = held.filter(_from(room, F.col("shard")) > 0).groupBy("hub").agg(
            F.max_by(F.struct("shard", "n"), F.struct("n", F.xxhash64("hub", "shard"))).alias("goal")
        )
        here = held.withColumnRenamed("n", "here")
        gains = placed.join(here, ["hub", "shard"]).join(goals, "hub")
        # neighbours there against neighbours here, the document itself not counted; one goal a hub, so no two swap
        gain = F.col("goal.n") - (F.col("here") - 1)
        gains = gains.filter((F.col("goal.shard") != F.col("shard")) & (gain > 0))
        wishes = gains.groupBy("row", F.col("goal.shard").alias("to")).agg(F.sum(gain).alias("gain"))
        wishes = wishes.groupBy("row").agg(F.max_by("to", F.struct("gain", "to")).alias("to"))
        place = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(PLACES))
        wishes = stored(wishes.withColumn("place", place), "shard-wishes")
        limits = _limits(wishes, room)
        if not any(limits):
            break
        accepted = wishes.filter(F.col("place") < _from(limits, F.col("to")))
        moved = state.join(accepted.select("row", "to"), "row", "left")
        state = stored(moved.select("row", F.coalesce("to", "shard").alias("shard")), "shard-state")
    return state


def _slots(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds slot: gapless from 0 in each shard, linked rows first."""
    pieces = max(1, -(-n_rows // PIECE))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.lit(pieces)))
    sizes = rows.groupBy("shard", "last", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("last", "piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inner = Window.partitionBy("shard", "last", "piece").orderBy("doc_id", "row")
    numbered = rows.withColumn("number", F.row_number().over(inner))
    keys = ["shard", "last", "piece"]
    return numbered.join(sizes, keys).withColumn("slot", F.col("before") + F.col("number") - 1).drop("piece", "number", "before")


def assign(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col("text").cast("string")
    rows = stored(
        documents.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length(text).cast("bigint"), F.lit(0).cast("bigint")) + 1).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("hub"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    n_rows = rows.count()
    share, more = divmod(n_rows, shards)
    hubs = rows.filter("hub is not null").groupBy("hub").agg(F.count("*").alias("n")).filter("n > 1").select("hub")
    linked = propagate(rows.join(hubs, "hub"), shards, share)
    own = F.coalesce("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int"))
    placed = rows.drop("hub").join(linked, "row", "left").select(
        "row", "doc_id", "size", "text_crc32", own.alias("shard"), F.col("shard").isNull().alias("last")
    )
    placed = stored(_slots(placed, n_rows), "shard-slots")
    counts = _tally(placed, shards)
    fair = [share + (k < more) for k in range(shards)]
    over = [max(0, n - f) for n, f in zip(counts, fair)]
    under = [max(0, f - n) for n, f in zip(counts, fair)]
    # the surplus of all shards in one row, dealt to the gaps of all shards in one row
    begin = [sum(over[:k]) for k in range(shards)]
    rank = _from(begin, F.col("shard")) + F.col("slot") - _from(fair, F.col("shard"))
    leaves = F.col("slot") >= _from(fair, F.col("shard"))
    to, slot = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for k in range(shards):
        first = sum(under[:k])
        inside = (rank >= first) & (rank < first + under[k])
        to = F.when(inside, F.lit(k)).otherwise(to)
        slot = F.when(inside, counts[k] + rank - first).otherwise(slot)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.when(leaves, to).otherwise(F.col("shard")).alias("shard"),
        F.when(leaves, slot).otherwise(F.col("slot")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
