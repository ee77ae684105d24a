"""Chat formatting by token-level assembly.

Every turn is encoded by itself, in segments (role, text), and reserved ids that no text can produce are spliced in:

    START role "\\n" text END "\\n"

Control strings occurring in a role or text are escaped before encoding, so that also the printed form can be read
back: each `<|` gets a backslash inside, `<|` becoming `<\\|`, `<\\|` becoming `<\\\\|` and so on; a role's line breaks and
backslashes are escaped as well. The loss mask covers the text segment of assistant turns; mask and position of a
segment follow from prefix sums of segment lengths within the turn, and of turn lengths within the conversation.

The output is one row per turn, not per conversation. Turns are encoded, and read back, where they lie, before any of
them moves; then they are dealt by conv_id, sorted by turn and streamed, and only running positions or digests are kept.
So of a conversation with a third of all rows one task sorts and hashes the turns, with bounded memory, but tokenises none.

Defined results: null texts and roles are empty; a null conv_id is a conversation of its own; repeated turn numbers
are ordered by role, then text; other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"

TURNS = (
    "conv_id bigint, turn bigint, role string, position bigint, token_ids array<int>, loss_mask array<boolean>, "
    "n_tokens int"
)
ASSEMBLED = (
    "conv_id bigint, turn bigint, role string, text string, token_ids array<int>, loss_mask array<boolean>, n_tokens int"
)
SAID = "conv_id bigint, turn bigint, role string, text string, trained string, printed bigint, n_tokens bigint"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_tokens bigint"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


class Codec:
    """The public byte-level vocabulary with two reserved ids above its ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.start, self.end = max(ranks.values()) + 1, max(ranks.values()) + 2
        self.break_ids = self.encoding.encode_ordinary("\n")

    def assemble(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, loss mask) of one turn."""
        encode = self.encoding.encode_ordinary
        segments = [
            ([self.start], False),
            (encode(escape_role(role)), False),
            (self.break_ids, False),
            (encode(escape(text)), role == TRAINED_ROLE),
            ([self.end], False),
            (self.break_ids, False),
        ]
        places = np.cumsum([0, *(len(ids) for ids, _ in segments)])
        change = np.zeros(places[-1] + 1, np.int32)  # +1 where the mask opens, -1 where it closes
        for (_, trained), begin, end in zip(segments, places, places[1:]):
            change[begin] += trained
            change[end] -= trained
        return np.concatenate([np.array(ids, np.int32) for ids, _ in segments]), np.cumsum(change[:-1]) > 0

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
        """(role, text, text under the mask, length of the printed turn), from ids and mask alone."""
        if ids[0] != self.start:
            raise ValueError("a turn begins with the reserved id")
        end = int(np.flatnonzero(ids == self.end)[0])
        body = self.encoding.decode_bytes(ids[1:end].tolist()).decode()
        role, _, text = body.partition("\n")
        trained = self.encoding.decode_bytes(ids[mask].tolist()).decode()
        printed = len(START) + len(body) + len(END) + len(self.encoding.decode_bytes(ids[end + 1 :].tolist()).decode())
        return unescape_role(role), unescape(text), unescape(trained), printed


def vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Read on the driver and sent to the tasks; the executors need no such file. A vocabulary has a fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _codec(ranks) -> Callable[[], Codec]:
    made: list[Codec] = []

    def get() -> Codec:
        if not made:
            made.append(Codec(ranks.value))
        return made[0]

    return get


def _batches(rows: list[tuple], schema: str, at_once: int = 512) -> Iterator[pa.RecordBatch]:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    kinds["array<boolean>"] = pa.list_(pa.bool_())
    names, types = zip(*(column.split() for column in schema.split(", ")))
    for begin in range(0, len(rows), at_once):
        part = zip(*rows[begin : begin + at_once])
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(part, types)], names)


def _in_order(turns: DataFrame) -> DataFrame:
    """Each conversation's turns in one partition, one after the other."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def assembled(conversations: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row per turn: ids and loss mask beside its role and text; no row moves."""
    spark: SparkSession = conversations.sparkSession
    codec = _codec(spark.sparkContext.broadcast(vocabulary(path)))
    rows = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, mask = codec().assemble(row["role"], row["text"])
                out.append((row["conv_id"], row["turn"], row["role"], row["text"], ids, mask, len(ids)))
            yield from _batches(out, ASSEMBLED)

    return rows.mapInArrow(encode, ASSEMBLED)


def format_turns(conversations: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row per turn: ids, loss mask and the turn's position in its conversation, in conversation order."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, position = object(), 0
        for batch in batches:
            positions = []
            for conv, n in zip(batch.column("conv_id").to_pylist(), batch.column("n_tokens").to_pylist()):
                if conv != at:
                    at, position = conv, 0
                positions.append(position)
                position += n
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["position"] = pa.array(positions, pa.int64())
            names = [column.split()[0] for column in TURNS.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    return _in_order(assembled(conversations, path)).drop("text").mapInArrow(place, TURNS)


def digests(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """What formatted conversations say, read back from the ids and masks of `assembled` or `format_turns`."""
    codec = _codec(turns.sparkSession.sparkContext.broadcast(vocabulary(path)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, masks = batch.column("token_ids"), batch.column("loss_mask")
            out = []
            for i, (conv, turn) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist())):
                own, mask = ids[i].values.to_numpy(), masks[i].values.to_numpy(zero_copy_only=False)
                out.append((conv, turn, *codec().read(own, mask), len(own)))
            yield from _batches(out, SAID)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = object(), None
        done: list[tuple] = []

        def ended() -> list[tuple]:
            if state is None:
                return []
            n, said, chars, trained, printed, tokens = state
            return [(at, n, said.hexdigest(), chars, trained.hexdigest(), printed, tokens)]

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != at:
                    done += ended()
                    at, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                state[0] += 1
                state[1].update(f"{row['role']}\n{row['text']}\n".encode())
                state[2] += len(row["trained"])
                state[3].update(row["trained"].encode())
                state[4] += row["printed"]
                state[5] += row["n_tokens"]
            yield from _batches(done, DIGESTS)
            done = []
        yield from _batches(ended(), DIGESTS)

    seen = turns.select("conv_id", "turn", "token_ids", "loss_mask").mapInArrow(read, SAID)
    return _in_order(seen).mapInArrow(close, DIGESTS)
