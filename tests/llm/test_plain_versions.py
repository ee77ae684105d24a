"""Training of the quality classifier and label propagation against versions that do one thing at a time."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from finloom.llm import quality, sharding, tokens

FULL = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & FULL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & FULL
    return x ^ (x >> 31)


def word_hash(word):
    total, power = 0, 1
    for b in word:
        total, power = (total + (b + 1) * power) & FULL, (power * tokens._UNBASE) & FULL
    return mixed((total + len(word) * 0xD6E8FEB86659FD93) & FULL)


def plain_features(text, bits):
    """End of text, words, words said twice, and three to five bytes of each word with a space on either side."""
    words = text.translate(bytes(32 if b in tokens.WHITE_BYTES else b for b in range(256))).split(b" ")
    words = [w for w in words if w]
    found = [0, *(word_hash(w) >> (64 - bits) for w in words), *(1 for a, b in zip(words, words[1:]) if a == b)]
    for n in (3, 4, 5):
        salt = (0x9E3779B97F4A7C15 * (2 * n + 1)) & FULL
        for wide in (b" " + w + b" " for w in words):
            for at in range(len(wide) - n + 1):
                found.append((int.from_bytes(wide[at : at + n], "big") * salt & FULL) >> (64 - bits))
    return Counter(found)


def plain_training(texts, labels, s):
    rng = np.random.default_rng(s.seed)
    vectors = (rng.uniform(-0.5, 0.5, (s.buckets, s.dim)).astype(np.float32) / s.dim).tolist()
    output = [[0.0, 0.0] for _ in range(s.dim)]
    bits, order, step = s.buckets.bit_length() - 1, np.arange(len(texts)), 0
    for _ in range(s.epochs):
        rng.shuffle(order)
        for i in order:
            rate = s.rate * (1 - step / (s.epochs * len(texts)))
            step += 1
            seen = plain_features(texts[i], bits)
            n = sum(seen.values())
            hidden = [sum(k * vectors[f][d] for f, k in seen.items()) / n for d in range(s.dim)]
            z = [sum(hidden[d] * output[d][c] for d in range(s.dim)) for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            miss = [e[c] / sum(e) - (labels[i] == c) for c in (0, 1)]
            back = [sum(output[d][c] * miss[c] for c in (0, 1)) for d in range(s.dim)]
            for d in range(s.dim):
                for c in (0, 1):
                    output[d][c] -= rate * hidden[d] * miss[c]
                for f in seen:
                    vectors[f][d] -= rate * back[d]
    return [sum(v[d] * (output[d][1] - output[d][0]) for d in range(s.dim)) for v in vectors]


TEXTS = [b"", b"a", b"a a  a\tab", "schön ist\x0bes".encode(), b"one two two three\n", b" \n ", b"abcdefg hi"]


@pytest.mark.parametrize("text", TEXTS)
def test_features_are_words_and_their_parts(text):
    found = Counter(np.concatenate([b for _, _, b in quality.features([text], 1 << 12)]).tolist())
    assert found == plain_features(text, 12)


def test_training_equals_one_example_at_a_time(words):
    rng = random.Random(5)
    texts = [words(i, rng.randrange(1, 30)).encode() + (b" !!" if i % 3 == 0 else b"") for i in range(24)] + TEXTS
    labels = np.array([int(i % 3 != 0) for i in range(len(texts))])
    settings = quality.Settings(buckets=1 << 8, dim=3, epochs=4, rate=0.5)
    got = quality.train(texts, labels, settings)
    assert got == pytest.approx(np.array(plain_training(texts, labels, settings)), rel=1e-2, abs=1e-4)


def plain_propagation(spark, members, shards, quota, rounds):
    """Each document in turn, with hashes looked up: one goal a hub, the strongest wish a document, first come by place."""

    def hashes(rows, schema, *columns):
        df = spark.createDataFrame(rows, schema)
        return {tuple(r)[:-1]: r[-1] for r in df.select("*", F.xxhash64(*columns)).collect()}

    rows, hubs = sorted({r for r, _ in members}), sorted({h for _, h in members})
    of_row = hashes([(r,) for r in rows], "row bigint", "row")
    of_goal = hashes([(h, k) for h in hubs for k in range(shards)], "hub string, shard int", "hub", "shard")
    of_turn = hashes([(r, t) for r in rows for t in range(rounds)], "row bigint, turn int", "row", "turn")
    state = {r: of_row[r,] % shards for r in rows}
    for turn in range(rounds):
        load = Counter(state.values())
        room = [max(0, quota - load[k]) for k in range(shards)]
        held = Counter((h, state[r]) for r, h in members)
        goal = {}
        for h in hubs:
            open_ = [(held[h, k], of_goal[h, k], k) for k in range(shards) if held[h, k] and room[k]]
            if open_:
                goal[h] = max(open_)
        wishes = defaultdict(Counter)
        for r, h in members:
            if h in goal and goal[h][2] != state[r]:
                gain = goal[h][0] - (held[h, state[r]] - 1)
                if gain > 0:
                    wishes[r][goal[h][2]] += gain
        if not wishes:
            break
        comers = defaultdict(list)
        for r, gains in wishes.items():
            comers[max((g, k) for k, g in gains.items())[1]].append((of_turn[r, turn] % sharding.PLACES, r))
        for k, found in comers.items():
            for _, r in sorted(found)[: room[k]]:
                state[r] = k
    return state


@pytest.mark.parametrize(("quota", "hot"), [(25, 0), (16, 30), (1000, 20)])
def test_propagation_equals_the_plain_version(spark, quota, hot):
    rng = random.Random(quota)
    members = {(r, f"h{rng.randrange(12)}") for r in range(60) for _ in range(rng.randrange(1, 3))}
    members = sorted(members | {(r, "hot") for r in range(hot)})
    df = spark.createDataFrame(members, "row bigint, hub string")
    found = {r["row"]: r["shard"] for r in sharding.propagate(df, 4, quota, rounds=5).collect()}
    assert found == plain_propagation(spark, members, 4, quota, 5)

    def cut(state):
        sides = defaultdict(Counter)
        for r, h in members:
            sides[h][state[r]] += 1
        return sum(sum(c.values()) ** 2 - sum(n * n for n in c.values()) for c in sides.values())

    start = {r["row"]: r["s"] for r in df.select("row", F.pmod(F.xxhash64("row"), F.lit(4)).alias("s")).collect()}
    assert cut(found) < cut(start)
