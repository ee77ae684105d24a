"""The corpus operators against plain versions, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from finloom.llm import (
    chat,
    decontaminate,
    exact_dedup,
    langid,
    lm,
    mixing,
    near_dedup,
    quality,
    sharding,
    tokens,
    url_filter,
)
from finloom.scratch import fresh_folder

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def saved(spark, frame):
    folder = fresh_folder(spark, "test")
    frame.write.parquet(folder)
    return folder


def test_words_are_cut_at_white_space_only():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n\t\x0bÄß") for _ in range(rng.randrange(400))).encode() for _ in range(50)]
    texts += [b"", b"   ", b"x" * 5000, b"word " * 3000]
    own = tokens.BLOCK
    tokens.BLOCK = 64
    try:
        owners = [x for o, held in tokens.blocks(texts, 64) for x in zip(o, held)]
        assert all(sum((WORD.findall(p) for o, p in owners if o == i), []) == WORD.findall(t) for i, t in enumerate(texts))
    finally:
        tokens.BLOCK = own
    hashes, counts = tokens.word_hashes(texts, fold=False)
    assert counts.tolist() == [len(WORD.findall(t)) for t in texts]
    seen = {}
    for word, h in zip(sum((WORD.findall(t) for t in texts), []), hashes.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# --- op1 ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(spark, edge_docs, collide):
    """With a digest of two values nearly all texts collide, and the full bytes must decide."""
    path = saved(spark, edge_docs)
    digest = (lambda t: (F.length(t) % 2).cast("string")) if collide else exact_dedup.sha256
    rows = exact_dedup.deduplicate(spark, path, digest=digest).collect()
    groups = defaultdict(list)
    for r in edge_docs.select("doc_id", "text").collect():
        groups[(r["text"] or "").translate(LOWER)].append(r["doc_id"])
    expected = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, keep, len(ids), sha) for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == expected
    assert sum(r["kept"] for r in rows) == len(groups)


def test_exact_dedup_state_goes_on(spark, edge_docs):
    path, checkpoint = saved(spark, edge_docs.limit(8)), fresh_folder(spark, "state")
    exact_dedup.update_state(spark, path, checkpoint)
    edge_docs.filter("doc_id = 5").write.mode("append").parquet(path)
    state = exact_dedup.update_state(spark, path, checkpoint)
    assert state.agg(F.sum("n")).first()[0] == spark.read.parquet(path).count()


def test_empty_tables(spark, no_docs):
    path = saved(spark, no_docs)
    assert exact_dedup.deduplicate(spark, path).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert quality.keep_good(no_docs, labels, F.lit(True)).count() == 0
    assert decontaminate.decontaminate(no_docs, benchmark).count() == 0
    model = langid.fit(no_docs, F.lit(True))
    assert no_docs.select(langid.detector(model)("text")).count() == 0
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert sharding.assign(no_docs).count() == 0
    assert lm.score(no_docs, F.lit(True)).count() == 0
    assert mixing.taken(no_docs).count() == 0
    assert mixing.mix(no_docs).columns == no_docs.columns
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.format_turns(turns)).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(pages, {"net/": "block"}).count() == 0


# --- op2 ------------------------------------------------------------------------------------------------------


def test_url_filter(spark):
    rules = {"net/": "block", "ok.net/en/": "allow", "org/fr/": "allow", "bad.com/junk/": "block"}
    urls = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://a.net/x", "http://ok.net/en/1", "x://ok.net/en?q"]
    urls += [f"http://bad.com/junk/{i}" for i in range(30)] + [f"http://bad.com/news/{i}" for i in range(30)]
    urls += ["http://bad.com/junk", "http://notbad.com/junk/1", "https://a.org/fr/2#x", "http://h/é/ß?x#y", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id bigint, url string, host int")
    for r in url_filter.judge(pages, rules).collect():
        url = urls[r["page_id"]]
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
        fits = [
            k for k in rules
            if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith(k[k.index("/") :])
        ]
        rule = max(fits, key=len, default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (rules[rule] if rule else "allow")


def test_url_templates(spark):
    rows = [("h", ["a", f"s{i}"], 1 if i < 25 else 0, 1 if i < 25 else 0, 1) for i in range(40)] + [("h", ["b", "x"], 0, 3, 3)]
    paths = spark.createDataFrame(rows, "host string, segments array<string>, blocked bigint, labelled bigint, urls bigint")
    found = {r["template"]: r for r in url_filter.rejected_templates(paths).collect()}
    assert set(found) == {"/a/*", "/b/x"}  # many rare segments become one template
    assert found["/a/*"]["rejected"] and not found["/b/x"]["rejected"]
    assert found["/a/*"]["purity"] == pytest.approx((25 + 2 * 25 / 28) / 27)


def test_url_frequent_section_stays_a_branch(spark):
    """One hot labelled section among many: its verdict is not that of the others, on either side of 20 sections."""
    for sections in (15, 40):
        urls = [f"http://a.com/de/{i}" for i in range(300)]
        urls += [f"http://a.com/s{k}x/{i}" for k in range(sections) for i in range(600 // sections)]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
        found = url_filter.judge(pages, {"a.com/de/": "block"}).collect()
        assert all(r["verdict"] == ("block" if r["page_id"] < 300 else "allow") for r in found)
        assert {r["template"] for r in found if r["page_id"] < 300} == {"/de/<num>"}
        if sections == 40:
            assert {r["template"] for r in found if r["page_id"] >= 300} == {"/*/<num>"}


# --- op3, op5 -------------------------------------------------------------------------------------------------


def test_quality_learns_and_takes_anything(spark, edge_docs, words):
    good = [(100 + i, words(i, 60)) for i in range(40)]
    junk = [(200 + i, " ".join(w + "$$$" for w in words(i, 60).split())) for i in range(40)]
    docs = spark.createDataFrame([*good, *junk], "doc_id bigint, text string")
    labels = [(i, int(i < 200), 0) for i, _ in [*good, *junk]] + [(None, 1, 0), (100, None, 0), (100, 0, 1), (7, 3, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    table = quality.fit(docs, labels, F.col("doc_id") % 4 != 2)
    found = {r[0]: r[1] for r in docs.select("doc_id", quality.scorer(table)("text")).collect()}
    assert all((found[i] >= 0.7) == (i < 200) for i in found)
    scores = [r[0] for r in edge_docs.select(quality.scorer(table)("text")).collect()]
    assert len(scores) == edge_docs.count() and all(0 <= s <= 1 for s in scores)
    assert quality.keep_good(edge_docs, labels, F.lit(True)).columns == edge_docs.columns


def test_quality_score_is_the_average_over_features():
    table = np.random.default_rng(1).normal(size=1 << 10).astype(np.float32)
    texts = [b"", b"a", b"ab ab  ab\ncd", "schön ist".encode(), b"x y " * 500]
    for text, got in zip(texts, quality.score_texts(texts, table)):
        found = np.concatenate([b for _, _, b in quality.features([text], 1 << 10)])
        assert got == pytest.approx(1 / (1 + math.exp(-table[found].mean(dtype=np.float64))), rel=1e-5)


def test_kneser_ney_sums_to_one_and_matches_a_plain_version():
    texts = ["the cat sat on the mat", "the hat", "a cat"]
    model = langid.train({"xx": texts})
    scorer = langid.Scorer(model)
    coded = [langid.symbols(t).tolist() for t in texts]
    n_max, d = langid.ORDER, langid.DISCOUNT
    grams = [Counter(tuple(c[i - n + 1 : i + 1]) for c in coded for i in range(n_max - 1, len(c))) for n in range(n_max + 1)]
    longer = Counter(tuple(c[i - n_max + 1 : i + 1]) for c in coded for i in range(n_max - 1, len(c)))
    size = len({c[i] for c in coded for i in range(n_max - 1, len(c))}) + 1

    def p(gram):
        if not gram:
            return 1 / size
        n = len(gram)
        if n == n_max:
            counts = longer
        else:  # different symbols before
            counts = Counter(g[1:] for g in grams[n + 1])
        context = gram[:-1]
        own = {g: k for g, k in counts.items() if g[:-1] == context}
        if not own:
            return p(gram[1:])
        total = sum(own.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * p(gram[1:])

    symbols = {c[i] for c in coded for i in range(n_max - 1, len(c))}
    lost = p((0,))  # one symbol more than was seen
    assert sum(p((*coded[0][:3], s)) for s in symbols) <= 1 and sum(p((s,)) for s in symbols) + lost == pytest.approx(1)
    text = coded[1]
    expected = -sum(math.log(p(tuple(text[i - n_max + 1 : i + 1]))) for i in range(n_max - 1, len(text)))
    entropy, n = scorer.entropies(texts[1])
    assert entropy[0] * n == pytest.approx(expected, rel=1e-4)


def test_language(spark, edge_docs):
    samples = [("en", "the house and the garden of this man"), ("de", "das Haus und der Garten des Mannes")]
    rows = [(100 + i, samples[i % 2][1] + f" {'abcdefgh'[i % 8]}", samples[i % 2][0]) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs, F.lit(True))
    found = {r[0]: r[1]["lang_pred"] for r in docs.select("doc_id", langid.detector(model)("text")).collect()}
    assert all(found[i] == lang for i, _, lang in rows)
    for r in edge_docs.select("text", langid.detector(model)("text").alias("x")).collect():
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["x"]["lang_pred"] != "und") == letters and 0 <= r["x"]["score"] <= 1


# --- op4 ------------------------------------------------------------------------------------------------------


def _edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_against_every_alignment(words):
    rng = random.Random(4)
    items = [(i, words(50 + i, 12 + 9 * i)) for i in range(4)]
    windows = [w for i, t in items for w in decontaminate.windows_of(i, t)]
    index = decontaminate.Index(windows)
    texts = []
    for k in range(24):
        _, text = items[k % 4]
        chars = list(text[: 20 + 5 * k])
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.choice((0, 1))] = rng.choice(("z", ""))
        texts.append(words(k, 20) + " " + "".join(chars) + " " + words(k + 1, 20))
    folded = ["".join(map(chr, decontaminate.folded(t))) for t in texts]
    for text, got in zip(folded, index.matches(texts)):
        assert got == sorted({w.item for w in windows if _edits("".join(map(chr, w.codes)), text) <= w.edits})


def test_decontamination_rows(spark, edge_docs, words):
    items = [(1, words(5, 30)), (2, None), (3, ""), (4, "short"), (None, "x"), (1, words(5, 30)), (9, words(77, 40))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (decontaminate.BLOCK, 200):  # one block, several blocks
        found = edge_docs.select("doc_id", decontaminate.matched_items(edge_docs, benchmark, block=block).alias("m"))
        assert {r["doc_id"] for r in found.collect() if r["m"]} == {5, 6, 7, 8}
    kept = decontaminate.decontaminate(edge_docs, benchmark)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 5


# --- op6 ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|x", "<\\\\|<||>", "a\nb", "é\u2028<|", "\\n", "<" * 5 + "|" * 5])
def test_chat_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
    codec = chat.Codec(chat.vocabulary())
    for role in ("user", "assistant", text):
        ids, mask = codec.assemble(role, text)
        got_role, got_text, trained, printed = codec.read(ids, mask)
        assert (got_role, got_text) == (role, text)
        assert trained == (text if role == "assistant" else "")
        assert (ids == codec.start).sum() == (ids == codec.end).sum() == 1
        assert printed == len(f"<|im_start|>{chat.escape_role(role)}\n{chat.escape(text)}<|im_end|>\n")


def test_chat_positions(spark):
    rows = [(1, 1, "assistant", None, 0), (1, 0, None, "hi", 0), (None, 0, "user", "x", 0), (1, 1, "assistant", "b", 0)]
    turns = chat.format_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, position int"))
    own = [r for r in turns.collect() if r["conv_id"] == 1]
    assert [r["position"] for r in own] == [0, own[0]["n_tokens"], own[0]["n_tokens"] + own[1]["n_tokens"]]
    said = {r["conv_id"]: r for r in chat.digests(turns).collect()}
    assert said[1]["turns_sha256"] == hashlib.sha256(b"\nhi\nassistant\n\nassistant\nb\n").hexdigest()
    assert (said[1]["n_turns"], said[1]["loss_chars"], said[None]["n_turns"]) == (3, 1, 1)


# --- op7 ------------------------------------------------------------------------------------------------------


def test_samples_agree_as_often_as_texts_are_similar(words):
    idf = np.ones(1 << near_dedup.IDF_BITS, np.float32)
    idf[::3] = 0.4
    agree, similar = [], []
    for seed in range(60):
        a = words(seed, 200).split() + ["again"] * 20
        b = [w if i % (5 + seed) else "new" + w for i, w in enumerate(a)]
        owner, hashes, tf = near_dedup.shingles([" ".join(a).encode(), " ".join(b).encode()])
        weight = near_dedup.weights(hashes, tf, idf)
        _, found = near_dedup.samples(owner, hashes, weight)
        agree.append((found[:, 0] == found[:, 1]).mean())
        one, two = owner == 0, owner == 1
        got = near_dedup.similarity((hashes[one], weight[one]), (hashes[two], weight[two]))
        left, right = dict(zip(hashes[one], weight[one])), dict(zip(hashes[two], weight[two]))
        keys = set(left) | set(right)
        plain = sum(min(left.get(k, 0), right.get(k, 0)) for k in keys) / sum(max(left.get(k, 0), right.get(k, 0)) for k in keys)
        assert got == pytest.approx(plain, rel=1e-5)
        similar.append(plain)
    assert abs(np.mean(agree) - np.mean(similar)) < 0.03


def test_near_dedup_against_every_pair(spark, words):
    rng = random.Random(9)
    texts = {}
    for group in range(12):
        base = words(group, 150).split()
        for copy in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.choice((0, 1, 2, 9, 30))):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sets = {i: Counter(zip(*(t.split()[k:] for k in range(5)))) for i, t in texts.items()}
    label = {i: i for i in texts}
    for a in texts:
        for b in range(a):
            low = sum(min(1 + math.log(sets[a][k]), 1 + math.log(sets[b][k])) for k in sets[a].keys() & sets[b].keys())
            high = sum(1 + math.log(v) for s in (sets[a], sets[b]) for v in s.values()) - low
            if low / high >= 0.8:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    found = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs).collect()}
    assert {i: r["class_id"] for i, r in found.items()} == label
    assert all(r["kept"] == (i == r["class_id"]) for i, r in found.items())
    assert {r["doc_id"] for r in near_dedup.keep_one(docs).collect()} == set(label.values())


def test_near_dedup_in_a_large_bucket(spark, words):
    """400 texts about a shared passage, just too far apart, and 6 hidden pairs that agree in three words more."""
    passage, n = words(1, 160), 400
    tails = [[f"t{i}x{k}" for k in range(22)] for i in range(n)]
    for i in range(0, 12, 2):
        tails[i + 1][:3] = tails[i][:3]
    texts = {i: f"{passage} {' '.join(tail)}" for i, tail in enumerate(tails)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)))) for i, t in texts.items()}
    assert all(len(s) == len(t.split()) - 4 for s, t in zip(sets.values(), texts.values()))  # each once: weight 1
    idf = near_dedup.idf_table(docs)
    bands = {r["doc_id"]: set(enumerate(r["bands"])) for r in near_dedup._signatures(docs, idf).collect()}
    label = {i: i for i in texts}
    for a in texts:
        for b in range(a):
            same = len(sets[a] & sets[b])
            if bands[a] & bands[b] and same / (len(sets[a]) + len(sets[b]) - same) >= 0.8:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    assert len(set(label.values())) == n - 6
    found = near_dedup.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == label


def test_near_dedup_rows(spark, edge_docs):
    kept = near_dedup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] or 0) for r in kept.collect())
    assert ids == [0, 1, 2, 3, 4, 5, 9, 10, 11, 12]  # 6, 7, 8 and 13 are near copies of 5 and 12


# --- op8 ------------------------------------------------------------------------------------------------------


def test_sharding(spark, edge_docs, words):
    rows = [(i, words(i % 40 if i < 160 else 1, 9) if i < 400 else words(i, 9)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for frame, shards in ((docs, 16), (edge_docs, 40)):
        found = sharding.assign(frame, shards).collect()
        held = defaultdict(list)
        for r in found:
            held[r["shard"]].append(r["slot"])
        sizes = [len(held[k]) for k in range(shards)]
        assert len(found) == frame.count() and max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in held.values())
        texts = Counter((r["doc_id"], zlib.crc32((r["text"] or "").encode())) for r in frame.collect())
        assert Counter((r["doc_id"], r["text_crc32"]) for r in found) == texts
    shard = {r["doc_id"]: r["shard"] for r in sharding.assign(docs).collect()}
    small = [{shard[i] for i, t in rows[:160] if t == rows[k][1]} for k in range(40) if k != 1]
    assert sum(len(s) > 1 for s in small) <= 2  # copies share a shard, unless its quota was used up meanwhile
    large = Counter(shard[i] for i, t in rows if t == rows[1][1])  # 244 copies, 56 rows a shard
    assert len(large) <= 6


def test_sharding_uses_room_to_the_row(spark, monkeypatch):
    """A hub of a third of all rows fills shards exactly, though a bucket of wishes holds far more than is left over."""
    monkeypatch.setattr(sharding, "GRAIN", 4)
    rows = [(i, "hub" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sharding.assign(docs).collect()
    held = Counter(r["shard"] for r in found if r["doc_id"] % 3 == 0)
    assert sorted(held.values(), reverse=True) == [187, 187, 187, 187, 187, 65]  # 3000 rows on 16 shards: quota 187
    assert Counter(Counter(r["shard"] for r in found).values()) == {187: 8, 188: 8}


# --- op9 ------------------------------------------------------------------------------------------------------


def test_ppm_against_a_plain_version():
    texts = [b"abracadabra", b"abrakadabra abc", b"", "größe".encode()]
    depth = 3
    keys, counts = np.unique(np.concatenate([lm.grams(t, depth) for t in texts]), return_counts=True)
    trie = lm.Trie(keys, counts, depth)
    seen = defaultdict(Counter)
    for t in texts:
        s = bytes([lm.START]) * depth + t + bytes([lm.END])
        for i in range(depth, len(s)):
            for k in range(depth + 1):
                seen[s[i - k : i]][s[i]] += 1

    def p(context, symbol):
        out, gone = 1.0, set()
        for k in range(depth, -1, -1):
            own = seen.get(context[depth - k :])
            left = {s: c for s, c in (own or {}).items() if s not in gone}
            n, d = sum(left.values()), len(left)
            if symbol in left:
                return out * (left[symbol] - 0.5) / n
            if d:
                out *= d / (2 * n)
            gone = set(own or {})
        return out / (256 - len(gone))

    for t in [*texts, b"xyz", b"abrax", bytes(range(1, 60))]:
        s = bytes([lm.START]) * depth + t + bytes([lm.END])
        expected = sum(math.log10(p(s[i - depth : i], s[i])) for i in range(depth, len(s)))
        assert trie.log10([t])[0] == pytest.approx(expected, rel=1e-9)
        assert trie.log10([t, b"q", t], block=4)[2] == pytest.approx(expected, rel=1e-9)


def test_lm_base(spark, edge_docs):
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    rows = edge_docs.select("doc_id", "text", learn.alias("learn")).collect()
    words = [WORD.findall((r["text"] or "").translate(LOWER).encode()) for r in rows]
    taught = [w for w, r in zip(words, rows) if r["learn"]]
    counts = Counter(x for w in taught for x in w)
    n, v = sum(counts.values()) + len(taught), len(counts) + 1
    expected = Counter()
    for w, r in zip(words, rows):
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        base += math.log10((len(taught) + 0.5) / (n + 0.5 * (v + 1)))
        expected[r["doc_id"], not r["learn"], len(w) + 1, sum(x in counts for x in w) + 1, n, round(base, 6)] += 1
    found = lm.score(edge_docs, learn).collect()
    got = Counter((*list(r)[:5], round(r["base_score"], 6)) for r in found)
    assert got == expected
    texts = [(r["text"] or "").encode() for r in rows]
    trie = lm.Trie(*lm.gram_counts([t for t, r in zip(texts, rows) if r["learn"]], lm.DEPTH), lm.DEPTH)
    wanted = sorted((r["doc_id"] or 0, x) for r, x in zip(rows, trie.log10(texts)))
    for load in (lm.RANGE, 1 << 12):  # one part; many, some repeated
        dealt = sorted((r["doc_id"] or 0, r["score"]) for r in lm.score(edge_docs.repartition(3), learn, load=load).collect())
        assert [x for x, _ in dealt] == [x for x, _ in wanted]
        assert [x for _, x in dealt] == pytest.approx([x for _, x in wanted], rel=1e-6)


def test_lm_without_training(spark, edge_docs):
    for r in lm.score(edge_docs, F.lit(False)).collect():
        assert r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0
        assert r["score"] == pytest.approx(-(r["n_bytes"] + 1) * math.log10(256), rel=1e-6)


# --- op10 -----------------------------------------------------------------------------------------------------


def test_mixing(spark, edge_docs, words):
    rng = random.Random(2)
    rows = [(i, words(i, rng.choice((1, 5, 40, 300))), rng.choice(("a", "b", "c", "ä", None) + ("hot",) * 5)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    size = {i: len(t.split()) for i, t, _ in rows}
    total = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    order = [*sorted(s for s in total if s is not None), None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:
        budget = 1.5 * sum(total.values()) - sum(2 * total[s] for s in full)
        rest = [s for s in order if s not in full]
        target = {s: budget * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = {s for s in rest if target[s] > 2 * total[s]}
        if not above:
            break
        full |= above
    target |= {s: 2 * total[s] for s in full}
    source = {i: s for i, _, s in rows}
    found = mixing.taken(docs).collect()
    took = Counter()
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        took[source[r["doc_id"]]] += r["taken"]
    assert {s: (took[s], target[s]) for s in order if abs(took[s] - target[s]) > 0.01 * target[s] + 40} == {}
    again = {r["doc_id"]: r["taken"] for r in mixing.taken(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in found}
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    for r in mixing.taken(edge_docs).groupBy("doc_id").agg(F.sum("size"), F.sum("taken")).collect():
        assert not r[1] or copies[r[0]] * r[1] == r[2] * (2 if r[0] == 8 else 1)
