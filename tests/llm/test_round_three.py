"""Periodic runs, repeated substrings and hard negatives against plain versions, and cases that caps once got wrong."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finloom.llm import decontaminate, langid, mixing, negatives, queries, runs, substrings, url_filter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# --- op11 -------------------------------------------------------------------------------------------------------------


def plain_runs(w, least=runs.LEAST):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                own = w[i : j + p]
                if not any(all(a == b for a, b in zip(own, own[q:])) for q in range(1, p)):
                    out.append((i, j - i + p, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def test_suffix_tree_extensions():
    rng = random.Random(1)
    for _ in range(200):
        w = [rng.randrange(rng.choice((1, 2, 4))) for _ in range(rng.randrange(1, 30))]
        tree = runs.SuffixTree([*w, -1])
        assert tree.leaves == sorted(range(len(w) + 1), key=lambda i: [*w[i:], -1])
        assert tree.leaves_reversed() == sorted(range(len(w) + 1), key=lambda i: [*(-x for x in w[i:]), -99])
        i, j = (np.array(x) for x in zip(*[(i, j) for i in range(len(w) + 1) for j in range(len(w) + 1) if i != j]))
        plain = [next((k for k in range(99) if [*w, -1][a + k : a + k + 1] != [*w, -1][b + k : b + k + 1]), 0) for a, b in zip(i, j)]
        assert tree.common(i, j).tolist() == plain


def test_runs_of_random_words():
    rng = random.Random(2)
    for _ in range(400):
        n, k = rng.randrange(70), rng.choice((1, 2, 3, 5))
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.4 and n > 5:
            a, p = rng.randrange(n - 2), rng.randrange(1, 6)
            w = [w[a + (i - a) % p] if i >= a and a + (i - a) % p < n else x for i, x in enumerate(w)]
        texts = [" ".join(f"w{x}" for x in v).encode() for v in (w, [], w[::-1])]
        text, start, length, period, counts = runs.find_runs(texts)
        expected = [(t, *r) for t, v in ((0, w), (2, w[::-1])) for r in plain_runs(v)]
        assert list(zip(text.tolist(), start.tolist(), length.tolist(), period.tolist())) == expected
        assert counts.tolist() == [n, 0, n]


def test_periodic_runs_of_awkward_rows(spark, edge_docs, no_docs):
    more = [(20, "a b " * 9 + "c", "en", "a"), (20, "a b " * 9 + "c", "en", "a"), (21, "x " * 30_000, "en", "b"), (22, "é ß " * 12, None, None)]
    docs = edge_docs.unionByName(spark.createDataFrame([(*r, 1, 1, 2, 3) for r in more], edge_docs.schema))
    docs = docs.withColumnRenamed("gone", "runs").withColumnRenamed("times", "N_WORDS")
    found = runs.periodic_runs(docs)
    assert found.columns == [*docs.columns, "n_words_", "runs_", "collapsed"]
    name = "runs_"
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        w = WORD.findall((r["text"] or "").encode())
        # the long text of edge_docs has words by a square modulo 9973
        expected = plain_runs(w) if len(w) < 2000 else {4: [(0, 60_000, 9973)], 21: [(0, 30_000, 1)]}[r["doc_id"]]
        assert [tuple(x) for x in r[name]] == expected
        assert r["collapsed"].encode() == plain_collapse(w, expected)
    assert runs.periodic_runs(no_docs).count() == 0


def test_op11(spark, small):
    rows = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    seen = 0
    for doc_id, text in docs:
        w = WORD.findall((text or "").encode())
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if n > 700:
            continue
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
        found = plain_runs(w)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        told = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        kept = hashlib.sha256(plain_collapse(w, found)).hexdigest()
        milli = 1000 * best[1] // best[2] if found else None
        assert tuple(rows[doc_id]) == (doc_id, len(found), *best, milli, told, kept)
        seen += bool(found)
    assert seen


# --- op12 -------------------------------------------------------------------------------------------------------------


def plain_spans(texts, w):
    strings = Counter(t[i : i + w] for t in texts for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        spans: list[list[int]] = []
        for i in range(len(t) - w + 1):
            if strings[t[i : i + w]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + w
                else:
                    spans.append([i, i + w])
        out.append(spans)
    return out


def test_suffix_array_and_matches():
    rng = random.Random(3)
    for _ in range(600):
        w = [rng.randrange(rng.choice((1, 2, 3, 8))) for _ in range(rng.randrange(40))]
        assert substrings.suffix_array(w) == sorted(range(len(w)), key=lambda i: w[i:])

        def common(i, j, w=w):
            return next((k for k in range(len(w)) if w[i + k : i + k + 1] != w[j + k : j + k + 1] or max(i, j) + k >= len(w)), 0)

        plain = [max((common(i, j) for j in range(len(w)) if j != i), default=0) for i in range(len(w))]
        assert substrings.longest_matches(w) == plain


@pytest.mark.parametrize("alphabet, limit, piece", [("a", 2, 50), ("ab", 2, 1 << 20), ("abcdef", 5, 64), ("ab", 2048, 1 << 20)])
def test_repeated_spans(spark, monkeypatch, alphabet, limit, piece):
    """Passages cut anywhere into random surroundings, groups halved down to single windows, texts cut into pieces."""
    rng = random.Random(len(alphabet) * limit)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(20, 120))) for _ in range(4)]
    texts = []
    for _ in range(100):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            parts.append(p[rng.randrange(len(p)) :] + "".join(rng.choice(alphabet) for _ in range(rng.randrange(6))))
        texts.append("".join(parts))
    texts += [*texts[:5], "", None, "é" * 20, "xé" + "é" * 20]
    owner, place, _ = substrings.anchors([(t or "").encode() for t in texts], 24, 9)
    monkeypatch.setattr(substrings, "_PIECE", piece)
    again = substrings.anchors([(t or "").encode() for t in texts], 24, 9)
    assert owner.tolist() == again[0].tolist() and place.tolist() == again[1].tolist()
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id bigint, text string, at int, key int")
    found = {r["doc_id"]: r for r in substrings.deduplicate(docs.repartition(3), w=24, k=9, limit=limit).collect()}
    for k, (t, spans) in enumerate(zip(texts, plain_spans([(t or "").encode() for t in texts], 24))):
        assert [[s["start"], s["start"] + s["length"]] for s in found[k]["spans"] or []] == spans
        body, kept, at = (t or "").encode(), b"", 0
        for a, b in spans:
            kept, at = kept + body[at:a], b
        assert bytes(found[k]["kept"]) == kept + body[at:]


def test_op12(spark, small, edge_docs, no_docs, tmp_path):
    assert substrings.repeated_spans(no_docs).count() == 0
    for folder, docs in ((small, None), (str(tmp_path), edge_docs)):
        if docs is not None:
            docs.write.parquet(f"{folder}/documents.parquet")
        rows = Counter(map(tuple, queries.op12_substrings(spark, folder).collect()))
        listed = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        texts = [(r["text"] or "").encode() for r in listed]
        expected = Counter()
        for r, t, spans in zip(listed, texts, plain_spans(texts, 400)):
            kept, at = b"", 0
            for a, b in spans:
                kept, at = kept + t[at:a], b
            kept += t[at:]
            expected[r["doc_id"], len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()] += 1
        assert rows == expected


# --- op13 -------------------------------------------------------------------------------------------------------------


def plain_negatives(rows, is_anchor, n_positive=5, n_negative=10):
    taken = []
    for own, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) or abs(x) >= 1 << 20 for x in vector):
            continue
        taken.append((own, [int(np.floor(256 * x)) for x in vector], label))
    place = lambda own: float("inf") if own is None else own
    out = Counter()
    for k, (anchor, v, label) in enumerate(taken):
        if not is_anchor(anchor):
            continue
        score = [sum(a * b for a, b in zip(v, u)) for _, u, _ in taken]
        order = sorted((i for i in range(len(taken)) if i != k), key=lambda i: (-score[i], place(taken[i][0]), i))
        for p in [i for i in order if taken[i][2] == label][:n_positive]:
            inside = [i for i in order if taken[i][2] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            for rank, i in enumerate(inside[:n_negative], 1):
                out[anchor, taken[p][0], rank, taken[i][0], score[p], score[i]] += 1
    return out


@pytest.mark.parametrize("settings", [negatives.Settings(), negatives.Settings(anchors=3, candidates=7)])
def test_hard_negatives(spark, settings):
    """Ties, repeated rows, other lengths, large and missing values, in one block and in many."""
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [round(c + rng.gauss(0, 0.4), 1) for c in centres[i % 4]], i % 3) for i in range(120)]
    rows += [rows[10], rows[20], (None, rows[5][1], 1), (130, rows[7][1], 2), (140, [1.0, 2.0], 0), (150, [], 1)]
    rows += [(160, None, 1), (170, [1.0, None], 1), (180, [float("nan")] * 6, 1), (190, [float("inf")] * 6, 1), (200, rows[3][1], None)]
    rows += [(210, [9e5, -9e5, 1.0, 0.0, 0.0, 0.0], 2), (220, [2e6] * 6, 0)]
    schema = "vec_id bigint, embedding array<float>, label int, row int, id string"
    exact = [(a, None if v is None else [None if x is None else float(np.float32(x)) for x in v], b) for a, v, b in rows]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], schema).repartition(3)
    found = negatives.mine(frame.select("vec_id", "embedding", "label", "row"), F.col("id") % 10 == 0, settings=settings)
    expected = plain_negatives(exact, lambda own: own is not None and own % 10 == 0)
    assert Counter(map(tuple, found.collect())) == expected and expected


def test_bounds_hold_and_spare_scores():
    """Anchors close to each other: few candidates are scored again, and every score lies within its bounds."""
    rng = np.random.default_rng(5)
    centre = rng.integers(-200, 200, 32)
    matrix = {"a": centre + rng.integers(-3, 4, (40, 32)), "c": rng.integers(-200, 200, (500, 32))}
    row = {}
    for side, m in matrix.items():
        order, (parent, edge) = negatives.spanning_tree(m.astype(float))
        assert parent[0] == -1 and all(p < k for k, p in enumerate(parent) if k)
        m = matrix[side] = m[order]
        parts = (np.arange(len(m)), np.arange(len(m)), np.zeros(len(m), np.int64), m.astype(np.int32), parent.astype(np.int64), edge)
        row |= {f"{side}_{f}": x.tobytes() for f, x in zip(negatives._BLOCK_FIELDS, parts)} | {f"{side}_n": len(m)}
    a, c = negatives._Block(row, "a"), negatives._Block(row, "c")
    bounds = negatives.Bounds(a, c)
    truth = matrix["a"] @ matrix["c"].T
    for k in range(len(a.id)):
        low, high = bounds.of(k)
        assert (low <= truth[k]).all() and (truth[k] <= high).all()
        top = np.flatnonzero(high >= negatives._largest(low, 5))
        assert set(np.argsort(-truth[k], kind="stable")[:5]) <= set(top)
        bounds.score(k, low, high, top)
    assert bounds.scored < 0.5 * truth.size


def test_blocks_are_neither_broadcast_nor_collected(spark):
    """Pairs of blocks are many more bytes than blocks; a small table's must not be sent through the driver either."""
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], i % 3) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    settings = negatives.Settings(anchors=3, candidates=7)
    prepared = negatives.prepare(frame)
    blocks = [negatives._blocks(prepared, n, tree, "test") for n, tree in ((3, True), (7, False))]
    for found in (negatives.positives(*blocks, settings), negatives.mine(frame, F.col("id") % 10 == 0, settings=settings)):
        assert found.count()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_each_cell_gets_a_partition(spark):
    for n in (1, 7, 24):
        dealt = spark.createDataFrame([(k,) for k in negatives._keys(spark, n)], "cell int").repartition(n, "cell")
        assert sorted(r[0] for r in dealt.select(F.spark_partition_id()).collect()) == list(range(n))


def block_of(vectors, label, tree, start=0):
    n = len(vectors)
    columns = (np.arange(start, start + n), np.arange(start, start + n) * 7 % 50, np.array(label), [np.array(v, np.int32) for v in vectors])
    batch = pa.RecordBatch.from_arrays(
        [*(pa.array(x, pa.int64()) for x in columns[:3]), pa.array(columns[3], pa.list_(pa.int32()))], ["row", "id", "label", "vector"]
    )
    names = ["block", "n", "size", "item", *negatives._BLOCK_FIELDS]
    return negatives._Block({f"block_{k}": x for k, x in zip(names, negatives._pack(batch, start, tree))}, "block")


@pytest.mark.parametrize("scale, kind", [(1, np.float32), (1 << 12, np.float64), (1 << 21, np.int64)])
@pytest.mark.parametrize("worth", [0, negatives.WORTH])
def test_search_of_one_cell(monkeypatch, scale, kind, worth):
    """Anchors close together and far apart, one very common vector, all kinds of numbers; pieces by bounds or whole."""
    monkeypatch.setattr(negatives, "WORTH", worth)
    rng = np.random.default_rng(7)
    centre = rng.integers(-100, 100, (4, 24))
    near = lambda n: centre[rng.integers(0, 4, n)] + rng.integers(-6, 7, (n, 24))
    vectors = np.concatenate([near(60), rng.integers(-100, 100, (40, 24)), np.repeat(centre[:1], 700, 0), near(1500)]) * scale
    label = rng.integers(0, 3, len(vectors))
    a = block_of(vectors[:100], label[:100], True)
    assert len(a.pieces) and len(a.alone) and set(a.alone) | {k for p in a.pieces for k in p} == set(range(100))
    cells = [block_of(vectors[k : k + 300], label[k : k + 300], False, k) for k in range(0, len(vectors), 300)]
    score = vectors @ vectors[a.row].T  # exact: below 2^63
    own = np.concatenate([c.id[np.argsort(c.row)] for c in cells])
    most = np.iinfo(np.int64).max
    for same, windows in ((True, [(-most, most)]), (False, [(0, most), (scale * scale * 1000, scale * scale * 50_000), (1, 0)])):
        least, high = (np.array([[w[i] for w in windows]] * 100) for i in (0, 1))
        found = negatives._Firsts(least, high, 5)
        for c in cells:
            bounds = negatives.Bounds(a, c)
            assert bounds.left.dtype == kind
            negatives._search(bounds, found, same)
            found.merge()
        got = list(zip(*(x.tolist() for x in found.rows())))
        expected = []
        for k in range(100):
            fit = (label == a.label[k]) == same
            fit[a.row[k]] = False
            for w, (low, top) in enumerate(windows):
                at = np.flatnonzero(fit & (score[:, k] >= low) & (score[:, k] <= top))
                at = at[np.lexsort((at, own[at], -score[at, k]))[:5]]
                expected += [(k, w, int(score[i, k]), int(own[i]), int(i)) for i in at]
        assert got == expected


def test_no_embeddings(spark):
    nothing = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert negatives.mine(nothing, F.col("id") % 100 == 0).count() == 0


# --- what caps once got wrong -----------------------------------------------------------------------------------------


def verdicts(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    return Counter((r["path"].rsplit("/", 1)[0], r["verdict"]) for r in url_filter.judge(pages, rules).collect())


def test_branches_that_part_deep(spark):
    urls = [f"http://h.com/w/x/y/z/{kind}/{i}" for kind in ("bad", "good") for i in range(30)]
    found = verdicts(spark, urls, {"h.com/w/x/y/z/bad/": "block"})
    assert found == {("/w/x/y/z/bad", "block"): 30, ("/w/x/y/z/good", "allow"): 30}


def test_few_labels_do_not_speak_for_a_wildcard(spark):
    urls = [f"http://h.com/s{k}/{i}" for k in range(31) for i in range(10)]
    found = verdicts(spark, urls, {"h.com/s0/": "block"})
    assert found == {(f"/s{k}", "allow" if k else "block"): 10 for k in range(31)}


def test_code_points_beyond_the_table():
    rng = random.Random(6)
    one, two = ("".join(chr(0x20000 + rng.randrange(5000)) for _ in range(120)) for _ in range(2))
    index = decontaminate.Index(decontaminate.windows_of(1, one))
    assert index.matches([two, f"x {one} y"]) == [[], [1]]
    assert len(np.unique(langid.symbols(one))) > 100


def test_short_items_are_matched_as_words():
    items = [(1, "is it 7"), (2, "a"), (3, "b?"), (2, "a")]
    index = decontaminate.Index([w for i, t in items for w in decontaminate.windows_of(i, t)])
    assert index.matches(["Is it 7", "this it 70", "7 A. b", "ab", "", None]) == [[1], [], [2, 3], [], [], []]


def test_banded_alignment_equals_the_whole_one():
    def whole(p, r, e):
        row = [0] * (len(r) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(r, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        return min(min(row), e + 1)

    rng = random.Random(7)
    for _ in range(500):
        p, r = ([rng.randrange(3) for _ in range(rng.randrange(1, n))] for n in (20, 40))
        e = rng.randrange(5)
        assert decontaminate.distance(np.array(p, np.uint32), np.array(r, np.uint32), e) == whole(p, r, e)


def test_frequent_qgrams_are_counted_in_slices(monkeypatch):
    phrase = "the quick brown fox jumps over "
    items = [phrase * 3 + f"tail {i * 7919}" for i in range(60)]
    windows = [w for i, t in enumerate(items) for w in decontaminate.windows_of(i, t)]
    text = phrase * 40 + items[3]
    expected = decontaminate.Index(windows).matches([text])
    monkeypatch.setattr(decontaminate, "SLICE", 500)
    assert decontaminate.Index(windows).matches([text]) == expected


def test_rows_without_an_id_are_told_apart(spark):
    rows = [(None if i % 3 else i, f"{i} " + "x " * 9, "ab"[i % 2]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for r in mixing.taken(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) <= 20
    again = mixing.taken(docs.repartition(5)).agg(F.sum("taken")).first()[0]
    assert again == mixing.taken(docs).agg(F.sum("taken")).first()[0]


def test_a_rare_language_is_learnt(spark):
    for seed in range(6):
        rows = [(seed * 100 + i, "the quick brown fox " * 5, "en") for i in range(9)] + [(seed * 100 + 50, "der schnelle braune Fuchs " * 5, "de")]
        model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
        assert set(model.languages) == {"de", "en"}
