"""Kneser-Ney models of several languages against a plain version, and what bounds the sample."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from finloom.llm import langid

SAMPLES = {
    "en": ["the cat sat on the mat", "the hat", "a cat and a dog"],
    "de": ["die Katze saß auf der Matte", "der Hund", "über den Hügel"],
    "ru": ["кот сидел на коврике", "a кот"],
}
UNSEEN = ["the dog sat on der Matte", "кошка the ß", "日本 the cat", "zzz qqq", "a"]


def plain(samples):
    """P(symbol after context) by the definition, for one language; `size` symbols in all languages together, and one."""
    coded = {k: [langid.symbols(t).tolist() for t in v] for k, v in samples.items()}
    n_max, d = langid.ORDER, langid.DISCOUNT
    size = len({s for v in coded.values() for c in v for s in c[n_max - 1 :]}) + 1

    def of(language):
        places = [(c, i) for c in coded[language] for i in range(n_max - 1, len(c))]
        counts = {n_max: Counter(tuple(c[i - n_max + 1 : i + 1]) for c, i in places)}
        for n in range(n_max - 1, 0, -1):
            counts[n] = Counter(g[1:] for g in {tuple(c[i - n : i + 1]) for c, i in places})

        def p(gram):
            if not gram:
                return 1 / size
            own = {g: k for g, k in counts[len(gram)].items() if g[:-1] == gram[:-1]}
            if not own:
                return p(gram[1:])
            total = sum(own.values())
            return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * p(gram[1:])

        return p

    return {k: of(k) for k in samples}


@pytest.mark.parametrize("text", [*UNSEEN, *SAMPLES["de"]])
def test_every_language_agrees_with_the_plain_version(text):
    model = langid.train(SAMPLES)
    entropy, n = langid.Scorer(model).entropies(text)
    code = langid.symbols(text).tolist()
    for k, p in plain(SAMPLES).items():
        expected = -sum(math.log(p(tuple(code[i - langid.ORDER + 1 : i + 1]))) for i in range(langid.ORDER - 1, len(code)))
        assert entropy[model.languages.index(k)] * n == pytest.approx(expected, rel=1e-4)


@pytest.mark.parametrize("context", ["   ", "the", "Mat", "кот", "日本 ", "zzz"])
def test_probabilities_of_the_code_sum_to_one(context):
    model = langid.train(SAMPLES)
    scorer = langid.Scorer(model)
    before = [ord(c.lower()) for c in context]
    known = {s for v in SAMPLES.values() for t in v for s in langid.symbols(t)[langid.ORDER - 1 :].tolist()}
    total = sum(np.exp(scorer._sum(np.array([*before, s], np.uint32))) for s in [*known, ord("日")])
    assert total == pytest.approx(np.ones(3), rel=1e-4)


def test_copies_and_long_texts_do_not_pass_the_bound(spark, monkeypatch):
    """3,000 equal rows without an id and texts of 200,000 characters: few short stretches reach the driver."""
    seen = {}
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda samples: seen.update(samples) or train(samples))
    copies = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'the same old words' AS text", "'en' AS lang")
    long = spark.range(40).selectExpr("id AS doc_id", "concat(id, repeat(' der Hund', 22000)) AS text", "'de' AS lang")
    model = langid.fit(copies.unionByName(long), F.lit(True), per_language=20, longest=500)
    assert set(model.languages) == {"en", "de"}
    assert len(seen["en"]) == 1 and 5 <= len(seen["de"]) <= 35
    assert all(len(t) == 500 for t in seen["de"])
