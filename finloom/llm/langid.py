"""Language identification with interpolated Kneser-Ney character models.

Each language gets a character model of order ORDER over its lower-cased letters, other characters being one space.
For every n-gram seen in any language the finished interpolated log-probability under every language is stored, the
n-grams as sorted 64-bit hashes with one row of numbers each; contexts hold their interpolation weights likewise. One
look-up in the longest table gives the probability under all languages; only a miss goes to the next shorter table.
The language with the lowest cross-entropy per character wins. Its lead over the runner-up, scaled by a temperature
fitted on held-back training texts, is the score; predictions under the calibrated threshold are marked as rejected.

The shortest models are interpolated with one uniform distribution over all symbols of all languages and one more, which
stands for every symbol never seen; so a language's probabilities of the known symbols and of an unknown one sum to one.

The models are fitted on a bounded sample: about `per_language` different texts of each language, chosen by the hash of
doc_id and text, of each a stretch of at most `longest` characters that begins at a place given by the same hash. Every
document's whole text is scored by Spark.

Defined results: a row without doc_id may be learnt from if `learn` says so (in the registered query it has no fold: it is
not learnt from, and held_out is null); null or empty texts and texts without a letter give `und` with score 0; a null language is no training
row; with one language all texts with letters get it with score 1; with no training row everything is `und`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.tokens import mix

ORDER = 4
UNKNOWN = "und"
DISCOUNT = 0.75
CHUNK = 1 << 19  # characters handled at once
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ALPHABET = 1 << 17  # code points in the table; those beyond are looked at one by one


def _letters() -> np.ndarray:
    """Code point of the lower-case letter, 32 for anything else."""
    return np.array([_letter(c) for c in range(_ALPHABET)], np.uint32)


def _letter(c: int) -> int:
    low = chr(c).lower()
    return (ord(low) if len(low) == 1 else c) if chr(c).isalpha() else 32


def fold_codes(codes: np.ndarray, table: np.ndarray, fold: Callable[[int], int]) -> np.ndarray:
    """Code points folded by a table of the first ones, and by `fold` for each different one beyond."""
    far = codes >= len(table)
    if not far.any():
        return table[codes]
    out = table[np.where(far, 0, codes)]
    different, which = np.unique(codes[far], return_inverse=True)
    out[far] = np.array([fold(int(c)) for c in different], np.uint32)[which]
    return out


_fold: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Lower-case letters with single spaces between words and ORDER - 1 spaces before the first."""
    if not _fold:
        _fold.append(_letters())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    codes = fold_codes(codes, _fold[0], _letter)
    space = codes == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]  # the first of a run of spaces
    codes = codes[keep]
    if len(codes) and codes[0] == 32:
        codes = codes[1:]
    if not len(codes):
        return codes
    tail = [] if codes[-1] == 32 else [32]
    return np.concatenate([np.full(ORDER - 1, 32, np.uint32), codes, np.array(tail, np.uint32)])


def keys(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n symbols that end at each place from ORDER - 1 on."""
    wide = codes.astype(np.uint64)
    out = np.zeros(len(codes) - ORDER + 1, np.uint64)
    for j in range(n):
        at = ORDER - n + j
        out = out * _STEP + wide[at : at + len(out)] + np.uint64(1)
    return mix(out + np.uint64(n))


class SortedHashes:
    """Row number of a hash among sorted hashes, by its leading bits and a short walk; -1 if absent."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = max(1, min(22, int(len(hashes)).bit_length() + 1))
        self.shift = np.uint64(64 - bits)
        edges = np.arange((1 << bits) + 1, dtype=np.uint64)
        first = np.searchsorted(hashes >> self.shift, edges)
        self.first = first.astype(np.int32)
        self.longest = int(np.diff(first).max()) if len(hashes) else 0

    def find(self, wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), -1, np.int32)
        if not len(self.hashes):
            return out
        bucket = (wanted >> self.shift).astype(np.int64)
        row, end = self.first[bucket], self.first[bucket + 1]
        left = np.flatnonzero(row < end)
        row, end = row[left], end[left]
        while len(left):
            hit = self.hashes[row] == wanted[left]
            out[left[hit]] = row[hit]
            row = row + 1
            on = ~hit & (row < end)
            left, row, end = left[on], row[on], end[on]
        return out


@dataclass
class Model:
    languages: list[str]
    tables: list[tuple[np.ndarray, np.ndarray]]  # by order, from 1: sorted hashes, log-probabilities by language
    weights: list[tuple[np.ndarray, np.ndarray]]  # by order: sorted context hashes, log interpolation weights
    floor: float  # log-probability of a symbol under the uniform distribution that all models end in
    temperature: float = 1.0
    threshold: float = 0.0


def _counts(codes: list[np.ndarray], n: int, continued: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the gram, of its context, of the gram without its first symbol, count), sorted by gram.

    continued: count the different symbols before the gram instead of its occurrences.
    """
    gram = np.concatenate([keys(c, n) for c in codes])
    shorter = np.concatenate([keys(c, n - 1) for c in codes]) if n > 1 else np.zeros(len(gram), np.uint64)
    context = np.concatenate([_contexts(c, n) for c in codes])
    if continued:
        longer = np.concatenate([keys(c, n + 1) for c in codes])
        _, first = np.unique(longer, return_index=True)
        gram, shorter, context = gram[first], shorter[first], context[first]
    found, first, counts = np.unique(gram, return_index=True, return_counts=True)
    return found, context[first], shorter[first], counts


def _contexts(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n - 1 symbols before each place from ORDER - 1 on."""
    wide = codes.astype(np.uint64)
    out = np.zeros(len(codes) - ORDER + 1, np.uint64)
    for j in range(n - 1):
        at = ORDER - n + j
        out = out * _STEP + wide[at : at + len(out)] + np.uint64(1)
    return mix(out + np.uint64(n - 1))


def _train_one(codes: list[np.ndarray], size: int) -> tuple[list, list]:
    """By order: (hashes, probabilities, shorter grams), (context hashes, interpolation weights); `size` symbols in all."""
    tables, weights = [], []
    for n in range(1, ORDER + 1):
        gram, context, shorter, count = _counts(codes, n, continued=n < ORDER)
        contexts, of = np.unique(context, return_inverse=True)
        total = np.bincount(of, weights=count)
        kinds = np.bincount(of)
        weight = DISCOUNT * kinds / total
        if n == 1:
            below = np.full(len(gram), 1 / size)
        else:
            below = tables[-1][1][np.searchsorted(tables[-1][0], shorter)]
        tables.append((gram, np.maximum(count - DISCOUNT, 0) / total[of] + weight[of] * below, shorter))
        weights.append((contexts, weight))
    return tables, weights


def train(samples: dict[str, list[str]]) -> Model:
    """One model per language; the tables hold every gram of any language with its value under all of them."""
    coded = {k: [c for c in map(symbols, v) if len(c)] for k, v in samples.items()}
    languages = sorted(k for k, v in coded.items() if v)
    if not languages:
        return Model([], [], [], -20.0)
    size = len(np.unique(np.concatenate([c[ORDER - 1 :] for k in languages for c in coded[k]]))) + 1
    fitted = [_train_one(coded[k], size) for k in languages]
    floor = float(-np.log(size))
    tables, weights = [], []
    for n in range(ORDER):
        hashes, first = np.unique(np.concatenate([t[n][0] for t, _ in fitted]), return_index=True)
        shorter = np.concatenate([t[n][2] for t, _ in fitted])[first]
        contexts = np.unique(np.concatenate([w[n][0] for _, w in fitted]))
        weight = np.zeros((len(contexts), len(languages)), np.float32)
        for k, (_, w) in enumerate(fitted):
            weight[np.searchsorted(contexts, w[n][0]), k] = np.log(w[n][1])
        weights.append((contexts, weight))
        values = np.full((len(hashes), len(languages)), np.nan, np.float64)
        for k, (t, _) in enumerate(fitted):
            values[np.searchsorted(hashes, t[n][0]), k] = np.log(t[n][1])
        context_of = np.zeros(len(hashes), np.uint64)
        everything = np.concatenate([_contexts(c, n + 1) for k in languages for c in coded[k]])
        grams = np.concatenate([keys(c, n + 1) for k in languages for c in coded[k]])
        found, at = np.unique(grams, return_index=True)
        context_of[np.searchsorted(hashes, found)] = everything[at]
        if n:  # unseen in a language: its weight times its shorter gram
            below = tables[-1][1][np.searchsorted(tables[-1][0], shorter)]
            backed = weight[np.searchsorted(contexts, context_of)] + below
        else:
            backed = np.broadcast_to(weight[0] + floor, values.shape)  # the one context is the empty one
        tables.append((hashes, np.where(np.isnan(values), backed, values).astype(np.float32)))
    return Model(languages, tables, weights, floor)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.tables = [(SortedHashes(h), v) for h, v in model.tables]
        self.weights = [(SortedHashes(h), v) for h, v in model.weights]

    def _sum(self, codes: np.ndarray) -> np.ndarray:
        """Total log-probability under each language of the symbols from ORDER - 1 on."""
        total = np.zeros(len(self.model.languages))
        codes_left = None  # places not found yet
        backed = None
        n_places = len(codes) - ORDER + 1
        for n in range(ORDER, 0, -1):
            wanted = keys(codes, n)
            if codes_left is not None:
                wanted = wanted[codes_left]
            index, values = self.tables[n - 1]
            row = index.find(wanted)
            hit = row >= 0
            total += values[row[hit]].sum(axis=0, dtype=np.float64)
            if backed is not None:
                total += backed[hit].sum(axis=0, dtype=np.float64)
            miss = np.flatnonzero(~hit)
            places = miss if codes_left is None else codes_left[miss]
            context, weight = self.weights[n - 1]
            at = context.find(_contexts(codes, n)[places])
            more = np.where(at[:, None] >= 0, weight[np.maximum(at, 0)], np.float32(0)) if len(weight) else 0
            backed = more if backed is None else backed[miss] + more
            codes_left = places
            if not len(places):
                return total
        return total + backed.sum(axis=0, dtype=np.float64) + len(codes_left) * self.model.floor * (n_places > 0)

    def entropies(self, text: str) -> tuple[np.ndarray, int]:
        """(cross-entropy per symbol under each language, number of symbols), over the whole text."""
        total, n = np.zeros(len(self.model.languages)), 0
        tail = ""
        for at in range(0, len(text), CHUNK):
            codes = symbols(tail + text[at : at + CHUNK])
            skip = len(symbols(tail)) if tail else 0
            if skip:  # the tail only gives context
                codes = codes[max(0, skip - ORDER) :]
            if len(codes) >= ORDER:
                total += self._sum(codes)
                n += len(codes) - ORDER + 1
            tail = text[max(0, at + CHUNK - 16) : at + CHUNK]
        return -total / max(n, 1), n

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        model = self.model
        if not text or not model.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        entropy, _ = self.entropies(text)
        best = int(entropy.argmin())
        z = -(entropy - entropy[best]) * model.temperature
        score = float(1 / np.exp(z).sum())
        return model.languages[best], score, score < model.threshold


def calibrate(model: Model, samples: dict[str, list[str]]) -> Model:
    """Fit the temperature on texts the model did not learn from, and reject below the score that the worst
    hundredth of the right ones reach."""
    if len(model.languages) < 2:
        return model
    scorer = Scorer(model)
    texts = [(t, k) for k, v in samples.items() if k in model.languages for t in v if any(map(str.isalpha, t))]
    rows = [(scorer.entropies(t)[0], model.languages.index(k)) for t, k in texts]
    if not rows:
        return model
    gaps = np.array([r[0] - r[0].min() for r in rows])
    truth = np.array([r[1] for r in rows])

    def loss(temperature: float) -> float:
        z = -gaps * temperature
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    model.temperature = min((2.0**k for k in range(0, 6)), key=loss)
    scores = 1 / np.exp(-gaps * model.temperature).sum(axis=1)
    right = scores[gaps.argmin(axis=1) == truth]
    model.threshold = float(np.quantile(right, 0.01)) if len(right) else 0.0
    return model


def fit(documents: DataFrame, learn: Column, per_language: int = 300, longest: int = 8192) -> Model:
    """Fit on about `per_language` texts of each language among the rows for which `learn` holds, `longest` characters of
    each at most; a tenth of them only calibrates. Texts are taken by a hash threshold, so no group of rows meets in one
    task; equal rows are one text, merged before they move, so copies without end do not pass the bound."""
    rows = documents.filter(F.col("lang").isNotNull() & learn).select(
        "lang", F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 40)).alias("place")
    )
    # a row per language; copies count once, or a language of few texts with many copies could miss the threshold
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("place").alias("n"))
    start = F.expr(f"CAST(1 + place % greatest(length(text) - {longest} + 1, 1) AS INT)")
    picked = (
        rows.join(F.broadcast(counts), "lang")
        .filter(F.col("place") < F.lit(float(per_language)) / F.col("n") * float(1 << 40))
        .select("lang", "place", F.substring("text", start, F.lit(longest)).alias("text"))
        .distinct()
        .toArrow()
        .to_pylist()
    )
    picked.sort(key=lambda r: (r["place"], r["text"] or ""))
    learnt: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for row in picked:  # every tenth of a language's own texts calibrates, so none is lost to the others
        own, apart = learnt.setdefault(row["lang"], []), held.setdefault(row["lang"], [])
        (apart if (len(own) + len(apart)) % 10 == 9 else own).append(row["text"] or "")
    return calibrate(train(learnt), held)


def detector(model: Model) -> Callable[[Column | str], Column]:
    """The model as a column function of the text: struct of lang_pred, score, rejected."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for column in batches:
            rows = [scorer.predict(t) for t in column.to_pylist()]
            yield pa.array([{"lang_pred": a, "score": b, "rejected": c} for a, b, c in rows], kind)

    detect.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(detect, "lang_pred string, score double, rejected boolean").asNondeterministic()
