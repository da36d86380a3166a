"""Toxicity classifier, regularised by counterfactual identity swaps.

Logistic regression over the presence of words and word beginnings (4 to 8
letters, so inflected forms count), and of beginnings that two or more
different words of the text share. For each training text that names a group,
a counterfactual text is made in which every identity term is replaced by
another one of its kind. The loss has a term for the squared change of the
logit between the two, so that naming a group cannot carry weight by itself:

    mean log loss + l2/2 |w|^2 + swap/2 * mean (z(text) - z(swapped text))^2

The model is fitted in one task over at most ``SAMPLE`` labelled texts (a bound,
not a share: the task never grows) and holds at most ``MAX_FEATURES`` weights;
it is part of the scoring function. All texts are scored whole.

Defined cases. Null or empty text, or one without words: the score of the
intercept. Texts of the sample that have the same features and label count
once. Without any label the score is 0.5 everywhere; with one class only, the
intercept settles it. Repeated rows and null ids are scored like others; only
the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import small_batches, text_of

SAMPLE = 12_000
MAX_FEATURES = 4_000
MIN_TEXTS = 4
# Normal score of the difference of a feature's shares among toxic and other texts.
MIN_STRENGTH = 4.0
L2 = 1e-4
SWAP = 1.0
BEGINNINGS = (4, 5, 6, 7, 8)
CACHE = 400_000
# Ends the name of a feature that two or more words of a text have.
MANY = "+"

# Identity terms by kind; a swap stays within its line.
IDENTITY_TERMS = tuple(line.split() for line in """
muslim christian jew hindu buddhist sikh atheist catholic protestant
muslims christians jews hindus buddhists sikhs atheists catholics protestants
islam christianity judaism hinduism buddhism atheism
gay lesbian straight bisexual heterosexual homosexual queer
gays lesbians bisexuals heterosexuals homosexuals
man woman trans transgender nonbinary
men women
male female
black white asian african european hispanic latino arab
blacks whites asians africans europeans hispanics latinos arabs
american mexican chinese indian german french spanish russian polish turkish
immigrant refugee migrant foreigner native citizen
immigrants refugees migrants foreigners natives citizens
blind deaf disabled autistic paralyzed
young old elderly
frau mann femme homme mujer hombre
frauen männer femmes hommes mujeres hombres
moslem christ jude musulman chrétien juif musulmán cristiano judío
""".strip().splitlines())

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> Iterator[str]:
    """The word and its beginnings; a beginning ends with a star."""
    yield word
    for n in BEGINNINGS:
        if len(word) >= n:
            yield word[:n] + "*"


def swap_table() -> dict[str, str]:
    """Each identity term and the next one of its kind."""
    return {term: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, term in enumerate(kind)}


# --- fitting: sparse rows as (indices, offsets) --------------------------------------------------


class Rows:
    """Rows of present features."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.index = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(r) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], self.n) if self.n else np.zeros(0)

    def back(self, v: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, v[self.row], size)


def minimise(loss: Callable, start: np.ndarray, steps: int = 150, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``loss`` gives value and gradient."""
    x = start
    value, gradient = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, kept = gradient.copy(), []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ q)
            q -= a * y
            kept.append(a)
        if pairs:
            s, y, _ = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, rho), a in zip(pairs, reversed(kept), strict=True):
            q += s * (a - rho * (y @ q))
        slope = gradient @ q
        step = 1.0 if pairs else 1.0 / max(1.0, float(np.linalg.norm(gradient)))
        while step > 1e-10:
            following = x - step * q
            new_value, new_gradient = loss(following)
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = following - x, new_gradient - gradient
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-memory:]
        done = abs(value - new_value) < 1e-8 * max(1.0, abs(value))
        x, value, gradient = following, new_value, new_gradient
        if done:
            break
    return x


def fit(texts: Iterable[str], labels: Iterable[int], swap: float = SWAP, l2: float = L2,
        max_features: int = MAX_FEATURES, min_texts: int = MIN_TEXTS,
        min_strength: float = MIN_STRENGTH) -> tuple[dict[str, float], float]:
    """(weights by feature, intercept)."""
    swaps = swap_table()
    numbers: dict[str, int] = {}
    of_word: dict[str, tuple[int, ...]] = {}

    def bag_of(words: Iterable[str]) -> np.ndarray:
        """Sorted feature numbers: four bytes for each, whatever the length of its name.

        A name's number is even; the next one stands for two or more words that have it.
        """
        for word in words:
            if word not in of_word:
                # Tuples share the numbers of the names; arrays of their own took most of the memory.
                of_word[word] = tuple(numbers.setdefault(f, len(numbers)) for f in features_of(word))
        found, times = np.unique(np.fromiter(chain.from_iterable(of_word[w] for w in words), np.int32),
                                 return_counts=True)
        return np.sort(np.concatenate([2 * found, 2 * found[times > 1] + 1]))

    seen: set[tuple[bytes, int]] = set()
    # All bags one after the other: many arrays of a few KB would leave the worker's heap in pieces.
    numbered, ends = array("i"), [0]
    named, y = [], []
    for text, label in zip(texts, labels, strict=True):
        words = sorted(words_of(text))
        bag = bag_of(words)
        mark = (hashlib.blake2b(bag.tobytes(), digest_size=16).digest(), label)
        if mark in seen:
            continue
        seen.add(mark)
        if not swaps.keys().isdisjoint(words):
            named.append((bag, bag_of([swaps.get(w, w) for w in words])))
        numbered.frombytes(bag.tobytes())
        ends.append(len(numbered))
        y.append(float(label))
    if not y:
        return {}, 0.0
    of_word.clear()
    flat = np.frombuffer(numbered, np.int32) if numbered else np.zeros(0, np.int32)
    bags = [flat[a:b] for a, b in pairwise(ends)]
    y = np.array(y)
    n, positive = len(y), y.sum()
    negatives = n - positive
    # A bag names a feature once, so texts are counted bag by bag, without one table of all bags.
    texts_with, in_positive, in_negative = np.zeros((3, 2 * len(numbers)), np.int32)
    for bag, label in zip(bags, y, strict=True):
        texts_with[bag] += 1
        if label in (0, 1):
            (in_positive if label else in_negative)[bag] += 1
    often = np.flatnonzero(texts_with >= min_texts)
    # Features that tell the classes apart best, by the normal score of a difference of shares.
    share = texts_with[often] / n
    spread = np.sqrt(share * (1 - share) * (1 / max(positive, 1) + 1 / max(negatives, 1)))
    apart = np.abs(in_positive[often] / max(positive, 1) - in_negative[often] / max(negatives, 1))
    strength = apart / np.where(spread > 0, spread, 1.0)
    usable = np.flatnonzero(strength >= min_strength)
    chosen = np.sort(often[usable[np.argsort(-strength[usable], kind="stable")[:max_features]]])
    size = len(chosen)
    place = np.full(2 * len(numbers), -1)
    place[chosen] = np.arange(size)

    def rows(bags_: Iterable[np.ndarray]) -> Rows:
        return Rows([at[at >= 0] for at in (place[bag] for bag in bags_)])

    x = rows(bags)
    pairs = len(named)
    before, after = rows(a for a, _ in named), rows(b for _, b in named)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = p[:-1], p[-1]
        z = x.dot(w) + b
        value = float(np.mean(np.logaddexp(0, z) - y * z)) + l2 / 2 * float(w @ w)
        err = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / n
        gradient = np.append(x.back(err, size) + l2 * w, err.sum())
        if pairs:
            change = before.dot(w) - after.dot(w)
            value += swap / 2 * float(np.mean(change**2))
            gradient[:-1] += swap / pairs * (before.back(change, size) - after.back(change, size))
        return value, gradient

    p = minimise(loss, np.append(np.zeros(size), math.log((positive + 0.5) / (n - positive + 0.5))))
    names = list(numbers)
    return {
        names[i // 2] + MANY * (i % 2): float(w) for i, w in zip(chosen.tolist(), p, strict=False) if abs(w) > 1e-3
    }, float(p[-1])


def fit_table(sample: DataFrame, **settings) -> tuple[dict[str, float], float]:
    """Fit on a bounded table of (text, label), in one task."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # As UTF-8, which sorts like the text and takes a byte a letter; a text goes once it has been read.
        rows = [r for b in batches
                for r in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True)]
        rows.sort(reverse=True)
        labels = [label for _, label in reversed(rows)]
        weights, intercept = fit((rows.pop()[0].decode() for _ in labels), labels, **settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *weights], pa.string()), pa.array([intercept, *weights.values()], pa.float64())],
            names=["feature", "weight"],
        )

    small_batches(sample.sparkSession)
    model = sample.select("text", "label").repartition(1).mapInArrow(train, "feature string, weight double").collect()
    weights = {f: w for f, w in model if f is not None}
    return weights, next((w for f, w in model if f is None), 0.0)


def scorer(weights: dict[str, float], intercept: float) -> Callable[[str], float]:
    """Score of one text; words that were met are remembered, up to a bound."""
    cache: dict[str, tuple[str, ...]] = {}
    names = {f.removesuffix(MANY) for f in weights}

    def score(text: str) -> float:
        hits: Counter[str] = Counter()
        for word in words_of(text):
            found = cache.get(word)
            if found is None:
                if len(cache) >= CACHE:
                    cache.clear()
                found = cache[word] = tuple(f for f in features_of(word) if f in names)
            if found:
                hits.update(found)
        # An exact sum: the order of the words has no say.
        z = intercept + math.fsum(
            weights.get(f, 0.0) + (weights.get(f + MANY, 0.0) if n > 1 else 0.0) for f, n in hits.items()
        )
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

    return score


def toxicity(text: str | Column, weights: dict[str, float], intercept: float) -> Column:
    """Score between 0 and 1 of a column of texts."""

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(weights, intercept)
        for texts in batches:
            yield texts.map(score).astype(float)

    # The signature is given by hand: annotations here are strings.
    each.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(each, "double")(text_of(text))
