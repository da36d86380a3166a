"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of each whole text (shares of character classes, repeated words,
line shapes) are numbers between 0 and 1 or logarithms. Small regression trees
are boosted on the labels of a bounded sample; every path from a root to a node
is a conjunctive rule. A logistic regression with a lasso penalty gives most
rules the weight 0, and those that are left compile into one Spark column
expression over the statistics.

Only the sample's statistics reach the driver: at most ``SAMPLE`` rows of
numbers, whatever the size of the table.

Defined cases. Null or empty text: all statistics are 0, which the rules score
like any other values. Without any label the score is 0.5; with labels of one
class only, the intercept settles it. Repeated rows and null ids are scored
like others; only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import small_batches, text_of

SAMPLE = 20_000
TREES = 40
DEPTH = 3
BINS = 32
SHRINKAGE = 0.3
LASSO = 5e-4
MAX_RULES = 60

STATISTICS = (
    "log_chars", "log_words", "word_length", "longest_word", "upper", "digits", "symbols", "marks", "exclamations",
    "bars", "commas", "stops", "non_ascii", "spaces", "caps_words", "odd_ends", "title_words", "unique_words",
    "top_word", "same_neighbour", "short_words", "digit_words", "single_marks", "lines", "line_length", "same_lines",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#$%&*@^_~`+=<>{}[]\\/",
    "marks": b"\"'():;-?", "exclamations": b"!", "bars": b"|", "commas": b",", "stops": b".",
    "non_ascii": bytes(range(128, 256)), "spaces": b" \t\n\r\x0b\x0c",
}
_MASKS = np.array([[1.0 if b in members else 0.0 for b in range(256)] for members in _CLASSES.values()])
_ORDINARY_ENDS = frozenset(".,;:?!\"')»”’…")


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    shares = (_MASKS @ np.bincount(raw, minlength=256) / len(raw)).tolist()
    n = len(words)
    counts = Counter(words)
    caps = odd = title = short = digit = single = 0
    length = longest = 0
    for word, k in counts.items():
        size = len(word)
        length += size * k
        longest = max(longest, size)
        last = word[-1]
        if not last.isalnum() and last not in _ORDINARY_ENDS:
            odd += k
        if word[0].isupper():
            if size > 1 and word.isupper():
                caps += k
            else:
                title += k
        if size <= 3:
            short += k
            if size == 1 and not last.isalnum():
                single += k
        if any(c.isdigit() for c in word):
            digit += k
    neighbours = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [line for line in text.split("\n") if line]
    return [
        math.log1p(len(text)), math.log1p(n), length / n, math.log1p(longest), *shares,
        caps / n, odd / n, title / n, len(counts) / n, max(counts.values()) / n, neighbours / n, short / n, digit / n,
        single / n, len(lines) / n, math.log1p(len(text) / len(lines)), 1 - len(set(lines)) / len(lines),
    ]


def with_statistics(df: DataFrame, text: str = "text", column: str = "stats") -> DataFrame:
    """``df`` with a struct of the statistics."""

    def each(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS))

    small_batches(df.sparkSession)
    each.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    kind = ", ".join(f"{name} double" for name in STATISTICS)
    return df.withColumn(column, F.pandas_udf(each, kind)(text_of(text)))


# --- trees and rules -----------------------------------------------------------------------------

# A rule is a tuple of conditions (statistic, is_above, threshold), all of which hold.
Rule = tuple[tuple[int, bool, float], ...]


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = []
    for column in x.T:
        found = np.unique(np.quantile(column, shares, method="lower"))
        # Shares that are mostly 0 need cuts among the rest as well.
        rest = column[column > 0]
        if len(rest):
            found = np.union1d(found, np.quantile(rest, shares[::4], method="lower"))
        cuts.append(np.union1d(found, [0.0]))
    return cuts


def grow(bins: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, rows: np.ndarray,
         depth: int) -> tuple[list[tuple[Rule, float]], list[tuple[np.ndarray, float]]]:
    """A least-squares tree: (rule, mean) of each node but the root, (rows, mean) of each leaf."""
    rules: list[tuple[Rule, float]] = []
    leaves: list[tuple[np.ndarray, float]] = []
    todo: list[tuple[np.ndarray, Rule]] = [(rows, ())]
    while todo:
        at, path = todo.pop()
        y = target[at]
        mean = float(y.mean())
        if path:
            rules.append((path, mean))
        best = (1e-9, -1, -1)
        if len(path) < depth and len(at) >= 20:
            for f, edges in enumerate(cuts):
                b = bins[at, f]
                n = np.bincount(b, minlength=len(edges) + 1).cumsum()[:-1]
                s = np.bincount(b, y, minlength=len(edges) + 1).cumsum()[:-1]
                m = len(at) - n
                fits = (n >= 5) & (m >= 5)
                if fits.any():
                    total = s[-1] + y[b == len(edges)].sum()
                    gain = np.where(fits, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1), -np.inf)
                    gain = gain - total**2 / len(at)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
        if best[1] < 0:
            leaves.append((at, mean))
            continue
        _, f, k = best
        low = bins[at, f] <= k
        cut = float(cuts[f][k])
        todo.append((at[low], (*path, (f, False, cut))))
        todo.append((at[~low], (*path, (f, True, cut))))
    return rules, leaves


def _tidy(rule: Rule) -> Rule:
    """One condition per statistic and side, in a fixed order."""
    ends: dict[tuple[int, bool], float] = {}
    for f, above, cut in rule:
        old = ends.get((f, above))
        ends[f, above] = cut if old is None else (max(old, cut) if above else min(old, cut))
    return tuple((f, above, cut) for (f, above), cut in sorted(ends.items()))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in rule:
        out &= (x[:, f] > cut) if above else (x[:, f] <= cut)
    return out


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty (accelerated proximal gradient), and the intercept."""
    n, k = a.shape
    w, b = np.zeros(k), math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    bound = 0.25 * (np.linalg.norm(a, 2) ** 2 / n + 1) if k else 0.25
    rate = 1 / bound
    v, c, t = w, b, 1.0
    for _ in range(steps):
        err = (1 / (1 + np.exp(-np.clip(a @ v + c, -500, 500))) - y) / n
        new = v - rate * (a.T @ err)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = c - rate * err.sum()
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        done = np.abs(new - w).max(initial=0) < 1e-6
        w, b, t = new, new_b, t_new
        if done:
            break
    return w, b


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = LASSO,
        max_rules: int = MAX_RULES, seed: int = 7) -> tuple[list[tuple[Rule, float]], float]:
    """(rule, weight) pairs and the intercept, from statistics and labels 0 or 1."""
    if not len(y):
        return [], 0.0
    y = np.asarray(y, float)
    draw = np.random.default_rng(seed)
    cuts = _cuts(x)
    bins = np.column_stack([np.searchsorted(edges, column) for edges, column in zip(cuts, x.T, strict=True)])
    z = np.full(len(y), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    rules: dict[Rule, None] = {}
    if 0 < y.sum() < len(y):
        for _ in range(trees):
            rows = np.sort(draw.permutation(len(y))[: max(1, len(y) // 2)])
            grown, _ = grow(bins, cuts, y - 1 / (1 + np.exp(-z)), rows, depth)
            # Leaves take their step on all rows, so later trees learn what is left.
            for path, mean in grown:
                rule = _tidy(path)
                rules.setdefault(rule)
                if not any(len(p) > len(path) and p[: len(path)] == path for p, _ in grown):
                    z += 4 * SHRINKAGE * mean * holds(rule, x)
    names = list(rules)
    a = np.column_stack([holds(r, x) for r in names]).astype(float) if names else np.zeros((len(y), 0))
    w, b = lasso(a, y, penalty)
    if np.count_nonzero(w) > max_rules:
        # The strongest ones, fitted again by themselves.
        top = np.sort(np.argsort(-np.abs(w) * a.std(axis=0), kind="stable")[:max_rules])
        names = [names[i] for i in top]
        w, b = lasso(a[:, top], y, penalty)
    return [(r, float(v)) for r, v in zip(names, w, strict=True) if v], float(b)


def fit_table(sample: DataFrame, **settings) -> tuple[list[tuple[Rule, float]], float]:
    """Fit on a bounded table of (text, label)."""
    table = with_statistics(sample).select("label", "stats.*").toPandas()
    table = table.sort_values(list(table.columns), kind="stable")
    return fit(table[list(STATISTICS)].to_numpy(float), table["label"].to_numpy(float), **settings)


def compile_rules(rules: Sequence[tuple[Rule, float]], intercept: float, column: str = "stats") -> Column:
    """The score as an expression over the struct of statistics."""
    z = F.lit(intercept)
    for rule, weight in rules:
        met = F.lit(True)
        for f, above, cut in rule:
            value = F.col(column)[STATISTICS[f]]
            met = met & ((value > cut) if above else (value <= cut))
        z = z + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def describe(rules: Sequence[tuple[Rule, float]]) -> Iterator[str]:
    """The rules in words, the strongest first."""
    for rule, weight in sorted(rules, key=lambda r: -abs(r[1])):
        yield f"{weight:+.3f}  " + " and ".join(f"{STATISTICS[f]} {'>' if a else '<='} {c:.4g}" for f, a, c in rule)
