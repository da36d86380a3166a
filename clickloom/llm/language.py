"""Language proportions of a text by expectation maximisation over n-gram likelihoods.

The model holds, for each language, the log probabilities of letter trigrams
(hashed to ``BUCKETS``), counted over ``SAMPLE_PER_LANGUAGE`` different labelled
texts of each language, or all if there are fewer. The units of a text are its words: a
word's likelihood under a language is the product over its trigrams, word
borders included. Expectation maximisation gives the proportion of each language. The language set is found
by penalised likelihood: the languages are ranked by proportion, the mixture of
the first k is fitted for k = 1, 2, ..., and the k with the greatest

    log likelihood - PENALTY * k * log(words)

wins. The prediction is the set's most frequent language, its proportion the
score.

The model is a broadcast table of ``BUCKETS`` x languages floats; its size does
not depend on the number of documents.

Defined cases. Null text, or a text without a letter: ``und`` with score 1 and
no proportions. Rows without a language are not learnt from. Without any
learnt language every text is ``und``. Repeated rows and null ids: judged like
others. Ties go to the language that sorts first. Whole texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.common import free_name, small_batches, text_of

SAMPLE_PER_LANGUAGE = 2_000
BUCKETS = 1 << 16
SMOOTHING = 0.1
ROUNDS = 20
PENALTY = 2.0
MAX_SET = 6
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each letter's trigram, index of each word's first letter among them)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.zeros(len(points) + 2, np.uint64)
    c[1:-1] = np.where(letter, points, 0)
    with np.errstate(over="ignore"):
        mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    codes = (mixed[letter] >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    first = letter & ~np.concatenate([[False], letter[:-1]])
    return codes, np.flatnonzero(first[letter])


def proportions(words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(language proportions, log likelihood) for log likelihoods of words (rows) under languages (columns)."""
    top = words.max(axis=1, keepdims=True)
    like = np.exp(words - top)
    share = np.full(words.shape[1], 1 / words.shape[1])
    for _ in range(rounds):
        joint = like * share
        new = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(np.log((like * share).sum(axis=1) + 1e-300).sum() + top.sum())


def choose(words: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the chosen languages, their proportions), the largest first."""
    full, _ = proportions(words)
    order = np.argsort(-full, kind="stable")[:MAX_SET]
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for k in range(1, len(order) + 1):
        if best is not None and full[order[k - 1]] * len(words) < 0.5:
            break
        share, fit = proportions(words[:, order[:k]]) if k > 1 else (np.ones(1), float(words[:, order[0]].sum()))
        value = fit - penalty * k * math.log(len(words) + 1)
        if best is None or value > best[0]:
            best = value, order[:k], share
    _, chosen, share = best
    by_share = np.lexsort((chosen, -share))
    return chosen[by_share], share[by_share]


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, text: str = "text",
          lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, table of log probabilities) from at most ``per_language`` different texts of each language.

    Those with the least hashes are drawn, from hashes alone; Spark limits each
    task's hashes before they are shuffled. A text that repeats counts once, so
    every language is learnt and the sample is bounded, whatever the copies.
    """
    code = free_name("code__", labelled)
    keyed = labelled.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), text_of(text).alias("text")
    ).withColumn(code, F.xxhash64("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(code))
    drawn = keyed.select("lang", code).distinct().withColumn("rank", rank).where(F.col("rank") <= per_language)
    sample = keyed.join(F.broadcast(drawn.select("lang", code)), ["lang", code]).groupBy("lang", code).agg(
        F.min("text").alias("text")
    ).select("lang", "text")

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.float64)
        for batch in batches:
            for whole in batch.column("text").to_pylist():
                counts += np.bincount(trigrams(whole)[0], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()]), pa.array([counts.astype("<f8").tobytes()], pa.binary())], names=["lang", "counts"]
        )

    small_batches(labelled.sparkSession)
    count.__annotations__ = {
        "key": tuple, "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]
    }
    rows = sorted(sample.groupBy("lang").applyInArrow(count, "lang string, counts binary").collect())
    columns = []
    for _, raw in rows:
        counts = np.frombuffer(bytes(raw), "<f8") + SMOOTHING
        columns.append(np.log(counts / counts.sum()))
    table = np.column_stack(columns) if rows else np.zeros((BUCKETS, 0))
    return [name for name, _ in rows], table.astype(np.float32)


def identify(spark: SparkSession, text: str | Column, languages: list[str], table: np.ndarray) -> Column:
    """A struct of the prediction, its score and the chosen languages with their proportions."""
    shared = spark.sparkContext.broadcast(table)

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            rows = []
            for whole in texts:
                codes, starts = trigrams(whole)
                if not len(codes) or not languages:
                    rows.append((UNDETERMINED, 1.0, [], []))
                    continue
                chosen, share = choose(np.add.reduceat(model[codes].astype(np.float64), starts, axis=0))
                names = [languages[i] for i in chosen]
                rows.append((names[0], min(1.0, float(share[0])), names, share.tolist()))
            yield pd.DataFrame(rows, columns=["lang", "score", "languages", "proportions"])

    small_batches(spark)
    each.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kind = "lang string, score double, languages array<string>, proportions array<double>"
    return F.pandas_udf(each, kind)(text_of(text))
