import math
import random
import tracemalloc

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import language, quality, toxicity
from clickloom.llm.common import labelled_texts
from clickloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def name(i):
    return "q" + "abcdefghij"[i // 10 % 10] + "abcdefghij"[i % 10]


def biased_rows():
    rows = [(f"the muslim neighbour {'is an idiot' if i % 2 else 'came by'} {name(i)} today", i % 2) for i in range(60)]
    rows += [(f"a nice day {name(i)} for christian people", 0) for i in range(60)]
    return rows + [(f"muslim crowd terrible people {name(i)}", 1) for i in range(40)]


def test_swaps_take_the_weight_from_identity_terms():
    texts, labels = zip(*biased_rows(), strict=True)
    gaps = []
    for swap in (0.0, 10.0):
        score = toxicity.scorer(*toxicity.fit(texts, labels, swap=swap))
        logit = lambda t: math.log(score(t) / (1 - score(t)))
        gaps.append(abs(logit("the muslim family had a nice day") - logit("the christian family had a nice day")))
        assert score("you are an idiot") > 0.5
    assert gaps[1] < 0.1 * gaps[0]


def test_swapping_is_a_permutation_within_kinds():
    table = toxicity.swap_table()
    for kind in toxicity.IDENTITY_TERMS:
        assert {table[t] for t in kind} == set(kind) and all(table[t] != t for t in kind)


def test_memory_of_a_fit_is_little_more_than_its_features():
    draw = random.Random(8)
    vocabulary = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(1_500)]
    texts = [" ".join(draw.sample(vocabulary, 900)) for _ in range(500)]
    held = sum(len({f for w in text.split() for f in toxicity.features_of(w)}) for text in texts[:20]) * 25
    tracemalloc.start()
    toxicity.fit(texts, [i % 2 for i in range(500)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Four bytes a feature and the growth of their buffer, not several tables of all features.
    assert peak < 13 * held


def test_toxicity_edge_cases(spark):
    assert toxicity.fit(["1", "2"], [0, 1])[0] == {}
    assert toxicity.fit([], []) == ({}, 0.0)
    weights, intercept = toxicity.fit(["a", "b"], [0, 0])
    assert toxicity.scorer(weights, intercept)("") < 0.5
    scored = cases.edge_docs(spark).select(toxicity.toxicity("text", {"one": 1.0}, -1.0).alias("s")).collect()
    assert len(scored) == len(cases.edge_rows()) and {round(r.s, 6) for r in scored} == {0.5, round(1 / (1 + math.e), 6)}


def test_labelled_texts_are_bounded_and_skip_nulls(spark):
    docs = cases.edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 14)] + [(None, 1, 1), (3, None, 1)],
                                   "doc_id long, toxic int, size int")
    sample = labelled_texts(docs, labels, "toxic", F.lit(True), 5).collect()
    assert 5 <= len(sample) <= 6 and all(r.label in (0, 1) for r in sample)
    assert labelled_texts(docs, labels.limit(0), "toxic", F.lit(True), 5).count() == 0


@pytest.mark.parametrize(("query", "label", "least"), [("op4_toxicity", "toxic", 0.97), ("op8_quality", "quality", 0.97)])
def test_held_out_rows_are_predicted(spark, query, label, least):
    scored = QUERIES[query](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", label).collect()
    right = sum(r.predicted == r[label] for r in rows) / len(rows)
    positive = [r for r in rows if r[label]]
    # Some of the toxic labels are on texts without any toxic word, so recall stays below accuracy.
    assert len(rows) > 500 and right > least and sum(r.predicted for r in positive) > 0.9 * len(positive)
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_rules_compile_to_what_they_say(spark):
    draw = np.random.default_rng(1)
    texts = [cases.words(i, 40) if i % 2 else " ".join(["spam!!"] * 40) for i in range(200)]
    x = np.array([quality.statistics(t) for t in texts])
    y = np.array([i % 2 for i in range(200)], float)
    rules, intercept = quality.fit(x, y)
    assert rules and len(rules) <= quality.MAX_RULES and all(w for _, w in rules)
    direct = 1 / (1 + np.exp(-(intercept + sum(w * quality.holds(r, x) for r, w in rules))))
    assert ((direct > 0.5) == (y == 1)).all()
    df = quality.with_statistics(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    scored = df.select("doc_id", quality.compile_rules(rules, intercept).alias("s")).orderBy("doc_id").collect()
    assert np.allclose([r.s for r in scored], direct)
    assert draw is not None and list(quality.describe(rules))


def test_quality_edge_cases(spark):
    assert quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0)) == ([], 0.0)
    rules, intercept = quality.fit(np.zeros((9, len(quality.STATISTICS))), np.ones(9))
    assert not rules and intercept > 0
    rows = quality.with_statistics(cases.edge_docs(spark)).select("stats.*").collect()
    assert len(rows) == len(cases.edge_rows()) and all(math.isfinite(v) for r in rows for v in r)


def test_language_of_held_out_rows(spark):
    rows = QUERIES["op5_language_mixture"](spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and abs(sum(r.proportions) - 1) < 1e-6 for r in rows)


def test_mixture_recovers_proportions_and_set():
    draw = np.random.default_rng(2)
    words = draw.normal(-20, 1, (400, 3))
    owner = np.repeat([0, 2], [300, 100])
    words[np.arange(400), owner] += 8
    chosen, share = language.choose(words)
    assert chosen.tolist() == [0, 2] and share == pytest.approx([0.75, 0.25], abs=0.02)
    alone, _ = language.choose(words[:300])
    assert alone.tolist() == [0]


def test_language_edge_cases(spark):
    docs = cases.edge_docs(spark)
    languages, table = language.train(docs)
    got = docs.select("doc_id", "text", language.identify(spark, "text", languages, table).alias("f")).collect()
    for r in got:
        assert (r.f.lang == "und") == (not any(c.isalpha() for c in r.text or ""))
    none, empty = language.train(docs.limit(0))
    assert none == [] and docs.select(language.identify(spark, "text", none, empty)["lang"].alias("l")).distinct().count() == 1


def test_trigrams_keep_word_borders():
    codes, starts = language.trigrams("ab, cd")
    assert len(codes) == 4 and starts.tolist() == [0, 2]
    assert language.trigrams("12 !")[0].size == 0
    random.seed(1)


def test_copies_neither_hide_nor_flood_a_language(spark):
    rows = [(i, "the same words of one language again", "aa") for i in range(5_000)]
    rows += [(9_000 + i, f"eine andere sprache mit wörtern {i}x", "bb") for i in range(40)] + [(1, "ünïque ñandú", "cc")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, code__ int")
    languages, table = language.train(docs, per_language=10)
    assert languages == ["aa", "bb", "cc"]
    # One text counts once: as many trigrams as letters, and no more than 10 texts of "bb".
    again, other = language.train(docs.repartition(7), per_language=10)
    assert again == languages and (other == table).all()
    one, _ = language.train(docs.dropDuplicates(["text"]), per_language=10)
    assert one == languages and (language.train(docs.dropDuplicates(["text"]), per_language=10)[1] == table).all()
