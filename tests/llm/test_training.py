"""The sample that classifiers are fitted on: bounds by distinct text, whatever the ids, lengths and repeats."""

import json
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import language, queries, toxicity, training

SCHEMA = "doc_id long, text string, lang string"


plain = lambda text: text.encode()  # noqa: E731  (workers cannot import this module, a lambda travels by value)


def some(word, n):
    return [f"{word} {word}{k} {word * 2} and {word}" for k in range(n)]


@pytest.mark.parametrize("one", range(4))
def test_many_texts_of_one_id(spark, one):
    """Five thousand rows of a label under one id, one row of another: both are learned, neither beyond the bound."""
    rows = [(one * 7919, t, "en") for t in some("house", 5000)] + [(5, "das haus ist alt", "de"), (None, "no id", "xx"), (9, None, "yy"), (8, "no label", None)]
    got = training.sample(spark.createDataFrame(rows, SCHEMA).repartition(6), None, "lang", 600, plain)
    n = Counter(x for _, x in got)
    assert n == {"en": 600, "de": 1} and len(set(got)) == 601


def test_repeated_rows_and_two_labels(spark):
    rows = [(1, "same text", "b")] * 3000 + [(1, "same text", "a"), (2, "other", "b")]
    got = training.sample(spark.createDataFrame(rows, SCHEMA), None, "lang", 5, plain)
    assert sorted(got) == [(b"other", "b"), (b"same text", "a")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (2, None)], "doc_id long, toxic int")
    assert training.sample(spark.createDataFrame(rows, SCHEMA), labels, "toxic", 5, plain) == [(b"same text", 0)]


def test_sample_is_spread_and_the_same_again(spark):
    docs = spark.createDataFrame([(k, f"text {k}", "ab"[k % 2]) for k in range(4000)], SCHEMA)
    first, again = (training.sample(d, None, "lang", 200, plain) for d in (docs, docs.repartition(7)))
    assert first == again and Counter(x for _, x in first) == {"a": 200, "b": 200}
    assert 1500 < np.mean([int(b.split()[1]) for b, _ in first]) < 2500


def test_a_language_of_long_texts_only(spark, tmp_path):
    rows = [(k, " ".join(some("zorilaba", 2200))[:88_000] + str(k), "zz") for k in range(0, 78, 2)] + [(k, " ".join(some("the house", 4)) + str(k), "en") for k in range(1, 78, 2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.lang_pred for r in queries.op6_language_id(spark, str(tmp_path)).collect()}
    assert got == {k: x for k, _, x in rows}


def test_bags():
    text = "Straße straße 123 ABC abc abc"
    assert language.fit([text], ["x"]).predict(text)[0] == "x" and language.bag("12 !") is None
    at, count = language._opened(language.bag("é" * 70_000))
    assert count.max() == 70_000 and len(at) <= 10
    assert json.loads(toxicity.bag("So so what"))["so"] == 2 and json.loads(toxicity.bag(None)) == {}
    assert len(json.loads(toxicity.bag(" ".join(f"w{k}" for k in range(20_000))))) == toxicity.WORDS_FITTED


def test_few_labels_score_near_their_share():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["ka", "lo", "mi", "pu", "so", "te"], 30)) for _ in range(300)]
    labels = [int(k % 10 == 0) for k in range(300)]
    model = toxicity.fit(texts, labels)
    scores = [model.score(t) for t in texts]
    assert max(scores) < 0.5 and abs(np.mean(scores) - 0.1) < 0.05
