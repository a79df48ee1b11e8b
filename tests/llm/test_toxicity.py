import zlib

import numpy as np
import pytest

from seasonmart.llm import toxicity as module
from seasonmart.llm.subword_model import BUCKETS, Bags, Scorer, SubwordModel, fit, subwords, window_means
from seasonmart.llm.toxicity import toxicity, training_rows, without_toxic
from tests.llm.conftest import ODD_ROWS

BAD = ["grimwort", "snidefell", "vilebrack"]


@pytest.fixture
def labelled(spark, documents, prose):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(900):
        words, toxic = prose(int(rng.integers(20, 90))).split(), i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(int(rng.integers(0, len(words))), BAD[int(rng.integers(0, 3))])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "q"))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int, score string")


def out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy_and_misspellings(labelled, documents):
    docs, labels = labelled
    found = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert {r.doc_id for r in found.values() if r.held_out} == {i for i in range(900) if out(i)}
    assert all(r.predicted == (r.score >= 0.3) for r in found.values())
    right = [r.predicted == (i % 5 == 0) for i, r in found.items() if r.held_out]
    assert np.mean(right) > 0.97
    model = module.fit_toxicity(docs, labels)
    known, unseen, clean = Scorer(model).probabilities(["a grimwort b", "a grimworts! b", "kalo mi nurase"])
    assert unseen > 0.3 and known > 0.3 and clean < 0.1
    kept = {r.doc_id for r in without_toxic(docs, labels).collect()}
    assert kept == {i for i, r in found.items() if r.score < 0.3}


def test_training_rows_are_bounded_and_not_held_out(labelled, monkeypatch):
    docs, labels = labelled
    text_of = {r.text: r.doc_id for r in docs.collect()}
    found = training_rows(docs, labels, rows=100).collect()
    assert len(found) == 100 and not any(out(text_of[r.text]) for r in found)
    assert all(r.label == (text_of[r.text] % 5 == 0) for r in found)


def test_held_out_labels_do_not_matter(labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(module.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r.doc_id, r.score) for r in toxicity(docs, x).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_odd_rows(documents, spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (99, 1), (None, 1), (7, None), (8, 7)], "doc_id long, toxic int")
    docs = documents(ODD_ROWS)
    found = toxicity(docs, labels).collect()
    assert len(found) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert toxicity(documents([]), labels).collect() == []
    none = toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert without_toxic(docs, labels).columns == docs.columns


def test_subwords_of_many_words_equal_those_of_one():
    words = ["hello", "wörld!", "a", "日本", "x" * 300]
    buckets, owner = subwords(words)
    for i, word in enumerate(words):
        assert sorted(buckets[owner == i]) == sorted(subwords([word])[0])
    assert buckets.max() < BUCKETS


def test_windows_cover_all_words():
    for n in range(1, 40):
        scores = np.zeros(n)
        for at in range(n):
            scores[:] = 0
            scores[at] = 1
            assert window_means(scores).max() > 0
    assert window_means(np.zeros(0)).tolist() == [0]


def test_training_and_scoring_agree(prose):
    texts = [prose(n) for n in (1, 5, 30, 60)] + [""]
    bags = Bags(texts, 0)
    gram_scores = np.random.default_rng(0).normal(size=BUCKETS)
    by_window = bags.window_scores(gram_scores)
    best = np.maximum.reduceat(by_window, bags.first_window)
    assert np.allclose(best, Scorer(SubwordModel(gram_scores, 0.0)).logits(texts), atol=1e-5)


def test_one_class():
    model = fit(["a", "b"] * 10, [1] * 20)
    assert Scorer(model).probabilities(["anything"])[0] > 0.99
