"""Operator 8: toxicity scores from subword-bag embeddings and a linear softmax."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, fresh, frugal, give_back, held, text_or_empty, with_columns
from seasonmart.llm.subword_model import Scorer, SubwordModel, fit

#: The classifier is fitted on at most this many labelled texts, of this many bytes together.
FIT_ROWS, FIT_BYTES = 8_000, 64 << 20
#: Scores from here on count as toxic.
THRESHOLD = 0.3


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label may not be learned from: one id in four, by its CRC-32."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = FIT_ROWS, size: int = FIT_BYTES,
) -> DataFrame:
    """A sample of labelled texts: those whose ids have the smallest hashes, held-out ids excluded.

    Texts are taken whole, whatever their length, in the order of the hashes until ``rows`` texts or
    ``size`` bytes are reached. Only ids are shuffled to find labels that have a document.
    """
    labelled = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(
        F.col(doc_id).alias("labelled_id"), F.col(label).cast("int").alias("label")
    )
    known = docs.select(F.col(doc_id).alias("labelled_id"))
    chosen = labelled.join(known, "labelled_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(rows)
    texts = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text"))
    order = [F.xxhash64("id"), F.col("id"), F.col("label"), F.col("text")]
    found = texts.join(F.broadcast(chosen), F.col("id") == F.col("labelled_id"))  # at most ``rows`` ids
    found = found.where(F.octet_length("text") <= size).orderBy(*order).limit(rows)
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over ``rows`` texts
    return found.withColumn("so_far", F.sum(F.octet_length("text")).over(so_far)).where(F.col("so_far") <= size).select(
        "text", "label"
    )


def fit_toxicity(docs: DataFrame, labels: DataFrame, **options) -> SubwordModel:
    """Fit the classifier on the driver, on the bounded sample of ``training_rows``."""
    texts, ones = [], []
    for row in training_rows(docs, labels, **options).toLocalIterator():
        texts.append(row.text)
        ones.append(row.label)
    try:
        return fit(texts, ones)
    finally:
        del texts
        give_back()


def with_score(docs: DataFrame, model: SubwordModel, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score``: the probability, from 0 to 1, that a text is toxic. Null counts as empty."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # one number per bucket: 0.5 MB

    def run(batches):
        model = shared.value
        scorer = held(("scorer", model.key), lambda: Scorer(model))
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(text).to_pylist()]
            found = scorer.probabilities(texts) if texts else np.zeros(0)
            yield batch.append_column(score, pa.array(found, pa.float64()))

    return docs.mapInArrow(frugal(run), with_columns(docs, {score: "double"}))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Vectors of words and character n-grams are averaged over windows of ``WINDOW`` distinct words
    and go through a linear softmax; a document scores as its most suspicious window, so that a
    few words are not lost in a long text. Vectors and softmax are learned together in numpy, from
    at most ``FIT_ROWS`` labelled texts of ``FIT_BYTES`` together that are not held out, and the
    score is calibrated on a fifth of them. Only texts are inputs of a score.

    Defined results: null and empty texts score as a text without words, by the bias alone. Labels
    other than 0 and 1, and labels of unknown ids, are not learned from; without labels of both
    classes every text gets the share of label 1, or 0.5 if there are none. Repeated rows score
    alike. A null doc_id is not held out. Texts of any length are scored whole. An empty table gives
    an empty result. Other columns are left out.
    """
    model = fit_toxicity(docs, labels, doc_id=doc_id, text=text)
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_score(thin, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that score below the threshold, with their columns unchanged."""
    score = fresh(docs.columns, "score")
    model = fit_toxicity(docs, labels, doc_id=doc_id, text=text)
    return with_score(docs, model, text, score).where(F.col(score) < THRESHOLD).drop(score)
