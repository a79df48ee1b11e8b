"""From raw documents to token ids: five stages, each one of the operators in seasonmart.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seasonmart.llm.bpe import encode_and_decode
from seasonmart.llm.common import table
from seasonmart.llm.line_dedup import line_dedup
from seasonmart.llm.mixing import sample
from seasonmart.llm.near_dedup import without_near_copies
from seasonmart.llm.queries import KEEP_SHARE, TARGETS, mixing_dimensions, tokenizer_file
from seasonmart.llm.toxicity import without_toxic
from seasonmart.sources.sinks import Scratch, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels that are not held out.

    Null and empty texts score as texts without words; without labels nothing can be learned, and
    nothing goes unless label 1 is common.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that more than ``MAX_RATIO`` of a source's documents share are taken out of their texts.

    Every document stays, with an empty text if all of it was boilerplate; null texts and sources
    are left as they are.
    """
    return line_dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8.

    Documents without words, or without an id, are nobody's copy and stay.
    """
    return without_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of ``KEEP_SHARE`` of all tokens, its sources, languages and topics near their target shares.

    Texts without words have no place in it.
    """
    return sample(docs, TARGETS, mixing_dimensions(), keep_share=KEEP_SHARE)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the text they decode to; null texts have none."""
    return encode_and_decode(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The classifier, the signatures and the tokenizer have no counterpart in SQL; see
#: tests/llm/test_pipeline.py for the stages held against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written as Parquet for the next to read.

    Texts of any length go through whole. Repeated rows are documents like others until the near
    copies go. Columns keep their names, whatever they are; the last stage adds ``ids`` and
    ``decoded``, with underscores in front where a name is taken. An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for number, (name, apply) in enumerate(STAGES[:-1]):
            docs = scratch.stage(apply(spark, docs, sf_dir), f"{number}_{name}")
            if number:
                scratch.drop(f"{number - 1}_{STAGES[number - 1][0]}")
        name, apply = STAGES[-1]
        return stage(apply(spark, docs, sf_dir), name)


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
