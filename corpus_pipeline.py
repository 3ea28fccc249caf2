"""From raw documents to packed sequences: five stages on whole tables.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; all but the last return the columns they were given. ``run``
writes each stage's result below the shared scratch folder and reads it back,
so a lost executor costs tasks and never a stage.

Rows without text, without a letter, or with fewer words than the quality rules
ask for leave at the first two stages. Repeated rows leave at the fourth. Extra
columns are carried along; an empty table gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywise.llm import langid, lines, packing, quality, simhash
from quaywise.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.keep_known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and are no outliers of their language and source."""
    return quality.keep_clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later places of passages that repeat.

    ``n_chars``, where there is one, becomes the length of what is left.
    """
    return lines.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    return simhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.packed_pieces(docs)


STAGES = [
    ("language", language),
    ("quality", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pack", pack),
]

#: Language model and estimates are iterative: there is no SQL for the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that are left of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
