"""A training-data pipeline over the table `documents`: stages in order, each on all rows its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.llm import decontaminate, exact, jaccard, packing, quality, queries
from estate.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that reach grade 1 with a probability of one half; the model learns from labelled rows of `docs`."""
    labels = queries.table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, queries.quality_grade(), grades=3)
    return quality.score_quality(docs, model).where(quality.selected(1)).select(*docs.columns)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts the row with the smallest doc_id stays; texts without words all stay."""
    return jaccard.drop_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a word inside an occurrence of a benchmark window."""
    hits = decontaminate.benchmark_hits(docs, queries.table(spark, sf_dir, "benchmark"))
    return hits.where(F.size("span_start") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the rows that are left, in sequences of 4096 ids."""
    return packing.pack_documents(docs, queries.word_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL form; exact and near dedup are tested against plain Python on the smallest tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again as the next one's input."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
