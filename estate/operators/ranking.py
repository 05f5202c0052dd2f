"""Bounded top-k helpers; the limits here are the feature (reports and evidence samples)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_rows(rows: DataFrame, order: Sequence[Column | str], limit: int | None) -> DataFrame:
    """The first rows overall: each task keeps ``limit`` rows before they meet. Without a limit, all rows in order."""
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def first_rows(rows: DataFrame, keys: Sequence[str], limit: int | None) -> DataFrame:
    return top_rows(rows, list(keys), limit)


def top_rows_per_group(rows: DataFrame, groups: Sequence[str], order: Sequence[Column | str], limit: int) -> DataFrame:
    """The first rows of each group. Spark limits each group inside every task before the shuffle,
    so a group holding most rows sends only ``limit`` rows per task."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= limit).drop("_rank")
