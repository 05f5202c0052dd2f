"""Consumers and recent writers of objects in scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estate.functions.text import dotted_name
from estate.operators.closure import reachable

NAME = ["catalog", "schema", "name"]
# The classes whose objects are looked at, and the audit actions that write.
CONSUMER_SCOPE = ["drift_managed_on_old", "external_on_old"]
WRITER_SCOPE = [*CONSUMER_SCOPE, "consistent_new"]
WRITE_ACTIONS = ["updateTable", "createTable", "mergeTable", "writeTable"]


def _scope(inventory: DataFrame, classes: list[str]) -> DataFrame:
    return inventory.filter(F.col("classification").isin(classes)).select(*NAME).distinct()


def _recent(rows: DataFrame, days: int, as_of) -> Column:
    """Later than ``days`` before ``as_of``; the bound takes the column's own type, so it reaches the scan."""
    bound = F.lit(as_of).cast(rows.schema["event_time"].dataType) - F.make_dt_interval(days=F.lit(days))
    return F.col("event_time") > bound


def lineage_consumers(inventory: DataFrame, lineage: DataFrame, *, days: int, as_of) -> DataFrame:
    """Edges that touch an object in scope at either end.

    Each edge becomes one row per end (one when both ends are the same object), so the edges are
    read once and meet the scope in one equi-join; a condition with OR would compare every pair.
    An edge between two objects in scope therefore appears twice.
    """
    recent = lineage.filter(_recent(lineage, days, as_of))
    end = lambda side: F.struct(*[F.col(f"{side}_table_{part}").alias(part) for part in NAME])
    edges = recent.select(
        F.col("source_table_full_name").alias("source"),
        F.col("target_table_full_name").alias("target"),
        "event_time",
        "entity_type",
        "entity_id",
        F.inline(F.array_distinct(F.array(end("source"), end("target")))),
    )
    return edges.join(_scope(inventory, CONSUMER_SCOPE), NAME).select("source", "target", "event_time", "entity_type", "entity_id")


def recent_writes(inventory: DataFrame, audit: DataFrame, *, days: int, as_of) -> DataFrame:
    """Write actions on objects in scope, matched by the full name in the request parameters."""
    scope = _scope(inventory, WRITER_SCOPE).select(dotted_name(*NAME).alias("full_name"))
    writes = audit.filter(_recent(audit, days, as_of) & F.col("action_name").isin(WRITE_ACTIONS)).withColumn(
        "full_name", F.try_element_at("request_params", F.lit("full_name_arg"))
    )
    return writes.join(scope, "full_name").select(
        "event_time", F.col("user_identity.email").alias("actor"), "action_name", "request_params"
    )


def downstream_consumers(inventory: DataFrame, lineage: DataFrame, *, days: int, as_of, max_depth: int | None = None) -> DataFrame:
    """(full_name, depth): everything that recent edges lead to from objects in scope, consumers of consumers included.

    ``depth`` is the number of edges from the nearest object in scope, which has 0 and is not listed
    itself. Edges without one of their names lead nowhere.
    """
    recent = lineage.filter(_recent(lineage, days, as_of))
    # A name with a missing part is null.
    end = lambda side: F.concat(*[p for i, n in enumerate(NAME) for p in ([F.lit(".")] if i else []) + [F.col(f"{side}_table_{n}")]])
    edges = recent.select(end("source").alias("src"), end("target").alias("dst"))
    seeds = _scope(inventory, CONSUMER_SCOPE).select(dotted_name(*NAME).alias("node"))
    return reachable(seeds, edges, max_depth=max_depth).filter("depth > 0").select(F.col("node").alias("full_name"), "depth")
