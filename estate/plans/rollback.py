"""Existence-driven roll-back: statements that lead back to the original from any state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estate.functions.text import quote_literal, quote_name
from estate.functions.urls import attach_moved_url, url_class
from estate.operators.closure import peel
from estate.operators.governance import own_kind
from estate.operators.state import attach_existence, current_log, shadow_name, staging_name
from estate.settings import KEY

# Log statuses a roll-back starts from, and those after the swap.
ROLLBACK_STATUSES = ["snapshot_taken", "cloned", "swapped", "replayed", "validated", "failed", "rollback_failed"]
SWAPPED_STATUSES = ["swapped", "replayed", "validated"]
DROP_ORDER = {"VIEW": 1, "TABLE": 2, "VOLUME": 3, "REGISTERED_MODEL": 4}

INVENTORY_COLUMNS = ["table_type", "storage_path", "data_source_format", "parent_managed_location", "classification"]


def rollback_candidates(log: DataFrame, inventory: DataFrame) -> DataFrame:
    """Current log rows that can be rolled back, with what the inventory knew of the object."""
    known = inventory.select(*KEY, *[c for c in INVENTORY_COLUMNS if c in inventory.columns])
    return current_log(log).filter(F.col("status").isin(ROLLBACK_STATUSES)).join(known, KEY, "left")


def unrecoverable_objects(log: DataFrame, listing: DataFrame) -> DataFrame:
    """Swapped objects with neither the original nor its shadow left; unknown is not missing."""
    swapped = current_log(log).filter(F.col("status").isin(SWAPPED_STATUSES))
    return attach_existence(swapped, listing).filter(~F.col("orig_exists") & ~F.col("pre_exists"))


def _name(name: Column) -> Column:
    return quote_name("catalog", "schema", name)


def _step(label: str, statement: Column) -> Column:
    return F.struct(F.lit(label).alias("label"), statement.alias("statement"))


def plan_rollback(rows: DataFrame) -> DataFrame:
    """Numbered steps per object with existence flags (``attach_existence``).

    ``noop``, ``warn`` and ``error`` rows carry a message in place of a statement. An object whose
    existence is unknown gets a warning, never a drop.
    """
    orig, pre, staging = _name(F.col("name")), _name(shadow_name("name")), _name(staging_name("name"))
    has_orig, has_pre, has_staging = F.col("orig_exists"), F.col("pre_exists"), F.col("staging_exists")
    kind = own_kind(F.col("object_type"))
    drop = lambda name: F.concat(F.lit("DROP "), kind, F.lit(" IF EXISTS "), name)
    fmt = F.upper(F.coalesce(F.nullif("data_source_format", F.lit("")), F.lit("DELTA")))
    at = F.concat(F.lit(" LOCATION "), quote_literal(F.col("storage_path")))
    recreate = F.when(kind == "VOLUME", F.concat(F.lit("CREATE EXTERNAL VOLUME "), orig, at)).otherwise(
        F.concat(F.lit("CREATE EXTERNAL TABLE "), orig, F.lit(" USING "), fmt, at)
    )
    external = F.coalesce(F.upper("table_type") == "EXTERNAL", F.lit(False))
    no_path = F.nullif("storage_path", F.lit("")).isNull()
    note = lambda label, text: F.array(_step(label, F.concat(orig, F.lit(": " + text))))
    drop_orig = F.when(has_orig, _step("drop_migrated", drop(orig)))
    drop_staging = _step("drop_staging", drop(staging))
    steps = (
        F.when(external & no_path, note("error", "no original path"))
        .when(has_orig.isNull() | has_pre.isNull() | has_staging.isNull(), note("warn", "existence unknown"))
        .when(external, F.array_compact(F.array(drop_orig, _step("recreate_external", recreate))))
        .when(
            has_pre,
            F.array_compact(
                F.array(
                    drop_orig,
                    _step("restore_shadow", F.concat(F.lit("ALTER "), kind, F.lit(" "), pre, F.lit(" RENAME TO "), orig)),
                    F.when(has_staging, drop_staging),
                )
            ),
        )
        .when(has_orig & has_staging, F.array(drop_staging))
        .when(has_orig, note("noop", "original intact"))
        .when(has_staging, note("warn", "only staging is left"))
        .otherwise(note("error", "nothing is left"))
    )
    return rows.select(*KEY, F.posexplode(steps).alias("position", "step")).select(
        *KEY, (F.col("position") + 1).alias("step_no"), "step.label", "step.statement"
    )


def rollback_outcomes(steps: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """``outcome`` per object: skipped, rollback_failed or rolled_back.

    ``failures`` lists the keys whose statements failed when they were run.
    """
    first = steps.filter(F.col("step_no") == 1)
    outcome = F.when(F.col("label") == "noop", "skipped").when(F.col("label").isin("warn", "error"), "rollback_failed")
    if failures is None:
        return first.select(*KEY, F.coalesce(outcome, F.lit("rolled_back")).alias("outcome"))
    failed = failures.select(*KEY).distinct().withColumn("_failed", F.lit(True))
    ran = F.when(F.col("_failed"), "rollback_failed").otherwise("rolled_back")
    return first.join(failed, KEY, "left").select(*KEY, F.coalesce(outcome, ran).alias("outcome"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("objects"))


def schema_root_reverts(inventory: DataFrame, *, old: str, new: str) -> DataFrame:
    """Schemas whose managed location is on new, with the location on old."""
    parents = inventory.groupBy("catalog", "schema").agg(F.min_by("parent_managed_location", "name").alias("current_root"))
    return _reverted(parents, "current_root", old=old, new=new)


def catalog_root_reverts(catalogs: DataFrame, *, old: str, new: str) -> DataFrame:
    return _reverted(catalogs.select("catalog", F.col("storage_root").alias("current_root")), "current_root", old=old, new=new)


def _reverted(rows: DataFrame, root: str, *, old: str, new: str) -> DataFrame:
    on_new = rows.filter(url_class(F.col(root), old=old, new=new) == "new")
    return attach_moved_url(on_new, root, new=old, old=new).withColumn("target_root", F.col("moved.url")).drop("moved")


#: Classes that have no place on either account: views, models and functions.
WITHOUT_PLACE = ("path_missing", "requires_external_handling")


def _offends() -> Column:
    return ~F.coalesce(F.col("classification").isin("consistent_old", *WITHOUT_PLACE), F.lit(False))


def rollback_check(inventory: DataFrame) -> DataFrame:
    """One row: the roll-back succeeded when nothing is on new and all that has a place is on old."""
    count = lambda label: F.count_if(F.col("classification") == label)
    return inventory.agg(
        count("consistent_new").alias("consistent_new"),
        count("drift_managed_on_old").alias("drift"),
        F.count_if(_offends()).alias("offenders"),
        (F.count_if(_offends()) == 0).alias("success"),
    )


def rollback_offenders(inventory: DataFrame) -> DataFrame:
    return inventory.filter(_offends())


def drop_order(inventory: DataFrame) -> DataFrame:
    """Objects on new in the order a roll-back drops them, then the schemas only they live in.

    A schema qualifies when none of its objects is anywhere but on new. ``drop_rank`` is the
    order between kinds; for the order among views see ``dependency_order``.
    """
    on_new = F.col("classification") == "consistent_new"
    ranks = F.create_map(*[F.lit(v) for pair in DROP_ORDER.items() for v in pair])
    kind = F.when(F.col("table_type").eqNullSafe("VIEW"), "VIEW").otherwise(F.col("object_type"))
    objects = inventory.filter(on_new).select(
        "catalog", "schema", "name", kind.alias("kind"), F.coalesce(F.try_element_at(ranks, kind), F.lit(2)).alias("drop_rank")
    )
    schemas = (
        inventory.groupBy("catalog", "schema")
        .agg(F.bool_and(on_new).alias("only_new"))
        .filter("only_new")
        .select("catalog", "schema", F.lit(None).cast("string").alias("name"), F.lit("SCHEMA").alias("kind"), F.lit(5).alias("drop_rank"))
    )
    return objects.unionByName(schemas)


def dependency_order(objects: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(full_name, drop_level): an object is dropped on a later level than all that depend on it.

    ``objects`` has ``full_name``; ``dependencies`` has ``full_name`` and ``depends_on``. Objects on a cycle, or that a
    cycle depends on, cannot be ordered and have a null level.
    """
    edges = dependencies.select(F.col("full_name").alias("src"), F.col("depends_on").alias("dst"))
    return peel(objects.select(F.col("full_name").alias("node")), edges).select(F.col("node").alias("full_name"), F.col("level").alias("drop_level"))
