"""Decision report over a classified inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from estate.functions.text import dotted_name
from estate.operators.ranking import top_rows
from estate.settings import CLASSES, GIB, KEY

THROWAWAY_NAME = "_test_|_tmp_|_sandbox_|_scratch_"


def _is(label: str) -> Column:
    return F.col("classification") == label


def class_counts(inventory: DataFrame, *, classes: Sequence[str] = tuple(CLASSES)) -> DataFrame:
    """One row per class in fixed order, 0 when empty: one pass, no join with a class list."""
    counted = inventory.agg(*[F.count_if(_is(c)).alias(c) for c in classes])
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("classification"), F.col(c).alias("objects"))
        for i, c in enumerate(classes)
    ]
    return counted.select(F.inline(F.array(*cells)))


def class_counts_by_catalog(inventory: DataFrame, *, classes: Sequence[str] = tuple(CLASSES)) -> DataFrame:
    """Catalog by class, zeros filled; partial counts are merged before the shuffle."""
    return inventory.groupBy("catalog").agg(*[F.count_if(_is(c)).alias(c) for c in classes]).orderBy("catalog")


def top_drift_catalogs(inventory: DataFrame, *, limit: int | None = 10) -> DataFrame:
    counts = inventory.filter(_is("drift_managed_on_old")).groupBy("catalog").agg(F.count(F.lit(1)).alias("drift"))
    return top_rows(counts, [F.desc("drift"), F.asc("catalog")], limit)


def _listed(rows: DataFrame, columns: Sequence[Column | str], limit: int | None) -> DataFrame:
    total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    return top_rows(rows, KEY, limit).select(
        dotted_name("catalog", "schema", "name").alias("full_name"), *columns, total.alias("total")
    )


def pipeline_objects(inventory: DataFrame, *, limit: int | None = 50) -> DataFrame:
    """The first objects kept by a pipeline, each with the total."""
    return _listed(inventory.filter("requires_pipeline_handling"), ["table_type", "classification"], limit)


def unknown_account_objects(inventory: DataFrame, *, limit: int | None = 50) -> DataFrame:
    """The first objects on a third account, each with the total."""
    return _listed(inventory.filter(_is("unknown_account")), ["storage_path"], limit)


def _sizable(inventory: DataFrame) -> DataFrame:
    return inventory.filter(~_is("path_missing") & ~F.col("table_type").eqNullSafe("VIEW"))


def size_coverage(inventory: DataFrame) -> DataFrame:
    """How many objects that could have a size do, and the bytes known."""
    sized, total = F.count("size_bytes"), F.count(F.lit(1))
    return _sizable(inventory).agg(
        sized.alias("sized"),
        total.alias("total_sizable"),
        F.when(total == 0, 0.0).otherwise(100.0 * (total - sized) / F.nullif(total, F.lit(0))).cast("double").alias("pct_missing"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
    )


def size_coverage_by_type(inventory: DataFrame) -> DataFrame:
    return (
        _sizable(inventory)
        .groupBy("object_type")
        .agg(F.count("size_bytes").alias("sized"), F.count(F.lit(1)).alias("total_sizable"))
        .orderBy("object_type")
    )


def bytes_on_new(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.coalesce(F.sum(F.when(_is("consistent_new"), F.col("size_bytes"))), F.lit(0)).alias("bytes_on_new"))


def recommendation(
    inventory: DataFrame,
    *,
    as_of,
    max_objects: int = 25,
    max_gib: float = 10.0,
    max_owners: int = 3,
    max_age_days: int = 30,
) -> DataFrame:
    """Verdict in one row. Age is tested first; all limits are strict.

    Owners are reduced to distinct values on the map side, so only they are shuffled.
    """
    moment = F.lit(as_of).cast("timestamp")
    age = F.floor((F.unix_micros(moment) - F.unix_micros(F.col("created_at").cast("timestamp"))) / F.lit(86400 * 10**6))
    per_owner = (
        inventory.filter(_is("consistent_new"))
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"), F.max(age).alias("age"))
    )
    facts = per_owner.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.greatest(F.coalesce(F.max("age"), F.lit(0)), F.lit(0)).alias("age"),
        F.count_if(F.coalesce(F.col("owner") != "", F.lit(False))).alias("owners"),
    ).withColumn("gib", F.col("bytes") / F.lit(GIB))
    over = (F.col("n") > max_objects) | (F.col("gib") > max_gib) | (F.col("owners") > max_owners)
    verdict = (
        F.when((F.col("age") > max_age_days) | over, "FORWARD_MIGRATE_REQUIRED")
        .when(F.col("n") == 0, "ROLLBACK_FEASIBLE")
        .otherwise("ROLLBACK_REQUIRES_SIGNOFF")
    )
    why = (
        F.when(F.col("age") > max_age_days, F.format_string(f"oldest object on new is %d days old, limit {max_age_days}", "age"))
        .when(over, F.format_string("%d objects, %.1f GiB and %d owners on new exceed the limits", "n", "gib", "owners"))
        .when(F.col("n") == 0, F.lit("nothing is on new"))
        .otherwise(F.format_string("%d objects on new are within the limits and need a sign-off", "n"))
    )
    feasible = F.col("verdict") == "ROLLBACK_FEASIBLE"
    return (
        facts.withColumn("verdict", verdict)
        .withColumn("why", why)
        .select(
            "verdict",
            "why",
            F.col("n").alias("new_object_count"),
            F.when(feasible, F.lit(0)).otherwise(F.col("bytes")).cast("long").alias("bytes_on_new"),
        )
    )


def rollback_ledger(inventory: DataFrame) -> DataFrame:
    """What a roll-back would drop, with a flag for names that look throw-away."""
    return inventory.filter(_is("consistent_new")).select(
        dotted_name("catalog", "schema", "name").alias("full_name"),
        "object_type",
        "owner",
        "created_at",
        "size_bytes",
        F.col("name").rlike(THROWAWAY_NAME).alias("looks_throwaway"),
    )


def cross_region(locations: DataFrame) -> DataFrame:
    """Whether the locations lie in more than one region."""
    return locations.agg((F.countDistinct(F.nullif("region", F.lit(""))) > 1).alias("cross_region"))


def forward_cost(
    inventory: DataFrame,
    locations: DataFrame,
    *,
    same_region_rate: float = 0.5,
    cross_region_rate: float = 0.15,
    dbu_per_hour: float = 1.5,
) -> DataFrame:
    """Bytes to clone, hours at the rate of the region spread, and compute units."""
    facts = inventory.agg(
        F.count_if(_is("drift_managed_on_old")).alias("drift_objects"),
        F.count_if(_is("external_on_old")).alias("external_objects"),
        F.coalesce(F.sum(F.when(_is("drift_managed_on_old"), F.col("size_bytes"))), F.lit(0)).alias("drift_bytes"),
    ).withColumn("cross_region", cross_region(locations).scalar())
    rate = F.when(F.col("cross_region"), F.lit(cross_region_rate)).otherwise(F.lit(same_region_rate))
    return (
        facts.withColumn("gib", F.col("drift_bytes") / F.lit(GIB))
        .withColumn("rate", rate)
        .withColumn("hours", F.col("gib") / F.col("rate") / F.lit(3600))
        .withColumn("dbu", F.col("hours") * F.lit(dbu_per_hour))
    )
