"""Existence, migration state, claims and the append-only log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estate.settings import KEY, SHADOW_SUFFIX, STAGING_SUFFIX

# Action of an executed step to the status it leaves behind.
ACTION_STATUS = {
    "clone": "cloned",
    "ctas": "cloned",
    "drop": "cloned",
    "create": "cloned",
    "rename_orig": "cloned",
    "rename_staging": "swapped",
}

# Phases still to run from each state, in order. Other states need a review.
PHASES = {
    "pristine": ["clone", "rename_orig_to_pre", "promote_staging", "replay", "validate"],
    "cloned": ["rename_orig_to_pre", "promote_staging", "replay", "validate"],
    "swap_partial": ["promote_staging", "replay", "validate"],
    "swapped": ["replay", "validate"],
    "swapped_orphan": ["replay", "validate", "drop_orphan_staging"],
}

LOG_COLUMNS = {
    "status": "string",
    "claimed_by": "string",
    "claimed_at": "timestamp",
    "started_at": "timestamp",
    "finished_at": "timestamp",
    "row_count_before": "long",
    "row_count_after": "long",
    "schema_hash_before": "string",
    "schema_hash_after": "string",
    "staging_fqn": "string",
    "pre_migration_fqn": "string",
    "error_trace": "string",
    "updated_at": "timestamp",
}


def shadow_name(name: Column | str) -> Column:
    return F.concat(name, F.lit(SHADOW_SUFFIX))


def staging_name(name: Column | str) -> Column:
    return F.concat(name, F.lit(STAGING_SUFFIX))


def action_status(action: Column | str) -> Column:
    """The status after a step; an unknown action is its own status."""
    column = F.col(action) if isinstance(action, str) else action
    pairs = [F.lit(text) for pair in ACTION_STATUS.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def attach_existence(objects: DataFrame, listing: DataFrame) -> DataFrame:
    """``orig_exists``, ``pre_exists``, ``staging_exists`` of each object.

    A listing row may carry ``present``: null means it could not be read, and then existence is
    null (unknown) rather than false. Each listed name counts as itself and, with a suffix, also as
    the shadow or staging copy of its base name; one aggregation on the base name gives all three.
    """
    present = F.col("present") if "present" in listing.columns else F.lit(True)

    def as_base(variant: str, suffix: str) -> Column:
        base = F.substring("name", F.lit(1), F.length("name") - len(suffix))
        return F.when(F.col("name").endswith(suffix), F.struct(base.alias("base"), F.lit(variant).alias("variant")))

    roles = F.array_compact(
        F.array(
            F.struct(F.col("name").alias("base"), F.lit("orig").alias("variant")),
            as_base("pre", SHADOW_SUFFIX),
            as_base("staging", STAGING_SUFFIX),
        )
    )
    facts = listing.select("catalog", "schema", "object_type", present.alias("present"), F.inline(roles))

    def state(variant: str) -> Column:
        mine = F.col("variant") == variant
        found = F.count_if(mine & F.col("present"))
        unread = F.count_if(mine & F.col("present").isNull())
        return F.when(found > 0, "yes").when(unread > 0, "unknown").otherwise("no").alias(f"_{variant}")

    known = facts.groupBy("catalog", "schema", "object_type", F.col("base").alias("name")).agg(*[state(v) for v in ("orig", "pre", "staging")])
    rows = objects.join(known, KEY, "left")
    for variant in ("orig", "pre", "staging"):
        flag = F.when(F.coalesce(f"_{variant}", F.lit("no")) == "unknown", F.lit(None)).otherwise(
            F.coalesce(f"_{variant}", F.lit("no")) == "yes"
        )
        rows = rows.withColumn(f"{variant}_exists", flag.cast("boolean"))
    return rows.drop("_orig", "_pre", "_staging")


def object_state() -> Column:
    """State from the three existence flags; ``unknown`` while one of them is."""
    orig, pre, staging = F.col("orig_exists"), F.col("pre_exists"), F.col("staging_exists")
    return (
        F.when(orig.isNull() | pre.isNull() | staging.isNull(), "unknown")
        .when(orig & pre & staging, "swapped_orphan")
        .when(orig & pre, "swapped")
        .when(pre & staging, "swap_partial")
        .when(pre, "gap")
        .when(orig & staging, "cloned")
        .when(orig, "pristine")
        .when(staging, "only_staging")
        .otherwise("absent")
    )


def attach_state(objects: DataFrame, listing: DataFrame) -> DataFrame:
    return attach_existence(objects, listing).withColumn("state", object_state())


def _phases(state: Column) -> Column:
    table = F.create_map(*[part for s, phases in PHASES.items() for part in (F.lit(s), F.array(*[F.lit(p) for p in phases]))])
    return F.try_element_at(table, state)


def resume_phases(stated: DataFrame) -> DataFrame:
    """Remaining phases per object, numbered; a state that needs review has none."""
    return (
        stated.withColumn("phases", _phases(F.col("state")))
        .select(*KEY, "state", F.posexplode("phases").alias("position", "phase"))
        .select(*KEY, "state", (F.col("position") + 1).alias("phase_no"), "phase")
    )


def flag_resumable(stated: DataFrame) -> DataFrame:
    return stated.withColumn("resumable", F.col("state").isin(list(PHASES)))


def current_log(log: DataFrame) -> DataFrame:
    """The current row per object; a log without ``updated_at`` is taken to be that already."""
    return latest_log(log) if "updated_at" in log.columns else log


def forward_worklist(objects: DataFrame, log: DataFrame) -> DataFrame:
    """Objects that are not validated now, dropped before anything is done for them."""
    return objects.join(current_log(log).filter(F.col("status") == "validated").select(*KEY).distinct(), KEY, "left_anti")


def failed_worklist(objects: DataFrame, log: DataFrame) -> DataFrame:
    """Only objects whose last status is failed."""
    return objects.join(current_log(log).filter(F.col("status") == "failed").select(*KEY).distinct(), KEY, "left_semi")


def latest_log(events: DataFrame) -> DataFrame:
    """Current row per object from the append-only log: the newest event, then the larger row.

    The struct maximum is merged on the map side, so an object with many events stays cheap.
    """
    rest = [c for c in events.columns if c not in KEY and c != "updated_at"]
    return events.groupBy(*KEY).agg(F.max(F.struct("updated_at", *rest)).alias("last")).select(*KEY, "last.*")


def log_rows(rows: DataFrame) -> DataFrame:
    """Rows in the stored shape of the log; columns not given are null."""
    return rows.select(
        *KEY,
        *[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in LOG_COLUMNS.items()],
    )


def log_update(state: DataFrame, *, updated_at, changes: dict[str, Column]) -> DataFrame:
    """Events that set fields of the given log rows, to be appended."""
    changed = state
    for name, value in changes.items():
        changed = changed.withColumn(name, value)
    return log_rows(changed.withColumn("updated_at", F.lit(updated_at).cast("timestamp")))


def claim_owners(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Who holds each wanted object: its logged claim, else the first candidate.

    ``candidates`` has the key, ``actor`` and ``claimed_at``; ``log`` is one row per object. One
    winner per object holds within a batch only; two drivers at once are not protected.
    """
    wanted = candidates.select(
        *KEY, F.struct(F.lit(1).alias("rank"), F.col("claimed_at").cast("timestamp").alias("at"), F.col("actor").alias("by"), F.lit("claimed").alias("status")).alias("claim")
    )
    logged = log.select(
        *KEY, F.struct(F.lit(0).alias("rank"), F.col("claimed_at").cast("timestamp").alias("at"), F.col("claimed_by").alias("by"), "status").alias("claim")
    )
    return (
        logged.unionByName(wanted)
        .groupBy(*KEY)
        .agg(F.min("claim").alias("claim"))
        .select(
            *KEY,
            (F.col("claim.rank") == 1).alias("is_new"),
            F.col("claim.at").alias("claimed_at"),
            F.col("claim.by").alias("claimed_by"),
            F.col("claim.status").alias("status"),
        )
    )


def claim(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Each candidate with ``granted``: the object is theirs and is not validated."""
    owners = claim_owners(candidates, log).drop("claimed_at")
    return candidates.join(owners, KEY).withColumn(
        "granted", F.coalesce((F.col("claimed_by") == F.col("actor")) & (F.col("status") != "validated"), F.lit(False))
    )


def new_claims(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """The log rows to append for objects claimed for the first time."""
    fresh = claim_owners(candidates, log).filter("is_new")
    return log_rows(fresh.withColumn("started_at", F.col("claimed_at")).withColumn("updated_at", F.col("claimed_at")))
