"""Dropping shadows safely: targets, a fail-closed gate, decisions and statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estate.functions.text import quote_name
from estate.operators.governance import own_kind
from estate.operators.state import current_log
from estate.settings import SHADOW_SUFFIX


def cleanup_targets(log: DataFrame) -> DataFrame:
    """Objects whose current state is validated and names a shadow."""
    return current_log(log).filter((F.col("status") == "validated") & F.col("pre_migration_fqn").isNotNull()).select("pre_migration_fqn", "object_type")


def _parts(name: Column) -> Column:
    return F.split(F.replace(name, F.lit("`"), F.lit("")), r"\.")


def _three_parts(parts: Column) -> Column:
    return F.coalesce((F.size(parts) == 3) & ~F.array_contains(parts, ""), F.lit(False))


def _part(parts: Column, index: int) -> Column:
    return F.get(parts, F.lit(index))


def live_name(shadow: Column) -> Column:
    """Quoted name of the object a shadow was made from; null when it is not a shadow name."""
    parts = _parts(shadow)
    name = _part(parts, 2)
    base = F.substring(name, F.lit(1), F.length(name) - len(SHADOW_SUFFIX))
    ok = _three_parts(parts) & name.endswith(SHADOW_SUFFIX) & (base != "")
    return F.when(ok, quote_name(_part(parts, 0), _part(parts, 1), base))


def validate_targets(targets: DataFrame, *, ops_schema: str | None) -> DataFrame:
    """``reject_reason`` (null when accepted), quoted ``fqn`` and ``live_fqn``. First fault wins."""
    name = F.col("pre_migration_fqn")
    parts = _parts(name)
    ops = (ops_schema or "").replace("`", "").split(".")
    in_ops = F.lit(False)
    if len(ops) >= 2 and ops[0] and ops[1]:
        in_ops = (_part(parts, 0) == ops[0]) & (_part(parts, 1) == ops[1])
    kind = F.upper(F.coalesce("object_type", F.lit("")))
    reason = (
        F.when(F.coalesce(name, F.lit("")) == "", "empty name")
        .when(~_three_parts(parts), "not a three-part name")
        .when(~_part(parts, 2).endswith(SHADOW_SUFFIX), "not a shadow name")
        .when(~kind.isin("TABLE", "VOLUME"), "unsupported object type")
        .when(in_ops, "in the ops schema")
    )
    accepted = F.col("reject_reason").isNull()
    return (
        targets.withColumn("reject_reason", reason)
        .withColumn("fqn", F.when(accepted, quote_name(_part(parts, 0), _part(parts, 1), _part(parts, 2))))
        .withColumn("live_fqn", F.when(accepted, live_name(name)))
    )


def gate(validated: DataFrame) -> DataFrame:
    """``may_drop``: false for every target as soon as one target is rejected."""
    rejected = validated.agg(F.count_if(F.col("reject_reason").isNotNull()).alias("n")).scalar()
    return validated.withColumn("may_drop", rejected == 0)


def drop_decisions(gated: DataFrame, listing: DataFrame) -> DataFrame:
    """``decision`` per target from what exists now.

    An unreadable object gives ``unknown`` and is never dropped. ``listing`` has ``catalog``,
    ``schema``, ``name``, ``object_type`` and optionally ``present``, one row per object.
    """
    present = F.col("present") if "present" in listing.columns else F.lit(True)
    found = listing.select(
        quote_name("catalog", "schema", "name").alias("_name"),
        F.upper("object_type").alias("_type"),
        F.when(present, "yes").when(present.isNull(), "unknown").otherwise("no").alias("_state"),
    ).groupBy("_name", "_type").agg(F.max(F.col("_state")).alias("_state"))

    def looked_up(rows: DataFrame, name: str, flag: str) -> DataFrame:
        side = found.select(F.col("_name"), F.col("_type").alias("_kind"), F.col("_state").alias(flag))
        # A target without this name is looked up under its raw text, which no quoted name equals:
        # null keys would all meet in one task.
        keyed = rows.withColumn("_name", F.coalesce(name, F.concat(F.lit("?"), F.coalesce("pre_migration_fqn", F.lit("")))))
        return keyed.join(side, ["_name", "_kind"], "left").withColumn(flag, F.coalesce(flag, F.lit("no"))).drop("_name")

    rows = gated.withColumn("_kind", F.upper("object_type"))
    rows = looked_up(looked_up(rows, "fqn", "_shadow"), "live_fqn", "_live")
    decision = (
        F.when(~F.col("may_drop"), "blocked")
        .when(F.col("_shadow") == "no", "skipped_absent")
        .when(F.col("_shadow") == "unknown", "unknown")
        .when(F.col("live_fqn").isNull() | (F.col("_live") == "no"), "refused_no_live")
        .when(F.col("_live") == "unknown", "unknown")
        .otherwise("drop")
    )
    return rows.withColumn("decision", decision).drop("_kind", "_shadow", "_live")


def drop_statements(decided: DataFrame) -> DataFrame:
    statement = F.concat(F.lit("DROP "), own_kind(F.col("object_type")), F.lit(" IF EXISTS "), "fqn")
    return decided.filter(F.col("decision") == "drop").select("fqn", "object_type", statement.alias("statement"))


def undrop_statements(cleanup_log: DataFrame) -> DataFrame:
    """UNDROP for dropped tables; a dropped volume cannot come back and is reported as failed."""
    parts = _parts(F.col("pre_migration_fqn"))
    name = F.when(F.size(parts) == 3, quote_name(_part(parts, 0), _part(parts, 1), _part(parts, 2))).otherwise(F.col("pre_migration_fqn"))
    is_table = F.upper(F.coalesce("object_type", F.lit("TABLE"))) == "TABLE"
    return cleanup_log.filter(F.col("status") == "dropped").select(
        "pre_migration_fqn",
        "object_type",
        F.when(is_table, "undrop").otherwise("undrop_failed").alias("outcome"),
        F.when(is_table, F.concat(F.lit("UNDROP TABLE "), name)).alias("statement"),
    )


def cleanup_log_rows(outcomes: DataFrame, *, logged_at) -> DataFrame:
    """The stored shape of the cleanup log, with whole messages."""
    message = F.col("error_message") if "error_message" in outcomes.columns else F.lit(None).cast("string")
    return outcomes.select(
        F.lit(logged_at).cast("timestamp").alias("ts"),
        F.col("fqn").alias("pre_migration_fqn"),
        "object_type",
        "status",
        message.cast("string").alias("error_message"),
    )


def cleanup_totals(cleanup_log: DataFrame) -> DataFrame:
    return cleanup_log.groupBy("status").agg(F.count(F.lit(1)).alias("objects"))
