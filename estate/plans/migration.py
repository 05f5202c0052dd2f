"""Routing objects to a playbook, its ordered statements, and pre-flight checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from estate.functions.text import quote_literal, quote_name
from estate.functions.urls import attach_moved_url
from estate.operators.state import shadow_name, staging_name
from estate.operators.verify import compare_fingerprints, fingerprint
from estate.settings import KEY
from estate.sources.footers import footer_signature


# Playbook by class, object type and kind.
_ROUTES = {
    "external_on_old/TABLE/delta": "external_table",
    "external_on_old/TABLE/other": "external_table",
    "external_on_old/TABLE/pipeline": "external_table",
    "external_on_old/VOLUME/managed": "external_volume",
    "external_on_old/VOLUME/other": "external_volume",
    "drift_managed_on_old/TABLE/delta": "clone",
    "drift_managed_on_old/TABLE/other": "ctas",
    "drift_managed_on_old/TABLE/pipeline": "hand_off",
    "drift_managed_on_old/VOLUME/managed": "volume_copy",
}


def route(inventory: DataFrame, *, skip_managed_volumes: bool = False) -> DataFrame:
    """``route`` of each object on old storage, null for objects that stay."""
    volume = F.col("object_type") == "VOLUME"
    kind = (
        F.when(volume & F.col("table_type").eqNullSafe("MANAGED"), "managed")
        .when(volume, "other")
        .when(F.col("requires_pipeline_handling"), "pipeline")
        .when(F.col("data_source_format").eqNullSafe("DELTA"), "delta")
        .otherwise("other")
    )
    routes = dict(_ROUTES)
    if skip_managed_volumes:
        routes["drift_managed_on_old/VOLUME/managed"] = "volume_skipped"
    table = F.create_map(*[F.lit(cell) for pair in routes.items() for cell in pair])
    return inventory.withColumn("route", F.try_element_at(table, F.concat_ws("/", "classification", "object_type", kind)))


def _name(name: Column | str = "name") -> Column:
    return quote_name("catalog", "schema", F.col(name) if isinstance(name, str) else name)


def create_volume(name: Column, *, if_not_exists: bool = False) -> Column:
    return F.concat(F.lit("CREATE VOLUME IF NOT EXISTS " if if_not_exists else "CREATE VOLUME "), name)


def drop_volume(name: Column) -> Column:
    return F.concat(F.lit("DROP VOLUME "), name)


def rename(kind: str, name: Column, target: Column) -> Column:
    """The target is always qualified: a bare name would resolve against the session's schema."""
    return F.concat(F.lit(f"ALTER {kind} "), name, F.lit(" RENAME TO "), target)


def _steps(*steps: tuple[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(action).alias("action"), text.alias("statement")) for action, text in steps])


def plan_steps(routed: DataFrame, *, new: str, old: str | None = None) -> DataFrame:
    """Ordered statements per routed object, or one ``error`` row when its path cannot move.

    All steps are built inside the object's row; nothing is shuffled.
    """
    rows = routed.filter(F.col("route").isin("clone", "ctas", "external_table", "external_volume"))
    rows = attach_moved_url(rows, "storage_path", new=new, old=old)
    orig, pre, staging = _name(), _name(shadow_name("name")), _name(staging_name("name"))
    swap = (("rename_orig", rename("TABLE", orig, pre)), ("rename_staging", rename("TABLE", staging, orig)))
    fmt = F.upper(F.coalesce(F.nullif("data_source_format", F.lit("")), F.lit("DELTA")))
    at = F.concat(F.lit(" LOCATION "), quote_literal(F.col("moved.url")))
    stays = F.nullif("storage_path", F.lit("")).isNull()
    fault = F.when(stays, "no storage path").otherwise(F.col("moved.error"))
    external = F.col("route").isin("external_table", "external_volume")
    steps = (
        F.when(external & fault.isNotNull(), _steps(("error", fault)))
        .when(F.col("route") == "clone", _steps(("clone", F.concat(F.lit("CREATE TABLE "), staging, F.lit(" DEEP CLONE "), orig)), *swap))
        .when(
            F.col("route") == "ctas",
            _steps(("ctas", F.concat(F.lit("CREATE TABLE "), staging, F.lit(" AS SELECT * FROM "), orig)), *swap),
        )
        .when(
            F.col("route") == "external_table",
            _steps(
                ("drop", F.concat(F.lit("DROP TABLE "), orig)),
                ("create", F.concat(F.lit("CREATE EXTERNAL TABLE "), orig, F.lit(" USING "), fmt, at)),
            ),
        )
        .otherwise(
            _steps(("drop", drop_volume(orig)), ("create", F.concat(F.lit("CREATE EXTERNAL VOLUME "), orig, at)))
        )
    )
    return rows.select(*KEY, "route", F.posexplode(steps).alias("position", "step")).select(
        *KEY, "route", (F.col("position") + 1).alias("step_no"), "step.action", "step.statement"
    )


def managed_volume_steps(routed: DataFrame) -> DataFrame:
    """Statements around the file copy of a managed volume, and the copy and its verification between them.

    The original stays as the shadow: only the cleanup may drop it.
    """
    orig, pre, staging = _name(), _name(shadow_name("name")), _name(staging_name("name"))
    nothing = F.lit(None).cast("string")
    steps = _steps(
        ("create_staging", create_volume(staging, if_not_exists=True)),
        ("copy", nothing),
        ("verify", nothing),
        ("rename_orig", rename("VOLUME", orig, pre)),
        ("rename_staging", rename("VOLUME", staging, orig)),
    )
    return (
        routed.filter(F.col("route") == "volume_copy")
        .select(*KEY, F.posexplode(steps).alias("position", "step"))
        .select(*KEY, (F.col("position") + 1).alias("step_no"), "step.action", "step.statement")
    )


def location_cover(targets: DataFrame, locations: DataFrame, *, keys: Sequence[str] = tuple(KEY), path: str = "target_path") -> DataFrame:
    """The first listed external location that is the target path or a parent of it; null when none.

    Each path is expanded into its own ancestors, which meet the location URLs in an equi-join, so
    no target is compared with every location. ``locations`` has ``pos``, ``name``, ``url``.
    """
    parts = F.split(F.col(path), "/")
    # Without a scheme and host a text names no place, so the shortest ancestor is scheme://host.
    depth = F.size(parts)
    ancestors = F.transform(F.sequence(F.least(F.lit(3), depth), depth), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    listed = (
        locations.select(F.rtrim("url", F.lit("/")).alias("ancestor"), F.struct("pos", "name").alias("location"))
        .groupBy("ancestor")
        .agg(F.min("location").alias("location"))
    )
    covered = (
        targets.select(*keys, F.explode(F.array_distinct(ancestors)).alias("ancestor"))
        .join(listed, "ancestor")
        .groupBy(*keys)
        .agg(F.min("location").alias("location"))
        .select(*keys, F.col("location.name").alias("location_name"))
    )
    return targets.join(covered, list(keys), "left")


def missing_at_target(targets: DataFrame, entries: DataFrame, *, root: str = "target_path") -> DataFrame:
    """Targets below which not one entry is listed; ``entries`` has ``root`` per entry."""
    present = entries.select(F.col("root").alias(root)).distinct()
    return targets.join(present, root, "left_anti")


def entry_completeness(targets: DataFrame, entries: DataFrame, *, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Entries at ``old_path`` and ``new_path``: complete when new has as many and old has any."""
    counts = entries.groupBy("root").agg(F.count(F.lit(1)).alias("entries"))
    rows = targets
    for side in ("old", "new"):
        found = counts.select(F.col("root").alias(f"{side}_path"), F.col("entries").alias(f"_{side}"))
        rows = rows.join(found, f"{side}_path", "left").withColumn(f"{side}_count", F.coalesce(f"_{side}", F.lit(0))).drop(f"_{side}")
    short = F.col("new_count") < F.col("old_count")
    return rows.select(
        *keys,
        "old_count",
        "new_count",
        (~short & (F.col("old_count") > 0)).alias("complete"),
        (short & (F.col("old_count") > 0)).alias("warn"),
    )


def table_signature(table: DataFrame) -> DataFrame:
    """Row count and a stable hash of the ordered (name, type) pairs."""
    text = "\n".join(f"{f.name}\t{f.dataType.simpleString()}" for f in table.schema.fields)
    return table.agg(F.count(F.lit(1)).alias("row_count")).withColumn("schema_hash", F.sha2(F.lit(text), 256))


def compare_signatures(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: whether row count and schema are the same before and after."""
    return _compare_signatures(table_signature(before), table_signature(after))


def compare_footers(before: DataFrame, after: DataFrame) -> DataFrame:
    """The same from the footers of both sides' files; files that are no Parquet make both checks fail."""
    verdict = _compare_signatures(footer_signature(before), footer_signature(after))
    whole = F.col("unreadable") == 0
    return verdict.withColumns({c: F.col(c) & whole for c in ("row_count_ok", "schema_ok")})


def _compare_signatures(before: DataFrame, after: DataFrame) -> DataFrame:
    sides = before.withColumn("side", F.lit("before")).unionByName(after.withColumn("side", F.lit("after")))
    pick = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column)))
    return sides.agg(
        pick("before", "row_count").alias("row_count_before"),
        pick("after", "row_count").alias("row_count_after"),
        (pick("before", "row_count") == pick("after", "row_count")).alias("row_count_ok"),
        (pick("before", "schema_hash").eqNullSafe(pick("after", "schema_hash"))).alias("schema_ok"),
        *([F.sum("unreadable").alias("unreadable")] if "unreadable" in sides.columns else []),
    )


def _layout(spark: SparkSession, table: str) -> tuple[str, list[str], dict[str, str]]:
    """Format, partition columns and properties of a table."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if described.get("Comment"):
        properties["comment"] = described["Comment"]
    return described.get("Provider") or "parquet", partitions, properties


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def staged_rewrite(spark: SparkSession, table: str, *, shadow: str, staging: str, location: str | None = None) -> DataFrame:
    """Copy a table to staging, verify the copy, swap the names and keep the original as shadow.

    Names are unquoted session-catalog names. The copy has the format, partitioning, properties and
    comments of the table. Row count, schema and fingerprint are compared before any name changes; a
    copy that differs is left in staging and the table stays as it is. A staging or shadow that
    exists already is never touched: that is an error. If the second renaming fails, the first is
    taken back.
    """
    for name in (staging, shadow):
        if spark.catalog.tableExists(name):
            raise ValueError(f"{name} exists already")
    source = spark.table(table)
    kind, partitions, properties = _layout(spark, table)
    writer = source.write.mode("errorifexists").format(kind)
    if partitions:
        writer = writer.partitionBy(*partitions)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(staging)
    comment = properties.pop("comment", None)
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {staging} IS {_literal(comment)}")
    if properties:
        spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({', '.join(f'{_literal(k)} = {_literal(v)}' for k, v in properties.items())})")
    original, copy = spark.table(table), spark.table(staging)
    signs = compare_signatures(original, copy).select("row_count_ok", "schema_ok").first()
    verdict = compare_fingerprints(fingerprint(original), fingerprint(copy)).withColumns({k: F.lit(v) for k, v in signs.asDict().items()})
    result = verdict.withColumn("match", F.col("match") & F.col("row_count_ok") & F.col("schema_ok")).first()
    if result["match"]:
        spark.sql(f"ALTER TABLE {table} RENAME TO {shadow}")
        try:
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {shadow} RENAME TO {table}")
            raise
    return spark.createDataFrame([result], verdict.schema)
