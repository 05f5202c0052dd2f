"""Permission audit: required against held privileges, set-wise.

A securable row holds ``kind`` (CATALOG, SCHEMA, EXTERNAL LOCATION), ``securable`` (its dotted
name), ``parts`` (the name parts), ``owner`` and ``required`` (array of privileges). Grant rows
hold ``kind``, ``securable``, ``principal``, ``privilege``. Securables whose grants could not be
read are listed in ``unreadable`` (``kind``, ``securable``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from estate.functions.text import quote_ident
from estate.operators.closure import reachable
from estate.operators.inventory import user_schemas
from estate.settings import UNLISTED_CATALOG_KINDS

# The privileges each kind of securable needs.
CATALOG_NEEDS = ["USE CATALOG", "CREATE SCHEMA"]
SCHEMA_NEEDS = ["USE SCHEMA", "CREATE TABLE"]
MANAGED_CATALOG_SCHEMA_NEEDS = ["USE SCHEMA", "CREATE TABLE", "MANAGE"]
LOCATION_NEEDS = ["CREATE EXTERNAL TABLE", "READ FILES", "WRITE FILES"]


def _texts(values: Sequence[str]):
    return F.array(*[F.lit(v) for v in values])


def held_privileges(securables: DataFrame, grants: DataFrame, *, me: str, groups: Sequence[str] = (), unreadable: DataFrame | None = None) -> DataFrame:
    """``privileges`` held by me or my groups; null where the grants could not be read.

    Grants are reduced to the distinct privileges per securable before the shuffle; the
    privilege vocabulary is closed, so the sets stay small.
    """
    mine = (
        grants.filter(F.col("principal").isin([me, *groups]) & (F.col("privilege") != ""))
        .groupBy("kind", "securable")
        .agg(F.array_sort(F.collect_set("privilege")).alias("privileges"))
    )
    rows = securables.join(mine, ["kind", "securable"], "left")
    held = F.coalesce("privileges", F.array().cast("array<string>"))
    if unreadable is None:
        return rows.withColumn("privileges", held)
    failed = unreadable.select("kind", "securable").distinct().withColumn("_failed", F.lit(True))
    return (
        rows.join(failed, ["kind", "securable"], "left")
        .withColumn("privileges", F.when(F.col("_failed").isNull(), held))
        .drop("_failed")
    )


def principals_of(seeds: DataFrame, memberships: DataFrame) -> DataFrame:
    """(principal): the seeds' principals and every group they are in, through groups of groups; cycles may occur.

    ``memberships`` has ``member`` (a person or a group) and ``group``.
    """
    edges = memberships.select(F.col("member").alias("src"), F.col("group").alias("dst"))
    return reachable(seeds.select(F.col("principal").alias("node")), edges).select(F.col("node").alias("principal"))


def effective_privileges(securables: DataFrame, grants: DataFrame, principals: DataFrame, *, unreadable: DataFrame | None = None) -> DataFrame:
    """``privileges`` that any of the principals has on each securable itself or on the catalog or schema above it.

    Null where the grants of the securable, or of one above it, could not be read. Each securable meets
    its own ancestors by equality; grants are reduced to distinct privileges per securable first.
    """
    held = grants.filter(F.col("privilege") != "").join(principals.distinct(), "principal", "left_semi")
    held = held.groupBy("kind", "securable").agg(F.collect_set("privilege").alias("own"))
    itself = F.struct("kind", "securable")
    above = [
        F.when(F.size("parts") > n, F.struct(F.lit(kind).alias("kind"), F.array_join(F.slice("parts", 1, n), ".").alias("securable")))
        for n, kind in ((1, "CATALOG"), (2, "SCHEMA"))
    ]
    key = ["kind", "securable"]
    at = securables.select(*[F.col(k).alias(f"of_{k}") for k in key], F.explode(F.array_compact(F.array(itself, *above))).alias("at")).select("of_kind", "of_securable", "at.*").distinct()
    at = at.join(held, key, "left")
    if unreadable is not None:
        at = at.join(unreadable.select(*key).distinct().withColumn("failed", F.lit(True)), key, "left")
    else:
        at = at.withColumn("failed", F.lit(None).cast("boolean"))
    found = at.groupBy(*[F.col(f"of_{k}").alias(k) for k in key]).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("privileges"), F.max("failed").alias("failed")
    )
    return securables.join(found, key).withColumn("privileges", F.when(F.col("failed").isNull(), F.col("privileges"))).drop("failed")


def missing_privileges(rows: DataFrame, *, me: str) -> DataFrame:
    """``status`` (owner, ok, missing, cannot_verify) and the sorted ``missing`` privileges."""
    lacking = F.array_sort(F.array_except("required", "privileges"))
    status = (
        F.when(F.col("owner").eqNullSafe(me), "owner")
        .when(F.col("privileges").isNull(), "cannot_verify")
        .when(F.array_contains("privileges", "ALL PRIVILEGES") | (F.size(lacking) == 0), "ok")
        .otherwise("missing")
    )
    return rows.withColumn("status", status).withColumn("missing", F.when(F.col("status") == "missing", lacking))


def catalog_securables(catalogs: DataFrame) -> DataFrame:
    return catalogs.filter(~F.coalesce(F.col("catalog_type").isin(UNLISTED_CATALOG_KINDS), F.lit(False))).select(
        F.lit("CATALOG").alias("kind"),
        F.col("catalog").alias("securable"),
        F.array("catalog").alias("parts"),
        "owner",
        _texts(CATALOG_NEEDS).alias("required"),
    )


def schema_securables(schemas: DataFrame, catalogs: DataFrame) -> DataFrame:
    """User schemas; those in a managed catalog also need MANAGE."""
    managed = catalogs.filter(F.col("catalog_type") == "MANAGED_CATALOG").select("catalog", F.lit(True).alias("_managed"))
    needs = F.when(F.col("_managed"), _texts(MANAGED_CATALOG_SCHEMA_NEEDS)).otherwise(_texts(SCHEMA_NEEDS))
    return (
        user_schemas(schemas)
        .join(managed, "catalog", "left")
        .select(
            F.lit("SCHEMA").alias("kind"),
            F.concat_ws(".", "catalog", "schema").alias("securable"),
            F.array("catalog", "schema").alias("parts"),
            "owner",
            needs.alias("required"),
        )
    )


def location_securables(locations: DataFrame, *, new: str) -> DataFrame:
    """External locations whose URL contains the account part of ``new``."""
    return locations.filter(F.col("url").contains(new.split("/")[0])).select(
        F.lit("EXTERNAL LOCATION").alias("kind"),
        F.col("name").alias("securable"),
        F.array("name").alias("parts"),
        "owner",
        _texts(LOCATION_NEEDS).alias("required"),
    )


def audit(securables: DataFrame, grants: DataFrame, *, me: str, groups: Sequence[str] = (), unreadable: DataFrame | None = None) -> DataFrame:
    """Held, missing and verdict per securable of any kind."""
    return missing_privileges(held_privileges(securables, grants, me=me, groups=groups, unreadable=unreadable), me=me)


def has_location(locations: DataFrame, *, new: str) -> DataFrame:
    """One row: whether any external location covers the new account. None is a deficit."""
    return locations.agg((F.count_if(F.col("url").contains(new.split("/")[0])) > 0).alias("has_location"))


def tables_not_owned(tables: DataFrame, *, me: str) -> DataFrame:
    """Tables per foreign owner, most first; a table without an owner is not counted under one."""
    return (
        tables.filter((F.col("object_type") == "TABLE") & F.col("owner").isNotNull() & (F.col("owner") != me))
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("tables"))
        .orderBy(F.desc("tables"), F.asc("owner"))
    )


def suggested_grants(audited: DataFrame, *, me: str) -> DataFrame:
    """One GRANT statement per securable with missing privileges."""
    name = F.array_join(F.transform("parts", quote_ident), ".")
    statement = F.concat(
        F.lit("GRANT "), F.array_join("missing", ", "), F.lit(" ON "), "kind", F.lit(" "), name, F.lit(" TO "), quote_ident(F.lit(me)), F.lit(";")
    )
    return audited.filter(F.col("status") == "missing").select("kind", "securable", statement.alias("statement"))


def managed_volumes_in_scope(inventory: DataFrame) -> DataFrame:
    found = F.count_if((F.col("object_type") == "VOLUME") & (F.col("table_type") == "MANAGED")) > 0
    return inventory.agg(found.alias("managed_volumes"))
