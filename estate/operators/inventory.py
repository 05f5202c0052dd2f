"""From catalog listings to a classified inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from estate.functions.text import dotted_name
from estate.functions.urls import url_class
from estate.operators.ranking import first_rows, top_rows
from estate.settings import (
    CATALOG_LEVEL_OBJECTS,
    EXTERNAL_HANDLING,
    KEY,
    MANAGED_TABLE_TYPES,
    PIPELINE_TABLE_TYPES,
    UNLISTED_CATALOG_KINDS,
)

# Each listing names its columns after its kind of object.
_PREFIXES = {"TABLE": "table", "VOLUME": "volume", "REGISTERED_MODEL": "model", "FUNCTION": "routine"}


def _common_shape(listing: DataFrame, object_type: str) -> DataFrame:
    prefix = _PREFIXES[object_type]
    typed = object_type in ("TABLE", "VOLUME")
    text = lambda name: (F.col(name) if name in listing.columns else F.lit(None)).cast("string")
    type_column = "volume_type" if object_type == "VOLUME" else "table_type"
    path_column = "storage_location" if object_type == "VOLUME" else "storage_path"
    stamp = lambda name: (F.col(name) if name in listing.columns else F.lit(None)).cast("timestamp")
    return listing.select(
        text(f"{prefix}_catalog").alias("catalog"),
        text(f"{prefix}_schema").alias("schema"),
        text(f"{prefix}_name").alias("name"),
        F.lit(object_type).alias("object_type"),
        (text(type_column) if typed else F.lit(None).cast("string")).alias("table_type"),
        text("data_source_format").alias("data_source_format"),
        text(f"{prefix}_owner").alias("owner") if f"{prefix}_owner" in listing.columns else text("owner").alias("owner"),
        stamp("created").alias("created_at"),
        stamp("last_altered").alias("last_altered"),
        text(path_column).alias("storage_path"),
    )


def union_listings(
    tables: DataFrame,
    volumes: DataFrame | None = None,
    models: DataFrame | None = None,
    functions: DataFrame | None = None,
) -> DataFrame:
    """The four listings in one shape. A filter on ``catalog`` reaches every branch's scan."""
    rows = _common_shape(tables, "TABLE")
    for listing, object_type in ((volumes, "VOLUME"), (models, "REGISTERED_MODEL"), (functions, "FUNCTION")):
        if listing is not None:
            rows = rows.unionByName(_common_shape(listing, object_type))
    return rows


def keep_catalogs(objects: DataFrame, catalogs: Sequence[str], *, allow_all: bool = False) -> DataFrame:
    """Only the named catalogs; an empty list means all and must be allowed on purpose."""
    if catalogs:
        return objects.filter(F.col("catalog").isin(list(catalogs)))
    if not allow_all:
        raise ValueError("name the catalogs, or pass allow_all=True")
    return objects


def drop_catalog_kinds(rows: DataFrame, catalogs: DataFrame, kinds: Sequence[str] = tuple(UNLISTED_CATALOG_KINDS)) -> DataFrame:
    """Rows whose catalog is not of an excluded kind; rows of an unlisted catalog stay."""
    excluded = catalogs.filter(F.col("catalog_type").isin(list(kinds))).select("catalog")
    return rows.join(excluded, "catalog", "left_anti")


def attach_parent_location(objects: DataFrame, catalogs: DataFrame, schemas: DataFrame) -> DataFrame:
    """``parent_managed_location``: the schema's storage root, else the catalog's.

    Both lookups have one row per parent, so the object side never multiplies; Spark broadcasts
    them while they are small and otherwise splits hot parents in the shuffle join.
    """
    roots = (
        schemas.select("catalog", "schema", F.nullif("storage_root", F.lit("")).alias("schema_root"))
    )
    catalog_roots = catalogs.select("catalog", F.nullif("storage_root", F.lit("")).alias("catalog_root"))
    return (
        objects.join(roots, ["catalog", "schema"], "left")
        .join(catalog_roots, "catalog", "left")
        .withColumn("parent_managed_location", F.coalesce("schema_root", "catalog_root"))
        .drop("schema_root", "catalog_root")
    )


def attach_counts(objects: DataFrame, tags: DataFrame, grants: DataFrame) -> DataFrame:
    """``tag_count`` and ``grant_count`` of TABLE rows; no rows stays null, not 0.

    Rows with an ``object_type`` count for the table of their name only if they are a table's.
    """
    names = ["catalog", "schema", "name"]
    for rows, column in ((tags, "tag_count"), (grants, "grant_count")):
        if "object_type" in rows.columns:
            rows = rows.filter(F.upper("object_type") == "TABLE")
        counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias(column)).withColumn("object_type", F.lit("TABLE"))
        objects = objects.join(counts, KEY, "left")
    return objects


# Class by kind of object, class of its own path, class of its parent's location.
_CLASS_OF_PLACE = {
    "managed/old/old": "consistent_old",
    "managed/new/new": "consistent_new",
    "managed/new/old": "consistent_new",
    "managed/old/new": "drift_managed_on_old",
    "external/old": "external_on_old",
    "external/new": "external_on_new",
}


def classify(objects: DataFrame, *, old: str, new: str) -> DataFrame:
    """``classification`` from the object's own path and its parent's managed location.

    Places are looked up in one table, so a filter on the class carries one copy of each URL test.
    """
    own = url_class(F.col("storage_path"), old=old, new=new)
    parent = url_class(F.col("parent_managed_location"), old=old, new=new)
    managed = F.coalesce(F.col("table_type").isin(MANAGED_TABLE_TYPES), F.lit(False))
    place = F.concat_ws("/", F.when(managed, "managed").otherwise("external"), own, F.when(managed, parent))
    table = F.create_map(*[F.lit(cell) for pair in _CLASS_OF_PLACE.items() for cell in pair])
    label = (
        F.when(F.col("object_type").isin(CATALOG_LEVEL_OBJECTS), EXTERNAL_HANDLING)
        .when(F.col("storage_path").isNull() | F.col("table_type").eqNullSafe("VIEW"), "path_missing")
        .otherwise(F.coalesce(F.try_element_at(table, place), F.lit("unknown_account")))
    )
    return objects.withColumn("classification", label)


def flag_pipeline_handling(objects: DataFrame) -> DataFrame:
    """Tables kept by a pipeline: materialized views and streaming tables."""
    by_pipeline = (F.col("object_type") == "TABLE") & F.col("table_type").isin(PIPELINE_TABLE_TYPES)
    return objects.withColumn("requires_pipeline_handling", F.coalesce(by_pipeline, F.lit(False)))


def attach_table_sizes(objects: DataFrame, sizes: DataFrame, *, collect_sizes: bool = True) -> DataFrame:
    """``size_bytes`` and, where there is none, ``skip_reason``.

    ``sizes`` holds the key, ``size_bytes`` and ``error``. Off means null sizes without a reason.
    """
    if not collect_sizes:
        return objects.withColumn("size_bytes", F.lit(None).cast("long")).withColumn("skip_reason", F.lit(None).cast("string"))
    found = sizes.select(*KEY, F.col("size_bytes").alias("_size"), F.col("error").alias("_error"), F.lit(True).alias("_row"))
    fmt = F.upper(F.coalesce("data_source_format", F.lit("")))
    by_pipeline = F.coalesce(F.col("table_type").isin(PIPELINE_TABLE_TYPES), F.lit(False))
    plain = F.coalesce(F.col("table_type").isin("MANAGED", "EXTERNAL"), F.lit(False))
    reason = (
        F.when(by_pipeline, F.concat("table_type", F.lit(": size is in the backing table")))
        .when(~fmt.isin("", "DELTA") & ~plain, F.concat(F.lit("non-Delta format: "), fmt))
        .when(F.col("_error").isNotNull(), F.col("_error"))
        .when(F.col("_row").isNull(), "no size row")
        .when(F.col("_size").isNull(), "size is null")
    )
    return (
        objects.join(found, KEY, "left")
        .withColumn("skip_reason", reason)
        .withColumn("size_bytes", F.when(F.col("skip_reason").isNull(), F.col("_size")))
        .drop("_size", "_error", "_row")
    )


def volume_sizes(files: DataFrame, *, keys: Sequence[str] = ("catalog", "schema", "name")) -> DataFrame:
    """Bytes per volume from a file listing; null with the reason where the listing has an error row."""
    failed = F.max("error") if "error" in files.columns else F.lit(None).cast("string")
    rolled = files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("_bytes"),
        failed.alias("_error"),
    )
    return (
        rolled.withColumn("skip_reason", F.col("_error"))
        .withColumn("size_bytes", F.when(F.col("skip_reason").isNull(), F.col("_bytes")))
        .drop("_bytes", "_error")
    )


def skip_reason_summary(sized: DataFrame, *, top: int | None = 5) -> DataFrame:
    """The most frequent reasons (text before the first colon), with sized and total counts; all of them without ``top``."""
    totals = sized.agg(F.count("size_bytes").alias("sized"), F.count(F.lit(1)).alias("total"))
    counts = (
        sized.filter(F.col("skip_reason").isNotNull())
        .groupBy(F.substring_index("skip_reason", ":", 1).alias("reason"))
        .agg(F.count(F.lit(1)).alias("objects"))
    )
    return top_rows(counts, [F.desc("objects"), F.asc("reason")], top).select(
        "reason",
        "objects",
        totals.select("sized").scalar().alias("sized"),
        totals.select("total").scalar().alias("total"),
    )


def skipped_examples(sized: DataFrame, *, limit: int | None = 5) -> DataFrame:
    """The first skipped objects in key order, with their full reason."""
    skipped = sized.filter(F.col("skip_reason").isNotNull())
    return first_rows(skipped, KEY, limit).select(
        dotted_name("catalog", "schema", "name").alias("full_name"),
        F.coalesce("data_source_format", F.lit("(null)")).alias("data_source_format"),
        "skip_reason",
    )


def inventory_rows(objects: DataFrame, *, captured_at) -> DataFrame:
    """The stored shape of the inventory, stamped with the capture time."""
    typed = {
        "table_type": "string",
        "data_source_format": "string",
        "storage_path": "string",
        "parent_managed_location": "string",
        "owner": "string",
        "created_at": "timestamp",
        "last_altered": "timestamp",
        "requires_pipeline_handling": "boolean",
        "size_bytes": "long",
        "tag_count": "long",
        "grant_count": "long",
        "has_row_filter": "boolean",
        "has_column_mask": "boolean",
        "classification": "string",
    }
    columns = [F.col(k) for k in KEY]
    for name, kind in typed.items():
        value = F.col(name) if name in objects.columns else F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return objects.select(*columns, F.lit(captured_at).cast("timestamp").alias("captured_at"))


def user_schemas(schemas: DataFrame, *, catalog: str | None = None, ops_schema: str | None = None) -> DataFrame:
    """Schemas that people own: not the built-in ones, not ``_*``, not the tool's own."""
    rows = schemas if catalog is None else schemas.filter(F.col("catalog") == catalog)
    rows = rows.filter(~F.col("schema").isin("information_schema", "default") & ~F.col("schema").startswith("_"))
    if ops_schema and "." in ops_schema:
        rows = rows.filter(F.col("schema") != ops_schema.split(".", 1)[1])
    return rows


def repoint_plan(schemas: DataFrame, *, prefix: str) -> DataFrame:
    """Per schema the current storage root and the one below ``prefix``."""
    return schemas.select(
        "catalog",
        "schema",
        F.col("storage_root").alias("current_root"),
        F.concat(F.lit(prefix.rstrip("/") + "/"), "schema").alias("target_root"),
    )


def external_location_rows(locations: DataFrame) -> DataFrame:
    """The stored shape of the external-locations snapshot."""
    kinds = {
        "name": "string",
        "url": "string",
        "credential_name": "string",
        "read_only": "boolean",
        "region": "string",
        "isolation_mode": "string",
        "accessible_in_current_workspace": "boolean",
    }
    return locations.select(
        *[(F.col(c) if c in locations.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
    ).withColumn("read_only", F.coalesce("read_only", F.lit(False)))
