"""Shared column lists and fixed values."""

from __future__ import annotations

# An object is identified by all four columns: a table and a volume may share a name.
KEY = ["catalog", "schema", "name", "object_type"]

# The vocabulary of the stored tables.
CLASSES = [
    "consistent_old",
    "consistent_new",
    "drift_managed_on_old",
    "external_on_old",
    "external_on_new",
    "unknown_account",
    "path_missing",
]
EXTERNAL_HANDLING = "requires_external_handling"
MANAGED_TABLE_TYPES = ["MANAGED", "MATERIALIZED_VIEW", "STREAMING_TABLE"]
PIPELINE_TABLE_TYPES = ["MATERIALIZED_VIEW", "STREAMING_TABLE"]
CATALOG_LEVEL_OBJECTS = ["REGISTERED_MODEL", "FUNCTION"]
UNLISTED_CATALOG_KINDS = ["FOREIGN_CATALOG", "DELTASHARING_CATALOG", "SYSTEM_CATALOG"]
INHERITED_FROM = ["CATALOG", "SCHEMA", "METASTORE"]
SHADOW_SUFFIX = "__pre_migration"
STAGING_SUFFIX = "__migrate_staging"
GIB = 1024**3
