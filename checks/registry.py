"""Registered queries with their oracle texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.derived import NEW, OLD, derive, with_inputs
from estate.operators import inventory as inv
from estate.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BUILDS: dict[str, Callable[["Inputs"], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-01-01"


def query(name: str, oracle: str | None = None):
    """Register a query under a name; without an oracle text only its rows are checked."""

    def register(build: Callable[["Inputs"], DataFrame]):
        BUILDS[name] = build
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_inputs(oracle, SHARED)
        return build

    return register


class Inputs:
    """Derived inputs of one scale-factor folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        return derive(self.spark, self.sf_dir, name, self._made)

    def inventory(self) -> DataFrame:
        """The objects with parent location, class and pipeline flag."""
        rows = inv.attach_parent_location(self("objects"), self("catalogs"), self("schemas"))
        return inv.flag_pipeline_handling(inv.classify(rows, old=OLD, new=NEW))


class StoredInputs(Inputs):
    """Inputs that are written once and read from there, so that their derivation is not timed."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._stored: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._stored:
            path = scratch_path(self.spark, f"input-{name}")
            super().__call__(name).write.parquet(path)
            self._stored[name] = self.spark.read.parquet(path)
        return self._stored[name]


# --- oracle building blocks, in DuckDB's SQL ---

ABFSS_RE = r"^abfss://([^@]+)@([^.]+)\.dfs\.core\.windows\.net(/(.*))?$"
S3_RE = r"^s3[an]?://([a-z0-9][a-z0-9.-]{1,61}[a-z0-9])(/(.*))?$"


def part(url: str, pattern: str, group: int) -> str:
    return f"regexp_extract({url}, '{pattern}', {group}, 'i')"


def account(url: str) -> str:
    return f"lower(coalesce(nullif({part(url, ABFSS_RE, 2)}, ''), nullif({part(url, S3_RE, 1)}, '')))"


def class_by_account(url: str, old: str = OLD, new: str = NEW) -> str:
    return (
        f"CASE WHEN {account(url)} IS NULL THEN 'unknown' WHEN {account(url)} = '{old}' THEN 'old' "
        f"WHEN {account(url)} = '{new}' THEN 'new' ELSE 'other' END"
    )


def path_text(url: str) -> str:
    """account/container/path or bucket/path without trailing slashes."""
    return (
        f"rtrim(CASE WHEN {part(url, ABFSS_RE, 2)} <> '' THEN lower({part(url, ABFSS_RE, 2)}) || '/' || {part(url, ABFSS_RE, 1)} || '/' || {part(url, ABFSS_RE, 4)} "
        f"WHEN {part(url, S3_RE, 1)} <> '' THEN lower({part(url, S3_RE, 1)}) || '/' || {part(url, S3_RE, 3)} END, '/')"
    )


def under(text: str, prefix: str) -> str:
    return f"({text} = '{prefix}' OR starts_with({text}, '{prefix}/'))"


def quoted(*parts: str) -> str:
    return " || '.' || ".join(f"'`' || replace({p}, '`', '``') || '`'" for p in parts)


KEYS = "catalog, schema, name, object_type"
SAME = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in KEYS.split(", "))
CLASSES = "consistent_old consistent_new drift_managed_on_old external_on_old external_on_new unknown_account path_missing".split()

SHARED = {
    "parented": """
SELECT o.*, coalesce(nullif(s.storage_root, ''), nullif(c.storage_root, '')) AS parent_managed_location
FROM {objects} o LEFT JOIN {schemas} s ON s.catalog = o.catalog AND s.schema = o.schema LEFT JOIN {catalogs} c ON c.catalog = o.catalog""",
    "located": f"""
SELECT *, {class_by_account('storage_path')} AS own, {class_by_account('parent_managed_location')} AS parent FROM {{parented}}""",
    "inv": """
SELECT * EXCLUDE (own, parent),
  object_type = 'TABLE' AND table_type IS NOT NULL AND table_type IN ('MATERIALIZED_VIEW', 'STREAMING_TABLE') AS requires_pipeline_handling,
  CASE WHEN object_type IN ('REGISTERED_MODEL', 'FUNCTION') THEN 'requires_external_handling'
       WHEN storage_path IS NULL OR table_type = 'VIEW' THEN 'path_missing'
       WHEN own = 'other' THEN 'unknown_account'
       WHEN table_type IN ('MANAGED', 'MATERIALIZED_VIEW', 'STREAMING_TABLE') THEN
         CASE own || ',' || parent WHEN 'old,old' THEN 'consistent_old' WHEN 'new,new' THEN 'consistent_new'
           WHEN 'new,old' THEN 'consistent_new' WHEN 'old,new' THEN 'drift_managed_on_old' ELSE 'unknown_account' END
       WHEN own = 'old' THEN 'external_on_old' WHEN own = 'new' THEN 'external_on_new' ELSE 'unknown_account' END AS classification
FROM {located}""",
}
