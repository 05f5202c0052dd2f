"""Inventory: listings, parents, classes, sizes."""

from pyspark.sql import functions as F

from checks.registry import AS_OF, KEYS, SAME, query
from estate.operators import inventory as inv
from estate.session import scratch_path
from estate.settings import KEY
from estate.sources import tables


def _listing(inputs, object_type):
    """One kind's listing under the names the catalog gives it."""
    rows = inputs("objects").filter(F.col("object_type") == object_type)
    prefix = {"TABLE": "table", "VOLUME": "volume", "REGISTERED_MODEL": "model", "FUNCTION": "routine"}[object_type]
    renamed = {"catalog": f"{prefix}_catalog", "schema": f"{prefix}_schema", "name": f"{prefix}_name", "created_at": "created"}
    if object_type == "VOLUME":
        renamed |= {"table_type": "volume_type", "storage_path": "storage_location", "owner": "volume_owner"}
    return rows.withColumnsRenamed(renamed).drop("object_type", "k", "size_bytes")


def _union(inputs):
    return inv.union_listings(*[_listing(inputs, t) for t in ("TABLE", "VOLUME", "REGISTERED_MODEL", "FUNCTION")])


@query(
    "union_listings",
    """SELECT catalog, schema, name, object_type, CASE WHEN object_type IN ('TABLE', 'VOLUME') THEN table_type END AS table_type, data_source_format,
  owner, created_at, CAST(NULL AS TIMESTAMP) AS last_altered, storage_path FROM {objects}""",
)
def _(inputs):
    return _union(inputs).withColumn("created_at", F.col("created_at").cast("timestamp_ntz")).withColumn(
        "last_altered", F.col("last_altered").cast("timestamp_ntz")
    )


@query("catalog_allow_list", "SELECT catalog, schema, name FROM {objects} WHERE catalog IN ('ASIA', 'EUROPE')")
def _(inputs):
    return inv.keep_catalogs(_union(inputs), ["ASIA", "EUROPE"]).select("catalog", "schema", "name")


@query(
    "catalog_kind_exclusion",
    """SELECT s.catalog, s.schema, s.owner FROM {wide_schemas} s WHERE NOT EXISTS (SELECT 1 FROM {wide_catalogs} c WHERE c.catalog = s.catalog
  AND c.catalog_type IN ('FOREIGN_CATALOG', 'DELTASHARING_CATALOG', 'SYSTEM_CATALOG'))""",
)
def _(inputs):
    return inv.drop_catalog_kinds(inputs("wide_schemas"), inputs("wide_catalogs")).select("catalog", "schema", "owner")


@query("parent_managed_location", "SELECT k, parent_managed_location FROM {parented}")
def _(inputs):
    return inv.attach_parent_location(inputs("objects"), inputs("catalogs"), inputs("schemas")).select("k", "parent_managed_location")


@query(
    "object_counts",
    f"""SELECT o.k, t.n AS tag_count, g.n AS grant_count FROM {{objects}} o
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{tags}} GROUP BY ALL) t ON {SAME('o', 't')} AND o.object_type = 'TABLE'
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{grants}} GROUP BY ALL) g ON {SAME('o', 'g')} AND o.object_type = 'TABLE'""",
)
def _(inputs):
    return inv.attach_counts(inputs("objects"), inputs("tags"), inputs("grants")).select("k", "tag_count", "grant_count")


@query("classify_object", "SELECT k, classification FROM {inv}")
def _(inputs):
    return inputs.inventory().select("k", "classification")


@query("requires_pipeline_handling", "SELECT k, requires_pipeline_handling FROM {inv}")
def _(inputs):
    return inv.flag_pipeline_handling(inputs("objects")).select("k", "requires_pipeline_handling")


_SIZED = f"""SELECT o.k, o.catalog, o.schema, o.name, o.data_source_format,
  CASE WHEN o.table_type IN ('MATERIALIZED_VIEW', 'STREAMING_TABLE') THEN o.table_type || ': size is in the backing table'
       WHEN upper(coalesce(o.data_source_format, '')) NOT IN ('', 'DELTA') AND coalesce(o.table_type, '') NOT IN ('MANAGED', 'EXTERNAL')
         THEN 'non-Delta format: ' || upper(o.data_source_format)
       WHEN s.error IS NOT NULL THEN s.error WHEN s.name IS NULL THEN 'no size row' WHEN s.size_bytes IS NULL THEN 'size is null' END AS skip_reason,
  s.size_bytes AS found
FROM {{objects}} o LEFT JOIN {{sizes}} s ON {SAME('o', 's')} WHERE o.object_type = 'TABLE'"""


def _sized(inputs):
    listed = inputs("objects").filter(F.col("object_type") == "TABLE").drop("size_bytes")
    return inv.attach_table_sizes(listed, inputs("sizes"))


@query("table_sizes", f"SELECT k, skip_reason, CASE WHEN skip_reason IS NULL THEN found END AS size_bytes FROM ({_SIZED})")
def _(inputs):
    return _sized(inputs).select("k", "skip_reason", "size_bytes")


@query(
    "volume_sizes",
    """SELECT source || '/' || lang AS volume, count(*) AS file_count, max(CASE WHEN doc_id % 97 = 5 THEN 'AccessError' END) AS skip_reason,
  CASE WHEN count(*) FILTER (WHERE doc_id % 97 = 5) = 0 THEN CAST(sum(n_chars) AS BIGINT) END AS size_bytes FROM {documents} GROUP BY source, lang""",
)
def _(inputs):
    failed = F.when(F.col("doc_id") % 97 == 5, "AccessError").alias("error")
    files = inputs("documents").select(F.concat_ws("/", "source", "lang").alias("volume"), F.col("n_chars").alias("size"), failed)
    return inv.volume_sizes(files, keys=["volume"])


@query(
    "skip_reason_summary",
    f"""SELECT split_part(skip_reason, ':', 1) AS reason, count(*) AS objects,
  (SELECT count(*) FILTER (WHERE skip_reason IS NULL AND found IS NOT NULL) FROM ({_SIZED})) AS sized, (SELECT count(*) FROM ({_SIZED})) AS total
FROM ({_SIZED}) WHERE skip_reason IS NOT NULL GROUP BY 1 ORDER BY objects DESC, reason LIMIT 5""",
)
def _(inputs):
    return inv.skip_reason_summary(_sized(inputs))


@query(
    "skipped_examples",
    f"""SELECT catalog || '.' || schema || '.' || name AS full_name, coalesce(data_source_format, '(null)') AS data_source_format, skip_reason
FROM ({_SIZED}) WHERE skip_reason IS NOT NULL ORDER BY catalog, schema, name LIMIT 5""",
)
def _(inputs):
    return inv.skipped_examples(_sized(inputs))




@query(
    "write_inventory",
    "SELECT catalog, schema, name, object_type, classification, requires_pipeline_handling, size_bytes, CAST(NULL AS BIGINT) AS tag_count, TIMESTAMP '2001-01-01' AS captured_at FROM {inv}",
)
def _(inputs):
    path = scratch_path(inputs.spark, "inventory")
    tables.write_inventory(inputs.inventory(), path, captured_at=AS_OF)
    return inputs.spark.read.parquet(path).select(
        *KEY, "classification", "requires_pipeline_handling", "size_bytes", "tag_count", F.col("captured_at").cast("timestamp_ntz").alias("captured_at")
    )


@query(
    "write_external_locations",
    "SELECT name, url, credential_name, read_only, region, CAST(NULL AS VARCHAR) AS isolation_mode, CAST(NULL AS BOOLEAN) AS accessible_in_current_workspace FROM {locations}",
)
def _(inputs):
    path = scratch_path(inputs.spark, "locations")
    tables.write_external_locations(inputs("locations"), path)
    return inputs.spark.read.parquet(path)


@query(
    "user_schemas",
    "SELECT catalog, schema FROM {wide_schemas} WHERE schema NOT IN ('information_schema', 'default', 'ops') AND NOT starts_with(schema, '_')",
)
def _(inputs):
    return inv.user_schemas(inputs("wide_schemas"), ops_schema="main.ops").select("catalog", "schema")


@query(
    "repoint_plan",
    """SELECT catalog, schema, storage_root AS current_root, 'abfss://lake@newacct.dfs.core.windows.net/root/' || schema AS target_root
FROM {wide_schemas} WHERE catalog = 'cat2' AND schema NOT IN ('information_schema', 'default', 'ops') AND NOT starts_with(schema, '_')""",
)
def _(inputs):
    schemas = inv.user_schemas(inputs("wide_schemas"), catalog="cat2", ops_schema="main.ops")
    return inv.repoint_plan(schemas, prefix="abfss://lake@newacct.dfs.core.windows.net/root//")
