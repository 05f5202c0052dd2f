"""Inputs derived from the driver's tables.

Each text is one SELECT that both Spark and DuckDB accept; ``{name}`` stands for a driver table or
another derived input. The catalog listings, grants, logs and file listings of an estate do not
exist in the tables, so they are computed from key arithmetic and grow with them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

OLD, NEW = "oldacct", "newacct"
TABLES = "region nation customer supplier part orders lineitem events documents labels benchmark pages conversations embeddings".split()

# Object key of order row ``k``; the same arithmetic names it in every input.
OBJECT_TYPE = """CASE WHEN {k} % 10 = 8 THEN 'VOLUME' WHEN {k} % 20 = 9 THEN 'REGISTERED_MODEL'
  WHEN {k} % 20 = 19 THEN 'FUNCTION' ELSE 'TABLE' END"""

TEXTS: dict[str, str] = {}


# The one difference between the engines: EACH(1, 2) repeats a row once per value.
_EACH = re.compile(r"EACH\(([^)]*)\)")


def _repeated(source: str, name: str, values) -> str:
    return f"(SELECT *, EACH({', '.join(str(v) for v in values)}) AS {name} FROM {source})"


TEXTS["catalogs"] = """
SELECT r_name AS catalog, CASE WHEN r_regionkey = 4 THEN 'FOREIGN_CATALOG' ELSE 'MANAGED_CATALOG' END AS catalog_type,
  concat('abfss://lake@', CASE WHEN r_regionkey % 2 = 0 THEN 'newacct' ELSE 'OldAcct' END,
         '.dfs.core.windows.net/', lower(r_name)) AS storage_root,
  concat('owner', r_regionkey % 3) AS owner
FROM {region}"""

TEXTS["schemas"] = """
SELECT r_name AS catalog, n_name AS schema,
  CASE WHEN n_nationkey % 3 = 0 THEN NULL
       WHEN n_nationkey % 3 = 1 THEN concat('abfss://lake@oldacct.dfs.core.windows.net/', lower(n_name))
       ELSE concat('s3://newacct/', lower(n_name)) END AS storage_root,
  concat('owner', n_nationkey % 4) AS owner
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

TEXTS["objects"] = """
SELECT o_orderkey AS k, r_name AS catalog, n_name AS schema, concat('t', o_orderkey) AS name,
  """ + OBJECT_TYPE.replace("{k}", "o_orderkey") + """ AS object_type,
  CASE WHEN o_orderkey % 10 <= 2 THEN 'MANAGED' WHEN o_orderkey % 10 <= 4 THEN 'EXTERNAL' WHEN o_orderkey % 10 = 5 THEN 'VIEW'
       WHEN o_orderkey % 10 = 6 THEN 'MATERIALIZED_VIEW' WHEN o_orderkey % 10 = 7 THEN 'STREAMING_TABLE'
       WHEN o_orderkey % 20 = 8 THEN 'MANAGED' WHEN o_orderkey % 20 = 18 THEN 'EXTERNAL' ELSE NULL END AS table_type,
  CASE WHEN o_orderkey % 30 = 0 THEN 'ICEBERG' WHEN o_orderkey % 20 = 3 THEN 'PARQUET'
       WHEN o_orderkey % 10 <= 4 THEN 'DELTA' ELSE NULL END AS data_source_format,
  CASE WHEN o_orderkey % 10 IN (5, 9) OR o_orderkey % 11 = 0 THEN NULL
       WHEN o_orderkey % 11 = 1 THEN concat('abfss://lake@third.dfs.core.windows.net/t', o_orderkey)
       WHEN o_orderkey % 11 <= 4 THEN concat('abfss://lake@oldacct.dfs.core.windows.net/Dir/t', o_orderkey)
       WHEN o_orderkey % 11 = 5 THEN concat('ABFSS://Lake@OLDACCT.dfs.core.windows.net/t', o_orderkey)
       WHEN o_orderkey % 11 <= 7 THEN concat('abfss://lake@newacct.dfs.core.windows.net/t', o_orderkey)
       WHEN o_orderkey % 11 = 8 THEN concat('s3a://newacct/t', o_orderkey)
       WHEN o_orderkey % 11 = 9 THEN concat('s3://oldacct/t', o_orderkey)
       ELSE concat('file:///tmp/t', o_orderkey) END AS storage_path,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('owner', o_custkey % 6) END AS owner,
  o_orderdate AS created_at,
  CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 10 = 9 THEN NULL
       ELSE CAST(round(o_totalprice * 100) AS BIGINT) * 1024 END AS size_bytes
FROM {orders} JOIN {nation} ON n_nationkey = o_custkey % 25 JOIN {region} ON r_regionkey = n_regionkey"""

# URLs of every accepted and refused form, for the column expressions.
TEXTS["urls"] = """
SELECT o_orderkey AS k, CASE o_orderkey % 17
  WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('s3://Shared/old/T', o_orderkey) WHEN 3 THEN concat('s3a://shared/NEW/T', o_orderkey, '//')
  WHEN 4 THEN concat('s3n://shared/older/t', o_orderkey) WHEN 5 THEN 'S3://my.bucket-1' WHEN 6 THEN concat('s3://ab/t', o_orderkey)
  WHEN 7 THEN concat('s3://my_bucket/t', o_orderkey) WHEN 8 THEN concat('ABFSS://Lake@OldAcct.DFS.core.windows.net/Dir/T', o_orderkey)
  WHEN 9 THEN 'abfss://lake@newacct.dfs.core.windows.net' WHEN 10 THEN concat('abfss://@newacct.dfs.core.windows.net/t', o_orderkey)
  WHEN 11 THEN concat('https://host/t', o_orderkey) WHEN 12 THEN 's3://shared/Old/' WHEN 13 THEN concat('abfss://old@shared.dfs.core.windows.net/T', o_orderkey)
  WHEN 14 THEN concat('s3://oldacct/t', o_orderkey, '/') WHEN 15 THEN concat('abfss://lake@third.dfs.core.windows.net/a@b/t', o_orderkey)
  ELSE concat('S3A://NewAcct/T', o_orderkey) END AS url
FROM {orders}"""

# One catalog per supplier and one schema per customer: listings that grow with the tables.
TEXTS["wide_catalogs"] = """
SELECT concat('cat', s_suppkey) AS catalog,
  CASE WHEN s_suppkey % 5 = 4 THEN 'FOREIGN_CATALOG' WHEN s_suppkey % 11 = 7 THEN 'SYSTEM_CATALOG'
       WHEN s_suppkey % 7 = 3 THEN 'DELTASHARING_CATALOG' WHEN s_suppkey % 3 = 0 THEN 'HIVE' ELSE 'MANAGED_CATALOG' END AS catalog_type,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_suppkey % 6 = 5 THEN ''
       ELSE concat('abfss://lake@', CASE WHEN s_suppkey % 2 = 0 THEN 'NewAcct' ELSE 'oldacct' END,
                   '.dfs.core.windows.net/cat', s_suppkey) END AS storage_root,
  concat('owner', s_suppkey % 5) AS owner
FROM {supplier}"""

TEXTS["wide_schemas"] = """
SELECT concat('cat', c_custkey % (SELECT count(*) FROM {supplier})) AS catalog,
  CASE WHEN c_custkey % 17 = 1 THEN 'default' WHEN c_custkey % 17 = 2 THEN 'information_schema'
       WHEN c_custkey % 17 = 3 THEN concat('_sys', c_custkey) WHEN c_custkey % 17 = 4 THEN 'ops'
       ELSE concat('sch', c_custkey) END AS schema,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('s3://oldacct/sch', c_custkey) END AS storage_root,
  concat('owner', c_custkey % 5) AS owner
FROM {customer}"""

TEXTS["locations"] = """
SELECT s_suppkey AS pos, concat('loc', s_suppkey) AS name,
  CASE WHEN s_suppkey % 4 = 0 THEN concat('abfss://lake@newacct.dfs.core.windows.net/part', s_suppkey, '/')
       WHEN s_suppkey % 4 = 1 THEN concat('s3://newacct/part', s_suppkey % 10)
       WHEN s_suppkey % 4 = 2 THEN concat('abfss://lake@oldacct.dfs.core.windows.net/part', s_suppkey)
       ELSE concat('s3://newacct/part', s_suppkey % 10, '/sub', s_suppkey % 3) END AS url,
  concat('cred', s_suppkey % 9) AS credential_name,
  s_suppkey % 8 = 0 AS read_only,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN 'east' ELSE 'west' END AS region,
  concat('owner', s_suppkey % 5) AS owner
FROM {supplier}"""

TEXTS["lineage"] = """
SELECT concat('c.s.t', l_orderkey) AS source_table_full_name, concat('c.s.t', l_partkey) AS target_table_full_name,
  src.catalog AS source_table_catalog, src.schema AS source_table_schema, concat('t', l_orderkey) AS source_table_name,
  tgt.catalog AS target_table_catalog, tgt.schema AS target_table_schema, concat('t', l_partkey) AS target_table_name,
  l_shipdate AS event_time, l_returnflag AS entity_type, l_suppkey AS entity_id
FROM {lineitem} LEFT JOIN {objects} src ON src.k = l_orderkey LEFT JOIN {objects} tgt ON tgt.k = l_partkey"""

TEXTS["audit"] = """
SELECT event_id, ts AS event_time, concat('user', user_id, '@x.com') AS email,
  CASE event_type WHEN 'purchase' THEN 'writeTable' WHEN 'signup' THEN 'createTable' WHEN 'click' THEN 'updateTable'
    WHEN 'error' THEN 'mergeTable' ELSE 'getTable' END AS action_name,
  concat(o.catalog, '.', o.schema, '.', o.name) AS full_name
FROM (SELECT *, event_id % (SELECT count(*) FROM {orders}) AS object_no FROM {events}) e JOIN {objects} o ON o.k = e.object_no"""

# Two grants per customer; the object is the order of the same number.
TEXTS["grants"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, c_custkey AS k, concat('p', (c_custkey + sh * 7) % 20) AS principal,
  CASE (c_custkey + sh) % 4 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'MODIFY' WHEN 2 THEN 'ALL PRIVILEGES' ELSE 'READ VOLUME' END AS privilege,
  CASE (c_custkey + sh * 2) % 5 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VOLUME' WHEN 2 THEN 'SCHEMA' WHEN 3 THEN 'CATALOG' ELSE 'METASTORE' END AS granted_on
FROM """ + _repeated("{customer}", "sh", (0, 1)) + """ c JOIN {objects} o ON o.k = c_custkey"""

TEXTS["live_grants"] = """
SELECT catalog, schema, name, object_type, k, principal, privilege,
  CASE WHEN granted_on IN ('SCHEMA', 'CATALOG', 'METASTORE') AND k % 3 = 0
       THEN CASE WHEN object_type = 'VOLUME' THEN 'VOLUME' ELSE 'TABLE' END ELSE granted_on END AS granted_on
FROM {grants} WHERE k % 7 <> 0"""

# Grants on catalogs, schemas and locations, for the permission audit.
TEXTS["securable_grants"] = """
SELECT 'CATALOG' AS kind, concat('cat', s_suppkey) AS securable, concat('p', (s_suppkey + sh) % 4) AS principal,
  CASE WHEN s_suppkey % 9 = 1 THEN 'ALL PRIVILEGES' WHEN sh % 2 = 0 THEN 'USE CATALOG' ELSE 'CREATE SCHEMA' END AS privilege
FROM """ + _repeated("{supplier}", "sh", (0, 1, 2)) + """ x
UNION ALL
SELECT 'SCHEMA' AS kind, concat(catalog, '.', schema) AS securable, concat('p', c_custkey % 4) AS principal,
  CASE c_custkey % 5 WHEN 0 THEN 'USE SCHEMA' WHEN 1 THEN 'CREATE TABLE' WHEN 2 THEN 'MANAGE' WHEN 3 THEN '' ELSE 'ALL PRIVILEGES' END AS privilege
FROM (SELECT c_custkey, concat('cat', c_custkey % (SELECT count(*) FROM {supplier})) AS catalog,
        CASE WHEN c_custkey % 17 = 1 THEN 'default' WHEN c_custkey % 17 = 2 THEN 'information_schema' WHEN c_custkey % 17 = 4 THEN 'ops'
             ELSE concat('sch', c_custkey) END AS schema FROM {customer}) s
UNION ALL
SELECT 'EXTERNAL LOCATION' AS kind, concat('loc', s_suppkey) AS securable, concat('p', (s_suppkey + sh) % 4) AS principal,
  CASE sh WHEN 0 THEN 'READ FILES' WHEN 1 THEN 'WRITE FILES' ELSE 'CREATE EXTERNAL TABLE' END AS privilege
FROM """ + _repeated("{supplier}", "sh", (0, 1, 2)) + """ x"""

TEXTS["unreadable_securables"] = """
SELECT 'SCHEMA' AS kind, concat(catalog, '.', schema) AS securable FROM {wide_schemas} WHERE length(schema) % 7 = 0
UNION ALL
SELECT 'CATALOG' AS kind, catalog AS securable FROM {wide_catalogs} WHERE length(catalog) % 6 = 0 AND owner = 'owner2'"""

# Groups in groups: g<n> is in g<n / 2>, some are in a principal, and there are cycles.
TEXTS["memberships"] = """
SELECT concat('g', s_suppkey) AS member, concat('g', CAST(floor(s_suppkey / 2) AS BIGINT)) AS parent FROM {supplier}
UNION ALL SELECT concat('user', s_suppkey % 3) AS member, concat('g', s_suppkey) AS parent FROM {supplier} WHERE s_suppkey % 7 = 1
UNION ALL SELECT concat('g', s_suppkey) AS member, concat('p', s_suppkey) AS parent FROM {supplier} WHERE s_suppkey IN (1, 2)
UNION ALL SELECT 'g1' AS member, concat('g', s_suppkey) AS parent FROM {supplier} WHERE s_suppkey = 5"""

TEXTS["tags"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, concat('tag', p_size % 7) AS tag_name, concat('it''s ', p_size) AS tag_value
FROM (SELECT *, p_partkey % (SELECT count(*) FROM {orders}) AS object_no FROM {part}) p
JOIN {objects} o ON o.k = p.object_no"""

TEXTS["sizes"] = """
SELECT catalog, schema, name, object_type, size_bytes,
  CASE WHEN k % 23 = 0 THEN concat('AccessError: t', k % 3) ELSE NULL END AS error
FROM {objects} WHERE object_type = 'TABLE' AND k % 19 <> 0"""

# Describe rows of the orders' tables: a column named Location on some, then the detail part.
_DESCRIBE_LABELS = ["id", "Location", "", "# Detailed Table Information", "Comment", "Location", "Owner", "Location"]
TEXTS["described"] = """
SELECT catalog, schema, name, object_type, 0 AS pos, 'owner' AS col_name, 'string' AS data_type, NULL AS comment FROM {objects} WHERE object_type = 'TABLE' AND k % 9 = 4
UNION ALL
SELECT catalog, schema, name, object_type, pos,
  CASE pos """ + " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(_DESCRIBE_LABELS, 1)) + """ END AS col_name,
  CASE pos WHEN 1 THEN 'bigint' WHEN 2 THEN 'string' WHEN 5 THEN concat('note ', k)
    WHEN 6 THEN CASE WHEN k % 4 = 0 THEN '' ELSE concat('s3://newacct/described/t', k) END
    WHEN 7 THEN concat('owner', k % 6) WHEN 8 THEN 'late' ELSE NULL END AS data_type,
  CASE WHEN pos = 1 AND k % 3 = 0 THEN concat('key of ', k) WHEN pos = 2 AND k % 5 = 0 THEN 'text' ELSE NULL END AS comment
FROM """ + _repeated("{objects}", "pos", range(1, 9)) + """ o
WHERE object_type = 'TABLE' AND k % 7 <> 3 AND (pos <> 5 OR k % 4 <> 1) AND (pos <> 8 OR k % 2 = 0)"""

TEXTS["filters"] = """
SELECT catalog, schema, name, object_type, k % 2 AS pos,
  CASE WHEN k % 2 = 0 THEN concat('ops.f', k % 5) ELSE NULL END AS filter_name, concat('ops.g', k % 5) AS function_name,
  CASE k % 3 WHEN 0 THEN ' a, b ,,c' WHEN 1 THEN 'id' ELSE NULL END AS using_columns
FROM {objects} WHERE object_type = 'TABLE' AND k % 6 = 1 OR object_type = 'TABLE' AND k % 6 = 4"""

TEXTS["masks"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, concat('col', l_linenumber) AS column_name, concat('ops.m', l_suppkey % 4) AS function_name,
  CASE WHEN l_suppkey % 2 = 0 THEN concat('id, x', l_linenumber, ', ') ELSE NULL END AS using_columns
FROM {lineitem} l
JOIN {objects} o ON o.k = l_orderkey WHERE o.object_type = 'TABLE'"""

TEXTS["properties"] = """
SELECT catalog, schema, name, object_type, CASE m WHEN 0 THEN 'delta.minReader' WHEN 1 THEN 'quality' ELSE 'team' END AS key,
  concat(CASE m WHEN 0 THEN '1' WHEN 1 THEN 'it''s ' ELSE 'x' END, k % 9) AS value
FROM """ + _repeated("{objects}", "m", (0, 1, 2)) + """ o
WHERE object_type = 'TABLE' AND k % 3 <> m"""

# What is listed now: the live name, the shadow and the staging copy by the bits of k % 8.
TEXTS["listing"] = """
SELECT catalog, schema, name, object_type, k % 41 <> 7 AS readable FROM {objects} WHERE k % 8 IN (1, 3, 5, 7)
UNION ALL SELECT catalog, schema, concat(name, '__pre_migration') AS name, object_type, k % 43 <> 3 AS readable FROM {objects} WHERE k % 8 IN (2, 3, 6, 7)
UNION ALL SELECT catalog, schema, concat(name, '__migrate_staging') AS name, object_type, TRUE AS readable FROM {objects} WHERE k % 8 IN (4, 5, 6, 7)"""

TEXTS["log"] = """
SELECT catalog, schema, name, object_type, k,
  CASE k % 9 WHEN 0 THEN 'claimed' WHEN 1 THEN 'snapshot_taken' WHEN 2 THEN 'cloned' WHEN 3 THEN 'swapped' WHEN 4 THEN 'replayed'
    WHEN 5 THEN 'validated' WHEN 6 THEN 'failed' WHEN 7 THEN 'rollback_failed' ELSE 'rolled_back' END AS status,
  concat('runner', k % 3) AS claimed_by, created_at AS claimed_at,
  CASE WHEN k % 9 = 5 THEN concat(catalog, '.`', schema, '`.', name, '__pre_migration') ELSE NULL END AS pre_migration_fqn
FROM {objects} WHERE k % 5 <> 0"""

# The log as its events: what each object went through before its current row.
TEXTS["history"] = """
SELECT catalog, schema, name, object_type, k, status, claimed_by, claimed_at, pre_migration_fqn, TIMESTAMP '1999-01-01 00:00:00' AS updated_at FROM {log}
UNION ALL SELECT catalog, schema, name, object_type, k, 'failed' AS status, claimed_by, claimed_at, NULL AS pre_migration_fqn, TIMESTAMP '1998-01-01 00:00:00' AS updated_at FROM {log} WHERE k % 2 = 0
UNION ALL SELECT catalog, schema, name, object_type, k, 'validated' AS status, claimed_by, claimed_at, concat(catalog, '.', schema, '.', name, '__pre_migration') AS pre_migration_fqn,
  TIMESTAMP '1998-06-01 00:00:00' AS updated_at FROM {log} WHERE k % 4 <> 1"""

# Events spread over the first objects: what the log says of each, mostly in order, and who writes to them meanwhile.
_TURN = "(SELECT CAST(floor(count(*) / 20) AS BIGINT) + 1 FROM {events})"
TEXTS["moves"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, e.updated_at, CASE WHEN event_id % 29 = 3 THEN NULL WHEN event_id % 13 = 5 THEN 'swapped'
  ELSE CASE e.step WHEN 0 THEN 'claimed' WHEN 1 THEN 'snapshot_taken' WHEN 2 THEN 'cloned' WHEN 3 THEN 'swapped' WHEN 4 THEN 'replayed' WHEN 5 THEN 'validated' ELSE 'rolled_back' END END AS status
FROM (SELECT event_id, ts AS updated_at, event_id % turn AS object_no, CAST(floor(event_id / turn) AS BIGINT) % 7 AS step FROM (SELECT *, """ + _TURN + """ AS turn FROM {events}) t) e
JOIN {objects} o ON o.k = e.object_no"""
TEXTS["table_writes"] = """
SELECT event_id, ts AS event_time, concat('user', user_id, '@x.com') AS email,
  CASE event_type WHEN 'purchase' THEN 'writeTable' WHEN 'click' THEN 'updateTable' WHEN 'error' THEN 'mergeTable' ELSE 'getTable' END AS action_name,
  concat(o.catalog, '.', o.schema, '.', o.name) AS full_name
FROM (SELECT *, (event_id * 7 + 3) % """ + _TURN + """ AS object_no FROM {events}) e JOIN {objects} o ON o.k = e.object_no"""

# The same log with malformed shadow names, for the fail-closed gate.
TEXTS["bad_log"] = """
SELECT catalog, schema, name, CASE WHEN k % 9 = 5 AND k % 7 = 0 THEN 'FUNCTION' ELSE object_type END AS object_type, k, status,
  CASE WHEN k % 9 <> 5 THEN NULL WHEN k % 13 = 1 THEN concat(catalog, '.', schema, '.', name)
       WHEN k % 13 = 2 THEN concat(schema, '.', name, '__pre_migration') WHEN k % 13 = 3 THEN concat('main.ops.', name, '__pre_migration')
       WHEN k % 13 = 4 THEN '' WHEN k % 13 = 5 THEN concat(catalog, '..', name, '__pre_migration')
       WHEN k % 13 = 6 THEN concat(catalog, '.', schema, '.__pre_migration') ELSE pre_migration_fqn END AS pre_migration_fqn
FROM {log}"""

# What views read: chains of views on views down to a table, and a pair that read each other.
TEXTS["dependencies"] = """
SELECT o.catalog || '.' || o.schema || '.' || o.name AS full_name, d.catalog || '.' || d.schema || '.' || d.name AS depends_on
FROM {objects} o JOIN {objects} d ON d.k = CASE WHEN o.k % 70 = 5 THEN o.k - 4 ELSE o.k - 10 END WHERE o.k % 10 = 5 AND o.k % 490 > 10
UNION ALL SELECT o.catalog || '.' || o.schema || '.' || o.name AS full_name, d.catalog || '.' || d.schema || '.' || d.name AS depends_on
FROM {objects} o JOIN {objects} d ON d.k = o.k + CASE WHEN o.k % 490 = 7 THEN 1 ELSE -1 END WHERE o.k % 490 IN (7, 8)"""

TEXTS["files"] = """
SELECT source AS volume, concat(lang, '/', doc_id, '.txt') AS relpath, n_chars AS size, md5(text) AS content_hash, doc_id FROM {documents}"""

TEXTS["copied_files"] = """
SELECT source AS volume, concat(lang, '/', doc_id, '.txt') AS relpath, CASE WHEN doc_id % 50 = 1 THEN n_chars + 1 ELSE n_chars END AS size,
  CASE WHEN doc_id % 50 = 3 THEN md5(concat(text, 'x')) ELSE md5(text) END AS content_hash, doc_id
FROM {documents} WHERE doc_id % 50 <> 0
UNION ALL SELECT source AS volume, concat('extra/', doc_id, '.txt') AS relpath, n_chars AS size, md5(text) AS content_hash, doc_id FROM {documents} WHERE doc_id % 50 = 2"""

# Entries below storage roots: one per line item, at the order's old and new place.
TEXTS["entries"] = """
SELECT concat('abfss://lake@oldacct.dfs.core.windows.net/Dir/t', l_orderkey) AS root, l_linenumber AS entry FROM {lineitem}
UNION ALL SELECT concat('abfss://lake@newacct.dfs.core.windows.net/Dir/t', l_orderkey) AS root, l_linenumber AS entry FROM {lineitem}
WHERE l_orderkey % 4 <> 0 AND (l_orderkey % 4 <> 1 OR l_linenumber > 2)
UNION ALL SELECT concat('s3://newacct/t', l_orderkey, '/_delta_log') AS root, l_linenumber AS entry FROM {lineitem} WHERE l_orderkey % 3 <> 0"""


# Where the objects of validated log rows are described to be after the move.
TEXTS["after"] = """
SELECT catalog, schema, name, object_type, k,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN concat('s3://oldacct/t', k) ELSE concat('s3://newacct/t', k, '/') END AS location
FROM {objects} WHERE k % 13 <> 5"""

# Distinct files each object's rows were read from.
TEXTS["read_paths"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, CASE WHEN l_linenumber = 7 AND o.k % 5 = 2 THEN 'file:///tmp/x'
  WHEN l_linenumber = 6 AND o.k % 3 = 0 THEN concat('s3a://oldacct/t', o.k) ELSE concat('s3a://NewAcct/t', o.k, '/part', l_linenumber) END AS path
FROM {lineitem} JOIN {objects} o ON o.k = l_orderkey"""

# Rows of every object's shadow and live copy.
TEXTS["shadow_rows"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, o.k, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM {lineitem} JOIN {objects} o ON o.k = l_orderkey"""
TEXTS["live_rows"] = """
SELECT catalog, schema, name, object_type, k, l_linenumber, CASE WHEN k % 13 = 1 AND l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag, l_shipdate
FROM {shadow_rows} WHERE k % 17 <> 2"""

# Files of the volumes: one document per file, spread over the objects that are volumes.
TEXTS["volume_files"] = """
SELECT o.catalog, o.schema, o.name, o.object_type, o.k, d.relpath, d.content_hash, d.doc_id
FROM (SELECT concat(lang, '/', doc_id) AS relpath, md5(text) AS content_hash, doc_id, 10 * (doc_id % 120) + 8 AS object_no FROM {documents}) d
JOIN {objects} o ON o.k = d.object_no"""
TEXTS["copied_volume_files"] = """
SELECT catalog, schema, name, object_type, k, relpath, CASE WHEN doc_id % 50 = 3 THEN md5(relpath) ELSE content_hash END AS content_hash, doc_id
FROM {volume_files} WHERE doc_id % 50 <> 0 AND k % 70 <> 8"""


def _inputs(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", TEXTS[name])))


def derive(spark: SparkSession, sf_dir: str, name: str, made: dict[str, DataFrame]) -> DataFrame:
    """A driver table or a derived input as a DataFrame; ``made`` keeps what is already defined."""
    if name not in made:
        if name in TEXTS:
            made[name] = spark.sql(_EACH.sub(r"explode(array(\1))", TEXTS[name]), **{part: derive(spark, sf_dir, part, made) for part in _inputs(name)})
        else:
            made[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return made[name]


def with_inputs(query: str, extra: dict[str, str] | None = None) -> str:
    """The oracle text of a query: its ``{name}`` inputs become CTEs, in order of need."""
    texts = TEXTS | (extra or {})
    ordered: list[str] = []

    def visit(text: str) -> None:
        for part in dict.fromkeys(re.findall(r"\{(\w+)\}", text)):
            if part in texts and part not in ordered:
                visit(texts[part])
                ordered.append(part)

    visit(query)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", _EACH.sub(r"unnest([\1])", text))
    ctes = ",\n".join(f"{name} AS ({plain(texts[name])}\n)" for name in ordered)
    body = plain(query).strip()
    return (f"WITH {ctes}\n{body}" if ctes else body)
