"""Permission audit."""

from pyspark.sql import functions as F

from checks.derived import NEW
from checks.registry import query
from estate.operators import access

ME, GROUPS = "p1", ["p2"]

_SECURABLES = """
SELECT 'CATALOG' AS kind, catalog AS securable, owner, ['CREATE SCHEMA', 'USE CATALOG'] AS required FROM {wide_catalogs}
WHERE catalog_type NOT IN ('FOREIGN_CATALOG', 'DELTASHARING_CATALOG', 'SYSTEM_CATALOG')
UNION ALL
SELECT 'SCHEMA', s.catalog || '.' || s.schema, s.owner,
  CASE WHEN c.catalog_type = 'MANAGED_CATALOG' THEN ['CREATE TABLE', 'MANAGE', 'USE SCHEMA'] ELSE ['CREATE TABLE', 'USE SCHEMA'] END
FROM {wide_schemas} s LEFT JOIN {wide_catalogs} c ON c.catalog = s.catalog
WHERE NOT starts_with(s.schema, '_') AND s.schema NOT IN ('information_schema', 'default')
UNION ALL
SELECT 'EXTERNAL LOCATION', name, owner, ['CREATE EXTERNAL TABLE', 'READ FILES', 'WRITE FILES'] FROM {locations} WHERE contains(url, 'newacct')"""

_AUDITED = f"""SELECT kind, securable, missing AS lacking, held,
  CASE WHEN owner = 'p1' THEN 'owner' WHEN unread THEN 'cannot_verify' WHEN list_contains(held, 'ALL PRIVILEGES') OR len(missing) = 0 THEN 'ok' ELSE 'missing' END AS status
FROM (SELECT *, list_sort(list_filter(required, lambda p: NOT list_contains(held, p))) AS missing FROM
  (SELECT s.*, coalesce(g.held, []) AS held,
     EXISTS (SELECT 1 FROM {{unreadable_securables}} u WHERE u.kind = s.kind AND u.securable = s.securable) AS unread
   FROM ({_SECURABLES}) s LEFT JOIN (SELECT kind, securable, list_sort(list_distinct(list(privilege))) AS held FROM {{securable_grants}}
     WHERE principal IN ('p1', 'p2') AND privilege <> '' GROUP BY ALL) g ON g.kind = s.kind AND g.securable = s.securable))"""


def _securables(inputs, kind):
    if kind == "CATALOG":
        rows = access.catalog_securables(inputs("wide_catalogs"))
    elif kind == "SCHEMA":
        rows = access.schema_securables(inputs("wide_schemas"), inputs("wide_catalogs"))
    else:
        rows = access.location_securables(inputs("locations"), new=NEW)
    # The derived owners are owner0 to owner4; owner3 is me.
    return rows.withColumn("owner", F.when(F.col("owner") == "owner3", ME).otherwise(F.col("owner")))


def _audit(inputs, kind):
    return access.audit(
        _securables(inputs, kind), inputs("securable_grants"), me=ME, groups=GROUPS, unreadable=inputs("unreadable_securables")
    )


_AUDITED = _AUDITED.replace("CASE WHEN owner = 'p1'", "CASE WHEN owner = 'owner3'")


@query(
    "held_privileges",
    f"SELECT securable, CASE WHEN status <> 'cannot_verify' THEN array_to_string(held, ',') END AS privileges FROM ({_AUDITED}) WHERE kind = 'SCHEMA' AND status <> 'owner'",
)
def _(inputs):
    rows = access.held_privileges(
        _securables(inputs, "SCHEMA").filter(F.col("owner") != ME),
        inputs("securable_grants"),
        me=ME,
        groups=GROUPS,
        unreadable=inputs("unreadable_securables"),
    )
    return rows.select("securable", F.array_join("privileges", ",").alias("privileges"))


def _register(name: str, kind: str):
    @query(name, f"SELECT securable, status, CASE WHEN status = 'missing' THEN array_to_string(lacking, ',') END AS missing FROM ({_AUDITED}) WHERE kind = '{kind}'")
    def _(inputs):
        return _audit(inputs, kind).select("securable", "status", F.array_join("missing", ",").alias("missing"))


_register("catalog_audit", "CATALOG")
_register("schema_audit", "SCHEMA")
_register("external_location_audit", "EXTERNAL LOCATION")


@query(
    "missing_privileges",
    f"SELECT status, count(*) AS securables, CAST(sum(CASE WHEN status = 'missing' THEN len(lacking) ELSE 0 END) AS BIGINT) AS lacking FROM ({_AUDITED}) GROUP BY status",
)
def _(inputs):
    rows = _audit(inputs, "CATALOG").unionByName(_audit(inputs, "SCHEMA")).unionByName(_audit(inputs, "EXTERNAL LOCATION"))
    return rows.groupBy("status").agg(
        F.count(F.lit(1)).alias("securables"), F.sum(F.coalesce(F.size("missing"), F.lit(0))).alias("lacking")
    )


@query("has_new_location", "SELECT count(*) > 0 AS has_location FROM {locations} WHERE contains(url, 'newacct')")
def _(inputs):
    return access.has_location(inputs("locations"), new=f"{NEW}/prefix")


@query(
    "tables_not_owned",
    "SELECT owner, count(*) AS tables FROM {objects} WHERE object_type = 'TABLE' AND owner <> 'owner2' GROUP BY owner",
)
def _(inputs):
    return access.tables_not_owned(inputs("objects"), me="owner2")


@query(
    "suggested_grants",
    f"""SELECT kind, securable, 'GRANT ' || array_to_string(lacking, ', ') || ' ON ' || kind || ' `' || replace(securable, '.', '`.`') || '` TO `p1`;' AS statement
FROM ({_AUDITED}) WHERE status = 'missing'""",
)
def _(inputs):
    rows = _audit(inputs, "CATALOG").unionByName(_audit(inputs, "SCHEMA")).unionByName(_audit(inputs, "EXTERNAL LOCATION"))
    return access.suggested_grants(rows, me=ME)


@query("managed_volumes_in_scope", "SELECT count(*) > 0 AS managed_volumes FROM {inv} WHERE object_type = 'VOLUME' AND table_type = 'MANAGED'")
def _(inputs):
    return access.managed_volumes_in_scope(inputs.inventory())


# Everything user1 is in, through groups of groups.
_PRINCIPALS = """SELECT DISTINCT principal FROM (WITH RECURSIVE r AS (SELECT 'user1' AS principal UNION SELECT parent FROM r JOIN {memberships} m ON m.member = r.principal) SELECT * FROM r) p"""


def _principals(inputs):
    me = inputs("region").limit(1).select(F.lit("user1").alias("principal"))
    return access.principals_of(me, inputs("memberships").withColumnRenamed("parent", "group"))


@query("principals_of", _PRINCIPALS)
def _(inputs):
    return _principals(inputs)


_SECURED = """SELECT 'CATALOG' AS kind, catalog AS securable, catalog AS above FROM {wide_catalogs}
UNION ALL SELECT DISTINCT 'SCHEMA', concat(catalog, '.', schema), catalog FROM {wide_schemas}"""


@query(
    "effective_privileges",
    f"""SELECT s.kind, s.securable, CASE WHEN EXISTS (SELECT 1 FROM {{unreadable_securables}} u WHERE (u.kind = s.kind AND u.securable = s.securable) OR (u.kind = 'CATALOG' AND u.securable = s.above)) THEN NULL
  ELSE coalesce((SELECT array_to_string(list_sort(list(DISTINCT g.privilege)), ',') FROM {{securable_grants}} g
    WHERE g.privilege <> '' AND g.principal IN ({_PRINCIPALS}) AND ((g.kind = s.kind AND g.securable = s.securable) OR (g.kind = 'CATALOG' AND g.securable = s.above))), '') END AS privileges
FROM ({_SECURED}) s""",
)
def _(inputs):
    catalogs = inputs("wide_catalogs").select(F.lit("CATALOG").alias("kind"), F.col("catalog").alias("securable"), F.array("catalog").alias("parts"))
    schemas = inputs("wide_schemas").select(F.lit("SCHEMA").alias("kind"), F.concat_ws(".", "catalog", "schema").alias("securable"), F.array("catalog", "schema").alias("parts")).distinct()
    rows = access.effective_privileges(catalogs.unionByName(schemas), inputs("securable_grants"), _principals(inputs), unreadable=inputs("unreadable_securables"))
    return rows.select("kind", "securable", F.array_join("privileges", ",").alias("privileges"))
