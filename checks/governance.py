"""Capture, replay and remediation of governance."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from checks.registry import AS_OF, KEYS, SAME, query, quoted
from estate.operators import governance, verify
from estate.operators.closure import stored
from estate.plans import governance as plans
from estate.settings import KEY

_OWN = "CASE WHEN upper(object_type) = 'VOLUME' THEN 'VOLUME' ELSE 'TABLE' END"


def _grants(inputs, name="grants"):
    return inputs(name).select(*KEY, "principal", "privilege", "granted_on")


@query(
    "normalise_grants",
    """SELECT k, principal, privilege, CASE WHEN k % 4 = 0 THEN 'TABLE' ELSE granted_on END AS granted_on FROM {grants} WHERE k % 6 <> 0""",
)
def _(inputs):
    shown = inputs("grants").select(
        "k",
        F.when(F.col("k") % 6 != 0, F.col("principal")).alias("Principal"),
        F.when(F.col("k") % 2 == 0, F.col("privilege")).alias("ActionType"),
        F.when(F.col("k") % 2 == 1, F.col("privilege")).alias("privilege"),
        F.when(F.col("k") % 4 != 0, F.col("granted_on")).alias("object_type"),
    )
    return governance.normalise_grants(shown)


@query("direct_grants", f"SELECT {KEYS}, principal, privilege FROM {{grants}} WHERE granted_on = {_OWN}")
def _(inputs):
    return governance.direct_grants(_grants(inputs)).select(*KEY, "principal", "privilege")


@query(
    "tag_lists",
    f"""SELECT {KEYS}, string_agg(tag_name || '=' || tag_value, ';' ORDER BY tag_name, tag_value) AS tags FROM {{tags}} GROUP BY ALL""",
)
def _(inputs):
    pairs = F.transform("tags", lambda t: F.concat(t["name"], F.lit("="), t["value"]))
    return governance.tag_lists(inputs("tags")).select(*KEY, F.array_join(pairs, ";").alias("tags"))


_LIST = "array_to_string(list_filter(list_transform(string_split(coalesce({c}, ''), ','), lambda x: trim(x)), lambda x: x <> ''), ',')"


@query(
    "row_filters",
    f"SELECT {KEYS}, coalesce(filter_name, function_name) AS row_filter_name, {_LIST.format(c='using_columns')} AS columns FROM {{filters}}",
)
def _(inputs):
    return governance.row_filters(inputs("filters")).select(
        *KEY, "row_filter_name", F.array_join("row_filter_using_columns", ",").alias("columns")
    )


@query(
    "column_masks",
    f"SELECT {KEYS}, column_name AS \"column\", function_name AS mask_function, {_LIST.format(c='using_columns')} AS columns FROM {{masks}}",
)
def _(inputs):
    return governance.column_masks(inputs("masks")).select(
        *KEY, "column", "mask_function", F.array_join("using_columns", ",").alias("columns")
    )


@query("described_owner", f"SELECT {KEYS}, data_type AS owner FROM {{described}} WHERE lower(col_name) = 'owner' AND pos > 4")
def _(inputs):
    return governance.described_owners(inputs("described"))


@query(
    "described_comments",
    f"""SELECT {KEYS}, col_name AS "column", comment FROM {{described}} WHERE pos < 4 AND col_name <> '' AND comment IS NOT NULL
UNION ALL SELECT {KEYS}, NULL, data_type FROM {{described}} WHERE pos > 4 AND lower(col_name) = 'comment'""",
)
def _(inputs):
    return governance.described_comments(inputs("described"))


@query(
    "property_maps",
    f"""SELECT {KEYS}, string_agg(key || '=' || value, ';' ORDER BY key) AS properties FROM {{properties}} GROUP BY ALL""",
)
def _(inputs):
    entries = F.array_sort(F.map_entries("table_properties"))
    return governance.property_maps(inputs("properties")).select(
        *KEY, F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("properties")
    )


def _snapshots(inputs):
    return governance.capture_snapshots(
        inputs("objects").filter(F.col("object_type").isin("TABLE", "VOLUME")),
        grants=_grants(inputs),
        tags=inputs("tags"),
        filters=inputs("filters"),
        masks=inputs("masks"),
        describe=inputs("described"),
        properties=inputs("properties"),
        captured_at=AS_OF,
    )


_ON = lambda a: SAME("o", a)


@query(
    "capture_snapshot",
    f"""SELECT o.catalog, o.schema, o.name, o.object_type, coalesce(g.n, 0) AS grants, coalesce(t.n, 0) AS tags, coalesce(m.n, 0) AS masks,
  w.data_type AS owner, coalesce(f.filter_name, f.function_name) AS row_filter_name, c.data_type AS table_comment,
  coalesce(l.n, 0) AS column_comments, coalesce(p.n, 0) AS properties
FROM {{objects}} o
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{grants}} WHERE granted_on = {_OWN} GROUP BY ALL) g ON {_ON('g')}
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{tags}} GROUP BY ALL) t ON {_ON('t')}
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{masks}} GROUP BY ALL) m ON {_ON('m')}
LEFT JOIN {{described}} w ON {_ON('w')} AND w.col_name = 'Owner'
LEFT JOIN {{described}} c ON {_ON('c')} AND c.col_name = 'Comment'
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{described}} WHERE pos < 4 AND comment IS NOT NULL GROUP BY ALL) l ON {_ON('l')}
LEFT JOIN {{filters}} f ON {_ON('f')}
LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM {{properties}} GROUP BY ALL) p ON {_ON('p')}
WHERE o.object_type IN ('TABLE', 'VOLUME')""",
)
def _(inputs):
    s = F.col("snapshot")
    return governance.read_snapshots(_snapshots(inputs)).select(
        *KEY,
        F.size(s["grants"]).cast("long").alias("grants"),
        F.size(s["tags"]).cast("long").alias("tags"),
        F.size(s["column_masks"]).cast("long").alias("masks"),
        s["owner"].alias("owner"),
        s["row_filter_name"].alias("row_filter_name"),
        s["table_comment"].alias("table_comment"),
        F.size(s["column_comments"]).cast("long").alias("column_comments"),
        F.size(s["table_properties"]).cast("long").alias("properties"),
    )


_TARGET = f"{_OWN} || ' ' || {quoted('catalog', 'schema', 'name')}"
_LIT = lambda e: f"'''' || replace({e}, '''', '''''') || ''''"
_STEPS = f"""
SELECT {KEYS}, 1 AS rank, 'grant' AS kind, principal || privilege || granted_on AS sub,
  'GRANT ' || privilege || ' ON ' || {_TARGET} || ' TO `' || principal || '`' AS statement FROM {{grants}} WHERE granted_on = {_OWN}
UNION ALL SELECT {KEYS}, 2, 'owner', '', 'ALTER ' || {_TARGET} || ' OWNER TO `' || data_type || '`' FROM {{described}} WHERE col_name = 'Owner'
UNION ALL SELECT {KEYS}, 3, 'tags', '', 'ALTER ' || {_TARGET} || ' SET TAGS (' || string_agg({_LIT('tag_name')} || ' = ' || {_LIT('tag_value')}, ', ' ORDER BY tag_name, tag_value) || ')'
  FROM {{tags}} GROUP BY {KEYS}
UNION ALL SELECT {KEYS}, 4, 'comment', '', 'COMMENT ON ' || {_TARGET} || ' IS ' || {_LIT('data_type')} FROM {{described}} WHERE col_name = 'Comment'
UNION ALL SELECT {KEYS}, 5, 'property', key, 'ALTER ' || {_TARGET} || ' SET TBLPROPERTIES (' || {_LIT('key')} || ' = ' || {_LIT('value')} || ')'
  FROM {{properties}} WHERE NOT starts_with(key, 'delta.')"""


@query(
    "replay_statements",
    f"""SELECT {KEYS}, row_number() OVER (PARTITION BY {KEYS} ORDER BY rank, sub) AS step_no, kind, statement FROM ({_STEPS}) WHERE object_type IN ('TABLE', 'VOLUME')""",
)
def _(inputs):
    return plans.replay_statements(_snapshots(inputs))


@query(
    "replay_warnings",
    f"""SELECT {KEYS}, 'row_filter' AS part, coalesce(filter_name, function_name) AS detail FROM {{filters}}
UNION ALL SELECT {KEYS}, 'column_masks', CAST(count(*) AS VARCHAR) FROM {{masks}} GROUP BY {KEYS}""",
)
def _(inputs):
    return plans.replay_warnings(_snapshots(inputs))


# Snapshots as an earlier tool took them, with the inherited grants still inside.
def _full_snapshots(inputs):
    grant = F.struct("principal", "privilege", F.col("granted_on").alias("object_type"))
    return (
        inputs("grants")
        .groupBy(*KEY)
        .agg(F.to_json(F.struct(F.collect_list(grant).alias("grants"))).alias("snapshot_json"))
        .withColumn("captured_at", F.lit(AS_OF).cast("timestamp"))
    )


_REVOKES = f"""SELECT DISTINCT {KEYS}, principal, privilege, 'REVOKE ' || privilege || ' ON ' || {_TARGET} || ' FROM `' || principal || '`' AS statement
FROM {{grants}} g WHERE granted_on IN ('CATALOG', 'SCHEMA', 'METASTORE')
  AND NOT EXISTS (SELECT 1 FROM {{grants}} d WHERE {SAME('d', 'g')} AND d.principal = g.principal AND d.privilege = g.privilege
    AND d.granted_on = CASE WHEN d.object_type = 'VOLUME' THEN 'VOLUME' ELSE 'TABLE' END)
  AND EXISTS (SELECT 1 FROM {{live_grants}} l WHERE {SAME('l', 'g')} AND l.principal = g.principal AND l.privilege = g.privilege
    AND l.granted_on = CASE WHEN l.object_type = 'VOLUME' THEN 'VOLUME' ELSE 'TABLE' END)"""


@query("inherited_grant_revokes", _REVOKES)
def _(inputs):
    return plans.revoke_statements(_full_snapshots(inputs), _grants(inputs, "live_grants"))


@query("inherited_grant_revoke_counts", f"SELECT {KEYS}, count(*) AS revokes FROM ({_REVOKES}) GROUP BY ALL")
def _(inputs):
    return plans.revoke_counts(plans.revoke_statements(_full_snapshots(inputs), _grants(inputs, "live_grants")))


@query(
    "governance_diff",
    f"""SELECT o.k, NOT (o.k % 5 = 0 AND EXISTS (SELECT 1 FROM {{grants}} g WHERE {SAME('g', 'o')} AND g.granted_on = CASE WHEN g.object_type = 'VOLUME' THEN 'VOLUME' ELSE 'TABLE' END)) AS grants_ok,
  NOT (o.k % 6 = 0 AND EXISTS (SELECT 1 FROM {{described}} d WHERE {SAME('d', 'o')} AND d.col_name = 'Owner')) AS owner_ok,
  NOT EXISTS (SELECT 1 FROM {{tags}} t WHERE {SAME('t', 'o')} AND t.tag_name = 'tag3') AS tags_ok,
  NOT EXISTS (SELECT 1 FROM {{filters}} f WHERE {SAME('f', 'o')} AND f.using_columns = 'id') AS row_filter_ok,
  NOT (o.k % 4 = 0 AND EXISTS (SELECT 1 FROM {{masks}} m WHERE {SAME('m', 'o')})) AS column_mask_ok,
  NOT EXISTS (SELECT 1 FROM {{described}} d WHERE {SAME('d', 'o')} AND d.pos = 1 AND d.comment IS NOT NULL) AS comments_ok
FROM {{objects}} o WHERE o.object_type IN ('TABLE', 'VOLUME')""",
)
def _(inputs):
    k = F.col("k")
    number = inputs("objects").select(*KEY, "k")
    numbered = lambda rows: rows.join(number, KEY)
    # Only these rows depend on the number; for the rest a join says that their key is known, as a capture asks anyway.
    owner, keyed = F.coalesce(F.col("col_name") == "Owner", F.lit(True)), reduce(and_, [F.col(c).isNotNull() for c in KEY])
    described = inputs("described")
    described = described.filter(~owner & keyed).unionByName(described.filter(owner).join(number.filter(k % 6 != 0), KEY, "left_semi"))
    changed = governance.capture_snapshots(
        inputs("objects").filter(F.col("object_type").isin("TABLE", "VOLUME")),
        grants=numbered(_grants(inputs)).filter(k % 5 != 0),
        tags=inputs("tags").filter(F.col("tag_name") != "tag3"),
        filters=inputs("filters").withColumn("using_columns", F.when(F.col("using_columns") != "id", F.col("using_columns"))),
        # Stored, so that the shuffle files behind the largest part are gone before the capture's.
        masks=stored(numbered(inputs("masks")).withColumn("function_name", F.when(k % 4 == 0, F.lit("other")).otherwise(F.col("function_name"))), "masks"),
        describe=described.withColumn("comment", F.when(F.col("pos") != 1, F.col("comment"))),
        properties=inputs("properties"),
        captured_at=AS_OF,
    )
    flags = verify.governance_diff(governance.read_snapshots(_snapshots(inputs)), governance.read_snapshots(changed))
    return flags.join(number, KEY).drop(*KEY)
