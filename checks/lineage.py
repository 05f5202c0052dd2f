"""Consumers and writers."""

from pyspark.sql import functions as F

from checks.registry import AS_OF, query
from estate.operators import lineage
from estate.session import scratch_path
from estate.sources import tables

_IN_SCOPE = "classification IN ('drift_managed_on_old', 'external_on_old')"


def _is_scoped(end: str) -> str:
    """Whether an edge's end, given as its three names, is an object in scope."""
    return f"(l.{end}_table_catalog, l.{end}_table_schema, l.{end}_table_name) IN (SELECT (catalog, schema, name) FROM {{inv}} WHERE {_IN_SCOPE})"


_RECENT = "SELECT l.source_table_full_name AS source, l.target_table_full_name AS target, l.event_time, l.entity_type, l.entity_id FROM {lineage} l WHERE l.event_time > TIMESTAMP '2000-12-02'"
# An edge is listed once for each end in scope, and once only if both ends are the same table.
_LISTED = f"""{_RECENT} AND {_is_scoped('source')}
UNION ALL {_RECENT} AND {_is_scoped('target')} AND l.source_table_full_name IS DISTINCT FROM l.target_table_full_name"""


def _consumers(inputs):
    return lineage.lineage_consumers(inputs.inventory(), inputs("lineage"), days=30, as_of=AS_OF)


@query("lineage_consumers", _LISTED)
def _(inputs):
    return _consumers(inputs)


@query(
    "recent_writes",
    f"""SELECT event_time, email AS actor, action_name, full_name, event_id AS request_id FROM {{audit}}
WHERE event_time > TIMESTAMP '2024-01-21' AND action_name IN ('createTable', 'mergeTable', 'updateTable', 'writeTable')
  AND full_name IN (SELECT concat_ws('.', catalog, schema, name) FROM {{inv}} WHERE classification = 'consistent_new' OR {_IN_SCOPE})""",
)
def _(inputs):
    audit = inputs("audit").select(
        "event_time",
        "action_name",
        F.struct("email").alias("user_identity"),
        F.create_map(F.lit("full_name_arg"), "full_name", F.lit("request_id"), F.col("event_id").cast("string")).alias("request_params"),
    )
    found = lineage.recent_writes(inputs.inventory(), audit, days=10, as_of="2024-01-31")
    return found.select(
        "event_time",
        "actor",
        "action_name",
        F.col("request_params")["full_name_arg"].alias("full_name"),
        F.col("request_params")["request_id"].cast("long").alias("request_id"),
    )


@query("write_lineage", _LISTED)
def _(inputs):
    path = scratch_path(inputs.spark, "lineage")
    tables.write_lineage(_consumers(inputs), path)
    return inputs.spark.read.parquet(path)


# Consumers of consumers; the depth is bounded here only because the recursive text would walk cycles for ever.
_EDGE = """SELECT DISTINCT l.source_table_catalog || '.' || l.source_table_schema || '.' || l.source_table_name AS src, l.target_table_catalog || '.' || l.target_table_schema || '.' || l.target_table_name AS dst
FROM {lineage} l WHERE l.event_time > TIMESTAMP '2000-12-02'"""


@query(
    "downstream_consumers",
    f"""SELECT full_name, CAST(min(depth) AS INTEGER) AS depth FROM (
  WITH RECURSIVE edge AS MATERIALIZED ({_EDGE}), walk AS (
    SELECT concat_ws('.', catalog, schema, name) AS full_name, 0 AS depth FROM {{inv}} WHERE {_IN_SCOPE}
    UNION SELECT dst, depth + 1 FROM walk JOIN edge ON full_name = src WHERE depth < 5 AND dst IS NOT NULL)
  SELECT * FROM walk) w GROUP BY full_name HAVING min(depth) > 0""",
)
def _(inputs):
    return lineage.downstream_consumers(inputs.inventory(), inputs("lineage"), days=30, as_of=AS_OF, max_depth=5)
