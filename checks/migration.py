"""Routes, plans, states, claims, pre-flight."""

from pyspark.sql import functions as F

from checks.derived import NEW, OLD
from checks.registry import AS_OF, KEYS, SAME, query, quoted
from estate.operators import history, state
from estate.plans import migration
from estate.session import scratch_path
from estate.sources import footers, listings
from estate.settings import KEY

_ROUTE = """CASE WHEN classification = 'external_on_old' AND object_type = 'TABLE' THEN 'external_table'
  WHEN classification = 'external_on_old' AND object_type = 'VOLUME' THEN 'external_volume'
  WHEN classification <> 'drift_managed_on_old' THEN NULL
  WHEN table_type IN ('MATERIALIZED_VIEW', 'STREAMING_TABLE') THEN 'hand_off'
  WHEN object_type = 'TABLE' AND data_source_format = 'DELTA' THEN 'clone' WHEN object_type = 'TABLE' THEN 'ctas'
  WHEN object_type = 'VOLUME' AND table_type = 'MANAGED' THEN 'volume_copy' END"""


def _routed(inputs):
    return migration.route(inputs.inventory())


@query("migration_route", f"SELECT k, {_ROUTE} AS route FROM {{inv}}")
def _(inputs):
    return _routed(inputs).select("k", "route")


_ORIG, _PRE, _STAGING = (quoted("catalog", "schema", n) for n in ("name", "(name || '__pre_migration')", "(name || '__migrate_staging')"))
_MOVED = """CASE WHEN storage_path ILIKE 's3://%' THEN 's3://newacct/t' || k ELSE regexp_replace(regexp_replace(storage_path, '@oldacct', '@newacct', 'i'), '^abfss', 'abfss', 'i') END"""


@query(
    "migration_steps",
    f"""SELECT {KEYS}, route, step_no, action, statement FROM (
  SELECT *, 1 AS step_no, CASE route WHEN 'clone' THEN 'clone' WHEN 'ctas' THEN 'ctas' ELSE 'drop' END AS action,
    CASE route WHEN 'clone' THEN 'CREATE TABLE ' || {_STAGING} || ' DEEP CLONE ' || {_ORIG} WHEN 'ctas' THEN 'CREATE TABLE ' || {_STAGING} || ' AS SELECT * FROM ' || {_ORIG}
      WHEN 'external_table' THEN 'DROP TABLE ' || {_ORIG} ELSE 'DROP VOLUME ' || {_ORIG} END AS statement FROM (SELECT *, {_ROUTE} AS route FROM {{inv}})
  UNION ALL SELECT *, 2, CASE WHEN route IN ('clone', 'ctas') THEN 'rename_orig' ELSE 'create' END,
    CASE WHEN route IN ('clone', 'ctas') THEN 'ALTER TABLE ' || {_ORIG} || ' RENAME TO ' || {_PRE}
      WHEN route = 'external_table' THEN 'CREATE EXTERNAL TABLE ' || {_ORIG} || ' USING ' || upper(coalesce(data_source_format, 'DELTA')) || ' LOCATION ''' || {_MOVED} || ''''
      ELSE 'CREATE EXTERNAL VOLUME ' || {_ORIG} || ' LOCATION ''' || {_MOVED} || '''' END FROM (SELECT *, {_ROUTE} AS route FROM {{inv}})
  UNION ALL SELECT *, 3, 'rename_staging', 'ALTER TABLE ' || {_STAGING} || ' RENAME TO ' || {_ORIG} FROM (SELECT *, {_ROUTE} AS route FROM {{inv}}) WHERE route IN ('clone', 'ctas'))
WHERE route IN ('clone', 'ctas', 'external_table', 'external_volume')""",
)
def _(inputs):
    return migration.plan_steps(_routed(inputs), new=NEW, old=OLD)


@query(
    "managed_volume_steps",
    f"""SELECT {KEYS}, step_no, action, statement FROM (
  SELECT *, 1 AS step_no, 'create_staging' AS action, 'CREATE VOLUME IF NOT EXISTS ' || {_STAGING} AS statement FROM {{inv}}
  UNION ALL SELECT *, 2, 'copy', NULL FROM {{inv}}
  UNION ALL SELECT *, 3, 'verify', NULL FROM {{inv}}
  UNION ALL SELECT *, 4, 'rename_orig', 'ALTER VOLUME ' || {_ORIG} || ' RENAME TO ' || {_PRE} FROM {{inv}}
  UNION ALL SELECT *, 5, 'rename_staging', 'ALTER VOLUME ' || {_STAGING} || ' RENAME TO ' || {_ORIG} FROM {{inv}})
WHERE classification = 'drift_managed_on_old' AND object_type = 'VOLUME' AND table_type = 'MANAGED'""",
)
def _(inputs):
    return migration.managed_volume_steps(_routed(inputs))


@query("shadow_and_staging_names", "SELECT k, name || '__pre_migration' AS shadow, name || '__migrate_staging' AS staging FROM {objects}")
def _(inputs):
    return inputs("objects").select("k", state.shadow_name("name").alias("shadow"), state.staging_name("name").alias("staging"))


@query(
    "action_status",
    """SELECT action, CASE WHEN action IN ('clone', 'ctas', 'drop', 'create', 'rename_orig') THEN 'cloned' WHEN action = 'rename_staging' THEN 'swapped' ELSE action END AS status, count(*) AS steps
FROM (SELECT CASE k % 8 WHEN 0 THEN 'clone' WHEN 1 THEN 'ctas' WHEN 2 THEN 'drop' WHEN 3 THEN 'create' WHEN 4 THEN 'rename_orig' WHEN 5 THEN 'rename_staging' WHEN 6 THEN 'replayed' ELSE 'validated' END AS action FROM {objects}) GROUP BY ALL""",
)
def _(inputs):
    actions = ["clone", "ctas", "drop", "create", "rename_orig", "rename_staging", "replayed", "validated"]
    action = F.element_at(F.array(*[F.lit(a) for a in actions]), (F.col("k") % 8 + 1).cast("int"))
    rows = inputs("objects").select(action.alias("action"))
    return rows.groupBy("action", state.action_status("action").alias("status")).agg(F.count(F.lit(1)).alias("steps"))


# Two runners want each object at times that tie on some.
_CANDIDATES = f"""SELECT {KEYS}, k, 'runner' || CAST((k + s) % 4 AS VARCHAR) AS actor, TIMESTAMP '2001-01-01' + INTERVAL 1 HOUR * CAST((k * (s + 1)) % 3 AS INTEGER) AS claimed_at
FROM {{objects}}, (SELECT 0 AS s UNION ALL SELECT 1 AS s)"""


def _candidates(inputs):
    k, s = F.col("k"), F.col("s")
    return inputs("objects").select(*KEY, "k", F.explode(F.array(F.lit(0), F.lit(1))).alias("s")).select(
        *KEY,
        "k",
        F.concat(F.lit("runner"), (k + s) % 4).alias("actor"),
        (F.lit(AS_OF).cast("timestamp") + F.make_dt_interval(hours=((k * (s + 1)) % 3).cast("int"))).alias("claimed_at"),
    )


_FIRST = f"SELECT {KEYS}, arg_min(actor, (claimed_at, actor)) AS actor, min(claimed_at) AS claimed_at FROM ({_CANDIDATES}) GROUP BY ALL"


@query(
    "claim",
    f"""SELECT c.k, c.actor, coalesce(l.claimed_by, f.actor) = c.actor AND coalesce(l.status, 'claimed') <> 'validated' AS granted
FROM ({_CANDIDATES}) c JOIN ({_FIRST}) f ON {SAME('c', 'f')} LEFT JOIN {{log}} l ON {SAME('c', 'l')}""",
)
def _(inputs):
    return state.claim(_candidates(inputs), inputs("log")).select("k", "actor", "granted")


@query(
    "new_claims",
    f"""SELECT {KEYS}, 'claimed' AS status, actor AS claimed_by, claimed_at FROM ({_FIRST}) f WHERE NOT EXISTS (SELECT 1 FROM {{log}} l WHERE {SAME('l', 'f')})""",
)
def _(inputs):
    fresh = state.new_claims(_candidates(inputs), inputs("log"))
    return fresh.select(*KEY, "status", "claimed_by", F.col("claimed_at").cast("timestamp_ntz").alias("claimed_at"))


# Each log row gets later events from the line items of its order.
def _events(inputs):
    start = state.log_rows(inputs("log").withColumn("updated_at", F.lit("1990-01-01").cast("timestamp")))
    later = inputs("log").join(inputs("lineitem"), F.col("k") == F.col("l_orderkey")).select(
        *KEY,
        F.concat(F.lit("step"), F.col("l_linenumber")).alias("status"),
        "claimed_by",
        F.col("l_partkey").alias("row_count_before"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
    )
    return start.unionByName(state.log_rows(later))


@query(
    "latest_log",
    f"""SELECT {KEYS}, status, row_count_before, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY updated_at DESC, status DESC, row_count_before DESC) AS rn FROM (
    SELECT {KEYS}, status, CAST(NULL AS BIGINT) AS row_count_before, TIMESTAMP '1990-01-01' AS updated_at FROM {{log}}
    UNION ALL SELECT {KEYS}, 'step' || l_linenumber, l_partkey, l_shipdate FROM {{log}} JOIN {{lineitem}} ON k = l_orderkey)) WHERE rn = 1""",
)
def _(inputs):
    rows = state.latest_log(_events(inputs))
    return rows.select(*KEY, "status", "row_count_before", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


@query(
    "log_update",
    f"SELECT {KEYS}, CASE WHEN status = 'swapped' THEN 'replayed' ELSE status END AS status, claimed_by, CASE WHEN status = 'swapped' THEN 7 END AS row_count_after FROM {{log}}",
)
def _(inputs):
    log = state.log_rows(inputs("log").withColumn("updated_at", F.lit("2000-01-01").cast("timestamp")))
    changes = {"status": F.lit("replayed"), "row_count_after": F.lit(7).cast("long")}
    updates = state.log_update(log.filter(F.col("status") == "swapped"), updated_at=AS_OF, changes=changes)
    return state.latest_log(log.unionByName(updates)).select(*KEY, "status", "claimed_by", "row_count_after")


_STATE = """CASE k % 8 WHEN 0 THEN 'absent' WHEN 1 THEN 'pristine' WHEN 2 THEN 'gap' WHEN 3 THEN 'swapped' WHEN 4 THEN 'only_staging'
  WHEN 5 THEN 'cloned' WHEN 6 THEN 'swap_partial' ELSE 'swapped_orphan' END"""


def _stated(inputs):
    return state.attach_state(inputs("objects"), inputs("listing").drop("readable"))


@query("object_state", f"SELECT k, {_STATE} AS state FROM {{objects}}")
def _(inputs):
    return _stated(inputs).select("k", "state")


@query(
    "object_state_unreadable",
    f"SELECT k, CASE WHEN (k % 41 = 7 AND k % 8 IN (1, 3, 5, 7)) OR (k % 43 = 3 AND k % 8 IN (2, 3, 6, 7)) THEN 'unknown' ELSE {_STATE} END AS state FROM {{objects}}",
)
def _(inputs):
    listing = inputs("listing").withColumn("present", F.when(F.col("readable"), F.lit(True)))
    return state.attach_state(inputs("objects"), listing).select("k", "state")


_PHASES = """SELECT * FROM (VALUES ('pristine', 1, 'clone'), ('pristine', 2, 'rename_orig_to_pre'), ('pristine', 3, 'promote_staging'), ('pristine', 4, 'replay'), ('pristine', 5, 'validate'),
  ('cloned', 1, 'rename_orig_to_pre'), ('cloned', 2, 'promote_staging'), ('cloned', 3, 'replay'), ('cloned', 4, 'validate'),
  ('swap_partial', 1, 'promote_staging'), ('swap_partial', 2, 'replay'), ('swap_partial', 3, 'validate'), ('swapped', 1, 'replay'), ('swapped', 2, 'validate'),
  ('swapped_orphan', 1, 'replay'), ('swapped_orphan', 2, 'validate'), ('swapped_orphan', 3, 'drop_orphan_staging')) v(state, phase_no, phase)"""


@query("resume_phases", f"SELECT {KEYS}, s.state, phase_no, phase FROM (SELECT *, {_STATE} AS state FROM {{objects}}) s JOIN ({_PHASES}) p ON p.state = s.state")
def _(inputs):
    return state.resume_phases(_stated(inputs))


@query("resumable_states", f"SELECT state, state IN ('pristine', 'cloned', 'swap_partial', 'swapped', 'swapped_orphan') AS resumable, count(*) AS objects FROM (SELECT {_STATE} AS state FROM {{objects}}) GROUP BY ALL")
def _(inputs):
    return state.flag_resumable(_stated(inputs)).groupBy("state", "resumable").agg(F.count(F.lit(1)).alias("objects"))


@query("forward_worklist", f"SELECT k FROM {{objects}} o WHERE NOT EXISTS (SELECT 1 FROM {{log}} l WHERE {SAME('l', 'o')} AND l.status = 'validated')")
def _(inputs):
    return state.forward_worklist(inputs("objects"), inputs("history")).select("k")


@query("retry_failed_worklist", f"SELECT o.k FROM {{objects}} o JOIN {{log}} l ON {SAME('l', 'o')} WHERE l.status = 'failed'")
def _(inputs):
    return state.failed_worklist(inputs("objects"), inputs("history")).select("k")


_PLACES = """SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'abfss://lake@newacct.dfs.core.windows.net/part' || CAST(o_custkey % 30 AS VARCHAR) || '/t'
  WHEN 1 THEN 's3://newacct/part' || CAST(o_custkey % 20 AS VARCHAR) || '/sub' || CAST(o_custkey % 4 AS VARCHAR) || '/t' WHEN 2 THEN 's3://newacct/part' || CAST(o_custkey % 20 AS VARCHAR)
  WHEN 3 THEN 's3://newacct/part1' || '5/x' ELSE 's3://elsewhere/t' END AS target_path FROM {orders}"""


@query(
    "external_location_cover",
    f"""SELECT t.k, t.target_path, (SELECT arg_min(l.name, l.pos) FROM {{locations}} l WHERE t.target_path = rtrim(l.url, '/') OR starts_with(t.target_path, rtrim(l.url, '/') || '/')) AS location_name
FROM ({_PLACES}) t""",
)
def _(inputs):
    c = F.col("o_custkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    path = (
        F.when(F.col("o_orderkey") % 5 == 0, text("abfss://lake@newacct.dfs.core.windows.net/part", c % 30, "/t"))
        .when(F.col("o_orderkey") % 5 == 1, text("s3://newacct/part", c % 20, "/sub", c % 4, "/t"))
        .when(F.col("o_orderkey") % 5 == 2, text("s3://newacct/part", c % 20))
        .when(F.col("o_orderkey") % 5 == 3, F.lit("s3://newacct/part15/x"))
        .otherwise(F.lit("s3://elsewhere/t"))
    )
    targets = inputs("orders").select(F.col("o_orderkey").alias("k"), path.alias("target_path"))
    return migration.location_cover(targets, inputs("locations"), keys=["k"])


_TARGETS = """SELECT k, 'abfss://lake@oldacct.dfs.core.windows.net/Dir/t' || k AS old_path, 'abfss://lake@newacct.dfs.core.windows.net/Dir/t' || k AS new_path FROM {inv} WHERE classification = 'external_on_old'"""


def _targets(inputs):
    path = lambda account: F.concat(F.lit(f"abfss://lake@{account}.dfs.core.windows.net/Dir/t"), "k")
    return inputs.inventory().filter(F.col("classification") == "external_on_old").select(
        "k", path("oldacct").alias("old_path"), path("newacct").alias("new_path")
    )


@query("missing_at_target", f"SELECT k, new_path FROM ({_TARGETS}) t WHERE NOT EXISTS (SELECT 1 FROM {{entries}} e WHERE e.root = t.new_path)")
def _(inputs):
    return migration.missing_at_target(_targets(inputs), inputs("entries"), root="new_path").select("k", "new_path")


@query(
    "partition_completeness",
    f"""SELECT k, old_count, new_count, new_count >= old_count AND old_count > 0 AS complete, new_count < old_count AND old_count > 0 AS warn
FROM (SELECT k, (SELECT count(*) FROM {{entries}} e WHERE e.root = t.old_path) AS old_count, (SELECT count(*) FROM {{entries}} e WHERE e.root = t.new_path) AS new_count FROM ({_TARGETS}) t)""",
)
def _(inputs):
    return migration.entry_completeness(_targets(inputs), inputs("entries"), keys=["k"])


@query(
    "row_count_and_schema_check",
    """SELECT count(*) AS row_count_before, count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS row_count_after,
  count(*) = count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS row_count_ok, FALSE AS schema_ok FROM {lineitem}""",
)
def _(inputs):
    lines = inputs("lineitem")
    # The copy lacks rows and has one column of another type.
    copy = lines.filter(F.col("l_orderkey") % 7 != 0).withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    return migration.compare_signatures(lines, copy)


def _footers(inputs, rows, label):
    path = scratch_path(inputs.spark, label)
    rows.repartition(max(3, -(-rows.count() // 1_000_000))).write.parquet(path)
    return footers.parquet_footers(footers.parquet_files(listings.list_tree(inputs.spark, path)))


@query(
    "row_count_and_schema_by_footers",
    """SELECT count(*) AS row_count_before, count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS row_count_after,
  count(*) = count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS row_count_ok, TRUE AS schema_ok, CAST(0 AS BIGINT) AS unreadable FROM {lineitem}""",
)
def _(inputs):
    lines = inputs("lineitem")
    return migration.compare_footers(_footers(inputs, lines, "footers-before"), _footers(inputs, lines.filter(F.col("l_orderkey") % 7 != 0), "footers-after"))


_RANGE = "SELECT '{0}' AS name, count(*) - count({0}) AS nulls, {1} AS low, {2} AS high, {3} AS low_text, {4} AS high_text FROM {{orders}}"
_RANGES = [
    *[_RANGE.format(c, f"CAST(min({c}) AS BIGINT)", f"CAST(max({c}) AS BIGINT)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)") for c in ("o_orderkey", "o_custkey")],
    *[_RANGE.format(c, "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)", f"min({c})", f"max({c})") for c in ("o_orderstatus", "o_orderpriority")],
]


@query("column_ranges_by_footers", " UNION ALL ".join(_RANGES))
def _(inputs):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return footers.column_ranges(_footers(inputs, inputs("orders").select(columns), "footers-ranges")).drop("files")


@query("staged_table_rewrite", "SELECT count(*) AS source_n, count(*) AS target_n, TRUE AS match FROM {orders}")
def _(inputs):
    spark = inputs.spark
    folder = scratch_path(spark, "rewrite")
    stem = "estate_" + folder.rsplit("-", 1)[-1]
    inputs("orders").write.option("path", f"{folder}/original").saveAsTable(stem)
    verdict = migration.staged_rewrite(
        spark, stem, shadow=f"{stem}__pre_migration", staging=f"{stem}__migrate_staging", location=f"{folder}/copy"
    )
    for name in (stem, f"{stem}__pre_migration"):
        spark.sql(f"DROP TABLE {name}")
    return verdict.select("source_n", "target_n", "match")


_AS_OF_WRITE = """SELECT w.*, m.status, m.updated_at AS since, row_number() OVER (PARTITION BY w.event_id ORDER BY m.updated_at DESC, m.status DESC NULLS LAST) AS rn
FROM {table_writes} w JOIN {moves} m ON m.object_type = 'TABLE' AND concat_ws('.', m.catalog, m.schema, m.name) = w.full_name AND m.updated_at <= w.event_time
WHERE w.action_name IN ('mergeTable', 'updateTable', 'writeTable')"""


@query("writes_while_cloned", f"SELECT full_name, event_time, email AS actor, action_name, event_id AS request_id, status, since FROM ({_AS_OF_WRITE}) WHERE rn = 1 AND status = 'cloned'")
def _(inputs):
    audit = inputs("table_writes").select(
        "event_time",
        "action_name",
        F.struct("email").alias("user_identity"),
        F.create_map(F.lit("full_name_arg"), "full_name", F.lit("request_id"), F.col("event_id").cast("string")).alias("request_params"),
    )
    found = history.writes_while(inputs("moves"), audit)
    return found.withColumn("request_id", F.col("request_params")["request_id"].cast("long")).drop("request_params")


_PAIRS = ", ".join(f"('{before}', '{after}')" for before, afters in history.FOLLOWS.items() for after in afters)
_STEPS = f"""SELECT {KEYS}, updated_at, coalesce(status, '(none)') AS status,
  lag(coalesce(status, '(none)'), 1, '') OVER (PARTITION BY {KEYS} ORDER BY updated_at, coalesce(status, '(none)')) AS before FROM {{moves}}"""


@query(
    "illegal_log_events",
    f"""SELECT {KEYS}, bad_events, updated_at, before, status FROM (
  SELECT *, count(*) OVER (PARTITION BY {KEYS}) AS bad_events, row_number() OVER (PARTITION BY {KEYS} ORDER BY updated_at, status, before) AS rn
  FROM ({_STEPS}) WHERE (before, status) NOT IN ({_PAIRS})) WHERE rn = 1""",
)
def _(inputs):
    return history.illegal_events(inputs("moves"))
