"""Roll-back and cleanup."""

from pyspark.sql import functions as F

from checks.derived import NEW, OLD
from checks.registry import AS_OF, KEYS, SAME, account, query, quoted
from estate.operators import state
from estate.plans import cleanup, rollback
from estate.session import scratch_path
from estate.settings import KEY
from estate.sources import tables

_CANDIDATES = f"""SELECT l.*, i.table_type, i.storage_path, i.data_source_format FROM {{log}} l LEFT JOIN {{inv}} i ON {SAME('l', 'i')}
WHERE l.status IN ('snapshot_taken', 'cloned', 'swapped', 'replayed', 'validated', 'failed', 'rollback_failed')"""


def _candidates(inputs):
    return rollback.rollback_candidates(inputs("history"), inputs.inventory())


@query("rollback_candidates", f"SELECT {KEYS}, status, table_type, storage_path, data_source_format FROM ({_CANDIDATES})")
def _(inputs):
    return _candidates(inputs).select(*KEY, "status", "table_type", "storage_path", "data_source_format")


@query("unrecoverable_objects", f"SELECT {KEYS}, status FROM {{log}} WHERE status IN ('swapped', 'replayed', 'validated') AND k % 8 IN (0, 4)")
def _(inputs):
    return rollback.unrecoverable_objects(inputs("history"), inputs("listing").drop("readable")).select(*KEY, "status")


_KW = "CASE WHEN object_type = 'VOLUME' THEN 'VOLUME' ELSE 'TABLE' END"
_ORIG, _PRE, _STAGING = (quoted("catalog", "schema", n) for n in ("name", "(name || '__pre_migration')", "(name || '__migrate_staging')"))
_DROP = lambda n: f"'DROP ' || {_KW} || ' IF EXISTS ' || {n}"
_HAS = "k % 8 IN (1, 3, 5, 7)", "k % 8 IN (2, 3, 6, 7)", "k % 8 IN (4, 5, 6, 7)"
_EXT = "coalesce(table_type, '') = 'EXTERNAL'"
# (condition, order, label, text): each row of the table is one possible step.
_STEPS = [
    (f"{_EXT} AND storage_path IS NULL", 1, "error", f"{_ORIG} || ': no original path'"),
    (f"{_EXT} AND storage_path IS NOT NULL AND {_HAS[0]}", 1, "drop_migrated", _DROP(_ORIG)),
    (
        f"{_EXT} AND storage_path IS NOT NULL",
        2,
        "recreate_external",
        f"'CREATE EXTERNAL ' || {_KW} || ' ' || {_ORIG} || CASE WHEN object_type = 'VOLUME' THEN '' ELSE ' USING ' || upper(coalesce(data_source_format, 'DELTA')) END || ' LOCATION ''' || storage_path || ''''",
    ),
    (f"NOT {_EXT} AND {_HAS[1]} AND {_HAS[0]}", 1, "drop_migrated", _DROP(_ORIG)),
    (f"NOT {_EXT} AND {_HAS[1]}", 2, "restore_shadow", f"'ALTER ' || {_KW} || ' ' || {_PRE} || ' RENAME TO ' || {_ORIG}"),
    (f"NOT {_EXT} AND {_HAS[1]} AND {_HAS[2]}", 3, "drop_staging", _DROP(_STAGING)),
    (f"NOT {_EXT} AND k % 8 = 5", 1, "drop_staging", _DROP(_STAGING)),
    (f"NOT {_EXT} AND k % 8 = 1", 1, "noop", f"{_ORIG} || ': original intact'"),
    (f"NOT {_EXT} AND k % 8 = 4", 1, "warn", f"{_ORIG} || ': only staging is left'"),
    (f"NOT {_EXT} AND k % 8 = 0", 1, "error", f"{_ORIG} || ': nothing is left'"),
]
_PLAN = f"""SELECT {KEYS}, row_number() OVER (PARTITION BY {KEYS} ORDER BY ord) AS step_no, label, statement FROM (
{' UNION ALL '.join(f"SELECT {KEYS}, {o} AS ord, '{label}' AS label, {text} AS statement FROM ({_CANDIDATES}) WHERE {cond}" for cond, o, label, text in _STEPS)})"""


def _plan(inputs):
    return rollback.plan_rollback(state.attach_existence(_candidates(inputs), inputs("listing").drop("readable")))


@query("rollback_steps", _PLAN)
def _(inputs):
    return _plan(inputs)


_OUTCOME = f"""SELECT p.*, CASE WHEN label = 'noop' THEN 'skipped' WHEN label IN ('warn', 'error') OR length(name) % 5 = 0 THEN 'rollback_failed' ELSE 'rolled_back' END AS outcome FROM ({_PLAN}) p WHERE step_no = 1"""


@query("rollback_outcomes", f"SELECT outcome, count(*) AS objects FROM ({_OUTCOME}) GROUP BY outcome")
def _(inputs):
    steps = _plan(inputs)
    failures = steps.filter(F.length("name") % 5 == 0)
    return rollback.outcome_counts(rollback.rollback_outcomes(steps, failures))


_MOVED = lambda c: f"CASE WHEN {c} ILIKE 's3%' THEN regexp_replace({c}, '^s3[an]?://newacct', 's3://oldacct', 'i') ELSE regexp_replace({c}, '@newacct', '@oldacct', 'i') END"


@query(
    "schema_root_reverts",
    f"SELECT DISTINCT catalog, schema, parent_managed_location AS current_root, {_MOVED('parent_managed_location')} AS target_root FROM {{inv}} WHERE {account('parent_managed_location')} = 'newacct'",
)
def _(inputs):
    return rollback.schema_root_reverts(inputs.inventory(), old=OLD, new=NEW)


@query(
    "catalog_root_reverts",
    f"SELECT catalog, storage_root AS current_root, {_MOVED('storage_root')} AS target_root FROM {{wide_catalogs}} WHERE {account('storage_root')} = 'newacct'",
)
def _(inputs):
    return rollback.catalog_root_reverts(inputs("wide_catalogs"), old=OLD, new=NEW)


@query(
    "rollback_check",
    """SELECT count(*) FILTER (WHERE classification = 'consistent_new') AS consistent_new, count(*) FILTER (WHERE classification = 'drift_managed_on_old') AS drift,
  count(*) FILTER (WHERE classification NOT IN ('consistent_old', 'path_missing', 'requires_external_handling')) AS offenders, count(*) FILTER (WHERE classification NOT IN ('consistent_old', 'path_missing', 'requires_external_handling')) = 0 AS success FROM {inv}""",
)
def _(inputs):
    return rollback.rollback_check(inputs.inventory())


@query("rollback_offenders", "SELECT k, classification FROM {inv} WHERE classification NOT IN ('consistent_old', 'path_missing', 'requires_external_handling')")
def _(inputs):
    return rollback.rollback_offenders(inputs.inventory()).select("k", "classification")


# Schemas by customer number, so that some hold objects on new only.
_SPREAD = "SELECT * REPLACE ('s' || (k % 701) AS schema) FROM {inv}"


@query(
    "rollback_drop_order",
    f"""SELECT catalog, schema, name, CASE WHEN table_type = 'VIEW' THEN 'VIEW' ELSE object_type END AS kind,
  CASE WHEN table_type = 'VIEW' THEN 1 WHEN object_type = 'VOLUME' THEN 3 WHEN object_type = 'REGISTERED_MODEL' THEN 4 ELSE 2 END AS drop_rank
FROM ({_SPREAD}) WHERE classification = 'consistent_new'
UNION ALL SELECT catalog, schema, NULL, 'SCHEMA', 5 FROM ({_SPREAD}) GROUP BY catalog, schema HAVING bool_and(classification = 'consistent_new')""",
)
def _(inputs):
    spread = inputs.inventory().withColumn("schema", F.concat(F.lit("s"), F.col("k") % 701))
    return rollback.drop_order(spread)


@query("cleanup_targets", "SELECT pre_migration_fqn, object_type FROM {log} WHERE status = 'validated' AND pre_migration_fqn IS NOT NULL")
def _(inputs):
    return cleanup.cleanup_targets(inputs("history"))


_CHECKED = """SELECT *, CASE WHEN pre_migration_fqn = '' THEN 'empty name'
    WHEN len(p) <> 3 OR list_contains(p, '') THEN 'not a three-part name' WHEN NOT ends_with(p[3], '__pre_migration') THEN 'not a shadow name'
    WHEN object_type NOT IN ('TABLE', 'VOLUME') THEN 'unsupported object type' WHEN p[1] = 'main' AND p[2] = 'ops' THEN 'in the ops schema' END AS reject_reason
FROM (SELECT pre_migration_fqn, object_type, string_split(replace(pre_migration_fqn, '`', ''), '.') AS p FROM {src} WHERE status = 'validated' AND pre_migration_fqn IS NOT NULL)"""
_LIVE = "CASE WHEN len(p) = 3 AND NOT list_contains(p, '') AND ends_with(p[3], '__pre_migration') AND p[3] <> '__pre_migration' THEN " + quoted("p[1]", "p[2]", "left(p[3], -15)") + " END"
_FQN = quoted("p[1]", "p[2]", "p[3]")


@query(
    "validate_cleanup_targets",
    f"""SELECT pre_migration_fqn, object_type, reject_reason, CASE WHEN reject_reason IS NULL THEN {_FQN} END AS fqn, CASE WHEN reject_reason IS NULL THEN {_LIVE} END AS live_fqn
FROM ({_CHECKED.replace('{src}', '{bad_log}')})""",
)
def _(inputs):
    return cleanup.validate_targets(cleanup.cleanup_targets(inputs("bad_log")), ops_schema="main.ops")


@query("live_name_of_shadow", f"SELECT pre_migration_fqn, {_LIVE} AS live_fqn FROM ({_CHECKED.replace('{src}', '{bad_log}')})")
def _(inputs):
    return cleanup.cleanup_targets(inputs("bad_log")).select("pre_migration_fqn", cleanup.live_name(F.col("pre_migration_fqn")).alias("live_fqn"))


def _gated(inputs, log, object_types=("TABLE", "VOLUME")):
    targets = cleanup.cleanup_targets(inputs(log)).filter(F.col("object_type").isin(*object_types))
    return cleanup.gate(cleanup.validate_targets(targets, ops_schema="main.ops"))


@query(
    "cleanup_gate",
    f"SELECT 'good' AS log, TRUE AS may_drop, count(*) AS targets FROM {{log}} WHERE status = 'validated' AND object_type IN ('TABLE', 'VOLUME') UNION ALL SELECT 'bad', FALSE, count(*) FROM {{bad_log}} WHERE status = 'validated'",
)
def _(inputs):
    count = lambda rows, name: rows.groupBy(F.lit(name).alias("log"), "may_drop").agg(F.count(F.lit(1)).alias("targets"))
    every = ("TABLE", "VOLUME", "FUNCTION", "REGISTERED_MODEL")
    return count(_gated(inputs, "log"), "good").unionByName(count(_gated(inputs, "bad_log", every), "bad"))


_DECIDED = f"""SELECT {KEYS}, {_PRE} AS fqn, {_ORIG} AS live_fqn, CASE WHEN k % 8 NOT IN (2, 3, 6, 7) THEN 'skipped_absent' WHEN k % 43 = 3 THEN 'unknown'
  WHEN k % 8 NOT IN (1, 3, 5, 7) THEN 'refused_no_live' WHEN k % 41 = 7 THEN 'unknown' ELSE 'drop' END AS decision
FROM {{log}} WHERE status = 'validated' AND object_type IN ('TABLE', 'VOLUME')"""


def _decided(inputs):
    listing = inputs("listing").withColumn("present", F.when(F.col("readable"), F.lit(True)))
    return cleanup.drop_decisions(_gated(inputs, "log"), listing)


@query("drop_decisions", f"SELECT fqn, live_fqn, object_type, decision FROM ({_DECIDED})")
def _(inputs):
    return _decided(inputs).select("fqn", "live_fqn", "object_type", "decision")


@query("drop_statements", f"SELECT fqn, object_type, 'DROP ' || object_type || ' IF EXISTS ' || fqn AS statement FROM ({_DECIDED}) WHERE decision = 'drop'")
def _(inputs):
    return cleanup.drop_statements(_decided(inputs))


def _outcomes(inputs):
    long = F.when(F.col("decision") == "refused_no_live", F.repeat(F.col("live_fqn"), 60))
    status = F.when(F.col("decision") == "drop", "dropped").otherwise(F.col("decision"))
    return _decided(inputs).withColumn("error_message", long).withColumn("status", status)


@query(
    "cleanup_log",
    f"""SELECT TIMESTAMP '2001-01-01' AS ts, fqn AS pre_migration_fqn, object_type, CASE WHEN decision = 'drop' THEN 'dropped' ELSE decision END AS status,
  CASE WHEN decision = 'refused_no_live' THEN repeat(live_fqn, 60) END AS error_message FROM ({_DECIDED})""",
)
def _(inputs):
    path = scratch_path(inputs.spark, "cleanup")
    tables.append_rows(cleanup.cleanup_log_rows(_outcomes(inputs), logged_at=AS_OF), path)
    return inputs.spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("cleanup_totals", f"SELECT CASE WHEN decision = 'drop' THEN 'dropped' ELSE decision END AS status, count(*) AS objects FROM ({_DECIDED}) GROUP BY ALL")
def _(inputs):
    return cleanup.cleanup_totals(cleanup.cleanup_log_rows(_outcomes(inputs), logged_at=AS_OF))


@query(
    "undrop_statements",
    f"""SELECT fqn AS pre_migration_fqn, object_type, CASE WHEN object_type = 'TABLE' THEN 'undrop' ELSE 'undrop_failed' END AS outcome,
  CASE WHEN object_type = 'TABLE' THEN 'UNDROP TABLE ' || fqn END AS statement FROM ({_DECIDED}) WHERE decision = 'drop'""",
)
def _(inputs):
    return cleanup.undrop_statements(cleanup.cleanup_log_rows(_outcomes(inputs), logged_at=AS_OF))


@query(
    "dependency_order",
    """SELECT o.full_name, CAST(w.level AS INTEGER) AS drop_level FROM (SELECT catalog || '.' || schema || '.' || name AS full_name FROM {objects}) o LEFT JOIN (
  WITH RECURSIVE edge AS MATERIALIZED (SELECT * FROM {dependencies}), walk AS (
    SELECT catalog || '.' || schema || '.' || name AS full_name, 0 AS level FROM {objects} WHERE catalog || '.' || schema || '.' || name NOT IN (SELECT depends_on FROM edge)
    UNION ALL SELECT depends_on, level + 1 FROM walk JOIN edge USING (full_name))
  SELECT full_name, max(level) AS level FROM walk GROUP BY full_name) w USING (full_name)""",
)
def _(inputs):
    names = inputs("objects").select(F.concat_ws(".", "catalog", "schema", "name").alias("full_name"))
    return rollback.dependency_order(names, inputs("dependencies"))
