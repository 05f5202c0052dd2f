"""Decision report."""

from pyspark.sql import functions as F

from checks.registry import AS_OF, CLASSES, query
from estate.operators import report
from estate.settings import CLASSES as OUR_CLASSES, EXTERNAL_HANDLING

_COUNTS = ", ".join(f"count(*) FILTER (WHERE classification = '{c}') AS {c}" for c in CLASSES)


@query(
    "class_counts",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS classification, count(*) FILTER (WHERE classification = '{c}') AS objects FROM {{inv}}" for i, c in enumerate(CLASSES)
    ),
)
def _(inputs):
    return report.class_counts(inputs.inventory())


@query(
    "class_counts_all_eight",
    "SELECT classification, count(*) AS objects FROM {inv} GROUP BY ALL",
)
def _(inputs):
    return report.class_counts(inputs.inventory(), classes=[*OUR_CLASSES, EXTERNAL_HANDLING]).drop("position")


@query("class_counts_by_catalog", f"SELECT catalog, {_COUNTS} FROM {{inv}} GROUP BY catalog")
def _(inputs):
    return report.class_counts_by_catalog(inputs.inventory())


@query(
    "top_drift_catalogs",
    "SELECT catalog, count(*) AS drift FROM {inv} WHERE classification = 'drift_managed_on_old' GROUP BY catalog ORDER BY drift DESC, catalog LIMIT 10",
)
def _(inputs):
    return report.top_drift_catalogs(inputs.inventory())


_FULL = "catalog || '.' || schema || '.' || name AS full_name"


@query(
    "pipeline_objects",
    f"""SELECT {_FULL}, table_type, classification, (SELECT count(*) FROM {{inv}} WHERE requires_pipeline_handling) AS total
FROM {{inv}} WHERE requires_pipeline_handling ORDER BY catalog, schema, name, object_type LIMIT 50""",
)
def _(inputs):
    return report.pipeline_objects(inputs.inventory())


@query(
    "unknown_account_objects",
    f"""SELECT {_FULL}, storage_path, (SELECT count(*) FROM {{inv}} WHERE classification = 'unknown_account') AS total
FROM {{inv}} WHERE classification = 'unknown_account' ORDER BY catalog, schema, name, object_type LIMIT 50""",
)
def _(inputs):
    return report.unknown_account_objects(inputs.inventory())


_SIZABLE = "FROM {inv} WHERE classification <> 'path_missing' AND coalesce(table_type, '') <> 'VIEW'"


@query(
    "size_coverage",
    f"""SELECT count(size_bytes) AS sized, count(*) AS total_sizable, 100.0 * (count(*) - count(size_bytes))::DOUBLE / count(*) AS pct_missing,
  CAST(sum(size_bytes) AS BIGINT) AS total_bytes {_SIZABLE}""",
)
def _(inputs):
    return report.size_coverage(inputs.inventory())


@query("size_coverage_by_type", f"SELECT object_type, count(size_bytes) AS sized, count(*) AS total_sizable {_SIZABLE} GROUP BY object_type")
def _(inputs):
    return report.size_coverage_by_type(inputs.inventory())


def _verdict(where: str, age: int, objects: int, gib: float, owners: int) -> str:
    return f"""SELECT CASE WHEN age > {age} OR n > {objects} OR gib > {gib} OR owners > {owners} THEN 'FORWARD_MIGRATE_REQUIRED'
    WHEN n = 0 THEN 'ROLLBACK_FEASIBLE' ELSE 'ROLLBACK_REQUIRES_SIGNOFF' END AS verdict,
  CASE WHEN age > {age} THEN 'oldest object on new is ' || age || ' days old, limit {age}'
    WHEN n > {objects} OR gib > {gib} OR owners > {owners} THEN n || ' objects, ' || printf('%.1f', gib) || ' GiB and ' || owners || ' owners on new exceed the limits'
    WHEN n = 0 THEN 'nothing is on new' ELSE n || ' objects on new are within the limits and need a sign-off' END AS why,
  n AS new_object_count, bytes AS bytes_on_new
FROM (SELECT count(*) AS n, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes, coalesce(sum(size_bytes), 0) / 1073741824.0::DOUBLE AS gib,
        count(DISTINCT owner) AS owners, coalesce(max(date_diff('day', created_at, TIMESTAMP '2001-01-01')), 0) AS age
      FROM {{inv}} WHERE classification = 'consistent_new' AND {where})"""


@query("recommendation", _verdict("TRUE", 30, 25, 10.0, 3))
def _(inputs):
    return report.recommendation(inputs.inventory(), as_of=AS_OF)


@query("recommendation_by_volume", _verdict("TRUE", 100000, 25, 10.0, 3))
def _(inputs):
    return report.recommendation(inputs.inventory(), as_of=AS_OF, max_age_days=100000)


@query("recommendation_signoff", _verdict("TRUE", 100000, 10**9, 1e12, 100))
def _(inputs):
    return report.recommendation(inputs.inventory(), as_of=AS_OF, max_age_days=100000, max_objects=10**9, max_gib=1e12, max_owners=100)


@query("bytes_on_new", "SELECT CAST(sum(size_bytes) AS BIGINT) AS bytes_on_new FROM {inv} WHERE classification = 'consistent_new'")
def _(inputs):
    return report.bytes_on_new(inputs.inventory())


@query(
    "rollback_ledger",
    f"""SELECT {_FULL}, object_type, owner, created_at, size_bytes, regexp_matches(name, '_test_|_tmp_|_sandbox_|_scratch_') AS looks_throwaway
FROM {{inv}} WHERE classification = 'consistent_new'""",
)
def _(inputs):
    return report.rollback_ledger(inputs.inventory())


@query(
    "throwaway_names",
    """SELECT k, contains(label, '_test_') OR contains(label, '_tmp_') OR contains(label, '_sandbox_') OR contains(label, '_scratch_') AS looks_throwaway
FROM (SELECT k, CASE k % 5 WHEN 0 THEN 'a_test_' WHEN 1 THEN 'b_tmp_x' WHEN 2 THEN '_scratch_' WHEN 3 THEN '_sandbox' ELSE 'test_' END || k AS label, classification FROM {inv})
WHERE classification = 'consistent_new'""",
)
def _(inputs):
    start = F.element_at(F.array(*[F.lit(p) for p in ("a_test_", "b_tmp_x", "_scratch_", "_sandbox", "test_")]), (F.col("k") % 5 + 1).cast("int"))
    named = inputs.inventory().withColumn("name", F.concat(start, "k"))
    return report.rollback_ledger(named).select(
        F.regexp_extract("full_name", r"(\d+)$", 1).cast("long").alias("k"), "looks_throwaway"
    )


@query(
    "forward_cost",
    """SELECT drift_objects, external_objects, drift_bytes, cross_region, gib, rate, gib / rate / 3600 AS hours, gib / rate / 3600 * 1.5::DOUBLE AS dbu
FROM (SELECT *, drift_bytes / 1073741824.0::DOUBLE AS gib, CASE WHEN cross_region THEN 0.15::DOUBLE ELSE 0.5::DOUBLE END AS rate FROM
  (SELECT count(*) FILTER (WHERE classification = 'drift_managed_on_old') AS drift_objects, count(*) FILTER (WHERE classification = 'external_on_old') AS external_objects,
     CAST(sum(size_bytes) FILTER (WHERE classification = 'drift_managed_on_old') AS BIGINT) AS drift_bytes,
     (SELECT count(DISTINCT region) > 1 FROM {locations}) AS cross_region FROM {inv}))""",
)
def _(inputs):
    return report.forward_cost(inputs.inventory(), inputs("locations"))


@query("cross_region", "SELECT count(DISTINCT region) > 1 AS cross_region FROM {locations}")
def _(inputs):
    return report.cross_region(inputs("locations"))
