"""Validation evidence."""

from pyspark.sql import functions as F

from checks.derived import NEW
from checks.registry import AS_OF, KEYS, SAME, account, query
from estate.operators import differences, verify
from estate.session import scratch_path
from estate.settings import KEY
from estate.sources import tables

_SAME_ROWS = lambda a, b: f"NOT EXISTS (({a}) EXCEPT ALL ({b})) AND NOT EXISTS (({b}) EXCEPT ALL ({a}))"
_LINES = "SELECT * FROM {lineitem}"
_COPIES = {
    "identical": _LINES,
    "order dropped": "SELECT * FROM {lineitem} WHERE l_orderkey <> (SELECT max(l_orderkey) FROM {lineitem})",
    "order duplicated": "SELECT * FROM {lineitem} UNION ALL SELECT * FROM {lineitem} WHERE l_orderkey = (SELECT max(l_orderkey) FROM {lineitem})",
    "all duplicated": "SELECT * FROM {lineitem} UNION ALL SELECT * FROM {lineitem}",
    "value changed": "SELECT * REPLACE (CASE WHEN l_orderkey = (SELECT max(l_orderkey) FROM {lineitem}) THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM {lineitem}",
}


def _moved(rows, *by):
    """The same rows in other tasks, as many as their size asks for."""
    return rows.hint("rebalance", *by)


def _copies(lines):
    last = lines.agg(F.max("l_orderkey").alias("last")).scalar()
    is_last = F.col("l_orderkey") == last
    return {
        "identical": _moved(lines, "l_partkey"),
        "order dropped": lines.filter(~is_last),
        "order duplicated": lines.unionAll(lines.filter(is_last)),
        "all duplicated": lines.unionAll(lines),
        "value changed": lines.withColumn("l_quantity", F.when(is_last, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))),
    }


@query("content_checksum", "SELECT o_orderpriority, count(*) AS n, TRUE AS stable FROM {orders} GROUP BY ALL")
def _(inputs):
    orders = inputs("orders")
    first = verify.fingerprint(orders, by=["o_orderpriority"])
    again = verify.fingerprint(_moved(orders, "o_custkey"), by=["o_orderpriority"])
    compared = verify.compare_fingerprints(first, again, by=["o_orderpriority"])
    return compared.select("o_orderpriority", F.col("source_n").alias("n"), F.col("match").alias("stable"))


@query(
    "compare_content_checksum",
    " UNION ALL ".join(f"SELECT '{name}' AS copy, {_SAME_ROWS(_LINES, text)} AS match" for name, text in _COPIES.items()),
)
def _(inputs):
    lines = inputs("lineitem")
    print_of = verify.fingerprint
    rows = None
    for name, copy in _copies(lines).items():
        verdict = verify.compare_fingerprints(print_of(lines), print_of(copy)).select(F.lit(name).alias("copy"), "match")
        rows = verdict if rows is None else rows.unionAll(verdict)
    return rows


@query(
    "checksum_sees_moved_null",
    "SELECT count(*) FILTER (WHERE k % 2 = 0) = 0 AS match FROM (SELECT o_orderkey AS k FROM {orders})",
)
def _(inputs):
    pair = lambda first, second: inputs("orders").select("o_orderkey", first.alias("a"), second.alias("b"))
    even, text, nothing = F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"), F.lit(None).cast("string")
    left = pair(F.when(even, nothing).otherwise(text), text)
    moved = pair(text, F.when(even, nothing).otherwise(text))
    return verify.compare_fingerprints(verify.fingerprint(left), verify.fingerprint(moved)).select("match")


# Every copy's differing rows, with how often each side has them.
def _counted_differences(name: str, text: str) -> str:
    only = lambda a, b: f"SELECT * FROM (({a}) EXCEPT ALL ({b}))"
    columns = "l_orderkey, l_linenumber, l_partkey, l_quantity"
    sides = f"SELECT *, 1 AS s, 0 AS t FROM ({only(_LINES, text)}) UNION ALL SELECT *, 0 AS s, 1 AS t FROM ({only(text, _LINES)})"
    return f"SELECT '{name}' AS copy, {columns}, CAST(sum(s - t) AS BIGINT) AS surplus FROM ({sides}) GROUP BY ALL"


@query("checksum_differences", " UNION ALL ".join(_counted_differences(n, t) for n, t in _COPIES.items()))
def _(inputs):
    lines = inputs("lineitem")
    rows = None
    for name, copy in _copies(lines).items():
        found = differences.checksum_differences(lines, copy)
        found = found.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").agg(F.sum(F.col("source_rows") - F.col("target_rows")).alias("surplus"))
        found = found.select(F.lit(name).alias("copy"), "*")
        rows = found if rows is None else rows.unionByName(found)
    return rows


# Nested values that differ only in where a null or an empty list stands; each changed copy has to be seen.
_NESTED = {
    "array": ("[k, NULL]", "[NULL, k]"), "shorter": ("[k, NULL]", "[k]"), "struct": ("{'a': NULL, 'b': k}", "{'a': k, 'b': NULL}"),
    "lists": ("[[], [k]]", "[[k], []]"), "list of struct": ("[{'a': k, 'b': NULL}]", "[{'a': NULL, 'b': k}]"), "no list": ("[[k], NULL]", "[[k], []]"),
}


def _nested(k, nothing):
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    none = F.array().cast("array<bigint>")
    return {
        "array": (F.array(k, nothing), F.array(nothing, k)), "shorter": (F.array(k, nothing), F.array(k)), "struct": (pair(nothing, k), pair(k, nothing)),
        "lists": (F.array(none, F.array(k)), F.array(F.array(k), none)), "list of struct": (F.array(pair(k, nothing)), F.array(pair(nothing, k))),
        "no list": (F.array(F.array(k), F.lit(None).cast("array<bigint>")), F.array(F.array(k), none)),
    }


def _nested_oracle(name: str, first: str, changed: str) -> str:
    side = lambda value: f"SELECT o_orderkey, {value} AS v FROM (SELECT o_orderkey, o_orderkey AS k FROM {{orders}})"
    return f"SELECT '{name}' AS value, {_SAME_ROWS(side(first), side(first))} AS kept_match, {_SAME_ROWS(side(first), side(changed))} AS moved_match"


@query("checksum_sees_nested_null", " UNION ALL ".join(_nested_oracle(n, *v) for n, v in _NESTED.items()))
def _(inputs):
    k = F.col("o_orderkey")
    rows = None
    for name, values in _nested(k, F.lit(None).cast("bigint")).items():
        orders = inputs("orders")
        first, changed = (verify.fingerprint(orders.select(k, v.alias("v"))) for v in values)
        again = verify.fingerprint(_moved(orders).select(k, values[0].alias("v")))
        kept = verify.compare_fingerprints(first, again).select(F.lit(name).alias("value"), F.col("match").alias("kept_match"))
        found = kept.crossJoin(verify.compare_fingerprints(first, changed).select(F.col("match").alias("moved_match")))
        rows = found if rows is None else rows.unionByName(found)
    return rows


_CANDIDATES = f"""SELECT l.catalog, l.schema, l.name, l.object_type, l.k, i.data_source_format, i.parent_managed_location, i.table_type
FROM {{log}} l JOIN {{inv}} i ON {SAME('l', 'i')} WHERE l.status = 'validated'"""


def _candidates(inputs):
    return verify.validation_candidates(inputs("history"), inputs.inventory())


@query("validation_candidates", f"SELECT {KEYS}, data_source_format, parent_managed_location, table_type FROM ({_CANDIDATES})")
def _(inputs):
    return _candidates(inputs).drop("pre_migration_fqn")


_L1 = f"""SELECT c.*, a.location, coalesce({account('a.location')} = 'newacct', FALSE) AS metadata_location_ok FROM ({_CANDIDATES}) c LEFT JOIN {{after}} a ON {SAME('a', 'c')}"""


def _located(inputs):
    return verify.location_evidence(_candidates(inputs), inputs("after"), new=NEW)


@query("location_evidence", f"SELECT {KEYS}, location, metadata_location_ok FROM ({_L1})")
def _(inputs):
    return _located(inputs).select(*KEY, "location", "metadata_location_ok")


_L2 = f"""SELECT *, CASE WHEN data_source_format = 'DELTA' AND table_type = 'EXTERNAL' AND location IS NOT NULL
  THEN EXISTS (SELECT 1 FROM {{entries}} e WHERE e.root = rtrim(location, '/') || '/_delta_log') END AS delta_log_at_new_ok FROM ({_L1})"""


@query("log_directory_evidence", f"SELECT {KEYS}, delta_log_at_new_ok FROM ({_L2})")
def _(inputs):
    return verify.log_directory_evidence(_located(inputs), inputs("entries")).select(*KEY, "delta_log_at_new_ok")


_READ = f"SELECT {KEYS}, bool_and({account('path')} = 'newacct') AS ok FROM {{read_paths}} WHERE {account('path')} IS NOT NULL GROUP BY ALL"


@query(
    "file_path_evidence",
    f"SELECT c.catalog, c.schema, c.name, c.object_type, CASE WHEN c.object_type <> 'VOLUME' THEN r.ok END AS input_file_name_ok FROM ({_CANDIDATES}) c LEFT JOIN ({_READ}) r ON {SAME('c', 'r')}",
)
def _(inputs):
    return verify.file_path_evidence(_candidates(inputs), inputs("read_paths"), new=NEW).select(*KEY, "input_file_name_ok")


@query(
    "parent_evidence",
    f"SELECT {KEYS}, CASE WHEN table_type = 'EXTERNAL' THEN NULL ELSE coalesce({account('parent_managed_location')} = 'newacct', FALSE) END AS parent_managed_location_match FROM ({_CANDIDATES})",
)
def _(inputs):
    return verify.parent_evidence(_candidates(inputs), new=NEW).select(*KEY, "parent_managed_location_match")


_KEYED = f"SELECT {KEYS}, k, count(*) AS n FROM {{shadow_rows}} GROUP BY ALL"
# A live copy differs when it is gone (k % 17 = 2) or its first lines were changed.
_L5 = f"""SELECT s.catalog, s.schema, s.name, s.object_type, s.k % 17 <> 2 AND NOT (s.k % 13 = 1 AND EXISTS (SELECT 1 FROM {{shadow_rows}} r WHERE r.k = s.k AND r.l_linenumber = 1)) AS ok FROM ({_KEYED}) s"""


def _prints(inputs):
    shown = lambda name: verify.fingerprint(inputs(name).drop("k"), by=KEY)
    return shown("shadow_rows"), shown("live_rows")


@query(
    "table_checksum_evidence",
    f"SELECT c.catalog, c.schema, c.name, c.object_type, CASE WHEN coalesce(c.table_type, '') <> 'EXTERNAL' AND c.object_type <> 'VOLUME' THEN s.ok END AS content_checksum_ok FROM ({_CANDIDATES}) c LEFT JOIN ({_L5}) s ON {SAME('c', 's')}",
)
def _(inputs):
    return verify.table_checksum_evidence(_candidates(inputs), *_prints(inputs)).select(*KEY, "content_checksum_ok")


_L6 = f"""SELECT {KEYS}, bool_and(doc_id % 50 <> 0 AND doc_id % 50 <> 3) AS ok, bool_or(doc_id % 50 <> 0 AND k % 70 <> 8) AS there FROM {{volume_files}} GROUP BY ALL"""


@query(
    "volume_hash_evidence",
    f"SELECT o.catalog, o.schema, o.name, o.object_type, CASE WHEN coalesce(o.table_type, '') <> 'EXTERNAL' AND o.object_type = 'VOLUME' AND s.there THEN s.ok END AS volume_content_checksum_ok FROM {{objects}} o LEFT JOIN ({_L6}) s ON {SAME('o', 's')}",
)
def _(inputs):
    rows = verify.volume_hash_evidence(inputs("objects"), inputs("volume_files"), inputs("copied_volume_files"))
    return rows.select(*KEY, "volume_content_checksum_ok")


# Every combination of the six flags: the base-3 digits of k.
def _flagged(inputs):
    rows = inputs("objects")
    for i, name in enumerate(verify.LAYERS):
        digit = F.floor(F.col("k") / F.lit(3**i)) % 3
        rows = rows.withColumn(name, F.when(digit == 1, True).when(digit == 2, False))
    return rows


_DIGIT = lambda i: f"(k // {3**i}) % 3"
_PASS = f"NOT ({' OR '.join(f'{_DIGIT(i)} = 2' for i in range(6))}) AND ({' OR '.join(f'{_DIGIT(i)} = 1' for i in range(6))})"


@query("overall_pass", f"SELECT k, {_PASS} AS overall_pass FROM {{objects}}")
def _(inputs):
    return verify.attach_overall(_flagged(inputs)).select("k", "overall_pass")


@query(
    "evidence_json",
    f"""SELECT {KEYS}, '{{"location":' || coalesce('"' || location || '"', 'null') || ',"metadata_location_ok":' || CASE WHEN metadata_location_ok THEN 'true' ELSE 'false' END
  || ',"table_type":' || coalesce('"' || table_type || '"', 'null') || '}}' AS evidence FROM ({_L1})""",
)
def _(inputs):
    return _located(inputs).select(*KEY, verify.evidence_json(["table_type", "metadata_location_ok", "location"]).alias("evidence"))


def _results(inputs, **options):
    return verify.result_rows(_flagged(inputs), validated_at=AS_OF, **options)


@query(
    "write_validation_results",
    f"SELECT {KEYS}, {_DIGIT(0)} = 1 AS metadata_location_ok, {_DIGIT(5)} = 1 AS volume_content_checksum_ok, FALSE AS grants_ok, {_PASS} AS overall_pass FROM {{objects}}",
)
def _(inputs):
    path = scratch_path(inputs.spark, "results")
    tables.write_validation_results(_results(inputs, nulls_as_false=True), path)
    return inputs.spark.read.parquet(path).select(*KEY, "metadata_location_ok", "volume_content_checksum_ok", "grants_ok", "overall_pass")


# All columns of the stored results, with the flags of a live state in which some things differ.
@query(
    "validation_results_with_governance",
    f"""SELECT {KEYS}, {', '.join(f'{_DIGIT(i)} = 1 AS {n}' for i, n in enumerate(verify.LAYERS))}, {_PASS} AS overall_pass,
  k % 3 <> 0 AND k % 5 <> 0 AS grants_ok, k % 4 <> 0 AND k % 5 <> 0 AS owner_ok, k % 5 <> 0 AS tags_ok, k % 5 <> 0 AS row_filter_ok, k % 5 <> 0 AS column_mask_ok, k % 5 <> 0 AS comments_ok,
  TIMESTAMP '2001-01-01' AS validated_at, CAST(length(name) AS BIGINT) > 0 AS has_evidence FROM {{objects}}""",
)
def _(inputs):
    k = F.col("k")
    diff = inputs("objects").filter(k % 5 != 0).select(*KEY, *[
        (k % 3 != 0 if n == "grants_ok" else k % 4 != 0 if n == "owner_ok" else F.lit(True)).alias(n) for n in verify.GOVERNANCE_FLAGS
    ])
    path = scratch_path(inputs.spark, "results")
    rows = verify.result_rows(verify.attach_governance(_flagged(inputs), diff), validated_at=AS_OF, nulls_as_false=True)
    tables.write_validation_results(rows, path)
    read = inputs.spark.read.parquet(path).withColumn("validated_at", F.col("validated_at").cast("timestamp_ntz"))
    return read.withColumn("has_evidence", F.length("evidence_json") > 2).drop("evidence_json")


_COPIES = ("orders", "lineitem", "customer", "part")


@query(
    "fingerprint_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {{{t}}}) AS n, TRUE AS copy_match, FALSE AS changed_match" for t in _COPIES),
)
def _(inputs):
    frames = [(t, inputs(t)) for t in _COPIES]
    changed = [(t, f.withColumn(f.columns[0], F.col(f.columns[0]) + 1)) for t, f in frames]
    source = verify.fingerprint_tables(frames, batch=3)
    match = lambda other: verify.compare_fingerprints(source, verify.fingerprint_tables(other, batch=3), by=["table"])
    copy = match([(t, _moved(f)) for t, f in frames]).select("table", F.col("source_n").alias("n"), F.col("match").alias("copy_match"))
    return copy.join(match(changed).select("table", F.col("match").alias("changed_match")), "table")


@query("validation_failures", f"SELECT {KEYS}, CASE {_DIGIT(1)} WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS delta_log_at_new_ok FROM {{objects}} WHERE NOT ({_PASS})")
def _(inputs):
    return verify.failures(_results(inputs)).select(*KEY, "delta_log_at_new_ok")


@query("validation_pass_counts", f"SELECT count(*) FILTER (WHERE {_PASS}) AS passed, count(*) AS total FROM {{objects}}")
def _(inputs):
    return verify.pass_counts(_results(inputs))


@query("validation_by_catalog", f"SELECT catalog, count(*) FILTER (WHERE {_PASS}) AS passed, count(*) FILTER (WHERE NOT ({_PASS})) AS failed FROM {{objects}} GROUP BY catalog")
def _(inputs):
    return verify.pass_counts_by_catalog(_results(inputs))
