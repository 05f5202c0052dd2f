"""Cases in which a plausible answer would lose data."""

import json

import pytest
from pyspark.sql import functions as F

from estate.functions.text import list_cell, quote_literal
from estate.operators import governance, state, verify
from estate.plans import cleanup, governance as plans, migration, rollback

K = "catalog string, schema string, name string, object_type string"


def test_state_is_the_last_event(spark):
    events = [("a", "failed", 1), ("a", "validated", 2), ("b", "validated", 1), ("b", "rolled_back", 2), ("d", "validated", 1), ("d", "failed", 2)]
    rows = [("c", "s", n, "TABLE", status, f"2001-01-0{at} 00:00:00", "c.s." + n + "__pre_migration") for n, status, at in events]
    log = spark.createDataFrame(rows, K + ", status string, updated_at string, pre_migration_fqn string").withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    objects = log.select("catalog", "schema", "name", "object_type").distinct()
    inventory = objects.selectExpr("*", "'DELTA' AS data_source_format", "'x' AS parent_managed_location", "'MANAGED' AS table_type")
    names = lambda frame: sorted(r.name for r in frame.collect())
    assert names(state.forward_worklist(objects, log)) == ["b", "d"]
    assert names(state.failed_worklist(objects, log)) == ["d"]
    assert names(verify.validation_candidates(log, inventory)) == ["a"]
    assert names(rollback.rollback_candidates(log, inventory)) == ["a", "d"]
    assert [r.pre_migration_fqn for r in cleanup.cleanup_targets(log).collect()] == ["c.s.a__pre_migration"]
    assert names(rollback.unrecoverable_objects(log, objects.where("name = 'none'"))) == ["a"]


def test_a_column_called_owner_is_not_the_owner(spark):
    rows = [("c", "s", "t", "TABLE", i, label, kind) for i, (label, kind) in enumerate([("owner", "string"), ("", None), ("# Detailed Table Information", ""), ("Owner", "me")])]
    rows += [("c", "s", "u", "TABLE", 1, "owner", "string")]
    describe = spark.createDataFrame(rows, K + ", pos int, col_name string, data_type string").withColumn("comment", F.lit(None).cast("string"))
    assert [(r.name, r.owner) for r in governance.described_owners(describe).collect()] == [("t", "me")]


def test_list_cells_and_repeated_properties(spark):
    rows = spark.createDataFrame([("c", "s", "t", "TABLE", 1, "f", [" a", "", "b"])], K + ", pos int, function_name string, using_columns array<string>").withColumn("column_name", F.lit("x"))
    assert governance.row_filters(rows).first().row_filter_using_columns == ["a", "b"]
    assert governance.column_masks(rows).first().using_columns == ["a", "b"]
    assert spark.range(1).select(list_cell(F.lit(" a,,b ")).alias("x")).first().x == ["a", "b"]
    properties = spark.createDataFrame([("c", "s", "t", "TABLE", "k", "z", 1), ("c", "s", "t", "TABLE", "k", "a", 2), ("c", "s", "t", "TABLE", None, "n", 3)], K + ", key string, value string, pos int")
    assert governance.property_maps(properties).first().table_properties == {"k": "a"}
    assert governance.property_maps(properties.drop("pos")).first().table_properties == {"k": "z"}


def test_literals_and_tags_without_value(spark):
    text = spark.range(1).select(quote_literal(F.lit("it's b\\")).alias("x")).first().x
    assert text == "'it''s b\\\\'" and spark.sql("SELECT " + text.replace("''", "\\'") + " AS x").first().x == "it's b\\"
    snapshot = {"grants": [], "tags": [{"name": "pii", "value": None}, {"name": "n", "value": "v"}], "column_masks": []}
    rows = spark.createDataFrame([("c", "s", "t", "TABLE", json.dumps(snapshot))], K + ", snapshot_json string")
    assert [r.statement for r in plans.replay_statements(rows).collect()] == ["ALTER TABLE `c`.`s`.`t` SET TAGS ('pii', 'n' = 'v')"]


def test_volume_plan_keeps_the_original(spark):
    rows = spark.createDataFrame([("c", "s", "v", "VOLUME", "volume_copy")], K + ", route string")
    steps = migration.managed_volume_steps(rows).orderBy("step_no").collect()
    assert [s.action for s in steps] == ["create_staging", "copy", "verify", "rename_orig", "rename_staging"]
    assert not any("DROP" in (s.statement or "") for s in steps)


def test_location_text_is_a_literal(spark):
    rows = spark.createDataFrame([("c", "s", "t", "TABLE", "EXTERNAL", "s3://old/it's", "external_table", "DELTA")], K + ", table_type string, storage_path string, route string, data_source_format string")
    create = migration.plan_steps(rows, new="new").where("action = 'create'").first().statement
    assert create.endswith("LOCATION 's3://new/it''s'")


@pytest.mark.parametrize("pair", ["map('a', 1, 'b', 2)|map('b', 2, 'a', 1)", "struct(map(1, map('x', 1, 'y', 2)) AS m)|struct(map(1, map('y', 2, 'x', 1)) AS m)", "array(map('p', array(1), 'q', array(2)))|array(map('q', array(2), 'p', array(1)))"])
def test_maps_at_any_depth_hash_without_their_order(spark, pair):
    one, two = (spark.range(1).select(F.expr(e).alias("x")) for e in pair.split("|"))
    assert verify.compare_fingerprints(verify.fingerprint(one), verify.fingerprint(two)).first().match
    nothing = one.select(F.when(F.lit(False), F.col("x")).alias("x"))
    assert not verify.compare_fingerprints(verify.fingerprint(one), verify.fingerprint(nothing)).first().match
