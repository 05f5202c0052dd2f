import itertools

import pytest
from pyspark.sql import functions as F

from estate.operators import state
from estate.plans import migration, rollback

KEY = "catalog string, schema string, name string, object_type string"
STATES = {
    (True, False, False): "pristine", (True, False, True): "cloned", (False, True, True): "swap_partial", (True, True, False): "swapped",
    (True, True, True): "swapped_orphan", (False, True, False): "gap", (False, False, True): "only_staging", (False, False, False): "absent",
}


def listing(spark, names):
    return spark.createDataFrame([("c", "s", n, "TABLE") for n in names] or [("x", "x", "x", "TABLE")], KEY)


@pytest.mark.parametrize("flags", list(itertools.product([True, False], repeat=3)))
def test_states(spark, flags):
    names = [n for n, there in zip(("t", "t__pre_migration", "t__migrate_staging"), flags) if there]
    rows = spark.createDataFrame([("c", "s", "t", "TABLE")], KEY)
    row = state.attach_state(rows, listing(spark, names)).first()
    assert row.state == STATES[flags] and (row.orig_exists, row.pre_exists, row.staging_exists) == flags
    assert state.flag_resumable(state.attach_state(rows, listing(spark, names))).first().resumable == (row.state in state.PHASES)


def test_existence_needs_the_object_type(spark):
    rows = spark.createDataFrame([("c", "s", "t", "VOLUME")], KEY)
    assert state.attach_state(rows, listing(spark, ["t"])).first().state == "absent"


def test_unreadable_is_unknown(spark):
    rows = spark.createDataFrame([("c", "s", "t", "TABLE")], KEY)
    seen = spark.createDataFrame([("c", "s", "t", "TABLE", None)], KEY + ", present boolean")
    row = state.attach_state(rows, seen).first()
    assert row.orig_exists is None and row.state == "unknown"


def test_suffixed_object_has_its_own_state(spark):
    rows = spark.createDataFrame([("c", "s", "t", "TABLE"), ("c", "s", "t__pre_migration", "TABLE")], KEY)
    got = {r.name: r.state for r in state.attach_state(rows, listing(spark, ["t__pre_migration"])).collect()}
    assert got == {"t": "gap", "t__pre_migration": "pristine"}


def test_phases(spark):
    rows = spark.createDataFrame([("c", "s", s, "TABLE", s) for s in sorted(STATES.values())], KEY + ", state string")
    got = {}
    for r in state.resume_phases(rows).orderBy("phase_no").collect():
        got.setdefault(r.state, []).append(r.phase)
    assert got == state.PHASES and got["cloned"][0] == "rename_orig_to_pre" and got["swapped_orphan"][-1] == "drop_orphan_staging"


def test_worklist(spark):
    rows = spark.createDataFrame([("c", "s", n, "TABLE") for n in "abc"], KEY)
    log = spark.createDataFrame([("c", "s", "a", "TABLE", "validated"), ("c", "s", "c", "TABLE", "validated"), ("c", "s", "b", "TABLE", "failed")], KEY + ", status string")
    assert [r.name for r in state.forward_worklist(rows, log).collect()] == ["b"]
    assert [r.name for r in state.failed_worklist(rows, log).collect()] == ["b"]


def claims(spark, candidates, log):
    wanted = spark.createDataFrame([("c", "s", n, "TABLE", actor, at) for n, actor, at in candidates], KEY + ", actor string, claimed_at string")
    known = spark.createDataFrame(
        [("c", "s", n, "TABLE", by, status, "2020-01-01") for n, by, status in log], KEY + ", claimed_by string, status string, claimed_at string"
    )
    return {(r.name, r.actor): r.granted for r in state.claim(wanted, known).collect()}, state.new_claims(wanted, known)


def test_claim(spark):
    granted, fresh = claims(
        spark,
        [("new", "a", "2024-01-02"), ("new", "b", "2024-01-01"), ("mine", "a", "2024-01-01"), ("theirs", "a", "2024-01-01"), ("done", "a", "2024-01-01")],
        [("mine", "a", "cloned"), ("theirs", "b", "claimed"), ("done", "a", "validated")],
    )
    assert granted == {("new", "a"): False, ("new", "b"): True, ("mine", "a"): True, ("theirs", "a"): False, ("done", "a"): False}
    assert [(r.name, r.claimed_by, r.status) for r in fresh.collect()] == [("new", "b", "claimed")]


def test_one_winner_per_object_however_many_ask(spark):
    granted, fresh = claims(spark, [("hot", f"r{i}", "2024-01-01") for i in range(50)], [("x", "y", "claimed")])
    assert sum(granted.values()) == 1 and granted[("hot", "r0")] and fresh.count() == 1


def test_log_update_and_latest(spark):
    log = state.log_rows(
        spark.createDataFrame([("c", "s", "t", "TABLE", "claimed", "a", "2024-01-01")], KEY + ", status string, claimed_by string, updated_at string")
    )
    later = state.log_update(log, updated_at="2024-01-02", changes={"status": F.lit("cloned"), "row_count_before": F.lit(5)})
    row = state.latest_log(log.unionByName(later)).first()
    assert (row.status, row.claimed_by, row.row_count_before) == ("cloned", "a", 5)


def test_action_status(values):
    assert values(state.action_status, ["clone", "rename_staging", "replayed"]) == ["cloned", "swapped", "replayed"]


ROW = KEY + ", table_type string, storage_path string, data_source_format string, orig_exists boolean, pre_exists boolean, staging_exists boolean"


def plan(spark, kind="TABLE", table_type="MANAGED", path="s3://old/t", fmt="delta", flags=(True, False, False)):
    rows = spark.createDataFrame([("c", "s", "t", kind, table_type, path, fmt, *flags)], ROW)
    return [(r.label, r.statement) for r in rollback.plan_rollback(rows).orderBy("step_no").collect()]


def test_rollback_after_full_swap(spark):
    assert plan(spark, flags=(True, True, False)) == [
        ("drop_migrated", "DROP TABLE IF EXISTS `c`.`s`.`t`"),
        ("restore_shadow", "ALTER TABLE `c`.`s`.`t__pre_migration` RENAME TO `c`.`s`.`t`"),
    ]


def test_rollback_after_half_swap(spark):
    assert [label for label, _ in plan(spark, flags=(False, True, True))] == ["restore_shadow", "drop_staging"]


def test_rollback_of_clone_and_of_nothing(spark):
    assert plan(spark, flags=(True, False, True)) == [("drop_staging", "DROP TABLE IF EXISTS `c`.`s`.`t__migrate_staging`")]
    assert [label for label, _ in plan(spark)] == ["noop"]
    assert [label for label, _ in plan(spark, flags=(False, False, True))] == ["warn"]
    assert [label for label, _ in plan(spark, flags=(False, False, False))] == ["error"]
    assert [label for label, _ in plan(spark, flags=(None, True, False))] == ["warn"]


def test_rollback_of_volume(spark):
    assert plan(spark, kind="VOLUME", flags=(True, True, False))[1][1] == "ALTER VOLUME `c`.`s`.`t__pre_migration` RENAME TO `c`.`s`.`t`"


def test_rollback_of_external(spark):
    assert plan(spark, table_type="EXTERNAL") == [
        ("drop_migrated", "DROP TABLE IF EXISTS `c`.`s`.`t`"),
        ("recreate_external", "CREATE EXTERNAL TABLE `c`.`s`.`t` USING DELTA LOCATION 's3://old/t'"),
    ]
    assert plan(spark, kind="VOLUME", table_type="EXTERNAL", flags=(False, False, False)) == [
        ("recreate_external", "CREATE EXTERNAL VOLUME `c`.`s`.`t` LOCATION 's3://old/t'")
    ]
    assert plan(spark, table_type="EXTERNAL", fmt=None)[1][1].endswith("USING DELTA LOCATION 's3://old/t'")
    assert [label for label, _ in plan(spark, table_type="EXTERNAL", path=None)] == ["error"]


@pytest.mark.parametrize("flags", list(itertools.product([True, False], repeat=3)))
def test_rollback_leads_back_to_pristine(spark, flags):
    """Run the planned steps on the set of names: the original is back and nothing else is left."""
    names = {n for n, there in zip(("t", "t__pre_migration", "t__migrate_staging"), flags) if there}
    steps = plan(spark, flags=flags)
    if steps[0][0] in ("error", "warn"):
        assert "t" not in names and "t__pre_migration" not in names
        return
    for label, statement in steps:
        last = lambda text: text.split(".")[-1].strip("`")
        if label in ("drop_migrated", "drop_staging"):
            names.remove(last(statement))
        elif label == "restore_shadow":
            names.remove("t__pre_migration")
            names.add(last(statement))
    assert names == {"t"}


INV = KEY + ", table_type string, data_source_format string, storage_path string, classification string, requires_pipeline_handling boolean"


@pytest.mark.parametrize(
    "kind, table_type, fmt, cls, pipeline, expected",
    [
        ("TABLE", "MANAGED", "DELTA", "drift_managed_on_old", False, "clone"),
        ("TABLE", "MANAGED", None, "drift_managed_on_old", False, "ctas"),
        ("TABLE", "STREAMING_TABLE", None, "drift_managed_on_old", True, "hand_off"),
        ("TABLE", "EXTERNAL", None, "external_on_old", False, "external_table"),
        ("VOLUME", "EXTERNAL", None, "external_on_old", False, "external_volume"),
        ("VOLUME", "MANAGED", None, "drift_managed_on_old", False, "volume_copy"),
        ("TABLE", "MANAGED", "DELTA", "consistent_new", False, None),
    ],
)
def test_route(spark, kind, table_type, fmt, cls, pipeline, expected):
    rows = spark.createDataFrame([("c", "s", "t", kind, table_type, fmt, "s3://old/t", cls, pipeline)], INV)
    assert migration.route(rows).first().route == expected
    if expected == "volume_copy":
        assert migration.route(rows, skip_managed_volumes=True).first().route == "volume_skipped"


def test_external_steps_and_faults(spark):
    rows = spark.createDataFrame(
        [("c", "s", n, "TABLE", "EXTERNAL", None, p, "external_on_old", False) for n, p in (("a", "s3a://old/t"), ("b", None), ("d", "file:/x"))], INV
    )
    got = {}
    for r in migration.plan_steps(migration.route(rows), new="new").orderBy("name", "step_no").collect():
        got.setdefault(r.name, []).append((r.action, r.statement))
    assert got["a"] == [
        ("drop", "DROP TABLE `c`.`s`.`a`"),
        ("create", "CREATE EXTERNAL TABLE `c`.`s`.`a` USING DELTA LOCATION 's3://new/t'"),
    ]
    assert [a for a, _ in got["b"]] == ["error"] and [a for a, _ in got["d"]] == ["error"]


def test_location_cover(spark):
    targets = spark.createDataFrame([(1, "s3://b/x/y"), (2, "s3://b/xx"), (3, "s3://b/x"), (4, "s3://other/x")], "k int, target_path string")
    locations = spark.createDataFrame([(1, "deep", "s3://b/x/y/"), (0, "top", "s3://b/x/"), (2, "all", "s3://b")], "pos int, name string, url string")
    got = {r.k: r.location_name for r in migration.location_cover(targets, locations, keys=["k"]).collect()}
    assert got == {1: "top", 2: "all", 3: "top", 4: None}


def test_completeness(spark):
    entries = spark.createDataFrame([("o1",)] * 3 + [("n1",)] * 3 + [("o2",)] * 5 + [("n2",)] * 3, "root string")
    targets = spark.createDataFrame([(1, "o1", "n1"), (2, "o2", "n2"), (3, "o3", "n3")], "k int, old_path string, new_path string")
    got = {r.k: (r.complete, r.warn) for r in migration.entry_completeness(targets, entries, keys=["k"]).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (False, False)}


def test_staged_rewrite(spark, tmp_path):
    spark.range(10).write.mode("overwrite").option("path", str(tmp_path / "a")).saveAsTable("rewrite_me")
    row = migration.staged_rewrite(spark, "rewrite_me", shadow="rewrite_me_shadow", staging="rewrite_me_staging", location=str(tmp_path / "b")).first()
    assert row.match and row.source_n == 10
    assert spark.table("rewrite_me").count() == spark.table("rewrite_me_shadow").count() == 10
    assert not spark.catalog.tableExists("rewrite_me_staging")
    for name in ("rewrite_me", "rewrite_me_shadow"):
        spark.sql(f"DROP TABLE {name}")
