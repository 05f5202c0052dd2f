import pytest

from estate.plans import cleanup

KEY = "catalog string, schema string, name string, object_type string"


def checked(spark, name, kind="TABLE", ops="main.ops"):
    rows = spark.createDataFrame([(name, kind)], "pre_migration_fqn string, object_type string")
    return cleanup.validate_targets(rows, ops_schema=ops).first()


@pytest.mark.parametrize(
    "name, kind, reason",
    [
        ("c.s.t__pre_migration", "TABLE", None),
        ("`c`.`s`.`t__pre_migration`", "volume", None),
        ("c.s.t", "TABLE", "not a shadow name"),
        ("s.t__pre_migration", "TABLE", "not a three-part name"),
        ("c..t__pre_migration", "TABLE", "not a three-part name"),
        ("a.b.c.t__pre_migration", "TABLE", "not a three-part name"),
        ("", "TABLE", "empty name"),
        (None, "TABLE", "empty name"),
        ("c.s.t__pre_migration", "FUNCTION", "unsupported object type"),
        ("c.s.t__pre_migration", None, "unsupported object type"),
        ("main.ops.t__pre_migration", "TABLE", "in the ops schema"),
    ],
)
def test_targets(spark, name, kind, reason):
    row = checked(spark, name, kind)
    assert row.reject_reason == reason
    assert (row.fqn, row.live_fqn) == (("`c`.`s`.`t__pre_migration`", "`c`.`s`.`t`") if reason is None else (None, None))


def test_bare_suffix_has_no_live_name(spark):
    row = checked(spark, "c.s.__pre_migration")
    assert row.reject_reason is None and row.live_fqn is None


def test_one_rejection_blocks_all(spark):
    rows = spark.createDataFrame([("c.s.t__pre_migration", "TABLE"), ("c.s.live", "TABLE")], "pre_migration_fqn string, object_type string")
    gated = cleanup.gate(cleanup.validate_targets(rows, ops_schema=None))
    assert [r.may_drop for r in gated.collect()] == [False, False]
    listing = spark.createDataFrame([("c", "s", "t", "TABLE"), ("c", "s", "t__pre_migration", "TABLE")], KEY)
    assert cleanup.drop_statements(cleanup.drop_decisions(gated, listing)).count() == 0


@pytest.mark.parametrize(
    "shadow, live, decision",
    [(True, True, "drop"), (False, True, "skipped_absent"), (True, False, "refused_no_live"), (None, True, "unknown"), (True, None, "unknown")],
)
def test_decisions(spark, shadow, live, decision):
    seen = [("c", "s", n, "TABLE", None if there is None else True) for n, there in (("t__pre_migration", shadow), ("t", live)) if there is not False]
    rows = spark.createDataFrame([("c.s.t__pre_migration", "TABLE")], "pre_migration_fqn string, object_type string")
    gated = cleanup.gate(cleanup.validate_targets(rows, ops_schema="main.ops"))
    decided = cleanup.drop_decisions(gated, spark.createDataFrame(seen, KEY + ", present boolean"))
    assert decided.first().decision == decision
    assert [r.statement for r in cleanup.drop_statements(decided).collect()] == (
        ["DROP TABLE IF EXISTS `c`.`s`.`t__pre_migration`"] if decision == "drop" else []
    )


def test_undrop(spark):
    log = spark.createDataFrame(
        [("c.s.t__pre_migration", "TABLE", "dropped"), ("c.s.v__pre_migration", "VOLUME", "dropped"), ("c.s.u__pre_migration", "TABLE", "failed")],
        "pre_migration_fqn string, object_type string, status string",
    )
    got = {r.pre_migration_fqn: (r.outcome, r.statement) for r in cleanup.undrop_statements(log).collect()}
    assert got == {
        "c.s.t__pre_migration": ("undrop", "UNDROP TABLE `c`.`s`.`t__pre_migration`"),
        "c.s.v__pre_migration": ("undrop_failed", None),
    }
