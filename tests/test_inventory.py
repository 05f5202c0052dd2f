import datetime as dt

import pytest
from estate.operators import inventory as inv, report

OBJECT = "catalog string, schema string, name string, object_type string, table_type string, data_source_format string, storage_path string, parent_managed_location string, owner string, created_at timestamp, size_bytes long"
OLD_URL, NEW_URL, THIRD = (f"abfss://c@{a}.dfs.core.windows.net/x" for a in ("oldacct", "newacct", "third"))


def objects(spark, *rows):
    full = [("c", "s", f"t{i}", *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, OBJECT)


@pytest.mark.parametrize(
    "kind, table_type, path, parent, expected",
    [
        ("TABLE", "MANAGED", OLD_URL, OLD_URL, "consistent_old"),
        ("TABLE", "MANAGED", NEW_URL, NEW_URL, "consistent_new"),
        ("TABLE", "MANAGED", OLD_URL, NEW_URL, "drift_managed_on_old"),
        ("TABLE", "MANAGED", NEW_URL, OLD_URL, "consistent_new"),
        ("TABLE", "MATERIALIZED_VIEW", OLD_URL, NEW_URL, "drift_managed_on_old"),
        ("TABLE", "EXTERNAL", OLD_URL, NEW_URL, "external_on_old"),
        ("VOLUME", "EXTERNAL", NEW_URL, None, "external_on_new"),
        ("TABLE", None, OLD_URL, None, "external_on_old"),
        ("TABLE", "MANAGED", THIRD, NEW_URL, "unknown_account"),
        ("TABLE", "MANAGED", OLD_URL, None, "unknown_account"),
        ("TABLE", "MANAGED", "file:/x", NEW_URL, "unknown_account"),
        ("TABLE", "MANAGED", "", NEW_URL, "unknown_account"),
        ("TABLE", "MANAGED", None, NEW_URL, "path_missing"),
        ("TABLE", "VIEW", OLD_URL, NEW_URL, "path_missing"),
        ("FUNCTION", None, None, None, "requires_external_handling"),
        ("REGISTERED_MODEL", None, OLD_URL, OLD_URL, "requires_external_handling"),
    ],
)
def test_classes(spark, kind, table_type, path, parent, expected):
    rows = objects(spark, (kind, table_type, "DELTA", path, parent, None, None, None))
    assert inv.classify(rows, old="OldAcct", new="newacct").first().classification == expected


def test_classes_by_prefix(spark):
    rows = objects(spark, ("TABLE", "MANAGED", None, "s3://b1b/old/t", "s3://b1b/new", None, None, None))
    assert inv.classify(rows, old="b1b/old", new="b1b/new").first().classification == "drift_managed_on_old"


def test_allow_list(spark):
    rows = objects(spark, ("TABLE", "MANAGED", None, None, None, None, None, None))
    assert inv.keep_catalogs(rows, ["c"]).count() == 1 and inv.keep_catalogs(rows, ["d"]).count() == 0
    with pytest.raises(ValueError):
        inv.keep_catalogs(rows, [])
    assert inv.keep_catalogs(rows, [], allow_all=True).count() == 1


def test_parent_falls_back_to_catalog(spark):
    rows = objects(spark, ("TABLE", "MANAGED", None, None, None, None, None, None)).drop("parent_managed_location")
    catalogs = spark.createDataFrame([("c", "root")], "catalog string, storage_root string")
    for schema_root, expected in (("own", "own"), ("", "root"), (None, "root")):
        schemas = spark.createDataFrame([("c", "s", schema_root)], "catalog string, schema string, storage_root string")
        assert inv.attach_parent_location(rows, catalogs, schemas).first().parent_managed_location == expected


def test_size_reasons(spark):
    rows = objects(
        spark,
        ("TABLE", "STREAMING_TABLE", None, None, None, None, None, None),
        ("TABLE", "VIEW", "parquet", None, None, None, None, None),
        ("TABLE", "MANAGED", "PARQUET", None, None, None, None, None),
        ("TABLE", "MANAGED", "DELTA", None, None, None, None, None),
        ("TABLE", "MANAGED", "DELTA", None, None, None, None, None),
        ("TABLE", "MANAGED", "DELTA", None, None, None, None, None),
    ).drop("size_bytes")
    sizes = spark.createDataFrame(
        [("c", "s", "t2", "TABLE", 5, None), ("c", "s", "t4", "TABLE", None, None), ("c", "s", "t5", "TABLE", None, "Denied: no")],
        "catalog string, schema string, name string, object_type string, size_bytes long, error string",
    )
    got = {r.name: (r.size_bytes, r.skip_reason) for r in inv.attach_table_sizes(rows, sizes).collect()}
    assert got["t0"][1].startswith("STREAMING_TABLE:") and got["t1"][1] == "non-Delta format: PARQUET"
    assert got["t2"] == (5, None) and got["t3"] == (None, "no size row") and got["t4"] == (None, "size is null") and got["t5"] == (None, "Denied: no")
    off = inv.attach_table_sizes(rows, sizes, collect_sizes=False)
    assert off.filter("size_bytes is not null or skip_reason is not null").count() == 0


def test_volume_sizes_whole_or_failed(spark):
    files = spark.createDataFrame([("v", 1, None)] * 12000 + [("w", 2, None), ("w", 2, "denied")], "volume string, size long, error string")
    got = {r.volume: (r.size_bytes, r.skip_reason) for r in inv.volume_sizes(files, keys=["volume"]).collect()}
    assert got == {"v": (12000, None), "w": (None, "denied")}


def test_counts_of_a_table_and_a_volume_of_one_name(spark):
    rows = spark.createDataFrame([("c", "s", "n", "TABLE"), ("c", "s", "n", "VOLUME")], "catalog string, schema string, name string, object_type string")
    tags = spark.createDataFrame([("c", "s", "n", "TABLE"), ("c", "s", "n", "VOLUME")], rows.schema)
    got = {r.object_type: r.tag_count for r in inv.attach_counts(rows, tags, tags.drop("object_type")).collect()}
    assert got == {"TABLE": 1, "VOLUME": None}


def test_reports_without_a_limit(spark):
    rows = spark.createDataFrame([("c%d" % i, "drift_managed_on_old") for i in range(30)], "catalog string, classification string")
    assert report.top_drift_catalogs(rows).count() == 10 and report.top_drift_catalogs(rows, limit=None).count() == 30


def on_new(spark, count, days_old, owner="u", size=None):
    made = dt.datetime(2024, 1, 31) - dt.timedelta(days=days_old)
    rows = objects(spark, *[("TABLE", "MANAGED", None, NEW_URL, NEW_URL, owner, made, size)] * count)
    return inv.classify(rows, old="oldacct", new="newacct")


@pytest.mark.parametrize(
    "count, days_old, size, verdict",
    [
        (1, 2, None, "ROLLBACK_REQUIRES_SIGNOFF"),
        (5, 2, None, "ROLLBACK_REQUIRES_SIGNOFF"),
        (25, 30, None, "ROLLBACK_REQUIRES_SIGNOFF"),
        (26, 2, None, "FORWARD_MIGRATE_REQUIRED"),
        (1, 31, None, "FORWARD_MIGRATE_REQUIRED"),
        (1, 2, 10 * 1024**3, "ROLLBACK_REQUIRES_SIGNOFF"),
        (1, 2, 10 * 1024**3 + 1, "FORWARD_MIGRATE_REQUIRED"),
    ],
)
def test_verdict(spark, count, days_old, size, verdict):
    row = report.recommendation(on_new(spark, count, days_old, size=size), as_of="2024-01-31").first()
    assert (row.verdict, row.new_object_count) == (verdict, count)


def test_verdict_with_nothing_on_new(spark):
    rows = objects(spark, ("TABLE", "MANAGED", None, OLD_URL, OLD_URL, "u", None, 7))
    row = report.recommendation(inv.classify(rows, old="oldacct", new="newacct"), as_of="2024-01-31").first()
    assert (row.verdict, row.new_object_count, row.bytes_on_new) == ("ROLLBACK_FEASIBLE", 0, 0)


def test_counts_are_zero_filled_and_total(spark):
    rows = inv.classify(objects(spark, ("TABLE", "MANAGED", None, OLD_URL, OLD_URL, "u", None, 7)), old="oldacct", new="newacct")
    counts = [(r.classification, r.objects) for r in report.class_counts(rows).orderBy("position").collect()]
    assert counts[0] == ("consistent_old", 1) and len(counts) == 7 and sum(n for _, n in counts) == 1


def test_coverage_of_nothing(spark):
    row = report.size_coverage(inv.classify(objects(spark, ("TABLE", "VIEW", None, None, None, None, None, None)), old="a", new="b")).first()
    assert (row.sized, row.total_sizable, row.pct_missing, row.total_bytes) == (0, 0, 0.0, 0)
