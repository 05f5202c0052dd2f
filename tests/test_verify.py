import itertools

import pytest
from pyspark.sql import functions as F

from estate.operators import verify

KEY = "catalog string, schema string, name string, object_type string"


def same(left, right):
    return verify.compare_fingerprints(verify.fingerprint(left), verify.fingerprint(right)).first().match


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "c", "c")], "k int, x string, y string")


def test_order_does_not_matter_but_number_does(rows):
    assert same(rows, rows.orderBy(F.desc("k")).repartition(3))
    assert not same(rows, rows.filter("k > 1"))
    assert not same(rows, rows.union(rows.filter("k = 1")))
    assert not same(rows.union(rows), rows.union(rows).union(rows).union(rows))
    assert not same(rows, rows.withColumn("x", F.when(F.col("k") == 3, "d").otherwise(F.col("x"))))


def test_moved_null_is_seen(spark):
    left = spark.createDataFrame([(None, "a")], "x string, y string")
    right = spark.createDataFrame([("a", None)], "x string, y string")
    assert not same(left, right)
    plain = lambda t: t.select(F.xxhash64("x", "y")).first()[0]
    assert plain(left) == plain(right)


def test_empty_and_nested(spark):
    empty = spark.createDataFrame([], "x int")
    row = verify.fingerprint(empty).first()
    assert (row.n, row.xor64, row.sum64) == (0, 0, 0) and same(empty, empty)
    maps = lambda text: spark.sql(f"SELECT {text} AS m, array(struct(map('k', 1))) AS nested, parse_json('{{\"a\": 1}}') AS v")
    assert same(maps("map('a', 1, 'b', 2)"), maps("map('b', 2, 'a', 1)"))
    assert not same(maps("map('a', 1, 'b', 2)"), maps("map('a', 1, 'b', 3)"))


def test_keyed(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "g string, x int")
    right = spark.createDataFrame([("a", 1), ("b", 9), ("d", 3)], "g string, x int")
    prints = [verify.fingerprint(t, by=["g"]) for t in (left, right)]
    assert {r.g: r.match for r in verify.compare_fingerprints(*prints, by=["g"]).collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_overall_truth_table(spark):
    flags = list(itertools.product([None, True, False], repeat=3))
    table = spark.createDataFrame([(i, *f) for i, f in enumerate(flags)], "i int, a boolean, b boolean, c boolean")
    got = {r.i: r.ok for r in table.select("i", verify.overall_pass(["a", "b", "c"]).alias("ok")).collect()}
    assert got == {i: (False not in f and True in f) for i, f in enumerate(flags)}


def evidence(spark, kind="TABLE", table_type="MANAGED", fmt="DELTA", location="s3://new/t", paths=("s3://new/t/1",), parent="s3://new/", log_entries=1):
    key = ("c", "s", "t", kind)
    rows = spark.createDataFrame([(*key, table_type, fmt, parent)], KEY + ", table_type string, data_source_format string, parent_managed_location string")
    rows = verify.location_evidence(rows, spark.createDataFrame([(*key, location)], KEY + ", location string"), new="new")
    entries = spark.createDataFrame([("s3://new/t/_delta_log",)] * log_entries or [("elsewhere",)], "root string")
    rows = verify.log_directory_evidence(rows, entries)
    read = spark.createDataFrame([(*key, p) for p in paths] or [("x", "x", "x", "x", "x")], KEY + ", path string")
    rows = verify.parent_evidence(verify.file_path_evidence(rows, read, new="new"), new="new")
    for name in verify.LAYERS[4:]:
        rows = rows.withColumn(name, F.lit(None).cast("boolean"))
    row = verify.attach_overall(rows).first()
    return [row[n] for n in verify.LAYERS[:4]], row.overall_pass


def test_layers(spark):
    assert evidence(spark) == ([True, None, True, True], True)
    assert evidence(spark, paths=("s3://new/t/1", "s3://old/t/2")) == ([True, None, False, True], False)
    assert evidence(spark, paths=()) == ([True, None, None, True], True)
    assert evidence(spark, location=None) == ([False, None, True, True], False)
    assert evidence(spark, table_type="EXTERNAL") == ([True, True, True, None], True)
    assert evidence(spark, table_type="EXTERNAL", log_entries=0) == ([True, False, True, None], False)
    assert evidence(spark, table_type="EXTERNAL", fmt="PARQUET") == ([True, None, True, None], True)
    assert evidence(spark, kind="VOLUME") == ([True, None, None, True], True)
    assert evidence(spark, parent=None) == ([True, None, True, False], False)


@pytest.mark.parametrize("target, match", [("h1", True), ("h2", False), (None, None)])
def test_volume_hashes(spark, target, match):
    key = ("c", "s", "v", "VOLUME")
    rows = spark.createDataFrame([(*key, "MANAGED")], KEY + ", table_type string")
    hashes = lambda h: spark.createDataFrame([(*key, "f", h)] if h else [("x", "x", "x", "x", "f", "h")], KEY + ", relpath string, content_hash string")
    assert verify.volume_hash_evidence(rows, hashes("h1"), hashes(target)).first().volume_content_checksum_ok is match


def test_table_checksum(spark):
    key = ("c", "s", "t", "TABLE")
    rows = spark.createDataFrame([(*key, "MANAGED")], KEY + ", table_type string")
    prints = lambda *cells: verify.fingerprint(spark.createDataFrame([(*key, c) for c in cells], KEY + ", x int"), by=KEY.replace(" string", "").split(", "))
    ok = lambda a, b: verify.table_checksum_evidence(rows, a, b).first().content_checksum_ok
    assert ok(prints(1, 2), prints(2, 1)) is True and ok(prints(1), prints(2)) is False
    other = prints(1).withColumn("name", F.lit("u"))
    assert ok(prints(1), other) is False and ok(other, prints(1)) is None


def test_stored_flags(spark):
    rows = spark.createDataFrame([("c", "s", "t", "TABLE", True, None)], KEY + ", metadata_location_ok boolean, delta_log_at_new_ok boolean")
    for name in verify.LAYERS[2:]:
        rows = rows.withColumn(name, F.lit(None).cast("boolean"))
    kept = verify.result_rows(rows, validated_at="2024-01-01").first()
    assert kept.delta_log_at_new_ok is None and kept.overall_pass
    filled = verify.result_rows(rows, validated_at="2024-01-01", nulls_as_false=True).first()
    assert filled.delta_log_at_new_ok is False and filled.overall_pass and filled.evidence_json.startswith('{"content_checksum_ok":null,')
