import hashlib

import pytest

from estate.operators import files
from estate.session import scratch_path
from estate.sources import listings

LISTING = "volume string, relpath string, size long"


def frame(spark, rows):
    return spark.createDataFrame([("v", p, n) for p, n in rows], LISTING)


def compared(spark, old, new, **options):
    return files.compare_listings(frame(spark, old), frame(spark, new), keys=["volume"], **options).first()


A, B, C = ("a/1.bin", 100), ("b/2.bin", 200), ("c/3.bin", 300)


def test_same_listings_match(spark):
    row = compared(spark, [A, B], [B, A])
    assert row.match and (row.source_files, row.target_files, row.source_bytes, row.target_bytes) == (2, 2, 300, 300)


def test_differences(spark):
    row = compared(spark, [A, B], [("a/1.bin", 99), C])
    assert not row.match and (row.missing, row.extra, row.mismatch) == (["b/2.bin"], ["c/3.bin"], ["a/1.bin"])


def test_null_size_is_not_a_missing_file(spark):
    row = compared(spark, [("x", None)], [("y", None)])
    assert not row.match and row.missing == ["x"] and row.extra == ["y"]
    done = {r.relpath: r.done for r in files.plan_copy(frame(spark, [("x", None)]), frame(spark, [("y", 1)]), keys=["volume"]).collect()}
    assert done == {"x": False}


def test_duplicate_path_fails(spark):
    row = compared(spark, [A, A], [A])
    assert not row.match and row.duplicate_paths == 1


def test_evidence_is_the_first_paths_but_counts_are_whole(spark):
    row = compared(spark, [(f"f{i:03}", 1) for i in range(120)], [("z", 1)])
    assert row.missing_files == 120 and row.missing == [f"f{i:03}" for i in range(50)] and row.extra == ["z"]


@pytest.mark.parametrize(
    "target, todo", [([], {"a/1.bin", "b/2.bin"}), ([A, B], set()), ([A], {"b/2.bin"}), ([("a/1.bin", 50), B], {"a/1.bin"})]
)
def test_resumable_copy(spark, target, todo):
    dst = frame(spark, target) if target else spark.createDataFrame([], LISTING)
    rows = files.plan_copy(frame(spark, [A, B]), dst, keys=["volume"]).collect()
    assert len(rows) == 2 and {r.relpath for r in rows if not r.done} == todo


def test_sample(spark):
    rows = frame(spark, [(f"f/{i}", 1) for i in range(200)])
    pick = lambda f: {r.relpath for r in files.checksum_sample(rows, fraction=f).collect()}
    assert len(pick(1.0)) == 200 and pick(0.0) == set() and pick(0.2) < pick(0.6) < pick(1.0)
    expected = {f"f/{i}" for i in range(200) if int(hashlib.md5(f"f/{i}".encode()).hexdigest()[:8], 16) < 0.2 * 0xFFFFFFFF}
    assert pick(0.2) == expected
    shuffled = {r.relpath for r in files.checksum_sample(rows.orderBy("size"), fraction=0.2).collect()}
    assert shuffled == expected


def test_copy_mode(spark):
    rows = spark.createDataFrame([("big", 2)] * 3 + [("small", None)], "volume string, size long")
    assert {r.volume: (r.files, r.bytes) for r in files.copy_mode(rows, keys=["volume"]).collect()} == {"big": (3, 6), "small": (1, 0)}


def test_differences_are_whole(spark):
    schema = "volume string, relpath string, size long"
    source = spark.createDataFrame([("v", f"f{i:03}", 1) for i in range(200)] + [("v", "twice", 1)] * 2, schema)
    target = spark.createDataFrame([("v", "f000", 2), ("v", "new", 1), ("v", "twice", 1)], schema)
    got = [(r.relpath, r.difference) for r in files.listing_differences(source, target, keys=["volume"]).collect()]
    assert len(got) == 202 and {d for p, d in got if p == "f000"} == {"mismatch"} and ("new", "extra") in got and ("twice", "duplicate") in got


def test_copy_pairs(spark):
    for src, dst in (("/old", "/new"), ("/old/", "/new//")):
        row = files.copy_pairs(frame(spark, [A]), source_root=src, target_root=dst).first()
        assert (row.src, row.dst) == ("/old/a/1.bin", "/new/a/1.bin")


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "old"
    for name, body in (("a/1.bin", b"x" * 10), ("a b/ü.bin", b"y" * 5000), ("c.bin", b""), ("_log/.hidden", b"z")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(body)
    return root


def test_tree_copy_and_hashes(spark, tree, tmp_path):
    got = {r.relpath: r.size for r in listings.list_tree(spark, str(tree)).collect()}
    assert got == {"a/1.bin": 10, "a b/ü.bin": 5000, "c.bin": 0, "_log/.hidden": 1}
    row = files.copy_and_verify(spark, str(tree), str(tmp_path / "new"), partitions=2).first()
    assert row.match and (row.copied, row.failed) == (4, 0)
    (tmp_path / "new" / "a" / "1.bin").write_bytes(b"half")
    row = files.copy_and_verify(spark, str(tree), str(tmp_path / "new"), partitions=2).first()
    assert row.match and (row.copied, row.failed) == (1, 0)
    for root in (str(tmp_path / "new"), f"file://{tmp_path}/new/"):
        hashes = {r.relpath: r.content_hash for r in files.file_hashes(spark, root, partitions=2).collect()}
        assert hashes == {n: hashlib.md5((tree / n).read_bytes()).hexdigest() for n in got}
    assert listings.list_tree(spark, str(tmp_path / "nowhere")).count() == 0


def test_a_failed_file_is_reported(spark, tmp_path):
    pairs = files.copy_pairs(frame(spark, [("gone", 1)]), source_root=str(tmp_path), target_root=str(tmp_path / "new"))
    row = files.copy_files(pairs, partitions=1).first()
    assert row.status == "failed" and "gone" in row.error


def test_files_read(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t"))
    assert listings.files_read(spark.read.parquet(str(tmp_path / "t"))).count() == 3


def test_hot_volume_sends_only_the_first_paths(spark):
    """The per-group limit runs inside the tasks, before the shuffle."""
    plan = files.compare_listings(frame(spark, [A]), frame(spark, [B]), keys=["volume"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
