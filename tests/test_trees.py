import hashlib
import os
import zlib
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import files as checked
from checks.registry import Inputs
from estate.operators import files
from estate.operators.ranges import crc_shift
from estate.sources import listings
from estate.sources.listings import path_opener


def trees(tmp_path, names):
    for name, tree in names.items():
        for path, text in tree.items():
            os.makedirs(tmp_path / name / os.path.dirname(path), exist_ok=True)
            (tmp_path / name / path).write_text(text)


def test_many_trees_with_absent_and_empty_ones(spark, tmp_path):
    trees(tmp_path, {f"t{i}": {f"a/b{k}/_f": "x" * k for k in range(i)} for i in range(1, 6)})
    (tmp_path / "none").mkdir()
    roots = spark.createDataFrame([(n, f"{tmp_path}/{n}/") for n in ("t1", "t2", "t3", "t4", "t5", "none", "gone")], "tree string, root string")
    rows = listings.list_trees(roots, keys=["tree"]).collect()
    assert {r.tree: r.state for r in rows if r.relpath is None} == {**{f"t{i}": "present" for i in range(1, 6)}, "none": "present", "gone": "absent"}
    assert sorted((r.tree, r.relpath, r.size) for r in rows if r.relpath) == sorted((f"t{i}", f"a/b{k}/_f", k) for i in range(1, 6) for k in range(i))


def test_jobs_grow_with_depth_not_with_trees(spark, tmp_path):
    trees(tmp_path, {f"t{i}": {"a/b/f": "x"} for i in range(30)})

    def jobs(n):
        spark.sparkContext.setJobGroup(f"trees-{n}", "")
        listings.list_trees(spark.createDataFrame([(i, f"{tmp_path}/t{i}") for i in range(n)], "tree int, root string"), keys=["tree"])
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees-{n}"))

    assert jobs(30) <= jobs(2) + 2


def test_verdict_for_every_tree(spark, tmp_path):
    trees(tmp_path, {"s/one": {"f": "1", "d/g": "22"}, "s/two": {"f": "1"}, "t/two": {"f": "9", "old." + "0" * 32 + ".partial": ""}, "t/three": {"x": ""}})
    (tmp_path / "s/three").mkdir()
    rows = [(n, f"{tmp_path}/s/{n}", f"{tmp_path}/t/{n}") for n in ("one", "two", "three", "gone")]
    frame = spark.createDataFrame(rows, "tree string, source_root string, target_root string")
    got = {r.tree: (r.source_state, r.copied, r.match) for r in files.copy_and_verify_trees(frame, keys=["tree"], partitions=2).collect()}
    # The copy of two has the size of its source, so its other content is left to the hashes.
    assert got == {"one": ("present", 2, True), "two": ("present", 0, True), "three": ("present", 0, False), "gone": ("absent", 0, False)}
    assert not list(tmp_path.glob("t/one/**/*.partial"))


def test_a_failed_copy_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("f", 1, f"{tmp_path}/missing", f"{tmp_path}/to/f")], "relpath string, size long, src string, dst string")
    row = files.copy_files(rows, partitions=1).first()
    assert row.status == "failed" and not list(tmp_path.glob("to/*"))


def test_bare_paths_are_refused_on_a_cluster():
    import pytest

    assert path_opener(False)("file:///tmp/x")[1] == "/tmp/x"
    with pytest.raises(ValueError):
        path_opener(False)("/tmp/x")


def test_a_null_root_is_absent(spark, tmp_path):
    trees(tmp_path, {"one": {"f": "1"}})
    roots = spark.createDataFrame([("one", f"{tmp_path}/one"), ("none", None)], "tree string, root string")
    rows = {(r.tree, r.state, r.relpath) for r in listings.list_trees(roots, keys=["tree"]).collect()}
    assert rows == {("one", "present", None), ("one", "file", "f"), ("none", "absent", None)}


def test_documents_without_a_source_are_a_tree(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "en", "x"), (2, "bb", None, None), (3, "c", "en", None)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = lambda name: {tuple(r) for r in queries()[name](spark, str(tmp_path)).collect()}
    assert found("list_trees") == {("source=x", "present", 1, 2), (None, "present", 2, 5), ("absent", "absent", 0, None), ("empty", "present", 0, None)}
    assert found("copy_and_verify_trees") == {("source=x", "present", True, True), (None, "present", True, True), ("absent", "absent", True, False), ("empty", "present", True, True)}
    md5 = lambda text: hashlib.md5(f"{text}\n".encode()).hexdigest()
    assert found("tree_hashes") == {("source=x", md5("a"), 1), (None, md5("bb"), 1), (None, md5("c"), 1)}
    assert found("range_digests") == {("source=x", 1, 1, True), (None, 2, 2, True)}
    assert found("copy_by_ranges") == {("source=x", 1, 1, 1, True, True), (None, 2, 2, 2, True, True)}


def test_documents_become_the_files_that_sparks_writer_leaves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checked, "FILES_PER_TASK", 5, raising=False)
    odd = ["a b", "x/y:z=1%#\"'*?\\{}[]^", "\x01\t\x7f", "ä", "", None]
    docs = [(s, l, t) for s in odd for l in ("en", None) for t in ("", "two\nlines", "é" * 700, None)] + [("twice", "en", "same")] * 30
    spark.createDataFrame(docs, "source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stored = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = stored.select("source", "lang", F.col("text").alias("value"))
    rows.repartition(8).write.partitionBy("source", "lang").option("maxRecordsPerFile", 1).text(f"{tmp_path}/by-spark")

    def found(base):
        every = [p for p in Path(base).rglob("*") if p.is_file()]
        return Counter((str(p.parent.relative_to(base)), "".join(p.suffixes[-2:] if p.name[0] == "." else p.suffixes[-1:]), p.name[0] == ".", p.read_bytes()) for p in every)

    tree = checked._tree(Inputs(spark, str(tmp_path))).removeprefix("file:")
    assert found(tree) == found(f"{tmp_path}/by-spark")
    # Tasks grow with the documents; the checksums are those that Spark checks when it reads.
    assert len({p.name[:10] for p in Path(tree).rglob("part-*.txt")}) > 8
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(tree)
    assert sorted(bytes(r.content) for r in read.collect()) == sorted((t or "").encode() + b"\n" for _, _, t in docs)


def test_range_digests_plan_few_tasks(spark, tmp_path):
    """Spark's file source plans a task for each four small files."""
    docs = spark.createDataFrame([(str(i), "en", "x") for i in range(40)], "text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries()["range_digests"](spark, str(tmp_path))
    assert "binaryFile" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.collect()] == [("source=x", 40, 40, True)]


def test_crc_of_a_text_with_many_bytes_behind():
    shift = crc_shift()
    for behind in (0, 1, 65535, 65536, 200_001):
        rest = bytes(range(256)) * (behind // 256 + 1)
        assert shift(zlib.crc32(b"begin"), behind) ^ zlib.crc32(rest[:behind]) == zlib.crc32(b"begin" + rest[:behind])
