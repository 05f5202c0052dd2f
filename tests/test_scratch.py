import pytest

from __spark_entry__ import queries
from estate.session import scratch_path
from estate.sources import footers, listings


@pytest.fixture
def shared(spark, monkeypatch):
    """Sets the folder that the session names as shared, for one test."""
    kind = type(spark.conf)
    return lambda folder: monkeypatch.setattr(kind, "get", lambda self, key, *default, get=kind.get: folder if key == "spark.checkpoint.dir" else get(self, key, *default))


def test_files_below_a_folder_that_only_spark_knows_by_name(spark, shared, tmp_path):
    """Workers open files without Spark, so a mount of viewfs has to be named by what is behind it."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.scratch.link./ck", f"file://{tmp_path}")
    shared("viewfs://scratch/ck")
    path = scratch_path(spark, "tree")
    spark.range(10).repartition(2).write.parquet(path)
    listed = footers.parquet_files(listings.list_tree(spark, path))
    assert sum(r.row_count for r in footers.parquet_footers(listed).collect()) == 10


def test_files_below_the_root_of_a_mount_table(spark, shared, tmp_path):
    """What no mount names lies on the table's fallback; the root itself resolves to nothing."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("fs.viewfs.mounttable.fallback.link./other", f"file://{tmp_path}")
    settings.set("fs.viewfs.mounttable.fallback.linkFallback", f"file://{tmp_path}")
    shared("viewfs://fallback/")
    path = scratch_path(spark, "tree")
    spark.range(10).repartition(2).write.parquet(path)
    assert footers.parquet_files(listings.list_tree(spark, path)).count() == 2


def test_trees_below_a_folder_with_a_scheme(spark, shared, tmp_path):
    """The empty tree is made on the driver by Python."""
    shared(f"file://{tmp_path}")
    docs = spark.createDataFrame([(1, "a", "en", "x"), (2, "b", "de", "y")], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    rows = queries()["copy_and_verify_trees"](spark, f"{tmp_path}/in").collect()
    found = {r.tree: (r.source_state, r.match) for r in rows}
    assert found == {"source=x": ("present", True), "source=y": ("present", True), "absent": ("absent", False), "empty": ("present", True)}


def test_a_bare_folder_of_a_cluster_gets_its_scheme(spark, shared, tmp_path, monkeypatch):
    shared(str(tmp_path))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    path = scratch_path(spark, "tree")
    spark.range(4).repartition(2).write.parquet(path)
    assert footers.parquet_files(listings.list_tree(spark, path)).count() == 2
