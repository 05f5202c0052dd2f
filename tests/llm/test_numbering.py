import pytest
from pyspark.sql import functions as F

from estate.llm import exact, jaccard, substrings
from estate.llm.storage import numbered

KEY = "spark.sql.files.minPartitionNum"


@pytest.fixture
def files(spark, tmp_path):
    """Several files that are split in other ways when the session's cores change."""
    words = [" ".join(f"w{(i // 3) * 50 + j}" for j in range(40)) + (" more" if i % 3 == 2 else "") for i in range(600)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "doc_id long, text string")
    rows.repartition(8).write.parquet(f"{tmp_path}/docs")
    yield f"{tmp_path}/docs"
    spark.conf.unset(KEY)


@pytest.mark.parametrize("drop", [exact.drop_exact_duplicates, jaccard.drop_similar])
def test_kept_rows_do_not_depend_on_splits(spark, files, drop):
    spark.conf.set(KEY, "1")
    kept = drop(spark.read.parquet(files))
    spark.conf.set(KEY, "64")
    late = sorted(r.doc_id for r in kept.collect())
    assert late == sorted(r.doc_id for r in drop(spark.read.parquet(files)).collect()) and 100 < len(late) < 600


def test_repeats_do_not_depend_on_splits(spark, tmp_path):
    """The splits change after the first stages of substring dedup and before the last, and files share tasks."""
    passage = " ".join(f"p{j}" for j in range(60))
    texts = [(i, f"start{i} " + (passage if i % 2 else f"none{i}") + f" end{i} " + " ".join(f"w{i}x{j}" for j in range(i % 7))) for i in range(300)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(12).write.parquet(f"{tmp_path}/docs")
    try:
        spark.conf.set(KEY, "1")
        found = substrings.remove_repeats(spark.read.parquet(f"{tmp_path}/docs"))
        spark.conf.set(KEY, "64")
        kept = {r.doc_id: (r.n_removed, r.kept) for r in found.collect()}
    finally:
        spark.conf.unset(KEY)
    expected = {i: (60, t.replace(passage + " ", "")) if i % 2 and i > 1 else (0, t) for i, t in texts}
    assert kept == {i: (n, " ".join(t.split())) for i, (n, t) in expected.items()}


def test_numbers_are_of_the_row_and_unique(spark, files):
    frame = numbered(spark.read.parquet(files), "n")
    spark.conf.set(KEY, "1")
    first = {r.doc_id: r.n for r in frame.collect()}
    spark.conf.set(KEY, "64")
    assert {r.doc_id: r.n for r in numbered(spark.read.parquet(files), "n").collect()} == first and len(set(first.values())) == 600
    # What comes from no file, or has a column of that name, is numbered once and stored.
    for other in (spark.range(50).withColumn("_metadata", F.lit(1)), spark.read.parquet(files).groupBy("text").count(), spark.read.parquet(files).limit(0)):
        found = numbered(other, "n")
        assert found.select("n").distinct().count() == found.count() == other.count()
