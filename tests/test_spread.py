from pyspark.sql import functions as F

from checks import verify
from estate.operators import differences
from estate.operators.closure import DROP_SHUFFLES, stored


def test_equal_copies_are_not_counted_by_hash(spark, monkeypatch):
    """Their digests agree, so no hash of a row is shuffled."""
    labels, stored = [], differences.stored
    monkeypatch.setattr(differences, "stored", lambda rows, label: labels.append(label) or stored(rows, label))
    rows = spark.range(1000).withColumn("v", F.col("id") % 7)
    found = differences.checksum_differences(rows, rows.repartition(3))
    assert found.count() == 0 and found.columns == ["id", "v", "source_rows", "target_rows"]
    assert labels == ["ranges"]


def test_differing_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(differences, "ROWS_PER_TASK", 10, raising=False)
    rows = spark.range(300)
    found = differences.checksum_differences(rows, rows.unionAll(rows))
    assert found.agg(F.count("id"), F.sum("source_rows"), F.sum("target_rows")).first()[:] == (300, 300, 600)
    assert "hashpartitioning(_h#" in (plan := found._jdf.queryExecution().toString()) and ", 90)" in plan


def test_copies_of_a_table_are_dealt_by_size(spark):
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        moved = verify._moved(spark.range(200_000))
        parts = moved.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("id").alias("s")).collect()
        assert len(parts) > 5 and sum(r.s for r in parts) == sum(range(200_000))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)


def test_scattered_differences_go_from_coarse_ranges_to_hashes(spark, monkeypatch):
    """Finer digests would be as many as the rows."""
    labels, stored = [], differences.stored
    monkeypatch.setattr(differences, "stored", lambda rows, label: labels.append(label) or stored(rows, label))
    rows = spark.range(20_000).select("id", (F.col("id") % 7).alias("v"))
    found = differences.checksum_differences(rows, rows.filter("id % 2 = 0").unionAll(rows.filter("id % 5 = 0")).unionAll(spark.range(-3, 0).selectExpr("id", "-id")))
    got = {(r.id, r.v): (r.source_rows, r.target_rows) for r in found.collect()}
    counts = {(i, i % 7): (1, (i % 2 == 0) + (i % 5 == 0)) for i in range(20_000)} | {(i, -i): (0, 1) for i in range(-3, 0)}
    assert got == {k: c for k, c in counts.items() if c[0] != c[1]}
    assert labels[:2] == ["ranges", "differing-hashes"]


def test_only_the_columns_asked_for_are_shuffled(spark):
    rows = spark.range(300).withColumn("wide", F.repeat(F.lit("x"), 50))
    found = differences.checksum_differences(rows, rows.unionAll(rows)).select("id")
    assert "first(_c1" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.agg(F.sum("id")).first()[0] == sum(range(300))


def test_a_stored_table_keeps_no_shuffle(spark):
    shuffles = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before = shuffles()
    found = stored(spark.range(100).groupBy((F.col("id") % 3).alias("k")).count(), "counts")
    assert shuffles() <= before and spark.conf.get(DROP_SHUFFLES, None) is None
    assert sorted(r["count"] for r in found.collect()) == [33, 33, 34]
