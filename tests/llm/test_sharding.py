from collections import Counter
from math import comb

from pyspark.sql import functions as F

from estate.llm import sharding


def test_exact_sizes_and_gapless_slots(spark):
    docs = spark.range(0, 1003, numPartitions=7).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("x").alias("slot"), F.lit(1).alias("part"))
    got = sharding.shard_rows(docs, shards=16, rows_per_sort=10).collect()
    assert sorted(r.doc_id for r in got) == list(range(1003))
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) - min(sizes.values()) == 1
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))


def test_empty_small_and_skewed_inputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_rows(empty).collect() == []
    few = sharding.shard_rows(spark.range(3).toDF("doc_id"), shards=16).collect()
    assert sorted(r.shard for r in few) == [0, 1, 2] and {r.slot for r in few} == {0}
    # One partition holds nearly all rows, others none.
    hot = spark.range(500).toDF("doc_id").repartition(5, F.when(F.col("doc_id") < 490, 0).otherwise(F.col("doc_id")))
    sizes = Counter(r.shard for r in sharding.shard_rows(hot, shards=8).collect())
    assert set(sizes.values()) <= {62, 63} and sum(sizes.values()) == 500


def test_hypergeometric_quantiles(spark):
    total, good, drawn, n = 30, 11, 13, 4000
    u = (F.col("id") + 0.5) / n
    got = spark.range(n).select(sharding.hypergeometric(*[F.lit(x).cast("long") for x in (total, good, drawn)], u).alias("k")).groupBy("k").count().collect()
    share = {r.k: r["count"] / n for r in got}
    for k in range(0, 12):
        want = comb(good, k) * comb(total - good, drawn - k) / comb(total, drawn)
        assert abs(share.get(k, 0.0) - want) < 1.5 / n
    edge = lambda *x: spark.range(1).select(sharding.hypergeometric(*[F.lit(v).cast("long") for v in x], F.lit(0.7)).alias("k")).first().k
    assert edge(10, 0, 5) == 0 and edge(10, 10, 4) == 4 and edge(10, 3, 10) == 3 and edge(10, 3, 0) == 0


def test_matrix_margins(spark):
    sizes = [17, 0, 400, 3, 250]
    parts = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "part long, n long")
    ends = {r.part: r.ends for r in sharding.communication_matrix(parts, 6, 3).collect()}
    assert {p: e[-1] for p, e in ends.items()} == {i: n for i, n in enumerate(sizes) if n}
    totals = [sum(e[s] - (e[s - 1] if s else 0) for e in ends.values()) for s in range(6)]
    assert sum(totals) == sum(sizes) and max(totals) - min(totals) <= 1


def test_shards_are_independent_of_the_partition(spark):
    docs = spark.range(0, 8000, numPartitions=4).toDF("doc_id")
    got = sharding.shard_rows(docs, shards=4, seed=9).withColumn("part", F.floor(F.col("doc_id") / 2000)).groupBy("part", "shard").count().collect()
    # 500 are expected in each cell, with a deviation of about 17.
    assert len(got) == 16 and all(abs(r["count"] - 500) < 100 for r in got)
