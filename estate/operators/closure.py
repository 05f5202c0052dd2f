"""Fixpoints over edges between names: what is reachable, and in which order a graph can be taken apart.

Each round joins only what the last one found; its rows are written to the shared folder, so lineage stays
short and a lost executor costs one round. Rounds grow with the longest shortest path, not with the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estate.session import scratch_path

#: So many rounds' results are kept as tables of their own before they are written together.
MERGE_AFTER = 16


#: Spark's setting that drops the shuffle files of a statement when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder. The shuffle files behind it go at once, not when the driver next collects its garbage."""
    path, conf = scratch_path(rows.sparkSession, label), rows.sparkSession.conf
    before = conf.get(DROP_SHUFFLES, None)
    conf.set(DROP_SHUFFLES, "true")
    try:
        rows.write.parquet(path)
    finally:
        conf.unset(DROP_SHUFFLES) if before is None else conf.set(DROP_SHUFFLES, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def reachable(seeds: DataFrame, edges: DataFrame, *, max_depth: int | None = None, by: list[str] | None = None) -> DataFrame:
    """(node, depth): every node that edges (src, dst) lead to from the seeds (node), with the fewest steps; seeds have 0.

    With ``by``, columns of the seeds, each of their values has its own closure. Cycles end by
    themselves, null ends lead nowhere.
    """
    by = by or []
    key = [*by, "node"]
    edges = stored(edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct(), "edges")
    delta = stored(seeds.select(*key).filter("node IS NOT NULL").distinct().withColumn("depth", F.lit(0)), "reached")
    known, parts, depth = delta, 1, 0
    while (max_depth is None or depth < max_depth) and not delta.isEmpty():
        depth += 1
        onward = delta.join(edges, delta.node == edges.src).select(*by, F.col("dst").alias("node")).distinct()
        delta = stored(onward.join(known, key, "left_anti").select(*key, F.lit(depth).alias("depth")), "reached")
        known, parts = known.unionByName(delta), parts + 1
        if parts > MERGE_AFTER:
            known, parts = stored(known, "reached"), 1
    return known


def peel(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, level): level 0 are nodes that no edge (src, dst) leads to, each next level those freed by the ones before.

    A node is on a later level than every node with an edge to it. Nodes on a cycle, or that a cycle leads
    to, have a null level. Edges from or to other nodes are left out; an edge from a node to itself is a cycle.
    """
    left = stored(nodes.select("node").distinct(), "nodes")
    ends = lambda column: left.select(F.col("node").alias(column))
    rest = stored(edges.select("src", "dst").distinct().join(ends("src"), "src", "left_semi").join(ends("dst"), "dst", "left_semi").select("src", "dst"), "edges")
    done, parts, level = None, 0, 0
    while True:
        free = stored(left.join(rest.select(F.col("dst").alias("node")).distinct(), "node", "left_anti").withColumn("level", F.lit(level)), "level")
        if free.isEmpty():
            break
        done, parts, level = free if done is None else done.unionByName(free), parts + 1, level + 1
        if parts > MERGE_AFTER:
            done, parts = stored(done, "level"), 1
        left = stored(left.join(free, "node", "left_anti"), "nodes")
        rest = stored(rest.join(free.select(F.col("node").alias("src")), "src", "left_anti"), "edges")
    blocked = left.withColumn("level", F.lit(None).cast("int"))
    return blocked if done is None else done.unionByName(blocked)
