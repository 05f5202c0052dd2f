"""Links inside groups of candidate sets of any size, without a list of all their pairs.

A group is first tried as a star around its most central set. Where its sets are then still in several
components, the group is cut into blocks of bounded size and each two blocks meet in one task, which
counts all common elements at once and gives back only what joins components: at most one pair a set.
As many groups of one family of texts have nearly the same sets, groups that hang together are taken as
one wherever fewer elements are sent that way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.components import components
from estate.llm.packed import flat, groups_of
from estate.llm.storage import stored

#: A block's sets, and its elements, at most (one larger set is a block of its own).
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 1 << 20
#: Elements of so many sets are counted by matrix products, others by the pairs of sets that have them.
DENSE, COLUMNS = 24, 2048


def hubs(groups: DataFrame) -> DataFrame:
    """(grp, id) -> (grp, hub): the set with the largest groups over all; ties to the smaller id."""
    sized = groups.groupBy("grp").agg(F.count("*").alias("size"))
    weight = groups.join(sized, "grp").groupBy("id").agg(F.sum("size").alias("weight"))
    return groups.join(weight, "id").groupBy("grp").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("h")).select("grp", (-F.col("h.minus")).alias("hub"))


def common_elements(sets: np.ndarray, elements: np.ndarray, n: int) -> np.ndarray:
    """How many elements each two of n sets have in common; `elements` are those of set `sets`, each once."""
    order, heads = groups_of(elements, sets)
    sets, heads = sets[order], heads[np.append(True, elements[order][heads][1:] != elements[order][heads][:-1])]
    size = np.diff(np.append(heads, len(sets)))
    out = np.zeros((n, n), np.float32)
    many = np.flatnonzero(size >= DENSE)
    for at in range(0, len(many), COLUMNS):
        own = many[at : at + COLUMNS]
        column = np.repeat(np.arange(len(own)), size[own])
        row = sets[np.repeat(heads[own], size[own]) + np.arange(len(column)) - np.repeat(np.cumsum(size[own]) - size[own], size[own])]
        has = np.zeros((n, len(own)), np.float32)
        has[row, column] = 1
        out += has @ has.T
    few = np.repeat((size > 1) & (size < DENSE), size)
    which = np.repeat(np.arange(len(size)), size)
    for shift in range(1, DENSE - 1):
        i = np.flatnonzero(few[:-shift] & (which[:-shift] == which[shift:])) if len(few) > shift else np.zeros(0, np.int64)
        if not len(i):
            break
        np.add.at(out, (sets[i], sets[i + shift]), 1)
        np.add.at(out, (sets[i + shift], sets[i]), 1)
    return out


def _join_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, component, block = (np.asarray(table.column(c).combine_chunks()) for c in ("id", "component", "block"))
        size = np.concatenate([np.diff(np.asarray(c.offsets)) for c in table.column("hashes").chunks])
        shared = common_elements(np.repeat(np.arange(len(ids)), size), flat(table, "hashes"), len(ids))
        near = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
        if block.min() != block.max():
            near &= block[:, None] != block[None, :]  # the rest is looked at where a block meets itself
        _, label = np.unique(component, return_inverse=True)
        while True:
            least = np.where(near, label[None, :], len(ids)).min(1)
            now = np.arange(label.max() + 1)
            np.minimum.at(now, label, least)
            now = now[now]
            if (now == np.arange(len(now))).all():
                break
            label = np.unique(now[label], return_inverse=True)[1]
        # Every set is joined with the first set of what its component has become.
        order, heads = groups_of(label)
        first = np.empty(len(heads), np.int64)
        first[label[order[heads]]] = order[heads]
        other = first[label]
        new = component != component[other]
        _, one = np.unique(component[new], return_index=True)
        return pa.table({"a": pa.array(ids[new][one], pa.int64()), "b": pa.array(ids[other][new][one], pa.int64())})

    return run


def _hanging_together(groups: DataFrame) -> DataFrame:
    """(grp, id) -> (id, cluster): groups that share sets are of one cluster.

    Every set first follows the smallest centre of its groups, which is one edge a set and leaves a family of
    texts in few parts; then only parts that meet in a group are joined.
    """
    centre = groups.join(hubs(groups), "grp").groupBy("id").agg(F.min("hub").alias("hub"))
    parts = components(centre.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    of_group = stored(groups.join(parts, "id").select("grp", "component").distinct(), "parts-of-groups")
    least = of_group.groupBy("grp").agg(F.min("component").alias("a"))
    joined = components(of_group.join(least, "grp").where("a <> component").select("a", F.col("component").alias("b")).distinct())
    joined = joined.select(F.col("id").alias("part"), F.col("component").alias("whole"))
    return parts.join(joined, F.col("component") == F.col("part"), "left").select("id", F.coalesce("whole", "component").alias("cluster"))


def close_groups(groups: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """The components (id, component) of all sets of one group that are `percent` similar.

    groups (grp, id) has each pair once, sets (id, n, hashes) each set once; `links` (a, b) are known to be similar.
    """
    found = components(links)
    labelled = groups.join(found, "id", "left").select("grp", "id", F.coalesce("component", "id").alias("component"))
    several = labelled.groupBy("grp").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("grp")
    open_rows = stored(labelled.join(several, "grp", "left_semi").join(sets.select("id", "n"), "id"), "open-groups")
    hanging = open_rows.join(_hanging_together(open_rows.select("grp", "id")), "id")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks")
    whole = hanging.select("cluster", "id", "component", "n").distinct()
    by_group = hanging.groupBy("cluster", "grp").agg(blocks, F.sum("n").alias("n"))
    by_cluster = whole.groupBy("cluster").agg(blocks, F.sum("n").alias("n"))
    cost = by_group.groupBy("cluster").agg(F.sum(F.col("n") * F.col("blocks")).alias("apart"))
    cost = stored(by_cluster.join(cost, "cluster").withColumn("as_one", F.col("n") * F.col("blocks") <= F.col("apart")), "clusters")
    one = whole.join(cost.where("as_one").select("cluster", "blocks"), "cluster").select(F.lit(True).alias("as_one"), F.col("cluster").alias("grp"), "id", "component", "blocks")
    apart = hanging.join(cost.where("NOT as_one").select("cluster"), "cluster", "left_semi").join(by_group.select("cluster", "grp", "blocks"), ["cluster", "grp"])
    dealt = one.unionByName(apart.select(F.lit(False).alias("as_one"), "grp", "id", "component", "blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("block", block).withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("as_one", "grp", "id", "component", "block", F.least("block", "beside").alias("lo"), F.greatest("block", "beside").alias("hi"))
    dealt = dealt.join(sets.select("id", "hashes"), "id")
    joined = dealt.groupBy("as_one", "grp", "lo", "hi").applyInArrow(_join_blocks(percent), "a long, b long")
    # What blocks join are components; the old links are still needed to reach their other sets.
    return components(stored(links.unionByName(joined.distinct()), "all-links"))
