"""A uniform random split into shards of exact size, by a communication matrix.

How many rows go from each input partition to each shard is drawn first, exactly as a uniform random
permutation of all rows would distribute them: the matrix is multivariate hypergeometric, given the
sizes of the partitions and of the shards. Then the rows of a partition are permuted and dealt out by
its row of the matrix, exchanged, and permuted again within their shard.

The matrix is drawn from the top: the shards' totals are split between the two halves of the
partitions, each half is split again, and so on, all halves of a level at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estate.llm.storage import fresh_name, stored

SPREAD = 12  # standard deviations around the mode that a draw sees: beyond lies less than a double's resolution


def _bound(value: Column, use) -> Column:
    """Evaluate `value` once and pass it to `use` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of `good` among `total` are in a random sample of `drawn`, as the quantile of u in (0, 1).

    Weights start with 1 at the mode and follow the ratio of neighbouring probabilities, so that no
    large factorials occur. They are summed once for the total and once up to u.
    """
    size, hits, sample = (c.cast("double") for c in (total, good, drawn))
    low = F.greatest(F.lit(0).cast("long"), good + drawn - total)
    high = F.least(good, drawn)
    mode = F.floor((sample + 1) * (hits + 1) / (size + 2)).cast("long")
    deviation = F.sqrt(F.greatest(F.lit(0.0), sample * (hits / size) * (1 - hits / size) * (size - sample) / F.greatest(size - 1, F.lit(1.0))))
    reach = (F.ceil(deviation * SPREAD) + 40).cast("long")
    first = F.greatest(low, mode - reach)
    last = F.least(high, mode + reach)
    facts = F.struct(
        size.alias("n"), hits.alias("k"), sample.alias("m"), u.alias("u"),
        F.least(F.greatest(mode, first), last).alias("mode"), first.alias("first"), last.alias("last"),
    )

    def up(f, j):  # weight(j) / weight(j - 1)
        return (f["k"] - j + 1) * (f["m"] - j + 1) / (j * (f["n"] - f["k"] - f["m"] + j))

    def down(f, j):  # weight(j) / weight(j + 1)
        return (j + 1) * (f["n"] - f["k"] - f["m"] + j + 1) / ((f["k"] - j) * (f["m"] - j))

    one, none = F.lit(1.0), F.lit(0.0)

    def side(f, steps, ratio):
        add = lambda s, j: _bound(s["w"] * ratio(f, j), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")))
        return F.aggregate(steps, F.struct(one.alias("w"), none.alias("sum")), add, lambda s: s["sum"])

    nothing = F.array().cast("array<long>")

    def ups(f):
        return F.when(f["last"] > f["mode"], F.sequence(f["mode"] + 1, f["last"])).otherwise(nothing)

    def downs(f):
        return F.when(f["first"] < f["mode"], F.sequence(f["mode"] - 1, f["first"], F.lit(-1).cast("long"))).otherwise(nothing)

    def walk(f, start, steps, ratio):
        """From `start` (left, found, w) on: the first step at which what is left of u's share is used up."""

        def add(s, j):
            return _bound(
                s["w"] * ratio(f, j),
                lambda w: F.struct(
                    w.alias("w"),
                    (s["left"] - w).alias("left"),
                    F.when(s["found"].isNull() & (s["left"] <= w), j).otherwise(s["found"]).alias("found"),
                ),
            )

        return F.aggregate(steps, start, add)

    def pick(f):
        whole = 1 + side(f, ups(f), up) + side(f, downs(f), down)
        start = F.struct(
            one.alias("w"),
            (f["u"] * whole - 1).alias("left"),
            F.when(f["u"] * whole <= 1, f["mode"]).alias("found"),
        )

        def after(s):
            rest = F.struct(one.alias("w"), s["left"].alias("left"), s["found"].alias("found"))
            return F.coalesce(_bound(walk(f, rest, downs(f), down), lambda t: t["found"]), f["first"])

        return _bound(walk(f, start, ups(f), up), after)

    return F.when((good == 0) | (drawn == 0), F.lit(0).cast("long")).when(drawn == total, good).otherwise(_bound(facts, pick))


def communication_matrix(partitions: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, n) -> (part, ends): where each shard's share ends among the partition's permuted rows.

    `part` are integers from 0. Shard sizes are equal, or one more for the first shards.
    """
    top = partitions.agg(F.coalesce(F.max("part"), F.lit(0)).alias("p"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    levels, rows = max(1, int(top.p).bit_length()), int(top.n)
    sizes = F.array(*[F.lit(rows // shards + (s < rows % shards)).cast("long") for s in range(shards)])
    nodes = partitions.sparkSession.range(1).select(F.lit(0).cast("long").alias("node"), F.lit(rows).cast("long").alias("n"), sizes.alias("wants"))
    start = F.struct(F.col("n").alias("n"), F.col("taken").alias("m"), F.array().cast("array<long>").alias("out"))

    def draw(s, i):
        want = F.element_at(F.col("wants"), i)
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("level"), F.col("node"), i), 11).cast("double") + 0.5) / float(1 << 53)
        return _bound(
            hypergeometric(s["n"], want, s["m"], u),
            lambda k: F.struct((s["n"] - want).alias("n"), (s["m"] - k).alias("m"), F.concat(s["out"], F.array(k)).alias("out")),
        )

    got = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, draw, lambda s: s["out"])
    # One expression for all levels.
    for level in range(levels - 1, -1, -1):
        left = partitions.groupBy(F.shiftright(F.col("part"), level).cast("long").alias("child")).agg(F.sum("n").alias("taken")).where("child % 2 = 0")
        nodes = nodes.join(left, left.child == nodes.node * 2, "left").select("node", "n", "wants", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
        rest = F.zip_with("wants", "got", lambda w, g: w - g)
        # Each level is written, so that a draw is made once and is not copied into the next level's plan.
        halves = stored(nodes.withColumn("level", F.lit(level)).withColumn("got", got), f"matrix-{level}")
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("taken").alias("n"), F.col("got").alias("wants")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("n") - F.col("taken")).alias("n"), rest.alias("wants")),
        )
        nodes = halves.select(F.inline(both)).where("n > 0")
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(F.slice("wants", F.lit(1), i), F.lit(0).cast("long"), lambda a, b: a + b))
    return stored(nodes.select(F.col("node").alias("part"), ends.alias("ends")), "matrix")


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 17, rows_per_sort: int = 100_000) -> DataFrame:
    """All rows and columns of `docs`, with `shard` and `slot` (gapless from 0 in each shard).

    Sizes of shards differ by one row at most. Every assignment of rows to shards of these sizes is
    equally likely, up to the quality of Spark's generator. Nulls, repeated rows and texts play no
    part; an empty table gives no rows; a column of `docs` called shard or slot is replaced. Rows are
    written once with their random numbers and meet two exchanges, so hand over the columns that
    are wanted, not more. No sort holds more than a partition of the input or about
    `rows_per_sort` rows.
    """
    if shards < 1:
        raise ValueError("shards has to be positive")
    docs = docs.drop("shard", "slot")
    part, first, second = (fresh_name(docs.columns, c) for c in ("part", "first", "second"))
    fixed = stored(docs.withColumns({part: F.spark_partition_id().cast("long"), first: F.rand(seed), second: F.rand(seed + 1)}), "shard-rows")
    sizes = stored(fixed.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n")), "shard-parts")
    ends = communication_matrix(sizes, shards, seed).withColumnRenamed("part", part).withColumnRenamed("ends", fresh_name(docs.columns, "ends"))
    place, cut = fresh_name(docs.columns, "place"), ends.columns[1]
    dealt = (
        fixed.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(first, second)) - 1)
        .join(ends, part)
        .withColumn("shard", F.size(F.filter(cut, lambda e: e <= F.col(place))))
        .drop(part, first, place, cut)
    )
    # Within a shard, rows are sorted by their second number in slices of it.
    total = int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n)
    slices = max(1, -(-total // (shards * rows_per_sort)))
    cell = fresh_name(docs.columns, "cell")
    dealt = stored(dealt.withColumn(cell, F.floor(F.col(second) * slices).cast("int")), "shard-dealt")
    cells = dealt.groupBy("shard", cell).agg(F.count("*").alias("n"))
    # One row per shard and slice: a few numbers per hundred thousand rows.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = fresh_name(docs.columns, "base")
    cells = cells.select("shard", cell, before.alias(base))
    row = F.row_number().over(Window.partitionBy("shard", cell).orderBy(second)).cast("long") - 1
    return dealt.withColumn("slot", row).join(cells, ["shard", cell]).withColumn("slot", F.col("slot") + F.col(base)).drop(cell, base, second)
