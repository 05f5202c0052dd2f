"""Which rows of two copies differ, by digests of ranges of row hashes.

A digest is what ``verify.fingerprint`` gives, per range of hashes: row count, xor and sum. The first
digests have few ranges and merge inside each task; only ranges whose digests differ are cut into finer
ones, as long as those merge inside a task too, and only rows of the finest differing ranges are counted by hash. Equal
ranges are read, as every row has to be hashed, but never shuffled. Digests are small tables: stored with a copy, they spare reading
it again as long as the other one agrees.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from estate.operators.closure import stored
from estate.operators.verify import row_hash

#: Leading bits of the hash that name a range, level by level.
LEVELS = (12, 24)
SIDES = ("source", "target")
#: Rows that one task puts in order by their hash, or merges into digests of ranges.
ROWS_PER_TASK = 500_000


def _range(bits: int) -> Column:
    return F.shiftrightunsigned("_h", 64 - bits)


def _hashed(table: DataFrame) -> DataFrame:
    return table.select(row_hash(table).alias("_h"), *[F.col("`" + c.replace("`", "``") + "`").alias(f"_c{i}") for i, c in enumerate(table.columns)])


def range_digests(table: DataFrame, *, bits: int = LEVELS[0]) -> DataFrame:
    """(range, n, xor64, sum64) of every range of row hashes with the same leading bits; empty ranges have no row."""
    return _digests(_hashed(table), bits)


def _digests(hashed: DataFrame, bits: int) -> DataFrame:
    return hashed.groupBy(_range(bits).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("xor64"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("sum64")
    )


def differing_ranges(source: DataFrame, target: DataFrame) -> DataFrame:
    """(range, source_n, target_n) of the ranges whose digests are not equal."""
    both = source.withColumn("side", F.lit("source")).unionByName(target.withColumn("side", F.lit("target")))
    pick = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{column}")
    paired = both.groupBy("range").agg(*[pick(s, c) for s in SIDES for c in ("n", "xor64", "sum64")])
    same = reduce(lambda a, b: a & b, [F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in ("n", "xor64", "sum64")])
    return paired.filter(~same).select("range", *[F.coalesce(f"{s}_n", F.lit(0)).alias(f"{s}_n") for s in SIDES])


def checksum_differences(source: DataFrame, target: DataFrame, *, levels: Sequence[int] = LEVELS) -> DataFrame:
    """Every distinct row that one copy has more often, with ``source_rows`` and ``target_rows``.

    Both tables need the same columns and types, in the same order. Rows are told apart by 64-bit hashes
    that see nulls at every depth, so maps may occur. The result is empty when the fingerprints agree.
    """
    if [(f.name, f.dataType) for f in source.schema] != [(f.name, f.dataType) for f in target.schema]:
        raise ValueError("the copies have different columns")
    taken = {c.lower() for c in source.columns}
    if taken & {"source_rows", "target_rows"}:
        raise ValueError("source_rows and target_rows name the result's counts")
    left, right = _hashed(source), _hashed(target)
    inside, ranges, coarse = lambda rows: rows, 1, 0
    for bits in levels:
        # Digests of more ranges than a task has rows are no fewer than the rows, and four times as large as their hashes.
        if coarse and ranges << (bits - coarse) > ROWS_PER_TASK:
            break
        found = stored(differing_ranges(_digests(inside(left), bits), _digests(inside(right), bits)), "ranges")
        ranges, rows = found.agg(F.count(F.lit(1)), F.sum(F.col("source_n") + F.col("target_n"))).first()
        if not rows:
            none = F.lit(0).cast("long")
            return source.filter(F.lit(False)).select("*", *[none.alias(f"{s}_rows") for s in SIDES])
        found, coarse = found.select("range"), bits
        inside = lambda rows, found=found, bits=bits: rows.join(found, _range(bits) == F.col("range"), "left_semi")
    counted = lambda rows, side: inside(rows).select("_h", F.lit(side).alias("_side"))
    sums = [F.count_if(F.col("_side") == s).alias(f"{s}_rows") for s in SIDES]
    hashes = counted(left, "source").unionByName(counted(right, "target")).groupBy("_h").agg(*sums).filter("source_rows <> target_rows")
    hashes = stored(hashes, "differing-hashes")
    # One row of each differing hash is fetched, from the target only where the source has none. Its cells stay columns,
    # so that those which the caller drops are not shuffled; first() takes all cells of a group from one row.
    # Tasks are counted by the rows in differing ranges, so that none grows with the tables.
    tasks = max(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))
    cells = [c for c in left.columns if c != "_h"]
    totals = [f"{s}_rows" for s in SIDES]
    shown = None
    for side, having in ((left, F.col("source_rows") > 0), (right, F.col("source_rows") == 0)):
        wanted, every = hashes.agg(F.count_if(having), F.count(F.lit(1))).first()
        if not wanted:
            continue
        # A table of their own, so that Spark knows when they are few and the rows need not be shuffled.
        few = hashes if wanted == every else stored(hashes.filter(having), "differing-hashes")
        found = side.join(few.repartition(tasks, "_h"), "_h").groupBy("_h").agg(*[F.first(c).alias(c) for c in (*cells, *totals)])
        shown = found if shown is None else shown.unionByName(found)
    return shown.select(*[F.col(c).alias(name) for c, name in zip(cells, source.columns, strict=True)], *totals)
