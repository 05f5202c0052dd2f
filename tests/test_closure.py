"""Fixpoints, range digests, byte ranges, moves: random cases against plain Python."""

import os
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from estate.operators import closure, differences, files, ranges, verify
from estate.operators.access import effective_privileges, principals_of


@pytest.mark.parametrize("seed", [1, 2])
def test_reachable_against_breadth_first(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(55)] + [("n1", "n1"), (None, "n2"), ("n3", None)]
    edges += [(f"c{i}", f"c{i + 1}") for i in range(25)]  # longer than the number of tables kept apart
    seeds = ["n0", "n5", "c0", "alone"]
    want, level, depth = {s: 0 for s in seeds}, list(seeds), 0
    while level:
        depth += 1
        level = sorted({b for a, b in edges if a in level and b is not None and b not in want})
        want |= {b: depth for b in level}
    rows = spark.createDataFrame(edges, "src string, dst string")
    start = spark.createDataFrame([(s,) for s in [*seeds, None]], "node string")
    assert {r.node: r.depth for r in closure.reachable(start, rows).collect()} == want
    assert {r.node: r.depth for r in closure.reachable(start, rows, max_depth=2).collect()} == {k: d for k, d in want.items() if d <= 2}


def test_closures_of_each_seed_are_apart(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "src string, dst string")
    seeds = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "who int, node string")
    got = sorted((r.who, r.node, r.depth) for r in closure.reachable(seeds, edges, by=["who"]).collect())
    assert got == [(1, "a", 0), (1, "b", 1), (1, "c", 2), (2, "a", 1), (2, "b", 0), (2, "c", 0)]


def test_peel_orders_all_but_cycles(spark):
    edges = [("v3", "v2"), ("v2", "v1"), ("v3", "t"), ("v1", "t"), ("x", "y"), ("y", "x"), ("x", "below"), ("self", "self"), ("gone", "t")]
    nodes = spark.createDataFrame([(n,) for n in ["t", "v1", "v2", "v3", "x", "y", "below", "self", "alone"]], "node string")
    got = {r.node: r.level for r in closure.peel(nodes, spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {"v3": 0, "alone": 0, "v2": 1, "v1": 2, "t": 3, "x": None, "y": None, "below": None, "self": None}


def test_differing_rows_are_those_of_the_multisets(spark):
    rng = random.Random(4)
    row = lambda: (rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([None, [], [None], [None, 1], [1, None]]), rng.choice([None, {"k": 1}, {}]))
    one = [row() for _ in range(400)]
    two = one[:-9] + [row() for _ in range(14)]
    schema = "a int, b string, c array<int>, d map<string,int>"
    frames = [spark.createDataFrame(r, schema).repartition(3) for r in (one, two)]
    text = lambda r: repr(tuple(r))
    got = {text(r[:4]): (r.source_rows, r.target_rows) for r in differences.checksum_differences(*frames, levels=(2, 5)).collect()}
    left, right = Counter(map(text, one)), Counter(map(text, two))
    assert got == {k: (left[k], right[k]) for k in left | right if left[k] != right[k]}
    assert differences.checksum_differences(frames[0], frames[0]).count() == 0
    with pytest.raises(ValueError):
        differences.checksum_differences(frames[0], frames[1].drop("d"))


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("array<int>", [None, [], [None], [1], [1, None], [None, 1], [None, None]]),
        ("struct<a:string,b:string>", [None, (None, None), (None, "a"), ("a", None), ("a", "a")]),
        ("array<array<int>>", [[], [None], [[]], [[], [1]], [[1], []], [[1], None], [None, [1]], [[None], [1]]]),
        ("array<struct<a:int,b:int>>", [[(1, None)], [(None, 1)], [None], [(None, None)]]),
        ("struct<m:map<string,array<int>>>", [({"k": None},), ({"k": []},), ({"k": [None]},), ({},), (None,)]),
    ],
)
def test_nested_values_have_hashes_of_their_own(spark, kind, values):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    hashes = [r.h for r in rows.select(verify.row_hash(rows).alias("h")).collect()]
    assert len(set(hashes)) == len(values)


def test_crc_of_ranges_and_copies_in_several_tasks(spark, tmp_path):
    rng = random.Random(5)
    sizes = {"empty": 0, "one": 1, "even": 4000, "odd": 10_001}
    for name, size in sizes.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_bytes(rng.randbytes(size))
    source = [(n, s, f"{tmp_path}/in/{n}") for n, s in sizes.items()]
    listing = spark.createDataFrame(source, "relpath string, size long, path string").withColumn("k", F.lit(1))
    digests = ranges.range_digests(listing, keys=["k"], range_bytes=1000)
    got = {r.relpath: (r.crc32, r.ranges, r["size"]) for r in ranges.combine_digests(digests, keys=["k"]).collect()}
    assert got == {n: (zlib.crc32((tmp_path / "in" / n).read_bytes()), max(1, -(-s // 1000)), s) for n, s in sizes.items()}

    pairs = listing.select("k", "relpath", "size", F.col("path").alias("src"), F.concat(F.lit(f"{tmp_path}/out/x/"), "relpath").alias("dst"))
    done = {r.relpath: r for r in ranges.copy_by_ranges(pairs, keys=["k"], range_bytes=1000).collect()}
    assert {n: (r.status, r.crc32) for n, r in done.items()} == {n: ("copied", g[0]) for n, g in got.items()}
    assert sorted(os.listdir(tmp_path / "out" / "x")) == sorted(sizes)  # no marks are left
    assert all((tmp_path / "out" / "x" / n).read_bytes() == (tmp_path / "in" / n).read_bytes() for n in sizes)
    assert {r.status for r in ranges.copy_by_ranges(pairs, keys=["k"], range_bytes=1000).collect()} == {"skipped"}


def test_a_stopped_copy_goes_on_where_it_was(spark, tmp_path):
    (tmp_path / "big").write_bytes(random.Random(6).randbytes(5000))
    schema = "relpath string, size long, src string, dst string"
    # The listing says more than there is: the last ranges fail, the others are on the storage.
    stopped = spark.createDataFrame([("big", 7000, f"{tmp_path}/big", f"{tmp_path}/out/big")], schema)
    first = ranges.copy_by_ranges(stopped, range_bytes=1000, partitions=3).first()
    assert (first.status, first.copied_ranges) == ("failed", 5) and not (tmp_path / "out" / "big").exists()
    with (tmp_path / "big").open("ab") as more:
        more.write(b"z" * 2000)
    again = ranges.copy_by_ranges(stopped, range_bytes=1000, partitions=3).first()
    assert (again.status, again.ranges, again.copied_ranges) == ("copied", 7, 2)
    assert (tmp_path / "out" / "big").read_bytes() == (tmp_path / "big").read_bytes()


def test_moves_pair_equal_contents_and_leave_the_rest(spark):
    side = lambda rows: spark.createDataFrame(rows, "v string, relpath string, content_hash string")
    source = side([("a", f"old/{i}", "same") for i in range(5)] + [("a", "stays", "x"), ("a", "changed", "y"), ("a", "unknown", None), ("b", "other", "same")])
    target = side([("a", f"new/{i}", "same") for i in range(3)] + [("a", "stays", "x"), ("a", "changed", "z"), ("a", "unknown2", None)])
    got = files.differences_with_moves(source, target, keys=["v"]).collect()
    kinds = Counter((r.v, r.difference) for r in got)
    assert kinds == {("a", "moved"): 3, ("a", "missing"): 3, ("a", "extra"): 1, ("a", "mismatch"): 1, ("b", "missing"): 1}
    assert {r.moved_to for r in got if r.difference == "moved"} == {f"new/{i}" for i in range(3)}


def test_files_below_unequal_directories(spark):
    paths = ["a/b/1", "a/b/2", "a/c/3", "d/e/4", "d/e/f/5", "6"]
    rows = lambda there: spark.createDataFrame([(1, p, s) for p, s in there], "k int, relpath string, size long")
    source, target = rows([(p, 1) for p in paths]), rows([(p, 2 if p == "a/b/2" else 1) for p in paths if not p.startswith("d/")])
    digests = [files.directory_digests(x, keys=["k"]) for x in (source, target)]
    found = files.directory_differences(*digests, keys=["k"])
    assert {(r.directory, r.difference) for r in found.collect()} == {("", "mismatch"), ("a", "mismatch"), ("a/b", "mismatch"), ("d", "missing")}
    assert sorted(r.relpath for r in files.files_below(source, found, keys=["k"]).collect()) == ["6", "a/b/1", "a/b/2", "d/e/4", "d/e/f/5"]


def test_privileges_come_from_groups_and_from_above(spark):
    member = spark.createDataFrame([("me", "g1"), ("g1", "g2"), ("g2", "g1"), ("you", "g3")], "member string, group string")
    principals = principals_of(spark.createDataFrame([("me",)], "principal string"), member)
    grants = spark.createDataFrame(
        [("CATALOG", "c", "g2", "USE CATALOG"), ("SCHEMA", "c.s", "me", "SELECT"), ("TABLE", "c.s.t", "g3", "MODIFY"), ("TABLE", "c.s.t", "g1", ""), ("TABLE", "c.s.t", "g1", "SELECT")],
        "kind string, securable string, principal string, privilege string",
    )
    things = spark.createDataFrame([("CATALOG", "c", ["c"]), ("SCHEMA", "c.s", ["c", "s"]), ("TABLE", "c.s.t", ["c", "s", "t"]), ("TABLE", "d.s.t", ["d", "s", "t"])], "kind string, securable string, parts array<string>")
    unread = spark.createDataFrame([("SCHEMA", "d.s")], "kind string, securable string")
    got = {r.securable: r.privileges for r in effective_privileges(things, grants, principals, unreadable=unread).collect()}
    assert got == {"c": ["USE CATALOG"], "c.s": ["SELECT", "USE CATALOG"], "c.s.t": ["SELECT", "USE CATALOG"], "d.s.t": None}
