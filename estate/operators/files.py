"""File trees: compare, plan a copy, copy on the executors, hash contents.

A listing has the group columns (for example the volume key), ``relpath`` and a value column
(``size`` or ``content_hash``). Two listings are paired by one aggregation on (group, relpath), not
by a full outer join, which Spark cannot split when a key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from estate.operators.ranking import top_rows_per_group
from estate.session import shared_folder
from estate.sources.listings import is_local, list_trees, path_opener

COPY_BLOCK = 8 * 1024 * 1024
FILES_PER_TASK = 2000
BYTES_PER_TASK = 64 * 1024**3


def _task_count(files: DataFrame) -> int:
    """Tasks for work on files: by their number and bytes, at least enough to keep a cluster busy."""
    found = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    return max(min(found["n"], 256), found["n"] // FILES_PER_TASK, found["bytes"] // BYTES_PER_TASK, 1)


def pair_listings(source: DataFrame, target: DataFrame, *, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (group, relpath): rows and value on each side."""
    side = lambda rows, name: rows.select(*keys, "relpath", F.col(value).alias("value"), F.lit(name).alias("side"))
    both = side(source, "source").unionByName(side(target, "target"))
    aggregates = []
    for name in ("source", "target"):
        mine = F.col("side") == name
        aggregates += [
            F.count_if(mine).alias(f"{name}_rows"),
            F.max(F.when(mine, F.col("value"))).alias(f"{name}_value"),
        ]
    return both.groupBy(*keys, "relpath").agg(*aggregates)


def _verdicts(pairs: DataFrame) -> DataFrame:
    in_source, in_target = F.col("source_rows") > 0, F.col("target_rows") > 0
    difference = (
        F.when(~in_target, "missing")
        .when(~in_source, "extra")
        .when(~F.col("source_value").eqNullSafe(F.col("target_value")), "mismatch")
    )
    return pairs.withColumn("difference", difference)


KINDS = ("missing", "extra", "mismatch")


def _summary(pairs: DataFrame, keys: Sequence[str], totals: bool) -> DataFrame:
    duplicated = (F.col("source_rows") > 1) | (F.col("target_rows") > 1)
    counts = [
        F.count_if(F.col("source_rows") > 0).alias("source_files"),
        F.count_if(F.col("target_rows") > 0).alias("target_files"),
        *[F.count_if(F.col("difference") == k).alias(f"{k}_files") for k in KINDS],
        F.count_if(duplicated).alias("duplicate_paths"),
    ]
    if totals:
        counts += [F.coalesce(F.sum(f"{s}_value"), F.lit(0)).alias(f"{s}_bytes") for s in ("source", "target")]
    clean = F.lit(True)
    for column in (*[f"{k}_files" for k in KINDS], "duplicate_paths"):
        clean = clean & (F.col(column) == 0)
    return pairs.groupBy(*keys).agg(*counts).withColumn("match", clean)


def _compare(source: DataFrame, target: DataFrame, keys: Sequence[str], value: str, evidence: int) -> DataFrame:
    pairs = _verdicts(pair_listings(source, target, keys=keys, value=value))
    summary = _summary(pairs, keys, totals=value == "size")
    shown = top_rows_per_group(
        pairs.filter(F.col("difference").isNotNull()).select(*keys, "difference", "relpath"), [*keys, "difference"], ["relpath"], evidence
    )
    listed = shown.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[F.array_sort(F.collect_list(F.when(F.col("difference") == k, F.col("relpath")))).alias(k) for k in KINDS]
    )
    # Null-safe keys add no filter to one side, so both sides share the shuffle of the pairs.
    same_group = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rows = summary.join(listed, same_group, "left").drop(*[f"_{k}" for k in keys])
    for kind in KINDS:
        rows = rows.withColumn(kind, F.coalesce(kind, F.array().cast("array<string>")))
    return rows


def _differences(source: DataFrame, target: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    pairs = _verdicts(pair_listings(source, target, keys=keys, value=value))
    kind = F.coalesce("difference", F.when((F.col("source_rows") > 1) | (F.col("target_rows") > 1), "duplicate"))
    return pairs.withColumn("difference", kind).filter(F.col("difference").isNotNull()).select(*keys, "relpath", "difference", "source_value", "target_value")


def listing_differences(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """One row per path that differs, with its kind and both sizes: the whole set, without a limit."""
    return _differences(source, target, keys, "size")


def hash_differences(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """As ``listing_differences`` with ``content_hash``."""
    return _differences(source, target, keys, "content_hash")


def compare_listings(source: DataFrame, target: DataFrame, *, keys: Sequence[str], evidence: int = 50) -> DataFrame:
    """Per group: same paths and same sizes? Counts and bytes are exact; the path lists are the
    first ``evidence`` of each kind. A path listed twice on a side fails the match."""
    return _compare(source, target, keys, "size", evidence)


def compare_hashes(source: DataFrame, target: DataFrame, *, keys: Sequence[str], evidence: int = 50) -> DataFrame:
    """As ``compare_listings`` with ``content_hash``: finds files of equal size that differ."""
    return _compare(source, target, keys, "content_hash", evidence)


def hash_verdicts(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Counts and ``match`` of ``compare_hashes`` without the path lists."""
    return _summary(_verdicts(pair_listings(source, target, keys=keys, value="content_hash")), keys, totals=False)


def directory_digests(listing: DataFrame, *, keys: Sequence[str], value: str = "size") -> DataFrame:
    """(keys, directory, depth, files, xor64, sum64): of every directory a digest of all files below it.

    Files are first merged by their own directory; the directories' digests are then added to all directories
    above, so rows grow with directories times their depth, not with files. The root is ''.
    """
    own = F.regexp_replace("relpath", "/?[^/]*$", "")
    seen = F.xxhash64("relpath", value, F.col(value).isNull())
    flat = listing.select(*keys, own.alias("own"), seen.alias("h")).groupBy(*keys, "own").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")
    )
    parts = F.when(F.col("own") == "", F.array().cast("array<string>")).otherwise(F.split("own", "/"))
    depths = F.sequence(F.lit(0), F.size("parts"))
    up = flat.withColumn("parts", parts).withColumn("depth", F.explode(depths))
    up = up.withColumn("directory", F.when(F.col("depth") == 0, "").otherwise(F.array_join(F.slice("parts", 1, F.col("depth")), "/")))
    return up.groupBy(*keys, "directory", "depth").agg(F.sum("n").alias("files"), F.bit_xor("x").alias("xor64"), F.sum("s").alias("sum64"))


def directory_differences(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """(keys, directory, difference, source_files, target_files): the directories whose digests are not equal.

    Both sides are ``directory_digests``. A directory that one side lacks is ``missing`` or ``extra`` and
    reported at the highest place only, other unequal ones are ``mismatch``; equal subtrees do not appear. Only
    the unequal directories' own files have to be compared then (``files_below``).
    """
    both = source.withColumn("side", F.lit("source")).unionByName(target.withColumn("side", F.lit("target")))
    pick = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{column}")
    paired = both.groupBy(*keys, "directory", "depth").agg(*[pick(s, c) for s in ("source", "target") for c in ("files", "xor64", "sum64")])
    same = F.lit(True)
    for column in ("files", "xor64", "sum64"):
        same = same & F.col(f"source_{column}").eqNullSafe(F.col(f"target_{column}"))
    kind = F.when(F.col("target_files").isNull(), "missing").when(F.col("source_files").isNull(), "extra").otherwise("mismatch")
    unequal = paired.filter(~same).withColumn("difference", kind)
    # The parent of what is missing is missing itself, or it is there and unequal.
    parent = F.when(F.col("depth") > 0, F.regexp_replace("directory", "/?[^/]*$", ""))
    above = unequal.filter("difference <> 'mismatch'").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("directory").alias("_directory"))
    inner = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    kept = unequal.withColumn("_parent", parent).join(above, [*inner, F.col("_parent") == F.col("_directory")], "left_anti")
    count = lambda side: F.coalesce(f"{side}_files", F.lit(0)).alias(f"{side}_files")
    return kept.select(*keys, "directory", "difference", count("source"), count("target"))


def files_below(listing: DataFrame, differences: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """The files that lie directly in an unequal directory, or anywhere below a missing or extra one."""
    own = F.regexp_replace("relpath", "/?[^/]*$", "")
    parts = F.when(own == "", F.array().cast("array<string>")).otherwise(F.split(own, "/"))
    upper = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda d: F.struct(F.array_join(F.slice(parts, F.lit(1), d), "/").alias("directory"), (d == F.size(parts)).alias("direct")))
    rows = listing.select(*keys, "relpath", F.inline(upper))
    found = differences.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("directory").alias("_directory"), (F.col("difference") == "mismatch").alias("_mismatch"))
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    hit = rows.join(found, [*match, F.col("directory") == F.col("_directory")]).filter("direct OR NOT _mismatch")
    return hit.select(*keys, "relpath").distinct()


def _ranked(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows with their number inside their group, in the order of the md5 of their path.

    A group of any size is numbered in 256 parts: the number inside the part, plus the sizes of earlier parts.
    """
    rows = rows.withColumn("_order", F.md5("relpath")).withColumn("_part", F.substring("_order", 1, 2))
    sizes = rows.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("_before", before).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy("_order", "relpath"))
    return rows.withColumn("_inside", inside).join(starts, [*group, "_part"]).withColumn("_rank", F.col("_before") + F.col("_inside")).drop("_inside", "_before", "_part", "_order")


def differences_with_moves(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """(keys, relpath, difference, moved_to): as ``hash_differences``, but missing and extra files of equal content are one ``moved`` row.

    Where a content occurs several times among them, paths are paired by their rank inside that content,
    and what is left over stays missing or extra. Contents that are not known (null) are never paired.
    """
    rows = _differences(source, target, keys, "content_hash")
    content = F.coalesce("source_value", "target_value")
    alone = rows.filter(F.col("difference").isin("missing", "extra") & content.isNotNull()).select(*keys, "relpath", "difference", content.alias("_content"))
    ranked = _ranked(alone, [*keys, "_content", "difference"])
    side = lambda kind, name: F.max(F.when(F.col("difference") == kind, F.col("relpath"))).alias(name)
    paired = ranked.groupBy(*keys, "_content", "_rank").agg(side("missing", "_from"), side("extra", "_to"))
    kind = F.when(F.col("_to").isNull(), "missing").when(F.col("_from").isNull(), "extra").otherwise("moved")
    found = paired.select(*keys, F.coalesce("_from", "_to").alias("relpath"), kind.alias("difference"), F.when(kind == "moved", F.col("_to")).alias("moved_to"))
    rest = rows.filter(~F.col("difference").isin("missing", "extra") | content.isNull()).select(*keys, "relpath", "difference", F.lit(None).cast("string").alias("moved_to"))
    return found.unionByName(rest)


def partition_parity(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Files per partition directory on both sides; the partition is the relpath without its last part."""
    def side(rows: DataFrame, name: str) -> DataFrame:
        folder = F.regexp_replace("relpath", "/?[^/]*$", "")
        return rows.select(*keys, folder.alias("partition"), F.lit(name).alias("side"))

    both = side(source, "source").unionByName(side(target, "target"))
    counts = both.groupBy(*keys, "partition").agg(
        *[F.count_if(F.col("side") == s).alias(f"{s}_files") for s in ("source", "target")]
    )
    return counts.withColumn("match", F.col("source_files") == F.col("target_files"))


def copy_pairs(source: DataFrame, *, source_root: str | Column, target_root: str | Column) -> DataFrame:
    """``src`` and ``dst`` of each file; roots may end in a slash or not."""
    def under(root: str | Column) -> Column:
        base = F.lit(root) if isinstance(root, str) else root
        return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), "relpath")

    return source.withColumn("src", under(source_root)).withColumn("dst", under(target_root))


def plan_copy(source: DataFrame, target: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Each source file with ``done``: the target has the same path with the same size."""
    pairs = pair_listings(source, target, keys=keys, value="size")
    same = (F.col("target_rows") > 0) & F.col("source_value").eqNullSafe(F.col("target_value"))
    return pairs.filter(F.col("source_rows") > 0).select(*keys, "relpath", F.col("source_value").alias("size"), same.alias("done"))


def copy_mode(source: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Files and bytes to copy per group. Copies are always spread over tasks, so there is no mode to choose."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes"))


def checksum_sample(listing: DataFrame, *, fraction: float) -> DataFrame:
    """Files chosen by a hash of their path: both copies choose the same ones, and a larger
    fraction contains a smaller one. The filter runs before any content is read."""
    if fraction >= 1.0:
        return listing
    if fraction <= 0.0:
        return listing.filter(F.lit(False))
    bucket = F.conv(F.substring(F.md5("relpath"), 1, 8), 16, 10).cast("long")
    return listing.filter(bucket < F.lit(fraction * 0xFFFFFFFF))


def _key_types(rows: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"{k} {rows.schema[k].dataType.simpleString()}, " for k in keys)


def copy_files(pairs: DataFrame, *, keys: Sequence[str] = (), partitions: int | None = None, threads: int = 8) -> DataFrame:
    """Copy ``src`` to ``dst`` on the executors: one status row per file, with the ``keys``.

    On a mount a file goes to a temporary name and is renamed when complete, and a failed one's
    temporary file is deleted; an object store publishes a file when its stream is closed. So a
    retried or speculative task leaves either the whole file or none. Files already there with
    their size are skipped. Copying waits for the storage, so a task copies ``threads`` files at a
    time. The result is lazy: checkpoint it before it is used twice.
    """
    block, open_path, keys = COPY_BLOCK, path_opener(is_local(pairs.sparkSession)), list(keys)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import contextlib
        import posixpath
        import uuid
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow import fs

        def write(source, source_path: str, target, path: str) -> None:
            with source.open_input_stream(source_path) as reader, target.open_output_stream(path) as writer:
                while chunk := reader.read(block):
                    writer.write(chunk)

        def one(src: str, dst: str, size) -> tuple[str, str | None]:
            try:
                source, source_path = open_path(src)
                target, target_path = open_path(dst)
                there = target.get_file_info(target_path)
                if there.type == fs.FileType.File and pd.notna(size) and there.size == int(size):
                    return "skipped", None
                if not isinstance(target, fs.LocalFileSystem):
                    write(source, source_path, target, target_path)
                    return "copied", None
                target.create_dir(posixpath.dirname(target_path), recursive=True)
                partial = f"{target_path}.{uuid.uuid4().hex}.partial"
                try:
                    write(source, source_path, target, partial)
                    target.move(partial, target_path)
                except BaseException:
                    with contextlib.suppress(OSError):
                        target.delete_file(partial)
                    raise
                return "copied", None
            except Exception as fault:  # reported per file; the other files go on
                return "failed", f"{type(fault).__name__}: {fault}"

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                results = list(pool.map(one, batch["src"], batch["dst"], batch["size"]))
                batch["status"] = [status for status, _ in results]
                batch["error"] = [error for _, error in results]
                yield batch[[*keys, "relpath", "size", "status", "error"]]

    spread = pairs.select(*keys, "relpath", "size", "src", "dst").repartition(partitions or _task_count(pairs), *keys, "relpath")
    return spread.mapInPandas(copy, f"{_key_types(pairs, keys)}relpath string, size long, status string, error string")


def copy_and_verify_trees(trees: DataFrame, *, keys: Sequence[str], partitions: int | None = None, threads: int = 8) -> DataFrame:
    """Copy what each target lacks, list the targets again and compare: one row per tree, always.

    ``trees`` has the keys, ``source_root`` and ``target_root``. A source that does not exist does
    not match and says so in ``source_state``. Files that a killed task left under a temporary name
    are no part of a target. The statuses are checkpointed to the shared folder, so the copy runs
    once even when an executor is lost.
    """
    shared_folder(trees.sparkSession)
    listed = lambda side: list_trees(trees.select(*keys, F.col(f"{side}_root").alias("root")), keys=keys)
    whole = lambda rows: rows.filter((F.col("state") == "file") & ~F.col("relpath").rlike(r"\.[0-9a-f]{32}\.partial$")).select(*keys, "relpath", "size")
    found = listed("source")
    source, before = whole(found), whole(listed("target"))
    todo = plan_copy(source, before, keys=keys).filter(~F.col("done")).join(trees, list(keys))
    pairs = copy_pairs(todo, source_root=F.col("source_root"), target_root=F.col("target_root"))
    statuses = copy_files(pairs, keys=keys, partitions=partitions, threads=threads).checkpoint()
    count = lambda status: F.count_if(F.col("status") == status).alias(status)
    counts = statuses.groupBy(*keys).agg(count("copied"), count("failed"))
    states = found.filter(F.col("relpath").isNull()).select(*keys, F.col("state").alias("source_state"))
    verdict = compare_listings(source, whole(listed("target")), keys=keys)
    rows = trees.join(states, list(keys), "left").join(verdict, list(keys), "left").join(counts, list(keys), "left")
    numbers = [c for c in verdict.columns if c.endswith(("_files", "_bytes")) or c == "duplicate_paths"] + ["copied", "failed"]
    # An existing source without files matches a target without files, of which no verdict row speaks.
    match = F.coalesce("match", F.lit(True)) & F.coalesce(F.col("source_state") == "present", F.lit(False)) & (F.col("failed") == 0)
    return rows.withColumns({n: F.coalesce(n, F.lit(0)) for n in numbers}).withColumn("match", match)


def copy_and_verify(spark: SparkSession, source_root: str, target_root: str, *, partitions: int | None = None) -> DataFrame:
    """``copy_and_verify_trees`` for one tree."""
    one = spark.createDataFrame([(target_root, source_root, target_root)], "tree string, source_root string, target_root string")
    return copy_and_verify_trees(one, keys=["tree"], partitions=partitions).drop("source_root", "target_root")


def tree_hashes(roots: DataFrame, *, keys: Sequence[str], fraction: float = 1.0, partitions: int | None = None, threads: int = 8) -> DataFrame:
    """``keys``, ``relpath`` and the md5 of the whole content of each (sampled) file below many roots.

    Files are read in blocks on the executors, ``threads`` at a time in a task, so a file of any
    size takes one block of memory; the sample is taken from the listing, before any content is
    read. An absent or empty root has no rows: see ``list_trees`` for the difference.
    """
    block, open_path, keys = COPY_BLOCK, path_opener(is_local(roots.sparkSession)), list(keys)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        from concurrent.futures import ThreadPoolExecutor

        def one(path: str) -> str:
            filesystem, inner = open_path(path)
            total = hashlib.md5()
            with filesystem.open_input_stream(inner) as reader:
                while chunk := reader.read(block):
                    total.update(chunk)
            return total.hexdigest()

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                yield batch[[*keys, "relpath"]].assign(content_hash=list(pool.map(one, batch["path"])))

    chosen = checksum_sample(list_trees(roots, keys=keys).filter("state = 'file'"), fraction=fraction)
    spread = chosen.select(*keys, "relpath", "path").repartition(partitions or _task_count(chosen), *keys, "relpath")
    return spread.mapInPandas(digest, f"{_key_types(roots, keys)}relpath string, content_hash string")


def file_hashes(spark: SparkSession, root: str, *, fraction: float = 1.0, partitions: int | None = None) -> DataFrame:
    """``tree_hashes`` of one tree."""
    one = spark.createDataFrame([(0, root)], "tree int, root string")
    return tree_hashes(one, keys=["tree"], fraction=fraction, partitions=partitions).drop("tree")
