"""File trees and describe listings as DataFrames.

Describe rows hold the object key, ``pos`` (row order), ``col_name``, ``data_type``, ``comment``.
DataFrames have no row order, so ``pos`` must come with the listing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from estate.functions.urls import first_url_cell, storage_account
from estate.session import shared_folder
from estate.settings import KEY


def path_opener(local_paths: bool = True):
    """A function that opens a path on any worker: a local path, or any URL Arrow knows.

    It is made here, inside a function, so that Spark sends it by value and the workers need no
    copy of this package. Only scheme and host are read as a URL; the rest may hold any character.
    One file system per scheme and host is made in a task. A path without a scheme would be each
    worker's own disk on a cluster, so it is refused unless ``local_paths``.
    """
    made: dict = {}

    def open_path(path: str):
        import posixpath

        from pyarrow import fs

        scheme, is_url, rest = path.partition("://")
        if not is_url and not path.startswith("file:") and not local_paths:
            raise ValueError(f"a path without a scheme is another place on each worker: {path}")
        if not is_url or scheme == "file":
            if "file" not in made:
                made["file"] = fs.LocalFileSystem()
            return made["file"], rest if is_url else path.removeprefix("file:")
        host, _, inner = rest.partition("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        if (scheme, host) not in made:
            made[scheme, host] = fs.FileSystem.from_uri(f"{scheme}://{host}/")
        filesystem, base = made[scheme, host]
        return filesystem, posixpath.join(base, inner)

    return open_path


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


#: Directories that one task lists: few, as each is a round trip to the storage.
DIRECTORIES_PER_TASK = 8


def list_trees(roots: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """All files below many roots: ``keys``, ``state``, ``relpath``, ``size``, ``path``.

    ``roots`` has the keys and ``root``. ``state`` is ``file``; each root also has one row without
    relpath, ``present`` or ``absent``; a null root is absent. All roots go down together, one level of directories per
    round, so the number of jobs grows with the depth of the trees, not with their number. Spark's
    own file sources leave out empty files and names that begin with ``_`` or ``.``, so the
    executors list the directories. Each round is checkpointed to the shared folder (set
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have it cleaned); the driver sees only
    how many directories are left.
    """
    spark = roots.sparkSession
    shared_folder(spark)
    open_path = path_opener(is_local(spark))
    key_type = ", ".join(f"{k} {roots.schema[k].dataType.simpleString()}" for k in keys)

    def list_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import itertools
        import os

        from pyarrow import fs

        def entries(directory: str):
            """(name, size, is it a directory), one by one on mounts, so that a flat folder is not held whole."""
            filesystem, inner = open_path(directory)
            if isinstance(filesystem, fs.LocalFileSystem):
                with os.scandir(inner) as found:
                    for e in found:
                        folder = e.is_dir()
                        yield e.name, 0 if folder else e.stat().st_size, folder
            else:
                for i in filesystem.get_file_info(fs.FileSelector(inner)):
                    yield i.base_name, i.size or 0, i.type == fs.FileType.Directory

        def there(directory: str | None) -> bool:
            if directory is None:
                return False
            filesystem, inner = open_path(directory)
            return filesystem.get_file_info(inner).type == fs.FileType.Directory

        def rows(key: tuple, prefix: str, directory: str):
            if not prefix:
                found = there(directory)
                yield *key, "present" if found else "absent", None, None, directory
                if not found:
                    return
            for name, size, folder in entries(directory):
                yield *key, "directory" if folder else "file", prefix + name, size, f"{directory}/{name}"

        columns = [*keys, "state", "relpath", "size", "path"]
        for batch in batches:
            every = itertools.chain.from_iterable(
                rows(key, prefix, directory)
                for key, prefix, directory in zip(zip(*(batch[k] for k in keys), strict=True), batch["prefix"], batch["path"], strict=True)
            )
            while part := list(itertools.islice(every, 10_000)):
                yield pd.DataFrame(part, columns=columns).astype({"size": "Int64"})

    level = roots.select(*keys, F.lit("").alias("prefix"), F.rtrim("root", F.lit("/")).alias("path"))
    out, waiting = None, max(1, level.count())
    while waiting:
        entries = (
            level.repartition(-(-waiting // DIRECTORIES_PER_TASK), "path")
            .mapInPandas(list_directories, f"{key_type}, state string, relpath string, size long, path string")
            .checkpoint()
        )
        found = entries.filter("state <> 'directory'")
        out = found if out is None else out.unionByName(found)
        level = entries.filter("state = 'directory'").select(*keys, F.concat("relpath", F.lit("/")).alias("prefix"), "path")
        waiting = level.count()
    return out


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """``relpath``, ``size`` and ``path`` of every file below ``root``; none when there is no root."""
    one = spark.createDataFrame([(0, root)], "tree int, root string")
    return list_trees(one, keys=["tree"]).filter("state = 'file'").select("relpath", "size", "path")


def files_read(table: DataFrame) -> DataFrame:
    """The distinct files the rows of a table come from; no data column is read."""
    return table.select(F.col("_metadata.file_path").alias("path")).distinct()


def hosts_in_paths(rows: DataFrame, path: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Distinct accounts of the parseable paths, optionally per group."""
    return (
        rows.select(*by, storage_account(F.col(path)).alias("account")).filter(F.col("account").isNotNull()).distinct()
    )


def url_cells(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The first cell of each row, in column order, that holds a storage URL."""
    return rows.withColumn("url", first_url_cell(*[F.col(c) for c in columns])).filter(F.col("url").isNotNull())


def detail_starts(describe: DataFrame, starts: Column) -> DataFrame:
    """Per object the position of the first row that begins the detail part."""
    return describe.filter(starts).groupBy(*KEY).agg(F.min("pos").alias("detail_pos"))


def described_locations(describe: DataFrame) -> DataFrame:
    """The first ``Location`` after the detail separator; a column of that name does not count."""
    starts = detail_starts(describe, F.col("col_name").rlike("^(# )?Detailed"))
    return (
        describe.filter((F.col("col_name") == "Location") & (F.trim("data_type") != ""))
        .join(starts, KEY)
        .filter(F.col("pos") > F.col("detail_pos"))
        .groupBy(*KEY)
        .agg(F.min_by(F.trim("data_type"), "pos").alias("location"))
    )


def resolve_storage_paths(objects: DataFrame, describe: DataFrame) -> DataFrame:
    """The listed path, else the described location, else null."""
    found = described_locations(describe)
    return (
        objects.join(found, KEY, "left")
        .withColumn("storage_path", F.coalesce(F.nullif("storage_path", F.lit("")), "location"))
        .drop("location")
    )
