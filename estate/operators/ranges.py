"""Large files by byte ranges: digests that combine to the file's, and copies that several tasks share.

The CRC of a whole file is the exclusive or of its ranges' CRCs, each multiplied by x to the number of bits
that follow the range (modulo the CRC's polynomial, over GF(2)). A task knows how many bytes follow, so
it does the multiplication itself, and the file's CRC is one ``bit_xor`` whatever the order, size or number
of its ranges. As a CRC does not tell apart contents made to collide, a hash over the ranges' md5 in their order is given
beside it; it holds for one size of ranges only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from estate.operators.files import COPY_BLOCK, _key_types
from estate.session import shared_folder
from estate.sources.listings import is_local, path_opener

RANGE_BYTES = 256 * 1024**2
#: Fixed value: the reflected polynomial of CRC-32; bit 31 is the coefficient of x^0.
CRC_POLYNOMIAL = 0xEDB88320


def crc_shift():
    """A function (crc, n): the CRC's share in that of a text with n more bytes behind it.

    Made inside a function, so that Spark sends it by value.
    """
    polynomial = CRC_POLYNOMIAL

    def times(a: int, b: int) -> int:
        product, bit = 0, 1 << 31
        while bit:
            if a & bit:
                product ^= b
            b, bit = (b >> 1) ^ (polynomial if b & 1 else 0), bit >> 1
        return product

    powers = [1 << 23]  # x^8, one byte; each next one is the square

    def shift(crc: int, n: int) -> int:
        import zlib

        # Up to 64 KiB are added as so many zero bytes, without zlib's inversion before and after; only more is multiplied.
        crc, n, k = zlib.crc32(bytes(n % 65536), crc ^ 0xFFFFFFFF) ^ 0xFFFFFFFF, n >> 16, 16
        while n:
            while len(powers) <= k:
                powers.append(times(powers[-1], powers[-1]))
            if n & 1:
                crc = times(powers[k], crc)
            n, k = n >> 1, k + 1
        return crc

    return shift


def split_ranges(files: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each file of a listing with ``size`` once per range, with ``range_no``, ``offset`` and ``length``; an empty file has one range."""
    last = F.greatest(F.ceil(F.col("size") / range_bytes), F.lit(1)) - 1
    rows = files.withColumn("range_no", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    offset = F.col("range_no") * range_bytes
    return rows.withColumn("offset", offset).withColumn("length", F.least(F.lit(range_bytes), F.col("size") - offset).cast("long"))


def _spread(ranges: DataFrame, partitions: int | None, *by: str) -> DataFrame:
    """Some ranges per task; one large file's ranges go to many tasks."""
    return ranges.repartition(partitions or max(1, min(100_000, -(-ranges.count() // 4))), *by, "range_no")


def range_digests(files: DataFrame, *, keys: Sequence[str], range_bytes: int = RANGE_BYTES, partitions: int | None = None) -> DataFrame:
    """``keys``, ``relpath``, ``range_no``, ``length``, ``md5``, and ``crc_part``, the range's share in the file's CRC-32.

    ``files`` is a listing with ``relpath``, ``size`` and ``path``. A file that has become shorter since
    fails the job.
    """
    block, open_path, shift, keys = COPY_BLOCK, path_opener(is_local(files.sparkSession)), crc_shift(), list(keys)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import zlib

        def one(path: str, size: int, offset: int, length: int) -> tuple[str, int]:
            filesystem, inner = open_path(path)
            total, crc, left = hashlib.md5(), 0, length
            with filesystem.open_input_file(inner) as reader:
                reader.seek(offset)
                while left:
                    chunk = reader.read(min(block, left))
                    if not chunk:
                        raise EOFError(f"{path} is shorter than {size} bytes")
                    total.update(chunk)
                    crc, left = zlib.crc32(chunk, crc), left - len(chunk)
            return total.hexdigest(), shift(crc, size - offset - length)

        for batch in batches:
            found = [one(*r) for r in zip(batch["path"], batch["size"], batch["offset"], batch["length"], strict=True)]
            yield batch[[*keys, "relpath", "range_no", "length"]].assign(md5=[m for m, _ in found], crc_part=[c for _, c in found])

    ranges = split_ranges(files.select(*keys, "relpath", "size", "path"), range_bytes=range_bytes)
    return _spread(ranges, partitions, *keys, "relpath").mapInPandas(digest, f"{_key_types(files, keys)}relpath string, range_no long, length long, md5 string, crc_part long")


def combine_digests(digests: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """``keys``, ``relpath``, ``size``, ``ranges``, ``crc32`` of the whole file, and ``tree_hash``, the md5 of the ranges' md5 in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("range_no", "md5"))), lambda r: r["md5"])
    return digests.groupBy(*keys, "relpath").agg(
        F.sum("length").alias("size"), F.count(F.lit(1)).alias("ranges"), F.bit_xor("crc_part").alias("crc32"), F.md5(F.array_join(ordered, "")).alias("tree_hash")
    )


def copy_by_ranges(pairs: DataFrame, *, keys: Sequence[str] = (), range_bytes: int = RANGE_BYTES, partitions: int | None = None, threads: int = 8) -> DataFrame:
    """Copy ``src`` to ``dst`` on mounts, the ranges of a file in different tasks: one row per file.

    All tasks write into one temporary file, each at its range's offset, and leave an empty mark behind
    when the range is on the storage. The names follow from source, size and range, so a retried task, or a later run
    after a stop, does only the ranges that have no mark. When all of a file's ranges are there, it is
    renamed and the marks go. ``status`` is copied, skipped (there with its size) or failed; ``copied_ranges`` says how
    many ranges this run wrote; ``crc32`` is that of the bytes read, null if ranges were taken over from an earlier run.
    Writing at an offset needs a mount: object stores take ``files.copy_files``. A task copies ``threads`` ranges at a
    time, as it waits for the storage.
    """
    block, open_path, shift, keys = COPY_BLOCK, path_opener(is_local(pairs.sparkSession)), crc_shift(), list(keys)
    shared_folder(pairs.sparkSession)

    def names():
        import hashlib

        def name(src: str, dst: str, *what) -> str:
            return f"{dst}.{hashlib.md5(repr((src, *map(int, what))).encode()).hexdigest()}.partial"

        return name

    named = names()

    def mount(path: str) -> str:
        from pyarrow import fs

        filesystem, inner = open_path(path)
        if not isinstance(filesystem, fs.LocalFileSystem):
            raise ValueError("ranges need a mount")
        return inner

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import zlib
        from concurrent.futures import ThreadPoolExecutor

        def one(src: str, dst: str, size: int, offset: int, length: int) -> tuple[str, int | None, str | None]:
            try:
                target = mount(dst)
                if os.path.isfile(target) and os.path.getsize(target) == size:
                    return "skipped", None, None
                partial, mark = named(src, target, size, range_bytes), named(src, target, size, range_bytes, offset)
                if os.path.exists(mark) and os.path.exists(partial):
                    return "resumed", None, None
                os.makedirs(os.path.dirname(target), exist_ok=True)
                filesystem, inner = open_path(src)
                crc, at = 0, offset
                out = os.open(partial, os.O_CREAT | os.O_RDWR, 0o644)
                try:
                    with filesystem.open_input_file(inner) as reader:
                        reader.seek(offset)
                        while at < offset + length:
                            chunk = reader.read(min(block, offset + length - at))
                            if not chunk:
                                raise EOFError(f"{src} is shorter than {size} bytes")
                            crc, rest = zlib.crc32(chunk, crc), memoryview(chunk)
                            while rest:
                                n = os.pwrite(out, rest, at)
                                at, rest = at + n, rest[n:]
                    os.fsync(out)
                finally:
                    os.close(out)
                os.close(os.open(mark, os.O_CREAT | os.O_WRONLY, 0o644))
                return "copied", shift(crc, size - offset - length), None
            except Exception as fault:  # reported per file; the other ranges go on
                return "failed", None, f"{type(fault).__name__}: {fault}"

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                found = list(pool.map(one, batch["src"], batch["dst"], batch["size"], batch["offset"], batch["length"]))
                columns = {c: [f[i] for f in found] for i, c in enumerate(("status", "crc_part", "error"))}
                yield batch[[*keys, "relpath", "src", "dst", "size"]].assign(**columns).astype({"crc_part": "Int64"})

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import contextlib
        import os

        def one(src: str, dst: str, size: int, ready: bool) -> str | None:
            if not ready:
                return None
            try:
                target = mount(dst)
                partial = named(src, target, size, range_bytes)
                # An earlier attempt of this task may have renamed it already.
                if os.path.exists(partial) or not os.path.isfile(target):
                    if os.path.getsize(partial) != size:
                        raise OSError(f"{dst} has {os.path.getsize(partial)} of {size} bytes")
                    os.replace(partial, target)
                for offset in range(0, max(size, 1), range_bytes):
                    with contextlib.suppress(FileNotFoundError):
                        os.remove(named(src, target, size, range_bytes, offset))
                return None
            except Exception as fault:
                return f"{type(fault).__name__}: {fault}"

        for batch in batches:
            faults = [one(*r) for r in zip(batch["src"], batch["dst"], batch["size"], batch["ready"], strict=True)]
            batch["error"] = [e if pd.notna(e) else f for e, f in zip(batch["error"], faults, strict=True)]
            batch["status"] = ["failed" if f else s for s, f in zip(batch["status"], faults, strict=True)]
            yield batch[[*keys, "relpath", "size", "status", "ranges", "copied_ranges", "crc32", "error"]]

    types = _key_types(pairs, keys)
    ranges = split_ranges(pairs.select(*keys, "relpath", "src", "dst", "size"), range_bytes=range_bytes)
    copied = _spread(ranges, partitions, *keys, "relpath").mapInPandas(copy, f"{types}relpath string, src string, dst string, size long, status string, crc_part long, error string").checkpoint()
    count = lambda status: F.count_if(F.col("status") == status)
    status = F.when(count("failed") > 0, "failed").when(count("skipped") == F.count(F.lit(1)), "skipped").otherwise("copied")
    whole = copied.groupBy(*keys, "relpath", "src", "dst", "size").agg(
        status.alias("state"), F.count(F.lit(1)).alias("ranges"), count("copied").alias("copied_ranges"), F.bit_xor("crc_part").alias("crc"), F.min("error").alias("error")
    )
    whole = whole.withColumn("crc32", F.when(F.col("copied_ranges") == F.col("ranges"), F.col("crc"))).withColumn("ready", F.col("state") == "copied").drop("crc").withColumnRenamed("state", "status")
    return whole.mapInPandas(finish, f"{types}relpath string, size long, status string, ranges long, copied_ranges long, crc32 long, error string").checkpoint()
