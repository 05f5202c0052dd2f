"""Lines that occur in many documents, by levelled sorted runs of line hashes.

The state is a set of runs: tables of (line hash, documents that hold it), sorted by hash. A new
batch is counted, merge-anti-joined with the keys that the runs already know to be frequent (these
need no more counting), and what is left becomes a run of level 0. When a level holds `fanout` runs,
they are merged into one run of the next level. A key is frequent when its counts add up to the
threshold over all runs.

A line's key is the line without white space `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased; it is
held as a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.llm.arrays import ragged, text_slices
from estate.llm.storage import stored

KEY = ["h1", "h2"]


def _keys(text: bytes) -> list[bytes]:
    # strip() and lower() of bytes know ASCII alone, and strip() takes just the six characters above.
    return [line.strip() for line in text.lower().split(b"\n")]


class LineRuns:
    """The runs, by level. `add` takes a batch of (h1, h2, n); `frequent` gives the keys over the threshold."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def _runs(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        out = None
        for run in runs:
            out = run if out is None else out.unionByName(run)
        return out

    def _write(self, counts: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stored(counts.sortWithinPartitions(*KEY), f"run-{level}"))
        if len(self.levels[level]) == self.fanout:
            merged = self.levels[level][0]
            for run in self.levels[level][1:]:
                merged = merged.unionByName(run)
            self.levels[level] = []
            self._write(merged.groupBy(*KEY).agg(F.sum("n").alias("n")), level + 1)

    def add(self, batch: DataFrame) -> None:
        """Count a batch and add its run."""
        counts = batch.groupBy(*KEY).agg(F.sum("n").alias("n"))
        runs = self._runs()
        if runs is not None:
            settled = runs.where(F.col("n") >= self.min_docs).select(*KEY).distinct()
            counts = counts.join(settled.hint("merge"), KEY, "left_anti")
        self._write(counts, 0)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys in at least `min_docs` documents."""
        runs = self._runs()
        if runs is None:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        return runs.groupBy(*KEY).agg(F.sum("n").alias("n")).where(F.col("n") >= self.min_docs).select(*KEY)


def _hash_lines(min_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            pieces, sizes = [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                distinct = {k for k in _keys(text.as_py()) if k}
                if min_chars > 1:
                    distinct = {k for k in distinct if len(k.decode()) >= min_chars}
                sizes[i] = len(distinct)
                pieces.extend(map(xxhash.xxh3_128_digest, distinct))
            both = np.frombuffer(b"".join(pieces), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1"), batch.column("t2"), ragged(both[:, 0], sizes, pa.int64()), ragged(both[:, 1], sizes, pa.int64())],
                names=["t1", "t2", "k1", "k2"],
            )

    return run


def _drop_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        totals, dropped, kept = [], [], []
        gone = batch.column("gone")
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            whole = text.as_py()
            n = whole.count(b"\n") + 1
            totals.append(n)
            if not gone[i].is_valid:
                dropped.append(0)
                kept.append(whole)
                continue
            pairs = gone[i].values.flatten()
            both = np.column_stack([np.asarray(p) for p in pairs])
            known = {row.tobytes() for row in both}
            lines = [line for line, key in zip(whole.split(b"\n"), _keys(whole), strict=True) if not key or xxhash.xxh3_128_digest(key) not in known]
            dropped.append(n - len(lines))
            kept.append(b"\n".join(lines))
        out = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name not in ("text", "gone")]
        names = [n for n in batch.schema.names if n not in ("text", "gone")]
        yield pa.RecordBatch.from_arrays(
            [*out, pa.array(totals, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=[*names, "n_lines", "n_dropped", "kept_text"],
        )


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 8, fanout: int = 4, text_col: str = "text") -> DataFrame:
    """The rows of `docs` without their text, with n_lines, n_dropped and kept_text.

    A line goes from every document when its key has `min_chars` characters and lies in at least
    `min_docs` rows; within a row it counts once. A null or empty text is one empty line, which has
    an empty key and stays. Repeated rows are documents of their own. Columns of `docs` with the
    names of the results are replaced. An empty table gives no rows.
    """
    results = ("n_lines", "n_dropped", "kept_text")
    docs = docs.drop(*results)
    others = [c for c in docs.columns if c.lower() != text_col.lower()]
    # The columns that pass through have plain numbers as names on the way.
    text = F.coalesce(F.col(text_col), F.lit(""))
    numbered = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], text.alias("text"))
    numbered = numbered.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    lines = numbered.select("t1", "t2", "text").mapInArrow(_hash_lines(min_chars), "t1 long, t2 long, k1 array<long>, k2 array<long>")
    lines = stored(lines.withColumn("batch", F.pmod("t1", F.lit(batches)).cast("int")), "lines", "batch")
    pairs = F.inline(F.arrays_zip(F.col("k1").alias("h1"), F.col("k2").alias("h2")))
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).select(pairs).select("h1", "h2", F.lit(1).cast("long").alias("n")))
    # What to drop depends on the text alone: one list for each distinct text.
    of_text = lines.dropDuplicates(["t1", "t2"]).select("t1", "t2", pairs).join(runs.frequent(), KEY)
    gone = of_text.groupBy("t1", "t2").agg(F.collect_list(F.struct(*KEY)).alias("gone"))
    joined = numbered.join(gone, ["t1", "t2"], "left").select(*[f"c{i}" for i in range(len(others))], "text", "gone")
    schema = ", ".join([f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(others)] + ["n_lines long", "n_dropped long", "kept_text string"])
    out = joined.mapInArrow(_drop_lines, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], *results)
