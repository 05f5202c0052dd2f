"""Many small keyed records in one row per bucket, so that Spark shuffles arrays instead of single rows.

A task packs the records of a few megabytes of text by bucket; Spark shuffles the rows by bucket; one
task then has all records of a bucket as flat arrays. The number of buckets grows with the input, so
a bucket stays at some megabytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import mix, ragged


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the high half of 64-bit keys."""
    return ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def pack(bucket: np.ndarray, columns: dict[str, tuple[np.ndarray, pa.DataType]], extra: dict[str, tuple[int, pa.DataType]] | None = None) -> pa.RecordBatch:
    """One row per bucket with the columns' records as lists; `extra` are constants of the row."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    sizes = np.diff(np.append(first, len(order)))
    arrays = [pa.array(found, pa.int32())] + [pa.array(np.full(len(found), v), k) for v, k in (extra or {}).values()]
    arrays += [ragged(values[order], sizes, kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *(extra or {}), *columns])


def flat(table: pa.Table, column: str) -> np.ndarray:
    """All records of a list column."""
    chunks = [np.asarray(c.flatten()) for c in table.column(column).chunks]
    return np.concatenate(chunks) if chunks else np.zeros(0, np.int64)


def of_each(table: pa.Table, column: str, lists: str) -> np.ndarray:
    """A constant of the rows, once for each record of a list column."""
    return np.repeat(np.asarray(table.column(column)), np.concatenate([np.diff(np.asarray(c.offsets)) for c in table.column(lists).chunks]))


OWNED = "bucket int, owner array<long>, value array<int>"


def send_to_owners(owner: np.ndarray, values: np.ndarray, buckets: int) -> pa.Table:
    """Integers for owners, packed by the owners' buckets; the schema is OWNED."""
    by = np.lexsort((values, owner))
    owner, values = owner[by], values[by]
    return pa.Table.from_batches([pack(bucket_of(mix(owner.astype(np.uint64)), buckets), {"owner": (owner, pa.int64()), "value": (values, pa.int32())})])


def gather_of_owners(sent: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One row per owner with all its integers as a list."""

    def gather(table: pa.Table) -> pa.Table:
        owner, values = flat(table, "owner"), flat(table, "value")
        order = np.argsort(owner, kind="stable")
        found, first = np.unique(owner[order], return_index=True)
        return pa.table({names[0]: pa.array(found, pa.int64()), names[1]: ragged(values[order], np.diff(np.append(first, len(order))), pa.int32())})

    return sent.groupBy("bucket").applyInArrow(gather, f"{names[0]} long, {names[1]} array<int>")


def groups_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each group of them starts in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def text_buckets(docs: DataFrame, text: str, bytes_each: int) -> int:
    """How many buckets the texts of a table need."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first().n or 0
    return max(1, -(-int(total) // bytes_each))
