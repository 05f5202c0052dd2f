"""Footers of Parquet files against scans of them."""

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from estate.plans import migration
from estate.sources import footers, listings

ROWS = [(i, None if i % 3 else -i, f"t{i:03d}", datetime.date(2020, 1, 1 + i % 20), [i], None) for i in range(60)]
SCHEMA = "k long, maybe int, text string, day date, list array<int>, never string"


def _read(spark, folder):
    return footers.parquet_footers(footers.parquet_files(listings.list_tree(spark, str(folder))))


def test_signature_and_ranges_equal_a_scan(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    rows.repartition(4).write.parquet(f"{tmp_path}/a")
    rows.filter("k < 0").coalesce(1).write.mode("append").parquet(f"{tmp_path}/a")  # a file without rows
    rows.filter("k % 3 = 1").coalesce(1).write.mode("append").parquet(f"{tmp_path}/a")  # `maybe` is null throughout
    table = spark.read.parquet(f"{tmp_path}/a")
    found = _read(spark, tmp_path / "a")
    signature, scanned = footers.footer_signature(found).first(), migration.table_signature(table).first()
    assert (signature.row_count, signature.schema_hash, signature.unreadable) == (scanned.row_count, scanned.schema_hash, 0)
    ranges = {r.name: r for r in footers.column_ranges(found).collect()}
    epoch = F.lit("1970-01-01").cast("date")
    for name, value in (("k", F.col("k")), ("maybe", F.col("maybe")), ("day", F.datediff("day", epoch))):
        low, high, nulls = table.agg(F.min(value), F.max(value), F.count_if(F.col(name).isNull())).first()
        assert (ranges[name].low, ranges[name].high, ranges[name].nulls, ranges[name].low_text) == (low, high, nulls, None)
    assert (ranges["text"].low_text, ranges["text"].high_text, ranges["text"].low) == ("t000", "t059", None)
    assert (ranges["never"].low_text, ranges["never"].nulls) == (None, 80)
    assert migration.compare_footers(found, found).first().asDict() == {
        "row_count_before": 80, "row_count_after": 80, "row_count_ok": True, "schema_ok": True, "unreadable": 0,
    }


def test_foreign_files_broken_files_and_none(spark, tmp_path):
    for folder in ("a", "b", "none"):
        (tmp_path / folder).mkdir()
    # Written by another program, in another order of columns; without statistics in one file.
    pq.write_table(pa.table({"k": [3, 1], "at": pa.array([1, 2], pa.timestamp("us"))}), tmp_path / "a" / "x.parquet")
    pq.write_table(pa.table({"k": [9], "at": pa.array([5], pa.timestamp("us"))}), tmp_path / "a" / "y.parquet", write_statistics=False)
    (tmp_path / "a" / "_hidden.parquet").write_text("no data")
    (tmp_path / "b" / "broken.parquet").write_text("this is no Parquet file")
    (tmp_path / "b" / "empty.parquet").write_text("")
    a, b, none = (_read(spark, tmp_path / f) for f in ("a", "b", "none"))
    signature, scanned = footers.footer_signature(a).first(), migration.table_signature(spark.read.parquet(f"{tmp_path}/a")).first()
    assert (signature.row_count, signature.schema_hash) == (3, scanned.schema_hash)
    ranges = {r.name: (r.files, r.nulls, r.low, r.high) for r in footers.column_ranges(a).collect()}
    assert ranges["k"] == (2, None, None, None)  # one file does not know
    assert [r.row_count for r in b.collect()] == [None, None] and all(r.problem for r in b.collect())
    verdict = migration.compare_footers(b, b).first()
    assert (verdict.row_count_ok, verdict.schema_ok, verdict.unreadable) == (False, False, 4)
    assert none.collect() == [] and footers.footer_signature(none).first().row_count == 0 and footers.column_ranges(none).collect() == []
