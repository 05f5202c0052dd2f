import hashlib
import random

from pyspark.sql import functions as F

from estate.llm import exact


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, text_sha256 string").repartition(3)
    got = exact.exact_duplicates(docs, **options).collect()
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(lowered(text), []).append(doc)
    largest = lambda ids: max((i for i in ids if i is not None), default=None)
    want = sorted((str(doc), str(largest(groups[lowered(text)])), len(groups[lowered(text)]), hashlib.sha256(lowered(text).encode()).hexdigest()) for doc, text, *_ in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_against_grouping(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abAB\n é𝄞") for _ in range(n)) for n in (1, 3, 8, 15, 16, 17, 31, 64, 200, 1000)]
    rows = [(i, rng.choice(base) + rng.choice(["", "", "x"]), "en", "?") for i in range(120)]
    rows += [(200, None, None, None), (201, "", "en", None), (None, "lone", None, None), (None, "lone", None, None), (7, base[8], None, None), (7, base[8], None, None)]
    check(spark, rows, block=8)


def test_clashing_routes_are_told_apart_by_content(spark):
    rows = [(i, f"text number {i % 40} of some length", "en", "") for i in range(80)]
    check(spark, rows, block=4, hash_bits=3)


def test_long_text_and_prefixes(spark):
    long = "abc " * 60_000
    check(spark, [(1, long, "", ""), (2, long.upper(), "", ""), (3, long[:-1], "", ""), (4, long[: len(long) // 2], "", ""), (5, long + "\0", "", "")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_duplicates(docs).collect() == []
    assert exact.drop_exact_duplicates(docs).collect() == []


def test_drop_keeps_one_row_of_each_text_with_its_columns(spark, tmp_path):
    rows = [(1, "A", 5), (2, "a", 6), (2, "a", 6), (3, "b", 7), (None, None, 8), (None, "", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, rid int").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = exact.drop_exact_duplicates(docs)
    assert got.columns == docs.columns
    kept = [tuple(r) for r in got.where(F.col("doc_id").isNotNull()).orderBy("doc_id").collect()]
    assert kept == [(2, "a", 6), (3, "b", 7)]
    assert got.count() == 3
