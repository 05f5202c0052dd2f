import random
from collections import Counter

from pyspark.sql import functions as F

from estate.llm import linededup


def brute(rows, min_docs, min_chars=1):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))
    count = Counter(k for _, text in rows for k in {key(line) for line in (text or "").split("\n")} if len(k) >= min_chars)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if count[key(line)] < min_docs]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, kept_text string, t1 int").repartition(4)
    got = linededup.drop_frequent_lines(docs, **options)
    assert got.columns == ["doc_id", "t1", "n_lines", "n_dropped", "kept_text"]
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    pool = ["Common line", " common LINE\t", "\x0bÉtude", "étude", "a", "", "  ", "x ", " wide", "zwölf"] + [f"rare {i}" for i in range(60)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(90)]
    rows += [(None, None), (500, ""), (501, "\n\n"), (3, rows[3][1]), (3, rows[3][1]), (502, "rare 1\n" * 20_000)]
    for options in ({"min_docs": 10}, {"min_docs": 4, "batches": 5, "fanout": 2}, {"min_docs": 3, "min_chars": 5}):
        assert run(spark, rows, **options) == brute(rows, options["min_docs"], options.get("min_chars", 1))


def test_empty_table(spark):
    assert linededup.drop_frequent_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_are_levelled_and_settled_keys_are_not_stored_again(spark):
    runs = linededup.LineRuns(spark, min_docs=3, fanout=2)
    batch = lambda keys: spark.createDataFrame([(k, 0, 1) for k in keys], "h1 long, h2 long, n long")
    runs.add(batch([1, 1, 1, 2]))
    runs.add(batch([1, 2, 3]))
    assert [len(level) for level in runs.levels] == [0, 1]
    # 1 was settled by the first batch: the second added nothing to it.
    assert sorted((r.h1, r.n) for r in runs.levels[1][0].collect()) == [(1, 3), (2, 2), (3, 1)]
    runs.add(batch([2, 1]))
    assert sorted(r.h1 for r in runs.frequent().collect()) == [1, 2]
    assert runs.levels[0][0].agg(F.sum("n")).first()[0] == 1
