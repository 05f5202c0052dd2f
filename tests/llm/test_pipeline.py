import os

import corpus_pipeline
from estate.llm import decontaminate, exact, jaccard, queries
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_in_order_and_their_decisions(spark):
    docs = queries.table(spark, SF, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, SF), name)
        assert after.columns == docs.columns
        # Each stage only drops rows, and drops what its operator finds in its own input.
        assert after.exceptAll(before).isEmpty()
        left, had = after.count(), before.count()
        if name == "exact_dedup":
            assert left == exact.exact_duplicates(before).where("kept").count()
        if name == "near_dedup":
            assert left == jaccard.similarity_components(before).where("doc_id = component_id").count()
        if name == "decontamination":
            hits = decontaminate.benchmark_hits(before, queries.table(spark, SF, "benchmark")).where("size(items) > 0").count()
            assert left == had - hits
        assert 0 < left <= had
        before = after
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    packed = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in packed.where("piece = 0").collect()) == sorted(r.doc_id for r in before.collect())


def test_oracles_match(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(SF, table + '.parquet')}'")
    for name, text in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, SF)
        want = con.sql(text)
        columns = sorted(got.columns)
        assert sorted(want.columns) == columns
        rows = lambda items: sorted(map(str, items))
        assert rows(tuple(r[c] for c in columns) for r in got.collect()) == rows(con.sql(f"SELECT {', '.join(columns)} FROM ({text})").fetchall())


def test_exact_and_near_stages_by_plain_python(spark):
    """The ids that stay, from equal texts and from the shingle sets of all pairs."""
    docs = queries.table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    last = {}
    for doc, text in rows:
        key = (text or "").encode().lower()
        last[key] = max(doc, last.get(key, doc))
    kept = corpus_pipeline.stored(corpus_pipeline.drop_exact(spark, docs, SF), "exact")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(last.values())
    left = [(doc, text) for doc, text in rows if doc in set(last.values())]
    want = sorted(int(doc) for doc, size, least in brute(left) if not size or doc == least)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near(spark, kept, SF).collect()) == want
