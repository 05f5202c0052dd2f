import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estate.llm import ngrams, quality, toxicity
from estate.llm.ngrams import SparseRows, SplitCodes, gram_codes, held_out, labelled_sample, lbfgs, present_grams
from estate.llm.toxicity import log_count_ratios

SMALL = {"rows": 500, "steps": 40}


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 8)))
    out = []
    for i in range(n):
        grade = rng.randrange(3)
        words = [word() for _ in range(rng.randrange(8, 120))]
        if grade == 1:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["Vexgrub", "vexkorp", "zudwick"]) + word()
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        out.append((i, " ".join(words), grade))
    return out


def tables(spark, seed=1, n=600):
    rows = texts(seed, n)
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows] + [(9001, None, None, None), (9002, "", "en", None), (None, "mala tine", "en", 1.0), (9003, "zudwickal " * 9000, "en", None)], "doc_id long, text string, tail string, score double")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows if i % 3] + [(None, 1), (7777, 2), (2, None), (1, 9)], "doc_id long, grade int")
    return docs, labels, {i: g for i, _, g in rows}


def test_ordinal_grades_on_held_out_rows(spark):
    docs, labels, truth = tables(spark)
    model = quality.fit_quality(docs, labels, F.col("grade"), 3, rows=500, steps=120)
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = quality.score_quality(docs, model).withColumn("held_out", held_out()).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.tail[1] <= r.tail[0] <= 1 and abs(sum(r.tail) - r.expected_grade) < 1e-9 for r in rows)
    new = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([(r.tail[0] >= 0.5) == (truth[r.doc_id] >= 1) for r in new]) > 0.95
    mean = [np.mean([r.expected_grade for r in new if truth[r.doc_id] == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]


def test_ordinal_gradient_is_that_of_the_likelihood(spark):
    """With one feature, the fit gives the empirical tails of each of its values."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        good = i % 2
        docs.append((i, "ok ok" if good else "no no"))
        labels.append((i, rng.choices([0, 1, 2], [1, 3, 6] if good else [6, 3, 1])[0]))
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, grade int")
    model = quality.fit_quality(d, l, F.col("grade"), 3, rows=1000, penalty=0.0, steps=400)
    rows = quality.score_quality(d, model).where(~held_out()).collect()
    grade = dict(labels)
    for good in (0, 1):
        own = [r for r in rows if r.doc_id % 2 == good]
        for k in (1, 2):
            assert abs(np.mean([grade[r.doc_id] >= k for r in own]) - own[0].tail[k - 1]) < 0.06


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = tables(spark)
    labels = labels.select("doc_id", (F.col("grade") == 1).cast("int").alias("toxic"))
    got = toxicity.toxicity_scores(docs, labels, **SMALL).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    new = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == (truth[r.doc_id] == 1) for r in new]) > 0.95
    assert next(r for r in got if r.doc_id == 9003).predicted == 1


def test_labels_do_not_leak_from_held_out_rows(spark):
    docs, labels, _ = tables(spark, n=200)
    labels = labels.select("doc_id", (F.col("grade") == 1).cast("int").alias("toxic"))
    other = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda l: sorted((str(r.doc_id), r.score) for r in toxicity.toxicity_scores(docs, l, **SMALL).collect())
    assert score(labels) == score(other)


def test_without_labels_and_without_rows(spark):
    docs, labels, _ = tables(spark, n=20)
    none = spark.createDataFrame([], "doc_id long, toxic int, grade int")
    assert {round(r.score, 6) for r in toxicity.toxicity_scores(docs, none, **SMALL).collect()} == {0.5}
    model = quality.fit_quality(docs, none, F.col("grade"), 4)
    assert all(abs(r.expected_grade - 1.5) < 1e-6 for r in quality.score_quality(docs, model).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.toxicity_scores(empty, none, **SMALL).collect() == []
    assert quality.score_quality(empty, model).collect() == []


def test_log_count_ratios():
    x = SparseRows(np.array([2, 1, 2]), np.array([0, 1, 1, 1, 2]), None, 4)
    ratio = log_count_ratios(x, np.array([1, 0, 0]))
    assert np.allclose(ratio, np.log([2 / 3, 2 / 3, 1 / 3, 1 / 3]) - np.log([1 / 4, 3 / 4, 2 / 4, 1 / 4]))
    w = np.array([1.0, 2.0, 4.0, 8.0])
    assert x.times(w).tolist() == [3.0, 2.0, 6.0] and x.transposed(np.array([1.0, 10.0, 100.0])).tolist() == [1.0, 111.0, 100.0, 0.0]


@pytest.mark.parametrize("piece", [3, 7, 1 << 18])
def test_grams_are_of_folded_characters_and_do_not_depend_on_pieces(monkeypatch, piece):
    monkeypatch.setattr(ngrams, "PIECE", piece)
    texts = ["Ärger ΣΑΣ straße İstanbul", "", "x", "漢字 かな 漢字", "a\U0001f600b " * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for text, got in zip(texts, present_grams(batch, (2, 4), 12), strict=True):
        whole = f" {text} ".casefold()
        want = {int(gram_codes(np.array([ord(c) for c in whole[i : i + n]], np.uint32), (n,), 12)[0][0]) for n in (2, 4) for i in range(len(whole) - n + 1)}
        assert got.tolist() == sorted(want)


def test_split_codes_give_whole_rows_back():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 1 << 18, n)) for n in (5, 0, 0, 300, 1, 40, 0)]
    per = np.array([np.bincount(r >> 16, minlength=4) for r in rows])
    codes = SplitCodes(np.concatenate(rows).astype(np.uint16), per)
    ends = np.cumsum([0] + [len(r) for r in rows])
    for a in range(len(rows)):
        for b in range(a + 1, len(rows) + 1):
            assert codes[ends[a] : ends[b]].tolist() == np.concatenate(rows[a:b]).tolist()


def test_lbfgs_reaches_the_minimum():
    rng = np.random.default_rng(5)
    m = rng.normal(size=(30, 12))
    target = rng.normal(size=30)
    loss = lambda p: (((m @ p - target) ** 2).sum(), 2 * m.T @ (m @ p - target))
    assert np.allclose(lbfgs(loss, np.zeros(12), 200, tolerance=1e-14), np.linalg.lstsq(m, target, rcond=None)[0], atol=1e-4)


def test_toxicity_equals_a_plain_fit(spark):
    """Features, ratios, fit and calibration again in plain Python, by long gradient descent."""
    rng = random.Random(8)
    make = lambda bad: " ".join(["".join(rng.choice("abcde") for _ in range(3)) for _ in range(4)] + (["zuzu"] if bad and rng.random() < 0.8 else []))
    rows = [(i, make(i % 3 == 0), int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels, rows=60, sizes=(2, 3), bits=16, penalty=0.1, steps=400).collect()}
    learn = {r.doc_id for r in docs.where(~held_out()).collect()}
    fold = {r.label_id: r.fold for r in labels.select(F.col("doc_id").alias("label_id"), F.expr("pmod(xxhash64(3, doc_id), 3)").alias("fold")).collect()}
    grams = lambda t: {t[i : i + n] for n in (2, 3) for i in range(len(t) - n + 1)}
    bags = {i: grams(f" {t} ") for i, t, _ in rows}
    truth = {i: y for i, _, y in rows}
    names = sorted(set().union(*bags.values()))
    x = {i: np.array([g in bags[i] for g in names], float) for i in bags}

    def fit(ids):
        y = np.array([truth[i] for i in ids], float)
        m = np.array([x[i] for i in ids])
        ratio = np.log((y @ m + 1) / (y.sum() + 2)) - np.log(((1 - y) @ m + 1) / ((1 - y).sum() + 2))
        weigh = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
        # The n-grams that no row has weigh nothing, so their penalty leaves them at 0.
        w, c = np.zeros(len(names)), 0.0
        for _ in range(20000):
            e = weigh * (1 / (1 + np.exp(-(m @ (w * ratio) + c))) - y)
            w, c = w - 0.05 * (ratio * (e @ m) + 0.1 * w), c - 0.05 * e.sum()
        return w * ratio, c

    own = sorted(learn)
    z = {}
    for k in range(3):
        w, c = fit([i for i in own if fold[i] != k])
        z |= {i: x[i] @ w + c for i in own if fold[i] == k}
    scale, shift = toxicity.calibration(np.array([z[i] for i in own]), np.array([float(truth[i]) for i in own]))
    w, c = fit(own)
    want = {i: 1 / (1 + np.exp(-(scale * (x[i] @ w + c) + shift))) for i in x}
    assert max(abs(got[i] - want[i]) for i in want) < 0.02


def test_sample_takes_one_text_for_each_label(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    free = {r.doc_id for r in docs.where(~held_out()).collect()}
    got = labelled_sample(docs, labels, F.col("toxic"), 10, "doc_id", "text").collect()
    assert sorted((r.target, r.text) for r in got) == ([(0, ""), (1, "")] if 1 in free else [])
