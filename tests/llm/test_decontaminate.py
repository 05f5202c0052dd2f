import random
import re

import numpy as np
import pytest

from estate.llm import decontaminate
from estate.llm.decontaminate import FMIndex, suffix_array

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for item, phrase in items:
            p = words(phrase)
            n = min(window, len(p))
            for s in range(len(p) - n + 1) if p else ():
                for k in range(len(own) - n + 1):
                    if own[k : k + n] == p[s : s + n]:
                        hit.update(range(k, k + n))
                        names |= {str(item)} if item is not None else set()
        out.append((str(doc), len(own), sorted(hit), sorted(names)))
    return sorted(out, key=str)


def run(spark, docs, items, window, **options):
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, items string, n_words int").repartition(3)
    got = decontaminate.benchmark_hits(d, spark.createDataFrame(items, "item_id long, text string"), window, **options)
    assert got.columns == ["doc_id", "text", "n_words", "span_start", "span_end", "items"]
    rows = got.collect()
    for r in rows:  # merged: a gap lies between neighbours
        assert all(a < b for a, b in zip(r.span_end[:-1], r.span_start[1:], strict=True))
    spread = lambda r: [w for a, b in zip(r.span_start, r.span_end, strict=True) for w in range(a, b)]
    return sorted(((str(r.doc_id), r.n_words, spread(r), r["items"]) for r in rows), key=str)


@pytest.mark.parametrize("vocabulary,seed", [(3, 1), (40, 2), (400, 3)])
def test_against_brute_force(spark, vocabulary, seed):
    rng = random.Random(seed)
    w = lambda: rng.choice(["W", "w", "é", "Q9"]) + str(rng.randrange(vocabulary))
    items = [(i, rng.choice([" ", ", ", "-\n"]).join(w() for _ in range(rng.randrange(0, 14)))) for i in range(12)] + [(None, " ".join(w() for _ in range(8))), (3, None), (3, " ".join(w() for _ in range(7)))]
    docs = []
    for i in range(40):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += [w() for _ in range(rng.randrange(0, 30))] + words_of(rng.choice(items)[1])
        docs.append((i, "; ".join(parts)))
    docs += [(None, None), (77, ""), (78, "..."), (5, docs[5][1]), (79, " ".join(w() for _ in range(5000)))]
    for options in ({}, {"block_words": 20}):
        assert run(spark, docs, items, 5, **options) == brute(docs, items, 5)


def words_of(text):
    return (text or "").replace(",", " ").replace("-", " ").split()


def test_empty_tables(spark):
    docs = [(1, "a b c"), (2, None)]
    assert run(spark, docs, [], 10) == [("1", 3, [], []), ("2", 0, [], [])]
    assert run(spark, docs, [(1, None), (2, "?!")], 10) == [("1", 3, [], []), ("2", 0, [], [])]
    assert run(spark, [], [(1, "a")], 10) == []


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(6)
    for size in (1, 2, 9, 300):
        text = np.append(rng.integers(1, 4, size), 0)
        order = suffix_array(text)
        assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
        index = FMIndex(text, 4)
        assert index.locate(np.arange(len(text))).tolist() == order.tolist()
