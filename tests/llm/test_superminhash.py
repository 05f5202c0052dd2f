import random

import numpy as np
import pytest
from test_jaccard import brute, changed

from estate.llm import closing, superminhash


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1, "x", True) for d, t in rows], "doc_id long, text string, id int, n string, kept boolean").repartition(4)
    got = superminhash.near_duplicates(docs, **options).collect()
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got if r.n_shingles)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    word = lambda: "w%d" % rng.randrange(3000)
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([1, 3, 6, 40, 150, 400]))]
        rows += [(len(rows) + i, " ".join(changed(rng, base, rng.randrange(8)))) for i in range(rng.randrange(1, 8))]
    rows += [(5000, None), (5001, ""), (5002, "  \n"), (None, "a b c d e f"), (5003, "A b c d e F"), (None, None), (5004, "x " * 3), (5005, "x x x")]
    rows += rows[3:9]
    assert run(spark, rows) == brute(rows, 85)
    assert run(spark, []) == []


def test_a_drifting_family_and_a_common_passage_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(closing, "BLOCK_SETS", 40)
    monkeypatch.setattr(closing, "DENSE", 6)
    rng = random.Random(2)
    base = ["b%d" % i for i in range(140)]
    family = [" ".join(changed(rng, base, rng.randrange(12))) for _ in range(220)]
    passage = " ".join("p%d" % i for i in range(60))
    common = [passage + " " + " ".join("q%d" % rng.randrange(90000) for _ in range(rng.choice([6, 30, 90]))) for _ in range(150)]
    rows = list(enumerate(family + common + family[:20]))
    assert run(spark, rows) == brute(rows, 85)


@pytest.mark.parametrize("n", [1, 2, 30, 600])
def test_ranks_are_those_of_the_plain_algorithm(n):
    """Element by element: permutation by swaps, ranks j + u, smallest rank of each place."""
    places = superminhash.BANDS * superminhash.ROWS
    elements = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    got = superminhash.signatures(np.zeros(n, np.int64), elements, 1)[0]
    want = [1 << 64] * places
    for e in elements:
        order = list(range(places))
        for j in range(places):
            seed = superminhash.mix(np.array([e]) ^ np.uint64(0x2545F4914F6CDD1D))
            draw = superminhash.mix(seed + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            k = j + (int(draw[0]) >> 32) * (places - j) // (1 << 32)
            order[j], order[k] = order[k], order[j]
            want[order[j]] = min(want[order[j]], j << 56 | int(superminhash.mix(draw)[0]) >> 8)
    assert got.tolist() == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = pool[:260], pool[40:]
        ranks = superminhash.signatures(np.repeat([0, 1], 260), np.concatenate([a, b]), 2)
        errors.append((ranks[0] == ranks[1]).mean() - 220 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < np.sqrt(0.73 * 0.27 / 192)


def test_common_elements():
    rng = random.Random(7)
    sets = [set(rng.sample(range(80), rng.randrange(60))) for _ in range(90)]
    owner = np.array([i for i, s in enumerate(sets) for _ in s])
    elements = np.array([e for s in sets for e in s])
    want = np.array([[len(a & b) if a is not b else 0 for b in sets] for a in sets])
    got = closing.common_elements(owner, elements, 90)
    np.fill_diagonal(got, 0)
    assert (got == want).all()
