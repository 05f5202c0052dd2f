import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from estate.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, slot long, score int"


def brute(rows, positives=5, few=5):
    """Every anchor against every row in Python's integers."""
    taking = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    taking = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in taking]
    out = []
    for a, v, y in taking:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), i, z) for i, w, z in taking)
        for s, i, z in [x for x in scored if x[2] == y and x[1] != a][:positives]:
            fit = [x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s][:few]
            out += [(a, i, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(fit)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, label, **options).collect())


def made(rng, n, dims=6, labels=3):
    """Vectors around a few centres, so that scores tie and windows fill."""
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [round(x + rng.choice([0, 0, 0.05, 0.5]) * rng.gauss(0, 1), 2) for x in c], rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("panel_bytes", [8 << 20, 100])
def test_against_every_row(spark, panel_bytes):
    rng = random.Random(panel_bytes)
    rows = made(rng, 450)
    copies = [(1000 + i, rows[5][1], rows[5][2]) for i in range(120)]  # ties beyond the wanted number
    assert run(spark, rows + copies, panel_bytes=panel_bytes) == brute(rows + copies)


def test_tiles_smaller_than_the_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 2)
    rows = made(random.Random(3), 600, dims=70)
    assert run(spark, rows) == brute(rows)


def test_rows_that_take_no_part_and_short_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1), (100, [], 1), (200, None, 1), (300, [1.0, None], 1), (400, [float("inf"), 1.0], 1), (500, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (1, [1.0, 2.0, 0.5], 1), (2, [0.9, 1.9], 2), (3, [float("nan")], 1), (4, [2.0], 2), (6, [-3.0, -1.0], 1), (7, [1.0], 9), (8, [-0.001], 2),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[2:7]) == [] and run(spark, []) == []
    assert run(spark, [r for r in rows if r[0] and r[0] % 100]) == []


def test_repeated_rows_and_anchors(spark):
    rows = [(100, [1.0, 1.0], 1), (100, [1.0, 1.0], 1), (3, [1.0, 0.9], 1), (3, [1.0, 0.9], 1), (5, [0.9, 0.9], 2), (5, [0.9, 0.9], 2)]
    assert run(spark, rows) == brute(rows)


def test_scores_are_exact(spark):
    rng = np.random.default_rng(0)
    for dims, most in ((64, 200), (130, 3000), (5, 1 << 24), (1, 1 << 27)):
        a, b = rng.integers(-most, most, (9, dims)), rng.integers(-most, most, (40, dims))
        a[0], b[0], b[1] = most, most, -most
        residues = negatives.Residues.for_scores(dims * most * most)
        assert all(p * p * negatives.SPAN <= 4 * negatives.EXACT for p in residues.primes)
        assert (residues.scores(residues.of(a, anchors=True), residues.of(b)) == a.astype(object) @ b.astype(object).T).all()


def test_too_large_scores_raise(spark):
    with pytest.raises(ArithmeticError):
        run(spark, [(100, [1e30], 1), (1, [1e30], 1)])
