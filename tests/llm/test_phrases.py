import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from estate.llm import phrases


def brute(rows, support, first=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    found = {(lang, p): c for (lang, p), c in f.items() if c >= support and len(p) > 1}
    out = []
    for (lang, p), a in found.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(x == lang and len(q) > len(p) and c >= a and inside(q) for (x, q), c in found.items()):
            continue
        score, cut = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:cut]], f[lang, p[cut:]]))
    rank = Counter()
    rows = []
    for lang, score, a, p, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= first:
            rows.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -score))
    return rows


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, lang string, n int, phrase string, k int").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


def made(rng, n, longest=60):
    vocabulary = ["the", "of", "New", "york", "city", "Ünïcode", "naïve", "日本", "x", "a`b", "N'", "%s"] + [f"w{i}" for i in range(12)]
    fixed = ["new york city hall", "of the x", "日本 naïve Ünïcode", "a a a a a a"]
    gap = lambda: rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", ";", "\x0b", " ! "])
    text = lambda: "".join((rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary)) + gap() for _ in range(rng.randrange(longest)))
    return [(i, text(), rng.choice(["en", "en", "de", "", None])) for i in range(n)]


@pytest.mark.parametrize(("seed", "size"), [(1, 16 << 20), (3, 200)])
def test_against_plain_counts(spark, seed, size):
    rows = made(random.Random(seed), 250) + [(900, None, "en"), (901, "", "de"), (902, None, None), (None, "new york city hall", "en")]
    rows += rows[:40]  # repeated rows
    for shards in (1, 4):
        assert run(spark, rows, support=9, slice_bytes=size, shard=F.pmod(F.hash("text"), F.lit(shards))) == brute(rows, 9)


def test_long_texts_are_cut_where_pieces_end(spark):
    rng = random.Random(5)
    long = " ".join(t for _, t, _ in made(rng, 300))
    whole = " ".join(rng.choice(["p", "q", "r"]) for _ in range(3000))  # one piece, longer than a shard
    rows = [(1, long, "en"), (2, whole, "de"), (3, long + whole, "en")]
    assert run(spark, rows, support=12, slice_bytes=2000, first=40) == brute(rows, 12, 40)


def test_first_rows_ties_and_no_rows(spark):
    rows = [(i, "a b. c d. e f g. e f h", "en") for i in range(7)]
    assert run(spark, rows, support=7, first=3) == brute(rows, 7, 3)
    assert run(spark, rows, support=15) == [] and run(spark, []) == [] and run(spark, [(1, None, None)]) == []


def test_a_hot_language_and_a_phrase_of_one_shard(spark):
    rows = [(i, "only here now", "en") for i in range(20)] + [(100 + i, f"u{i} v{i % 7} end", "en") for i in range(2000)]
    shard = F.when(F.col("doc_id") < 100, 3).otherwise(F.pmod(F.hash("text"), F.lit(40)))  # t is 1 in some
    assert run(spark, rows, support=20, slice_bytes=3000, shard=shard) == brute(rows, 20)


def test_words_of_a_phrase_are_read_in_one_text_however_many_slices_hold_it(spark, monkeypatch):
    """The last pass made a row for each frequent phrase of each slice, and both grow with the table."""
    made, kind = [], type(spark.range(0))
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda *a, **b: made.append(plain(*a, **b)) or made[-1])
    rows = [(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(30)) + f". t{i}", "en") for i in range(2000)]
    assert run(spark, rows, support=100, slice_bytes=1000) == brute(rows, 100)
    assert made[-1].where("k > 0").count() < 400  # 250 phrases are frequent; slices of 1000 bytes hold most of them
