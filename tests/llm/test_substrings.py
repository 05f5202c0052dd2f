import hashlib
import random
import re

import pytest

from estate.llm import substrings


def brute(rows, window):
    split = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    first = {}
    for doc, words in split:
        for k in range(len(words) - window + 1):
            if doc is not None:
                key = tuple(words[k : k + window])
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[k : k + window])] < doc:
                gone.update(range(k, k + window))
        out.append((str(doc), len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out)


def run(spark, rows, window, **options):
    docs = spark.createDataFrame([(d, t, "x", None) for d, t in rows], "doc_id long, text string, kept string, rid int").repartition(4)
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs, window, **options).collect())


@pytest.mark.parametrize("words,seed", [(400, 1), (6, 2), (2, 3)])
def test_against_brute_force(spark, words, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" if i % 7 else f"Wö{i}," for i in range(words)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [text(n) for n in (45, 49, 50, 51, 60, 130)] + [["same"] * 55, ["a", "b"] * 40, ["x"] * 3 + text(30) + ["y"] * 25]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += text(rng.randrange(0, 70))
            parts += rng.choice(passages)
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", "\t \r"]).join(parts)))
    rows += [(5, None), (6, ""), (None, rows[10][1]), (None, rows[10][1]), (2000, rows[11][1]), (2000, rows[11][1]), (2001, " ".join(text(9000) + passages[5]))]
    assert run(spark, rows, 50, bucket_bytes=4000) == brute(rows, 50)
    assert run(spark, rows, 64) == brute(rows, 64)


def test_digest_window_and_empty_table(spark):
    got = substrings.remove_repeats(spark.createDataFrame([(1, " a  b ")], "doc_id long, text string"), digest=True).collect()
    assert got[0].kept == hashlib.sha256(b"a b").hexdigest()
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), window=20)


def test_shared_windows_have_a_shared_middle():
    """The symbols over the middle of a window are the same whatever stands around it."""
    import numpy as np

    rng = np.random.default_rng(5)
    for alphabet in (2, 3, 50):
        for _ in range(200):
            window = rng.integers(0, alphabet, 50).astype(np.uint64)
            parsed = []
            for _ in range(2):
                before, after = (rng.integers(0, alphabet, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
                words = np.concatenate([before, window, after]) + np.uint64(7)
                names, first = substrings.symbols_of(words, np.array([0, len(words)]))
                ends = np.append(first[1:], len(words))
                inside = (first < len(before) + 50 - substrings.LOST) & (ends > len(before) + substrings.LOST)
                parsed.append([(int(n), int(f) - len(before)) for n, f in zip(names[inside], first[inside], strict=True)])
            assert parsed[0] == parsed[1]
