import random
import re

import numpy as np
import pyarrow as pa
import pytest

from estate.llm import jaccard
from estate.llm.components import components


def brute(rows, percent=80):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((str(doc), len(sets[i]), str(least.get(root(i)))) for i, (doc, _) in enumerate(rows))


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, id int, n string").repartition(4)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similarity_components(docs, **options).collect())


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], ["new%d" % rng.randrange(999)], [words[k], "add"]])
        words = words or ["w"]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    common = [word() for _ in range(40)]
    rows = []
    for size in (5, 7, 12, 30, 80, 200, 600):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 4, 6, 9, 14, 20):
            rows.append((len(rows) * 7 % 997, " ".join(changed(rng, base, min(edits, size // 3)))))
    # A large family of near copies that drifts away from its first member, and texts with a common passage.
    now = [word() for _ in range(120)]
    for _ in range(60):
        now = changed(rng, now, 1)
        rows.append((rng.randrange(5000), " ".join(now)))
    for _ in range(60):
        rows.append((rng.randrange(5000), " ".join([word() for _ in range(rng.randrange(4, 60))] + common)))
    rows += [(9001, None), (9002, ""), (9003, " \n"), (9004, "One two"), (9005, "one\tTWO"), (9006, "one two three four"), (None, rows[3][1]), (None, "all alone here without an id"), (4, rows[9][1]), (4, rows[9][1])]
    assert run(spark, rows) == brute(rows)


def test_large_signatures_whose_first_sets_have_copies_elsewhere(monkeypatch):
    """Slices with families that drift, and slices with copies of their first members: similar sets meet,
    and where a slice says that a signature is large, all sets that have it are told."""
    monkeypatch.setattr(jaccard, "SLICE_HOT", 4)
    monkeypatch.setattr(jaccard, "SMALL", 3)
    rng = random.Random(6)
    slices = [[], [], [], []]
    for k in range(24):
        now = ["u%d" % rng.randrange(1 << 40) for _ in range(60)]
        drift = [now := changed(rng, now, 1) for _ in range(14)]
        at = [slices[(k + j) % 4] for j in range(3)]
        at[0] += [" ".join(w) for w in drift[:10]]
        at[1] += [" ".join(drift[0]), " ".join(drift[10])]
        at[2] += [" ".join(drift[0]), " ".join(drift[12]), " ".join(drift[13])]
    send = jaccard._send_signatures(jaccard.Scheme.of(80), 5, 2)
    table = pa.Table.from_batches([b for texts in slices for b in send(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))])
    bucket = np.asarray(table.column("bucket"))
    pairs, many, told, have = set(), {}, set(), {}
    for b in np.unique(bucket):
        part = table.filter(pa.array(bucket == b))
        for r in part.to_pylist():
            for low, high, entry, home, sign in zip(r["low"], r["high"], r["entry"], r["home"], r["sign"]):
                name = (low & 0xFFFFFFFF) | (high & 0xFF) << 32 | home << 40
                have.setdefault(name, set()).add(r["sets"][entry // 2])
                if sign == 2:
                    told.add(name)
        for r in jaccard._meet(part).to_pylist():
            if r["pair"]:
                pairs.add(frozenset((r["a"], r["b"])))
            else:
                many.setdefault(r["a"], set()).add(r["b"])
    assert len(told) > 100
    assert [n for n in told if many.get(n) != have[n]] == []
    sets = jaccard.ShingleSets(5)
    sets.read(pa.RecordBatch.from_arrays([pa.array(sum(slices, []))], names=["text"]))
    each = {int(n): set(sets.hashes[a:b].tolist()) for n, a, b in zip(sets.names.view(np.int64), sets.ends[:-1], sets.ends[1:])}
    met = pairs | {frozenset((a, b)) for group in many.values() for a in group for b in group if a < b}
    near = {frozenset((a, b)) for a in each for b in each if a < b and 100 * len(each[a] & each[b]) >= 80 * len(each[a] | each[b])}
    assert len(near) > 200 and near <= met


def test_many_small_families_at_another_threshold(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(25):
        base = ["v%d" % rng.randrange(200) for _ in range(rng.randrange(10, 60))]
        rows += [(rng.randrange(10_000), " ".join(changed(rng, base, rng.randrange(0, 5)))) for _ in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similarity_components(docs, percent=60).collect())
    assert got == brute(rows, 60)


def test_similar_sets_share_a_signature():
    """Random sets at and above the threshold, in one band and in neighbouring ones."""
    scheme = jaccard.Scheme.of(80)
    rng = np.random.default_rng(4)
    for _ in range(300):
        both = int(rng.integers(4, 200))
        extra = both // 4
        split = int(rng.integers(0, extra + 1))
        pool = np.unique(rng.integers(0, 1 << 63, both + extra + 50).astype(np.uint64))[: both + extra]
        rng.shuffle(pool)
        one, two = pool[: both + split], np.concatenate([pool[:both], pool[both + split :]])
        found = []
        for elements in (one, two):
            sets = jaccard.ShingleSets(5)
            sets.hashes, sets.text, sets.sizes = np.sort(elements), np.zeros(len(elements), np.int64), np.array([len(elements)])
            found.append(set(np.concatenate([jaccard._signatures(sets, scheme, np.array([0]), beside)[0] for beside in (0, 1)]).tolist()))
        assert found[0] & found[1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (200, 201), (300, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(30)} == {100} and got[201] == 200 and got[300] == 300
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table_and_dropping(spark):
    assert jaccard.similarity_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(3, "a b c d e f g"), (2, "a b c d e f g"), (2, "q w e r t y u"), (None, None), (9, "")], "doc_id long, text string")
    got = jaccard.drop_similar(docs).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in docs.collect() if r.doc_id != 3)
