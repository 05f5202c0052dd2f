import zlib

import numpy as np
import pytest

from estate.llm import packing
from estate.llm.queries import word_tokenizer


def test_rule_places_by_sum_of_squares():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 33, 300)
    state = packing.OpenSequences(32)
    levels = {}
    for n in lengths.tolist():
        count = np.bincount([v for v in levels.values() if v < 32], minlength=33).astype(int)
        cost = {}
        for level in sorted({0} | set(levels.values())):
            if level + n > 32:
                continue
            after = count.copy()
            if level:
                after[level] -= 1
            if level + n < 32:
                after[level + n] += 1
            cost[level] = int((after[1:32] ** 2).sum())
        number, level = state.place(n)
        assert level == levels.get(number, 0) and cost[level] == min(cost.values())
        levels[number] = level + n
    assert max(levels.values()) <= 32


@pytest.mark.parametrize("capacity,group", [(64, 50_000), (64, 40)])
def test_documents_round_trip(spark, capacity, group, tmp_path):
    from tokenizers import Tokenizer

    odd = ["", None, "It's  THE\tend.\n\nDon't!", "étude ÉTUDE ÷x× naïve…", "a" * 3000, "100% of 3,000 ... ???", "ﬁ ǅ İstanbul ΣΑΣ", "x y z", "<|endoftext|> and <|startoftext|>a", "hello " * 400, "don't'll 'S", "word!!! %%%", "\U0001d11e music"]
    rows = [(i, t, "x", 0) for i, t in enumerate(odd * 4)] + [(None, "no id", None, None), (3, odd[3], "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string, offset int").repartition(3)
    docs.write.parquet(str(tmp_path / "d"))
    pieces = packing.tokenized_pieces(spark.read.parquet(str(tmp_path / "d")), word_tokenizer(), capacity, with_ids=True)
    got = packing.pack_sequences(pieces, capacity, group).collect()
    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = []
    for doc, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            want.append((str(doc), k, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(w[3] for w in want)
    assert len(sequences) <= 1.1 * total / capacity + 2


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), word_tokenizer()).collect() == []
