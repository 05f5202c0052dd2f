"""Packing of tokenized documents into sequences by the sum-of-squares rule.

A piece goes where it makes the sum over all residual gaps of (open sequences with that gap) squared
smallest: into an open sequence that has room, or into a new one. Ties go to the smallest gap left,
and an open sequence before a new one. Pieces are placed from the longest to the shortest.

Pieces are dealt at random to groups of bounded size, which are packed side by side. Sequences that
a group leaves with room are opened again: their pieces go to the next round, with fewer groups, and
only the last round's leavings stay. One group's state is a table of gaps and its own pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.storage import stored

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
_CACHE_WORDS = 400_000
_tokenizers: dict[str, "WordCache"] = {}


#: Letters of ASCII and Latin-1, then marks of ASCII: the pre-tokenizer makes two pieces of such a word,
#: and the normaliser lower-cases its letters and changes nothing else.
_PLAIN_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")


class WordCache:
    """Ids of words between ASCII white space, as little-endian 32-bit numbers.

    The tokenizer's pre-tokenizer never joins text over white space, and its normaliser works on each
    side of it alone, so the ids of a text are those of its words one after another. Plain words go to
    the tokenizer's model by their two pieces, all others through the whole tokenizer. A bounded number
    of words is kept; when it is reached, the words seen since the last time stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        byte_level = self.tokenizer.pre_tokenizer
        self.mapped = {i: "".join(piece for piece, _ in byte_level.pre_tokenize_str(chr(i))) for i in range(0xDF, 0x100) if chr(i).isalpha()}

    def _whole(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def _plain(self, letters: str, marks: str) -> bytes:
        letters = letters.lower()
        first = self.letters.get(letters)
        if first is None:
            first = b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(letters.translate(self.mapped)))
            self.letters[letters] = first
        if marks not in self.marks:
            self.marks[marks] = self._whole([marks])[0]
        return first + self.marks[marks]

    def learn(self, words: set[bytes]) -> None:
        if len(self.new) > _CACHE_WORDS:
            self.old, self.new = self.new, {}
        if len(self.letters) > _CACHE_WORDS or len(self.marks) > _CACHE_WORDS:
            self.letters, self.marks = {}, {"": b""}
        missing = []
        for w in words:
            if w not in self.new:
                known = self.old.get(w)
                if known is None:
                    word = w.decode()
                    plain = _PLAIN_WORD.fullmatch(word)
                    if plain is None:
                        missing.append(word)
                        continue
                    known = self._plain(*plain.groups())
                self.new[w] = known
        for w, ids in zip(missing, self._whole(missing), strict=True):
            self.new[w.encode()] = ids

    def ids(self, text: bytes) -> bytes:
        words = text.split()
        try:
            return b"".join(map(self.new.__getitem__, words))
        except KeyError:
            self.learn(set(words))
            return b"".join(map(self.new.__getitem__, words))


def _tokenizer(path: str) -> WordCache:
    """One per Python worker: workers are used again for later tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordCache(path)
    return _tokenizers[path]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, row, piece, start, length, ids_crc32 and, if asked for, ids.

    A text's ids end with `end_id`; only longer ones than `capacity` are cut. A null text counts as
    empty and is one piece of one id. `row` is unique for each row of `docs`.
    """
    schema = PIECES + (", ids array<long>" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _tokenizer(tokenizer_path)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out: list[list] = [[] for _ in names]
                part = batch.slice(at, 512)
                # Each text is taken as bytes by itself: its ids may be larger than the text.
                for doc, row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.binary()), strict=True):
                    ids = cache.ids(text.as_py() or b"") + tail
                    for k, start in enumerate(range(0, len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + capacity)]
                        row_out = (doc, row, k, start, len(own) // 4, zlib.crc32(own))
                        for column, value in zip(out, row_out + ((np.frombuffer(own, "<u4").astype(np.int64),) if with_ids else ()), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=False)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokenize, schema)


class OpenSequences:
    """Open sequences by level (ids they hold), with the sum-of-squares rule."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes a piece, and the place there."""
        c, cap = self.count, self.capacity
        # Moving one sequence from level h to h + length changes the sum by 2 * (count[h + length] - count[h]) + 2;
        # full sequences no longer count; a new one adds 2 * count[length] + 1.
        level, best = 0, 2 * int(c[length]) + 1 if length < cap else 0
        if length < cap:
            held = c[1 : cap - length + 1]
            cost = 2 * (c[1 + length : cap + 1] - held) + 2
            cost[-1] = 1 - 2 * held[-1]
            cost[held == 0] = np.iinfo(np.int64).max
            # The last of equal costs has the smallest gap.
            at = len(cost) - 1 - int(np.argmin(cost[::-1]))
            if cost[at] <= best and held[at]:
                level = at + 1
        if level:
            number = self.stacks[level].pop()
            c[level] -= 1
        else:
            number = self.opened
            self.opened += 1
        to = level + length
        if to < cap:
            c[to] += 1
            self.stacks[to].append(number)
        return number, level


def place_pieces(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, placed from the longest to the shortest.

    The pieces of sequences that stay with room are placed again by themselves, as long as that
    takes fewer sequences.
    """
    sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rest, used, had = np.argsort(-lengths, kind="stable"), 0, np.iinfo(np.int64).max
    while len(rest):
        state = OpenSequences(capacity)
        where = np.array([state.place(n) for n in lengths[rest].tolist()])
        if state.opened >= had:
            break
        offsets[rest] = where[:, 1]
        filled = np.bincount(where[:, 0], lengths[rest]).astype(np.int64)
        # Full sequences get the first numbers and are done.
        order = np.argsort(filled < capacity, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        sequences[rest] = number[where[:, 0]] + used
        used += int((filled == capacity).sum())
        rest = rest[filled[where[:, 0]] < capacity]
        had = int((filled < capacity).sum())
    return sequences, offsets


def _pack_round(pieces: DataFrame, groups: int, capacity: int, step: int, seed: int) -> DataFrame:
    """(row, piece, length) packed in `groups` random groups; sequence_id is unique over groups and rounds."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["row", "piece"])
        group = int(frame["group"].iloc[0])
        sequences, offsets = place_pieces(frame["length"].to_numpy(), capacity)
        filled = np.bincount(sequences, frame["length"]).astype(np.int64)
        return pd.DataFrame(
            {
                "row": frame["row"], "piece": frame["piece"], "length": frame["length"],
                "sequence_id": (step * (1 << 56)) + group * (1 << 28) + sequences, "offset": offsets, "filled": filled[sequences],
            }
        )

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.lit(seed + step), "row", "piece"), F.lit(groups)).cast("long"))
    return dealt.groupBy("group").applyInPandas(pack, "row long, piece int, length long, sequence_id long, offset long, filled long")


def pack_sequences(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 50_000, seed: int = 5) -> DataFrame:
    """Every row of `pieces` (row, piece, length; others are kept) with sequence_id and offset.

    A sequence holds at most `capacity` ids and its pieces lie without gaps from 0. Rounds go on
    while more than one group's worth of pieces lies in sequences with room; each works on what the
    round before could not fill, and their number is the logarithm of the input at most. An empty
    table gives no rows.
    """
    wanted = stored(pieces, "pieces")
    rest, closed, step = wanted.select("row", "piece", "length"), None, 0
    while True:
        n = rest.count()
        groups = max(1, -(-n // group_pieces))
        packed = stored(_pack_round(rest, groups, capacity, step, seed), f"packed-{step}")
        last = groups == 1 or step >= 40
        full = packed if last else packed.where(F.col("filled") == capacity)
        closed = full if closed is None else closed.unionByName(full)
        if last:
            break
        rest, step = packed.where(F.col("filled") < capacity).select("row", "piece", "length"), step + 1
    return wanted.join(closed.select("row", "piece", "sequence_id", "offset"), ["row", "piece"])


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Documents as packed training sequences, one row per piece, in any order.

    doc_id (null stays null), piece, start, length, ids_crc32, sequence_id, offset and, if asked for,
    the ids. Repeated rows are packed each by itself. Columns of `docs` other than id and text are
    ignored.
    """
    pieces = tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    return pack_sequences(pieces, capacity).drop("row").withColumnRenamed("doc_id", id_col)


