"""Benchmark passages in documents, by an FM-index over each shard of the documents.

A shard is a few megabytes of texts in one task. Its words become symbols: one per word that occurs
in a test phrase, one for all others (runs of these are one symbol). The shard's suffixes are sorted;
the symbols before them form the transform, which a wavelet matrix answers rank queries on. All test
phrases are searched backwards at once, their occurrences are located by walking to the next sampled
suffix position, and the spans of words that they cover are merged per document.

Phrases are a query set. They reach the tasks in blocks of bounded size; every block is searched in
one more pass over the rows, which carries the spans found so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import ALNUM, LOWER, WordHash, find_words, ragged, text_bytes, text_slices

SAMPLE_RATE = 8
#: Symbols below those of words: the end of the shard, and any word of no phrase or the end of a text.
END, OTHER, FIRST = 0, 1, 2


def _words(text: pa.Array, hasher: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(text)
    data = LOWER[data]
    starts, ends, counts = find_words(data, offsets, ALNUM)
    return hasher(data, starts, ends), counts, starts, ends


# --- the phrases ---


@dataclass
class Phrases:
    """Distinct windows as rows of symbols, right-aligned, and the items that hold them."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = place + FIRST
    symbols: np.ndarray  # one row per window
    sizes: np.ndarray
    item_ends: np.ndarray  # items of window w: items[item_ends[w] : item_ends[w + 1]]
    items: np.ndarray
    names: list[str | None]

    @staticmethod
    def of(items: list[tuple[str | None, np.ndarray]], window: int) -> Phrases:
        vocabulary = np.unique(np.concatenate([w for _, w in items]))
        rows, sizes, owners = [], [], []
        for k, (_, words) in enumerate(items):
            symbols = np.searchsorted(vocabulary, words) + FIRST
            size = min(window, len(symbols))
            views = np.lib.stride_tricks.sliding_window_view(symbols, size)
            padded = np.zeros((len(views), window), np.int64)
            padded[:, window - size :] = views
            rows.append(padded)
            sizes.append(np.full(len(views), size))
            owners.append(np.full(len(views), k))
        distinct, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.column_stack([which.ravel(), np.concatenate(owners)]), axis=0)
        ends = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        return Phrases(vocabulary, distinct, (distinct > 0).sum(axis=1), ends, pairs[:, 1], [name for name, _ in items])


def _item_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHash(7)
    for batch in text_slices(batches, "text"):
        words, counts, _, _ = _words(batch.column("text"), hasher)
        yield pa.RecordBatch.from_arrays([batch.column("item"), ragged(words.view(np.int64), np.diff(counts), pa.int64())], names=["item", "words"])


def phrase_blocks(benchmark: DataFrame, window: int, block_words: int, item_col: str, text_col: str) -> Iterator[Phrases]:
    """The test phrases, in blocks of about `block_words` words; an item is never divided."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(_item_words, "item string, words array<long>").where(F.size("words") > 0)
    block: list[tuple[str | None, np.ndarray]] = []
    held = 0
    for row in rows.toLocalIterator():
        words = np.array(row.words, np.int64).view(np.uint64)
        if block and held + len(words) > block_words:
            yield Phrases.of(block, window)
            block, held = [], 0
        block.append((row.item, words))
        held += len(words)
    if block:
        yield Phrases.of(block, window)


# --- the index ---


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. `text` holds small integers and ends with its only smallest one."""
    n = len(text)
    bits = int(text.max() + 1).bit_length()
    depth = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(depth):
        key <<= bits
        if j < n:
            key[: n - j] += text[j:] + 1
    order = np.argsort(key)
    new = np.ones(n, bool)
    sorted_key = key[order]
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    places = np.arange(n)
    rank = np.empty(n, np.int64)
    heads = np.maximum.accumulate(np.where(new, places, 0))
    rank[order] = heads
    while True:
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_places = np.flatnonzero(~alone)
        if not len(open_places):
            return order
        # Suffixes that are still equal are told apart by the rank of what follows.
        suffix = order[open_places]
        follow = suffix + depth
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[suffix] * (n + 1) + second
        by = np.argsort(key)
        order[open_places] = suffix[by]
        key = key[by]
        new[open_places[1:]] |= key[1:] != key[:-1]
        heads = np.maximum.accumulate(np.where(new[open_places], open_places, 0))
        rank[order[open_places]] = heads
        depth *= 2


class WaveletMatrix:
    """Rank queries on a sequence of small integers, one bit of the symbols per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = ((sequence >> bit) & 1).astype(bool)
            count = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(one, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(sequence) - int(count[-1]))
            sequence = np.concatenate([sequence[~one], sequence[one]])
        self.base = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            before = ones[place]
            place = np.where((symbol >> (self.bits - 1 - level)) & 1, zeros + before, place - before)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, place) - self.base[symbol]


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        self.transform = text[order - 1]
        self.tree = WaveletMatrix(self.transform, symbols)
        self.less = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.less[1:])
        # Every eighth position of the text is kept, with the row of its suffix.
        marked = order % SAMPLE_RATE == 0
        self.sample_row = np.flatnonzero(marked)
        self.sample_position = order[marked]
        self.marked = marked

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur, and their rows from and to."""
        live = np.arange(len(phrases.symbols))
        last = phrases.symbols[:, -1]
        low, high = self.less[last], self.less[last + 1]
        done: list[tuple[np.ndarray, ...]] = []
        for step in range(1, phrases.symbols.shape[1] + 1):
            some = low < high
            ended = some & (phrases.sizes[live] == step)
            done.append((live[ended], low[ended], high[ended]))
            some &= ~ended
            live, low, high = live[some], low[some], high[some]
            if not len(live):
                break
            symbol = phrases.symbols[live, -1 - step]
            low = self.less[symbol] + self.tree.rank(symbol, low)
            high = self.less[symbol] + self.tree.rank(symbol, high)
        return tuple(np.concatenate(c) for c in zip(*done, strict=True))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: back through the transform to a sampled one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.marked[rows])
        while len(walking):
            symbol = self.transform[rows[walking]]
            rows[walking] = self.less[symbol] + self.tree.rank(symbol, rows[walking])
            steps[walking] += 1
            walking = walking[~self.marked[rows[walking]]]
        return self.sample_position[np.searchsorted(self.sample_row, rows)] + steps


def _repeat_ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges, and the number of the range of each."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which], which


def find_hits(words: np.ndarray, counts: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word and end of every occurrence, and (text, item) of every item that occurs there."""
    none = np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(phrases.vocabulary, words), len(phrases.vocabulary) - 1)
    symbols = np.where(phrases.vocabulary[place] == words, place + FIRST, OTHER)
    # The texts with a separator after each; runs of separators and other words become one.
    ends = counts[1:]
    text = np.insert(symbols, ends, OTHER)
    word = np.insert(np.arange(len(words)), ends, -1)
    use = text != OTHER
    use[1:] |= text[:-1] != OTHER
    text, word = text[use], word[use]
    if not (text != OTHER).any():
        return none, none, none, none
    index = FMIndex(np.append(text, END), len(phrases.vocabulary) + FIRST)
    window, low, high = index.search(phrases)
    rows, which = _repeat_ranges(low, high)
    first = word[index.locate(rows)]
    window = window[which]
    entry, hit = _repeat_ranges(phrases.item_ends[window], phrases.item_ends[window + 1])
    owner = np.searchsorted(counts, first, "right") - 1
    pairs = np.unique(owner[hit] * len(phrases.names) + phrases.items[entry])
    return first, first + phrases.sizes[window], pairs // len(phrases.names), pairs % len(phrases.names)


HIT_COLUMNS = {"n_words": "long", "span_start": "array<long>", "span_end": "array<long>", "items": "array<string>"}


def _search(broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = broadcast.value
        hasher = WordHash(7)
        for batch in text_slices(batches, "text"):
            words, counts, _, _ = _words(batch.column("text"), hasher)
            first, end, text, item = find_hits(words, counts, phrases)
            found = [batch.column(c).to_pylist() for c in ("span_start", "span_end", "items")]
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, first, 1)
            np.add.at(change, end, -1)
            for i, spans in enumerate(found[0]):
                if spans:
                    np.add.at(change, counts[i] + np.array(spans), 1)
                    np.add.at(change, counts[i] + np.array(found[1][i]), -1)
            covered = np.cumsum(change[:-1]) > 0
            # Spans end with their text, as the next one may begin covered.
            edge = covered.copy()
            edge[1:] &= ~covered[:-1]
            begins = counts[:-1][counts[:-1] < counts[1:]]
            edge[begins] = covered[begins]
            starts = np.flatnonzero(edge)
            edge = covered.copy()
            edge[:-1] &= ~covered[1:]
            edge[begins[1:] - 1] = covered[begins[1:] - 1]
            ends = np.flatnonzero(edge) + 1
            owner = np.searchsorted(counts, starts, "right") - 1
            sizes = np.bincount(owner, minlength=batch.num_rows)
            base = counts[owner]
            names: list[list[str]] = [list(x or ()) for x in found[2]]
            for i, k in zip(text.tolist(), item.tolist(), strict=True):
                if phrases.names[k] is not None:
                    names[i].append(phrases.names[k])
            out = dict(zip(batch.schema.names, batch.columns, strict=True)) | {
                "n_words": pa.array(np.diff(counts), pa.int64()),
                "span_start": ragged(starts - base, sizes, pa.int64()),
                "span_end": ragged(ends - base, sizes, pa.int64()),
                "items": pa.array([sorted(set(x)) for x in names], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = 1_000_000
) -> DataFrame:
    """The rows of `docs` with n_words, span_start, span_end, items.

    Spans are merged ranges of word numbers (end not included) that lie in occurrences of windows;
    items are the ids, as strings in order, of the items with an occurring window. Words are those of
    `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is `window` words of an
    item; a shorter item is one window. A null or empty text has no words, an item without words no
    windows; an item with a null id marks words but is not named. Columns of `docs` with the names of
    the results are replaced. Words are compared by a 64-bit hash.
    """
    docs = docs.drop(*HIT_COLUMNS)
    others = [c for c in docs.columns if c != text_col]
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text_col).alias("text"))
    frame = plain.withColumns({name: F.lit(None).cast(kind) for name, kind in HIT_COLUMNS.items()})
    schema = frame.schema
    blocks = 0
    for phrases in phrase_blocks(benchmark, window, block_words, item_col, item_text_col):
        frame = frame.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(phrases)), schema)
        blocks += 1
    if not blocks:
        nothing = Phrases(np.zeros(1, np.uint64), np.zeros((0, window), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), ["-"])
        frame = frame.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(nothing)), schema)
    named = {f"c{i}": c for i, c in enumerate(others)} | {"text": text_col}
    return frame.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], F.col("text").alias(named["text"]), *HIT_COLUMNS)
