"""Hashed character n-grams of texts, and the bounded sample of labelled rows that classifiers learn from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import text_bytes

#: Characters of a text that are taken at once.
PIECE = 1 << 18
#: Parts of the labelled sample that are scored by a model of the other parts.
FOLDS = 3


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no classifier learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def gram_codes(data: np.ndarray, sizes: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each n, the code of the n bytes or characters from every place on (places near the end are left out)."""
    out = []
    shift = np.uint64(64 - bits)
    wide = data.astype(np.uint64)
    for n in sizes:
        m = len(data) - n + 1
        if m <= 0:
            out.append(np.zeros(0, np.int32))
            continue
        code = np.full(m, n, np.uint64)
        for j in range(n):
            code = code * np.uint64(0x100000001B3) + wide[j : j + m]
        out.append(((code * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32))
    return out


def present_grams(batch: pa.RecordBatch, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """For each text, the codes of its n-grams of characters, ascending; letters folded to one case, a space at both ends.

    Texts are taken in overlapping pieces, and one table of flags serves all, so that memory does not
    grow with what is derived from a text.
    """
    flags = np.zeros(1 << bits, bool)
    for text in batch.column("text"):
        text = " " + text.as_py() + " "
        for at in range(0, len(text), PIECE):
            # Folding looks at single characters, so an n-gram of the folded text lies within n characters.
            folded = text[at : at + PIECE + max(sizes) - 1].casefold()
            for codes in gram_codes(np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), np.uint32), sizes, bits):
                flags[codes] = True
        found = np.flatnonzero(flags)
        flags[found] = False
        yield found


def gram_counts(batch: pa.RecordBatch, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """For each text, how often each code occurs; bytes as they are."""
    data, offsets = text_bytes(batch.column("text"))
    codes = gram_codes(data, sizes, bits)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        total = np.zeros(1 << bits, np.int64)
        for n, c in zip(sizes, codes, strict=True):
            total += np.bincount(c[a : max(a, b - n + 1)], minlength=1 << bits)
        yield total


def labelled_sample(docs: DataFrame, labels: DataFrame, target: Column, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(target, fold, text) of at most `rows` labelled rows that are not held out, the first by a hash of their id.

    Labels without id or target are not used. Equal labels of one id count once, contradictory ones
    each; of rows that repeat an id the smallest text is taken. The sample of labels is bounded, so it
    is sent to all tasks instead of shuffling the texts.
    """
    chosen = labels.select(F.col(id_col).alias("label_id"), target.alias("target")).where("label_id IS NOT NULL AND target IS NOT NULL")
    chosen = chosen.where(~held_out("label_id")).distinct().orderBy(F.xxhash64("label_id"), "label_id", "target").limit(rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), texts.doc_id == chosen.label_id)
    fold = F.pmod(F.xxhash64(F.lit(FOLDS), "label_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return found.groupBy("label_id", "target").agg(F.min("text").alias("text")).select("target", fold, "text")


class SplitCodes:
    """Ascending codes of rows, two bytes each: the lower 16 bits, and how many codes a row has of each upper part."""

    def __init__(self, low: np.ndarray, per_upper: np.ndarray):
        self.low, self.upper = low.view(np.uint16), per_upper.shape[1]
        self.lengths = per_upper.ravel()
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __getitem__(self, entries: slice) -> np.ndarray:
        """The codes of some whole rows, given by their first and last entry."""
        runs = np.arange(*np.searchsorted(self.starts, [entries.start, entries.stop]))
        return np.repeat((runs % self.upper) << 16, self.lengths[runs]) + self.low[entries]


class SparseRows:
    """Rows of codes, with values or ones, and the two products that a linear fit needs.

    Products go over a million entries at a time, so that beside the codes little memory is used.
    """

    def __init__(self, sizes: np.ndarray, codes: np.ndarray | SplitCodes, values: np.ndarray | None, columns: int):
        self.n, self.columns, self.codes, self.values = len(sizes), columns, codes, values
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], 1 << 20)), self.n))
        self.parts = [(a, b, ends[a], ends[b], sizes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for a, b, first, last, sizes in self.parts:
            each = weights[self.codes[first:last]]
            if self.values is not None:
                each = each * self.values[first:last]
            # Rows without entries keep their zero; the others start where the one before ends.
            some = np.flatnonzero(sizes)
            if len(some):
                out[a + some] = np.add.reduceat(each, (np.cumsum(sizes) - sizes)[some])
        return out

    def transposed(self, per_row: np.ndarray) -> np.ndarray:
        out = np.zeros(self.columns)
        for a, b, first, last, sizes in self.parts:
            each = np.repeat(per_row[a:b], sizes)
            if self.values is not None:
                each = each * self.values[first:last]
            out += np.bincount(self.codes[first:last], each, minlength=self.columns)
        return out


def list_column(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and flat values of a list column."""
    column = table.column(name).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return np.diff(np.asarray(column.offsets)), np.asarray(column.flatten())


def adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam; gradient(x) gives the gradient at x."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        x -= rate * (0.5 if t > 0.7 * steps else 1) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x


def lbfgs(loss, start: np.ndarray, steps: int, memory: int = 8, tolerance: float = 1e-6) -> np.ndarray:
    """Minimise a smooth function by limited-memory BFGS; loss(x) gives the value and the gradient at x."""
    x, (value, g) = start, loss(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, along = g.copy(), []
        for s, y in reversed(moves):
            along.append(s @ d / (s @ y))
            d -= along[-1] * y
        d *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1e-12, np.linalg.norm(g))
        for (s, y), share in zip(moves, reversed(along), strict=True):
            d += s * (share - y @ d / (s @ y))
        step, slope = 1.0, g @ d
        while True:
            there = x - step * d
            new_value, new_g = loss(there)
            if new_value <= value - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        gain = value - new_value
        if gain <= 0:
            break
        s, y = there - x, new_g - g
        if s @ y > 1e-12:
            moves = [*moves[1 - memory :], (s, y)]
        x, value, g = there, new_value, new_g
        if gain < tolerance * max(1.0, abs(value)):
            break
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
