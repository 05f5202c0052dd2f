"""Hard negatives of anchors by exact integer inner products in a residue number system.

Components become integers; a panel of anchors meets blocks of rows in matrix products, one for each of
several small primes. A product is done on residues in float32: residues are centred and sums are cut
after so many terms that they stay below 2**24, so every sum is exact. The anchors' residues carry the
factors of Chinese remaindering already, so that products y_i satisfy

    score = sum(y_i * (P / p_i)) - P * round(sum(y_i / p_i)),

P being the product of the primes: int64 arithmetic modulo 2**64 on whole arrays. The primes are chosen so
that P is over four times the largest possible score, by the Cauchy-Schwarz bound of the table's longest row.

Anchors are a query set of a part of the rows. They meet all rows panel by panel; a panel has a bounded
size and is broadcast. A task keeps the best few rows of each anchor while it reads its blocks, Spark merges
those of all tasks. The first sweep finds positives, the second one negatives inside the windows that the
positives' scores give. Each sweep's results are stored, so a lost executor costs only its own tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estate.llm.storage import stored

#: A float32 holds all integers up to this one.
EXACT = 1 << 24
#: Products of centred residues are summed over at most so many components at once.
SPAN = 64
LARGEST_PRIME = 2 * math.isqrt(EXACT // SPAN) - 1
LONGEST = 1 << 55
#: Rows of a tile of scores, and anchors.
TILE_ROWS, TILE_ANCHORS = 2048, 512
LOW = -np.iinfo(np.int64).max

OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def small_primes(bound: int) -> list[int]:
    """The largest primes up to LARGEST_PRIME whose product is over four times the bound."""
    found, product, n = [], 1, LARGEST_PRIME
    while product <= 4 * bound or not found:
        while any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
            n -= 1
        if n < 3:
            raise ArithmeticError("scores are beyond 64 bits")
        found.append(n)
        product *= n
        n -= 1
    return found


@dataclass(frozen=True)
class Residues:
    """The primes, and for each one P / p modulo 2**64 and the factor that the anchors carry."""

    primes: tuple[int, ...]

    @staticmethod
    def for_scores(bound: int) -> Residues:
        if bound > LONGEST:
            raise ArithmeticError(f"scores of up to {bound} do not fit 64 bits")
        return Residues(tuple(small_primes(bound)))

    @property
    def modulus(self) -> int:
        return math.prod(self.primes)

    def of(self, rows: np.ndarray, anchors: bool = False) -> list[np.ndarray]:
        """Centred residues of int64 rows, as float32, by prime."""
        out = []
        for p in self.primes:
            r = rows % p
            if anchors:
                r = r * pow(self.modulus // p, -1, p) % p
            out.append((r - p * (r > p // 2)).astype(np.float32))
        return out

    def scores(self, anchors: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
        """Inner products of all anchors with all rows, exactly, from the residues of both."""
        total = turns = None
        for p, a, b in zip(self.primes, anchors, rows, strict=True):
            y = np.zeros((len(a), len(b)), np.float32)
            for at in range(0, a.shape[1], SPAN):
                part = a[:, at : at + SPAN] @ b[:, at : at + SPAN].T
                part -= np.rint(part * np.float32(1 / p)) * np.float32(p)
                y += part
            y -= np.rint(y * np.float32(1 / p)) * np.float32(p)
            whole = y.astype(np.int64)
            weight = np.uint64(self.modulus // p % (1 << 64)).astype(np.int64)
            total = whole * weight if total is None else total + whole * weight
            share = whole / p
            turns = share if turns is None else turns + share
        return total - np.rint(turns).astype(np.int64) * np.uint64(self.modulus % (1 << 64)).astype(np.int64)


class Best:
    """The best few (score, id) of every slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, most: int):
        self.scores, self.ids = np.full((slots, most), LOW), np.full((slots, most), np.iinfo(np.int64).max)

    def take(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer a tile, a row of scores per slot; `ids` ascend, LOW is no offer. The tile is used up."""
        at = np.arange(len(slots))
        for _ in range(self.scores.shape[1]):
            column = scores[at].argmax(1) if len(at) < len(slots) else scores.argmax(1)
            value, own = scores[at, column], slots[at]
            better = (value > self.scores[own, -1]) | (value == self.scores[own, -1]) & (ids[column] < self.ids[own, -1]) & (value > LOW)
            at, column, value, own = at[better], column[better], value[better], own[better]
            if not len(at):
                return
            scores[at, column] = LOW
            self.scores[own, -1], self.ids[own, -1] = value, ids[column]
            order = np.lexsort((self.ids[own], -self.scores[own]))
            self.scores[own] = np.take_along_axis(self.scores[own], order, 1)
            self.ids[own] = np.take_along_axis(self.ids[own], order, 1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.scores > LOW)
        return slot, self.ids[slot, place], self.scores[slot, place]


def taking_part(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels, sizes and all components floor(scale * x), as whole doubles, of the rows without null or non-finite components."""
    lists = batch.column("vector")
    sizes = np.diff(np.asarray(lists.offsets))
    values = np.floor(scale * np.asarray(lists.flatten().cast(pa.float64())))  # nulls are not numbers here
    row = np.repeat(np.arange(len(sizes)), sizes)
    fit = np.ones(len(sizes), bool)
    fit[row[~np.isfinite(values)]] = False
    return np.asarray(batch.column("id"))[fit], np.asarray(batch.column("label"))[fit], sizes[fit], values[fit[row]]


def matrix_of(sizes: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Vectors as int64 rows; shorter ones are filled with zeros."""
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values.astype(np.int64)
    return out


@dataclass(frozen=True)
class Panel:
    """A bounded number of anchors, and the windows of scores in which negatives are looked for (without them: positives)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    #: The anchor of each window, in order, with its positive and that one's score, and the window's bounds.
    anchor: np.ndarray | None = None
    positive: np.ndarray | None = None
    positive_score: np.ndarray | None = None
    least: np.ndarray | None = None
    greatest: np.ndarray | None = None


def _sweep(sent, residues: Residues, scale: float, most: int):
    """Tasks that read all rows once and give the best rows of every anchor, or of every window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Panel = sent.value
        tiles = [np.arange(at, min(at + TILE_ANCHORS, len(p.ids))) for at in range(0, len(p.ids), TILE_ANCHORS)]
        anchors = [residues.of(p.vectors[t], anchors=True) for t in tiles]
        best = Best(len(p.ids) if p.anchor is None else len(p.anchor), most)
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_ROWS):
                ids, labels, sizes, values = taking_part(whole.slice(at, TILE_ROWS), scale)
                if not len(ids):
                    continue
                order = np.argsort(ids, kind="stable")
                ids, labels = ids[order], labels[order]
                rows = residues.of(matrix_of(sizes, values, p.vectors.shape[1])[order])
                for t, a in zip(tiles, anchors, strict=True):
                    scores = residues.scores(a, rows)
                    same = p.labels[t][:, None] == labels[None, :]
                    if p.anchor is None:
                        scores[~same | (p.ids[t][:, None] == ids[None, :])] = LOW
                        best.take(t, scores, ids)
                        continue
                    scores[same] = LOW
                    slots = np.arange(*np.searchsorted(p.anchor, [t[0], t[-1] + 1]))
                    turn = np.arange(len(slots)) - np.searchsorted(p.anchor[slots], p.anchor[slots])
                    for k in range(int(turn.max(initial=-1)) + 1):  # a window of each anchor at a time
                        own = slots[turn == k]
                        inside = scores[p.anchor[own] - t[0]]
                        inside[(inside < p.least[own][:, None]) | (inside > p.greatest[own][:, None])] = LOW
                        best.take(own, inside, ids)
        slot, ids, scores = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["slot", "id", "score"])

    return run


def _extent(scale: float):
    """Per task the number of rows, the longest vector, and the largest sum of squares."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = width = 0
        longest = 0.0
        for batch in batches:
            ids, _, sizes, values = taking_part(batch, scale)
            if len(ids):
                n, width = n + len(ids), max(width, int(sizes.max()))
                squares = np.bincount(np.repeat(np.arange(len(sizes)), sizes), values * values, len(sizes))
                longest = max(longest, float(squares.max()))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([width], pa.int64()), pa.array([longest], pa.float64())], names=["n", "width", "longest"])

    return run


def _firsts(rows: DataFrame, most: int) -> DataFrame:
    """Of the tasks' rows the best few of each slot, with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, panel_bytes: int = 8 << 20,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    A row's score is the inner product of its components floor(scale * x) with the anchor's. An anchor's
    positives are its best `positives` other rows of the same label; the negatives of both are the best
    rows of other labels with low * positive_score <= 100 * score <= high * positive_score. Ties go to the
    smaller id. `anchors` and `label` (whole numbers) are expressions over the columns of `vectors`.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Vectors shorter
    than the longest one are filled with zeros, empty ones score 0. Repeated rows count each on their own,
    as anchors too; a row with the anchor's id is never its positive. Other columns are ignored; an empty table, or
    one without anchors, gives no rows. Scores that could pass 2**55 raise an ArithmeticError.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).alias("vector"), anchors.alias("anchor"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    reads = rows.select("id", "label", "vector")
    extent = reads.mapInArrow(_extent(scale), "n long, width long, longest double").agg(F.sum("n").alias("n"), F.max("width").alias("width"), F.max("longest").alias("longest")).first()
    empty = spark.createDataFrame([], OUTPUT)
    if not extent.n:
        return empty
    if not extent.longest < LONGEST:
        raise ArithmeticError(f"scores of up to {extent.longest:g} are too large")
    residues, width = Residues.for_scores(int(extent.longest * (1 + 1e-9)) + 1), max(1, extent.width)

    count = rows.where("anchor").count()
    panels = -(-count * width * 8 // panel_bytes)
    # Anchors are dealt once and stored, so each has its panel for good.
    dealt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(max(1, panels)))
    dealt = stored(rows.where("anchor").select("id", "label", "vector", dealt.alias("panel")), "anchors")
    out = empty
    for panel in range(panels):
        table = dealt.where(F.col("panel") == panel).drop("panel").toArrow().combine_chunks()
        if not table.num_rows:
            continue
        ids, labels, sizes, values = taking_part(table.to_batches()[0], scale)
        first = Panel(ids, labels, matrix_of(sizes, values, width))
        sent = spark.sparkContext.broadcast(first)
        near = _firsts(reads.mapInArrow(_sweep(sent, residues, scale, positives), "slot long, id long, score long"), positives).toArrow().sort_by([("slot", "ascending"), ("rank", "ascending")])
        sent.unpersist()
        anchor, positive, score = (np.asarray(near.column(c).combine_chunks()) for c in ("slot", "id", "score"))
        second = Panel(ids, labels, first.vectors, anchor, positive, score, -(-low * score // 100), high * score // 100)
        sent = spark.sparkContext.broadcast(second)
        found = _firsts(reads.mapInArrow(_sweep(sent, residues, scale, negatives), "slot long, id long, score long"), negatives)
        windows = pa.table({"slot": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": positive, "positive_score": score})
        named = found.join(spark.createDataFrame(windows), "slot")
        named = named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = out.unionByName(stored(named, "negatives"))
        sent.unpersist()
    return out
