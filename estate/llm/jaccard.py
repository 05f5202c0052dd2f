"""Texts with similar sets of word shingles, by PartEnum signatures.

Sets whose sizes lie in one band, or in neighbouring bands, and whose Jaccard similarity reaches the
threshold differ in at most k elements, k being fixed by the larger band. The elements are dealt to
n > k parts by their hash; an element that only one set has spoils one part, so that similar sets
agree on at least n - k parts. Each subset of elements that a part holds is a signature (subsets of
one part are enumerated; parts are small), tagged with the band. A set has signatures for its own
band and for the next one, so that neighbours meet.

n is a fifth more than needed. So a set can do without a few of its signatures: those that very many
sets share, such as the parts that a common passage fills, are used only by sets of which they could
be all that is left of an agreement (n - k parts or more). Empty parts are treated alike.

Signatures only propose pairs: those that share as many of them as they must go on, and links are
decided on whole sets. In signatures with many sets no
pairs are listed: each set is tried against one of them, and where sets of one signature are not yet in
one component, blocks of bounded size meet (see `closing`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import LOWER, SPACED, WindowHash, WordHash, find_words, mix, ragged, text_bytes, text_slices, window_starts
from estate.llm.closing import close_groups, hubs
from estate.llm.packed import flat, groups_of, pack, text_buckets
from estate.llm.sieve import passes, sieve_of
from estate.llm.storage import fresh_name, numbered, stored

#: Groups of so many sets are tried pair by pair at once.
SMALL = 8
#: So many sets of one signature in a few megabytes of text make it a large one at once.
SLICE_HOT = 64


@dataclass(frozen=True)
class Scheme:
    """Bands of sizes, and per band the number of parts and how many of them may differ."""

    percent: int
    first: np.ndarray
    spoiled: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(percent: int, largest: int = 1 << 40) -> Scheme:
        first, last = [], []
        at = 1
        while at <= largest:
            first.append(at)
            last.append(at * 100 // percent)
            at = last[-1] + 1
        # |A - B| + |B - A| <= (1 - t) / (1 + t) * (|A| + |B|), both sizes at most the band's last.
        spoiled = np.array([(100 - percent) * 2 * x // (100 + percent) for x in last])
        return Scheme(percent, np.array(first), spoiled, -(-(spoiled + 1) * 6 // 5))


class ShingleSets:
    """The shingle sets of a slice of texts: sorted hashes, where each set starts, and a name of each set."""

    def __init__(self, shingle: int):
        self.shingle, self.words = shingle, WordHash(31)
        self.windows = WindowHash(shingle, 32)

    def read(self, batch: pa.RecordBatch) -> None:
        data, offsets = text_bytes(batch.column("text"))
        data = LOWER[data]
        starts, ends, counts = find_words(data, offsets, SPACED)
        words = self.words(data, starts, ends)
        at, text = window_starts(counts, self.shingle)
        hashes = self.windows(words)[at] if len(at) else np.zeros(0, np.uint64)
        # Shorter texts are one shingle: their words in order.
        few = np.flatnonzero((np.diff(counts) > 0) & (np.diff(counts) < self.shingle))
        if len(few):
            own = np.zeros(len(few), np.uint64)
            for j in range(self.shingle - 1):
                have = counts[few] + j < counts[few + 1]
                own = np.where(have, mix(own * np.uint64(0x9E3779B97F4A7C15) + words[np.minimum(counts[few] + j, len(words) - 1)] + np.uint64(1)), own)
            hashes, text = np.concatenate([hashes, own]), np.concatenate([text, few])
        order, heads = groups_of(text, hashes)
        self.hashes, self.text = hashes[order[heads]], text[order[heads]]
        self.sizes = np.bincount(self.text, minlength=batch.num_rows)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.hashes))])
        self.names = mix(sums[self.ends[1:]] - sums[self.ends[:-1]] + self.sizes.astype(np.uint64))

    def first_of_each(self) -> np.ndarray:
        """Texts that are the first with their set here; those without words are left out."""
        _, first = np.unique(self.names, return_index=True)
        return np.sort(first[self.sizes[first] > 0])


def _signatures(sets: ShingleSets, scheme: Scheme, chosen: np.ndarray, beside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the chosen texts for their band plus `beside`: name, place among the chosen, and
    how many unusable parts a set can have before it needs these."""
    sizes = sets.sizes[chosen]
    tag = np.searchsorted(scheme.first, sizes, "right") - 1 + beside
    parts, spoiled = scheme.parts[tag], scheme.spoiled[tag]
    place_of = np.full(len(sets.sizes), -1)
    place_of[chosen] = np.arange(len(chosen))
    element = np.flatnonzero(place_of[sets.text] >= 0)
    owner, hashes = place_of[sets.text[element]], mix(sets.hashes[element] ^ np.uint64(0x5851F42D4C957F2D))
    starts = np.concatenate([[0], np.cumsum(parts)])
    part = ((hashes >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = starts[owner] + part
    # Sums of 26-bit halves are exact in doubles.
    again = mix(hashes)
    low = np.bincount(cell, (again & np.uint64((1 << 26) - 1)).astype(float), minlength=starts[-1])
    high = np.bincount(cell, (again >> np.uint64(38)).astype(float), minlength=starts[-1])
    filled = np.bincount(cell, minlength=starts[-1]) > 0
    of = np.repeat(np.arange(len(chosen)), parts)
    name = mix(low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + high.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1))
    within = np.arange(starts[-1]) - starts[of]
    name = mix(name ^ mix(within.astype(np.uint64) + (tag[of].astype(np.uint64) << np.uint64(44))))
    empty = np.bincount(of[~filled], minlength=len(chosen))
    spare = parts - spoiled
    use = filled | (empty >= spare)[of]
    return name[use], of[use], spare - empty


def _send_signatures(scheme: Scheme, shingle: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(shingle)
        for whole in text_slices(batches, "text"):
            for at in range(0, whole.num_rows, 16000):
                batch = whole.slice(at, 16000)
                sets.read(batch)
                chosen = sets.first_of_each()
                if not len(chosen):
                    continue
                each = [_signatures(sets, scheme, chosen, beside) for beside in (0, 1)]
                name = np.concatenate([e[0] for e in each])
                entry = np.concatenate([e[1] * 2 + i for i, e in enumerate(each)])
                home = ((name >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)
                key = name & np.uint64((1 << 40) - 1)
                order, heads = groups_of(name)
                size = np.diff(np.append(heads, len(order)))
                hot = np.zeros(len(name), bool)
                hot[order] = np.repeat(size > SLICE_HOT, size)
                sign = np.zeros(len(name), np.int8)
                stand = order[heads[size > SLICE_HOT]]
                part = np.where(hot, buckets + (entry % buckets), home)
                sign[hot] = 1  # known to be large: handed on
                rows = np.concatenate([np.arange(len(name)), stand])
                part = np.concatenate([part, home[stand]])
                sign = np.concatenate([sign, np.full(len(stand), 2, np.int8)])  # says so to the others
                by = np.lexsort((entry[rows], part))
                rows, part, sign = rows[by], part[by], sign[by]
                packed = pack(
                    part,
                    {
                        "low": ((key[rows] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), pa.int32()),
                        "high": ((key[rows] >> np.uint64(32)).astype(np.uint8).view(np.int8), pa.int8()),
                        "entry": (entry[rows].astype(np.int16), pa.int16()), "home": (home[rows], pa.int32()), "sign": (sign, pa.int8()),
                    },
                )
                n = packed.num_rows
                limited = lambda x: np.clip(x, -1, 30_000).astype(np.int16)  # noqa: E731  a lower need lets more pairs on
                tile = lambda x, kind: ragged(np.tile(x, n), np.full(n, len(x)), kind)
                yield pa.RecordBatch.from_arrays(
                    [*packed.columns, tile(sets.names[chosen].view(np.int64), pa.int64()), tile(limited(each[0][2]), pa.int16()), tile(limited(each[1][2]), pa.int16())],
                    names=[*packed.schema.names, "sets", "spare0", "spare1"],
                )

    return run


SENT = "bucket int, low array<int>, high array<tinyint>, entry array<smallint>, home array<int>, sign array<tinyint>, sets array<long>, spare0 array<smallint>, spare1 array<smallint>"


def _meet(table: pa.Table) -> pa.Table:
    """Pairs of sets that share a signature of few sets, and the rows of signatures of many."""
    name = flat(table, "low").view(np.uint32).astype(np.int64)
    name |= flat(table, "high").view(np.uint8).astype(np.int64) << 32
    name |= flat(table, "home").astype(np.int64) << 40
    entry, sign = flat(table, "entry").astype(np.int32), flat(table, "sign")
    count = lambda c: np.concatenate([np.diff(np.asarray(x.offsets)) for x in table.column(c).chunks])
    base = np.repeat(np.concatenate([[0], np.cumsum(count("sets"))[:-1]]).astype(np.int32), count("low"))
    place = base + entry // 2
    set_ = flat(table, "sets")[place]
    told = sign == 1
    # Most signatures are of one set and can go before the sets are compared.
    rows = np.flatnonzero(~told)
    rows = rows[np.argsort(name[rows])]
    ordered = name[rows]
    equal = ordered[1:] == ordered[:-1]
    rows = rows[(np.append(equal, False) | np.append(False, equal))[: len(rows)] | (sign[rows] == 2)]
    order, heads = groups_of(name[rows], set_[rows])
    rows = rows[order[heads]]  # each set once per signature
    same = name[rows][1:] == name[rows][:-1]
    head = np.flatnonzero(np.append(True, ~same)) if len(rows) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(rows)))
    # A row that says so may be gone by now, as its set has been told here by another slice.
    large = np.isin(name[rows[head]], name[sign == 2]) | (size > SMALL)
    per_row = np.repeat(large, size)
    many = np.concatenate([np.flatnonzero(told), rows[per_row]])
    few = rows[~per_row]
    beside = entry[many] % 2
    spare = np.where(beside == 0, flat(table, "spare0")[place[many]], flat(table, "spare1")[place[many]])
    few_beside = entry[few] % 2
    few_spare = np.where(few_beside == 0, flat(table, "spare0")[place[few]], flat(table, "spare1")[place[few]])
    a, b, by, need = [], [], [], []
    for shift in range(1, SMALL):
        if len(few) <= shift:
            break
        pair = np.flatnonzero(name[few][shift:] == name[few][:-shift])
        a.append(set_[few[pair]])
        b.append(set_[few[pair + shift]])
        by.append(few_beside[pair])
        need.append(few_spare[pair])
    a, b, by, need = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, by, need))
    order, heads = groups_of(a, b, by)
    count = np.diff(np.append(heads, len(order)))
    a, b, by, need = (x[order[heads]] for x in (a, b, by, need))
    n, m = len(a), len(many)
    return pa.table(
        {
            "pair": pa.array(np.arange(n + m) < n), "a": pa.array(np.concatenate([a, name[many]]), pa.int64()), "b": pa.array(np.concatenate([b, set_[many]]), pa.int64()),
            "beside": pa.array(np.concatenate([by, beside]), pa.int32()), "spare": pa.array(np.concatenate([need, spare]), pa.int32()),
            "shared": pa.array(np.concatenate([count, np.ones(m, np.int64)]), pa.int32()),
        }
    )


def _send_sets(shingle: int, sieve):
    """Every row with the name and size of its set; the set itself only if the filter has its name."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(shingle)
        for batch in text_slices(batches, "text"):
            sets.read(batch)
            size = np.zeros(batch.num_rows, np.int64)
            first = sets.first_of_each()
            first = first[passes(sieve.value, sets.names[first])]
            size[first] = sets.sizes[first]
            keep = np.repeat(size > 0, sets.sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), pa.array(sets.names.view(np.int64), mask=sets.sizes == 0), pa.array(sets.sizes, pa.int64()), ragged(sets.hashes[keep].view(np.int64), size, pa.int64())],
                names=["rid", "doc_id", "id", "n", "hashes"],
            )

    return run


def _overlap(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = batch.column("one"), batch.column("two")
        shared = [len(np.intersect1d(np.asarray(x.values), np.asarray(y.values), assume_unique=True)) for x, y in zip(one, two, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("both"), pa.array(shared, pa.int64())], names=["a", "b", "both", "shared"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    of = lambda x, y, n: sets.select(F.col("id").alias(x), F.col("hashes").alias(y), F.col("n").alias(n))
    near = 100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")
    met = pairs.join(of("a", "one", "n1"), "a").join(of("b", "two", "n2"), "b").where(near)
    met = met.select("a", "b", (F.col("n1") + F.col("n2")).alias("both"), "one", "two").mapInArrow(_overlap, "a long, b long, both long, shared long")
    return stored(met.where(100 * F.col("shared") >= percent * (F.col("both") - F.col("shared"))).select("a", "b"), "links")


def _ordered(x, y) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def similar_sets(docs: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 16 << 20, rid_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, components): every row's set (rid, doc_id, id, n), and the component of each set that has a link.

    rid is the row's number in column `rid_col`; without one it holds for this result alone.
    """
    scheme = Scheme.of(percent)
    rid = F.col(rid_col) if rid_col else F.monotonically_increasing_id()
    rows = docs.select(rid.alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    buckets = min(1 << 20, text_buckets(docs, text_col, bucket_bytes))
    sent = rows.select("text").mapInArrow(_send_signatures(scheme, shingle, buckets), SENT)
    met = stored(sent.groupBy("bucket").applyInArrow(_meet, "pair boolean, a long, b long, beside int, spare int, shared int"), "signatures")
    many = met.where("NOT pair").select(F.col("a").alias("signature"), F.col("b").alias("id"), "beside", "spare")
    # A set stays in large signatures only if they could be all that it agrees on with another.
    held = stored(many.groupBy("id", "beside").agg(F.count("*").alias("have"), F.max("spare").alias("spare")), "held-signatures")
    needs = held.where("have >= spare").select("id", "beside")
    large = stored(many.join(needs, ["id", "beside"], "left_semi").select("signature", "id").distinct(), "large-signatures")
    star = large.join(hubs(large.withColumnRenamed("signature", "grp")), F.col("signature") == F.col("grp")).where("id <> hub").select(*_ordered("id", "hub"))
    # A pair has to agree on as many parts as its sets can spare; parts in large signatures may all agree.
    seen = met.where("pair").groupBy("a", "b", "beside").agg(F.sum("shared").alias("shared"), F.max("spare").alias("spare"))
    most = F.col("shared") + F.coalesce("have", F.lit(0))
    seen = seen.join(held.select(F.col("id").alias("a"), "beside", "have"), ["a", "beside"], "left").where(most >= F.col("spare"))
    pairs = stored(seen.select(*_ordered("a", "b")).unionByName(star).distinct(), "pairs")
    wanted = stored(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(large.select("id")).distinct(), "wanted-sets")
    # Sets of the wanted names alone are kept: first by the filter, then by the names themselves.
    sieve = docs.sparkSession.sparkContext.broadcast(sieve_of(wanted, F.col("id")))

    schema = "rid long, doc_id long, id long, n long, hashes array<long>"
    every = stored(rows.mapInArrow(_send_sets(shingle, sieve), schema), "rows-with-sets")
    members = every.select("rid", "doc_id", "id", "n")
    sets = every.where("size(hashes) > 0").join(wanted, "id", "left_semi").groupBy("id").agg(F.first("hashes").alias("hashes"), F.first("n").alias("n"))
    sets = stored(sets, "sets")
    links = _linked(pairs, sets, percent)
    return members, close_groups(large.withColumnRenamed("signature", "grp"), sets, links, percent)


def similarity_components(docs: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of `docs`.

    A row's set are the distinct runs of `shingle` words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; with
    fewer words, the whole sequence is one; without words (or text) the set is empty and linked with
    nothing. Rows are linked when 100 * intersection >= percent * union. component_id is the smallest
    id reachable by links; null ids are never the smallest, and a component of null ids alone has
    none. Repeated rows share a component. Other columns are ignored; an empty table gives no rows.
    Shingles and sets are compared by 64-bit hashes.
    """
    members, found = similar_sets(docs, percent, shingle, id_col, text_col)
    rows = members.where("id IS NOT NULL").join(found, "id", "left").select("doc_id", "n", F.coalesce("component", "id").alias("component"))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = rows.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = members.where("id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("doc_id", id_col)


def drop_similar(docs: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` but for all except one row of each component; the smallest id stays, a null id before others.

    Rows without words all stay.
    """
    rid = fresh_name(docs.columns, "rid")
    docs = numbered(docs, rid)
    members, found = similar_sets(docs, percent, shingle, id_col, text_col, rid_col=rid)
    rows = members.where("id IS NOT NULL").join(found, "id", "left").select("rid", "doc_id", F.coalesce("component", "id").alias("component"))
    best = rows.groupBy("component").agg(F.min(F.struct("doc_id", "rid")).alias("best"))
    gone = rows.join(best, "component").where("rid <> best.rid").select(F.col("rid").alias(rid))
    return docs.join(gone, rid, "left_anti").drop(rid)
