"""Near-duplicate texts by SuperMinHash signatures, banding, verification on whole sets and components.

Each element of a set draws a permutation of the signature's places and takes its j-th place with the rank
j + u, u being uniform in [0, 1); a place keeps the smallest rank of all elements. As an element's ranks
differ in their whole parts, they are spread evenly over the places, and a signature's error is smaller
than that of independent minima. All elements of some megabytes of texts draw their j-th step together; a
set stops as soon as j is beyond the whole part of its largest rank, which large sets reach after few steps.

Bands of several places propose groups of sets: 32 bands of 6 places miss a pair that is 85 % similar with
a probability of 3 in 10 million. Links are decided on whole sets. Groups of any size are closed without a
list of all their pairs (see `closing`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import mix, ragged, text_slices
from estate.llm.closing import close_groups, hubs
from estate.llm.jaccard import ShingleSets, _linked
from estate.llm.sieve import passes, sieve_of
from estate.llm.storage import stored

BANDS, ROWS = 32, 6
#: A rank's whole part has 8 bits, so there are fewer than 255 places.
NONE = np.uint64((1 << 64) - 1)


def signatures(owner: np.ndarray, elements: np.ndarray, sets: int, places: int = BANDS * ROWS) -> np.ndarray:
    """The ranks of each set, a row of uint64: the whole part in the top 8 bits. `owner` is the set of each element."""
    ranks = np.full((sets, places), NONE)
    seeds = mix(elements ^ np.uint64(0x2545F4914F6CDD1D))
    swaps = np.zeros((len(elements), 0), np.int16)
    flat = ranks.reshape(-1)
    for j in range(places):
        if not len(owner):
            break
        draw = mix(seeds + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        chosen = (j + ((draw >> np.uint64(32)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)).astype(np.int16)
        # The place at position `chosen` of the permutation, as earlier swaps have left it.
        place = chosen.copy()
        for t in range(j - 1, -1, -1):
            np.copyto(place, np.int16(t), where=swaps[:, t] == place)
        swaps = np.concatenate([swaps, chosen[:, None]], axis=1)
        rank = np.uint64(j) << np.uint64(56) | mix(draw) >> np.uint64(8)
        np.minimum.at(flat, owner * places + place, rank)
        of = np.unique(owner)
        done = np.zeros(sets, bool)
        done[of] = (ranks[of].max(1) >> np.uint64(56)) < np.uint64(j + 1)
        on = ~done[owner]
        owner, seeds, swaps = owner[on], seeds[on], swaps[on]
    return ranks


def _sign(shingle: int):
    """Each text's id, set name and size; for one text of each set in some megabytes also the names of its bands."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(shingle)
        for whole in text_slices(batches, "text"):
            for at in range(0, whole.num_rows, 8000):
                batch = whole.slice(at, 8000)
                sets.read(batch)
                chosen = sets.first_of_each()
                place = np.full(batch.num_rows, -1)
                place[chosen] = np.arange(len(chosen))
                own = place[sets.text] >= 0
                ranks = signatures(place[sets.text[own]], sets.hashes[own], len(chosen)).reshape(len(chosen), BANDS, ROWS)
                names = np.zeros((len(chosen), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for k in range(ROWS):
                    names = mix(names * np.uint64(0xD1342543DE82EF95) + ranks[:, :, k])
                bands = ragged(names.reshape(-1).view(np.int64), np.where(place >= 0, BANDS, 0), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sets.names.view(np.int64), mask=sets.sizes == 0), pa.array(sets.sizes, pa.int64()), bands], names=["doc_id", "id", "n", "bands"]
                )

    return run


def _send_sets(shingle: int, sent):
    """The sets whose names the filter lets through, once in each slice of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(shingle)
        for batch in text_slices(batches, "text"):
            sets.read(batch)
            first = sets.first_of_each()
            first = first[passes(sent.value, sets.names[first])]
            own = np.zeros(batch.num_rows, bool)
            own[first] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.names[first].view(np.int64)), pa.array(sets.sizes[first], pa.int64()), ragged(sets.hashes[own[sets.text]].view(np.int64), sets.sizes[first], pa.int64())],
                names=["id", "n", "hashes"],
            )

    return run


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of `docs`.

    A row's set are the distinct runs of `shingle` words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; with
    fewer words, the whole sequence is one; without words (or text) the set is empty and linked with
    nothing. Rows are linked when 100 * intersection >= percent * union. component_id is the smallest
    id reachable by links; kept says that the row has it. Null ids are never the smallest; a row of a
    component of null ids alone has none and is kept if it is empty, not otherwise. Repeated rows share a
    component and are kept alike. Other columns are ignored; an empty table gives no rows. Shingles and
    sets are compared by 64-bit hashes; proposals by bands are meant for 80 percent or more.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = stored(texts.mapInArrow(_sign(shingle), "doc_id long, id long, n long, bands array<long>"), "signed-rows")
    banded = signed.where(F.size("bands") > 0).select("id", F.explode("bands").alias("grp")).distinct()
    several = banded.groupBy("grp").agg(F.count("*").alias("sets")).where("sets > 1").select("grp")
    groups = stored(banded.join(several, "grp", "left_semi"), "bands")
    star = groups.join(hubs(groups), "grp").where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    star = stored(star, "star-pairs")
    wanted = groups.select("id").distinct()
    sent = docs.sparkSession.sparkContext.broadcast(sieve_of(wanted, F.col("id")))
    sets = texts.select("text").mapInArrow(_send_sets(shingle, sent), "id long, n long, hashes array<long>")
    sets = stored(sets.join(wanted, "id", "left_semi").groupBy("id").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")), "sets")
    found = close_groups(groups, sets, _linked(star, sets, percent), percent)

    rows = signed.select("doc_id", "id", "n").where("id IS NOT NULL").join(found, "id", "left").select("doc_id", "n", F.coalesce("component", "id").alias("component"))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = rows.join(least, "component").select("doc_id", "n", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    alone = signed.where("id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")
