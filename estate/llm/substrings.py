"""Long word sequences that repeat across documents, by recompression.

The words of a text are renamed in rounds. One round names runs of equal symbols, the others name
pairs: a symbol is left or right by a bit of its name, and a left one followed by a right one becomes
one symbol. A new symbol's name is a hash of what it replaces, so equal inputs get equal names in all
documents and tasks. Whether symbols merge depends on them and their lengths alone; so where a
sequence of words repeats, all symbols are the same but for those near its ends. In each round an end
loses one symbol at most, and lengths are limited per round, so 22 words at each end are always
enough: the symbols over the middle 6 of a repeated window of 50 words are shared by both documents.

Rows whose whole text a row with a smaller id has are copies: all their windows repeat, so they need
no comparison. Of all other rows Spark finds which symbols occur in more than one of them. Only windows whose middle is covered by
shared symbols are compared, by 96 bits of hash, with those of all other documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import SPACED, WindowHash, WordHash, find_words, mix, ragged, text_bytes, text_slices, window_starts
from estate.llm.packed import OWNED, bucket_of, flat, gather_of_owners, groups_of, of_each, pack, send_to_owners, text_buckets
from estate.llm.storage import PLACE_BITS, numbered, stored
from estate.session import scratch_path

#: Runs of at most so many equal words get a name; an end of a window loses as many words at most.
LONGEST_RUN = 3
#: The greatest length in words of a symbol after each round of pairs. A round loses, at each end, one
#: symbol of the round before.
PAIR_ROUNDS = (4, 4, 8, 8)
LOST = LONGEST_RUN + sum((LONGEST_RUN, *PAIR_ROUNDS[:-1]))


def symbols_of(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the symbols that cover the words, and the first word of each; none covers two texts."""
    names, first = words.copy(), np.arange(len(words))
    if not len(words):
        return names, first
    begins = np.zeros(len(words) + 1, bool)
    begins[counts[:-1]] = True
    # Runs.
    new = begins[:-1].copy()
    new[1:] |= words[1:] != words[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(words)))
    short = (sizes > 1) & (sizes <= LONGEST_RUN)
    keep = np.ones(len(words), bool)
    within = np.arange(len(words)) - np.repeat(heads, sizes)
    keep[np.repeat(short, sizes) & (within > 0)] = False
    run = heads[short]
    names[run] = mix(names[run] + sizes[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    names, first = names[keep], first[keep]
    for number, most in enumerate(PAIR_ROUNDS):
        length = np.diff(np.append(first, len(words)))
        right = (mix(names ^ np.uint64(number + 1)) >> np.uint64(63)).astype(bool)
        merge = ~right[:-1] & right[1:] & (length[:-1] + length[1:] <= most) & ~begins[first[1:]]
        left = np.flatnonzero(merge)
        names[left] = mix(names[left] * np.uint64(0x9E3779B97F4A7C15) + mix(names[left + 1] + np.uint64(number)))
        keep = np.ones(len(names), bool)
        keep[left + 1] = False
        names, first = names[keep], first[keep]
    return names, first


class _Texts:
    """Words and symbols of a slice of texts."""

    def __init__(self):
        self.hashers = WordHash(11), WordHash(12)

    def read(self, batch: pa.RecordBatch, both: bool = False) -> None:
        data, offsets = text_bytes(batch.column("text"))
        starts, ends, self.counts = find_words(data, offsets, SPACED)
        self.words = self.hashers[0](data, starts, ends)
        self.second = self.hashers[1](data, starts, ends) if both else None


def _near_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut where row numbers are too far apart for 32-bit offsets, as those of two files are."""
    for batch in batches:
        high = np.asarray(batch.column("rid")) >> PLACE_BITS
        cuts = [0, *(np.flatnonzero(np.diff(high)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def _send_symbols(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts()
        for batch in text_slices(_near_rows(batches), "text"):
            texts.read(batch)
            names, first = symbols_of(texts.words, texts.counts)
            if not len(names):
                continue
            rid = np.asarray(batch.column("rid"))
            row = np.searchsorted(texts.counts, first, "right") - 1
            order, heads = groups_of(names, row)
            names, row = names[order[heads]], row[order[heads]]  # each once per row, in order of names
            head = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            size = np.diff(np.append(head, len(names)))
            # A symbol of several rows of this slice is shared for certain: one record asks for the
            # others' sake, and its rows are told without a question.
            certain = np.repeat(size > 1, size)
            base = int(rid[0])
            ask = head
            offset = np.where(size > 1, -1, (rid[row[ask]] - base)).astype(np.int64)
            told_row = rid[row[certain]]
            part = np.concatenate([bucket_of(names[ask], buckets), bucket_of(mix(told_row.astype(np.uint64)), buckets)])
            low = lambda x: (x & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            columns = {
                "symbol": (np.concatenate([low(names[ask]), low(names[certain])]), pa.int32()),
                "offset": (np.concatenate([offset, told_row - base]).astype(np.int32), pa.int32()),
                "told": (np.concatenate([np.zeros(len(ask), np.int8), np.ones(len(told_row), np.int8)]), pa.int8()),
            }
            yield pack(part, columns, {"base": (base, pa.int64())})

    return run


def _find_shared(table: pa.Table, buckets: int) -> pa.Table:
    symbol, offset, told = flat(table, "symbol"), flat(table, "offset"), flat(table, "told").astype(bool)
    rid = of_each(table, "base", "symbol") + offset
    asked = np.flatnonzero(~told)
    order, heads = groups_of(symbol[asked])
    size = np.diff(np.append(heads, len(order)))
    # One record alone is shared only if it stands for several rows, and these know already.
    shared = asked[order[np.repeat(size > 1, size)]]
    shared = shared[offset[shared] >= 0]
    all_ = np.concatenate([shared, np.flatnonzero(told)])
    return send_to_owners(rid[all_], symbol[all_], buckets)


def _kept(text: bytes, gone: np.ndarray | None, digest: bool) -> str:
    words = text.split()
    if gone is not None:
        words = [w for w, out in zip(words, gone.tolist(), strict=True) if not out]
    kept = b" ".join(words)
    return hashlib.sha256(kept).hexdigest() if digest else kept.decode()


def _choose(window: int, digest: bool):
    """Rows without candidate windows are finished; of the others, the text and the windows' starts go on."""
    middle = LOST, window - LOST

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts()
        for batch in text_slices(batches, "text"):
            texts.read(batch)
            names, first = symbols_of(texts.words, texts.counts)
            low = (names & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            row = np.searchsorted(texts.counts, first, "right") - 1
            column = batch.column("shared")
            sizes = np.diff(np.asarray(column.offsets)) if not column.null_count else np.array([len(x) if x.is_valid else 0 for x in column])
            owner, lists = np.repeat(np.arange(batch.num_rows), sizes), np.asarray(column.flatten())
            key = lambda r, s: r.astype(np.int64) << 32 | s.view(np.uint32).astype(np.int64)
            shared = np.isin(key(row, low), key(owner, lists.astype(np.int32)))
            copy = np.asarray(batch.column("copy"))
            gone = np.where(copy & (np.diff(texts.counts) >= window), np.diff(texts.counts), 0)
            covered = np.zeros(len(texts.words) + 1, np.int64)
            np.cumsum(np.repeat(shared, np.diff(np.append(first, len(texts.words)))), out=covered[1:])
            starts, text = window_starts(texts.counts, window)
            wanted = (covered[starts + middle[1]] - covered[starts + middle[0]] == middle[1] - middle[0]) & ~copy[text]
            starts, text = starts[wanted], text[wanted]
            n = np.bincount(text, minlength=batch.num_rows)
            # Neighbouring starts are held as the first and the one after the last.
            edge = np.ones(len(starts) + 1, bool)
            edge[1:-1] = (np.diff(starts) > 1) | (np.diff(text) > 0)
            cut = np.flatnonzero(edge)
            cuts, owners = cut[:-1], text[cut[:-1]]
            run_from, run_to = starts[cuts] - texts.counts[owners], starts[cut[1:] - 1] + 1 - texts.counts[owners]
            runs = np.bincount(owners, minlength=batch.num_rows)
            whole = batch.column("text").cast(pa.binary())
            kept = [None if n[i] else _kept(b"" if gone[i] else whole[i].as_py(), None, digest) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"), batch.column("doc_id"), pa.array(np.diff(texts.counts), pa.int64()), pa.array(gone, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.string()),
                    pa.array([whole[i].as_py().decode() if n[i] else None for i in range(batch.num_rows)], pa.string()), ragged(run_from, runs, pa.int32()), ragged(run_to, runs, pa.int32()),
                ],
                names=["rid", "doc_id", "n_words", "n_removed", "n_candidates", "kept", "text", "run_from", "run_to"],
            )

    return run


def _send_windows(window: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, hashes = _Texts(), (WindowHash(window, 21), WindowHash(window, 22))
        for batch in text_slices(batches, "text"):
            texts.read(batch, both=True)
            low, high = (np.asarray(batch.column(c).flatten()).astype(np.int64) for c in ("run_from", "run_to"))
            size = np.diff(np.asarray(batch.column("run_from").offsets))
            run = np.repeat(np.arange(len(low)), high - low)
            start = low[run] + np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            row = np.repeat(np.arange(batch.num_rows), size)[run]
            at = texts.counts[row] + start
            one, two = hashes[0](texts.words)[at], hashes[1](texts.second)[at]
            doc = np.asarray(batch.column("doc_id"))[row]
            rid = np.asarray(batch.column("rid"))[row]
            order, heads = groups_of(one, two, doc)
            one, two, doc, rid, start = one[order], two[order], doc[order], rid[order], start[order]
            new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
            group = np.cumsum(new) - 1
            least = doc[np.flatnonzero(new)][group]
            # Of a window's documents in this slice the smallest has to ask; the others have their answer.
            told = doc > least
            part = np.where(told, bucket_of(mix(rid.astype(np.uint64)), buckets), bucket_of(one, buckets))
            by = np.lexsort((start, rid))
            yield pack(
                part[by],
                {
                    "one": (np.where(told, np.uint64(0), one).view(np.int64)[by], pa.int64()), "two": (np.where(told, np.uint64(0), two & np.uint64(0x7FFFFFFF)).astype(np.int32)[by], pa.int32()),
                    "doc": (np.where(told, 0, doc)[by], pa.int64()), "rid": (rid[by], pa.int64()), "start": (start[by], pa.int32()), "told": (told[by].astype(np.int8), pa.int8()),
                },
            )

    return run


def _find_repeats(table: pa.Table, buckets: int) -> pa.Table:
    one, two, doc, rid, start, told = (flat(table, c) for c in ("one", "two", "doc", "rid", "start", "told"))
    told = told.astype(bool)
    asked = np.flatnonzero(~told)
    order, heads = groups_of(one[asked], two[asked])
    order = asked[order]
    if len(order):
        least = np.repeat(np.minimum.reduceat(doc[order], heads), np.diff(np.append(heads, len(order))))
        repeats = np.concatenate([order[doc[order] > least], np.flatnonzero(told)])
    else:
        repeats = np.flatnonzero(told)
    return send_to_owners(rid[repeats], start[repeats], buckets)


def _remove(window: int, digest: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            removed, kept = [], []
            lists = batch.column("repeats")
            for i, (n, text) in enumerate(zip(batch.column("n_words").to_pylist(), batch.column("text").cast(pa.binary()), strict=True)):
                change = np.zeros(n + 1, np.int64)
                if lists[i].is_valid:
                    starts = np.asarray(lists[i].values)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                kept.append(_kept(text.as_py(), gone, digest))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["rid", "doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def _bucketed(frame: DataFrame, key: str) -> DataFrame:
    """A stored frame whose files are bucketed by a key, so that a later join on it moves the other side alone.

    The frame comes from a join on the key, so each of its tasks writes few buckets. The table has a name
    of its own in the session's catalog and its files in the shared folder.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, window: int = 50, digest: bool = False, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 16 << 20) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row of `docs`.

    Words are those of `[^\\x20\\x09-\\x0D]+`. A word is removed when a window of `window` words covers it
    whose sequence also starts in a row with a smaller id; windows are judged on the input. `kept` are
    the other words, joined by one space, or with `digest` their SHA-256. A null text has no words. Rows
    with a null id keep all words and take none from others; rows that repeat an id take none from each
    other. Other columns are ignored. An empty table gives no rows. `docs` is read more than once, and its
    rows keep their numbers however files are split; what is not read from files is stored first. `window` is 46 at least, so that its middle has 2 words.
    """
    if window < 2 * LOST + 2:
        raise ValueError(f"window has to be at least {2 * LOST + 2} words")
    docs = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "rid")
    rows = docs.select("rid", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Copies are found by a 128-bit hash of the text; the narrow table is grouped, not the texts.
    texts = rows.where("doc_id IS NOT NULL").select("rid", "doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    texts = stored(texts, "substring-texts")
    least = texts.groupBy("t1", "t2").agg(F.min("doc_id").alias("least"))
    copies = stored(texts.join(least, ["t1", "t2"]).where("doc_id > least").select("rid"), "substring-copies")
    named = rows.where("doc_id IS NOT NULL")
    buckets = text_buckets(docs, "text", bucket_bytes)
    sent = named.select("rid", "text").mapInArrow(_send_symbols(buckets), "bucket int, base long, symbol array<int>, offset array<int>, told array<tinyint>")
    shared = gather_of_owners(sent.groupBy("bucket").applyInArrow(lambda t: _find_shared(t, buckets), OWNED), ("rid", "shared"))
    none = F.array().cast("array<int>")
    known = shared.withColumn("copy", F.lit(False)).unionByName(copies.select("rid", none.alias("shared"), F.lit(True).alias("copy")))
    known = known.groupBy("rid").agg(F.flatten(F.collect_list("shared")).alias("shared"), F.bool_or("copy").alias("copy"))
    joined = rows.join(known, "rid", "left").withColumns({"shared": F.coalesce("shared", none), "copy": F.coalesce("copy", F.lit(False))})
    chosen = joined.select("rid", "doc_id", "text", "shared", "copy").mapInArrow(
        _choose(window, digest),
        "rid long, doc_id long, n_words long, n_removed long, n_candidates long, kept string, text string, run_from array<int>, run_to array<int>",
    )
    chosen = _bucketed(chosen, "rid")
    open_rows = chosen.where("n_candidates > 0")
    candidates = int(open_rows.agg(F.sum("n_candidates").alias("n")).first().n or 0)
    parts = max(1, candidates // 500_000)
    windows = open_rows.select("rid", "doc_id", "text", "run_from", "run_to").mapInArrow(
        _send_windows(window, parts), "bucket int, one array<long>, two array<int>, doc array<long>, rid array<long>, start array<int>, told array<tinyint>"
    )
    repeats = gather_of_owners(windows.groupBy("bucket").applyInArrow(lambda t: _find_repeats(t, parts), OWNED), ("rid", "repeats"))
    last = open_rows.join(repeats, "rid", "left").select("rid", "doc_id", "n_words", "text", "repeats")
    mended = last.mapInArrow(_remove(window, digest), "rid long, doc_id long, n_words long, n_removed long, kept string")
    done = chosen.where("n_candidates = 0").select("rid", "doc_id", "n_words", "n_removed", "kept")
    return done.unionByName(mended).drop("rid").withColumnRenamed("doc_id", id_col)
