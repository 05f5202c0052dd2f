"""Phrase collocations by SON partitioning: local mining at lowered support, then exact counts of what is left.

The shards are a fixed number of groups of files, each with a share b of all bytes. A phrase found
`support` times in all is found at least t = ceil(support * b) times in some shard, as the shares sum to
one. As the number of shards does not grow with the table, t stays well above 1 at every size; instead a
shard is mined by many tasks. Mining goes level by level: a phrase of k words is looked at only where its
parts of fewer words are still possible. Tasks report names (64-bit hashes) and counts of a few megabytes
of text; Spark adds them up by shard.

The union of the locally frequent phrases is counted over all shards by the same aggregation, which keeps
a sum for each shard; those below `support` in all can go at once, so the next level has few parts to look
at. The others' names form a filter of bounded size. The aggregation also keeps one text of each phrase, by
the text's hash; a last pass reads the words of a phrase there and nowhere else. If every slice told the
words of all its frequent phrases, these rows would grow with the slices times the frequent phrases, as the
support stays the same while both grow.

Counts are sums of counts of slices, so a frequent phrase or a language with most rows is one row of each
slice. Texts longer than a slice are cut where pieces end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estate.llm.arrays import LOWER, WordHash, find_words, mix, text_bytes, text_slices
from estate.llm.sieve import passes, sieve_of
from estate.llm.storage import stored

SLICE_BYTES = 2 << 20
#: Levels that are mined in one pass over the texts.
PASSES = ((1, 2), (3,), (4, 5))
LONGEST = 5
#: Most bits of the filter of names and texts (32 MB); every place of a frequent phrase asks it.
CHOSEN_BITS = 1 << 28
#: Bytes that end a piece: [.,;:!?\x0A-\x0D]; words of a piece lie between spaces and tabs.
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[ord(c) for c in ".,;:!?"]] = ENDS_PIECE[10:14] = True
IN_WORD = ~ENDS_PIECE
IN_WORD[[9, 32]] = False


Texts = tuple[int, str, np.ndarray, np.ndarray, np.ndarray]


def slices(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[Texts]:
    """By shard and language, lower-cased bytes of texts, some megabytes at once, where each text starts, and its hash.

    A text beyond that size is cut behind the last end of a piece; without any it stays whole.
    """
    held, size = [], 0
    for part in text_slices(batches, "text", most=min(most, 2 << 20)):
        own = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
        if own > most:
            yield from _cut(part, most)
            continue
        if held and size + own > most:
            yield from _by_language(held)
            held, size = [], 0
        held.append(part)
        size += own
    if held:
        yield from _by_language(held)


def _by_language(parts: list[pa.RecordBatch]) -> Iterator[Texts]:
    table = pa.Table.from_batches(parts)
    for group in table.group_by(["shard", "lang"]).aggregate([]).to_pylist():
        own = pc.and_(pc.equal(table.column("shard"), group["shard"]), pc.equal(table.column("lang"), group["lang"]))
        rows = table.filter(own)
        data, offsets = text_bytes(rows.column("text").combine_chunks())
        yield group["shard"], group["lang"], LOWER[data], offsets, np.asarray(rows.column("source"))


def _cut(part: pa.RecordBatch, most: int) -> Iterator[Texts]:
    for shard, lang, data, offsets, sources in _by_language([part]):
        ends = np.union1d(np.flatnonzero(ENDS_PIECE[data]) + 1, offsets[1:])
        at = 0
        while at < len(data):
            k = np.searchsorted(ends, at + most, "right") - 1
            to = int(ends[k]) if k >= 0 and ends[k] > at else int(ends[np.searchsorted(ends, at, "right")])
            inner = offsets[(offsets > at) & (offsets < to)]
            of = np.searchsorted(offsets, np.concatenate([[at], inner]), "right") - 1
            yield shard, lang, data[at:to], np.concatenate([[at], inner, [to]]) - at, sources[of]
            at = to


class Runs:
    """The words of texts of one language, and their phrases level by level."""

    def __init__(self, lang: str, data: np.ndarray, offsets: np.ndarray, sources: np.ndarray, hashes: WordHash):
        self.data = data
        self.starts, self.ends, counts = find_words(data, offsets, IN_WORD)
        self.words = hashes(data, self.starts, self.ends)
        self.sources = np.repeat(sources.astype(np.int32), np.diff(counts))
        piece = np.searchsorted(np.flatnonzero(ENDS_PIECE[data]), self.starts)
        self.joined = piece[1:] == piece[:-1]
        firsts = counts[1:-1]
        self.joined[firsts[(firsts > 0) & (firsts < len(self.words))] - 1] = False
        self.seed = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))

    def levels(self, kept) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(k, names, counts, a place of each, all places, the number of the name at each) of the phrases of k words that `kept(k, names)` lets through.

        Phrases of k words are formed from places where both parts of k - 1 words were let through.
        """
        at, value = np.arange(len(self.words)), self.words
        for k in range(1, LONGEST + 1):
            if not len(at):
                return
            names, first, which, counts = np.unique(mix(value ^ mix(self.seed + np.full(1, k, np.uint64))), return_index=True, return_inverse=True, return_counts=True)
            good = kept(k, names)
            through = good[which]
            number = (np.cumsum(good) - 1)[which[through]]
            yield k, names[good], counts[good], at[first[good]], at[through], number
            at, value = at[through], value[through]
            # The next word belongs to the piece, and the phrase that starts one word later was let through.
            on = np.flatnonzero(at[1:] == at[:-1] + 1)
            on = on[self.joined[at[on] + k - 1]] if len(on) else on
            value = mix(value[on] * np.uint64(0x9E3779B97F4A7C15) + self.words[at[on] + k] + np.uint64(k))
            at = at[on]

    def wide(self, k: int, at: np.ndarray) -> np.ndarray:
        """31 more bits of the names of phrases of k words, so that two texts hardly share one."""
        value = np.zeros(len(at), np.uint64)
        for i in range(k):
            value = mix((value ^ self.words[at + i]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(i + 1))
        return (value >> np.uint64(33)).astype(np.int32)

    def told(self, chosen: np.ndarray, names: np.ndarray, at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and a place of the names that are to be told in one of these texts."""
        own = self.sources[at].view(np.uint32).astype(np.uint64)
        here = np.flatnonzero(passes(chosen, names[number] ^ (own | own << np.uint64(32))))
        which, first = np.unique(number[here], return_index=True)
        return which, at[here[first]]

    def texts(self, k: int, at: np.ndarray) -> pa.Array:
        """The words of phrases of k words, with one space between them."""
        place = (at[:, None] + np.arange(k)).ravel()
        sizes = self.ends[place] - self.starts[place]
        to = np.cumsum(sizes + 1) - (sizes + 1) - np.repeat(np.arange(len(at)), k)
        ends = np.concatenate([[0], np.cumsum((sizes + 1).reshape(-1, k).sum(1) - 1)]) if len(at) else np.zeros(1, np.int64)
        out = np.full(int(ends[-1]), 32, np.uint8)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(to, sizes) + within] = self.data[np.repeat(self.starts[place], sizes) + within]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


MINED = "shard int, k int, name long, wide int, source int, n long"
TOLD = "lang string, k int, name long, wide int, phrase string, n long"


def _mine(levels: tuple[int, ...], sent, most: int):
    """The phrases of these levels in a slice, where the filter lets their shorter parts through, each with the hash of one of its texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash(41)
        kept = lambda k, names: np.ones(len(names), bool) if k >= levels[0] else passes(sent.value, names)
        for shard, lang, data, offsets, sources in slices(batches, most):
            runs = Runs(lang, data, offsets, sources, hashes)
            for k, names, counts, at, _, _ in runs.levels(kept):
                if k > levels[-1]:
                    break
                if k >= levels[0]:
                    whole = lambda x, n=len(names): pa.array(np.full(n, x), pa.int32())
                    columns = [whole(shard), whole(k), pa.array(names.view(np.int64)), pa.array(runs.wide(k, at)), pa.array(runs.sources[at]), pa.array(counts, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "k", "name", "wide", "source", "n"])

    return run


def _tell(sent, chosen, most: int):
    """The words of the phrases that are chosen in a text of the slice, and the number of all words of each language (k = 0)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash(41)
        for _, lang, data, offsets, sources in slices(batches, most):
            runs = Runs(lang, data, offsets, sources, hashes)
            found = [(0, np.zeros(1, np.uint64), np.zeros(1, np.int32), pa.array([""]), [len(runs.words)])]
            for k, names, _, _, at, number in runs.levels(lambda _, names: passes(sent.value, names)):
                which, at = runs.told(chosen.value, names, at, number)
                found.append((k, names[which], runs.wide(k, at), runs.texts(k, at), [None] * len(at)))
            for k, names, wide, phrase, counts in found:
                n = len(phrase)
                columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, k), pa.int32()), pa.array(names.view(np.int64)), pa.array(wide), phrase, pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "k", "name", "wide", "phrase", "n"])

    return run


def phrase_counts(
    docs: DataFrame, support: int = 100, *, lang_col: str = "lang", text_col: str = "text", shard: Column | None = None, shards: int = 4, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to 5 words found `support` times in a language; with k = 0, the number of its words.

    A row's shard is that of its file, or `shard` (a whole number from 0); rows that come from no file are one shard.
    """
    shard = F.pmod(F.xxhash64(F.input_file_name()), F.lit(shards)) if shard is None else shard
    texts = docs.select(shard.cast("int").alias("shard"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("source", F.hash("text"))
    sizes = {r.shard: r.n for r in texts.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    total = sum(sizes.values())
    local = {i: max(1, -(-support * n // max(1, total))) for i, n in sizes.items()}
    spark, frequent, sent = docs.sparkSession, None, None
    for levels in PASSES:
        mined = texts.mapInArrow(_mine(levels, sent, slice_bytes), MINED)
        own = {i: F.coalesce(F.sum(F.when(F.col("shard") == i, F.col("n"))), F.lit(0)) for i in local}
        mined = mined.groupBy("name", "wide").agg(F.sum("n").alias("n"), F.min("source").alias("source"), F.array(*[own[i] >= t for i, t in local.items()]).alias("mined"))
        candidates = mined.where(F.exists("mined", lambda x: x) & (F.col("n") >= support))
        found = stored(candidates.select("name", "wide", "n", "source"), "frequent-phrases")
        frequent = found if frequent is None else frequent.unionByName(found)
        sent = spark.sparkContext.broadcast(sieve_of(frequent, F.col("name")))
    # As in `told`: the hash of the text over both halves of the name.
    own = F.col("source").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    key = F.col("name").bitwiseXOR(own).bitwiseXOR(F.shiftleft(own, 32))
    chosen = spark.sparkContext.broadcast(sieve_of(frequent, key, CHOSEN_BITS, 64))
    told = texts.mapInArrow(_tell(sent, chosen, slice_bytes), TOLD).groupBy("lang", "k", "name", "wide", "phrase").agg(F.sum("n").alias("words"))
    told = stored(told, "phrase-words")
    counts = told.where("k > 0").join(frequent.select("name", "wide", "n"), ["name", "wide"]).select("lang", "k", "phrase", "n")
    return stored(counts.unionByName(told.where("k = 0").select("lang", "k", "phrase", F.col("words").alias("n"))), "phrase-counts")


def collocations(
    docs: DataFrame, support: int = 100, first: int = 2000, *, cover: int = 100, lang_col: str = "lang", text_col: str = "text", **mining
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases of 2 to 5 words by score.

    Texts are lower-cased (A-Z), split at [.,;:!?\\x0A-\\x0D] into pieces and these into words [^\\x20\\x09]+.
    n counts a language's words, a, l and r the occurrences of a phrase and of its two parts inside pieces,
    overlaps included. Candidates have a >= support. Of a candidate's cuts the one with the lowest score
    floor(1000 * a * n / (l * r)) counts, ties to the shortest first part. A candidate inside a longer one
    with 100 * f(longer) >= cover * a is dropped. Ties of score go to the larger a, then to the phrase in
    the order of UTF-8 bytes. All arithmetic is exact (decimals of 38 digits).

    A null language is `und`, a null or empty text has no words; repeated rows count each on their own; an
    empty table gives no rows; other columns are ignored. `mining` are further options of `phrase_counts`.
    Phrases within a slice are told apart by hashes of 64 bits, those of different slices by 95 bits.
    """
    found = phrase_counts(docs, support, lang_col=lang_col, text_col=text_col, **mining)
    known = found.where("k > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    candidates = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), words.alias("words"))
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k")).alias("tail"))
    of = lambda key, n: known.select("lang", F.col("phrase").alias(key), F.col("n").alias(n))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    cuts = cuts.join(found.where("k = 0").select("lang", F.col("n").alias("words_n")), "lang")
    score = F.expr("(CAST(a AS DECIMAL(18, 0)) * CAST(words_n AS DECIMAL(19, 0)) * 1000BD) DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(19, 0)))")
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "a", "l", "r", "words_n")).alias("b")).select("lang", "phrase", "b.*")

    size, start = F.col("size"), F.col("start")
    inner = candidates.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))).withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - size + 1)))
    inner = inner.groupBy("lang", part(start, size).alias("phrase")).agg(F.max("a").alias("longer"))
    covered = best.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    ranked = covered.withColumn("rank", rank).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("words_n").alias("n"), "score")
