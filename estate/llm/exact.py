"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of characters. The distinct blocks are sorted and
numbered; then neighbouring numbers form pairs, the distinct pairs are sorted and numbered, and so
on until one number is left of each text. Two texts end with the same number at the same level if
and only if they are equal: numbers stand for content, not for a hash of it.

A hash only routes a block to its number. Before it is used, all distinct blocks are counted by it; if
two share one, another hash is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.storage import fresh_name, numbered, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are; a pure ASCII text takes the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _blocks(text: Column, size: int) -> Column:
    """Consecutive pieces of `size` characters; an empty text is one empty piece."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.char_length(text) <= size, F.array(text)).otherwise(pieces)


def _numbered(distinct: DataFrame, order: list[str], keep: list[str], label: str) -> DataFrame:
    """Sort the distinct rows within their partitions and number them; stored, so numbers are final."""
    rows = distinct.sortWithinPartitions(*order).select(*keep, F.monotonically_increasing_id().alias("name"))
    return stored(rows, label)


def _route(block: Column, seed: int, bits: int) -> Column:
    route = F.xxhash64(F.lit(seed), block)
    return F.shiftrightunsigned(route, 64 - bits) if bits < 64 else route


def _rows_and_names(rows: DataFrame, block: int, hash_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) -> (rid, doc_id, text_sha256, routes) and (h, name), once no two blocks share a route."""
    seed = 0
    while True:
        blocks = rows.select(F.explode(_blocks(F.col("text"), block)).alias("block"))
        routed = blocks.select(_route(F.col("block"), seed, hash_bits).alias("h"), "block")
        # The text goes through one exchange, each distinct block of a task once.
        names = _numbered(routed.distinct(), ["block"], ["h"], "block-names")
        if names.groupBy("h").count().where("count > 1").isEmpty():
            routes = F.transform(_blocks(F.col("text"), block), lambda b: _route(b, seed, hash_bits))
            rid = F.col("rid") if "rid" in rows.columns else F.monotonically_increasing_id()
            base = rows.select(rid.alias("rid"), "doc_id", F.sha2("text", 256).alias("text_sha256"), routes.alias("routes"))
            return stored(base, "exact-rows"), names
        seed, hash_bits = seed + 1, 64


def _identities(base: DataFrame, names: DataFrame) -> DataFrame:
    """(rid, level, name), equal level and name exactly where texts are equal.

    One round halves the rows, so there are as many rounds as the longest text has doublings of a
    block, and all rounds together are a small multiple of the first.
    """
    routes = base.select("rid", F.size("routes").cast("long").alias("n"), F.posexplode("routes").alias("pos", "h"))
    rows = stored(routes.join(names, "h").select("rid", "n", F.col("pos").cast("long").alias("pos"), "name"), "blocks-0")
    level, done = 0, None
    while True:
        ended = rows.where("n = 1").select("rid", F.lit(level).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        rows = rows.where("n > 1")
        if rows.isEmpty():
            return done
        level += 1
        pair = rows.groupBy("rid", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"),
            F.max(F.ceil(F.col("n") / 2).cast("long")).alias("n"),
        )
        pairs = stored(pair, f"pairs-{level}")
        names = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"], f"pair-names-{level}")
        same = (pairs.a == names.a) & pairs.b.eqNullSafe(names.b)
        rows = stored(pairs.join(names, same).select("rid", "pos", "n", names.name), f"blocks-{level}")


def _verdicts(rows: DataFrame, block: int, hash_bits: int) -> DataFrame:
    """(doc_id, text) -> rid, doc_id, keep_id, group_size, kept, text_sha256; texts are lower-cased."""
    base, names = _rows_and_names(rows, block, hash_bits)
    rows = base.drop("routes").join(stored(_identities(base, names), "exact-identities"), "rid")
    best = F.max(F.struct("doc_id", "rid")).alias("best")
    groups = rows.groupBy("level", "name").agg(best, F.count("*").alias("group_size"))
    return rows.join(groups, ["level", "name"]).select(
        "rid",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        "text_sha256",
    )


def _own_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 4096, hash_bits: int = 64) -> DataFrame:
    """One row per input row: its id, keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. The row with
    the largest id of a group stays; a null id is smaller than any other, and of rows that repeat an
    id one stays. An empty table gives no rows. Other columns of `docs` are ignored, whatever their
    names. `hash_bits` below 64 is for tests of clashing routes.
    """
    return _verdicts(_own_rows(docs, id_col, text_col), block, hash_bits).drop("rid").withColumnRenamed("doc_id", id_col)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 4096) -> DataFrame:
    """The rows of `docs` that `exact_duplicates` keeps, with all their columns."""
    rid = fresh_name(docs.columns, "rid")
    docs = numbered(docs, rid)
    rows = docs.select(F.col(rid).alias("rid"), F.col(id_col).alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    gone = _verdicts(rows, block, 64).where("NOT kept").select(F.col("rid").alias(rid))
    return docs.join(gone, rid, "left_anti").drop(rid)
