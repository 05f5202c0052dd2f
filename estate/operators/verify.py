"""Evidence that a copy is complete and lies on the new account.

Flags have three values: true, false, and null for "does not apply".
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from estate.functions.urls import is_on_account, storage_account
from estate.operators.closure import stored
from estate.operators.files import hash_verdicts
from estate.operators.state import current_log
from estate.session import shared_folder
from estate.settings import KEY

# The columns of the stored results.
LAYERS = [
    "metadata_location_ok",
    "delta_log_at_new_ok",
    "input_file_name_ok",
    "parent_managed_location_match",
    "content_checksum_ok",
    "volume_content_checksum_ok",
]
GOVERNANCE_FLAGS = ["grants_ok", "owner_ok", "tags_ok", "row_filter_ok", "column_mask_ok", "comments_ok"]


def _flagged(column: Column, kind: T.DataType) -> list[Column]:
    """What a value adds to a hash: itself in hashable form, and whether it is null, as xxhash64 skips nulls at every depth."""
    return [_hashable(column, kind), column.isNull()]


def _hashable(column: Column, kind: T.DataType) -> Column:
    """A value xxhash64 accepts, equal for equal values only.

    Fields and elements carry their null flags and arrays their length, so a nested null that moves or goes
    is seen; maps at any depth become entries in order, variants text.
    """
    if isinstance(kind, T.VariantType):
        return F.to_json(column)
    if isinstance(kind, T.StructType):
        parts = [part for f in kind.fields for part in _flagged(column[f.name], f.dataType)]
        return F.when(column.isNotNull(), F.struct(F.lit(len(kind.fields)).alias("size"), *[p.alias(f"p{i}") for i, p in enumerate(parts)]))
    if isinstance(kind, T.ArrayType):
        element = lambda e: F.struct(*[p.alias(f"p{i}") for i, p in enumerate(_flagged(e, kind.elementType))])
        return F.when(column.isNotNull(), F.struct(F.size(column).alias("size"), F.transform(column, element).alias("elements")))
    if isinstance(kind, T.MapType):
        # Entries as JSON text can be sorted whatever their values are.
        entry = lambda e: F.struct(_hashable(e["key"], kind.keyType).alias("key"), _hashable(e["value"], kind.valueType).alias("value"))
        entries = F.array_sort(F.transform(F.map_entries(column), lambda e: F.to_json(entry(e), {"ignoreNullFields": "false"})))
        return F.when(column.isNotNull(), F.struct(F.size(column).alias("size"), entries.alias("entries")))
    return column


def row_hash(table: DataFrame, *, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash over every column and whether it is null, so a null that moves is seen, nested ones too."""
    fields = [f for f in table.schema.fields if columns is None or f.name in columns]
    parts: list[Column] = []
    for field in fields:
        cell = F.col("`" + field.name.replace("`", "``") + "`")
        parts += _flagged(cell, field.dataType)
    return F.xxhash64(*parts)


def fingerprint(table: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Row count, xor and sum of the row hashes: the order of rows does not matter, their number does.

    One pass; each task merges its rows into one buffer (per ``by`` group) before the shuffle.
    """
    columns = [c for c in table.columns if c not in by]
    hashed = table.select(*by, row_hash(table, columns=columns).alias("_h"))
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor("_h"), F.lit(0)).alias("xor64"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("sum64"),
    ]
    return hashed.groupBy(*by).agg(*sums) if by else hashed.agg(*sums)


def fingerprint_tables(tables: Sequence[tuple[str, DataFrame]], *, batch: int = 64) -> DataFrame:
    """(table, n, xor64, sum64) of many tables, each hashed with its own schema.

    The one-row plans are united in batches, so that no plan grows with the number of tables; each
    batch is checkpointed to the shared folder and its tables are read side by side.
    """
    if not tables:
        raise ValueError("no tables")
    shared_folder(tables[0][1].sparkSession)
    out = None
    for start in range(0, len(tables), batch):
        united = None
        for name, table in tables[start : start + batch]:
            row = fingerprint(table).select(F.lit(name).alias("table"), "n", "xor64", "sum64")
            united = row if united is None else united.unionByName(row)
        done = united.checkpoint()
        out = done if out is None else out.unionByName(done)
    return out


def compare_fingerprints(source: DataFrame, target: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """``match`` per group (or in one row): all three values are equal.

    A group on one side only does not match.
    """
    both = source.withColumn("side", F.lit("source")).unionByName(target.withColumn("side", F.lit("target")))
    pick = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{column}")
    paired = both.groupBy(*by).agg(*[pick(s, c) for s in ("source", "target") for c in ("n", "xor64", "sum64")])
    same = F.lit(True)
    for column in ("n", "xor64", "sum64"):
        same = same & F.col(f"source_{column}").eqNullSafe(F.col(f"target_{column}"))
    return paired.withColumn("match", same)


def validation_candidates(log: DataFrame, inventory: DataFrame) -> DataFrame:
    """Objects that are validated now, with format, parent location and table type from the inventory."""
    known = inventory.select(*KEY, "data_source_format", "parent_managed_location", "table_type")
    return current_log(log).filter(F.col("status") == "validated").select(*KEY, "pre_migration_fqn").join(known, KEY)


def _is_external() -> Column:
    return F.col("table_type").eqNullSafe("EXTERNAL")


def _is_volume() -> Column:
    return F.upper("object_type") == "VOLUME"


def location_evidence(objects: DataFrame, locations: DataFrame, *, new: str) -> DataFrame:
    """Layer 1: the described location is on new; none found is false."""
    return objects.join(locations.select(*KEY, "location"), KEY, "left").withColumn(
        "metadata_location_ok", is_on_account(F.col("location"), new)
    )


def log_directory_evidence(objects: DataFrame, entries: DataFrame) -> DataFrame:
    """Layer 2: external Delta tables have entries in the log directory below their location.

    ``entries`` has one ``root`` per listed entry; the directory is ``<location>/_delta_log``.
    """
    counts = entries.groupBy("root").agg(F.count(F.lit(1)).alias("_entries"))
    applies = F.col("data_source_format").eqNullSafe("DELTA") & _is_external() & (F.coalesce("location", F.lit("")) != "")
    folder = F.concat(F.rtrim("location", F.lit("/")), F.lit("/_delta_log"))
    # Objects it does not apply to get a key of their own: equal or null keys would all meet in one task.
    rows = objects.withColumn("_applies", applies)
    rows = rows.withColumn("root", F.when(F.col("_applies"), folder).otherwise(F.concat_ws("\n", *KEY)))
    found = F.coalesce(F.col("_entries") > 0, F.lit(False))
    return (
        rows.join(counts, "root", "left")
        .withColumn("delta_log_at_new_ok", F.when(F.col("_applies"), found))
        .drop("root", "_entries", "_applies")
    )


def file_path_evidence(objects: DataFrame, paths: DataFrame, *, new: str) -> DataFrame:
    """Layer 3: every distinct file a table's rows come from is on new; null without any, and for volumes.

    ``paths`` has the key and ``path``. Cells that are no storage URL do not count, as in a listing
    with mixed columns.
    """
    urls = paths.filter(storage_account(F.col("path")).isNotNull())
    verdict = urls.groupBy(*KEY).agg(F.bool_and(is_on_account(F.col("path"), new)).alias("_all"))
    return objects.join(verdict, KEY, "left").withColumn("input_file_name_ok", F.when(~_is_volume(), F.col("_all"))).drop("_all")


def parent_evidence(objects: DataFrame, *, new: str) -> DataFrame:
    """Layer 4: the parent's managed location is on new; does not apply to external objects."""
    ok = is_on_account(F.col("parent_managed_location"), new)
    return objects.withColumn("parent_managed_location_match", F.when(~_is_external(), ok))


def table_checksum_evidence(objects: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Layer 5: keyed fingerprints of shadow and live table; managed tables with a shadow only.

    ``source`` and ``target`` are fingerprints by key. A table whose shadow was read but whose
    live copy was not (or differs) fails.
    """
    compared = compare_fingerprints(source, target, by=KEY)
    known = compared.filter(F.col("source_n").isNotNull()).select(*KEY, F.col("match").alias("_match"))
    applies = ~_is_external() & ~_is_volume()
    return objects.join(known, KEY, "left").withColumn("content_checksum_ok", F.when(applies, F.col("_match"))).drop("_match")


def volume_hash_evidence(objects: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Layer 6: file hashes of shadow and live volume; managed volumes with both listings only."""
    compared = hash_verdicts(source, target, keys=KEY)
    both = (F.col("source_files") > 0) & (F.col("target_files") > 0)
    known = compared.filter(both).select(*KEY, F.col("match").alias("_match"))
    applies = ~_is_external() & _is_volume()
    return objects.join(known, KEY, "left").withColumn("volume_content_checksum_ok", F.when(applies, F.col("_match"))).drop("_match")


def overall_pass(flags: Sequence[str] = tuple(LAYERS)) -> Column:
    """No flag is false and at least one is true; null flags are left out."""
    layers = F.array(*[F.col(f) for f in flags])
    return F.forall(layers, lambda f: F.coalesce(f, F.lit(True))) & F.exists(layers, lambda f: F.coalesce(f, F.lit(False)))


def attach_overall(results: DataFrame) -> DataFrame:
    return results.withColumn("overall_pass", overall_pass())


def evidence_json(fields: Sequence[str], *, keep_nulls: bool = True) -> Column:
    """The evidence columns as JSON with sorted keys."""
    return F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false" if keep_nulls else "true"})


def result_rows(results: DataFrame, *, validated_at, nulls_as_false: bool = False) -> DataFrame:
    """The stored shape of the results. Flags keep their nulls unless definite values are asked for."""
    def flag(name: str) -> Column:
        value = (F.col(name) if name in results.columns else F.lit(None)).cast("boolean")
        return (F.coalesce(value, F.lit(False)) if nulls_as_false else value).alias(name)

    fields = [c for c in (*LAYERS, "location", "parent_managed_location") if c in results.columns]
    return results.select(
        *KEY,
        *[flag(n) for n in LAYERS[:4]],
        *[flag(n) for n in GOVERNANCE_FLAGS],
        *[flag(n) for n in LAYERS[4:]],
        overall_pass().alias("overall_pass"),
        evidence_json(fields).alias("evidence_json"),
        F.lit(validated_at).cast("timestamp").alias("validated_at"),
    )


def attach_governance(results: DataFrame, diff: DataFrame) -> DataFrame:
    """The results with the governance flags of ``governance_diff``; objects without a snapshot keep null flags."""
    return results.drop(*GOVERNANCE_FLAGS).join(diff.select(*KEY, *GOVERNANCE_FLAGS), KEY, "left")


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("overall_pass"))


def pass_counts(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if("overall_pass").alias("passed"), F.count(F.lit(1)).alias("total"))


def pass_counts_by_catalog(results: DataFrame) -> DataFrame:
    return results.groupBy("catalog").agg(
        F.count_if("overall_pass").alias("passed"), F.count_if(~F.col("overall_pass")).alias("failed")
    )


#: Bits of an item's hash that are added up, twice: the sums of half a million snapshots of an object stay below 64 bits.
DIGEST_BITS = 44


def _part_digests(part: str, s: Column, fields: dict[str, T.DataType]) -> list[Column]:
    """Two sums over the hashes of a part's items, modulo 2**DIGEST_BITS: equal for equal items, whatever their order."""
    mask = F.lit((1 << DIGEST_BITS) - 1)

    def one(seed: int, *cells: tuple[Column, T.DataType]) -> Column:
        return F.xxhash64(F.lit(seed), *[p for c, kind in cells for p in _flagged(c, kind)]).bitwiseAND(mask)

    def single(*cells: tuple[Column, T.DataType]):
        there = F.coalesce(*[c.cast("string") for c, _ in cells]).isNotNull()
        return lambda seed: F.when(there, one(seed, *cells)).otherwise(F.lit(0).cast("long"))

    def many(array: Column, kind: T.StructType, *names: str):
        add = lambda seed: lambda total, e: (total + one(seed, *[(e[n], kind[n].dataType) for n in names])).bitwiseAND(mask)
        return lambda seed: F.coalesce(F.aggregate(array, F.lit(0).cast("long"), add(seed)), F.lit(0).cast("long"))

    text = T.StringType()
    if part == "owner":
        items = [single((s["owner"], text))]
    elif part == "row_filter":
        items = [single((s["row_filter_name"], text), (F.array_join(s["row_filter_using_columns"], ","), text))]
    elif part == "comments":
        entry = T.StructType([T.StructField("key", text), T.StructField("value", text)])
        # A table's comment has one cell and a column's two, so they are told apart by their number.
        items = [single((s["table_comment"], text)), many(F.map_entries(s["column_comments"]), entry, "key", "value")]
    else:
        array, names = {
            "grants": ("grants", ("principal", "privilege", "object_type")),
            "tags": ("tags", ("name", "value")),
            "column_mask": ("column_masks", ("column", "mask_function", "using_columns")),
        }[part]
        items = [many(s[array], fields[array].elementType, *names)]
    sums = [[item(seed) for item in items] for seed in (1, 2)]
    return [reduce(lambda a, b: a + b, x).bitwiseAND(mask) for x in sums]


def governance_diff(snapshots: DataFrame, live: DataFrame) -> DataFrame:
    """A flag per part for each object in the snapshots: live governance equals the snapshot.

    Both sides are parsed snapshots (``governance.read_snapshots``). Each part is compared by 88 bits of digest over its
    items, so one short row per snapshot is shuffled, whatever the size of its parts. Digests are stored side by
    side, so that the shuffle files behind one capture are gone before the other one begins.
    """
    parts = [name.removesuffix("_ok") for name in GOVERNANCE_FLAGS]

    def digests(rows: DataFrame, side: str) -> DataFrame:
        fields = {f.name: f.dataType for f in rows.schema["snapshot"].dataType.fields}
        found = [d.alias(f"{part}_{i}") for part in parts for i, d in enumerate(_part_digests(part, F.col("snapshot"), fields))]
        return stored(rows.select(*KEY, *found), f"{side}-digests")

    # The live side counts negatively, so what both have adds up to nothing.
    names = [f"{part}_{i}" for part in parts for i in range(2)]
    known = digests(snapshots, "snapshot").select(*KEY, F.lit(True).alias("_known"), *names)
    both = known.unionByName(digests(live, "live").select(*KEY, F.lit(False).alias("_known"), *[(-F.col(n)).alias(n) for n in names]))
    size = F.lit(1 << DIGEST_BITS)
    same = lambda part: reduce(lambda a, b: a & b, [F.pmod(F.sum(f"{part}_{i}"), size) == 0 for i in range(2)])
    return (
        both.groupBy(*KEY)
        .agg(F.bool_or("_known").alias("_known"), *[same(p).alias(f"{p}_ok") for p in parts])
        .filter("_known")
        .drop("_known")
    )
