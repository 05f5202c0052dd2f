"""Grants, owner, tags, filters, masks, comments, properties: capture, replay, remediation.

Statements and warnings come from ``estate.plans.governance``. A snapshot is one JSON text per
object, so it holds that object's grants and tags; their number is limited by the catalog, not by
the data. Comparisons (``revoke_plan``, ``verify.governance_diff``) work on exploded rows instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from estate.functions.text import list_cell
from estate.settings import INHERITED_FROM, KEY
from estate.sources.listings import detail_starts

SNAPSHOT_TYPE = (
    "grants array<struct<principal:string,privilege:string,object_type:string>>, owner string, "
    "tags array<struct<name:string,value:string>>, row_filter_name string, row_filter_using_columns array<string>, "
    "column_masks array<struct<column:string,mask_function:string,using_columns:array<string>>>, "
    "table_comment string, column_comments map<string,string>, table_properties map<string,string>"
)


def own_kind(object_type: Column) -> Column:
    """The securable keyword of an object: VOLUME, or TABLE for all else."""
    return F.when(F.upper(object_type) == "VOLUME", "VOLUME").otherwise("TABLE")


def _is_inherited(granted_on: Column) -> Column:
    return F.coalesce(F.upper(granted_on).isin(INHERITED_FROM), F.lit(False))


def normalise_grants(rows: DataFrame) -> DataFrame:
    """Grant rows under any of the spellings a listing uses, as ``principal``, ``privilege``,
    ``granted_on``; other columns stay. Rows without a principal are dropped."""
    by_name = {c.lower().replace("_", ""): c for c in rows.columns}

    def pick(*names: str) -> Column:
        cells = [F.nullif(F.col(by_name[n]), F.lit("")) for n in names if n in by_name]
        return F.coalesce(*cells) if cells else F.lit(None).cast("string")

    used = {by_name[n] for n in ("principal", "actiontype", "privilege", "action", "objecttype") if n in by_name}
    return rows.select(
        *[c for c in rows.columns if c not in used],
        pick("principal").alias("principal"),
        pick("actiontype", "privilege", "action").alias("privilege"),
        F.coalesce(pick("objecttype"), F.lit("TABLE")).alias("granted_on"),
    ).filter(F.col("principal").isNotNull())


def direct_grants(grants: DataFrame) -> DataFrame:
    """Grants made on the object itself. ``object_type`` is the object's, ``granted_on`` the row's."""
    kind = own_kind(F.col("object_type"))
    return grants.filter(F.upper(F.coalesce(F.nullif("granted_on", F.lit("")), kind)) == kind)


def tag_lists(tags: DataFrame) -> DataFrame:
    return tags.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct(F.col("tag_name").alias("name"), F.col("tag_value").alias("value")))).alias("tags")
    )


def row_filters(rows: DataFrame) -> DataFrame:
    """The first filter row per object: its function and the columns it uses."""
    name = F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in ("filter_name", "function_name") if n in rows.columns])
    # A list cell is used when it has an entry, as a text cell is when it is not blank.
    lists = [list_cell(F.col(n), rows.schema[n].dataType) for n in ("using_columns", "input_columns") if n in rows.columns]
    columns = F.coalesce(*[F.when(F.size(c) > 0, c) for c in lists], F.array().cast("array<string>"))
    first = rows.groupBy(*KEY).agg(F.min_by(F.struct(name.alias("name"), columns.alias("columns")), "pos").alias("first"))
    return first.select(*KEY, F.col("first.name").alias("row_filter_name"), F.col("first.columns").alias("row_filter_using_columns"))


def column_masks(rows: DataFrame) -> DataFrame:
    return rows.select(
        *KEY,
        F.col("column_name").alias("column"),
        F.col("function_name").alias("mask_function"),
        list_cell(F.col("using_columns"), rows.schema["using_columns"].dataType).alias("using_columns"),
    )


def described_owners(describe: DataFrame) -> DataFrame:
    """The first owner row after the detail separator; a column of that name does not count."""
    starts = detail_starts(describe, _starts_detail(F.coalesce("col_name", F.lit(""))))
    return (
        describe.filter(F.lower("col_name") == "owner")
        .join(starts, KEY)
        .filter(F.col("pos") > F.col("detail_pos"))
        .groupBy(*KEY)
        .agg(F.min_by("data_type", "pos").alias("owner"))
    )


def _starts_detail(label: Column) -> Column:
    return label.startswith("#") | label.startswith("Detailed")


def described_comments(describe: DataFrame) -> DataFrame:
    """``column`` and ``comment`` rows; the table comment has a null column.

    Column comments stand before the first separator row, the table comment after it (last wins).
    Rows are narrowed to the few that can matter before anything is shuffled.
    """
    label = F.coalesce("col_name", F.lit(""))
    starts = detail_starts(describe, _starts_detail(label))
    columns = (
        describe.filter((label != "") & F.col("comment").isNotNull())
        .join(starts, KEY, "left")
        .filter(F.col("detail_pos").isNull() | (F.col("pos") < F.col("detail_pos")))
        .groupBy(*KEY, F.col("col_name").alias("column"))
        .agg(F.max_by("comment", "pos").alias("comment"))
    )
    table = (
        describe.filter(F.lower(label) == "comment")
        .join(starts, KEY)
        .filter(F.col("pos") > F.col("detail_pos"))
        .groupBy(*KEY)
        .agg(F.max_by("data_type", "pos").alias("comment"))
        .select(*KEY, F.lit(None).cast("string").alias("column"), "comment")
    )
    return columns.unionByName(table)


def property_maps(rows: DataFrame) -> DataFrame:
    """Properties as a map; of a repeated key the last by ``pos`` (or by value) counts, null keys are left out."""
    order = [F.col("pos")] if "pos" in rows.columns else []
    last = rows.filter(F.col("key").isNotNull()).groupBy(*KEY, "key").agg(F.max(F.struct(*order, "value")).alias("last"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("key"), F.col("last.value").alias("value"))))
    return last.groupBy(*KEY).agg(F.map_from_entries(entries).alias("table_properties"))


def _last_per_key(entries: Column) -> Column:
    """Sorted (key, ...) structs to the last one of each key, as a map needs unique keys."""
    return F.filter(entries, lambda e, i: ~F.coalesce(F.get(entries, i + 1)["a"] == e["a"], F.lit(False)))


def _as_map(entries: Column) -> Column:
    kept = F.transform(_last_per_key(entries), lambda e: F.struct(e["a"].alias("key"), e["b"].alias("value")))
    return F.map_from_entries(kept)


def _as_text(rows: DataFrame, cell: str) -> Column:
    """A list cell as comma text; a text cell as it is."""
    return F.array_join(cell, ",") if isinstance(rows.schema[cell].dataType, T.ArrayType) else F.col(cell)


def _part_rows(rows: DataFrame, part: str, *, pos: Column | None = None, a=None, b=None, c=None) -> DataFrame:
    text = lambda cell: (F.lit(None) if cell is None else F.col(cell) if isinstance(cell, str) else cell).cast("string")
    place = F.lit(0) if pos is None else pos
    return rows.select(*KEY, F.lit(part).alias("part"), place.cast("long").alias("pos"), text(a).alias("a"), text(b).alias("b"), text(c).alias("c"))


def _describe_parts(describe: DataFrame) -> DataFrame:
    """The describe rows that matter, each under every part it can belong to; one scan."""
    label, nothing = F.coalesce("col_name", F.lit("")), F.lit(None).cast("string")

    def when(condition: Column, part: str, a: Column = nothing, b: Column = nothing) -> Column:
        return F.when(condition, F.struct(F.lit(part).alias("part"), a.alias("a"), b.alias("b")))

    found = F.array_compact(
        F.array(
            when(_starts_detail(label), "detail"),
            when(F.lower(label) == "owner", "owner", F.col("data_type")),
            when(F.lower(label) == "comment", "comment", F.col("data_type")),
            when((label != "") & F.col("comment").isNotNull(), "column", F.col("col_name"), F.col("comment")),
        )
    )
    rows = describe.select(*KEY, F.col("pos").cast("long").alias("pos"), F.inline(found))
    return rows.withColumn("c", F.lit(None).cast("string"))


def capture_snapshots(
    objects: DataFrame,
    *,
    grants: DataFrame,
    tags: DataFrame,
    filters: DataFrame,
    masks: DataFrame,
    describe: DataFrame,
    properties: DataFrame,
    captured_at,
) -> DataFrame:
    """One snapshot JSON per object; a part without rows is empty.

    All parts become rows of one shape and meet in a single aggregation on the object: one
    shuffle, where joining each part's own aggregate would hold nine operators' memory per task.
    """
    pos = F.col("pos")
    function = F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in ("filter_name", "function_name") if n in filters.columns])
    parts = [
        _part_rows(direct_grants(grants), "grant", a="principal", b="privilege", c="granted_on"),
        _part_rows(tags, "tag", a="tag_name", b="tag_value"),
        _part_rows(filters, "row_filter", pos=pos, a=function, b=_as_text(filters, "using_columns")),
        _part_rows(masks, "mask", a="column_name", b="function_name", c=_as_text(masks, "using_columns")),
        _part_rows(properties.filter(F.col("key").isNotNull()), "property", pos=pos if "pos" in properties.columns else None, a="key", b="value"),
        _describe_parts(describe),
    ]
    rows = _part_rows(objects, "object")
    for part in parts:
        rows = rows.unionByName(part)

    # One list per object, in the order that the parts need: by part, then by these cells.
    by_pos = F.col("part").isin("comment", "owner", "row_filter")
    cells = F.struct("part", F.when(by_pos, pos).alias("first"), "a", F.when(F.col("part").isin("column", "property"), pos).alias("then"), "b", "c", "pos")
    # The hash of the object leads, as tasks sort by it far faster than by four texts with common beginnings.
    gathered = (
        rows.groupBy(F.xxhash64(*KEY).alias("_object"), *KEY)
        .agg(
            F.count_if(F.col("part") == "object").alias("wanted"),
            F.min(F.when(F.col("part") == "detail", pos)).alias("detail"),
            F.sort_array(F.collect_list(F.when(~F.col("part").isin("object", "detail"), cells))).alias("parts"),
        )
        .filter(F.col("wanted") > 0)
    )

    def listed(part: str) -> Column:
        return F.filter("parts", lambda e: e["part"] == part)

    owners = F.filter(listed("owner"), lambda e: e["pos"] > F.col("detail"))
    gathered = gathered.select(
        *KEY,
        "detail",
        *[listed(part).alias(part) for part in ("grant", "tag", "mask", "property", "comment", "column")],
        F.get(owners, F.lit(0))["a"].alias("owner"),
        F.get(listed("row_filter"), F.lit(0))["a"].alias("filter_name"),
        F.get(listed("row_filter"), F.lit(0))["b"].alias("filter_columns"),
    )
    before_detail = F.filter("column", lambda e: F.col("detail").isNull() | (e["pos"] < F.col("detail")))
    after_detail = F.filter("comment", lambda e: e["pos"] > F.col("detail"))
    snapshot = F.struct(
        F.transform("grant", lambda g: F.struct(g["a"].alias("principal"), g["b"].alias("privilege"), g["c"].alias("object_type"))).alias("grants"),
        F.col("owner"),
        F.transform("tag", lambda t: F.struct(t["a"].alias("name"), t["b"].alias("value"))).alias("tags"),
        F.col("filter_name").alias("row_filter_name"),
        list_cell(F.col("filter_columns")).alias("row_filter_using_columns"),
        F.transform(
            "mask", lambda m: F.struct(m["a"].alias("column"), m["b"].alias("mask_function"), list_cell(m["c"]).alias("using_columns"))
        ).alias("column_masks"),
        F.try_element_at(after_detail, F.lit(-1))["a"].alias("table_comment"),
        _as_map(before_detail).alias("column_comments"),
        _as_map(F.col("property")).alias("table_properties"),
    )
    return gathered.select(
        *KEY,
        F.to_json(snapshot, {"ignoreNullFields": "false"}).alias("snapshot_json"),
        F.lit(captured_at).cast("timestamp").alias("captured_at"),
    )


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot per object, the larger text on equal times."""
    return (
        snapshots.groupBy(*KEY)
        .agg(F.max(F.struct("captured_at", "snapshot_json")).alias("last"))
        .select(*KEY, "last.snapshot_json", "last.captured_at")
    )


def read_snapshots(snapshots: DataFrame) -> DataFrame:
    """The parsed parts as a struct column ``snapshot``; unreadable JSON gives null."""
    return snapshots.withColumn("snapshot", F.from_json("snapshot_json", SNAPSHOT_TYPE)).drop("snapshot_json")


def inherited_only_grants(snapshots: DataFrame, live_grants: DataFrame) -> DataFrame:
    """Pairs that were only inherited at capture time but are direct on the live object now.

    Snapshot grants and live grants are one stream of flagged rows, merged by a single
    aggregation on (object, principal, privilege).
    """
    kind = own_kind(F.col("object_type"))
    captured = (
        read_snapshots(latest_snapshots(snapshots))
        .select(*KEY, F.inline("snapshot.grants").alias("principal", "privilege", "granted_on"))
        .select(
            *KEY,
            "principal",
            "privilege",
            _is_inherited(F.col("granted_on")).alias("inherited"),
            F.coalesce(F.upper("granted_on") == kind, F.lit(False)).alias("direct"),
            F.lit(False).alias("live"),
        )
    )
    live = direct_grants(live_grants).select(
        *KEY, "principal", "privilege", F.lit(False).alias("inherited"), F.lit(False).alias("direct"), F.lit(True).alias("live")
    )
    return (
        captured.unionByName(live)
        .groupBy(*KEY, "principal", "privilege")
        .agg(F.bool_or("inherited").alias("inherited"), F.bool_or("direct").alias("direct"), F.bool_or("live").alias("live"))
        .filter(F.col("inherited") & ~F.col("direct") & F.col("live"))
        .select(*KEY, "principal", "privilege")
    )
