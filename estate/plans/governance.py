"""Replay statements, warnings and revokes as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estate.functions.text import quote_ident, quote_literal, quote_name
from estate.operators.governance import inherited_only_grants, own_kind, read_snapshots
from estate.settings import INHERITED_FROM, KEY


def _target() -> Column:
    return F.concat(own_kind(F.col("object_type")), F.lit(" "), quote_name("catalog", "schema", "name"))


def _step(kind: str, statement: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), statement.alias("statement"))


def _one(kind: str, value: Column, statement: Column) -> Column:
    """One step when the value is there, else none."""
    none = F.array().cast("array<struct<kind:string,statement:string>>")
    return F.when(F.coalesce(value != "", F.lit(False)), F.array(_step(kind, statement))).otherwise(none)


def _list(column: Column, kind: str) -> Column:
    return F.coalesce(column, F.array().cast(kind))


def replay_statements(snapshots: DataFrame) -> DataFrame:
    """Ordered statements per snapshot: grants, owner, tags, comment, properties.

    Inherited grants and ``delta.`` properties are left out; volumes have no properties. All steps
    of an object are built inside its row, so nothing is shuffled.
    """
    rows = read_snapshots(snapshots).withColumn("target", _target())
    target = F.col("target")
    grants = F.transform(
        F.filter(
            _list(F.col("snapshot.grants"), "array<struct<principal:string,privilege:string,object_type:string>>"),
            lambda g: ~F.coalesce(F.upper(g["object_type"]).isin(INHERITED_FROM), F.lit(False)),
        ),
        lambda g: _step(
            "grant", F.concat(F.lit("GRANT "), g["privilege"], F.lit(" ON "), target, F.lit(" TO "), quote_ident(g["principal"]))
        ),
    )
    owner = F.col("snapshot.owner")
    tags = F.array_join(
        F.transform("snapshot.tags", lambda t: F.concat(quote_literal(t["name"]), F.coalesce(F.concat(F.lit(" = "), quote_literal(t["value"])), F.lit("")))), ", "
    )
    comment = F.col("snapshot.table_comment")
    entries = F.map_entries(F.coalesce("snapshot.table_properties", F.create_map().cast("map<string,string>")))
    settable = F.filter(entries, lambda e: ~e["key"].startswith("delta.") & (F.col("object_type") == "TABLE"))
    properties = F.transform(
        settable,
        lambda e: _step(
            "property",
            F.concat(
                F.lit("ALTER "), target, F.lit(" SET TBLPROPERTIES ("), quote_literal(e["key"]), F.lit(" = "), quote_literal(e["value"]), F.lit(")")
            ),
        ),
    )
    steps = F.concat(
        grants,
        _one("owner", owner, F.concat(F.lit("ALTER "), target, F.lit(" OWNER TO "), quote_ident(owner))),
        _one("tags", tags, F.concat(F.lit("ALTER "), target, F.lit(" SET TAGS ("), tags, F.lit(")"))),
        _one("comment", comment, F.concat(F.lit("COMMENT ON "), target, F.lit(" IS "), quote_literal(comment))),
        properties,
    )
    return rows.select(*KEY, F.posexplode(steps).alias("position", "step")).select(
        *KEY, (F.col("position") + 1).alias("step_no"), "step.kind", "step.statement"
    )


def replay_warnings(snapshots: DataFrame) -> DataFrame:
    """Captured parts that have no replay statement: row filters and column masks."""
    rows = read_snapshots(snapshots)
    masks = F.coalesce(F.size("snapshot.column_masks"), F.lit(0))
    row_filter = F.nullif("snapshot.row_filter_name", F.lit(""))
    found = F.array_compact(
        F.array(
            F.when(row_filter.isNotNull(), F.struct(F.lit("row_filter").alias("part"), row_filter.alias("detail"))),
            F.when(masks > 0, F.struct(F.lit("column_masks").alias("part"), masks.cast("string").alias("detail"))),
        )
    )
    return rows.select(*KEY, F.inline(found))


def revoke_statements(snapshots: DataFrame, live_grants: DataFrame) -> DataFrame:
    """REVOKE per inherited-only pair that has become direct."""
    statement = F.concat(
        F.lit("REVOKE "), "privilege", F.lit(" ON "), _target(), F.lit(" FROM "), quote_ident("principal")
    )
    return inherited_only_grants(snapshots, live_grants).withColumn("statement", statement)


def revoke_counts(revokes: DataFrame) -> DataFrame:
    return revokes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("revokes"))
