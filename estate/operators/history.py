"""What the migration log said about an object at a point in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from estate.functions.text import dotted_name
from estate.operators.lineage import NAME, WRITE_ACTIONS
from estate.settings import KEY

#: Statuses that may follow each status; the first event of an object follows "".
FOLLOWS = {
    "": ["claimed"],
    "claimed": ["snapshot_taken", "failed"],
    "snapshot_taken": ["cloned", "failed"],
    "cloned": ["swapped", "failed", "rolled_back"],
    "swapped": ["replayed", "failed", "rolled_back", "rollback_failed"],
    "replayed": ["validated", "failed", "rolled_back", "rollback_failed"],
    "validated": ["rolled_back", "rollback_failed"],
    "failed": ["claimed", "snapshot_taken", "cloned", "swapped", "replayed", "validated", "failed", "rolled_back", "rollback_failed"],
    "rollback_failed": ["rolled_back", "rollback_failed"],
    "rolled_back": ["claimed"],
}


def attach_before(rows: DataFrame, key: list[str], at: str, state: Column, order: list[Column], *, bucket: str = "day") -> DataFrame:
    """The rows with `before`, the newest non-null `state` among the rows of the same key that come earlier.

    Rows are ordered by `at`, then by `order`. Time is cut into buckets (a unit of `date_trunc`): the
    last state of each bucket is found by an aggregation that merges inside each task, is carried over
    these few rows to the next buckets, and only rows of one bucket are then put in order. So a key
    that holds many rows is spread over as many tasks as it has buckets. Rows without a time are dropped.
    """
    clock = F.col(at)
    rows = rows.filter(clock.isNotNull()).withColumns({"_state": state, "_bucket": F.date_trunc(bucket, at)})
    rows = rows.withColumn("_place", F.struct(clock.alias("at"), *[o.alias(f"o{i}") for i, o in enumerate(order)]))
    newest = F.max(F.when(F.col("_state").isNotNull(), F.struct("_place", "_state")))
    last = rows.groupBy(*key, "_bucket").agg(newest.alias("_newest"))
    earlier = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*key, "_bucket", F.last(F.col("_newest._state"), ignorenulls=True).over(earlier).alias("_state"))
    # A row that carries the state has no place, so it comes first in its bucket.
    both = rows.unionByName(carried.filter(F.col("_state").isNotNull()), allowMissingColumns=True)
    inside = Window.partitionBy(*key, "_bucket").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("before", F.last("_state", ignorenulls=True).over(inside))
    return found.filter(F.col("_place").isNotNull()).drop("_state", "_bucket", "_place")


def writes_while(events: DataFrame, audit: DataFrame, *, statuses: tuple[str, ...] = ("cloned",), bucket: str = "day") -> DataFrame:
    """(full_name, event_time, actor, action_name, request_params, status, since): writes to a table while its log stood at one of `statuses`.

    A write between clone and swap reaches the original only and is lost by the swap. An event of the
    log counts from its own time on, so a write of the same time comes after it; of events of one time
    the largest status is the last. Writes to tables that the log does not know are dropped before
    anything is shuffled by time.
    """
    log = events.filter((F.col("object_type") == "TABLE") & F.col("updated_at").isNotNull())
    log = log.select(dotted_name(*NAME).alias("full_name"), F.col("updated_at").alias("event_time"), F.lit(0).alias("kind"), "status")
    writes = audit.filter(F.col("action_name").isin(WRITE_ACTIONS)).select(
        F.try_element_at("request_params", F.lit("full_name_arg")).alias("full_name"),
        F.col("event_time").cast(log.schema["event_time"].dataType).alias("event_time"),
        F.lit(1).alias("kind"),
        F.col("user_identity.email").alias("actor"),
        "action_name",
        "request_params",
    )
    writes = writes.join(log.select("full_name").distinct(), "full_name", "left_semi")
    said = F.when(F.col("kind") == 0, F.struct("status", F.col("event_time").alias("since")))
    rows = attach_before(log.unionByName(writes, allowMissingColumns=True), ["full_name"], "event_time", said, [F.col("kind"), F.col("status")], bucket=bucket)
    found = rows.filter((F.col("kind") == 1) & F.col("before.status").isin(list(statuses)))
    return found.select("full_name", "event_time", "actor", "action_name", "request_params", "before.status", "before.since")


def illegal_events(events: DataFrame, *, follows: dict[str, list[str]] = FOLLOWS, bucket: str = "day") -> DataFrame:
    """(key, bad_events, updated_at, before, status): objects whose log breaks the order of statuses, with the first event that does.

    An event is bad if its status may not follow that of the event before, which is "" for the first;
    a null status, given as "(none)", or an unknown one is always bad and nothing may follow it. Events of one time are ordered by
    status. Events without a time have no place in the order and are not judged.
    """
    status = F.coalesce("status", F.lit("(none)"))
    rows = attach_before(events.select(*KEY, "updated_at", "status"), KEY, "updated_at", status, [status], bucket=bucket)
    rows = rows.withColumn("before", F.coalesce("before", F.lit("")))
    legal = F.create_map(*[part for s, after in follows.items() for part in (F.lit(s), F.array(*[F.lit(a) for a in after]))])
    allowed = F.coalesce(F.array_contains(F.try_element_at(legal, F.col("before")), status), F.lit(False))
    first = F.min(F.struct("updated_at", status.alias("status"), "before")).alias("first")
    return rows.filter(~allowed).groupBy(*KEY).agg(F.count(F.lit(1)).alias("bad_events"), first).select(*KEY, "bad_events", "first.updated_at", "first.before", "first.status")
