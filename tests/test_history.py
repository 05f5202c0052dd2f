"""The log at a point in time, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest

from estate.operators import history

START = datetime(2024, 1, 1)
LOG = "catalog string, schema string, name string, object_type string, updated_at timestamp, status string"
AUDIT = "event_time timestamp, action_name string, request_params map<string,string>, user_identity struct<email string>"


def _log(rng, objects, n, hours):
    statuses = [*list(history.FOLLOWS)[1:], None]
    rows = [("c", "s", f"t{rng.choice(objects)}", "TABLE", START + timedelta(hours=rng.randrange(hours)), rng.choice(statuses)) for _ in range(n)]
    return rows + [("c", "s", "t0", "TABLE", None, "cloned"), ("c", None, "t0", "TABLE", START, "cloned"), ("c", "s", "t0", "VOLUME", START, "cloned")]


def _last(rows):
    return max(rows, key=lambda r: (r[4], r[5] is not None, r[5] or ""), default=None)


# One object holds most rows; hours apart and months apart, so that states are carried over empty buckets.
@pytest.mark.parametrize("hours,bucket", [(30, "hour"), (24 * 200, "day"), (24 * 200, "month")])
def test_writes_see_the_status_of_their_time(spark, hours, bucket):
    rng = random.Random(hours)
    log = _log(rng, [0] * 8 + [1, 2], 150, hours)
    writes = [(START + timedelta(hours=rng.randrange(hours)), rng.choice(["writeTable", "getTable"]), {"full_name_arg": f"c.s.t{rng.choice([0, 0, 0, 1, 2, 9])}", "n": str(i)}, ("u",)) for i in range(200)]
    writes += [(None, "writeTable", {"full_name_arg": "c.s.t0", "n": "x"}, ("u",)), (START, "writeTable", {}, None), (START, "writeTable", None, None)]
    expected = set()
    for at, action, params, _ in writes:
        if at is None or action != "writeTable" or not params:
            continue
        last = _last([r for r in log if r[3] == "TABLE" and r[1] and r[4] is not None and r[4] <= at and f"c.s.{r[2]}" == params["full_name_arg"]])
        if last and last[5] in ("cloned", "failed"):
            expected.add((params["n"], last[5], last[4]))
    found = history.writes_while(spark.createDataFrame(log, LOG), spark.createDataFrame(writes, AUDIT), statuses=("cloned", "failed"), bucket=bucket)
    assert sorted((r.request_params["n"], r.status, r.since) for r in found.collect()) == sorted(expected) and expected


@pytest.mark.parametrize("hours,bucket", [(30, "hour"), (24 * 200, "day")])
def test_first_illegal_event(spark, hours, bucket):
    rng = random.Random(hours)
    log = _log(rng, [0] * 8 + list(range(1, 40)), 200, hours)
    good = ["claimed", "snapshot_taken", "cloned", "failed", "cloned", "swapped", "replayed", "validated"]
    log += [("c", "s", "good", "TABLE", START + timedelta(hours=i), s) for i, s in enumerate(good)]
    expected = {}
    for key in {r[:4] for r in log}:
        bad, before = [], ""
        for at, status in sorted((r[4], r[5] or "(none)") for r in log if r[:4] == key and r[4] is not None):
            if status not in history.FOLLOWS.get(before, []):
                bad.append((at, before, status))
            before = status
        if bad:
            expected[key] = (len(bad), *min(bad, key=lambda b: (b[0], b[2], b[1])))
    found = history.illegal_events(spark.createDataFrame(log, LOG), bucket=bucket).collect()
    assert {tuple(r)[:4]: tuple(r)[4:] for r in found} == expected and ("c", "s", "good", "TABLE") not in expected


def test_empty_tables(spark):
    log = spark.createDataFrame([], LOG)
    assert history.writes_while(log, spark.createDataFrame([], AUDIT)).collect() == []
    assert history.illegal_events(log).collect() == []


def test_rows_are_put_in_order_by_bucket_only(spark):
    """The window over all rows is partitioned by key and bucket; the one by key alone has one row a bucket."""
    plan = history.illegal_events(spark.createDataFrame(_log(random.Random(1), [0], 50, 90), LOG))._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("Window [") == 2
