"""Day totals in the state of a stream: seeds, several micro-batches, restarts, expiry."""

import datetime as dt
import json

import pytest

from adlens.sources import log_stream
from adlens.streaming import day_state, deal_stream

TOPIC = "sltadxlog-adx-bg"


def records(spark, rows):
    """(event_id, ts, deal) -> log records."""
    value = lambda d: json.dumps({"dealid": d, "sltcustomtopic": TOPIC} if d else {"sltcustomtopic": TOPIC})
    return spark.createDataFrame([(i, d, t, value(d)) for i, t, d in rows], "event_id long, key string, timestamp timestamp, value string")


def day(n, hour=12):
    return dt.datetime(2024, 1, n, hour)


def start(spark, path, tmp, stored, delay, most):
    raw = log_stream.stream_log(spark, path, "g", most).withColumnRenamed("timestamp", "ts")
    return day_state.run_seeded_totals(spark, raw, stored, str(tmp / "out"), str(tmp / "ckpt"), {"processingTime": "0 seconds"}, delay)[0]


def totals(spark, tmp):
    return {(r["dealid"], r["now_time"]): r["total"] for r in deal_stream.latest_totals(spark, str(tmp / "out")).collect()}


@pytest.fixture()
def stored(spark):
    return spark.createDataFrame([("a", "2024-01-01", 100), ("b", "2024-01-02", 7), ("never seen", "2024-01-01", 5), (None, "2024-01-01", 40)],
                                 "dealid string, now_time string, total int")


def test_seeds_batches_and_restart(spark, stored, tmp_path):
    path = str(tmp_path / "log")
    rows = [(i, day(1 + i % 3), ["a", "b", None][i % 5 % 3]) for i in range(90)]
    log_stream.append_log(records(spark, rows[:50]), path, ["event_id"], partitions=2)
    q = start(spark, path, tmp_path, stored, "30 days", 20)
    log_stream.drain(q)
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) >= 2
    log_stream.append_log(records(spark, rows[50:]), path, ["event_id"])
    log_stream.drain(start(spark, path, tmp_path, stored, "30 days", 20))
    want = {}
    seeds = {("a", "2024-01-01"): 100, ("b", "2024-01-02"): 7, (None, "2024-01-01"): 40}
    for _, t, d in rows:
        key = (d, t.strftime("%Y-%m-%d"))
        want[key] = want.get(key, seeds.get(key, 0)) + 1
    assert totals(spark, tmp_path) == want


def test_state_is_cleared_at_day_ends(spark, stored, tmp_path):
    """Days in order: closed days leave the state, and a record of a closed day is dropped."""
    path = str(tmp_path / "log")
    rows = [(i, day(1 + i // 10, i % 10), f"d{i % 10}") for i in range(280)]
    log_stream.append_log(records(spark, rows), path, ["event_id"], partitions=1)
    q = start(spark, path, tmp_path, stored.limit(0), "1 day", 40)
    log_stream.drain(q)
    held = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    every_bucket = 28 * 10  # ten deals in buckets of their own, mostly, on 28 days
    assert held < every_bucket / 3
    log_stream.append_log(records(spark, [(999, day(2), "d1"), (1000, day(28, 23), "d1")]), path, ["event_id"])
    log_stream.drain(start(spark, path, tmp_path, stored.limit(0), "1 day", 40))
    got = totals(spark, tmp_path)
    assert got[("d1", "2024-01-02")] == 1 and got[("d1", "2024-01-28")] == 2
    assert len(got) == 280 and sum(got.values()) == 281
