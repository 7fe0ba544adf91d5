"""The partitioned log: offsets, rate limit, restarts, groups, unfinished appends."""

import json

import pytest
from pyspark.sql import functions as F

from adlens.sources import files, log_stream
from adlens.sources import testdata as td

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def records(spark):
    return td.to_log_records(td.table(spark, SF, "events")).persist()


def start(spark, path, out, ckpt, group="g", most=150):
    return (log_stream.stream_log(spark, path, group, most).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", ckpt).trigger(processingTime="0 seconds").start())


def positions(spark, out):
    rows = [tuple(r) for r in spark.read.parquet(out).select("partition", "offset").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_append_numbers_records(spark, records, tmp_path):
    p = str(tmp_path / "log")
    first = log_stream.append_log(records.filter("event_id % 3 = 0"), p, ["event_id"], partitions=3, segment_rows=50)
    ends = log_stream.append_log(records.filter("event_id % 3 > 0"), p, ["event_id"], partitions=99, segment_rows=50)
    log = log_stream.read_log(spark, p)
    assert log.count() == records.count() == sum(ends) and len(ends) == 3
    per = {r["partition"]: r for r in log.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.countDistinct("offset").alias("n")).collect()}
    assert [(per[i]["lo"], per[i]["hi"] + 1, per[i]["n"]) for i in range(3)] == [(0, e, e) for e in ends]
    # a key keeps its partition and its order within an append
    assert log.groupBy("key").agg(F.countDistinct("partition").alias("k")).filter("k > 1").count() == 0
    assert log.exceptAll(log_stream.read_log(spark, p)).count() == 0
    assert log.select("key", "value").exceptAll(records.select("key", "value")).count() == 0
    assert all(n <= 50 for part in range(3) for _, n, _ in log_stream.segments(p, part)) and sum(first) < sum(ends)


def test_micro_batches_and_restart(spark, records, tmp_path):
    """A query stopped half-way and restarted on its checkpoint reads every record once."""
    p, out, ckpt = (str(tmp_path / x) for x in ("log", "out", "ckpt"))
    log_stream.append_log(records, p, ["event_id"], partitions=3, segment_rows=64)
    total = records.count()
    q = start(spark, p, out, ckpt)
    while q.isActive and not (q.lastProgress and q.lastProgress["batchId"] >= 2):
        q.awaitTermination(1)
    q.stop()
    seen = positions(spark, out)
    assert 0 < len(seen)
    log_stream.append_log(records.withColumn("event_id", F.col("event_id") + 10**6), p, ["event_id"], segment_rows=64)
    q = start(spark, p, out, ckpt, most=230)
    log_stream.drain(q)
    assert len(positions(spark, out)) == 2 * total
    batches = [x["numInputRows"] for x in q.recentProgress if x["numInputRows"]]
    assert len(batches) >= 3 and max(batches) <= 230 * 2 + 3


def test_rate_limit(spark, records, tmp_path):
    p, out, ckpt = (str(tmp_path / x) for x in ("log", "out", "ckpt"))
    ends = log_stream.append_log(records, p, ["event_id"], partitions=4)
    q = start(spark, p, out, ckpt, most=-(-sum(ends) // 6))
    log_stream.drain(q)
    batches = [x["numInputRows"] for x in q.recentProgress if x["numInputRows"]]
    assert len(batches) >= 5 and max(batches) <= -(-sum(ends) // 6) + 4
    assert len(positions(spark, out)) == sum(ends)


def test_group_goes_on_from_committed_offsets(spark, records, tmp_path):
    """A query on a new checkpoint goes on from what its group committed; another group starts anew."""
    p = str(tmp_path / "log")
    ends = log_stream.append_log(records, p, ["event_id"], partitions=2)
    log_stream.drain(start(spark, p, str(tmp_path / "o1"), str(tmp_path / "c1"), group="a", most=200))
    committed = json.loads(files.read(f"{p}/_groups/a.json"))["committed"]
    assert 0 < sum(committed) <= sum(ends)
    log_stream.append_log(records, p, ["event_id"])
    log_stream.drain(start(spark, p, str(tmp_path / "o2"), str(tmp_path / "c2"), group="a", most=200))
    later = positions(spark, str(tmp_path / "o2"))
    assert later == {(i, o) for i in range(2) for o in range(committed[i], 2 * ends[i])}
    log_stream.drain(start(spark, p, str(tmp_path / "o3"), str(tmp_path / "c3"), group="b", most=5000))
    assert len(positions(spark, str(tmp_path / "o3"))) == 2 * sum(ends)


def test_ends_never_run_backwards(tmp_path, spark, records):
    """A reader that forgot its place plans from its marks, beyond any end it has handed out."""
    p = str(tmp_path / "log")
    ends = log_stream.append_log(records, p, ["event_id"], partitions=2)
    one = log_stream.LogStreamReader(p, "g", 100)
    handed = [one.latestOffset() for _ in range(3)]
    again = log_stream.LogStreamReader(p, "g", 7)
    nxt = again.latestOffset()
    assert all(nxt[k] >= handed[-1][k] for k in nxt)
    for _ in range(1000):
        last = again.latestOffset()
    assert [last[str(i)] for i in range(2)] == ends
    assert again.partitions(last, last) == []
    with pytest.raises(ValueError):
        log_stream.LogStreamReader(p, None, 5)


def test_unfinished_append_is_invisible(spark, records, tmp_path):
    """Segments without their marker are not read, and the next append takes their offsets."""
    p = str(tmp_path / "log")
    ends = log_stream.append_log(records.limit(100), p, ["event_id"], partitions=2)
    bad = records.withColumn("value", F.when(F.col("event_id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        log_stream.append_log(bad, p, ["event_id"])
    files.put(f"{p}/p=0/{ends[0]:020d}-1-{'0' * 32}.parquet", lambda out: out.write(b"left behind"))
    assert log_stream.end_offsets(p) == ends
    log_stream.append_log(records.limit(50), p, ["event_id"])
    assert log_stream.read_log(spark, p).count() == 150


def test_null_keys_and_empty_appends(spark, tmp_path):
    p = str(tmp_path / "log")
    rows = spark.createDataFrame([(i, None, f"v{i}", None) for i in range(40)], "event_id long, key string, value string, timestamp timestamp")
    assert log_stream.append_log(rows.limit(0), p, ["event_id"], partitions=2) == [0, 0]
    assert log_stream.read_log(spark, p).count() == 0
    ends = log_stream.append_log(rows, p, ["event_id"])
    assert sum(ends) == 40 and min(ends) > 0
    assert {r["value"] for r in log_stream.read_log(spark, p).collect()} == {f"v{i}" for i in range(40)}
