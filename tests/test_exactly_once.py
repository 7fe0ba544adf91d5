"""Counters fenced by epoch, staged DB-API upserts, stored columns, compaction over empty batches."""

import json
import os
import sys

import pytest
from pyspark.sql import functions as F

from adlens.sinks import dbapi, merge
from adlens.sinks.counters import EpochCounters, EpochCounterSink
from adlens.streaming import deal_stream


def deltas(spark, **kv):
    return spark.createDataFrame(list(kv.items()), "key string, value long")


def values(store, spark):
    return {r["key"]: r["value"] for r in store.values(spark).collect()}


def test_epochs_apply_once(spark, tmp_path):
    store = EpochCounters(str(tmp_path / "c"))
    assert values(store, spark) == {} and store.fold(spark) == {}
    for _ in range(2):
        store.apply(deltas(spark, a=1, b=2), "q", 0)
        store.apply(deltas(spark, a=10), "q", 1)
        store.apply(deltas(spark, a=100), "other", 0)
    assert values(store, spark) == {"a": 111, "b": 2}
    assert store.fold(spark) == {"q": 1, "other": 0}
    assert not store.apply(deltas(spark, a=10), "q", 1)
    assert store.apply(deltas(spark, c=5, a=-1), "q", 2)
    assert values(store, spark) == {"a": 110, "b": 2, "c": 5}
    assert store.fold(spark) == {"q": 2, "other": 0} and values(store, spark) == {"a": 110, "b": 2, "c": 5}
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 4)], "key string, value long")
    store.apply(rows, "q", 3)  # several rows of a key, a null key
    assert values(store, spark) == {"a": 113, "b": 2, "c": 5, None: 4}


def test_unfinished_fold_changes_nothing(spark, tmp_path):
    store = EpochCounters(str(tmp_path / "c"))
    store.apply(deltas(spark, a=1), "q", 0)
    # a base without its marker: a fold that died
    deltas(spark, a=999).write.parquet(str(tmp_path / "c" / "base-dead"))
    assert values(store, spark) == {"a": 1}


def test_sink_publishes_values_not_increments(spark, tmp_path):
    root = str(tmp_path / "kv")
    os.makedirs(root)

    class FileStore:
        def __init__(self):
            self.root = root

        def set(self, key, value):
            with open(os.path.join(self.root, key), "w") as f:
                f.write(str(value))

        def close(self):
            pass

    store = EpochCounters(str(tmp_path / "c"))
    sink = EpochCounterSink(store, lambda b: b.groupBy("key").agg(F.count("*").alias("value")), fold_every=2, connect=FileStore)
    batches = [["a", "a", "b"], ["a"], ["b", "c"]]
    for replay in range(2):
        for i, keys in enumerate(batches):
            sink(spark.createDataFrame([(k,) for k in keys], "key string"), i)
    kv = {k: int(open(os.path.join(root, k)).read()) for k in os.listdir(root)}
    assert kv == values(store, spark) == {"a": 3, "b": 2, "c": 1}


# A database in one file: just enough of DB-API for the three statements of a staged upsert.
FAKE = '''
import fcntl, json, os

FILE = {file!r}


class Connection:
    def __init__(self):
        self.todo = []

    def cursor(self):
        return self

    def executemany(self, sql, rows):
        assert sql.startswith("INSERT INTO stage(`job`,`attempt`,")
        for r in rows:
            if r[2] == "poison":
                raise RuntimeError("bad row")
        self.todo += [("load", [list(r) for r in rows])]

    def execute(self, sql, args):
        if sql.startswith("INSERT INTO target"):
            assert "ON DUPLICATE KEY UPDATE `m`=VALUES(`m`)" in sql
            if os.path.exists(FILE + ".refuse"):
                raise RuntimeError("target refused")
            self.todo.append(("merge", args))
        else:
            assert sql.startswith("DELETE FROM stage")
            self.todo.append(("clear", args))

    def commit(self):
        with open(FILE + ".lock", "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            db = json.load(open(FILE)) if os.path.exists(FILE) else {{"stage": [], "target": {{}}, "transactions": 0}}
            for kind, what in self.todo:
                if kind == "load":
                    db["stage"] += what
                elif kind == "merge":
                    for job, attempt, k, at, m in db["stage"]:
                        if [job, attempt] == list(what):
                            old = db["target"].get(k)
                            db["target"][k] = [old[0] if old else at, m]
                else:
                    db["stage"] = [r for r in db["stage"] if r[0] != what[0]]
            db["transactions"] += 1
            json.dump(db, open(FILE, "w"))

    def rollback(self):
        self.todo = []

    def close(self):
        pass


def connect():
    return Connection()
'''


@pytest.fixture()
def database(spark, tmp_path):
    name = f"fake_db_{os.getpid()}_{abs(hash(str(tmp_path)))}"
    module = tmp_path / f"{name}.py"
    module.write_text(FAKE.format(file=str(tmp_path / "db.json")))
    spark.sparkContext.addPyFile(str(module))
    sys.path.insert(0, str(tmp_path))
    yield f"{name}:connect", lambda: json.load(open(tmp_path / "db.json")), tmp_path
    sys.path.remove(str(tmp_path))


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k string, at string, m long").repartition(4, "k")


def upsert(df, connect):
    dbapi.upsert_dbapi(df, connect, "target", "stage", ["k"], ["m"], batch_rows=3)


def test_staged_upsert(spark, database):
    connect, db, _ = database
    upsert(rows(spark, [(f"k{i}", "first", i) for i in range(20)]), connect)
    upsert(rows(spark, [(f"k{i}", "second", 100 + i) for i in range(10, 30)]), connect)
    got = db()
    assert got["stage"] == []
    assert got["target"] == {f"k{i}": ["first" if i < 20 else "second", i if i < 10 else 100 + i] for i in range(30)}


def test_failed_task_leaves_target_alone(spark, database):
    connect, db, _ = database
    upsert(rows(spark, [("a", "x", 1)]), connect)
    with pytest.raises(Exception, match="bad row"):
        upsert(rows(spark, [(f"k{i}", "x", i) for i in range(20)] + [("poison", "x", 0)]), connect)
    got = db()
    assert got["target"] == {"a": ["x", 1]} and got["stage"] == []


def test_failed_commit_is_one_transaction(spark, database):
    connect, db, tmp = database
    upsert(rows(spark, [("a", "x", 1)]), connect)
    (tmp / "db.json.refuse").write_text("")
    with pytest.raises(Exception, match="target refused"):
        upsert(rows(spark, [(f"k{i}", "x", i) for i in range(20)]), connect)
    got = db()
    assert got["target"] == {"a": ["x", 1]} and got["stage"] == []


def test_merge_keeps_stored_columns(spark, tmp_path):
    p = str(tmp_path / "t")
    stage = iter(range(100))
    run = lambda df: merge.merge_partitions(spark, p, df, ["k"], ["m"], "day", str(tmp_path / f"stage{next(stage)}"))
    run(spark.createDataFrame([("a", 1, "note a", "2024-01-01"), ("z", 9, "note z", "2024-01-02")], "k string, m long, note string, day string"))
    run(spark.createDataFrame([("a", 2, "2024-01-01"), ("b", 3, "2024-01-01")], "k string, m long, day string"))
    read = lambda: spark.read.option("mergeSchema", "true").schema("k string, m long, note string, extra int, day string").parquet(p)
    assert sorted(map(tuple, read().collect())) == [("a", 2, "note a", None, "2024-01-01"), ("b", 3, None, None, "2024-01-01"), ("z", 9, "note z", None, "2024-01-02")]
    # a column only the update has is added, one only an untouched day has is kept
    run(spark.createDataFrame([("a", 4, 7, "2024-01-01"), ("c", 5, 8, "2024-01-01")], "k string, m long, extra int, day string"))
    assert sorted(map(tuple, read().collect()), key=str) == [("a", 4, "note a", None, "2024-01-01"), ("b", 3, None, None, "2024-01-01"),
                                                            ("c", 5, None, 8, "2024-01-01"), ("z", 9, "note z", None, "2024-01-02")]


def test_compaction_survives_empty_batches(spark, tmp_path):
    p = str(tmp_path / "totals")
    batch = lambda n: spark.createDataFrame([("d", "2024-01-01", n)] if n else [], "dealid string, now_time string, total long")
    sink = deal_stream.BatchLedgerSink(p, compact_every=2)
    sink(batch(1), 0)
    sink(batch(0), 1)
    snaps = lambda: sorted(x for x in os.listdir(os.path.join(p, deal_stream.SNAPSHOTS)) if x.startswith("snap"))
    assert snaps() == ["snap=0"]
    for i in range(2, 8):
        sink(batch(0), i)
    assert snaps() == ["snap=0"]  # nothing new was written
    sink(batch(5), 8)
    assert snaps() == ["snap=0", "snap=1"]
    deal_stream.BatchLedgerSink(p, compact_every=2)(batch(6), 9)  # restarted: counts from the snapshot
    assert deal_stream.latest_totals(spark, p).collect()[0]["total"] == 6
