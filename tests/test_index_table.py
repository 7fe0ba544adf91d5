"""The index table: pushed filters, skipped blocks, pruned columns, all-or-nothing commits."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.datasource import (EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not,
                                    StringContains, StringStartsWith)

from adlens.plans.registry import QUERIES
from adlens.sinks import writers
from adlens.sources import files, index_table, logs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(6)
    words = ["", "a", "ab", "abc", "b", "é", "東京", "z" * 90, "z" * 64 + "a", None]
    rows = [(i if i % 50 else None, rnd.choice(words), rnd.choice([True, False, None]), rnd.choice([1.5, float("nan"), None]), [i]) for i in range(900)]
    return spark.createDataFrame(rows, "n long, s string, flag boolean, x double, arr array<int>")


@pytest.fixture(scope="module")
def path(spark, docs, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("index") / "t")
    index_table.write_index(docs, p, order=["s", "n"], files_wanted=3, block_rows=40)
    return p


CONDITIONS = ["n = 17", "n > 880 AND n <= 890", "n IN (3, 4, 700)", "n IS NULL", "n <=> NULL", "n <=> 5", "s = ''", "s >= 'b'", "s < 'ab'", "s LIKE 'ab%'",
              "s = concat(repeat('z', 64), 'a')", "s > repeat('z', 70)", "s LIKE 'z%'", "s LIKE '%b%'", "s IN ('é', '東京', 'nope')", "flag", "NOT flag", "flag = false AND s IS NOT NULL",
              "x = 1.5", "x > 1", "n % 7 = 2 AND s = 'a'", "n = 1 OR s = 'abc'", "n <> 5 AND n < 9", "array_contains(arr, 5)", "n = 10000", "s IS NULL AND n < 100",
              "n IN (NULL, 8)", "s >= 'é' AND s <= '東京'"]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filters_give_sparks_rows(spark, docs, path, condition):
    got = index_table.read_index(spark, path).filter(condition).collect()
    assert sorted(map(str, got)) == sorted(map(str, docs.filter(condition).collect()))


def explain(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_plan_shows_pushed_filters_and_columns(spark, path):
    df = index_table.read_index(spark, path, ["n", "s"]).filter("s = 'ab' AND n > 3 AND n % 2 = 0")
    plan = explain(df)
    assert "EqualTo(s,ab)" in plan and "GreaterThan(n,3)" in plan
    assert "ReadSchema: struct<n:bigint,s:string>" in plan


def reader(path, *filters):
    schema = index_table.IndexSource({"path": path}).schema()
    r = index_table.IndexReader(path, schema, blocks_per_task=2)
    return r, list(r.pushFilters(list(filters)))


def test_blocks_are_skipped(path):
    every = reader(path)[0].blocks()
    assert len(every) >= 20
    assert len(reader(path, EqualTo(("s",), "é"))[0].blocks()) < len(every) / 3
    assert reader(path, EqualTo(("s",), "aaa"), GreaterThan(("n",), 10_000))[0].blocks() == []
    assert reader(path, In(("s",), ("\U0010fff0", "\U0010fffe")))[0].blocks() == []
    # a text longer than the bounds kept
    assert 0 < len(reader(path, EqualTo(("s",), "z" * 90))[0].blocks()) < len(every) / 2
    assert [index_table.text_above(x) for x in ("ab", "a\U0010ffff", "\ud7ff", "\U0010ffff", "")] == ["ac", "b", "\ue000", None, None]
    parts = reader(path, IsNotNull(("s",)))[0].partitions()
    assert all(sum(len(b) for _, b in p.value) <= 2 for p in parts)


def test_unknown_filters_go_back_to_spark(path):
    given = [Not(EqualTo(("n",), 1)), StringContains(("s",), "b"), EqualTo(("x",), 1.5), EqualTo(("n",), None), GreaterThan(("arr", "e"), 1)]
    taken = [EqualNullSafe(("n",), None), IsNull(("s",)), LessThan(("n",), 4), LessThanOrEqual(("n",), 4), GreaterThanOrEqual(("s",), "a"), StringStartsWith(("s",), "a")]
    r, back = reader(path, *given, *taken)
    assert back == given and r.filters == taken


def test_append_overwrite_and_empty(spark, docs, tmp_path):
    p = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        index_table.read_index(spark, p).count()
    part = docs.select("n", "s")
    index_table.write_index(part.filter("n < 100"), p)
    index_table.write_index(part.filter("n >= 100"), p)
    assert index_table.read_index(spark, p).count() == part.filter("n IS NOT NULL").count()
    index_table.write_index(part.limit(0), p)
    index_table.write_index(part.filter("n = 5"), p, "overwrite")
    index_table.write_index(part.filter("n = 6"), p)
    assert sorted(r["n"] for r in index_table.read_index(spark, p).collect()) == [5, 6]
    index_table.write_index(part.limit(0), p, "overwrite")
    assert index_table.read_index(spark, p).count() == 0


def test_failed_job_leaves_nothing(spark, docs, tmp_path):
    """Some tasks finish and one fails: no document of the job is visible and no file of a
    finished task is left; what was committed before stays."""
    p = str(tmp_path / "t")
    index_table.write_index(docs.select("n", "s").filter("n = 7"), p)
    kept = files.names(p)
    bad = docs.select(F.when(F.col("n") == 899, F.raise_error(F.lit("broken task")).cast("long")).otherwise(F.col("n")).alias("n"), "s").repartition(8, "n")
    with pytest.raises(Exception, match="broken task"):
        index_table.write_index(bad, p)
    assert [r["n"] for r in index_table.read_index(spark, p).collect()] == [7]
    assert files.names(p) == kept


def test_blocks_are_bounded_by_bytes(spark, tmp_path):
    """Long documents end a block before its rows do: a task holds a block, not a million of them."""
    import pyarrow.parquet as pq
    p = str(tmp_path / "t")
    big = spark.range(0, 400, 1, 2).select("id", F.when(F.col("id") == 77, F.repeat(F.lit("x"), 200_000))
                                           .otherwise(F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 30))).alias("doc"))
    index_table.register(spark)
    big.write.format(index_table.FORMAT).mode("append").option("block_bytes", "50000").option("block_rows", "20").save(p)
    found = [pq.read_table(f"{p}/{n}") if n.startswith("docs") else None for n in files.names(p)]
    assert sum(t.num_rows for t in found if t is not None) == 400
    for n in files.names(p):
        if n.startswith("docs"):
            f = pq.ParquetFile(f"{p}/{n}")
            for i in range(f.num_row_groups):
                t = f.read_row_group(i)
                assert t.num_rows <= 20 and (t.num_rows == 1 or t.nbytes <= 50_000 + 2_000 or 77 in t["id"].to_pylist())
    got = index_table.read_index(spark, p)
    assert sorted(got.collect()) == sorted(big.collect())
    assert [r["id"] for r in got.filter("id = 301").collect()] == [301]


def test_documents_and_views(spark, tmp_path):
    p = str(tmp_path / "docs")
    docs = spark.createDataFrame([("a", "{}"), ("b", '{"x":1}')], "doc_id string, doc string")
    writers.write_documents(docs, p, "append", index_table.FORMAT)
    logs.register_table(spark, "docs_view", index_table.FORMAT, path=p)
    assert spark.sql("SELECT doc FROM docs_view WHERE doc_id = 'b'").collect()[0][0] == '{"x":1}'


def test_query_prunes(spark):
    plan = explain(QUERIES["index_scan_pushdown"](spark, SF))
    for pushed in ("EqualTo(dsp_id,10002)", "GreaterThanOrEqual(dealid,3)", "LessThan(dealid,8)", "In(advertiser_id", "IsNotNull(tag_id)"):
        assert pushed in plan
