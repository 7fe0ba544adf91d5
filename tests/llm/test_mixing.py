import plain
import pytest

from adlens.llm import mixing
from adlens.llm.common import table


def as_rows(df):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()))


def test_equals_the_plain_mix(odd_docs, spark):
    for docs in (odd_docs, table(spark, "/root/testdata/sf0.001", "documents")):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
        want = sorted((d is not None, d or 0, n, s, round(g, 6), t) for d, n, s, g, t in plain.mix(rows))
        assert as_rows(mixing.mix(docs)) == want
        assert as_rows(mixing.mix(docs.repartition(5))) == want


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 2}, {"a": 5}, {"a": 0, "b": 0}, {"a": 10, "b": 1000, "c": 1, "d": 0, None: 4}])
def test_targets_equal_iterative_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain.targets(sizes))


def test_mixed_documents(odd_docs, no_docs):
    taken = {}
    for r in mixing.mix(odd_docs).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    got = {}
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    whole = {r["text"] or "" for r in odd_docs.collect()}
    for r in out.collect():
        got[r["source"]] = got.get(r["source"], 0) + len(plain.words(r["text"]))
        assert any(t.startswith(r["text"] or "") for t in whole)
    assert {s: n for s, n in got.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
