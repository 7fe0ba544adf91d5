"""Property tests: the merge operators equal plain dictionary merges."""

from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.sinks import merge

small = st.integers(min_value=0, max_value=50)


@settings(max_examples=8, deadline=None)
@given(target=st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), small, max_size=4),
       updates=st.dictionaries(st.sampled_from(["a", "b", "c", "e"]), small, max_size=4))
def test_upsert_equals_dict_update(spark, target, updates):
    t = spark.createDataFrame([(k, f"attr-{k}", v) for k, v in target.items()], "k string, attr string, m long")
    u = spark.createDataFrame([(k, "new", v) for k, v in updates.items()], "k string, attr string, m long")
    got = {r["k"]: (r["attr"], r["m"]) for r in merge.upsert(t, u, ["k"], ["m"]).collect()}
    want = {k: (f"attr-{k}", v) for k, v in target.items()}
    for k, v in updates.items():
        want[k] = (want[k][0] if k in want else "new", v)
    assert got == want


@settings(max_examples=8, deadline=None)
@given(current=st.dictionaries(st.sampled_from(["k1", "k2", "k3"]), small, max_size=3),
       deltas=st.lists(st.tuples(st.sampled_from(["k1", "k2", "k4"]), small), max_size=6))
def test_counter_add_equals_incrby(spark, current, deltas):
    c = spark.createDataFrame(list(current.items()), "key string, value long")
    d = spark.createDataFrame(deltas, "key string, value long")
    got = {r["key"]: r["value"] for r in merge.counter_add(c, d).collect()}
    want = dict(current)
    for k, v in deltas:
        want[k] = want.get(k, 0) + v
    assert got == want
