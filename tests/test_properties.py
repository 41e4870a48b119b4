"""Distributed building blocks against plain Python on generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.quality import dedup_latest
from strata.operators.skew import lookup_join, previous_value, trailing_hour_counts
from strata.operators.star import merge_dimension_scd1

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.sampled_from(["a", "b", "hot", None])


@few
@given(st.lists(st.tuples(keys, st.integers(0, 12000)), max_size=40))
def test_trailing_hour(spark, calls):
    df = spark.createDataFrame(calls, "k STRING, s INT")
    timed = df.select("k", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("ts"))
    got = {
        (r["k"], r["s"]): (r["calls"], r["n"])
        for r in trailing_hour_counts(timed, ["k"], "ts", "n")
        .withColumn("s", F.unix_timestamp("ts") - 1_700_000_000)
        .collect()
    }
    named = calls
    want = {(k, s): (named.count((k, s)), sum(1 for j, t in named if j == k and s - 3600 <= t <= s)) for k, s in named}
    assert got == want


@few
@given(st.lists(st.tuples(keys, st.integers(0, 5), st.one_of(st.none(), st.integers(0, 3))), max_size=30))
def test_newest_row(spark, data):
    df = spark.createDataFrame(data, "k STRING, at INT, v INT")
    got = {r["k"]: (r["at"], r["v"]) for r in dedup_latest(df, ["k"], ["at"]).collect()}
    want = {}
    for k, at, v in data:
        best = want.get(k)
        if best is None or (at, -1 if v is None else v) > (best[0], -1 if best[1] is None else best[1]):
            want[k] = (at, v)
    assert got == want


@few
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=30), st.sets(st.sampled_from(["a", "b", "c", "hot"])))
def test_lookup_paths_agree(spark, facts, members):
    left = spark.createDataFrame(facts, "k STRING, v INT")
    right = spark.createDataFrame([(m, i) for i, m in enumerate(sorted(members))], "m STRING, sk INT")
    want = sorted(((k, v, sorted(members).index(k) if k in members else None) for k, v in facts), key=repr)
    for size in (None, 0):
        got = lookup_join(left, right, [("k", "m")], ["sk"], size).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 99)), max_size=30, unique=True))
def test_previous_value(spark, data):
    df = spark.createDataFrame([(k, i, i * 3) for k, i in data], "k STRING, i INT, v INT")
    got = {(r["k"], r["i"]): r["p"] for r in previous_value(df, ["k"], ["i"], "v", "p").collect()}
    for k in ("a", "b", None):
        line = sorted(i for j, i in data if j == k)
        for before, i in zip([None, *line], line, strict=False):
            assert got[(k, i)] == (None if before is None else before * 3)


@few
@given(st.lists(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 2), max_size=5), min_size=1, max_size=3))
def test_merges_keep_keys(spark, loads):
    state = spark.createDataFrame([], "SK INT, BK STRING, V INT")
    keys_seen, values = {}, {}
    for load in loads:
        source = spark.createDataFrame(list(load.items()), "BK STRING, V INT")
        merged = merge_dimension_scd1(state, source, "BK", "SK", ["V"], "2024-01-01").collect()
        state = spark.createDataFrame(merged, "SK INT, BK STRING, V INT")
        for k in sorted(set(load) - set(keys_seen)):
            keys_seen[k] = len(keys_seen) + 1
        values.update(load)
        assert {r["BK"]: (r["SK"], r["V"]) for r in merged} == {k: (keys_seen[k], values[k]) for k in keys_seen}
