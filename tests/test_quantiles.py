import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweave.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.8, 1.0]


def check(spark, data):
    df = spark.createDataFrame([(k, float(v)) for k, v in data], "k int, v double")
    got = {r["k"]: r["q"] for r in Q.exact_quantiles(df, ["k"], ["v"], PROBS).collect()}
    for key in {k for k, _ in data}:
        want = np.quantile([v for k, v in data if k == key], PROBS)
        assert got[key] == pytest.approx(want, rel=1e-12, abs=1e-300)


def test_mixed_signs_and_magnitudes(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=300), rng.normal(size=300) * 1e9, [0.0, -0.0, 1e-300, -1e300, 2.0, 4.0, 8.0]])
    check(spark, [(int(i % 3), v) for i, v in enumerate(values)])


def test_hot_group_with_few_values(spark):
    check(spark, [(1, i % 5) for i in range(3000)] + [(2, 1.5), (3, 1.0), (3, 2.0)])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, values):
    check(spark, [(1, v) for v in values])


def test_buckets_keep_the_order(spark):
    values = sorted({s * m * 2.0**e for s in (-1, 1) for e in range(-40, 40) for m in (1, 1.0001, 1.4, 1.9999999)} | {0.0})
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", Q.value_bucket(F.col("v")).alias("b"))
    buckets = [r["b"] for r in df.orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_missing_values_and_keys_take_no_part(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", 1.0), ("a", 2.0), (None, 9.0)], "k string, v double")
    assert [tuple(r) for r in Q.group_medians(df, ["k"], ["v"]).collect()] == [("a", 1.5)]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("b", "z")], "k string, v string")
    assert sorted(tuple(r) for r in Q.group_modes(df, ["k"], "v").collect()) == [("a", "x"), ("b", "z")]
    assert Q.column_modes(df, ["k", "v"]) == {"k": "a", "v": "x"}


def test_infinities_are_left_out(spark):
    from tallyweave.operators.quantiles import value_counts

    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "x double")
    assert [(r["value"], r["n"]) for r in value_counts(df, [], ["x"]).collect()] == [(1.0, 1)]
