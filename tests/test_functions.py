import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyweave.functions import dates as D
from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators.features import argmax_column, kv_columns, kv_wide
from tallyweave.sources.nulls import normalise_missing


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_ratio_and_bounds(spark):
    assert one(spark, N.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, N.ratio(F.lit(1.0), F.lit(4.0))) == 0.25
    assert one(spark, N.within(F.lit(5.0), 0, 4)) is None
    assert one(spark, N.within(F.lit(4.0), 0, 4)) == 4.0
    assert one(spark, N.positive_part(F.lit(None).cast("double"))) == 0.0
    assert one(spark, N.rescale_sentinel(F.lit(365243.0))) == 3652.0
    assert one(spark, N.rescale_sentinel(F.lit(20000.0))) == 20000.0


def test_bucket_rounds_half_to_even(spark):
    assert one(spark, N.round_to_bucket(F.lit(1987), 5)) == "1985"
    assert one(spark, N.round_to_bucket(F.lit(1992.5), 5)) == "1990"


def test_equal_width_bins_are_right_closed(spark):
    edge = lambda x: one(spark, N.equal_width_bin(F.lit(x), F.lit(0.0), F.lit(20.0)))
    assert [edge(0.0), edge(1.0), edge(1.01), edge(20.0)] == [1, 1, 2, 20]
    assert one(spark, N.equal_width_bin(F.lit(3.0), F.lit(3.0), F.lit(3.0))) == 1


def test_energy_needs_all_operands(spark):
    fix = lambda kcal, kj, fat=10.0: one(
        spark,
        N.energy_from_parts(F.lit(kcal), F.lit(kj).cast("double"), F.lit(fat).cast("double"), F.lit(5.0), F.lit(5.0)),
    )
    assert fix(100.0, 418.0) == 100.0
    assert fix(100.0, 500.0) == 130.0
    assert fix(100.0, None) == 100.0
    assert fix(100.0, 500.0, None) == 100.0
    assert fix(2000.0, None) == 130.0


def test_mass_rescale(spark):
    assert one(spark, N.rescale_mass(F.lit(50.0), F.lit(103.0))) == 48.5
    assert one(spark, N.rescale_mass(F.lit(50.0), F.lit(106.0))) == 50.0


def test_weeks_end_on_monday(spark):
    week = lambda t: one(spark, D.week_ending_monday(F.lit(t)))
    assert week(dt.datetime(2024, 1, 1, 10)) == dt.date(2024, 1, 1)
    assert week(dt.datetime(2024, 1, 2)) == dt.date(2024, 1, 8)
    assert one(spark, D.weekday(F.lit(dt.datetime(2024, 1, 1)))) == 0


def test_text(spark):
    assert one(spark, X.s3_to_https(F.lit("s3://b/a dir/x#1.jpg"), "eu-west-1")) == (
        "https://b.s3.eu-west-1.amazonaws.com/a%20dir/x%231.jpg"
    )
    assert one(spark, X.first_level(F.lit('["Home >> Kitchen >> Pans"]'))) == "Home"
    assert one(spark, X.parent_folder(F.lit("s3://b/apple/1.jpg"))) == "apple"
    assert one(spark, X.distinct_tags(F.lit("en:A, en:a,,fr:b"))) == ["en:a", "fr:b"]
    assert one(spark, X.remove_phrase(F.lit("Acme red  mug ACME"), F.lit("acme"))) == "red mug"
    assert one(spark, X.edit_similarity(F.lit(""), F.lit(""))) == 1.0
    assert one(spark, X.edit_similarity(F.lit("abcd"), F.lit("abce"))) == 0.75


def test_nan_and_inf_become_null(spark):
    df = spark.createDataFrame([(float("nan"), "Unknown "), (float("inf"), "x"), (1.0, None)], "a double, b string")
    assert [tuple(r) for r in normalise_missing(df, ["unknown"]).collect()] == [(None, None), (None, "x"), (1.0, None)]


@pytest.mark.parametrize("local", [True, False])
def test_key_value_strings(spark, local):
    df = spark.createDataFrame([(1, "a:1.5,b:2,a:1"), (2, "x"), (3, None), (4, "z:7,b:oops")], "id int, s string")
    groups = {"a": "a", "b": "b"}
    if local:
        out = df.select("id", *[c.alias(n) for n, c in kv_columns("s", groups, "NA", "k_", ["a", "b", "NA"]).items()])
    else:
        out = kv_wide(df, "id", "s", groups, "NA", "k_", ["a", "b", "NA"])
    got = {r["id"]: (r["k_a"], r["k_b"], r["k_NA"]) for r in out.collect()}
    assert got == {1: (2.5, 2.0, 0.0), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 0.0), 4: (0.0, 0.0, 7.0)}


def test_argmax_column(spark):
    df = spark.createDataFrame([(0.0, 3.0, 3.0), (0.0, 0.0, 0.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(argmax_column(["a", "b", "c"])).collect()] == ["b", None]


def test_tokens_keep_letters_of_any_script_and_repeats(spark):
    from tallyweave.functions.text import tokens

    df = spark.createDataFrame([("für Menté Straße garçon straße el-niño 12ab",)], "t string")
    assert df.select(tokens("t", 3)).first()[0] == ["für", "menté", "straße", "garçon", "straße", "niño"]
    assert df.select(tokens("t", 3, stop=["für"])).first()[0] == ["menté", "straße", "garçon", "straße", "niño"]
