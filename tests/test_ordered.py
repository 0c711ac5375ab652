import datetime as dt

import duckdb
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.operators import aggregates as A
from tallyweave.operators import joins as J
from tallyweave.operators import ordered as O
from tallyweave.operators import sampling as P


def test_merge_duplicates(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, None, "x"), ("a", 2, 5, "y"), ("a", 3, 6, None), ("b", 1, None, None), (None, 1, 1, "z")],
        "k string, o int, n int, s string",
    )
    once = O.merge_duplicates(df, ["k"], [F.col("o")])
    assert rows(once) == [("a", 1, 5, "x"), ("b", 1, None, None)]
    assert rows(O.merge_duplicates(once, ["k"], [F.col("o")])) == rows(once)


def test_group_median_repair_uses_good_rows_only(spark, rows):
    df = spark.createDataFrame(
        [(1, "A", 250.0), (2, " a", 10.0), (3, "a", 30.0), (4, "b", 300.0), (5, "c", 7.0), (6, None, 400.0)],
        "id int, g string, v double",
    )
    out = O.repair_by_group_median(df, {"v": F.col("v") > 100}, "g")
    assert rows(out, "id", "v") == [(1, 20.0), (2, 10.0), (3, 30.0), (4, 300.0), (5, 7.0), (6, 400.0)]


def test_word_median_repair_needs_all_frequent_words(spark, rows):
    data = [(i, "apple pie", 10.0 + i) for i in range(3)] + [(10 + i, "apple juice", 1.0 + i) for i in range(3)]
    data += [(20, "apple pie hot", 999.0), (21, "juice", 999.0), (22, "unknown", 999.0)]
    df = spark.createDataFrame(data, "id int, name string, v double")
    out = O.repair_by_word_median(df, {"v": F.col("v") > 100}, X.terms("name"), 3)
    got = dict(rows(out, "id", "v"))
    assert (got[20], got[21], got[22], got[0]) == (11.0, 2.0, 999.0, 10.0)


def test_cascade_prefers_the_finest_level(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", "x", 1.0), (2, "a", "x", None), (3, "a", "y", None), (4, "b", "x", 9.0), (5, "c", "z", None), (6, None, "x", None)],
        "id int, k string, l string, v double",
    )
    levels = [["k", "l"], ["k"], ["l"]]
    assert [v for _, v in rows(O.cascade_impute(df, "v", levels), "id", "v")] == [1.0, 1.0, 1.0, 9.0, None, 5.0]
    last = O.cascade_impute(df, "v", levels, last_wins=True)
    assert [v for _, v in rows(last, "id", "v")] == [1.0, 5.0, 1.0, 9.0, None, 5.0]
    mean = O.cascade_impute(df, ["v"], [["l"]], kind="mean")
    assert dict(rows(mean, "id", "v"))[2] == 5.0


def test_weekly_calendar_has_empty_weeks(spark, rows):
    days = [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 23)]
    df = spark.createDataFrame([(d, 2.0) for d in days], "ts timestamp, v double")
    out = O.running_totals(O.weekly_totals(df, "ts", F.col("v")), ["n"])
    assert [(str(r["week"]), r["n"], r["total"], r["cum_n"]) for r in out.orderBy("week").collect()] == [
        ("2024-01-01", 1, 2.0, 1),
        ("2024-01-08", 1, 2.0, 2),
        ("2024-01-15", 0, 0.0, 2),
        ("2024-01-22", 0, 0.0, 2),
        ("2024-01-29", 1, 2.0, 3),
    ]


def test_global_rank_with_one_hot_value(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 700, 5).otherwise(F.col("id") % 7).alias("v"))
    ranked = O.global_rank(df.repartition(6), F.desc("v"), "id").collect()
    want = {r: i + 1 for i, r in enumerate(sorted(((x["id"], x["v"]) for x in df.collect()), key=lambda p: (-p[1], p[0])))}
    assert all(want[(r["id"], r["v"])] == r["rank"] for r in ranked) and len(ranked) == 1000


def test_latest_non_null(spark, rows):
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2003, 3.0), ("a", 2004, None), ("b", 2010, 5.0)], "k string, year int, v double")
    out = O.latest_non_null(df, ["k"], "year", "v", [1999, 2001, 2005])
    assert rows(out) == [("a", 2001, 1.0), ("a", 2005, 3.0)]


def test_long_concatenations_are_dealt_into_parts(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, "hot").otherwise("cold").alias("k"), "id")
    out = A.string_concat(df, ["k"], F.col("id").cast("string"), ["id"], part_items=20).collect()
    hot = [r for r in out if r["k"] == "hot"]
    assert len(hot) > 1
    assert sorted(int(x) for r in hot for x in r["text"].split(",")) == list(range(90))
    assert [r["text"] for r in out if r["k"] == "cold"] == [",".join(map(str, range(90, 100)))]


def test_parts_of_a_long_concatenation_are_ranges_of_the_order(spark):
    """Several parts, ties of the order, null keys and a group of exactly one part against SQL over all items."""
    rows = [("hot", (i * 37) % 95 // 2, f"i{i}") for i in range(95)] + [(None, i, f"n{i}") for i in range(25)]
    rows += [("even", -i, f"e{i}") for i in range(20)] + [("even", 3, None)]
    df = spark.createDataFrame(rows, "k string, o int, id string")
    out = A.string_concat(df.repartition(7), ["k"], F.col("id"), ["o"], part_items=20).collect()
    want = duckdb.sql(
        """WITH r AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY o, id) - 1) // 20 AS part FROM df_rows WHERE id IS NOT NULL)
           SELECT k, part, string_agg(id, ',' ORDER BY o, id) FROM r GROUP BY ALL""".replace(
            "df_rows", "(VALUES " + ",".join("(%s, %d, %s)" % (_sql(k), at, _sql(i)) for k, at, i in rows) + ") AS v(k, o, id)"
        )
    ).fetchall()
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def _sql(text):
    return "NULL" if text is None else f"'{text}'"


def test_longest_prefix(spark, rows):
    left = spark.createDataFrame([(1, "SP", "0123"), (2, "SP", "0199"), (3, "RJ", "0123"), (4, "SP", None)], "id int, st string, zip string")
    table = spark.createDataFrame([("SP", "01", 1.0), ("SP", "012", 2.0), ("SP", "0123", 3.0), ("SP", "0123", 2.5)], "st string, pre string, lat double")
    out = J.by_longest_prefix(left, "zip", table, "pre", ["st"], ["lat"])
    assert dict(rows(out, "id", "lat")) == {1: 2.5, 2: 1.0, 3: None, 4: None}


def test_grid_and_lookup(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "x string, y int, n int")
    assert rows(J.complete_grid(df, "x", "y", ["n"])) == [("a", 1, 5), ("a", 2, 0), ("b", 1, 0), ("b", 2, 6)]
    pairs = spark.createDataFrame([("c1", "p2"), ("c1", "p1"), ("c1", None), ("c2", None)], "c string, p string")
    assert rows(J.learned_parent(pairs, "c", "p")) == [("c1", "p1"), ("c1", "p1"), ("c1", "p2"), ("c2", None)]


def test_samples_repeat_and_keep_their_shares(spark):
    df = spark.range(20000)
    first, again = P.uniform_sample(df, 0.3, "id"), P.uniform_sample(df.repartition(7), 0.3, "id")
    assert {r[0] for r in first.collect()} == {r[0] for r in again.collect()}
    assert abs(first.count() / 20000 - 0.3) < 0.02
    split = P.hash_split(df, "id", 0.25).groupBy("split").count().collect()
    assert abs({r["split"]: r["count"] for r in split}["test"] / 20000 - 0.25) < 0.02


def test_word_median_with_a_word_that_most_rows_share(spark, monkeypatch):
    """Cells stay small whatever a word's share; the result is that of the plain rule."""
    from statistics import median

    monkeypatch.setattr(O, "TILE_ROWS", 8)
    rows = [(i, ["hot", *([f"w{i % 40}"] if i % 3 else []), *([f"x{i % 7}"] if i % 5 == 0 else [])], float(i * 37 % 101), i % 11 == 0) for i in range(600)]
    rows.append((900, ["rare"], 1.0, True))
    df = spark.createDataFrame(rows, "id int, words array<string>, v double, bad boolean")
    got = {r["id"]: r["v"] for r in O.repair_by_word_median(df, {"v": F.col("bad")}, F.col("words"), 5).select("id", "v").collect()}
    counts = {}
    for _, words, _, _ in rows:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    sets = {i: {w for w in words if counts[w] >= 5} for i, words, _, _ in rows}
    for i, _, v, bad in rows:
        near = [x for j, _, x, b in rows if not b and sets[j] and sets[i] <= sets[j]]
        assert got[i] == (median(near) if bad and sets[i] and near else v)


def test_cascade_joins_rows_once(spark):
    """Four levels are looked up for each distinct key, null keys too; the rows meet one table."""
    rows = [("a", "x", 1.0), ("a", "x", None), ("a", None, None), (None, "y", None), ("b", "y", 5.0), (None, None, None)] * 2
    df = spark.createDataFrame(rows, "k string, m string, v double")
    levels = [["k", "m"], ["k"], ["m"]]
    out = O.cascade_impute(df, "v", levels)
    got = sorted(((r["k"], r["m"], r["v"]) for r in out.collect()), key=str)
    want = [("a", "x", 1.0), ("a", "x", 1.0), ("a", None, 1.0), (None, "y", 5.0), ("b", "y", 5.0), (None, None, None)] * 2
    assert got == sorted(want, key=str)
    fills = O.fit_cascade(df, ["v"], levels)
    plan = O.apply_cascade(df.repartition(3), ["v"], levels, fills)._jdf.queryExecution().analyzed().toString()
    assert plan.split("RepartitionByExpression")[0].split("Repartition 3")[0].count("Join") == 1
