import datetime as dt
import time

from pyspark.sql import functions as F

from tallyweave.operators.aggregates import profile_by_key
from tallyweave.operators.columns import child_feature_nulls, composite_index, well_filled
from tallyweave.plans import catalogue as G
from tallyweave.plans import country_index as K
from tallyweave.plans import images as I
from tallyweave.plans import rfm as M
from tallyweave.sources import readers as R
from tallyweave.sources import writers as W
from tallyweave.streaming import forms as S


def shop(spark):
    day = lambda d, h=0: dt.datetime(2018, 1, d, h)
    make = spark.createDataFrame
    stamps = "order_purchase_timestamp timestamp_ntz, order_estimated_delivery_date timestamp_ntz, order_delivered_customer_date timestamp_ntz"
    return M.Shop(
        customers=make([("c1", "u1", "0123", "SP"), ("c2", "u1", "0123", "SP"), ("c3", "u2", "9", "RJ")],
                       "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_state string"),
        orders=make(
            [("o9", "c1", "delivered", day(1), day(11), day(6, 12)), ("o1", "c2", "delivered", day(8), day(18), day(10)),
             ("o5", "c1", "canceled", day(20), day(25), None), ("o7", "c3", "shipped", day(3), day(9), None)],
            f"order_id string, customer_id string, order_status string, {stamps}"),
        items=make([("o9", "p1", 10.0, 1.0), ("o9", "p2", 20.0, 2.0), ("o1", "p1", 5.0, 0.5), ("o1", "p3", 7.0, 0.5), ("o5", "p1", 99.0, 9.0)],
                   "order_id string, product_id string, price double, freight_value double"),
        products=make([("p1", "t", 1), ("p2", "g", 2), ("p3", None, 3)], "product_id string, product_category_name string, product_photos_qty int"),
        translation=make([("t", "toys"), ("g", "music")], "product_category_name string, product_category_name_english string"),
        payments=make([("o9", "boleto", 15.0), ("o9", "voucher", 18.0), ("o1", "boleto", 13.0)], "order_id string, payment_type string, payment_value double"),
        reviews=make([("o9", 1), ("o9", 5), ("o1", 2)], "order_id string, review_score int"),
        places=make([("01", "SP", -23.0, -46.0), ("01", "SP", -24.0, -46.0), ("012", "SP", -20.0, -40.0)],
                    "geolocation_zip_code_prefix string, geolocation_state string, geolocation_lat double, geolocation_lng double"),
    )


def test_customer_table_does_not_multiply_items_by_payments(spark):
    table = {r["customer_unique_id"]: r for r in M.rfm_scores(M.rfm_table(shop(spark))).collect()}
    u1, u2 = table["u1"], table["u2"]
    assert u1["nb_all_purchases"] == 2 and u1["m"] == 42.0 and u1["average_amount"] == 21.0
    assert u1["last_order_id"] == "o1" and u1["last_amount"] == 12.0 and u1["last_nb_items"] == 2
    assert u1["all_purchases_categories"] == "music:20.0000,toys:15.0000" and u1["last_categories"] == "toys:5.0000"
    assert u1["all_purchases_payments"] == "boleto:28.0000,voucher:18.0000"
    assert u1["all_expected_delivery_delay"] == 10.0 and u1["all_effective_delivery_delay"] == (5.5 + 2) / 2
    assert round(u1["all_purchases_review_score"], 9) == round(8 / 3, 9) and u1["last_review_score"] == 2.0
    assert (u1["customer_latitude"], u1["r"]) == (-20.0, 0) and u1["f"] == 2 * 365 / 5
    assert u1["most_purchased_weekday"] == 0
    assert u2["r"] == 5 and u2["m"] is None and u2["customer_latitude"] is None


def test_date_bound_reaches_everything(spark):
    table = {r["customer_unique_id"]: r for r in M.rfm_table(shop(spark), to_date="2018-01-05 00:00:00").collect()}
    assert table["u1"]["all_purchases_amount"] == 30.0 and table["u1"]["last_order_id"] == "o9"
    assert table["u1"]["all_purchases_payments"] == "boleto:15.0000,voucher:18.0000"


def test_features_of_customers(spark):
    table = M.rfm_table(shop(spark))
    out = {r["customer_unique_id"]: r.asDict() for r in M.feature_table(table, prefixes=("all_cats_", "last_payment_"), scale=None).collect()}
    assert out["u1"]["all_cats_culture_leisure"] == 35.0 and out["u1"]["last_payment_cash"] == 13.0


def test_child_profiles(spark):
    child = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (None, 1.0)], "k int, v double")
    main = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    out = child_feature_nulls(main.join(profile_by_key(child, "k", "T"), "k", "left"))
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, 2, 2.0, 4.0, 3.0, 2.0, 6.0), (2, 1, 5.0, 5.0, 5.0, 0.0, 5.0), (3, 0, None, None, None, None, None)]


def test_half_filled_columns_stay(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, None), (3, None, None), (4, 2, 9)], "a int, half int, less int")
    assert well_filled(df) == ["a", "half"]


def test_country_steps(spark):
    wide = spark.createDataFrame([("FR", "X", 1.0, None, 3.0), ("FR", "Y", None, 2.0, None)], "c string, i string, `1999` double, `2000` double, `2101` double")
    long = K.unpivot_years(wide, ["c", "i"])
    assert sorted(tuple(r) for r in long.collect()) == [("FR", "X", 1999, 1.0), ("FR", "Y", 2000, 2.0)]
    df = spark.createDataFrame([("a", 50.0, 80.0, 10.0, 9.0, 4.0), ("b", 10.0, 20.0, 5.0, 16.0, 0.0)], "c string, pc double, net double, gdp double, ad double, yo double")
    out = {r["c"]: (r["person_index"], r["overall_index"]) for r in composite_index(df, "pc", "net", "gdp", "ad", "yo").collect()}
    assert out == {"a": (1.0, 1.0), "b": (0.0, 0.0)}
    young = spark.createDataFrame([(None, 10.0, 2.0, None, 6.0)], "h double, g double, p double, y double, t double")
    r = K.fill_indicators(young, "h", "g", "p", "y", "t").first()
    assert (r["h"], round(r["y"], 9)) == (5.0, 14.0)


def test_catalogue_cleans_to_consistent_complete_rows(spark):
    schema = ", ".join(
        ["row_id long", "code string", "product_name string", "brands_tags string", "main_category string", "food_groups_tags string",
         "pnns_groups_1 string", "pnns_groups_2 string", "nutriscore_grade string", "`energy_100g` double", "`energy-kcal_100g` double",
         "`fat_100g` double", "`saturated-fat_100g` double", "`carbohydrates_100g` double", "`sugars_100g` double",
         "`proteins_100g` double", "`salt_100g` double", "`sodium_100g` double"])
    base = lambda i, name, fat=10.0, sat=2.0, carb=20.0, sugar=5.0, g2="bread", grade="a", salt=1.0: (
        i, str(i), name, f"b{i}", "cat", "grp", "cereals", g2, grade, 4.18 * 250, 250.0, fat, sat, carb, sugar, 8.0, salt, salt / 2.5 if salt else 0.5)
    data = [base(i, f"loaf {i}") for i in range(6)]
    data += [base(10, "loaf 0", fat=250.0), base(11, "bad", fat=1.0, sat=50.0), base(12, "no grade", grade=None, fat=11.0), base(13, "no salt", salt=None)]
    data += [(0, "0", "loaf 0", "zz") + base(0, "x")[4:]]
    out = G.clean_catalogue(spark.createDataFrame(data, schema)).collect()
    got = {r["row_id"]: r.asDict() for r in out}
    assert got[10]["fat_100g"] == 10.0 and got[12]["nutriscore_grade"] == "a" and got[13]["salt_100g"] == 1.0
    assert got[11]["fat_100g"] == 10.0 and got[11]["saturated-fat_100g"] == 2.0
    assert len(out) == 10 and all(r["sugars_100g"] <= r["carbohydrates_100g"] for r in out)


def test_binary_files_and_projection(spark, tmp_path):
    for label, name, content in (("apple", "1", b"aaab"), ("apple", "2", b"aabb"), ("pear", "1", b"bbbbbb")):
        (tmp_path / label).mkdir(exist_ok=True)
        (tmp_path / label / f"{name}.jpg").write_bytes(content)
    (tmp_path / "pear" / "note.txt").write_text("x")
    files = R.read_binary(spark, str(tmp_path), "*.jpg")

    def load(_):
        return lambda blobs: [[b.count(b"a"), b.count(b"b"), len(b)] for b in blobs]

    features = I.featurised(files, load)
    model, projected = I.project(features, 2)
    flat = I.flat_table(projected, 2)
    assert flat.columns == ["path", "label", "label_index", "pca_1", "pca_2"]
    assert sorted((r["label"], r["label_index"]) for r in flat.collect()) == [("apple", 0.0), ("apple", 0.0), ("pear", 1.0)]
    W.save_model(model, str(tmp_path / "model"))
    assert W.load_pipeline(str(tmp_path / "model")).transform(features).count() == 3


def test_cached_dataset_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert R.cached_dataset(spark, str(tmp_path / "d"), build).count() == 3
    assert len(calls) == 1


def test_one_file_csv_takes_any_number_of_rows(spark, tmp_path):
    W.write_csv_single(spark.range(20), str(tmp_path / "x"))
    assert len(list((tmp_path / "x").glob("part-*.csv"))) == 1
    assert spark.read.csv(str(tmp_path / "x"), header=True).count() == 20



def test_late_records_are_dropped_and_weeks_equal_the_batch(spark, tmp_path):
    first = [(dt.datetime(2024, 1, 1, 10), 1.0), (dt.datetime(2024, 2, 20), 2.0)]
    middle = [(dt.datetime(2024, 2, 20, 1), 3.0)]
    late = [(dt.datetime(2024, 1, 1, 11), 5.0), (dt.datetime(2024, 2, 20, 2), 4.0)]
    for i, part in enumerate((first, middle, late)):
        spark.createDataFrame(part, "ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(str(tmp_path / f"e{i}"))
        time.sleep(1.1)  # files are taken in order of their time
    schema = spark.read.parquet(str(tmp_path / "e0")).schema
    stream = S.read_events(spark, str(tmp_path / "e*"), schema, files_per_batch=1)
    out = S.run_to_table(S.weekly_totals(stream, "ts", "v"), "weekly", ["week"])
    got = {str(r["week"]): (r["n"], r["total"]) for r in out.collect()}
    assert got == {"2024-01-01": (1, 1.0), "2024-02-26": (3, 9.0)}
    assert S.run_to_table(S.customer_figures(stream.withColumn("u", F.lit(1)), "u", "ts", "v"), "f", ["u"]).first()["frequency"] == 5


def test_cluster_stability_of_every_week(spark, monkeypatch):
    """All 29 weeks come from the query, and one job gives the index that each week has by itself."""
    from tallyweave.operators.evaluation import adjusted_rand_index, adjusted_rand_indices
    from tallyweave.plans.stability import cluster_stability
    from tallyweave.suite import learning

    asked = []
    monkeypatch.setattr(learning, "shop", lambda t: t)
    monkeypatch.setattr(learning.ST, "cluster_stability", lambda until, key, start, weeks: asked.extend(weeks))
    learning.ml_cluster_stability(None)
    assert asked == list(range(1, 30))

    start = dt.datetime(2020, 1, 1)

    def until(date):
        week = (date - start).days // 7
        moved = F.when(F.col("id") < 4 * week, 9.0).otherwise(0.0)
        return spark.range(40 + week).select("id", ((F.col("id") % 2) * 5.0 + moved).alias("x"), (F.col("id") % 2).cast("double").alias("y"))

    got = {r["week"]: (r["ari"], r["n"]) for r in cluster_stability(until, "id", start, range(0, 4), components=2, clusters=2).collect()}
    assert sorted(got) == [0, 1, 2, 3] and got[0] == (1.0, 40) and all(n == 40 for _, n in got.values())

    pairs = spark.range(60).select((F.col("id") % 3).alias("w"), (F.col("id") % 4).alias("p"), (F.col("id") % 7 % 3).alias("r"))
    for row in adjusted_rand_indices(pairs, "w", "p", "r").collect():
        alone = adjusted_rand_index(pairs.where(F.col("w") == row["w"]), "p", "r").first()
        assert (round(row["ari"], 12), row["n"]) == (round(alone["ari"], 12), alone["n"])


def test_catalogue_stage_replaces_what_it_was_made_from(spark):
    from tallyweave.session import staged, staged_paths

    first = staged(spark.range(5).toDF("id"), "first")
    kept = set(staged_paths())
    df = G.replaced(first.withColumns({"x": F.col("id").cast("double"), "g": F.lit("a")}), "one", kept)
    df = G.repair_rule(df, F.col("x") > 3, ("x",), ("g",), kept)
    assert len(set(staged_paths()) - kept) == 1 and first.count() == 5
    assert sorted(r["x"] for r in df.collect()) == [0.0, 1.0, 1.5, 2.0, 3.0]


def test_customer_history_gives_the_table_of_each_date(spark):
    tables = shop(spark)
    history = M.rfm_history(tables, "2018-02-01")
    for date in ("2018-01-02 12:00:00", "2018-01-31"):
        got, want = history(date), M.rfm_table(tables, to_date=date)
        assert got.columns == want.columns and want.count() > 0
        key = lambda r: r["customer_unique_id"]
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
