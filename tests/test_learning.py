import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallyweave.operators import association as S
from tallyweave.operators import clustering as K
from tallyweave.operators import evaluation as E
from tallyweave.operators import features as FE
from tallyweave.operators import modelling as ML
from tallyweave.operators import textfeatures as T
from tallyweave.plans.catalogue import chained_regression


def test_corrected_moments(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 5, 40)], "v double")
    r = FE.corrected_moments(df, ["v"]).first()
    assert r["skew"] == pytest.approx(2.1929, abs=1e-4) and r["kurtosis"] == pytest.approx(4.8368, abs=1e-4)


def test_stages_save_and_load(spark, tmp_path):
    df = spark.createDataFrame(
        [(1.0, 4.0, "x"), (2.0, 4.0, "y"), (None, 4.0, None), (400.0, 4.0, "y"), (5.0, 4.0, "y")], "a double, b double, c string"
    )
    stages = [
        FE.SimpleImpute(columns=["a", "c"]),
        FE.LogSkewed(columns=["a", "b"]),
        FE.Scale(columns=["a", "b"], method="minmax"),
        FE.OneHot(columns=["c"]),
    ]
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    out = loaded.transform(df)
    assert out.columns == ["a", "b", "c[x]", "c[y]"]
    got = [tuple(r) for r in out.collect()]
    assert got == [tuple(r) for r in model.transform(df).collect()]
    assert all(r[1] == 0.0 for r in got) and got[2][2:] == (0, 1)
    fill = (np.log1p(3.5) - np.log1p(1)) / (np.log1p(400) - np.log1p(1))
    assert got[2][0] == pytest.approx(fill)


def test_unknown_values_are_all_zero(spark):
    train = spark.createDataFrame([("x",), ("y",)], "c string")
    out = FE.OneHot(columns=["c"]).fit(train).transform(spark.createDataFrame([("z",), (None,), ("y",)], "c string"))
    assert [tuple(r) for r in out.collect()] == [(0, 0), (0, 0), (0, 1)]


def test_eta_squared(spark):
    df = spark.createDataFrame([("p", 1.0, 1.0), ("p", 1.0, 3.0), ("q", 3.0, 1.0), ("q", 3.0, 3.0)], "k string, a double, b double")
    got = {r["column"]: (r["eta2"], r["effect"]) for r in S.eta_squared(df, "k", ["a", "b"]).collect()}
    assert got == {"a": (1.0, "large"), "b": (0.0, "negligible")}


def test_chi_square_with_empty_cells(spark):
    cells = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 5, ("c", "y"): 7}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "a string, b string")
    r = S.chi_square(df, "a", "b").first()
    table = np.array([[10, 20], [30, 5], [0, 7]], dtype=float)
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    chi2 = ((table - expected) ** 2 / expected).sum()
    assert r["chi2"] == pytest.approx(chi2) and r["dof"] == 2
    assert r["p_value"] == pytest.approx(np.exp(-chi2 / 2), rel=1e-6)  # two degrees of freedom
    assert r["verdict"] == "dependent"


def test_rand_index(spark):
    df = spark.createDataFrame([(0, "b", 1), (0, "b", 2), (1, "a", 1), (1, "a", 2)], "x int, y string, z int")
    assert E.adjusted_rand_index(df, "x", "y").first()["ari"] == 1.0
    there, back = E.adjusted_rand_index(df, "x", "z").first()["ari"], E.adjusted_rand_index(df, "z", "x").first()["ari"]
    assert there == back == pytest.approx(-0.5)


def test_cost_threshold(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.9, 0)], "s double, y int")
    costs = E.business_cost(df, "s", "y", bins=10)
    best = E.best_threshold(costs).first()
    assert (best["threshold"], best["cost"]) == (0.2, 2.0)
    at = {round(r["threshold"], 1): (r["missed"], r["false_alarms"]) for r in costs.collect()}
    assert at[0.0] == (0, 3) and at[0.8] == (1, 1) and at[1.0] == (2, 0)


def test_no_drift_between_equal_tables(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    same = E.drift(df, df, ["v"]).first()
    moved = E.drift(df, df.select((F.col("v") + 15).alias("v")), ["v"]).first()
    assert same["psi"] == 0.0 and same["ks"] == 0.0 and moved["psi"] > 0.2 and moved["ks"] > 0.3


def test_projection(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(200, 3)) @ np.diag([5.0, 1.0, 0.1]) + 10
    df = spark.createDataFrame([([float(x) for x in v],) for v in data], "x array<double>")
    p = K.Projection("x", 2).fit(df)
    shares = [r["explained"] for r in p.variance(df).collect()]
    values = np.sort(np.linalg.eigvalsh(np.cov(data.T)))[::-1]
    assert shares == pytest.approx((values / values.sum())[:2])
    out = np.array([r["pca"] for r in p.transform(df).collect()])
    assert np.abs(out.mean(axis=0)).max() < 1e-9
    full = K.Projection("x", 3).fit(df)
    back = full.inverse(full.transform(df)).collect()
    assert max(abs(a - b) for r in back for a, b in zip(r["x"], r["restored"], strict=True)) < 1e-9


def test_kmeans_cost_does_not_rise(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([([float(x) for x in v],) for v in rng.normal(size=(120, 2))], "x array<double>")
    costs = [r["inertia"] for r in K.kmeans_scan(df, "x", [2, 4, 8]).orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2]


def test_tfidf_vectors_equal_the_relational_form(spark):
    df = spark.createDataFrame([(1, "red mug mug"), (2, "red pan"), (3, "blue pan lid")], "id int, text string")
    words = F.split("text", " ")
    long = {(r["id"], r["term"]): r["weight"] for r in T.tf_idf(df, "id", words).collect()}
    model = T.tfidf_model().fit(df.withColumn("tokens", words))
    vocabulary = model.stages[0].vocabulary
    for r in T.smooth_vectors(model.transform(df.withColumn("tokens", words))).collect():
        for term, weight in zip(vocabulary, r["tfidf"].toArray(), strict=True):
            assert long.get((r["id"], term), 0.0) == pytest.approx(weight)


def test_tfidf_of_common_and_rare_terms(spark, monkeypatch):
    """Terms beyond the most frequent take the other way and weigh the same; rows of one id are one document."""
    rows = [(i % 20, f"all some{i % 3} own{i}" + " few" * (i % 7 == 0)) for i in range(40)] + [(None, "all own1"), (77, None), (78, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    words = F.split("text", " ")
    whole = {(r["id"], r["term"]): r["weight"] for r in T.tf_idf(df, "id", words).collect()}
    monkeypatch.setattr(T, "COMMON_TERMS", 4)
    parts = {(r["id"], r["term"]): r["weight"] for r in T.tf_idf(df, "id", words).collect()}
    assert parts == pytest.approx(whole) and (None, "all") not in whole
    held = {(i, w) for i, text in rows if i is not None and text is not None for w in text.split(" ")}
    assert set(whole) == held


def test_chained_regression(spark):
    data = [(float(i), 2.0 * i + 1) for i in range(10)] + [(None, 41.0), (30.0, None), (None, None)]
    df = spark.createDataFrame(data, "a double, b double")
    out = [tuple(r) for r in chained_regression(df, "a", "b", 50).collect()]
    assert out[:10] == data[:10] and out[12] == (None, None)
    assert out[10][0] == pytest.approx(20.0, abs=1e-3) and out[11][1] == pytest.approx(61.0, abs=1e-3)


def test_regression_scores_and_clipping(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"))
    df = df.withColumn("t", F.col("x") * 3 + 1)
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    got = {
        r["estimator"]: r
        for r in ML.regression_grid(train, test, "id", "t", ["x"], bounds=(0.0, 50.0), names=("baseline", "knn", "linear"), folds=2).collect()
    }
    assert got["baseline"]["r2"] <= 0 and got["knn"]["r2"] > 0.9 and got["linear"]["r2"] > 0.95
    assert got["linear"]["n"] == 100


def test_elastic_net_takes_one_pass_and_finds_the_optimum(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = x @ [3.0, 0.02] + 1 + rng.normal(size=300) * 0.1
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, label double")
    elastic, grid = ML.regressors()["elasticnet"]
    assert elastic.getSolver() == "normal" and len(grid) == 4
    rows = ML.assembled(df, ["a", "b"])
    for params in grid:
        # The solvers scale the penalty by deviations over n and n - 1 rows.
        one, steps = (elastic.copy({elastic.solver: solver}).fit(rows, params) for solver in ("normal", "l-bfgs"))
        assert np.allclose(one.coefficients.toArray(), steps.coefficients.toArray(), rtol=1e-2) and abs(one.intercept - steps.intercept) < 1e-2


def chained_plain(rows, rounds):
    """The same rounds over whole rows."""
    import numpy as np

    known = [(a, b) for a, b in rows if a is not None or b is not None]
    mean = lambda values: sum(values) / len(values)
    ka, ca, kb, cb = 0.0, mean([a for a, _ in known if a is not None]), 0.0, mean([b for _, b in known if b is not None])

    def fit(x, y):
        k = np.cov(x, y, bias=True)[0, 1] / np.var(x)
        return k, np.mean(y) - k * np.mean(x)

    for _ in range(rounds):
        full = [(a, b if b is not None else kb * a + cb) for a, b in known if a is not None]
        ka, ca = fit([b for _, b in full], [a for a, _ in full])
        full = [(a if a is not None else ka * b + ca, b) for a, b in known if b is not None]
        kb, cb = fit([a for a, _ in full], [b for _, b in full])
    fill = lambda a, b: (a if a is not None else ka * b + ca if b is not None else None, b if b is not None else kb * a + cb if a is not None else None)
    return [fill(a, b) for a, b in rows]


def test_chained_regression_equals_rounds_over_rows(spark):
    import random

    import pytest

    from tallyweave.plans.catalogue import chained_regression

    draw = random.Random(3)
    rows = []
    for _ in range(200):
        a = draw.gauss(1000, 3)
        b = 2 * a + draw.gauss(0, 4)
        rows.append((a if draw.random() < 0.7 else None, b if draw.random() < 0.6 else None))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a double, b double")
    for rounds in (1, 10):
        got = {r["id"]: (r["a"], r["b"]) for r in chained_regression(df, "a", "b", rounds).collect()}
        for i, (a, b) in enumerate(chained_plain(rows, rounds)):
            assert got[i] == (None if a is None else pytest.approx(a, rel=1e-9), None if b is None else pytest.approx(b, rel=1e-9))
    empty = df.filter("id < 0")
    assert chained_regression(empty, "a", "b").count() == 0
    alone = df.select("id", "a", F.lit(None).cast("double").alias("b"))
    assert chained_regression(alone, "a", "b").filter("b IS NOT NULL").count() == 0


def test_group_imputer_saves_and_loads(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from tallyweave.operators.features import GroupImpute, GroupImputeModel

    df = spark.createDataFrame(
        [("a", "x", 1.0, "u"), ("a", "x", 3.0, "u"), ("a", "y", None, None), ("b", "y", 9.0, "v"), (None, "y", None, None)],
        "k string, l string, v double, t string",
    )
    stage = GroupImpute(["v", "t"], [["k", "l"], ["k"], ["l"]], last_wins=True)
    stage.write().overwrite().save(f"{tmp_path}/stage")
    again = GroupImpute.load(f"{tmp_path}/stage")
    assert (again.uid, again.targets, again.levels, again.last_wins) == (stage.uid, ["v", "t"], [["k", "l"], ["k"], ["l"]], True)
    model = Pipeline(stages=[stage]).fit(df)
    model.write().overwrite().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    assert isinstance(loaded.stages[0], GroupImputeModel) and loaded.stages[0].uid == model.stages[0].uid
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, loaded.transform(df).collect()), key=key) == sorted(map(tuple, model.transform(df).collect()), key=key)


def test_csv_catalog_lists_a_folder(spark, tmp_path):
    from tallyweave.sources.readers import list_files, register_csv_catalog

    (tmp_path / "shop_one_dataset.csv").write_text('id,name\n1,"a ""b"""\n1,"a ""b"""\n2,c\n')
    (tmp_path / "shop_two.csv").write_text("x\n5\n")
    (tmp_path / "notes.txt").write_text("no table")
    views = register_csv_catalog(spark, str(tmp_path), "shop_", schemas={"two": "x int"})
    assert sorted(views) == ["one", "two"]
    assert sorted(map(tuple, spark.table("one").collect())) == [("1", 'a "b"'), ("2", "c")]
    assert spark.table("two").schema["x"].dataType.simpleString() == "int"
    assert list_files(spark, f"{tmp_path}/none") == [] and register_csv_catalog(spark, f"{tmp_path}/none") == {}


def test_topic_model_finds_planted_topics_and_gains_every_round(spark):
    import random

    draw = random.Random(1)
    words = {t: [f"{t}{i}" for i in range(12)] for t in "abc"}
    rows = [(i, w) for i in range(90) for w in draw.choices(words["abc"[i % 3]], k=30) + draw.choices(words[draw.choice("abc")], k=3)]
    bag = spark.createDataFrame(rows, "doc long, term string").groupBy("doc", "term").agg(F.count(F.lit(1)).alias("n"))
    docs, terms, fits = T.topic_model(bag, "doc", 3, iterations=10)
    assert len(fits) == 10 and all(b >= a - 1.0 for a, b in zip(fits, fits[1:], strict=False)) and fits[-1] > fits[0]
    shares = {r["doc"]: r["shares"] for r in docs.collect()}
    assert len(shares) == 90 and all(abs(sum(s) - 1) < 1e-9 and min(s) > 0 for s in shares.values())
    top = {d: s.index(max(s)) for d, s in shares.items()}
    groups = [{top[d] for d in range(90) if d % 3 == g} for g in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    weights = terms.collect()
    assert len(weights) == 36 and all(abs(sum(r["weights"][i] for r in weights) - 1) < 1e-9 for i in range(3))
    heavy = T.heaviest_terms(terms, 10).collect()
    assert len(heavy) == 30 and all(len({r["term"][0] for r in heavy if r["topic"] == i}) == 1 for i in range(3))
    again = {r["doc"]: r["shares"] for r in T.topic_model(bag.repartition(7), "doc", 3, iterations=10)[0].collect()}
    assert all(np.allclose(again[d], shares[d]) for d in shares)


def test_topic_blocks_of_any_size_give_the_same(spark, monkeypatch):
    rows = [(f"d{i % 23}" if i % 29 else None, f"t{i * i % 31}", 1 + i % 4) for i in range(300)]
    bag = spark.createDataFrame(rows, "doc string, term string, n long")

    def model():
        docs, terms, fits = T.topic_model(bag, "doc", 3, iterations=4)
        return {r["doc"]: r["shares"] for r in docs.collect()}, {r["term"]: r["weights"] for r in terms.collect()}, fits

    one = model()
    monkeypatch.setattr(T, "BLOCK_ROWS", 40)
    many = model()
    assert set(one[0]) == set(many[0]) == {f"d{i}" for i in range(23)} and set(one[1]) == set(many[1])
    assert all(np.allclose(one[i][key], many[i][key]) for i in (0, 1) for key in one[i]) and np.allclose(one[2], many[2])


def test_topic_model_of_nothing(spark):
    docs, terms, fits = T.topic_model(spark.createDataFrame([], "doc long, term string, n long"), "doc", 3)
    assert docs.count() == terms.count() == 0 and fits == []


def test_fold_costs_merge_to_those_of_all_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i % 3), float(s), int(rng.random() < s)) for i, s in enumerate(rng.random(300))] + [(0, None, 1), (1, 0.5, None)]
    df = spark.createDataFrame(rows, "fold int, score double, y int")
    costs = E.fold_costs(df, "fold", "score", "y", bins=20, miss=7, alarm=2)
    got = {(r["fold"], round(r["threshold"] * 20)): (r["missed"], r["false_alarms"], r["cost"]) for r in costs.collect()}
    assert len(got) == 4 * 21
    known = [r for r in rows if None not in r]
    for fold in (None, 0, 1, 2):
        part = [(min(20, int(s * 20)), y) for f, s, y in known if fold is None or f == fold]
        for k in range(21):
            missed, alarms = sum(y for b, y in part if b < k), sum(1 - y for b, y in part if b >= k)
            assert got[fold, k] == (missed, alarms, 7 * missed + 2 * alarms)
    for r in E.chosen_thresholds(costs).collect():
        assert (r["cost"], round(r["threshold"] * 20)) == min((c, k) for (f, k), (_, _, c) in got.items() if f == r["fold"])


def test_rates_come_from_other_folds_alone(spark):
    rows = [(0, "a", 1), (0, "a", 0), (1, "a", 1), (1, "b", 0), (2, "b", 1), (2, None, 1), (0, None, None), (1, "c", 1)]
    got = E.out_of_fold_rates(spark.createDataFrame(rows, "f int, k string, y int"), "f", ["k"], "y").collect()
    assert len(got) == len(rows)
    for r in got:
        others = [(k, y) for f, k, y in rows if f != r["f"] and y is not None]
        same = [y for k, y in others if k == r["k"]] or [y for _, y in others]
        assert abs(r["score"] - sum(same) / len(same)) < 1e-12


def test_word_vectors_stay_off_the_driver(spark, monkeypatch):
    """Words that share contexts lie together; blocks are averaged; the driver is sent no vector."""
    monkeypatch.setattr(T, "BLOCK_WORDS", 12_000)
    monkeypatch.setattr(T, "RUN", 20)
    rng = np.random.default_rng(1)
    topics = [[f"{name}{i}" for i in range(6)] for name in ("sea", "hill")]
    texts = [[str(w) for w in rng.choice(topics[i % 2], 12)] for i in range(3_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9_000, []), (9_001, None), (9_002, ["once"]), (9_003, ["sea0", "once"]), (9_003, ["sea0"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    words, docs = T.word_vectors(df, "tokens", size=16, partitions=2)
    v = {r["word"]: np.array(r["vector"]) for r in words.collect()}
    assert set(v) == {w for t in topics for w in t} | {"once"}
    alike = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    centre = np.mean([x for w, x in v.items() if w != "once"], axis=0)
    near = lambda other: alike(v["sea0"] - centre, v[other] - centre)
    assert np.mean([near(f"sea{i}") for i in range(1, 6)]) > 0.4 > -0.4 > np.mean([near(f"hill{i}") for i in range(6)])
    got = docs.collect()
    assert len(got) == len(rows) and docs.columns == ["id", "tokens", "doc_vector"]
    for r in got:
        want = sum((v[t] for t in r["tokens"] or []), np.zeros(16)) / max(1, len(r["tokens"] or []))
        assert np.allclose(r["doc_vector"], want, atol=1e-6)
    # A fitted MLlib model would hold all vectors at the driver.
    assert not hasattr(words, "getVectors")


def test_word_vectors_of_one_block_by_single_pairs(monkeypatch):
    """Runs of one word, neighbours of reach one, no negative samples: equal to a loop over pairs."""
    monkeypatch.setattr(T, "RUN", 1)
    at, doc = np.array([0, 1, 2, 1, 0]), np.array([0, 0, 0, 1, 1])
    start = T._starts(np.arange(3), 4)
    assert np.abs(start).max() <= 0.125 and (T._starts(np.array([2]), 4)[0] == start[2]).all()
    want, other = start.astype("float64"), np.zeros((3, 4))
    for i in range(5):
        step, mine = 0.5 * (1 - i / 5), want[at[i]].copy()
        pairs = [j for j in (i - 1, i + 1) if 0 <= j < 5 and doc[j] == doc[i]]
        pull = {j: step * (1 - 1 / (1 + np.exp(-(mine @ other[at[j]])))) for j in pairs}
        want[at[i]] += sum(pull[j] * other[at[j]] for j in pairs)
        for j in pairs:
            other[at[j]] += pull[j] * mine
    got = T._skip_grams(at, doc, start.copy(), [0, 1], window=1, negatives=0, rate=0.5)
    assert np.abs(got - start).max() > 1e-4 and np.allclose(got, want, atol=1e-6)


def test_topic_rounds_leave_no_bag_behind(spark):
    from tallyweave.session import staged_paths

    before = set(staged_paths())
    bag = spark.createDataFrame([(i % 9, f"w{i % 7}", 1 + i % 3) for i in range(63)], "d long, term string, n int")
    docs, _, fits = T.topic_model(bag.groupBy("d", "term").agg(F.sum("n").alias("n")), "d", 2, iterations=3)
    left = sorted(p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in set(staged_paths()) - before)
    assert left == ["blocks", "terms", "topic-terms", "topics"] and len(fits) == 3 and docs.count() == 9


def test_word_vectors_store_no_vectors_of_blocks(spark):
    from tallyweave.session import staged, staged_paths

    texts = [(i, ["a", "b", f"c{i % 4}"] * 5) for i in range(40)]
    before = set(staged_paths())
    df = staged(spark.createDataFrame(texts, "d int, tokens array<string>"), "tokens")
    words, docs = T.word_vectors(df, "tokens", size=8, partitions=3, spent=staged_paths()[-1:])
    left = sorted(p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in set(staged_paths()) - before)
    assert left == ["word-blocks", "word-rows", "word-vectors"]
    assert words.count() == 6 and docs.filter(F.size("doc_vector") == 8).count() == 40
