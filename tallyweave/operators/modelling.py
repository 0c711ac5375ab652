"""Regression and classification grids on a numeric feature list."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.numeric import clip
from tallyweave.operators.columns import q
from tallyweave.operators.evaluation import chosen_thresholds, fold_costs
from tallyweave.operators.neighbours import nearest
from tallyweave.operators.quantiles import group_medians
from tallyweave.operators.sampling import unit_hash
from tallyweave.session import spread, staged


def assembled(df: DataFrame, features) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features_vec", handleInvalid="skip").transform(df)


def folded(df: DataFrame, row_id: str, folds: int = 5) -> DataFrame:
    """Fold number by id hash: the same folds for every estimator and every rerun."""
    return df.withColumn("fold", F.floor(unit_hash(row_id, "fold") * folds).cast("int"))


def regressors(seed: int = 0) -> dict:
    """Name -> (estimator, parameter grid)."""
    linear = LinearRegression(featuresCol="features_vec", labelCol="label")
    # From the moments of the columns, one pass over the rows a fit; the iterative solver passes once a step.
    elastic = LinearRegression(featuresCol="features_vec", labelCol="label", solver="normal")
    forest = RandomForestRegressor(featuresCol="features_vec", labelCol="label", seed=seed)
    boosting = GBTRegressor(featuresCol="features_vec", labelCol="label", seed=seed, maxIter=10)
    grid = ParamGridBuilder
    return {
        "linear": (linear, grid().addGrid(linear.fitIntercept, [True, False]).build()),
        "elasticnet": (
            elastic,
            grid().addGrid(elastic.regParam, [0.01, 1.0]).addGrid(elastic.elasticNetParam, [0.0, 0.5]).build(),
        ),
        "randomforest": (forest, grid().addGrid(forest.numTrees, [20]).addGrid(forest.maxDepth, [5]).build()),
        "boosting": (boosting, grid().addGrid(boosting.maxDepth, [3]).build()),
    }


def scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: r2, rmse, n."""
    y, p = q(truth).cast("double"), q(predicted).cast("double")
    sums = df.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("var"), F.count(F.lit(1)).alias("n")
    )
    return sums.select((1 - F.try_divide(F.col("mse"), F.col("var"))).alias("r2"), F.sqrt("mse").alias("rmse"), "n")


def regression_grid(
    train: DataFrame,
    test: DataFrame,
    row_id: str,
    target: str,
    features,
    use_log: bool = False,
    bounds: tuple[float, float] | None = None,
    names=("baseline", "knn", "linear", "elasticnet", "randomforest", "boosting"),
    folds: int = 5,
    neighbours: int = 5,
    parallelism: int = 4,
) -> DataFrame:
    """(estimator, r2, rmse, n) on the test rows for the best grid point of each estimator.

    ``use_log`` trains on log1p(target) and inverts with expm1; predictions are clipped to ``bounds``.
    """
    y = F.log1p(q(target)) if use_log else q(target).cast("double")
    prepare = lambda d: assembled(d.select(row_id, target, *[q(f) for f in features]), features).withColumn("label", y)
    train_x, test_x = folded(prepare(spread(train, row_id)), row_id, folds).cache(), prepare(test)

    def finish(df: DataFrame):
        p = F.expm1("prediction") if use_log else F.col("prediction")
        if bounds is not None:
            p = clip(p, *bounds)
        return df.withColumn("prediction", p)

    out = None
    for name in names:
        if name == "baseline":
            middle = group_medians(train_x, [], ["label"])
            predicted = test_x.withColumn("prediction", middle.scalar())
        elif name == "knn":
            vectors = lambda d: d.select(row_id, vector_to_array("features_vec").alias("v"))
            near = nearest(vectors(test_x), vectors(train_x).withColumnRenamed(row_id, "ref"), neighbours, row_id, "ref", "v")
            known = train_x.select(q(row_id).alias("ref"), "label")
            means = near.join(known, "ref").groupBy(row_id).agg(F.avg("label").alias("prediction"))
            predicted = test_x.join(means, row_id)
        else:
            estimator, grid = regressors()[name]
            search = CrossValidator(
                estimator=estimator,
                estimatorParamMaps=grid,
                evaluator=RegressionEvaluator(labelCol="label", metricName="r2"),
                numFolds=folds,
                foldCol="fold",
                parallelism=parallelism,
            )
            predicted = search.fit(train_x).transform(test_x)
        row = scores(finish(predicted), target, "prediction").select(F.lit(name).alias("estimator"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def stacked(train: DataFrame, test: DataFrame, first_target: str, first_features, target: str, features) -> DataFrame:
    """Test rows with ``first`` (prediction of the first target) and ``prediction`` of the second, which uses ``first``."""
    one = LinearRegression(featuresCol="features_vec", labelCol=first_target, predictionCol="first").fit(assembled(train, first_features))
    with_first = lambda d: one.transform(assembled(d, first_features)).drop("features_vec")
    two = LinearRegression(featuresCol="features_vec", labelCol=target).fit(assembled(with_first(train), [*features, "first"]))
    return two.transform(assembled(with_first(test), [*features, "first"])).drop("features_vec")


def weighted_classifier(train: DataFrame, test: DataFrame, row_id: str, target: str, features, iterations: int = 10):
    """(model, scored test rows): boosted trees, classes weighted to equal totals; ``score`` is P(class 1)."""
    positives = train.agg(F.avg(q(target).cast("double"))).first()[0] or 0.5
    weight = F.when(q(target) == 1, 0.5 / max(positives, 1e-9)).otherwise(0.5 / max(1 - positives, 1e-9))
    ready = assembled(spread(train, row_id), features).withColumns({"label": q(target).cast("double"), "w": weight})
    model = GBTClassifier(featuresCol="features_vec", labelCol="label", weightCol="w", maxIter=iterations, maxDepth=3, seed=0).fit(ready)
    scored = model.transform(assembled(test, features).withColumn("label", q(target).cast("double")))
    return model, scored.withColumn("score", vector_to_array("probability")[1]).select(row_id, "label", "score", "prediction", "rawPrediction", "probability")


def classification_scores(scored: DataFrame) -> DataFrame:
    """One row: auc, f1, log_loss of scored rows (label, score, prediction)."""
    auc = BinaryClassificationEvaluator(labelCol="label").evaluate(scored)
    f1 = MulticlassClassificationEvaluator(labelCol="label", metricName="f1").evaluate(scored)
    p = clip("score", 1e-15, 1 - 1e-15)
    loss = -F.avg(F.col("label") * F.log(p) + (1 - F.col("label")) * F.log(1 - p))
    return scored.agg(F.lit(float(auc)).alias("auc"), F.lit(float(f1)).alias("f1"), loss.alias("log_loss"))


def cross_validated_auc(df: DataFrame, row_id: str, target: str, features, folds: int = 5, miss: float = 10, alarm: float = 1) -> DataFrame:
    """(fold, auc, f1, log_loss, threshold, cost) of the weighted classifier.

    ``cost`` is ``miss`` per positive below the threshold and ``alarm`` per negative at or above it, for the cheapest
    threshold of the fold's held-out rows.
    """
    parts, out = folded(df, row_id, folds), None
    for i in range(folds):
        _, scored = weighted_classifier(parts.filter(F.col("fold") != i), parts.filter(F.col("fold") == i), row_id, target, features)
        scored = staged(scored.withColumn("fold", F.lit(i)), "scored")
        best = chosen_thresholds(fold_costs(scored, "fold", "score", "label", miss=miss, alarm=alarm)).filter("fold IS NOT NULL")
        row = classification_scores(scored).select(F.lit(i).alias("fold"), "*").join(best.select("fold", "threshold", "cost"), "fold")
        out = row if out is None else out.unionByName(row)
    return out
