"""Association measures between columns."""

from __future__ import annotations

import math
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.numeric import effect_label
from tallyweave.operators.columns import q


def correlation_pairs(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of each pair of columns, one pass: (a, b, corr)."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(q(a).cast("double"), q(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def eta_squared(df: DataFrame, klass: str, columns) -> DataFrame:
    """Between-class share of the sum of squares per numeric column, with its wording."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("value")) for c in columns])
    )
    long = df.filter(q(klass).isNotNull()).select(q(klass).alias("klass"), cells.alias("cell")).select("klass", "cell.*")
    # Per class: size, mean and inner sum of squares; both totals follow from them.
    classes = long.filter(F.col("value").isNotNull()).groupBy("column", "klass").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("inner"),
    )
    grand = classes.groupBy("column").agg(
        (F.var_pop("mean")).alias("_spread"),
        F.sum("inner").alias("inner"),
        F.sum("n").alias("rows"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
    )
    between = (
        classes.join(grand.select("column", "grand"), "column")
        .groupBy("column")
        .agg(F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"))
    )
    out = grand.join(between, "column").withColumn(
        "eta2", F.coalesce(F.try_divide(F.col("between"), F.col("between") + F.col("inner")), F.lit(0.0))
    )
    return out.select("column", "rows", "eta2", effect_label("eta2").alias("effect"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts in long form (a, b, n), zero cells left out."""
    return df.groupBy(q(a), q(b)).agg(F.count(F.lit(1)).alias("n"))


def chi2_survival(x: float, dof: float) -> float:
    """P(X > x) of the chi squared distribution: the upper regularised incomplete gamma function."""
    if dof <= 0 or x <= 0:
        return 1.0
    a, x = dof / 2, x / 2
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # power series of the lower part
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return 1 - scale * total
    # continued fraction of the upper part, from the tail inwards
    fraction = 0.0
    for n in range(2000, 0, -1):
        fraction = n * (n - a) / (x + 2 * n + 1 - a - fraction)
    return scale / (x + 1 - a - fraction)


def chi_square(df: DataFrame, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """Chi squared, degrees of freedom, p-value and verdict of independence.

    All steps after the contingency count run on at most |a| x |b| rows. Cells
    with no rows add their expected count, which the row totals give without
    listing the cells: sum of all expected counts = n.
    """
    pairs = df.select(q(a).cast("string").alias("a"), q(b).cast("string").alias("b")).dropna()
    cells = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("na"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("nb"))
    total = cells.agg(F.sum("n")).scalar()
    seen = cells.join(rows, "a").join(cols, "b").withColumn("e", F.col("na") * F.col("nb") / total)
    stat = seen.agg(
        # sum (n - e)^2 / e over all cells = sum n^2 / e - total, with the sum over seen cells only
        F.sum(F.col("n") * F.col("n") / F.col("e")).alias("_s"),
        F.sum("n").alias("rows"),
        (F.count_distinct("a") - 1).alias("_ra"),
        (F.count_distinct("b") - 1).alias("_rb"),
    ).select(
        (F.col("_s") - F.col("rows")).alias("chi2"), (F.col("_ra") * F.col("_rb")).alias("dof"), "rows"
    )
    survival = F.pandas_udf(lambda x, k: pd.Series([chi2_survival(*v) for v in zip(x, k, strict=True)]), "double")
    out = stat.withColumn("p_value", survival("chi2", F.col("dof").cast("double")))  # a single row
    return out.withColumn(
        "verdict", F.when(F.col("p_value") < alpha, "dependent").otherwise("independent")
    )
