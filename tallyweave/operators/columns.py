"""Column selection and row-wise updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.numeric import exact_sum, rescale_mass
from tallyweave.session import staged

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def q(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, but=()) -> list[str]:
    return [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c not in but]


def drop_by_suffix(df: DataFrame, suffixes) -> DataFrame:
    return df.select(*[q(c) for c in df.columns if not c.endswith(tuple(suffixes))])


def keep_columns(df: DataFrame, exact=(), prefixes=()) -> DataFrame:
    """Listed columns plus those that start with a prefix, in frame order."""
    keep = [c for c in df.columns if c in exact or (prefixes and c.startswith(tuple(prefixes)))]
    return df.select(*[q(c) for c in keep])


def fill_shares(df: DataFrame) -> dict[str, float]:
    """Share of non-null cells per column: one pass, one result row."""
    row = df.agg(*[F.avg(q(c).isNotNull().cast("double")).alias(c) for c in df.columns]).first()
    return {c: (row[c] if row[c] is not None else 0.0) for c in df.columns}


def well_filled(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """Columns filled at least to ``threshold``; keep the list to prune other tables alike."""
    return [c for c, share in fill_shares(df).items() if not share < threshold]


def raise_total(df: DataFrame, total: str, building: str, parts) -> DataFrame:
    """Where the parts exceed the total, raise the total to their sum and the building part by the excess."""
    parts_sum = reduce(lambda a, b: a + b, [q(p) for p in parts])
    excess = F.when(q(total) < parts_sum, parts_sum - q(total)).otherwise(F.lit(0.0))
    return df.withColumns({total: q(total) + excess, building: q(building) + excess})


def rescale_components(df: DataFrame, components) -> DataFrame:
    """Rescale the components of each row whose sum lies in (100, 105]."""
    total = reduce(lambda a, b: a + b, [q(c) for c in components])
    return df.withColumns({c: rescale_mass(q(c), total) for c in components})


def child_feature_nulls(df: DataFrame) -> DataFrame:
    """After left joins of child profiles: no child rows -> count 0; one child row -> variance 0."""
    names, out = set(df.columns), []
    for c in df.columns:
        col = q(c)
        if c.endswith(("_NB_ROWS", "_nb")):
            col = F.coalesce(col, F.lit(0))
        elif c.endswith("_var") and f"{c[:-4]}_mean" in names:
            col = F.when(col.isNull() & q(f"{c[:-4]}_mean").isNotNull(), F.lit(0.0)).otherwise(col)
        out.append(col.alias(c))
    return df.select(*out)


def composite_index(df: DataFrame, pc: str, net: str, gdp: str, adult: str, young: str, full: bool = False) -> DataFrame:
    """Per-person and population-wide confidence index, both min-max scaled.

    ``full`` adds the computers x income term. The scalars come from scalar
    subqueries over one-row aggregates, so no row is paired with another.
    """
    top = df.agg(F.max(q(gdp))).scalar()
    person = q(pc) * q(net) + q(net) * 100 * q(gdp) / top
    if full:
        person = person + q(pc) * 100 * q(gdp) / top
    bounds = lambda d, c: d.agg(F.struct(F.min(c).alias("low"), F.max(c).alias("high"))).scalar()
    # Written once each, so a step does not repeat the steps before it in its bounds.
    raw = staged(df.withColumn("person_raw", person), "index-person")
    span = bounds(raw, "person_raw")
    share = F.try_divide(F.col("person_raw") - span["low"], span["high"] - span["low"])
    scaled = raw.withColumn("person_index", F.coalesce(share, F.lit(0.0)))
    overall = F.bround(F.col("person_index") * F.sqrt(q(adult) + 0.25 * q(young)))
    overall = staged(scaled.withColumn("overall_raw", overall), "index-overall")
    span = bounds(overall, "overall_raw")
    share = F.try_divide(F.col("overall_raw") - span["low"], span["high"] - span["low"])
    return overall.withColumn("overall_index", F.coalesce(share, F.lit(0.0))).drop("person_raw", "overall_raw")


def scaled_by_max(df: DataFrame, columns) -> DataFrame:
    """``x / max(x)`` per column."""
    return df.withColumns({f"{c}_rel": F.try_divide(q(c), df.agg(F.max(q(c))).scalar()) for c in columns})


def scaled_min_max(df: DataFrame, columns) -> DataFrame:
    """``(x - min) / (max - min)`` per column; a constant column gives 0."""
    new = {}
    for c in columns:
        low, high = df.agg(F.min(q(c))).scalar(), df.agg(F.max(q(c))).scalar()
        new[f"{c}_scaled"] = F.coalesce(F.try_divide(q(c) - low, high - low), F.lit(0.0))
    return df.withColumns(new)


def column_shares(df: DataFrame, columns, name: str = "category") -> DataFrame:
    """Total of each column and its share of the grand total, one row per column."""
    totals = df.agg(*[exact_sum(q(c)).alias(c) for c in columns])
    long = totals.unpivot([], [q(c) for c in columns], name, "total")
    grand = reduce(lambda a, b: a + b, [q(c) for c in columns])
    return long.withColumn("share", F.try_divide(F.col("total"), totals.select(grand).scalar()))
