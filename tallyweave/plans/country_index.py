"""Ranking of countries from yearly indicator series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.operators.aggregates import pivot_first, weighted_means
from tallyweave.operators.columns import q
from tallyweave.operators.ordered import latest_non_null

# Population bands cover 14 and 6 years of age.
YOUNG_YEARS, TEEN_YEARS = 14, 6


def unpivot_years(wide: DataFrame, keys, first: int = 1970, last: int = 2100) -> DataFrame:
    """One column per year to (keys, year, value), missing values left out."""
    years = [c for c in wide.columns if c.isdigit() and first <= int(c) <= last]
    long = wide.select(*keys, *[q(y).cast("double").alias(y) for y in years]).unpivot(list(keys), years, "year", "value")
    return long.filter(F.col("value").isNotNull()).withColumn("year", F.col("year").cast("int"))


def country_table(long: DataFrame, country: str, indicator: str, names, cutoffs) -> DataFrame:
    """(cutoff, country) rows with the latest value of each indicator at that cut-off."""
    latest = latest_non_null(long, [country, indicator], "year", "value", cutoffs)
    return pivot_first(latest, ["cutoff", country], indicator, "latest_value", names)


def fill_indicators(df: DataFrame, gdp_head: str, gdp: str, population: str, young: str, teen: str) -> DataFrame:
    """GDP per head from GDP and population; one age band from the other, assuming even ages."""
    return df.withColumns(
        {
            gdp_head: N.fill_ratio(gdp_head, gdp, population),
            teen: N.fill_scaled(teen, young, TEEN_YEARS / YOUNG_YEARS),
            young: N.fill_scaled(young, teen, YOUNG_YEARS / TEEN_YEARS),
        }
    )


def confidence_ranking(df: DataFrame, country: str, pc: str, net: str, gdp_head: str, adult: str, young: str) -> DataFrame:
    """Per cut-off: both confidence indices and the rank by the population-wide one.

    All cut-offs at once; the extremes of a cut-off are a small table joined back.
    """
    top = df.groupBy("cutoff").agg(F.max(gdp_head).alias("_top"))
    person = q(pc) * q(net) + q(net) * 100 * q(gdp_head) / F.col("_top")
    raw = df.join(top, "cutoff").withColumn("person_raw", person).drop("_top")

    def scaled(frame, source, target):
        ends = frame.groupBy("cutoff").agg(F.min(source).alias("_lo"), F.max(source).alias("_hi"))
        return frame.join(ends, "cutoff").withColumn(target, N.min_max(source, "_lo", "_hi")).drop("_lo", "_hi", source)

    out = scaled(raw, "person_raw", "person_index")
    size = F.sqrt(q(adult) + 0.25 * q(young))
    out = scaled(out.withColumn("overall_raw", F.bround(F.col("person_index") * size)), "overall_raw", "overall_index")
    # One row per country and cut-off: a few hundred rows per window.
    order = Window.partitionBy("cutoff").orderBy(F.desc("overall_index"), country)
    return out.withColumn("rank", F.row_number().over(order))


def region_table(df: DataFrame, region: str, means, sums, weight: str) -> DataFrame:
    """Per region: population-weighted means and plain sums."""
    totals = df.groupBy(region).agg(*[F.sum(c).alias(c) for c in sums])
    return totals.join(weighted_means(df, region, means, weight), region)
