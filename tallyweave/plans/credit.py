"""Feature matrix of credit applications: child tables profiled per client and joined to the main table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.operators.aggregates import profile_by_key
from tallyweave.operators.columns import child_feature_nulls, numeric_columns, q, well_filled
from tallyweave.operators.features import OneHot, SimpleImpute
from tallyweave.sources.nulls import normalise_missing

# Share of filled cells a column needs, earliest plausible day count.
FILL_THRESHOLD = 0.5
EARLIEST_DAY = -20000
# Day columns whose large values are a hundred times too large.
SENTINEL_DAYS = (
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
)
# Columns that repeat others.
CARD_DUPLICATES = (
    "AMT_RECIVABLE",
    "AMT_TOTAL_RECEIVABLE",
    "AMT_RECEIVABLE_PRINCIPAL",
    "AMT_PAYMENT_TOTAL_CURRENT",
)
# Ratio features of the main table (name, numerator, denominator).
APPLICATION_RATIOS = (
    ("DAYS_EMPLOYED_PERC", "DAYS_EMPLOYED", "DAYS_BIRTH"),
    ("INCOME_CREDIT_PERC", "AMT_INCOME_TOTAL", "AMT_CREDIT"),
    ("INCOME_PER_PERSON", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    ("ANNUITY_INCOME_PERC", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("PAYMENT_RATE", "AMT_ANNUITY", "AMT_CREDIT"),
)
KEY, LOAN, TARGET = "SK_ID_CURR", "SK_ID_PREV", "TARGET"


def pruned_and_imputed(df: DataFrame, keys=(KEY, LOAN, "SK_ID_BUREAU"), threshold: float = FILL_THRESHOLD) -> DataFrame:
    """Columns filled below the threshold go; the rest are imputed (median, mode)."""
    kept = df.select(*[q(c) for c in well_filled(df, threshold)])
    columns = [c for c in kept.columns if c not in keys]
    return SimpleImpute(columns=columns).fit(kept).transform(kept)


def bureau_profile(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Credits elsewhere with their monthly balances; the row count is taken after that join."""
    old = {c: N.within(q(c), EARLIEST_DAY) for c in ("DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_UPDATE") if c in bureau.columns}
    joined = bureau.withColumns(old).join(balance, "SK_ID_BUREAU", "left") if old else bureau.join(balance, "SK_ID_BUREAU", "left")
    return profile_by_key(joined.drop("SK_ID_BUREAU"), KEY, "BUREAU")


def card_profile(cards: DataFrame) -> DataFrame:
    return profile_by_key(cards.drop(*CARD_DUPLICATES, LOAN), KEY, "CREDIT_CARD_BALANCE")


def instalment_profile(instalments: DataFrame) -> DataFrame:
    """Share and difference paid, days past due and days before due."""
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    enriched = instalments.withColumns(
        {
            "PAYMENT_PERC": N.ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
            "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
            "DPD": N.positive_part(late),
            "DBD": N.positive_part(-late),
        }
    )
    return profile_by_key(enriched.drop(LOAN, "DAYS_ENTRY_PAYMENT", "AMT_PAYMENT"), KEY, "INSTALLMENTS_PAYMENTS")


def cash_profile(cash: DataFrame) -> DataFrame:
    return profile_by_key(cash.drop(LOAN), KEY, "POS_CASH")


def previous_profile(previous: DataFrame) -> DataFrame:
    """Earlier applications: day sentinels rescaled, share of the amount granted."""
    days = {c: N.rescale_sentinel(c) for c in SENTINEL_DAYS if c in previous.columns}
    enriched = previous.withColumns({**days, "APP_CREDIT_PERC": N.ratio("AMT_APPLICATION", "AMT_CREDIT")})
    return profile_by_key(
        enriched.drop("AMT_APPLICATION", "AMT_GOODS_PRICE", "DAYS_FIRST_DUE", LOAN), KEY, "PREVIOUS_APPLICATION"
    )


def main_table(train: DataFrame, test: DataFrame, ratios=APPLICATION_RATIOS, key: str = KEY, target: str = TARGET) -> DataFrame:
    """Train and test stacked: columns well filled in train, ratios, imputed, text columns one-hot."""
    kept = well_filled(train, FILL_THRESHOLD)
    both = train.select(*[q(c) for c in kept]).unionByName(
        test.select(*[q(c) for c in kept if c in test.columns]), allowMissingColumns=True
    )
    both = both.withColumns({n: N.ratio(a, b) for n, a, b in ratios if a in both.columns and b in both.columns})
    both = both.drop("OBS_60_CNT_SOCIAL_CIRCLE", "AMT_GOODS_PRICE")
    columns = [c for c in both.columns if c not in (key, target)]
    filled = SimpleImpute(columns=columns).fit(both).transform(both)
    texts = [c for c, kind in filled.dtypes if kind == "string"]
    return OneHot(columns=texts).fit(filled).transform(filled) if texts else filled


def feature_matrix(main: DataFrame, profiles, key: str = KEY) -> DataFrame:
    """Main table with each child profile joined on, child nulls settled, infinities NULL.

    All joins share the key, so the main table is shuffled once.
    """
    out = main
    for profile in profiles:
        out = out.join(profile, key, "left")
    return normalise_missing(child_feature_nulls(out))


def split_by_target(matrix: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """(rows with a target, rows to score without the target column)."""
    return matrix.filter(q(target).isNotNull()), matrix.filter(q(target).isNull()).drop(target)


def numeric_features(matrix: DataFrame, key: str = KEY, target: str = TARGET) -> list[str]:
    return numeric_columns(matrix, but=(key, target))
