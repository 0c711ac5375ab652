"""One missing value: NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.numeric import finite


def normalise_missing(df: DataFrame, text_sentinels=()) -> DataFrame:
    """NaN and infinities become NULL in float columns, sentinel texts in string columns.

    Spark treats NaN as a value (the largest one), which would bias every median;
    this belongs right after reading.
    """
    sentinels = [s.lower() for s in text_sentinels]
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in ("double", "float"):
            col = finite(col)
        elif kind == "string" and sentinels:
            col = F.when(~F.lower(F.trim(col)).isin(sentinels), col)
        out.append(col.alias(name))
    return df.select(*out)
