"""Helpers shared by the operators of this subpackage: tables, byte tokens, row ids."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lower case for A-Z alone, on UTF-8 bytes.
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())

# Lower case, and a blank for every ASCII byte that is neither letter nor digit. Bytes of
# non-ASCII characters stay, so ``text.translate(WORD_BYTES).split()`` gives the words.
WORD_BYTES = bytes(
    LOWER[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def utf8(text: Column) -> Column:
    """Bytes of a text; a null text has none."""
    return F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))


def fold(key: Column, folds: int = 5) -> Column:
    """Fold of a row: crc32 of its key as text; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def if_small(ids: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A staged table of ids, marked for broadcast if it has at most ``rows`` rows; else the join shuffles."""
    return F.broadcast(ids) if ids.count() <= rows else ids
