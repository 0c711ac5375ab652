"""Text column expressions, all built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def contains_any(x, terms) -> Column:
    """Case-insensitive: does the text contain one of the terms?"""
    x = F.lower(_c(x))
    return reduce(lambda a, b: a | b, [x.contains(t.lower()) for t in terms])


def not_contains(x, term: str) -> Column:
    return ~F.lower(_c(x)).contains(term.lower())


def group_values(x, tokens) -> Column:
    """Text containing a token (any case) becomes that upper-case token; the last match wins."""
    x = _c(x)
    out = x
    for token in tokens:
        out = F.when(F.upper(out).contains(token.upper()), F.lit(token.upper())).otherwise(out)
    return out


def split_any(x, separators) -> Column:
    """Split on any of several one-character separators."""
    klass = "[" + "".join("\\" + s for s in separators) + "]"
    return F.split(_c(x), klass)


def distinct_tags(x, separator: str = ",") -> Column:
    """Trimmed, lower-cased, non-empty distinct tags of a tag string."""
    parts = F.transform(F.split(_c(x), separator), lambda t: F.trim(F.lower(t)))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def terms(x, separators=(" ",), min_length: int = 1) -> Column:
    """Distinct lower-case terms of a row, at least ``min_length`` long."""
    parts = F.transform(split_any(F.lower(_c(x)), separators), lambda t: F.btrim(t, F.lit(" \t\n\r")))
    return F.array_distinct(F.filter(parts, lambda t: F.length(t) >= min_length))


def tokens(x, min_length: int = 4, stop=()) -> Column:
    """Lower-case runs of letters of any script, at least ``min_length`` long, without stop words; repeats stay."""
    words = F.split(F.lower(_c(x)), r"[^\p{L}]+")
    stop = [str(s) for s in stop]
    return F.filter(words, lambda t: (F.length(t) >= min_length) & (~t.isin(*stop) if stop else F.lit(True)))


def remove_phrase(x, phrase) -> Column:
    """Drop a phrase held in another column (a brand, say) and tidy the blanks."""
    x, phrase = F.lower(_c(x)), F.lower(_c(phrase))
    return F.trim(F.regexp_replace(F.replace(x, F.coalesce(phrase, F.lit(""))), " +", " "))


def mark_sentence(x) -> Column:
    """``[CLS] first. [SEP] second. [SEP]`` markers around sentences."""
    return F.concat(F.lit("[CLS] "), F.replace(_c(x), F.lit(". "), F.lit(". [SEP] ")), F.lit(" [SEP]"))


def s3_to_https(uri, region: str) -> Column:
    """``s3://bucket/key`` as a virtual-hosted https URL; the key is percent-quoted, slashes stay."""
    uri = _c(uri)
    bucket = F.regexp_extract(uri, "^s3[an]?://([^/]+)/", 1)
    key = F.regexp_extract(uri, "^s3[an]?://[^/]+/(.*)$", 1)
    quoted = F.replace(F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit("https://"), bucket, F.lit(f".s3.{region}.amazonaws.com/"), quoted)


def parent_folder(path) -> Column:
    """Name of the folder a file lies in."""
    return F.element_at(F.split(_c(path), "/"), -2)


def first_level(path, separator: str = ">>") -> Column:
    """First level of a category path such as ``["a >> b >> c"]``."""
    return F.trim(F.element_at(F.split(F.regexp_replace(_c(path), r'^\["|"\]$', ""), separator), 1))


def edit_similarity(a, b) -> Column:
    """1 - edit distance / longer length; 1 for two empty texts."""
    a, b = _c(a), _c(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)
