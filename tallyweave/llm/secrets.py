"""Secrets in texts: fixed patterns, and windows of high entropy, in DataFrame functions alone.

Base kinds are found by pattern. The method adds a fourth kind, ``entropy``: in each candidate string
(a long run of letters, digits and ``+/_=-``) a window of fixed width slides over the characters. The
Shannon entropy of the window follows from the sum of n*log2(n) over its characters. The counts of all characters are
carried from window to window: one step changes those of the character that enters and of the one that leaves, and the
sum by their terms, so nothing is counted anew and the work grows with the length of the candidate. What counts as high
depends on the class of the candidate's characters.

The allow list (words of examples, runs of one character, counted-up alphabets) is taken out of a candidate first:
windows that touch an allowed match are passed over, those beside it are not. UUIDs are allowed as a whole, and so are
candidates without digits unless they change between small and capital letters as often as random ones. A span reaches
from the first high window to the end of the last one.

No pattern backtracks over repeated groups, so texts and candidates of any length are taken without recursion.

Offsets are code points, ends exclusive. Everything is row by row: no shuffle, whole texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# Fixed patterns of the base kinds: pattern, group that is measured, least length of that group.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (ASSIGN, 1, 6),
    # One run of the characters has its longest match at its first AKIA, so the length can stand in the pattern.
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Least bits per character by class, for windows of 20 (at most log2(20) = 4.32).
LEAST_BITS = {"hex": 3.0, "alnum": 3.7, "base64": 3.8}
# Matches within a candidate that no window may touch.
ALLOWED = r"(?i:example|sample|dummy|placeholder|changeme|your[_-]|test[_-]|0123456789|abcdefghij)|(.)\1{5,}+"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# Candidates without digits are looked at if this share of their places changes between small and capital letters.
CASE_CHANGES = 0.4
MASK = "~"  # stands for a character of an allowed match; no candidate holds it
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _found(text: Column, pattern: str, group: int) -> Column:
    """(piece before it, match, measured group) for each match, and a last piece without a match."""
    both = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
        lambda m, g: F.struct(m.alias("match"), g.alias("part")),
    )
    return F.zip_with(
        F.split(text, pattern, -1), both, lambda piece, m: F.struct(piece.alias("piece"), m["match"].alias("match"), m["part"].alias("part"))
    )


def _span(start: Column, kind: str, end: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("int").alias("end")
    )


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<start:int,rank:int,end:int>>)")


def _walk(found: Column, spans_of) -> Column:
    """Spans of all matches; ``spans_of(start, match struct)`` gives those of one."""

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["piece"])
        return F.struct(
            (start + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"),
            F.when(x["match"].isNull(), done["out"]).otherwise(F.concat(done["out"], spans_of(start, x))).alias("out"),
        )

    return F.aggregate(found, F.struct(F.lit(0).alias("at"), _no_spans().alias("out")), step, lambda done: done["out"])


def base_spans(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches of a base kind that are long enough."""
    pattern, group, least = BASE[kind]

    def one(start: Column, x: Column) -> Column:
        span = F.array(_span(start, kind, start + F.length(x["match"])))
        return F.when(F.length(x["part"]) >= least, span).otherwise(_no_spans())

    return _walk(_found(text, pattern, group), one)


ZERO = 48  # a count n is held as the character ZERO + n


def _bind(value: Column, fn) -> Column:
    """``fn`` of ``value``, which is evaluated once for all its uses."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def high_windows(word: Column, least: Column, width: int = WINDOW) -> Column:
    """Struct (first, last): starts of the first and last window of at least ``least`` bits, -1 if none.

    The state holds the window and one character for each letter of ``ALPHABET``, which says how often it stands in the
    window. A masked place empties both. What is the same for all windows is part of the state, so it is evaluated once.
    """
    most_sum = (F.lit(math.log2(width)) - least) * width + 1e-9  # entropy = log2(width) - sum(n log2 n) / width
    log_n = [n * math.log2(n) if n else 0.0 for n in range(width + 2)]
    gain = F.array(*[F.lit(log_n[n + 1] - log_n[n]) for n in range(width + 1)])  # of the sum, when n becomes n + 1
    empty = F.struct(F.lit("").alias("window"), F.lit(chr(ZERO) * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"))

    def changed(held: Column, char: Column, by: int, window: Column) -> Column:
        """The counts after ``char`` has entered (1) or left (-1)."""

        def with_place(place: Column) -> Column:
            return _bind(
                F.ascii(F.substring(held["counts"], place, F.lit(1))) - ZERO,
                lambda n: F.struct(
                    window.alias("window"),
                    F.overlay(held["counts"], F.char((n + ZERO + by).cast("long")), place, F.lit(1)).alias("counts"),
                    (held["total"] + F.get(gain, n if by > 0 else n - 1) * by).alias("total"),
                ),
            )

        return _bind(F.instr(F.lit(ALPHABET), char), with_place)

    def slide(done: Column, x: Column) -> Column:
        held = done["held"]
        left = F.when(
            F.length(held["window"]) >= width,
            changed(held, F.substring(held["window"], 1, 1), -1, F.substring(held["window"], 2, width)),
        ).otherwise(held)
        now = F.when(x == MASK, empty).otherwise(_bind(left, lambda h: changed(h, x, 1, F.concat(h["window"], x))))

        def judge(h: Column) -> Column:
            high = (h["total"] <= done["most"]) & (F.length(h["window"]) >= width)
            at = done["at"] + 1 - width
            return F.struct(
                (done["at"] + 1).alias("at"),
                done["most"].alias("most"),
                h.alias("held"),
                F.when(high & (done["first"] < 0), at).otherwise(done["first"]).alias("first"),
                F.when(high, at).otherwise(done["last"]).alias("last"),
            )

        return _bind(now, judge)

    start = F.struct(F.lit(0).alias("at"), most_sum.alias("most"), empty.alias("held"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    return F.aggregate(F.split(word, ""), start, slide, lambda done: F.struct(done["first"].alias("first"), done["last"].alias("last")))


def masked(word: Column, allowed: str = ALLOWED) -> Column:
    """The word with ``MASK`` in place of every character of an allowed match."""
    parts = F.transform(_found(word, allowed, 0), lambda x: F.concat(x["piece"], F.repeat(F.lit(MASK), F.coalesce(F.length(x["match"]), F.lit(0)))))
    return F.when(word.rlike(allowed), F.array_join(parts, "")).otherwise(word)


def entropy_spans(
    text: Column,
    width: int = WINDOW,
    least_bits: dict[str, float] = LEAST_BITS,
    allowed: str = ALLOWED,
) -> Column:
    """Windows of high entropy in candidates with letters, beside what is allowed."""

    def one(start: Column, x: Column) -> Column:
        word = x["match"]
        least = (
            F.when(word.rlike("^[0-9a-fA-F]+$"), F.lit(least_bits["hex"]))
            .when(word.rlike("^[0-9A-Za-z]+$"), F.lit(least_bits["alnum"]))
            .otherwise(F.lit(least_bits["base64"]))
        )
        changes = F.regexp_count(word, F.lit("[a-z](?=[A-Z])|[A-Z](?=[a-z])"))
        looked_at = word.rlike("[A-Za-z]") & (word.rlike("[0-9]") | (changes >= F.length(word) * CASE_CHANGES)) & ~word.rlike(UUID)
        spans = F.transform(
            F.array(high_windows(masked(word, allowed), least, width)),
            lambda w: _span(start + w["first"], "entropy", F.when(w["first"] >= 0, start + w["last"] + width)),
        )
        return F.when(looked_at, F.filter(spans, lambda s: s["end"].isNotNull())).otherwise(_no_spans())

    return _walk(_found(text, CANDIDATE, 0), one)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    said = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(said, ",")


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_assign, n_access, n_hex, n_entropy, base_spans and spans (``kind:start:end``, comma-joined).

    Spans are in the order of their starts, then of the kinds. A null text is the empty text and has no
    spans. Candidates of any length are looked at whole. One row per input row, repeated rows included; no other input column is read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.col(key),
        *[base_spans(body, kind).alias(f"found_{kind}") for kind in BASE],
        entropy_spans(body).alias("found_entropy"),
    )
    base = F.concat(*[F.col(f"found_{kind}") for kind in BASE])
    return found.select(
        F.col(key),
        *[F.size(f"found_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        _joined(base).alias("base_spans"),
        _joined(F.concat(base, F.col("found_entropy"))).alias("spans"),
    )
