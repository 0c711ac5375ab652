"""Spelling variants: words one code point apart, found through PartEnum signatures of their letters.

A word's letters are a multiset, seen as a binary vector over (letter, occurrence). One inserted, deleted or
replaced code point changes at most two of its entries, so near words lie within Hamming distance two.
Partition and enumerate: the entries are dealt to ``PARTS`` parts; two vectors within distance two differ in two
parts at most, so they agree on the rest for at least one choice of two parts to leave out. Each choice gives one
signature. Signatures are joined by equality and every pair is verified: letters first, then the words.

* Counting: words are counted inside tasks first, so a word that makes up a third of all tokens is a few rows.
* Words of equal letters (anagrams) share signatures; they travel together, in pieces of about ``PIECE`` words.
* A pair of letter multisets that several signatures join is let through by the first of them alone, in the join's
  own condition, so no shuffle removes repeats.
* Within a verified pair of multisets the differing letter is known: for each word the few places where it can
  stand are tried and looked up, so words are not compared all to all.

Handling: a null text has no words, a null id counts as the empty text in the hash, an empty table gives no rows;
repeated rows count each; columns other than the two named ones are passed over; runs may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.frames import LOWER
from tallyweave.session import spread, staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
PARTS = 7  # parts of the vector; two are left out in turn: 21 signatures
BITS = 9  # bits of a part's digest; seven of them fill a signed long
PIECE = 64  # words of equal letters that travel in one row, about
FLUSH = 200_000  # words a task counts before it hands them on
BALANCED = 4  # occurrences of a letter up to which its part is chosen by frequency

CHOICES = list(combinations(range(PARTS), 2))
_PART_MASK = [((1 << BITS) - 1) << (BITS * p) for p in range(PARTS)]


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", damage: int = 97, least: int = 5) -> DataFrame:
    """(word, n): letter runs of all texts, A-Z in lower case, of at least ``least`` code points, with their counts.

    A run whose crc32 with its document's id is a multiple of ``damage`` loses one code point, as scanned text
    would; 0 leaves all runs as they are.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not body:
                    continue
                runs = Counter(RUN.findall(body.encode().translate(LOWER).decode()))
                start = zlib.crc32(f"{key or ''}:".encode())
                for run, n in runs.items():
                    if damage:
                        h = zlib.crc32(run.encode(), start)
                        if h % damage == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                    if len(run) >= least:
                        counts[run] += n
                if len(counts) >= FLUSH:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    runs = docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return runs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _letters(word: str) -> Column:
    """The letters of a word in order: one text for all words of equal letters."""
    return F.array_join(F.array_sort(F.split(word, "")), "")


def _parts_by_frequency(classes: DataFrame) -> dict[str, int]:
    """Part of the commoner entries, dealt so that the parts tell words apart equally well.

    An entry is a letter and its occurrence, at most ``BALANCED`` of them for each of the alphabet's letters, so the
    driver sees a few hundred rows. Others are dealt by a hash. Any dealing finds the same pairs.
    """
    met = classes.select(F.split("letters", "").alias("c"))
    has = [
        met.select(F.explode(F.array_distinct("c")).alias("letter"), "c").select(
            F.concat("letter", F.lit(str(i))).alias("entry"),
            (F.size(F.filter("c", lambda x: x == F.col("letter"))) > i).alias("there"),
        )
        for i in range(BALANCED)
    ]
    counted = has[0]
    for more in has[1:]:
        counted = counted.unionByName(more)
    shares = {r["entry"]: r["n"] for r in counted.where("there").groupBy("entry").agg(F.count("*").alias("n")).collect()}
    total = max(shares.values(), default=1) + 1
    load, part = [0.0] * PARTS, {}
    for entry, n in sorted(shares.items(), key=lambda x: (-x[1], x[0])):
        part[entry] = min(range(PARTS), key=lambda p: load[p])
        load[part[entry]] += n / total * (1 - n / total) + 1e-9
    return part


def part_digests(letters: str, part: dict[str, int]) -> int:
    """``BITS`` bits for each part of a word's vector, side by side."""
    inside: list[list[str]] = [[] for _ in range(PARTS)]
    before, nth = "", 0
    for letter in letters:
        nth = nth + 1 if letter == before else 0
        before = letter
        entry = f"{letter}{nth}"
        found = part.get(entry)
        inside[xxhash.xxh64_intdigest(entry) % PARTS if found is None else found].append(entry)
    code = 0
    for p, entries in enumerate(inside):
        code |= (xxhash.xxh64_intdigest("".join(entries)) & ((1 << BITS) - 1)) << (BITS * p)
    return code


def differing_letters(a: str, b: str) -> tuple[str, str] | None:
    """(letter only in a, letter only in b) of two sorted letter texts one edit apart, else None; '' stands for none."""
    i, shorter = 0, min(len(a), len(b))
    while i < shorter and a[i] == b[i]:
        i += 1
    j = 0
    while j < shorter - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if len(a) + len(b) == 1:
        return a, b
    if a and len(a) == len(b):
        if a[1:] == b[:-1]:
            return a[0], b[-1]
        if a[:-1] == b[1:]:
            return a[-1], b[0]
    return None


def _pieces(words: DataFrame) -> DataFrame:
    """(letters, piece, words): words of equal letters with their counts as one text, ``word:n`` joined by commas."""
    lettered = words.select("word", "n", _letters("word").alias("letters"))
    sizes = lettered.groupBy("letters").agg(F.ceil(F.count("*") / PIECE).alias("pieces"))
    one = lettered.join(sizes, "letters").withColumn("piece", F.pmod(F.xxhash64("word"), "pieces"))
    return one.groupBy("letters", "piece").agg(
        F.array_join(F.collect_list(F.concat_ws(":", "word", F.col("n").cast("string"))), ",").alias("words")
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of ``words`` (word, n) that differ by exactly one edit."""
    pieces = staged(_pieces(words), "letter-pieces")
    part = _parts_by_frequency(pieces)
    drop_mask = [_PART_MASK[i] | _PART_MASK[j] for i, j in CHOICES]
    signed = pa.schema(
        [("choice", pa.int32()), ("sig", pa.int64()), ("code", pa.int64()), ("letters", pa.string()), ("words", pa.string())]
    )

    def sign(batches):
        for batch in batches:
            letters, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # A few classes at a time: a row of long words is repeated for each choice.
            for at in range(0, len(letters), 512):
                some = letters[at : at + 512]
                codes = [part_digests(x, part) for x in some]
                n = len(CHOICES)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(range(n)) * len(some), pa.int32()),
                        pa.array([c & ~m for c in codes for m in drop_mask], pa.int64()),
                        pa.array([c for c in codes for _ in range(n)], pa.int64()),
                        pa.array([x for x in some for _ in range(n)], pa.string()),
                        pa.array([x for x in held[at : at + 512] for _ in range(n)], pa.string()),
                    ],
                    schema=signed,
                )

    rows = spread(pieces.select("letters", "words"), "letters").mapInArrow(
        sign, "choice int, sig long, code long, letters string, words string"
    )
    a, b = rows.alias("a"), rows.alias("b")
    at = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("a.choice") + 1)
    differ = F.col("a.code").bitwiseXOR(F.col("b.code"))
    low = differ.bitwiseAND(at([_PART_MASK[i] for i, _ in CHOICES])) != 0
    high = differ.bitwiseAND(at([_PART_MASK[j] for _, j in CHOICES])) != 0
    zero = F.col("a.choice") < PARTS - 1  # the choices that leave out part 0 come first
    first = (low & high) | (zero & ~low & high) | ((F.col("a.choice") == 0) & ~high)
    pairs = a.join(
        b,
        (F.col("a.choice") == F.col("b.choice"))
        & (F.col("a.sig") == F.col("b.sig"))
        & (F.col("a.letters") < F.col("b.letters"))
        & (F.abs(F.length("a.letters") - F.length("b.letters")) <= 1)
        & first
        & (F.levenshtein(F.col("a.letters"), F.col("b.letters"), 2) >= 0),
    ).select(F.col("a.letters").alias("la"), F.col("a.words").alias("wa"), F.col("b.letters").alias("lb"), F.col("b.words").alias("wb"))
    near = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def counts(held: str) -> dict[str, int]:
        return {w: int(n) for w, n in (x.split(":") for x in held.split(","))}

    def verify(batches):
        for batch in batches:
            found: list[tuple[str, int, str, int]] = []
            for la, wa, lb, wb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                change = differing_letters(la, lb)
                if change is None:
                    continue
                old, new = change
                left, right = counts(wa), counts(wb)
                if not old:  # the second has one letter more: take it away from its words
                    left, right, old, new = right, left, new, old
                for word, n in left.items():
                    others, i = set(), word.find(old)
                    while i >= 0:
                        others.add(word[:i] + new + word[i + 1 :])
                        i = word.find(old, i + 1)
                    for other in others:
                        if (m := right.get(other)) is not None:
                            found += [(word, n, other, m), (other, m, word, n)]
            if found:
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, near, strict=True)], schema=near)

    return pairs.mapInArrow(verify, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointers are doubled until none moves; a form is always commoner, so no cycles."""
    hops = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = hops.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = hops.join(onward, "root", "left")
        if moved.where("beyond IS NOT NULL").isEmpty():
            return hops
        hops = staged(moved.select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n), a word once.

    ``form`` is the near word of largest count (ties: smallest in code-point order) if it is at least ``ratio``
    times the word's own; ``root`` follows forms to the last.
    """
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    known = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= F.col("n") * ratio, F.struct("best.near", (-F.col("best.less")).alias("n"))).alias("to"),
    )
    known = staged(known, "variants")
    roots = _roots(known.where("to IS NOT NULL").select("word", F.col("to.near").alias("form")))
    return known.join(roots, "word", "left").select(
        "word", F.col("to.near").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("to.n").alias("form_n")
    )


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", damage: int = 97, least_n: int = 3) -> DataFrame:
    """Variants among all words of ``docs`` that occur at least ``least_n`` times; see :func:`group_variants`."""
    words = staged(count_words(docs, doc_id, text, damage).where(F.col("n") >= least_n), "words")
    return group_variants(words)
