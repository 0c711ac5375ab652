"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import variants as V

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, damage=97):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    out, form = {}, {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def collected(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_groups_equal_brute_force(spark):
    draw = random.Random(5)
    stems = ["".join(draw.choice("aeinstré") for _ in range(draw.randint(4, 8))) for _ in range(60)]
    rows = []
    for i in range(400):
        picked = []
        for _ in range(20):
            w = draw.choice(stems)
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice("aeinß") + w[at:], w[:at] + "z" + w[at + 1 :]])
            picked.append(draw.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, " ".join(picked)))
    rows += [(None, None), (7, ""), (None, "Étient étient ÉTIENT"), (8, "12 .. aa" * 50), (9, "x" * 70_000 + " " + "y" * 5)]
    rows += [(500, "repeated repeats repeated")] * 4 + [(501, "q" * 3_000)] * 3 + [(502, "q" * 2_999 + "r")] * 9
    got = collected(V.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_groups(plain_words(rows))
    assert any(v[0] for v in got.values()) and any(v[1] not in (k, v[0]) for k, v in got.items())


def test_many_anagrams_stay_whole(spark):
    """Words of equal letters fill several pieces; each piece meets every other."""
    draw = random.Random(2)
    words = set()
    while len(words) < 400:
        w = list("aabcdefg")
        draw.shuffle(w)
        words.add("".join(w))
    words |= {w[:3] + "z" + w[4:] for w in list(words)[:150]} | {w + "a" for w in list(words)[:150]}
    table = {w: 3 + i % 40 for i, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(table.items()), "word string, n long")
    assert collected(V.group_variants(df)) == plain_groups(table)


def test_long_chains_reach_their_root(spark):
    chain = ["abcdefghijklmnopqrstuvwxyz"[:5] * 2]
    for i in range(9):
        chain.append(chain[-1][:i] + "z" + chain[-1][i + 1 :])
    table = {w: 3 * 2**i for i, w in enumerate(chain)}
    got = collected(V.group_variants(spark.createDataFrame(list(table.items()), "word string, n long")))
    assert got == plain_groups(table) and got[chain[0]][1] == chain[-1]


def test_ties_take_the_smallest_near_word(spark):
    table = {"planes": 3, "planet": 10, "planer": 10, "plane": 6}
    got = collected(V.group_variants(spark.createDataFrame(list(table.items()), "word string, n long")))
    assert got["planes"] == ("planer", "planer", 3, 3, 10)
    assert got["plane"] == (None, "plane", 6, 3, None)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert V.spelling_variants(empty).collect() == []
    df = spark.createDataFrame([(1, "letters letters letters lettres lettres lettres lettres lettres lettres", 4, "w", 1)],
                               "doc_id long, text string, n long, word string, root int")
    assert {r["word"] for r in V.spelling_variants(df, damage=0).collect()} == {"letters", "lettres"}


@pytest.mark.parametrize("a,b", [("abcde", "abcde"), ("aabb", "abbc"), ("abc", "abd"), ("aab", "abb"), ("abc", "ab"), ("abcd", "ab"), ("", "a"), ("abcd", "abxy")])
def test_differing_letters(a, b):
    ca, cb = Counter(a), Counter(b)
    gone, new = ca - cb, cb - ca
    expected = None
    if sum((gone + new).values()) in (1, 2) and sum(gone.values()) <= 1 and sum(new.values()) <= 1:
        expected = ("".join(gone), "".join(new))
    assert V.differing_letters(a, b) == expected


def test_damage_is_by_document_and_run(spark):
    rows = [(i, "wandering") for i in range(2_000)]
    counted = {r["word"]: r["n"] for r in V.count_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {w: n for w, n in counted.items() if n >= 3} == plain_words(rows) and len(counted) > 3


def test_table_words_match_plain_count(spark, sf, texts):
    got = {r["word"]: r["n"] for r in V.count_words(spark.read.parquet(f"{sf}/documents.parquet")).where(F.col("n") >= 3).collect()}
    assert got == plain_words(texts)
