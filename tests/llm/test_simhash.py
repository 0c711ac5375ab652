"""Fingerprints, tiled comparison and components against plain versions."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweave.llm import simhash as S
from tallyweave.llm.graph import components
from tallyweave.llm.queries import QUERIES


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


def plain(rows, radius=2):
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= radius
    ]
    group = plain_components(len(rows), links)
    least = {}
    for (key, _), g in zip(rows, group, strict=True):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    return sorted(
        ((k, f"{p:016x}", least.get(g)) for (k, _), p, g in zip(rows, prints, group, strict=True)), key=str
    )


def test_query_matches_brute_force(spark, sf, texts):
    got = sorted(map(tuple, QUERIES["op1_simhash"](spark, sf).collect()), key=str)
    assert got == plain(texts)


EDGES = [
    (5, None), (4, ""), (None, " \t "), (7, "One two"), (6, "one TWO"), (9, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"),
    (None, "lonely words here"), (3, "É é x y z \x85 w"), (2, "w " * 30000), (1, "w " * 30001),
]


def test_edges(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in EDGES], "doc_id long, text string, fingerprint int")
    assert sorted(map(tuple, S.near_duplicates(docs).collect()), key=str) == plain(EDGES)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).collect() == []
    assert S.drop_near_duplicates(docs).collect() == []


@pytest.mark.parametrize("tile_rows", [2048, 3])
def test_links_of_close_fingerprints(spark, tile_rows):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {int(x) for x in base}
    for x in base[:20]:
        for _ in range(6):
            prints.add(int(x) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False))))
    prints = sorted(prints)
    frame = spark.createDataFrame([(f"{x:016x}", f"{x:016x}", 0) for x in prints], "id string, fingerprint string, n_shingles long")
    links = S.link_classes(frame, 2, words=1, id_bytes=8, tile_rows=tile_rows)
    at = {f"{x:016x}": i for i, x in enumerate(prints)}
    got = [(at[r["a"]], at[r["b"]]) for r in links.collect()]
    want = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    assert {tuple(sorted(x, reverse=True)) for x in got} <= set(want)
    assert plain_components(len(prints), got) == plain_components(len(prints), want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14), st.integers(0, 3)), max_size=40))
def test_forest(links):
    links = [x for x in links if x[0] != x[1]]
    i, j, d = (np.array([x[k] for x in links], dtype=np.int64) for k in range(3))
    kept = S.nearest_forest(i, j, d, 15)
    assert plain_components(15, [x[:2] for x in links]) == plain_components(15, [links[k][:2] for k in kept])
    assert len(kept) == 15 - len(set(plain_components(15, [x[:2] for x in links])))


def test_components_of_a_long_path(spark):
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(500, 501), (501, 501), (None, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(1, n + 1)} | {501: 500}


def test_one_of_each_group_stays(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [vocabulary[k] for k in rng.integers(0, 3000, n)]
    rows, group = [], 0
    for n in (60, 300, 2000):
        for _ in range(5):
            words = text(n)
            rows.append((len(rows), " ".join(words), group))
            rows.append((len(rows), " ".join(words), group))  # a copy
            near = list(words)
            near[n // 2] = "other"
            rows.append((len(rows), "  ".join(near).upper(), group))
            group += 1
            rows.append((len(rows), " ".join(words[: n // 2] + text(n // 2)), group))  # half of it: another text
            group += 1
    rows += [(None, "", group), (len(rows), None, group), (0, rows[0][1], 0)]
    docs = spark.createDataFrame([(k, t, g) for k, t, g in rows], "doc_id long, text string, row_id int")
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert sorted(r["row_id"] for r in kept) == list(range(group + 1))
    least = {}
    for k, _, g in rows:
        if k is not None:
            least[g] = min(k, least.get(g, k))
    assert {r["row_id"]: r["doc_id"] for r in kept} == least


def test_links_that_only_farther_pairs_confirm(spark):
    """Families of edits around the least similarity: many of the nearest links fail, yet no confirmed one is lost."""
    rng = np.random.default_rng(11)
    rows = []
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(120)]
        for _ in range(40):
            words = list(base)
            for at in rng.integers(0, 120, rng.integers(1, 5)):
                words[at] = f"x{rng.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(words)))
    parts = [S.shingles(t.encode().split(), 5) for _, t in rows]
    prints = [int("".join(f"{x:016x}" for x in S.fingerprint(p, range(42, 46)).tolist()), 16) for p in parts]
    sets = [set(p) for p in parts]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 52 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in S.drop_near_duplicates(docs).collect())
    assert kept == sorted(set(plain_components(len(rows), links)))


def test_shared_parts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (0, 1, 20, 50, 200)]
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in sets[1:]] for x in sets]
    for block in (7, 8192):
        assert S.shared_parts(sets, sets[1:], block).tolist() == want


@pytest.mark.parametrize("tile_rows", [8, 256])
def test_links_apart_join_what_all_pairs_join(spark, tile_rows):
    """Many tiles, a root with tiles of its own, and single texts beside it."""
    rng = np.random.default_rng(7)
    texts = []
    for _ in range(60):
        words = [f"w{k}" for k in range(100)]
        for at in rng.integers(0, 100, rng.integers(1, 4)):
            words[at] = f"x{rng.integers(0, 10**9)}"
        texts.append(" ".join(words[: rng.integers(84, 101)]))
    sets = [set(S.shingles(t.encode().split(), 5)) for t in texts]
    prints = ["".join(f"{x:016x}" for x in S.fingerprint(sorted(p), range(42, 46)).tolist()) for p in sets]
    root = [0 if i < 30 else i for i in range(60)]
    links = [
        (i, j)
        for i in range(60)
        for j in range(i)
        if root[i] != root[j]
        and (int(prints[i], 16) ^ int(prints[j], 16)).bit_count() <= 70
        and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    name = lambda i: f"{i:032x}"
    rows = [(name(i), prints[i], len(sets[i]), "raw", name(root[i])) for i in range(60)]
    classes = spark.createDataFrame(rows, "id string, fingerprint string, n_shingles long, raw string, root string")
    frame = spark.createDataFrame([(name(i), t) for i, t in enumerate(texts)], "id string, text string")
    found = S.links_apart(classes, frame, 5, 0.8, 70, 4, tile_rows=tile_rows).collect()
    got = [(int(r["a"], 16), int(r["b"], 16)) for r in found]
    assert {tuple(sorted(x, reverse=True)) for x in got} <= set(links)
    same = [(0, i) for i in range(30)]
    assert plain_components(60, got + same) == plain_components(60, links + same)
    assert links and len(set(plain_components(60, links + same))) < 31


def few_and_repeated():
    """Texts of 5 to 15 words with single edits, and texts of which a line is repeated: (doc_id, text)."""
    rng = np.random.default_rng(13)
    texts = []
    for n in range(5, 16):
        for _ in range(30):
            words = [f"w{k}" for k in rng.integers(0, 10**9, n)]
            texts += [words, [*words, f"x{rng.integers(0, 10**9)}"], [f"y{rng.integers(0, 10**9)}", *words]]
    for _ in range(20):
        words = [f"w{k}" for k in rng.integers(0, 10**9, 104)]
        texts += [words, words + words[40:64] * 30]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_few_shingles_and_repeated_lines_against_brute_force(spark):
    rows = few_and_repeated()
    sets = [set(S.shingles(t.encode().split(), 5)) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(max(0, i - 2), i)  # other texts share no word
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in S.drop_near_duplicates(docs).collect())
    assert len(links) > 200 and kept == sorted(set(plain_components(len(rows), links)))


def test_radius_leaves_a_negligible_tail():
    radius = S.radii_by_size(0.8, 256, 1e-6)
    for a in range(1, 320):
        for b in range(a, int(a / 0.8 + 1e-9) + 1):
            share = S.bit_share(a, b, 0.8)
            if share is not None:
                assert S.least_radius(share, 256, 1e-6) <= radius[min(a, 64), min(b, 64)]
