import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.operators import density as D
from tallyweave.operators import neighbours as NB


def frame(spark, vectors, name="id", start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, v array<double>")


def brute(qs, rs, k, skip):
    out = {}
    for i, a in enumerate(qs):
        d = sorted((((a - b) ** 2).sum(), j) for j, b in enumerate(rs) if not (skip and i == j))
        out[i] = [j for _, j in d[:k]]
    return out


@pytest.mark.parametrize("tile", [2048, 16])
@pytest.mark.parametrize("dims,k,skip", [(2, 1, False), (2, 4, True), (8, 3, False)])
def test_nearest_is_exact(spark, monkeypatch, tile, dims, k, skip):
    monkeypatch.setattr(NB, "TILE_ROWS", tile)
    rng = np.random.default_rng(dims)
    refs = np.round(np.concatenate([rng.normal(size=(120, dims)), rng.normal(size=(60, dims)) * 0.01 + 5]), 3)
    refs = np.concatenate([refs, np.repeat(refs[:1], 40, axis=0)])  # a hot group of copies
    qs = refs if skip else np.round(rng.normal(size=(70, dims)) * 3, 3)
    found = NB.nearest(frame(spark, qs), frame(spark, refs, "ref"), k, "id", "ref", "v", skip_same_id=skip).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["ref"])
    assert got == brute(qs, refs, k, skip)


def test_fewer_refs_than_asked(spark):
    found = NB.nearest(frame(spark, [[0.0], [5.0]]), frame(spark, [[1.0]], "ref"), 3, "id", "ref", "v")
    assert sorted((r["id"], r["ref"], r["dist2"]) for r in found.collect()) == [(0, 0, 1.0), (1, 0, 16.0)]
    none = NB.nearest(frame(spark, [[0.0]]), frame(spark, [[1.0]], "ref").filter("false"), 1, "id", "ref", "v")
    assert none.count() == 0


def test_impute_from_nearest_leaves_known_and_featureless_rows(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "a"), (2, 10.0, "b"), (3, 1.0, None), (4, 9.0, None), (5, None, None)], "id long, x double, t string"
    )
    out = NB.impute_from_nearest(df, "id", "t", F.when(F.col("x").isNotNull(), F.array("x")))
    assert {r["id"]: r["t"] for r in out.collect()} == {1: "a", 2: "b", 3: "a", 4: "b", 5: None}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_nearest_text_is_exact(spark, monkeypatch):
    monkeypatch.setattr(NB, "TILE_ROWS", 4)
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abc"), size=rng.integers(1, 9)))
    known, asked = sorted({word() for _ in range(60)}), sorted({word() + "d" for _ in range(25)} | {"zzzz"})
    make = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: (r["nearest"], round(r["similarity"], 9)) for r in NB.nearest_text(make(asked), make(known)).collect()}
    for a in asked:
        best = min((-(1 - levenshtein(a, b) / max(len(a), len(b))), b) for b in known)
        assert got[a] == (best[1], round(-best[0], 9))


def test_nearest_text_by_gram_index_and_beyond(spark, monkeypatch):
    """Long texts a few edits away, some far from all, an empty one, and grams that all texts share."""
    monkeypatch.setattr(NB, "TILE_ROWS", 8)
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), size=n))
    known = sorted({word(rng.integers(20, 45)) for _ in range(40)} | {"shared " + word(12) for _ in range(30)} | {"a"})

    def damaged(t, edits):
        for _ in range(edits):
            i = rng.integers(0, len(t) + 1)
            t = [t[:i] + "z" + t[i:], t[:i] + t[i + 1 :], t[:i] + "y" + t[i + 1 :]][rng.integers(0, 3)]
        return t

    asked = sorted({damaged(known[i], int(rng.integers(0, 14))) for i in range(0, len(known), 2)} | {"", "q" * 30, "shared "})
    make = lambda texts: spark.createDataFrame([(t,) for t in texts] * 2 + [(None,)], "text string")
    got = {r["text"]: (r["nearest"], round(r["similarity"], 9)) for r in NB.nearest_text(make(asked), make(known)).collect()}
    assert set(got) == set(asked)
    for a in asked:
        best = min((-(1 - levenshtein(a, b) / max(len(a), len(b))), b) for b in known)
        assert got[a] == (best[1], round(-best[0], 9))
    assert NB.nearest_text(make(["x"]), make([]).filter("false")).collect()[0]["nearest"] is None


def test_blocked_join_bounds_both_sides(spark):
    left = spark.range(1000).selectExpr("id AS a", "CASE WHEN id < 700 THEN 0 ELSE id END AS k")
    right = spark.range(900).selectExpr("id AS b", "CASE WHEN id < 500 THEN 0 ELSE id END AS k")
    joined = NB.blocked_join(left, right, "k", "a", "b", 50)
    assert joined.count() == joined.select("a", "b").distinct().count() == 700 * 500 + 200
    cells = joined.groupBy("k", "_l", "_r").agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"))
    assert cells.agg(F.max("a")).first()[0] <= 100 and cells.agg(F.max("b")).first()[0] <= 100


def dbscan(points, eps, least):
    n = len(points)
    near = [[j for j in range(n) if ((points[i] - points[j]) ** 2).sum() <= eps * eps] for i in range(n)]
    core = [len(x) >= least for x in near]
    label = list(range(n))
    moved = True
    while moved:
        moved = False
        for i in range(n):
            for j in near[i]:
                if core[i] and core[j] and label[j] < label[i]:
                    label[i], moved = label[j], True
    out = {}
    for i in range(n):
        around = [(((points[i] - points[j]) ** 2).sum(), j) for j in near[i] if core[j]]
        out[i] = label[i] if core[i] else label[min(around)[1]] if around else None
    return out


def test_density_clusters(spark):
    rng = np.random.default_rng(5)
    blob = lambda x, y, n, s: rng.normal(size=(n, 2)) * s + (x, y)
    pts = np.concatenate([blob(0, 0, 60, 0.15), blob(2, 0, 40, 0.3), blob(5, 5, 12, 0.6), rng.uniform(-3, 8, size=(20, 2))])
    pts = np.round(np.concatenate([pts, np.repeat([[6.0, -2.0]], 9, axis=0)]), 2)  # copies alone make a cluster
    got = {r["id"]: r["cluster"] for r in D.density_clusters(frame(spark, pts), "id", "v", 2, 0.3, 5).collect()}
    want = dbscan(pts, 0.3, 5)
    assert {i: c is None for i, c in got.items()} == {i: c is None for i, c in want.items()}
    # the same partition: labels map one to one
    assert len({(got[i], want[i]) for i in got}) == len(set(got.values())) == len(set(want.values()))


def test_density_in_six_dimensions(spark, monkeypatch):
    monkeypatch.setattr(D, "TILE_ROWS", 16)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 6)) * 2
    pts = np.concatenate([c + rng.normal(size=(60, 6)) * s for c, s in zip(centres, (0.1, 0.2, 0.3, 0.5))])
    pts = np.round(np.concatenate([pts, rng.uniform(-4, 4, size=(30, 6)), np.repeat(pts[:1], 20, axis=0)]), 3)
    df = frame(spark, pts).unionByName(spark.createDataFrame([(900, None), (901, [0.0, None, 0.0, 0.0, 0.0, 0.0])], "id long, v array<double>"))
    got = {r["id"]: r["cluster"] for r in D.density_clusters(df, "id", "v", 6, 0.6, 6).collect()}
    assert got.pop(900) is None and got.pop(901) is None
    want = dbscan(pts, 0.6, 6)
    assert {i: c is None for i, c in got.items()} == {i: c is None for i, c in want.items()}
    assert len({(got[i], want[i]) for i in got}) == len(set(got.values())) == len(set(want.values())) >= 4


def test_density_writes_rows_not_pairs(spark, monkeypatch):
    """Crowded points: every table that is written between the steps grows with the points, not with their pairs."""
    written, staged = [], D.staged

    def counted(df, name="stage"):
        out = staged(df, name)
        written.append((out.count(), name))
        return out

    monkeypatch.setattr(D, "staged", counted)
    monkeypatch.setattr(D, "TILE_ROWS", 32)
    pts = np.round(np.random.default_rng(8).uniform(size=(500, 6)) * 1.8, 3)
    df = frame(spark, pts).unionByName(spark.createDataFrame([(900, [float("inf")] * 6), (901, [float("nan")] * 6)], "id long, v array<double>"))
    got = {r["id"]: r["cluster"] for r in D.density_clusters(df, "id", "v", 6, 0.9, 20).collect()}
    assert got.pop(900) is None and got.pop(901) is None
    want = dbscan(pts, 0.9, 20)
    assert got == want and None in want.values() and len(set(want.values())) > 1
    assert max(written)[0] <= 2 * len(pts), max(written)


def test_density_of_large_leaves_and_repeated_ids(spark, monkeypatch):
    """Leaves that are dealt by a hash, and an id that stands at two places, each of which counts for itself."""
    monkeypatch.setattr(D, "TILE_ROWS", 8)
    monkeypatch.setattr(D, "MAX_DEPTH", 1)
    rng = np.random.default_rng(3)
    pts = np.round(np.concatenate([rng.normal(size=(90, 2)), rng.normal(size=(60, 2)) * 0.5 + (6, 0), rng.uniform(-4, 9, size=(30, 2))]), 2)
    got = {r["id"]: r["cluster"] for r in D.density_clusters(frame(spark, pts), "id", "v", 2, 0.5, 5).collect()}
    assert got == dbscan(pts, 0.5, 5)
    twice = spark.createDataFrame([(1, [0.0])] * 3 + [(1, [9.0])] * 2 + [(2, [0.1])], "id long, v array<double>")
    assert sorted(map(tuple, D.density_clusters(twice, "id", "v", 1, 0.5, 3).collect()), key=str) == [(1, 1)] * 3 + [(1, None)] * 2 + [(2, 1)]


def test_components_of_a_long_path(spark):
    nodes = spark.range(70).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(49)] + [(60, 69)], "a long, b long")
    got = {r["node"]: r["cluster"] for r in D.connected_components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(50)) and got[69] == got[60] == 60 and got[55] == 55


@pytest.mark.parametrize("shape", ["clustered", "one ring", "copies", "uniform"])
def test_blocked_search_in_many_dimensions(spark, monkeypatch, shape):
    """64 dimensions: equal to brute force, and on clustered data bounds settle most of the pairs."""
    monkeypatch.setattr(NB, "TILE_ROWS", 64)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(24, 64)) * 3
    refs = {
        "clustered": centres[rng.integers(0, 24, 2_000)] + rng.normal(size=(2_000, 64)) * 0.3,
        "one ring": np.eye(64)[rng.integers(0, 64, 700)] * rng.choice([1.0, -1.0], 700)[:, None],
        "copies": np.concatenate([np.ones((600, 64)), rng.normal(size=(200, 64))]),
        "uniform": rng.uniform(size=(500, 64)),
    }[shape]
    near = (refs[rng.integers(0, len(refs), 300)] + rng.normal(size=(300, 64)) * 0.1).round(6)
    found = NB.nearest(frame(spark, near), frame(spark, refs, "ref"), 5, "id", "ref", "v").collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["ref"])
    assert got == brute(near, refs, 5, False)
    if shape == "clustered":
        measured = NB.measured_pairs(frame(spark, near), frame(spark, refs, "ref"), 5, "id", "ref", "v")
        assert measured < 0.3 * len(near) * len(refs)


def test_top_k_leaves_out_own_ids_and_breaks_ties():
    refs = np.array([[0.0], [1.0], [1.0], [-1.0]])
    row, rid, dist = NB.top_k(np.array([[0.0], [1.0]]), refs, np.array([7, 9, 8, 6]), 2, np.array([7, 9]))
    assert list(zip(row, rid, dist)) == [(0, 6, 1.0), (0, 8, 1.0), (1, 8, 0.0), (1, 7, 1.0)]


def test_tiles_are_sent_to_batches(spark, monkeypatch):
    """A batch is a run of tiles, about eight batches to a side, none above its limit; every tile is in one."""
    tiles = spark.range(300).selectExpr("cast(id % 9 AS int) AS cell", "cast(id % 7 AS int) AS ring", "cast(id AS int) AS salt")
    sizes = lambda: [r["n"] for r in NB._numbered(tiles).groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes()) == 300 and max(sizes()) <= 32 and len(sizes()) == 10
    monkeypatch.setattr(NB, "BATCH_TILES", 1000)
    assert sum(sizes()) == 300 and len(sizes()) == 9


def test_equal_queries_are_asked_once(spark, monkeypatch):
    asked, search = [], NB._search
    monkeypatch.setattr(NB, "_search", lambda points, *rest: asked.append(points.count()) or search(points, *rest))
    qs = frame(spark, [[i % 3] for i in range(60)] + [[1.0]]).unionByName(frame(spark, [[2.0]]))  # id 0 stands twice
    found = NB.nearest(qs, frame(spark, [[0.2], [1.1], [1.9]], "ref"), 2, "id", "ref", "v").collect()
    assert asked == [3] and len(found) == 122
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["ref"], round(r["dist2"], 9)))
    assert got.pop(0) == [(2, 0.01), (0, 0.04)]
    assert all(v == {0: [(0, 0.04), (1, 1.21)], 1: [(1, 0.01), (0, 0.64)], 2: [(2, 0.01), (1, 0.81)]}[i % 3 if i < 60 else 1] for i, v in got.items())


def test_counts_leave_few_text_pairs(spark):
    """The bound is never below the similarity, and few pairs of texts that differ in letters are left to measure."""
    rng = np.random.default_rng(8)
    word = lambda letters, n: "".join(rng.choice(list(letters), size=n))
    texts = np.array([word("abcdefgh"[i % 5 :], 4 + i % 9) for i in range(60)] + ["", "é\U0001f600", "aaaaaaaa"], dtype=object)
    bound = NB._most_similar(texts, texts, NB._counts(texts), NB._counts(texts))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert bound[i, j] >= 1 - levenshtein(a, b) / max(len(a), len(b), 1) - 1e-12
    make = lambda rows, c: spark.createDataFrame([(r,) for r in rows], f"{c} string")
    known = make([f"{word('abcdefghijklmnopqrst', 12)} {i}" for i in range(900)], "rt")
    asked = make([f"brand#{i:09d} small" for i in range(40)], "qt")
    assert NB._count_tiles(asked, known)(asked.withColumn("least", F.lit(0.5))).count() < 0.05 * 900 * 40
