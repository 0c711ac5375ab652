"""Vector links against brute force."""

import numpy as np
import pytest

from tallyweave.llm import forest as V
from tallyweave.llm.queries import QUERIES


def plain(rows, least=0.95):
    x = [None if v is None or not len(v) or any(c is None or not np.isfinite(c) for c in v) or not any(v) else np.array(v, dtype=float) for _, v in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(n):
        for j in range(i):
            if x[i] is None or x[j] is None or len(x[i]) != len(x[j]):
                continue
            if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= least:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    ids = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(k)] = min(key, ids.get(find(k), key))
    return sorted(((key, links[k], ids.get(find(k)), key is not None and key == ids.get(find(k))) for k, (key, _) in enumerate(rows)), key=str)


def test_query_matches_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op5_forest"](spark, sf).collect()), key=str) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (4, [2.0, 0.0]), (4, [2.0, 0.0]), (None, [1.0, 0.01]), (7, None), (8, []), (9, [0.0, 0.0]), (10, [nan, 1.0]),
            (11, [inf, 1.0]), (12, [None, 1.0]), (13, [1.0, 0.0, 0.0]), (14, [1.0, 0.0, 0.1]), (None, [0.0, -3.0]), (15, [-1.0, 0.0])]
    docs = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n_links int")
    assert sorted(map(tuple, V.link_vectors(docs).collect()), key=str) == plain(rows)


def test_empty_table(spark):
    assert V.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_recall_with_small_leaves_and_a_large_group_of_copies(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24))
    ball = rng.normal(size=24) + 0.02 * rng.normal(size=(300, 24))
    near = x[:300] + 0.045 * np.linalg.norm(x[:300], axis=1, keepdims=True) * rng.normal(size=(300, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((x, ball, near)))]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in V.link_vectors(docs, leaf_rows=64, fit_rows=200).collect()}
    want = {r[0]: r for r in plain(rows)}
    assert set(got) == set(want)
    assert all(got[k]["n_links"] <= want[k][1] for k in want)  # no link below the least cosine, none counted twice
    assert sum(got[k]["n_links"] for k in got) >= 0.95 * sum(w[1] for w in want.values())
    one_by_one = [k for k in range(300) if want[k][1]]
    assert len(one_by_one) > 100
    assert sum(got[k]["n_links"] for k in one_by_one) >= 0.9 * sum(want[k][1] for k in one_by_one)


@pytest.mark.parametrize("margin", [0.0, 0.2])
def test_route(margin):
    values = np.linspace(-1, 1, 9)[:, None].repeat(V.STEP, 1)
    cuts = np.full((9, (1 << V.STEP) - 1), np.nan)
    cuts[:, 0], cuts[:, 2] = 0.0, 0.5
    rows, path, done = V.route(values, cuts, np.full(9, margin))
    assert done.all() and set(path) == {2, 6, 7}
    assert sorted(rows[path == 2]) == [i for i in range(9) if values[i, 0] <= margin]
    assert sorted(rows[path == 7]) == [i for i in range(9) if values[i, 0] > max(-margin, 0.5 - margin)]
