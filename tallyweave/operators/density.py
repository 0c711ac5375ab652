"""Density clustering of points.

Identical points are one row with a count. Points are dealt to tiles, the leaves of a tree of median cuts that is fitted on a
bounded sample; the cuts only shape the tiles, any choice finds the same clusters. A tile is one row that holds its points as
blocks of bytes, and distances are products of whole tiles. Only tiles whose bounding boxes lie within eps meet, in two passes:

* First each tile meets itself and the tiles nearest to it. That settles the core points of crowded places, since counts only
  grow, and links what lies close together.
* Then only what is left open meets the other tiles in reach: points with too few neighbours so far, points of different
  clusters, and points that may be on the border of one.

So the rows that are written grow with the points, not with their pairs, and the pairs that are measured in the second pass
grow with the open points. A group holds the tiles of one leaf and up to ``BATCH_TILES`` tiles that meet them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.columns import q
from tallyweave.operators.neighbours import nearest
from tallyweave.session import spread, staged

TILE_ROWS = 512  # rows of a tile, about
MAX_DEPTH = 12  # levels of cuts; beyond 4,096 leaves the tiles grow to four times their rows and are then dealt by a hash
SAMPLE_ROWS = 32_768  # points that the cuts are fitted on, about
NEAR_TILES = 6  # other tiles that a tile meets in the first pass
BATCH_TILES = 256  # tiles that meet the tiles of a leaf in one group, at most
SLACK = 1e-9  # relative: rounding never settles a pair at the limit


def k_distance(df: DataFrame, row_id: str, features: str, k: int) -> DataFrame:
    """Distance of each row to its k-th nearest other row; the elbow of the sorted curve suggests eps."""
    refs = df.withColumnRenamed(row_id, "_ref")
    near = nearest(df, refs, k, row_id, "_ref", features, skip_same_id=True)
    return near.filter(F.col("rank") == k).select(row_id, F.sqrt("dist2").alias("k_distance"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype("float64")


def _long(block: bytes) -> np.ndarray:
    return np.frombuffer(block, dtype="int64")


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, summed from the first coordinate to the last."""
    return reduce(lambda x, y: x + y, [(a[:, i] - b[:, i]) ** 2 for i in range(a.shape[1])])


def _near(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` lie within the limit. Products settle most pairs, those close to it are measured exactly."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=bool)
    with np.errstate(over="ignore", invalid="ignore"):
        x, y = a - a[0], b - a[0]
        x2, y2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        off = x2[:, None] + y2[None, :] - 2.0 * (x @ y.T) - limit
        near = off <= 0.0
        row, col = np.nonzero(~(np.abs(off) > SLACK * (limit + x2.max() + y2.max())))
        near[row, col] = _squared(a[row], b[col]) <= limit
    return near


def _in_reach(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Rows of ``a`` that lie within the limit of the bounding box of ``b``."""
    gap = np.maximum(np.maximum(b.min(axis=0) - a, a - b.max(axis=0)), 0.0)
    with np.errstate(over="ignore"):
        return np.flatnonzero(np.einsum("ij,ij->i", gap, gap) <= limit * (1 + SLACK))


def _groups(near: np.ndarray) -> np.ndarray:
    """First row of the connected group of each row."""
    group = np.full(len(near), -1)
    for first in range(len(near)):
        front = np.array([first]) if group[first] < 0 else np.empty(0, int)
        while len(front):
            group[front] = first
            front = np.flatnonzero(near[front].any(axis=0) & (group < 0))
    return group


def _linked(near: np.ndarray, ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of groups that a near pair of rows links."""
    if not near.any():
        return np.empty(0, "int64"), np.empty(0, "int64")
    by_row, by_col = np.argsort(ours, kind="stable"), np.argsort(theirs, kind="stable")
    a, at = np.unique(ours[by_row], return_index=True)
    b, bt = np.unique(theirs[by_col], return_index=True)
    met = np.logical_or.reduceat(np.logical_or.reduceat(near[np.ix_(by_row, by_col)], at, axis=0), bt, axis=1)
    row, col = np.nonzero(met)
    return a[row], b[col]


def _cuts(points: DataFrame, total: int, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Depth, axes and places of median cuts, node by node; the children of node i are 2 i and 2 i + 1."""
    depth = 0
    while depth < MAX_DEPTH and total > TILE_ROWS << depth:
        depth += 1
    axis, cut = np.zeros(1 << depth, int), np.zeros(1 << depth)
    if depth:
        share = min(1.0, SAMPLE_ROWS / total)
        sample = points.filter(F.pmod(F.xxhash64("v", F.lit("cuts")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
        found = sample.select("v").limit(2 * SAMPLE_ROWS).toPandas()["v"]
        parts = {1: _matrix(found) if len(found) else np.empty((0, dims))}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            if len(part):
                axis[node] = np.nan_to_num(part / (np.abs(part).max() or 1.0)).std(axis=0).argmax()
                cut[node] = np.median(part[:, axis[node]])
            low = part[:, axis[node]] <= cut[node]
            parts[2 * node], parts[2 * node + 1] = part[low], part[~low]
    return depth, axis, cut


def _tiled(points: DataFrame, dims: int) -> DataFrame:
    """Points with the leaf (tile) they lie in, and the part (salt) of it where a leaf is too large."""
    depth, axis, cut = _cuts(points, points.count(), dims)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                v, node = _matrix(pdf["v"]), np.ones(len(pdf), int)
                for _ in range(depth):
                    node = 2 * node + (v[np.arange(len(v)), axis[node]] > cut[node])
                yield pdf.assign(tile=(node - (1 << depth)).astype("int32"))

    placed = staged(spread(points.select("num", "v", "w"), "num").mapInPandas(place, "num long, v array<double>, w long, tile int"), "placed")
    salts = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / (4 * TILE_ROWS)).alias("salts"))
    return placed.join(F.broadcast(salts), "tile").withColumn("salt", F.pmod(F.xxhash64("num"), "salts").cast("int")).drop("salts")


def _sum(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _visits(points: DataFrame, dims: int, limit: float) -> DataFrame:
    """(a, b, near): leaves whose boxes lie within the limit; near are a leaf itself and the few nearest to it."""
    corner = lambda f: F.array(*[f(F.col("v")[i]) for i in range(dims)])
    boxes = staged(points.groupBy("tile").agg(corner(F.min).alias("lo"), corner(F.max).alias("hi")), "boxes")
    ours = boxes.select(F.col("tile").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
    met = spread(ours, "a").crossJoin(F.broadcast(boxes.withColumnRenamed("tile", "b")))
    gap = [F.greatest(F.col("lo")[i] - F.col("hi_a")[i], F.col("lo_a")[i] - F.col("hi")[i], F.lit(0.0)) for i in range(dims)]
    apart = [F.col("lo")[i] / 2 + F.col("hi")[i] / 2 - F.col("lo_a")[i] / 2 - F.col("hi_a")[i] / 2 for i in range(dims)]
    met = met.select("a", "b", _sum([g * g for g in gap]).alias("gap"), _sum([x * x for x in apart]).alias("apart"))
    order = Window.partitionBy("a").orderBy(F.col("a") != F.col("b"), "apart", "b")
    met = met.filter(F.col("gap") <= limit * (1 + SLACK)).withColumn("near", F.row_number().over(order) <= NEAR_TILES + 1)
    return staged(met.select("a", "b", "near"), "visits")


def _blocks(points: DataFrame, *longs: str) -> DataFrame:
    """One row for each tile of the points: the coordinates and the whole-numbered columns, as bytes."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        packed = {c: [pdf[c].to_numpy(dtype="int64").tobytes()] for c in longs}
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1], "salt": pdf["salt"].iloc[:1], "v": [_matrix(pdf["v"]).tobytes()], **packed})

    schema = ", ".join(["tile int, salt int, v binary", *[f"{c} binary" for c in longs]])
    return points.select("tile", "salt", "v", *longs).groupBy("tile", "salt").applyInPandas(pack, schema)


def _meet(visits: DataFrame, asking: DataFrame, holding: DataFrame, dims: int, measure, schema: str) -> DataFrame:
    """Rows that ``measure`` finds for each pair of tiles of the visited leaves. It is given both rows and both matrices."""
    by, names = ["b", "part", "salt"], [c.split()[0] for c in schema.split(", ")]
    dealt = visits.select("a", "b", F.floor(F.col("a") / BATCH_TILES).cast("int").alias("part"))
    dealt = dealt.join(asking.select(F.col("tile").alias("a"), "salt"), "a")
    ours = dealt.join(asking.withColumnRenamed("tile", "a"), ["a", "salt"])
    to = [f"to_{c}" for c in by]
    holding = holding.withColumnRenamed("tile", "to_b").drop("salt")
    theirs = dealt.select(*[F.col(c).alias(f"to_{c}") for c in by]).distinct().join(holding, "to_b")

    def pair(askers: pd.DataFrame, holders: pd.DataFrame) -> pd.DataFrame:
        found = [[np.empty(0)] * len(names)]
        for y in holders.itertuples(index=False):
            refs = np.frombuffer(y.v).reshape(-1, dims)
            for x in askers.itertuples(index=False):
                found.append(measure(x, y, np.frombuffer(x.v).reshape(-1, dims), refs))
        return pd.DataFrame({c: np.concatenate([f[i] for f in found[1:] or found]) for i, c in enumerate(names)})

    return spread(ours, *by).groupBy(*by).cogroup(spread(theirs, *to).groupBy(*to)).applyInPandas(pair, schema)


def _core_points(points: DataFrame, blocks: DataFrame, visits: DataFrame, dims: int, limit: float, min_points: int) -> DataFrame:
    """Points with the number of rows within the limit, counted until it reaches ``min_points``."""

    def count(x, y, ours, refs):
        at = _in_reach(ours, refs, limit)
        return _long(x.num)[at], _near(ours[at], refs, limit) @ _long(y.w)

    def counted(asked: DataFrame, asking: DataFrame) -> DataFrame:
        return _meet(asked, asking, blocks, dims, count, "num long, within long").groupBy("num").agg(F.sum("within").alias("within"))

    first = staged(points.join(counted(visits.filter("near"), blocks.drop("w")), "num"), "counted")
    few = _blocks(first.filter(F.col("within") < min_points), "num")
    more = counted(visits.filter("NOT near"), staged(few, "few")).withColumnRenamed("within", "more")
    within = F.col("within") + F.coalesce("more", F.lit(0))
    return staged(first.join(more, "num", "left").withColumn("core", within >= min_points).drop("within", "more"), "cores")


def _core_clusters(core: DataFrame, visits: DataFrame, dims: int, limit: float) -> DataFrame:
    """Core points with the component (root) they belong to."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        v = _matrix(pdf["v"])
        return pdf.assign(node=pdf["num"].to_numpy()[_groups(_near(v, v, limit))])

    kind = "num long, v array<double>, tile int, salt int, node long"
    by_tile = spread(core.select("num", "v", "tile", "salt"), "tile", "salt").groupBy("tile", "salt")
    grouped = staged(by_tile.applyInPandas(group, kind), "grouped")

    def link(x, y, ours, refs):
        at, to = _in_reach(ours, refs, limit), _in_reach(refs, ours, limit)
        mine, theirs = _long(x.node)[at], _long(y.node)[to]
        ours, refs = ours[at], refs[to]
        if not len(at) or not len(to):
            return mine[:0], theirs[:0]
        # The commonest group is not held against itself, nor is any other link inside a group of use.
        groups, held = np.unique(np.concatenate([mine, theirs]), return_counts=True)
        most = groups[held.argmax()]
        found = []
        for row, col in ((mine == most, theirs != most), (mine != most, np.ones(len(theirs), dtype=bool))):
            a, b = _linked(_near(ours[row], refs[col], limit), mine[row], theirs[col])
            found.append((a[a != b], b[a != b]))
        return tuple(np.concatenate(f) for f in zip(*found, strict=True))

    def linked(asked: DataFrame, blocks: DataFrame) -> DataFrame:
        return staged(_meet(asked, blocks, blocks, dims, link, "a long, b long").distinct(), "edges")

    # Each pair of leaves once; it is near if one of both finds it so.
    pairs = visits.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("near").alias("near"))
    edges = linked(pairs.filter("near"), staged(_blocks(grouped, "node"), "blocks"))
    label = connected_components(grouped.select("node").distinct(), edges).withColumnRenamed("cluster", "root")
    grouped = staged(grouped.join(label, "node").drop("node").withColumnRenamed("root", "node"), "grouped")
    # Two leaves of one and the same component have nothing left to link.
    whole = grouped.groupBy("tile").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    ends = lambda end: whole.select(F.col("tile").alias(end), F.col("low").alias(f"low_{end}"), F.col("high").alias(f"high_{end}"))
    rest = pairs.filter("NOT near").join(ends("a"), "a").join(ends("b"), "b")
    rest = rest.filter(F.least("low_a", "low_b") < F.greatest("high_a", "high_b")).select("a", "b")
    edges = linked(rest, staged(_blocks(grouped, "node"), "blocks"))
    label = connected_components(grouped.select("node").distinct(), edges).withColumnRenamed("cluster", "root")
    return staged(grouped.join(label, "node").select("num", "v", "tile", "salt", "root"), "clusters")


def density_clusters(df: DataFrame, row_id: str, features: str, dims: int, eps: float, min_points: int) -> DataFrame:
    """(row_id, cluster) for every row; cluster is NULL for noise, else the smallest point number of the cluster.

    Border points join the cluster of their nearest core point. ``min_points`` counts the point itself. Rows without
    features, or with a missing or infinite coordinate, are noise.
    """
    limit = eps * eps
    rows = df.select(q(row_id), q(features).cast("array<double>").alias("v"))
    known = rows.filter(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    same = known.groupBy("v").agg(F.count(F.lit(1)).alias("w"), F.min(row_id).alias("p"))
    points = staged(same.withColumn("num", F.monotonically_increasing_id()), "points")
    tiled = _tiled(points, dims)
    visits = _visits(tiled, dims, limit)
    tiled = _core_points(tiled, staged(_blocks(tiled, "num", "w"), "blocks"), visits, dims, limit, min_points)
    clusters = _core_clusters(tiled.filter("core"), visits, dims, limit)
    named = clusters.select("num", "root").join(points.select("num", "p"), "num")
    names = named.groupBy("root").agg(F.min("p").alias("cluster"))
    named = staged(named.join(names, "root").select("num", "p", "cluster"), "named")

    # Border points: the rest, if a core point lies within eps.
    def closest(x, y, ours, refs):
        at = _in_reach(ours, refs, limit)
        row, col = np.nonzero(_near(ours[at], refs, limit))
        apart = _squared(ours[at][row], refs[col])
        least = np.full(len(at), np.inf)
        np.minimum.at(least, row, apart)
        tie = apart == least[row]
        return _long(x.num)[at][row[tie]], apart[tie], _long(y.num)[col[tie]]

    rest = staged(_blocks(tiled.filter("NOT core"), "num"), "rest")
    found = _meet(visits, rest, staged(_blocks(clusters, "num"), "blocks"), dims, closest, "num long, dist2 double, ref long")
    found = found.join(named.select(F.col("num").alias("ref"), "p", "cluster"), "ref")
    order = F.struct("dist2", F.col("p").isNull(), "p", "cluster")
    border = found.groupBy("num").agg(F.min(order).alias("best")).select("num", "best.cluster")
    by_point = named.select("num", "cluster").unionByName(border)
    labelled = points.join(by_point, "num").select("v", "cluster")
    return rows.join(labelled, "v", "left").select(row_id, "cluster")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, cluster = smallest node of its component) by alternating large-star and small-star steps.

    Each step rewires edges towards smaller nodes; the number of steps grows with the logarithm of the
    longest path, and they end at the fixed point. State is written to the shared folder after every round.
    """
    state = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    before = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        state = staged(small.filter("u <> v").distinct(), "components")
        # The rewired graph is a star per component once its edge set repeats.
        now = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == (now["n"], now["h"]):
            break
        before = (now["n"], now["h"])
    roots = state.groupBy("u").agg(F.min("v").alias("cluster"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("cluster", "node").alias("cluster")
    )
