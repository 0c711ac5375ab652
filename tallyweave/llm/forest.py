"""Near-duplicate vectors by a forest of random-projection trees.

In each tree a vector goes down from the root: at every level the vectors of a node are projected on a
random direction (one per tree and level) and split at a threshold; vectors close to it go down both sides
(spill). The threshold is fitted on a sample of at most ``fit_rows`` rows of the node, at that of some
quantiles where the spill is least. Nodes are split until they hold at most ``leaf_rows``, six levels per
round of Spark jobs; all vectors are routed. A node that no split would make much smaller, a dense ball of
copies, stays whole, and is compared in tiles: every pair of its tiles is one row, so no leaf has to
fit one task and none is cut off.

Within a leaf all pairs are compared in double precision. A pair that meets in several leaves counts in
the first of them. Tiles return the number of links of each vector and a spanning forest of the links,
never the links themselves. Equal vectors are one class and compared once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.graph import components
from tallyweave.llm.simhash import nearest_forest
from tallyweave.session import staged

LEVELS = 48  # at most; a node this deep stays whole
STEP = 6  # levels per round
QUANTILES = (0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65)
LEAST_GAIN = 1.6  # a split whose sides hold more than this times the node is not made


def directions(tree: int, levels: range, dim: int, seed: int) -> np.ndarray:
    """Unit directions of some levels of a tree, as columns."""
    out = np.stack([np.random.default_rng((seed, tree, level, dim)).normal(size=dim) for level in levels], axis=1)
    return out / np.linalg.norm(out, axis=0)


def fit_node(values: np.ndarray, n: int, first: int, leaf_rows: int, margin: float) -> np.ndarray:
    """Thresholds of the next STEP levels below a node of about ``n`` rows, in heap order; NaN: no split.

    ``values``: projections of a sample of the rows, a column per level. ``first``: level of the node.
    """
    out = np.full((1 << STEP) - 1, np.nan)
    each = n / max(1, len(values))

    def split(place: int, rows: np.ndarray, depth: int) -> None:
        if depth == STEP or first + depth >= LEVELS or len(rows) * each <= leaf_rows or len(rows) < 16:
            return
        x = values[rows, depth]
        cuts = np.quantile(x, QUANTILES)
        spill = [((x > c - margin) & (x <= c + margin)).sum() + abs((x <= c).sum() - len(x) / 2) / 4 for c in cuts]
        cut = cuts[int(np.argmin(spill))]
        left, right = rows[x <= cut + margin], rows[x > cut - margin]
        if len(left) + len(right) > LEAST_GAIN * len(rows):
            return
        out[place] = cut
        split(2 * place + 1, left, depth + 1)
        split(2 * place + 2, right, depth + 1)

    split(0, np.arange(len(values)), 0)
    return out


def route(values: np.ndarray, cuts: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, path (1 and then a bit per level) and whether it ended early, of each place that a row reaches."""
    rows, path = np.arange(len(values)), np.ones(len(values), dtype=np.int64)
    ended = []
    for depth in range(STEP):
        cut = cuts[rows, path - 1]
        stop = np.isnan(cut)
        ended.append((rows[stop], path[stop], np.ones(stop.sum(), dtype=bool)))
        rows, path, cut = rows[~stop], path[~stop], cut[~stop]
        x, m = values[rows, depth], margin[rows]
        left, right = x <= cut + m, x > cut - m
        rows, path = np.concatenate((rows[left], rows[right])), np.concatenate((2 * path[left], 2 * path[right] + 1))
    ended.append((rows, path, np.zeros(len(rows), dtype=bool)))
    return tuple(np.concatenate(x) for x in zip(*ended, strict=True))


def margin_of(least: float, dim: int, spill: float) -> float:
    """Spill margin: ``spill`` standard deviations of the projected difference of two vectors at the least cosine."""
    return spill * math.sqrt(max(0.0, 2 - 2 * least) / max(1, dim))


def _clean(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """key, raw (bytes of the vector, null if it links with nothing) and digest."""
    kind = vectors.schema[embedding].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = np.float32 if narrow else np.float64
        for batch in batches:
            raws, digests = [], []
            for vector in batch.column("vector"):
                raw = None
                if vector.is_valid and not vector.values.null_count and len(vector.values):
                    x = vector.values.to_numpy(zero_copy_only=False).astype(dtype)
                    size = np.linalg.norm(x.astype(np.float64))
                    raw = x.tobytes() if np.isfinite(x).all() and np.isfinite(size) and size > 0 else None
                raws.append(raw)
                digests.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(raws, pa.binary()), pa.array(digests, pa.binary())], names=["key", "raw", "digest"]
            )

    cast = F.col(f"`{embedding}`") if narrow else F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").alias("key"), cast.alias("vector"))
    fields = [rows.schema["key"], T.StructField("raw", T.BinaryType()), T.StructField("digest", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType(fields))


def _units(raws: list[bytes], dtype) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), dtype=dtype).reshape(len(raws), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def grow(classes: DataFrame, dtype, least: float, trees: int, leaf_rows: int, fit_rows: int, spill: float, seed: int) -> DataFrame:
    """(class, tree, node) of each leaf of each tree that a class reaches; ``tree`` is dim * trees + its number."""

    def project(levels: range):
        """Projections on these levels: ``values`` of every row; without ``tree`` in the input, a row per tree."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raws, ids = batch.column("raw").to_pylist(), batch.column("class").to_numpy()
                dims = np.array([len(r) for r in raws]) // np.dtype(dtype).itemsize
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    unit = _units([raws[i] for i in at], dtype)
                    for tree in range(trees):
                        values = (unit @ directions(tree, levels, dim, seed)).astype(np.float32)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[at]),
                                pa.array(np.full(len(at), dim * trees + tree)),
                                pa.array(list(values), pa.list_(pa.float32())),
                            ],
                            names=["class", "tree", "values"],
                        )

        return classes.select("class", "raw").mapInArrow(run, "class long, tree long, values array<float>")

    def fit(table: pa.Table) -> pa.Table:
        values = np.stack([np.asarray(x, dtype=np.float64) for x in table.column("values").to_pylist()])
        tree, node, n = (table.column(c)[0].as_py() for c in ("tree", "node", "n"))
        cuts = fit_node(values, n, node.bit_length() - 1, leaf_rows, margin_of(least, tree // trees, spill))
        return pa.table({"tree": [tree], "node": [node], "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack(batch.column("values").to_pylist()).astype(np.float64)
            cuts = np.stack(batch.column("cuts").to_pylist())
            ids, tree, node = (batch.column(c).to_numpy() for c in ("class", "tree", "node"))
            margin = np.array([margin_of(least, t // trees, spill) for t in tree])
            rows, path, done = route(values, cuts, margin)
            depth = np.frexp(path)[1] - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[rows]),
                    pa.array(tree[rows]),
                    pa.array((node[rows] << depth) + path - (np.int64(1) << depth)),
                    pa.array(done),
                ],
                names=["class", "tree", "node", "done"],
            )

    place, leaves, level = None, [], 0
    while True:
        values = project(range(level, level + STEP))
        if place is None:
            rows = values.withColumn("node", F.lit(1).cast("long"))
        else:
            rows = place.join(values, ["class", "tree"])
        rows = staged(rows, "forest-rows")
        sizes = staged(rows.groupBy("tree", "node").agg(F.count("*").alias("n")), "forest-sizes")
        chance = F.shiftrightunsigned(F.xxhash64("class", "tree", "node"), 11).cast("double") / F.lit(float(1 << 53))
        sample = rows.join(sizes, ["tree", "node"]).where(chance * F.col("n") < fit_rows)
        fitted = staged(
            sample.select("tree", "node", "n", "values")
            .groupBy("tree", "node")
            .applyInArrow(fit, "tree long, node long, cuts array<double>"),
            "forest-cuts",
        )
        sent = staged(
            rows.join(fitted, ["tree", "node"]).mapInArrow(send, "class long, tree long, node long, done boolean"), "forest-places"
        )
        level += STEP
        leaves.append(sent.where("done").select("class", "tree", "node"))
        on = sent.where("not done").select("class", "tree", "node")
        if level >= LEVELS:
            leaves.append(on)
            break
        open_nodes = on.groupBy("tree", "node").agg(F.count("*").alias("n"))
        open_nodes = staged(open_nodes.withColumn("open", F.col("n") > leaf_rows).drop("n"), "forest-open")
        marked = on.join(open_nodes, ["tree", "node"])
        leaves.append(marked.where("not open").select("class", "tree", "node"))
        if open_nodes.where("open").isEmpty():
            break
        place = marked.where("open").select("class", "tree", "node")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return staged(out, "forest-leaves")


def first_common(leaves: np.ndarray, other: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """The least leaf of both rows, for each pair of rows of leaves (sorted, filled up with different negatives)."""
    out = np.empty(len(leaves), dtype=np.int64)
    for at in range(0, len(leaves), block):
        one, two = leaves[at : at + block], other[at : at + block]
        both = (one[:, :, None] == two[:, None, :]).any(axis=2)
        out[at : at + block] = np.where(both, one, np.iinfo(np.int64).max).min(axis=1)
    return out


def link_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    least: float = 0.95,
    trees: int = 4,
    leaf_rows: int = 1024,
    fit_rows: int = 4096,
    spill: float = 0.5,
    seed: int = 17,
) -> DataFrame:
    """``key``, n_links, component_id and kept: one row per vector, every vector indexed.

    Null, empty and zero vectors and those with null or non-finite components link with nothing. Vectors
    of different lengths are not compared. Rows with equal vectors link with each other, also if they share
    a key. A null key is never the id of a component; a component without keys has a null id. Other
    input columns are not read.
    """
    rows = staged(_clean(vectors, key, embedding), "forest-vectors")
    kind = vectors.schema[embedding].dataType
    dtype = np.float32 if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else np.float64
    classes = staged(
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("key").alias("least_key"), F.count("*").alias("weight"), F.first("raw").alias("raw"))
        .withColumn("class", F.monotonically_increasing_id()),
        "forest-classes",
    )
    places = grow(classes, dtype, least, trees, leaf_rows, fit_rows, spill, seed)
    # One number per leaf; a node deeper than the number has room for would need a tree of over 50 levels.
    leaf = (F.col("tree") % trees * F.lit(1 << 56) + F.col("node")).alias("leaf")
    memberships = places.groupBy("class").agg(F.sort_array(F.collect_list(leaf)).alias("leaves"))
    sizes = staged(
        places.groupBy("tree", "node").agg(F.ceil(F.count("*") / leaf_rows).cast("int").alias("n_tiles")), "forest-leaf-sizes"
    )
    held = classes.select("class", "weight", "raw").join(memberships, "class")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for members in batch.column("rows").to_pylist():
                width = max(len(m["leaves"]) for m in members)
                record = _record(len(members[0]["raw"]), width)
                blob = np.zeros(len(members), dtype=record)
                for i, m in enumerate(members):
                    filled = m["leaves"] + [-1 - k for k in range(width - len(m["leaves"]))]
                    blob[i] = (m["class"], m["weight"], np.frombuffer(m["raw"], dtype=np.uint8), filled)
                blobs.append(width.to_bytes(4, "little") + len(members[0]["raw"]).to_bytes(4, "little") + blob.tobytes())
            yield batch.drop_columns(["rows"]).append_column("blob", pa.array(blobs, pa.binary()))

    tile = F.pmod(F.xxhash64("class"), F.col("n_tiles")).cast("int").alias("tile")
    tiles = staged(
        places.join(sizes, ["tree", "node"])
        .join(held, "class")
        .groupBy("tree", "node", "n_tiles", tile)
        .agg(F.collect_list(F.struct("class", "weight", "raw", "leaves")).alias("rows"))
        .select("tree", "node", "n_tiles", "tile", "rows")
        .mapInArrow(pack, "tree long, node long, n_tiles int, tile int, blob binary"),
        "forest-tiles",
    )
    mine = (F.col("tree") % trees * F.lit(1 << 56) + F.col("node")).alias("leaf")
    alone = tiles.select("blob", F.lit(None).cast("binary").alias("other"), mine)
    crossed = (
        tiles.where("tile < n_tiles - 1")
        .select("tree", "node", F.col("blob"), mine, F.explode(F.expr("sequence(tile + 1, n_tiles - 1)")).alias("tile"))
        .join(tiles.select("tree", "node", "tile", F.col("blob").alias("other")), ["tree", "node", "tile"])
        .select("blob", "other", "leaf")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            found: dict[str, list] = {"a": [], "b": [], "n": []}
            for blob, other, leaf in zip(batch.column("blob"), batch.column("other"), batch.column("leaf"), strict=True):
                one = _open(blob.as_py(), dtype)
                two = _open(other.as_py(), dtype) if other.is_valid else None
                _compare(one, two, leaf.as_py(), least, found)
            yield pa.RecordBatch.from_pydict(found, schema=out)

    found = staged(alone.union(crossed).mapInArrow(compare, "a long, b long, n long"), "forest-links")
    degrees = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null")).select(F.col("node").alias("class"), "root")
    rooted = classes.select("digest", "class", "weight", "least_key").join(roots, "class", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "class"))
    ids = rooted.groupBy("root").agg(F.min("least_key").alias("component_id"))
    told = staged(
        rooted.join(ids, "root")
        .join(degrees, "class", "left")
        .select("digest", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"),
        "forest-classes-told",
    )
    alone = F.col("digest").isNull()
    joined = rows.select("key", "digest").join(told, "digest", "left")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def _record(raw: int, width: int) -> np.dtype:
    return np.dtype([("class", "<i8"), ("weight", "<i8"), ("raw", "u1", (raw,)), ("leaves", "<i8", (width,))])


def _open(blob: bytes, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, weights, unit vectors and leaves of a tile."""
    width, raw = (int.from_bytes(blob[i : i + 4], "little") for i in (0, 4))
    rows = np.frombuffer(blob, dtype=_record(raw, width), offset=8)
    x = np.ascontiguousarray(rows["raw"]).view(dtype).astype(np.float64)
    return rows["class"], rows["weight"], x / np.linalg.norm(x, axis=1, keepdims=True), rows["leaves"]


def _compare(one, two, leaf: int, least: float, found: dict[str, list]) -> None:
    """Add the links of a tile (``two`` None) or between two tiles of a leaf: (a, None, number) and (a, b, 0)."""
    ids, weights, unit, leaves = one
    other = one if two is None else two
    close = []
    for at in range(0, len(unit), 512):
        cosine = unit[at : at + 512] @ other[2].T
        i, j = np.nonzero(cosine >= least)
        close.append((i + at, j, cosine[i, j]))
    i, j, cosine = (np.concatenate(x) for x in zip(*close, strict=True))
    if two is None:
        keep = i < j
        i, j, cosine = i[keep], j[keep], cosine[keep]
    if not len(i):
        return
    shift = 0 if two is None else len(ids)
    every = ids if two is None else np.concatenate((ids, other[0]))
    width = max(leaves.shape[1], other[3].shape[1])
    fill = lambda x, base: np.concatenate(
        (x, np.broadcast_to(base - np.arange(width - x.shape[1]), (len(x), width - x.shape[1]))), axis=1
    )
    # Negatives of the two sides must differ, or fillings would be taken for a common leaf.
    mine, theirs = fill(np.where(leaves < 0, leaves - 1000, leaves), -5000), fill(other[3], -9000)
    first = np.concatenate(
        [first_common(mine[i[k : k + 65536]], theirs[j[k : k + 65536]]) for k in range(0, len(i), 65536)]
    )
    here = first == leaf
    n = np.bincount(i[here], other[1][j[here]], len(every)) + np.bincount(
        j[here] + shift, weights[i[here]], len(every)
    )
    linked = np.flatnonzero(n)
    tied = nearest_forest(i, j + shift, -cosine, len(every))
    found["a"] += every[linked].tolist() + every[i[tied]].tolist()
    found["b"] += [None] * len(linked) + every[j[tied] + shift].tolist()
    found["n"] += n[linked].astype(np.int64).tolist() + [0] * len(tied)
