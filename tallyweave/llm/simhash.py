"""SimHash near-duplicates by exact tiled comparison.

Fingerprints: each word shingle is hashed by XXH64; a bit of the fingerprint is set if it is set in over
half of the hashes. Texts of equal content form a class, and classes are compared, not copies.

Comparison: classes are put into cells by the population counts of the parts of their fingerprint (and,
for a least similarity, by size), and cells are cut by hash into tiles of bounded size. The counts of two
fingerprints cannot differ by more than the bits they differ in, so tile pairs whose counts differ beyond the radius
are never formed. Each other pair of tiles is one row: all its pairs are compared by numpy exclusive-or
and bit counts, and the links are thinned to a spanning forest of the nearest ones. So a group of m copies
gives about m links, not m * m / 2, and no link between components is lost.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.frames import LOWER, if_small, utf8
from tallyweave.llm.graph import components
from tallyweave.session import staged

CODE = 100_000  # cell coordinates are digits to this base


def shingles(words: list[bytes], k: int) -> list[bytes]:
    if len(words) < k:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def fingerprint(parts: list[bytes], seeds: range, block: int = 1 << 15) -> np.ndarray:
    """One 64-bit word per seed; all zero without shingles."""
    out = np.zeros(len(seeds), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for w, seed in enumerate(seeds):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(parts), block):
            some = parts[at : at + block]
            h = np.fromiter((digest(s, seed) for s in some), dtype="<u8", count=len(some))
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[w] = np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0]
    return out


def fingerprints(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    shingle: int = 3,
    words: int = 1,
    seed: int = 42,
    distinct: bool = False,
) -> DataFrame:
    """``keep`` with fingerprint (16 hex digits a word) and n_shingles (distinct ones), row by row.

    ``distinct``: a shingle counts once in the fingerprint, however often the text repeats it. Words are runs of anything but blanks and tabs to carriage returns, A-Z in lower case. A text of fewer
    words than a shingle is one shingle; a null or empty text has none and the fingerprint zero.
    """
    seeds = range(seed, seed + words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sizes = [], []
            for body in batch.column("simhash_body"):
                parts = shingles(body.as_py().translate(LOWER).split(), shingle)
                each = set(parts)
                counted = list(each) if distinct else parts
                prints.append("".join(f"{x:016x}" for x in fingerprint(counted, seeds).tolist()))
                sizes.append(len(each))
            kept = batch.drop_columns(["simhash_body"])
            columns = [*kept.columns, pa.array(prints, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept.schema.names, "fingerprint", "n_shingles"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], utf8(F.col(f"`{text}`")).alias("simhash_body"))
    fields = [rows.schema[c] for c in keep]
    fields += [T.StructField("fingerprint", T.StringType()), T.StructField("n_shingles", T.LongType())]
    return rows.mapInArrow(run, T.StructType(fields))


def nearest_forest(i: np.ndarray, j: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Indices of links (i, j) that span the same components, nearest links first (Boruvka's rounds)."""
    order = np.argsort(d, kind="stable")
    label, chosen = np.arange(n), []
    while True:
        a, b = label[i[order]], label[j[order]]
        order = order[a != b]
        if not len(order):
            return np.concatenate(chosen) if chosen else np.zeros(0, dtype=np.int64)
        a, b = label[i[order]], label[j[order]]
        # The first link of each component in one fixed order of all links: no cycles.
        ends = np.stack([a, b], axis=1).ravel()
        _, first = np.unique(ends, return_index=True)
        links = np.unique(first // 2)
        chosen.append(order[links])
        a, b = a[links], b[links]
        while True:  # labels of the joined components sink to their least one
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
            if (label == before).all():
                break


def bit_share(a: int, b: int, least: float) -> float | None:
    """Chance that a bit differs between sets of ``a`` and ``b`` shingles that are just ``least`` similar; None if none are."""
    both = math.ceil(least * (a + b) / (1 + least) - 1e-9)
    if both > min(a, b):
        return None
    ones = lambda n: np.array([math.comb(n, k) / 2**n for k in range(n + 1)])
    shared = np.arange(both + 1)
    # Chance of a set bit by the number of shared shingles that have it.
    x, y = ((2 * (shared[:, None] + np.arange(n - both + 1)) > n) @ ones(n - both) for n in (a, b))
    return float((ones(both) * (x * (1 - y) + y * (1 - x))).sum())


def least_radius(share: float, bits: int, tail: float) -> int:
    """Bits within which two fingerprints lie but for a chance of ``tail``, if each differs with chance ``share``."""
    beyond = 0.0
    for r in range(bits, 0, -1):
        beyond += math.comb(bits, r) * share**r * (1 - share) ** (bits - r)
        if beyond > tail:
            return r
    return 0


@functools.lru_cache
def radii_by_size(least: float, bits: int, tail: float, exact: int = 64) -> np.ndarray:
    """Radius by the numbers of distinct shingles of two texts, those beyond ``exact`` as one; -1: never similar.

    Of few shingles, one more can turn many bits; as they grow the share sinks to that of a normal pair, so the
    largest radius of the sizes next to ``exact`` holds for all above.
    """
    out = np.full((exact + 1, exact + 1), -1, dtype=np.int64)
    out[0, 0] = 0
    for a in range(1, 2 * exact + 1):
        for b in range(a, int(a / least + 1e-9) + 1):
            share = bit_share(a, b, least)
            if share is not None:
                x, y = min(a, exact), min(b, exact)
                out[x, y] = out[y, x] = max(out[x, y], least_radius(share, bits, tail))
    out[-1] = out[:, -1] = out[-1, -1]
    return out


def tile_links(
    one: np.ndarray,
    two: np.ndarray | None,
    radius: int | np.ndarray,
    block: int = 256,
    sizes: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j, bits) of rows of two tiles within the radius; ``two`` None: pairs i < j of one tile.

    ``radius`` may be a table by the ``sizes`` of both rows, as from ``radii_by_size``.
    """
    other = one if two is None else two
    widest = int(np.max(radius))
    found = []
    for at in range(0, len(one), block):
        rows = one[at : at + block]
        start = at + 1 if two is None else 0
        bits = np.zeros((len(rows), len(other) - start), dtype=np.uint16)
        for w in range(one.shape[1]):
            bits += np.bitwise_count(rows[:, w, None] ^ other[None, start:, w])
        i, j = np.nonzero(bits <= widest)
        d = bits[i, j]
        i, j = i + at, j + start
        if sizes is not None:
            top = len(radius) - 1
            near = d <= radius[np.minimum(sizes[0][i], top).astype(int), np.minimum(sizes[1][j], top).astype(int)]
            i, j, d = i[near], j[near], d[near]
        if two is None:
            keep = i < j
            i, j, d = i[keep], j[keep], d[keep]
        found.append((i, j, d))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def cell_steps(parts: int, radius: int, width: int, sized: bool) -> list[int]:
    """Codes of the steps from a cell to itself and to one of each two cells that lie opposite each other.

    Step t in a coordinate means that counts differ by (|t| - 1) * width + 1 at least.
    """
    reach = range(-(radius // width + 1), radius // width + 2)
    least = lambda t: max(0, (abs(t) - 1) * width + 1)
    codes = []
    for steps in itertools.product(reach, repeat=parts):
        if sum(map(least, steps)) <= radius:
            for size in (-1, 0, 1) if sized else (0,):
                code = size
                for t in steps:
                    code = code * CODE + t
                codes.append(code)
    return sorted(c for c in codes if c >= 0)


def nearest_of_each(i: np.ndarray, j: np.ndarray, d: np.ndarray, each: int) -> np.ndarray:
    """Indices of the ``each`` nearest links of every row, seen from either end."""
    chosen = []
    for end in (i, j):
        order = np.argsort(d, kind="stable")
        for _ in range(each):
            _, first = np.unique(end[order], return_index=True)
            chosen.append(order[first])
            order = np.delete(order, first)
    return np.unique(np.concatenate(chosen))


def link_classes(
    classes: DataFrame,
    radius: int | np.ndarray,
    words: int,
    parts: int = 4,
    width: int = 1,
    least_similarity: float | None = None,
    tile_rows: int = 2048,
    each: int = 0,
    id_bytes: int = 16,
) -> DataFrame:
    """Links (a, b, bits) between classes (id, fingerprint, n_shingles) within ``radius`` bits, or a table of them by size.

    ``id`` is a string of hex digits for ``id_bytes`` bytes. The links of each tile pair are thinned to a
    spanning forest, with the ``each`` nearest links of every class added. ``parts``: the fingerprint is cut
    into so many parts for the population counts. ``width``: counts per cell. ``least_similarity``: shingle
    sets of sizes that already rule it out are not compared.
    """
    shrink = -math.log(least_similarity) if least_similarity else None
    record = np.dtype([("size", "<u8"), ("print", ">u8", (words,)), ("id", f"V{id_bytes}")])

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("id", "fingerprint", "n_shingles")]
            codes, packed = [], []
            for name, print_, size in zip(*columns, strict=True):
                code = 1 + int(math.log(max(1, size)) / shrink) if shrink else 1
                step = len(print_) // parts
                for p in range(parts):
                    code = code * CODE + int(print_[p * step : (p + 1) * step], 16).bit_count() // width + 1
                codes.append(str(code))
                packed.append(size.to_bytes(8, "little") + bytes.fromhex(print_) + bytes.fromhex(name))
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array(codes)], names=["packed", "cell"])

    rows = classes.select("id", "fingerprint", "n_shingles").mapInArrow(cells, "packed binary, cell string")
    # With a size coordinate a code may exceed a long, so codes are decimals.
    rows = staged(rows.withColumn("cell", F.col("cell").cast("decimal(38,0)")), "simhash-classes")
    counts = staged(
        rows.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("n_tiles")), "simhash-cells"
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [b"".join(x) for x in batch.column("rows").to_pylist()]
            yield batch.drop_columns(["rows"]).append_column("blob", pa.array(blobs, pa.binary()))

    tile = F.pmod(F.xxhash64("packed"), F.col("n_tiles")).cast("int")
    tiles = staged(
        rows.join(counts, "cell")
        .groupBy("cell", tile.alias("tile"))
        .agg(F.collect_list("packed").alias("rows"))
        .mapInArrow(pack, "cell decimal(38,0), tile int, blob binary"),
        "simhash-tiles",
    )
    by_size = isinstance(radius, np.ndarray)
    steps = cell_steps(parts, int(np.max(radius)), width, shrink is not None)
    own = F.col("step") == 0
    pairs = (
        tiles.select(
            "cell", "tile", F.explode(F.array(*[F.lit(str(c)).cast("decimal(38,0)") for c in steps])).alias("step")
        )
        .select("cell", "tile", "step", (F.col("cell") + F.col("step")).cast("decimal(38,0)").alias("cell2"))
        .join(counts.withColumnRenamed("cell", "cell2"), "cell2")
        .select(
            "cell",
            "tile",
            "cell2",
            own.alias("own"),
            F.explode(F.sequence(F.when(own, F.col("tile")).otherwise(0), F.col("n_tiles") - 1)).alias("tile2"),
        )
    )
    others = tiles.select(F.col("cell").alias("cell2"), F.col("tile").alias("tile2"), F.col("blob").alias("two"))
    work = (
        pairs.join(tiles.withColumnRenamed("blob", "one"), ["cell", "tile"])
        .join(others, ["cell2", "tile2"])
        .select("one", F.when(~(F.col("own") & (F.col("tile") == F.col("tile2"))), F.col("two")).alias("two"))
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("a", pa.string()), ("b", pa.string()), ("bits", pa.int32())])
        for batch in batches:
            found = {"a": [], "b": [], "bits": []}
            for blob, blob2 in zip(batch.column("one"), batch.column("two"), strict=True):
                one = np.frombuffer(blob.as_py(), dtype=record)
                two = np.frombuffer(blob2.as_py(), dtype=record) if blob2.is_valid else None
                other = one if two is None else two
                i, j, d = tile_links(
                    one["print"].astype(np.uint64),
                    None if two is None else two["print"].astype(np.uint64),
                    radius,
                    sizes=(one["size"], other["size"]) if by_size else None,
                )
                if least_similarity and len(i):
                    x, y = one["size"][i], other["size"][j]
                    keep = np.minimum(x, y) >= least_similarity * np.maximum(x, y)
                    i, j, d = i[keep], j[keep], d[keep]
                if not len(i):
                    continue
                shift = 0 if two is None else len(one)
                kept = nearest_forest(i, j + shift, d, shift + len(other))
                if each:
                    kept = np.union1d(kept, nearest_of_each(i, j + shift, d, each))
                found["a"] += [x.tobytes().hex() for x in one["id"][i[kept]]]
                found["b"] += [x.tobytes().hex() for x in other["id"][j[kept]]]
                found["bits"] += d[kept].tolist()
            yield pa.RecordBatch.from_pydict(found, schema=out)

    return work.mapInArrow(compare, "a string, b string, bits int")


def verified(links: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Links whose texts (id, text) have shingle sets with a Jaccard similarity of at least ``least``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @functools.lru_cache(maxsize=2)  # rows come sorted by b
        def parts(body: bytes) -> frozenset:
            return frozenset(shingles(body.translate(LOWER).split(), shingle))

        for batch in batches:
            kept = []
            for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                one, two = parts(x.as_py()), parts(y.as_py())
                kept.append(len(one & two) >= least * len(one | two))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    body = utf8(F.col("text"))
    rows = links.join(texts.select(F.col("id").alias("a"), body.alias("text_a")), "a")
    rows = rows.join(texts.select(F.col("id").alias("b"), body.alias("text_b")), "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a string, b string")


def shared_parts(one: list[np.ndarray], two: list[np.ndarray], block: int = 1 << 13) -> np.ndarray:
    """Size of the intersection of each set of ``one`` with each of ``two`` (sorted hashes), by matrix products."""

    def marks(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
        grid = np.zeros((len(sets), len(some)), dtype=np.float32)
        for row, every in enumerate(sets):
            low, high = np.searchsorted(every, some[0]), np.searchsorted(every, some[-1], "right")
            at = np.searchsorted(some, every[low:high])
            grid[row, at[some[at] == every[low:high]]] = 1
        return grid

    out = np.zeros((len(one), len(two)), dtype=np.int64)
    known = np.intersect1d(np.concatenate(one), np.concatenate(two))
    for at in range(0, len(known), block):
        some = known[at : at + block]
        out += (marks(one, some) @ marks(two, some).T).astype(np.int64)
    return out


def links_apart(
    classes: DataFrame,
    texts: DataFrame,
    shingle: int,
    least: float,
    radius: int | np.ndarray,
    words: int,
    tile_rows: int = 256,
    tile_bytes: int = 4 << 20,
) -> DataFrame:
    """Links (a, b) within ``radius`` bits and of ``least`` similarity between classes of one ``raw`` but two roots.

    ``classes``: id, fingerprint, n_shingles, raw, root; ``texts``: id, text. The classes of a raw component
    are cut by size, and by root where a root has many, into tiles of bounded rows and bytes. A tile holds the
    64-bit hashes of the shingles, so all pairs of two tiles are confirmed by matrix products within one row, and
    only a spanning forest of the confirmed links leaves it. Tiles of one root are not compared.
    """
    shrink = -math.log(least)
    sized = classes.withColumn("size", F.floor(F.log(F.greatest("n_shingles", F.lit(1))) / F.lit(shrink)).cast("int"))
    roots = sized.groupBy("raw", "size", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("held"))
    home = F.when(F.col("n") >= tile_rows // 4, F.col("root")).otherwise("")
    homes = staged(roots.withColumn("home", home), "simhash-homes")
    n_tiles = F.greatest(F.ceil(F.sum("n") / tile_rows), F.ceil(F.sum("held") * 8 / tile_bytes)).cast("int")
    counts = homes.groupBy("raw", "size", "home").agg(n_tiles.alias("n_tiles"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for body in batch.column("body"):
                found = {xxhash.xxh64_intdigest(x) for x in shingles(body.as_py().translate(LOWER).split(), shingle)}
                parts.append(np.sort(np.fromiter(found, dtype="<u8", count=len(found))).tobytes())
            yield batch.drop_columns(["body"]).append_column("parts", pa.array(parts, pa.binary()))

    key = ["raw", "size", "home", "tile"]
    dealt = sized.join(homes.select("raw", "size", "root", "home"), ["raw", "size", "root"]).join(
        counts, ["raw", "size", "home"]
    )
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("n_tiles")).cast("int"))
    dealt = dealt.select(*key, "id", "root", "fingerprint").join(texts.select("id", utf8(F.col("text")).alias("body")), "id")
    row = T.StructType([*dealt.drop("body").schema.fields, T.StructField("parts", T.BinaryType())])
    rows = F.collect_list(F.struct("id", "root", "fingerprint", "parts")).alias("rows")
    tiles = staged(dealt.mapInArrow(hashed, row).groupBy(*key).agg(rows), "simhash-apart-tiles")

    here = tiles.select("raw", "size", F.struct("home", "tile").alias("x"), F.explode(F.array(F.lit(0), F.lit(1))).alias("step"))
    there = tiles.select("raw", F.col("size").alias("size2"), F.struct("home", "tile").alias("y"))
    one_root = (F.col("x.home") != "") & (F.col("x.home") == F.col("y.home"))
    pairs = here.withColumn("size2", F.col("size") + F.col("step")).join(there, ["raw", "size2"])
    pairs = pairs.where(((F.col("step") == 1) | (F.col("x") <= F.col("y"))) & ~one_root)
    own = (F.col("step") == 0) & (F.col("x") == F.col("y"))
    named = lambda size, at, name: tiles.select(
        "raw", F.col("size").alias(size), F.struct("home", "tile").alias(at), F.col("rows").alias(name)
    )
    work = pairs.withColumn("own", own).join(named("size", "x", "one"), ["raw", "size", "x"])
    work = work.join(named("size2", "y", "two"), ["raw", "size2", "y"])
    work = work.select("one", F.when(~F.col("own"), F.col("two")).alias("two"))

    def unpacked(rows: list) -> tuple:
        prints = np.frombuffer(bytes.fromhex("".join(r["fingerprint"] for r in rows)), dtype=">u8")
        parts = [np.frombuffer(r["parts"], dtype="<u8") for r in rows]
        sizes = np.array([len(x) for x in parts])
        return prints.reshape(-1, words).astype(np.uint64), np.array([r["root"] for r in rows]), parts, sizes

    by_size = isinstance(radius, np.ndarray)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("a", pa.string()), ("b", pa.string())])
        for batch in batches:
            for x, y in zip(batch.column("one"), batch.column("two"), strict=True):
                one = x.as_py()
                two = y.as_py() if y.is_valid else one
                (prints, root, parts, size), (prints2, root2, parts2, size2) = unpacked(one), unpacked(two)
                sizes = (size, size2) if by_size else None
                i, j, d = tile_links(prints, prints2 if y.is_valid else None, radius, sizes=sizes)
                keep = root[i] != root2[j]
                i, j, d = i[keep], j[keep], d[keep]
                if not len(i):
                    continue
                (u, at), (v, at2) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
                shared = shared_parts([parts[k] for k in u], [parts2[k] for k in v])[at, at2]
                keep = shared >= least * (size[i] + size2[j] - shared)
                i, j, d = i[keep], j[keep], d[keep]
                shift = len(one) if y.is_valid else 0
                kept = nearest_forest(i, j + shift, d, shift + len(two))
                found = {"a": [one[k]["id"] for k in i[kept]], "b": [two[k]["id"] for k in j[kept]]}
                yield pa.RecordBatch.from_pydict(found, schema=out)

    return work.mapInArrow(compare, "a string, b string")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``key``, fingerprint and component_id: the least key reachable over fingerprints within ``radius`` bits.

    One row per input row; equal fingerprints are linked, those of empty texts too. A row with a null key
    belongs to its component but is not its least key; a component of null keys alone has a null id. Rows
    that share a key but not a fingerprint are told apart. Other input columns are not read.
    """
    prints = staged(fingerprints(docs, [key], text, shingle).drop("n_shingles"), "simhash-prints")
    # The fingerprint itself stands for its class.
    classes = prints.groupBy("fingerprint").agg(F.min(F.col(f"`{key}`")).alias("least"))
    ids = classes.select(F.col("fingerprint").alias("id"), "fingerprint", F.lit(0).cast("long").alias("n_shingles"))
    roots = components(link_classes(ids, radius, words=1, id_bytes=8)).withColumnRenamed("node", "fingerprint")
    rooted = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = staged(rooted.select("fingerprint", "root").join(least, "root").drop("root"), "simhash-ids")
    return prints.join(ids, "fingerprint").select(F.col(f"`{key}`"), "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    least_similarity: float = 0.8,
    words: int = 4,
    tail: float = 1e-6,
) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``.

    Links: fingerprints of ``words`` x 64 bits over the distinct shingles, confirmed on the shingle sets. The
    radius follows from the two numbers of shingles: a pair of ``least_similarity`` itself lies beyond it with a
    chance of at most ``tail``. Of 256 bits that is about 68, for few shingles up to 80, while texts without
    common shingles differ by 128.
    The links nearest to each other are confirmed first (a spanning forest and three a text), then all links
    between texts that these have not joined (``links_apart``), so no link that would join groups is left out.
    Of a group the row with the least key stays, null keys last; of repeated rows one stays. Null and empty
    texts are one group. No column name is reserved.
    """
    rows = staged(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            F.col(f"`{key}`").alias("key"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
            F.monotonically_increasing_id().alias("row_id"),
        ).withColumn("id", F.md5(F.col("text").cast("binary"))),
        "simhash-rows",
    )
    prints = staged(
        fingerprints(rows, ["row_id", "key", "id"], "text", shingle, words, distinct=True), "simhash-prints"
    )
    classes = prints.groupBy("id").agg(
        F.min("fingerprint").alias("fingerprint"), F.min("n_shingles").alias("n_shingles"), F.min("row_id").alias("row_id")
    )
    radius = radii_by_size(least_similarity, 64 * words, tail)
    width = int(radius.max()) + 1
    links = staged(
        link_classes(classes, radius, words, 1, width, least_similarity, each=3).drop("bits"), "simhash-links"
    )
    ends = staged(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes, "id").select("row_id"), "simhash-ends")
    texts = staged(rows.join(if_small(ends), "row_id").select("id", "text"), "simhash-texts")
    confirmed = staged(verified(links, texts, shingle, least_similarity), "simhash-confirmed")
    # The links span all pairs within the radius: more of them can only lie within one of their components.
    raw = components(links).select(F.col("node").alias("id"), F.col("root").alias("raw"))
    joined = components(confirmed).withColumnRenamed("node", "id")
    nodes = texts.select("id").join(classes.drop("row_id"), "id").join(raw, "id", "left").join(joined, "id", "left")
    nodes = nodes.withColumns({"raw": F.coalesce("raw", "id"), "root": F.coalesce("root", "id")})
    split = nodes.groupBy("raw").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    nodes = staged(nodes.join(split.select("raw"), "raw"), "simhash-apart")
    confirmed = confirmed.union(links_apart(nodes, texts, shingle, least_similarity, radius, words))
    roots = components(confirmed).withColumnRenamed("node", "id")

    grouped = prints.select("row_id", "key", "id").join(roots, "id", "left")
    grouped = grouped.select("row_id", "key", F.coalesce("root", "id").alias("root"))
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "row_id"))
    best = grouped.groupBy("root").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    lost = grouped.join(best.select("root", F.col("first.row_id").alias("stays")), "root").where("row_id <> stays")
    lost = staged(lost.select("row_id"), "simhash-lost")
    return rows.join(if_small(lost), "row_id", "left_anti").select("row.*")
