"""Benchmark decontamination: word windows of the test items, looked for in every training text.

Words are runs of ASCII letters and digits and non-ASCII characters, with A-Z lower-cased. A window
is 13 consecutive words of an item; an item with fewer words, but not none, is one window. Texts are
scanned where they lie, without a shuffle: words become numbers through a broadcast dictionary of the
benchmark's words, windows become 64-bit rolling hashes, hash hits are verified word by word.

The broadcast is bounded: the benchmark is cut by size into blocks of at most ``block_bytes`` of text.
One block is the rule; with more, the texts pass through one scan per block in the same task, each
scan with its own block, and carry their hits along. So any size of benchmark works alike.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.frames import WORD_BYTES, utf8

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive numbers."""
    out = np.zeros(len(ids) - width + 1, dtype=np.uint64)
    for j in range(width):
        out *= BASE
        out += ids[j : j + len(out)]
    return out


class WindowSet:
    """Windows of some items: by width their sorted rolling hashes, and where each stands in ``flat``."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.ids: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        flat, by_width, at = [], defaultdict(list), 0
        for k, (_, text) in enumerate(items):
            numbers = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)], dtype=np.uint64)
            width = min(window, len(numbers))
            if width:
                value = rolling(numbers, width)
                by_width[width].append((value, at + np.arange(len(value)), np.full(len(value), k)))
            flat.append(numbers)
            at += len(numbers)
        self.flat = np.concatenate([*flat, np.zeros(0, dtype=np.uint64)])
        self.widths = {}
        for width, found in by_width.items():
            value, start, item = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(value, kind="stable")
            self.widths[width] = value[order], start[order], item[order]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Marks of the words that lie in an occurrence of a window, and the items met."""
        n = len(words)
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in words), dtype=np.uint64, count=n)
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        hit, met = np.zeros(n, dtype=bool), set()
        for width, (hashes, starts, items) in self.widths.items():
            if n < width:
                continue
            at = np.flatnonzero(unknown[width:] == unknown[: n - width + 1])  # no word foreign to the benchmark
            if not len(at):
                continue
            value = rolling(ids, width)[at]
            low, high = np.searchsorted(hashes, value), np.searchsorted(hashes, value, side="right")
            many = high - low
            if not many.any():
                continue
            place = np.repeat(at, many)
            entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(len(place))
            step = np.arange(width)
            same = (ids[place[:, None] + step] == self.flat[starts[entry][:, None] + step]).all(axis=1)
            for i in np.unique(place[same]).tolist():
                hit[i : i + width] = True
            met.update(self.items[k] for k in np.unique(items[entry[same]]).tolist())
        return hit, met


def ranges_of(marks: np.ndarray) -> list[int]:
    """Start and end of each run of marks, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0])))).tolist()


def cut(text: bytes, ranges: list[int]) -> bytes:
    """The text without the words in these ranges, and without what stands between them."""
    at = [m.span() for m in WORD.finditer(text.translate(WORD_BYTES))]
    out, last = [], 0
    for first, end in zip(ranges[::2], ranges[1::2], strict=True):
        out.append(text[last : at[first][0]])
        last = at[end - 1][1]
    return b"".join([*out, text[last:]])


def _blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The items, dealt by hash to as many frames as their size asks for; each fits the driver and a broadcast."""
    body = utf8(F.col(text))
    rows = items.select(F.col(key).cast("string").alias("item"), body.alias("body")).where("item is not null")
    held = rows.agg(F.sum(F.octet_length("body") + 64), F.max(F.octet_length("body"))).first()
    if (held[1] or 0) > block_bytes:
        raise ValueError(f"a benchmark item has {held[1]} bytes; block_bytes is {block_bytes}")
    # Half-filled on average, so that an uneven deal still keeps within the bound.
    n = 1 if (held[0] or 0) <= block_bytes else -(-2 * held[0] // block_bytes)
    block = F.pmod(F.xxhash64("item"), F.lit(n))
    return [rows.where(block == b) if n > 1 else rows for b in range(n)]


def scan_texts(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    block_bytes: int = 16 << 20,
    keep: list[str] | None = None,
    cleaned: bool = False,
) -> DataFrame:
    """Columns ``keep`` (all) with a struct column ``scan``: n_words, ranges (array of word ranges hit), items, and with
    ``cleaned`` the text without its hit spans.

    An input column named scan is replaced. Null texts have no words. One row per input row, so repeated
    rows, null keys and clashing names of other columns do no harm. Items that are null, empty or have a
    null key hit nothing; without items nothing is hit.
    """
    spark = docs.sparkSession
    others = [c for c in (docs.columns if keep is None else keep) if c != "scan"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        utf8(F.col(f"`{text}`")).alias("body"),
        F.lit(0).alias("n_words"),
        F.expr("cast(array() as array<int>)").alias("ranges"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    schema = rows.schema
    blocks = _blocks(items, item_key, item_text, block_bytes)
    for b, block in enumerate(blocks):
        held = spark.sparkContext.broadcast(
            WindowSet([(r["item"], bytes(r["body"])) for r in block.toLocalIterator()], window)
        )
        last = b == len(blocks) - 1

        def run(batches: Iterator[pa.RecordBatch], held=held, last=last) -> Iterator[pa.RecordBatch]:
            windows = held.value
            for batch in batches:
                bodies = batch.column("body")
                n_words, ranges, met, out = [], [], [], []
                before = zip(batch.column("ranges").to_pylist(), batch.column("items").to_pylist(), strict=True)
                for body, (old_ranges, old_items) in zip(bodies, before, strict=True):
                    body = body.as_py()
                    words = words_of(body)
                    hit, items_met = windows.scan(words)
                    for first, end in zip(old_ranges[::2], old_ranges[1::2], strict=True):
                        hit[first:end] = True
                    n_words.append(len(words))
                    ranges.append(ranges_of(hit))
                    met.append(sorted(items_met.union(old_items)))
                    if last:
                        out.append(cut(body, ranges[-1]) if cleaned and ranges[-1] else body if cleaned else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row"),
                        pa.array(out, pa.binary()) if last else bodies,
                        pa.array(n_words, pa.int32()),
                        pa.array(ranges, pa.list_(pa.int32())),
                        pa.array(met, pa.list_(pa.string())),
                    ],
                    names=["row", "body", "n_words", "ranges", "items"],
                )

        rows = rows.mapInArrow(run, schema)
    found = [F.col("n_words"), F.col("ranges"), F.col("items")]
    if cleaned:
        found.append(F.col("body").cast("string").alias("cleaned"))
    return rows.select("row.*", F.struct(*found).alias("scan"))


def n_hit(scan: str = "scan"):
    """Number of words hit, from the ranges of a scan."""
    ranges = F.col(f"{scan}.ranges")
    return F.aggregate(
        F.transform(ranges, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda a, b: a + b
    ).cast("long")


def is_contaminated(share: int = 20, scan: str = "scan"):
    """At least one word hit, and hits are at least one word in ``share``."""
    return (n_hit(scan) > 0) & (share * n_hit(scan) >= F.col(f"{scan}.n_words"))


def remove_documents(docs: DataFrame, items: DataFrame, share: int = 20, **options) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``."""
    return scan_texts(docs, items, **options).where(~is_contaminated(share)).select(*[f"`{c}`" for c in docs.columns])


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents with the hit spans cut out of their texts; a null text stays null."""
    found = scan_texts(docs, items, text=text, cleaned=True, **options)
    body = F.when(F.col(f"`{text}`").isNotNull(), F.col("scan.cleaned"))
    return found.select(*[body.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
