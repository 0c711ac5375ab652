"""Benchmark windows: hits, items and removals against a plain version, blocks of the benchmark, awkward rows."""

import hashlib
import re

import pytest

from tallyweave.llm import decontaminate as D
from tallyweave.llm.queries import QUERIES

PASSAGE = " ".join(f"p{i}" for i in range(15))
ITEMS = [(1, PASSAGE), (2, "Short Item"), (3, None), (4, ""), (5, "é ü"), (6, PASSAGE + " tail"), (None, "no key"), (2, "Short Item")]
ROWS = [
    (1, None), (2, ""), (3, PASSAGE.upper()), (3, PASSAGE.upper()), (None, f"a {PASSAGE} b"), (4, "short, item! " + "w " * 38),
    (5, "short item " + "w " * 39), (6, " ".join(PASSAGE.split()[:12])), (7, "x É ü"), (8, "x é ü"), (9, "w " * 60_000 + PASSAGE), (10, "-- !?"),
]


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_scan(docs, items, window=13):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        width = min(window, len(words))
        if item is not None and width:
            for i in range(len(words) - width + 1):
                windows.setdefault(tuple(words[i : i + width]), set()).add(str(item))
    out = []
    for key, text in docs:
        words, hit, met = plain_words(text), set(), set()
        for width in {len(w) for w in windows}:
            for i in range(len(words) - width + 1):
                if found := windows.get(tuple(words[i : i + width])):
                    hit.update(range(i, i + width))
                    met |= found
        out.append((key, len(words), len(hit), tuple(sorted(met)), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def told(frame):
    """Rows of a scan in the form of the plain version."""
    picked = frame.select("doc_id", "scan.n_words", D.n_hit().alias("n_hit"), "scan.items", D.is_contaminated().alias("bad"))
    return [(r[0], r[1], r[2], tuple(r[3]), r[4]) for r in picked.collect()]


def in_order(rows):
    return sorted(rows, key=str)


def frames(spark):
    docs = spark.createDataFrame([(k, t, "a", "b", 1) for k, t in ROWS], "doc_id long, text string, row string, body string, n_words int")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_query_against_brute_force(spark, sf, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op3_decontamination"](spark, sf).collect()]
    digest = lambda met: hashlib.sha256(",".join(met).encode()).hexdigest()
    want = [(k, n, h, len(met), digest(met), bad) for k, n, h, met, bad in plain_scan(texts, items)]
    assert in_order(got) == in_order(want) and any(r[-1] for r in got)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_awkward_rows_in_one_block_and_in_several(spark, block_bytes):
    docs, items = frames(spark)
    found = D.scan_texts(docs, items, block_bytes=block_bytes)
    assert found.columns == [*docs.columns, "scan"]
    assert in_order(told(found)) == in_order(plain_scan(ROWS, ITEMS))


def test_removals(spark):
    docs, items = frames(spark)
    bad = [r[4] for r in plain_scan(ROWS, ITEMS)]
    kept = D.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert in_order((r["doc_id"], r["text"]) for r in kept.collect()) == in_order(r for r, b in zip(ROWS, bad, strict=True) if not b)
    cut = D.remove_spans(docs, items)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert left[1] is None and plain_words(left[None]) == ["a", "b"] and plain_words(left[3]) == []
    assert left[6] == ROWS[7][1] and left[7] == "x É ü" and plain_words(left[9]) == ["w"] * 60_000


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert D.scan_texts(docs.limit(0), items).collect() == []
    assert D.remove_documents(docs, items.limit(0)).count() == len(ROWS)


def test_an_item_beyond_the_block_size_is_refused(spark):
    docs, items = frames(spark)
    with pytest.raises(ValueError):
        D.scan_texts(docs, items, block_bytes=20)
