"""Poisson replication: counts of copies against a plain inversion, shares of sources, awkward rows."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from tallyweave.llm.mixing import mix_sources
from tallyweave.llm.queries import QUERIES


def plain_counts(docs, weight_of, seed=7):
    """Copies by (doc_id, text) for rows (doc_id, text, source) whose rates are at most 400."""
    held = Counter()
    for _, text, source in docs:
        held[source] += len((text or "").encode()) + 1
    weights = {s: weight_of(s, n) for s, n in held.items()}
    out = Counter()
    for key, text, source in docs:
        mean = weights[source] / (sum(weights.values()) or 1.0) * sum(held.values()) / held[source]
        place = int(hashlib.md5(f"{seed}:1:{'null' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
        n, p = 0, math.exp(-mean)
        total = p
        while total <= place and n < 2000:
            n += 1
            p *= mean / n
            total += p
        out[key, text] += n
    return Counter({k: n for k, n in out.items() if n})


def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = QUERIES["op7_mixing"](spark, sf).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == plain_counts(docs, lambda s, n: n**0.5)
    copies = defaultdict(list)
    for r in got:
        copies[r["doc_id"]].append(r["mix_copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())


ROWS = [(None, None, None), (None, "", None), (1, "a b", "s"), (1, "a b", "s"), (2, "é", "s"), (3, "x" * 200_000, "t"), (4, "", "t"), (5, None, "u")]
FIELDS = "doc_id long, text string, source string, mix_copy string, rate double, cdf int, held int"


def awkward(spark):
    return spark.createDataFrame([(*r, "old", 0.5, 1, 2) for r in ROWS], FIELDS)


@pytest.mark.parametrize("weights", [None, {"s": 0.004, "t": 1.0, "u": 0.002}, {}])
def test_awkward_rows(spark, weights):
    weight_of = (lambda s, n: n**0.9) if weights is None else lambda s, n: weights.get(s, 0.0)
    out = mix_sources(awkward(spark), weights=weights, temperature=0.9)
    assert out.columns == ["doc_id", "text", "source", "rate", "cdf", "held", "mix_rate", "mix_copy"]
    rows = out.collect()
    assert all(r["mix_rate"] <= 400 for r in rows)  # what the plain version covers
    assert Counter((r["doc_id"], r["text"]) for r in rows) == plain_counts(ROWS, weight_of)


def test_empty_table(spark):
    assert mix_sources(awkward(spark).limit(0)).collect() == []


def test_large_rates_and_target_shares(spark):
    """A source of a thousandth of the bytes that shall fill half of the mix: its rate is beyond one draw."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', 99) AS text", "IF(id < 4, 'rare', 'rest') AS source")
    by_source = {r["source"]: r["n"] for r in mix_sources(docs, weights={"rare": 1.0, "rest": 1.0}).groupBy("source").agg({"*": "count"}).toDF("source", "n").collect()}
    # Means of 2000 copies each; six standard deviations of a Poisson number.
    assert all(abs(by_source[s] - 2000) <= 6 * math.sqrt(2000) for s in ("rare", "rest"))


def test_same_copies_on_any_partitioning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = lambda d: Counter((r["doc_id"], r["mix_copy"]) for r in mix_sources(d).select("doc_id", "mix_copy").collect())
    assert counts(docs) == counts(docs.repartition(13))


def test_rows_without_a_key_draw_apart(spark):
    """A third of the rows has no key: they are neither lost nor repeated together, and the source keeps its share."""
    docs = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, NULL, id) AS doc_id", "concat('text ', lpad(id div 2, 6, '0')) AS text", "id AS url", "IF(id % 2 = 0, 'a', 'b') AS source"
    )
    out = mix_sources(docs, weights={"a": 1.0, "b": 1.0}).where("doc_id IS NULL").groupBy("url", "source").count().collect()
    copies = Counter(r["count"] for r in out)
    # 2000 rows at a rate of 1: Poisson counts, six standard deviations.
    for n in range(4):
        share = math.exp(-1) / math.factorial(n)
        seen = copies[n] if n else 2000 - len(out)
        assert abs(seen - 2000 * share) <= 6 * math.sqrt(2000 * share * (1 - share))
    by_source = Counter()
    for r in out:
        by_source[r["source"]] += r["count"]
    assert all(abs(by_source[s] - 1000) <= 6 * math.sqrt(1000) for s in "ab")
