"""Factorization machine: naive pair sums, planted pairs, the labelled sample, scores of awkward rows."""

import math

import numpy as np
import pytest

from tallyweave.llm import toxicity as X
from tallyweave.llm.queries import QUERIES


def naive_score(machine, text):
    """Score by every pair of terms, one by one."""
    terms = [i for i, b in enumerate(machine.buckets) if b in set(X.Terms().of((text or "").encode()))]
    margin = machine.bias + sum(float(machine.weights[i]) for i in terms)
    for at, i in enumerate(terms):
        for j in terms[at + 1 :]:
            margin += sum(float(a) * float(b) for a, b in zip(machine.factors[i], machine.factors[j], strict=True))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, margin))))


def test_scores_equal_sums_over_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(None, None, 1), (1, "", 2), (2, "foolish people", 3), (2, "foolish people", 3), (3, "x" * 100_000, 4)]
    rows += [(i, " ".join(f"word{j}" for j in rng.integers(0, 60, 25)), 5) for i in range(10, 40)]
    words = sorted({b for i in range(60) for b in X.buckets_of(f"word{i}".encode())} | set(X.buckets_of(b"foolish")))
    machine = X.Machine(np.array(words), 8)
    machine.bias, machine.weights = -0.5, rng.normal(0, 0.3, len(words))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic_score int")
    got = X.score_texts(docs, machine, ["doc_id", "text", "toxic_score"]).collect()
    assert len(got) == len(rows)
    assert all(r["toxic_score"] == pytest.approx(naive_score(machine, r["text"])) for r in got)


def planted(kind, n=4000, share=0.1, seed=1):
    """Texts whose label depends on two terms together; neither tells anything alone."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for _ in range(n):
        terms = list(1000 + rng.zipf(1.3, 30) % 5000)
        if kind == "either":
            one, two = rng.random() < 0.5, rng.random() < 0.5
            terms += [1] * one + [2] * two
            labels.append(one != two)
        else:
            labels.append(rng.random() < share)
            lot = rng.random()
            insult, group = [10 + rng.integers(30)], [5]
            terms += insult + group if labels[-1] else insult if lot < 0.45 else group if lot < 0.9 else []
        rows.append(np.unique(np.array(terms, dtype=np.int64)))
    return rows, np.array(labels, dtype=float)


@pytest.mark.parametrize("kind", ["either", "insult and group"])
def test_pairs_without_effect_of_their_terms_are_learned(kind):
    rows, labels = planted(kind)
    machine = X.fit_machine(rows[:2000], labels[:2000])
    place = machine.places()
    scores = machine.scores([[place[t] for t in r.tolist() if t in place] for r in rows[2000:]])
    toxic = labels[2000:] > 0
    assert (scores[toxic] >= 0.5).mean() >= 0.9
    assert (scores[~toxic] >= 0.5).mean() <= 0.01


def test_sample_is_bounded_and_keeps_rare_labels(spark):
    known = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(20_000)], "key long, label int").repartition(7)
    taken, likelier = X.labelled_sample(known, 1_000)
    labels = [r["label"] for r in taken.collect()]
    assert len(labels) == 1_000 and sum(labels) == 200  # all toxic ones
    assert likelier == pytest.approx(math.log(1 / (800 / 19_800)))
    taken, _ = X.labelled_sample(known, 100)
    labels = [r["label"] for r in taken.collect()]
    assert len(labels) == 100 and sum(labels) == 50
    assert sorted(X.labelled_sample(known.repartition(3), 100)[0].collect()) == sorted(taken.collect())
    everything, likelier = X.labelled_sample(known, 50_000)
    assert everything.count() == 20_000 and likelier == 0
    none, likelier = X.labelled_sample(known.limit(0), 100)
    assert none.count() == 0 and likelier == 0
    assert X.labelled_sample(known.where("label = 1"), 100)[0].count() == 100


def test_tables_of_few_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, ""), (3, "b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    for some in (labels, labels.where("toxic = 0"), labels.limit(0)):
        machine = X.train(docs, some)
        scores = [r["toxic_score"] for r in X.score_texts(docs, machine, ["doc_id"]).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
        assert X.score_texts(docs.limit(0), machine, ["doc_id"]).count() == 0


def test_query_covers_all_documents(spark, sf):
    rows = QUERIES["op2_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
