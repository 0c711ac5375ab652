"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct words (runs of ASCII letters, digits and non-ASCII characters, A-Z in lower
case) and the first four and five bytes of longer words, hashed into 2**20 buckets. The machine scores a
set of terms by bias + sum of w_i + sum over pairs of <v_i, v_j>, so that two terms together can mean more
(an insult and the group it is aimed at) or less than each by itself.

It is fitted on a bounded sample of labelled documents, at most ``sample`` of them, of which toxic ones take
up to a half, so that rare toxicity is not lost; the bias is set back to the true share afterwards. Two kinds
of terms become inputs. Terms that tell by themselves: their share in toxic texts differs from that in others
by many standard errors. And terms that tell only with others: a pilot machine over all terms of at least five
sample texts learns their factors under a pull to zero that is constant per term, whatever its support, so that
factors stay large only where pairs with other terms explain labels; the ``paired`` largest join. The fit is
mini-batch AdaGrad in one task over at most ``sample`` sparse rows. Then all documents are scored where they lie, whole, by the
broadcast machine.
"""

from __future__ import annotations

import io
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.decontaminate import words_of
from tallyweave.llm.frames import fold, utf8

BUCKETS = 1 << 20
PREFIXES = (4, 5)
CACHED_WORDS = 400_000


def buckets_of(word: bytes) -> tuple[int, ...]:
    """Hashed terms of a word: itself, and its first bytes if it is longer than these."""
    out = [zlib.crc32(word) % BUCKETS]
    out += [zlib.crc32(word[:n], n) % BUCKETS for n in PREFIXES if len(word) > n]
    return tuple(out)


class Terms:
    """Terms of texts; words met before are looked up."""

    def __init__(self, places: dict[int, int] | None = None):
        self.places, self.cache = places, {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        found = self.cache.get(word)
        if found is None:
            found = buckets_of(word)
            if self.places is not None:
                found = tuple(self.places[b] for b in found if b in self.places)
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def of(self, text: bytes) -> list[int]:
        found: set[int] = set()
        for word in set(words_of(text)):
            found.update(self.of_word(word))
        return sorted(found)


def _per_row(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each row's span; an empty row has 0."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]))
    filled = np.flatnonzero(np.diff(starts))
    if len(filled):
        out[filled] = np.add.reduceat(values, starts[:-1][filled], axis=0)
    return out


class Machine:
    """bias, weights (n) and factors (n x k) over chosen buckets; an unfitted machine scores by its bias."""

    def __init__(self, buckets: np.ndarray, k: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.buckets, self.bias = buckets, 0.0
        self.weights = np.zeros(len(buckets))
        self.factors = rng.normal(0, 0.1, (len(buckets), k))

    def places(self) -> dict[int, int]:
        return {int(b): i for i, b in enumerate(self.buckets)}

    def margins(self, terms: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margin and factor sum of each row; row r has the terms from starts[r] to starts[r + 1]."""
        v = self.factors[terms]
        sums = _per_row(v, starts)
        squares = _per_row(np.einsum("ij,ij->i", v, v), starts)
        return self.bias + _per_row(self.weights[terms], starts) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
        terms = np.fromiter((t for r in rows for t in r), dtype=np.int64, count=int(starts[-1]))
        return 1 / (1 + np.exp(-np.clip(self.margins(terms, starts)[0], -60, 60)))

    def fit(
        self,
        rows: list[np.ndarray],
        labels: np.ndarray,
        epochs: int,
        shrink: np.ndarray | float,
        factor_shrink: np.ndarray | float,
        batch: int,
        seed: int,
        rate: float = 0.1,
        factor_rate: float = 0.05,
    ) -> Machine:
        """Mini-batch AdaGrad. The shrinks pull a term to zero in each batch that holds it: a number, or one a term."""
        rng = np.random.default_rng(seed)
        shrink, factor_shrink = (np.broadcast_to(x, self.weights.shape) for x in (shrink, factor_shrink))
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3) if len(labels) else 1e-3
        self.bias = float(np.log(share / (1 - share)))
        seen_w, seen_v, seen_b = np.full(len(self.weights), 1e-6), np.full(self.factors.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                some = [rows[i] for i in chosen]
                sizes = np.array([len(r) for r in some])
                terms = np.concatenate(some)
                margin, sums = self.margins(terms, np.concatenate(([0], np.cumsum(sizes))))
                slope = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels[chosen]) / batch
                g_b = slope.sum() * batch / len(chosen)
                seen_b += g_b**2
                self.bias -= rate * g_b / np.sqrt(seen_b)
                if not len(terms):
                    continue
                row = np.repeat(np.arange(len(some)), sizes)
                by_term = np.argsort(terms, kind="stable")
                ordered = terms[by_term]
                first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
                used = ordered[first]
                here = slope[row]
                pull = here[:, None] * (sums[row] - self.factors[terms])
                g_w = np.add.reduceat(here[by_term], first) + shrink[used] * self.weights[used]
                g_v = np.add.reduceat(pull[by_term], first, axis=0) + factor_shrink[used, None] * self.factors[used]
                seen_w[used] += g_w**2
                seen_v[used] += g_v**2
                self.weights[used] -= rate * g_w / np.sqrt(seen_w[used])
                self.factors[used] -= factor_rate * g_v / np.sqrt(seen_v[used])
        return self

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, buckets=self.buckets, bias=self.bias, weights=self.weights, factors=self.factors)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Machine:
        held = np.load(io.BytesIO(data))
        out = cls(held["buckets"], held["factors"].shape[1])
        out.bias, out.weights, out.factors = float(held["bias"]), held["weights"], held["factors"]
        return out


def choose_terms(rows: list[np.ndarray], labels: np.ndarray, most: int, errors: float, least_texts: int) -> np.ndarray:
    """Buckets whose share of texts differs most, in standard errors, between the two labels."""
    terms = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    marks = np.repeat(labels, [len(r) for r in rows])
    with_term = np.bincount(terms, minlength=BUCKETS)
    toxic_with = np.bincount(terms, marks, minlength=BUCKETS)
    n, n_toxic = max(1, len(labels)), labels.sum()
    share = with_term / n
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * n_toxic * (1 - n_toxic / n)) + 1e-9
    apart = np.abs(toxic_with - share * n_toxic) / error
    apart[with_term < least_texts] = 0
    best = np.argsort(-apart, kind="stable")[:most]
    return np.sort(best[apart[best] >= errors])


def _per_batch(support: np.ndarray, n_rows: int, batch: int) -> np.ndarray:
    """What a prior that counts once in a pass over the rows weighs in each batch that holds the term."""
    return 1 / np.minimum(n_rows, batch * np.maximum(1, support))


def paired_terms(
    rows: list[np.ndarray],
    labels: np.ndarray,
    most: int,
    least_texts: int,
    k: int,
    batch: int,
    seed: int,
    steps: int = 1000,
    pull: float = 5.0,
    factor_pull: float = 15.0,
) -> np.ndarray:
    """Buckets whose factors a pilot machine over all terms of ``least_texts`` texts or more keeps largest.

    ``pull`` and ``factor_pull`` are the precisions of normal priors. Factors that end below 0.2 are no
    evidence of pairs. At least ``steps`` batches and three passes are made.
    """
    support = np.bincount(np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64), minlength=BUCKETS)
    buckets = np.flatnonzero(support >= least_texts)
    if not len(buckets) or labels.min() == labels.max():
        return buckets[:0]
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[buckets] = np.arange(len(buckets))
    inner = [p[p >= 0] for p in (place[r] for r in rows)]
    each = _per_batch(support[buckets], len(rows), batch)
    epochs = max(3, math.ceil(steps * batch / len(rows)))
    pilot = Machine(buckets, k, seed).fit(inner, labels, epochs, pull * each, factor_pull * each, batch, seed)
    size = np.sqrt((pilot.factors**2).sum(axis=1))
    best = np.argsort(-size, kind="stable")[:most]
    return np.sort(buckets[best[size[best] >= 0.2]])


def fit_machine(
    rows: list[np.ndarray],
    labels: np.ndarray,
    terms: int = 4096,
    paired: int = 256,
    errors: float = 4.0,
    least_texts: int = 5,
    k: int = 8,
    steps: int = 2000,
    pull: float = 1.0,
    factor_pull: float = 3.0,
    batch: int = 64,
    seed: int = 3,
) -> Machine:
    """A machine over the terms that tell alone and in pairs; at least ``steps`` batches and twelve passes."""
    alone = choose_terms(rows, labels, terms, errors, least_texts)
    together = paired_terms(rows, labels, paired, least_texts, k, batch, seed)
    machine = Machine(np.union1d(alone, together), k, seed)
    if not len(rows):
        return machine.fit(rows, labels, 0, 0.0, 0.0, batch, seed)
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[machine.buckets] = np.arange(len(machine.buckets))
    inner = [p[p >= 0] for p in (place[r] for r in rows)]
    support = np.bincount(np.concatenate(inner), minlength=len(machine.buckets))
    each = _per_batch(support, len(rows), batch)
    epochs = max(12, math.ceil(steps * batch / len(rows)))
    return machine.fit(inner, labels, epochs, pull * each, factor_pull * each, batch, seed)


def labelled_sample(known: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """At most ``sample`` rows of ``known`` (key, label), and the log of how much likelier a toxic one was taken.

    Toxic rows take up to half of the places, others the rest. A bound of the hash, set from the counts, lets
    little more than the rows to take through, so no task passes on more than its part of them.
    """
    known = known.withColumn("lot", F.shiftrightunsigned(F.xxhash64("key"), 11).cast("double") / F.lit(float(1 << 53)))
    toxic = F.col("label") > 0
    n, n_toxic = known.agg(F.count("*"), F.count(F.when(toxic, 1))).first()
    most_toxic = min(n_toxic, max(sample // 2, sample - (n - n_toxic)))
    parts, shares = [], []
    for mine, there, most in ((toxic, n_toxic, most_toxic), (~toxic, n - n_toxic, min(n - n_toxic, sample - most_toxic))):
        bound = min(1.0, (most + 8 * math.sqrt(most) + 8) / max(1, there))
        part = known.where(mine)
        if most < there:
            part = part.where(F.col("lot") < bound).orderBy("lot", "key").limit(most)
        parts.append(part.select("key", "label"))
        shares.append(most / there if there else 1.0)
    return parts[0].union(parts[1]), math.log(shares[0] / shares[1]) if min(shares) > 0 else 0.0


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 20_000
) -> Machine:
    """A machine fitted on the labelled documents outside fold 0, at most ``sample`` of their keys.

    Rows with a null key or label are not learned from; if a key has several labels the larger counts.
    Without any label the machine gives every text a low score.
    """
    known, likelier = labelled_sample(
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(F.col(key)) != 0))
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).cast("int").alias("label")),
        sample,
    )
    # At most ``sample`` pairs of key and label, so the broadcast is bounded.
    rows = docs.select(F.col(key).alias("key"), utf8(F.col(f"`{text}`")).alias("body")).join(F.broadcast(known), "key")

    def terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Terms()
        for batch in batches:
            found = [held.of(body.as_py()) for body in batch.column("body")]
            arrays = [batch.column("key"), pa.array(found, pa.list_(pa.int32())), batch.column("label")]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "terms", "label"])

    schema = T.StructType([rows.schema["key"], T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("label", T.IntegerType())])

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks = [], []
        for batch in batches:
            column = batch.column("terms")
            held += [np.asarray(x.values, dtype=np.int64) for x in column]
            marks += batch.column("label").to_pylist()
        machine = fit_machine(held, np.array(marks, dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([machine.dump()], pa.binary())], names=["machine"])

    found = rows.mapInArrow(terms, schema).repartition(1).sortWithinPartitions("key", F.xxhash64("terms"))
    dumped = found.mapInArrow(fit, "machine binary").first()
    if not dumped:
        return fit_machine([], np.zeros(0))
    machine = Machine.load(bytes(dumped["machine"]))
    machine.bias -= likelier
    return machine


def _scored(docs: DataFrame, machine: Machine, keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` as a struct ``row``, and toxic_score."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        terms = Terms(fitted.places())
        for batch in batches:
            scores = fitted.scores([terms.of(body.as_py()) for body in batch.column("body")])
            arrays = [batch.column("row"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "toxic_score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), utf8(F.col(f"`{text}`")).alias("body"))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("toxic_score", T.DoubleType())]))


def score_texts(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with toxic_score, from 0 to 1; null and empty texts get the score of no terms.

    One row per input row, repeated rows and null keys included. A column named toxic_score is replaced.
    """
    return _scored(docs, machine, [c for c in keep if c != "toxic_score"], text).select("row.*", "toxic_score")


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a score below ``least``, with the columns of ``docs``; no column name is reserved."""
    scored = _scored(docs, train(docs, labels, key, text), docs.columns, text)
    return scored.where(F.col("toxic_score") < least).select("row.*")
