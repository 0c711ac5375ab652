"""Class-based bigram language model with classes from exchange clustering.

P(word | previous word) = P(class | previous class) * P(word | class).

Counts are taken over all training texts. The ``clustered`` most frequent words get their classes by
exchange: each word in turn of its half moves to the class that raises the likelihood of the class
bigrams most. A round counts, in Spark, how often each word stands before and after each class, and scores
all moves from these counts; only the class of each clustered word and the class bigrams, both of fixed
size, reach the driver. During the exchange all other words stand in classes given by their shape (last
byte, accents, length).

Then every other training word, however rare, moves from its shape to the class under which the places
where it stands are likeliest; its places are counted by the pair of classes around it, in one grouped
pass. The table (word, n, class) stays in Spark and is joined when texts are scored. A word outside the
clustered ones holds less than one part in ``clustered`` of all tokens, so no key of that pass or join is
hot. Shapes are left to words not met in training.

A word has its relative frequency in its class; the unseen of a shape have half a token of all. Transitions
are smoothed towards the frequency of the class. Class bigrams are exact but for pairs of two words outside
the clustered ones, which are dealt out by the margins of their classes. All probabilities sum to one.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.frames import LOWER, fold, utf8
from tallyweave.session import staged

SHAPES = 16  # shape classes
HELD_ROWS = 150_000  # rows of counts that a task gathers before it passes them on
PIECE_BYTES = 1 << 20  # texts tokenised at once; a longer text is a piece of its own
SCORED_PLACES = 1 << 16  # places scored at once when words outside the clustered ones get classes

_LOWER = np.frombuffer(LOWER, dtype=np.uint8)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def words_of(bodies: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts and the text of each: runs of anything but blanks and tabs to carriage returns, A-Z in lower case."""
    none, offsets, values = bodies.buffers()
    starts = np.frombuffer(offsets, dtype=np.int32)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
    data = np.frombuffer(values or b"", dtype=np.uint8)[starts[0] : starts[-1]]
    starts -= starts[0]
    data = _LOWER[data]
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = starts[:-1][np.diff(starts) > 0]
    first[edges] = solid[edges]  # a word ends with its text
    at = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    packed = data[solid]
    cuts = np.append(0, np.cumsum(np.flatnonzero(last) - at + 1)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cuts), pa.py_buffer(packed)])
    return words, np.searchsorted(starts, at, side="right") - 1


def shapes_of(words: pa.Array) -> np.ndarray:
    """One of SHAPES classes a word: punctuation at the end, accents, one of four kinds of last letters or lengths."""
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    none, offsets, values = words.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8)[cuts[0] : cuts[-1]]
    cuts -= cuts[0]
    last = data[cuts[1:] - 1].astype(np.int64)
    accents = np.maximum.reduceat(data, cuts[:-1]) >= 0x80
    plain = ((last >= 0x30) & (last <= 0x39)) | ((last >= 0x61) & (last <= 0x7A)) | (last >= 0x80)
    kind = np.where(plain, last % 4, np.minimum(3, np.diff(cuts) // 4))
    return ~plain * 8 + accents * 4 + kind


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to rows of at most PIECE_BYTES of text together, or one row."""
    for batch in batches:
        lengths = pc.binary_length(batch.column("body")).to_numpy()
        start, size = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > PIECE_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)


def _merged(tables: Iterable[pa.Table], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Tables of counts n by ``keys``, added up as far as HELD_ROWS rows go."""
    held, waiting = [], 0

    def added() -> pa.Table:
        found = pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return found.select([*keys, "n_sum"]).rename_columns([*keys, "n"])

    for one in tables:
        held.append(one)
        waiting += len(one)
        if waiting > 2 * HELD_ROWS:
            held = [added()]
            waiting = len(held[0])
            if waiting > HELD_ROWS:
                yield from held[0].combine_chunks().to_batches()
                held, waiting = [], 0
    if held:
        yield from added().combine_chunks().to_batches()


class Vocabulary:
    """Numbers of the held words, most frequent first, then of the shapes, then of the end of a text.

    ``symbol`` maps them to what bigrams are counted of: clustered words, shapes, end.
    """

    def __init__(self, words: list[bytes], clustered: int):
        self.words = pa.array(words, pa.binary())
        self.n_held, self.n_clustered = len(words), min(clustered, len(words))
        self.end = self.n_held + SHAPES
        first = self.n_clustered
        self.n_symbols = first + SHAPES + 1
        self.symbol = np.concatenate(
            (np.arange(first), first + shapes_of(self.words[first:]), np.arange(first, self.n_symbols))
        ).astype(np.int64)

    def numbers(self, words: pa.Array) -> np.ndarray:
        found = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        other = found < 0
        if other.any():
            found[other] = self.n_held + shapes_of(words)[other]
        return found


class Model(NamedTuple):
    """``classes`` and ``emissions`` are indexed by the numbers of the vocabulary; classes are those of exchange,
    then the shapes, then the end."""

    vocabulary: Vocabulary
    classes: np.ndarray
    transitions: np.ndarray  # log10 P(class | previous class)
    emissions: np.ndarray  # log10 P(word | class) of held words; 0 for the unseen of a shape and the end
    totals: np.ndarray  # log10 of the tokens of a class: a word of the joined table has log10(n) less that
    unigrams: np.ndarray  # log10(count + 0.5); 0 for shapes
    known: np.ndarray  # 1 for words met in training and, after training on any text, the end
    n_tokens: int
    n_types: int


def count_words(texts: DataFrame) -> DataFrame:
    """(word binary, n) over all texts (column body)."""

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        for piece in _pieces(batches):
            found = pc.value_counts(words_of(piece.column("body"))[0])
            yield pa.table({"word": found.field("values"), "n": found.field("counts")})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged(tables(batches), ["word"])

    return texts.select("body").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def top_words(counts: DataFrame, held: int) -> list:
    """At most ``held`` words with their counts, most frequent first: all words from some count on.

    The least count comes from a histogram of at most 64 steps for each power of two, so only the wanted
    words reach the driver.
    """
    power = F.floor(F.log2("n"))
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), power - 6)).cast("long")
    bound = (F.col("n") - F.col("n") % step).alias("bound")
    least, total = None, 0
    for r in counts.groupBy(bound).count().orderBy(F.desc("bound")).collect():
        total += r["count"]
        if total > held:
            break
        least = r["bound"]
    if least is None:
        return []
    return sorted(counts.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], bytes(r["word"])))


def _framed(words: np.ndarray, rows: np.ndarray, n: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, one end before, between and after them; and where each word stands."""
    at = np.arange(len(words)) + rows + 1
    line = np.full(len(words) + n + 1, end, dtype=np.int64)
    line[at] = words
    return line, at


def count_bigrams(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(one, two, n) of symbols over all texts, each framed by the end."""
    held = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        v = held.value
        for piece in _pieces(batches):
            words, rows = words_of(piece.column("body"))
            line, _ = _framed(v.symbol[v.numbers(words)], rows, len(piece), v.n_symbols - 1)
            pairs, n = np.unique(line[:-1] * v.n_symbols + line[1:], return_counts=True)
            one, two = (pairs // v.n_symbols).astype(np.int32), (pairs % v.n_symbols).astype(np.int32)
            yield pa.table({"one": one, "two": two, "n": n})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged(tables(batches), ["one", "two"])

    found = texts.select("body").mapInArrow(run, "one int, two int, n long")
    return found.groupBy("one", "two").agg(F.sum("n").alias("n"))


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_move(
    own: int, before: np.ndarray, after: np.ndarray, alone: int, grid: np.ndarray, n_classes: int
) -> tuple[int, float]:
    """Which of the first ``n_classes`` classes a word of class ``own`` should move to, and the gain in likelihood.

    ``after[c]``: how often the word stands before class c; ``before[c]``: after class c; ``alone``: how often
    after itself (held in both at ``own``); ``grid``: class bigrams.
    """
    r, l = after.copy(), before.copy()  # noqa: E741
    r[own] -= alone
    l[own] -= alone
    left = grid.copy()
    left[own] -= r
    left[:, own] -= l
    left[own, own] -= alone
    rows, columns = left.sum(axis=1) + l, left.sum(axis=0) + r  # the neighbours keep their totals
    n_row, n_column = r.sum() + alone, l.sum() + alone
    diagonal = left.diagonal()
    gain = (_x_log_x(left + r) - _x_log_x(left)).sum(axis=1) + (_x_log_x(left + l[:, None]) - _x_log_x(left)).sum(axis=0)
    # The cell of a class with itself takes what both directions bring, once.
    gain -= _x_log_x(diagonal + r) + _x_log_x(diagonal + l) - 2 * _x_log_x(diagonal)
    gain += _x_log_x(diagonal + r + l + alone) - _x_log_x(diagonal)
    gain -= _x_log_x(rows + n_row) - _x_log_x(rows) + _x_log_x(columns + n_column) - _x_log_x(columns)
    best = int(gain[:n_classes].argmax())
    return best, float(gain[best] - gain[own])


def _with_classes(bigrams: DataFrame, classes: np.ndarray) -> DataFrame:
    """Bigrams with the classes c1 and c2 of their symbols; the broadcast has one row per symbol."""
    found = bigrams.sparkSession.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "symbol int, class int")
    for word, name in (("one", "c1"), ("two", "c2")):
        side = found.select(F.col("symbol").alias(word), F.col("class").alias(name))
        bigrams = bigrams.join(F.broadcast(side), word)
    return bigrams


def class_bigrams(bigrams: DataFrame, classes: np.ndarray) -> np.ndarray:
    n = int(classes.max()) + 1
    grid = np.zeros((n, n), dtype=np.int64)
    for r in _with_classes(bigrams, classes).groupBy("c1", "c2").agg(F.sum("n").alias("n")).collect():
        grid[r["c1"], r["c2"]] = r["n"]
    return grid


def likelihood(grid: np.ndarray) -> float:
    """Log likelihood of the class bigrams, but for a part that does not depend on the classes."""
    return float(_x_log_x(grid).sum() - _x_log_x(grid.sum(axis=0)).sum() - _x_log_x(grid.sum(axis=1)).sum())


def exchange_round(bigrams: DataFrame, classes: np.ndarray, grid: np.ndarray, n_clustered: int, turn: int) -> list:
    """(word, class, gain) of the words of this turn's half that gain by a move; at most one row a word."""
    marked = _with_classes(bigrams, classes)

    def side(word: str, other: str, after: bool) -> DataFrame:
        mine = (F.col(word) < n_clustered) & (F.col(word) % 2 == turn % 2)
        return (
            marked.where(mine)
            .groupBy(F.col(word).alias("word"), F.lit(after).alias("after"), F.col(other).alias("class"))
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("one") == F.col("two"), F.col("n")).otherwise(0)).alias("alone"))
        )

    rows = (
        side("one", "c2", True)
        .union(side("two", "c1", False))
        .groupBy("word")
        .agg(
            F.collect_list(F.struct("after", "class", "n")).alias("near"),
            F.sum(F.when(F.col("after"), F.col("alone"))).alias("alone"),
        )
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"word": [], "class": [], "gain": []}
            columns = (batch.column(c).to_pylist() for c in ("word", "near", "alone"))
            for word, near, alone in zip(*columns, strict=True):
                counts = np.zeros((2, len(grid)), dtype=np.int64)
                for x in near:
                    counts[int(x["after"]), x["class"]] = x["n"]
                best, gain = best_move(int(classes[word]), counts[0], counts[1], alone or 0, grid, n_classes)
                if gain > 1e-6:
                    out["word"].append(word)
                    out["class"].append(best)
                    out["gain"].append(gain)
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    n_classes = len(grid) - SHAPES - 1
    arrow = pa.schema([("word", pa.int32()), ("class", pa.int32()), ("gain", pa.float64())])
    # A fixed number of parts: the rows are few, but each takes long.
    return rows.repartition(64, "word").mapInArrow(run, "word int, class int, gain double").collect()


def exchange_clusters(bigrams: DataFrame, n_clustered: int, n_classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Class by symbol, and class bigrams. Words start by frequency rank modulo the number of classes."""
    n_classes = min(n_classes, n_clustered)
    classes = np.array([*(i % max(1, n_classes) for i in range(n_clustered)), *range(n_classes, n_classes + SHAPES + 1)])
    grid = class_bigrams(bigrams, classes)
    for turn in range(rounds if n_classes > 1 else 0):
        moves = sorted(exchange_round(bigrams, classes, grid, n_clustered, turn), key=lambda r: -r["gain"])
        while moves:  # moves are scored one by one; if they do harm together, the better half is tried
            moved = classes.copy()
            moved[[r["word"] for r in moves]] = [r["class"] for r in moves]
            new = class_bigrams(bigrams, moved)
            if likelihood(new) > likelihood(grid):
                classes, grid = moved, new
                break
            moves = moves[: len(moves) // 2]
    return classes, grid


def _smoothed(grid: np.ndarray, pull: float) -> np.ndarray:
    """P(class of the column | class of the row)."""
    into = grid.sum(axis=0) + 0.5
    return (grid + pull * into / into.sum()) / (grid.sum(axis=1)[:, None] + pull)


def place_scores(grid: np.ndarray, n_classes: int, pull: float) -> np.ndarray:
    """Log likelihood of a word's place, by (class before, class after) and by the class the word would have."""
    own = np.maximum(grid[:, :n_classes].sum(axis=0), 1)
    t = np.log(_smoothed(grid, pull))
    scores = t[:, None, :n_classes] + t.T[None, :, :n_classes] - np.log(own)
    return scores.reshape(len(grid) ** 2, n_classes)


def assign_classes(texts: DataFrame, vocabulary: Vocabulary, classes: np.ndarray, grid: np.ndarray, pull: float) -> DataFrame:
    """(word, n, class, near) of every training word outside the clustered ones: its likeliest exchange class.

    Rows without a word hold how often words of ``class`` stand before class ``near`` (``near`` below the number
    of classes) or after it (``near`` less that number).
    """
    size = len(grid)
    n_classes = size - SHAPES - 1
    held = texts.sparkSession.sparkContext.broadcast((vocabulary, classes, place_scores(grid, n_classes, pull)))

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        v, of_symbol, _ = held.value
        for piece in _pieces(batches):
            words, rows = words_of(piece.column("body"))
            symbols = v.symbol[v.numbers(words)]
            line, at = _framed(of_symbol[symbols], rows, len(piece), size - 1)
            other = symbols >= v.n_clustered
            at = at[other]
            place = (line[at - 1] * size + line[at + 1]).astype(np.int32)
            yield pa.table({"word": words.filter(pa.array(other)), "place": place, "n": np.ones(len(at), np.int64)})

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged(tables(batches), ["word", "place"])

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = held.value[2]
        near = np.zeros((n_classes, 2 * size), dtype=np.int64)
        for batch in batches:
            lists = batch.column("places")
            cuts = lists.offsets.to_numpy().astype(np.int64)
            places = lists.values.field("place").to_numpy()
            times = lists.values.field("n").to_numpy()
            best = np.zeros(len(batch), dtype=np.int32)
            total = np.zeros(len(batch), dtype=np.int64)
            start = 0
            while start < len(batch):  # a word has at most size x size places
                stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + SCORED_PLACES, side="right")) - 1)
                a, b = cuts[start], cuts[stop]
                inner = cuts[start:stop] - a
                best[start:stop] = np.add.reduceat(times[a:b, None] * scores[places[a:b]], inner).argmax(axis=1)
                total[start:stop] = np.add.reduceat(times[a:b], inner)
                start = stop
            of_place = np.repeat(best, np.diff(cuts))
            spots = places[cuts[0] : cuts[-1]]
            np.add.at(near, (of_place, spots % size), times[cuts[0] : cuts[-1]])
            np.add.at(near, (of_place, size + spots // size), times[cuts[0] : cuts[-1]])
            nothing = pa.nulls(len(batch), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(total), pa.array(best), nothing], names=names)
        own, other = np.nonzero(near)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(own), pa.binary()), pa.array(near[own, other]), pa.array(own.astype(np.int32)), pa.array(other.astype(np.int32))],
            names=names,
        )

    names = ["word", "n", "class", "near"]
    # Tasks have added up what they saw; a hash of the word puts all its places together for both groupings.
    found = texts.select("body").mapInArrow(count, "word binary, place int, n long").repartition("word")
    found = found.groupBy("word", "place").agg(F.sum("n").alias("n"))
    found = found.groupBy("word").agg(F.collect_list(F.struct("place", "n")).alias("places"))
    return found.mapInArrow(choose, "word binary, n long, class int, near int")


def full_grid(grid: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Class bigrams after all words have left their shapes.

    ``near[c, x]``: how often words of class c from outside the clustered ones stand before x; ``near[c, size + x]``:
    after x. Pairs of two such words are dealt out by the margins of their classes.
    """
    size = len(grid)
    n_classes = size - SHAPES - 1
    shape = np.zeros(size, dtype=bool)
    shape[n_classes : size - 1] = True
    out = grid.astype(np.float64)
    out[shape] = 0
    out[:, shape] = 0
    ahead, behind = near[:, :size], near[:, size:]
    out[:n_classes, ~shape] += ahead[:, ~shape]
    out[~shape, :n_classes] += behind[:, ~shape].T
    before, after = ahead[:, shape].sum(axis=1), behind[:, shape].sum(axis=1)
    out[:n_classes, :n_classes] += np.outer(before, after) / max(1, before.sum())
    return out


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    held: int = 65_536,
    clustered: int = 4_096,
    n_classes: int = 48,
    rounds: int = 8,
    pull: float = 4.0,
) -> tuple[Model, DataFrame]:
    """The model of the texts outside fold 1, and (word, n, class) of all training words outside the clustered ones.

    ``held``: words that travel with the model. ``clustered``: words that seed the classes by exchange.
    ``pull``: weight, in tokens, of the class frequency within the transitions from a class.
    """
    texts = docs.where(fold(F.col(f"`{key}`")) != 1).select(utf8(F.col(f"`{text}`")).alias("body"))
    counts = staged(count_words(texts), "brown-words")
    top = top_words(counts, held)
    vocabulary = Vocabulary([bytes(r["word"]) for r in top], clustered)
    bigrams = staged(count_bigrams(texts, vocabulary), "brown-bigrams")
    first = vocabulary.n_clustered
    of_symbol, seed = exchange_clusters(bigrams, first, n_classes, rounds)

    size = len(seed)
    n_classes = size - SHAPES - 1
    assigned = staged(assign_classes(texts, vocabulary, of_symbol, seed, pull), "brown-classes")
    near = np.zeros((n_classes, 2 * size), dtype=np.int64)
    for r in assigned.where("word is null").groupBy("class", "near").agg(F.sum("n").alias("n")).collect():
        near[r["class"], r["near"]] = r["n"]
    grid = full_grid(seed, near)
    rest = assigned.where("word is not null").select("word", "n", "class")

    n_held = np.array([r["n"] for r in top], dtype=np.float64)
    n_texts = int(seed[:, -1].sum())
    n_words, n_types = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())
    # Of a place, half a token in all goes to the unseen of each shape; the rest to the other classes.
    unseen = 0.5 / (n_words + n_texts + 0.5 * (SHAPES + 1))
    shape = np.zeros(size, dtype=bool)
    shape[n_classes : size - 1] = True
    transitions = np.full((size, size), unseen)
    transitions[:, ~shape] = _smoothed(grid[:, ~shape], pull) * (1 - SHAPES * unseen)

    classes = np.concatenate((of_symbol[:first], np.zeros(len(top) - first, np.int64), np.arange(n_classes, size)))
    if len(top) > first:
        found = {bytes(r["word"]): r["class"] for r in rest.where(F.col("n") >= int(n_held[-1])).select("word", "class").collect()}
        classes[first : len(top)] = [found[bytes(r["word"])] for r in top[first:]]
    of_class = np.bincount(of_symbol[:first], n_held[:first], n_classes) if first else np.zeros(n_classes)
    of_class += near[:, :size].sum(axis=1)  # a word stands before something each time
    totals = np.log10(np.maximum(of_class, 1))
    emissions = np.concatenate((np.log10(n_held) - totals[classes[: len(top)]], np.zeros(SHAPES + 1)))
    unigrams = np.concatenate((np.log10(n_held + 0.5), np.zeros(SHAPES), [math.log10(n_texts + 0.5)]))
    known = np.concatenate((np.ones(len(top)), np.zeros(SHAPES), [float(n_texts > 0)]))
    model = Model(
        vocabulary, classes, np.log10(transitions), emissions, totals, unigrams, known, n_words + n_texts, n_types + (n_texts > 0)
    )
    return model, rest


def score_texts(docs: DataFrame, model: Model, rest: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with n_tokens, n_known, train_tokens, base_score (unigrams), score (the model), perplexity.

    Scores are log10 probabilities of the whole text with its end. A null text is empty: one token. One row
    per input row, repeated rows and null keys included; input columns of these names are replaced.

    A text sends its distinct words that are not held to the joined table, never its tokens. ``path`` keeps,
    of its classes in order, those next to such a word; such words are in it as -1, -2 and so on by their
    number in the text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    keep = [c for c in keep if c not in added]
    names = ["n_tokens", "n_known", "base", "model", "words", "times", "shapes", "path"]

    def first_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        v = m.vocabulary
        for piece in _pieces(batches):
            n = len(piece)
            words, rows = words_of(piece.column("body"))
            numbers = v.numbers(words)
            per_text = np.bincount(rows, minlength=n)

            def sums(values: np.ndarray, last: float, rows=rows, n=n) -> np.ndarray:
                return np.bincount(rows, values, n) + last

            rare = numbers >= v.n_held
            terms = words.filter(pa.array(rare)).dictionary_encode()
            many = max(1, len(terms.dictionary))
            found, place, times = np.unique(
                rows[rare] * many + terms.indices.to_numpy().astype(np.int64), return_inverse=True, return_counts=True
            )
            cuts = np.searchsorted(found // many, np.arange(n + 1)).astype(np.int32)
            listed = terms.dictionary.take(pa.array(found % many))

            line = np.full(len(words) + 2 * n, m.classes[v.end], dtype=np.int64)
            at = np.arange(len(words)) + 2 * rows + 1
            line[at] = m.classes[numbers]
            line[at[rare]] = -1 - (place - cuts[rows[rare]])
            text_of = np.repeat(np.arange(n), per_text + 2)
            inside = text_of[1:] == text_of[:-1]
            plain = inside & (line[1:] >= 0) & (line[:-1] >= 0)
            model_sum = np.bincount(text_of[1:][plain], m.transitions[line[:-1][plain], line[1:][plain]], n)
            new = line < 0
            on_path = new.copy()
            on_path[1:] |= new[:-1]
            on_path[:-1] |= new[1:]
            steps = np.searchsorted(text_of[on_path], np.arange(n + 1)).astype(np.int32)

            lists = pa.ListArray.from_arrays
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row"),
                    pa.array(per_text + 1),
                    pa.array(sums(m.known[numbers], m.known[v.end]).astype(np.int64)),
                    pa.array(sums(m.unigrams[numbers], m.unigrams[v.end])),
                    pa.array(model_sum + sums(m.emissions[numbers], 0)),
                    lists(pa.array(cuts), listed),
                    lists(pa.array(cuts), pa.array(times.astype(np.int32))),
                    lists(pa.array(cuts), pa.array(shapes_of(listed).astype(np.int8))),
                    lists(pa.array(steps), pa.array(line[on_path].astype(np.int32))),
                ],
                names=["row", *names],
            )

    def second_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n_classes = len(m.totals)
        for batch in batches:
            known, base, score = (batch.column(c).to_numpy().copy() for c in ("n_known", "base", "model"))
            steps, path = batch.column("path").offsets.to_numpy(), batch.column("path").values.to_numpy()
            cuts = batch.column("times").offsets.to_numpy()
            times, shapes = (batch.column(c).values.to_numpy() for c in ("times", "shapes"))
            seen = batch.column("seen").fill_null([])
            seen_cuts = seen.offsets.to_numpy()
            number, count, label = (seen.values.field(c).to_numpy() for c in ("i", "n", "class"))
            for i in range(len(batch)):
                many = times[cuts[i] : cuts[i + 1]].astype(np.float64)
                if not len(many):
                    continue
                here = slice(seen_cuts[i], seen_cuts[i + 1])
                own = shapes[cuts[i] : cuts[i + 1]].astype(np.int64) + n_classes
                own[number[here]] = label[here]
                n = np.zeros(len(many))
                n[number[here]] = count[here]
                line = path[steps[i] : steps[i + 1]].astype(np.int64)
                new = line < 0
                line[new] = own[-1 - line[new]]
                pair = new[1:] | new[:-1]  # two that are not new meet only where the path leaves words out
                score[i] += m.transitions[line[:-1][pair], line[1:][pair]].sum()
                score[i] += (many[number[here]] * (np.log10(count[here]) - m.totals[label[here]])).sum()
                base[i] += (many * np.log10(n + 0.5)).sum()
                known[i] += int(many[n > 0].sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("n_tokens"), pa.array(known), pa.array(base), pa.array(score)], names=["row", *names[:4]]
            )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), utf8(F.col(f"`{text}`")).alias("body"))
    start = f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, n_known long, base double, model double"
    lists = ", words array<binary>, times array<int>, shapes array<tinyint>, path array<int>"
    found = staged(rows.mapInArrow(first_part, start + lists).withColumn("row_id", F.monotonically_increasing_id()), "brown-texts")
    seen = (
        found.select("row_id", F.posexplode("words").alias("i", "word"))
        .join(rest, "word")
        .groupBy("row_id")
        .agg(F.collect_list(F.struct("i", "n", "class")).alias("seen"))
    )
    scored = found.drop("words").join(seen, "row_id", "left").mapInArrow(second_part, start)
    floor = math.log10(model.n_tokens + 0.5 * (model.n_types + 1))
    return scored.select(
        "row.*",
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        F.col("model").alias("score"),
        F.pow(F.lit(10.0), -F.col("model") / F.col("n_tokens")).alias("perplexity"),
    )
