"""Class bigram model: counts, moves, normalisation and scores against plain versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyweave.llm import brown as B
from tallyweave.llm.queries import QUERIES


def plain_tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def plain_base(rows):
    train = [plain_tokens(t) + [None] for k, t in rows if zlib.crc32(str("" if k is None else k).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in t)
    n, v = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        tokens = plain_tokens(text) + [None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((key, len(tokens), sum(counts[w] > 0 for w in tokens), n, base))
    return out


def same(got, want):
    assert len(got) == len(want)
    order = lambda r: tuple(str(x) for x in r[:4])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9)


def test_query_against_brute_force(spark, sf, texts):
    rows = QUERIES["op9_brown"](spark, sf).collect()
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows], plain_base(texts))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


ROWS = [(1, None), (2, ""), (None, "a b a b"), (3, "a b c a b c"), (3, "a b c a b c"), (4, "A B éé zz."), (5, "x" * 5000), (6, "b a " * 3000), (7, "new words here")]


def test_edges_and_small_tables_of_held_words(spark):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in ROWS], "doc_id long, text string, score string")
    model, counts = B.train(docs, held=3, clustered=2, n_classes=2, rounds=2)
    got = B.score_texts(docs, model, counts, ["doc_id", "score"])
    rows = got.collect()
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows], plain_base(ROWS))
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model, counts = B.train(docs)
    assert B.score_texts(docs, model, counts, ["doc_id"]).collect() == []


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    model, rest = B.train(docs, held=4, clustered=3, n_classes=2, rounds=2)
    v = model.vocabulary
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    mass = Counter()
    for number in range(v.end + 1):  # of a shape, the unseen
        if number < v.n_clustered or number >= v.n_held:
            mass[int(model.classes[number])] += 10 ** float(model.emissions[number])
    for r in rest.collect():
        mass[r["class"]] += 10 ** (math.log10(r["n"]) - model.totals[r["class"]])
    assert len(mass) == 2 + B.SHAPES + 1 and all(x == pytest.approx(1) for x in mass.values())
    for number in range(v.n_clustered, v.n_held):  # held words outside the clustered ones are in the table, too
        (row,) = [r for r in rest.collect() if bytes(r["word"]) == v.words[number].as_py()]
        assert model.classes[number] == row["class"]
        assert model.emissions[number] == pytest.approx(math.log10(row["n"]) - model.totals[row["class"]])


def test_words_and_shapes_of_texts():
    texts = [None, "", " ", "A b\tÉé  zz.", "a", "b ", "x\u00a0y \x0b\x1c Z9", "", "ü"]
    bodies = pa.array([(t or "").encode() for t in ["cut", *texts]]).slice(1)
    words, rows = B.words_of(bodies)
    want = [(i, w) for i, t in enumerate(texts) for w in plain_tokens(t)]
    assert list(zip(rows.tolist(), [w.decode() for w in words.to_pylist()], strict=True)) == want

    def shape(word):
        last = word[-1]
        marked = not (chr(last).isdigit() or "a" <= chr(last) <= "z" or last > 127)
        return marked * 8 + (not word.isascii()) * 4 + (min(3, len(word) // 4) if marked else last % 4)

    assert B.shapes_of(words).tolist() == [shape(w) for w in words.to_pylist()]


def test_top_words_are_all_from_some_count_on(spark):
    rows = [(f"w{i}".encode(), n) for i, n in enumerate([900, 7, 7, 7, 300, 5, 1, 1, 1, 1])]
    counts = spark.createDataFrame(rows, "word binary, n long")
    for held, want in ((0, []), (1, [900]), (3, [900, 300]), (5, [900, 300, 7, 7, 7]), (9, [900, 300, 7, 7, 7, 5]), (99, sorted((n for _, n in rows), reverse=True))):
        assert [r["n"] for r in B.top_words(counts, held)] == want


def test_every_word_gets_its_likeliest_class_and_texts_their_scores(spark, texts):
    rows = [*ROWS, *texts[:60]]
    docs = spark.createDataFrame([(k, t) for k, t in rows], "doc_id long, text string")
    seen = {}

    def spy(texts, vocabulary, classes, grid, pull, real=B.assign_classes):
        seen.update(v=vocabulary, classes=classes, grid=grid, pull=pull)
        return real(texts, vocabulary, classes, grid, pull)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(B, "assign_classes", spy)
        patch.setattr(B, "PIECE_BYTES", 900)
        patch.setattr(B, "HELD_ROWS", 200)
        patch.setattr(B, "SCORED_PLACES", 5)
        model, rest = B.train(docs, held=60, clustered=20, n_classes=4, rounds=3)
    v, grid = seen["v"], seen["grid"]
    first = {w.as_py().decode(): i for i, w in enumerate(v.words[: v.n_clustered])}

    def before(word):  # class during the exchange
        if word is None:
            return len(grid) - 1
        return int(seen["classes"][first[word]]) if word in first else 4 + int(B.shapes_of(pa.array([word.encode()]))[0])

    score = B.place_scores(grid, 4, seen["pull"])
    sums, counts, lines = {}, Counter(), []
    for key, text in rows:
        if zlib.crc32(str("" if key is None else key).encode()) % 5 != 1:
            line = [None, *plain_tokens(text), None]
            lines.append(line)
            for a, w, b in zip(line, line[1:], line[2:]):
                if w not in first:
                    sums[w] = sums.get(w, 0) + score[before(a) * len(grid) + before(b)]
                    counts[w] += 1
    got = {bytes(r["word"]).decode(): (r["n"], r["class"]) for r in rest.collect()}
    assert {w: c[0] for w, c in got.items()} == dict(counts)
    assert all(sums[w][c] == pytest.approx(sums[w].max(), rel=1e-9) for w, (_, c) in got.items())

    def final(word):
        if word in first or word is None:
            return before(word)
        return got[word][1] if word in got else before(word)

    plain = np.zeros(grid.shape)
    for line in lines:
        for a, b in zip(line, line[1:]):
            plain[final(a), final(b)] += 1
    near = np.zeros((4, 2 * len(grid)))
    for line in lines:
        for a, b in zip(line, line[1:]):
            if a in got:
                near[got[a][1], before(b)] += 1
            if b in got:
                near[got[b][1], len(grid) + before(a)] += 1
    full = B.full_grid(grid, near)
    assert np.allclose(full.sum(axis=0), plain.sum(axis=0)) and np.allclose(full.sum(axis=1), plain.sum(axis=1))
    assert np.allclose(full[4:], plain[4:]) and np.allclose(full[:, 4:], plain[:, 4:])

    scored = B.score_texts(docs, model, rest, ["doc_id"]).collect()
    n_of = Counter(w for line in lines for w in line[1:])
    want = []
    for key, text in rows:
        line = [None, *plain_tokens(text), None]
        total = 0.0
        for a, b in zip(line, line[1:]):
            total += model.transitions[final(a), final(b)]
            total += math.log10(n_of[b]) - model.totals[final(b)] if b is not None and n_of[b] else 0.0
        want.append((str(key), len(line) - 1, total))
    for a, b in zip(sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in scored), sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in scored], plain_base(rows))


def test_gain_of_a_move_is_the_change_in_likelihood():
    rng = np.random.default_rng(0)
    n, k = 12, 5
    pairs = rng.integers(0, 30, (n, n))
    classes = rng.integers(0, k, n)

    def grid(classes):
        out = np.zeros((k, k), dtype=np.int64)
        np.add.at(out, (classes[:, None].repeat(n, 1), classes[None].repeat(n, 0)), pairs)
        return out

    for word in range(n):
        before = np.bincount(classes, pairs[:, word], k).astype(np.int64)
        after = np.bincount(classes, pairs[word], k).astype(np.int64)
        best, gain = B.best_move(classes[word], before, after, int(pairs[word, word]), grid(classes), k)
        changes = []
        for c in range(k):
            moved = classes.copy()
            moved[word] = c
            changes.append(B.likelihood(grid(moved)) - B.likelihood(grid(classes)))
        assert best == int(np.argmax(changes)) and gain == pytest.approx(max(changes))
