"""Encoding and decoding against the library itself."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tallyweave.llm import pieces as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


AWKWARD = [
    "", " ", "  ", "a", " a", "a ", "a  b ", "\n", "\n\n a\tb\r\n", "▁", "a▁b", "▁ ▁", "naïve Ünïcode ß", "日本語 テキスト",
    "😀 👩‍👩‍👧", "\u0000x\u0000", "<s> </s> <unk> <0x41>", " " * 40 + "end", "x" * 5_000, "word " * 3_000, "é" * 999, " ﻿�",
    "https://example.org/a?b=c#d", "1234567890 12.5e-3", "مرحبا بالعالم", "á   　",
]


def results(df, keep):
    encoded = P.encode_texts(df, MODEL, keep)
    return P.decode_ids(encoded, MODEL, [*keep, "ids"]).collect()


@pytest.mark.parametrize("part_chunks,bucket_bytes,head_chunks", [(400_000, 16 << 20, 200_000), (20, 300, 0), (1, 1, 5)])
def test_awkward_texts_equal_the_library(spark, library, monkeypatch, part_chunks, bucket_bytes, head_chunks):
    monkeypatch.setattr(P, "PART_CHUNKS", part_chunks)
    monkeypatch.setattr(P, "HEAD_CHUNKS", head_chunks)
    monkeypatch.setattr(P, "GROUP_CHUNKS", part_chunks)
    monkeypatch.setattr(P, "BUCKET_BYTES", bucket_bytes)
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(100, None), (None, "no key"), (101, "same text"), (101, "same text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = P.encode_texts(df, MODEL, ["doc_id", "text"])
    got = P.decode_ids(encoded, MODEL, ["doc_id", "text", "ids"]).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids
        assert r["decoded"] == (library.decode(ids) if ids else "")


def test_whole_table_equals_the_library(spark, sf, texts, library):
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in results(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"])}
    for key, text in texts:
        ids = library.encode(text or "")
        assert got[key] == (ids, library.decode(ids) if ids else "")


def test_each_distinct_chunk_is_segmented_once():
    """Whatever the number of parts that ask for it."""
    seen = []

    def spell(chunk):
        seen.append(chunk)
        return [ord(c) for c in chunk]

    asked = [("a", ["x", "yy", ""]), ("b", ["yy", "zzz"]), ("c", ["x"])]
    rows = [r for part, chunks in asked for r in P._requests(part, {c: i for i, c in enumerate(chunks)}, 1)]
    table = pa.table([pa.array(c) for c in zip(*rows)], names=["part", "bucket", "numbers", "lengths", "body"])
    answers = P.answer_requests(table, spell)
    assert sorted(seen) == ["", "x", "yy", "zzz"]
    assert answers["part"].to_pylist() == ["a", "b", "c"]
    assert P.unpack(answers["lengths"][0].as_py()).tolist() == [1, 2, 0]
    assert P.unpack(answers["body"][1].as_py()).tolist() == [ord(c) for c in "yyzzz"]


def test_packing_is_exact():
    for values in ([], [0], [5, 70_000, 2**31 - 1, 3]):
        assert P.unpack(P.pack(np.array(values, P.IDS))).tolist() == values


def test_parts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_CHUNKS", 50)
    df = spark.createDataFrame([(" ".join(f"w{i}-{j}" for i in range(20)),) for j in range(40)], "text string")
    head = spark.sparkContext.broadcast(["w0-0"])
    rows = P._number_chunks(df.coalesce(1), [], "text", 1, head, requests=True).collect()
    held = [len(P.unpack(r["numbers"])) for r in rows]
    assert sum(held) == 799 and max(held) < 50 + 20


def test_other_documents_in_the_second_scan_raise():
    documents = pa.table({"kept": pa.array([[1]]), "lengths": [P.pack(np.array([2]))], "body": [P.pack(np.array([0, 3]))]})
    answers = pa.table({n: pa.array([], pa.binary()) for n in ("numbers", "lengths", "body")})
    with pytest.raises(RuntimeError, match="changed between two scans"):
        P._join_by_position(documents, answers, np.array([7], P.IDS), np.array([1]))


def test_frequent_chunks_come_commonest_first(spark, library):
    df = spark.createDataFrame([("to be or not to be",)] * 3 + [("to once",), (None,)], "text string")
    chunks, ids, lengths = P.frequent_chunks(df, MODEL, "text", 0)
    assert chunks == ["to", "be", "not", "or"]
    assert ids.tolist() == library.encode("to be not or") and lengths.sum() == len(ids)


def test_empty_table_and_clashing_columns(spark):
    assert P.encode_texts(spark.createDataFrame([], "doc_id long, text string"), MODEL, ["doc_id"]).collect() == []
    df = spark.createDataFrame([(1, "two words", "k", "c", 5)], "doc_id long, text string, key string, chunk string, n int")
    row = P.encode_texts(df, MODEL, ["key", "chunk", "n", "doc_id"]).first()
    assert (row["key"], row["chunk"], row["n"], row["doc_id"]) == ("k", "c", 5, 1) and len(row["ids"]) == 2


def test_lone_marks_and_model_check(library):
    P.load_model(MODEL)
    for text in ("a ", "a  ", " ", "b   c "):
        ids = [i for c in P.marked_words(text) for i in P.segment(library, c)]
        assert ids == library.encode(text)
