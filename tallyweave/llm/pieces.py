"""SentencePiece encoding and decoding with a table of distinct chunks.

The library marks each blank (U+0020 as U+2581) and puts a mark before the text. A model whose pieces hold marks only
at their start cannot join letters across a mark, so a text is the concatenation of its marked words (marks and what
follows up to the next mark), and each of them is segmented alike wherever it stands.

1. The commonest chunks of a bounded sample of texts are segmented and broadcast; which chunks these are changes the
   amount of work, never a result.
2. Tasks number the chunks of a part, which is a run of documents with a bounded number of other chunks, and write the
   documents as the numbers of their chunks by position. Each part asks for its other chunks once, packed by buckets of
   a hash of the chunk, so a busy chunk is one entry of each part.
3. A bucket holds all requests for its chunks: it keeps the table of these, segments each distinct chunk once, and
   answers every part with the ids. The number of buckets grows with the text, so a bucket stays bounded.
4. Documents and answers meet by part, and the ids are joined by position.

Texts are not shuffled: what moves are packed numbers, requests and answers. Documents are scanned twice, once for the
requests and once for the numbers, so ``docs`` has to be a stored table or a plain selection of one. A part is named by
what it holds, so documents that differ between the scans raise an error and never get wrong ids.

Handling: a null text is encoded as the empty one (no ids, decoded to the empty text); texts and chunks of any length
are taken whole; an empty table gives no rows; repeated rows give equal rows; columns to keep go through unchanged,
whatever their names, unless they are called ``ids`` or ``decoded``, which the results take.
"""

from __future__ import annotations

import functools
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
SAMPLE_BYTES = 32 << 20  # bytes of text that the broadcast chunks are counted in, about
HEAD_CHUNKS = 200_000  # chunks that are broadcast, at most
PART_CHUNKS = 50_000  # other distinct chunks at which a part is closed
PART_BYTES = 4 << 20  # characters of text at which a part is closed
GROUP_CHUNKS = 100_000  # positions at which a packed group of documents is closed
BUCKET_BYTES = 16 << 20  # bytes of text for each bucket of chunks
IDS = np.dtype("<i4")


def marked_words(text: str) -> list[str]:
    """The chunks of a text, in order, each without the mark it begins with; the empty text has none."""
    if not text:
        return []
    words = text.split(" ")
    if "" in words or MARK in text:  # marks in a row belong to the chunk they precede
        return [c[1:] for c in CHUNK.findall(MARK + text.replace(" ", MARK))]
    return words


@functools.lru_cache(maxsize=4)
def _loaded(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def load_model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model of a file that every executor has at ``path``; a process reads it once.

    Raises ValueError if its chunks are not independent: if a piece holds a mark after another character, or its
    normaliser changes more than blanks.
    """
    from sentencepiece import sentencepiece_model_pb2  # noqa: PLC0415

    model = _loaded(os.fspath(path))
    if any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size())):
        raise ValueError("a piece of the model crosses a whitespace marker")
    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    rules, kind = spec.normalizer_spec, spec.trainer_spec
    if (
        rules.precompiled_charsmap
        or rules.remove_extra_whitespaces
        or not (rules.add_dummy_prefix and rules.escape_whitespaces)
        or kind.treat_whitespace_as_suffix
    ):
        raise ValueError("the model's normaliser changes more than blanks")
    return model


def segment(model: sentencepiece.SentencePieceProcessor, chunk: str) -> list[int]:
    """Ids of a chunk. The library adds the first mark itself; a lone mark is read off a text that ends with it."""
    return model.encode(chunk) if chunk else model.encode("a ")[len(model.encode("a")) :]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed: the upper planes are nearly empty."""
    planes = np.ascontiguousarray(values, IDS).view("u1").reshape(-1, IDS.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "u1").reshape(IDS.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(IDS).ravel()


def _pack_texts(texts: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(texts))


def _unpack_texts(blob: bytes, lengths: np.ndarray) -> list[bytes]:
    whole, ends = zstandard.ZstdDecompressor().decompress(blob), np.cumsum(lengths)
    return [whole[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


_REQUEST = [("part", pa.string()), ("bucket", pa.int32()), ("numbers", pa.binary()), ("lengths", pa.binary()), ("body", pa.binary())]


def _requests(part: str, numbers: dict[str, int], buckets: int) -> list[tuple]:
    """One row for each bucket that a part's chunks fall into."""
    texts = [c.encode() for c in numbers]
    bucket = np.array([xxhash.xxh64_intdigest(t) % buckets for t in texts], "int64")
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    rows = []
    for at in np.split(order, cuts):
        held = [texts[i] for i in at.tolist()]
        # Numbers rise within a bucket, so their steps are small.
        rows.append((part, int(bucket[at[0]]), pack(np.diff(at, prepend=0)), pack(np.array([len(t) for t in held])), _pack_texts(held)))
    return rows


def frequent_chunks(docs: DataFrame, model_path: str, text: str, size: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(chunks, ids of all, number of ids of each): chunks that occur thrice or more in the sample, commonest first.

    The sample has about ``SAMPLE_BYTES`` of the table's ``size`` bytes, chosen by a hash of the text, so what comes to
    the driver is bounded.
    """
    share = min(1.0, SAMPLE_BYTES / max(1, size))
    body = F.col(f"`{text}`").cast("string")
    sample = docs.select(body.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    schema = pa.schema([("chunk", pa.string()), ("n", pa.int64())])

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for one in batch.column(0).to_pylist():
                counts.update(marked_words(one or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def segment_all(batches):
        model = _loaded(os.fspath(model_path))
        for batch in batches:
            ids = [np.array(segment(model, c), IDS).tobytes() for c in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=["chunk", "n", "ids"])

    counted = sample.mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n")).where("n >= 3")
    found = counted.mapInArrow(segment_all, "chunk string, n long, ids binary").toArrow().to_pydict()
    order = sorted(range(len(found["n"])), key=lambda i: (-found["n"][i], found["chunk"][i]))[:HEAD_CHUNKS]
    ids = [found["ids"][i] for i in order]
    lengths = np.array([len(x) // IDS.itemsize for x in ids], "int64")
    return [found["chunk"][i] for i in order], np.frombuffer(b"".join(ids), IDS), lengths


def _number_chunks(docs: DataFrame, keep: list[str], text: str, buckets: int, head, requests: bool) -> DataFrame:
    """Rows of one kind: ``requests`` of the parts, or groups of documents (``kept``, ``lengths``, ``body`` of numbers)."""
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("int")
    rows = docs.select(kept.alias("kept"), F.col(f"`{text}`").cast("string").alias("text"))
    names = ["kept", *[n for n, _ in _REQUEST]]

    def number(batches):
        common = {c: i for i, c in enumerate(head.value)}
        start = len(common)
        numbers: dict[str, int] = {}
        groups: list[tuple] = []
        lengths: list[int] = []
        codes: list[int] = []
        size = nth = 0

        def close() -> pa.RecordBatch | None:
            """The finished part under its name."""
            whole = xxhash.xxh64()
            for c in numbers:
                whole.update(c.encode())
                whole.update(b"\xff")
            part = f"{TaskContext.get().partitionId()}-{nth}-{whole.hexdigest()}"
            if requests:
                if not numbers:
                    return None
                columns = list(zip(*_requests(part, numbers, buckets), strict=True))
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _REQUEST, strict=True)], names=names[1:])
            if not groups:
                return None
            held = pa.concat_arrays([g[0] for g in groups])
            ends = np.cumsum([0] + [len(g[0]) for g in groups])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)
            return pa.RecordBatch.from_arrays(
                [lists, pa.array([part] * len(groups), pa.string()), *[pa.array([g[i] for g in groups], pa.binary()) for i in (1, 2)]],
                names=["kept", "part", "lengths", "body"],
            )

        for batch in batches:
            texts, first = batch.column(1), 0
            for at in range(len(texts)):
                body = texts[at].as_py() or ""
                chunks = marked_words(body)
                found = list(map(common.get, chunks))
                if None in found:
                    found = [start + numbers.setdefault(c, len(numbers)) if i is None else i for i, c in zip(found, chunks, strict=True)]
                codes += found
                lengths.append(len(found))
                size += len(body)
                full = len(numbers) >= PART_CHUNKS or size >= PART_BYTES
                if full or len(codes) >= GROUP_CHUNKS or at + 1 == len(texts):
                    if not requests:
                        groups.append((batch.column(0).slice(first, at + 1 - first), pack(np.array(lengths)), pack(np.array(codes))))
                    first, lengths, codes = at + 1, [], []
                if full:
                    if (out := close()) is not None:
                        yield out
                    numbers, groups, size, nth = {}, [], 0, nth + 1
        if (out := close()) is not None:
            yield out

    if requests:
        return rows.mapInArrow(number, "part string, bucket int, numbers binary, lengths binary, body binary")
    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(number, f"kept array<{kind}>, part string, lengths binary, body binary")


def answer_requests(requests: pa.Table, segment_one) -> pa.Table:
    """Answers to all requests of one bucket: (part, numbers, lengths, body) with the ids of each chunk.

    The table of distinct chunks lives here; ``segment_one`` sees each of them once.
    """
    table: dict[bytes, bytes] = {}
    out = []
    for row in requests.select(["part", "numbers", "lengths", "body"]).to_batches(max_chunksize=64):
        for part, numbers, lengths, body in zip(*(c.to_pylist() for c in row.columns), strict=True):
            ids = []
            for chunk in _unpack_texts(body, unpack(lengths)):
                found = table.get(chunk)
                if found is None:
                    found = table[chunk] = np.array(segment_one(chunk.decode()), IDS).tobytes()
                ids.append(found)
            counts = np.array([len(f) for f in ids]) // IDS.itemsize
            out.append((part, numbers, pack(counts), pack(np.frombuffer(b"".join(ids), IDS))))
    columns = list(zip(*out, strict=True)) if out else [[]] * 4
    types = [pa.string(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "numbers", "lengths", "body"])


def _join_by_position(documents: pa.Table, answers: pa.Table, head_ids: np.ndarray, head_sizes: np.ndarray) -> pa.Table:
    """Documents of one part with the ids of their chunks in order."""
    counts, ids = [head_sizes], [head_ids]
    numbers = [np.arange(len(head_sizes))]
    for a, b, c in zip(*(answers[n].to_pylist() for n in ("numbers", "lengths", "body")), strict=True):
        numbers.append(np.cumsum(unpack(a), dtype="int64") + len(head_sizes))
        counts.append(unpack(b).astype("int64"))
        ids.append(unpack(c))
    order, held, flat = np.concatenate(numbers), np.concatenate(counts), np.concatenate(ids)
    begin, size = np.zeros(len(order), "int64"), np.zeros(len(order), "int64")
    begin[order], size[order] = np.cumsum(held) - held, held
    kept, found, ends = [], [], [np.zeros(1, "int64")]
    for held_by, lengths, body in zip(documents["kept"].combine_chunks(), documents["lengths"].to_pylist(), documents["body"].to_pylist(), strict=True):
        codes = unpack(body)
        if codes.max(initial=-1) >= len(size):
            raise RuntimeError("the documents changed between two scans: store them first")
        each = size[codes]
        after = np.cumsum(each)
        # Place of each id: the start of its chunk plus its rank inside.
        places = np.repeat(begin[codes] - (after - each), each) + np.arange(int(each.sum()))
        kept.append(held_by.values)
        found.append(flat[places])
        last = np.cumsum(unpack(lengths).astype("int64"))
        ends.append(np.concatenate([[0], after])[last] + ends[-1][-1])
    if not kept:
        return pa.table([documents["kept"].combine_chunks().flatten(), pa.array([], pa.list_(pa.int32()))], names=["kept", "ids"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(found)))
    return pa.table([pa.concat_arrays(kept), lists], names=["kept", "ids"])


def encode_texts(docs: DataFrame, model_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``ids`` (array of int), as the library encodes the whole text, without begin or end ids."""
    load_model(model_path)
    context = docs.sparkSession.sparkContext
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    chunks, head_ids, head_sizes = frequent_chunks(docs, model_path, text, size)
    head, tables = context.broadcast(chunks), context.broadcast((head_ids, head_sizes))
    buckets = int(size // BUCKET_BYTES) + 1

    def answer(requests: pa.Table) -> pa.Table:
        model = _loaded(os.fspath(model_path))
        return answer_requests(requests, lambda chunk: segment(model, chunk))

    requests = _number_chunks(docs, keep, text, buckets, head, requests=True)
    answers = requests.groupBy("bucket").applyInArrow(answer, "part string, numbers binary, lengths binary, body binary")
    documents = _number_chunks(docs, keep, text, buckets, head, requests=False)
    kind = documents.schema["kept"].dataType.elementType.simpleString()
    out = documents.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        lambda ours, theirs: _join_by_position(ours, theirs, *tables.value), f"kept {kind}, ids array<int>"
    )
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], "ids")


def decode_ids(encoded: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``decoded``: the library's text of column ``ids``; null ids count as none."""
    rows = encoded.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept") if keep else F.lit(None).cast("int").alias("kept"), "ids"
    )

    def decode(batches):
        model = _loaded(os.fspath(model_path))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                # One list of Python numbers at a time.
                texts = [model.decode(x.values.to_numpy().tolist()) if x.is_valid and len(x) else "" for x in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts, pa.string())], names=["kept", "decoded"])

    out = rows.mapInArrow(decode, f"kept {rows.schema['kept'].dataType.simpleString()}, decoded string")
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], "decoded")
