"""Archives: round trip, roles of records, dictionary frame, single records."""

import glob
import hashlib
import io
import struct
import time

import pytest
import zstandard

from tallyweave.llm import warc as W
from tallyweave.llm.queries import QUERIES

LONG = "<html>" + "é" * 300
ROWS = [
    (5, "http://a/\r\nX: y %41", LONG), (3, "http://b/", LONG), (9, None, LONG), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"),
    (None, "n", LONG), (None, "n", "z" * 200), (7, "rn", "a\r\n\r\nb" * 50), (7, "rn", "a\r\n\r\nb" * 50), (8, "x", "y" * 3_000_000), (10, "x", "y" * 3_000_000),
]


def pages(spark):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in ROWS], "page_id long, url string, html string, payload string")


def test_round_trip(spark, tmp_path):
    got = W.archive_pages(pages(spark), str(tmp_path / "a")).collect()
    assert len(got) == len(ROWS) and all(r["intact"] for r in got)
    leader = {LONG: 3, "z" * 200: None, ROWS[9][2]: 7, ROWS[11][2]: 8}
    want = []
    for page_id, url, html in ROWS:
        body = (html or "").encode()
        first = leader.get(html, page_id)
        refers = first if first != page_id else None
        kind = "response" if refers is None else "revisit"
        payload = None if refers is not None else body
        want.append((page_id, url, kind, payload, len(body), hashlib.sha256(body).hexdigest(), refers, True))
    order = lambda r: (str(r[0]), r[5], str(r[1]))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive_pages(none, str(tmp_path / "a")).collect() == []


@pytest.fixture
def archive(spark, sf, tmp_path):
    W.archive_pages(spark.read.parquet(f"{sf}/pages.parquet").repartition(1), str(tmp_path / "a"))
    (name,) = glob.glob(str(tmp_path / "a" / "part-*"))
    with open(name, "rb") as file:
        return file.read()


def test_dictionary_leads_and_records_stand_alone(archive):
    magic, size = struct.unpack_from("<II", archive)
    assert magic == W.DICTIONARY_MAGIC
    held = zstandard.ZstdCompressionDict(archive[8 : 8 + size])
    assert held.dict_id() != 0
    records = list(W.read_archive(archive))
    # The last record, cut out of the archive and read by itself with the dictionary.
    starts = [i for i in range(len(archive)) if archive.startswith(W.SEPARATOR, i)]
    alone = archive[starts[-2] + 8 : starts[-1]]
    assert zstandard.ZstdDecompressor(dict_data=held).decompressobj().decompress(alone) == records[-1]
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(W.read_archive(archive[: len(archive) - 20]))


def test_whole_stream_is_plain_zstandard(archive):
    held = zstandard.ZstdCompressionDict(archive[8 : 8 + struct.unpack_from("<I", archive, 4)[0]])
    reader = zstandard.ZstdDecompressor(dict_data=held).stream_reader(io.BytesIO(archive), read_across_frames=True)
    assert reader.read() == b"".join(W.read_archive(archive))


def test_reading_grows_with_the_length_of_an_archive():
    """Records of all block kinds are cut out of a long archive; no record copies what lies behind it."""
    noise = [hashlib.sha256(b"%d" % i).digest() * 4 for i in range(120_000)]
    large = [b"", b"z" * 400_000, b"".join(noise[:9_000]), b"ab" * 200_000]
    packers = [zstandard.ZstdCompressor(write_checksum=c, write_content_size=s) for c, s in ((False, True), (True, True), (True, False))]
    records = [*noise, *large * len(packers)]
    frames = [packers[i % len(packers)].compress(r) for i, r in enumerate(records)]
    began = time.process_time()
    assert list(W.read_archive(W.SEPARATOR.join(frames))) == records
    assert time.process_time() - began < 8
    whole = W.SEPARATOR.join(frames[-2:])
    for cut in (1, 5, len(frames[-1]) - 7):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.read_archive(whole[:-cut]))


def test_damage_is_noticed():
    record = W.build_record(1, "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None, "2024-01-01T00:00:00Z")
    assert W.parse_record(record)["intact"]
    assert not W.parse_record(record.replace(b"payload\r\n", b"paylaod\r\n"))["intact"]


def test_query_covers_all_pages(spark, sf):
    assert QUERIES["op4_warc"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
