import gzip
import hashlib
import io
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from sievewright.llm import media as M


def png():
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 2, 2, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0ab\0cd")) + chunk(b"IEND", b"")


def zipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "hello" * 40)
        z.writestr("b.txt", "x")
    return out.getvalue()


def ogg_page(flags, number, body=b"data"):
    return b"OggS\0" + bytes([flags]) + bytes(8) + b"abcd" + struct.pack("<I", number) + bytes(4) + bytes([1, len(body)]) + body


FILES = {
    "image/png": png(),
    "image/gif": b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + b"\x21\xf9\x04\0\0\0\0\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02\x44\x01\0\x3b",
    "image/jpeg": b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x05abc\xff\xda\x00\x04ab\x12\xff\x00\x34\xff\xd0\x56\xff\xd9",
    "image/bmp": b"BM" + struct.pack("<IIIIiiHHI", 58, 0, 54, 40, 1, 1, 1, 24, 0) + bytes(20) + b"abc\0",
    "image/webp": b"RIFF" + struct.pack("<I", 16) + b"WEBPVP8 " + struct.pack("<I", 4) + b"abcd",
    "audio/wav": M.wav(b"\x80\x90\x70"),
    "video/avi": b"RIFF" + struct.pack("<I", 16) + b"AVI LIST" + struct.pack("<I", 4) + b"hdrl",
    "audio/ogg": ogg_page(2, 0) + ogg_page(0, 1) + ogg_page(4, 2),
    "audio/flac": b"fLaC" + b"\x80\x00\x00\x22" + bytes(34) + b"\xff\xf8abc",
    "video/mp4": struct.pack(">I4s", 12, b"ftyp") + b"isom" + struct.pack(">I4s", 10, b"mdat") + b"xy" + struct.pack(">I4s", 12, b"moov") + b"abcd",
    "application/pdf": b"%PDF-1.4\nbody\nstartxref\n9\n%%EOF",
    "application/zip": zipped(),
    "application/gzip": gzip.compress(b"hello" * 50),
}


@pytest.mark.parametrize("kind", FILES)
def test_whole_embedded_and_broken(kind):
    own, file = M.Sniffer(), FILES[kind]
    assert own.segments(file)[:1] == [(kind, 0, len(file))]
    lead = b"some text BM PK GIF89a "
    tail = b"" if kind == "audio/flac" else b" and more"
    assert own.segments(lead + file + tail) == [(kind, len(lead), len(file))]
    assert not [s for s in own.segments(file[:-1]) if s[0] == kind and kind != "audio/flac"]
    broken = bytearray(file)
    broken[len(file) // 2] ^= 0xFF
    own.segments(bytes(broken))  # must not fail
    for cut in range(len(file)):
        own.segments(file[:cut])


def test_wav_with_chunks_before_fmt():
    plain, own, lead = M.wav(b"\x80\x90\x70\x60"), M.Sniffer(), b"text WAVE RIFF "
    for extra in (b"JUNK" + struct.pack("<I", 4) + bytes(4), b"bext" + struct.pack("<I", 6) + b"RIFF..", b"JUNK" + struct.pack("<I", 3) + bytes(4)):
        file = plain[:4] + struct.pack("<I", len(plain) - 8 + len(extra)) + plain[8:12] + extra + plain[12:]
        assert own.segments(file) == [("audio/wav", 0, len(file))]
        assert own.segments(lead + file + b" and more") == [("audio/wav", len(lead), len(file))]
        assert M.wav_samples(file) == (M.RATE, b"\x80\x90\x70\x60")
    no_fmt = b"RIFF" + struct.pack("<I", 16) + b"WAVEdata" + struct.pack("<I", 4) + b"abcd"
    assert own.segments(no_fmt) == [] and own.segments(b"RIFX" + plain[4:]) == []


def test_ogg_of_interleaved_streams():
    page = lambda flags, number, serial: ogg_page(flags, number).replace(b"abcd", serial)
    file = page(2, 0, b"aaaa") + page(2, 0, b"bbbb") + page(0, 1, b"bbbb") + page(0, 1, b"aaaa") + page(4, 2, b"aaaa") + page(0, 2, b"bbbb") + page(4, 3, b"bbbb")
    own = M.Sniffer()
    assert own.segments(b"lead" + file + b" and more" + png()) == [("audio/ogg", 4, len(file)), ("image/png", 4 + len(file) + 9, len(png()))]
    assert own.segments(page(2, 0, b"aaaa") + page(0, 1, b"cccc") + page(4, 1, b"aaaa")) == []
    assert own.segments(page(2, 0, b"aaaa") + page(0, 2, b"aaaa") + page(4, 3, b"aaaa")) == []
    for cut in range(len(file)):
        assert not [s for s in own.segments(file[:cut]) if s[1] == 0]


def test_truncated_archives_are_read_once():
    """A header for each of many members and no end record: time grows with the bytes, not with their square."""
    import time

    def took(n):
        value = (b"PK\3\4" + bytes(26)) * n
        began = time.perf_counter()
        assert M.Sniffer().segments(value) == []
        return time.perf_counter() - began

    took(1000)
    assert took(40_000) < 4 * 10 * max(took(4000), 0.01)
    two = zipped() + b"between" + zipped()
    assert [s[1:] for s in M.Sniffer().segments(two)] == [(0, len(zipped())), (len(zipped()) + 7, len(zipped()))]


def test_media_edge_cases(spark):
    schema = "doc_id long, text string, media string, feature string, Segments string"
    rows = [(1, "a", "m", "f", "s"), (1, "a", "m", "f", "s"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    stored = M.store_texts(df)
    assert stored.columns == ["doc_id", "n_bytes", "media"] and stored.count() == 3 and M.store_texts(df.limit(0)).count() == 0
    read = M.read_media(M.sniff(stored.withColumn("feature", F.lit("old")).withColumn("note", F.lit("kept")), "media"))
    out = read.collect()
    assert read.columns.count("feature") == 1 and {r.note for r in out} == {"kept"} and all(r.feature.startswith("audio/wav") for r in out)
    assert out[0] == out[1] or len({str(r) for r in out}) == 2
    assert M.read_media(M.sniff(stored.limit(0), "media")).count() == 0 and M.carve(M.sniff(stored.limit(0), "media"), "media").count() == 0


def test_query_shows_correction(spark):
    from sievewright.llm.queries import op3_media

    out = op3_media(spark, "/root/testdata/sf0.001").toPandas()
    assert (out.detected == "audio/wav").all() and out.corrected.all() and (out.n_files >= 1).all()


def test_sniff_and_carve(spark):
    inner = FILES["image/png"]
    rows = [(1, inner, "image/jpeg"), (2, b"note" + inner + FILES["audio/wav"], "text/plain"), (3, None, "image/gif"), (4, b"", None), (5, b"GIF89a broken", "image/gif"), (6, b"plain", None), (1, inner, "image/jpeg")]
    df = spark.createDataFrame(rows, "id long, content binary, declared string").withColumn("kind_", F.lit(1)).withColumn("DETECTED", F.lit("x"))
    got = M.sniff(df, "content", "declared")
    out = {r.id: r for r in got.collect()}
    assert {k: (r.detected, r.corrected) for k, r in out.items()} == {1: ("image/png", True), 2: ("text/plain", False), 3: ("image/gif", False), 4: (None, False), 5: (M.UNKNOWN, True), 6: (M.UNKNOWN, True)}
    carved = [(r.id, r.kind, bytes(r.media)) for r in M.carve(got).collect()]
    assert sorted(carved) == sorted([(1, "image/png", inner)] * 2 + [(2, "image/png", inner), (2, "audio/wav", FILES["audio/wav"])])
    assert M.sniff(df.limit(0)).count() == 0


def test_texts_round_trip(spark):
    texts = [(1, "é" * 40), (2, None), (3, ""), (4, "x" * 64), (5, "BM GIF89a %PDF-1.4"), (6, "y" * 300_000), (None, "z"), (4, "x" * 64)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    out = M.read_media(M.sniff(M.store_texts(df), "media")).collect()
    assert len(out) == len(texts)
    for r in out:
        raw = dict(texts)[r.doc_id]
        raw = (raw or "").encode()
        want = raw + bytes(max(64, (len(raw) + 63) // 64 * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        file = M.wav(want)
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
        assert M.wav_samples(file) == (M.RATE, want) and f"samples={len(want)} " in r.feature
    other = spark.createDataFrame([(1, png()), (2, None)], "doc_id long, media binary")
    assert {r.doc_id: (r.payload_bytes, r.media_bytes) for r in M.read_media(M.sniff(other, "media")).collect()} == {1: (None, len(png())), 2: (None, None)}
