"""Media columns by signature sniffing (operator 3).

An Aho-Corasick automaton finds the magic bytes of all formats in one pass over a
value; a validator of the format then walks its structure (chunks, blocks, pages,
boxes, markers), checks lengths and the checksums of PNG chunks and gzip members
(those of Ogg pages, FLAC frames and members of archives are not looked at), and
tells how long the file is.  What passes corrects the declared type, and what stands inside
other data is carved out.  Text can be stored as 8-bit samples of a WAV file and
read back the same way.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

UNKNOWN = "application/octet-stream"
RATE = 8000
SEGMENT = StructType().add("kind", StringType()).add("start", LongType()).add("length", LongType())


def png(b: memoryview, at: int) -> int:
    """Chunks with right checksums from IHDR to IEND."""
    p, first = at + 8, True
    while p + 12 <= len(b):
        (n,) = struct.unpack_from(">I", b, p)
        kind = bytes(b[p + 4 : p + 8])
        if p + 12 + n > len(b) or (first and (kind != b"IHDR" or n != 13)) or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return 0
        p, first = p + 12 + n, False
        if kind == b"IEND":
            return p - at
    return 0


def gif(b: memoryview, at: int) -> int:
    """Colour tables, extensions and images up to the trailer."""
    if at + 13 > len(b):
        return 0
    table = lambda flags: 3 << ((flags & 7) + 1) if flags & 0x80 else 0
    p = at + 13 + table(b[at + 10])
    while p < len(b):
        if b[p] == 0x3B:
            return p + 1 - at
        if b[p] == 0x21:
            p += 2
        elif b[p] == 0x2C and p + 10 < len(b):
            p += 11 + table(b[p + 9])
        else:
            return 0
        while p < len(b) and b[p]:
            p += 1 + b[p]
        p += 1
    return 0


def jpeg(b: memoryview, at: int) -> int:
    """Marker segments, a frame and a scan, up to the end marker."""
    p, frame, scan = at + 2, False, False
    while p + 4 <= len(b) or p + 2 == len(b):
        if b[p] != 0xFF:
            return 0
        m = b[p + 1]
        if m == 0xD9:
            return p + 2 - at if frame and scan else 0
        if m == 0xFF:
            p += 1
            continue
        if m in (0x00, 0x01, 0xD8) or 0xD0 <= m <= 0xD7 or p + 4 > len(b):
            return 0
        (n,) = struct.unpack_from(">H", b, p + 2)
        if n < 2 or p + 2 + n > len(b):
            return 0
        frame |= 0xC0 <= m <= 0xCF and m not in (0xC4, 0xC8, 0xCC)
        p += 2 + n
        if m == 0xDA:
            scan, whole = True, b.obj
            while True:
                p = whole.find(b"\xff", p)
                if p < 0 or p + 1 >= len(b):
                    return 0
                if b[p + 1] and not 0xD0 <= b[p + 1] <= 0xD7:
                    break
                p += 2
    return 0


def _riff(form: bytes, needs: tuple[bytes, ...], always: tuple[bytes, ...] = ()) -> Callable[[memoryview, int], int]:
    def walk(b: memoryview, at: int) -> int:
        if at + 12 > len(b) or bytes(b[at : at + 4]) != b"RIFF" or bytes(b[at + 8 : at + 12]) != form:
            return 0
        end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
        p, seen = at + 12, set()
        if end > len(b):
            return 0
        while p + 8 <= end:
            n = struct.unpack_from("<I", b, p + 4)[0]
            seen.add(bytes(b[p : p + 4]))
            p += 8 + n + (n & 1)
        return end - at if p in (end, end + 1) and any(x in seen for x in needs) and seen.issuperset(always) else 0

    return walk


def bmp(b: memoryview, at: int) -> int:
    """Sizes of file, headers and, uncompressed, of the rows agree."""
    if at + 54 > len(b):
        return 0
    size, reserved, start, head, width, height, planes, bits, packing = struct.unpack_from("<IIIIiiHHI", b, at + 2)
    if reserved or head not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or not height or not 14 + head <= start <= size or at + size > len(b):
        return 0
    return size if packing or start + (width * bits + 31) // 32 * 4 * abs(height) <= size else 0


def ogg(b: memoryview, at: int) -> int:
    """Pages of one stream or of several interleaved ones, each in order, to the last page of them all.

    The first pages of all streams come before any other page.
    """
    p, number, streams, begun = at, {}, set(), False
    while p + 27 <= len(b) and bytes(b[p : p + 5]) == b"OggS\0":
        flags, serial, sequence, n = b[p + 5], bytes(b[p + 14 : p + 18]), struct.unpack_from("<I", b, p + 18)[0], b[p + 26]
        size = 27 + n + sum(b[p + 27 : p + 27 + n])
        first = bool(flags & 2)
        if sequence != number.get(serial, 0) or first != (serial not in number) or first and begun or not first and serial not in streams or p + size > len(b):
            return 0
        p, begun, number[serial] = p + size, begun or not first, sequence + 1
        streams.add(serial)
        if flags & 4:
            streams.discard(serial)
            if not streams:
                return p - at
    return 0


def flac(b: memoryview, at: int) -> int:
    """Metadata blocks from STREAMINFO to the last, then frames up to the end of the data."""
    p, first = at + 4, True
    while p + 4 <= len(b):
        kind, n = b[p], int.from_bytes(b[p + 1 : p + 4], "big")
        if (first and (kind & 0x7F or n != 34)) or p + 4 + n > len(b):
            return 0
        p, first = p + 4 + n, False
        if kind & 0x80:
            return len(b) - at if p + 2 <= len(b) and b[p] == 0xFF and b[p + 1] & 0xFC == 0xF8 else 0
    return 0


def pdf(b: memoryview, at: int) -> int:
    """A version, a cross-reference offset and the end mark (the last before another file's head)."""
    whole: bytes = b.obj
    if not (at + 8 <= len(b) and chr(b[at + 5]).isdigit() and b[at + 6] == 0x2E and chr(b[at + 7]).isdigit()):
        return 0
    stop = whole.find(b"%PDF-", at + 5)
    end = whole.rfind(b"%%EOF", at, stop if stop > 0 else len(whole))
    return end + 5 - at if end > 0 and whole.find(b"startxref", at, end) > 0 else 0


@lru_cache(maxsize=1)
def _archives(whole: bytes) -> dict[int, int]:
    """Where each archive of a value starts, by the end records whose central directory ends at them, and where it ends."""
    out, p = {}, -1
    while (p := whole.find(b"PK\5\6", p + 1)) >= 0 and p + 22 <= len(whole):
        size, start, note = struct.unpack_from("<IIH", whole, p + 12)
        at = p - size - start
        if at >= 0 and whole[at + start : at + start + 4] in (b"PK\1\2", b"PK\5\6") and p + 22 + note <= len(whole):
            out.setdefault(at, p + 22 + note)
    return out


def zipped(b: memoryview, at: int) -> int:
    """The first end record whose central directory starts and ends where it says; a value's end records are read once."""
    return max(0, _archives(b.obj).get(at, 0) - at)


def gzipped(b: memoryview, at: int) -> int:
    """One member that inflates, with its checksum, to the end; output is dropped piece by piece."""
    d, p = zlib.decompressobj(31), at
    try:
        rest = b""
        while not d.eof:
            if not rest:
                rest, p = bytes(b[p : p + 65_536]), p + 65_536
                if not rest:
                    return 0
            d.decompress(rest, 1 << 20)
            rest = d.unconsumed_tail
    except zlib.error:
        return 0
    return min(p, len(b)) - len(d.unused_data) - len(rest) - at


def mp4(b: memoryview, at: int) -> int:
    """Top-level boxes from ftyp on, with media or an index among them."""
    p, seen = at, []
    while p + 8 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        if n == 1 and p + 16 <= len(b):
            (n,) = struct.unpack_from(">Q", b, p + 8)
        if n < 8 or kind not in (b"ftyp", b"moov", b"mdat", b"moof", b"free", b"skip", b"wide", b"meta", b"uuid", b"sidx", b"styp", b"mfra", b"pdin"):
            break
        if p + n > len(b):
            return 0
        seen.append(kind)
        p += n
    return p - at if seen[:1] == [b"ftyp"] and {b"moov", b"mdat", b"meta"} & set(seen) else 0


#: (type, magic bytes, where they stand in the file, validator).
FORMATS: tuple[tuple[str, bytes, int, Callable[[memoryview, int], int]], ...] = (
    ("image/png", b"\x89PNG\r\n\x1a\n", 0, png),
    ("image/gif", b"GIF87a", 0, gif),
    ("image/gif", b"GIF89a", 0, gif),
    ("image/jpeg", b"\xff\xd8\xff", 0, jpeg),
    ("image/bmp", b"BM", 0, bmp),
    ("image/webp", b"WEBPVP8", 8, _riff(b"WEBP", (b"VP8 ", b"VP8L", b"VP8X"))),
    ("audio/wav", b"WAVE", 8, _riff(b"WAVE", (b"data",), (b"fmt ",))),  # other chunks may stand before fmt
    ("video/avi", b"AVI LIST", 8, _riff(b"AVI ", (b"LIST",))),
    ("audio/ogg", b"OggS\0\2", 0, ogg),
    ("audio/flac", b"fLaC", 0, flac),
    ("video/mp4", b"ftyp", 4, mp4),
    ("application/pdf", b"%PDF-", 0, pdf),
    ("application/zip", b"PK\3\4", 0, zipped),
    ("application/gzip", b"\x1f\x8b\x08", 0, gzipped),
)


class Sniffer:
    """The automaton over all magic bytes; values are searched as Latin-1 text, a character a byte."""

    def __init__(self):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        for k, (_, magic, _, _) in enumerate(FORMATS):
            self.find.add_word(magic.decode("latin-1"), k)
        self.find.make_automaton()

    def segments(self, value: bytes) -> list[tuple[str, int, int]]:
        """(kind, start, length) of the files in ``value`` in order.

        Outside the file that is the whole value, files do not overlap: the first
        wins, and what stands inside it belongs to it.
        """
        view, starts = memoryview(value), set()
        for end, k in self.find.iter(value.decode("latin-1")):
            start = end + 1 - len(FORMATS[k][1]) - FORMATS[k][2]
            if start >= 0:
                starts.add((start, k))
        out, free = [], 0
        for start, k in sorted(starts):
            if start >= free and (n := FORMATS[k][3](view, start)):
                out.append((FORMATS[k][0], start, n))
                free = 1 if n == len(value) else start + n
        return out


def sniff(df: DataFrame, content_col: str = "content", declared_col: str | None = None) -> DataFrame:
    """``df`` with ``detected``, ``corrected`` and ``segments`` (array of kind, start, length).

    ``detected`` is the type of the file that starts at byte 0, else the declared
    type if it is none of the known formats (a known one that fails validation is
    taken away), else ``application/octet-stream``.  ``corrected`` tells whether it
    differs from the declared type.  Null and empty values have no segments and
    keep their declared type.  Columns of these names are replaced.
    """
    new = ("detected", "corrected", "segments")
    kept = [c for c in df.columns if c.lower() not in new]
    content = kept.index(next(c for c in kept if c.lower() == content_col.lower()))
    declared = None if declared_col is None else kept.index(next(c for c in kept if c.lower() == declared_col.lower()))
    known = {f[0] for f in FORMATS}
    segments = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sniffer()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                said = part.column(declared).to_pylist() if declared is not None else [None] * part.num_rows
                found, types = [], []
                for value, d in zip(part.column(content), said):
                    raw = value.as_py()
                    got = own.segments(bytes(raw)) if raw else []
                    found.append([{"kind": k, "start": s, "length": n} for k, s, n in got])
                    types.append(got[0][0] if got and got[0][1] == 0 else d if not raw else d if d is not None and d not in known else UNKNOWN)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(types, pa.string()), pa.array([t != d for t, d in zip(types, said)]), pa.array(found, segments)], names=[*kept, *new])

    slim = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType(list(slim.schema.fields)).add(new[0], StringType()).add(new[1], BooleanType()).add(new[2], ArrayType(SEGMENT))
    return slim.mapInArrow(run, schema)


def carve(sniffed: DataFrame, content_col: str = "content") -> DataFrame:
    """One row for each file inside a value of :func:`sniff`'s result: its columns, kind, start, length and media (the bytes)."""
    rows = sniffed.select("*", F.inline("segments"))
    return rows.withColumn("media", F.substring(F.col(content_col), (F.col("start") + 1).cast("int"), F.col("length").cast("int")))


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """A WAV file of unsigned 8-bit mono samples."""
    pad = len(samples) & 1
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples)) + samples + b"\0" * pad


def wav_samples(file: bytes) -> tuple[int, bytes] | None:
    """(rate, samples) of an 8-bit mono WAV file; None if it is another."""
    p, rate = 12, None
    while p + 8 <= len(file):
        kind, n = struct.unpack_from("<4sI", file, p)
        if kind == b"fmt ":
            coding, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", file, p + 8)
            if (coding, channels, bits) != (1, 1, 8):
                return None
        if kind == b"data" and rate is not None:
            return rate, file[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    return None


def store_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every whole text as the 8-bit samples of a WAV file; null is the empty text.

    Null and repeated ids stay, a row each; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in part.column(1)]
                files = [wav(x + b"\0" * (max(64, -(-len(x) // 64) * 64) - len(x))) for x in raw]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def feature(rate: int, samples: bytes) -> str:
    """Duration, level and crossings of the middle, of the samples as read back."""
    x = np.frombuffer(samples, dtype=np.uint8)
    centred = x.astype(np.int16) - 128
    power = int((centred.astype(np.int32) ** 2).sum(dtype=np.int64))
    crossings = int(np.count_nonzero(np.diff(x >= 128)))
    return f"audio/wav rate={rate} samples={len(x)} sum={int(x.sum(dtype=np.int64))} power={power} crossings={crossings} peak={int(x.max()) if len(x) else 0}"


def read_media(stored: DataFrame, content_col: str = "media") -> DataFrame:
    """What sniffing, validating and reading a stored file back tells.

    Takes the rows of :func:`sniff`; adds payload_bytes, payload_sha256, tail_crc32
    (of the last 64 payload bytes), media_bytes, media_sha256 and feature.  The
    payload of a file that is no 8-bit mono WAV is null, and so is all that rests on
    it; a null file has nulls only.  Repeated rows and null ids stay, an empty table
    stays empty; the content and ``segments`` go, columns of the new names are
    replaced, and all others stay.
    """
    new = {"payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"}
    names = [c for c in stored.columns if c.lower() not in {content_col.lower(), "segments"} | new]
    fields = [*names, content_col]
    out = StructType(list(stored.select(*names).schema.fields))
    for name, kind in (("payload_bytes", LongType()), ("payload_sha256", StringType()), ("tail_crc32", LongType()), ("media_bytes", LongType()), ("media_sha256", StringType()), ("feature", StringType())):
        out = out.add(name, kind)

    def digests(file: bytes | None, kind: str) -> tuple:
        if file is None:
            return (None,) * 6
        got = wav_samples(file) if kind == "audio/wav" else None
        whole = (len(file), hashlib.sha256(file).hexdigest())
        if got is None:
            return (None, None, None, *whole, None)
        rate, samples = got
        return (len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), *whole, feature(rate, samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detected = names.index("detected")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                files = (x.as_buffer().to_pybytes() if x.is_valid else None for x in part.column(len(names)))
                rows = [digests(f, k) for f, k in zip(files, part.column(detected).to_pylist())]
                cols = list(zip(*rows))
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *(pa.array(c, t) for c, t in zip(cols, types))], names=out.names)

    return stored.select(*fields).mapInArrow(run, out)
