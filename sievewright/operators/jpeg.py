"""Baseline JPEG from pixels, in numpy: no chroma subsampling, Huffman codes made for each picture.

A picture is passed over twice, in strips of block rows: once to count the symbols
that the codes are made from, once to write.  Neither pass holds more than a strip
of coefficients, however large the picture.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# The example quantisation tables of ITU-T T.81, annex K.1, row by row.
LUMINANCE = (
    (16, 11, 10, 16, 24, 40, 51, 61),
    (12, 12, 14, 19, 26, 58, 60, 55),
    (14, 13, 16, 24, 40, 57, 69, 56),
    (14, 17, 22, 29, 51, 87, 80, 62),
    (18, 22, 37, 56, 68, 109, 103, 77),
    (24, 35, 55, 64, 81, 104, 113, 92),
    (49, 64, 78, 87, 103, 121, 120, 101),
    (72, 92, 95, 98, 112, 100, 103, 99),
)
CHROMINANCE = (
    (17, 18, 24, 47, 99, 99, 99, 99),
    (18, 21, 26, 66, 99, 99, 99, 99),
    (24, 26, 56, 99, 99, 99, 99, 99),
    (47, 66, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
)

#: Blocks of a strip, three components counted.
STRIP = 24_576
#: Places of a block in the order of its symbols: DC at 0, before each coefficient k three long runs from 4 k, the end of the block.
PLACES, END = 260, 259


@lru_cache(maxsize=1)
def zigzag() -> np.ndarray:
    """The 64 places of a block, diagonal by diagonal, each the other way than the one before."""
    at = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in at])


@lru_cache(maxsize=1)
def cosines() -> np.ndarray:
    """The orthonormal 8 x 8 cosine transform."""
    k = np.arange(8)
    d = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 16) / 2
    d[0] /= np.sqrt(2)
    return d.astype(np.float32)


def tables(quality: int) -> np.ndarray:
    """(2, 8, 8) divisors of a quality from 1 to 100."""
    percent = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array([LUMINANCE, CHROMINANCE]) * percent + 50) // 100, 1, 255)


def strips(rgb: np.ndarray, divisors: np.ndarray) -> Iterator[np.ndarray]:
    """Quantised coefficients, (blocks, 3, 64) in zigzag order, of strip after strip of block rows."""
    h, w = rgb.shape[:2]
    across = -(-w // 8)
    rows = 8 * max(1, STRIP // (3 * across))
    of = divisors[[0, 1, 1]].astype(np.float32)
    for top in range(0, h, rows):
        part = rgb[top : top + rows].astype(np.float32)
        part = np.pad(part, ((0, -part.shape[0] % 8), (0, 8 * across - w), (0, 0)), mode="edge")
        r, g, b = np.moveaxis(part, 2, 0)
        y = 0.299 * r + 0.587 * g + 0.114 * b
        planes = np.stack([y - 128, (b - y) / 1.772, (r - y) / 1.402])
        blocks = planes.reshape(3, -1, 8, across, 8).transpose(1, 3, 0, 2, 4).reshape(-1, 3, 8, 8)
        found = np.rint(cosines() @ blocks @ cosines().T / of).clip(-1023, 1023).astype(np.int64)
        yield found.reshape(-1, 3, 64)[:, :, zigzag()]


def symbols(found: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(table, symbol, extra bits, their number) of each symbol of a strip, in the order they are written.

    ``before`` holds the DC coefficients ahead of the strip.  Tables: 0 and 1 for the
    DC of luminance and chrominance, 2 and 3 for AC.
    """
    blocks = found.reshape(-1, 64)
    dc = np.diff(found[:, :, 0], axis=0, prepend=before[None, :]).ravel()
    b, k = np.nonzero(blocks[:, 1:])
    k += 1
    first = np.ones(len(b), dtype=bool)
    first[1:] = b[1:] != b[:-1]
    gap = k - np.where(first, 0, np.roll(k, 1)) - 1
    value = blocks[b, k]
    last = np.zeros(len(blocks), dtype=np.int64)
    last[b] = k  # the greatest of a block comes last
    short = np.flatnonzero(last < 63)
    long = gap >> 4
    of = np.repeat(np.arange(len(b)), long)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(long) - long, long)
    every = np.concatenate([dc, value])
    bits = np.frexp(np.abs(every).astype(np.float64))[1]
    extra = np.where(every < 0, every + (1 << bits) - 1, every)
    n, z, e = len(blocks), len(of), len(short)
    none = np.zeros(z + e, dtype=np.int64)
    block = np.concatenate([np.arange(n), b, b[of], short])
    place = np.concatenate([np.zeros(n, dtype=np.int64), 4 * k + 3, 4 * k[of] + nth, np.full(e, END)])
    name = np.concatenate([bits[:n], ((gap & 15) << 4) + bits[n:], np.full(z, 0xF0), np.zeros(e, dtype=np.int64)])
    table = np.where(place == 0, 0, 2) + (block % 3 > 0)
    order = np.argsort(block * PLACES + place)
    return table[order], name[order], np.concatenate([extra, none])[order], np.concatenate([bits, none])[order]


def code_lengths(counts: np.ndarray, most: int = 16) -> dict[int, int]:
    """Lengths of the best prefix code of at most ``most`` bits for symbols by their counts, by merging packages.

    One symbol more, as rare as none, takes the code of ones only, which the format forbids.
    """
    single = sorted([(1 + int(counts[s]) * 512, (s,)) for s in np.flatnonzero(counts).tolist()] + [(1, (-1,))])
    if len(single) < 3:
        return {s: 1 for _, (s,) in single if s >= 0}
    row: list = []
    for _ in range(most):
        paired = [(row[i][0] + row[i + 1][0], row[i][1] + row[i + 1][1]) for i in range(0, len(row) - 1, 2)]
        row = sorted(single + paired, key=lambda x: x[0])
    out = dict.fromkeys((s for _, (s,) in single), 0)
    for _, held in row[: 2 * len(single) - 2]:
        for s in held:
            out[s] += 1
    del out[-1]  # the rarest symbol's code is the last of the longest: ones only
    return out


def huffman(counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(the table as the file holds it, code of each symbol, its length)."""
    lengths = code_lengths(counts)
    ranked = sorted(lengths, key=lambda s: (lengths[s], s))
    code, size = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
    now, was = 0, lengths[ranked[0]] if ranked else 0
    for s in ranked:
        now <<= lengths[s] - was
        was = lengths[s]
        code[s], size[s] = now, was
        now += 1
    held = [sum(1 for s in ranked if lengths[s] == n) for n in range(1, 17)]
    return bytes(held) + bytes(ranked), code, size


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _packed(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bits, one a byte, of numbers of up to 32 bits."""
    left = (value.astype(np.uint64) << (32 - size).astype(np.uint64)).astype(">u4")
    bits = np.unpackbits(left.view(np.uint8).reshape(-1, 4), axis=1)
    return bits[np.arange(32) < size[:, None]]


def encode(rgb: np.ndarray, quality: int = 95) -> bytes:
    """A baseline JPEG (JFIF, 4:4:4) of (h, w, 3) levels of 0..255; ``ValueError`` for a size the format cannot hold."""
    h, w = rgb.shape[:2]
    if rgb.ndim != 3 or rgb.shape[2] != 3 or not (0 < h < 65_536 and 0 < w < 65_536):
        raise ValueError(f"no JPEG of shape {rgb.shape}")
    divisors = tables(quality)
    counts, before = np.zeros(1024, dtype=np.int64), np.zeros(3, dtype=np.int64)
    for found in strips(rgb, divisors):
        table, name, _, _ = symbols(found, before)
        counts += np.bincount(table * 256 + name, minlength=1024)
        before = found[-1, :, 0]
    codes = [huffman(c) for c in counts.reshape(4, 256)]
    code, size = (np.concatenate([c[i] for c in codes]) for i in (1, 2))
    out = [b"\xff\xd8", _segment(0xE0, b"JFIF\0" + struct.pack(">HBHHBB", 0x0101, 0, 1, 1, 0, 0))]
    out += [_segment(0xDB, bytes([i]) + bytes(divisors[i].ravel()[zigzag()].tolist())) for i in (0, 1)]
    out.append(_segment(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1])))
    out += [_segment(0xC4, bytes([16 * (i // 2) + i % 2]) + codes[i][0]) for i in range(4)]
    out.append(_segment(0xDA, bytes([3, 1, 0x00, 2, 0x11, 3, 0x11, 0, 63, 0])))
    before, rest = np.zeros(3, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    for found in strips(rgb, divisors):
        table, name, extra, bits = symbols(found, before)
        at = table * 256 + name
        whole = np.concatenate([rest, _packed((code[at] << bits) + extra, size[at] + bits)])
        full = len(whole) // 8 * 8
        out.append(np.packbits(whole[:full]).tobytes().replace(b"\xff", b"\xff\x00"))
        before, rest = found[-1, :, 0], whole[full:]
    if len(rest):
        out.append(np.packbits(np.concatenate([rest, np.ones(8 - len(rest), dtype=np.uint8)])).tobytes().replace(b"\xff", b"\xff\x00"))
    return b"".join([*out, b"\xff\xd9"])
