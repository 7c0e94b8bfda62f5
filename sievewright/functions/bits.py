"""Perceptual hashes as 64-bit integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions import let


def from_hex(c: Column) -> Column:
    """16 hexadecimal digits as a signed long; null for null and ''."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.conv(c, 16, -10).cast("long"))


def signed(x: int) -> int:
    """64 bits as a signed long; also of the union of signed longs."""
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def hamming_within(a: Column, b: Column, most: int) -> Column:
    """Never null: a missing hash is near to nothing."""
    return F.coalesce(hamming(a, b) <= most, F.lit(False))


def dct_bits(block: Column) -> Column:
    """64 coefficients to 64 bits (hex): over the median of all but the first, the first coefficient leading."""
    median = F.element_at(F.array_sort(F.slice(block, 2, 63)), 32)
    ones = let(median, lambda m: F.transform(block, lambda x: F.when(x > m, "1").otherwise("0")))
    return F.lpad(F.lower(F.conv(F.array_join(ones, ""), 2, 16)), 16, "0")


def band_cuts(radius: int) -> list[tuple[int, int]]:
    """(low bit, width) of radius + 1 bands over 64 bits: hashes within ``radius`` agree in at least one."""
    n, out, at = radius + 1, [], 0
    for k in range(n):
        width = 64 // n + (k < 64 % n)
        out.append((at, width))
        at += width
    return out


def band_keys(h: Column, radius: int) -> Column:
    """Array of (band, key), one for each band."""
    return F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(h, low).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)).alias("key")) for i, (low, width) in enumerate(band_cuts(radius))])
