"""The record table: one row for each image or document, keyed by ``filename``.

Rows are never deleted: a verdict is an entry of ``reject_reasons``, and
``rejected`` tells whether there is any.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the record format.
UNKNOWN_LICENSE = "UNKNOWN"
STRATA, PLASTIC, PROXY, SYNTHETIC, UNCLASSIFIED = "01_real_estratos", "02_real_plastiglomerado", "03_proxy_materiales", "04_synth_plastiglomerado", "_unclassified"
CLASSES = (STRATA, PLASTIC, PROXY, SYNTHETIC, UNCLASSIFIED)
REASONS = ("too_small", "studio_background", "blurry", "duplicate", "extreme_aspect", "unreadable", "license_denied", "out_of_scope", "manual")
#: Reasons that the pixel filters set anew on each pass; the others survive it.
RECOMPUTED = ("too_small", "studio_background", "blurry", "extreme_aspect")
CLASS_REPEATS = {STRATA: 10, PLASTIC: 15, PROXY: 8, SYNTHETIC: 5}
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".tiff", ".tif", ".webp")

RECORD = T.StructType(
    [
        T.StructField("filename", T.StringType(), False),
        T.StructField("sha256", T.StringType()),
        T.StructField("phash", T.StringType()),
        T.StructField("source", T.StringType(), False),
        T.StructField("source_id", T.StringType()),
        T.StructField("origin_title", T.StringType()),
        T.StructField("origin_url", T.StringType()),
        T.StructField("download_url", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("attribution", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("mode", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sharpness", T.DoubleType()),
        T.StructField("saturation", T.DoubleType()),
        T.StructField("klass", T.StringType()),
        T.StructField("panoramic", T.BooleanType()),
        T.StructField("rejected", T.BooleanType()),
        T.StructField("reject_reasons", T.ArrayType(T.StringType())),
        T.StructField("needs_review", T.ArrayType(T.StringType())),
        T.StructField("caption", T.StringType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("mode", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("phash", T.StringType()),
        T.StructField("sharpness", T.DoubleType()),
        T.StructField("border_mean", T.DoubleType()),
        T.StructField("border_std", T.DoubleType()),
        T.StructField("dark_frac", T.DoubleType()),
        T.StructField("light_frac", T.DoubleType()),
        T.StructField("saturation", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Thresholds:
    """What the pixel filters compare with; the defaults are fixed values."""

    min_short_side: int = 1024
    panoramic_aspect: float = 2.0
    max_aspect: float = 3.5
    border_frac: float = 0.12
    border_std: float = 32.0
    border_dark: float = 62.0
    border_light: float = 205.0
    dark_frac: float = 0.40
    light_frac: float = 0.32
    dark_level: int = 30
    light_level: int = 225
    min_sharpness: float = 40.0
    hamming: int = 5

    def override(self, min_short_side: int | None = None, min_sharpness: float | None = None) -> Thresholds:
        """A zero short side means the default; a zero sharpness means zero."""
        return Thresholds(**{**self.__dict__, **({"min_short_side": min_short_side} if min_short_side else {}), **({"min_sharpness": min_sharpness} if min_sharpness is not None else {})})
