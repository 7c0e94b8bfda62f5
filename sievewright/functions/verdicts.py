"""The algebra of verdicts on array columns: ordered sets that are only ever added to or taken from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.schema import RECOMPUTED, Thresholds


def add_reason(values: Column, value: str | Column) -> Column:
    """``values`` with ``value`` at the end, if it is not there yet."""
    item = F.lit(value) if isinstance(value, str) else value
    held = F.coalesce(values, F.array().cast("array<string>"))
    return F.when(F.array_contains(held, item), held).otherwise(F.array_append(held, item))


def drop_reason(values: Column, value: str) -> Column:
    return F.array_remove(F.coalesce(values, F.array().cast("array<string>")), F.lit(value))


def has(values: Column, value: str) -> Column:
    return F.coalesce(F.array_contains(values, F.lit(value)), F.lit(False))


def is_rejected(reasons: Column) -> Column:
    return F.size(F.coalesce(reasons, F.array().cast("array<string>"))) > 0


def short_side(width: Column, height: Column) -> Column:
    """The lesser side; null where a side is missing or zero."""
    return F.when((width != 0) & (height != 0), F.least(width, height))


def aspect(width: Column, height: Column) -> Column:
    return F.when((width != 0) & (height != 0), F.greatest(width, height).cast("double") / F.least(width, height))


def has_provenance(license_: Column, title: Column) -> Column:
    return (F.coalesce(license_, F.lit("UNKNOWN")) != "UNKNOWN") & (F.coalesce(title, F.lit("")) != "")


def studio_background(border_mean: Column, border_std: Column, dark_frac: Column, light_frac: Column, t: Thresholds = Thresholds()) -> Column:
    """An even border that is dark or light, or too much of the picture that is."""
    even = (border_std < t.border_std) & ((border_mean < t.border_dark) | (border_mean > t.border_light))
    return even | (dark_frac > t.dark_frac) | (light_frac > t.light_frac)


def filter_reasons(reasons: Column, m: Column, t: Thresholds = Thresholds()) -> Column:
    """The reasons after the pixel filters saw the metrics ``m`` (a struct): recomputed ones anew, the others kept."""
    w, h = m["width"], m["height"]
    found = F.array_compact(
        F.array(
            F.when(F.least(w, h) < t.min_short_side, "too_small"),
            F.when(studio_background(m["border_mean"], m["border_std"], m["dark_frac"], m["light_frac"], t), "studio_background"),
            F.when(m["sharpness"] < t.min_sharpness, "blurry"),
            F.when(aspect(w, h) > t.max_aspect, "extreme_aspect"),
        )
    )
    kept = F.filter(F.coalesce(reasons, F.array().cast("array<string>")), lambda r: ~r.isin(*RECOMPUTED))
    return F.concat(kept, found)


def is_panoramic(m: Column, t: Thresholds = Thresholds()) -> Column:
    a = aspect(m["width"], m["height"])
    return F.coalesce((a >= t.panoramic_aspect) & (a <= t.max_aspect), F.lit(False))


def mode_note(notes: Column, mode: Column) -> Column:
    """A note where the picture has to become RGB."""
    note = F.concat(F.lit("convertir a RGB (mode="), mode, F.lit(")"))
    return F.when(~mode.isin("RGB", "L"), add_reason(notes, note)).otherwise(notes)


def resize_reasons(reasons: Column, width: Column, height: Column, least: int) -> Column:
    """Only ``too_small`` against the stored sides; rows without sides stay as they are."""
    side = short_side(width, height)
    return F.when(side.isNull(), reasons).when(side < least, add_reason(reasons, "too_small")).otherwise(drop_reason(reasons, "too_small"))
