"""Reports: counts, totals and quantiles over records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.functions.licenses import apply_policy, is_allowed
from sievewright.functions.text import suffix
from sievewright.functions.verdicts import has, has_provenance, is_rejected, resize_reasons, short_side
from sievewright.schema import CLASSES, IMAGE_SUFFIXES, UNKNOWN_LICENSE


def by_class(df: DataFrame) -> DataFrame:
    """(klass, n) of active rows, a row for each class even at 0."""
    spark: SparkSession = df.sparkSession
    dim = spark.createDataFrame([(c, i) for i, c in enumerate(CLASSES)], "klass string, place int")
    counts = df.where(~F.col("rejected")).groupBy("klass").agg(F.count("*").alias("n"))
    return dim.join(counts, "klass", "left").orderBy("place").select("klass", F.coalesce("n", F.lit(0)).alias("n"))


def by_license(df: DataFrame) -> DataFrame:
    return df.where(~F.col("rejected")).groupBy("license").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "license")


def reasons(df: DataFrame) -> DataFrame:
    """(reason, n) over all rows, a row for each reason it has."""
    return df.select(F.explode("reject_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def percent(part: Column, whole: Column) -> Column:
    """Whole per cent, rounded down; 0 of nothing."""
    return F.when(whole > 0, F.floor(100 * part / whole)).otherwise(F.lit(0)).cast("long")


def totals(df: DataFrame) -> DataFrame:
    """One row: entries, active, rejected, those of the active with provenance (and per cent), captioned active rows."""
    live = ~F.col("rejected")
    own = has_provenance(F.col("license"), F.col("origin_title"))
    out = df.agg(F.count("*").alias("entries"), F.count_if(live).alias("active"), F.count_if(~live).alias("rejected"), F.count_if(live & own).alias("with_provenance"), F.count_if(live & (F.coalesce("caption", F.lit("")) != "")).alias("captioned"))
    return out.withColumn("provenance_pct", percent(F.col("with_provenance"), F.col("active")))


def attribution_counts(df: DataFrame) -> DataFrame:
    live = ~F.col("rejected")
    return df.agg(F.count_if(live).alias("active"), F.count_if(live & (F.coalesce("origin_title", F.lit("")) != "")).alias("with_title"), F.count_if(live & (F.col("license") == UNKNOWN_LICENSE)).alias("unknown_license"))


def histogram(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n")).orderBy(name)


def nearest_rank(df: DataFrame, column: str, fractions: dict[str, float], parts: int = 256) -> DataFrame:
    """One row: min, max, median and nearest-rank quantiles of the non-null values.

    The quantile of p is the value at place min(floor(n * p), n - 1) from 0 in
    ascending order.  The distinct values with their numbers are dealt into ``parts``
    ranges of about equal size; the ranges' totals tell in which ones the wanted
    places lie, and only those are put in order, each by itself.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("m"))
    bounds = counts.agg(F.percentile_approx("v", [k / parts for k in range(1, parts)], 20 * parts).alias("b")).first()["b"] or []
    edges = sorted(set(bounds))
    of = F.size(F.filter(F.array(*[F.lit(b) for b in edges]), lambda b: b < F.col("v"))) if edges else F.lit(0)
    ranged = counts.withColumn("part", of)
    whole, upto = Window.partitionBy(), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(F.sum("m").alias("held"), F.min("v").alias("low"), F.max("v").alias("high"))  # a row for each range
    totals = totals.select("part", "held", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("before"), F.sum("held").over(whole).alias("n"), F.min("low").over(whole).alias("least"), F.max("high").over(whole).alias("most"))
    n = F.col("n")
    places = {**{k: F.least(F.floor(n * F.lit(p)), n - 1) for k, p in fractions.items()}, "low_mid": F.floor((n - 1) / 2), "high_mid": F.floor(n / 2)}
    holds = reduce(lambda a, b: a | b, [(F.col("before") <= p) & (p < F.col("before") + F.col("held")) for p in places.values()])
    placed = ranged.join(totals.where(holds), "part").withColumn("upto", F.col("before") + F.sum("m").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("v")))
    middle = (at(places["low_mid"]).cast("double") + at(places["high_mid"]).cast("double")) / 2
    return placed.agg(F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("n"), F.max("least").alias("least"), F.max("most").alias("most"), middle.alias("median"), *[at(places[k]).alias(k) for k in fractions])


def file_summary(df: DataFrame) -> DataFrame:
    """One row: files and their bytes, those that are pictures by suffix, the range of widths, the middle height, and pictures that are neither RGB nor grey."""
    pictures = suffix(F.col("filename")).isin(*IMAGE_SUFFIXES)
    return df.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.count_if(pictures).alias("images"), F.min("width").alias("least_width"), F.max("width").alias("most_width"), F.median("height").alias("median_height"), F.count_if(~F.col("mode").isin("RGB", "L")).alias("odd_modes"))


def usable(df: DataFrame, duplicate: Column, readable: Column) -> DataFrame:
    """One row: readable rows, and those of them that no audit verdict of this run concerns."""
    bad = F.lit(False)
    for r in ("too_small", "studio_background", "blurry", "extreme_aspect"):
        bad = bad | has(F.col("reject_reasons"), r)
    bad = bad | F.coalesce(duplicate, F.lit(False))
    return df.agg(F.count_if(readable).alias("readable"), F.count_if(readable & ~bad).alias("usable"))


def relicense(df: DataFrame) -> DataFrame:
    """Records after the licence policy, with ``was_denied`` and ``is_denied``."""
    was = has(F.col("reject_reasons"), "license_denied")
    after = apply_policy(F.col("license"), F.col("reject_reasons"))
    return df.withColumn("was_denied", was).withColumn("is_denied", ~is_allowed(F.col("license"))).withColumn("reject_reasons", after).withColumn("rejected", is_rejected(F.col("reject_reasons")))


def relicense_delta(df: DataFrame) -> DataFrame:
    """(filename, license, change): rows newly ``denied`` or ``freed``."""
    out = relicense(df)
    change = F.when(~F.col("was_denied") & F.col("is_denied"), "denied").when(F.col("was_denied") & ~F.col("is_denied"), "freed")
    return out.select("filename", "license", change.alias("change")).where("change is not null")


def refilter(df: DataFrame, least: int, klass: str | None = None) -> DataFrame:
    """Records against another least short side, with ``changed`` and the verdict before (``was_rejected``)."""
    chosen = F.lit(True) if klass is None else F.col("klass") == klass
    had = has(F.col("reject_reasons"), "too_small")
    side = short_side(F.col("width"), F.col("height"))
    changed = F.coalesce(chosen & ((side < least) != had), F.lit(False))
    after = F.when(F.col("changed"), resize_reasons(F.col("reject_reasons"), F.col("width"), F.col("height"), least)).otherwise(F.col("reject_reasons"))
    out = df.withColumn("changed", changed).withColumn("was_rejected", F.col("rejected")).withColumn("reject_reasons", after)
    return out.withColumn("rejected", F.when(F.col("changed"), is_rejected(F.col("reject_reasons"))).otherwise(F.col("rejected")))


def refilter_counts(df: DataFrame) -> DataFrame:
    """One row of a refiltered frame.

    ``rescued`` and ``newly_rejected`` go by the verdict before, as the command has
    always counted; the ``_truly`` columns count rows whose verdict turned.
    """
    c, was, now = F.col("changed"), F.col("was_rejected"), F.col("rejected")
    return df.agg(F.count_if(c).alias("changed"), F.count_if(c & was).alias("rescued"), F.count_if(c & ~was).alias("newly_rejected"), F.count_if(c & was & ~now).alias("rescued_truly"), F.count_if(c & ~was & now).alias("newly_rejected_truly"))
