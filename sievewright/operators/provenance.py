"""Provenance: metadata of a matched candidate, and generated records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions.bits import from_hex
from sievewright.functions.licenses import apply_policy
from sievewright.functions.text import CaptionWords, html_strip, none_if_empty, stem
from sievewright.functions.verdicts import add_reason, has_provenance, is_rejected
from sievewright.operators.duplicates import all_distances, distance_buckets, grid, hamming_pairs, match_by_lists, match_in_turn
from sievewright.schema import SYNTHETIC, UNKNOWN_LICENSE
from sievewright.scratch import written

# Fixed values of the generated descriptions.
COMPOSITIONS = ("close macro detail, top-down view", "angled view, raking side light", "cross-section cut, exposed interior texture", "wide view, several fragments scattered on a surface")
MIXES = ("dominated by fused plastic threads, netting and rope", "dominated by mineral sediment with sparse plastic inclusions", "roughly equal mix of sand, pebbles and melted plastic", "heavily weathered, plastic barely distinguishable from the rock matrix")
CONTEXTS = ("beach sediment, sand and pebbles", "volcanic basalt matrix", "coastal dune stratigraphy", "tidal debris accumulation")
SYNTH_LICENSE = "CC BY-SA 4.0 (síntesis derivada, no descargada de Commons)"


def pending(df: DataFrame) -> DataFrame:
    """Records without provenance that have a hash to be found by."""
    return df.where(~has_provenance(F.col("license"), F.col("origin_title")) & none_if_empty(F.col("phash")).isNotNull())


def match_candidates(records: DataFrame, candidates: DataFrame, radius: int = 5) -> DataFrame:
    """(seq, filename, distance): candidates (seq, phash) in turn take their nearest pending record."""
    locals_ = pending(records).select("filename", from_hex(F.col("phash")).alias("h"))
    hashed = candidates.select("seq", from_hex(F.col("phash")).alias("h"))
    return match_hashes(hashed, locals_.withColumnRenamed("filename", "local"), radius).select("seq", F.col("local").alias("filename"), "distance")


def match_hashes(candidates: DataFrame, locals_: DataFrame, radius: int) -> DataFrame:
    """(seq, local, distance): candidates (seq, h) in turn take their nearest free local (local, h).

    Over the pairs within the radius, where choices of bits find them; else by lists
    of each candidate's nearest.
    """
    candidates, locals_ = written(candidates.select(F.col("seq").cast("long").alias("seq"), "h"), "hashed-candidates"), written(locals_.select(F.col("local").cast("string").alias("local"), "h"), "hashed-locals")
    if grid(candidates.count() + locals_.count(), radius):
        return match_in_turn(cross_distances(candidates, locals_, radius))
    return match_by_lists(candidates, locals_, radius)


def hash_thumbs(spark: SparkSession, candidates: DataFrame, folder: str, fetch, tasks: int = 4) -> DataFrame:
    """Candidates (seq, thumb_url, ...) with ``phash`` and ``error`` of their thumbnails.

    Thumbnails go to a folder that executors share, by number; one that cannot be
    fetched or decoded is an error of its row, and the others go on.
    """
    from sievewright.operators.pixels import measure
    from sievewright.operators.tree import download

    named = candidates.select(F.format_string("%016d.img", "seq").alias("filename"), "seq", F.col("thumb_url").alias("download_url"))
    got = written(download(named, folder, fetch, tasks), "thumbs")
    measured = measure(spark, folder).select(F.col("name").alias("filename"), "phash", F.col("error").alias("unread_"))
    told = named.select("filename", "seq").join(got, "filename").join(measured, "filename", "left").select("seq", "phash", F.coalesce("error", "unread_").alias("error"))
    return candidates.join(told, "seq", "left")


def error_counts(rows: DataFrame, source: str = "source", error: str = "error") -> DataFrame:
    """(name, n): failures by source and type of error, the commonest first."""
    kind = F.concat(F.col(source), F.lit(": "), F.regexp_extract(error, "^([^:]*)", 1))
    return rows.where(F.col(error).isNotNull()).groupBy(kind.alias("name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name")


def match_buckets(records: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    return distance_buckets(candidates.select("seq", from_hex(F.col("phash")).alias("h")), pending(records).select(F.col("filename").alias("local"), from_hex(F.col("phash")).alias("h")), matches.select("seq", F.col("filename").alias("local")))


def apply_metadata(records: DataFrame, matched: DataFrame) -> DataFrame:
    """Records with the metadata of their candidate, and the licence policy on what came of it.

    ``matched`` has (filename, title, description_url, url, meta map<string,string>,
    category).  Without a licence of its own the candidate leaves the record's.
    """
    m = matched.select("filename", *[F.col(c).alias(f"{c}_") for c in ("title", "description_url", "url", "meta", "category")])
    rows = records.join(m, "filename", "left").withColumn("hit_", F.col("title_").isNotNull())
    field = lambda k: html_strip(F.try_element_at("meta_", F.lit(k)))
    listed = F.filter(F.transform(F.split(field("Categories"), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    cats = F.when(field("Categories").isNull(), F.array("category_")).otherwise(add_reason(listed, F.col("category_")))
    new = {
        "source": F.lit("wikimedia"),
        "origin_title": F.col("title_"),
        "origin_url": F.col("description_url_"),
        "download_url": F.col("url_"),
        "license": F.coalesce(field("LicenseShortName"), field("UsageTerms"), F.col("license")),
        "attribution": F.coalesce(field("Artist"), field("Credit")),
        "description": field("ImageDescription"),
        "categories": cats,
    }
    rows = rows.select(*[F.when(F.col("hit_"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in records.columns], "hit_")
    rows = rows.withColumn("reject_reasons", F.when(F.col("hit_"), apply_policy(F.col("license"), F.col("reject_reasons"))).otherwise(F.col("reject_reasons")))
    return rows.withColumn("rejected", F.when(F.col("hit_"), is_rejected(F.col("reject_reasons"))).otherwise(F.col("rejected"))).select(*records.columns)


def pick(values: tuple[str, ...], number: Column, salt: str) -> Column:
    """One of ``values`` by a hash of ``number``: deterministic, and independent for each salt."""
    place = F.conv(F.substring(F.md5(F.concat(F.lit(salt + "/"), number.cast("string"))), 1, 7), 16, 10).cast("long") % len(values)
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def synth_description(number: Column) -> Column:
    """A description for a seed: a mix, a context and a composition of four each, picked by hash."""
    return F.concat_ws(", ", pick(MIXES, number, "mix"), pick(CONTEXTS, number, "context"), pick(COMPOSITIONS, number, "composition"))


def synth_caption(description: Column, words: CaptionWords = CaptionWords()) -> Column:
    return F.concat(F.lit(f"{words.trigger}, {words.synthetic}, plastiglomerate, "), description, F.lit(", photographic detail, natural lighting"))


def round_robin(items: DataFrame, references: DataFrame, index: str = "i") -> DataFrame:
    """``items`` (with a number from 0) with the reference in turn; references go by name."""
    from pyspark.sql import Window

    n = references.count()
    if not n:
        raise ValueError("no references")
    numbered = references.select(F.col("name").alias("reference"), (F.row_number().over(Window.orderBy("name")) - 1).alias("place_"))
    return items.withColumn("place_", F.pmod(F.col(index), F.lit(n)).cast("int")).join(numbered, "place_").drop("place_")


def synth_records(spark: SparkSession, references: DataFrame, count: int, seed: int, scale: float = 0.35, words: CaptionWords = CaptionWords()) -> DataFrame:
    """The records that ``count`` generated pictures would have; drawing the pictures is not done here."""
    rows = round_robin(spark.range(count).select(F.col("id").alias("i")), references)
    run = F.col("i") + F.lit(seed)
    described = rows.withColumn("source_id", run.cast("string")).withColumn("description", synth_description(run))
    return described.select(
        "i",
        F.format_string("synth_%03d_%s.jpg", F.col("i"), stem(F.col("reference"))).alias("filename"),
        F.lit("synthesis").alias("source"),
        "source_id",
        F.concat(F.lit("Síntesis SDXL+IP-Adapter — seed "), "source_id", F.lit(f", escala {scale}")).alias("origin_title"),
        F.concat(F.lit("Generado a partir de "), "reference", F.lit(" (CC BY-SA 4.0, Wikimedia Commons)")).alias("attribution"),
        F.lit(SYNTH_LICENSE).alias("license"),
        "description",
        F.lit(SYNTHETIC).alias("klass"),
        synth_caption(F.col("description"), words).alias("caption"),
        "reference",
    )


def nearest(edges: DataFrame) -> DataFrame:
    """(seq, local, distance) of the nearest local of each candidate, ties to the first name."""
    return edges.groupBy("seq").agg(F.min(F.struct("distance", "local")).alias("best")).select("seq", "best.local", "best.distance")


def cross_distances(candidates: DataFrame, locals_: DataFrame, radius: int) -> DataFrame:
    """(seq, local, distance) of all pairs within ``radius`` of candidates (seq, h) and locals (local, h)."""
    candidates = written(candidates.select(F.col("seq").cast("long").alias("seq"), "h").where("seq is not null and h is not null"), "cross-candidates")
    locals_ = written(locals_.select(F.col("local").cast("string").alias("local"), "h").where("local is not null and h is not null"), "cross-locals")
    if not grid(candidates.count() + locals_.count(), radius):
        return all_distances(candidates, locals_, radius)
    keyed = candidates.select(F.concat(F.lit("c"), F.col("seq").cast("string")).alias("k"), "h").union(locals_.select(F.concat(F.lit("l"), "local"), "h"))
    pairs = hamming_pairs(keyed, "k", "h", radius).where(F.col("a").startswith("c") & F.col("b").startswith("l"))
    rest = lambda c: F.substring(c, 2, 1 << 30)
    return pairs.select(rest("a").cast("long").alias("seq"), rest("b").alias("local"), "distance")


def recovery_counts(records: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """(kind, name, n): records without provenance, candidates with and without a hash, matches, licences found and errors met."""
    own = has_provenance(F.col("license"), F.col("origin_title"))
    many = lambda kind, df, name=F.lit(None).cast("string"): df.groupBy(F.lit(kind).alias("kind"), name.alias("name")).agg(F.count("*").alias("n"))
    meta = lambda k: html_strip(F.try_element_at("meta", F.lit(k)))
    hit = matches.select("seq").join(candidates, "seq")
    hashed = none_if_empty(F.col("phash")).isNotNull()
    parts = [
        many("pending", pending(records)),
        many("with_provenance", records.where(own)),
        many("candidates", candidates),
        many("hashed", candidates.where(hashed)),
        many("failed", candidates.where(~hashed)),
        many("matched", matches),
        many("license", hit, F.coalesce(meta("LicenseShortName"), meta("UsageTerms"), F.lit(UNKNOWN_LICENSE))),
    ]
    if "error" in candidates.columns:
        parts.append(many("error", candidates.where(F.col("error").isNotNull()), F.regexp_extract("error", "^([^:]*)", 1)))
    return reduce(DataFrame.unionByName, parts)
