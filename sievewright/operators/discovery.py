"""Discovery: which candidates are new, admitted, and under which name they come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.licenses import is_allowed
from sievewright.functions.text import none_if_empty
from sievewright.operators.manifest import known_urls
from sievewright.schema import UNKNOWN_LICENSE


def anti_join_known(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidates whose URL the manifest does not know."""
    return candidates.join(known_urls(manifest), "download_url", "left_anti")


def limit_per_group(df: DataFrame, group: str, order: Column, most: int) -> DataFrame:
    """The first ``most`` rows of each group (a group limit, applied before the shuffle too)."""
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("rank_") <= most).drop("rank_")


def candidate_status(candidates: DataFrame, manifest: DataFrame, order: str = "seq", allow_unknown: bool = False) -> DataFrame:
    """``candidates`` with ``status``, decided in the order of discovery.

    ``skipped_known``: no URL, a URL of the manifest, or one accepted earlier in
    this run; ``skipped_license``: not admitted; else ``accepted``.  A URL counts as
    seen only once it was accepted, so the first admitted row of a URL is taken.
    """
    allowed = is_allowed(F.col("license"))
    if allow_unknown:
        allowed = allowed | (F.coalesce(F.col("license"), F.lit(UNKNOWN_LICENSE)) == UNKNOWN_LICENSE)
    url = none_if_empty(F.col("download_url"))
    known = known_urls(manifest).select(F.col("download_url").alias("known_"))
    rows = candidates.join(known, url == F.col("known_"), "left").withColumn("allowed_", allowed)
    taken = rows.where(F.col("known_").isNull() & url.isNotNull() & F.col("allowed_")).groupBy(F.col("download_url").alias("url_")).agg(F.min(order).alias("taken_"))
    rows = rows.join(taken, url == F.col("url_"), "left")
    status = F.when(url.isNull() | F.col("known_").isNotNull() | F.coalesce(F.col(order) > F.col("taken_"), F.lit(False)), "skipped_known").when(~F.col("allowed_"), "skipped_license").otherwise("accepted")
    return rows.withColumn("status", status).drop("known_", "allowed_", "url_", "taken_")


def unique_filename(accepted: DataFrame, manifest: DataFrame, order: str = "seq") -> DataFrame:
    """``accepted`` with ``final_name``.

    A name is free for the first row of the run that has it, if the manifest has no
    record of that name or one of the same URL; others get the first eight digits of
    their URL's SHA-1 before the extension.
    """
    old = manifest.select(F.col("filename").alias("old_name_"), F.col("download_url").alias("old_url_"))
    rows = accepted.join(old, F.col("filename") == F.col("old_name_"), "left")
    free = F.col("old_name_").isNull() | F.col("old_url_").eqNullSafe(F.col("download_url"))
    first = rows.groupBy(F.col("filename").alias("name_")).agg(F.min(order).alias("first_"))
    rows = rows.join(first, F.col("filename") == F.col("name_"))
    digest = F.substring(F.sha1(F.coalesce(none_if_empty(F.col("download_url")), F.col("filename"))), 1, 8)
    dotted = F.contains(F.col("filename"), F.lit("."))
    other = F.when(dotted, F.regexp_replace(F.col("filename"), r"^(.*)\.([^.]*)$", F.concat(F.lit("$1_"), digest, F.lit(".$2")))).otherwise(F.concat("filename", F.lit("_"), digest))
    return rows.withColumn("final_name", F.when(free & (F.col(order) == F.col("first_")), F.col("filename")).otherwise(other)).drop("old_name_", "old_url_", "name_", "first_")


def query_plan(sources: DataFrame, queries: DataFrame) -> DataFrame:
    """Every source with every (class, term); both are lists of a configuration, a few dozen rows."""
    return sources.crossJoin(queries)


def counters(candidates: DataFrame) -> DataFrame:
    """(kind, name, n): what a run met, by status, source and class of the accepted, and licence."""
    ok = candidates.where("status = 'accepted'")
    parts = [candidates.groupBy(F.lit("status").alias("kind"), F.col("status").alias("name")), ok.groupBy(F.lit("source").alias("kind"), F.col("source").alias("name")), ok.groupBy(F.lit("class").alias("kind"), F.col("klass").alias("name")), ok.groupBy(F.lit("license").alias("kind"), F.col("license").alias("name"))]
    out = parts[0].count()
    for p in parts[1:]:
        out = out.unionByName(p.count())
    return out.withColumnRenamed("count", "n")


def top_counts(df: DataFrame, name: Column, order: str, most: int) -> DataFrame:
    """(name, n): the commonest values; of equal counts, the one met first comes first."""
    return df.groupBy(name.alias("name")).agg(F.count("*").alias("n"), F.min(order).alias("first_")).orderBy(F.desc("n"), "first_").limit(most).drop("first_")
