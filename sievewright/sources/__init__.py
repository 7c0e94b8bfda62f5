"""Sources of candidates, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def registry() -> dict:
    from sievewright.sources.europepmc import EuropePmcSource
    from sievewright.sources.flickr import FlickrSource
    from sievewright.sources.mediawiki import MediaWikiSource

    return {"wikimedia": MediaWikiSource, "europepmc": EuropePmcSource, "flickr": FlickrSource}


def available(name: str, options: dict | None = None) -> bool:
    """Whether a source has what it needs; an unknown name is a KeyError."""
    return registry()[name] is not None and (name != "flickr" or bool((options or {}).get("api_key")))


def listed(spark: SparkSession, name: str, queries: list[str], **options) -> DataFrame:
    """What a source finds for ``queries``, as it came: query, seq, its own columns, and error where a listing broke off."""
    import json

    source = registry()[name]
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(queries=json.dumps(queries), **{k: str(v) for k, v in options.items()}).load()


def to_records(name: str, raw: DataFrame, klass: str) -> DataFrame:
    """Record fields of what :func:`listed` found; also query and seq."""
    from sievewright.sources import europepmc, flickr, mediawiki

    if name == "wikimedia":
        return mediawiki.pages_to_records(raw, "page", F.lit(klass), F.regexp_replace("query", "(?i)^category:", ""))
    if name == "europepmc":
        return europepmc.figures_to_records(raw, F.lit(klass), F.col("query"))
    return flickr.photos_to_records(raw, "photo", F.lit(klass), F.col("query"))


def discover(spark: SparkSession, name: str, queries: list[str], klass: str, **options) -> DataFrame:
    """Record fields of what a source finds for ``queries``; also query and seq."""
    return to_records(name, listed(spark, name, queries, **options), klass)
