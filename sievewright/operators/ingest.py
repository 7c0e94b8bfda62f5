"""Ingest and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions.text import suffix
from sievewright.schema import IMAGE_SUFFIXES


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, length) of the files of a folder, not of its subfolders; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return rows.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length")


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder that are pictures by their suffix, sorted by path."""
    return list_files(spark, folder).where(suffix(F.col("name")).isin(*IMAGE_SUFFIXES)).orderBy("path")


def list_references(spark: SparkSession, folder: str) -> DataFrame:
    """(name) of the pictures of a folder that a generator may start from: JPEG and PNG by their suffix, in any case, sorted."""
    return list_files(spark, folder).where(suffix(F.col("name")).isin(".jpg", ".jpeg", ".png")).select("name").orderBy("name")


def new_or_changed(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``source`` (name, length, ...) of which ``target`` has no file of the same name and length."""
    return source.join(target.select("name", "length").distinct(), ["name", "length"], "left_anti")


def sha256(content: Column) -> Column:
    """The digest of a file's bytes, or of a text's UTF-8, in hex."""
    return F.sha2(content, 256)


def with_sha256(spark: SparkSession, folder: str) -> DataFrame:
    """(name, sha256, length) of a folder's files, hashed where they are read."""
    rows = spark.read.format("binaryFile").load(folder)
    return rows.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), sha256(F.col("content")).alias("sha256"), "length")


def seed_records(images: DataFrame, known: DataFrame, source_name: str = "local") -> DataFrame:
    """(filename, sha256, source): images the manifest does not have, and those of its rows that lack a digest."""
    old = known.select("filename", F.col("sha256").alias("old_"), F.col("source").alias("source_"))
    rows = images.select(F.col("name").alias("filename"), "sha256").join(old, "filename", "left")
    return rows.where("old_ is null or old_ = ''").select("filename", "sha256", F.coalesce("source_", F.lit(source_name)).alias("source"))
