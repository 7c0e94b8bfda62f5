"""Incremental discovery over streams: candidates once each, and the manifest kept by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.operators import manifest
from sievewright.operators.discovery import candidate_status


def first_seen(stream: DataFrame, key: str = "download_url", time: str | None = None, late: str = "1 hour") -> DataFrame:
    """Each key once.  With an event time, the state of a key is dropped ``late`` after it."""
    if time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, name: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(window start, name, n) of a stream's rows, late ones within ``late`` included."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), name).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), name, "n")


def upsert_batches(stream: DataFrame, path: str, order: str, checkpoint: str):
    """Keep a Parquet manifest: each batch's accepted candidates are written beside those of the batches before.

    A batch reads the known URLs only and writes its own rows only.  Folders are
    named by batch, so a batch that runs twice writes the same one; the reader takes
    the last row of each filename (:func:`current`), and :func:`compact` puts old
    batches together.
    """
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        old = _versions(spark, path, before=number)
        known = spark.read.schema("download_url string").parquet(*old) if old else batch.limit(0)
        ok = candidate_status(batch, known, order).where("status = 'accepted'").drop("status")
        manifest.latest(ok, "filename", -F.col(order)).write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def _versions(spark, path: str, before: int | None = None) -> list[str]:
    """The folders of whole batches in order (before a batch, if one is named), from the last compaction on."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    batches = {int(n[6:]): n for n in names if n.startswith("batch=") and (before is None or int(n[6:]) < before)}
    bases = {int(n[5:]): n for n in names if n.startswith("base=") and (before is None or int(n[5:]) < before)}
    base = max(bases, default=-1)
    return [f"{path}/{n}" for n in [*([bases[base]] if bases else []), *(batches[k] for k in sorted(batches) if k > base)]]


def current(spark, path: str, before: int | None = None) -> DataFrame | None:
    """The manifest as of the last whole batch (before a batch, if one is named); None if there is none."""
    folders = _versions(spark, path, before)
    if not folders:
        return None
    rows = spark.read.parquet(*folders)
    names = rows.columns
    # the folder's number orders the batches; a row's name is in a batch once
    number = F.regexp_extract("_metadata.file_path", r"/(?:batch|base)=(\d+)/", 1).cast("long")
    last = rows.select("*", number.alias("batch_")).groupBy(F.col("filename").alias("name_")).agg(F.max_by(F.struct(*names), "batch_").alias("row_"))
    return last.select("row_.*")


def compact(spark, path: str) -> None:
    """Write the manifest as one base of its last batch, which later reads start from, and delete the folders it replaces."""
    folders = _versions(spark, path)
    if len(folders) < 2:
        return
    number = int(folders[-1].rsplit("=", 1)[1])
    current(spark, path).write.mode("overwrite").parquet(f"{path}/base={number:012d}")
    jvm = spark.sparkContext._jvm
    for folder in folders:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
