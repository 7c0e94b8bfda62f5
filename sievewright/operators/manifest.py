"""The manifest: a keyed table of records, kept as JSON lines or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewright.functions.text import none_if_empty
from sievewright.functions.verdicts import has, has_provenance
from sievewright.schema import CLASSES, REASONS, RECORD, UNKNOWN_LICENSE


def with_defaults(df: DataFrame) -> DataFrame:
    """Missing values of a record's fields become their defaults."""
    empty = F.array().cast("array<string>")
    filled = {"license": F.lit(UNKNOWN_LICENSE), "klass": F.lit("_unclassified"), "panoramic": F.lit(False), "rejected": F.lit(False), "categories": empty, "reject_reasons": empty, "needs_review": empty}
    return df.withColumns({c: F.coalesce(F.col(c), d) for c, d in filled.items() if c in df.columns})


def latest(df: DataFrame, key: str, order: Column) -> DataFrame:
    """Of rows with the same key the last in ``order``."""
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(key).orderBy(order.desc()))).where("rank_ = 1").drop("rank_")


def valid(df: DataFrame) -> Column:
    """Whether a row is a record: its key fields are there and its enumerations hold known values."""
    reasons = F.coalesce(F.col("reject_reasons"), F.array().cast("array<string>"))
    return F.col("filename").isNotNull() & F.col("source").isNotNull() & F.coalesce(F.col("klass").isin(*CLASSES), F.lit(True)) & F.forall(reasons, lambda r: r.isin(*REASONS))


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Records of JSON lines; blank and corrupt lines, and lines that are no record, go (``corrupt_lines`` shows them)."""
    read = T.StructType([*RECORD.fields, T.StructField("corrupt_", T.StringType())])
    read = T.StructType([T.StructField(f.name, f.dataType, True) for f in read.fields])
    rows = lines.where(F.trim(F.col(line)) != "").withColumn("record_", F.from_json(line, read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt_"}))
    rest = [c for c in lines.columns if c != line]
    return rows.select(*rest, F.col(line).alias("line_"), "record_.*")


def corrupt_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    rows = parse_lines(lines, line)
    return rows.where(F.col("corrupt_").isNotNull() | ~valid(rows)).select("line_")


def _file_system(spark: SparkSession, path: str):
    """(file system, path, path of the copy that :func:`save` keeps while it swaps)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm.org.apache.hadoop.fs.Path(f"{path}.previous")


def load(spark: SparkSession, path: str) -> DataFrame:
    """The records of a manifest: the last line of a filename wins; no file is an empty manifest.

    Of a folder, files go by name and lines by their place in the file.  Where a
    :func:`save` was cut off between its two renames, the manifest before it is put
    back first.
    """
    fs, at, previous = _file_system(spark, path)
    if not fs.exists(at):
        if not fs.exists(previous):
            return spark.createDataFrame([], RECORD)
        fs.rename(previous, at)
    # a split's lines are in one task, in order; splits go by file and first byte
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = parse_lines(spark.read.text(path).select("value", place.alias("line_no_")))
    rows = rows.where(F.col("corrupt_").isNull() & valid(rows))
    return with_defaults(latest(rows, "filename", F.col("line_no_")).select(*RECORD.names))


def to_lines(df: DataFrame) -> DataFrame:
    """(filename, line): a record as JSON without its nulls."""
    return df.select("filename", F.to_json(F.struct(*[c for c in RECORD.names if c in df.columns])).alias("line"))


def save(df: DataFrame, path: str) -> None:
    """Write the manifest sorted by filename.

    It is written beside ``path`` and swapped in by renames; the manifest before it
    stays until the new one stands, so at every moment one of them is whole.
    """
    spark = df.sparkSession
    staging = f"{path}.staging"
    to_lines(df).orderBy("filename").select("line").coalesce(1).write.mode("overwrite").text(staging)
    fs, at, previous = _file_system(spark, path)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging)
    part = next(s.getPath() for s in fs.listStatus(new) if s.getPath().getName().startswith("part-"))
    if fs.exists(at):
        fs.delete(previous, True)
        if not fs.rename(at, previous):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(part, at):
        raise OSError(f"cannot put {path} in its place; the manifest before it is {path}.previous")
    fs.delete(previous, True)
    fs.delete(new, True)


def upsert(old: DataFrame, new: DataFrame, key: str = "filename") -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def active(df: DataFrame) -> DataFrame:
    return df.where(~F.col("rejected")).orderBy("filename")


def known_urls(df: DataFrame) -> DataFrame:
    return df.select(none_if_empty(F.col("download_url")).alias("download_url")).where("download_url is not null").distinct()


def known_sha256(df: DataFrame) -> DataFrame:
    return df.select(none_if_empty(F.col("sha256")).alias("sha256")).where("sha256 is not null").distinct()


def known_phash(df: DataFrame, order: Column | None = None) -> DataFrame:
    """(phash, filename): of rows that share a hash, the last filename in ``order``."""
    return df.where(none_if_empty(F.col("phash")).isNotNull()).groupBy("phash").agg(F.max_by("filename", order if order is not None else F.col("filename")).alias("filename"))


def index_sizes(df: DataFrame) -> DataFrame:
    """One row: how many distinct digests, hashes and URLs the manifest knows."""
    return df.agg(*[F.count_distinct(none_if_empty(F.col(c))).alias(n) for c, n in (("sha256", "n_sha256"), ("phash", "n_phash"), ("download_url", "n_urls"))])


def provenance(df: DataFrame) -> Column:
    return has_provenance(F.col("license"), F.col("origin_title"))


def mark_manually(df: DataFrame, names: DataFrame, note: str | None = None) -> DataFrame:
    """(filename, status) of a manual rejection, and the records after it.

    ``names`` has a column filename, repeated names count once.  Status: ``missing``
    (no such record), ``noop`` (already rejected by hand), ``reinforced`` (rejected
    for another reason, now by hand too), ``newly``.  The result has all of the
    record's columns, null where missing.
    """
    from sievewright.functions.verdicts import add_reason

    asked = names.select("filename").distinct()
    found = asked.join(df.withColumn("known_", F.lit(True)), "filename", "left")
    status = F.when(F.col("known_").isNull(), "missing").when(has(F.col("reject_reasons"), "manual"), "noop").when(F.col("rejected"), "reinforced").otherwise("newly")
    out = found.withColumn("status", status)
    there = F.col("known_").isNotNull()
    out = out.withColumn("reject_reasons", F.when(there, add_reason(F.col("reject_reasons"), "manual"))).withColumn("rejected", F.when(there, True))
    if note:
        out = out.withColumn("needs_review", F.when(there & (F.col("status") != "noop"), add_reason(F.col("needs_review"), note)).otherwise(F.col("needs_review")))
    return out.drop("known_")


def restore_manually(df: DataFrame, names: DataFrame) -> DataFrame:
    """(filename, status, ...): ``missing``, ``not_manual`` (only verdicts of operators, which stay), ``still_rejected`` or ``restored``."""
    from sievewright.functions.verdicts import drop_reason, is_rejected

    asked = names.select("filename").distinct()
    found = asked.join(df.withColumn("known_", F.lit(True)), "filename", "left")
    found = found.withColumn("manual_", has(F.col("reject_reasons"), "manual"))
    manual = F.col("manual_")
    after = F.when(manual, drop_reason(F.col("reject_reasons"), "manual")).otherwise(F.col("reject_reasons"))
    status = F.when(F.col("known_").isNull(), "missing").when(~manual, "not_manual").when(is_rejected(after), "still_rejected").otherwise("restored")
    out = found.withColumn("status", status).withColumn("reject_reasons", after)
    return out.withColumn("rejected", F.when(manual, is_rejected(F.col("reject_reasons"))).otherwise(F.col("rejected"))).drop("known_", "manual_")
