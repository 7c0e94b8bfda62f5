"""Token ids in ORC files (operator 9).

Documents are dealt to *shards*, ranges of their id whose bounds come from a scan
of the id column alone, and encoded after that: the shuffle carries text, not ids,
and texts are read once.  Each shard is a folder in ascending order, its rows
ascend too.  ORC run-length encodes the integers, keeps a row index with minima and
maxima for every ``row_stride`` rows and a Bloom filter on the id, so a lookup
reads few stripes and large files are read stripe by stripe in parallel.  A row
also tells how many ids stand before it in its shard; the starts over all shards
follow from one sum per shard, read from those narrow columns alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.llm.common import scratch_path
from sievewright.llm.tokens import encoder, text_slices, tokenizer_path

FILE_SCHEMA = "doc_id long, shard_start long, n_tokens int, ids array<int>, shard int"
#: Bytes of input for a shard, about.
SHARD_BYTES = 256 << 20


def shard_bounds(df: DataFrame, id_col: str) -> list[int]:
    """Ascending ids that cut the rows into about even shards; only the id column is read.

    There are as many shards as shuffle partitions, or more so that none gets much
    over ``SHARD_BYTES``.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 62 else 0  # plans without files have no size
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), known // SHARD_BYTES)
    cuts = F.percentile_approx(F.col(id_col).cast("long"), [k / n for k in range(1, n)] or [0.5], max(10_000, 20 * n))
    return sorted(set(df.agg(cuts.alias("cuts")).first()["cuts"] or []))


def shard_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are below ``key`` (null: none), by two searches over the square root of their number.

    The bounds stand in the plan as one literal each way, whatever their number.
    """
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    ends = array([bounds[min(i + step, len(bounds)) - 1] for i in range(0, len(bounds), step)])
    coarse = F.size(F.filter(ends, lambda b: b < key))
    fine = F.size(F.filter(F.slice(array(bounds), coarse * step + 1, step), lambda b: b < key))
    return F.when(key.isNull(), 0).otherwise(F.least(coarse * step, F.lit(len(bounds))) + fine).cast("int")


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, tokenizer: str | None = None, stripe_mb: int = 64, row_stride: int = 5000, fpp: float = 0.01) -> str:
    """Encode every whole text, append ``end_id``, and write ORC files in ascending id order to ``path``.

    Null texts are empty; rows with a null id come first; rows with equal ids
    stand in the order of their texts; an empty table writes a file without rows.
    Further columns are ignored, whatever their names.  All rows of an id are in one
    shard.
    """
    vocabulary = tokenizer or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("shard_start", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32())), ("shard", pa.int32())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, before = encoder(vocabulary), None, 0
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                raw = [x + end for x in own.ids(texts)]
                shard = batch.column(2).slice(at, len(raw))
                n = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
                edges = np.concatenate(([0], np.cumsum(n)))
                ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.Array.from_buffers(pa.int32(), int(edges[-1]), [None, pa.py_buffer(b"".join(raw))]))
                of = shard.to_numpy()
                first = np.searchsorted(of, of)  # the first row of each row's shard in this slice
                start = edges[:-1] - edges[first] + np.where(of == last, before, 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(start), pa.array(n, pa.int32()), ids, shard], schema=schema)
                last, before = of[-1], int(start[-1] + n[-1])

    key = F.col(id_col).cast("long")
    bounds = shard_bounds(df, id_col)
    slim = df.select(key.alias("doc_id"), F.col(text_col).cast("string").alias("text"), shard_of(key, bounds).alias("shard"))
    dealt = slim.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "doc_id", "text")  # a task for each shard
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(fpp), "orc.create.index": "true", "orc.row.index.stride": str(row_stride), "orc.stripe.size": str(stripe_mb << 20), "orc.compress": "SNAPPY"}
    dealt.mapInArrow(encode, FILE_SCHEMA).write.partitionBy("shard").format("orc").options(**options).save(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they stand in the files; filters on ``doc_id`` reach the row indexes and Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """For each document, from the files: doc_id, start, n_tokens, ids_crc32 (unsigned, of little-endian 32-bit ids), shard."""
    rows = read_tokens(spark, path)
    shards = rows.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each shard only
    shards = shards.select("shard", before.alias("before"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            edges = lists.offsets.to_numpy()
            raw = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4").tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(edges), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"])

    read = rows.select("doc_id", "shard", "shard_start", "ids").mapInArrow(digest, "doc_id long, shard int, shard_start long, n_tokens long, ids_crc32 long")
    return read.join(shards, "shard").select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32", "shard")


def round_trip(df: DataFrame, **options) -> DataFrame:
    """Write to a new folder under ``spark.checkpoint.dir`` and read the index back."""
    spark = df.sparkSession
    return token_index(spark, write_tokens(df, scratch_path(spark, "tokens-orc"), **options))
