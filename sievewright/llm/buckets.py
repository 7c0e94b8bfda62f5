"""Comparing the rows of a bucket with each other, whatever the bucket's size.

Rows are dealt by bucket, sorted, and handed to numpy in runs, so no task holds
more than a block.  A bucket of more than ``block`` rows is split by a hash of
the row into blocks, and each *pair of blocks* becomes a run of its own: every
pair of rows still meets exactly once, in as many tasks as there are block pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import cut

#: Columns that :func:`deal` adds: the block pair of the run, and the block of the row.
RUN = ("block_a", "block_b", "block_own")


def deal(rows: DataFrame, keys: list[str], row_hash: Column, block: int = 4096) -> DataFrame:
    """``rows`` with the columns of ``RUN``, dealt and sorted by (keys, block_a, block_b).

    The list of large buckets is written to the shared folder first; it is sent to
    every executor only if the planner finds its files small enough.
    """
    hot, _ = cut(rows.groupBy(*keys).count().where(F.col("count") > block).select(*keys, F.ceil(F.col("count") / block).cast("int").alias("n_blocks")), "hot-buckets")
    many = rows.join(hot, keys, "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
    many = many.withColumn("block_own", F.pmod(row_hash, F.col("n_blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda k: F.struct(F.least("block_own", k).alias("block_a"), F.greatest("block_own", k).alias("block_b")))
    dealt = many.select(*rows.columns, "block_own", F.inline(pairs)).select(*rows.columns, *RUN)
    order = [*keys, "block_a", "block_b"]
    return dealt.repartition(*order).sortWithinPartitions(*order)


def whole_runs(batches: Iterator[pa.RecordBatch], n_keys: int, most: int = 16_384) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut sorted batches into tables of whole runs, with each row's run number.

    A run is the rows that agree in the first ``n_keys`` columns and in the first
    two of ``RUN`` (which are the third- and second-last columns).  A table has at
    most ``most`` rows unless one run has more.
    """
    kept: list[pa.Table] = []

    def numbered(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, dtype=bool)
        for i in [*range(n_keys), t.num_columns - 3, t.num_columns - 2]:
            c = t.column(i).to_numpy()
            change[1:] |= c[1:] != c[:-1]
        return np.cumsum(change)

    for batch in batches:
        for at in range(0, batch.num_rows, most):
            kept.append(pa.Table.from_batches([batch.slice(at, most)]))
            if sum(t.num_rows for t in kept) < most:
                continue
            t = pa.concat_tables(kept).combine_chunks()
            run = numbered(t)
            last = int(np.searchsorted(run, run[-1]))
            if last:
                yield t.slice(0, last), run[:last]
            kept = [t.slice(last)]
    if kept and (t := pa.concat_tables(kept).combine_chunks()).num_rows:
        yield t, numbered(t)


class Union:
    """Union-find over 0..n-1 in numpy; roots are the least of their set."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        r = self.root
        while True:
            a, b = r[a], r[b]
            differ = a != b
            if not differ.any():
                return
            a, b = a[differ], b[differ]
            np.minimum.at(r, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = r[r]
                if np.array_equal(up, r):
                    break
                r[:] = up


def pairs_by_offset(run: np.ndarray, own: np.ndarray, split: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i < j) of rows of a run, in vectorised steps by j - i.

    Where ``split`` is set (a run of two blocks), only rows of different blocks pair.
    """
    n = len(run)
    end = np.searchsorted(run, run, "right")
    i, d = np.arange(n), 1
    while True:
        i = i[i + d < end[i]]
        if not len(i):
            return
        j = i + d
        ok = ~split[i] | (own[i] != own[j])
        yield (i, j) if ok.all() else (i[ok], j[ok])
        d += 1
