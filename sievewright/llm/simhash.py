"""SimHash near-duplicates by a segment-popcount grid (operator 4).

A 64-bit fingerprint is cut into 32 segments of two bits, and maps to the vector
of their bit counts.  The Manhattan distance of two such vectors is never more
than the Hamming distance of the fingerprints, so fingerprints within ``radius``
bits lie within ``radius`` in the grid.  The range join rests on that: the
coordinates are dealt into ``radius + k`` groups, and two vectors within
``radius`` agree in at least ``k`` whole groups, that is, they share a cell of one
of the grids over ``k`` groups.  Cells are joined with themselves, the Manhattan
distance filters, and the exact bit difference decides.  ``k`` follows from the
number of fingerprints, so that the candidates for each stay about bounded; the
result does not depend on it.

Equal fingerprints are one row from the start, large cells are compared block
against block, and a block gives only a spanning forest of its links, so no list
of all pairs of a group is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.buckets import Union, deal, pairs_by_offset, whole_runs
from sievewright.llm.common import cut, sweeping
from sievewright.llm.components import components
from sievewright.llm.tokens import text_slices

SEED = 42
#: Bits at the even places of 64.
EVEN = 0x5555555555555555
#: Two random segments of two bits have equal counts with probability 3/8, about 1.415 bits.
BITS_A_SEGMENT = 1.415


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash over XXH64 (seed 42) of the shingles of a text, repeats included; 0 without words.

    Only A-Z are lower-cased; words are runs without ASCII white space; a text of
    fewer than ``shingle`` words is one shingle.
    """
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    first, last = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), 65_536):
        h = np.array([xxh64_intdigest(joined[i:j], SEED) for i, j in zip(first[at : at + 65_536], last[at : at + 65_536])], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(first), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                fp = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(fp)], ["doc_id", "fp"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def bit_counts(fp):
    """The 32 counts of a fingerprint's two-bit segments, two bits each, as one long."""
    low, high = fp.bitwiseAND(F.lit(EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))  # their sum, without a carry


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed count vectors: equal 00, apart by one 01 or 11, by two 10."""
    x = a ^ b
    low, high = x & np.uint64(EVEN), (x >> np.uint64(1)) & np.uint64(EVEN)
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def grids(n: int, radius: int, wanted: int = 2048) -> list[int]:
    """Masks over the packed counts, one for each grid: all choices of k groups out of radius + k.

    k is the least from 2 at which ``n`` random fingerprints have about ``wanted``
    candidates each at most.
    """
    k = 2
    while k < 8 and n * comb(radius + k, k) / 2 ** (BITS_A_SEGMENT * 32 * k / (radius + k)) > wanted:
        k += 1
    groups = [sum(3 << (2 * s) for s in part.tolist()) for part in np.array_split(np.arange(32), radius + k)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(g)) for g in combinations(groups, k)]


def link(fps: DataFrame, n: int, radius: int = 4, block: int = 4096) -> DataFrame:
    """Edges (a, b) that connect just what all pairs of distinct ``fp`` within ``radius`` bits connect."""
    cells = F.array(*[F.struct(F.lit(i).alias("grid"), F.col("counts").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(grids(n, radius))])
    rows = fps.select("fp", bit_counts(F.col("fp")).alias("counts")).select("fp", "counts", F.inline(cells)).select("grid", "cell", "fp", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, of in whole_runs(batches, 2):
            fp, counts = (t.column(c).to_numpy().view(np.uint64) for c in ("fp", "counts"))
            own, split = t.column("block_own").to_numpy(), t.column("block_a").to_numpy() != t.column("block_b").to_numpy()
            sets = Union(len(of))
            for i, j in pairs_by_offset(of, own, split):
                new = sets.root[i] != sets.root[j]
                i, j = i[new], j[new]
                near = manhattan(counts[i], counts[j]) <= radius
                i, j = i[near], j[near]
                same = np.bitwise_count(fp[i] ^ fp[j]) <= radius
                if same.any():
                    sets.join(i[same], j[same])
            child = np.flatnonzero(sets.root != np.arange(len(of)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[x].view(np.int64)) for x in (child, sets.root[child])], ["a", "b"])

    return deal(rows, ["grid", "cell"], F.xxhash64("fp"), block).mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, block: int = 4096) -> DataFrame:
    """(doc_id, fp, group_fp, component_id) for each row.

    ``component_id`` is the least id reachable by links of at most ``radius``
    differing bits; ``group_fp`` is one fingerprint for each component.  Null
    texts are empty; all texts without words share the fingerprint 0, which links
    like any other.  A row with a null id links its group like any other row, and
    its component_id is null only if no row of the group has an id.  Repeated rows
    stay; an empty table gives no rows; other columns are ignored.
    """
    with sweeping(df.sparkSession) as keep:
        docs, docs_path = cut(with_fingerprints(df, id_col, text_col, shingle), "fingerprints")
        fps, _ = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
        roots = components(link(fps.select("fp"), fps.count(), radius, block))
        linked = fps.join(roots, fps.fp == roots.node).select("fp", "first_id", "root")
        least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
        of = linked.join(least, "root").select(F.col("fp").alias("fp_"), "root", "least_id")
        known = fps.join(of, fps.fp == of.fp_, "left").select("fp", F.coalesce("root", "fp").alias("group_fp"), F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"))
        known, known_path = cut(known, "groups")
        keep |= {docs_path, known_path}
    return docs.join(known, "fp").select("doc_id", "fp", "group_fp", "component_id")
