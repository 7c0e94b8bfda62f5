"""Near-duplicate embeddings by E8 lattice hashing (operator 6).

A table projects unit vectors by a Gaussian matrix to blocks of eight dimensions,
scales them, and decodes each block to its nearest point of the lattice E8 (the
densest packing in eight dimensions, with a decoder of a few roundings).  The
points of all blocks name the cell.  A vector stands in its own cell and in the
neighbouring cells whose boundary it is near to, in several tables; vectors of the
same label that share any cell are compared by their cosine in double precision.

Equal vectors of a label are one row with a weight from the start.  What travels to
all cells of a vector is its shadow, a byte for each of a quarter of the dimensions:
an orthogonal projection brings vectors nearer, never apart, so those whose shadows
lie too far from all others of a cell leave it without a loss.  A vector itself
travels, as it was stored (four bytes for a float), only to the cells that it stays
in.  A pair is counted in the least cell that it shares, by the cells that both rows
name, and a run of a cell gives each row's number of new partners and a spanning
forest: links are never listed pair by pair, and a large cell is compared block
against block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from sievewright.llm.buckets import Union, deal, whole_runs
from sievewright.llm.common import cut, sweeping
from sievewright.llm.components import components

#: (blocks, cell size, tables, margin), ever finer: of random unit vectors in 64 dimensions the share of unrelated
#: pairs that are compared is 0.19, 0.02, 4e-4, 1e-4 and 1e-5, and a vector travels 4, 6, 12, 16 and 22 times.
#: Of pairs of cosine 0.98 each found 0.999 there; ``tests/llm`` asks for 0.997 in 16, 64 and 256 dimensions.
PLANS = ((1, 2.6, 2, 0.18), (1, 1.7, 2, 0.3), (2, 2.0, 4, 0.18), (2, 1.7, 5, 0.2), (3, 2.0, 5, 0.2))
#: Vectors of the largest label by which the plan is chosen.
SAMPLE = 512


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0...) in all places, and halves with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: round, and where the sum is odd round the worst place the other way."""
    f = np.rint(x)
    gap = x - f
    odd = np.flatnonzero(f.sum(axis=1) % 2)
    worst = np.abs(gap[odd]).argmax(axis=1)
    f[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
    return f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, the union of D8 and D8 shifted by one half."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    first = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(first[:, None], a, b)


class LatticeHash:
    """Cells of vectors in ``tables`` tables of ``blocks`` projections to eight dimensions.

    A vector stands in the cell of its nearest lattice point, and in each
    neighbouring cell whose boundary is so near that the squared distance to its
    point is less than ``margin`` longer.
    """

    def __init__(self, dim: int, blocks: int, size: float, tables: int, margin: float, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.blocks, self.margin = blocks, margin
        self.maps = [rng.normal(size=(dim, 8 * blocks)) / size for _ in range(tables)]
        self.mix = rng.integers(1, 1 << 63, size=(tables, 8 * blocks), dtype=np.uint64) | np.uint64(1)
        self.near = minimal_vectors()
        self.frame, _ = np.linalg.qr(rng.normal(size=(dim, min(dim, 256, max(16, dim // 4)))))
        self.step = 4 / np.sqrt(dim) / 127

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, 64-bit cell name) of every cell of every row, by row; each row has its cells once."""
        owner, names = [], []
        for t, m in enumerate(self.maps):
            y = x @ m
            base = np.concatenate([nearest_e8(y[:, 8 * b : 8 * b + 8]) for b in range(self.blocks)], axis=1)
            owner.append(np.arange(len(x)))
            names.append(self._name(t, base))
            for b in range(self.blocks):
                part = slice(8 * b, 8 * b + 8)
                # |z - c - v|^2 - |z - c|^2 for each neighbour c + v
                row, move = np.nonzero(2.0 - 2.0 * ((y[:, part] - base[:, part]) @ self.near.T) < self.margin)
                cell = base[row]
                cell[:, part] += self.near[move]
                owner.append(row)
                names.append(self._name(t, cell))
        row, name = np.concatenate(owner), np.concatenate(names)
        order = np.argsort(row, kind="stable")
        return row[order], name[order]

    def shadows(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors in the dimensions of ``frame``, as whole numbers of ``step`` that fit a byte."""
        return np.clip(np.rint(x @ self.frame / self.step), -127, 127).astype(np.int8)

    def reach(self, threshold: float) -> float:
        """The most that shadows of unit vectors of cosine ``threshold`` are apart, squared, in ``step``s.

        Projecting and clipping bring two vectors nearer; rounding moves each by half a
        step at most in each dimension.
        """
        return float(((np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6) / self.step + np.sqrt(self.frame.shape[1])) ** 2)

    def _name(self, t: int, cells: np.ndarray) -> np.ndarray:
        h = (np.rint(2 * cells).astype(np.int64).view(np.uint64) * self.mix[t]).sum(axis=1, dtype=np.uint64) + np.uint64(t)
        h ^= h >> np.uint64(29)
        return (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)

    def cost(self, x: np.ndarray, threshold: float) -> float:
        """Comparisons for each pair of unit vectors below ``threshold``: how often an unrelated pair shares a cell."""
        row, name = self.cells(x)
        order = np.argsort(name, kind="stable")
        meet = np.zeros((len(x), len(x)))
        for own in np.split(row[order], np.flatnonzero(np.diff(name[order])) + 1):
            meet[np.ix_(own, own)] += 1
        below = np.triu(x @ x.T < threshold, 1)
        return float(meet[below].mean()) if below.any() else 0.0


def units(x: np.ndarray) -> np.ndarray:
    """Rows of doubles scaled to length 1, without overflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vector, sound): sound rows have a label and a vector of finite numbers that is not zero."""
    kind = "float" if df.schema[vector_col].dataType.elementType == FloatType() else "double"
    vector = F.transform(F.col(vector_col), lambda x: x.cast(kind) + F.lit(0.0).cast(kind))  # turns -0.0 into 0.0
    sound = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    slim = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vector.alias("vector"))
    return slim.withColumn("sound", F.coalesce(sound, F.lit(False)))


def _stays(classes: DataFrame, hasher: LatticeHash, threshold: float, block: int) -> DataFrame:
    """(mark, cell): the cells of each class in which another's shadow is within reach; a cell is of one label."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = units(part.column(2).flatten().to_numpy().reshape(part.num_rows, -1).astype(np.float64))
                row, name = hasher.cells(x)
                cell = (name ^ part.column(0).to_numpy()[row]).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                shadow = pa.array([r.tobytes() for r in hasher.shadows(x)])
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), part.column(1).take(pa.array(row)), shadow.take(pa.array(row))], ["cell", "mark", "shadow"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, most = hasher.frame.shape[1], hasher.reach(threshold)
        for t, of in whole_runs(batches, 1):
            q = np.frombuffer(b"".join(t.column("shadow").to_pylist()), dtype=np.int8).reshape(-1, width).astype(np.float32)  # whole numbers below 2 ** 24
            own, split = t.column("block_own").to_numpy(), t.column("block_a").to_numpy() != t.column("block_b").to_numpy()
            length, near = (q * q).sum(axis=1), np.zeros(len(of), dtype=bool)
            edges = np.flatnonzero(np.diff(of, prepend=-1))
            for a, b in zip(edges.tolist(), np.append(edges[1:], len(of)).tolist()):
                if b - a < 2:
                    continue
                for i0 in range(a, b, 256):
                    i1 = min(b, i0 + 256)
                    i, j = np.nonzero(length[i0:i1, None] + length[None, i0:b] - 2 * (q[i0:i1] @ q[i0:b].T) <= most)
                    i, j = i + i0, j + i0
                    keep = (i < j) & (~split[a] | (own[i] != own[j]))
                    near[i[keep]] = near[j[keep]] = True
            yield pa.RecordBatch.from_arrays([pa.array(t.column(c).to_numpy()[near]) for c in ("mark", "cell")], ["mark", "cell"])

    rows = classes.select(F.xxhash64("label").alias("label"), "mark_a", "vector").mapInArrow(place, "cell long, mark long, shadow binary")
    return deal(rows, ["cell"], F.xxhash64("mark"), block).mapInArrow(meet, "mark long, cell long")


def _links(classes: DataFrame, hasher: LatticeHash, threshold: float, block: int) -> DataFrame:
    """(a, b, n): a spanning forest of links (n null), and for row a the weight n of new partners (b null)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, of in whole_runs(batches, 2, 4096):
            get = lambda c: t.column(c).to_numpy()  # noqa: E731, B023
            x = units(t.column("vector").combine_chunks().flatten().to_numpy().reshape(len(of), -1).astype(np.float64))
            klass, weight, own, split = get("class"), get("weight"), get("block_own"), get("block_a") != get("block_b")
            named = [np.array(c, dtype=np.int64) for c in t.column("lower").to_pylist()]
            sets, partners = Union(len(of)), np.zeros(len(of), dtype=np.int64)
            edges = np.flatnonzero(np.diff(of, prepend=-1))
            for a, b in zip(edges.tolist(), np.append(edges[1:], len(of)).tolist()):
                if b - a < 2:
                    continue
                for i0 in range(a, b, 256):
                    i1 = min(b, i0 + 256)
                    i, j = np.nonzero(x[i0:i1] @ x[i0:b].T >= threshold - 1e-9)
                    i, j = i + i0, j + i0
                    keep = (i < j) & (~split[a] | (own[i] != own[j]))
                    i, j = i[keep], j[keep]
                    for k in range(0, len(i), 16_384):
                        p, q = i[k : k + 16_384], j[k : k + 16_384]
                        close = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                        p, q = p[close], q[close]
                        if not len(p):
                            continue
                        sets.join(p, q)
                        first = least_shared(named, p, q)
                        np.add.at(partners, p[first], weight[q[first]])
                        np.add.at(partners, q[first], weight[p[first]])
            child, met = np.flatnonzero(sets.root != np.arange(len(of))), np.flatnonzero(partners)
            none = lambda n: pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((klass[child], klass[met]))), pa.concat_arrays([pa.array(klass[sets.root[child]]), none(len(met))]), pa.concat_arrays([none(len(child)), pa.array(partners[met])])], ["a", "b", "n"])

    stays, _ = cut(_stays(classes, hasher, threshold, block).groupBy("mark").agg(F.sort_array(F.collect_set("cell")).alias("cells")), "vector-cells")
    rows = classes.join(stays, F.col("mark_a") == F.col("mark")).select(F.xxhash64("label").alias("label"), F.posexplode("cells").alias("at", "cell"), "class", "weight", "vector", "cells")
    rows = rows.select("label", "cell", "class", "weight", "vector", F.slice("cells", F.lit(1), F.col("at")).alias("lower"))
    return deal(rows, ["label", "cell"], F.xxhash64("class"), block).mapInArrow(compare, "a long, b long, n long")


def least_shared(named: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each pair (p, q) of rows, which all stand in one cell, whether no cell less than it is named by both.

    ``named`` holds the cells of each row that are less.
    """
    rows, at = np.unique(np.concatenate((p, q)), return_inverse=True)
    lower = [named[r] for r in rows.tolist()]
    width = max(1, max(map(len, lower)))
    left, right = np.zeros((len(rows), width), dtype=np.int64), np.ones((len(rows), width), dtype=np.int64)
    filled = np.zeros((len(rows), width), dtype=bool)
    for k, own in enumerate(lower):
        left[k, : len(own)] = right[k, : len(own)] = own
        filled[k, : len(own)] = True
    a, b = at[: len(p)], at[len(p) :]
    out = np.ones(len(p), dtype=bool)
    for k in range(width):
        out &= ~(filled[a, k] & ((left[a, k][:, None] == right[b]) & filled[b]).any(axis=1))
    return out


def plan_for(classes: DataFrame, dim: int, label: str, rows: int, threshold: float, wanted: float) -> tuple:
    """The first of ``PLANS`` that leaves about ``wanted`` comparisons a row in a label of so many rows.

    How often unrelated vectors meet depends on how the data lie, so it is measured
    on up to ``SAMPLE`` vectors of the label, those of least hash.
    """
    drawn = classes.where((F.size("vector") == dim) & (F.col("label") == label)).select("vector", F.xxhash64("class", F.lit("plan")).alias("ticket")).orderBy("ticket").limit(SAMPLE).collect()
    x = units(np.array([r["vector"] for r in drawn], dtype=np.float64))
    return next((p for p in PLANS if rows * LatticeHash(dim, *p).cost(x, threshold) <= wanted), PLANS[-1])


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, plan: tuple | None = None, wanted: float = 4096, block: int = 2048) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Rows link if their labels are equal and not null and the cosine of their
    vectors, in double precision, is at least ``threshold``.  Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, and
    vectors of different lengths never link.  ``component_id`` is the least id
    reachable, itself included; ``kept`` tells whether it is the row's own.  Equal
    vectors always link.  Rows with a null id link and count like others, but name
    no component; an id on several vectors is one node.  Repeated rows are equal
    vectors; an empty table gives no rows.  ``plan`` is a row of ``PLANS``; by
    default :func:`plan_for` chooses one by the largest label.  The plans' margins
    are made for thresholds from 0.98 on.
    """
    with sweeping(df.sparkSession) as keep:
        marks = [F.xxhash64("label", "vector").alias("mark_a"), F.xxhash64(F.lit("class"), F.col("label"), F.col("vector")).alias("mark_b")]
        found = usable(df, id_col, vector_col, label_col)
        # the vectors stay behind: what the end needs of a row is which class it is of
        rows, rows_path = cut(found.select("vec_id", "sound", *marks), "vectors")
        classes = found.where("sound").groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id")).select("*", *marks)
        classes, _ = cut(classes.withColumn("class", F.coalesce("first_id", "mark_a")), "vector-classes")
        sizes = classes.groupBy(F.size("vector").alias("dim"), "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max(F.struct("n", "label")).alias("most")).collect()  # a row for each length of vectors
        parts = []
        for r in sizes:
            chosen = plan or plan_for(classes, r["dim"], r["most"]["label"], r["most"]["n"], threshold, wanted)
            parts.append(_links(classes.where(F.size("vector") == r["dim"]), LatticeHash(r["dim"], *chosen), threshold, block))
        if not parts:
            keep.add(rows_path)
            return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
        links, _ = cut(reduce(DataFrame.union, parts), "vector-links")
        roots = components(links.where("b is not null").select("a", "b"))
        partners = links.where("n is not null").groupBy(F.col("a").alias("class_n")).agg(F.sum("n").alias("n"))
        slim = classes.select("class", "first_id", "weight", "mark_a", "mark_b")
        linked = slim.select("class", "first_id").join(roots, F.col("class") == F.col("node")).select("class", "first_id", "root")
        least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
        named = linked.join(least, "root").groupBy(F.col("class").alias("class_r")).agg(F.min("least_id").alias("least_id"))
        of = slim.join(named, F.col("class") == F.col("class_r"), "left").join(partners, F.col("class") == F.col("class_n"), "left")
        component = F.when(F.col("class_r").isNull(), F.col("first_id")).otherwise(F.col("least_id"))
        of, of_path = cut(of.select(F.col("mark_a").alias("of_a"), F.col("mark_b").alias("of_b"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), component.alias("least_id")), "vector-groups")
        keep |= {rows_path, of_path}
    out = rows.where("sound").select("vec_id", "mark_a", "mark_b").join(of, (F.col("mark_a") == F.col("of_a")) & (F.col("mark_b") == F.col("of_b"))).select("vec_id", "n_links", F.col("least_id").alias("component_id"))
    out = out.union(rows.where("not sound").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
