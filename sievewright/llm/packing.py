"""Packing documents into fixed windows: sum-of-squares online packing (operator 2).

Each task packs the documents of its own input partition, in order, so the whole
operator is one stage without a shuffle and a lost task is simply run again.  A
document is encoded whole, the end id is appended, and every full window of it
becomes a sequence by itself.  The remainder is one item for the sum-of-squares
rule: with ``N[h]`` windows filled up to ``h``, the item goes to the level (or to
a new window) that makes the sum of ``N[h]**2`` least; full windows leave the
array.  At the end of a task the rule's open windows stay as they are, the fullest
first: only the emptiest are cut, and their tokens fill the gaps of the others.
The last tokens of a task become sequences whose lengths are powers of two, which
need no padding.  A task holds the remainders in its open windows, never more than
its own input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievewright.llm.tokens import encoder, text_slices, tokenizer_path

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class LevelPacker:
    """Sum-of-squares packing of items of 1 to ``window - 1`` units.

    ``count`` is the level array: how many open windows are filled up to each
    level.  ``max_open``, where it is given, bounds the open windows of an endless
    input: beyond it, they are closed.  :func:`pack` sets no bound.
    """

    def __init__(self, window: int = 2048, max_open: int | None = None):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.bins: dict[int, list[list]] = {}
        self.open = 0

    def level_for(self, size: int) -> int:
        """The fill level (0: a new window) whose choice makes the sum of squares least; ties go to the fullest."""
        n, w = self.count, self.window
        top = w - size
        at = np.flatnonzero(n[1 : top + 1]) + 1
        if not len(at):
            return 0
        cost = 2 * (n[at + size] - n[at]) + 2
        if at[-1] == top:
            cost[-1] = 1 - 2 * n[top]
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return int(at[best]) if cost[best] <= 2 * n[size] + 1 else 0

    def put(self, item: tuple, size: int) -> list[list]:
        """Place an item; returns the windows this completes, each a list of items."""
        h = self.level_for(size)
        if h:
            held = self.bins[h].pop()
            self.count[h] -= 1
        else:
            held, self.open = [], self.open + 1
        held.append(item)
        if h + size == self.window:
            self.open -= 1
            return [held]
        self.bins.setdefault(h + size, []).append(held)
        self.count[h + size] += 1
        if self.max_open is None or self.open <= self.max_open:
            return []
        full, rest = self.close()
        if rest:
            size = sum(x[-1] for x in rest)
            self.bins, self.open = {size: [rest]}, 1
            self.count[size] = 1
        return full

    def close(self) -> tuple[list[list], list]:
        """(full windows, items of the one window left): the emptiest windows are cut to fill the gaps of the fullest."""
        held = [w for h in sorted(self.bins, reverse=True) for w in self.bins[h]]
        fill = [h for h in sorted(self.bins, reverse=True) for _ in self.bins[h]]
        self.drain()
        i, j, full = 0, len(held) - 1, []
        while i < j:
            room = self.window - fill[i]
            while room and i < j:
                key, start, length = held[j].pop()
                n = min(room, length)
                held[i].append((key, start, n))
                if n < length:
                    held[j].append((key, start + n, length - n))
                room, fill[i], fill[j] = room - n, fill[i] + n, fill[j] - n
                if not fill[j]:
                    j -= 1
            if not room:
                full.append(held[i])
                i += 1
        return full, held[i] if i <= j else []

    def drain(self) -> list[tuple]:
        """All items of the open windows, the fullest first; none stays open."""
        items = [x for h in sorted(self.bins, reverse=True) for held in self.bins[h] for x in held]
        self.bins, self.open = {}, 0
        self.count[:] = 0
        return items


def cut_and_join(items: list[tuple], size: int) -> tuple[list[list], list]:
    """Join items (key, start, length) end to end, cutting at each ``size``; returns (full, rest)."""
    full, now, room = [], [], size
    for key, start, length in items:
        while length:
            n = min(length, room)
            now.append((key, start, n))
            start, length, room = start + n, length - n, room - n
            if not room:
                full.append(now)
                now, room = [], size
    return full, now


def power_of_two_tail(items: list[tuple]) -> list[list]:
    """Cut the last items of a task into sequences whose lengths are powers of two, the longest first."""
    out, left = [], sum(x[2] for x in items)
    while left:
        size = 1 << (left.bit_length() - 1)
        full, rest = cut_and_join(items, size)
        out.append(full[0])
        items = [x for held in full[1:] for x in held] + rest
        left -= size
    return out


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece of a document (see ``SCHEMA``).

    Null and empty texts are documents of the end id alone; a null id stays null;
    repeated rows are packed one by one; an empty table gives no rows; other
    columns are ignored.  ``sequence_id`` holds the task's number above bit 40 and
    a running number below it.  Sequences are full (``window``) or a power of two
    long.
    """
    from pyspark.sql import functions as F

    if window < 2:
        raise ValueError("window must be at least 2")
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, encode, packer = TaskContext.get().partitionId() << 40, encoder(path), LevelPacker(window)
        ids_of: dict[int, list] = {}  # a document with an open remainder: its id, the remainder's ids and start, its length, ids not emitted yet
        rows: list[tuple] = []
        made = serial = 0

        def emit(held: list[tuple]) -> None:
            nonlocal made
            offset = 0
            for key, start, length in held:
                doc = ids_of[key]
                at = 4 * (start - doc[2])
                rows.append((doc[0], start, length, zlib.crc32(doc[1][at : at + 4 * length]), doc[3], base + made, offset))
                offset += length
                doc[4] -= length
                if not doc[4]:
                    del ids_of[key]
            made += 1

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * 7
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            rows.clear()
            return out

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, texts in text_slices(batch.column(1)):
                for k, raw in zip(keys[at : at + len(texts)], encode.ids(texts)):
                    raw += end
                    n = len(raw) // 4
                    rest = n % window
                    whole = n - rest
                    for start in range(0, whole, window):
                        rows.append((k, start, window, zlib.crc32(raw[4 * start : 4 * (start + window)]), n, base + made, 0))
                        made += 1
                    if rest:
                        ids_of[serial] = [k, raw[4 * whole :], whole, n, rest]
                        for held in packer.put((serial, whole, rest), rest):
                            emit(held)
                    serial += 1
                if len(rows) >= 20_000:
                    yield flushed()
        full, last = packer.close()
        for held in full + power_of_two_tail(last):
            emit(held)
            if len(rows) >= 20_000:
                yield flushed()
        yield flushed()

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
