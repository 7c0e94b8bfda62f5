"""Hamming distances of blocks of hashes against blocks of hashes, in numpy; memory is bounded by a tile."""

from __future__ import annotations

from collections.abc import Iterator

#: Distances of one tile: few enough for a core's cache.
ROWS, COLUMNS = 16, 4096


def unsigned(column):
    """A long column of Arrow as unsigned numbers (bit_count takes the absolute value of signed ones)."""
    import numpy as np

    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def tiles(a, b) -> Iterator[tuple]:
    """(row, column, distances) of each tile; the distances are valid until the next one."""
    import numpy as np

    x, d = np.empty(ROWS * COLUMNS, np.uint64), np.empty(ROWS * COLUMNS, np.uint8)
    for i in range(0, len(a), ROWS):
        rows = a[i : i + ROWS, None]
        for j in range(0, len(b), COLUMNS):
            columns = b[None, j : j + COLUMNS]
            shape = len(rows), columns.shape[1]
            n = shape[0] * shape[1]
            at = np.bitwise_xor(rows, columns, out=x[:n].reshape(shape))
            yield i, j, np.bitwise_count(at, out=d[:n].reshape(shape))


def earliest(a, b, radius: int):
    """For each of ``a`` the place of the first of ``b`` within the radius, or -1."""
    import numpy as np

    out = np.full(len(a), -1)
    for i, j, d in tiles(a, b):
        near = d <= radius
        hit = np.flatnonzero(near.any(axis=1) & (out[i : i + len(d)] < 0))
        out[i + hit] = j + near[hit].argmax(axis=1)
    return out


def places(names):
    """The place of each name in the order of names."""
    import numpy as np
    import pyarrow.compute as pc

    out = np.empty(len(names), np.int64)
    out[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
    return out


def nearest(a, b, place, radius: int, most: int, step: int = 2048) -> Iterator[tuple]:
    """(rows of ``a``, rows of ``b``, distances): the ``most`` nearest of ``b`` for each of ``a``, ties by ``place``."""
    import numpy as np

    back = np.empty(len(b), np.int64)
    back[place] = np.arange(len(b))
    def best(found: list):
        keys = np.sort(np.concatenate(found))
        row = keys >> 48
        return keys[np.arange(len(keys)) - np.searchsorted(row, row) < most]

    for start in range(0, len(a), step):
        found, n = [], 0
        for i, j, d in tiles(a[start : start + step], b):
            hit = np.flatnonzero(d <= radius)
            row, column = np.divmod(hit, d.shape[1])
            found.append((i + row) << 48 | d.ravel()[hit].astype(np.int64) << 40 | place[j + column])
            n += len(hit)
            if n > max(1 << 21, 2 * step * most):  # most of b is near to most of a
                found = [best(found)]
                n = len(found[0])
        found = best(found)
        if len(found):
            yield start + (found >> 48), back[found & ((1 << 40) - 1)], (found >> 40 & 255).astype(np.int32)


def least(a, turn, b, taken_at):
    """For each of ``a`` the least distance to those of ``b`` that are not taken before its turn, or 128 and more.

    ``a`` comes by turn, ``b`` by when it is taken: what is free for a row is the end of ``b``.
    """
    import numpy as np

    out = np.full(len(a), 255, np.uint8)
    for i in range(0, len(a), ROWS):
        rows, start = a[i : i + ROWS], np.searchsorted(taken_at, turn[i])
        for _, j, d in tiles(rows, b[start:]):
            at = taken_at[start + j : start + j + d.shape[1]]
            if at[0] < turn[min(i + ROWS, len(a)) - 1]:
                d = d | (at[None, :] < turn[i : i + ROWS, None]).view(np.uint8) << 7
            np.minimum(out[i : i + ROWS], d.min(axis=1), out=out[i : i + ROWS])
    return out


def within(a, b, radius: int, most: int = 50_000) -> Iterator[tuple]:
    """(rows of ``a``, rows of ``b``, distances) of all pairs within the radius; of ``a`` with itself each pair once if ``b`` is None."""
    import numpy as np

    found, n = [], 0
    for r in range(0, len(a), ROWS):
        start = r if b is None else 0
        for _, j, d in tiles(a[r : r + ROWS], a[start:] if b is None else b):
            hit = np.flatnonzero(d <= radius)
            row, column = np.divmod(hit, d.shape[1])
            row, column, d = row + r, column + j + start, d.ravel()[hit]
            if b is None and j == 0:
                once = row < column
                row, column, d = row[once], column[once], d[once]
            found.append((row, column, d))
            n += len(row)
            if n >= most:
                yield tuple(np.concatenate(x) for x in zip(*found))
                found, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*found))
