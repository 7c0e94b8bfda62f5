"""Reports as text for a terminal: a one-row frame as labels and values, a longer one as a table.

Only the rows that are shown come to the driver, with one sum for the shares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

WIDTH = 72


def megabytes(n: int | None) -> str:
    """Bytes in millions: two decimals below ten, whole above, thousands apart."""
    if n is None:
        return "-"
    return f"{n / 1e6:.2f} MB" if n < 10_000_000 else f"{n / 1e6:,.0f} MB"


def share(n: int, whole: int) -> str:
    """Whole per cent, rounded down; nothing of nothing is 0 %."""
    return f"{100 * n // whole if whole else 0}%"


def value(name: str, x) -> str:
    """A cell as text, by its column's name and its type."""
    if x is None:
        return "-"
    if name == "bytes" or name.endswith("_bytes"):
        return megabytes(x)
    if isinstance(x, bool):
        return "yes" if x else "no"
    if isinstance(x, int):
        return f"{x}%" if name.endswith("_pct") else f"{x:,}"
    if isinstance(x, float):
        return f"{x:,.2f}"
    if isinstance(x, (list, tuple)):
        return ", ".join(value("", y) for y in x)
    text = " ".join(str(x).split())
    return text if len(text) <= 40 else text[:39] + "…"


def frame(df: DataFrame, most: int = 15) -> list[str]:
    """The lines of one frame; beyond ``most`` rows a line says that there are more.

    A last column ``n`` of counts gets each row's share of all rows' sum, those not
    shown too.
    """
    rows, names = df.limit(most + 1).collect(), df.columns
    if not rows:
        return ["  none"]
    counted = names[-1] == "n" and isinstance(df.schema["n"].dataType, LongType)
    if len(rows) == 1 and not (counted and len(names) > 1):
        wide = max(map(len, names))
        return [f"  {n.replace('_', ' '):<{wide}}  {value(n, x)}" for n, x in zip(names, rows[0])]
    cells = [[value(n, x) for n, x in zip(names, r)] for r in rows[:most]]
    if counted:
        whole = df.agg(F.sum("n")).first()[0] or 0
        names, cells = [*names, "share"], [[*c, share(r["n"] or 0, whole)] for c, r in zip(cells, rows)]
    right = [counted and k >= len(names) - 2 for k in range(len(names))]
    wide = [max(len(n), *(len(c[k]) for c in cells)) for k, n in enumerate(names)]
    line = lambda c: "  " + "  ".join(f"{x:>{w}}" if r else f"{x:<{w}}" for x, w, r in zip(c, wide, right)).rstrip()
    return [line([n.replace("_", " ") for n in names]), *map(line, cells), *(["  and more"] if len(rows) > most else [])]


def report(title: str, frames: dict[str, DataFrame]) -> str:
    """A command's report: its title, then each of its frames under its name."""
    lines = ["=" * WIDTH, f" {title.upper()}", "=" * WIDTH]
    for name, df in frames.items():
        lines += ["", f" {name.replace('_', ' ').capitalize()}", *frame(df)]
    return "\n".join(lines)
