"""Token counts by field and section: offset-mapped attribution (operator 7).

The fields of a row are joined into one text and encoded once; every token keeps
its character span.  Sections (lines, or whole fields) are intervals of the same
text, and tokens are joined to them by a search in the sorted section starts.  A
token that lies over a boundary is given away by an explicit rule:

``majority``  to the section that holds most of its characters, a tie to the first
``start``     to the section that holds its first character
``share``     to each section by its share of the characters (counts are fractions)

The sum over the sections of a row is the number of its tokens under every rule.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.tokens import encoder, text_slices, tokenizer_path

RULES = ("majority", "start", "share")
SEPARATOR = "\n"


def attribute(spans: np.ndarray, starts: np.ndarray, end: int, rule: str = "majority") -> np.ndarray:
    """Tokens for each section, as doubles.

    ``spans`` is (n, 2), ``starts`` the ascending first characters of the sections,
    the first at 0; sections without characters get no token.
    """
    counts = np.zeros(len(starts))
    if not len(spans):
        return counts
    first = np.searchsorted(starts, spans[:, 0], "right") - 1
    last = np.maximum(np.searchsorted(starts, spans[:, 1] - 1, "right") - 1, first)
    if rule == "start":
        return np.bincount(first, minlength=len(starts)).astype(float)
    inside = first == last
    counts += np.bincount(first[inside], minlength=len(starts))
    ends = np.append(starts[1:], end)
    for (a, b), s, t in zip(spans[~inside].tolist(), first[~inside].tolist(), last[~inside].tolist()):
        part = np.minimum(ends[s : t + 1], b) - np.maximum(starts[s : t + 1], a)
        if rule == "share":
            counts[s : t + 1] += part / (b - a)
        else:
            counts[s + int(np.argmax(part))] += 1
    return counts


def count_tokens(df: DataFrame, id_col: str = "doc_id", fields: Sequence[str] = ("text",), by_line: bool = True, rule: str = "majority", tokenizer: str | None = None) -> DataFrame:
    """One row for each section: doc_id, field, section, start, length (characters), n_tokens (double).

    The fields of a row stand in the given order with a line feed between; it
    belongs to the field before it, as every line feed belongs to the line it ends.
    ``section`` counts a field's lines from 0 (``by_line``) or is 0.  ``start`` is
    in the joined text.  Null values are empty; an empty field has one section
    without characters, and a row always has a section for each field.  Ids may be
    null or repeat, and repeated rows count one by one; texts are encoded whole,
    however long; other columns are ignored, whatever their names; an empty table
    gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path, names = tokenizer or tokenizer_path(), list(fields)
    schema = pa.schema([("doc_id", pa.int64()), ("field", pa.string()), ("section", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, True)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, joined in text_slices(batch.column(1), 2 << 20):
                sizes = batch.column(2).slice(at, len(joined)).to_pylist()
                out: list[list] = [[], [], [], [], [], []]
                for key, text, size, spans in zip(keys[at : at + len(joined)], joined, sizes, own.token_spans(joined)):
                    starts, owner, number, at_char = [], [], [], 0
                    for f, n in enumerate(size):
                        stop, k = at_char + n, 0
                        while True:
                            starts.append(at_char)
                            owner.append(names[f])
                            number.append(k)
                            cut = text.find("\n", at_char, stop) if by_line else -1
                            if cut < 0 or cut + 1 >= stop:
                                break
                            at_char, k = cut + 1, k + 1
                        at_char = stop + (f + 1 < len(size))
                    edge = np.array(starts, dtype=np.int64)
                    counts = attribute(spans, edge, len(text), rule)
                    out[0] += [key] * len(starts)
                    out[1] += owner
                    out[2] += number
                    out[3] += starts
                    out[4] += np.diff(np.append(edge, len(text))).tolist()
                    out[5] += counts.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)

    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.concat_ws(SEPARATOR, *parts).alias("text"), F.array(*[F.length(p).cast("long") for p in parts]).alias("sizes"))
    return slim.mapInArrow(run, "doc_id long, field string, section long, start long, length long, n_tokens double")
