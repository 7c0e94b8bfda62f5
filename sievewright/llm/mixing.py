"""Mixing sources to target weights by systematic sampling (operator 8).

Every source gets a target by weight, capped at a multiple of its size with the
excess reshared (water filling).  A document's expected copies are its source's
target over its source's size; along the documents of a source, ordered by (size,
md5 of the id), the running sum of expected copies plus one offset of the source
is emitted once for each whole number it crosses.  The order by size spreads the
copies evenly over short and long documents, so the words taken miss the target
by about one document.

The running sum is a rank times a constant, and the rank is put together from
counts: of smaller sizes in the source, of smaller md5 prefixes in the size, and
a row number inside (source, size, prefix).  The last is the only sort over
documents; it goes by small groups, so a source with a third of all rows is
spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import WORD, cut, fresh_name

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
CAP = 2.0
SEED = "mix-1"
#: Rows of one size and source that a task numbers, about; the digits of the md5 that split them follow from it.
PART_ROWS = 1_000_000


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Weights repeat over the sources by code point, null last.  ``target`` is
    min(cap * size, level * weight) with the level at which the targets sum to
    ``total`` times all sizes.  The windows run over one row for each source.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    w = sources.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("level", (F.lit(float(total)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(up_to), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to), F.lit(0.0))))
    # in this order the first source that its level leaves below its cap sets the level for all after it;
    # of sources that reach their caps together, the first has the highest level
    w = w.withColumn("water", -F.min(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), (-F.col("level")).alias("below")))).over(everything)["below"])
    return w.select("source", "source_size", F.when(F.col("water").isNull(), F.col("most")).otherwise(F.least("most", F.col("water") * F.col("weight"))).alias("target"))


def _key(source: Column) -> Column:
    """A source as a string that is never null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _source(key: Column) -> Column:
    return F.when(key != "n", F.substring(key, 2, 1 << 30))


def prefix_digits(rows: int) -> int:
    """Hex digits (2 at least) that leave ``PART_ROWS`` to a part even if all rows are of one source and size."""
    digits = 2
    while rows > PART_ROWS << (4 * digits):
        digits += 1
    return digits


def offset_of(key: Column) -> Column:
    """The source's random offset in [0, 1): 24 bits of an md5; a null source has one too."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(SEED + "/"), key)), 1, 6), 16, 10).cast("double") / F.lit(16777216.0)


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[int] = WEIGHTS, total: float = TOTAL, cap: float = CAP, columns: Sequence[str] | None = None) -> DataFrame:
    """The chosen ``columns`` (all by default) and size, source_size, target, copies for each row.

    Where a name of the four is taken, underscores are added.  ``copies`` is how
    often the mix takes the document: at most ``cap``, rounded up.  Null texts have
    size 0, null sources are one source, null ids share one place in the order,
    and repeated rows are drawn one by one; rows that share id and size go by a hash
    of their columns.  A text counts whole, however long.  Sources without words have target 0
    and give no copies.  An empty table gives no rows.
    """
    keep = list(columns if columns is not None else df.columns)
    size, source_size, target, copies = (fresh_name(df.select(*keep), x) for x in ("size", "source_size", "target", "copies"))
    mark = F.md5(F.concat(F.lit(SEED + "/"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), _key(F.col(source_col).cast("string")).alias("key"), word_count(F.col(text_col)).alias("size"), mark.alias("mark"))
    rows = rows.withColumn("part", F.substring("mark", 1, prefix_digits(df.count())))

    groups, _ = cut(rows.groupBy("key", "size", "part").agg(F.count("*").alias("n")), "mix-counts")
    by_size = groups.groupBy("key", "size").agg(F.sum("n").alias("n"))
    below = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    smaller = by_size.select("key", "size", below(Window.partitionBy("key").orderBy("size")).alias("smaller"))
    goal = targets(by_size.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")).select(_source(F.col("key")).alias("source"), "source_size"), weights, total, cap)
    goal = goal.select(_key(F.col("source")).alias("key"), "source_size", "target")
    places = groups.select("key", "size", "part", below(Window.partitionBy("key", "size").orderBy("part")).alias("earlier")).join(smaller, ["key", "size"]).join(goal, "key")
    places, _ = cut(places.select("key", "size", "part", (F.col("smaller") + F.col("earlier")).alias("before"), "source_size", "target"), "mix-places")

    # window and join ask for the same dealing, so the rows travel once
    own = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("mark", F.xxhash64("row")))
    ranked = rows.withColumn("own", own).join(places, ["key", "size", "part"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = (F.col("before") + F.col("own")).cast("double")
    crossed = lambda r: F.floor(offset_of(F.col("key")) + expected * r)
    return ranked.select("row.*", F.col("size").alias(size), F.col("source_size").alias(source_size), F.col("target").alias(target), (crossed(rank) - crossed(rank - 1)).cast("long").alias(copies))


def emit(mixed: DataFrame, copies_col: str = "copies", columns: Sequence[str] | None = None) -> DataFrame:
    """Each row as often as it is taken."""
    keep = list(columns if columns is not None else [c for c in mixed.columns if c != copies_col])
    many = F.explode(F.sequence(F.lit(1), F.col(copies_col).cast("int")))
    return mixed.where(F.col(copies_col) > 0).select(*keep, many.alias(fresh_name(mixed, "copy"))).select(*keep)


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM s),
v AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER o, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS level
      FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT (SELECT level FROM v WHERE level <= most / weight ORDER BY most / weight, level DESC LIMIT 1) AS water),
t AS (SELECT source, source_size, CASE WHEN water IS NULL THEN most ELSE least(most, water * weight) END AS target,
             ('0x' || substr(md5('{SEED}/' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 6))::BIGINT::DOUBLE / 16777216.0::DOUBLE AS u FROM v, x),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e,
             (row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5('{SEED}/' || coalesce(d.doc_id::VARCHAR, ''))))::DOUBLE AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(u + e * k) - floor(u + e * (k - 1.0)))::BIGINT * size)::BIGINT AS taken FROM r"""
