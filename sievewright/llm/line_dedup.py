"""Site-relative line dedup, with DataFrame functions only (operator 1).

Lines are counted by (site, line digest): the pages of the site that contain the
line, once each, over the pages of the site.  Lines above ``max_ratio`` on at
least ``min_pages`` pages are boilerplate and leave every page of that site.  The
shuffle carries two 64-bit digests a distinct line of a page, summed before it;
texts are never shuffled by line, nor those of a hot site by site.  A site has at most (mean distinct lines a page)
/ ``max_ratio`` boilerplate lines, however large it is, so a site's list is short
and joins its pages as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import cut

#: More than this share of a site's pages makes a line boilerplate.
MAX_RATIO = 0.08
#: Fewer pages than this never do: a small site repeats lines by chance.
MIN_PAGES = 5
#: A site with more than one in so many of all pages is hot.
HOT_SITES = 1000


def digest(line: Column) -> Column:
    """128 bits of a line without its outer spaces: two hashes from unrelated seeds."""
    own = F.trim(line)
    return F.struct(F.xxhash64(own).alias("a"), F.xxhash64(F.lit("line"), own).alias("b"))


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without user, port and a leading ``www.``; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def html_lines(html: Column) -> Column:
    """The text of a page with a line for each block element.

    Comments, scripts, styles and heads go with their content; the tags of block
    elements become line feeds, other tags nothing; the five basic entities are
    replaced; blank lines go.
    """
    text = F.coalesce(html, F.lit(""))
    for pattern, by in HTML_STEPS:
        text = F.regexp_replace(text, pattern, by)
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(text, r"[ \t\r]*\n[ \t\r\n]*", "\n")
    return F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


#: Patterns that Spark's and DuckDB's regular expressions read alike.
HTML_STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|table|tr|td|th|section|article|nav|header|footer|aside|main|blockquote|pre|figure|figcaption|form|body|html)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)


def boilerplate(df: DataFrame, site_col: str, text_col: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, lines, hot): for each site with boilerplate, the digests of its boilerplate lines.

    ``hot`` marks sites with more than one in ``HOT_SITES`` of all pages, so there
    are fewer than ``HOT_SITES`` of them.
    """
    pages = df.select(F.col(site_col).alias("site"), F.col(text_col).alias("text"))
    totals = pages.groupBy("site").agg(F.count("*").alias("pages"))
    # a line counts once a page: equal lines of one page are one before they are digested
    lines = pages.select("site", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.trim(x)))).alias("line")).where("line <> ''")
    counts = lines.select("site", digest(F.col("line")).alias("d")).groupBy("site", "d").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    above = counts.join(totals.withColumnRenamed("site", "site_"), F.col("site").eqNullSafe(F.col("site_"))).where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
    lists = above.groupBy("site").agg(F.sort_array(F.collect_list("d")).alias("lines"), F.max("pages").alias("pages"))
    return lists.select("site", "lines", (F.col("pages") * HOT_SITES > F.lit(df.count())).alias("hot"))


def drop_boilerplate(df: DataFrame, site: str, text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, kept_col: str | None = None, dropped_col: str | None = None) -> DataFrame:
    """``df`` with ``text_col`` less its site's boilerplate lines; the rows and their number stay.

    Blank lines stay and never count.  Null texts stay null; null sites are one
    site of their own; a page whose lines all go keeps the text ''.  Repeated rows
    are pages of their own, and a line on exactly ``max_ratio`` of the pages stays.
    An empty table stays empty.  ``dropped_col``, if named, gets the number of lines
    dropped, ``kept_col`` of those kept; a column of that name is replaced.

    The lists of the few hot sites are sent to all tasks; the rows of those sites are
    then dealt by their content where the other lists are too large for that, so a
    site with a third of all pages is no task of its own.
    """
    found, _ = cut(boilerplate(df, site, text_col, max_ratio, min_pages), "boilerplate")
    taken = {c.lower() for c in [*df.columns, dropped_col or "", kept_col or ""]}
    names = ["hot_site", "hot_lines", "cold_site", "cold_salt", "cold_lines"]
    while taken & set(names):
        names = [x + "_" for x in names]
    hot_site, hot_lines, cold_site, cold_salt, cold_lines = names
    hot = found.where("hot").select(F.col("site").alias(hot_site), F.col("lines").alias(hot_lines))
    cold = found.where("not hot").select(F.col("site").alias(cold_site), F.lit(0).alias(cold_salt), F.col("lines").alias(cold_lines))
    out = df.join(F.broadcast(hot), F.col(site).eqNullSafe(F.col(hot_site)), "left")
    salt = F.when(F.col(hot_lines).isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(F.col(text_col)), F.lit(1 << 20)).cast("int"))
    out = out.join(cold, F.col(site).eqNullSafe(F.col(cold_site)) & (salt == F.col(cold_salt)), "left")
    gone = F.coalesce(F.col(hot_lines), F.col(cold_lines))
    whole = F.split(F.col(text_col), "\n")
    left = F.filter(whole, lambda x: (F.trim(x) == "") | ~F.array_contains(gone, digest(x)))
    text = F.when(gone.isNull() | F.col(text_col).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    more = {}
    if dropped_col:
        more[dropped_col] = F.when(gone.isNull() | F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(whole) - F.size(left)).cast("long")
    if kept_col:
        more[kept_col] = F.when(F.col(text_col).isNull(), F.lit(0)).when(gone.isNull(), F.size(whole)).otherwise(F.size(left)).cast("long")
    kept = [c for c in df.columns if c.lower() not in {x.lower() for x in more}]
    return out.withColumns({**more, text_col: text}).select(*kept, *more)


def page_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, text) of raw pages, ready for :func:`drop_boilerplate`.

    A null page has the text '', a URL without a host or a null one the host null;
    repeated pages stay, other columns go, and an empty table stays empty.
    """
    return pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), html_lines(F.col(html_col)).alias("text"))


def oracle(max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> str:
    """The SQL of the ``pages`` query."""
    text = "coalesce(html, '')"
    for pattern, by in HTML_STEPS:
        text = f"regexp_replace({text}, '{pattern}', {'chr(10)' if by else chr(39) * 2}, 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    text = f"regexp_replace(regexp_replace({text}, '[ \\t\\r]*\\n[ \\t\\r\\n]*', chr(10), 'g'), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')"
    host = r"nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '^www\.', ''), '')"
    return f"""
WITH p AS (SELECT page_id, {host} AS host, {text} AS text FROM pages),
l AS (SELECT page_id, host, u.line, u.pos FROM (SELECT page_id, host, string_split(text, chr(10)) AS a FROM p) q, LATERAL (SELECT unnest(a) AS line, generate_subscripts(a, 1) AS pos) u),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
c AS (SELECT host, trim(line) AS line, count(DISTINCT page_id) AS n FROM l WHERE trim(line) <> '' GROUP BY 1, 2),
b AS (SELECT c.host, c.line FROM c JOIN t ON c.host IS NOT DISTINCT FROM t.host WHERE n >= {min_pages} AND n > {max_ratio}::DOUBLE * pages),
m AS (SELECT l.*, b.line IS NOT NULL AS gone FROM l LEFT JOIN b ON l.host IS NOT DISTINCT FROM b.host AND trim(l.line) = b.line)
SELECT page_id, host, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*) FILTER (WHERE NOT gone) AS n_kept, count(*) FILTER (WHERE gone) AS n_dropped
FROM m GROUP BY page_id, host"""
