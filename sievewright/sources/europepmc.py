"""Figures of open-access articles: search, full text, and the archives that hold the pictures."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from sievewright.functions.licenses import ALLOWED_MARKERS, DENIED_CLAUSES, is_allowed
from sievewright.schema import UNKNOWN_LICENSE
from sievewright.sources.http import get, told

# Fixed values of the service's interface and of its records.
ENDPOINT = "https://www.ebi.ac.uk/europepmc/webservices/rest"
MEMBER = "::"
NOTE = "figura de paper: revisar si es compuesta y recortar"
ARTICLE = "pmcid string, license string, title string, authorString string, journalTitle string"


def article_gate(articles: DataFrame) -> DataFrame:
    """Articles with an id and an admitted licence (none stated counts as ``cc by``); before any full text is fetched."""
    return articles.where((F.coalesce("pmcid", F.lit("")) != "") & is_allowed(F.coalesce("license", F.lit("cc by"))))


def figures(xml: str | None) -> list[tuple[str, str, str]]:
    """(id, href, caption) of each figure that names a graphic; none if the text is no XML."""
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return []
    out = []
    for fig in root.iter("fig"):
        graphics = [g for g in fig.iter() if isinstance(g.tag, str) and g.tag.endswith("graphic")]
        hrefs = [v for k, v in graphics[0].attrib.items() if k.endswith("href")] if graphics else []
        if hrefs and hrefs[0]:
            caption = fig.find("caption")
            words = "" if caption is None else " ".join("".join(caption.itertext()).split())
            out.append((fig.get("id", "fig"), hrefs[0], words[:500]))
    return out


class FigureRows:
    """Table function: one article's XML to a row for each figure."""

    def eval(self, xml: str):
        yield from figures(xml)


def register(spark: SparkSession) -> None:
    """Make ``xml_figures(xml)`` known to SQL."""
    from pyspark.sql.functions import udtf

    spark.udtf.register("xml_figures", udtf(FigureRows, returnType="fig_id string, href string, caption string"))


def figure_rows(articles: DataFrame, xml: str = "xml") -> DataFrame:
    """``articles`` with a row for each figure of their full text: fig_id, href, caption."""
    register(articles.sparkSession)
    articles.createOrReplaceTempView("sievewright_articles")
    return articles.sparkSession.sql(f"select a.*, f.* from sievewright_articles a, lateral xml_figures(a.{xml}) f").drop(xml)


def figures_to_records(rows: DataFrame, klass: Column, query: Column) -> DataFrame:
    """Record fields of (pmcid, license, title, authorString, journalTitle, fig_id, href, caption)."""
    safe = F.regexp_replace("href", r"[^\p{L}\p{N}_.-]+", "_")
    named = F.when(F.regexp_like(safe, F.lit(r"(?i)\.(jpg|jpeg|png)$")), safe).otherwise(F.concat(safe, F.lit(".jpg")))
    authors, journal = F.trim(F.coalesce("authorString", F.lit(""))), F.trim(F.coalesce("journalTitle", F.lit("")))
    archive = F.concat(F.lit(f"{ENDPOINT}/"), "pmcid", F.lit("/supplementaryFiles"))
    own = [c for c in ("query", "seq") if c in rows.columns]
    return rows.where(F.col("href").isNotNull()).select(
        *own,
        F.concat(F.lit("epmc_"), F.lower("pmcid"), F.lit("_"), named).alias("filename"),
        F.lit("europepmc").alias("source"),
        F.col("pmcid").alias("source_id"),
        F.concat(F.trim(F.coalesce("title", F.lit(""))), F.lit(" — "), "fig_id").alias("origin_title"),
        F.concat(F.lit("https://europepmc.org/article/PMC/"), "pmcid").alias("origin_url"),
        F.concat(archive, F.lit(MEMBER), "href").alias("download_url"),
        F.coalesce("license", F.lit("cc by")).alias("license"),
        F.when(authors != "", F.concat(authors, F.lit(" ("), journal, F.lit(")"))).otherwise(journal).alias("attribution"),
        F.col("caption").alias("description"),
        F.array(query, F.lit("europepmc")).alias("categories"),
        F.array(F.lit(NOTE)).alias("needs_review"),
        klass.alias("klass"),
    )


def best_member(wanted: str, names: list[str]) -> str | None:
    """The archive's member for a figure: the same name; else the same stem whatever its case, a picture format first."""
    if wanted in names:
        return wanted
    stem = lambda n: n.rsplit(".", 1)[0].lower()
    same = [n for n in names if stem(n) == stem(wanted)]
    return next((n for n in same if n.lower().endswith((".jpg", ".jpeg", ".png"))), same[0] if same else None)


def best_member_of(wanted: Column, names: Column) -> Column:
    """:func:`best_member` of columns."""

    @F.pandas_udf("string")
    def chosen(w: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if a is None or b is None else best_member(a, list(b)) for a, b in zip(w, n)], dtype=object)

    return chosen(wanted, names)


def split_url(url: str) -> tuple[str, str]:
    archive, mark, member = url.rpartition(MEMBER)
    if not mark:
        raise ValueError(f"no {MEMBER} in {url!r}")
    return archive, member


def read_members(wanted: DataFrame, fetch=get) -> DataFrame:
    """``wanted`` (download_url, ...) with (content, error): the members named by ``archive::member``.

    Rows are dealt and sorted by archive, so a task fetches each archive once, holds
    one at a time, and gives its members row by row; a failure is the row's error and
    loses no other row.
    """
    names = wanted.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zipped = failed = None
        for batch in batches:
            for at in range(batch.num_rows):
                url, content, error = batch.column(names.index("download_url"))[at].as_py(), None, None
                try:
                    archive, member = split_url(url)
                    if archive != held:
                        held, zipped, failed = archive, None, None
                        try:
                            zipped = zipfile.ZipFile(io.BytesIO(fetch(archive)))
                        except Exception as e:
                            failed = e
                    if failed is not None:
                        raise failed
                    name = best_member(member, zipped.namelist())
                    if name is None:
                        raise FileNotFoundError(member)
                    content = zipped.read(name)
                except Exception as e:
                    error = f"{type(e).__name__}: {str(e)[:80]}"
                yield pa.RecordBatch.from_arrays([*batch.slice(at, 1).columns[: len(names)], pa.array([content], pa.binary()), pa.array([error], pa.string())], [*names, "content", "error"])

    archive = F.regexp_extract("download_url", f"^(.*){MEMBER}", 1)
    dealt = wanted.withColumn("archive_", archive).repartition("archive_").sortWithinPartitions("archive_")
    return dealt.mapInArrow(run, StructType([*wanted.schema.fields, StructField("content", BinaryType()), StructField("error", StringType())]))


def _admitted(license_: str | None) -> bool:
    text = (license_ or "cc by").lower().strip()
    return (license_ or "cc by") != UNKNOWN_LICENSE and not any(d in text for d in DENIED_CLAUSES) and any(a in text for a in ALLOWED_MARKERS)


class EuropePmcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.queries, self.limit, self.endpoint = json.loads(options["queries"]), int(options.get("limit", 100)), options.get("endpoint", ENDPOINT)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((i, q)) for i, q in enumerate(self.queries)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        i, query = partition.value
        cursor, taken = "*", 0
        while taken < self.limit:
            try:
                page = json.loads(get(f"{self.endpoint}/search", {"query": f"{query} AND OPEN_ACCESS:y AND HAS_FT:y", "format": "json", "resultType": "core", "pageSize": 50, "cursorMark": cursor}))
            except Exception as e:
                yield query, (i << 32) + taken, *[None] * 8, told(e)  # what came stays
                return
            articles = (page.get("resultList") or {}).get("result") or []
            for a in articles:
                if not a.get("pmcid") or not _admitted(a.get("license")):
                    continue
                try:
                    xml = get(f"{self.endpoint}/{a['pmcid']}/fullTextXML").decode("utf-8", "replace")
                except Exception as e:
                    yield query, (i << 32) + taken, a["pmcid"], *[None] * 7, told(e)
                    continue
                for fig, href, caption in figures(xml):
                    if taken < self.limit:
                        yield query, (i << 32) + taken, a["pmcid"], a.get("license"), a.get("title"), a.get("authorString"), a.get("journalTitle"), fig, href, caption, None
                        taken += 1
            following = page.get("nextCursorMark")
            if not articles or not following or following == cursor:
                return
            cursor = following


class EuropePmcSource(DataSource):
    """Options: ``queries`` (JSON list; one task each), ``limit`` (figures a query), ``endpoint``.

    A search page or a full text that cannot be had is a row with nothing but its
    error (and the article's id).
    """

    @classmethod
    def name(cls) -> str:
        return "europepmc"

    def schema(self) -> str:
        return "query string, seq long, " + ARTICLE + ", fig_id string, href string, caption string, error string"

    def reader(self, schema) -> DataSourceReader:
        return EuropePmcReader(dict(self.options))
