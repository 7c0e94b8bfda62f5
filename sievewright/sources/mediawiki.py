"""Files of a media wiki: a data source of raw pages, and the way from a page to a record."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievewright.functions.text import html_strip, none_if_empty, parsed, safe_filename
from sievewright.functions.verdicts import add_reason
from sievewright.schema import UNKNOWN_LICENSE
from sievewright.sources.http import get, told

# Fixed values of the wiki's interface.
ENDPOINT = "https://commons.wikimedia.org/w/api.php"
SUFFIXES = (".jpg", ".jpeg", ".png")
LEAST_SIDE = 1024
PAGE = "pageid long, title string, imageinfo array<struct<url:string,descriptionurl:string,thumburl:string,width:int,height:int,extmetadata:map<string,struct<value:string>>>>, categories array<struct<title:string>>"


def usable(page: dict) -> bool:
    """Whether :func:`pages_to_records` keeps a page; the limit of a query counts these."""
    info = (page.get("imageinfo") or [{}])[0]
    return bool(info.get("url")) and page.get("title", "").lower().endswith(SUFFIXES) and min(info.get("width") or 0, info.get("height") or 0) >= LEAST_SIDE


def generator(query: str, limit: int) -> dict:
    """Request parameters: members of a category, or a search in the files' name space."""
    if query.lower().startswith("category:"):
        return {"generator": "categorymembers", "gcmtitle": query, "gcmtype": "file", "gcmlimit": min(limit, 100)}
    return {"generator": "search", "gsrsearch": query, "gsrnamespace": 6, "gsrlimit": min(limit, 50)}


def paginate(endpoint: str, params: dict, limit: int, wanted=usable) -> Iterator[dict]:
    """Pages until ``limit`` wanted ones, an error (what came stays, and it is raised), or no continuation."""
    ask, taken = {"action": "query", "format": "json", "prop": "imageinfo|categories", "iiprop": "url|size|extmetadata", "cllimit": 50, **params}, 0
    more: dict = {}
    while taken < limit:
        answer = json.loads(get(endpoint, {**ask, **more}))
        for page in (answer.get("query", {}).get("pages") or {}).values():
            if taken < limit and wanted(page):
                taken += 1
                yield page
        more = answer.get("continue") or {}
        if not more:
            return


class _Query(InputPartition):
    pass


class MediaWikiReader(DataSourceReader):
    def __init__(self, options: dict):
        self.queries = json.loads(options["queries"])
        self.limit, self.endpoint = int(options.get("limit", 200)), options.get("endpoint", ENDPOINT)
        self.thumbs = options.get("thumbs", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Query((i, q)) for i, q in enumerate(self.queries)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        i, query = partition.value
        params = generator(query, self.limit)
        if self.thumbs:
            params |= {"iiurlwidth": 320}
        wanted = (lambda p: bool((p.get("imageinfo") or [{}])[0].get("thumburl"))) if self.thumbs else usable
        taken = 0
        try:
            for page in paginate(self.endpoint, params, self.limit, wanted):
                yield query, (i << 32) + taken, json.dumps(page), None
                taken += 1
        except Exception as e:
            yield query, (i << 32) + taken, None, told(e)


class MediaWikiSource(DataSource):
    """Options: ``queries`` (JSON list; one task each), ``limit``, ``endpoint``, ``thumbs`` (pages with a thumbnail instead).

    A listing that breaks off ends with a row that has an error and no page.
    """

    @classmethod
    def name(cls) -> str:
        return "mediawiki"

    def schema(self) -> str:
        return "query string, seq long, page string, error string"

    def reader(self, schema) -> DataSourceReader:
        return MediaWikiReader(dict(self.options))


def pages_to_records(pages: DataFrame, page: str, klass: Column, hint: Column) -> DataFrame:
    """Record fields of raw pages (JSON); pages that are no usable picture go.

    ``hint`` is the query that found the page, and becomes a category if it is not
    one already.
    """
    rows = pages.select("*", parsed(F.col(page), PAGE).alias("p_")).withColumn("i_", F.try_element_at("p_.imageinfo", F.lit(1)))
    title, info = F.coalesce("p_.title", F.lit("")), F.col("i_")
    fit = none_if_empty(info["url"]).isNotNull() & F.regexp_like(title, F.lit(r"(?i)\.(jpg|jpeg|png)$")) & (F.coalesce(info["width"], F.lit(0)) >= LEAST_SIDE) & (F.coalesce(info["height"], F.lit(0)) >= LEAST_SIDE)
    meta = lambda k: html_strip(F.try_element_at(info["extmetadata"], F.lit(k))["value"])
    cats = F.transform(F.coalesce("p_.categories", F.from_json(F.lit("[]"), "array<struct<title:string>>")), lambda c: F.regexp_replace(F.coalesce(c["title"], F.lit("")), "^Category:", ""))
    number = F.coalesce(F.col("p_.pageid").cast("string"), F.lit(""))
    safe = safe_filename(F.regexp_replace(title, "^File:", ""))
    own = [c for c in pages.columns if c not in (page, "error")]
    return rows.where(fit).select(
        *own,
        F.when(number != "", F.concat(F.lit("wm_"), number, F.lit("_"), safe)).otherwise(F.concat(F.lit("wm_"), safe)).alias("filename"),
        F.lit("wikimedia").alias("source"),
        number.alias("source_id"),
        title.alias("origin_title"),
        info["descriptionurl"].alias("origin_url"),
        info["url"].alias("download_url"),
        F.coalesce(meta("LicenseShortName"), meta("UsageTerms"), F.lit(UNKNOWN_LICENSE)).alias("license"),
        F.coalesce(meta("Artist"), meta("Credit")).alias("attribution"),
        meta("ImageDescription").alias("description"),
        add_reason(cats, hint).alias("categories"),
        info["width"].alias("width"),
        info["height"].alias("height"),
        klass.alias("klass"),
    )


def thumb_candidates(pages: DataFrame, page: str = "page", most: int = 600) -> DataFrame:
    """(query, seq, title, description_url, url, thumb_url, meta, category) of pages with a thumbnail, the first ``most`` of each query."""
    from sievewright.operators.discovery import limit_per_group

    rows = pages.select("query", "seq", parsed(F.col(page), PAGE).alias("p")).withColumn("i", F.try_element_at("p.imageinfo", F.lit(1))).where("i.thumburl is not null")
    rows = rows.select("query", "seq", "p.title", F.col("i.descriptionurl").alias("description_url"), "i.url", F.col("i.thumburl").alias("thumb_url"), F.transform_values("i.extmetadata", lambda _, v: v["value"]).alias("meta"), F.regexp_replace("query", "(?i)^category:", "").alias("category"))
    return limit_per_group(rows, "query", F.col("seq"), most)
