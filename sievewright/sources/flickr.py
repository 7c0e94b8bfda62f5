"""Photographs of Flickr under free licences."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievewright.functions.text import none_if_empty, parsed
from sievewright.sources.http import get, told

# Fixed values of the service's interface.
ENDPOINT = "https://api.flickr.com/services/rest/"
LICENSE_IDS = "4,5,7,9,10"
LICENSE_NAMES = {"4": "CC BY 2.0", "5": "CC BY-SA 2.0", "7": "Dominio público (Flickr Commons)", "9": "CC0", "10": "Dominio público"}
SIZES = ("o", "k", "h", "b")
LEAST_SIDE = 1024
PHOTO = "id string, title string, owner string, ownername string, license string, description struct<_content:string>, " + ", ".join(f"url_{s} string, width_{s} string, height_{s} string" for s in SIZES)


def photos_to_records(photos: DataFrame, photo: str, klass: Column, query: Column) -> DataFrame:
    """Record fields of raw photos (JSON): the largest size there is; photos without one, or known to be small, go."""
    p = lambda c: F.col(f"p_.{c}")
    number = lambda c: F.nullif(F.expr(f"coalesce(try_cast(p_.{c} as int), 0)"), F.lit(0))
    width = height = None
    for s in SIZES:
        there = none_if_empty(p(f"url_{s}")).isNotNull()
        width = F.when(there, number(f"width_{s}")) if width is None else width.when(there, number(f"width_{s}"))
        height = F.when(there, number(f"height_{s}")) if height is None else height.when(there, number(f"height_{s}"))
    url = F.coalesce(*[none_if_empty(p(f"url_{s}")) for s in SIZES])
    rows = photos.select("*", parsed(F.col(photo), PHOTO).alias("p_")).withColumns({"u_": url, "w_": width, "h_": height})
    small = F.coalesce(F.least("w_", "h_") < LEAST_SIDE, F.lit(False)) & F.col("w_").isNotNull() & F.col("h_").isNotNull()
    name = F.concat(F.lit("Flickr license "), F.coalesce(p("license"), F.lit("")))
    for k, v in reversed(LICENSE_NAMES.items()):
        name = F.when(p("license") == k, v).otherwise(name)
    id_ = F.coalesce(p("id"), F.lit(""))
    own = [c for c in ("query", "seq") if c in photos.columns]
    return rows.where(F.col("u_").isNotNull() & ~small).select(
        *own,
        F.concat(F.lit("flickr_"), id_, F.lit(".jpg")).alias("filename"),
        F.lit("flickr").alias("source"),
        id_.alias("source_id"),
        F.coalesce(none_if_empty(p("title")), F.concat(F.lit("Flickr "), id_)).alias("origin_title"),
        F.concat(F.lit("https://www.flickr.com/photos/"), F.coalesce(p("owner"), F.lit("")), F.lit("/"), id_).alias("origin_url"),
        F.col("u_").alias("download_url"),
        name.alias("license"),
        F.coalesce(none_if_empty(p("ownername")), p("owner")).alias("attribution"),
        F.col("p_.description._content").alias("description"),
        F.array(query, F.lit("flickr")).alias("categories"),
        F.col("w_").alias("width"),
        F.col("h_").alias("height"),
        klass.alias("klass"),
    )


class FlickrReader(DataSourceReader):
    def __init__(self, options: dict):
        self.key, self.queries = options.get("api_key"), json.loads(options["queries"])
        self.limit, self.endpoint = int(options.get("limit", 100)), options.get("endpoint", ENDPOINT)

    def partitions(self) -> list[InputPartition]:
        if not self.key:
            return [InputPartition(None)]
        return [InputPartition((i, q)) for i, q in enumerate(self.queries)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        i, query = partition.value
        number, taken = 1, 0
        while taken < self.limit:
            try:
                answer = json.loads(get(self.endpoint, {"method": "flickr.photos.search", "api_key": self.key, "text": query, "license": LICENSE_IDS, "format": "json", "nojsoncallback": 1, "per_page": 100, "page": number, "extras": "license,owner_name,description,url_o,url_k,url_h,url_b"}))["photos"]
            except Exception as e:
                yield query, (i << 32) + taken, None, told(e)
                return
            for photo in answer.get("photo") or []:
                if taken < self.limit:
                    yield query, (i << 32) + taken, json.dumps(photo), None
                    taken += 1
            if number >= int(answer.get("pages", 0)):
                return
            number += 1


class FlickrSource(DataSource):
    """Options: ``api_key`` (without one there are no rows), ``queries`` (JSON list), ``limit``, ``endpoint``; a search that breaks off ends with a row that has an error and no photo."""

    @classmethod
    def name(cls) -> str:
        return "flickr"

    def schema(self) -> str:
        return "query string, seq long, photo string, error string"

    def reader(self, schema) -> DataSourceReader:
        return FlickrReader(dict(self.options))
