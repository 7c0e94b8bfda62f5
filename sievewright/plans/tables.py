"""The benchmark tables seen as records, and the same view in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions.bits import dct_bits, from_hex

LICENSES = ["CC0", "cc0 1.0", "CC BY 4.0", "cc by", "CC BY-SA 3.0", "Public domain", "PD-USGov", "No restrictions", "cc by-nc", "CC BY-NC-SA 4.0", "CC BY-ND 4.0", "noncommercial", "All rights reserved", "Fair use", "Copyright held by author", "GFDL", "Copyrighted free use", "UNKNOWN", "", " Dominio Público "]
CATEGORIES = ["Sandstone", "Cross-bedding", " LIMESTONE ", "Slag", "Plastiglomerate", "Minerals", "Fluorite", "Cats", "Volcanic breccia", "Cliffs", "Quartz", "Kamilo Beach plastic", "Marine debris"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as records; also doc_id, text and lang.  A document has a caption if it has a label."""
    d = table(spark, sf_dir, "documents")
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id")).distinct()
    d = d.join(labelled, F.col("doc_id") == F.col("label_id"), "left")
    i = F.col("doc_id")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))
    line = F.substring_index("text", "\n", 1)
    found = F.regexp_extract("text", r"(Apache-2\.0|GPLv3|CC BY-NC 4\.0)", 1)
    arr = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<string>")
    return d.select(
        "doc_id",
        "text",
        "lang",
        F.concat("source", F.lit("_"), i.cast("string"), F.when(i % 4 == 1, ".JPEG").when(i % 4 == 2, ".png").otherwise(".jpg")).alias("filename"),
        F.sha2("text", 256).alias("sha256"),
        F.lit(None).cast("string").alias("phash"),
        "source",
        i.cast("string").alias("source_id"),
        F.when(i % 7 == 0, F.lit(None)).when(i % 13 == 0, F.concat(F.lit("Museo "), "lang")).otherwise(F.substring(line, 1, 40)).alias("origin_title"),
        F.when(i % 5 != 0, F.concat(F.lit("http://pages.example/"), i.cast("string"))).alias("origin_url"),
        F.when(i % 17 == 0, "").otherwise(F.concat(F.lit("http://files.example/"), F.md5("text"), F.lit(".jpg"))).alias("download_url"),
        F.when(found != "", found).otherwise(pick(LICENSES, i)).alias("license"),
        F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("Author "), "source")).alias("attribution"),
        F.col("text").alias("description"),
        F.when(i % 19 == 0, arr()).when(i % 3 == 0, F.array(pick(CATEGORIES, i * 5 + 1), pick(CATEGORIES, i * 7 + 4))).otherwise(F.array(pick(CATEGORIES, i), pick(CATEGORIES, i * 3 + 2), pick(CATEGORIES, i * 11 + 5))).alias("categories"),
        F.when(i % 23 != 0, (500 + i * 37 % 2600).cast("int")).alias("width"),
        (500 + i * 53 % 2600).cast("int").alias("height"),
        F.when(i % 5 == 3, "L").when(i % 5 == 4, "RGBA").otherwise("RGB").alias("mode"),
        (F.col("n_chars") * 7).alias("bytes"),
        (i * 13 % 100).cast("double").alias("sharpness"),
        (i * 11 % 60).cast("double").alias("saturation"),
        F.when(i % 6 == 0, "01_real_estratos").when(i % 6 == 1, "02_real_plastiglomerado").when(i % 6 == 2, "03_proxy_materiales").when(i % 6 == 3, "04_synth_plastiglomerado").otherwise("_unclassified").alias("klass"),
        (i % 10 == 0).alias("panoramic"),
        (i % 8 < 4).alias("rejected"),
        F.when(i % 8 == 0, arr("too_small", "duplicate")).when(i % 8 == 1, arr("manual")).when(i % 8 == 2, arr("license_denied")).when(i % 8 == 3, arr("too_small")).otherwise(arr()).alias("reject_reasons"),
        F.when(i % 6 == 0, arr("nota & <revisar>")).otherwise(arr()).alias("needs_review"),
        F.when(F.col("label_id").isNotNull(), F.concat(F.lit("caption "), "lang", F.lit(', "'), F.substring(line, 1, 120), F.lit('"'))).alias("caption"),
    )


def _pick_sql(values: list[str], at: str) -> str:
    return f"list_extract({_list(values)}, CAST(({at}) % {len(values)} + 1 AS BIGINT))"


RECORDS_SQL = rf"""r AS (
SELECT doc_id, text, lang,
  source || '_' || doc_id || CASE WHEN doc_id % 4 = 1 THEN '.JPEG' WHEN doc_id % 4 = 2 THEN '.png' ELSE '.jpg' END AS filename,
  sha256(text) AS sha256, source, CAST(doc_id AS VARCHAR) AS source_id,
  CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'Museo ' || lang ELSE substr(string_split(text, chr(10))[1], 1, 40) END AS origin_title,
  CASE WHEN doc_id % 5 <> 0 THEN 'http://pages.example/' || doc_id END AS origin_url,
  CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'http://files.example/' || md5(text) || '.jpg' END AS download_url,
  CASE WHEN regexp_extract(text, '(Apache-2\.0|GPLv3|CC BY-NC 4\.0)', 1) <> '' THEN regexp_extract(text, '(Apache-2\.0|GPLv3|CC BY-NC 4\.0)', 1) ELSE {_pick_sql(LICENSES, "doc_id")} END AS license,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Author ' || source END AS attribution, text AS description,
  CASE WHEN doc_id % 19 = 0 THEN CAST([] AS VARCHAR[]) WHEN doc_id % 3 = 0 THEN [{_pick_sql(CATEGORIES, "doc_id * 5 + 1")}, {_pick_sql(CATEGORIES, "doc_id * 7 + 4")}]
       ELSE [{_pick_sql(CATEGORIES, "doc_id")}, {_pick_sql(CATEGORIES, "doc_id * 3 + 2")}, {_pick_sql(CATEGORIES, "doc_id * 11 + 5")}] END AS categories,
  CASE WHEN doc_id % 23 <> 0 THEN CAST(500 + doc_id * 37 % 2600 AS INTEGER) END AS width, CAST(500 + doc_id * 53 % 2600 AS INTEGER) AS height,
  CASE WHEN doc_id % 5 = 3 THEN 'L' WHEN doc_id % 5 = 4 THEN 'RGBA' ELSE 'RGB' END AS mode, n_chars * 7 AS bytes,
  CAST(doc_id * 13 % 100 AS DOUBLE) AS sharpness, CAST(doc_id * 11 % 60 AS DOUBLE) AS saturation,
  CASE doc_id % 6 WHEN 0 THEN '01_real_estratos' WHEN 1 THEN '02_real_plastiglomerado' WHEN 2 THEN '03_proxy_materiales' WHEN 3 THEN '04_synth_plastiglomerado' ELSE '_unclassified' END AS klass,
  doc_id % 10 = 0 AS panoramic, doc_id % 8 < 4 AS rejected,
  CASE doc_id % 8 WHEN 0 THEN ['too_small', 'duplicate'] WHEN 1 THEN ['manual'] WHEN 2 THEN ['license_denied'] WHEN 3 THEN ['too_small'] ELSE CAST([] AS VARCHAR[]) END AS reject_reasons,
  CASE WHEN doc_id % 6 = 0 THEN ['nota & <revisar>'] ELSE CAST([] AS VARCHAR[]) END AS needs_review,
  CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'caption ' || lang || ', "' || substr(string_split(text, chr(10))[1], 1, 120) || '"' END AS caption
FROM documents)"""


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, phash, h): the perceptual hash that an embedding's 64 numbers give as an 8 x 8 block."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", dct_bits(F.col("embedding")).alias("phash"))
    return e.withColumn("h", from_hex(F.col("phash")))


HASHES_SQL = """m AS (SELECT vec_id, embedding AS e, list_sort(embedding[2:64])[32] AS mid FROM embeddings),
hb AS (SELECT vec_id, array_to_string(list_transform(e, lambda x: CASE WHEN x > mid THEN '1' ELSE '0' END), '') AS bits FROM m)"""
