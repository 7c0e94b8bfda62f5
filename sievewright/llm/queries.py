"""The contract queries, each a thin layer over its operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.common import cut
    from sievewright.llm.line_dedup import drop_boilerplate, page_lines

    lines, _ = cut(page_lines(_table(spark, sf_dir, "pages")), "page-lines")  # extracted once, read twice
    return drop_boilerplate(lines, "host", kept_col="n_kept", dropped_col="n_dropped")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored files are declared as what they were before, plain text; sniffing corrects that, and counts the files in each value."""
    from sievewright.llm.media import read_media, sniff, store_texts

    stored = store_texts(_table(spark, sf_dir, "documents")).withColumn("declared", F.lit("text/plain"))
    read = read_media(sniff(stored, "media", "declared").withColumn("n_files", F.size("segments").cast("long")))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "detected", "corrected", "n_files")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` has no URL: its source stands in for the host, and its language for the path within it."""
    from sievewright.llm.quality import grade

    return grade(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.lattice import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.mixing import mix

    mixed = mix(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.token_orc import round_trip

    return round_trip(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievewright.llm.langid import fit, held_out, identify

    docs = _table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_packing, op3_media, op4_simhash, op5_quality, op6_lattice, op7_token_counts, op8_mixing, op9_token_orc, op10_language_id)}

def _oracle_sql() -> dict[str, str]:
    from sievewright.llm import line_dedup, mixing

    return {"op1_line_dedup": line_dedup.oracle(), "op8_mixing": mixing.ORACLE}


ORACLE_SQL = _oracle_sql()
