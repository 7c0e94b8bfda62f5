"""A corpus pipeline over ``documents``: language, boilerplate, near-duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``docs`` as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import common, langid, line_dedup, mixing, packing, simhash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those whose language the model rejects.

    The model learns from the labelled rows of ``docs`` outside the held-out fold.
    Where there are none, nothing is known of any language, and only documents
    without letters go; null and empty texts are such.  Each row is judged by its
    text alone, so repeated rows stay or go together; further columns stay, whatever
    their names; an empty table stays empty.
    """
    model = langid.fit(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score, accepted = (common.fresh_name(docs, x) for x in ("lang_pred", "score", "accepted"))
    return langid.identify(docs, model, lang_col=lang, score_col=score, accepted_col=accepted).where(F.col(accepted)).select(*docs.columns)


def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the boilerplate lines of each source; every document stays, with its new number of characters.

    A null text stays null and a null source is a source; repeated rows count as
    pages of their own; further columns stay, whatever their names.
    """
    gone = common.fresh_name(docs, "dropped")
    left = line_dedup.drop_boilerplate(docs, "source", dropped_col=gone)
    return left.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near-duplicates the document with the least id, once.

    Only the rows whose id is null or repeated need a comparison of whole rows for
    that; they are few, and the others pass without a shuffle of texts by content.
    Documents that share an id are told apart by their texts: each group led by the
    id keeps one of its own.  Null texts are empty, and all texts without words are
    one group; of rows that share id and text the least by its other columns stays;
    further columns stay, whatever their names; an empty table stays empty.
    """
    found, _ = common.cut(simhash.near_duplicates(docs), "pipeline-groups")
    keep, again = common.fresh_name(docs, "keep_id"), common.fresh_name(docs, "again_id")
    keepers = found.where("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
    repeated, _ = common.cut(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select(F.col("doc_id").alias(again)), "repeated-ids")
    kept = docs.join(keepers, F.col("doc_id") == F.col(keep), "left_semi")
    once = kept.join(repeated, F.col("doc_id") == F.col(again), "left_anti")
    twice = kept.join(repeated, F.col("doc_id") == F.col(again), "left_semi")
    own = found.where("doc_id = component_id").join(repeated, F.col("doc_id") == F.col(again), "left_semi")
    return once.unionByName(_homonyms(twice, own)).unionByName(_nameless(docs.where("doc_id is null"), found.where("doc_id is null and component_id is null")))


def _homonyms(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of each group led by a repeated id, one row of that id: of least text (null is the least).

    ``found`` holds the groups of the rows that lead theirs.  The fingerprint finds a
    row's group again, as rows that share an id share nothing else.
    """
    texts = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text_k")).distinct().select("text_k", "doc_id", F.xxhash64("doc_id", "text_k").alias("key_k"))
    named = simhash.with_fingerprints(texts, "key_k", "text_k").withColumnRenamed("doc_id", "key_f")
    group = found.select(F.col("doc_id").alias("id_f"), F.col("fp").alias("fp_f"), "group_fp").distinct()
    of = texts.join(named.distinct(), F.col("key_k") == F.col("key_f")).join(group, (F.col("doc_id") == F.col("id_f")) & (F.col("fp") == F.col("fp_f")))
    led, text = common.fresh_name(rows, "led_id"), common.fresh_name(rows, "led_text")
    chosen = of.groupBy("id_f", "group_fp").agg(F.min("text_k").alias("text_c")).select(F.col("id_f").alias(led), F.col("text_c").alias(text))
    left = rows.join(chosen, (F.col("doc_id") == F.col(led)) & (F.coalesce("text", F.lit("")) == F.col(text)), "left_semi")
    return left.groupBy(F.col("doc_id").alias("id_k"), F.coalesce("text", F.lit("")).alias("key_k")).agg(_least_row(rows)).select("row.*")


def _least_row(rows: DataFrame) -> Column:
    return F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct("text", "lang", "source", "n_chars")).alias("row")


def _nameless(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of each group in which no row has an id, one row with the least text (null is the least)."""
    texts = rows.select(F.coalesce("text", F.lit("")).alias("text_k")).distinct().select("text_k", F.xxhash64("text_k").alias("id_k"))
    named = simhash.with_fingerprints(texts, "id_k", "text_k").withColumnRenamed("doc_id", "id_f")
    group = found.select(F.col("fp").alias("fp_f"), "group_fp").distinct()
    text = common.fresh_name(rows, "led_text")
    chosen = named.join(group, named.fp == group.fp_f).join(texts, F.col("id_f") == F.col("id_k")).groupBy("group_fp").agg(F.min("text_k").alias("text_c")).select(F.col("text_c").alias(text))
    return rows.join(chosen, F.coalesce("text", F.lit("")) == F.col(text), "left_semi").groupBy(F.coalesce("text", F.lit("")).alias("key_k")).agg(_least_row(rows)).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents so that the sources' words meet their targets.

    Null texts have no words and are taken or not like others of their size; null
    sources are one source; rows are drawn one by one, repeated ones too, and equal
    sizes go by a hash of the id; further columns stay, whatever their names.
    """
    return mixing.emit(mixing.mix(docs), common.fresh_name(docs, "copies"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens: one row for each piece.

    Null and empty texts are the end id alone, null ids stay null, and copies are
    packed one by one; further columns are ignored.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", site_lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Learned languages, SimHash components and token packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with common.sweeping(spark) as keep:  # of what a stage writes on its way, only its result stays
            docs, path = common.cut(stage(spark, docs, sf_dir), f"stage-{name}")
            keep.add(path)
        if before:
            common.discard(spark, before)  # nothing reads the stage before the last any more
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
