"""Classes from categories by majority vote, and what follows from a class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions.text import MUSEUM_NOTE, MUSEUM_WORDS, SPECIMEN_NOTE, SPECIMEN_WORDS, CaptionWords, caption, mentions
from sievewright.functions.verdicts import add_reason
from sievewright.schema import PLASTIC, PROXY, STRATA, UNCLASSIFIED

# Fixed values of the groups.
GROUP_CLASS = {"estratos": STRATA, "plastiglomerado": PLASTIC, "proxy": PROXY}
NOISE_GROUP = "legacy_noise"
CATALOGUE_NOTE = "mineral de colección, fuera del concepto"


def flatten(config: dict, blocks: tuple[str, ...] = ("wikimedia_categories", "search_terms")) -> list[tuple[int, str, str, str]]:
    """(seq, block, group, item) of a configuration, in its order."""
    out = []
    for block in blocks:
        for group, items in (config.get(block) or {}).items():
            for item in items or []:
                out.append((len(out), block, group, item))
    return out


def config_items(spark: SparkSession, config: dict) -> DataFrame:
    return spark.createDataFrame(flatten(config), "seq int, block string, group string, item string")


def group_index(items: DataFrame) -> DataFrame:
    """(item, group): lower-cased items; of one that stands in several groups, the last counts."""
    return items.groupBy(F.lower("item").alias("item")).agg(F.max_by("group", "seq").alias("group"))


def ordered_distinct(items: DataFrame, column: str = "item", order: str = "seq") -> DataFrame:
    """Each value once, where it stands first."""
    return items.groupBy(column).agg(F.min(order).alias(order)).orderBy(order)


def votes(df: DataFrame, index: DataFrame, key: str = "filename") -> DataFrame:
    """(key, klass, all_noise, n_votes) for each row that has categories.

    A category votes for its group.  Any vote for the scarce class wins; else the
    majority, a tie going to the group that voted first; the noise group and no vote
    give no class.  ``all_noise``: there is a noise category and none of another
    known group.
    """
    cats = df.select(key, F.posexplode("categories").alias("pos", "cat")).withColumn("item", F.regexp_replace(F.lower("cat"), r"(?U)^\s+|\s+$", ""))
    known = cats.join(index, "item", "left")
    counted = known.groupBy(key, "group").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    best = F.max(F.when(F.col("group").isNotNull(), F.struct("n", (-F.col("first")).alias("early"), "group")))["group"]
    told = counted.groupBy(key).agg(
        best.alias("best"),
        F.coalesce(F.bool_or(F.col("group") == "plastiglomerado"), F.lit(False)).alias("scarce"),
        (F.coalesce(F.bool_or(F.col("group") == NOISE_GROUP), F.lit(False)) & F.bool_and(F.coalesce(F.col("group") == NOISE_GROUP, F.lit(True)))).alias("all_noise"),
        F.sum(F.when(F.col("group").isNotNull(), F.col("n")).otherwise(0)).alias("n_votes"),
    )
    klass = F.when(F.col("scarce"), PLASTIC)
    for group, name in GROUP_CLASS.items():
        klass = klass.when(F.col("best") == group, name)
    return told.select(key, klass.otherwise(UNCLASSIFIED).alias("klass"), "all_noise", F.col("n_votes").cast("long").alias("n_votes"))


def studio_notes(notes: Column, description: Column, filename: Column, title: Column) -> Column:
    """Notes where the words tell of a specimen or of a museum."""
    wide = F.concat_ws(" ", filename, F.coalesce(title, F.lit("")))
    with_specimen = F.when(mentions(description, SPECIMEN_WORDS), add_reason(notes, SPECIMEN_NOTE)).otherwise(notes)
    return F.when(mentions(wide, MUSEUM_WORDS), add_reason(with_specimen, MUSEUM_NOTE)).otherwise(with_specimen)


def classify_all(df: DataFrame, index: DataFrame, overwrite: bool = False) -> DataFrame:
    """Records with their class.

    Classified rows stay unless ``overwrite``.  A class that changes takes the
    caption with it; rows that are not rejected get the studio notes; rows whose
    categories are all noise are out of scope.
    """
    told = votes(df, index).withColumnRenamed("klass", "voted_")
    rows = df.join(told.select("filename", "voted_", "all_noise"), "filename", "left")
    touched = F.lit(True) if overwrite else F.col("klass") == UNCLASSIFIED
    new = F.coalesce("voted_", F.lit(UNCLASSIFIED))
    noise = touched & (new == UNCLASSIFIED) & F.coalesce("all_noise", F.lit(False))
    notes = F.when(touched & ~F.col("rejected"), studio_notes(F.col("needs_review"), F.col("description"), F.col("filename"), F.col("origin_title"))).otherwise(F.col("needs_review"))
    out = rows.select(
        *[c for c in df.columns if c not in ("klass", "caption", "needs_review", "reject_reasons", "rejected")],
        F.when(touched, new).otherwise(F.col("klass")).alias("klass"),
        F.when(touched & (new != F.col("klass")), F.lit(None)).otherwise(F.col("caption")).alias("caption"),
        F.when(noise, add_reason(notes, CATALOGUE_NOTE)).otherwise(notes).alias("needs_review"),
        F.when(noise, add_reason(F.col("reject_reasons"), "out_of_scope")).otherwise(F.col("reject_reasons")).alias("reject_reasons"),
        (F.col("rejected") | noise).alias("rejected"),
    )
    return out.select(*df.columns)


def caption_all(df: DataFrame, overwrite: bool = False, words: CaptionWords = CaptionWords()) -> DataFrame:
    """Captions for classified rows that have none (or for all of them); rejected rows too."""
    lacks = F.lit(True) if overwrite else F.coalesce("caption", F.lit("")) == ""
    made = caption(F.col("klass"), F.col("categories"), F.col("description"), F.col("saturation"), F.col("panoramic"), words)
    return df.withColumn("caption", F.when(lacks & (F.col("klass") != UNCLASSIFIED), made).otherwise(F.col("caption")))
