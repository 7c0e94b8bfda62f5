"""Export: the gates, the training tree, its captions, attributions and contact sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.licenses import is_allowed
from sievewright.functions.text import html_escape, none_if_empty, stem, suffix
from sievewright.schema import CLASS_REPEATS, UNCLASSIFIED


def repeats_of(klass: Column, repeats: dict[str, int] | None = None) -> Column:
    """A class's repeats in an epoch, 1 where none are named."""
    out = F.when(F.lit(False), F.lit(1))
    for name, n in (repeats or CLASS_REPEATS).items():
        out = out.when(klass == name, n)
    return out.otherwise(1)


def gate_status(df: DataFrame, present: Column) -> DataFrame:
    """Records with ``export_status``: the first gate that stops a row, else ``ok``.

    ``inactive`` (rejected or without a class), ``skipped_license``,
    ``skipped_no_caption``, ``missing_source``.
    """
    status = (
        F.when(F.col("rejected") | (F.col("klass") == UNCLASSIFIED), "inactive")
        .when(~is_allowed(F.col("license")), "skipped_license")
        .when(F.coalesce("caption", F.lit("")) == "", "skipped_no_caption")
        .when(~F.coalesce(present, F.lit(False)), "missing_source")
        .otherwise("ok")
    )
    return df.withColumn("export_status", status)


def export_paths(df: DataFrame, repeats: dict[str, int] | None = None) -> DataFrame:
    """``df`` with folder, image_name, caption_name, repeats and converted (whether the picture is encoded anew)."""
    n = repeats_of(F.col("klass"), repeats)
    name = stem(F.col("filename"))
    converted = ~((F.coalesce("mode", F.lit("")) == "RGB") & suffix(F.col("filename")).isin(".jpg", ".jpeg"))
    return df.withColumns({"repeats": n.cast("long"), "folder": F.concat(n.cast("string"), F.lit("_"), F.col("klass")), "image_name": F.concat(name, F.lit(".jpg")), "caption_name": F.concat(name, F.lit(".txt")), "converted": converted})


def folder_totals(paths: DataFrame) -> DataFrame:
    """(folder, images, repeats, views)."""
    out = paths.groupBy("folder", "repeats").agg(F.count("*").alias("images"))
    return out.select("folder", "images", "repeats", (F.col("images") * F.col("repeats")).alias("views")).orderBy("folder")


def captions_csv(paths: DataFrame) -> DataFrame:
    """(file_name, text), sorted by both."""
    return paths.select(F.col("image_name").alias("file_name"), F.col("caption").alias("text")).orderBy("file_name", "text")


def csv_line(*cols: Column) -> Column:
    """A line of comma-separated values, quoted where a value holds a comma, quote or line end."""
    field = lambda c: F.when(F.regexp_like(c, F.lit('[,"\r\n]')), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.concat_ws(",", *[field(c) for c in cols])


def attribution_lines(df: DataFrame) -> DataFrame:
    """(source, filename, line): active rows with a title, as list items of a credits page."""
    rows = df.where(~F.col("rejected") & (F.coalesce("origin_title", F.lit("")) != ""))
    # The form of a credit line.
    by, at = none_if_empty(F.col("attribution")), none_if_empty(F.col("origin_url"))
    line = F.concat_ws(" ", F.concat(F.lit("- **"), F.col("filename"), F.lit("** — "), F.col("origin_title")), F.concat(F.lit("por "), by), F.concat(F.lit("("), F.col("license"), F.lit(")")), F.concat(F.lit("<"), at, F.lit(">")))
    return rows.select("source", "filename", line.alias("line")).orderBy("source", "filename")


def sheet_rows(df: DataFrame, image: Column | None = None) -> DataFrame:
    """(filename, css, figure): each record as a figure of the contact sheet; ``image`` is a data URI."""
    # The sheet's mark-up and its words.
    css = F.when(F.col("rejected"), "bad").when(F.size("needs_review") > 0, "warn").otherwise("ok")
    tag = lambda values, kind: F.array_join(F.transform(values, lambda x: F.concat(F.lit(f"<span class='tag{kind}'>"), html_escape(x), F.lit("</span>"))), "")
    tags = F.concat(
        tag(F.col("reject_reasons"), ""),
        tag(F.col("needs_review"), " warn"),
        F.when(F.col("panoramic"), "<span class='tag info'>panorámica</span>").otherwise(""),
        F.when(F.col("klass") != UNCLASSIFIED, F.concat(F.lit("<span class='tag info'>"), html_escape(F.col("klass")), F.lit("</span>"))).otherwise(""),
    )
    dims = F.when(F.coalesce("width", F.lit(0)) != 0, F.concat(F.col("width").cast("string"), F.lit("×"), F.coalesce(F.col("height").cast("string"), F.lit("?")))).otherwise("?")
    lic = F.coalesce(none_if_empty(F.col("license")), F.lit("?"))
    cap = F.when(F.coalesce("caption", F.lit("")) != "", F.concat(F.lit("<div class='cap'>"), html_escape(F.substring("caption", 1, 110)), F.lit("</div>"))).otherwise("")
    img = F.lit("<img alt='no se pudo leer'>") if image is None else F.coalesce(F.concat(F.lit("<img loading='lazy' src='"), image, F.lit("' alt=''>")), F.lit("<img alt='no se pudo leer'>"))
    figure = F.concat(F.lit("<figure class='"), css, F.lit("'>"), img, F.lit("<figcaption><div class='name'>"), html_escape(F.col("filename")), F.lit("</div><div class='meta'>"), dims, F.lit(" · "), html_escape(lic), F.lit("</div><div class='tags'>"), tags, F.lit("</div>"), cap, F.lit("</figcaption></figure>"))
    return df.select("filename", css.alias("css"), figure.alias("figure"))


def tree_check(files: DataFrame) -> DataFrame:
    """(folder, images, captions, repeats, matched, views) from (folder, name): does every picture have its caption file?"""
    ext = suffix(F.col("name"))
    out = files.groupBy("folder").agg(F.count_if(ext.isin(".jpg", ".png")).alias("images"), F.count_if(ext == ".txt").alias("captions"))
    n = F.coalesce(F.expr("try_cast(regexp_extract(folder, '^([0-9]+)_', 1) as long)"), F.lit(1))
    return out.withColumn("repeats", n).withColumn("matched", F.col("images") == F.col("captions")).withColumn("views", F.col("images") * F.col("repeats"))


def caption_twins(files: DataFrame) -> DataFrame:
    """(folder, name) of pictures that have a caption file of the same stem beside them."""
    s = stem(F.col("name"))
    twins = files.where(suffix(F.col("name")) == ".txt").select("folder", s.alias("stem_")).distinct()
    pictures = files.where(suffix(F.col("name")) != ".txt").withColumn("stem_", s)
    return pictures.join(twins, ["folder", "stem_"], "left_semi").select("folder", "name")
