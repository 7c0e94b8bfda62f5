"""Quality by hierarchical empirical Bayes (operator 5).

A document classifier (linear over averaged hashed shape n-grams, fitted on a
bounded labelled sample) gives each document a log-likelihood ratio.  Where a
document comes from gives it a prior: the rate of good documents of its path,
shrunk to that of its site, shrunk to that of the corpus.  The rates count a
label where there is one and the classifier's probability elsewhere, over all
documents, by grouped sums; how strongly a level pulls is estimated from the
spread between the groups (method of moments), so sparse sites lie near the
corpus and large ones near their own rate.  A document's own share is taken out
of its site's and path's sums before they judge it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import cut
from sievewright.llm.line_dedup import host_of
from sievewright.llm.subwords import SubwordModel, train
from sievewright.llm.tokens import text_slices

#: Bounds of a level's strength, in documents.
STRENGTH = (1.0, 1000.0)
#: A text of so many letters counts half its evidence: an average over few n-grams is a rough one.
HALF_LETTERS = 64
#: Classifier probabilities stay this far from 0 and 1, so that a single text never outweighs everything.
EDGE = 1e-4


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(label_id, label): one row for each id, the mean of its non-null labels rounded to 0 or 1 (a tie is 1)."""
    return labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("double").alias("label")).where("label_id is not null and label is not null").groupBy("label_id").agg(F.when(F.avg("label") >= 0.5, 1.0).otherwise(0.0).alias("label"))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = 1500, **options) -> SubwordModel | None:
    """Fit the classifier on about ``per_class`` labelled documents of each class, those of least hash.

    ``labels`` is what :func:`labelled` returns.  The sample of ids has at most
    about twice ``per_class`` rows, and only its texts come to the driver.  None if
    no label meets a text.
    """
    sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if not sizes:
        return None
    space = 1 << 40
    ticket = F.shiftrightunsigned(F.xxhash64("label_id", F.lit("quality-sample")), 24)
    drawn = F.lit(False)
    for label, n in sizes.items():
        drawn = drawn | ((F.col("label") == label) & (ticket < int(space * min(1.0, per_class / n))))
    ids = labels.where(drawn).limit(2 * per_class * len(sizes))
    texts = df.select(F.col(id_col).cast("long").alias("id_"), F.col(text_col).cast("string").alias("text_")).where("text_ is not null").join(F.broadcast(ids), F.col("id_") == F.col("label_id"))
    sample = texts.select("id_", "text_", "label").limit(4 * per_class * len(sizes)).toArrow().sort_by([("id_", "ascending"), ("text_", "ascending")])
    if not sample.num_rows:
        return None
    return train(sample.column("text_").to_pylist(), [f"{x:.0f}" for x in sample.column("label").to_pylist()], **{"orders": (2, 3), "buckets": 4096, "view": "shape"} | options)


def logit(p: Column) -> Column:
    return F.log(p) - F.log(1 - p)


def evidence(df: DataFrame, model: SubwordModel | None, id_col: str, text_col: str, site: Column, path: Column) -> DataFrame:
    """(doc_id, site, path, p): the probability that the whole text is good, short texts drawn towards a half.

    A half without a model; near 0 for a text without letters.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, texts in text_slices(batch.column(3), 1 << 20):
                p = np.full(len(texts), 0.5)
                if own is not None and "1" in own.classes:
                    probability, letters = own.probabilities(texts)
                    p = np.clip(probability[:, own.classes.index("1")], EDGE, 1 - EDGE)
                    z = np.log(p / (1 - p)) * letters / (letters + HALF_LETTERS)
                    p = np.where(letters > 0, 1 / (1 + np.exp(-z)), EDGE)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, len(texts)) for i in range(3)), pa.array(p)], ["doc_id", "site", "path", "p"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(site.cast("string"), F.lit("")).alias("site"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, site string, path string, p double")


def strength(groups: DataFrame, n: str, k: str, centre: Column) -> float:
    """Documents' worth of the level above, from the spread of the groups' rates around ``centre`` (one row comes back)."""
    rate = F.col(k) / F.col(n)
    r = groups.select(F.sum(F.col(n) * (rate - centre) ** 2).alias("between"), F.sum(n).alias("n"), F.sum(F.col(n).cast("double") * F.col(n)).alias("nn"), F.count("*").alias("g"), F.sum(F.col(n) * centre * (1 - centre)).alias("within")).first()
    if not r["n"] or r["g"] < 2:
        return STRENGTH[1]
    binomial = r["within"] / r["n"]
    spread = (r["between"] - (r["g"] - 1) * binomial) / max(r["n"] - r["nn"] / r["n"], 1e-9)
    return float(np.clip(binomial / spread - 1, *STRENGTH)) if spread > 0 else STRENGTH[1]


def path_of(url: Column, depth: int = 1) -> Column:
    """The first ``depth`` folders of a URL's path, lower case, without the document's own name; '' at the root, null if there is no URL."""
    path = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    folders = F.filter(F.split(F.regexp_replace(path, "[^/]*$", ""), "/"), lambda x: x != "")
    return F.when(host_of(url).isNotNull(), F.array_join(F.slice(folders, 1, depth), "/"))


def grade(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", path_col: str = "lang", keep_above: float = 0.5, model: SubwordModel | None = None, url_col: str | None = None) -> DataFrame:
    """(doc_id, text_score, site_rate, path_rate, quality, keep) for each row.

    With ``url_col``, the site is the URL's host and the path its first folder.
    Without, two columns stand for them; the defaults are what ``documents`` has:
    its source for the site, its language for a part of the site.  A text counts
    whole, however long.  ``labels`` has (doc_id, quality); ids without a row there
    are unlabelled.  Only the named columns are read, so others may have any name.
    ``text_score`` is the classifier's probability; ``site_rate`` and ``path_rate``
    are the shrunken rates of good documents without the row itself; ``quality`` is
    the posterior, and ``keep`` whether it is at least ``keep_above``.  Texts that
    are null or have no letter are no evidence of quality and score near 0; null
    sites and paths are one group each; repeated rows count one by one; without any
    label the classifier says a half of everything.  An empty table gives no rows.
    """
    known = labelled(labels)
    model = model or fit(df, known, id_col, text_col)
    site, path = (host_of(F.col(url_col)), path_of(F.col(url_col))) if url_col else (F.col(site_col), F.col(path_col))
    scored, _ = cut(evidence(df, model, id_col, text_col, site, path), "evidence")
    seen = scored.join(known, F.col("doc_id") == F.col("label_id"), "left").select("doc_id", "site", "path", "p", F.coalesce("label", "p").alias("e"))
    paths, _ = cut(seen.groupBy("site", "path").agg(F.count("*").alias("n_path"), F.sum("e").alias("k_path")), "path-sums")
    sites = paths.groupBy("site").agg(F.sum("n_path").alias("n_site"), F.sum("k_path").alias("k_site"))
    total = sites.agg(F.sum("n_site").alias("n"), F.sum("k_site").alias("k")).first()
    n, k = total["n"] or 0, total["k"] or 0.0
    overall = float(np.clip(k / n if n else 0.5, EDGE, 1 - EDGE))
    pull = strength(sites, "n_site", "k_site", F.lit(overall))
    shrunk = (F.col("k_site") + pull * overall) / (F.col("n_site") + pull)
    both = paths.join(sites.withColumnRenamed("site", "site_"), F.col("site") == F.col("site_")).select("site", "path", "n_path", "k_path", "n_site", "k_site")
    pull_path = strength(both, "n_path", "k_path", shrunk)
    groups = both.withColumnsRenamed({"site": "site_", "path": "path_"})
    own = F.col("e")
    site_rate = (F.col("k_site") - own + pull * overall) / (F.col("n_site") - 1 + pull)
    path_rate = (F.col("k_path") - own + pull_path * F.col("site_rate")) / (F.col("n_path") - 1 + pull_path)
    bounded = lambda c: F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), c))
    out = seen.join(groups, (F.col("site") == F.col("site_")) & (F.col("path") == F.col("path_"))).withColumn("site_rate", bounded(site_rate)).withColumn("path_rate", bounded(path_rate))
    # the classifier learned from classes in equal shares, so its log odds are the evidence alone
    posterior = 1 / (1 + F.exp(-(logit(F.col("p")) + logit(F.col("path_rate")))))
    return out.select("doc_id", F.col("p").alias("text_score"), "site_rate", "path_rate", posterior.alias("quality")).withColumn("keep", F.col("quality") >= keep_above)
