"""Language identification (operator 10).

Averaged hashed subword embeddings with a linear softmax, trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows, with a calibrated
rejection score.  Prediction is one Arrow pass without a shuffle; every text is
read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import cut, discard
from sievewright.llm.subwords import SubwordModel, train
from sievewright.llm.tokens import text_slices

UNDETERMINED = "und"
FOLDS = 5


def held_out(id_col: str) -> Column:
    """True where crc32 of the id's text is 0 modulo 5; also for a null id, which no fold can claim."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 1000, max_bytes: int = 64 << 20, **options) -> SubwordModel | None:
    """Train on about ``per_language`` rows of every language, and at most about ``max_bytes`` of text.

    The rows are those of least hash, so the sample is the same on every run; the
    counts that set its rate read no text.  Where the sampled texts are longer than
    ``max_bytes``, all languages are thinned alike, but each keeps a row.  Only
    texts with non-null ``lang`` outside the held-out fold take part; ids and
    sources choose nothing and are no input.  None if there is no such row.
    """
    spark = df.sparkSession
    known = df.select(F.col(id_col).alias("id_"), F.col(text_col).cast("string").alias("text_"), F.col(lang_col).cast("string").alias("lang_")).where(F.col("lang_").isNotNull() & ~held_out("id_"))
    rates, rates_path = cut(known.groupBy(F.col("lang_").alias("of_")).agg(F.least(F.lit(1.0), F.lit(float(per_language)) / F.count("*")).alias("rate_")), "language-rates")
    # 40 bits of a hash as a number from 0 to 1; rows that repeat id and text share it, so the limit bounds those
    ticket = F.shiftrightunsigned(F.xxhash64("id_", "text_", F.lit("language-sample")), 24) / F.lit(float(1 << 40))
    drawn = known.where("text_ is not null").withColumn("ticket_", ticket).join(rates, F.col("lang_") == F.col("of_")).where("ticket_ < rate_").limit(2 * per_language * max(1, rates.count()))
    drawn, path = cut(drawn.select("id_", "text_", "lang_", "ticket_", "rate_"), "language-sample")
    held = drawn.agg(F.sum(F.octet_length("text_")).alias("bytes")).first()["bytes"]
    share = min(1.0, max_bytes / max(1, held or 0))
    least = drawn.groupBy(F.col("lang_").alias("of_")).agg(F.min("ticket_").alias("least_"))
    kept = drawn.join(least, F.col("lang_") == F.col("of_")).where((F.col("ticket_") < F.col("rate_") * F.lit(share)) | (F.col("ticket_") == F.col("least_")))
    order = kept.select("id_", "text_", "lang_").toArrow().sort_by([("id_", "ascending"), ("text_", "ascending")])
    for done in (path, rates_path):
        discard(spark, done)
    if not order.num_rows:
        return None
    return train(order.column("text_").to_pylist(), order.column("lang_").to_pylist(), **options)


def identify(df: DataFrame, model: SubwordModel | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", accepted_col: str = "accepted") -> DataFrame:
    """``df`` with three more columns, which replace columns of the same names.

    ``lang_pred`` is the likeliest learned language (of equal ones the first by name), or ``und`` if the text is null
    or has no letter (or if nothing was learned); ``score`` is its calibrated
    probability, 0 for ``und``; ``accepted`` is false for ``und``, where the score
    is below the model's rejection score, and where the text's n-grams are less
    familiar than those of held-back texts of its length.  Rows are kept, repeated ones too;
    an empty table stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c.lower() not in {x.lower() for x in (lang_col, score_col, accepted_col)}]
    text = kept.index(next(c for c in kept if c.lower() == text_col.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, texts in text_slices(batch.column(text), 1 << 20):
                n = len(texts)
                lang, score, accepted = [UNDETERMINED] * n, np.zeros(n), np.zeros(n, dtype=bool)
                if own is not None:
                    p, letters, accepted = own.judge(texts)
                    known = letters > 0
                    best = p.argmax(axis=1)
                    lang = [own.classes[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
                    score = np.where(known, p[np.arange(n), best], 0.0)
                yield pa.RecordBatch.from_arrays([*batch.slice(at, n).columns, pa.array(lang), pa.array(score), pa.array(accepted)], names=[*kept, lang_col, score_col, accepted_col])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    schema = StructType(df.select(*[F.col(f"`{c}`") for c in kept]).schema.fields).add(lang_col, StringType()).add(score_col, DoubleType()).add(accepted_col, BooleanType())
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
