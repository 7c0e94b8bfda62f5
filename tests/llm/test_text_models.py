import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import langid, quality, subwords

SF = "/root/testdata/sf0.01"


def test_ngrams_against_plain_code():
    texts = ["Ab, c", "", "é1x"]
    grams, first, letters = subwords.features(texts, (3,), 1 << 16)
    (at, bucket), = grams
    flat = "".join(f" {''.join(c if c.isalpha() else ' ' for c in t.lower())} " for t in texts)
    want = [flat[i : i + 3] for i in range(len(flat) - 2) if flat[i + 1].isalpha()]
    assert [flat[i : i + 3] for i in at.tolist()] == want and letters.tolist() == [3, 0, 2]
    assert len(set(bucket.tolist())) == len(set(want)) and first.tolist() == [0, 7, 9]


def test_characters_above_the_first_plane(spark):
    texts = ["😀😀 🎉", "𝄞 🀄", "𐐀𐐁 😀", "a 😀", "\U000f0000"]
    grams, first, letters = subwords.features(texts, (3,), 1 << 16)
    assert letters.tolist() == [sum(map(str.isalpha, t)) for t in texts] == [0, 0, 2, 1, 0]
    assert np.unique(np.searchsorted(first, grams[0][0], "right") - 1).tolist() == [2, 3]
    docs = spark.createDataFrame([(1, "the and of", "en", "s"), (2, "les des une", "fr", "s"), (3, "😀😀 🎉", "en", "s")], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in langid.identify(docs, langid.fit(docs, hold=0.0)).collect()}
    assert (out[3].lang_pred, out[3].score, out[3].accepted) == ("und", 0.0, False)
    graded = quality.grade(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")).toPandas().set_index("doc_id")
    assert graded.text_score[3] < 0.01 and not graded.keep[3]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    out = langid.identify(docs, model).withColumn("held", langid.held_out("doc_id")).toPandas()
    assert len(out) == docs.count()
    assert out.held.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]
    held = out[out.held]
    assert (held.lang_pred == held.lang).mean() > 0.96
    assert out.score.between(0, 1).all() and out.accepted.mean() > 0.99
    again = langid.identify(docs, langid.fit(docs)).toPandas()
    assert again.sort_values("doc_id").score.tolist() == out.sort_values("doc_id").score.tolist()


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(1, "the and of", "en", "s"), (2, None, "en", None), (None, "1234 !!", None, "s"), (4, "", "fr", "s"), (6, "les des une", "fr", "s"), (6, "les des une", "fr", "s")], "doc_id long, text string, lang string, SCORE string")
    model = langid.fit(docs, hold=0.0)
    out = [(r.doc_id, r.lang_pred, r.accepted) for r in langid.identify(docs, model).collect()]
    assert [x for x in out if x[0] in (2, None, 4)] == [(2, "und", False), (None, "und", False), (4, "und", False)]
    assert all(x[1] in model.classes for x in out if x[0] in (1, 6))
    assert langid.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
    assert langid.identify(docs, model).columns == ["doc_id", "text", "lang", "lang_pred", "score", "accepted"]


def test_rejection_is_calibrated():
    rng = np.random.default_rng(0)
    words = {"a": ["alpha", "beta", "gamma"], "b": ["uno", "dos", "tres"]}
    texts, labels = zip(*[(" ".join(rng.choice(words[k], 8)), k) for k in "ab" * 100])
    model = subwords.train(list(texts), list(labels))
    p, _ = model.probabilities(["alpha beta", "uno tres", "zzzz qqqq"])
    assert p[0].argmax() == 0 and p[1].argmax() == 1 and p[:2].max(axis=1).min() > 0.8
    assert p[2].max() < p[:2].max(axis=1).min() and 0 < model.reject_below <= 0.545 + 1e-9


def plain_judge(model, text):
    """(probabilities, letters, familiarity) with loops over n-grams."""
    low = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    total, known, count = np.zeros(len(model.classes)), 0.0, 0
    for n in model.orders:
        for i in range(len(low) - n + 1):
            gram = low[i : i + n]
            if " " in gram[1:-1]:
                continue
            h = n
            for k, c in enumerate(gram):
                h = (h ^ ord(c)) * int(subwords._MULTIPLY[k % 5]) % (1 << 32)
                h ^= h >> 15
            b = h % len(model.table)
            total, known, count = total + model.table[b], known + model.familiar[b], count + 1
    z = (total / max(count, 1) + model.bias) / model.temperature
    e = np.exp(z - z.max())
    return e / e.sum(), sum(map(str.isalpha, text.lower())), known / max(count, 1)


def test_predictions_against_plain_code(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs)
    texts = [r.text for r in docs.limit(12).collect()] + ["", "1 2", "Ünï çødé", "kq7xz vbnwq", "Все люди", "🙂 a", "x" * 5000]
    got = langid.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for t, r in zip(texts, got):
        p, letters, known = plain_judge(model, t)
        want = model.classes[int(p.argmax())] if letters else "und"
        assert r.lang_pred == want and abs(r.score - (p.max() if letters else 0)) < 1e-6
        bound = max([-np.inf] + [b for n, b in zip(subwords.PIECES, model.bounds) if n <= letters])
        assert r.accepted == bool(letters and p.max() >= model.reject_below and known >= bound)


def test_temperature_lies_inside_its_range(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    assert subwords.TEMPERATURES[0] < model.temperature < subwords.TEMPERATURES[-1]
    p, _, accepted = model.judge(list(OTHER.values()))
    assert p.max() < 0.6 and not accepted.any()


def test_every_language_is_learned_and_bytes_are_bounded(spark):
    rows = [(i, " ".join([f"w{i % 400}q" * 3, chr(97 + i % 26) * 9, "abc"]), f"l{i % 400}", "s") for i in range(1200)] + [(5000 + i, "long " * 4000, "long", "s") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    known = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert len(known) > 256
    for most in (64 << 20, 50_000):
        assert set(langid.fit(df, max_bytes=most, epochs=0, buckets=256, hold=0.0).classes) == known


OTHER = {
    "Italian": "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita",
    "Finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki",
    "Turkish": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar, akıl ve vicdana sahiptirler",
    "Japanese": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Russian": "Все люди рождаются свободными и равными в своем достоинстве и правах",
    "keys": "kq7xz vbnwq zzkpt qwxjv plokm wsxzq yhnbg tgbvf rfvcd edcxs qazpl mkonj",
}


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    rows = [t for x in OTHER.values() for t in (x, " ".join([x] * 20))]
    assert not langid.identify(spark.createDataFrame([(x,) for x in rows], "text string"), model).toPandas().accepted.any()
    held = docs.where(langid.held_out("doc_id")).toPandas()
    for n in (3, 6, 12, 50):
        pieces = [" ".join(t.split()[:n]) for t in held.text if t]
        _, letters, accepted = model.judge(pieces)
        assert accepted[letters > 0].mean() > 0.98
    by = {k: " ".join(g.text.head(3)) for k, g in held.groupby("lang")}
    mixed = [by[a][:1000] + " " + by[b][:1000] for a in by for b in by if a < b]
    assert model.judge(mixed)[2].all()


def plain_grade(p, e, site, path):
    """The same posterior with loops; returns {row: quality}."""
    n, k = len(p), sum(e)
    overall = min(max(k / n, quality.EDGE), 1 - quality.EDGE)
    sums = lambda keys: {g: (sum(1 for x in keys if x == g), sum(v for x, v in zip(keys, e) if x == g)) for g in set(keys)}

    def strength(groups, centre):
        total = sum(m for m, _ in groups.values())
        if not total or len(groups) < 2:
            return quality.STRENGTH[1]
        between = sum(m * (s / m - centre(g)) ** 2 for g, (m, s) in groups.items())
        within = sum(m * centre(g) * (1 - centre(g)) for g, (m, _) in groups.items()) / total
        spread = (between - (len(groups) - 1) * within) / max(total - sum(m * m for m, _ in groups.values()) / total, 1e-9)
        return float(np.clip(within / spread - 1, *quality.STRENGTH)) if spread > 0 else quality.STRENGTH[1]

    sites, paths = sums(site), sums(list(zip(site, path)))
    a = strength(sites, lambda g: overall)
    shrunk = lambda s: (sites[s][1] + a * overall) / (sites[s][0] + a)
    b = strength(paths, lambda g: shrunk(g[0]))
    bound = lambda x: min(max(x, quality.EDGE), 1 - quality.EDGE)
    out = []
    for i in range(n):
        m, s = sites[site[i]]
        r = bound((s - e[i] + a * overall) / (m - 1 + a))
        m, s = paths[site[i], path[i]]
        r = bound((s - e[i] + b * r) / (m - 1 + b))
        z = np.log(p[i] / (1 - p[i])) + np.log(r / (1 - r))
        out.append(1 / (1 + np.exp(-z)))
    return out


def test_quality_against_plain_code(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = quality.labelled(labels)
    model = quality.fit(docs, known)
    got = quality.grade(docs, labels, model=model).toPandas().set_index("doc_id").sort_index()
    table = docs.toPandas().set_index("doc_id").sort_index()
    label = {r.label_id: r.label for r in known.collect()}
    p = got.text_score.tolist()
    e = [label.get(i, x) for i, x in zip(table.index, p)]
    want = plain_grade(p, e, table.source.tolist(), table.lang.tolist())
    assert np.allclose(got.quality, want, atol=1e-9)
    truth = labels.toPandas().drop_duplicates("doc_id").set_index("doc_id").quality
    both = got.loc[truth.index]
    assert (both.keep == (truth == 1)).mean() > 0.98
    assert both[truth == 1].keep.mean() > 0.99


def test_quality_of_hosts_and_paths(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    url = F.concat(F.lit("https://h"), F.col("doc_id") % 7, F.lit(".org/p"), F.floor(F.col("doc_id") / 7) % 3, F.lit("/x"))
    docs = docs.withColumn("host", F.regexp_extract(url, "//([^/]+)", 1)).withColumn("path", F.regexp_extract(url, "//[^/]+/([^/]+)", 1)).drop("source", "lang")
    known = quality.labelled(labels)
    got = quality.grade(docs, labels, site_col="host", path_col="path", model=quality.fit(docs, known)).toPandas().set_index("doc_id").sort_index()
    table = docs.toPandas().set_index("doc_id").sort_index()
    assert table.host.nunique() == 7 and table.path.nunique() == 3
    label, p = {r.label_id: r.label for r in known.collect()}, got.text_score.tolist()
    want = plain_grade(p, [label.get(i, x) for i, x in zip(table.index, p)], table.host.tolist(), table.path.tolist())
    assert np.allclose(got.quality, want, atol=1e-9)


def test_hosts_and_paths_of_urls(spark):
    cases = [("https://WWW.Ex.com/Blog/2024/post.html?q=/a/", "ex.com", "blog"), ("http://ex.com/post", "ex.com", ""), ("http://ex.com", "ex.com", ""), ("http://ex.com//a//b/c", "ex.com", "a"), ("no url", None, None), (None, None, None)]
    got = spark.createDataFrame(cases, "u string, h string, p string").select(quality.host_of(F.col("u")), quality.path_of(F.col("u")), "h", "p", quality.path_of(F.col("u"), 2)).collect()
    assert all(r[0] == r[2] and r[1] == r[3] for r in got) and got[0][4] == "blog/2024"


def test_quality_from_urls_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    url = F.concat(F.lit("https://h"), F.col("doc_id") % 7, F.lit(".org/p"), F.floor(F.col("doc_id") / 7) % 3, F.lit("/x.html"))
    docs = docs.select("doc_id", "text", url.alias("url"), F.lit("clash").alias("site"), F.lit("clash").alias("p"), F.lit("clash").alias("label"))
    learned = labels.where("crc32(cast(doc_id as string)) % 4 <> 0")
    got = quality.grade(docs, learned, url_col="url").toPandas().set_index("doc_id")
    held = labels.where("crc32(cast(doc_id as string)) % 4 = 0").toPandas().drop_duplicates("doc_id").set_index("doc_id").quality
    assert len(held) > 50 and (got.loc[held.index].keep == (held == 1)).mean() > 0.95
    assert got.loc[held.index][held == 1].keep.mean() > 0.97


def test_one_very_long_text_counts_whole(spark):
    rows = [(1, "fine words here and there " * 200_000 + "JUNK$$$ " * 20, "a", "x"), (2, "JUNK$$$ JUNK$$$ JUNK$$$", "a", "x"), (3, "fine words here and there", "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = quality.grade(docs, spark.createDataFrame([(2, 0), (3, 1)], "doc_id long, quality int")).toPandas().set_index("doc_id")
    assert len(got) == 3 and got.text_score[1] > got.text_score[2]


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, "some fine words", "a", "x"), (2, None, None, None), (None, "", "a", None), (3, "!!! ???", "a", "x"), (1, "some fine words", "a", "x")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, None), (3, 0), (None, 1)], "doc_id long, quality int")
    out = quality.grade(docs, labels).toPandas()
    assert len(out) == 5 and out.quality.between(0, 1).all()
    assert not out[out.doc_id == 2].keep.any()
    assert quality.grade(docs.limit(0), labels).count() == 0
    half = quality.grade(docs, labels.limit(0)).toPandas()
    assert (half.text_score == 0.5).all()


@pytest.mark.parametrize("spread", [0.0, 0.2])
def test_sparse_sites_are_shrunk(spark, spread):
    rng = np.random.default_rng(1)
    rows = [(f"s{g}", n, float(rng.binomial(n, min(0.95, max(0.05, 0.5 + spread * rng.normal()))))) for g in range(200) for n in [int(rng.integers(5, 400))]]
    got = quality.strength(spark.createDataFrame(rows, "site string, n long, k double"), "n", "k", F.lit(0.5))
    assert got >= 100 if spread == 0 else got < 20
