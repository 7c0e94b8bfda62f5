import os
import zlib

from pyspark.sql import functions as F

import corpus_pipeline as P
from sievewright.llm import common, mixing, simhash
from tests.llm.test_lines_and_mix import plain_dedup

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_code(spark):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in P.STAGES:
        after, _ = common.cut(stage(spark, docs, SF), f"test-{name}")
        seen[name] = (docs.toPandas(), after.toPandas())
        docs = after
    before, after = seen["language_id"]
    assert len(after) > 0.97 * len(before) and after.columns.tolist() == columns
    before, after = (x.sort_values("doc_id") for x in seen["line_dedup"])
    want = plain_dedup(list(zip(before.source, before.text)), 0.08, 5)
    assert after.text.tolist() == want and after.n_chars.tolist() == [len(t) for t in want]
    before, after = seen["simhash_near_dedup"]
    fp = {i: simhash.fingerprint(t) for i, t in zip(before.doc_id, before.text)}
    root = {i: i for i in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in fp:
        for j in fp:
            if i < j and (fp[i] ^ fp[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(after.doc_id) == sorted({find(i) for i in fp})
    before, after = seen["mixing"]
    count = after.doc_id.value_counts()
    assert count.max() <= 2 and set(count.index) <= set(before.doc_id) and after.columns.tolist() == columns
    before, after = seen["packing"]
    assert after[after.start == 0].doc_id.value_counts().sort_index().equals(before.doc_id.value_counts().sort_index())
    fill = after.groupby("sequence_id").length.sum()
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill)
    assert P.run(spark, SF).count() == len(after)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (2, "A B C D E", "en", "s", 9), (None, "a b c d e", "en", "s", 9), (None, "quite another text", None, None, None), (None, "quite another text", None, None, None), (5, None, "en", "s", 0), (6, "", "en", "s", 0)]
    docs, _ = common.cut(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "odd")
    got = [(r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, "a b c d e"), (None, "quite another text"), (5, None)], key=str)


def test_near_duplicates_of_repeated_ids(spark):
    rows = [(7, "a b c d e", "en", "s", 9), (7, "quite another text of words", "fr", "t", 27), (7, "quite another text of words", "fr", "t", 27), (3, "led by three and no other", "en", "s", 25), (7, "led by three and no other", "en", "s", 25), (9, "A B C D E", "en", "s", 9), (8, "", "en", "s", 0), (8, None, "en", "s", 0), (8, "eight words that nobody else has ever said", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    want = sorted([(7, "a b c d e"), (7, "quite another text of words"), (3, "led by three and no other"), (8, None), (8, "eight words that nobody else has ever said")], key=str)
    for n in (1, 4):
        docs, _ = common.cut(spark.createDataFrame(rows, schema).repartition(n), "repeated")
        assert sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SF).collect()), key=str) == want


def test_nothing_learned_drops_only_texts_without_letters(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = ["ab cd", "1234 !!", "😀", "", None, "日本", "𐐀", "x"]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    for lang in (None, "en"):
        docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, t in zip(held, texts)], schema)
        assert sorted(r.text for r in P.language_id(spark, docs, SF).collect()) == sorted(["ab cd", "日本", "𐐀", "x"])
    learned = [i for i in range(200) if i not in held]
    few = [("the and of", "en"), ("les des une", "fr"), ("der die das", "de"), ("los las una", "es"), ("mno pqr", None), ("12", None)]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in zip(learned, few)], schema)
    assert sorted(r.text for r in P.language_id(spark, docs, SF).collect()) == sorted(t for t, _ in few[:-1])


def test_other_columns_of_any_name_stay(spark):
    names = ["lang_pred", "SCORE", "accepted_", "dropped", "keep_id", "again_id", "fp", "row", "key_k", "id_f", "led_text", "copies", "size", "hot_site"]
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(7_000_000, "same words here", "en", "s", 1), (7_000_000, "other words there", "en", "s", 1), (None, "no id", None, None, None), (None, "no id", None, None, None), (7_000_001, None, None, None, None)], base.schema)
    docs, _ = common.cut(base.unionByName(odd).select("*", *[F.concat(F.lit(f"{n}/"), F.coalesce("text", F.lit("none"))).alias(n) for n in names]), "clash")
    for name, stage in P.STAGES[:-1]:
        before = {r.text for r in docs.collect()}
        docs, _ = common.cut(stage(spark, docs, SF), f"clash-{name}")
        assert docs.columns == [*base.columns, *names]
        rows = docs.collect()
        assert rows and all(r[n].startswith(f"{n}/") for r in rows for n in names)
        if name != "line_dedup":
            assert {r.text for r in rows} <= before and all(r[n] == f"{n}/{r.text if r.text is not None else 'none'}" for r in rows for n in names)
    assert P.pack(spark, docs, SF).count() >= len(rows)


def test_a_run_leaves_only_what_is_read(spark):
    root = common.scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    P.run(spark, SF)
    assert {x.split("-")[0] + "-" + x.split("-")[1] for x in set(os.listdir(root)) - before} == {"stage-mixing"}


def test_no_documents(spark):
    docs, _ = common.cut(spark.read.parquet(f"{SF}/documents.parquet").limit(0), "none")
    for name, stage in P.STAGES:
        docs, _ = common.cut(stage(spark, docs, SF), f"none-{name}")
        assert docs.count() == 0
    assert mixing.TOTAL == 1.5
