from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sievewright.llm import line_dedup as L
from sievewright.llm import mixing as M


def plain_dedup(rows, ratio, least):
    """rows: (site, text); returns the texts."""
    pages, seen = Counter(s for s, _ in rows), Counter()
    for s, t in rows:
        seen.update((s, x) for x in {x.strip(" ") for x in (t or "").split("\n")} if x)
    gone = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in gone) for s, t in rows]


def test_lines_against_plain_code(spark):
    rows = [("a", f"Menu\nbody {i}\n\nMenu\n  Footer {i % 2} ") for i in range(12)] + [("b", "Menu\nother"), ("b", None), (None, ""), *[(None, "Menu\nx y")] * 6, ("c", "long " * 5000 + "\nMenu")]
    df = spark.createDataFrame([(i, s, t, "k") for i, (s, t) in enumerate(rows)], "page_id long, host string, text string, lines string").withColumn("site", F.lit(1)).withColumn("boilerplate_site", F.lit(2))
    out = L.drop_boilerplate(df, "host", max_ratio=0.4, min_pages=5, kept_col="kept", dropped_col="dropped")
    assert out.columns == [*df.columns, "dropped", "kept"]
    got = {r.page_id: r for r in out.collect()}
    want = plain_dedup(rows, 0.4, 5)
    assert [got[i].text for i in range(len(rows))] == want
    assert got[0].dropped == 3 and got[0].kept == 2 and got[13].kept == 0
    assert L.drop_boilerplate(df.limit(0), "host").count() == 0


def test_one_hot_site(spark, monkeypatch):
    """A site with most pages is dealt by content: no broadcast, and no join by that site alone."""
    monkeypatch.setattr(L, "HOT_SITES", 3)
    rows = [("hot", f"Menu\nbody {i}\nline {i % 7}") for i in range(60)] + [(f"s{i % 9}", f"Top\nown {i}") for i in range(30)] + [(None, f"N\n{i}") for i in range(8)]
    df = spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(rows)], "host string, text string, kept long").withColumn("hot_lines", F.lit("clash"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.drop_boilerplate(df, "host", max_ratio=0.2, min_pages=3, dropped_col="kept").withColumn("place", F.spark_partition_id())
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert out.columns == ["host", "text", "hot_lines", "kept", "place"]
    assert sorted(r.text for r in got) == sorted(plain_dedup(rows, 0.2, 3))
    found = {r.site: r.hot for r in L.boilerplate(df, "host", "text", 0.2, 3).collect()}
    assert found["hot"] and not found[None] and not any(found[f"s{i}"] for i in range(9))


def test_no_python_in_line_dedup(spark):
    df = spark.createDataFrame([("a", "x")], "host string, text string")
    plan = L.drop_boilerplate(df, "host")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_hosts_and_html(spark):
    cases = [("https://WWW.Ex.com:80/a?b", "ex.com"), ("http://u:p@h.org#x", "h.org"), ("no url", None), (None, None), ("ftp://m.a.b/", "m.a.b")]
    got = spark.createDataFrame(cases, "u string, w string").select(L.host_of(F.col("u")), "w").collect()
    assert all(a == b for a, b in got)
    html = "<html><head><title>t</title></head><body><!-- <p>no</p> --><script>var t='</p>';</script><nav><li>One</li><li>Two &amp;&nbsp;more</li></nav><P class=x>Text <b>bold</b>.<br/>Next</P></body></html>"
    got = spark.createDataFrame([(html,), (None,), ("plain",)], "h string").select(L.html_lines(F.col("h"))).collect()
    assert [r[0] for r in got] == ["One\nTwo & more\nText bold.\nNext", "", "plain"]


def plain_targets(sizes):
    """Reshare until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, target, active = 1.5 * sum(sizes.values()), {}, set(order)
    while active:
        total = sum(weight[s] for s in active)
        above = {s for s in active if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            target.update({s: left * weight[s] / total for s in active})
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        active -= above
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10, None: 7}, {"x": 0, "y": 5, "z": 100}, {"é": 3, "Z": 900, "a": 4, "b": 80, "c": 1}, {"one": 4}, {"n": 0}, {"s": 3, "t": 4, None: 2}])
def test_targets_against_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_mix_meets_targets_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    runs = [M.mix(docs.repartition(n), columns=["doc_id", "source"]).toPandas().sort_values("doc_id").reset_index(drop=True) for n in (1, 5)]
    assert runs[0].equals(runs[1])
    out = runs[0]
    assert len(out) == 1000 and out.copies.between(0, 2).all()
    size = {s: int(g["size"].sum()) for s, g in out.groupby("source")}
    target = plain_targets(size)
    for s, g in out.groupby("source"):
        assert (g.source_size == size[s]).all() and abs(g.target.iloc[0] - target[s]) < 1e-6
        assert abs((g.copies * g["size"]).sum() - target[s]) <= g["size"].max()  # one document
    assert M.emit(M.mix(docs), columns=["doc_id"]).count() == out.copies.sum()


def test_mix_edge_cases(spark):
    rows = [(1, "a b", None), (2, None, "s"), (3, "", "s"), (None, "x\ty\x0bz", "s"), (4, "one", "t"), (4, "one", "t"), (5, "é\x1fü ç", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("Copies", F.lit(0))
    out = M.mix(df)
    assert out.columns == [*df.columns, "size_", "source_size", "target", "copies_"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append((r["size_"], r["source_size"], r["copies_"]))
    assert [x[:2] for x in got[2] + got[3] + got[None] + got[1]] == [(0, 3), (0, 3), (3, 3), (2, 2)]
    assert len(got[4]) == 2 and got[5][0][0] == 2
    assert M.mix(df.limit(0)).count() == 0
    assert M.emit(out, "copies_", ["doc_id"]).count() == sum(c for v in got.values() for *_, c in v)


def test_one_hot_size(spark, monkeypatch):
    """Many documents of one size and source: longer prefixes split them, and the ranks stay the same."""
    monkeypatch.setattr(M, "PART_ROWS", 1)
    assert [M.prefix_digits(n) for n in (0, 256, 257, 4096, 4097)] == [2, 2, 3, 3, 4]
    df = spark.createDataFrame([(i, "w", "a") for i in range(500)] + [(1000 + i, "x y", "b") for i in range(300)], "doc_id long, text string, source string")
    fine = sorted((r.doc_id, r.copies) for r in M.mix(df, columns=["doc_id"]).collect())
    monkeypatch.setattr(M, "PART_ROWS", 1_000_000)
    assert fine == sorted((r.doc_id, r.copies) for r in M.mix(df, columns=["doc_id"]).collect())


def test_rows_of_one_id_are_drawn_alike_on_each_run(spark):
    df = spark.createDataFrame([(7, f"t{i} u", "s") for i in range(40)] + [(i, "a b c", "t") for i in range(40)], "doc_id long, text string, source string")
    runs = [sorted((r.text, r.doc_id, r.copies) for r in M.mix(df.repartition(n)).collect()) for n in (1, 7)]
    assert runs[0] == runs[1]


def test_a_source_without_words_takes_nothing(spark):
    df = spark.createDataFrame([(i, "", "empty") for i in range(5)] + [(9, "w", "full")], "doc_id long, text string, source string")
    assert {r.source: r.copies for r in M.mix(df).where("source = 'empty'").collect()} == {"empty": 0}
