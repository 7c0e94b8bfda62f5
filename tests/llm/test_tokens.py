import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sievewright.llm import packing as P
from sievewright.llm import token_counts as C
from sievewright.llm import token_orc as O
from sievewright.llm.tokens import PieceEncoder, tokenizer_path

ODD = ["", "a  b", "a  \nb \n\n c", "<|endoftext|> x", "x²³ 1½", "日本語 テスト", "  lead", "it's we'll 'tis  ''s", "tab\t\tx\r\n y", " x   y\x1cz", "a_b__c 12ab3", "émentªº µ", "\n", "\n\n", " ", "a​b ﬁn", "word " * 3000, "x" * 20_000, "don't’s 3.14e-10", "퟿\U0001f600 é"]
DOCS = [(5, "the quick brown fox\njumps over"), (3, None), (9, ""), (7, "lazy dog " * 900), (7, "lazy dog " * 900), (None, "no id"), (1, "\n\n"), (2, "Éa ç\n" * 40)]


def library(texts):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode_batch(texts, add_special_tokens=False)


def corpus():
    return pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()


def test_ids_equal_the_library():
    texts = ODD + corpus()
    own = PieceEncoder(tokenizer_path(), capacity=3000)  # small: it is emptied on the way
    assert own.split
    got = [x for i in range(0, len(texts), 16) for x in own.ids(texts[i : i + 16])]
    assert got == [np.array(e.ids, dtype="<u4").tobytes() for e in library(texts)]


def test_new_pieces_ask_the_model_alone():
    letters = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028), 0x20AC)]
    own = PieceEncoder(tokenizer_path(), capacity=50)
    texts = [t for t in [*letters, "".join(letters[32:127]), " ".join(letters[192:]), *ODD, *corpus()[:60]] if own._splits(t)]
    assert len(texts) > 600
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in library(texts)]
    own.tokenizer = own.encode = None  # an encoding with spans and words costs twice what the ids do
    assert own.ids(texts) == want and own.ids(texts[::-1]) == want[::-1]
    assert len(own.known) <= 50


def test_spans_equal_the_library():
    texts = ODD + corpus()[:80]
    own = PieceEncoder(tokenizer_path(), spans=True)
    for e, got in zip(library(texts), own.token_spans(texts)):
        assert np.array_equal(np.array(e.offsets).reshape(-1, 2), got)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_files_go_whole(name):
    own = PieceEncoder(tokenizer_path(name))
    assert not own.split
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(tokenizer_path(name)).encode_batch(["Hello world"], add_special_tokens=False)[0].ids
    assert own.ids(["Hello world"]) == [np.array(want, dtype="<u4").tobytes()]


def test_level_choice_is_the_sum_of_squares_rule():
    rng = np.random.default_rng(0)
    packer = P.LevelPacker(64)
    for _ in range(2000):
        size = int(rng.integers(1, 64))
        n = packer.count.copy()
        got = packer.level_for(size)

        def after(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + size < 64:
                m[h + size] += 1
            return int((m**2).sum())

        open_levels = [0] + [h for h in range(1, 65 - size) if n[h]]
        assert got in open_levels and after(got) == min(map(after, open_levels))
        packer.put((0, 0, size), size)


@pytest.mark.parametrize("window,partitions", [(2048, 1), (32, 3)])
def test_pieces_cover_every_id_once(spark, window, partitions):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(partitions)
    rows = P.pack(df, window=window).collect()
    ids = {}
    for (k, t), e in zip(DOCS, library([t or "" for _, t in DOCS])):
        ids.setdefault(k, []).append(np.array(e.ids + [1], dtype="<u4"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        want = ids[r.doc_id][0]
        assert r.doc_tokens == len(want)
        assert r.ids_crc32 == zlib.crc32(want[r.start : r.start + r.length].tobytes())
    for k, own in by_doc.items():
        assert sum(r.length for r in own) == sum(map(len, ids[k]))
        assert {i for r in own for i in range(r.start, r.start + r.length)} == set(range(len(ids[k][0])))
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and at & (at - 1) == 0 or at == window
    assert P.pack(df.limit(0)).count() == 0


def test_open_windows_are_bounded():
    packer, full = P.LevelPacker(100, max_open=10), []
    for i in range(1000):
        full += packer.put((i, 0, 60), 60)
        assert packer.open <= 11
    assert all(sum(x[2] for x in held) == 100 for held in full)
    rest = packer.drain()
    assert sum(x[2] for held in full for x in held) + sum(x[2] for x in rest) == 60_000


def plain_packing(sizes, window):
    """The rule with one level after another tried, then the emptiest open windows cut into the gaps of the fullest.

    Returns (windows that the rule filled, windows that the end filled, the window left), each of (item, start, length).
    """
    open_, full = [], []
    for i, size in enumerate(sizes):
        count = Counter(sum(x[2] for x in w) for w in open_)

        def squares(h):
            after = count.copy()
            if h:
                after[h] -= 1
            if h + size < window:
                after[h + size] += 1
            return sum(n * n for n in after.values())

        best = min([h for h in count if h + size <= window] + [0], key=lambda h: (squares(h), -h))
        held = next((w for w in reversed(open_) if best and sum(x[2] for x in w) == best), None)
        if held is None:
            held = []
        else:
            open_.remove(held)
        held.append((i, 0, size))
        (full if best + size == window else open_).append(held)
    open_.sort(key=lambda w: -sum(x[2] for x in w))
    closed = []
    while len(open_) > 1:
        room = window - sum(x[2] for x in open_[0])
        while room and len(open_) > 1:
            i, start, n = open_[-1].pop()
            open_[0].append((i, start, min(n, room)))
            if n > room:
                open_[-1].append((i, start + room, n - room))
            room = max(0, room - n)
            if not open_[-1]:
                open_.pop()
        if not room:
            closed.append(open_.pop(0))
    return full, closed, open_[0] if open_ else []


@pytest.mark.parametrize("window", [20, 64])
def test_whole_packing_against_plain_code(window):
    sizes = np.random.default_rng(3).integers(1, window, 400).tolist()
    packer, got = P.LevelPacker(window), []
    for i, size in enumerate(sizes):
        got += packer.put((i, 0, size), size)
    full, rest = packer.close()
    want = plain_packing(sizes, window)
    assert got == want[0] and full == want[1] and rest == want[2] and packer.open == 0
    assert all(sum(x[2] for x in w) == window for w in got + full)


def test_one_task_packs_as_plain_code(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("text_", F.lit(1)).coalesce(1)
    rows = P.pack(df, window=32).toPandas()
    sizes = [len(e.ids) + 1 for e in library([t or "" for _, t in DOCS])]
    full, closed, rest = plain_packing([n % 32 for n in sizes if n % 32], 32)
    rests = [k for (k, _), n in zip(DOCS, sizes) if n % 32]
    want = sorted([sorted((str(rests[i]), n) for i, _, n in w) for w in full + closed])
    whole = rows.groupby("sequence_id").filter(lambda g: len(g) > 1 and g.length.sum() == 32)
    assert sorted(sorted((str(None if np.isnan(k) else int(k)), n) for k, n in zip(g.doc_id, g.length)) for _, g in whole.groupby("sequence_id")) == [w for w in want if len(w) > 1]
    tail = rows.groupby("sequence_id").length.sum()
    assert sum(tail[tail < 32]) == sum(x[2] for x in rest)


@pytest.mark.parametrize("tasks", [1, 8, 32])
def test_most_windows_come_from_the_rule(tasks):
    text = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    sizes = [len(x) // 4 + 1 for x in PieceEncoder(tokenizer_path()).ids([t or "" for t in text])]
    ruled = whole = 0
    for k in range(tasks):
        packer, full = P.LevelPacker(), []
        for i, n in enumerate(sizes[k::tasks]):
            if n % 2048:
                full += packer.put((i, 0, n % 2048), n % 2048)
        opened = packer.open
        closed, rest = packer.close()
        # a window of the rule stays one unless it was cut up to fill others
        ruled += len(full) + sum(sum(x[2] for x in w if x[1] == 0) > 1024 for w in closed)
        whole += len(full) + len(closed)
        assert len(closed) + bool(rest) <= opened
    assert ruled > 0.7 * whole


def test_orc_round_trip(spark, tmp_path):
    from pyarrow import orc

    df = spark.createDataFrame([d for d in DOCS if d != DOCS[4]], "doc_id long, text string")
    path = O.write_tokens(df, str(tmp_path / "t"))
    got = {r.doc_id: r for r in O.token_index(spark, path).collect()}
    at = 0
    for k, t in sorted((d for d in DOCS if d != DOCS[4]), key=lambda d: (d[0] is not None, d[0])):
        want = np.array(library([t or ""])[0].ids + [2], dtype="<u4")
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)
    files = sorted((tmp_path / "t").glob("shard=*/*.orc"))
    assert files and all(orc.ORCFile(str(f)).compression.lower() != "uncompressed" for f in files)
    assert all(orc.ORCFile(str(f)).schema.names == ["doc_id", "shard_start", "n_tokens", "ids"] for f in files)
    # a Bloom filter costs bytes in the row index
    bare = O.read_tokens(spark, path).coalesce(1)
    bare.write.option("orc.compress", "ZSTD").orc(str(tmp_path / "bare"))
    assert sum(f.stat().st_size for f in files) > 0 and bare.count() == len(got)
    one = O.read_tokens(spark, path).where("doc_id = 9")
    assert "EqualTo(doc_id,9)" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1
    assert O.round_trip(df.limit(0)).count() == 0


def test_orc_repeated_ids_long_texts_and_other_columns(spark):
    rows = [*DOCS, (7, "a", ), (7, None), (4, "long " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).withColumn("ids", F.lit(1)).repartition(3)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in O.round_trip(df).collect())
    at, want = 0, []
    for k, t in sorted(rows, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        ids = np.array(library([t or ""])[0].ids + [2], dtype="<u4")
        want.append((at, k, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_each_shard_has_its_task(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") * 3).alias("doc_id"), F.lit("some text").alias("text")).repartition(6)
    O.write_tokens(df, str(tmp_path / "t"))
    rows = O.read_tokens(spark, str(tmp_path / "t")).select("shard", F.input_file_name().alias("f")).groupBy("shard").agg(F.count_distinct("f").alias("files"), F.count("*").alias("n")).collect()
    assert len(rows) == 4 and {r.files for r in rows} == {1} and max(r.n for r in rows) < 1.2 * min(r.n for r in rows)


def test_shards_ascend(spark, tmp_path):
    import random

    ids = list(range(0, 3000, 3))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i, f"t {i}") for i in ids], "doc_id long, text string").repartition(5)
    rows = O.read_tokens(spark, O.write_tokens(df, str(tmp_path / "s"))).groupBy("shard").agg({"doc_id": "min", "*": "count"}).orderBy("shard").collect()
    assert len(rows) > 2 and [r[1] for r in rows] == sorted(r[1] for r in rows)
    start = {r.doc_id: (r.start, r.n_tokens) for r in O.token_index(spark, str(tmp_path / "s")).collect()}
    at = 0
    for i in sorted(ids):
        assert start[i][0] == at
        at += start[i][1]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 50])
def test_shard_search(spark, n):
    from bisect import bisect_left

    from pyspark.sql import functions as F

    bounds = sorted({(k * k * 7) % 211 for k in range(n)})
    got = spark.range(-3, 220).select("id", O.shard_of(F.col("id"), bounds)).collect()
    assert all(r[1] == bisect_left(bounds, r[0]) for r in got)
    assert spark.sql("select cast(null as long) x").select(O.shard_of(F.col("x"), bounds)).first()[0] == 0


def test_token_counts_of_odd_rows(spark):
    rows = [(None, "a\nb"), (1, None), (1, None), (2, "long words " * 30_000), (None, "a\nb")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("section", F.lit("clash")).withColumn("sizes", F.lit(1))
    out = C.count_tokens(df).toPandas()
    assert out.columns.tolist() == ["doc_id", "field", "section", "start", "length", "n_tokens"]
    assert (out.doc_id.isna().sum(), (out.doc_id == 1).sum(), out[out.doc_id == 1].n_tokens.sum()) == (4, 2, 0)
    assert out[out.doc_id == 2].n_tokens.tolist() == [len(library([rows[3][1]])[0].ids)]
    assert C.count_tokens(df.limit(0)).count() == 0


@pytest.mark.parametrize("rule", C.RULES)
@pytest.mark.parametrize("by_line", [True, False])
def test_attribution_against_plain_code(spark, rule, by_line):
    texts = [(i, t, h) for i, (t, h) in enumerate([(None, "h"), ("", None), ("a\n\n b c\n", "head line"), ("one two\nthree", "x\ny"), *((t, "t") for t in ODD)])]
    df = spark.createDataFrame(texts, "doc_id long, text string, head string")
    got = {}
    for r in C.count_tokens(df, fields=("head", "text"), by_line=by_line, rule=rule).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t, h in texts:
        joined = f"{h or ''}\n{t or ''}"
        marks = []
        base = 0
        for name, value in (("head", h or ""), ("text", t or "")):
            cuts = [0] + [k + 1 for k, c in enumerate(value) if c == "\n" and k + 1 < len(value)] if by_line else [0]
            marks += [(name, n, base + c) for n, c in enumerate(cuts)]
            base += len(value) + 1
        own = sorted(got[i], key=lambda r: (r.field != "head", r.section))
        assert [(r.field, r.section, r.start) for r in own] == marks
        starts = [m[2] for m in marks]
        ends = starts[1:] + [len(joined)]
        want = [0.0] * len(marks)
        for a, b in library([joined])[0].offsets:
            share = [max(0, min(b, e) - max(a, s)) for s, e in zip(starts, ends)]
            if rule == "share":
                want = [w + x / (b - a) for w, x in zip(want, share)]
            elif rule == "majority":
                want[share.index(max(share))] += 1
            else:
                want[[k for k, (s, e) in enumerate(zip(starts, ends)) if s <= a < e][0]] += 1
        assert np.allclose([r.n_tokens for r in own], want)
        assert [r.length for r in own] == [e - s for s, e in zip(starts, ends)]
