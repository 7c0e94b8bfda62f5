import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import simhash as S
from sievewright.llm.components import components


def brute(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint_against_plain_code():
    import re

    import xxhash

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << k for k in range(64) if h and 2 * sum(x >> k & 1 for x in h) > len(h))

    for text in ("", " \n", "one", "A b\tc", "É a b c d É a b c d\x0bx", "word " * 900, "x y z\x1cw q r s t"):
        assert S.fingerprint(text) == plain(text), text


def test_native_hash_agrees(spark):
    import xxhash

    got = spark.sql("select xxhash64('a b c d')").first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 2000, dtype=np.uint64) for _ in "ab")
    even = np.uint64(S.EVEN)
    counts = [(x & even) + ((x >> np.uint64(1)) & even) for x in (a, b)]
    got = S.manhattan(*counts)
    for x, y, d in zip(a.tolist(), b.tolist(), got.tolist()):
        assert d == sum(abs((x >> s & 3).bit_count() - (y >> s & 3).bit_count()) for s in range(0, 64, 2))
        assert d <= (x ^ y).bit_count()


@pytest.mark.parametrize("n,block", [(10, 4096), (10, 16), (10**9, 4096)])
def test_link_finds_every_component(spark, n, block):
    rng = np.random.default_rng(7)
    fps = set(rng.integers(-(2**63), 2**63 - 1, 300).tolist())
    for f in list(fps)[:60]:  # chains and dense groups
        for _ in range(8):
            for bit in rng.integers(0, 63, rng.integers(1, 5)).tolist():
                f ^= 1 << bit
            fps.add(f)
    fps = sorted(fps)
    u = np.array(fps, dtype=np.int64).view(np.uint64)
    pairs = [(fps[i], fps[j]) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= 4) + i + 1]
    edges = S.link(spark.createDataFrame([(f,) for f in fps], "fp long"), n, 4, block)
    got = {r.node: r.root for r in components(edges).collect()}
    want = brute(pairs, fps)
    linked = {x for p in pairs for x in p}
    assert got == {k: v for k, v in want.items() if k in linked}


def test_components_edge_cases(spark):
    schema = "a long, b long"
    assert components(spark.createDataFrame([], schema)).count() == 0
    assert components(spark.createDataFrame([(1, 1), (None, 2), (3, None)], schema)).count() == 0
    chain = [(i, i + 1) for i in range(60)] + [(60, 59), (100, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, schema)).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_near_duplicates_whole_operator(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base.upper()), (9, base + " tail"), (7, "other words entirely here now"), (8, None), (2, ""), (None, base), (None, "alone with no id at all"), (7, "other words entirely here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    got = [(r.doc_id, r.component_id) for r in S.near_duplicates(df).collect()]
    near = bin(S.fingerprint(base) ^ S.fingerprint(base + " tail")).count("1") <= 4
    assert sorted(got, key=str) == sorted([(5, 3), (3, 3), (9, 3 if near else 9), (7, 7), (7, 7), (8, 2), (2, 2), (None, 3), (None, None)], key=str)
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_pair_blocks_meet_once(spark):
    from sievewright.llm.buckets import deal, pairs_by_offset, whole_runs

    rows = spark.range(50).select(F.lit(1).alias("k"), (F.col("id")).alias("v")).union(spark.range(3).select(F.lit(2), F.col("id") + 100))
    t = deal(rows, ["k"], F.xxhash64("v"), 7).toArrow()
    seen = []
    for part, run in whole_runs(iter(t.to_batches()), 1):
        v = part.column("v").to_numpy()
        own = part.column("block_own").to_numpy()
        split = part.column("block_a").to_numpy() != part.column("block_b").to_numpy()
        for i, j in pairs_by_offset(run, own, split):
            seen += [tuple(sorted(p)) for p in zip(v[i].tolist(), v[j].tolist())]
    assert sorted(seen) == sorted([(a, b) for a in range(50) for b in range(a + 1, 50)] + [(100, 101), (100, 102), (101, 102)])
