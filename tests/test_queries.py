"""Every query with an oracle against DuckDB on the smallest tables, and the contract's form."""

import math

import pytest

import __spark_entry__ as entry
from sievewright.plans import tables
from sievewright.plans.queries import ORACLE_SQL, QUERIES
from tests.test_operators import greedy

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.select(*sorted(df.columns)).collect()
    res = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    want = [tuple(plain(r[i]) for i in order) for r in res.fetchall()]
    assert sorted(map(repr, want)) == sorted(repr(tuple(plain(v) for v in r)) for r in got)


def hashed(spark):
    return {r.vec_id: r.h for r in tables.hashes(spark, SF).collect()}


def test_near_dup_greedy_is_the_loop(spark):
    h = hashed(spark)
    got = {r.dup: r.keeper for r in QUERIES["near_dup_greedy"](spark, SF).collect()}
    assert got and got == greedy(sorted(h), lambda a, b: ((h[a] ^ h[b]) & ((1 << 64) - 1)).bit_count() <= 20)


def taken_in_turn(h, most):
    """{candidate: (local, distance)} of the loop, and each candidate's least distance to a local that is free."""
    free, out, least = {str(i) for i in h if i % 2 == 0}, {}, {}
    for c in sorted(i for i in h if i % 2):
        found = min((((h[c] ^ h[int(x)]) & ((1 << 64) - 1)).bit_count(), x) for x in free)
        least[c] = found[0]
        if found[0] <= most:
            out[c] = (found[1], found[0])
            free.discard(found[1])
    return out, least


def test_recover_nn_match_is_the_loop(spark):
    want, least = taken_in_turn(hashed(spark), 20)
    got = {r.seq: (r.local, r.distance) for r in QUERIES["recover_nn_match"](spark, SF).collect()}
    assert got and got == want
    row = QUERIES["nn_distance_buckets"](spark, SF).first()
    assert row.candidates == len(least) and [row[f"within_{s}"] for s in (18, 20, 22, 24)] == [sum(d <= s for d in least.values()) for s in (18, 20, 22, 24)]


def test_all_queries_are_tested():
    assert set(QUERIES) - set(ORACLE_SQL) == {"near_dup_greedy", "recover_nn_match", "nn_distance_buckets"}


def test_contract(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
