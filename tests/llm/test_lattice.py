import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import lattice as L


def brute(rows, threshold=0.98):
    """rows: (id, vector, label) with unique ids; {id: (n_links, component)}."""
    sound = {}
    for i, v, lab in rows:
        if v is not None and lab is not None and None not in v and len(v):
            x = np.array(v, dtype=float)
            if np.isfinite(x).all() and x.any():
                sound[i] = (x / np.linalg.norm(x), lab)
    root, n = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sound)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (x, p), (y, q) = sound[a], sound[b]
            if p == q and len(x) == len(y) and x @ y >= threshold:
                n[a] += 1
                n[b] += 1
                r, s = find(a), find(b)
                root[max(r, s)] = min(r, s)
    return {i: (n[i], find(i)) for i in root}


def sample(rng, n, dim=64):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(max(0, len(rows) - 40), len(rows))][1])
            if rng.random() < 0.7:
                w = rng.normal(size=dim)
                v = v / np.linalg.norm(v) + w / np.linalg.norm(w) * rng.choice([0.05, 0.12, 0.2, 0.3])
        else:
            v = rng.normal(size=dim)
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(0, 3))))
    return rows


def test_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * 2
    c = L.nearest_e8(x)
    assert (np.isclose(c, np.rint(c)).all(axis=1) | np.isclose(c - 0.5, np.rint(c - 0.5)).all(axis=1)).all()
    assert np.allclose(c.sum(axis=1) % 2, 0)
    best = ((x - c) ** 2).sum(axis=1)
    for v in L.minimal_vectors():  # the Voronoi cell of E8 is bounded by vectors of norm 2 and 4
        assert (best <= ((x - c - v) ** 2).sum(axis=1) + 1e-9).all()
        assert np.isclose((v**2).sum(), 2)


@pytest.mark.parametrize("plan,block", [(None, 2048), *((p, 8) for p in L.PLANS)])
def test_against_brute_force(spark, plan, block):
    rows = sample(np.random.default_rng(5), 260)
    base = rows[0][1]
    rows += [(1000 + i, base, rows[0][2]) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * 64, 1), (2002, [float("nan")] * 64, 1), (2003, [None] * 64, 1), (2004, base, None), (2005, [float("inf")] + [1.0] * 63, 1), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (2009, [-0.0, 2.0], 1), (2010, [0.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("class", F.lit(1)).withColumn("vector", F.lit(2))
    out = L.near_duplicates(df, plan=plan, block=block).collect()
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert len(out) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in out)
    wrong = [i for i in want if got[i] != want[i]]
    assert not wrong, [(i, got[i], want[i]) for i in wrong][:5]


def cells_of(hasher, x):
    row, name = hasher.cells(x)
    out = [set() for _ in x]
    for r, c in zip(row.tolist(), name.tolist()):
        assert c not in out[r]
        out[r].add(c)
    return out


@pytest.mark.parametrize("dim", [16, 64, 256])
@pytest.mark.parametrize("plan", L.PLANS)
def test_recall_of_each_plan_at_the_threshold(plan, dim):
    """Against brute force: of pairs whose cosine is 0.98 exactly, the hardest there are."""
    rng = np.random.default_rng(1)
    a, w = (L.units(rng.normal(size=(2000, dim))) for _ in "aw")
    w = L.units(w - (w * a).sum(axis=1, keepdims=True) * a)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * w
    hasher = L.LatticeHash(dim, *plan)
    met = [bool(p & q) for p, q in zip(cells_of(hasher, a), cells_of(hasher, b))]
    assert np.mean(met) >= 0.997


def test_plans_get_finer_and_cost_is_what_meets():
    x = L.units(np.random.default_rng(3).normal(size=(400, 64)))
    costs = [L.LatticeHash(64, *p).cost(x, 0.98) for p in L.PLANS]
    assert costs == sorted(costs, reverse=True)
    own = cells_of(L.LatticeHash(64, *L.PLANS[1]), x)
    assert np.isclose(costs[1], np.mean([len(own[i] & own[j]) for i in range(400) for j in range(i)]))


def test_biased_vectors_get_a_finer_plan(spark):
    rng = np.random.default_rng(4)
    rows = lambda shift: [(i, (rng.normal(size=64) + shift).tolist(), 1) for i in range(1500)]
    chosen = []
    for shift in (0.0, 1.5):
        df = spark.createDataFrame(rows(shift), "vec_id long, embedding array<float>, label int")
        classes = L.usable(df, "vec_id", "embedding", "label").withColumn("class", F.col("vec_id"))
        chosen.append(L.PLANS.index(L.plan_for(classes, 64, "1", 1500, 0.98, 400)))
    assert chosen[0] < chosen[1]


def test_doubles_are_compared_as_doubles(spark):
    v = np.zeros(8)
    v[0] = 1.0
    w = np.array([0.98, np.sqrt(1 - 0.98**2), 0, 0, 0, 0, 0, 0])
    below = w + np.array([0, 1e-9, 0, 0, 0, 0, 0, 0])
    df = spark.createDataFrame([(1, (3 * v).tolist(), 1), (2, (w * (1 + 1e-12)).tolist(), 1), (3, below.tolist(), 1)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in L.near_duplicates(df).collect()}
    want = {i: sum(1 for b in (v, w, below) if (a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)) >= 0.98) - 1 for i, a in ((1, v), (2, w), (3, below))}
    assert got[3] == want[3] == 1 and got[2] == want[2] and got[1] == want[1]


def test_empty_and_unusable(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert L.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    out = L.near_duplicates(spark.createDataFrame([(1, None, 1), (None, [1.0], None)], schema)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in out] == [(1, 0, 1, True), (None, 0, None, False)]
    out = L.near_duplicates(spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], schema)).collect()
    assert sorted([(r.vec_id or 0, r.n_links, r.component_id) for r in out]) == [(0, 2, 4), (4, 2, 4), (4, 2, 4)]


@pytest.mark.parametrize("dim", [1, 2, 8, 64, 256, 1200])
def test_shadows_of_links_are_within_reach(dim):
    """Exact for every pair: random ones, the spread of one coordinate, and vectors that lie in the frame itself."""
    rng = np.random.default_rng(6)
    hasher = L.LatticeHash(dim, *L.PLANS[0])
    a, w = (L.units(rng.normal(size=(400, dim))) for _ in "aw")
    a[:50], a[50:100] = np.eye(dim)[rng.integers(0, dim, 50)], L.units(hasher.frame.T[rng.integers(0, hasher.frame.shape[1], 50)])
    w = w - (w * a).sum(axis=1, keepdims=True) * a
    w[50:100] = hasher.frame.T[rng.integers(0, hasher.frame.shape[1], 50)]  # apart within the frame
    b = np.array([L.units((0.98 * p + np.sqrt(1 - 0.98**2) * q / max(np.linalg.norm(q), 1e-9))[None])[0] for p, q in zip(a, w)])
    linked = np.einsum("ij,ij->i", a, b) >= 0.98
    apart = ((hasher.shadows(a).astype(float) - hasher.shadows(b)) ** 2).sum(axis=1)
    assert linked.any() and (apart[linked] <= hasher.reach(0.98)).all()
    if dim >= 64:
        far = ((hasher.shadows(a).astype(float)[:200, None] - hasher.shadows(a)[None, 200:]) ** 2).sum(axis=2)
        assert (far[100:] > hasher.reach(0.98)).mean() > 0.99


def test_vectors_without_a_near_one_do_not_travel(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=64).tolist(), "a" if i % 2 else "b") for i in range(600)]
    rows += [(600 + i, (np.array(rows[i][1]) * 2 + rng.normal(size=64) * 0.01).tolist(), rows[i][2]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    marks = [F.xxhash64("label", "vector").alias("mark_a"), F.col("vec_id").alias("class"), F.lit(1).cast("long").alias("weight")]
    classes = L.usable(df, "vec_id", "embedding", "label").select("*", *marks)
    for block in (2048, 16):
        stays = L._stays(classes, L.LatticeHash(64, *L.PLANS[0]), 0.98, block).join(classes, F.col("mark") == F.col("mark_a")).groupBy("vec_id").count().collect()
        ids = {r.vec_id for r in stays}
        assert ids >= {*range(20), *range(600, 620)} and len(ids) < 80
