import random

import pytest
from pyspark.sql import functions as F

from sievewright.functions.bits import from_hex
from sievewright.operators import classes, discovery, duplicates, export, ingest, manifest, provenance, reports
from sievewright.plans import config
from sievewright.plans.commands import _conform
from sievewright.schema import RECORD


def recs(spark, rows):
    """Records from dicts; what is missing is its default."""
    full = [{"filename": "a.jpg", "source": "local", **r} for r in rows]
    return _conform(spark.createDataFrame([[r.get(c) for c in RECORD.names] for r in full], RECORD))


def as_dict(df, key="filename"):
    return {r[key]: r.asDict() for r in df.collect()}


# Manifest


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "m.jsonl")
    df = recs(spark, [{"filename": "b.jpg", "license": "CC0", "categories": ["x"], "width": 5, "rejected": True, "reject_reasons": ["manual"]}, {"filename": "a.jpg", "sharpness": 1.5}])
    manifest.save(df, path)
    first = open(path, encoding="utf-8").read()
    assert [line.split('"')[3] for line in first.splitlines()] == ["a.jpg", "b.jpg"] and "null" not in first and '"categories":[]' in first
    manifest.save(manifest.load(spark, path), path)
    assert open(path, encoding="utf-8").read() == first
    assert manifest.load(spark, path).schema.names == RECORD.names
    assert manifest.load(spark, str(tmp_path / "none")).count() == 0


def test_manifest_skips_corrupt_lines_and_the_last_wins(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"filename":"a.jpg","source":"s","license":"old"}\n\n{ this is no json\n{"filename":"b.jpg","source":"s","klass":"nonsense"}\n{"filename":"c.jpg","source":"s","reject_reasons":["what"]}\n{"filename":"a.jpg","source":"s","license":"new"}\n', encoding="utf-8")
    got = as_dict(manifest.load(spark, str(path)))
    assert list(got) == ["a.jpg"] and got["a.jpg"]["license"] == "new" and got["a.jpg"]["klass"] == "_unclassified"
    assert manifest.corrupt_lines(spark.read.text(str(path))).count() == 3


def test_a_save_that_was_cut_off(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    manifest.save(recs(spark, [{"filename": "a.jpg"}]), str(path))
    path.rename(tmp_path / "m.jsonl.previous")  # between the two renames
    assert list(as_dict(manifest.load(spark, str(path)))) == ["a.jpg"] and path.exists()
    manifest.save(recs(spark, [{"filename": "b.jpg"}]), str(path))
    assert list(as_dict(manifest.load(spark, str(path)))) == ["b.jpg"] and sorted(x.name for x in tmp_path.iterdir() if not x.name.startswith(".")) == ["m.jsonl"]


def test_files_of_a_manifest_go_by_name(spark, tmp_path):
    (tmp_path / "m").mkdir()
    line = lambda license_, pad: f'{{"filename":"a.jpg","source":"s","license":"{license_}","description":"{"x" * pad}"}}\n'
    for k, (license_, pad) in enumerate([("first", 5000), ("second", 10), ("last", 300)]):
        (tmp_path / "m" / f"part-{k}.json").write_text(line(license_, pad))
    assert as_dict(manifest.load(spark, str(tmp_path / "m")))["a.jpg"]["license"] == "last"


def test_upsert_and_indexes(spark):
    old = recs(spark, [{"filename": "a", "sha256": "1", "phash": "ff", "download_url": "u"}, {"filename": "b", "sha256": "", "phash": "ff"}, {"filename": "c", "rejected": True}])
    new = manifest.upsert(old, recs(spark, [{"filename": "b", "license": "CC0"}, {"filename": "d"}]))
    assert sorted(as_dict(new)) == ["a", "b", "c", "d"] and as_dict(new)["b"]["license"] == "CC0"
    assert tuple(manifest.index_sizes(old).first()) == (1, 1, 1)
    assert [tuple(r) for r in manifest.known_phash(old).collect()] == [("ff", "b")]
    assert [r.filename for r in manifest.active(old).collect()] == ["a", "b"]
    assert manifest.known_sha256(old).count() == 1 and manifest.known_urls(old).count() == 1


def test_provenance_needs_license_and_title(spark):
    df = recs(spark, [{"filename": "a", "license": "CC0", "origin_title": "t"}, {"filename": "b", "origin_title": "t"}, {"filename": "c", "license": "CC0", "origin_title": ""}])
    assert [r[0] for r in df.orderBy("filename").select(manifest.provenance(df)).collect()] == [True, False, False]


def test_manual_verdicts(spark):
    df = recs(spark, [{"filename": "a"}, {"filename": "b", "rejected": True, "reject_reasons": ["blurry"]}, {"filename": "c", "rejected": True, "reject_reasons": ["manual"]}])
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("x",), ("a",)], "filename string")
    got = as_dict(manifest.mark_manually(df, names, "nota"))
    assert {k: v["status"] for k, v in got.items()} == {"a": "newly", "b": "reinforced", "c": "noop", "x": "missing"}
    assert got["b"]["reject_reasons"] == ["blurry", "manual"] and got["a"]["needs_review"] == ["nota"] and got["a"]["rejected"]
    back = as_dict(manifest.restore_manually(manifest.upsert(df, manifest.mark_manually(df, names).where("status <> 'missing'").select(*df.columns)), names))
    assert {k: v["status"] for k, v in back.items()} == {"a": "restored", "b": "still_rejected", "c": "restored", "x": "missing"}
    assert back["b"]["reject_reasons"] == ["blurry"] and not back["a"]["rejected"]


# Duplicates


def greedy(order, near):
    kept, out = [], {}
    for x in order:
        hit = next((k for k in kept if near(k, x)), None)
        if hit is None:
            kept.append(x)
        else:
            out[x] = hit
    return out


@pytest.mark.parametrize("seed", range(3))
def test_greedy_against_the_loop(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(40))
    edges = {(a, b) for a in nodes for b in nodes if a < b and rng.random() < 0.07}
    got = {r.dup: r.keeper for r in duplicates.greedy_duplicates(spark.createDataFrame(sorted(edges), "a int, b int")).collect()}
    assert got == greedy(nodes, lambda a, b: (a, b) in edges)
    for most in (0, 10):  # in rounds to the end, or for some of the way
        assert got == {r.dup: r.keeper for r in duplicates.greedy_duplicates(spark.createDataFrame(sorted(edges), "a int, b int"), in_turn=most).collect()}


def test_find_duplicates(spark):
    rows = [(0, "a", "1", "ffffffffffffffff"), (1, "b", "1", "ffffffffffffffff"), (2, "c", "2", "fffffffffffffffe"), (3, "d", "3", "0000000000000000"), (4, "e", None, None), (5, "f", "", None)]
    df = spark.createDataFrame(rows, "ord int, filename string, sha256 string, p string").withColumn("phash64", from_hex(F.col("p")))
    assert sorted(tuple(r) for r in duplicates.find_duplicates(df).collect()) == [(1, 0, "exact"), (2, 0, "near")]
    assert [tuple(r) for r in duplicates.exact_duplicates(df).collect()] == [("b", "a")]


@pytest.mark.parametrize("radius", [3, 20])
def test_near_duplicates_against_the_loop(spark, radius):
    rng = random.Random(radius)
    h = [rng.getrandbits(62) for _ in range(12)]
    for _ in range(60):
        x = rng.choice(h)
        for _ in range(rng.randrange(4)):
            x ^= 1 << rng.randrange(62)
        h.append(x)
    got = {r.dup: r.keeper for r in duplicates.near_duplicates(spark.createDataFrame(list(enumerate(h)), "o int, h long"), "o", "h", radius).collect()}
    assert got == greedy(range(len(h)), lambda a, b: (h[a] ^ h[b]).bit_count() <= radius)


@pytest.mark.parametrize("turn", [1, 7, 1000])
def test_near_duplicates_in_turns_make_no_pairs(spark, monkeypatch, turn):
    """A wide radius, at which most rows are near to each other: in rounds of kept rows, with the loop's keepers."""
    rng = random.Random(turn)
    h = [rng.getrandbits(63) for _ in range(50 if turn > 1 else 12)]
    h += [x ^ (1 << rng.randrange(63)) for x in h[:20]] + h[:5]
    rows = [(f"n{i:03d}", x) for i, x in enumerate(h)]
    monkeypatch.setattr(duplicates, "hamming_pairs", None)
    got = {r.dup: r.keeper for r in duplicates.near_duplicates(spark.createDataFrame(rows, "o string, h long"), "o", "h", 22, turn=turn).collect()}
    assert got == {f"n{a:03d}": f"n{b:03d}" for a, b in greedy(range(len(h)), lambda a, b: (h[a] ^ h[b]).bit_count() <= 22).items()}


@pytest.mark.parametrize("radius", [0, 3, 5, 20])
def test_hamming_pairs_against_all_pairs(spark, radius):
    rng = random.Random(radius)
    h = [rng.getrandbits(64) for _ in range(60)]
    h += [x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in h[:30]] + h[:3]
    rows = [(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(h)] + [(1000, None)]
    got = {(r.a, r.b): r.distance for r in duplicates.hamming_pairs(spark.createDataFrame(rows, "k int, h long"), "k", "h", radius).collect()}
    assert got == {(i, j): (h[i] ^ h[j]).bit_count() for i in range(len(h)) for j in range(i + 1, len(h)) if (h[i] ^ h[j]).bit_count() <= radius}


@pytest.mark.parametrize("radius,n", [(4, 10), (4, 10**7), (6, 10**6), (9, 10**8), (20, 10)])
def test_hamming_pairs_by_more_groups_and_split_buckets(spark, monkeypatch, radius, n):
    """The groups of a larger table, and buckets that are split whatever their size."""
    rng = random.Random(radius)
    base = rng.getrandbits(64)
    h = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(40):
        x = base
        for _ in range(rng.randrange(8)):
            x ^= 1 << rng.randrange(64)
        h.append(x)
    chosen = duplicates.grid(n, radius)
    assert radius != 4 or chosen == (2 if n > 10 else 1) or n == 10
    monkeypatch.setattr(duplicates, "grid", lambda *_: chosen)
    rows = [(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(h)]
    got = [tuple(r) for r in duplicates.hamming_pairs(spark.createDataFrame(rows, "k int, h long"), "k", "h", radius, block=7).collect()]
    assert sorted(got) == [(i, j, (h[i] ^ h[j]).bit_count()) for i in range(len(h)) for j in range(i + 1, len(h)) if (h[i] ^ h[j]).bit_count() <= radius]


@pytest.mark.parametrize("names", [False, True])
def test_all_pairs_by_blocks_in_arrays(spark, monkeypatch, names):
    """Where no choice of bits selects, rows are packed in blocks: none is sent to each pair of blocks by itself."""
    rng = random.Random(6)
    h = [rng.getrandbits(64) for _ in range(700)]
    h += h[:20]
    rows = [(f"é{i}" if names else i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(h)] + [(None, 1)]
    df = duplicates.hamming_pairs(spark.createDataFrame(rows, "k string, h long" if names else "k int, h long"), "k", "h", 22, block=20)
    assert "Join" not in df._jdf.queryExecution().toString()
    key = lambda i: rows[i][0]
    near = [(i, j, (h[i] ^ h[j]).bit_count()) for i in range(len(h)) for j in range(i + 1, len(h))]
    assert sorted(tuple(r) for r in df.collect()) == sorted((*sorted((key(i), key(j))), d) for i, j, d in near if d <= 22)
    sides = spark.createDataFrame(rows, "k string, h long" if names else "k int, h long")
    odd = F.col("h") % 2 != 0
    got = provenance.cross_distances(sides.where(odd).select(F.crc32(F.encode(F.col("k").cast("string"), "UTF-8")).alias("seq"), "h"), sides.where(~odd).select(F.col("k").alias("local"), "h"), 22)
    assert "MapInArrow" in got._jdf.queryExecution().toString()
    assert got.count() == sum(1 for i, j, d in near if d <= 22 and (h[i] ^ h[j]) & 1)


@pytest.mark.parametrize("seed", range(3))
def test_match_in_turn_against_the_loop(spark, seed):
    rng = random.Random(seed)
    edges = [(c, f"l{x:02d}", rng.randrange(6)) for c in range(25) for x in range(20) if rng.random() < 0.2]
    free, want = {f"l{x:02d}" for x in range(20)}, {}
    for c in range(25):
        best = min(((d, x) for s, x, d in edges if s == c and x in free), default=None)
        if best:
            want[c] = (best[1], best[0])
            free.discard(best[1])
    got = {r.seq: (r.local, r.distance) for r in duplicates.match_in_turn(spark.createDataFrame(edges, "seq int, local string, distance int")).collect()}
    assert got == want
    for most in (0, 10):
        assert want == {r.seq: (r.local, r.distance) for r in duplicates.match_in_turn(spark.createDataFrame(edges, "seq int, local string, distance int"), most).collect()}
    assert duplicates.match_in_turn(spark.createDataFrame([], "seq int, local string, distance int")).count() == 0


@pytest.mark.parametrize("most", [1, 9, 64, 500_000])
def test_match_by_lists_against_the_loop(spark, monkeypatch, most):
    """Lists that are cut and used up (many candidates of a few hashes), rounds of any length, and names in order of text."""
    rng = random.Random(most)
    base = [rng.getrandbits(63) for _ in range(4)]
    turned = lambda: rng.choice(base) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63) if rng.random() < 0.5 else 0)
    n = 8 if most == 1 else 30
    cand, loc = [(3 * i + 1, turned()) for i in range(n)] + [(1000, None)], [(str(i), turned()) for i in range(n)] + [("x", None)]
    free, want = dict(loc[:-1]), {}
    for c, h in cand[:-1]:
        d, name = min(((h ^ x).bit_count(), k) for k, x in free.items()) if free else (99, "")
        if d <= 20:
            want[c] = (name, d)
            del free[name]
    monkeypatch.setattr(duplicates, "hamming_pairs", None)
    monkeypatch.setattr(duplicates, "FREE", 7)
    frames = spark.createDataFrame(cand, "seq long, h long"), spark.createDataFrame(loc, "local string, h long")
    got = {r.seq: (r.local, r.distance) for r in duplicates.match_by_lists(*frames, 20, most).collect()}
    assert got == want
    assert most < 500_000 or got == {r.seq: (r.local, r.distance) for r in provenance.match_hashes(*frames, 20).collect()}


def test_distance_buckets_against_the_loop(spark):
    rng = random.Random(4)
    cand = [(i, rng.getrandbits(62)) for i in range(12)]
    loc = [(f"l{i}", cand[i][1] ^ rng.getrandbits(8)) for i in range(8)]
    match = [(i, f"l{i}") for i in range(0, 8, 2)]
    best = {}
    for i, h in cand:
        gone = {x for s, x in match if s < i}
        best[i] = min(((h ^ g).bit_count() for x, g in loc if x not in gone), default=None)
    got = duplicates.distance_buckets(spark.createDataFrame(cand, "seq int, h long"), spark.createDataFrame(loc, "local string, h long"), spark.createDataFrame(match, "seq int, local string")).first()
    assert got.candidates == len(best) and [got[f"within_{s}"] for s in (5, 8, 12, 16)] == [sum(d <= s for d in best.values()) for s in (5, 8, 12, 16)]


def test_distance_buckets_by_many_blocks(spark, monkeypatch):
    """Blocks of a few rows meet in arrays, not by a join of rows; rows without a hash, and candidates after all locals are taken."""
    rng = random.Random(5)
    cand = [(i, rng.getrandbits(63)) for i in range(40)] + [(40, None)]
    loc = [(f"l{i}", cand[rng.randrange(40)][1] ^ rng.getrandbits(20)) for i in range(30)]
    match = [(i, f"l{i}") for i in range(30)]
    packed = duplicates._packed
    monkeypatch.setattr(duplicates, "_packed", lambda rows, n, block: packed(rows, n, 1))
    best = {i: min((h ^ x).bit_count() for k, x in loc if int(k[1:]) >= i) for i, h in cand[:30]}
    for late in (False, True):
        frames = spark.createDataFrame(cand, "seq int, h long"), spark.createDataFrame(loc + [("none", None)] * late, "local string, h long"), spark.createDataFrame(match, "seq int, local string")
        df = duplicates.distance_buckets(*frames, (8, 16, 24))
        assert "MapInArrow" in df._jdf.queryExecution().toString() and "NestedLoop" not in df._jdf.queryExecution().toString()
        got = df.first()
        assert got.candidates == (41 if late else 30) and [got[f"within_{s}"] for s in (8, 16, 24)] == [sum(d <= s for d in best.values()) for s in (8, 16, 24)]


def test_exact_phash_claims(spark):
    df = spark.createDataFrame([(0, "aa"), (1, "aa"), (2, "bb"), (3, None), (4, ""), (5, "")], "o int, phash string")
    got = {r.o: r.phash_duplicate for r in duplicates.claim_exact_phash(df, spark.createDataFrame([("bb", "old")], "phash string, filename string"), F.col("o")).collect()}
    assert got == {0: False, 1: True, 2: True, 3: False, 4: False, 5: False}


# Discovery


def test_candidate_status_and_names(spark):
    old = recs(spark, [{"filename": "x.jpg", "download_url": "u0"}, {"filename": "y.jpg", "download_url": "u9"}])
    rows = [(0, "a.jpg", "u0", "CC0"), (1, "b.jpg", "u1", "GFDL"), (2, "b.jpg", "u1", "CC0"), (3, "c.jpg", "u1", "CC0"), (4, "d.jpg", "", "CC0"), (5, "b.jpg", "u2", "CC BY 4.0"), (6, "x.jpg", "u3", "CC0"), (7, "noext", "u4", "CC0"), (8, "noext", "u5", "CC0"), (9, "z.jpg", "u6", "UNKNOWN")]
    df = spark.createDataFrame(rows, "seq int, filename string, download_url string, license string")
    got = discovery.candidate_status(df, old)
    assert [r.status for r in got.orderBy("seq").collect()] == ["skipped_known", "skipped_license", "accepted", "skipped_known", "skipped_known", "accepted", "accepted", "accepted", "accepted", "skipped_license"]
    assert discovery.candidate_status(df, old, allow_unknown=True).where("seq = 9").first().status == "accepted"
    names = {r.seq: r.final_name for r in discovery.unique_filename(got.where("status = 'accepted'"), old).collect()}
    import hashlib

    sha = lambda u: hashlib.sha1(u.encode()).hexdigest()[:8]
    assert names == {2: "b.jpg", 5: f"b_{sha('u2')}.jpg", 6: f"x_{sha('u3')}.jpg", 7: "noext", 8: f"noext_{sha('u5')}"}
    assert {(r.kind, r.name): r.n for r in discovery.counters(got.withColumn("source", F.lit("s")).withColumn("klass", F.lit("k"))).collect()}[("status", "accepted")] == 5
    top = discovery.top_counts(df, F.col("license"), "seq", 2).collect()
    assert [tuple(r) for r in top] == [("CC0", 7), ("GFDL", 1)]
    assert discovery.anti_join_known(df, old).count() == 9 and discovery.limit_per_group(df, "license", F.col("seq"), 1).count() == 4


# Classes


@pytest.mark.parametrize(
    "cats,klass",
    [
        (["Sandstone", "Limestone", "Slag"], "01_real_estratos"),
        (["Slag"], "03_proxy_materiales"),
        (["anthropocene plastic sediment"], "02_real_plastiglomerado"),
        (["Sandstone", "Limestone", "Plastiglomerate"], "02_real_plastiglomerado"),
        (["Minerals", "Fluorite"], "_unclassified"),
        ([], "_unclassified"),
        (["Cats"], "_unclassified"),
        ([" slag ", "Sandstone"], "03_proxy_materiales"),
        (["Sandstone", " SLAG"], "01_real_estratos"),
    ],
)
def test_votes(spark, cats, klass):
    index = classes.group_index(classes.config_items(spark, config.DEFAULT))
    got = classes.classify_all(recs(spark, [{"categories": cats}]), index).first()
    assert got.klass == klass


def test_classify_all(spark):
    index = classes.group_index(classes.config_items(spark, config.DEFAULT))
    df = recs(
        spark,
        [
            {"filename": "noise.jpg", "categories": ["Minerals", "Cats"], "caption": "c"},
            {"filename": "cats.jpg", "categories": ["Cats"]},
            {"filename": "kept.jpg", "categories": ["Slag"], "klass": "01_real_estratos", "caption": "c"},
            {"filename": "museum_1.jpg", "categories": ["Slag"], "description": "A Specimen", "caption": "old"},
        ],
    )
    got = as_dict(classes.classify_all(df, index))
    assert got["noise.jpg"]["reject_reasons"] == ["out_of_scope"] and got["noise.jpg"]["needs_review"] == [classes.CATALOGUE_NOTE] and got["noise.jpg"]["caption"] == "c"
    assert not got["cats.jpg"]["rejected"] and got["kept.jpg"]["klass"] == "01_real_estratos" and got["kept.jpg"]["caption"] == "c"
    assert len(got["museum_1.jpg"]["needs_review"]) == 2 and got["museum_1.jpg"]["caption"] is None
    again = as_dict(classes.classify_all(classes.classify_all(df, index), index, overwrite=True))
    assert again["kept.jpg"]["klass"] == "03_proxy_materiales" and again["kept.jpg"]["caption"] is None and len(again["museum_1.jpg"]["needs_review"]) == 2
    capt = as_dict(classes.caption_all(classes.classify_all(df, index, overwrite=True)))
    assert "fused industrial conglomerate" in capt["kept.jpg"]["caption"] and capt["cats.jpg"]["caption"] is None


# Reports and export


def test_quantiles_are_nearest_rank(spark):
    for values in ([], [3], list(range(10)), [5, 1, 1, 9, 7], [2.5, 1.5]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        got = reports.nearest_rank(df, "v", {"p10": 0.1, "p90": 0.9}).first()
        s, n = sorted(values), len(values)
        want = (n, s[0], s[-1], (s[(n - 1) // 2] + s[n // 2]) / 2, s[min(int(n * 0.1), n - 1)], s[min(int(n * 0.9), n - 1)]) if n else (0, None, None, None, None, None)
        assert tuple(got) == want


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_quantiles_of_distinct_doubles(spark, n):
    rng = random.Random(n)
    xs = [rng.gauss(0, 1) for _ in range(n)] + [0.25] * (n // 3)
    got = reports.nearest_rank(spark.createDataFrame([(x,) for x in [*xs, None]], "x double"), "x", {"p10": 0.1, "p99": 0.99, "all": 1.0}, parts=5).first()
    xs.sort()
    at = lambda p: xs[min(int(len(xs) * p), len(xs) - 1)]
    middle = (xs[(len(xs) - 1) // 2] + xs[len(xs) // 2]) / 2
    assert tuple(got) == (len(xs), xs[0], xs[-1], middle, at(0.1), at(0.99), xs[-1])


def test_totals_and_refilter(spark):
    df = recs(spark, [{"filename": "a", "width": 800, "height": 700, "rejected": True, "reject_reasons": ["too_small"], "license": "CC0", "origin_title": "t"}, {"filename": "b", "width": 600, "height": 700, "license": "CC0", "origin_title": "t", "caption": "c"}, {"filename": "c", "width": 800, "height": 700, "rejected": True, "reject_reasons": ["too_small", "manual"]}])
    out = reports.refilter(df, 640)
    assert {k: v["reject_reasons"] for k, v in as_dict(out).items()} == {"a": [], "b": ["too_small"], "c": ["manual"]}
    assert tuple(reports.refilter_counts(out).first()) == (3, 2, 1, 1, 1)
    assert reports.refilter(df, 640, "01_real_estratos").where("changed").count() == 0
    assert reports.totals(df).first().asDict() == {"entries": 3, "active": 1, "rejected": 2, "with_provenance": 1, "captioned": 1, "provenance_pct": 100}
    assert reports.totals(df.limit(0)).first().provenance_pct == 0
    assert {r.klass: r.n for r in reports.by_class(df).collect()} == {"01_real_estratos": 0, "02_real_plastiglomerado": 0, "03_proxy_materiales": 0, "04_synth_plastiglomerado": 0, "_unclassified": 1}


def test_export_gates_and_paths(spark):
    ok = {"klass": "02_real_plastiglomerado", "license": "CC0", "caption": 'x, "y"', "mode": "RGB"}
    df = recs(spark, [{"filename": "a.JPEG", **ok}, {"filename": "b.png", **ok}, {"filename": "c.jpg", **ok, "rejected": True}, {"filename": "d.jpg", **ok, "license": "GFDL"}, {"filename": "e.jpg", **ok, "caption": None}, {"filename": "f.jpg", **ok}, {"filename": "g.jpg"}])
    got = as_dict(export.gate_status(df, F.col("filename") != "f.jpg"))
    assert {k: v["export_status"] for k, v in got.items()} == {"a.JPEG": "ok", "b.png": "ok", "c.jpg": "inactive", "d.jpg": "skipped_license", "e.jpg": "skipped_no_caption", "f.jpg": "missing_source", "g.jpg": "inactive"}
    paths = export.export_paths(df.where("filename in ('a.JPEG', 'b.png')"))
    assert {k: (v["folder"], v["image_name"], v["converted"]) for k, v in as_dict(paths).items()} == {"a.JPEG": ("15_02_real_plastiglomerado", "a.jpg", False), "b.png": ("15_02_real_plastiglomerado", "b.jpg", True)}
    assert tuple(export.folder_totals(paths).first()) == ("15_02_real_plastiglomerado", 2, 15, 30)
    assert [r[0] for r in export.captions_csv(paths).select(export.csv_line(F.col("file_name"), F.col("text"))).collect()] == ['a.jpg,"x, ""y"""', 'b.jpg,"x, ""y"""']


def test_sheet_and_tree_check(spark):
    row = export.sheet_rows(recs(spark, [{"filename": "<x>.jpg", "rejected": True, "reject_reasons": ["blurry"]}])).first()
    assert row.css == "bad" and "class='bad'" in row.figure and "<span class='tag'>blurry</span>" in row.figure and "&lt;x&gt;" in row.figure
    files = spark.createDataFrame([("10_a", "x.jpg"), ("10_a", "x.txt"), ("10_a", "y.png"), ("b", "z.jpg"), ("b", "z.txt")], "folder string, name string")
    assert {r.folder: (r.images, r.captions, r.repeats, r.matched, r.views) for r in export.tree_check(files).collect()} == {"10_a": (2, 1, 10, False, 20), "b": (1, 1, 1, True, 1)}
    assert sorted(r.name for r in export.caption_twins(files).collect()) == ["x.jpg", "z.jpg"]


def test_metadata_and_synthesis(spark):
    df = recs(spark, [{"filename": "a", "license": "GFDL", "phash": "ff"}, {"filename": "b"}])
    m = spark.createDataFrame([("a", "T", "d", "u", {"LicenseShortName": "CC <b>BY</b> 4.0", "Artist": "", "Credit": "Me", "Categories": "One| Two |"}, "Cat")], "filename string, title string, description_url string, url string, meta map<string,string>, category string")
    got = as_dict(provenance.apply_metadata(df, m))
    assert (got["a"]["license"], got["a"]["attribution"], got["a"]["categories"], got["a"]["rejected"]) == ("CC BY 4.0", "Me", ["One", "Two", "Cat"], False) and got["b"]["source"] == "local"
    refs = spark.createDataFrame([("r2.jpg",), ("r1.jpg",)], "name string")
    made = provenance.synth_records(spark, refs, 5, 100).orderBy("i").collect()
    assert [r.filename for r in made] == ["synth_000_r1.jpg", "synth_001_r2.jpg", "synth_002_r1.jpg", "synth_003_r2.jpg", "synth_004_r1.jpg"]
    assert made[0].source_id == "100" and made[0].description in made[0].caption
    assert len({r.description for r in provenance.synth_records(spark, refs, 40, 1).collect()}) > 10


def test_long_names_stay_whole(spark):
    names = ["n" * 40 + str(i) for i in range(2)]
    locals_ = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "local string, h long")
    got = provenance.cross_distances(spark.createDataFrame([(7, 0)], "seq long, h long"), locals_, 3)
    assert sorted((r.seq, r.local, r.distance) for r in got.collect()) == [(7, names[0], 0), (7, names[1], 1)]


def test_match_candidates(spark):
    df = recs(spark, [{"filename": "a", "phash": "00000000000000ff"}, {"filename": "b", "phash": "00000000000000fe"}, {"filename": "c", "phash": "ffffffffffffffff", "license": "CC0", "origin_title": "t"}])
    cand = spark.createDataFrame([(1, "00000000000000ff"), (2, "00000000000000ff"), (3, "ffffffffffffffff")], "seq long, phash string")
    got = {r.seq: (r.filename, r.distance) for r in provenance.match_candidates(df, cand).collect()}
    assert got == {1: ("a", 0), 2: ("b", 1)}


def test_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "out").mkdir()
    for name, data in (("a.JPG", b"xy"), ("b.png", b"x"), ("c.txt", b"x"), ("sub/d.jpg", b"x")):
        (tmp_path / "in" / name).write_bytes(data)
    (tmp_path / "out" / "b.png").write_bytes(b"y")
    images = ingest.list_images(spark, str(tmp_path / "in"))
    assert [r.name for r in images.collect()] == ["a.JPG", "b.png"] and ingest.list_files(spark, str(tmp_path / "in")).count() == 3
    assert [r.name for r in ingest.new_or_changed(images, ingest.list_files(spark, str(tmp_path / "out"))).collect()] == ["a.JPG"]
    import hashlib

    assert {r.name: r.sha256 for r in ingest.with_sha256(spark, str(tmp_path / "in")).collect()}["a.JPG"] == hashlib.sha256(b"xy").hexdigest()
