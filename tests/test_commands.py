import hashlib
import io
import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import numpy as np
import pytest

from sievewright import cli
from sievewright.operators import jpeg, manifest, pixels, tree
from sievewright.plans import commands, config, render
from tests.test_operators import as_dict, recs
from tests.test_pixels import noise, png


def test_audit_folder(spark, tmp_path):
    big = np.clip(noise(3, 1200, 1600) // 2 + 70, 0, 255)
    for name, data in (("a.png", png(big)), ("b.png", png(big)), ("small.png", png(noise(5, 400, 600))), ("bad.jpg", b"nothing")):
        (tmp_path / name).write_bytes(data)
    (tmp_path / "a.txt").write_text("caption")
    old = recs(spark, [{"filename": "a.png", "rejected": True, "reject_reasons": ["too_small", "manual"]}, {"filename": "elsewhere.png"}])
    out = commands.audit(spark, old, str(tmp_path))
    got = as_dict(out.records)
    assert sorted(got) == ["a.png", "b.png", "bad.jpg", "elsewhere.png", "small.png"]
    assert got["a.png"]["reject_reasons"] == ["manual"] and got["a.png"]["width"] == 1600
    assert "duplicate" in got["b.png"]["reject_reasons"] and "too_small" in got["small.png"]["reject_reasons"] and got["bad.jpg"]["reject_reasons"] == ["unreadable"]
    assert tuple(out.report["files"].first())[0] == 5 and out.report["captioned"].first().n == 1
    assert tuple(out.report["usable"].first()) == (3, 1)
    relaxed = as_dict(commands.audit(spark, out.records, str(tmp_path), commands.Thresholds().override(300)).records)
    assert "too_small" not in relaxed["small.png"]["reject_reasons"] and "duplicate" in relaxed["b.png"]["reject_reasons"]


def test_ingest_then_nothing_new(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    (tmp_path / "in" / "a.jpg").write_bytes(b"x")
    m = str(tmp_path / "m.jsonl")
    run = lambda *a: cli.run(spark, ["--manifest", m, "--images", str(tmp_path / "out"), *a])
    run("ingest", "--source", str(tmp_path / "in"))
    got = as_dict(manifest.load(spark, m))
    assert (tmp_path / "out" / "a.jpg").read_bytes() == b"x" and got["a.jpg"]["sha256"] and got["a.jpg"]["source"] == "local"
    assert run("ingest", "--source", str(tmp_path / "in")).report["copy"].count() == 0


def test_commands_over_a_manifest(spark, tmp_path):
    m, images = str(tmp_path / "m.jsonl"), tmp_path / "img"
    images.mkdir()
    (images / "a.jpg").write_bytes(b"jpeg bytes")
    rows = [
        {"filename": "a.jpg", "license": "CC0", "origin_title": "A", "categories": ["Sandstone"], "mode": "RGB", "width": 2000, "height": 1500, "description": "Layered rock. x"},
        {"filename": "b.png", "license": "CC BY 4.0", "origin_title": "B", "categories": ["Slag"], "mode": "RGBA", "width": 800, "height": 700, "rejected": True, "reject_reasons": ["too_small"]},
        {"filename": "c.jpg", "license": "GFDL", "categories": ["Minerals"], "width": 2000, "height": 1500},
    ]
    manifest.save(recs(spark, rows), m)
    run = lambda *a: cli.run(spark, ["--manifest", m, "--images", str(images), *a])
    load = lambda: as_dict(manifest.load(spark, m))
    run("classify")
    assert {k: v["klass"] for k, v in load().items()} == {"a.jpg": "01_real_estratos", "b.png": "03_proxy_materiales", "c.jpg": "_unclassified"} and load()["c.jpg"]["reject_reasons"] == ["out_of_scope"]
    run("caption")
    assert "layered rock" in load()["a.jpg"]["caption"]
    run("refilter", "--min-short-side", "640", "--klass", "03_proxy_materiales")
    assert not load()["b.png"]["rejected"]
    assert run("relicense").report["changes"].count() == 1 and load()["c.jpg"]["reject_reasons"] == ["out_of_scope", "license_denied"]
    status = as_dict(run("reject", "b.png", "zzz.jpg", "--reason", "no").report["status"])
    assert status["b.png"]["status"] == "newly" and status["zzz.jpg"]["status"] == "missing" and load()["b.png"]["reject_reasons"] == ["manual"]
    run("restore", "b.png", "c.jpg")
    assert not load()["b.png"]["rejected"] and load()["c.jpg"]["rejected"]
    out = run("export", "--out", str(tmp_path / "train"))
    assert {r.export_status: r.n for r in out.report["status"].collect()} == {"ok": 1, "missing_source": 1, "inactive": 1}
    assert (tmp_path / "train/10_01_real_estratos/a.jpg").read_bytes() == b"jpeg bytes" and (tmp_path / "train/10_01_real_estratos/a.txt").read_text() == load()["a.jpg"]["caption"]
    csv = (tmp_path / "train/captions_SDXL.csv").read_bytes()
    assert csv.startswith(b"file_name,text\r\na.jpg,") and csv.endswith(b"\r\n")
    assert "| **Total** | **1** | | **10** |" in (tmp_path / "train/README.md").read_text()
    (tmp_path / "train/leftover.txt").write_text("x")
    run("export", "--out", str(tmp_path / "train"))
    assert not (tmp_path / "train/leftover.txt").exists()
    run("sheet", "--out", str(tmp_path / "s.html"))
    sheet = (tmp_path / "s.html").read_text()
    assert sheet.count("<figure") == 3 and "http" not in sheet and "class='bad'" in sheet
    rep = run("report", "--attributions", str(tmp_path / "att.md")).report
    assert rep["totals"].first().entries == 3
    text = (tmp_path / "att.md").read_text()
    assert "- **a.jpg** — A (CC0)" in text and "## local" in text
    run("synthesize", "--count", "2", "--reference-dir", str(images))
    assert sorted(load())[-2:] == ["synth_000_a.jpg", "synth_001_a.jpg"] and load()["synth_000_a.jpg"]["klass"] == "04_synth_plastiglomerado"


def test_recover_and_dry_run(spark, tmp_path):
    m = str(tmp_path / "m.jsonl")
    manifest.save(recs(spark, [{"filename": "a.jpg", "phash": "00000000000000ff"}, {"filename": "b.jpg", "phash": "ffffffffffffffff"}]), m)
    cand = spark.createDataFrame([(0, "00000000000000fe", "T", "d", "u", {"LicenseShortName": "CC0"}, "Cat")], "seq long, phash string, title string, description_url string, url string, meta map<string,string>, category string")
    cand.write.parquet(str(tmp_path / "cand"))
    for dry in (True, False):
        out = cli.run(spark, ["--manifest", m, "recover", "--candidates", str(tmp_path / "cand"), *["--dry-run"] * dry])
        assert [r.filename for r in out.report["unmatched"].collect()] == ["b.jpg"] and out.report["distances"].first().within_5 == 1
        assert as_dict(manifest.load(spark, m))["a.jpg"]["license"] == ("UNKNOWN" if dry else "CC0")
        counts = {(r.kind, r["name"]): r.n for r in out.report["counts"].collect()}
        assert counts == {("pending", None): 2, ("candidates", None): 1, ("hashed", None): 1, ("matched", None): 1, ("license", "CC0"): 1}


def test_listed_candidates_and_thumbs(spark, tmp_path):
    from sievewright.operators import provenance

    good = png(noise(7, 400, 600))
    cand = spark.createDataFrame([(0, "good"), (1, "bad"), (2, "boom")], "seq long, thumb_url string")

    def fetch(row):
        if row["download_url"] == "boom":
            raise OSError("gone")
        return good if row["download_url"] == "good" else b"no image"

    (tmp_path / "t").mkdir()
    got = {r.seq: (r.phash, r.error) for r in provenance.hash_thumbs(spark, cand, str(tmp_path / "t"), fetch).collect()}
    from sievewright.operators import pixels

    assert got[0] == (pixels.phash(pixels.thumbnail(noise(7, 400, 600))), None) and got[1][1].startswith("ValueError") and got[2] == (None, "OSError: gone")
    df = spark.createDataFrame([("s", e) for e in ("OSError: a", "OSError: b", None, "X: c")], "source string, error string")
    assert [tuple(r) for r in provenance.error_counts(df).collect()] == [("s: OSError", 2), ("s: X", 1)]
    uris = {r.name: r.uri for r in pixels.thumb_uris(spark, str(tmp_path / "t")).collect()}
    assert uris["0000000000000000.img"].startswith("data:image/png;base64,") and uris["0000000000000001.img"] is None


BIG = png(np.clip(noise(3, 1200, 1600) // 2 + 70, 0, 255))
FIG = '<a xmlns:x="y"><fig id="f1"><caption>c</caption><graphic x:href="one"/></fig><fig id="f2"><graphic x:href="none"/></fig></a>'


class Web(BaseHTTPRequestHandler):
    """A wiki of six pages, one article with an archive, two photographs; what was asked for is kept."""

    asked: list = []

    def log_message(self, *_):
        pass

    def do_GET(self):
        url, root = urlparse(self.path), f"http://127.0.0.1:{self.server.server_port}"
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        code, body = 200, b""
        if url.path == "/wiki":
            info = lambda i, license_: {"pageid": i, "title": f"File:P{i}.png", "imageinfo": [{"url": f"{root}/file/{i}", "descriptionurl": "d", "width": 1600, "height": 1200, "extmetadata": {"LicenseShortName": {"value": license_}}}]}
            body = b"{" if q.get("gsrsearch") == "broken" else json.dumps({"query": {"pages": {str(i): info(i, "GFDL" if i == 5 else "CC0") for i in range(1, 7)}}}).encode()
        elif url.path == "/epmc/search":
            body = json.dumps({"resultList": {"result": [{"pmcid": "PMC1", "license": "cc by", "title": "T"}, {"pmcid": "PMC2", "license": "cc by"}]}}).encode()
        elif url.path == "/flickr":
            body = json.dumps({"photos": {"pages": 1, "photo": [{"id": str(k), "license": "9", "url_o": f"{root}/file/f{k}"} for k in range(2)]}}).encode()
        elif url.path.endswith("PMC1/fullTextXML"):
            body = FIG.encode()
        elif url.path.endswith("/supplementaryFiles"):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("one.png", png(np.clip(noise(11, 1200, 1600) // 2 + 70, 0, 255)))
            body = out.getvalue()
        elif url.path.startswith("/file/"):
            name = url.path[6:]
            code = 404 if name == "4" else 200
            body = {"3": b"no picture", "4": b""}.get(name, BIG if name in ("1", "2") else png(np.clip(noise(20 + int(name.strip("f")), 1200, 1600) // 2 + 70, 0, 255)))
        else:
            code = 404
        if not url.path.startswith(("/wiki", "/flickr")):
            Web.asked.append(url.path)
        self.send_response(code)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)


@pytest.fixture
def web():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Web)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Web.asked = []
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetch_takes_in_what_it_accepts(spark, tmp_path, web):
    folder, strata = str(tmp_path / "img"), "01_real_estratos"

    def get(url, root=web):
        from sievewright.sources import europepmc, http

        return http.get(url.replace(europepmc.ENDPOINT, f"{root}/epmc"))

    def run(records, **kw):
        return commands.fetch(spark, records, ["wikimedia", "europepmc"], {strata: ["rock", "broken"]}, options={"wikimedia": {"endpoint": f"{web}/wiki"}, "europepmc": {"endpoint": f"{web}/epmc"}}, get=get, **kw)

    empty = recs(spark, []).limit(0)
    dry = run(empty)
    assert dry.records is None and not [x for x in Web.asked if "/file/" in x or "supplementary" in x]
    out = run(empty, folder=folder)
    got = as_dict(out.records)
    assert sorted(got) == ["epmc_pmc1_one.jpg", "wm_1_p1.png", "wm_2_p2.png", "wm_3_p3.png", "wm_6_p6.png"]
    assert got["wm_1_p1.png"]["width"] == 1600 and got["wm_1_p1.png"]["sha256"] == hashlib.sha256(BIG).hexdigest() and not got["wm_1_p1.png"]["rejected"]
    assert got["wm_2_p2.png"]["reject_reasons"] == ["duplicate"] and got["wm_6_p6.png"]["reject_reasons"] == []
    assert got["wm_3_p3.png"]["reject_reasons"] == ["unreadable"] and got["wm_3_p3.png"]["sha256"] is None and got["wm_3_p3.png"]["needs_review"] == ["no se pudo leer: ValueError"]
    assert sorted(p.name for p in (tmp_path / "img").iterdir()) == sorted(got) and [p.name for p in tmp_path.iterdir()] == ["img"]
    told = {(r["name"]): r.n for r in out.report["download_errors"].collect()}
    assert told == {"wikimedia: HTTPError": 1, "europepmc: FileNotFoundError": 1} and tuple(out.report["taken"].first()) == (5, 2)
    listing = {r["name"]: r.n for r in out.report["listing_errors"].collect()}
    assert listing == {"wikimedia: JSONDecodeError": 1, "europepmc: HTTPError": 2}
    assert Web.asked.count("/epmc/PMC1/supplementaryFiles") == 1
    assert {r["name"]: r.n for r in out.report["counters"].collect() if r.kind == "status"}["skipped_license"] == 1
    # a second run knows all but what failed
    Web.asked, known = [], recs(spark, []).sparkSession.createDataFrame(out.records.collect(), out.records.schema)
    again = run(known, folder=folder)
    assert tuple(again.report["taken"].first()) == (0, 2) and {x for x in Web.asked if "/file/" in x} == {"/file/4"}
    assert sorted(as_dict(again.records)) == sorted(got)


def test_fetch_with_a_key(spark, tmp_path, web):
    (tmp_path / "s.json").write_text(json.dumps({"flickr": {"api_key": "k", "endpoint": f"{web}/flickr"}}))
    (tmp_path / "c.json").write_text(json.dumps({"search_terms": {"estratos": ["rock"]}}))
    m = str(tmp_path / "m.jsonl")
    run = lambda *a: cli.run(spark, ["--manifest", m, "--images", str(tmp_path / "img"), "--config", str(tmp_path / "c.json"), "fetch", "--source", "flickr", "--secrets", str(tmp_path / "s.json"), *a])
    run("--dry-run")
    assert manifest.load(spark, m).count() == 0 and not (tmp_path / "img").exists()
    run()
    got = as_dict(manifest.load(spark, m))
    assert sorted(got) == ["flickr_0.jpg", "flickr_1.jpg"] and all(r["phash"] and not r["rejected"] for r in got.values())
    assert tuple(run().report["counters"].where("kind = 'status'").first()) == ("status", "skipped_known", 2)


def test_fetch_without_a_key_finds_nothing(spark, tmp_path):
    out = cli.run(spark, ["--manifest", str(tmp_path / "m"), "fetch", "--source", "flickr", "--dry-run"])
    assert out.report["counters"].count() == 0


def test_downloads_contain_errors(spark, tmp_path):
    (tmp_path / "there.jpg").write_bytes(b"old")
    df = spark.createDataFrame([("there.jpg", "u"), ("ok.jpg", "u"), ("bad.jpg", "boom")], "filename string, download_url string")

    def fetch(row):
        if row["download_url"] == "boom":
            raise PermissionError("no " * 60)
        return b"new"

    got = {r.filename: r.error for r in tree.download(df, str(tmp_path), fetch).collect()}
    assert got["ok.jpg"] is None and got["bad.jpg"].startswith("PermissionError: no") and len(got["bad.jpg"]) <= 97
    assert sorted(p.name for p in tmp_path.iterdir()) == ["ok.jpg", "there.jpg"] and (tmp_path / "there.jpg").read_bytes() == b"old"


def test_converted_pictures_need_an_encoder(spark, tmp_path):
    (tmp_path / "x.png").write_bytes(b"png")
    from sievewright.operators import export

    df = export.export_paths(recs(spark, [{"filename": "x.png", "klass": "01_real_estratos", "caption": "c"}]))
    assert tree.write_tree(df, str(tmp_path), str(tmp_path / "o")).first().error.startswith("ValueError")
    assert tree.write_tree(df, str(tmp_path), str(tmp_path / "o"), lambda b: b"jpeg").first().error is None
    assert (tmp_path / "o/10_01_real_estratos/x.jpg").read_bytes() == b"jpeg"


def test_export_recodes_what_is_not_rgb_jpeg(spark, tmp_path):
    m, images, out = str(tmp_path / "m.jsonl"), tmp_path / "img", tmp_path / "train"
    images.mkdir()
    colour, grey = noise(1, 120, 160), noise(2, 80, 80)[:, :, 0]
    plain = jpeg.encode(colour.astype("uint8"))
    for name, data in (("a.jpg", plain), ("b.png", png(colour)), ("c.png", png(grey)), ("d.png", b"no picture"), ("e.png", png(colour))):
        (images / name).write_bytes(data)
    good = {"license": "CC0", "klass": "01_real_estratos", "caption": "c"}
    manifest.save(recs(spark, [{"filename": n, "mode": k, **good, **more} for n, k, more in (("a.jpg", "RGB", {}), ("b.png", "RGB", {}), ("c.png", "L", {}), ("d.png", "RGB", {}), ("e.png", "RGB", {"rejected": True, "reject_reasons": ["manual"]}))]), m)
    done = {r.filename: r for r in cli.run(spark, ["--manifest", m, "--images", str(images), "export", "--out", str(out)]).report["written"].collect()}
    assert {k: (r.converted, r.error) for k, r in done.items() if k != "d.png"} == {"a.jpg": (False, None), "b.png": (True, None), "c.png": (True, None)}
    assert done["d.png"].converted and done["d.png"].error == "ValueError: not an image"
    folder = out / "10_01_real_estratos"
    assert sorted(p.name for p in folder.iterdir()) == ["a.jpg", "a.txt", "b.jpg", "b.txt", "c.jpg", "c.txt"] and (folder / "a.jpg").read_bytes() == plain
    assert (folder / "b.jpg").read_bytes() == plain and (folder / "b.txt").read_text() == "c"
    got = {r.name: r for r in pixels.measure(spark, str(folder)).where("name like '%.jpg'").collect()}
    assert {k: (r.width, r.height, r.mode) for k, r in got.items()} == {"a.jpg": (160, 120, "RGB"), "b.jpg": (160, 120, "RGB"), "c.jpg": (80, 80, "RGB")}


def test_configuration(tmp_path, spark):
    (tmp_path / "c.json").write_text(json.dumps({"wikimedia_categories": {"proxy": ["Slag"]}, "search_terms": {"estratos": ["slag"]}}))
    from sievewright.operators import classes

    items = classes.config_items(spark, config.load(str(tmp_path / "c.json")))
    assert [tuple(r) for r in classes.group_index(items).collect()] == [("slag", "estratos")]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["nonsense"])
    assert len(cli.parser()._subparsers._group_actions[0].choices) == 14


def test_reports_as_text(spark, tmp_path, capsys):
    assert [render.megabytes(n) for n in (None, 0, 1_500_000, 2_345_678_901)] == ["-", "0.00 MB", "1.50 MB", "2,346 MB"] and render.share(2, 3) == "66%" and render.share(0, 0) == "0%"
    many = spark.createDataFrame([(f"r{i:02}", i) for i in range(20)], "reason string, n long").orderBy("reason")
    lines = render.frame(many, most=4)
    assert lines[0].split() == ["reason", "n", "share"] and lines[4].split() == ["r03", "3", "1%"] and lines[5:] == ["  and more"]
    assert render.frame(many.where("n = 7"))[1].split() == ["r07", "7", "100%"] and render.frame(many.where("n > 99")) == ["  none"]
    assert render.frame(spark.createDataFrame([(3, 2_000_000, None, True)], "files long, bytes long, side int, ok boolean")) == ["  files  3", "  bytes  2.00 MB", "  side   -", "  ok     yes"]
    m = str(tmp_path / "m.jsonl")
    manifest.save(recs(spark, [{"filename": "a.jpg", "license": "CC0", "origin_title": "A"}, {"filename": "b.jpg", "rejected": True, "reject_reasons": ["manual"]}]), m)
    assert cli.main(["--manifest", m, "report"]) == 0
    text = capsys.readouterr().out
    assert " REPORT\n" in text and "provenance pct" in text and "100%" in text and "manual" in text


def test_references_are_jpeg_and_png(spark, tmp_path):
    from sievewright.operators import ingest

    for name in ("b.PNG", "a.jpg", "c.jpeg", "d.webp", "e.tif", "f.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in ingest.list_references(spark, str(tmp_path)).collect()] == ["a.jpg", "b.PNG", "c.jpeg"]
