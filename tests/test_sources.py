import io
import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from sievewright import sources
from sievewright.sources import europepmc, flickr, http, mediawiki


def page(i, **info):
    return {"pageid": i, "title": f"File:Pic {i}, Spain.jpg", "categories": [{"title": "Category:Shale"}], "imageinfo": [{"url": f"http://f/{i}", "descriptionurl": f"http://d/{i}", "width": 2000, "height": 1500, "thumburl": f"http://t/{i}", "extmetadata": {"LicenseShortName": {"value": "CC BY 4.0"}, "Artist": {"value": "<a>Ann</a>"}}, **info}]}


FIG = '<article xmlns:xlink="http://www.w3.org/1999/xlink"><fig id="f1"><caption><p>A  rock\n <b>here</b></p></caption><graphic xlink:href="fig-1"/></fig><fig><caption/></fig><fig id="f2"><alternatives><inline-graphic xlink:href="b.png"/></alternatives></fig></article>'


class Handler(BaseHTTPRequestHandler):
    failures = 0

    def log_message(self, *_):
        pass

    def answer(self, body, code=200):
        data = body if isinstance(body, bytes) else body.encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def do_GET(self):
        url = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        if url.path == "/flaky":
            Handler.failures += 1
            return self.answer("fine" if Handler.failures % 3 == 0 else "again", 200 if Handler.failures % 3 == 0 else 503)
        if url.path == "/wiki":
            at = int(q.get("gcmcontinue", 0))
            if q.get("gsrsearch") == "broken":
                return self.answer("{", 200)
            pages = {str(i): page(i, **({"width": 800} if i % 4 == 3 else {})) for i in range(at, at + 5)}
            more = {"continue": {"gcmcontinue": at + 5}} if at < 15 else {}
            return self.answer(json.dumps({"query": {"pages": pages}, **more}))
        if url.path == "/epmc/search":
            first = q["cursorMark"] == "*"
            arts = [{"pmcid": "PMC1", "license": "cc by", "title": "T", "authorString": "A", "journalTitle": "J"}, {"pmcid": "PMC2", "license": "cc by-nc"}, {"license": "cc by"}] if first else [{"pmcid": "PMC3", "title": "U"}]
            return self.answer(json.dumps({"resultList": {"result": arts}, "nextCursorMark": "x"}))
        if url.path.endswith("/fullTextXML"):
            return self.answer(FIG)
        if url.path == "/flickr":
            n = int(q["page"])
            return self.answer(json.dumps({"photos": {"pages": 2, "photo": [{"id": str(n * 10 + k), "owner": "o", "license": "9", "url_k": f"http://k/{n}{k}", "width_k": "2048", "height_k": 1365} for k in range(3)]}}))
        return self.answer("no", 404)


@pytest.fixture(scope="module")
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_get_tries_again(server, monkeypatch):
    monkeypatch.setattr(http, "PAUSE", 0.0)
    Handler.failures = 0
    assert http.get(f"{server}/flaky") == b"fine"
    with pytest.raises(Exception):
        http.get(f"{server}/nothing")


def test_wiki_pagination_and_limit(server, spark):
    found = sources.discover(spark, "wikimedia", ["Category:Shale", "outcrop", "broken"], "01_real_estratos", limit=7, endpoint=f"{server}/wiki")
    rows = found.orderBy("seq").collect()
    by = {q: [r for r in rows if r["query"] == q] for q in ("Category:Shale", "outcrop", "broken")}
    assert [len(v) for v in by.values()] == [7, 7, 0] and all(r.width >= 1024 for r in rows)
    first = by["Category:Shale"][0]
    assert (first.filename, first.license, first.attribution, first.categories) == ("wm_0_pic_0_spain.jpg", "CC BY 4.0", "Ann", ["Shale"])
    assert by["outcrop"][0].categories == ["Shale", "outcrop"]
    spark.dataSource.register(mediawiki.MediaWikiSource)
    raw = spark.read.format("mediawiki").options(queries='["Category:Shale"]', thumbs="true", limit="600", endpoint=f"{server}/wiki").load()
    assert mediawiki.thumb_candidates(raw, most=9).count() == 9


def test_page_mapping_edges(spark):
    cases = [page(1), page(2, url=None), page(3, width=1000), page(4, height=None), {"title": "File:x.svg"}, {"title": "File:y.jpg", "imageinfo": []}, {**page(7), "title": "File:Cliff, Spain.JPG"}, {**page(8), "pageid": None, "categories": None}]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "i int, page string")
    got = {r.i: r for r in mediawiki.pages_to_records(df, "page", F.lit("k"), F.lit("Shale")).collect()}
    assert sorted(got) == [0, 6, 7] and got[6].filename == "wm_7_cliff_spain.jpg" and got[7].filename == "wm_pic_8_spain.jpg" and got[7].categories == ["Shale"]


def test_europepmc(server, spark):
    rows = sources.discover(spark, "europepmc", ["rock"], "02_real_plastiglomerado", endpoint=f"{server}/epmc").orderBy("seq").collect()
    assert [r.filename for r in rows] == ["epmc_pmc1_fig-1.jpg", "epmc_pmc1_b.png", "epmc_pmc3_fig-1.jpg", "epmc_pmc3_b.png"]
    assert rows[0].description == "A rock here" and rows[0].attribution == "A (J)" and rows[0].origin_title == "T — f1" and rows[2].license == "cc by"
    assert rows[0].download_url.endswith("PMC1/supplementaryFiles::fig-1") and rows[0].needs_review == [europepmc.NOTE]
    articles = spark.createDataFrame([("PMC1", FIG), ("PMC9", "<broken"), ("PMC8", None)], "pmcid string, xml string")
    assert [(r.pmcid, r.fig_id, r.href) for r in europepmc.figure_rows(articles).collect()] == [("PMC1", "f1", "fig-1"), ("PMC1", "f2", "b.png")]
    gate = spark.createDataFrame([("P", "cc by"), ("P", None), ("", "cc by"), ("P", "cc by-nc")], "pmcid string, license string")
    assert europepmc.article_gate(gate).count() == 2


@pytest.mark.parametrize("wanted,names,want", [("a.jpg", ["a.gif", "a.jpg"], "a.jpg"), ("a", ["a.gif", "a.jpg"], "a.jpg"), ("a.tif", ["A.gif"], "A.gif"), ("a", ["b.jpg"], None), ("FIG.JPG", ["fig.gif", "fig.jpeg"], "fig.jpeg")])
def test_best_member(wanted, names, want):
    assert europepmc.best_member(wanted, names) == want


def test_members_of_archives(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("gone")
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("fig-1.jpg", b"one")
            z.writestr("fig-1.gif", b"small")
        return out.getvalue()

    df = spark.createDataFrame([("http://z::fig-1",), ("http://z::none",), ("http://bad::fig-1",)], "download_url string")
    got = {r.download_url: (r.content and bytes(r.content), r.error) for r in europepmc.read_members(df, fetch).collect()}
    assert got["http://z::fig-1"] == (b"one", None) and got["http://z::none"][1].startswith("FileNotFoundError") and got["http://bad::fig-1"][1].startswith("OSError")
    with pytest.raises(ValueError):
        europepmc.split_url("http://plain")


def test_flickr(server, spark):
    rows = sources.discover(spark, "flickr", ["rock"], "01_real_estratos", api_key="k", limit=5, endpoint=f"{server}/flickr").orderBy("seq").collect()
    assert len(rows) == 5 and rows[0].license == "CC0" and rows[0].width == 2048 and rows[0].filename == "flickr_10.jpg"
    assert sources.discover(spark, "flickr", ["rock"], "k", endpoint=f"{server}/flickr").count() == 0
    cases = [{"id": "1", "url_o": "o", "url_b": "b", "license": "4", "title": "T", "ownername": "N", "description": {"_content": "D"}}, {"id": "2"}, {"id": "3", "url_b": "b", "width_b": "800", "height_b": "900"}, {"id": "4", "url_h": "h", "license": "6"}]
    df = spark.createDataFrame([(json.dumps(c),) for c in cases], "photo string")
    got = {r.source_id: r for r in flickr.photos_to_records(df, "photo", F.lit("k"), F.lit("q")).collect()}
    assert sorted(got) == ["1", "4"] and (got["1"].download_url, got["1"].license, got["1"].attribution, got["1"].description) == ("o", "CC BY 2.0", "N", "D") and got["4"].license == "Flickr license 6"


def test_registry():
    assert sources.available("wikimedia") and not sources.available("flickr") and sources.available("flickr", {"api_key": "x"})
    with pytest.raises(KeyError):
        sources.available("nowhere")
