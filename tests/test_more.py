"""Plug-ins, browsers, uploads, workbooks and pacing without packages, browsers or a network."""

import sys
import threading
import time
import types
import zipfile
from io import BytesIO
from xml.etree import ElementTree

import pytest

from lumenweb.functions import plugins, tokenizers
from lumenweb.operators import registrars
from lumenweb.plans.catalog.more import PlantedBrowser
from lumenweb.sources import browser, network, sheets, upload


def test_plug_ins_are_registered_where_their_package_is(monkeypatch):
    before = {k: dict(v) for k, v in (("words", tokenizers.WORDS), ("sentences", tokenizers.SENTENCES))}
    try:
        assert plugins.install(lambda package: False) == []
        fake = types.ModuleType("jieba")
        fake.tokenize = lambda s: [(s[i : i + 2], i, i + 2) for i in range(0, len(s), 2)]
        thai = types.ModuleType("pythainlp")
        thai.word_tokenize, thai.sent_tokenize = lambda s: s.split("-"), lambda s: s.split("/")
        broken = types.ModuleType("tinysegmenter")
        monkeypatch.setitem(sys.modules, "jieba", fake)
        monkeypatch.setitem(sys.modules, "pythainlp", thai)
        monkeypatch.setitem(sys.modules, "tinysegmenter", broken)
        got = plugins.install(lambda p: p in ("jieba", "pythainlp", "tinysegmenter"))
        assert sorted(got) == [("sentences", "th"), ("words", "chn"), ("words", "ja"), ("words", "th")]
        assert tokenizers.tokenize_text("域名出售", "zh-cn") == [["域名", "出售"]]
        assert tokenizers.tokenize_text("a-b/c", "th") == [["a", "b"], ["c"]]
        assert tokenizers.tokenize_text("a b", "ja") == [["a", "b"]]  # a plug-in that fails gives way
    finally:
        tokenizers.WORDS.update(before["words"])
        tokenizers.SENTENCES.update(before["sentences"])
    assert {k for kind in plugins.KNOWN.values() for k in kind} >= {"chn", "ja", "ko", "th", "vi", "fa", "ar", "he", "hi", "te"}


def test_browser_visits():
    b = PlantedBrowser()
    assert browser.one(b, "p1.com", None, "http://p1.com", True, 1.0) == ("p1.com", None, "<p>http://p1.com</p>", False, None, False, "browser", b"shot")
    assert browser.one(b, "p5.com", None, "http://p5.com", True, 1.0) is None
    assert browser.one(b, "p7.com", "o", "http://p7.com", True, 1.0)[1:4] == ("o", "JS CRAWLING ERROR: no document", True)


def test_upload_outcomes():
    row = {"url": "u", "ss_filename": "a/s.png", "screenshot": b"x", "html_text": "t", "html_raw": "r", "categorisation": '{"url": "old", "k": 1}'}
    seen = []

    def send(method, address, fields):
        seen.append((method, address, fields))
        return (200, address, "7") if address == "i" else (200, "s/1", "") if method == "POST" else (204, address, "")

    assert upload.one(row, send, "i", "s", True) == ("u", "updated", "")
    assert [x[:2] for x in seen] == [("POST", "i"), ("POST", "s"), ("PATCH", "s/1")] and seen[1][2]["screenshot"] == 7
    assert upload.one(row, send, "i", "s", False)[1] == "known"
    assert upload.one(row | {"ss_filename": None}, send, "i", "s", True)[1] == "skipped"
    assert upload.one(row, lambda *x: (_ for _ in ()).throw(OSError("down")), "i", "s", True) == ("u", "failed", "OSError: down")


def test_workbooks_can_be_read():
    data = sheets.workbook({"A & B": (["x", "y"], [(1, "a<b"), (2.5, None), (True, "\x01ok")]), "empty": (["z"], [])})
    with zipfile.ZipFile(BytesIO(data)) as z:
        parts = {n: ElementTree.fromstring(z.read(n)) for n in z.namelist()}
    ns = {"m": sheets._MAIN}
    assert [s.get("name") for s in parts["xl/workbook.xml"].iterfind(".//m:sheet", ns)] == ["A & B", "empty"]
    cells = {c.get("r"): "".join(c.itertext()) for c in parts["xl/worksheets/sheet1.xml"].iterfind(".//m:c", ns)}
    assert cells == {"A1": "x", "B1": "y", "A2": "1", "B2": "a<b", "A3": "2.5", "A4": "1", "B4": "ok"}
    assert [sheets.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_pools_and_paces(spark):
    urls = spark.createDataFrame([(f"p{i}.com",) for i in range(24)], "url string").coalesce(1)

    def get(url):
        time.sleep(0.05)
        return {"status": 200, "final_url": url, "raw_text": str(threading.get_ident())}

    out = network.visit(urls, get, pool=6).collect()
    assert len(out) == 24 and len({r.raw_text for r in out}) > 1
    began = time.monotonic()
    assert network.visit(urls.limit(5), get, period=0.2).count() == 5
    assert time.monotonic() - began >= 0.8


def test_extending_by_many_tlds_is_an_error(spark):
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    tlds = spark.createDataFrame([(".com",), (".net",), (None,)], "tld string")
    none = spark.createDataFrame([], "domain string")
    assert registrars.extend(names, tlds, none).count() == 4
    assert registrars.extend(names, tlds.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        registrars.extend(names, tlds, none, limit=1)
