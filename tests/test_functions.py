"""URL, text, HTML and pattern functions against written-out expectations and properties."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenweb.functions import html, language, text, tokenizers, urls
from lumenweb.functions.patterns import TABLES, PatternEngine, PatternSet


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("link", "clean", "host"),
    [
        ("https://www.a.com/", "a.com", "a.com"), ("http://a.com/x/?q", "a.com/x/?q", "a.com"), ("//www.b.org", "b.org", "b.org"), ("http:\\\\www.c.de\\d", "c.de/d", "c.de"), ("HTTP://A.com", "HTTP://A.com", "HTTP:"),
        ("https://www.http://x.y", "x.y", "x.y"), ("a.com?x=1/2", "a.com?x=1/2", "a.com"), ("", "", ""), ("/", "", ""),
    ],
)
def test_links(spark, link, clean, host):
    assert one(spark, urls.clean_link(F.col("v")), v=link) == clean == html.clean(link)
    assert one(spark, urls.link_to_domain(F.col("v")), v=link) == host


@given(st.text(alphabet="htps:/w.ab\\?#1é", max_size=24))
@settings(max_examples=300, deadline=None)
def test_clean_link_never_lengthens(link):
    out = html.clean(link)
    assert len(out) <= len(link)
    assert link.replace("\\", "/").removesuffix("/").endswith(out)


@pytest.mark.parametrize(("link", "base", "full"), [("/x", "a.com", "http://a.com/x"), ("x", "a.com/", "http://a.com/x"), ("./x", "a.com", "http://a.com/x"), ("HTTPS://b", "a", "HTTPS://b"), ("//b/c", "a", "//b/c"), ("\\x", "http://a.com", "http://a.com/x")])
def test_absolute(spark, link, base, full):
    assert one(spark, urls.absolute(F.col("l"), F.col("b")), l=link, b=base) == full == html.join(link, base)


def test_absolute_with_the_base_scheme_kept(spark):
    assert one(spark, urls.absolute(F.col("l"), F.col("b"), keep_scheme=True), l="x", b="http://a.com") == "http://http://a.com/x"


@pytest.mark.parametrize(("link", "yes"), [("", True), (None, True), ("#a", True), ("mailto:x", True), ("http://a/about:blank", True), ("a/blank/b", False), ("x", False)])
def test_trivial_links(spark, link, yes):
    assert one(spark, urls.is_trivial_link(F.col("v")), v=link) is yes
    if link is not None:
        assert html.trivial(link) is yes


def test_names(spark):
    assert one(spark, urls.registered_name(F.col("v")), v="http://www.shop.foo.co.uk:80/x") == "foo"
    assert one(spark, urls.registered_name(F.col("v")), v="localhost") == "localhost"
    assert one(spark, urls.account_of(F.col("v"), "tw"), v="x.NotTwitter.com/Me?y") == "me"
    assert one(spark, urls.account_of(F.col("v"), "tw"), v="x.com/Me") is None
    assert one(spark, urls.name_distance(F.col("a"), F.col("b")), a="abc", b="abc") == -1
    assert one(spark, urls.name_distance(F.col("a"), F.col("b")), a="abc", b="xabcx") == 0
    assert one(spark, urls.name_distance(F.col("a"), F.col("b")), a="abc", b="abd") == 1


def test_idna_keeps_what_it_cant_encode(spark):
    rows = spark.createDataFrame([("bücher.example",), ("plain.com",), ("..ü..",), (None,)], "v string")
    assert [r.x for r in rows.select(urls.to_idna(F.col("v")).alias("x")).collect()] == ["xn--bcher-kva.example", "plain.com", "..ü..", None]


def tokens(spark, s):
    return one(spark, text.tokenize(F.col("v")), v=s)


def test_tokens(spark):
    assert tokens(spark, "Hello, World! This-is it_all... \n ok") == [["hello", "world"], ["this-is", "it_all"], ["ok"]]
    assert tokens(spark, "") == []
    assert tokens(spark, None) is None
    assert tokens(spark, "-._") == []
    assert tokens(spark, "a" * 250) == [["a" * 100], ["a" * 100], ["a" * 50]]


@given(st.text(alphabet="ab .,!-_\n?é'।", max_size=260))
@settings(max_examples=25, deadline=None)
def test_both_tokenizers_agree(spark, s):
    assert tokens(spark, s) == tokenizers.tokenize_text(s, "en")


def test_registered_tokenizers_are_used(spark):
    before = tokenizers.WORDS["ko"]
    tokenizers.register("words", "ko", lambda s: list(s))
    try:
        assert one(spark, tokenizers.tokenize(F.col("v"), F.lit("ko")), v="가나") == [["가", "나"]]
    finally:
        tokenizers.register("words", "ko", before)
    assert tokenizers.tokenize_text("a b", "ko", words=dict(tokenizers.WORDS, ko=lambda s: 1 / 0)) == [["a", "b"]]


def test_url_token_takes_names_literally(spark):
    assert one(spark, text.url_token(F.col("t"), F.col("u")), t="see a+b.com, a++b.com", u="a+b.com") == "see x_url, a++b.com"
    assert one(spark, text.url_token(F.col("t"), F.col("u")), t="x", u="") == "x"


def test_pairs(spark):
    types = F.create_map(*[F.lit(x) for x in ("domain", "core", "sale", "attr")])
    rows = spark.createDataFrame([([["domain", "sale"], ["sale"], ["x"], ["domain"], ["sale", "y", "z"]],), ([],)], "t array<array<string>>")
    got = [tuple(r.p) for r in rows.select(text.pair_features(F.col("t"), types).alias("p")).collect()]
    assert got == [(1, 2, 2, 1), (0, 0, 1000, 1000)]


def test_language(spark):
    for s, g in (("Das ist nicht die Seite, die wir suchen.", "de"), ("El dominio no se ha encontrado y es para la venta", "es"), ("域名正在出售中请联系我们谢谢大家", "zh-cn"), ("12 34", "other"), (None, "other")):
        assert one(spark, language.detect(F.col("v")), v=s) == g


def test_html_tree():
    d = html.extract("<ul><li><a href=/a>x<li><b>y</b></a></p></ul><br><a href='b'>z</a><!-- c --><p>&eacute; &amp; <script>var a='</p>';</script>", "s.com")
    assert d["all_links"] == ["s.com/a", "s.com/b"]
    assert d["clean_text"].startswith("x.y.z.é &") and "var" not in d["clean_text"] and "c" not in d["clean_text"].split(".")
    assert d["flag_js_found"] and d["lg_inline_script"] == len("var a='</p>';")
    assert html.extract(None, "s.com") is None
    assert html.extract("", "s.com")["clean_text"] is None
    assert html.extract("<<<>>></a></b>", None)["all_links"] == []
    assert html.extract("<div>" * 5000 + "t", "s.com")["tag_quantity"] == 5000


@given(st.text(alphabet="<>/ab =\"'!-&;ifrmescptx\n", max_size=200))
@settings(max_examples=400, deadline=None)
def test_no_page_breaks_the_parser(page):
    try:
        d = html.extract(page, "s.com")
    except AssertionError:  # the parser's own refusal of malformed declarations
        return
    assert d["n_lines_html"] >= 0 and d["tag_quantity"] >= 0


def test_pages_that_fail_are_empty(spark):
    pages = spark.createDataFrame([("a.com", "<p>x</p>"), ("b.com", None)], "url string, raw_text string")
    got = {r.url: r.html_data for r in html.parse_pages(pages).collect()}
    assert got["a.com"].clean_text == "x.." and got["b.com"] is None


ENGINE = PatternEngine()


# Our own sentences for each branch: core word, own url, excluded core, cancelled attribute, English as a fallback.
@pytest.mark.parametrize(
    ("language", "sentence", "notice"),
    [
        ("en", "Our domain has expired", "p9"), ("en", "domain for sale", "p3"), ("en", "this page is for sale", None), ("en", "my.com available", None), ("en", "pages parked", None), ("en", "Domain. Parked", None), ("en", "a site: parked. site parked", "p1"),
        ("fr", "le domaine sera en ligne prochainement", "construction"), ("fr", "les domaines parking", "p15"), ("fr", "les domaines vente", None), ("es", "dominio suspendido", "parked"), ("de", "Die Domain ist geparkt", "parked"), ("ru", "сайт недоступен", "parked"), ("zh-tw", "此域名可以转让", "parked"),
        ("sv", "domänen är parkerad", "parked"), ("et", "domeen osta kohe", "buy"), ("it", "il dominio è in vendita a noleggio", None), ("it", "dominio in vendita", "p2"), ("da", "domænet er til salg", "p13"), ("sk", "stránky vo výstavbe", "p15"), ("de", "this site is parked", "p1"), ("pt", "this site is parked", "p1"),
    ],
)
def test_patterns(language, sentence, notice):
    assert ENGINE.detect("", sentence, language, "my.com", 10)[:2] == (notice is not None, notice)


def test_pattern_limits():
    assert ENGINE.detect("", "domain parked", "en", "x.com", 1000)[0] is False
    assert ENGINE.detect("", "这个域名停放中", "zh-cn", "x.com", 5000)[0] is True
    assert ENGINE.detect("the site is parked", "abc", "en", "x.com", 1)[1] == "p1"
    assert ENGINE.detect(None, None, None, None, None) == (False, None, None)
    assert ENGINE.detect("", "domain parked", "pt", "x.com", 1)[2] == "pt"


def naive(sentences, cores, attributes, cancel, characters):
    """The pattern as one expression for each core, as it is defined."""
    for i, core in enumerate(cores):
        for m in re.finditer(f"{characters}*{core.pattern}{characters}*", sentences, re.I):
            for a in attributes:
                if i not in a.not_with and a.search.search(m[0]) and not (cancel and any(w.search(m[0]) for w in a.cancelled_by)):
                    return a.notice
    return None


@given(st.lists(st.sampled_from(["domain", "page", "pages", "site", " ", " ", ".", "parked", "rights reserved", " reserved", "sale", "my.com", "x", "é", "available", "-"]), max_size=12).map("".join))
@settings(max_examples=500, deadline=None)
def test_linear_search_is_the_definition(s):
    own = [re.compile(re.escape(x), re.I) for x in ("my.com", "www.my.com")]
    p = ENGINE.sets["en"]
    want = naive(re.sub(" {2,}", ".", s), p.cores + own, p.attributes, True, ENGINE.characters["en"]) if len(s) > 5 else None
    assert ENGINE.detect("", s, "en", "my.com", 1)[1] == want


def test_all_tables_compile():
    for name, (cores, attributes) in TABLES.items():
        p = PatternSet.of(cores, attributes)
        assert len(p.cores) >= 2 and len(p.attributes) == len([x for x in attributes.split("\n") if x.strip()]), name
