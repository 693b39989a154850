"""Hand-computed values for the column functions."""

import hashlib
import html
import random
import re
import time
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from crawlspark.functions.entities import decode_all_entities
from crawlspark.functions import filters, identity, state, text, times, urls, values


def sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest().upper()


def apply(spark, function, inputs, schema="v string"):
    """Results of `function` over one column, in the order of the inputs."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [row.r for row in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def test_hashes(spark):
    assert apply(spark, identity.sha_hex, ["", "a", "é"]) == [sha(""), sha("a"), sha("é")]
    ids = apply(spark, lambda url: identity.document_id(url, F.lit("5")), ["u"])
    assert ids == [sha("u-5")]
    assert apply(spark, lambda url: identity.document_id(url, F.lit(None)), ["u"]) == [sha("u-null")]
    assert apply(spark, lambda url: identity.index_id(url, F.lit("c"), F.lit(7)), ["u"]) == [sha("u-c-7")]


def test_body_text_replaces_malformed_bytes(spark):
    assert apply(spark, identity.body_text, [b"ab", b"a\xffb", None], "v binary") == ["ab", "a�b", None]


def test_plain_path(spark):
    paths = ["file:/a/b", "file:///a/b", "hdfs://node:8020/a/b", "/a/b", "a/b"]
    assert apply(spark, identity.plain_path, paths) == ["/a/b", "/a/b", "/a/b", "/a/b", "a/b"]


URLS = ["http://www.a.com:80/x", "http://www.www.a.com/", "http://a b", "http://a_b.com/", "mailto:x@y", "", None,
        "https://user@b.org/p?q#f", "HTTP://c.net"]


def test_host(spark):
    assert apply(spark, urls.host, URLS) == ["a.com", "www.a.com", "", "", "", "", "", "b.org", "c.net"]


def test_stored_path(spark):
    expected = ["com/a/www/", "com/a/www/www/", "a b/", "com/a_b/", "/", None, None, "org/b/", "net/c/"]
    expected = [prefix + sha(url) if prefix is not None else "" for prefix, url in zip(expected, URLS)]
    assert apply(spark, urls.stored_path, URLS) == expected


@pytest.mark.parametrize("link, absolute", [
    ("x.html", "http://h.org/a/b/x.html"),
    ("./x", "http://h.org/a/b/x"),
    ("../x", "http://h.org/a/x"),
    ("../../../x", "http://h.org/x"),
    ("/x", "http://h.org/x"),
    ("//o.org/x", "http://o.org/x"),
    ("?q=2", "http://h.org/a/b/c?q=2"),
    ("#top", "http://h.org/a/b/c?q=1#top"),
    ("https://o.org/../y", "https://o.org/y"),
    ("mailto:x@y", "mailto:x@y"),
    ("x/..", "http://h.org/a/b/"),
    ("x?y=/../z", "http://h.org/a/b/x?y=/../z"),
])
def test_resolve_link(spark, link, absolute):
    base = F.lit("http://h.org/a/b/c?q=1#f")
    assert apply(spark, lambda value: urls.resolve_link(base, value), [link]) == [absolute]


def test_resolve_link_at_a_bare_host(spark):
    assert apply(spark, lambda value: urls.resolve_link(F.lit("http://h.org"), value), ["x", "?q"]) == [
        "http://h.org/x", "http://h.org?q"]


def test_http_dates(spark):
    dates = ["Tue, 30 Aug 2016 18:00:00 GMT", "Tuesday, 30 Aug 2016 18:00:00 GMT", "Tue, 3 Aug 2016 08:00:00 GMT",
             "Tue, 30 Aug 2016 11:00:00 PDT", "Tue, 30 Aug 2016 20:00:00 +0200", "Xyz, 30 Aug 2016 18:00:00 GMT",
             "30 Aug 2016 18:00:00 GMT", "not a date", "", None]
    assert apply(spark, times.http_date_text, dates) == [
        "1472580000000", "1472580000000", "1470211200000", "1472580000000", "1472580000000", None, None, None, None,
        None]


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        millis = [0, 1472580000999, -1, 1457863200000]
        assert apply(spark, times.index_time, millis, "v bigint") == [
            "1970-01-01T00:00:00Z", "2016-08-30T18:00:00Z", "1969-12-31T23:59:59Z", "2016-03-13T10:00:00Z"]
        assert apply(spark, times.plain_time, millis[:1], "v bigint") == ["1970-01-01 00:00:00"]
        assert apply(spark, times.http_date_text, ["Tue, 30 Aug 2016 18:00:00 GMT"]) == ["1472580000000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_state(spark):
    assert apply(spark, state.status_name, ["db_fetched", "db_gone", None]) == ["FETCHED", None, None]
    rows = [{"pst": "success(1), lastModified=12", "nutch.protocol.code": "200"}, {"pst": "success(1)"},
            {"pst": "x=y"}, {}, None]
    kind = "v map<string,string>"
    assert apply(spark, state.last_modified_millis, rows, kind) == [12, 0, 0, 0, 0]
    assert apply(spark, state.status_code, rows, kind) == ["200", None, None, None, None]
    assert apply(spark, state.interval_days, [86_399, 86_400, 2_592_000], "v int") == [0, 1, 30]


TYPES = [None, "", "text/html", "text/html; charset=utf-8", "application/xhtml+xml", "text/vnd.wap.wml",
         "image/svg+xml", "application/pdf"]


def test_type_filters(spark):
    assert apply(spark, filters.is_text_type, TYPES) == [False, False, True, False, True, True, False, False]
    assert apply(spark, filters.is_image, TYPES) == [False] * 6 + [True, False]
    assert apply(spark, filters.is_parsable, TYPES) == [False, False, True, True, True, False, True, False]


def test_content_filters(spark):
    bodies = [None, "", "x" * 149, "x" * 150, "é" + "x" * 148]
    usable_text = apply(spark, lambda body: filters.is_usable(F.lit("text/html"), body), bodies)
    assert usable_text == [False, False, True, True, True]
    assert apply(spark, lambda body: filters.is_usable(F.lit("application/pdf"), body), bodies) == [True] * 5
    assert apply(spark, lambda body: filters.is_usable(F.lit(None), body), bodies) == [False] * 5
    page = apply(spark, lambda body: filters.is_page(F.lit("text/html"), body), bodies)
    assert page == [False, False, False, True, True]
    assert apply(spark, lambda body: filters.is_page(F.lit("image/png"), body), bodies) == [False] * 5
    assert apply(spark, lambda body: filters.is_page(F.lit(""), body), bodies) == [False] * 5


def test_plain_text(spark):
    page = ("<!DOCTYPE html>\n<html><HEAD><title>T</title><style>p{}</style></HEAD><body><!-- no > -->"
            "<script>var t='</p>';</script><p>One &amp;amp; two</p>\n\n<b\nclass='x'>three</b>&copy;</body>")
    plain = "a < b and\n c > d &amp;"
    assert apply(spark, text.extract_text, [page, plain, "", None]) == [
        "One &amp; two three ©", plain, "", ""]
    gated = apply(spark, lambda body: text.gated_text(F.lit("application/pdf"), body), [page])
    assert gated == [""]


OLD = {  # The patterns in their plain form; on broken pages they take quadratic time.
    "comment": r"(?s)<!--.*?(?:-->|\Z)", "head": r"(?is)<head\b[^>]*>.*?</head\s*>",
    "code": r"(?is)<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|\Z)", "tag": r"(?s)<[^>]+>", "blanks": r"[ \t\r\n]+"}
MARKS = ["<", ">", "<>", "<head>", "<head", "</head >", "</head>", "<HEAD a='>'>", "<title>", "</title>", "<title", "<script>", "</script>",
         "<script", "</script", "<style x>", "</style\n>", "<!--", "-->", "<meta name=a content=b>", "<meta ", "<meta name='q'", "<p>",
         "word", " ", "\n", "'", '"', "<a href=/x>", "<script src=y>", "<a href='"]


def random_pages(count):
    dice = random.Random(2)
    return ["".join(dice.choices(MARKS, k=dice.randrange(1, 14))) for _ in range(count)]


def test_markup_patterns_equal_their_plain_form(spark):
    pages = random_pages(4000)
    expected = []
    for page in pages:
        for pattern in OLD.values():
            page = re.sub(pattern, " ", page)
        expected.append(page.strip(" "))
    assert apply(spark, lambda body: text.markup_to_text(body, lambda plain: plain), pages) == expected


def test_metadata_and_scripts_equal_their_plain_form(spark):
    pages = random_pages(4000)
    found = apply(spark, lambda body: text.metadata_map(body, F.lit("text/html")), pages)
    for page, names in zip(pages, found):
        titles = [re.sub(OLD["blanks"], " ", title).strip(" ") for title in re.findall(r"(?is)<title\b[^>]*>(.*?)</title\s*>", page)]
        metas = [tag for tag in re.findall(r"(?is)<meta\s[^>]*>", page) if re.search(r"\sname\s*=\s*[^\s>]", tag)]
        assert names.get("title", []) == titles and sum(len(values) for name, values in names.items() if name in "aq") == len(metas)
    visible = apply(spark, lambda body: F.regexp_replace(body, text.SCRIPT_BODY, "$1$2"), pages)
    assert visible == [re.sub(r"(?is)(<script\b[^>]*>).*?(?:</script\s*>|\Z)", r"\1", page) for page in pages]


@pytest.mark.parametrize("mark", ["<", " < ", "<title>", "<title", "<head>", "<head ", "</head><head>", "<meta ", "<meta name='", "<script ",
                                  "<script>", "</script", "<!--", "<a href=\"", "<a href='x ", "<base href=", "\n \t", "<a \"'"])
def test_broken_pages_take_time_in_proportion(spark, mark):
    page = (mark * 1_000_000)[:1_000_000]
    df = spark.createDataFrame([(page,)], "v string").cache()
    df.count()
    kind, body = F.lit("text/html"), F.col("v")
    started = time.perf_counter()
    df.select(F.length(text.extract_text(body, content_type=kind)), F.size(text.metadata_map(body, kind)),
              F.size(text.raw_links(body)), text.base_url(F.lit("http://h/"), body)).collect()
    # A million characters through all patterns; the plain patterns took minutes to half an hour.
    assert time.perf_counter() - started < 5


def test_all_entities(spark):
    pages = ["<html><body>&eacute;&#233;&#xE9; &amp;lt; x</body>", "plain &eacute;", "<html>none</html>", None]
    assert apply(spark, lambda body: text.extract_text(body, decode_all_entities), pages) == [
        "ééé &lt; x", "plain &eacute;", "none", ""]


def test_all_entities_of_html_5(spark):
    names = sorted(name for name in html5 if name.endswith(";"))
    whole = " ".join(f"&{name}" for name in names)
    texts = ["&apos;&hellip;&NotEqualTilde;&CounterClockwiseContourIntegral;", "&#00000039;&#x0000000027;&#39;&#8364;", whole,
             "&#0;&#x110000;&#99999999999999999999;&#x80;&#146;", "&#" + "0" * 40 + "65;&nope; a&b; &; &#; &#x;"]
    assert apply(spark, decode_all_entities, texts) == [html.unescape(item) for item in texts]
    # References without a semicolon stay.
    assert apply(spark, decode_all_entities, ["?a=1&copy=2 &lt x &#65 y", "&&amp;amp;", "&lt;&#38;lt;"]) == [
        "?a=1&copy=2 &lt x &#65 y", "&&amp;", "<&lt;"]


def test_metadata(spark):
    page = ('<html><head><title> A\n title</title><meta charset=utf-8><META name="k" content="1">'
            "<meta content='2 &amp; 3' name='k'><meta property=\"og:x\" content=\"y\"><meta http-equiv=a content=b>"
            '<meta name="empty"></head>')
    found = apply(spark, text.metadata_map, [page, "plain <title>no</title>", None])
    assert found == [{"title": ["A title"], "k": ["1", "2 & 3"], "og:x": ["y"], "a": ["b"], "empty": [""],
                      "charset": ["utf-8"]}, {}, {}]


def test_links(spark):
    page = ('<html><body><a href="/a">x</a><A class=y HREF=\'/b\'>x</A><img alt="" src=/c.png>'
            '<a href="/a">again</a><!-- <a href="/hidden">x</a> --><script src="/s.js">"<a href=/no>"</script>'
            '<a href="?x=1&amp;y=2">q</a><a data-href="/not">n</a><a href="">e</a>')
    assert apply(spark, text.raw_links, [page]) == [["/a", "/b", "/c.png", "/s.js", "?x=1&y=2"]]
    base = apply(spark, lambda body: text.base_url(F.lit("http://h/"), body),
                 ['<base href="http://o/d/">', '<base href="/d/">', "none"])
    assert base == ["http://o/d/", "http://h/", "http://h/"]


def test_tokens(spark):
    texts = ["a b\nc", "  a  b ", "a\tb", "\ta \t b\t\n c\r", "  a  ", "Foo foo.", "", " \n ", "\t"]
    assert apply(spark, text.tokens, texts) == [
        ["a", "b", "c"], ["a", "b"], ["a\tb"], ["a", "b", "c"], ["a"], ["Foo", "foo."], [], [], []]


def test_value_kinds(spark):
    samples = ["12", "+5", "9" * 18, "9" * 19, "TRUE", "1.5", "1e5", "1e+5", " 7 ", "", "x", "-1."]
    assert apply(spark, values.value_kind, samples) == [
        "long", "long", "long", "double", "boolean", "double", "text", "double", "long", "text", "text", "text"]
    lists = [["1", "x", " 2 "], ["x", "1"], []]
    assert apply(spark, values.list_kind, lists, "v array<string>") == ["long", "text", None]
    like_first = apply(spark, lambda v: values.values_of_kind(v, values.list_kind(v)), lists, "v array<string>")
    assert like_first == [["1", "2"], ["x"], []]


def test_field_names(spark):
    names = ["id", "Author", "Last Modified", "size_l", "x_md"]

    def named(kind, multiple):
        return apply(spark, lambda name: values.metadata_field_name(name, F.lit(kind), F.lit(multiple)), names)

    assert named("text", False) == ["id_md", "author_t_md", "lastmodified_t_md", "size_l_t_md", "x_md_t_md"]
    assert named("long", False)[3] == "size_l_md"
    assert named("double", True)[1] == "author_ds_md"
