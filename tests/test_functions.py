import random
from urllib.parse import unquote, urljoin

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlspark.functions import html, names, numbers, text, url


def column(spark, values, kind, expression):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.o for r in rows.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


BASES = ["http://a.b/x/y", "http://a.b", "https://a.b:80/x/y/?q=1#f", "http://a.b/x//y/z.html?k"]
HREFS = [
    "", "c", "./c", "../c", "../../../c", "/p//q", "/p/../q/.", "//h/x?", "?q", "?", "#f", "#", "x?#", "x#",
    "mailto:a@b", "http://z/a?#", "https://z/a#", "http:c", "HTTP://Z/a", " /sp ace", "a\nb", "..", ".", "c/..",
    "a//b/", "/für", "x?a=../b", "/a/./b/", "....", "/..", "http://z",
]


def joined(spark, pairs):
    rows = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    found = rows.select("i", url.join_url(url.url_parts(F.col("b")), F.col("h")).alias("o")).orderBy("i").collect()
    return [r.o for r in found]


def test_join_url_agrees_with_the_standard(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    assert joined(spark, pairs) == [urljoin(b, h) for b, h in pairs]


@settings(max_examples=3, deadline=None, derandomize=True, phases=[Phase.generate])
@given(st.lists(st.text(alphabet="ab./?#;:", max_size=9), min_size=40, max_size=40))
def test_join_url_on_random_links(spark, hrefs):
    pairs = [(b, h) for b in BASES[:3] for h in hrefs]
    assert joined(spark, pairs) == [urljoin(b, h) for b, h in pairs]


def test_authority_keeps_port_and_www(spark):
    urls = ["http://www.a.b:8080/x", "https://a.b?q", "ftp://a.b/x", "", "a.b/x"]
    assert column(spark, urls, "string", url.authority) == ["www.a.b:8080", "a.b", "a.b", "", ""]
    assert column(spark, urls, "string", url.is_valid) == [True, True, False, False, False]


def test_percent_decode_keeps_what_is_no_escape(spark):
    values = ["a%20b", "a+b", "100%", "%zz%41", "%C3%BC", "plain"]
    assert column(spark, values, "string", url.percent_decode) == [unquote(v) for v in values]


def test_file_extension(spark):
    urls = ["http://a/x.PDF?y.z", "http://a/x", "http://a.b/", "http://a/x%2Etxt", "http://a/a.b/c"]
    assert column(spark, urls, "string", url.file_extension) == ["pdf", "", "", "txt", "b/c"]


def test_rounding_agrees_with_python(spark):
    random.seed(1)
    values = [2.675, 12.35, 12.25, 0.125, 0.375, 2.5, 1 / 3, 75.0] + [
        random.randint(0, 3000) / random.randint(1, 3000) * 100 for _ in range(2000)
    ]
    for digits in (1, 2):
        found = column(spark, values, "double", lambda v, d=digits: numbers.round_half_even(v, d))
        assert found == [round(v, digits) for v in values]


def test_labels(spark):
    sizes = [0, 1, 1023, 1024, 1536, 5 * 1024**3, 12582912]
    assert column(spark, sizes, "long", numbers.size_label) == [
        "0 B", "1.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "5.0 GB", "12.0 MB",
    ]
    seconds = [45.0, 59.94, 125.0, 8130.0, 93780.0]
    assert column(spark, seconds, "double", numbers.duration_label) == ["45.0s", "59.9s", "2m 5s", "2h 15m 30s", "1d 2h 3m"]


def test_percent_of_nothing_is_zero(spark):
    rows = spark.createDataFrame([(0, 0), (1, 3)], "a long, b long")
    assert [r.o for r in rows.select(numbers.percent(F.col("a"), F.col("b")).alias("o")).collect()] == [0.0, 1 / 3 * 100]


def test_clean_text_replaces_in_order(spark):
    values = ["  a \n\t b ", "&amp;lt;", "x&nbsp;y &#39;z&quot;"]
    assert column(spark, values, "string", text.clean_text) == ["a b", "<", "x y 'z\""]


def test_unescape_is_single_pass(spark):
    values = ["?a=1&amp;b=2", "&amp;lt;", "&#33;&#x4e2d;&#x110000;", "plain", None, "", "a & b; &c"]
    assert column(spark, values, "string", text.unescape_entities) == [
        "?a=1&b=2", "&lt;", "!中�", "plain", None, "", "a & b; &c",
    ]


def test_file_names(spark):
    urls = {
        "http://a.b/x/report%20one.pdf?x": "report-one.pdf",
        "http://a.b/x/é ü_2.tar.gz": "é-ü_2tar.pdf",
        "http://www.a.b/": "a.pdf",
        "http://a.b/.pdf": "pdf.pdf",
        "http://a.b/--a--b.": "a-b.pdf",
        "http://a.b/" + "x" * 150: "x" * 100 + ".pdf",
    }
    assert column(spark, list(urls), "string", names.file_name) == list(urls.values())
    nothing = column(spark, ["http://a.b/***"], "string", names.file_name)[0]
    assert nothing.startswith("document-") and len(nothing) == len("document-.pdf") + 32


def test_title_names_the_file(spark):
    found = column(spark, ["http://a.b/x.pdf"], "string", lambda v: names.file_name(v, F.lit(" My *great* - title ")))
    assert found == ["My-great-title.pdf"]


def test_portable_names(spark):
    values = ["a<b>:c.txt", "con.txt", "  a  b_ .", "x" * 300 + ".pdf", "...", "a\x01b"]
    found = column(spark, values, "string", names.portable_name)
    assert found[:3] == ["a_b_c.txt", "_con.txt", "_a_b_"]
    assert found[3] == "x" * 251 + ".pdf"
    assert found[4].startswith("unnamed_file_")
    assert found[5] == "ab"


def test_paths(spark):
    rows = spark.createDataFrame([("Labour & Co. - (LD)", "n.pdf")], "d string, n string")
    local = rows.select(names.local_path("./downloads", F.col("d"), F.col("n")).alias("o")).first().o
    key = rows.select(names.object_key("/store/", F.col("d"), F.col("n")).alias("o")).first().o
    flat = rows.select(names.object_key(None, F.col("d"), F.col("n"), by_department=False).alias("o")).first().o
    assert (local, key, flat) == ("downloads/Labour-Co-LD/n.pdf", "store/Labour-Co-LD/n.pdf", "n.pdf")


def test_attributes_survive_hostile_markup(spark):
    page = (
        "<a title='>' href=\"a\">1</a><A HREF=b>2</A><a href='c'x=1>3</a><a title=\"x href=no\" href=\"d\">4</a>"
        "<a title=it's href=e>5</a><abbr href=f>6</abbr><a\nhref = 'g'>7</a><a href=\"h>8</a>"
    )
    found = column(spark, [page], "string", lambda v: F.transform(
        F.transform(html.elements(v, "a"), lambda t: html.raw_attribute(t, "href")), html.attribute_value
    ))[0]
    assert found[:6] == ["a", "b", "c", "d", "e", "g"]


def test_a_long_page_costs_no_recursion(spark):
    page = "<p>" + "<a title=\"" + "x " * 200_000 + "\" href='end'>t</a>" + "<!-- " * 2000
    found = column(spark, [page], "string", lambda v: F.transform(
        html.elements(html.without_noise(v), "a"), lambda t: html.raw_attribute(t, "href")
    ))[0]
    assert found == ["'end'"]




def test_entities_are_decoded_once_and_all_names_are_known(spark):
    values = ["&#38;lt;", "&eacute;&apos;&nbsp;", "&#00000000065;", "&#x0000000041;", "&#99999999999;", "&#;", "&nosuchname;x", "&amp;#65;"]
    expected = ["&lt;", "\u00e9'\u00a0", "A", "A", "\ufffd", "&#;", "&nosuchname;x", "&#65;"]
    assert column(spark, values, "string", text.unescape_entities) == expected
