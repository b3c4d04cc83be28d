from pyspark.sql import functions as F

from crawlspark.operators import links, profile
from crawlspark.operators.forms import search_requests
from crawlspark.operators.rules import LinkRule, classify, document_rules

PAGE = """
<html><head><title> T&amp;T </title><style>a{}</style><script>var x = "<a href='/script.pdf'>s</a>";</script></head><body>
<a href="javascript:f('eng','/a/b.PDF')">J</a><a href="javascript:g('b.pdf')">no</a><a href="#top">t</a><a href=" ">b</a>
<a href="/web/viewer.html?x=1&amp;file=https%3A%2F%2Fc.d%2Fq%252Bz.pdf">v</a>
<a href="pdfjs/v?file=../k%2520l+m.pdf">v2</a><a href="pdfjs/v?file=">v3</a>
<a href="one.pdf">1</a><a href="./one.pdf">again</a><a href="html">Annual report page</a><a href="r">Annual <b> report </b></a>
<a href="/Documents/x">q</a><a href="https://o.p/f?format=PDF">o</a>
<!-- <a href="comment.pdf">c</a> -->
<iframe src="/emb?type=pdf"></iframe><div data-url="two.pdf">x</div>
<a hidden href="h.pdf">h</a><a style="color:red;display:none" href="h2.pdf">h</a><button data-href="/z/pdf/1">b</button>
<a href="/archive/1">Old</a><a href="/y/2019/">y</a><a href="http://o.p/archive">off</a><a href="/y/12019">no year</a>
<a name="n">no link</a></body></html>"""
URL = "https://a.b/x/y.html"


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")


def test_links_of_a_page(spark):
    found = links.classified_links(pages(spark, (URL, PAGE))).collect()
    got = [(r.kind, r.target_url, r.rule_ord) for r in found]
    assert got == [
        ("script", "https://a.b/a/b.PDF", 1),
        ("viewer", "https://c.d/q+z.pdf", 0),
        ("viewer", "https://a.b/x/k l m.pdf", 0),
        ("anchor", "https://a.b/x/pdfjs/v?file=", None),
        ("anchor", "https://a.b/x/one.pdf", 1),
        ("anchor", "https://a.b/x/one.pdf", 1),
        ("anchor", "https://a.b/x/html", None),
        ("anchor", "https://a.b/x/r", 5),
        ("anchor", "https://a.b/Documents/x", 17),
        ("anchor", "https://o.p/f?format=PDF", 25),
        ("anchor", "https://a.b/x/h.pdf", 1),
        ("anchor", "https://a.b/x/h2.pdf", 1),
        ("anchor", "https://a.b/archive/1", None),
        ("anchor", "https://a.b/y/2019/", None),
        ("anchor", "http://o.p/archive", None),
        ("anchor", "https://a.b/y/12019", None),
        ("frame", "https://a.b/emb?type=pdf", 26),
        ("data", "https://a.b/x/two.pdf", 1),
    ]
    assert [r.text for r in found][7] == "Annualreport"


def test_documents_are_distinct_and_in_order(spark):
    found = links.document_links(pages(spark, (URL, PAGE))).orderBy("ord").collect()
    assert [r.target_url for r in found] == [
        "https://a.b/a/b.PDF",
        "https://c.d/q+z.pdf",
        "https://a.b/x/k l m.pdf",
        "https://a.b/x/one.pdf",
        "https://a.b/x/r",
        "https://a.b/Documents/x",
        "https://o.p/f?format=PDF",
        "https://a.b/x/h.pdf",
        "https://a.b/x/h2.pdf",
        "https://a.b/emb?type=pdf",
        "https://a.b/x/two.pdf",
    ]
    assert [r.ord for r in found] == list(range(11))


def test_hidden_links(spark):
    found = {(r.kind, r.target_url) for r in links.hidden_links(pages(spark, (URL, PAGE))).collect()}
    assert ("hidden", "https://a.b/x/h.pdf") in found and ("hidden", "https://a.b/x/h2.pdf") in found
    assert ("data", "https://a.b/x/two.pdf") in found and ("data", "https://a.b/z/pdf/1") in found
    assert ("hidden", "https://a.b/x/one.pdf") not in found


def test_archive_links(spark):
    found = links.archive_links(pages(spark, (URL, PAGE))).orderBy("ord").collect()
    assert [r.target_url for r in found] == ["https://a.b/archive/1", "https://a.b/y/2019/"]


def test_archive_keyword_at_a_fragment(spark):
    page = pages(spark, (URL, '<a href="#x">Archive</a><a href="#y">y</a>'))
    assert [r.target_url for r in links.archive_links(page).collect()] == [URL + "#x"]


def test_rules(spark):
    cases = [
        ("http://x/a.PDF", "", 1),
        ("http://x/a.pdf?x=1", "web page", 1),
        ("http://x/a", "Download now", 3),
        ("http://x/a", "Download page", None),
        ("http://x/a", "report html", None),
        ("http://x/DOCUMENT/a", "", 17),
        ("http://x/documents/a", None, 17),
        ("http://x/a?filetype=pdf", "", 24),
        ("http://x/a", "", None),
    ]
    rows = spark.createDataFrame([(i, u, t) for i, (u, t, _) in enumerate(cases)], "i int, u string, t string")
    found = rows.select("i", classify(F.col("u"), F.col("t"), document_rules()).alias("o")).orderBy("i").collect()
    assert [r.o for r in found] == [o for _, _, o in cases]


def test_first_rule_wins_whatever_the_list_order(spark):
    rules = [LinkRule(2, "url", "contains", "a"), LinkRule(1, "url", "pattern", "b")]
    rows = spark.createDataFrame([("ab",), ("a",), ("c",)], "u string")
    assert [r.o for r in rows.select(classify(F.col("u"), F.lit(""), rules).alias("o")).collect()] == [1, 2, None]


def test_search_requests(spark):
    page = """<form action="/find" method="POST"><input type="text" name="zip"><input type="text" NAME="q">
      <input type="hidden" name="l" value="a"><input type="hidden" name="l" value="b"><input type="hidden" value="lost"></form>
      <form><input type="search" placeholder="Search here"></form><form><input type="text" name="zip"></form>"""
    found = search_requests(pages(spark, (URL, page)), ["x", "y", "z", "w"]).orderBy("form_pos", "term").collect()
    assert [(r.form_pos, r.term, r.method, r.form_url, r.params) for r in found] == [
        (0, t, "post", "https://a.b/find", {"l": "b", "q": t}) for t in "xyz"
    ] + [(1, t, "get", URL, {}) for t in "xyz"]


def test_a_form_of_very_many_inputs(spark):
    many = "".join(f'<input type="hidden" name="n{i % 4000}" value="{i}">' for i in range(5000))
    found = search_requests(pages(spark, (URL, f'<form><input type="text" name="q">{many}</form>')), ["x"]).first()
    assert found.params == {f"n{i}": str(i + 4000 if i < 1000 else i) for i in range(4000)} | {"q": "x"}


def test_search_results_keep_what_the_rules_keep(spark):
    page = pages(spark, ("http://s.t/find", '<a href="r.pdf">1</a><a href="r.pdf">2</a><a href="x">Guide</a><a href="y">y</a>'))
    assert [r.target_url for r in links.search_result_links(page).collect()] == ["http://s.t/r.pdf", "http://s.t/x"]


def test_script_weight(spark):
    rows = pages(spark, ("u", "<SCRIPT>" * 6 + " onclick=" * 5), ("v", "<script></script>" * 11 + '<a href="x.pdf">x</a>'), ("w", "<script>"))
    found = {r.url: (r.script_signs, r.document_count, r.requires_browser) for r in profile.script_weight(rows).collect()}
    assert found == {"u": (11, 0, True), "v": (11, 1, False), "w": (1, 0, False)}


def test_page_text(spark):
    row = profile.page_text(pages(spark, (URL, "<title> A  &amp; B</title><script>no</script><p>x&nbsp;y<br>z</p>"))).first()
    assert (row.title, row.text, row.text_length) == ("A & B", "A & B x y z", 11)


def test_site_report(spark):
    found = links.link_counts_by_site(pages(spark, (URL, '<a href="/1">1</a><a href="/1">1</a><a href="http://o.p/">o</a>'))).first()
    assert (found.site, found.links, found.distinct_targets, found.internal, found.external) == ("a.b", 3, 2, 2, 1)


def test_extraction_does_not_shuffle(spark):
    found = links.document_links(pages(spark, (URL, PAGE)))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
