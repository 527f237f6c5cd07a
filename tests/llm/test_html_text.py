import pytest

from matchledger.llm.html_text import extract_text, op1_html_text, visible_text
from tests.conftest import SF_DIR


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # blocks and spacing
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
        ("a <b> b </b> c\n\n d", "a b c d"),
        ("a<span> </span>b<i>c</i>", "a bc"),
        ("x<br>y<br/><br>z", "x\ny\n\nz"),
        ("<h1>T</h1>text<hr>end", "T\n\ntext\n\nend"),
        ("<pre> a  b\n  c</pre>d", " a  b\n  c\n\nd"),
        ("a&nbsp;&nbsp;b &amp; &lt;c&gt; &copy;", "a  b & <c> ©"),
        ("<blockquote>q<br>r</blockquote>", "    q\n    r"),
        # implied tags
        ("<ul><li>a<li>b</ul>", "- a\n- b"),
        ("<p>a<ul><li>b</ul>", "a\n\n- b"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
        ("<table><tr><td>a<td>b<tr><td>c<td>d</table>", "a  b\nc  d"),
        ("<title>t</title>body", "body"),
        ("<head><style>x</style><p>shown", "shown"),
        ("</p></div>a</b>", "a"),
        ("<b><p>a</b>b</p>c", "ab\n\nc"),
        # lists
        ("<ol><li>a<li>b<ul><li>c</ul></ol>", "1. a\n2. b\n   - c"),
        ('<ol start="9"><li>a<li>b<li value=3>c</ol>', "9. a\n10. b\n3. c"),
        ("<ul><li><li>b</ul>", "-\n- b"),
        ("<ul><li><p>a</p><p>b</p></ul>", "- a\n\n  b"),
        # tables
        ("<table><caption>C</caption><tr><th>Name<th>N<tr><td>long name<td>1</table>", "C\nName       N\nlong name  1"),
        ("<table><tr><td colspan=2>wide<tr><td>a<td>b</table>", "wide\na  b"),
        ("<table><tr><td rowspan=2>x<td>1<tr><td>2</table>", "x  1\n   2"),
        ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
        ("<table><tfoot><tr><td>f</tfoot><tbody><tr><td>b</table>", "b\nf"),
        ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
        # visibility
        ("a<script>x<p></script>b<style>y</style>c<!-- n -->d", "abcd"),
        ("<div hidden>x</div><p style='DISPLAY : none'>y</p>z", "z"),
        ("<p style='visibility:hidden'>x<b style='visibility:visible'>y</b></p>", "y"),
        ("<details><summary>s</summary>t</details><details open><summary>u</summary>v</details>", "s\nu\nv"),
        ("<table><tr><td hidden>x<td>y</table>", "y"),
        ("<noscript>x</noscript><template>y</template><dialog>d</dialog>", ""),
        ("<svg><title>x</title><defs>y</defs><text>t</text><text>u</text></svg>", "t\nu"),
        ("<math><mi>a</mi><mo>=</mo><mn>1</mn><annotation>x</annotation></math>", "a=1"),
        ("<map><area alt=x>m</map>", "m"),
        ("Size <select><option>S<option selected>M<option>L</select> in stock", "Size M in stock"),
        ("<select><optgroup label=x><option>S<option>M</select>", "S"),
        ("<select multiple><option>S<option>M</select>", "S\nM"),
        ("<select></select>", ""),
        # lists that begin with lists
        ("<ul><li><ul><li>a<li>b</ul><li>c</ul>", "- - a\n  - b\n- c"),
        # broken markup
        ("a<![data[y]]>b<![ hi", "ab"), ("a<!doctype html>b<?php x ?>c</ d>e</>f", "abcef"), ("a<!-->b<!--->c<!-- d --!>e", "abce"),
        ("a<b title='x>y'>z</b", "az"), ("<a href=x", ""), ("a</", "a</"), ("a<!", "a"),
        ("<p title=a&amp;b class = 'c'id=d>x", "x"), ("<textarea><b>x</b> &lt;</textarea>", "<b>x</b> <"), ("<script><b></scripty></SCRIPT >x", "x"),
        ("<table><tr><td colspan=%s>a<td rowspan=%s>b</table>" % ("9" * 5_000, "0"), "a  b"), ("&#%s;&#000065;&#x%s;" % ("9" * 5_000, "f" * 5_000), "\ufffdA\ufffd"),
        ("<input type=hidden value=h><input type=submit value=Go> now", "Go now"),
        # odd input
        (None, ""), ("", ""), ("   ", ""), ("just text < 3", "just text < 3"), ("<", "<"), ("&#0;&#xD800;", "��"),
    ],
)
def test_layout(html, text):
    assert visible_text(html) == text


def test_deep_and_long_pages():
    assert visible_text("<div>" * 20_000 + "x") == "x"
    assert visible_text("<table><tr><td>" * 500 + "x") == "x"
    assert len(visible_text("<p>word</p>" * 50_000).split()) == 50_000
    assert visible_text("</b>" * 50_000 + "<b>" * 5_000 + "x") == "x"


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 350_000, "<!--" * 250_000, "<a '" * 250_000, "<a b=" * 200_000, "</a " * 250_000, "<!x" * 350_000, "<script>" * 130_000,
        "<blockquote>x" * 75_000, "<li>x" * 200_000, "<ul><li>" * 125_000 + "x", "&" * 1_000_000, "&#" * 500_000, "<" * 1_000_000,
        "<i><div>" + "<b>" * 160_000 + "</i>" * 125_000, "<table><caption>" * 65_000 + "x", "<table><tr><td>" * 70_000 + "x",
        "<table><tr><td>" + "w" * 500_000 + "<td>z" + "<tr><td>a<td>b" * 35_000 + "</table>",
        "<table><tr>" + "<td colspan=1000 rowspan=1000>" * 33_000 + "x</table>",
        "<table>" + "<tr><td colspan=1000 rowspan=9><td>x" * 25_000 + "</table>",
    ],
    ids=range(19),
)
def test_odd_pages_of_a_megabyte_take_linear_time_and_room(html):
    import time

    begun = time.process_time()
    text = visible_text(html)
    assert time.process_time() - begun < 10
    assert len(text) < 50 * len(html)


def test_deep_structure_keeps_its_text():
    for opening in ("<table><caption>", "<table>", "<table><tr><td>", "<blockquote>", "<ul><li>", "<select>", "<b>"):
        words = visible_text("".join(f"{opening}w{k} " for k in range(1_500))).split()
        if opening != "<select>":
            assert [w for w in sorted(words) if w != "-"] == sorted(f"w{k}" for k in range(1_500)), opening


def test_query_keeps_every_page_and_word(spark):
    rows = op1_html_text(spark, SF_DIR).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert {r.page_id for r in rows} == pages.keys()
    import html
    import re

    for r in rows:
        shown = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>|<style.*?</style>", " ", pages[r.page_id])
        words = html.unescape(re.sub(r"<[a-zA-Z/!][^>]*>", " ", shown)).split()
        assert [w for w in r.text.split() if w != "-"] == words


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<b>same"), (3, "u", "<b>same")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in extract_text(df).collect()), key=repr)
    assert found == sorted([(1, "u", ""), (2, None, ""), (None, "u", "x"), (3, "u", "same"), (3, "u", "same")], key=repr)
    assert extract_text(df.limit(0)).count() == 0
