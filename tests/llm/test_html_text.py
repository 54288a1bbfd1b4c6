from __future__ import annotations

import time
from html.parser import HTMLParser

import pytest

from reelhouse.llm import html_text
from reelhouse.llm.html_text import extract_text, html_to_text


class PlainWords(HTMLParser):
    """All words outside head, scripts and styles, in order: what any rendering has to show."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_given_pages_show_all_their_words_in_order(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {row["page_id"]: row["text"] for row in extract_text(pages).collect()}
    rows = pages.collect()
    assert len(texts) == len(rows) > 0
    for row in rows:
        reader = PlainWords()
        reader.feed(row["html"])
        if not row["html"].endswith(">"):
            reader.close()
        shown = [word for word in texts[row["page_id"]].split() if word != "-"]
        assert shown == [word for word in reader.words if word != "-"], row["page_id"]


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just  text\n here &amp; there", "just text here & there"),
        ("<p>One <b>two</b>\n three<p>Four", "One two three\n\nFour"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>d", "- a\n- b\n  3. x\n  4. y\n- c\n\nd"),
        ("<dl><dt>T<dd>D</dl>", "T\n  D"),
        ("<h1>A</h1><h2>B</h2>c", "A\n\nB\n\nc"),
        ("<pre>  x\n   y</pre>z", "  x\n   y\n\nz"),
        ("<blockquote>q</blockquote>r", "  q\n\nr"),
        ("<title>T</title><style>p{}</style><script>var a='</p>'</script>x", "x"),
        ("<head><title>T</title><p>shown", "shown"),
        ("<p hidden>no<p style='Display : None'>no<p>yes", "yes"),
        ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
        ("<details><summary>S</summary>no</details><details open><summary>S</summary>yes</details>", "S\nS\nyes"),
        ("<a href='x>y'>link</a> <!-- no > no --> on", "link on"),
        ("a<!-- open", "a"),
        ("a <b", "a"),
        ("1 < 2 > 0", "1 < 2 > 0"),
        ("<textarea>a\nb</textarea>", "a\nb"),
        ("<noscript>no</noscript><template>no</template>x", "x"),
        ("x</p>y", "x\n\ny"),
        ("<table><tr><td>in", "in"),
        ("&copy; &#65; &nosuch; &lt;b&gt;", "© A &nosuch; <b>"),
    ],
)
def test_layout_rules(html, text):
    assert html_to_text(html) == text


def test_tables_are_aligned():
    html = (
        "<table><caption>Cap</caption><thead><tr><th>Name<th>Qty<tbody><tr><td>apple<td>10<tr><td colspan=2>wide cell here"
        "<tr><td rowspan=2>r<td>1<tr><td>2</table>tail"
    )
    assert html_to_text(html).split("\n") == [
        "Cap", "Name           | Qty", "apple          | 10", "wide cell here", "r              | 1", "               | 2", "", "tail",
    ]
    nested = html_to_text("<table><tr><td>a<table><tr><td>b<td>c</table><td>d|</table>")
    assert nested.split("\n") == ["a     | d|", "", "b | c"]


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 100_000 + "x", '<a "' * 100_000, "<b>" * 50_000 + "</i>" * 50_000, "<table>" * 3000 + "x", "<table><tr>" + "<td>x" * 30_000,
        '<a b="' * 100_000, "<ul><li>" * 5000 + "t", "<!--" * 100_000, "<p>" * 100_000 + "</p>" * 100_000, "<" * 300_000, "&" * 300_000,
    ],
)
def test_hostile_pages_take_linear_time(html):
    begin = time.perf_counter()
    html_to_text(html)
    assert time.perf_counter() - begin < 20


def test_depth_does_not_lose_text():
    assert html_to_text("<i>" * 2000 + "deep" + "</i>" * 2000 + " after") == "deep after"


def test_null_repeated_and_empty_tables_with_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, None, "x"), (2, "<p>a", "y"), (2, "<p>a", "y"), (None, "b", "z")], "page_id long, html string, text string"
    )
    found = extract_text(frame).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, ""), (2, "a"), (2, "a"), (None, "b")], key=str)
    assert extract_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>See <svg><text x=1>Jan</text><text>Feb</text></svg> there", "See Jan Feb there"),
        ("a<svg>no<g><path d='M0'/><text>b<tspan>c</tspan></text></g></svg>d", "a bc d"),
        ("<svg><title>no</title><desc>no<p>no</p></desc><defs><text>no</text></defs><metadata>no</metadata><text>yes</text></svg>", "yes"),
        ("<svg><title/><style/><script/><defs/><text>a</text></svg><p>b", "a\n\nb"),
        ("<svg><text display=none>no</text><g visibility='hidden'><text>no</text></g><text>yes</text></svg>", "yes"),
        ("<svg><text><![CDATA[a < b &amp; c]]></text></svg>", "a < b &amp; c"),
        ("<p>x<svg><foreignObject><div>one</div><div>two</div></foreignObject></svg>", "x\none\ntwo"),
        ("<svg><g><p>out of it</p>on", "out of it\n\non"),
        ("<math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>!", "E=mc2!"),
        ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"),
        ("a<math display=block><mi>x</mi></math>b", "a\nx\nb"),
        ("<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr><mtr><mtd><mn>3</mn></mtd></mtr></mtable></math>", "1 2\n3"),
        (
            "<math><semantics><mi>x</mi><annotation encoding='TeX'>no</annotation>"
            "<annotation-xml encoding='text/html'><p>no</p></annotation-xml></semantics></math>y",
            "xy",
        ),
        ("<math><mtext>if <b>so</b></mtext></math>", "if so"),
        ("<desc>shown</desc><defs>too", "showntoo"),
        ("<table><tr><td><svg><text>in</text></svg><td>b</table>", "in | b"),
        ("<svg>" + "<path/>" * 2000 + "<text>deep</text></svg>end", "deep end"),
    ],
)
def test_svg_and_mathml_show_what_they_draw(html, text):
    assert html_to_text(html) == text


@pytest.mark.parametrize(
    "sheet, body, shown",
    [
        (".h{display:none}", "<p class=h>a<p>b", "b"),
        ("p.h, #x { color: red; DISPLAY : None }", "<p class='big h'>a</p><div class=h>b</div><div id=x>c</div>", "b"),
        ("p{display:none}", "<P>a<div>b</div>", "b"),
        ("p{display:none} p.s{display:block}", "<p>a<p class=s>b", "b"),
        ("p.s{display:block} p{display:none}", "<p>a<p class=s>b", "b"),  # the more special rule wins
        (".a{display:none} .a{display:block}", "<p class=a>a", "a"),  # of equal ones the later
        (".a{display:none !important} .a{display:block}", "<p class=a style='display:block'>a<p>b", "b"),
        (".a{display:none}", "<p class=a style='display:block'>a", "a"),
        ("* {visibility:hidden} b{visibility:visible}", "<p>a <b>b</b>", "b"),
        ("@media print {p{display:none}} /* p{display:none} */", "<p>a", "a"),
        ("@media screen, print {p{display:none} i{display:none}} u{display:none}", "<p>a</p><i>b</i><u>c</u>d", "d"),
        ("@import 'x.css'; @font-face{font-family:x} p{display:none}", "<p>a</p>b", "b"),
        ("@keyframes k { from {top:0} to {top:1px} } p{display:none}", "<p>a</p>b", "b"),
        ("div p{display:none} p:hover{display:none} p[x]{display:none}", "<div><p x>a</p></div>", "a"),  # not applied
        (".h{display:none", "<p class=h>a<p>b", "b"),
        ("{display:none}.h{x-display:none;display:none-such}", "<p class=h>a", "a"),
        (".H{display:none}", "<p class=h>a", "a"),
        ("[hidden]{} p{display:block}", "<p hidden>a", "a"),  # any display overrides the attribute
    ],
)
def test_rules_of_style_sheets(sheet, body, shown):
    assert html_text.html_to_text(f"<head><style>{sheet}</style></head><body>{body}") == shown


def test_sheets_that_do_not_count():
    hide = "<style>p{display:none}</style>"
    for page in (f"<!-- {hide} -->", f"<script>'{hide}</script>", f"<textarea hidden>{hide}</textarea>", hide.replace("<style", "<style media=print"),
                 f"<template>{hide}</template>"):
        assert html_text.html_to_text(f"{page}<p>a") == "a"
    # a sheet counts for what stands before it, too
    assert html_text.html_to_text(f"<p>a</p>b{hide}") == "b"


def test_deep_pages_keep_visibility_and_cells_apart():
    deep = "<div>" * 3000
    assert html_text.html_to_text(f"{deep}<div hidden>a</div>b") == "b"
    assert html_text.html_to_text(f"{deep}<table><tr><td>a<td>b</table>") == "a | b"
    assert html_text.html_to_text("<b>" * 2000 + "<style>i{display:none}</style><i>a</i>b") == "b"
    nested = "<table><tr><td>x</td><td>" * 100 + "y"
    words = html_text.html_to_text(nested).replace("|", " ").split()
    assert words == ["x"] * 100 + ["y"]
    beyond = "<table><tr><td>" * (html_text.MAX_TABLES + 3) + "a<td>b"
    assert html_text.html_to_text(beyond).split() == ["a", "b"]
    assert html_text.html_to_text("<ul><li>" * 2000 + "x").count("x") == 1


def test_time_is_linear_in_deep_pages():
    def seconds(count):
        page = "<div><ul><li>" * count + "word " + "<p>a<table><tr><td>b" * (count // 10) + "<title" * count
        begin = time.perf_counter()
        html_text.html_to_text(page)
        return time.perf_counter() - begin

    seconds(500)
    assert seconds(16_000) < 40 * max(seconds(1000), 0.01)


def test_long_cells_are_aligned_if_that_costs_little():
    long, rows = "w" * 100, "".join(f"<tr><td>{'w' * 100}<td>{n}" for n in range(3))
    assert html_text.html_to_text(f"<table>{rows}<tr><td>short<td>x</table>").split("\n")[-1] == "short" + " " * 95 + " | x"
    page = f"<table><tr><td>{long * 50}<td>a" + "<tr><td>s<td>b" * 500 + "</table>"
    assert html_text.html_to_text(page).split("\n")[-1] == "s" + " " * 47 + " | b"


def test_spans_as_large_as_the_standard_allows():
    page = "<table><tr><td rowspan=1500>a<td>0" + "".join(f"<tr><td>{n}" for n in range(1, 1600)) + "</table>"
    lines = html_text.html_to_text(page).split("\n")
    assert lines[0] == "a    | 0" and lines[1499] == "     | 1499" and lines[1500] == "1500"
