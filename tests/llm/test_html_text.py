import random
import time

import pytest

from shelfweek.llm import html_text
from shelfweek.llm.html_text import page_text

CASES = [
    ("plain  text\n here", "plain text here"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("a <b>b</b>c <i> d</i> e", "a bc d e"),
    ("<div>one</div><div>two</div>", "one\ntwo"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>a<li>b<ol><li>c<li>d</ol><li>e</ul>", "  - a\n  - b\n     1. c\n     2. d\n  - e"),
    ("<ol start=9><li>a<li>b</ol>", " 9. a\n10. b"),
    ("<table><tr><th>Name<th>N<tr><td>Fig<td>10<tr><td>Apple<td>2</table>", "Name   N\nFig    10\nApple  2"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>", "ab     c\n1   2  3"),
    ("<table><td>x<br>yy<td>z</table>", "x   z\nyy"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\n\nin  ner"),
    ("<head><title>no</title></head><body>yes", "yes"),
    ("<p>a<script>if (x<y) '</p>'</script>b<style>p{}</style>c<!-- no --><noscript>no</noscript>", "abc"),
    ("<p hidden>no</p><p style='color:red; DISPLAY : none'>no<b>no</b></p>yes", "yes"),
    ("<details><summary>s</summary>no<p>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<dialog>no</dialog><template>no</template><input type=submit value=Go><input value=no>", "Go"),
    ("1 &lt; 2 &amp;&copy; &unknown; <3 < 4", "1 < 2 &© &unknown; <3 < 4"),
    ("<pre>\n a\n   b  c\n</pre>", " a\n   b  c"),
    ("<blockquote>q<p>r</blockquote>s", "    q\n\n    r\n\ns"),
    ("<a title='x>y' href=z>link</a>", "link"),
    ("<dl><dt>t<dd>d</dl>", "t\n    d"),
    ("<h1>T</h1>text<hr>more", "T\n\ntext\n\nmore"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<textarea>a <b> &amp;</textarea>", "a <b> &"),
    ("a<wbr>b<img alt=no>c", "abc"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    ("<table><tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b    c\nd       e\nf       g"),
    ("<table><tr><td rowspan=0>a<td rowspan=x>b<tr><td>c</table>", "a  b\nc"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes<i>too</i></b>no</div>", "yestoo"),
    ("<ul><li style='visibility:hidden'>no<li>yes</ul>", "  - yes"),
    ("<div style='display:none'>no<b style='visibility:visible'>no</b></div>yes", "yes"),
    (None, ""), ("", ""), ("<", "<"), ("<b", ""), ("<!--", ""), ("<script>x", ""), ("<p", ""),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_layout(page, text):
    assert page_text(page) == text


def test_any_depth_and_length():
    assert page_text("<div>" * 50_000 + "deep") == "deep"
    assert page_text("<table><tr><td>" * 3_000 + "deep").strip() == "deep"
    assert page_text("a <b>" * 100_000).count("a") == 100_000
    assert page_text("<!--" * 100_000) == ""
    assert page_text("<" * 100_000) == "<" * 100_000


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "deep", "<p><table><tr><td>" + "<div>" * 100_000 + "deep", "<p>" + "<b>" * 100_000 + "deep",
     "<body>" * 100_000 + "deep", "<ul><li>" * 50_000 + "deep", "<div>" * 50_000 + "deep" + "</div>" * 50_000,
     "<i>" * 60_000 + "</b>" * 60_000 + "deep", "<table><tr>" + "<td rowspan=9>" * 3_000 + "deep"],
)
def test_work_grows_with_the_page(page):
    """A hundred thousand nested elements take seconds, whatever is open around them."""
    began = time.perf_counter()
    assert page_text(page).strip().endswith("deep")
    assert time.perf_counter() - began < 5


def brute_grid(cells):
    """Text of a table by placing every cell on a board of squares."""
    board, texts = {}, {}
    for y, row in enumerate(cells):
        x = 0
        for text, columns, rows in row:
            while (y, x) in board:
                x += 1
            for dy in range(rows):
                for dx in range(columns):
                    board[y + dy, x + dx] = True
            texts[y, x] = text
            x += columns
    width = {}
    used = [y for y in range(len(cells)) if any(texts.get((y, x), "") for _, x in board)]
    for (y, x), text in texts.items():
        width[x] = max(width.get(x, 0), len(text))
    lines = []
    for y in used:
        last = max(x for a, x in board if a == y)
        lines.append("  ".join(texts.get((y, x), "").ljust(width.get(x, 0)) for x in range(last + 1)).rstrip())
    return "\n".join(lines).strip("\n")


def test_tables_against_a_board_of_squares():
    """Row and column spans at random; spans that do not overlap."""
    chance = random.Random(5)
    for _ in range(300):
        cells = [
            [("w" * chance.randint(1, 6), chance.choice([1, 1, 2]), 1 if x or y == 4 else chance.choice([1, 2, 3])) for x in range(chance.randint(1, 4))]
            for y in range(5)
        ]
        page = "<table>" + "".join(
            "<tr>" + "".join(f"<td colspan={c} rowspan={r}>{t}" for t, c, r in row) for row in cells
        ) + "</table>"
        assert page_text(page).strip("\n") == brute_grid(cells), page


def test_table_of_pages(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, "u", "<p>a", "old"), (1, "u", "<p>a", "old"), (2, None, None, None), (None, "v", "", "x")]
    found = html_text.extract_text(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "url", "text"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "u", "a"), (1, "u", "a"), (2, None, ""), (None, "v", "")], key=str
    )
    assert html_text.extract_text(spark.createDataFrame([], schema)).collect() == []


def test_all_visible_words_of_real_pages_are_kept(spark):
    """Against the words between tags, once scripts, styles, heads and comments are cut out."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r.text for r in html_text.extract_text(pages, keep=["page_id"]).collect()}
    unseen = re.compile(r"<!--.*?-->|<(script|style|head)\b.*?</\1>", re.S)
    for r in pages.collect():
        words = html.unescape(re.sub(r"<[^>]*>", " ", unseen.sub("", r.html))).split()
        got = [w for w in rows[r.page_id].split() if w != "-"]
        assert "".join(got) == "".join(w for w in words if w != "-")


def test_dotted_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "<p>t", "x", "y")], "page_id bigint, html string, `a.b` string, body string")
    assert [tuple(r) for r in html_text.extract_text(rows).collect()] == [(1, "x", "y", "t")]
    assert html_text.extract_text(rows).columns == ["page_id", "a.b", "body", "text"]
