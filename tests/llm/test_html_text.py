import pytest

from varloom.llm.html_text import _Columns, extract, render


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
    ("<ul><li>x<li>y<ul><li>z</ul><li>w</ul>t", "- x\n- y\n  - z\n- w\n\nt"), ("<ol start=3><li>a<br>b<li>c</ol>", "3. a\n   b\n4. c"),
    ("<table><caption>Cap</caption><tr><td>a<td>bbb<tr><th colspan=2>wide cell<tr><td>long cell<td>1</table>after", "Cap\na          bbb\nwide cell\nlong cell  1\n\nafter"),
    ("<table><td>1<td>2<tr><td>3</table>", "1  2\n3"), ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"),
    ('<div style="display: none">x</div><span hidden>y</span><input type=hidden value=q>z', "z"),
    ('a &lt; b &amp;&#x41; <!-- <b>no</b> --> c<script>var t="</p>";</script>d', "a < b &A cde"[:-1]),
    ("<head><title>T</title><body>b", "b"), ("<p>one two\n three <b> four</b>five</p>", "one two three fourfive"),
    ("<dl><dt>t<dd>d</dl>", "t\n    d"), ("<blockquote>q<p>r</blockquote>", "    q\n\n    r"), ("a<!-->b", "ab"), ("<p title='>'>x", "x"), ("x<y z", "x"), ("1 < 2", "1 < 2"),
    ("<select><option>a<option>c</select>b", "a b"), ("<select><option>a<option selected>c</select>", "c"), ("<select multiple><optgroup><option>a<option>c</select>", "a c"), ("<datalist><option>a</datalist>b", "b"),
    ("<svg><title>no</title><text>seen</text></svg>", "seen"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"), ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<style>.a, p#b, em{display:none} @media print{.c{display:none}} .d .e{display:none}</style><i class='z a'>1</i><p id=b>2</p><div id=b>3</div><em>4</em><i class=c>5</i><i class=e>6</i>", "3\n56"),
    ("<style media=print>.a{display:none}</style><i class=a>1</i>", "1"), ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"), ("<table><tr>t<td>a</table>", "t\na"),
    ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>", "a     b\n      c\nd  e  f"), ("<table><tr><td>a<td><table><tr><td>1<td>2<tr><td>3</table><td>z</table>", "a  1  2  z\n   3"),
    ("<table><tr><td colspan=1000>wide<td>x<tr><td>1</table>", "wide  x\n1"), ("<img alt='pic'> t", "pic t"), ("<textarea>a\n b</textarea>", "a\n b"), ("</p>x", "x"),
    ("<map><p>in map</p></map>", "in map"), ("<object data=x><p>fallback</object>", "fallback"), ("<input value=seen><input type=password value=no><input type=checkbox value=no><input type=odd value=' too'>", "seen too"),
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</div>", "b"), ("<style>.a{display:none}.a{display:block}</style><p class=a>x", "x"), ("<p style='display:none;display:block'>x", "x"),
    ("<p style='display:none;display:odd'>x", ""), ("<style>#i{display:block}p{display:none}</style><p id=i>x<p>y", "x"), ("<style>p{display:none!important}#i{display:block}</style><p id=i style='display:block'>x", ""),
    ("<style>.b{visibility:hidden}.c{visibility:visible}</style><ul class=b><li>x<li class=c>y</ul>", "- y"), ("<div style='display:none'><b style='display:block;visibility:visible'>x</b></div>", ""), ("<style>p{display:block}</style><p hidden>x", "x"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"), ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"), ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"), ("<ol type=I start=4><li>x<li>y</ol>", "IV. x\nV. y"),
    ("<table><tr><td style='visibility:hidden'>aaa<td>b<tr><td>c<td>d</table>", "   b\nc  d"), ("<table><tr style='visibility:collapse'><td>a<tr><td>b</table>", "b"), ("<table style='visibility:hidden'><tr><td>a<td style='visibility:visible'>b</table>", "  b"),
    ("<table><tr><td rowspan=2>a<td>b<td rowspan=0>c<tr><td>d<tr><td>e<td>f<td>g</table>", "a  b  c\n   d\ne  f     g"),
])
def test_render(page, text):
    assert render(page) == text


def test_deep_and_long_pages_do_not_fail():
    assert render("<div>" * 20_000 + "deep") == "deep"
    assert render("<table>" * 300 + "x").strip() == "x"
    assert render("<p>" + "w " * 200_000).count("w") == 200_000


def test_work_follows_the_length_of_a_page():
    import time

    took = []
    for n in (10_000, 80_000):
        began = time.process_time()
        for page in ("<div>" * n, "<p><button>" + "<div>" * n, "<b>" * n + "</i>" * n, "<table><tr><td>" + "<li>x" * n, "<ul><li>" * n):
            render(page)
        took.append(time.process_time() - began)
    assert took[1] < 30 * max(took[0], 0.02)  # eight times the length


def test_work_follows_the_length_of_tables():
    import time

    took = []
    for n in (1_000, 8_000):
        began = time.process_time()
        for page in (
            "<table><tr>" + "<td>x" * n, "<table><tr>" + "<td colspan=1000 rowspan=0>x" * 20 + "<tr><td>y" * n, "<table><tr>" + "<td rowspan=0>x" * (n // 10) + "<tr><td>y" * n,
            "<table><tr>" + "<td>x" * n + "<td>" + "y<br>" * n, "<table>" + "<tr><td rowspan=3>x" * n, "<style>" + "p.a{display:block}" * n + "</style><p class=a>x",
        ):
            assert "x" in render(page)
        took.append(time.process_time() - began)
    assert took[1] < 24 * max(took[0], 0.02)  # eight times the length


def test_held_columns_by_brute_force():
    import random

    rng = random.Random(3)
    for _ in range(300):
        table = [[(rng.choice([1, 1, 2, 4]), rng.choice([1, 1, 2, 3, 9])) for _ in range(rng.randrange(5))] for _ in range(6)]
        columns, until = _Columns(), {}
        for n, cells in enumerate(table):
            columns.row(n)
            free = lambda c: until.get(c, 0) <= n  # noqa: B023, E731
            col = 0
            later = []
            for across, down in cells:
                want = next(c for c in range(col, 200) if free(c))
                assert columns.free(col) == want
                if down > 1:
                    later.append((want, want + across, n + down))
                col = want + across
            for a, b, rows in later:
                columns.hold(a, b, rows)
                until |= {c: rows for c in range(a, b) if free(c)}


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "old", 7, "x")], "page_id long, html string, text string, n_chars int, text_sha256 string")
    assert [(r.page_id, r.text, r.n_chars) for r in extract(pages).collect()] == [(1, "a", 1)]


def test_table_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "u", "")], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.text, r.n_chars, r.n_lines) for r in extract(pages).collect())
    assert got == [(0, "", 0, 0), (1, "a", 1, 1), (1, "a", 1, 1), (2, "", 0, 0)]
    assert extract(pages.limit(0)).count() == 0
