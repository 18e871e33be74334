"""Layout of visible text."""

import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

import pytest

from receiptflow.llm.html_text import extract_text, visible_text

CASES = [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a<p>b", "a\n\nb"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<p>x <b> y</b>z</p>", "x yz"),
    ("<p>x<b> y</b> <i>z</i></p>", "x y z"),
    ("<head><title>t</title><style>p{}</style></head><body>b<script>if (a</p>) x</script>c", "bc"),
    ("<p hidden>a</p>b<span style='x:y; DISPLAY : none'>c<b>d</b></span>e", "be"),
    ("<details><summary>s</summary>t<p>u</details>v<details open><summary>w</summary>x</details>", "s\nv\nw\nx"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><caption>T<tr><td colspan=2>long text here<tr><td>a<td>b</table>", "T\nlong text here\na  b"),
    ("<table><tr><td>x<table><tr><td>1<td>2</table></td><td>y</table>", "x     y\n\n1  2"),
    ("<pre> a\n  b</pre>c", " a\n  b\n\nc"),
    ("<blockquote>q<p>r</blockquote>", "> q\n\n> r"),
    ("a &lt;b&gt; &amp;amp; &#233;<!-- x --> 1 < 2", "a <b> &amp; é 1 < 2"),
    ("<img alt='pic'><input type=hidden value=3>t<textarea>a <b></textarea>", "pict"[:3] + "ta <b>"),
    ("<h1>A</h1><section><h2>B</h2>text</section>", "A\n\nB\n\ntext"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n    d\nu"),
    ("</p></div>x</span>", "x"),
    ("<a href='unclosed", ""),
    ("x<a href=\">\">y</a>", "xy"),
    ("<template>no</template><noscript>shown </noscript><dialog>no</dialog><dialog open>yes</dialog>", "shown\nyes"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td>k<td rowspan=2>x<br>y<br>z<td>b<tr><td>long<td>c</table>", "k     x  b\nlong  y  c\n      z"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tr><td rowspan=2 colspan=2>ab<td>1<tr><td>2<tr><td>x<td>y<td>3</table>", "ab    1\n      2\nx  y  3"),
    ("<svg><title>no</title><text x=1>one</text><g><text>two<tspan>x</tspan></text></g>no</svg>after", "one\ntwox\nafter"),
    ("<svg width=1/>a<math/>b", "ab"),
    ("<svg><defs><text>no</text></defs><path d='x'/><foreignObject><p>in</p></foreignObject></svg>z", "in\n\nz"),
    ("<svg><g><p>out", "out"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
    ("<object data=x>fall<b>back</b></object>", "fallback"),
    ("<p style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</p>", "yes"),
    ("<input type=submit value='Send it'><input value=typed><input type=checkbox value=no><input type=image alt=pic>", "Send it typed pic"),
    ("<style>.h{display:none} #i, p.x{visibility:hidden}</style>a<b class='q h'>no</b><i id=i>no</i><p class=x>no<p>b", "a\n\nb"),
    ("<b class=h>no</b>a<style>/* .h{} */ .h{color:red;display : NONE}</style>", "a"),
    ("<style>@media print{.a{display:none}} @media screen{.b{display:none}} div .c{display:none}</style><i class=a>a</i><i class=b>b</i><i class=c>c</i>", "ac"),
    ("<style>p{display:none}.s{display:block}.t{display:none!important}</style><p>no<p class=s>yes<p class=t style='display:block'>no<p style='display:block'>in", "yes\n\nin"),
    ("<b hidden style='display:inline'>x</b>", "x"),
    ("<style>.h{display:none}", ""),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_cases(html, text):
    assert visible_text(html) == text


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_no_word_is_lost_or_doubled():
    rng = random.Random(6)
    tags = ["p", "div", "ul", "li", "b", "table", "tr", "td", "h2", "pre", "blockquote", "span", "section"]
    for _ in range(300):
        parts = []
        for k in range(rng.randint(1, 40)):
            tag = rng.choice(tags)
            parts.append(rng.choice([f"<{tag}>", f"</{tag}>", f" w{k} ", f"<{tag} class='x'> v{k} ", "<script>s()</script>"]))
        html = "".join(parts)
        reader = Plain()
        reader.feed(html)
        reader.close()
        assert sorted(re.findall(r"[wv]\d+", visible_text(html))) == sorted(re.findall(r"[wv]\d+", " ".join(reader.out))), html


def test_deep_and_long_pages(spark):
    rows = [(1, None), (2, ""), (3, "<div>" * 30_000 + "deep"), (4, "<p>" + "word " * 200_000), (4, "<li>x"), (4, "<li>x")]
    table = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 AS TEXT")
    got = extract_text(table).collect()
    assert [r.text if r.page_id != 4 or len(r.text) < 9 else len(r.text) for r in got] == [None, "", "deep", 999_999, "- x", "- x"]
    assert extract_text(table.limit(0)).count() == 0


def brute_table(rows):
    """One-line cells on a grid: (text, columns, rows) each."""
    grid, width = {}, {}
    for r, row in enumerate(rows):
        c = 0
        for text, columns, down in row:
            while (r, c) in grid:
                c += 1
            for i in range(down):
                for j in range(columns):
                    grid[r + i, c + j] = (text if (i, j) == (0, 0) else "", columns if j == 0 else 0)
            if columns == 1:
                width[c] = max(width.get(c, 0), len(text))
            c += columns
    out = []
    for r in range(len(rows)):
        line = ""
        last = max((c for i, c in grid if i == r), default=-1)
        c = 0
        while c <= last:
            text, columns = grid.get((r, c), ("", 1))
            columns = columns or 1
            room = sum(width.get(c + j, 0) for j in range(columns)) + 2 * (columns - 1)
            line += text.ljust(room) + "  "
            c += columns
        out.append(line.rstrip())
    return "\n".join(out).strip("\n")


def test_tables_against_a_grid():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(1, 5)
        taken, rows = {}, []
        for r in range(n):  # cells that do not run into one from above
            row, c = [], 0
            for _ in range(rng.randint(1, 4)):
                while (r, c) in taken:
                    c += 1
                columns = rng.choice([1, 1, 1, 2])
                columns = 1 if any((r, c + j) in taken for j in range(columns)) else columns
                down = min(rng.choice([1, 1, 2, 3]), n - r)
                row.append(("".join(rng.choices("abc", k=rng.randint(1, 6))), columns, down))
                taken.update({(r + i, c + j): 1 for i in range(down) for j in range(columns)})
                c += columns
            rows.append(row)
        html = "<table>" + "".join("<tr>" + "".join(f"<td colspan={c} rowspan={d}>{t}" for t, c, d in row) for row in rows) + "</table>"
        assert visible_text(html) == brute_table(rows), html


HOSTILE = {
    "stack": lambda n: "<b>" * n + "</i>" * n + "<li><blockquote>x" * (n // 8) + "<td>" * n,
    "rowspan": lambda n: "<table>" + "<tr><td rowspan=65534>a" * n,
    "colspan": lambda n: "<table>" + "<tr><td colspan=1000>a<td>b" * n,
    "nested": lambda n: "<table><tr><td>x" * n,
    "nested wide": lambda n: "<table><tr><td>a<td>bb<td>" * n,
    "tall and wide": lambda n: "<table><tr>" + "<td>a" * n + "<td>" + "b<br>" * n + "</table>",
    "one rule": lambda n: "<style>" + ".c{display:block}" * n + "</style>" + "<p class=c>x" * n,
    "many rules": lambda n: "<style>" + "".join(f".c.x{k}{{display:none}}" for k in range(n)) + "</style>" + "".join(f"<p class='c y{k}'>x" for k in range(n)),
    "staircase": lambda n: "<table>" + "".join(f"<tr>{'<td>' * (k % 100)}x" for k in range(n // 50)) + "</table>",
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_linear_time_and_room(kind):
    """Sixteen times the page: at most so many times the time and the text, and none of the text is lost."""
    took, sizes = [], []
    for n in (1000, 4000, 16_000):
        html = HOSTILE[kind](n)
        began = time.process_time()
        text = visible_text(html)
        took.append(time.process_time() - began)
        sizes.append(len(text))
        assert len(text) <= 20 * len(html) + (1 << 17)
        letters = Counter(re.sub(r"<style>.*</style>|<[^>]*>", "", html))
        assert all(text.count(c) >= letters[c] for c in "abx")
    assert took[2] < 40 * max(took[0], 0.02) and took[2] < 6


def test_line_feeds_after_start_tags_and_plain_text():
    assert visible_text("<pre>\n x\n y</pre>") == " x\n y"
    assert visible_text("<pre>\n\nx</pre>").splitlines() == ["", "x"]
    assert visible_text("<textarea>\r\nab</textarea>") == "ab"
    assert visible_text("a<plaintext>b <b>c</b> &amp;\n</plaintext>d") == "a\n\nb <b>c</b> &amp;\n</plaintext>d"


def restated(rows):
    """Blocks of random pages by a second layout: nested lists, paragraphs and one-row tables, written from a tree."""
    out = []

    def walk(node, indent):
        kind, body = node
        if kind == "p":
            gap()
            out.append(indent + body)
            gap()
        elif kind == "div":
            out.append(indent + body)
        elif kind in ("ul", "ol"):
            top = indent == ""
            gap() if top else None
            for k, (text, inner) in enumerate(body):
                mark = "- " if kind == "ul" else f"{k + 1}. "
                out.append(indent + mark + text)
                for x in inner:
                    walk(x, indent + " " * len(mark))
            gap() if top else None
        elif kind == "table":
            gap()
            widths = [max(len(r[c]) for r in body) for c in range(len(body[0]))]
            out.extend("  ".join(t.ljust(w) for t, w in zip(r, widths)).rstrip() for r in body)
            gap()

    def gap():
        if out and out[-1]:
            out.append("")

    for x in rows:
        walk(x, "")
    return "\n".join(out).strip("\n")


def test_random_pages_against_a_second_layout():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdef", k=rng.randint(1, 7)))

    def node(depth):
        kind = rng.choice(["p", "div", "ul", "ol", "table"] if depth == 0 else ["ul", "ol"])
        if kind in ("p", "div"):
            return kind, " ".join(word() for _ in range(rng.randint(1, 5)))
        if kind == "table":
            n = rng.randint(1, 4)
            return kind, [[word() for _ in range(n)] for _ in range(rng.randint(1, 4))]
        return kind, [(word(), [node(depth + 1)] if depth < 3 and rng.random() < 0.4 else []) for _ in range(rng.randint(1, 4))]

    def html(x):
        kind, body = x
        if kind in ("p", "div"):
            return f"<{kind}>  {body.replace(' ', rng.choice(['  ', chr(10), ' <b></b> ']))}</{kind}>"
        if kind == "table":
            return "<table>" + "".join("<tr>" + "".join(f"<td>{t}</td>" for t in r) + rng.choice(["</tr>", ""]) for r in body) + "</table>"
        return f"<{kind}>" + "".join(f"<li>{t}" + "".join(map(html, inner)) + rng.choice(["</li>", "", "\n"]) for t, inner in body) + f"</{kind}>"

    for _ in range(500):
        rows = [node(0) for _ in range(rng.randint(1, 6))]
        page = "".join(map(html, rows))
        assert visible_text(page) == restated(rows), page
