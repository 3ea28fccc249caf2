import itertools
import random
import re
import time

import pytest

from quaywise.llm import html

CASES = {
    "": "",
    "plain &amp; simple": "plain & simple",
    "<p>a<p>b": "a\n\nb",
    "<p>a<div>b</div>c": "a\n\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "a <b> b</b>  <i>c</i>\n d": "a b c d",
    "<h1>T</h1><div>x</div><div>y</div>": "T\n\nx\ny",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "- a\n- b\n  - c\n- d\n\ne",
    "<ol start=3><li>a</li><li value=9>b</li><li>c</li></ol>": "3. a\n9. b\n10. c",
    "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>": "a     bbb\ncccc  d",
    "<table><td>a</td><td>b</td></table>": "a  b",
    "<table><tr><th>h<tbody><tr><td colspan=2>wide<td>z</table>": "h\nwide    z",
    "<table><caption>cap</caption><tr><td>a<br>b<td>c</table>x": "cap\na  c\nb\n\nx",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i  j  k",
    "<pre>a\n  b\n\nc</pre>d": "a\n  b\n\nc\n\nd",
    "<title>no</title><script>no <p></script><style>no</style>yes": "yes",
    "<div hidden>no</div><p style='color:red; display : none'>no</p>yes": "yes",
    "<span style='visibility:hidden'>no</span><span style=\"x:y\">yes</span>": "yes",
    "<!-- no --><!-- a > b -->yes<!-- unclosed": "yes",
    "<input type=hidden value=no>a<img alt='pic ture' src=x>b": "apic tureb",
    "<a href='x>y' title=\"<p>\">link</a>": "link",
    "<dl><dt>T<dd>D<dt>U</dl>": "T\n  D\nU",
    "a<noscript>no</noscript><template>no</template>b": "ab",
    "a < b and c &lt; d": "a < b and c < d",
    "<p>unclosed <b>tags <i>nest": "unclosed tags nest",
    "</p>x</div></table>y": "xy",
    "<b>x</p>y</b>z": "x\n\nyz",
    "<textarea>a <b>\nc</textarea>": "a <b>\nc",
    "<script>never closed <p>no": "",
    "a\0b": "ab",
    "<blockquote>q</blockquote>r": "  q\n\nr",
    "&nbsp;x&#233;&unknown;": " xé&unknown;",
    "<body><body class=x>a</body>b</html>c": "abc",
    "<head>text begins the body": "text begins the body",
    "<": "<", "<a": "", "<a b='": "", "</": "</", "<!": "", "<!doctype html>x": "x",
}


@pytest.mark.parametrize("page", CASES)
def test_rendering(page):
    assert html.page_text(page) == CASES[page]


#: Text outside of cells, drawings, formulas and dialogs.
ANYWHERE = {
    "<table><tbody><form><tr><td>a</td></tr></form></tbody></table>": "a",
    "<table><form hidden><tr><td>a<td>b</tr></form><tr><td>c</table>": "a  b\nc",
    "<table><tbody>note<tr><td>a</table>": "note\n\na",
    "<table><tbody><tr>loose<td>a</tr>after</table>b": "looseafter\n\na\n\nb",
    "<table><tbody><div>d<tr><td>a<td>b</div></table>": "d\n\na  b",
    "<table><tr><td>a</td><span>s<td>b</span></table>": "s\n\na  b",
    "<table><colgroup><col>c<tr><td>a</table>": "c\n\na",
    "<table hidden>shown<tr><td>no</table>": "shown",
    "<table><tbody hidden>shown<tr><td>no<tbody><tr><td>a</table>": "shown\n\na",
    "<table><tr><td>a<table><tbody>i<tr><td>b</table></table>c": "ai\nb\n\nc",
    "<table>x<table><tr><td>y</table>z": "x\n\ny\n\nz",
    "a<svg><title>no</title><g><text>one <tspan>two</tspan></text></g>no<text>3</text></svg>b": "a\none two\n3\nb",
    "<svg><title/><style/><path d='M/'/><defs><text>no</text></defs><text x=1>yes</text></svg>z": "yes\nz",
    "<svg><rect width=5/><text display=none>no</text><text><![CDATA[a > b]]></text></svg>c": "a > b\nc",
    "<svg><foreignObject><p>in <b>html</b></p></foreignObject></svg>x": "in html\n\nx",
    "<svg><text>a<p>b</p>c": "a\n\nb\n\nc",
    "<svg>" + "<path/>" * 400 + "<text>a</text></svg>b": "a\nb",
    "so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>.": "so x= 1 2.",
    "<math><semantics><mi>y</mi><annotation>no</annotation></semantics><mphantom><mi>no</mi></mphantom></math>z": "yz",
    "<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr><mtr><mtd><mn>3</mn></mtd></mtr></mtable></math>": "1 2\n3",
    "<dialog>no</dialog><dialog open>yes</dialog>x": "yes\nx",
}


@pytest.mark.parametrize("page", ANYWHERE)
def test_text_anywhere(page):
    assert html.page_text(page) == ANYWHERE[page]


#: Ends, visibility, spans and controls.
SHOWN = {
    "<body><p>before</p><select><option>a<option>b</select><p>REST</p>": "before\n\na\n\nREST",
    "<select><optgroup label=x><option>a<option selected>b</optgroup></select>c": "b c",
    "<select><option disabled>a<option>b</select><select multiple><option>c<option>d</select>e": "b\nc\nd\ne",
    "<p>x<object><p>no</object>rest": "xrest",
    "<object><p>no<object><p>no</object></object>yes": "yes",
    "<b><option>a</b>b": "a\nb",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>z": "yes\nz",
    "<div style='visibility:hidden'><ul><li>no<li style='visibility:visible'>yes</ul></div>z": "- yes\n\nz",
    "<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>x": "  yes\n\nx",
    "<table><tr style='visibility:collapse'><td>no</tr><tr><td>a</table>": "a",
    "<p style='display:none;display:block'>yes</p>": "yes",
    "<p style='display:block;display:none'>no</p>yes": "yes",
    "<p style='display:none!important;display:block'>no</p>yes": "yes",
    "<p style='display:none;display:bogus'>no</p>yes": "yes",
    "<p hidden style='display:block'>yes</p>": "yes",
    "<svg><text style='visibility:hidden'>no<tspan visibility=visible>yes</tspan></text></svg>": "yes",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>": "a  b\n   c  d",
    "<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d<tbody><tr><td>e<td>f</table>": "a  b\n   c\n   d\ne  f",
    "<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c</table>": "a    b\n     c",
    "<table><tr><td rowspan=9>a<tr><td>b<tbody><tr><td>c<td>d</table>": "a\n   b\nc  d",
    "<table><tfoot><tr><td>f</tfoot><tbody><tr><td>b<thead><tr><td>h</table>": "h\nb\nf",
    "<input type=submit value='Go &amp; see'> <input type=text value=no><input type=image alt=pic>": "Go & see pic",
}


@pytest.mark.parametrize("page", SHOWN)
def test_what_is_shown(page):
    assert html.page_text(page) == SHOWN[page]


def random_page(rng, words, depth=0, seen=True, shown=True):
    """A well-formed page and the words of it that a browser shows, in order."""
    page, visible = [], []
    for _ in range(rng.randint(1, 4)):
        if depth > 5 or rng.random() < 0.4:
            word = f"w{next(words)}"
            page.append(f" {word} ")
            visible += [word] * (seen and shown)
            continue
        name = rng.choice("div p span b ul section blockquote table select object details video script".split())
        style, own_seen, own_shown = "", seen, shown
        kind = rng.randrange(8)
        if kind == 0:
            style, own_shown = " style='display:none'", False
        elif kind == 1:
            style, own_seen = " style='color:red;visibility:hidden'", False
        elif kind == 2:
            style, own_seen = " style='visibility:visible'", True
        elif kind == 3:
            style, own_shown = " hidden", False
        if name == "script":
            page.append(f"<script>w{next(words)} <p></script>")
            continue
        if name in ("object", "video"):
            own_shown = False
        if name == "select":
            options = [f"w{next(words)}" for _ in range(rng.randint(1, 3))]
            page.append(f"<select{style}>" + "".join(f"<option>{x}" for x in options) + "</select>")
            visible += options[:1] * (own_seen and own_shown)
            continue
        inside, found = random_page(rng, words, depth + 1, own_seen, own_shown)
        if name == "ul":
            inside = f"<li>{inside}</li>"
        if name == "table":
            inside = f"<tr><td>{inside}</td></tr>"
        if name == "p":  # a block within would end it
            name = "div" if "<" in inside else "p"
        page.append(f"<{name}{style}>{inside}</{name}>")
        visible += found
    return "".join(page), visible


def test_every_visible_word_once_and_in_order():
    rng = random.Random(11)
    for _ in range(1500):
        page, visible = random_page(rng, itertools.count())
        assert re.findall(r"w\d+", html.page_text(page)) == visible, page


def test_time_is_linear_in_a_line():
    start = time.perf_counter()
    assert html.page_text("<p>" + "word " * 2_000_000).count("word") == 2_000_000  # 10 MB
    assert html.page_text("<p>" + "<i>w</i> " * 200_000).count("w") == 200_000
    assert time.perf_counter() - start < 60


def test_no_word_is_lost_in_tables():
    rng = random.Random(3)
    parts = ["<table>", "<tbody>", "<tr>", "<td>", "<form>", "<div>", "<b>", "<caption>", "<colgroup>", "</table>", "</tr>", "</td>", "</div>", "</form>", "</tbody>", "<p>", "<svg><text>", "</svg>"]
    for _ in range(1000):
        page = "".join(rng.choice(parts) + (f" w{k} " if rng.random() < 0.5 else "") for k in range(30))
        words = set(re.findall(r"w\d+", re.sub(r"</?svg>|<text>", "", page)))
        found = re.findall(r"w\d+", html.page_text(page))
        assert len(found) == len(set(found)) and set(found) == words, page


def test_long_and_deep_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000 + "y"
    assert html.page_text(deep).split() == ["x", "y"]
    assert html.page_text("<table><tr><td>" * 200 + "z").split() == ["z"]
    assert html.page_text("<p>" + "word " * 200_000).count("word") == 200_000
    assert html.page_text("<a " * 20_000) == "" and html.page_text("<a b=\"" * 5_000) is not None


def test_pages(spark):
    schema = "page_id long, url string, html string, text string"
    given = [(1, "u", "<p>a", "clash"), (2, None, None, "clash"), (None, "u", "", "clash"), (1, "u", "<p>a", "clash")]
    found = html.extracted(spark.createDataFrame(given, schema)).collect()
    assert sorted(map(str, found)) == sorted(
        map(str, [r for r in spark.createDataFrame([(1, "u", "a"), (2, None, None), (None, "u", ""), (1, "u", "a")], "page_id long, url string, text string").collect()])
    )
    assert html.extracted(spark.createDataFrame([], schema)).collect() == []
