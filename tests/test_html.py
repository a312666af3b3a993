import random
import re
import time

import pytest
from docflow.config import ConvertConfig
from docflow.functions import html_to_markdown, page_metadata
from docflow.functions import html as html_module
from docflow.functions.charsets import decoded
from docflow.plans.convert import convert_directory
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def md(spark):
    def convert(html, **options):
        df = spark.createDataFrame([(html,)], "html string")
        return df.select(html_to_markdown(F.col("html"), ConvertConfig(**options))).first()[0]

    return convert


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a\n  b<p>c", "a b\n\nc"),
        ("<H1 class=x>T</H1>x<h6>2 six</h6>", "# T\n\nx\n\n###### 2 six"),
        ("a<br>b<BR/>c", "a\nb\nc"),
        ("<ul><li>a</li><li><p>b <b>c</p></ul>z", "- a\n- b c\n\nz"),
        ("&lt;b&gt; &amp;lt; &#233;&#x1F600;&nbsp;x &bogus; &am &#xD800; &#3;", "<b> &lt; é😀 x &bogus; &am &#xD800;"),
        ("1 < 2 and 3 > 2 <x>y</x>", "1 < 2 and 3 > 2 y"),
        ('<a class="q" href="/u?a=1&amp;b=2"><i>l</i> t</a> <a name="n">n</a>', "[l t](/u?a=1&b=2) n"),
        ("<a href='/s'>s</a> <a href=/u>u</a> <a href=\"/open\">open", "[s](/s) [u](/u) open"),
        ("<head><title>t</title></head><nav>n<nav>m</nav></nav>x<footer><nav>a</nav>b</footer>", "x"),
        ("<nav>kept<p>text", "kept\n\ntext"),
        ("a<!-- <p> --><style>p{}</style><SCRIPT>'</p><nav>'</SCRIPT >b", "ab"),
        ("a<script>never closed <p>", "a"),
        ("a<!-- never closed", "a"),
        ("text<a hre", "text"),
        ("<!DOCTYPE html><?xml?>x", "x"),
        ("\x01\x10a\x05\x06b\x07", "a b"),
        ("", ""),
        (None, None),
    ],
)
def test_pieces(md, html, expected):
    assert md(html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("&apos;&check;&hellip;", "'✓…"),
        ("&#150;&#x96;&#0065;", "––A"),
        ("<nav>a<nav>b<nav>c</nav></nav></nav>x", "x"),
    ],
)
def test_entities_and_nesting(md, html, expected):
    assert md(html) == expected


def test_boilerplate_can_stay(md):
    html = "<head>h</head><nav><a href=/x>x</a></nav>y<footer>z</footer>"
    assert md(html, drop_boilerplate=False) == "[x](/x)\n\ny\n\nz"


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<ol><li>a<li>b</ol>", "1. a\n2. b"),
        ("<ol start=9><li>a</li><li><p>b</p></li><li>c</ol>x", "9. a\n10. b\n11. c\n\nx"),
        ("<OL START='x'><LI>a</OL>", "1. a"),
        (
            "t<ul>\n<li>a\n <ol>\n<li>b<ul><li>c</li> <li>d</li></ul></li>\n<li>e</li></ol>\n</li>\n<li>f</li></ul>u",
            "t\n\n- a\n    1. b\n        - c\n        - d\n    2. e\n- f\n\nu",
        ),
        ("<ul><li>a<ul><li>b</li></ul>tail</li><li>c</li></ul>", "- a\n    - b\n    tail\n- c"),
        ("<ul><li>a<ul><li>b</ul> tail<li>c<ul><li>d</ul><p>e</ul>", "- a\n    - b\n    tail\n- c\n    - d\n\ne"),
        ("<ol><li><ul><li>b</ul></ol>", "1.\n    - b"),
        ("<ul><li></li><li>x</li></ul>", "-\n- x"),
        ("<li>loose<li>items</ul>", "- loose\n- items"),
        ("<ul><li>never<li>closed <p>x", "- never\n- closed\n\nx"),
        ("<ul><li>a<ul><li>b", "- a\n\n- b"),
        ("<ul><li>a<br>b</ul><p>5.<p>x", "- a\nb\n\n5.\n\nx"),
        ("<table><tr><td><ul><li>a<li>b</ul><td><ol><li>c</ol></table>", "| - a - b | 1. c |\n|---|---|"),
        ("\x15\x13\x16a\x17\x19b\x1ec\x1f", "a b c"),
    ],
)
def test_lists(md, html, expected):
    assert md(html) == expected


def test_lists_against_a_stack(md):
    """Random lists of any kind and depth against a recursive writer."""
    import random

    rng = random.Random(3)

    def made(depth, level):
        ordered, start = rng.random() < 0.5, rng.randint(0, 120)
        page, lines = f"<ol start={start}>" if ordered else "<ul class=x>", []
        for i in range(rng.randint(1, 4)):
            word = "".join(rng.choice("abcdef") for _ in range(4))
            lines.append("    " * level + (f"{start + i}." if ordered else "-") + f" {word}")
            inner, below = made(depth - 1, level + 1) if depth and rng.random() < 0.5 else ("", [])
            page += f"<li>{rng.choice(['', ' ', '<p>'])}{word}{inner}{rng.choice(['', '</li>', '</li> '])}"
            lines += below
        return page + ("</ol>" if ordered else "</ul>"), lines

    for _ in range(25):
        page, lines = made(4, 0)
        assert md("<p>x" + page + "y") == "x\n\n" + "\n".join(lines) + "\n\ny"


@pytest.mark.parametrize(
    "html, expected",
    [
        ("a<pre>\n  x  y\n\n\tz &lt;b&gt;\r\n</pre>b  c", "a\n\n```\n  x  y\n\n\tz <b>\n```\n\nb c"),
        ("<PRE class='c'><code>if <b>a</b>:\n    b</code></PRE>", "```\nif a:\n    b\n```"),
        ("<pre>a</pre>\n<pre>``` b</pre>", "```\na\n```\n\n``````\n``` b\n``````"),
        ("x<pre>never\n  closed", "x\n\nnever closed"),
        ("<!-- <pre> -->a  b<script>'<pre>'</script>", "a b"),
        ("<prefix>a  b</prefix>", "a b"),
        ("<ul><li>a<pre>x\n y</pre></ul>", "- a\n\n```\nx\n y\n```"),
        ("<table><tr><td><pre>x\n  y</pre></table>", "| `  x y ` |\n|---|"),
    ],
)
def test_verbatim(md, html, expected):
    if "<table>" in html:
        assert "x" in md(html) and md(html).startswith("| `") and md(html).endswith("|\n|---|")
    else:
        assert md(html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('a<i title="x > y">b</i>c', "abc"),
        ("<a href='/q?a>b'>l</a><a title=\"<p>\" href=/u>m</a>", "[l](/q?a>b)[m](/u)"),
        ('<img alt="1 < 2" src="https://e.x/i.png">', "<!-- image -->"),
        ('<p data-x="<script>">shown</p><p title="<!-- no">too</p>', "shown\n\ntoo"),
        ('<a href="/open>l</a> <b class="z">t</b>', 'l t'),
        ("<a href='/open>l</a> it's", "l it's"),
        ('say a="b <i>c</i>" d', 'say a="b c" d'),
        ('1 < 2="<x', '1 < 2="'),
    ],
)
def test_brackets_in_attributes(md, html, expected):
    assert md(html) == expected


TABLE = (
    "a<table><caption>Cap</caption><tr><th>A|B<th><p>C</p></tr>"
    "<tr><td>1</td><td>2\n<b>x</b><br>y</td><td></td></tr></table>b"
)


def test_tables(md):
    assert md(TABLE) == (
        "a\n\nCap\n\n| A\\|B | C |\n|---|---|\n| 1 | 2 x y | |\n\nb"
    )
    assert md(TABLE, tables=False) == "a\n\nCap\n\nA|B\n\nC\n\n1 2 x\ny\n\nb"
    assert md("a | b") == "a | b"


def test_nested_table_keeps_all_text(md):
    text = md("<table><tr><td>o1<table><tr><td>i1</td></tr></table>o2</td><td>o3</td></tr></table>")
    assert [text.count(part) for part in ("o1", "i1", "o2", "o3")] == [1, 1, 1, 1]
    assert "| i1 |\n|---|" in text


def test_image_modes(md):
    html = '<img src="data:image/png;base64,AA=="> <IMG alt=x SRC=https://e.x/i.png> <img>'
    assert md(html) == "![Image](data:image/png;base64,AA==) <!-- image --> <!-- image -->"
    assert md(html, image_mode="referenced") == "<!-- image --> ![Image](https://e.x/i.png) <!-- image -->"
    assert md(html, image_mode="placeholder") == "<!-- image --> <!-- image --> <!-- image -->"


@pytest.mark.parametrize(
    "piece",
    ["<nav>", "</nav>", "<!--", "<script ", "<a href=\"x\">", "<table>", "<", "&", "<td>", " \n", "<p>", "&#1",
     "<ul>", "<ol><li>", "</ul>", "<ul><li>a</ul>", "<li>", "<pre>", "</pre>", "<pre>a\n</pre>", "<a b=\">\">", "<a b='", "<a b=\"<", "='>", "<a ="],
)
def test_time_grows_with_length_only(md, piece):
    """Hostile pages: nothing is searched for again and again to the end of the page."""
    md(piece * 10)
    start = time.monotonic()
    md(piece * 100_000)
    assert time.monotonic() - start < 10


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<head><title>\n a  &amp; b</title></head>", {"title": "a & b"}),
        ("<HEAD><TITLE lang=x>t</TITLE><META NAME=A CONTENT='1 > 0'><meta property=\"og:x\" content=y><meta name=a content=2>", {"a": "1 > 0", "og:x": "y", "title": "t"}),
        ("<meta name=title content=m><title>t</title>", {"title": "t"}),
        ("<meta name=title content=m><body><title>t</title><meta name=b content=c>", {"title": "m"}),
        ("<!-- <title>no</title> --><script>'<meta name=n content=o>'</script><meta charset=utf-8><meta name=e content=''>", None),
        ("<title>never closed", None),
        ("", None),
        (None, None),
    ],
)
def test_page_metadata(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(page_metadata(F.col("html"))).first()[0] == expected


@pytest.mark.parametrize("piece", ["<title>", "<meta name=a content=b>", "<meta ", "<meta name='", "<title", "&amp;"])
def test_time_of_metadata_grows_with_length_only(spark, piece):
    for n in (10, 100_000):
        df = spark.createDataFrame([(piece * n,)], "html string")
        start = time.monotonic()
        df.select(page_metadata(F.col("html"))).collect()
    assert time.monotonic() - start < 10


PAGE = "<p>Grüße – „naïve“ €5"


@pytest.mark.parametrize(
    "data, text",
    [
        (PAGE.encode(), PAGE),
        (b"\xef\xbb\xbf" + PAGE.encode(), PAGE),
        (PAGE.encode("utf-16"), PAGE),
        (b"\xfe\xff" + PAGE.encode("utf-16-be"), PAGE),
        (PAGE.encode("cp1252"), PAGE),
        (b"<meta charset=latin1>" + PAGE.encode("cp1252"), "<meta charset=latin1>" + PAGE),
        (b'<META http-equiv=c content="text/html; charset = \'windows-1252\'">\xc3\xa4', "<META http-equiv=c content=\"text/html; charset = 'windows-1252'\">Ã¤"),
        ("<meta charset='shift_jis'>日本".encode("cp932"), "<meta charset='shift_jis'>日本"),
        ('<?xml version="1.0" encoding="koi8-r"?>Привет'.encode("koi8-r"), '<?xml version="1.0" encoding="koi8-r"?>Привет'),
        (b"<meta charset=utf-16>\xc3\xa4", "<meta charset=utf-16>ä"),
        (b"<meta charset=rot13>\xc3\xa4", "<meta charset=rot13>ä"),
        (b"<meta charset=none-such>\xe4", "<meta charset=none-such>ä"),
        (b"<meta charset=unicode_escape>\\n\xe4", "<meta charset=unicode_escape>\\nä"),
        (b"<meta charset=utf-8>\xe4.", "<meta charset=utf-8>\ufffd."),
        (b"x" * 2000 + b"<meta charset=koi8-r>\xc3\xa4", "x" * 2000 + "<meta charset=koi8-r>ä"),
        (b"\xff\xfea", "\ufffd"),
        (b"\x81\xe4", "\ufffdä"),
        (b"", ""),
    ],
)
def test_charsets(data, text):
    assert decoded(data) == text


def test_pages_of_any_charset_in_a_folder(spark, tmp_path):
    for name, data in (("a", PAGE.encode("cp1252")), ("b", PAGE.encode("utf-16")), ("c", PAGE.encode()), ("d", b"")):
        (tmp_path / f"{name}.html").write_bytes(data)
    rows = convert_directory(spark, str(tmp_path), pattern="*.html", extensions=(".html",)).collect()
    assert sorted(r.content for r in rows) == ["", *[PAGE[3:]] * 3]


def test_tags_of_very_many_attributes(md):
    assert md("<a " + 'b="x" ' * 100_000 + 'c=">">t</a><i title=">">u</i>').endswith("tu")


def test_only_tags_with_brackets_in_values_are_taken_apart():
    # A value that ends with = was taken for the start of one with a bracket, as in every embedded image.
    images = """<p><img src="data:image/png;base64,Tw=="><a href='?q='><b title="x=">a == "b" > c</b>"""
    assert re.search(html_module._QUOTED_BRACKET, images) and not re.search(html_module._TAG_TO_BRACKET, images)
    chance = random.Random(7)
    found = 0
    for _ in range(60_000):
        page = "<a" + "".join(chance.choices("<a =\"'>x", (2, 1, 2, 4, 4, 3, 3, 1), k=chance.randint(3, 18)))
        if any(set(tag[1:-1]) & set("<>") for tag in re.findall(html_module._TAG, page)):
            found += 1
            assert re.search(html_module._QUOTED_BRACKET, page) and re.search(html_module._TAG_TO_BRACKET, page), page
    assert found > 400
