import time
import random
from html.parser import HTMLParser

from docflow.operators import document_blocks, document_tables


class Tables(HTMLParser):
    """Brute force: a stack of open tables, one list of rows each."""

    def __init__(self):
        super().__init__()
        self.tables, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append(self.tables[-1])
        elif self.open and tag == "tr":
            self.open[-1].append([])
        elif self.open and tag in ("td", "th"):
            self.open[-1][-1].append("")

    def handle_endtag(self, tag):
        if tag == "table":
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1] and self.open[-1][-1]:
            self.open[-1][-1][-1] += data


def random_table(rng, depth):
    def cell():
        inner = random_table(rng, depth - 1) if depth and rng.random() < 0.4 else ""
        tag = rng.choice(["td", "th"])
        return f"<{tag}>{rng.choice(['', 'a', 'b&amp;', 'é'])}{inner}{rng.choice(['', 'z'])}</{tag}>"

    rows = ["<tr>" + "".join(cell() for _ in range(rng.randint(1, 3))) + "</tr>" for _ in range(rng.randint(0, 3))]
    return "<TABLE class='x'>" + "".join(rows) + "</table>"


def cells(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "document_path long, content string")
    return {tuple(r) for r in document_tables(df).collect()}


def test_tables_against_brute_force(spark):
    rng = random.Random(7)
    pages = ["x" + "".join(random_table(rng, 3) for _ in range(rng.randint(0, 3))) + "y" for _ in range(200)]
    expected = set()
    for page, html in enumerate(pages):
        parser = Tables()
        parser.feed(html)
        for t, rows in enumerate(parser.tables):
            for r, row in enumerate(rows):
                expected |= {(page, t, r, c, text.strip()) for c, text in enumerate(row)}
    assert cells(spark, pages) == expected and len(expected) > 500


def test_untidy_tables(spark):
    assert cells(spark, ["<table><tr><td>a<td>b<tr><td> c\n<p>d</table></table>e", "<p>none"]) == {
        (0, 0, 0, 0, "a"), (0, 0, 0, 1, "b"), (0, 0, 1, 0, "c d"),
    }
    assert cells(spark, ["<table><script><table></script><tr><td>never closed"]) == {
        (0, 0, 0, 0, "never closed")
    }


def plain_grid(rows):
    """Cells by filling every covered place of a table, one by one."""
    taken, found = set(), []
    for r, row in enumerate(rows):
        col = 0
        for down, across, text in row:
            while (r, col) in taken:
                col += 1
            found.append((r, col, min(down or 99, len(rows) - r), across, text))
            taken |= {(y, x) for y in range(r, r + (down or 99)) for x in range(col, col + across)}
            col += across
    return found


def test_spans_against_every_place_of_the_grid(spark):
    rng = random.Random(11)
    pages, expected = [], []
    for page in range(300):
        rows = [[(rng.choice([1, 1, 1, 2, 3, 0]), rng.choice([1, 1, 1, 2, 4]), rng.choice("abc")) for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 7))]
        quoted = lambda n: rng.choice([f"{n}", f"'{n}'", f'" {n}"'.replace(" ", "")])

        def tag(down, across, text):
            spans = ("" if down == 1 else f" rowspan={quoted(down)}") + ("" if across == 1 else f" COLSPAN={quoted(across)}")
            return f"<td{spans}>{text}</td>"

        pages.append("<table>" + "".join("<tr>" + "".join(tag(*c) for c in row) + "</tr>" for row in rows) + "</table>")
        expected += [(page, 0, *cell) for cell in plain_grid(rows)]
    df = spark.createDataFrame(list(enumerate(pages)), "document_path long, content string").repartition(3)
    found = [tuple(r) for r in document_tables(df, spans=True).collect()]
    assert sorted(found) == sorted(expected)


def test_odd_spans(spark):
    def laid(html):
        df = spark.createDataFrame([("p", html)], "document_path string, content string")
        return [tuple(r)[2:] for r in document_tables(df, spans=True).collect()]

    assert laid("<table><tr><td rowspan=99999 colspan=99999>a<td rowspan=-1 colspan=1.5>b<tr><td>c") == [
        (0, 0, 2, 1000, "a"), (0, 1000, 1, 1, "b"), (1, 1000, 1, 1, "c"),
    ]
    # Rows without cells count where cells from above fill them.
    assert laid("<table><tr></tr><tr><td rowspan=2>a</tr><tr></tr><tr></tr><tr><td>b</table>") == [(0, 0, 2, 1, "a"), (2, 0, 1, 1, "b")]
    assert laid("<table><tr><td rowspan=2>a<table><tr><td colspan=3>i<td>j</table><td>b<tr><td>c</table>") == [
        (0, 0, 2, 1, "a"), (0, 1, 1, 1, "b"), (1, 1, 1, 1, "c"), (0, 0, 1, 3, "i"), (0, 3, 1, 1, "j"),
    ]
    assert laid("<table><tr><td title='a > b' rowspan=2>a<td>b<tr><td>c</table>")[2] == (1, 1, 1, 1, "c")


def test_time_of_spans_grows_with_the_table_only(spark):
    import time

    for row in ("<tr><td rowspan=65534 colspan=1000>x", "<tr><td rowspan=2 colspan=1000>x<td>y", "<tr><td rowspan=9000>x"):
        df = spark.createDataFrame([("p", "<table>" + row * 3000)], "document_path string, content string")
        start = time.monotonic()
        assert document_tables(df, spans=True).count() >= 3000
        assert time.monotonic() - start < 20


def test_blocks(spark):
    text = "# T\n\n- a\n- b\n\ntext\nmore\n\n| a |\n|---|\n\n<!-- image -->\n\n![Image](data:x)\n\n#no"
    df = spark.createDataFrame(
        [("p", True, text), ("q", False, "")], "document_path string, success boolean, content string"
    )
    blocks = [(r.pos, r.kind, r.text) for r in document_blocks(df).collect()]
    assert [b[1] for b in blocks] == ["heading", "list", "paragraph", "table", "image", "image", "paragraph"]
    assert blocks[2] == (2, "paragraph", "text\nmore")


def test_time_of_tables_grows_with_their_number_only(spark):
    def seconds(n):
        df = spark.createDataFrame([("p", "<table><tr><td>x</td></tr></table>" * n)], "document_path string, content string")
        begun = time.perf_counter()
        assert document_tables(df).count() == n
        return time.perf_counter() - begun

    seconds(100)
    assert seconds(20_000) < 20 * max(seconds(2_000), 0.5)
