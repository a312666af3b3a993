r"""HTML to Markdown as one native expression.

No Python runs here: the page is cut at every ``<`` and every ``&``, each piece
is rewritten by a higher-order function, and a handful of ``regexp_replace``
calls tidy the rest. The conversion is a plain projection above the scan, so it
moves no data and Spark can drop it where nobody reads the text.

Cutting once costs a fraction of one ``regexp_replace`` per kind of tag. Every
step is linear in the length of the page, also for broken or hostile pages: no
attempt to match can run past the next marker and fail there. (A pattern such
as ``<nav>.*?</nav>`` searches the rest of the page once per unclosed ``<nav>``.)

Private markers stand in for structure between the steps. They are control
characters; the first step turns those of the input into blanks.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.config import ConvertConfig

# --- fixed values ----------------------------------------------------------
# Markers.
DROP, DROP_END = "\x01", "\x02"  # around a part that is left out
TABLE, TABLE_END, ROW, CELL = "\x03", "\x04", "\x05", "\x06"
END = "\x07"
LINK, LINK_TEXT, LINK_END = "\x0e", "\x0f", "\x10"
PARAGRAPH, LINE = "\x11", "\x12"
IMAGE = "\x14"
LIST, NUMBER, ITEM, LIST_END = "\x15", "\x13", "\x16", "\x17"
ITEM_LINE, INDENT, BULLET = "\x0b", "\x18", "\x19"
OPEN, CLOSE = "\x0c", "\x1d"  # around a finished list
FENCE, VERBATIM_LINE, VERBATIM_SPACE, VERBATIM_TAB = "\x1c", "\x1b", "\x1a", "\x08"
QUOTED_LT, QUOTED_GT = "\x1e", "\x1f"  # brackets in values of attributes

# Elements that start and end a block of text.
BLOCK_TAGS = (
    "p div h1 h2 h3 h4 h5 h6 ul ol article section main body address aside blockquote center "
    "dd details dl dt fieldset figcaption figure footer form header hr nav pre summary"
).split()

IMAGE_PLACEHOLDER = "<!-- image -->"

# Entities looked up first; the other names of HTML 5 follow in the library's order.
COMMON_ENTITIES = "amp quot lt gt nbsp copy middot apos".split()
# ---------------------------------------------------------------------------

# Levels of <nav> in <nav> that are left out; deeper ones keep the text around them.
NESTING = 8
# Levels of lists in lists that are indented.
LIST_LEVELS = 12

# Length that takes the rest of any text.
_ALL = 2**31 - 1

# What a reader never sees. An element cut off by the end of the page ends there.
_UNSEEN = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script(?:[\s/][^<>]*)?>.*?(?:</script[^<>]*>|\z)"
    r"|style(?:[\s/][^<>]*)?>.*?(?:</style[^<>]*>|\z))"
)
_CONTROL = r"[\x01-\x1f]"
# A whole tag; the values of its attributes may hold brackets. Nothing is tried twice.
_TAG = r"""<[a-zA-Z][^<>"'=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]*+)[^<>"'=]*+)*+>"""
_QUOTED_BRACKET = r"""=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""
# The same after the start of a tag whose values before it have none: not the end of a value
# with ``=`` at its end, as embedded images have.
_TAG_TO_BRACKET = r"""<[a-zA-Z][^<>"'=]*+(?:=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|(?!["'])[^\s"'<>]*+)[^<>"'=]*+)*+""" + _QUOTED_BRACKET
_VERBATIM = r"(?i)<pre(?=[\s/>])"


def _map(entries: dict[str, str]) -> Column:
    """A constant map, built by one expression that Spark folds into a literal."""
    text = "\x1e".join(f"{key}\x1f{value}" for key, value in entries.items())
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


def _tag_texts(config: ConvertConfig) -> dict[str, str]:
    """What each tag leaves behind; tags not listed leave nothing."""
    # The map is searched from its start, so the most frequent tags come first.
    frequent = "p /p li /li a /a b /b i /i span /span td /td th /th tr /tr br div /div html /html body /body".split()
    texts = dict.fromkeys(frequent, "")
    texts |= {"br": LINE, "/a": LINK_END}
    for name in BLOCK_TAGS:
        texts[name] = texts["/" + name] = PARAGRAPH
    texts |= {"ul": LIST + NUMBER, "/ul": LIST_END, "/ol": LIST_END, "li": ITEM}
    for level in range(1, 7):
        texts[f"h{level}"] = PARAGRAPH + "#" * level + " "
    if config.tables:
        texts |= {"table": TABLE, "/table": TABLE_END, "tr": ROW, "td": CELL, "th": CELL}
        texts["/caption"] = ROW
    else:
        texts |= {"table": PARAGRAPH, "/table": PARAGRAPH, "tr": LINE, "/caption": LINE}
        texts |= dict.fromkeys(("td", "th"), " ")
    for name in ("head", "nav", "footer") if config.drop_boilerplate else ("head",):
        texts[name], texts["/" + name] = DROP, DROP_END
    return texts


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in double, single or no quotes; ``''`` without it."""
    pattern = rf"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])


def _link(tag: Column) -> Column:
    href = attribute(tag, "href")
    return F.when(href != "", F.concat(F.lit(LINK), href, F.lit(LINK_TEXT))).otherwise("")


def _image(tag: Column, mode: str) -> Column:
    if mode == "placeholder":
        return F.lit(IMAGE)
    src = attribute(tag, "src")
    embedded = src.startswith("data:")
    kept = embedded if mode == "embedded" else (src != "") & ~embedded
    return F.when(kept, F.concat(F.lit("![Image]("), src, F.lit(")"))).otherwise(IMAGE)


def _list_start(tag: Column) -> Column:
    """The mark of a numbered list with its first number."""
    first = F.regexp_extract(attribute(tag, "start"), "^([0-9]{1,9})$", 1)
    return F.concat(F.lit(LIST), F.when(first == "", "1").otherwise(first), F.lit(NUMBER))


def keep_quoted_brackets(html: Column) -> Column:
    """The page with marks for ``<`` and ``>`` inside quoted values, where they end no tag.

    Only pages that may hold such are taken apart. A quote that is never closed, or not
    where a value may end, is no quote: the tag then ends at its first bracket.
    """

    def marked(page: Column) -> Column:
        inner = lambda tag: F.translate(F.substring(tag, F.lit(2), F.length(tag) - 2), "<>", QUOTED_LT + QUOTED_GT)
        whole = lambda tag: F.when(tag.isNull(), "").otherwise(F.concat(F.lit("<"), inner(tag), F.lit(">")))
        tags = F.regexp_extract_all(page, F.lit(_TAG), F.lit(0))
        return F.array_join(F.zip_with(F.split(page, _TAG, -1), tags, lambda text, tag: F.concat(text, whole(tag))), "")

    holds = lambda page: page.rlike(_QUOTED_BRACKET) & page.rlike(_TAG_TO_BRACKET)
    return bind(html, lambda page: F.when(holds(page), marked(page)).otherwise(page))


def _keep_verbatim(page: Column) -> Column:
    """The page with marks for the white space of closed ``<pre>`` elements, and fences around them."""

    def kept(body: Column) -> Column:
        lines = F.regexp_replace(F.regexp_replace(body, "\r\n?", "\n"), r"\A\n|\n\z", "")
        fence = F.when(F.contains(body, F.lit("```")), FENCE + FENCE).otherwise(FENCE)
        marks = F.translate(lines, "\n \t", VERBATIM_LINE + VERBATIM_SPACE + VERBATIM_TAB)
        return F.concat(fence, F.lit(VERBATIM_LINE), marks, F.lit(VERBATIM_LINE), fence)

    def piece(text: Column, i: Column) -> Column:
        end, start = F.instr(F.lower(text), "</pre"), F.instr(text, ">") + 1
        body = F.substring(text, start, end - start)
        element = F.concat(F.substring(text, F.lit(1), start - 1), kept(body), F.substring(text, end, F.lit(_ALL)))
        return F.when((i > 0) & (start > 1) & (end >= start), element).otherwise(text)

    return F.array_join(F.transform(F.split(page, _VERBATIM, -1), piece), "<pre")


def visible(html: Column) -> Column:
    """``drop_unseen``, with the white space of ``<pre>`` elements kept by marks."""

    def with_verbatim(page: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(page, r"[\x01-\x08\x0b\x0c\x0e-\x1d]", " "), _UNSEEN, "")
        return F.regexp_replace(_keep_verbatim(text), r"[\n\t\r]", " ")

    def plain(page: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(page, r"[\x01-\x1d]", " "), _UNSEEN, "")

    page = keep_quoted_brackets(F.regexp_replace(html, f"[{QUOTED_LT}{QUOTED_GT}]", " "))
    return bind(page, lambda p: F.when(p.rlike(_VERBATIM), with_verbatim(p)).otherwise(plain(p)))


def drop_unseen(html: Column) -> Column:
    """The page without comments, scripts and styles.

    Control characters, among them line breaks, tabs and stray markers, become
    blanks; to HTML they mean the same.
    """
    return F.regexp_replace(F.regexp_replace(html, _CONTROL, " "), _UNSEEN, "")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    Spark shares common parts of ordinary expressions by itself, but not what
    higher-order functions and their lambdas use.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def replace_tags(
    html: Column, tag_texts: dict[str, str], **computed: Callable[[Column], Column]
) -> Column:
    """Replace every tag by its text in ``tag_texts``, or by nothing.

    The text of the tags named by ``computed`` is computed from the tag.
    """
    texts = _map(tag_texts)

    def name_of(piece: Column, i: Column) -> Column:
        # Null for what precedes the first tag, '' for a < that starts no tag.
        return F.when(i > 0, F.lower(F.regexp_extract(piece, "^/?[a-zA-Z][a-zA-Z0-9]*", 0)))

    def rewritten(piece: Column, name: Column) -> Column:
        tag = F.substring_index(piece, ">", 1)
        text = F.substring(piece, F.instr(piece, ">") + 1, F.lit(_ALL))
        known = F.when(name.isNull(), piece)
        for computed_name, compute in computed.items():
            known = known.when(name == computed_name, F.concat(compute(tag), text))
        return (
            known.when(name != "", F.concat(F.coalesce(F.element_at(texts, name), F.lit("")), text))
            # <!doctype>, <?xml?> and a bare </ vanish; any other < is text.
            .when(piece.rlike("^[!?/]"), text)
            .otherwise(F.concat(F.lit("<"), piece))
        )

    # A tag cut off by the end of the page is closed by the end mark's bracket.
    pieces = F.split(F.concat(html, F.lit(END + ">")), "<")
    joined = F.array_join(
        bind(pieces, lambda all_: F.zip_with(all_, F.transform(all_, name_of), rewritten)), ""
    )
    return F.replace(joined, F.lit(END + ">"), F.lit(""))


def decode_entities(text: Column) -> Column:
    named = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
    names = COMMON_ENTITIES + [name for name in named if name not in COMMON_ENTITIES]
    # White space of any kind becomes a blank, as a no-break space does.
    chars = _map({n: " " if named[n].isspace() else named[n] for n in names})
    # What browsers show for the numbers of control characters: those of Windows-1252.
    western = _map({str(n): bytes([n]).decode("cp1252", "replace") for n in range(128, 160)})

    def entity_of(piece: Column, i: Column) -> Column:
        # Null for what precedes the first &, '' for an & that starts no entity.
        pattern = "^(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,40});"
        return F.when(i > 0, F.regexp_extract(piece, pattern, 1))

    def char(entity: Column) -> Column:
        number = F.when(
            entity.rlike("^#[xX]"), F.conv(F.regexp_extract(entity, "^#[xX]0*([0-9a-fA-F]+)", 1), 16, 10)
        ).otherwise(F.regexp_extract(entity, "^#0*([0-9]+)", 1))
        code = number.try_cast("int")
        # Control characters could be taken for markers; halves of a surrogate
        # pair and numbers beyond the last character have no text form.
        printable = F.when(code < 32, F.lit(" ")).when(code.between(128, 159), F.element_at(western, code.cast("string"))).when(
            (code < 0xD800) | code.between(0xE000, 0x10FFFF),
            F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
        )
        return F.when(entity.startswith("#"), printable).otherwise(F.element_at(chars, entity))

    def rewritten(piece: Column, entity: Column) -> Column:
        decoded = F.concat(
            char(entity), F.substring(piece, F.length(entity) + 2, F.lit(_ALL))
        )
        as_text = F.concat(F.lit("&"), piece)
        return (
            F.when(entity.isNull(), piece)
            .when(entity == "", as_text)
            .otherwise(F.coalesce(decoded, as_text))
        )

    return F.array_join(
        bind(
            F.split(text, "&"),
            lambda all_: F.zip_with(all_, F.transform(all_, entity_of), rewritten),
        ),
        "",
    )


def _render_tables(text: Column) -> Column:
    """Turn table markers into pipe tables.

    Everything up to a table's end marker becomes one line per row, with a rule
    below the first; a bar inside a cell is escaped. Text outside the cells, such
    as a caption, goes above the table.
    """

    def row_line(row: Column, i: Column) -> Column:
        rule = F.concat(F.lit("\n|"), F.repeat(F.lit("---|"), F.size(F.split(row, CELL)) - 1))
        line = F.regexp_replace(F.trim(row), f" ?{CELL} ?", " | ")
        return F.concat(F.ltrim(line), F.lit(" |"), F.when(i == 0, rule).otherwise(""))

    def body_text(body: Column) -> Column:
        marks = f"[ {PARAGRAPH}{LINE}{ITEM_LINE}{INDENT}{OPEN}{CLOSE}{VERBATIM_LINE}]+"
        one_line = F.regexp_replace(F.replace(body, F.lit("|"), F.lit("\\|")), marks, " ")
        return F.replace(F.replace(one_line, F.lit(FENCE), F.lit("`")), F.lit(BULLET), F.lit(" "))

    def rendered(rows: Column) -> Column:
        loose = F.filter(rows, lambda row: ~F.contains(row, F.lit(CELL)))
        lines = F.transform(F.filter(rows, lambda row: F.contains(row, F.lit(CELL))), row_line)
        return F.concat_ws(PARAGRAPH, F.lit(""), F.concat_ws(" ", loose), F.concat_ws(LINE, lines), F.lit(""))

    def table(piece: Column) -> Column:
        body = F.substring_index(piece, TABLE_END, 1)
        rest = F.substring(piece, F.length(body) + 1, F.lit(_ALL))
        return F.concat(bind(F.split(body_text(body), ROW), rendered), rest)

    pieces = F.transform(
        F.split(text, TABLE), lambda piece, i: F.when(i == 0, piece).otherwise(table(piece))
    )
    return F.array_join(pieces, "")


def _render_lists(text: Column) -> Column:
    """Turn list markers into lines with bullets or numbers, from the inside out.

    A round finishes all lists without a list inside: the text between a list's mark and
    the next end mark. Their lines, indented once more by every list around them, are text
    to the next round, so that each round is linear. A list that is never closed has
    bullets; what is deeper than ``LIST_LEVELS`` is not indented further.
    """

    def finished(piece: Column) -> Column:
        body = F.substring_index(piece, LIST_END, 1)
        rest = F.substring(piece, F.length(body) + 2, F.lit(_ALL))
        number = F.substring_index(body, NUMBER, 1)
        items = F.split(F.substring(body, F.length(number) + 2, F.lit(_ALL)), ITEM)

        def line(item: Column, i: Column) -> Column:
            # What follows an inner list in its item goes on in a line of its own.
            inner = F.rtrim(F.replace(item, F.lit(OPEN), F.lit("")), F.lit(f" {PARAGRAPH}{LINE}{CLOSE}"))
            inner = F.replace(inner, F.lit(CLOSE), F.lit(ITEM_LINE))
            inner = F.replace(inner, F.lit(ITEM_LINE), F.lit(ITEM_LINE + INDENT))
            bullet = F.when(number == "", "-").otherwise(F.concat((number.try_cast("long") + i - 1).cast("string"), F.lit(".")))
            return F.when(i == 0, item).otherwise(F.concat(F.lit(ITEM_LINE), bullet, F.lit(BULLET), inner))

        return F.concat(F.lit(OPEN), F.array_join(F.transform(items, line), ""), F.lit(CLOSE), rest)

    def round_(acc: Column) -> Column:
        pieces = F.transform(
            F.split(acc, LIST, -1),
            lambda piece, i: F.when(i == 0, piece)
            .when(F.contains(piece, F.lit(LIST_END)), finished(piece))
            .otherwise(F.concat(F.lit(LIST), piece)),
        )
        return F.array_join(pieces, "")

    def all_rounds(page: Column) -> Column:
        rounds = F.least(F.size(F.split(page, LIST)) - 1, F.lit(LIST_LEVELS))
        return F.aggregate(
            F.sequence(F.lit(1), rounds), page, lambda acc, _: F.when(F.contains(acc, F.lit(LIST)), round_(acc)).otherwise(acc)
        )

    text = _where_present(text, LIST, all_rounds)
    # Lists that were never closed, items and ends without a list.
    text = _where_present(text, LIST, lambda t: F.regexp_replace(t, f"{LIST}[0-9]*{NUMBER}", PARAGRAPH))
    text = F.replace(F.replace(text, F.lit(ITEM), F.lit(f"{ITEM_LINE}-{BULLET}")), F.lit(LIST_END), F.lit(PARAGRAPH))
    return _translated(text, OPEN + CLOSE, PARAGRAPH + PARAGRAPH)


def _tidy_indents(text: Column) -> Column:
    """Marks of indented lines stand before text only, without a blank between."""
    return F.regexp_replace(F.replace(text, F.lit(INDENT + " "), F.lit(INDENT)), f"{INDENT}++(?=\n|\\z)", "")


def _where_present(text: Column, mark: str, step: Callable[[Column], Column]) -> Column:
    """Apply a step only to texts that hold its mark; finding out costs far less."""
    return bind(text, lambda t: F.when(F.contains(t, F.lit(mark)), step(t)).otherwise(t))


def _translated(text: Column, old: str, new: str) -> Column:
    """``translate`` for texts that hold one of these; others are left alone, which costs far less."""
    return bind(text, lambda t: F.when(t.rlike(f"[{old}]"), F.translate(t, old, new)).otherwise(t))


def _drop_boilerplate(text: Column) -> Column:
    """Cut out closed elements that are left out, ``NESTING`` levels deep.

    One that is never closed keeps its text: a missing end tag must not cost the page.
    """
    for _ in range(NESTING):
        text = F.regexp_replace(text, rf"{DROP}[^{DROP}{DROP_END}]*{DROP_END}", " ")
    return text


def _link_texts(text: Column) -> Column:
    no_mark = f"[^{LINK}{LINK_TEXT}{LINK_END}]*"
    text = F.regexp_replace(text, f"{LINK}({no_mark}){LINK_TEXT}({no_mark}){LINK_END}", r"[$2]($1)")
    return F.regexp_replace(text, f"{LINK}[^{LINK_TEXT}]*{LINK_TEXT}", "")


def html_to_markdown(html: Column, config: ConvertConfig | None = None) -> Column:
    """Markdown text of an HTML page."""
    config = config or ConvertConfig()
    image = lambda tag: _image(tag, config.image_mode)
    text = replace_tags(visible(html), _tag_texts(config), a=_link, img=image, ol=_list_start)
    text = _where_present(text, DROP, _drop_boilerplate)
    text = _where_present(text, "&", decode_entities)
    text = _where_present(text, LINK, _link_texts)
    text = F.replace(text, F.lit(LINK_END), F.lit(""))
    text = _render_lists(text)
    if config.tables:
        text = _where_present(text, TABLE, _render_tables)
    # Markers without a partner. From here on no two blanks stand side by side.
    text = collapse_blanks(F.regexp_replace(text, f"[{DROP}-{END}]", " "))
    text = F.replace(F.replace(text, F.lit(PARAGRAPH), F.lit("\n\n")), F.lit(LINE), F.lit("\n"))
    # An item goes on beside its bullet, whatever it begins with.
    text = _where_present(text, BULLET, lambda t: F.regexp_replace(t, f"{BULLET}[ \n]*+", " "))
    # Blanks at line ends, surplus empty lines, both ends.
    for old, new in ((ITEM_LINE, "\n"), (" \n", "\n"), ("\n ", "\n")):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.regexp_replace(_where_present(text, INDENT, _tidy_indents), "\n{3,}", "\n\n")
    text = F.regexp_replace(F.replace(text, F.lit(IMAGE), F.lit(IMAGE_PLACEHOLDER)), r"\A[ \n]++|(?<![ \n])[ \n]++\z", "")
    text = F.replace(text, F.lit(INDENT), F.lit("    "))
    text = _where_present(text, FENCE, lambda t: F.replace(t, F.lit(FENCE), F.lit("```")))
    return _translated(text, QUOTED_LT + QUOTED_GT + VERBATIM_LINE + VERBATIM_SPACE + VERBATIM_TAB, "<>\n \t")
