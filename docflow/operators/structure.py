"""Structure of documents: blocks of converted text, cells of HTML tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.html import (
    BLOCK_TAGS,
    CELL,
    LINK,
    ROW,
    TABLE,
    TABLE_END,
    attribute,
    collapse_blanks,
    decode_entities,
    drop_unseen,
    keep_quoted_brackets,
    replace_tags,
)
from docflow.session import ship_package

# The most rows and columns that HTML lets a cell span.
MOST_ROWS, MOST_COLUMNS = 65_534, 1_000
# Between a cell's spans and its text.
SPAN_MARK = LINK
_CELLS = ["document_path", "table", "row", "col", "row_span", "col_span", "text"]


def block_kind(text: Column) -> Column:
    return (
        F.when(text.rlike("^#{1,6} "), "heading")
        .when(text.startswith("- "), "list")
        .when(text.startswith("| "), "table")
        .when(text.startswith("![") | (text == "<!-- image -->"), "image")
        .otherwise("paragraph")
    )


def document_blocks(df: DataFrame) -> DataFrame:
    """The blocks of every converted document in reading order: ``document_path, pos, kind, text``."""
    return (
        df.filter("success")
        .select("document_path", F.posexplode(F.split("content", "\n\n")).alias("pos", "text"))
        .filter(F.col("text") != "")
        .select("document_path", "pos", block_kind(F.col("text")).alias("kind"), "text")
    )


def _split_tables(marked: str) -> list[str]:
    """Text of each table with its row and cell markers, in the order the tables start.

    A table inside a cell is a table of its own, and the cell keeps the text around
    it. One pass keeps a stack of open tables, so any depth of nesting comes out right.
    """
    tables: list[list[str]] = []
    opened: list[list[str]] = []
    for piece in re.split(f"([{TABLE}{TABLE_END}])", marked):
        if piece == TABLE:
            tables.append([])
            opened.append(tables[-1])
        elif piece == TABLE_END:
            del opened[-1:]
        elif opened:
            opened[-1].append(piece)
    return ["".join(parts) for parts in tables]


class _Grid:
    """The columns of a table that cells of earlier rows still cover.

    ``until`` holds for each column the first row in which it is free again. A cell goes
    to the first free column after the one before it, and covers its columns until its
    last row, as browsers lay tables out.
    """

    def __init__(self):
        self.until = np.zeros(8, np.int64)

    def covers(self, row: int) -> bool:
        return bool((self.until > row).any())

    def place(self, row: int, col: int, rows: int, cols: int) -> int:
        """The column of a cell of the given size, which is looked for from ``col`` on."""
        free = np.flatnonzero(self.until[col:] <= row)
        col = col + int(free[0]) if len(free) else max(col, len(self.until))
        if rows > 1:
            if col + cols > len(self.until):
                self.until = np.concatenate([self.until, np.zeros(col + cols, np.int64)])
            covered = self.until[col : col + cols]
            np.maximum(covered, row + rows, out=covered)
        return col


def _span(text: str, most: int, zero: int) -> int:
    """A number of rows or columns: 1 if it is none, at most ``most``; 0 stands for ``zero``."""
    if not (text.isascii() and text.isdigit()):
        return 1
    return min(int(text[:9]) or zero, most)


def _table_cells(text: str) -> list[tuple[int, int, int, int, str]]:
    """``row, col, row_span, col_span, text`` of a table's cells in reading order.

    Rows without cells count only where cells from above reach into them. Spans end with
    the table.
    """
    rows = [row.split(CELL) for row in text.split(ROW)]
    if SPAN_MARK not in text:
        bare = (cells[1:] for cells in rows if len(cells) > 1)
        return [(r, c, 1, 1, cell.strip(" ")) for r, cells in enumerate(bare) for c, cell in enumerate(cells)]
    grid, found, r = _Grid(), [], 0
    for cells in rows:
        if len(cells) == 1:
            r += bool(found) and grid.covers(r)
            continue
        col = 0
        for cell in cells[1:]:
            spans, marked, text = cell.partition(SPAN_MARK)
            down, _, across = spans.partition(";") if marked else ("", "", "")
            size = _span(down, MOST_ROWS, MOST_ROWS), _span(across, MOST_COLUMNS, 1)
            col = grid.place(r, col, *size)
            found.append((r, col, *size, (text if marked else cell).strip(" ")))
            col += size[1]
        r += 1
    return [(row, col, min(down, r - row), across, text) for row, col, down, across, text in found]


def _explode_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per cell: the index of its document in the batch, its table, and the cell."""
    for batch in batches:
        found = [
            (i, t, *cell)
            for i, marked in enumerate(batch.column(1).to_pylist())
            for t, table in enumerate(_split_tables(marked))
            for cell in _table_cells(table)
        ]
        documents, *columns = zip(*found, strict=True) if found else [()] * len(_CELLS)
        arrays = [batch.column(0).take(pa.array(documents, pa.int32()))]
        arrays += [pa.array(c, pa.string() if name == "text" else pa.int32()) for name, c in zip(_CELLS[1:], columns, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, _CELLS)


def document_tables(
    df: DataFrame, path_col: str = "document_path", html_col: str = "content", spans: bool = False
) -> DataFrame:
    """Every cell of every HTML table: ``document_path, table, row, col, text``, counted from 0.

    ``row`` and ``col`` are the cell's first row and column in the table's grid, in which
    cells that span rows or columns push others aside. ``spans`` adds ``row_span`` and
    ``col_span``, the rows and columns that the cell covers; a ``rowspan`` of 0 or beyond
    the table ends with the table.
    """
    html = F.col(html_col).cast("string")
    tags = dict.fromkeys([*BLOCK_TAGS, *("/" + tag for tag in BLOCK_TAGS), "br", "li"], " ")
    tags |= {"table": TABLE, "/table": TABLE_END, "tr": ROW}

    def cell(tag: Column) -> Column:
        marked = F.concat(F.lit(CELL), attribute(tag, "rowspan"), F.lit(";"), attribute(tag, "colspan"), F.lit(SPAN_MARK))
        return F.when(tag.rlike(r"(?i)\s(?:row|col)span\s*="), marked).otherwise(F.lit(CELL))

    text = replace_tags(drop_unseen(keep_quoted_brackets(html)), tags, td=cell, th=cell)
    marked = collapse_blanks(decode_entities(text))
    ship_package(df.sparkSession)
    types = [df.schema[path_col].dataType.simpleString(), *("string" if c == "text" else "int" for c in _CELLS[1:])]
    cells = (
        df.filter(html.rlike(r"(?i)<table[\s/>]"))
        .select(F.col(path_col).alias("document_path"), marked.alias("marked"))
        .mapInArrow(_explode_tables, ", ".join(f"`{name}` {kind}" for name, kind in zip(_CELLS, types, strict=True)))
    )
    return cells.select(*(c for c in _CELLS if spans or not c.endswith("_span")))
