"""Tables inside HTML pages as rows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyforge.functions.names import ref


class _TableReader(HTMLParser):
    """Collects ``(table number, row number, cells)``; nested tables count on their own.

    A cell that spans several columns or rows stands in each of them.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str]]] = []
        self.tables = 0
        self.open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"number": self.tables, "rows": 0, "cells": None, "text": None,
                              "span": (1, 1), "below": {}})
            self.tables += 1
        elif self.open and tag == "tr":
            self._end_row()
            self.open[-1]["cells"] = []
        elif self.open and tag in ("td", "th"):
            self._end_cell()
            if self.open[-1]["cells"] is None:
                self.open[-1]["cells"] = []
            self.open[-1]["text"] = []
            told = dict(attrs)
            self.open[-1]["span"] = (_span(told.get("colspan"), 1000),
                                     _span(told.get("rowspan"), 65534))

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._end_row()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)

    def _end_cell(self):
        table = self.open[-1]
        if table["text"] is not None:
            text = " ".join("".join(table["text"]).split())
            columns, rows = table["span"]
            self._from_above(table)
            for _ in range(columns):
                if rows > 1:
                    table["below"][len(table["cells"])] = (text, rows)
                table["cells"].append(text)
            table["text"] = None

    @staticmethod
    def _from_above(table):
        """Cells of earlier rows that reach into the next columns of this one."""
        while len(table["cells"]) in table["below"] and (
                table["below"][len(table["cells"])][1] > 0):
            table["cells"].append(table["below"][len(table["cells"])][0])

    def _end_row(self):
        table = self.open[-1]
        self._end_cell()
        if table["cells"] is not None:
            self._from_above(table)
            table["below"] = {c: (text, left - 1) for c, (text, left) in table["below"].items()
                              if left > 1}
        if table["cells"]:
            self.rows.append((table["number"], table["rows"], table["cells"]))
            table["rows"] += 1
        table["cells"] = None

    def finish(self) -> list[tuple[int, int, list[str]]]:
        self.close()
        while self.open:
            self._end_row()
            self.open.pop()
        return self.rows


def _span(value: str | None, most: int) -> int:
    """A span attribute within the bounds of the HTML standard; 1 if it is no number."""
    return min(max(int(value), 1), most) if value and value.strip().isdigit() else 1


def table_rows(page: str) -> list[tuple[int, int, list[str]]]:
    reader = _TableReader()
    reader.feed(page)
    return reader.finish()


def extract_html_tables(pages: DataFrame, id_column: str, html_column: str) -> DataFrame:
    """``(page, table_no, row_no, cells)`` for every table row of every page.

    Pages without a table element are filtered out before any Python runs.
    """
    id_type = pages.schema[id_column].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(page, t, r, cells) for page, html in zip(batch["id"], batch["html"])
                   for t, r, cells in table_rows(html)]
            yield pd.DataFrame(out, columns=["page", "table_no", "row_no", "cells"])

    wanted = pages.select(ref(id_column).alias("id"), ref(html_column).alias("html"))
    found = wanted.where(F.lower("html").contains("<table"))
    return found.mapInPandas(
        parse, f"page {id_type}, table_no int, row_no int, cells array<string>")
