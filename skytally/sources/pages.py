"""Table rows out of HTML pages."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from skytally.sources.feeds import CELL_ROWS

# Workers get the functions themselves, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: class of the table that holds an airline's details.
DETAILS_CLASS = "table table-striped table-bordered border-dark"

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style template rt rp".split())


class _TableCells(HTMLParser):
    """Collect the first table of the wanted class; rows and cells nested in it count as well."""

    def __init__(self, wanted: str):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.rows: list[list[str]] | None = None
        self._open: list[tuple[str, object]] = []
        self._depth = None

    @property
    def done(self) -> bool:
        return self.rows is not None and self._depth is None

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        payload = None
        if self.rows is None:
            if tag == "table" and " ".join((dict(attrs).get("class") or "").split()) == self.wanted:
                self.rows, self._depth = [], len(self._open)
        elif tag == "tr":
            payload = []
            self.rows.append(payload)
        elif tag == "td":
            payload = []
            for name, row in self._open:
                if name == "tr" and row is not None:
                    row.append(payload)
        if tag not in _VOID:
            self._open.append((tag, payload))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                break
        if self._depth is not None and len(self._open) <= self._depth:
            self._depth = None

    def handle_data(self, data):
        if self._depth is None or any(name in _SILENT for name, _ in self._open):
            return
        for name, cell in self._open:
            if name == "td" and cell is not None:
                cell.append(data)


def page_rows(html: str, wanted: str) -> list[list[str]] | None:
    parser = _TableCells(wanted)
    parser.feed(html)
    parser.close()
    if parser.rows is None:
        return None
    return [["".join(cell).strip() for cell in row] for row in parser.rows]


def extract_tables(pages: DataFrame, wanted: str = DETAILS_CLASS) -> DataFrame:
    """(page_id, rows) of the pages that have the table; a row without ``td`` is an empty list.

    Pages without any table never leave the JVM.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch["html"].map(lambda html: page_rows(html, wanted))
            found = rows.notna()
            yield pd.DataFrame({"page_id": batch["page_id"][found], "rows": rows[found]})

    with_table = pages.filter(F.lower("html").contains("<table")).select(F.col("page_id").cast("long"), "html")
    return with_table.mapInPandas(parse, StructType().add("page_id", LongType()).add("rows", CELL_ROWS))
