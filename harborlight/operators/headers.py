"""Header lists of source rows, resolved once each: at which positions fields and menus stand (PRJ-7, GEN-1 to GEN-3).

Rows carry `headers` and `cells`. A source has few distinct header lists; each is looked at once, and rows then read their cells by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.functions.text import blank_to_null
from harborlight.session import ship, stored

MENU_SLOTS = 20
# Header words of menu names and prices, and their pairs.
NAME_WORDS, PRICE_WORDS = ("품목", "메뉴", "item", "menu"), ("가격", "price")
PAIRS = (("품목", "가격"), ("메뉴", "가격"), ("item", "price"), ("menu", "price"))
SINGLE_NAME, SINGLE_PRICE = ("itemNm", "ITEM_NM", "메뉴명", "품목명"), ("menuPrc", "MENU_PRC", "메뉴가격", "가격")


class Layout:
    """Positions in one header list. Headers count trimmed and in lower case; of equal ones the last."""

    def __init__(self, headers: list[str]):
        self.headers = headers
        self.last = {h.strip().lower(): i for i, h in enumerate(headers)}

    def places(self, names: tuple[str, ...]) -> list[int]:
        """Where the names stand, in their order."""
        return [self.last[n.lower()] for n in names if n.lower() in self.last]

    def numbered(self, words: tuple[str, ...]) -> dict[int, list[int]]:
        """Positions of headers `word N` by slot, the preferred spelling first: earlier words, numbers without 0, no underscore."""
        found: dict[int, list[tuple]] = {}
        for header, place in self.last.items():
            spelled = re.fullmatch(f"({'|'.join(words)})(_?)(0[1-9]|[1-9][0-9]?)", header)
            if spelled and int(spelled[3]) <= MENU_SLOTS:
                found.setdefault(int(spelled[3]), []).append((words.index(spelled[1]), spelled[3].startswith("0"), spelled[2], place))
        return {slot: [x[-1] for x in sorted(places)] for slot, places in found.items()}

    def pairs(self) -> list[tuple]:
        """(None, position of name, position of price) of each header `name N` for which there is a header `price N`, in header order."""
        found = []
        for name, price in PAIRS:
            for place, header in enumerate(self.headers):
                number = re.search(rf"(?i)^{name}\s*([0-9]+)$", header)
                prices = [i for i, h in enumerate(self.headers) if number and re.search(rf"(?i)^{price}\s*{number[1]}$", h)]
                found += [(None, [place], prices[:1])] if prices else []
        return found

    def slots(self) -> list[tuple]:
        """(slot or None, positions of the name, of the price) of every menu that rows may have, in order."""
        names, prices = self.numbered(NAME_WORDS), self.numbered(PRICE_WORDS)
        listed = [(slot, names[slot], prices.get(slot, [])) for slot in sorted(names)]
        single = self.places(SINGLE_NAME)
        return listed + ([(None, single, self.places(SINGLE_PRICE))] if single else []) + self.pairs()


def as_cells(rows: DataFrame) -> DataFrame:
    """Rows with `row` (map of header to text) as rows with headers and cells; others as they are."""
    if "headers" in rows.columns:
        return rows
    none = F.array().cast("array<string>")  # a row that is null has no cells
    return rows.select(F.coalesce(F.map_keys("row"), none).alias("headers"), F.coalesce(F.map_values("row"), none).alias("cells"), *[c for c in rows.columns if c != "row"])


def as_row(headers: str | Column = "headers", cells: str | Column = "cells") -> Column:
    """The map of header to text."""
    return F.map_from_arrays(headers, cells)


def resolved(rows: DataFrame, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """rows (of as_cells) with _places, the positions of each field in the order of fields, and _slots, those of menus.

    The distinct header lists are stored, so that Spark knows their size and broadcasts them only while they are small.
    """
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(0).to_pylist()
            layouts = [Layout(h) for h in listed]
            slots = [[dict(zip(("slot", "names", "prices"), s, strict=True)) for s in x.slots()] for x in layouts]
            places = [[x.places(names) for names in fields.values()] for x in layouts]
            kinds = pa.list_(pa.list_(pa.int32())), pa.list_(pa.struct([("slot", pa.int32()), ("names", pa.list_(pa.int32())), ("prices", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, kinds[0]), pa.array(slots, kinds[1])], ["headers", "_places", "_slots"])

    layouts = rows.select("headers").distinct().mapInArrow(run, "headers array<string>, _places array<array<int>>, _slots array<struct<slot: int, names: array<int>, prices: array<int>>>")
    return rows.join(stored(layouts, "header-layouts"), "headers")


def first_filled(places: Column, cells: str | Column = "cells") -> Column:
    """First non-blank cell of the positions (PRJ-7)."""
    own = F.col(cells) if isinstance(cells, str) else cells
    return F.get(F.filter(F.transform(places, lambda i: blank_to_null(F.get(own, i))), lambda v: v.isNotNull()), F.lit(0))
