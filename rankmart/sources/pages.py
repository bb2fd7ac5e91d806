"""Rows of ranking tables and lists in saved web pages."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass(frozen=True)
class PageSpec:
    """Where the rows of a page are.

    ``path`` leads to the element holding the rows: each step is a tag, a class or
    "", and the number of the match to take among those below the step before. The
    rows are its ``row`` elements, their texts those of the ``cells`` elements. With
    ``header`` the first row names the columns.
    """

    path: tuple[tuple[str, str, int], ...]
    row: str
    cells: tuple[str, ...]
    header: bool
    hint: str

    @property
    def tags(self) -> frozenset[str]:
        return frozenset([*(tag for tag, _, _ in self.path), self.row, *self.cells])


# The markup of a ranking page. The table is nested in the third row
# of its container.
RANKING_TABLE = PageSpec(
    path=(("table", "Table3", 0), ("tr", "", 2), ("table", "TableContent", 0)),
    row="tr",
    cells=("td", "th"),
    header=True,
    hint="Table3",
)
NAVIGATION_LIST = PageSpec(
    path=(("nav", "", 0),), row="li", cells=("a",), header=False, hint="<nav"
)


#: Pages whose rows are held together.
PAGES_TOGETHER = 64


class _Node:
    __slots__ = ("tag", "classes", "parts")

    def __init__(self, tag: str, classes: str):
        self.tag = tag
        self.classes = classes.split()
        self.parts: list[_Node | str] = []

    def walk(self) -> Iterator[_Node | str]:
        """All parts below, in the order of the page; pages may nest without bound."""
        waiting = [iter(self.parts)]
        while waiting:
            part = next(waiting[-1], None)
            if part is None:
                waiting.pop()
                continue
            yield part
            if isinstance(part, _Node):
                waiting.append(iter(part.parts))

    def below(self, tags: Sequence[str], class_: str = "") -> Iterator[_Node]:
        for part in self.walk():
            if isinstance(part, _Node) and part.tag in tags:
                if not class_ or class_ in part.classes:
                    yield part

    def text(self) -> str:
        """Its pieces of text, each stripped, joined without a blank."""
        return "".join(part.strip() for part in self.walk() if isinstance(part, str))


# Elements that a start tag ends when their own end tag was left out, up to the
# nearest enclosing element of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}


class _Outline(HTMLParser):
    """The elements of interest of one page; other tags vanish, their text stays."""

    def __init__(self, tags: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.tags = tags | {"script", "style", "table", "ul", "ol"}
        self.open = [_Node("", "")]

    def handle_starttag(self, tag, attrs):
        if tag not in self.tags or tag in VOID:
            return
        ended, stop = _ENDS.get(tag, ((), ()))
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in stop:
                break
            if self.open[depth].tag in ended:
                del self.open[depth:]
        node = _Node(tag, dict(attrs).get("class") or "")
        self.open[-1].parts.append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return
            if self.open[depth].tag == "table" and tag in ("tr", "td", "th"):
                return

    def handle_data(self, data):
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].parts.append(data)


def page_rows(html: str | None, spec: PageSpec) -> tuple[list[str], list[list[str]]]:
    """Column names and rows of one page; nothing found gives no rows."""
    if not html or spec.hint not in html:
        return [], []
    outline = _Outline(spec.tags)
    outline.feed(html)
    outline.close()
    found = outline.open[0]
    for tag, class_, number in spec.path:
        matches = list(found.below((tag,), class_))
        if len(matches) <= number:
            return [], []
        found = matches[number]
    rows = [[c.text() for c in row.below(spec.cells)] for row in found.below((spec.row,))]
    if not spec.header:
        return [], rows
    return (rows[0], rows[1:]) if rows else ([], [])


def extract_rows(
    pages: DataFrame, spec: PageSpec, page: Sequence[str] = ("page_id",), html: str = "html"
) -> DataFrame:
    """One row per table row: the ``page`` columns, ``row_no`` from 1, the page's
    ``header`` and the row's ``cells``.

    Pages are independent, so this is one pass without a shuffle; pages that cannot
    match never reach Python.
    """
    texts = ArrayType(StringType())
    schema = StructType(list(pages.select(*page).schema.fields))
    schema.add("row_no", IntegerType()).add("header", texts).add("cells", texts)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), PAGES_TOGETHER):
                yield parsed(whole.slice(start, PAGES_TOGETHER))

    def parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
        source, numbers, names, cells = [], [], [], []
        for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            header, rows = page_rows(text, spec)
            for number, row in enumerate(rows, 1):
                source.append(i)
                numbers.append(number)
                names.append(header)
                cells.append(row)
        kept = batch.select(range(batch.num_columns - 1)).take(pa.array(source, pa.int64()))
        arrays = [
            pa.array(numbers, pa.int32()),
            pa.array(names, pa.list_(pa.string())),
            pa.array(cells, pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(
            [*kept.columns, *arrays], [*kept.schema.names, "row_no", "header", "cells"]
        )

    candidates = pages.filter(F.col(html).contains(spec.hint)).select(*page, html)
    return candidates.mapInArrow(parse, schema)


def cells_as_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Name the cells by each page's own header; a column a page lacks is NULL."""

    def cell(name: str) -> Column:
        at = F.array_position("header", name)
        return F.when(at > 0, F.get("cells", (at - 1).cast("int")))

    others = [c for c in rows.columns if c not in ("header", "cells")]
    return rows.select(*others, *[cell(c).alias(c) for c in columns])


def url_parameter(url: str | Column, name: str) -> Column:
    """A query parameter of a URL. The name is plain text, e.g. ``worldtypes[]``."""
    pattern = "".join("\\" + ch if ch in "[](){}.*+?^$|\\" else ch for ch in name)
    return F.try_parse_url(
        F.col(url) if isinstance(url, str) else url, F.lit("QUERY"), F.lit(pattern)
    )


def tag_group(
    df: DataFrame, url: str, parameter: str, groups: Mapping[str, int | str], name: str
) -> DataFrame:
    """Add ``name``: the group whose number the URL carries in ``parameter``.

    ``groups`` is a fixed ``{label: number}``; an unknown number gives NULL.
    """
    pairs = [F.lit(x) for label, number in groups.items() for x in (str(number), label)]
    lookup = F.create_map(*pairs)
    return df.withColumn(name, F.try_element_at(lookup, url_parameter(url, parameter)))
