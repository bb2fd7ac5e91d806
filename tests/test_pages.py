from __future__ import annotations

import pytest

from rankmart.sources.domain import WORLD_TYPES
from rankmart.sources.pages import (
    NAVIGATION_LIST,
    RANKING_TABLE,
    cells_as_columns,
    extract_rows,
    page_rows,
    tag_group,
    url_parameter,
)

NAMES = ["Rank", "Name", "Vocation", "World", "Level", "Points"]


def table(names, rows):
    def line(cells, tag="td"):
        return "<tr>" + "".join(f"<{tag}> {c} </{tag}>" for c in cells) + "</tr>"

    return f"""<html><body><table class="Other"><tr><td>no</td></tr></table>
      <div><table width=1 class="Table3 x"><tr><td>Title</td></tr>
      <tr><td><form>Filter</form></td></tr>
      <tr><td><div class='Inner'><table class=TableContent>{line(names, "th")}
      {"".join(line(r) for r in rows)}</table></div></td></tr></table></div></body></html>"""


@pytest.fixture
def pages(spark):
    players = [(i, f"P{i}", "Knight", "Antica", 600 - i, f"{10**9 - i:,}") for i in range(1, 51)]
    return spark.createDataFrame(
        [
            (1, "https://e.org/?subtopic=x&worldtypes[]=3&category=6&currentpage=1", table(NAMES, players)),
            (2, "https://e.org/?worldtypes[]=9", table(["Rank", "Name", "Score"], [(1, "Q", 5)])),
            (3, "https://e.org/?a=1", "<html><p>Table3</p></html>"),
            (4, "not a url [", "<table class=Table3><tr><td>1</td></tr><tr><td>2</td></tr></table>"),
            (5, None, None),
            (6, "https://e.org", '<table class="Table3"><tr></tr><tr></tr><tr><td>x</td></tr></table>'),
        ],
        "page_id int, url string, html string",
    )


def test_rows_of_a_ranking_page(pages):
    found = extract_rows(pages, RANKING_TABLE)
    df = cells_as_columns(found, NAMES)
    first = df.filter("page_id = 1").orderBy("row_no").collect()
    assert len(first) == 50
    assert tuple(first[0])[1:] == (1, "1", "P1", "Knight", "Antica", "599", "999,999,999")
    assert all(r["Rank"] is not None for r in first)


def test_pages_with_other_headers_keep_their_names(pages):
    df = cells_as_columns(extract_rows(pages, RANKING_TABLE), ["Name", "Score", "World"])
    assert tuple(df.filter("page_id = 2").first())[2:] == ("Q", "5", None)


def test_pages_without_the_table_give_no_rows(pages):
    assert {r["page_id"] for r in extract_rows(pages, RANKING_TABLE).collect()} == {1, 2}


def test_groups_from_urls(pages, rows):
    tagged = tag_group(pages, "url", "worldtypes[]", WORLD_TYPES, "WorldType")
    assert rows(tagged, "page_id", "WorldType") == [
        (1, "Retro Open PvP"), (2, None), (3, None), (4, None), (5, None), (6, None),
    ]
    assert rows(pages.select("page_id", url_parameter("url", "category").alias("c")))[0] == (1, "6")


def test_text_is_stripped_piecewise_and_nested_markup_kept():
    html = table(["A"], [["<b>x </b> y&amp;z <!-- c --> <script>no()</script>w"]])
    assert page_rows(html, RANKING_TABLE) == (["A"], [["xy&zw"]])


def test_rows_and_cells_without_end_tags():
    html = """<table class=Table3><tr><td>1<tr><td>2<tr><td>
      <table class=TableContent><tr><td>A<td>B<tr><td>1<td>2</table></table>"""
    assert page_rows(html, RANKING_TABLE) == (["A", "B"], [["1", "2"]])


def test_short_rows_end_in_null(spark):
    pages = spark.createDataFrame([(1, table(["A", "B"], [["1"], ["1", "2"]]))], "page_id int, html string")
    df = cells_as_columns(extract_rows(pages, RANKING_TABLE), ["A", "B"]).orderBy("row_no")
    assert [tuple(r)[2:] for r in df.collect()] == [("1", None), ("1", "2")]


def test_nested_lists():
    html = "<nav><ul><li><a>1</a><ul><li><a>2</a></li></ul><li><a>3</a></ul></nav><li><a>4</a>"
    assert page_rows(html, NAVIGATION_LIST)[1] == [["1", "2"], ["2"], ["3"]]


def test_deeply_nested_pages_are_parsed(spark):
    deep = "<table class=Table3>" + "<table class=x><tr><td>" * 5_000
    good = table(["A"], [["1"]])
    pages = spark.createDataFrame([(1, deep), (2, good)], "page_id int, html string")
    assert [r["page_id"] for r in extract_rows(pages, RANKING_TABLE).collect()] == [2]
