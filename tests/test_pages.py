"""Page fixtures: month index pages, game pages, broken pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from hardwood.operators import pages as P
from hardwood.fixed_values import BOX_STATS
from hardwood.functions.markup import unescaped
from hardwood.operators.accounting import Cell, cell_errors
from hardwood.operators.pages import link_rows
from hardwood.plans.scrape import checked_box, pages_to_box


def month_page(games, extra=""):
    body = "".join(
        f'<tr><th><a href="/d/{i}">Tue, Oct {20 + i}, 2019</a></th><td><a href="/t/a">Away {i}</a></td>'
        f'<td><a href="/t/h">Home {i}</a></td><td><a href="/box/{i}"> Box Score </a></td></tr>'
        for i in range(games)
    )
    return f"<html><body><a href='/x'>skip</a><a href=\"/oct\">October</a><table><tbody>{body}{extra}</tbody></table><a href=\"/z\">z</a></body></html>"


@pytest.fixture(scope="module")
def months(spark):
    pages = [
        (1, "/full", month_page(3)),
        (2, "/odd", month_page(2, '<tr><td><a href="/p">Play-In</a></td></tr>')),
        (3, "/empty", "<html><body><a href=\"/nov\">november</a><p>none</p></body></html>"),
        (4, "/future", month_page(1).replace(" Box Score ", "")),
    ]
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_month_links(spark, months):
    found = P.month_links(P.link_rows(months), "https://s.example")
    assert [(r["page_id"], r["url_abs"]) for r in rows(found, "page_id")] == [
        (1, "https://s.example/oct"), (2, "https://s.example/oct"), (3, "https://s.example/nov"), (4, "https://s.example/oct"),
    ]


def test_addresses_in_any_form_and_references(spark):
    html = (
        "<a href='/a&amp;b'>D&#x27;Angelo</a><A class=x HREF = /c?d=1 >Jos&eacute;&nbsp;M</A><a data-href=\"/no\">none</a>"
        "<a name=top>no address</a><a\nhref=\"/f\">&#233;&#xe9;&unknown;&#xD800;&#0; & &amp;lt;</a>"
    )
    found = rows(P.link_rows(spark.createDataFrame([(1, html)], "page_id long, html string")), "pos")
    assert [(r["href"], r["text"]) for r in found] == [
        ("/a&b", "D'Angelo"), ("/c?d=1", "José M"), ("/f", "éé&unknown;&#xD800;&#0; & &lt;"),
    ]


def test_every_fourth_link(spark, months):
    links = P.link_rows(months.where("page_id = 1"), in_first_body=True)
    kept = P.stride_links(links, 4, F.trim("text") == P.BOX_SCORE_TEXT)
    assert [r["href"] for r in rows(kept, "href")] == ["/box/0", "/box/1", "/box/2"]


def test_completeness(spark, months):
    found = {r["url"]: (r["n_links"], r["n_box"], r["checked"]) for r in P.completeness(months, in_first_body=True).collect()}
    assert found == {"/full": (12, 3, None), "/odd": (9, 2, 2), "/empty": (0, 0, 0), "/future": (4, 0, 0)}


def test_zip_drops_the_rest(spark, months):
    found = rows(P.zip_links(months, in_first_body=True), "page_id", "ordinal")
    assert [(r["page_id"], r["ordinal"], r["first_href"], r["second_text"]) for r in found] == [
        (1, 0, "/box/0", "Tue, Oct 20, 2019"), (1, 1, "/box/1", "Tue, Oct 21, 2019"), (1, 2, "/box/2", "Tue, Oct 22, 2019"),
        (2, 0, "/box/0", "Tue, Oct 20, 2019"), (2, 1, "/box/1", "Tue, Oct 21, 2019"),
    ]


def stat_cells(points):
    return "".join(f"<td>{c}</td>" for c in ["34:12", "5", "0", "", *["1"] * 14, points, "+4"])


def game_page(title, away, home):
    other = "<tbody><tr><th>x</th><td>1</td></tr></tbody>"
    return f"<h1>{title}</h1><table><tbody>{away}</tbody>{other * 7}<tbody>{home}</tbody></table>"


@pytest.fixture(scope="module")
def games(spark):
    away = (
        f"<tr><th>Zoë O&#39;Neil</th>{stat_cells(21)}</tr>\n<tr><th>Reserves</th><th>MP</th></tr>"
        "<tr><th>Sam Sit</th><td>Did Not Play</td></tr>"
        f"<tr><th>Zoë O&#39;Neil</th>{stat_cells(99)}</tr>"
    )
    home = f"<tr><th>Zoë O&#39;Neil</th>{stat_cells(8)}</tr><tr><th>Lee Late<td>1:05<td>2"
    pages = [
        ("/b/1", game_page("Golden State Warriors at Seattle SuperSonics Box Score, January 13, 2016", away, home)),
        ("/b/2", "<h1>Postponed</h1><p>no game"),
        ("/b/3", "<table><tbody></tbody></table>"),
        ("/b/4", f"<h1>A at B Box Score, January 13, 2016</h1><table><tbody>{away}</tbody></table>"),
        ("/b/5", game_page("A v B, January 13, 2016", away, home)),
        ("/b/6", game_page("A at B Box Score, Smarch 13, 2016", away, home)),
        ("/b/7", None),
    ]
    return spark.createDataFrame(pages, "url string, html string")


def test_box_scores(spark, games):
    box, errors = pages_to_box(games)
    found = rows(box, "Home", "Player")
    assert [(r["Player"], r["Team"], r["Home"], r["MP"], r["FG"], r["PTS"]) for r in found] == [
        ("Sam Sit", "Golden State Warriors", 0, None, None, None),
        ("Zoë O'Neil", "Golden State Warriors", 0, 34.12, 5, 21.0),
        ("Lee Late", "Seattle SuperSonics", 1, 1.05, 2, None),
        ("Zoë O'Neil", "Seattle SuperSonics", 1, 34.12, 5, 8.0),
    ]
    assert {r["Date"] for r in found} == {dt.date(2016, 1, 13)}
    assert found[0]["Against"] == "Seattle SuperSonics" and found[0]["GameLink"] == "/b/1"
    assert found[1]["FG%"] is None and found[1]["+/-"] == 4.0
    assert [(r["URL"], r["Error"]) for r in rows(errors, "URL")] == [
        ("/b/2", "no table body"), ("/b/3", "no rows"), ("/b/4", "no home table"), ("/b/5", "no teams or date in the title"),
        ("/b/6", "no teams or date in the title"), ("/b/7", "no table body"),
    ]


def test_rows_of_all_tables(spark, games):
    found = P.table_rows(games)
    assert found.where("url = '/b/1'").groupBy("table_idx").count().count() == 9
    repeated = rows(found.where("NOT is_first AND url = '/b/1'"), "row_idx")
    assert [(r["table_idx"], r["row_idx"], r["header"]) for r in repeated] == [(0, 3, "Zoë O'Neil")]
    assert found.where("url IN ('/b/2', '/b/3', '/b/7')").count() == 0


def test_box_scores_do_not_shuffle(spark, games):
    plan = P.box_scores(games)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_zero_filled(spark):
    full = ["34:12", "", *["1"] * 16, "30", "-2", "Ann A"]
    data = [(0, full), (1, ["Did Not Dress", "Bob B"]), (1, ["Inactive", "Cid C"])]
    df = spark.createDataFrame([(t, c, "20200101", "Den", "Mia") for t, c in data], "t int, cells array<string>, d string, a string, h string")
    found = rows(P.zero_filled_box(df, "cells", "d", "a", "h", "t"), "Name")
    assert [(r["Name"], r["Team"], r["OPP"], r["Home"], r["Away"], r["MP"], r["FG"], r["PTS"], r["+/-"]) for r in found] == [
        ("Ann A", "Den", "Mia", 0, 1, 34.12, 0.0, 30.0, -2.0), ("Bob B", "Mia", "Den", 1, 0, 0.0, 0.0, 0.0, 0.0),
    ]
    assert found[0]["GameID"] == "20200101-Den-Mia"


def test_anchors_with_brackets_and_quotes(spark):
    html = """<a title="1 > 0" href="/x">one</a><a href='/y' data-a="href=/no">two</a><a data-b='say "hi" > all' href=/z>th<i title="a>b">re</i>e</a>
        <a name="no address">four</a><a href="">five</a><a HREF = /it's class=b>six</a><a data-href="/no" href="/w">seven</a><a href>eight</a><a title="=>" href="/v">nine"""
    found = link_rows(spark.createDataFrame([(1, html)], "page_id long, html string"))
    want = [("/x", "one"), ("/y", "two"), ("/z", "three"), ("", "five"), ("/it's", "six"), ("/w", "seven"), ("/v", "nine")]
    assert [(r["href"], r["text"]) for r in rows(found, "pos")] == want


def test_long_attributes_do_not_overflow(spark):
    html = f"""<a data-a="{'x>' * 200_000}" {'b=1 ' * 3_000} href="/x">one</a>""" + "<a " + "c " * 50_000
    found = link_rows(spark.createDataFrame([(1, html)], "page_id long, html string"))
    assert [(r["href"], r["text"]) for r in found.collect()] == [("/x", "one")]


def test_every_cell_is_a_value_or_an_error(spark):
    """Rows in are rows out and rows in quarantine; each unreadable cell is one error."""
    blank = {c: "1" for c in BOX_STATS} | {"Player": "P", "Date": "January 13 2016", "Team": "T", "Against": "U", "Home": "1", "GameLink": "/g"}
    cells = [
        {}, {"MP": "Did Not Play", "FG": "Not With Team"}, {c: "xx" for c in BOX_STATS}, {"MP": "34:12", "FG": " "}, {"Date": "13th of May"},
        {"PTS": None, "Home": "x"}, {"FG": "1.5"},
    ]
    raw = spark.createDataFrame([{k: v for k, v in (blank | c | {"GameLink": f"/g{i}"}).items()} for i, c in enumerate(cells)], ", ".join(f"`{c}` string" for c in blank))
    account = checked_box(raw)
    assert (account.n_rows, account.n_clean, account.n_quarantined, account.n_errors) == (7, 3, 4, len(BOX_STATS) + 3)
    assert [r["GameLink"] for r in rows(account.clean, "GameLink")] == ["/g0", "/g1", "/g3"]
    errors = [(r["URL"], r["Error"]) for r in rows(account.errors, "URL", "Error")]
    assert errors == sorted([("/g2", f"{c}: xx") for c in BOX_STATS] + [("/g4", "Date: 13th of May"), ("/g5", "Home: x"), ("/g6", "FG: 1.5")])


def test_references_are_read_once(spark):
    """Interpreted code evaluates an expression wherever it stands: the one for a reference's name stood in ten places."""
    shown = unescaped(F.col("t"))._jc.toString()
    assert shown.count("regexp_extract") == 1
    texts = spark.createDataFrame([("a &amp; b &#38; c &#x26; d &nope; e&nbsp;f &#0; &",), ("plain",), (None,)], "t string")
    assert [r[0] for r in texts.select(unescaped(F.col("t"))).collect()] == ["a & b & c & d &nope; e f &#0; &", "plain", None]


def test_errors_of_cells_and_of_whole_rows(spark):
    """Arrays are filtered in rows with errors only; an error of the whole row replaces those of its cells."""
    cells = [Cell("a", "A", lambda t: t.try_cast("double")), Cell("b", "B", lambda t: t.try_cast("int"))]
    df = spark.createDataFrame([("1", "x", None), ("", None, None), ("y", "z", None), ("y", "2", "broken"), ("1", "2", "broken")], "a string, b string, w string")
    found = df.select(cell_errors(cells, F.col("w")).alias("e"))
    assert [r["e"] for r in found.collect()] == [["B: x"], [], ["A: y", "B: z"], ["broken"], ["broken"]]
    assert [r[0] for r in df.select(cell_errors(cells)).collect()] == [["B: x"], [], ["A: y", "B: z"], ["A: y"], []]
