"""Landed pages: links, completeness checks, header and box-score extraction.

A page is one row and everything about its links and tables stays inside that row, so
nothing here shuffles, and all of it runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.fixed_values import BOX_STATS, MONTH_LINK_TEXTS
from hardwood.functions.clean import blank_to_zero, game_id, home_flag, minutes_dotted, repair_team
from hardwood.functions.markup import (
    body_rows, first_body, first_heading, header_date, header_teams, links, row_parts, table_bodies, visible_source,
)

BOX_SCORE_TEXT = "Box Score"


def _visible(pages: DataFrame, html: str) -> DataFrame:
    """The source without comments and scripts, computed once for all that reads it."""
    return pages.withColumn(html, visible_source(F.col(html)))


def _link_lists(pages: DataFrame, html: str, in_first_body: bool) -> DataFrame:
    source = first_body(F.col(html)) if in_first_body else F.col(html)
    return _visible(pages, html).withColumn("_links", links(source)).drop(html)


def _each(df: DataFrame, kept: Sequence[str], column, position: str, item: str) -> DataFrame:
    """One row per array element.

    A plain explode would add a filter on the array below, where the optimizer puts the
    parsing in a second time; the outer one and a filter on its result parse once.
    """
    return df.select(*kept, F.posexplode_outer(column).alias(position, item)).where(F.col(position).isNotNull())


def link_rows(pages: DataFrame, html: str = "html", in_first_body: bool = False) -> DataFrame:
    """One row per anchor with an address: ``pos`` (from 0), ``href``, ``text``."""
    kept = [c for c in pages.columns if c != html]
    lists = _link_lists(pages, html, in_first_body)
    return _each(lists, kept, "_links", "pos", "link").select(*kept, "pos", "link.href", "link.text")


def month_links(link_table: DataFrame, base_url: str, texts: Sequence[str] = MONTH_LINK_TEXTS) -> DataFrame:
    """Links whose text is a month name, with absolute address."""
    kept = link_table.where(F.lower("text").isin(list(texts)))
    return kept.withColumn("url_abs", F.concat(F.lit(base_url), "href"))


def stride_links(link_table: DataFrame, stride: int, condition: Column) -> DataFrame:
    """Every ``stride``-th link of a page that also meets ``condition``."""
    return link_table.where((F.pmod(F.col("pos") + 1, F.lit(stride)) == 0) & condition)


def _is_box(link: Column) -> Column:
    return F.trim(link["text"]) == BOX_SCORE_TEXT


def completeness(
    pages: DataFrame, is_box=_is_box, links_per_box: int = 4, html: str = "html", in_first_body: bool = False
) -> DataFrame:
    """``checked``: null for a complete page, else the number of box links found.

    Complete means exactly ``links_per_box`` links for each box link, and at least one.
    """
    counted = _link_lists(pages, html, in_first_body).select(
        *[c for c in pages.columns if c != html],
        F.size("_links").alias("n_links"),
        F.size(F.filter("_links", is_box)).alias("n_box"),
    )
    broken = (F.col("n_box") == 0) | (F.col("n_links") != F.col("n_box") * links_per_box)
    return counted.withColumn("checked", F.when(broken, F.col("n_box")))


def zip_links(pages: DataFrame, is_first=_is_box, is_second=None, html: str = "html", in_first_body: bool = False) -> DataFrame:
    """Pair two kinds of links of a page by ordinal; the longer list's rest is dropped."""
    is_second = is_second or (lambda link: link["text"].contains(","))
    kept = [c for c in pages.columns if c != html]
    lists = _link_lists(pages, html, in_first_body).select(
        *kept, F.filter("_links", is_first).alias("_a"), F.filter("_links", is_second).alias("_b")
    )
    paired = _each(lists, kept, F.arrays_zip("_a", "_b"), "ordinal", "pair")
    both = paired.where(F.col("pair._a").isNotNull() & F.col("pair._b").isNotNull())
    return both.select(
        *kept,
        "ordinal",
        F.col("pair._a.href").alias("first_href"),
        F.col("pair._a.text").alias("first_text"),
        F.col("pair._b.href").alias("second_href"),
        F.col("pair._b.text").alias("second_text"),
    )


def table_rows(pages: DataFrame, html: str = "html", tables: Sequence[int] | None = None) -> DataFrame:
    """Every table-body row of every page; the page's other columns are repeated.

    Adds ``table_idx``, ``row_idx``, ``header``, ``is_first`` (no earlier row of the table
    has the header) and ``cells``. With ``tables`` only those bodies are taken apart.
    """
    kept = [c for c in pages.columns if c != html]
    bodies = _visible(pages, html).select(*kept, table_bodies(F.col(html)).alias("_bodies"))
    return _opened(bodies, kept, tables)


def _opened(bodies: DataFrame, kept: Sequence[str], tables: Sequence[int] | None) -> DataFrame:
    """Bodies (``_bodies``) to rows."""
    opened = _each(bodies, kept, "_bodies", "table_idx", "_body")
    if tables is not None:
        opened = opened.where(F.col("table_idx").isin(*tables))
    lines = opened.select(*kept, "table_idx", F.transform(body_rows(F.col("_body")), row_parts).alias("_rows"))
    headers = lines.withColumn("_headers", F.transform("_rows", lambda r: r["header"]))
    rows = _each(headers, [*kept, "table_idx", "_headers"], "_rows", "row_idx", "_row")
    # The coalesce keeps a filter on this column from being inferred below, for the same reason.
    first = F.coalesce(F.array_position("_headers", F.col("_row.header")) == F.col("row_idx") + 1, F.lit(False))
    return rows.select(*kept, "table_idx", "row_idx", "_row.header", first.alias("is_first"), "_row.cells")


def _page_error(title: Column, bodies: Column, tables: Sequence[int]) -> Column:
    """What keeps a page from giving a whole game; null if nothing does."""
    away, home = header_teams(title)
    return (
        F.when(F.size(bodies) == 0, "no table body")
        .when(~F.exists(bodies, lambda b: b.rlike("(?i)<tr\\b")), "no rows")
        .when(F.size(bodies) <= max(tables), "no home table")
        .when((away == "") | (home == "") | header_date(title).isNull(), "no teams or date in the title")
    )


def _read_pages(pages: DataFrame, url: str, html: str, tables: Sequence[int]) -> DataFrame:
    """``(url, _title, _bodies, _error)``; a page without source has no table body."""
    source = F.coalesce(F.col(html), F.lit(""))
    read = _visible(pages.withColumn(html, source), html).select(
        url, first_heading(F.col(html)).alias("_title"), table_bodies(F.col(html)).alias("_bodies")
    )
    return read.withColumn("_error", _page_error(F.col("_title"), F.col("_bodies"), tables))


def page_errors(pages: DataFrame, url: str = "url", html: str = "html", tables: tuple[int, int] = (0, 8)) -> DataFrame:
    """Quarantine table ``(URL, Error)``: the pages that :func:`box_scores` leaves out, and why."""
    read = _read_pages(pages, url, html, tables).select(F.col(url).alias("URL"), F.array_compact(F.array("_error")).alias("_errors"))
    return _each(read, ["URL"], "_errors", "_i", "Error").drop("_i")


def _cell(i: int) -> Column:
    return F.try_element_at("cells", F.lit(i + 1))


def box_scores(pages: DataFrame, url: str = "url", html: str = "html", tables: tuple[int, int] = (0, 8)) -> DataFrame:
    """One row per player and game in the raw box-score layout, plus ``GameLink``.

    Table ``tables[0]`` is the visitors', ``tables[1]`` the home side's. A short row (the
    player did not play) is filled up with nulls. Of several rows with one name in one
    team the first counts. Pages listed by :func:`page_errors` give no rows, so no game is halved.
    """
    read = _read_pages(pages, url, html, tables)
    whole = F.when(F.col("_error").isNull(), F.col("_bodies"))
    read = read.select(url, "_title", whole.alias("_bodies"))
    away, home = header_teams(F.col("_title"))
    titled = read.select(
        url, "_bodies", away.alias("_away"), home.alias("_home"),
        F.date_format(header_date(F.col("_title")), "MMMM d yyyy").alias("Date"),
    )
    # Titles travel with the rows, and repeats of a name are found page by page: no shuffle.
    joined = _opened(titled, [url, "_away", "_home", "Date"], tables).where((F.col("header") != "Reserves") & F.col("is_first"))
    flag = home_flag(F.when(F.col("table_idx") == tables[0], 0).otherwise(1))
    return joined.select(
        F.col("header").alias("Player"),
        "Date",
        F.when(flag == 0, F.col("_away")).otherwise(F.col("_home")).alias("Team"),
        F.when(flag == 0, F.col("_home")).otherwise(F.col("_away")).alias("Against"),
        flag.alias("Home"),
        *[_cell(i).alias(c) for i, c in enumerate(BOX_STATS)],
        F.col(url).alias("GameLink"),
    )


def zero_filled_box(
    rows: DataFrame, cells: str, date_key: str, team1: str, team2: str, table_idx: str, full: int = 21
) -> DataFrame:
    """Older layout: cells end with the player's name.

    Rows with fewer than ``full`` cells become zeros if they say "Did Not ...", else they
    are dropped. Blanks become 0 and minutes are dotted.
    """
    short = F.size(cells) < full
    told = F.coalesce(F.try_element_at(cells, F.lit(1)).contains("Did Not"), F.lit(False))
    kept = rows.where(~short | told)
    stats = [c for c in BOX_STATS]
    values = []
    for i, name in enumerate(stats):
        text = blank_to_zero(F.try_element_at(cells, F.lit(i + 1)))
        number = minutes_dotted(text) if name == "MP" else text.try_cast("double")
        values.append(F.when(short, F.lit(0.0)).otherwise(number).alias(name))
    first = F.col(table_idx) == 0
    return kept.select(
        F.col(date_key).alias("Date"),
        game_id(F.col(date_key), F.col(team1), F.col(team2)).alias("GameID"),
        F.element_at(cells, -1).alias("Name"),
        F.when(first, F.col(team1)).otherwise(F.col(team2)).alias("Team"),
        F.when(first, F.col(team2)).otherwise(F.col(team1)).alias("OPP"),
        home_flag(F.col(table_idx)).alias("Home"),
        (1 - home_flag(F.col(table_idx))).alias("Away"),
        *values,
    )


def repaired_teams(box: DataFrame, aliases: dict[str, str]) -> DataFrame:
    return box.withColumns({c: repair_team(F.col(c), aliases) for c in ("Team", "Against")})
