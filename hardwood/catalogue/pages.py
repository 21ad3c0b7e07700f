"""Links, completeness, coverage and box scores out of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.cleaning import _sql_team, _team
from hardwood.catalogue.registry import query
from hardwood.fixed_values import SEASON_MONTHS
from hardwood.operators import pages as P
from hardwood.operators.reconcile import expected_months, only_new
from hardwood.plans.scrape import checked_box, clean_box
from hardwood.streaming.ingest import ingest_pages
from hardwood.session import work_path

MONTH_WORDS = ["the", "and", "der", "die", "de", "la", "for", "und"]

SQL_LINKS = """
    src AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', '', 'g') AS s FROM pages),
    raw AS (SELECT page_id, regexp_extract_all(s, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>([^<]*)', 1) AS hs,
                   regexp_extract_all(s, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>([^<]*)', 2) AS ts FROM src),
    link AS (SELECT page_id, unnest(range(len(hs)))::INT AS pos, unnest(hs) AS href, trim(unnest(ts)) AS text FROM raw)
"""


def _short(link):
    return F.length(link["text"]) <= 3


def _long(link):
    return F.length(link["text"]) > 3


@query("link_explode", "S7 S10", f"WITH {SQL_LINKS} SELECT page_id, pos, href, text FROM link")
def link_explode(tables):
    return P.link_rows(tables.pages.select("page_id", "html"))


def _quoted_otherwise(pages):
    """Addresses in double quotes, in single quotes or bare, by page; one letter of them as a reference."""
    form = F.col("page_id") % 3
    bare = F.regexp_replace("html", 'href="/([^"\\s>]*)"', "href=&#x2F;$1")
    single = F.regexp_replace("html", 'href="/([^"]*)"', "HREF = '&#47;$1'")
    html = F.when(form == 0, F.col("html")).when(form == 1, single).otherwise(bare)
    return pages.select("page_id", html.alias("html"))


@query("link_quoting_forms", "S10", f"WITH {SQL_LINKS} SELECT page_id, pos, href, text FROM link")
def link_quoting_forms(tables):
    """The same links, however their addresses are written."""
    return P.link_rows(_quoted_otherwise(tables.pages))


def _with_brackets(pages):
    """Attributes before the address that hold ``>``, quotes of the other kind, and what looks like an address."""
    more = """<a title="1 > 0" data-a='say "href=/x" > y' data-b = "it's" rel=next\n href="""
    return pages.select("page_id", F.regexp_replace("html", "<a href=", more).alias("html"))


@query("link_quoted_brackets", "S10", f"WITH {SQL_LINKS} SELECT page_id, pos, href, text FROM link")
def link_quoted_brackets(tables):
    """The same links, whatever stands in the other attributes."""
    return P.link_rows(_with_brackets(tables.pages))


@query("link_stride", "S11", f"WITH {SQL_LINKS} SELECT page_id, pos, href FROM link WHERE (pos + 1) % 4 = 0 AND length(text) > 1")
def link_stride(tables):
    links = P.link_rows(tables.pages.select("page_id", "html"))
    return P.stride_links(links, 4, F.length("text") > 1).select("page_id", "pos", "href")


@query(
    "month_links",
    "S10",
    f"WITH {SQL_LINKS} SELECT page_id, text, 'https://site.example' || href AS url FROM link WHERE lower(text) IN {tuple(MONTH_WORDS)}",
)
def month_links(tables):
    links = P.link_rows(tables.pages.select("page_id", "html"))
    return P.month_links(links, "https://site.example", MONTH_WORDS).select("page_id", "text", F.col("url_abs").alias("url"))


@query(
    "page_completeness",
    "S12",
    f"""
    WITH {SQL_LINKS},
    c AS (SELECT p.page_id, count(l.page_id)::INT AS n_links, count(l.page_id) FILTER (WHERE length(l.text) <= 3)::INT AS n_box
          FROM pages p LEFT JOIN link l ON p.page_id = l.page_id GROUP BY 1)
    SELECT page_id, n_links, n_box, CASE WHEN n_box = 0 OR n_links <> n_box * 4 THEN n_box END AS checked FROM c
    """,
)
def page_completeness(tables):
    return P.completeness(tables.pages.select("page_id", "html"), _short)


@query(
    "link_date_zip",
    "S13",
    f"""
    WITH {SQL_LINKS},
    a AS (SELECT page_id, href, text, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM link WHERE length(text) <= 3),
    b AS (SELECT page_id, href, text, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM link WHERE length(text) > 3)
    SELECT a.page_id, (a.k - 1)::INT AS ordinal, a.href AS first_href, a.text AS first_text, b.href AS second_href, b.text AS second_text
    FROM a JOIN b ON a.page_id = b.page_id AND a.k = b.k
    """,
)
def link_date_zip(tables):
    return P.zip_links(tables.pages.select("page_id", "html"), _short, _long)


_SQL_MONTHS = ", ".join(f"({k}, '{m}')" for k, v in SEASON_MONTHS.items() for m in v)


@query(
    "coverage_missing_months",
    "S8 J7",
    f"""
    WITH md(kind, month) AS (VALUES {_SQL_MONTHS}),
    seasons AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    grid AS (SELECT y::VARCHAR || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') AS season, month, y % 5 AS kind,
                    '/leagues/NBA_20' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') || '_games-' || month || '.html' AS page
             FROM seasons JOIN md ON md.kind = seasons.y % 5),
    landed AS (SELECT year(o_orderdate)::VARCHAR || '-' || lpad(((year(o_orderdate) + 1) % 100)::VARCHAR, 2, '0') AS season,
                      lower(strftime(o_orderdate, '%B')) AS month FROM orders GROUP BY 1, 2
               HAVING avg(o_totalprice) > (SELECT avg(o_totalprice) FROM orders))
    SELECT season, month, page FROM grid WHERE NOT EXISTS
      (SELECT 1 FROM landed WHERE landed.season = grid.season AND landed.month = grid.month)
    """,
)
def coverage_missing_months(tables):
    """Expected season months without a landed page; a month of dear orders stands for a page."""
    year = F.year("o_orderdate")
    label = F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))
    seasons = tables.orders.select(label.alias("season"), (year % 5).alias("scrape_type")).distinct()
    overall = tables.orders.agg(F.avg("o_totalprice")).first()[0]
    by_month = tables.orders.groupBy(label.alias("season"), F.lower(F.date_format("o_orderdate", "MMMM")).alias("month"))
    landed = by_month.agg(F.avg("o_totalprice").alias("mean")).where(F.col("mean") > F.lit(overall))
    grid = expected_months(seasons)
    return only_new(grid, landed, ["season", "month"], ["page"]).select("season", "month", "page")


@query(
    "new_seasons_only",
    "S9 J4",
    """
    SELECT year(l_shipdate)::INT AS season, count(*) AS n FROM lineitem
    WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_orderdate < DATE '1998-01-01') GROUP BY 1
    """,
)
def new_seasons_only(tables):
    landed = tables.lineitem.select(F.year("l_shipdate").alias("season"), "l_orderkey", "l_linenumber")
    loaded = tables.orders.where("o_orderdate < DATE '1998-01-01'").select(F.year("o_orderdate").alias("season"))
    new = only_new(landed, loaded, ["season"], ["l_orderkey", "l_linenumber"])
    return new.groupBy("season").agg(F.count(F.lit(1)).alias("n"))


@query(
    "zero_fill_short_rows",
    "S16 C14 C15 C16",
    f"""
    SELECT strftime(l_shipdate, '%Y%m%d') AS "Date",
           strftime(l_shipdate, '%Y%m%d') || '-' || {_sql_team('l_suppkey')} || '-' || {_sql_team('l_suppkey', 3)} AS "GameID",
           'P' || l_partkey AS "Name", CASE WHEN l_linenumber = 1 THEN {_sql_team('l_suppkey')} ELSE {_sql_team('l_suppkey', 3)} END AS "Team",
           CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS "Home",
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE (l_quantity::INT || '.07')::DOUBLE END AS "MP",
           CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 0 ELSE l_linenumber::DOUBLE END AS "FG",
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS "PTS"
    FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus = 'F'
    """,
)
def zero_fill_short_rows(tables):
    """Full rows, "Did Not Play" rows (kept as zeros) and other short rows (dropped)."""
    name = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    minutes = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(":07"))
    made = F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.col("l_linenumber").cast("string"))
    points = F.col("l_quantity").cast("int").cast("string")
    full = F.array(minutes, made, *[F.lit("1")] * 16, points, F.lit("-3"), name)
    cells = (
        F.when(F.col("l_returnflag") == "R", F.array(F.lit("Did Not Play"), name))
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.array(F.lit("Coach's choice"), name))
        .otherwise(full)
    )
    rows = tables.lineitem.select(
        cells.alias("cells"), F.date_format("l_shipdate", "yyyyMMdd").alias("day"), (F.col("l_linenumber") - 1).alias("t"),
        _team(F.col("l_suppkey")).alias("team1"), _team(F.col("l_suppkey"), 3).alias("team2"),
    )
    box = P.zero_filled_box(rows, "cells", "day", "team1", "team2", "t")
    return box.select("Date", "GameID", "Name", "Team", "Home", "MP", "FG", "PTS")


def _box_pages(tables):
    """Every order as a box-score page: nine table bodies, of which two hold the players."""
    order = F.col("o_orderkey").cast("string")
    title = F.concat(
        _team(F.col("o_custkey")), F.lit(" at "), _team(F.col("o_custkey"), 7), F.lit(" Box Score, "),
        F.date_format("o_orderdate", "MMMM d, yyyy"),
    )
    points = F.floor(F.col("o_totalprice") / 10000).cast("string")

    def player(name, minutes, score):
        cells = [minutes, score, *[F.lit("2")] * 16, score, F.lit("+1")]
        return F.concat(F.lit("<tr><th>"), name, F.lit("</th>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))

    reserves = F.lit("<tr><th>Reserves</th></tr>")
    absent = F.concat(F.lit("<tr><th>Out &amp; About</th><td>Did Not Play</td></tr>"))
    away = F.concat(player(F.concat(F.lit("A"), order), F.lit("34:12"), points), reserves, absent)
    # The home row leaves its last cells and the row itself unclosed.
    home = F.concat(F.lit("<tr><th>H"), order, F.lit("<td>12:30<td>"), points, F.lit("<td>"))
    other = F.lit("<tbody><tr><th>Team Totals</th><td>240</td></tr></tbody>")
    html = F.concat(
        F.lit("<html><body><h1>"), title, F.lit("</h1><table><tbody>"), away, F.lit("</tbody>"), *[other] * 7,
        F.lit("<tbody>"), home, F.lit("</tbody></table></body></html>"),
    )
    page = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("<h1>"), title, F.lit("</h1><p>postponed</p>"))).otherwise(html)
    # A page is much larger than the row it is made of, so the rows are spread out first.
    parts = int(tables.spark.conf.get("spark.sql.shuffle.partitions"))
    spread = tables.orders.repartition(parts, "o_orderkey")
    return spread.select(F.concat(F.lit("/boxscores/"), order).alias("url"), page.alias("html"))


@query(
    "box_score_extract",
    "S15 S14 C3 C6 C7 C14",
    f"""
    WITH g AS (SELECT '/boxscores/' || o_orderkey AS "GameLink", o_orderkey, {_sql_team('o_custkey')} AS a, {_sql_team('o_custkey', 7)} AS h,
                      strftime(o_orderdate, '%Y-%m-%d') AS "Date", floor(o_totalprice / 10000)::INT AS p FROM orders WHERE o_orderstatus <> 'P')
    SELECT 'A' || o_orderkey AS "Player", "Date", a AS "Team", h AS "Against", 0 AS "Home", 34.12::DOUBLE AS "MP", p AS "FG", p::DOUBLE AS "PTS", "GameLink" FROM g
    UNION ALL SELECT 'Out & About', "Date", a, h, 0, NULL, NULL, NULL, "GameLink" FROM g
    UNION ALL SELECT 'H' || o_orderkey, "Date", h, a, 1, 12.3::DOUBLE, p, NULL, "GameLink" FROM g
    """,
)
def box_score_extract(tables):
    box = clean_box(P.box_scores(_box_pages(tables)))
    return box.select("Player", F.col("Date").cast("string").alias("Date"), "Team", "Against", "Home", "MP", "FG", "PTS", "GameLink")


def _broken_pages(tables):
    """Pages with each kind of fault, beside whole ones."""
    pages = _box_pages(tables)
    order = F.element_at(F.split("url", "/"), -1).cast("long")
    kind = order % 8
    no_home = F.regexp_replace("html", "(?s)<tbody><tr><th>Team Totals.*?</tbody>", "")
    html = (
        F.when(kind == 1, no_home)
        .when(kind == 2, F.regexp_replace("html", " at ", " v "))
        .when(kind == 3, F.regexp_replace("html", "(?s)<tr.*?</tr>|<tr.*?(?=</tbody>)", ""))
        .otherwise(F.col("html"))
    )
    return pages.select("url", html.alias("html"))


@query(
    "box_score_quarantine",
    "K6 S15",
    """
    SELECT * FROM (
      SELECT '/boxscores/' || o_orderkey AS "URL",
        CASE WHEN o_orderstatus = 'P' THEN 'no table body' WHEN o_orderkey % 8 = 1 THEN 'no home table'
             WHEN o_orderkey % 8 = 2 THEN 'no teams or date in the title' WHEN o_orderkey % 8 = 3 THEN 'no rows' END AS "Error" FROM orders)
    WHERE "Error" IS NOT NULL
    """,
)
def box_score_quarantine(tables):
    return P.page_errors(_broken_pages(tables))


@query(
    "box_score_of_whole_pages",
    "S15 K6",
    """
    SELECT '/boxscores/' || o_orderkey AS "GameLink", count(*) AS n FROM orders, range(3)
    WHERE o_orderstatus <> 'P' AND o_orderkey % 8 NOT IN (1, 2, 3) GROUP BY 1
    """,
)
def box_score_of_whole_pages(tables):
    """Pages in quarantine give no rows; all others give all of theirs."""
    return P.box_scores(_broken_pages(tables)).groupBy("GameLink").agg(F.count(F.lit(1)).alias("n"))


def _unreadable_pages(tables):
    """Whole pages of which some have a cell that is no number."""
    order = F.element_at(F.split("url", "/"), -1).cast("long")
    html = (
        F.when(order % 8 == 4, F.replace(F.col("html"), F.lit("<td>34:12"), F.lit("<td>half")))
        .when(order % 8 == 5, F.replace(F.col("html"), F.lit("<td>12:30"), F.lit("<td>12;30")))
        .otherwise(F.col("html"))
    )
    return _box_pages(tables).select("url", html.alias("html"))


@query(
    "cell_quarantine",
    "C7 K6 C1",
    """
    WITH o AS (SELECT o_orderkey, '/boxscores/' || o_orderkey AS url FROM orders WHERE o_orderstatus <> 'P')
    SELECT 'error' AS kind, url AS "URL", CASE WHEN o_orderkey % 8 = 4 THEN 'MP: half' ELSE 'MP: 12;30' END AS "Error", 1 AS n FROM o WHERE o_orderkey % 8 IN (4, 5)
    UNION ALL SELECT 'clean', url, NULL, CASE WHEN o_orderkey % 8 IN (4, 5) THEN 2 ELSE 3 END FROM o
    UNION ALL SELECT 'rows', NULL, NULL, 3 * count(*) FROM o
    """,
)
def cell_quarantine(tables):
    """Unreadable cells one by one, the rows that stay, and all rows read."""
    account = checked_box(P.box_scores(_unreadable_pages(tables)))
    none = F.lit(None).cast("string")
    errors = account.errors.groupBy("URL", "Error").agg(F.count(F.lit(1)).alias("n")).select(F.lit("error").alias("kind"), "URL", "Error", "n")
    clean = account.clean.groupBy("GameLink").agg(F.count(F.lit(1)).alias("n"))
    clean = clean.select(F.lit("clean").alias("kind"), F.col("GameLink").alias("URL"), none.alias("Error"), "n")
    total = tables.spark.range(1).select(F.lit("rows").alias("kind"), none.alias("URL"), none.alias("Error"), F.lit(account.n_rows).cast("long").alias("n"))
    return errors.unionByName(clean).unionByName(total)


@query("stream_page_ingest", "T1", "SELECT page_id, url, length(html)::INT AS n_chars FROM pages")
def stream_page_ingest(tables):
    """Pages land in two parts, of which the second repeats a half of the first."""
    folder = work_path(tables.spark, "ingest")
    half = F.col("page_id") % 4
    for landed in (half < 2, half > 0):
        tables.pages.where(landed).write.mode("append").parquet(f"{folder}/landing")
        table = ingest_pages(tables.spark, f"{folder}/landing", f"{folder}/pages", f"{folder}/checkpoint")
    return table.select("page_id", "url", F.length("html").alias("n_chars"))
