"""Links, headers and tables out of page source, row by row in the JVM.

Functions that take a ``source`` expect :func:`visible_source` of the page.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMMENT_OR_SCRIPT = "(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>"
# A quote matters only after an equals sign: there a value in quotes may hold anything, also ``>``.
_VALUE = "(?:\"[^\"]*+\"|'[^']*+'|[^\\s>]*+)"
_ATTRIBUTES = f"[^>=]*+(?:=\\s*+{_VALUE}[^>=]*+)*+"
_TAG = f"(?s)</?[A-Za-z!]{_ATTRIBUTES}>"
_ANCHOR = f"(?is)<a(?=\\s){_ATTRIBUTES}>.*?(?=</a>|<a\\s|$)"
# The first address among the attributes of an opening tag, with its quotes.
_ADDRESS = f"(?is)^<a(?:\\s*+(?!href\\s*+=)[^\\s=>]++(?:\\s*+=\\s*+{_VALUE})?+)*+\\s*+href\\s*+=\\s*+(\"[^\"]*+\"|'[^']*+'|[^\\s>]++)"


def visible_source(html: Column) -> Column:
    """Source without comments, scripts and styles, whose text must not count as markup."""
    return F.regexp_replace(html, _COMMENT_OR_SCRIPT, "")


_REST = 1_000_000_000


# Names and code points of HTML's character references, as the standard library lists them.
_NAMES = {**name2codepoint, "apos": ord("'")}


def unescaped(text: Column) -> Column:
    """Character references resolved once: decimal, hexadecimal and named ones; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for name, code in sorted(_NAMES.items()) for x in (name, code)])

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        # A lambda's code is interpreted: an expression is evaluated wherever it stands, a lambda's variable is not.
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def code(name: Column) -> Column:
        return (
            F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("int"))
            .when(name.startswith("#"), F.substr(name, F.lit(2)).try_cast("int"))
            .otherwise(F.try_element_at(names, name))
        )

    def character(number: Column) -> Column:
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0")), "UTF-32")
        return F.when(number == 160, F.lit(" ")).otherwise(char)  # names are keys, so spaces must be alike

    def resolved(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^(#\\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        text = once(name, lambda n: F.concat(once(code(n), character), F.substr(piece, F.length(n) + 2)))
        return F.coalesce(text, F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    plain = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, _REST), resolved), ""))
    return F.when(text.contains("&"), plain).otherwise(text)


def without_tags(text: Column) -> Column:
    return F.when(text.contains("<"), F.regexp_replace(text, "(?s)<[^>]*>", "")).otherwise(text)


def inner_texts(sources: Column) -> Column:
    """Text between tags of every source in an array, without surrounding space."""
    bare = F.transform(sources, without_tags)
    return F.transform(bare, lambda t: F.btrim(unescaped(t), F.lit(" \t\r\n")))


def _before(text: Column, pattern: str) -> Column:
    """What stands before the first match, or the whole text; the pattern is compiled once, and not for each text as by split."""
    at = F.regexp_instr(text, F.lit(pattern))
    return F.when(at > 0, F.substr(text, F.lit(1), at - 1)).otherwise(text)


def table_bodies(source: Column) -> Column:
    """Each table body. Opening tags delimit, so a missing end tag does no harm."""
    parts = F.slice(F.split(source, "(?i)<tbody\\b[^>]*>"), 2, _REST)
    return F.transform(parts, lambda b: _before(b, "(?i)</(?:tbody|table)\\b"))


def body_rows(body: Column) -> Column:
    """Source of each row of a body."""
    return F.slice(F.split(body, "(?i)<tr\\b[^>]*>"), 2, _REST)


def _cell_sources(row: Column, tag: str) -> Column:
    pieces = F.slice(F.split(row, f"(?i)<{tag}\\b[^>]*>"), 2, _REST)
    return F.transform(pieces, lambda c: _before(c, "(?i)<t[dh]\\b|</t[dhr]\\b"))


def row_parts(row: Column) -> Column:
    """struct<header, cells>: text of the first header cell (null without one) and of the data cells."""
    header = F.get(inner_texts(F.slice(_cell_sources(row, "th"), 1, 1)), F.lit(0))
    return F.struct(header.alias("header"), inner_texts(_cell_sources(row, "td")).alias("cells"))


def first_body(source: Column) -> Column:
    """Inside of the first table body; empty where the page has none."""
    return F.coalesce(F.get(table_bodies(source), F.lit(0)), F.lit(""))


def links(source: Column) -> Column:
    """array<struct<href,text>> of the anchors with an address, in page order."""
    anchors = F.transform(
        F.regexp_extract_all(source, F.lit(_ANCHOR), F.lit(0)),
        lambda a: F.struct(F.regexp_extract(a, _ADDRESS, 1).alias("address"), a.alias("anchor")),
    )

    def unquoted(address: Column) -> Column:
        quoted = address.startswith('"') | address.startswith("'")
        return F.when(quoted, F.substr(address, F.lit(2), F.length(address) - 2)).otherwise(address)

    return F.transform(
        F.filter(anchors, lambda a: a["address"] != ""),
        lambda a: F.struct(
            unescaped(unquoted(a["address"])).alias("href"),
            F.trim(unescaped(F.regexp_replace(a["anchor"], _TAG, ""))).alias("text"),
        ),
    )


def first_heading(source: Column) -> Column:
    inside = F.regexp_extract(source, "(?is)<h1[^>]*>(.*?)</h1>", 1)
    return F.trim(unescaped(F.regexp_replace(inside, "(?s)<[^>]*>", "")))


def header_teams(title: Column) -> tuple[Column, Column]:
    """``A at B Box Score, ...`` -> (away, home); "at" inside a name does no harm."""
    pattern = "^(.*?) at (.*?) Box Score"
    return F.regexp_extract(title, pattern, 1), F.regexp_extract(title, pattern, 2)


def header_date(title: Column) -> Column:
    """Last two comma pieces of the title: ``, January 13, 2016`` -> date."""
    text = F.regexp_extract(title, ",\\s*([A-Za-z]+ \\d{1,2}),\\s*(\\d{4})\\s*$", 0)
    return F.try_to_timestamp(F.trim(F.regexp_replace(text, ",", "")), F.lit("MMMM d yyyy")).cast("date")
