"""Repair of names, dates, minutes, sentinels and keys (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hardwood.fixed_values import DID_NOT_PLAY


def compact_date(text: Column) -> Column:
    """``20191022`` -> date; null where the text is no such date."""
    return F.try_to_timestamp(text.cast("string"), F.lit("yyyyMMdd")).cast("date")


# --- fixed values: free date formats, by the shape of the text
DATE_SHAPES = {
    "^\\d{4}-\\d{1,2}-\\d{1,2}$": "yyyy-M-d",
    "^[A-Za-z]+ \\d{1,2} \\d{4}$": "MMMM d yyyy",
    "^[A-Za-z]+ \\d{1,2}, \\d{4}$": "MMMM d, yyyy",
    "^\\d{8}$": "yyyyMMdd",
}


def any_date(text: Column, shapes: dict[str, str] = DATE_SHAPES) -> Column:
    """Date in one of several formats. The shape picks the format, because each failed
    parse of a row costs more than all the patterns."""
    dates = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form))) for shape, form in shapes.items()]
    return F.coalesce(*dates).cast("date")


def anchor_date_key(text: Column) -> Column:
    """``Tue, Oct 22, 2019`` -> ``20191022``, for all twelve months."""
    day = F.regexp_replace(text, "^[A-Za-z]+, ", "")
    return F.date_format(F.try_to_timestamp(day, F.lit("MMM d, yyyy")), "yyyyMMdd")


def flip_name(name: Column) -> Column:
    """``Last, First`` -> ``First Last``: last piece, then first piece.

    A name without a comma is both pieces, so it doubles (``Nene`` -> ``Nene Nene``).
    """
    return F.concat(F.substring_index(name, ", ", -1), F.lit(" "), F.substring_index(name, ", ", 1))


def flip_name_once(name: Column) -> Column:
    """Like :func:`flip_name`, but a single-part name stays as it is."""
    return F.when(name.contains(", "), flip_name(name)).otherwise(name)


def _number(text: Column, kind: str) -> Column:
    return F.when(~text.isin(DID_NOT_PLAY), F.trim(text).try_cast(kind))


def minutes_dotted(text: Column) -> Column:
    """``34:12`` -> 34.12: the colon becomes a point. Sentinels and unknown text -> null."""
    return F.when(~text.isin(DID_NOT_PLAY), F.replace(text, F.lit(":"), F.lit(".")).try_cast("double"))


def minutes_true(text: Column) -> Column:
    """``34:12`` -> 34.2 minutes."""
    whole = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.coalesce(F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double"), F.lit(0.0))
    return F.when(~text.isin(DID_NOT_PLAY), whole + seconds / 60)


def count_or_null(text: Column) -> Column:
    """Whole number, null for sentinels and unknown text."""
    return _number(text, "int")


def unknown_text(text: Column, parsed: Column) -> Column:
    """True where a text is neither empty, nor a sentinel, nor readable as a number."""
    return parsed.isNull() & text.isNotNull() & (F.trim(text) != "") & ~text.isin(DID_NOT_PLAY)


def blank_to_zero(text: Column) -> Column:
    return F.when(F.trim(text) == "", F.lit("0")).otherwise(text)


def repair_team(team: Column, aliases: dict[str, str]) -> Column:
    """Alias -> full name through a literal map; other names pass."""
    pairs = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, team), team)


def home_flag(table_index: Column) -> Column:
    """First table of a game is the visitors'."""
    return F.when(table_index == 0, 0).otherwise(1)


def game_id(date_key: Column, away: Column, home: Column) -> Column:
    return F.concat_ws("-", date_key, away, home)


def season_end_year(label: Column) -> Column:
    """``2019-20`` -> ``2020``."""
    return F.concat(F.lit("20"), F.substring_index(label, "-", -1))


def year_key(day: Column) -> Column:
    """Two-digit calendar year."""
    return F.date_format(day, "yy")


def clock_text(hours: Column) -> Column:
    """Decimal hours -> ``hh:mm`` (19.5 -> ``19:30``)."""
    minutes = F.round(hours * 60).cast("int")
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), F.pmod(minutes, F.lit(60)))


def any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def injured_flag(columns: Iterable[str]) -> Column:
    """1 where any of the columns is null. Take it before nulls are filled."""
    return F.when(any_null(columns), 1).otherwise(0)
