"""Weighted scores, stat strings, positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hardwood.fixed_values import POSITIONS, SCORE_BOOKS, STAT_SUFFIXES


def weighted_score(weights: dict[str, float]) -> Column:
    """Sum of weight x column; null as soon as one column is null."""
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`") * F.lit(float(w)) for c, w in weights.items()])


def book_score(book: str = "FDP") -> Column:
    if book not in SCORE_BOOKS:
        raise ValueError(f"no score formula for book {book!r}; known: {sorted(SCORE_BOOKS)}")
    return weighted_score(SCORE_BOOKS[book])


def stat_token(stats: Column, suffix: str) -> Column:
    """Text before ``suffix`` in the last token that ends with it, else null."""
    found = F.regexp_extract(stats, f"(?:^.*\\s|^)([0-9-]+){suffix}(?:\\s|$)", 1)
    return F.nullif(found, F.lit(""))


def stat_columns(stats: Column) -> dict[str, Column]:
    """All columns of a stat string such as ``30pt 8rb 11-20fg``; absent items are null."""
    columns: dict[str, Column] = {}
    for suffix, name in STAT_SUFFIXES.items():
        text = stat_token(stats, suffix)
        if suffix in ("fg", "ft"):
            columns[f"{name}M"] = F.split_part(text, F.lit("-"), F.lit(1)).try_cast("int")
            columns[f"{name}A"] = F.split_part(text, F.lit("-"), F.lit(2)).try_cast("int")
        else:
            columns[name] = text.try_cast("int")
    return columns


def share(made: Column, attempted: Column) -> Column:
    """Made / attempted, null without an attempt."""
    return F.try_divide(made.cast("double"), attempted.cast("double"))


def multi_double(columns: list[Column], at_least: int) -> Column:
    """1 where ``at_least`` of the columns reach ten."""
    reached = reduce(lambda a, b: a + b, [F.when(c >= 10, 1).otherwise(0) for c in columns])
    return F.when(reached >= at_least, 1).otherwise(0)


def positions_of_digits(code: Column) -> Column:
    """``12`` -> [PG, SG]; other characters are dropped."""
    labels = F.array(*[F.lit(v) for v in POSITIONS.values()])
    digits = F.regexp_extract_all(code.cast("string"), F.lit("([1-5])"), F.lit(1))
    return F.transform(digits, lambda d: F.element_at(labels, d.cast("int")))


def positions_of_label(label: Column) -> Column:
    """``G-F`` -> [G, F]."""
    return F.split(label, "-")
