"""Landed pages -> raw box scores -> cleaned box scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.fixed_values import BOX_STATS, TEAM_ALIASES
from hardwood.functions.clean import any_date, count_or_null, minutes_dotted
from hardwood.operators.accounting import Account, Cell, read_cells
from hardwood.operators.pages import box_scores, page_errors, repaired_teams


def _number(text: Column) -> Column:
    # A failed cast costs an exception, and many cells are blank.
    return F.when(F.trim(text) != "", text.try_cast("double"))


_READERS = {"MP": minutes_dotted, "FG": count_or_null}
BOX_CELLS = [
    Cell("Date", "Date", any_date),
    Cell("Home", "Home", lambda text: text.try_cast("int")),
    *[Cell(c, c, _READERS.get(c, _number)) for c in BOX_STATS],
]


def clean_box(raw: DataFrame) -> DataFrame:
    """Teams repaired, dates and numbers typed, sentinels to null; so is what cannot be read, see :func:`checked_box`."""
    return repaired_teams(raw, TEAM_ALIASES).withColumns({cell.name: cell.value() for cell in BOX_CELLS})


def checked_box(raw: DataFrame) -> Account:
    """Like :func:`clean_box`, with rows that have an unreadable cell in quarantine."""
    return read_cells(repaired_teams(raw, TEAM_ALIASES), BOX_CELLS, F.col("GameLink"), ["Player", "Team", "Against", "GameLink"])


def pages_to_box(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned box scores, quarantine table of pages and of cells)."""
    account = checked_box(box_scores(pages))
    return account.clean, page_errors(pages).unionByName(account.errors)
