"""Cells read as values or as errors, so that no cell becomes null without a trace."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hardwood.functions.clean import unknown_text
from hardwood.session import materialize


@dataclass(frozen=True)
class Cell:
    """A column to read: its text, the name of its value, and how text becomes value (null where it cannot)."""

    source: str
    name: str
    read: Callable[[Column], Column]

    @property
    def text(self) -> Column:
        return F.col(f"`{self.source}`").cast("string")

    def value(self) -> Column:
        return self.read(F.col(f"`{self.source}`")).alias(self.name)

    def unread(self) -> Column:
        """True where the cell is neither empty, nor a sentinel, nor readable."""
        return unknown_text(self.text, self.read(F.col(f"`{self.source}`")))

    def error(self) -> Column:
        """What the cell holds, if that is neither empty, nor a sentinel, nor readable; else null."""
        return F.when(self.unread(), F.concat(F.lit(f"{self.name}: "), self.text))


def cell_errors(cells: Sequence[Cell], whole: Column | None = None) -> Column:
    """Array of the errors of all cells; where ``whole`` is not null, it is the row's only error.

    Whether there are any is compiled code that shares what it reads with the values; an array is filtered by
    interpreted code, which therefore only sees rows that have errors.
    """
    whole = F.lit(None).cast("string") if whole is None else whole
    none = F.array().cast("array<string>")
    found = F.array_compact(F.array(*[c.error() for c in cells]))
    # Compiled code shares what is read in the first condition, but not what stands in later ones.
    unread = reduce(lambda a, b: a | b, [c.unread() for c in cells])
    return F.when(unread & whole.isNull(), found).when(whole.isNotNull(), F.array(whole)).otherwise(none)


@dataclass(frozen=True)
class Account:
    """Rows whose cells could all be read, one ``(URL, Error)`` for every other cell, and how many of each."""

    clean: DataFrame
    errors: DataFrame
    n_rows: int
    n_clean: int
    n_errors: int

    @property
    def n_quarantined(self) -> int:
        return self.n_rows - self.n_clean


def read_cells(raw: DataFrame, cells: Sequence[Cell], url: Column, kept: Sequence[str] = ()) -> Account:
    """Read all ``cells`` of ``raw`` in one scan, which also counts and stores what it reads.

    Columns come in the order of ``kept`` and ``cells``. A row with a cell that cannot be read is in quarantine: it is not
    among the clean ones, and each such cell is one error.
    """
    plain = [F.col(f"`{c}`") for c in kept]
    return account_of(raw, [*plain, *[c.value() for c in cells]], cell_errors(cells), url)


def account_of(raw: DataFrame, values: Sequence[Column], errors: Column, url: Column) -> Account:
    """Rows of ``values`` told apart by whether the array ``errors`` is empty."""
    # The address of a row without errors is not asked for.
    read = raw.select(*values, errors.alias("_errors"), F.when(F.size(errors) > 0, url.cast("string")).alias("_url"))
    counts = Observation()
    n_errors = F.size("_errors")
    counted = read.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(n_errors == 0).alias("clean"),
        F.coalesce(F.sum(n_errors), F.lit(0)).alias("errors"),
    )
    stored = materialize(counted, "cells")
    clean = stored.where(F.size("_errors") == 0).drop("_errors", "_url")
    found = stored.select(F.col("_url").alias("URL"), F.explode("_errors").alias("Error"))
    return Account(clean, found, counts.get["rows"], counts.get["clean"], counts.get["errors"])
