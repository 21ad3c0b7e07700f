"""Free dates whose format is found from the whole column before any of it is parsed.

``03/04/2019`` alone could be March or April. A column as a whole usually tells: one pass counts, for each way of writing two
numbers and a year, in how many cells the first number exceeds 12 and in how many the second does. A
form that is told apart one way only is read that way in all cells. What stays ambiguous, or contradicts itself, or is no date, gets a
reason instead of a value, so nothing is guessed cell by cell. Years of two digits are those from 2000 to 2099.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.operators.accounting import Account, account_of

# --- fixed values: shapes that can be read in one way only, and their formats
PLAIN = {
    r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d",
    r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d",
    r"^\d{4}\.\d{1,2}\.\d{1,2}$": "yyyy.M.d",
    r"^\d{8}$": "yyyyMMdd",
    r"^[A-Z][a-z]{3,} \d{1,2} \d{4}$": "MMMM d yyyy",
    r"^[A-Z][a-z]{3,} \d{1,2}, \d{4}$": "MMMM d, yyyy",
    r"^[A-Z][a-z]{2} \d{1,2} \d{4}$": "MMM d yyyy",
    r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$": "MMM d, yyyy",
    r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$": "d MMMM yyyy",
    r"^\d{1,2} [A-Z][a-z]{2} \d{4}$": "d MMM yyyy",
    r"^\d{1,2}-[A-Z][a-z]{2}-\d{4}$": "d-MMM-yyyy",
    r"^\d{1,2}-[A-Z][a-z]{2}-\d{2}$": "d-MMM-yy",
}
SEPARATORS = ("/", "-", ".")
_DAY_NAME = r"^[A-Z][a-z]{2,8}, "
# May is the only month whose short name is its name.
_MAY = {r"^May \d{1,2} \d{4}$": "MMM d yyyy", r"^May \d{1,2}, \d{4}$": "MMM d, yyyy", r"^\d{1,2} May \d{4}$": "d MMM yyyy"}


@dataclass(frozen=True)
class Vote:
    """Cells of one form, and how many of them rule out that the month, or the day, comes first."""

    separator: str
    year_digits: int
    cells: int
    day_first: int
    month_first: int

    @property
    def order(self) -> str | None:
        """``dm`` or ``md``; null where the column does not tell, or tells both."""
        if bool(self.day_first) == bool(self.month_first):
            return None
        return "dm" if self.day_first else "md"


def _numbers(text: Column, separator: str, year_digits: int) -> tuple[Column, Column, Column]:
    """Whether a cell has the form, and its first two numbers."""
    s = f"[{separator}]"
    form = text.rlike(f"^\\d{{1,2}}{s}\\d{{1,2}}{s}\\d{{{year_digits}}}$")
    first, second = (F.split_part(text, F.lit(separator), F.lit(i)).try_cast("int") for i in (1, 2))
    return form, first, second


def votes(df: DataFrame, column: str) -> list[Vote]:
    """One row of counts for the whole column."""
    text = _trimmed(F.col(f"`{column}`"))
    forms = [(s, y) for s in SEPARATORS for y in (4, 2)]
    counts = []
    for i, (s, y) in enumerate(forms):
        form, first, second = _numbers(text, s, y)
        counts += [
            F.count_if(form).alias(f"n{i}"),
            F.count_if(form & (first > 12) & (second <= 12)).alias(f"d{i}"),
            F.count_if(form & (second > 12) & (first <= 12)).alias(f"m{i}"),
        ]
    found = df.agg(*counts).first()
    return [Vote(s, y, found[f"n{i}"], found[f"d{i}"], found[f"m{i}"]) for i, (s, y) in enumerate(forms) if found[f"n{i}"]]


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(F.trim(text.cast("string")), _DAY_NAME, "")


def voted_date(text: Column, decided: list[Vote]) -> tuple[Column, Column]:
    """``(date, reason)``: a null date of a cell that is not empty has a reason."""
    plain = _trimmed(text)
    dates = [F.when(plain.rlike(shape), F.try_to_timestamp(plain, F.lit(form))) for shape, form in {**PLAIN, **_MAY}.items()]
    unsure = F.lit(False)
    for vote in decided:
        form, first, second = _numbers(plain, vote.separator, vote.year_digits)
        year = "y" * vote.year_digits
        parts = {"dm": f"d{vote.separator}M{vote.separator}{year}", "md": f"M{vote.separator}d{vote.separator}{year}"}
        if vote.order:
            dates.append(F.when(form, F.try_to_timestamp(plain, F.lit(parts[vote.order]))))
        else:
            # Cells that tell by themselves are read, the others are not.
            sure = F.when(first > 12, "dm").when(second > 12, "md").when(first == second, "md")
            dates += [F.when(form & (sure == order), F.try_to_timestamp(plain, F.lit(parts[order]))) for order in parts]
            unsure = unsure | (form & sure.isNull())
    date = F.coalesce(*dates).cast("date")
    empty = text.isNull() | (F.trim(text.cast("string")) == "")
    reason = F.when(~empty & date.isNull(), F.when(unsure, F.lit("day or month first")).otherwise(F.lit("no date")))
    return date, reason


def read_dates(df: DataFrame, column: str, url: Column, decided: list[Vote] | None = None) -> Account:
    """``column`` as dates: rows whose cell was read or empty, and ``(URL, Error)`` for all others.

    The column is read twice, once for the vote; pass ``decided`` where it is known, as for a later part of the same feed.
    """
    decided = votes(df, column) if decided is None else decided
    date, reason = voted_date(F.col(f"`{column}`"), decided)
    error = F.when(reason.isNotNull(), F.concat(F.lit(f"{column}: "), reason, F.lit(": "), F.col(f"`{column}`").cast("string")))
    values = [date.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    return account_of(df, values, F.array_compact(F.array(error)), url)
