"""Formats found from a whole column."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from hardwood.operators.dates import read_dates, votes


def read(spark, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i long, day string")
    account = read_dates(df, "day", F.col("i"))
    values = {r["i"]: r["day"] for r in account.clean.collect()}
    errors = {int(r["URL"]): r["Error"] for r in account.errors.collect()}
    assert account.n_rows == len(cells) == len(values) + len(errors) and account.n_errors == len(errors)
    return values, errors


def test_one_cell_tells_for_all(spark):
    values, errors = read(spark, ["03/04/2019", "25/04/2019", "1/2/2019", None, " ", "03-04-2019", "03-25-2019", "1.2.19", "31.1.19"])
    assert errors == {}
    assert [values[i] for i in (0, 1, 2, 5, 6, 7, 8)] == [
        dt.date(2019, 4, 3), dt.date(2019, 4, 25), dt.date(2019, 2, 1), dt.date(2019, 3, 4), dt.date(2019, 3, 25),
        dt.date(2019, 2, 1), dt.date(2019, 1, 31),
    ]
    assert values[3] is None and values[4] is None


def test_columns_that_do_not_tell(spark):
    values, errors = read(spark, ["03/04/2019", "05/05/2019"])
    assert values == {1: dt.date(2019, 5, 5)} and errors == {0: "day: day or month first: 03/04/2019"}
    values, errors = read(spark, ["03/04/2019", "25/04/2019", "04/25/2019"])
    assert values == {1: dt.date(2019, 4, 25), 2: dt.date(2019, 4, 25)} and errors == {0: "day: day or month first: 03/04/2019"}


def test_names_of_months_and_what_is_no_date(spark):
    cells = ["May 3, 2019", "3 May 2019", "Tue, Oct 22, 2019", "Tuesday, October 22, 2019", "22-Oct-19", "2019.10.22", "20191022", "Oct 22 2019"]
    values, errors = read(spark, [*cells, "2019-02-30", "Octember 3 2019", "13/13/2019", "soon", "2019"])
    assert [values[i] for i in range(8)] == [dt.date(2019, 5, 3)] * 2 + [dt.date(2019, 10, 22)] * 6
    assert sorted(errors) == [8, 9, 10, 11, 12] and errors[8] == "day: no date: 2019-02-30"


def test_votes_are_counts_and_can_be_kept(spark):
    first = spark.createDataFrame([("25/04/2019",), ("03/04/2019",)], "day string")
    decided = votes(first, "day")
    assert [(v.separator, v.year_digits, v.cells, v.day_first, v.month_first, v.order) for v in decided] == [("/", 4, 2, 1, 0, "dm")]
    later = spark.createDataFrame([("1", "05/06/2020")], "id string, day string")
    assert rows(read_dates(later, "day", F.col("id"), decided).clean) == [{"id": "1", "day": dt.date(2020, 6, 5)}]
    assert votes(first.limit(0), "day") == []
