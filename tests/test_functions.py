"""Column functions on hand-written quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hardwood.fixed_values import FEED_COLUMNS, FEED_HEADER, TEAM_ALIASES, TEAM_CODES
from hardwood.functions import clean, mail, markup, scores


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_dates(spark):
    assert apply(spark, ["20191022", "nonsense", None], clean.compact_date) == [dt.date(2019, 10, 22), None, None]
    assert apply(spark, [20191022], clean.compact_date, "int") == [dt.date(2019, 10, 22)]
    assert apply(spark, ["January 13 2016", "2016-01-13", "?"], clean.any_date) == [dt.date(2016, 1, 13)] * 2 + [None]
    assert apply(spark, ["Tue, Oct 22, 2019", "Sat, Aug 1, 2020"], clean.anchor_date_key) == ["20191022", "20200801"]


def test_names(spark):
    names = ["James, LeBron", "Smith, Jr., Dennis", "Nene", None]
    assert apply(spark, names, clean.flip_name) == ["LeBron James", "Dennis Smith", "Nene Nene", None]
    assert apply(spark, names, clean.flip_name_once) == ["LeBron James", "Dennis Smith", "Nene", None]


def test_minutes(spark):
    texts = ["34:12", "0:05", "Did Not Play", "Did Not Dress", "Not With Team", "Player Suspended", "", None, "hurt"]
    assert apply(spark, texts, clean.minutes_dotted) == [34.12, 0.05] + [None] * 7
    assert apply(spark, ["34:12", "0:30", "Did Not Play"], clean.minutes_true) == [34.2, 0.5, None]
    unknown = apply(spark, texts, lambda x: clean.unknown_text(x, clean.minutes_dotted(x)))
    assert unknown == [False] * 8 + [True]


def test_counts_and_blanks(spark):
    assert apply(spark, ["7", " 8", "Did Not Play", "x", None], clean.count_or_null) == [7, 8, None, None, None]
    assert apply(spark, ["", "  ", "3", None], clean.blank_to_zero) == ["0", "0", "3", None]


def test_teams(spark):
    raw = ["Se", "tle SuperSonics", "Golden St", "e Warriors", "Miami H", "Miami He", "s", "Chicago Bulls"]
    fixed = apply(spark, raw, lambda x: clean.repair_team(x, TEAM_ALIASES))
    assert fixed == [
        "Seattle SuperSonics", "Seattle SuperSonics", "Golden State Warriors", "Golden State Warriors",
        "Miami Heat", "Miami Heat", "Charlotte Bobcats", "Chicago Bulls",
    ]
    assert len(TEAM_CODES) == 30 and len(FEED_COLUMNS) == 33 and len(FEED_HEADER) == 34


def test_keys(spark):
    assert apply(spark, ["2019-20", "1999-00"], clean.season_end_year) == ["2020", "2000"]
    assert apply(spark, [19.5, 0.25, 12.0, 7.75], clean.clock_text, "double") == ["19:30", "00:15", "12:00", "07:45"]
    assert apply(spark, [0, 8], clean.home_flag, "int") == [0, 1]


def test_stat_string(spark):
    texts = ["30pt 8rb 3as 2st 1bl 4to 4trey 11-20fg 4-5ft", "8rb 0-3fg", "", None, "2pt 3pt"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = df.select("i", *[c.alias(n) for n, c in scores.stat_columns(F.col("s")).items()]).orderBy("i").collect()
    full = got[0].asDict()
    assert full == {
        "i": 0, "Pts": 30, "Rbs": 8, "Ass": 3, "Stl": 2, "Bl": 1, "To": 4, "Trey": 4, "FGM": 11, "FGA": 20, "FTM": 4, "FTA": 5,
    }
    assert (got[1]["Pts"], got[1]["Rbs"], got[1]["FGM"], got[1]["FGA"]) == (None, 8, 0, 3)
    assert all(v is None for k, v in got[2].asDict().items() if k != "i")
    assert all(v is None for k, v in got[3].asDict().items() if k != "i")
    assert got[4]["Pts"] == 3  # the last one counts
    shares = df.limit(1).select(scores.share(F.lit(1), F.lit(4)).alias("a"), scores.share(F.lit(0), F.lit(0)).alias("b")).first()
    assert (shares["a"], shares["b"]) == (0.25, None)


def test_positions(spark):
    assert apply(spark, ["12", "5", "9", None], scores.positions_of_digits) == [["PG", "SG"], ["C"], [], None]
    assert apply(spark, ["G-F", "C"], scores.positions_of_label) == [["G", "F"], ["C"]]


def test_score(spark):
    columns = ["3P", "FG", "FT", "TRB", "AST", "BLK", "STL", "TOV"]
    df = spark.createDataFrame([(1, 10, 4, 5, 6, 1, 2, 3), (1, 10, 4, 5, 6, 1, 2, None)], ", ".join(f"`{c}` int" for c in columns))
    got = [r[0] for r in df.select(scores.book_score("FDP")).collect()]
    assert got[0] == pytest.approx(3 + 20 + 4 + 6 + 9 + 3 + 6 - 3)
    assert got[1] is None
    with pytest.raises(ValueError):
        scores.book_score("DKP")


def test_injured_flag(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 1.0), (3, None)], "a int, b double")
    assert [r[0] for r in df.select(clean.injured_flag(["a", "b"])).collect()] == [0, 1, 1]


def test_mail(spark):
    senders = ["Ann Example <Ann.E@Mail.example>", "bob@mail.example", "nobody"]
    assert apply(spark, senders, mail.sender_mailbox) == ["ann.e", "bob", ""]
    assert apply(spark, senders, mail.sender_address) == ["ann.e@mail.example", "bob@mail.example", ""]
    subjects = ["ADD  my-site! http://x.example", "Delete my.site", "show", ""]
    assert apply(spark, subjects, mail.command_verb) == ["add", "delete", "show", ""]
    assert apply(spark, subjects, mail.command_site) == ["mysite", "mysite", None, None]
    assert apply(spark, subjects, mail.command_url) == ["http://x.example", None, None, None]
    assert apply(spark, ["wORD", "ßa", "x"], mail.capitalized) == ["Word", "Ssa", "X"]


def test_report_line(spark):
    df = spark.createDataFrame([("alpha", "N", 3), ("BETA", "O", 1)], "w string, n string, c int")
    got = [r[0] for r in df.select(mail.report_line(F.col("w"), F.col("n"), F.col("c"))).collect()]
    assert got == ["\t\t\t\t\tAlpha\t+3", "Beta\t+1"]
    day = spark.range(1).select(mail.report_date(F.lit(dt.date(2020, 3, 4)))).first()[0]
    assert day == "3/4/2020"


def test_markup(spark):
    page = """<!-- <a href="/no">no</a> --><script>var a='<a href="/no2">x</a>'</script>
      <tbody><a class=k href="/one">Tue, Oct 22, 2019</a><a href="/two"><b>Box</b> Score</a><a name=x>none</a></tbody><a href="/after">A</a>"""
    got = apply(spark, [page], lambda x: markup.links(markup.visible_source(x)))[0]
    assert [(g["href"], g["text"]) for g in got] == [("/one", "Tue, Oct 22, 2019"), ("/two", "Box Score"), ("/after", "A")]
    inside = apply(spark, [page], lambda x: markup.links(markup.first_body(markup.visible_source(x))))[0]
    assert [g["href"] for g in inside] == ["/one", "/two"]


@pytest.mark.parametrize(
    "title, away, home",
    [
        ("Golden State Warriors at Denver Nuggets Box Score, January 13, 2016", "Golden State Warriors", "Denver Nuggets"),
        ("Dallas Mavericks at Seattle SuperSonics Box Score, January 3, 2006", "Dallas Mavericks", "Seattle SuperSonics"),
        ("Miami Heat at Charlotte Bobcats Box Score, November 1, 2010", "Miami Heat", "Charlotte Bobcats"),
    ],
)
def test_headers(spark, title, away, home):
    got = spark.range(1).select(*markup.header_teams(F.lit(title)), markup.header_date(F.lit(title))).first()
    assert tuple(got)[:2] == (away, home)
    assert isinstance(got[2], dt.date)


def test_character_references(spark):
    texts = ["O&#39;Neil", "A &amp; B &lt;i&gt;", "Don&#269;i&#263; &#x;", "&#128512;", "plain", None]
    assert apply(spark, texts, markup.unescaped) == ["O'Neil", "A & B <i>", "Dončić &#x;", "\U0001f600", "plain", None]
