"""Header CSV files, the colon-delimited feed, and folders of season files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.fixed_values import BOX_COLUMNS, FEED_COLUMNS, FEED_HEADER, IGNORED_ENTRIES
from hardwood.functions.clean import compact_date, flip_name
from hardwood.operators.accounting import Account, Cell, account_of, cell_errors
from hardwood.session import materialize

CORRUPT = "_corrupt"

# Everything is read as text first: a sentinel such as "Did Not Play" in one file must not
# decide the type of a whole column.
BOX_RAW = T.StructType([T.StructField(c, T.StringType()) for c in [*BOX_COLUMNS, "GameLink"]])
FEED_RAW = T.StructType([T.StructField(c, T.StringType()) for c in FEED_HEADER])

_WHOLE = {"GID": "long", **dict.fromkeys(["TeamPoints", "OppPoints", "Starting", "Appeared", "Active", "DoubleD", "TripleD"], "int")}
_TEXT = ["Player", "Date", "Team", "Against", "Home", "GameID", "Stats", "FDPos", "DKPos", "DDPos", "YHPos"]


def season_of(file_name: Column) -> Column:
    """``2019-20.csv`` -> ``2019-20``."""
    return F.regexp_extract(file_name, r"^(.*?)\.csv", 1)


def _read(spark: SparkSession, paths: Sequence[str], schema: T.StructType, sep: str) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # A parser that is asked for fewer columns does not notice a broken line.
        .option("columnPruning", False)
        .option("pathGlobFilter", "*.csv")
        .csv(list(paths))
    )


def read_games(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = BOX_RAW) -> DataFrame:
    """Season files of box scores, all at once, with ``season`` from the file name."""
    paths = [paths] if isinstance(paths, str) else paths
    return _read(spark, paths, schema, ",").withColumn("season", season_of(F.col("_metadata.file_name")))


def read_feed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = FEED_RAW) -> DataFrame:
    """Raw feed files; ``season`` from the file name."""
    paths = [paths] if isinstance(paths, str) else paths
    return _read(spark, paths, schema, ":").withColumn("season", season_of(F.col("_metadata.file_name")))


def wanted_file(file_name: Column, ignore: Iterable[str] = IGNORED_ENTRIES, without: str | None = None) -> Column:
    """Neither an ignored entry nor, with ``without``, a name that contains this text."""
    wanted = ~file_name.isin(list(ignore))
    return wanted & ~file_name.contains(without) if without else wanted


def listed_files(spark: SparkSession, folder: str, ignore: Iterable[str] = IGNORED_ENTRIES, containing: str | None = None) -> DataFrame:
    """``(path, file_name)`` of the CSV files of a folder, without the ignored entries.

    Sub-folders are not entered. With ``containing``, files with that text are left out.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    return files.where(wanted_file(F.col("file_name"), ignore, containing))


def read_folder(spark: SparkSession, folder: str, skip_containing: str = "Combined", reader=read_games) -> DataFrame:
    """All season files of a folder but the combined ones and the ignored entries."""
    return reader(spark, folder).where(wanted_file(F.col("_metadata.file_name"), without=skip_containing))


def file_headers(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, header)``: first line of each file.

    The lines of a file's first block are reduced to the first one inside each task, so
    a file of any size sends one line on.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    starts = lines.select(
        "value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("place"),
        F.col("_metadata.file_block_start").alias("start"),
    ).where(F.col("start") == 0)
    return starts.groupBy("path").agg(F.min_by("value", "place").alias("header"))


def checked_files(spark: SparkSession, folder: str, required: Sequence[str] = tuple(FEED_COLUMNS), sep: str = ":") -> DataFrame:
    """``(path, header, missing)``: required columns each file lacks."""
    names = F.array(*[F.lit(c) for c in required])
    return file_headers(spark, folder).withColumn("missing", F.array_except(names, F.split("header", sep)))


def parsed_feed(
    spark: SparkSession, folder: str, required: Sequence[str] = tuple(FEED_COLUMNS), sep: str = ":"
) -> tuple[DataFrame, DataFrame]:
    """(lines of the complete files with their ``_path``, quarantine of the other files).

    A line that does not parse has its text in ``_corrupt``. Files are read once per distinct header and put together by
    column name, so their column order may differ. Only the distinct headers and their file names reach the driver.
    """
    checked = materialize(checked_files(spark, folder, required, sep), "headers")
    quarantine = checked.where(F.size("missing") > 0).select(
        F.col("path").alias("URL"), F.concat(F.lit("missing columns: "), F.array_join("missing", ", ")).alias("Error")
    )
    by_header: dict[str, list[str]] = {}
    for row in checked.where(F.size("missing") == 0).select("path", "header").collect():
        by_header.setdefault(row["header"], []).append(row["path"])
    rows = None
    for header, paths in by_header.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header.split(sep)])
        part = _read(spark, paths, schema, sep).select(
            *[F.col(f"`{c}`") for c in required], CORRUPT,
            season_of(F.col("_metadata.file_name")).alias("season"), F.col("_metadata.file_path").alias("_path"),
        )
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in [*required, CORRUPT, "season", "_path"]])
        return spark.createDataFrame([], empty), quarantine
    return rows, quarantine


def read_checked_feed(
    spark: SparkSession, folder: str, required: Sequence[str] = tuple(FEED_COLUMNS), sep: str = ":"
) -> tuple[DataFrame, DataFrame]:
    """(rows of the complete files with their ``_path``, quarantine of the other files and of lines that do not parse).

    The parsed rows are stored once.
    """
    rows, quarantine = parsed_feed(spark, folder, required, sep)
    stored = materialize(rows, "feed")
    broken = stored.where(F.col(CORRUPT).isNotNull())
    lines = broken.select(F.col("_path").alias("URL"), F.concat(F.lit("corrupt line: "), CORRUPT).alias("Error"))
    return stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT), quarantine.unionByName(lines)


def _feed_reader(name: str) -> Callable[[Column], Column]:
    if name == "Date":
        return compact_date
    if name == "Player":
        return flip_name
    if name in _WHOLE:
        return lambda text: text.try_cast("double").cast(_WHOLE[name])
    if name in _TEXT:
        return lambda text: text
    return lambda text: text.try_cast("double")


# The chosen columns: names flipped, compact dates parsed, numbers typed.
FEED_CELLS = [Cell(old, new, _feed_reader(new)) for old, new in FEED_COLUMNS.items()]


def clean_feed(raw: DataFrame) -> DataFrame:
    """Chosen columns, renamed and typed; a cell that cannot be read is null. :func:`checked_feed` tells which."""
    return raw.select(*[cell.value() for cell in FEED_CELLS], *[c for c in ("season",) if c in raw.columns])


def checked_feed(raw: DataFrame, url: Column) -> Account:
    """Like :func:`clean_feed`, with lines that have an unreadable cell in quarantine, and those of ``_corrupt`` text as a whole."""
    kept = [c for c in ("season",) if c in raw.columns]
    errors = cell_errors(FEED_CELLS, F.concat(F.lit("corrupt line: "), CORRUPT) if CORRUPT in raw.columns else None)
    account = account_of(raw, [*[F.col(c) for c in kept], *[cell.value() for cell in FEED_CELLS]], errors, url)
    names = [cell.name for cell in FEED_CELLS]
    return replace(account, clean=account.clean.select(*names, *[c for c in account.clean.columns if c not in names]))


def game_state(stats: str = "Stats") -> Column:
    """``played``, or ``pending`` for today's games, which have salary and position only."""
    return F.when(F.col(stats).isNull(), "pending").otherwise("played")


def played_rows(feed: DataFrame) -> DataFrame:
    return feed.where(game_state() == "played")


def pending_rows(feed: DataFrame) -> DataFrame:
    return feed.where(game_state() == "pending")


def in_date_range(df: DataFrame, start: str | None = None, end: str | None = None, date: str = "Date") -> DataFrame:
    """Bounds as ``YYYYMMDD``, both inclusive and optional."""
    for bound, keep in ((start, lambda d, b: d >= b), (end, lambda d, b: d <= b)):
        if bound:
            df = df.where(keep(F.col(date), F.to_date(F.lit(bound), "yyyyMMdd")))
    return df
