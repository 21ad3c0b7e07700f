"""Subscriptions kept by mailed commands, and change reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.functions.mail import (
    command_site, command_url, command_verb, report_line, sender_address, sender_mailbox,
)
from hardwood.operators.balance import attach, keep_known
from hardwood.operators.series import GameSeries, lagged, led
from hardwood.session import materialize

CHANGES = ("add", "delete")
# Shows that one step takes out of a stretch.
STRETCH = 4_096
# Subjects of reply rows.
LIST, ADD_ERROR, DELETE_ERROR = "WEBSITE LIST", "ERROR add", "ERROR delete"
# --- fixed values: headings of a report
LIST_HEADING = "\t\t\tList Of Websites With Changes"
REPORT_HEADING = "\t\t\tWORD REPORT"
COLUMN_TITLES = "Old Words\t\t\t\t\tNew Words"


def parsed_commands(messages: DataFrame) -> DataFrame:
    """``messages(msg_id, ts, sender, subject)`` plus address, user, verb, site, url."""
    sender, subject = F.col("sender"), F.col("subject")
    return messages.withColumns(
        {
            "address": sender_address(sender),
            "user": sender_mailbox(sender),
            "verb": command_verb(subject),
            "site": command_site(subject),
            "url": command_url(subject),
        }
    )


def from_known_senders(commands: DataFrame, known: DataFrame, email: str = "Email") -> DataFrame:
    """Only messages whose address is on the list."""
    listed = known.select(F.lower(F.trim(email)).alias("address"))
    return keep_known(commands, listed, ["address"], ["msg_id"])


def last_commands(commands: DataFrame) -> DataFrame:
    """Last add / delete per (user, site). ``max_by`` is combined before the shuffle, so a
    busy user is no hot spot."""
    changes = commands.where(F.col("verb").isin(*CHANGES) & F.col("site").isNotNull())
    when = F.struct("ts", "msg_id")
    return changes.groupBy("user", "site").agg(
        F.max_by("verb", when).alias("verb"), F.max_by("url", when).alias("url"), F.max("ts").alias("ts")
    )


def subscription_state(commands: DataFrame) -> DataFrame:
    """Sites each user is subscribed to after all commands."""
    return last_commands(commands).where(F.col("verb") == "add").select("user", "site", "url", F.col("ts").alias("since"))


def listed_stretches(commands: DataFrame, block_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(user, site, first, last)`` and ``(user, show, msg_id, ts)``.

    Shows are numbered per user in time order. A site is on the list from an add to the next command
    for it, which covers the shows from ``first`` to ``last``; ``last`` is null where no command follows.
    """
    changes = commands.where(F.col("verb").isin(*CHANGES) & F.col("site").isNotNull()).select("msg_id", "ts", "user", "site", "verb")
    shows = commands.where(F.col("verb") == "show").select("msg_id", "ts", "user")
    order = ["ts", "msg_id"]
    shows = materialize(GameSeries.of(shows, ["user"], order, block_rows).position("show").result(), "shows")
    every = changes.withColumn("show", F.lit(None).cast("long")).unionByName(shows, allowMissingColumns=True)
    seen = GameSeries.of(materialize(every, "commands"), ["user"], order, block_rows).last_known("show", "_seen").result()
    seen = materialize(seen.where("verb IS NOT NULL").withColumn("_seen", F.coalesce("_seen", F.lit(0).cast("long"))), "seen")
    replay = GameSeries.of(seen.drop("show"), ["user", "site"], order, block_rows)
    followed = replay.neighbours(0, 1, last=led("_seen", 1)).result()
    stretches = followed.where(F.col("verb") == "add").select("user", "site", (F.col("_seen") + 1).alias("first"), "last")
    return stretches, shows


def shown_lists(commands: DataFrame, block_rows: int | None = None) -> DataFrame:
    """``(msg_id, ts, user, site)``: the list as it was when a user asked to see it, one row per site.

    Every stretch on the list gives one row for each show that it covers, and these rows meet their show by its
    number. So the work is in proportion to the commands and the rows that come out, however many
    commands one user sends.
    """
    stretches, shows = listed_stretches(commands, block_rows)
    total = materialize(shows.groupBy("user").agg(F.max("show").alias("shows")), "totals")
    # A user without shows has no lists.
    bounded = attach(stretches, total, ["user"], ["site", "first"], "inner")
    covered = bounded.withColumn("last", F.coalesce("last", "shows")).where("first <= last")
    # Long stretches are taken apart in two steps, so no row holds a long array.
    step = F.lit(STRETCH)
    covered = covered.withColumn("_from", F.explode(F.sequence("first", "last", step)))
    covered = covered.select("user", "site", F.explode(F.sequence("_from", F.least(F.col("_from") + step - 1, F.col("last")))).alias("show"))
    return attach(covered, shows, ["user", "show"], ["site"], "inner").select("msg_id", "ts", "user", "site")


def reply_rows(commands: DataFrame, block_rows: int | None = None) -> DataFrame:
    """``(msg_id, ts, user, subject, site)``: replies as rows, whatever the length of a list.

    An error names its site; a list has one row with a null site, which opens it, and one for each site.
    """
    shows = commands.where(F.col("verb") == "show").select("msg_id", "ts", "user")
    opened = shows.withColumn("site", F.lit(None).cast("string")).unionByName(shown_lists(commands, block_rows))
    failed = failed_commands(commands, block_rows).select("msg_id", "ts", "user", error_subject().alias("subject"), "site")
    return failed.unionByName(opened.select("msg_id", "ts", "user", F.lit(LIST).alias("subject"), "site"))


def error_subject() -> Column:
    return F.when(F.col("verb") == "add", F.lit(ADD_ERROR)).otherwise(F.lit(DELETE_ERROR))


def failed_commands(commands: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Adds of a listed site and deletes of an unlisted one, in time order per (user, site)."""
    changes = commands.where(F.col("verb").isin(*CHANGES) & F.col("site").isNotNull())
    replay = GameSeries.of(changes.select("msg_id", "ts", "user", "site", "verb"), ["user", "site"], ["ts", "msg_id"], block_rows)
    seen = replay.neighbours(1, 0, _before=lagged("verb", 1)).result()
    listed = F.coalesce(F.col("_before") == "add", F.lit(False))
    return seen.where(listed == (F.col("verb") == "add")).drop("_before")


def mails(replies: DataFrame) -> DataFrame:
    """Replies as mail texts ``(msg_id, ts, user, subject, message)``; a list becomes one text here and not before."""
    site, subject = F.col("site"), F.col("subject")
    failed = replies.where(subject != LIST).select(
        "msg_id", "ts", "user", F.lit("ERROR").alias("subject"),
        F.concat(site, F.when(subject == ADD_ERROR, F.lit(" is already listed")).otherwise(F.lit(" is not listed"))).alias("message"),
    )
    lists = replies.where(subject == LIST).groupBy("msg_id", "ts", "user").agg(F.array_sort(F.collect_list("site")).alias("sites"))
    return failed.unionByName(lists.select("msg_id", "ts", "user", F.lit(LIST).alias("subject"), F.array_join("sites", "\n").alias("message")))


def notices(commands: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Replies to send: the list for a show, an error for a command that changes nothing.

    Commands are replayed in time order. ``add`` of a listed site and ``delete`` of an
    unlisted one are errors; a change that worked is silent.
    """
    return mails(reply_rows(commands, block_rows))


def report_lines(changes: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Whole report of ``changes(user, title, word, is_new, cnt)``: ``(user, line_no, line)``.

    The list of changed sites, then for each site its heading, the column titles and its words.
    """
    none = F.lit("")

    def lines(df: DataFrame, section: int, title, place: int, line, word=none, is_new=none) -> DataFrame:
        keys = [F.lit(section).alias("section"), title.alias("title"), F.lit(place).alias("place")]
        return df.select("user", *keys, word.alias("word"), is_new.alias("is_new"), line.alias("line"))

    changes = materialize(changes, "changes")
    users = changes.select("user").distinct()
    sites = materialize(changed_sites(changes, block_rows=block_rows), "listed")
    title, word, is_new = F.col("title"), F.col("word"), F.col("is_new")
    whole = [
        lines(users, 0, none, 0, F.lit(LIST_HEADING)),
        lines(sites, 1, title, 0, F.col("entry")),
        lines(users, 2, none, 0, F.lit(REPORT_HEADING)),
        lines(sites, 3, title, 0, F.concat(F.lit("\t" * 4), title)),
        lines(sites, 3, title, 1, F.lit(COLUMN_TITLES)),
        lines(changes, 3, title, 2, report_line(word, is_new, F.col("cnt")), word, is_new),
    ]
    every = materialize(reduce(DataFrame.unionByName, whole), "lines")
    order = ["section", "title", "place", "word", "is_new"]
    series = GameSeries.of(every, ["user"], order, block_rows)
    return series.position("line_no").result().select("user", "line_no", "line")


def report_parts(changes: DataFrame, lines_per_part: int, block_rows: int | None = None) -> DataFrame:
    """The report cut into mail texts of at most ``lines_per_part`` lines: (user, part, n_lines, body).

    A user's whole report has no bound; its parts do, so no task holds more than one part.
    """
    lines = report_lines(changes, block_rows)
    part = F.floor((F.col("line_no") - 1) / lines_per_part).cast("int") + 1
    placed = lines.select("user", part.alias("part"), F.struct("line_no", "line").alias("l"))
    folded = placed.groupBy("user", "part").agg(F.array_sort(F.collect_list("l")).alias("ls"))
    return folded.select("user", "part", F.size("ls").alias("n_lines"), F.array_join(F.transform("ls", lambda l: l["line"]), "\n").alias("body"))


def changed_sites(changes: DataFrame, user: Sequence[str] = ("user",), title: str = "title", block_rows: int | None = None) -> DataFrame:
    """Numbered list of the sites with changes, per user: ``1.title``."""
    sites = materialize(changes.select(*user, title).distinct(), "sites")
    listed = GameSeries.of(sites, list(user), [title], block_rows).position("number").result()
    return listed.withColumn("entry", F.concat(F.col("number").cast("string"), F.lit("."), F.col(title)))
