"""Subscription mails: who wrote, what they ask, and the lines of a change report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sender_mailbox(sender: Column) -> Column:
    """Part before the ``@``, lower case, with or without angle brackets."""
    return F.regexp_extract(F.lower(sender), "^(?:[^<]*<)?\\s*([^@<>]*)@", 1)


def sender_address(sender: Column) -> Column:
    return F.regexp_extract(F.lower(sender), "^(?:[^<]*<)?\\s*([^<>\\s]+@[^<>\\s]+)", 1)


def subject_tokens(subject: Column) -> Column:
    return F.split(F.trim(subject), "\\s+")


def command_verb(subject: Column) -> Column:
    return F.lower(F.try_element_at(subject_tokens(subject), F.lit(1)))


def command_site(subject: Column) -> Column:
    """Second word without anything but letters and digits; null if there is none."""
    return F.regexp_replace(F.try_element_at(subject_tokens(subject), F.lit(2)), "[^A-Za-z0-9]", "")


def command_url(subject: Column) -> Column:
    return F.try_element_at(subject_tokens(subject), F.lit(3))


def capitalized(word: Column) -> Column:
    """Only the first character upper case; one that becomes two letters gives ``Ss``."""
    first = F.upper(F.substring(word, 1, 1))
    return F.concat(F.substring(first, 1, 1), F.lower(F.concat(F.substr(first, F.lit(2)), F.substr(word, F.lit(2)))))


def report_line(word: Column, is_new: Column, count: Column) -> Column:
    """``Word<tab>+count``; new words stand in the right-hand column."""
    text = F.concat(capitalized(word), F.lit("\t+"), count.cast("string"))
    return F.when(is_new == "N", F.concat(F.lit("\t" * 5), text)).otherwise(text)


def report_date(day: Column) -> Column:
    """``month/day/year`` without padding."""
    return F.date_format(day, "M/d/yyyy")
