"""Events as mailed commands, and change reports on conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.registry import query
from hardwood.functions.mail import report_date
from hardwood.operators import subscriptions as S
from hardwood.session import work_path
from hardwood.streaming.subscriptions import read_replies, read_state, update_replies, update_state


def _messages(events):
    """signup -> add, error -> delete, view -> show, anything else -> no command."""
    user = F.col("user_id").cast("string")
    site = F.regexp_extract("props", "(\\d+)", 1).cast("int") % 10
    verb = (
        F.when(F.col("event_type") == "signup", "ADD").when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "view", "Show").otherwise("hello")
    )
    bracketed = F.concat(F.lit("Fan No "), user, F.lit(" <User"), user, F.lit("@Mail.example>"))
    sender = F.when(F.col("value") > 20, bracketed).otherwise(F.concat(F.lit("user"), user, F.lit("@mail.example")))
    site_name = F.concat(F.lit("site-"), site.cast("string"), F.lit("!"))
    subject = F.when(F.col("event_type") == "view", verb).otherwise(
        F.concat(verb, F.lit("  "), site_name, F.lit(" http://s.example/"), site.cast("string"))
    )
    return events.select(F.col("event_id").alias("msg_id"), "ts", sender.alias("sender"), subject.alias("subject"))


SQL_MESSAGES = """
    m AS (SELECT event_id AS msg_id, ts, 'user' || user_id AS "user", value > 20 AS bracketed,
                 CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'delete' WHEN 'view' THEN 'show' ELSE 'hello' END AS verb,
                 CASE WHEN event_type <> 'view' THEN 'site' || (regexp_extract(props, '(\\d+)', 1)::INT % 10) END AS site,
                 CASE WHEN event_type <> 'view' THEN 'http://s.example/' || (regexp_extract(props, '(\\d+)', 1)::INT % 10) END AS url FROM events),
    c AS (SELECT *, row_number() OVER (PARTITION BY "user", site ORDER BY ts DESC, msg_id DESC) AS back,
                 lag(verb) OVER (PARTITION BY "user", site ORDER BY ts, msg_id) AS before
          FROM m WHERE verb IN ('add', 'delete'))"""


def _commands(tables):
    return S.parsed_commands(_messages(tables.events))


@query(
    "sender_parse",
    "C31",
    f"""WITH {SQL_MESSAGES} SELECT msg_id, "user", "user" || '@mail.example' AS address FROM m""",
)
def sender_parse(tables):
    return _commands(tables).select("msg_id", "user", "address")


@query("command_parse", "C32", f"WITH {SQL_MESSAGES} SELECT msg_id, verb, site, url FROM m")
def command_parse(tables):
    return _commands(tables).select("msg_id", "verb", "site", "url")


@query(
    "known_sender_only",
    "J5",
    f"""
    WITH {SQL_MESSAGES}
    SELECT msg_id, "user" FROM m WHERE "user" IN (SELECT 'user' || c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
    """,
)
def known_sender_only(tables):
    known = tables.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.concat(F.lit("User"), F.col("c_custkey").cast("string"), F.lit("@mail.example ")).alias("Email")
    )
    return S.from_known_senders(_commands(tables), known).select("msg_id", "user")


@query("subscription_state", "T2", f"""WITH {SQL_MESSAGES} SELECT "user", site, url FROM c WHERE back = 1 AND verb = 'add'""")
def subscription_state(tables):
    return S.subscription_state(_commands(tables)).select("user", "site", "url")


# A site is listed from an add to the next command for it.
SQL_SHOWN = """
    t AS (SELECT "user", site, verb, ts, msg_id, lead(ts) OVER w AS until_ts, lead(msg_id) OVER w AS until_id
          FROM m WHERE verb IN ('add', 'delete') WINDOW w AS (PARTITION BY "user", site ORDER BY ts, msg_id)),
    sh AS (SELECT s.msg_id, s.ts, s."user", t.site FROM m s JOIN t ON t."user" = s."user"
           WHERE s.verb = 'show' AND t.verb = 'add' AND (t.ts, t.msg_id) < (s.ts, s.msg_id)
             AND (t.until_id IS NULL OR (s.ts, s.msg_id) < (t.until_ts, t.until_id)))"""


@query("subscription_shows", "T2", f"""WITH {SQL_MESSAGES}, {SQL_SHOWN} SELECT msg_id, "user", site FROM sh""")
def subscription_shows(tables):
    """The lists as they were when users asked."""
    return S.shown_lists(_commands(tables)).select("msg_id", "user", "site")


@query(
    "subscription_notices",
    "T2 C34",
    f"""
    WITH {SQL_MESSAGES}, {SQL_SHOWN},
    l AS (SELECT msg_id, string_agg(site, chr(10) ORDER BY site) AS sites FROM sh GROUP BY 1)
    SELECT msg_id, "user", 'ERROR: ' || month(ts) || '/' || day(ts) || '/' || year(ts) AS subject,
           site || CASE verb WHEN 'add' THEN ' is already listed' ELSE ' is not listed' END AS message
    FROM c WHERE (coalesce(before, '') = 'add') = (verb = 'add')
    UNION ALL
    SELECT m.msg_id, "user", 'WEBSITE LIST: ' || month(ts) || '/' || day(ts) || '/' || year(ts), coalesce(sites, '')
    FROM m LEFT JOIN l ON l.msg_id = m.msg_id WHERE verb = 'show'
    """,
)
def subscription_notices(tables):
    sent = S.notices(_commands(tables))
    subject = F.concat("subject", F.lit(": "), report_date(F.col("ts")))
    return sent.select("msg_id", "user", subject.alias("subject"), "message")


@query("stream_subscription_state", "T2", f"""WITH {SQL_MESSAGES} SELECT "user", site, url FROM c WHERE back = 1 AND verb = 'add'""")
def stream_subscription_state(tables):
    spark = tables.spark
    events = spark.readStream.schema(tables.events.schema).option("pathGlobFilter", "events.parquet").parquet(tables.folder)
    folder = work_path(spark, "commands")
    update_state(S.parsed_commands(_messages(events)), f"{folder}/state", f"{folder}/checkpoint")
    return read_state(spark, f"{folder}/state").select("user", "site", "url")


@query(
    "stream_subscription_replies",
    "T2",
    f"""
    WITH {SQL_MESSAGES}, {SQL_SHOWN}
    SELECT msg_id, "user", 'ERROR ' || verb AS subject, site FROM c WHERE (coalesce(before, '') = 'add') = (verb = 'add')
    UNION ALL SELECT msg_id, "user", 'WEBSITE LIST', NULL FROM m WHERE verb = 'show'
    UNION ALL SELECT msg_id, "user", 'WEBSITE LIST', site FROM sh
    """,
)
def stream_subscription_replies(tables):
    """Errors and lists as rows, replayed in time order from the stream."""
    spark = tables.spark
    events = spark.readStream.schema(tables.events.schema).option("pathGlobFilter", "events.parquet").parquet(tables.folder)
    folder = work_path(spark, "replies")
    update_replies(S.parsed_commands(_messages(events)), f"{folder}/rows", f"{folder}/checkpoint", delay="0 seconds")
    return read_replies(spark, f"{folder}/rows").select("msg_id", "user", "subject", "site")


def _changes(tables):
    """Word counts per conversation (user) and turn (site); the assistant's words are new."""
    words = F.explode(F.split(F.lower("text"), "[^\\p{L}]+"))
    spoken = tables.conversations.select(
        F.col("conv_id").cast("string").alias("user"),
        F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("title"),
        F.when(F.col("role") == "assistant", "N").otherwise("O").alias("is_new"),
        words.alias("word"),
    ).where(F.col("word") != "")
    return spoken.groupBy("user", "title", "word", "is_new").agg(F.count(F.lit(1)).alias("cnt"))


SQL_CHANGES = """
    w AS (SELECT conv_id::VARCHAR AS "user", 'turn ' || turn AS title, CASE WHEN role = 'assistant' THEN 'N' ELSE 'O' END AS is_new,
                 unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS word FROM conversations),
    ch AS (SELECT "user", title, word, is_new, count(*) AS cnt FROM w WHERE word <> '' GROUP BY ALL)"""


SQL_REPORT = f"""
    {SQL_CHANGES},
    u AS (SELECT DISTINCT "user" FROM ch),
    d AS (SELECT DISTINCT "user", title FROM ch),
    e AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY title) AS number FROM d),
    a AS (
      SELECT "user", 0 AS section, '' AS title, 0 AS place, '' AS word, '' AS is_new, repeat(chr(9), 3) || 'List Of Websites With Changes' AS line FROM u
      UNION ALL SELECT "user", 1, title, 0, '', '', number || '.' || title FROM e
      UNION ALL SELECT "user", 2, '', 0, '', '', repeat(chr(9), 3) || 'WORD REPORT' FROM u
      UNION ALL SELECT "user", 3, title, 0, '', '', repeat(chr(9), 4) || title FROM d
      UNION ALL SELECT "user", 3, title, 1, '', '', 'Old Words' || repeat(chr(9), 5) || 'New Words' FROM d
      UNION ALL SELECT "user", 3, title, 2, word, is_new, CASE WHEN is_new = 'N' THEN repeat(chr(9), 5) ELSE '' END
                 || CASE WHEN word[1] = 'ß' THEN 'Ss' ELSE upper(substr(word, 1, 1)) END || lower(substr(word, 2)) || chr(9) || '+' || cnt FROM ch),
    l AS (SELECT "user", line, row_number() OVER (PARTITION BY "user" ORDER BY section, title, place, word, is_new) AS line_no FROM a)"""


@query("word_change_report", "A10 C33", f"""WITH {SQL_REPORT} SELECT "user", line_no, line FROM l""")
def word_change_report(tables):
    """Whole reports, line by line."""
    return S.report_lines(_changes(tables))


@query(
    "word_change_mails",
    "A10",
    f"""
    WITH {SQL_REPORT}
    SELECT "user", ((line_no - 1) // 100 + 1)::INT AS part, count(*)::INT AS n_lines, string_agg(line, chr(10) ORDER BY line_no) AS body
    FROM l GROUP BY 1, 2
    """,
)
def word_change_mails(tables):
    """The same, cut into mails of a hundred lines."""
    return S.report_parts(_changes(tables), 100)


@query(
    "changed_sites",
    "A11",
    f"""
    WITH {SQL_CHANGES}, d AS (SELECT DISTINCT "user", title FROM ch)
    SELECT "user", title, row_number() OVER (PARTITION BY "user" ORDER BY title) AS number,
           row_number() OVER (PARTITION BY "user" ORDER BY title) || '.' || title AS entry FROM d
    """,
)
def changed_sites(tables):
    return S.changed_sites(_changes(tables))
