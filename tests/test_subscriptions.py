"""Commands, notices, reports, and the streaming counterparts."""

import datetime as dt
import os
import random
import shutil
import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from helpers import rows
from hardwood.operators import subscriptions as S
from hardwood.streaming import subscriptions as streamed
from hardwood.streaming.ingest import ingest_pages
from hardwood.streaming.subscriptions import read_replies, read_state, update_replies, update_state

FIELDS = "msg_id long, ts timestamp, sender string, subject string"


def message(i, sender, subject):
    return (i, dt.datetime(2020, 1, 1, 12, 0, 0) + dt.timedelta(minutes=i), sender, subject)


INBOX = [
    message(1, "Ann <Ann@m.example>", "ADD my-site! http://a.example"),
    message(2, "ann@m.example", "add my.site http://b.example"),  # listed already
    message(3, "ann@m.example", "delete other"),  # never listed
    message(4, "Bob <bob@m.example>", "add news http://n.example"),
    message(5, "bob@m.example", "DELETE news!"),
    message(6, "ann@m.example", "show"),
    message(7, "eve@m.example", "add x http://x.example"),
    message(8, "bob@m.example", "add"),  # no site
    message(9, "ann@m.example", "add last http://l.example"),
]


def inbox(spark):
    return spark.createDataFrame(INBOX, FIELDS).repartition(3)


def test_state_and_shows(spark):
    commands = S.parsed_commands(inbox(spark))
    state = [(r["user"], r["site"]) for r in rows(S.subscription_state(commands), "user", "site")]
    assert state == [("ann", "last"), ("ann", "mysite"), ("eve", "x")]
    for block in (1_000_000, 1):
        assert [(r["msg_id"], r["user"], r["site"]) for r in rows(S.shown_lists(commands, block), "site")] == [(6, "ann", "mysite")]


def test_lists_are_those_at_the_time_of_the_show(spark):
    told = ["add a", "show", "add b", "show", "delete a", "show", "delete b", "show", "add a", "add a", "show"]
    sent = [message(i, "ann@m.example", t + (" http://x" if t.startswith("add") else "")) for i, t in enumerate(told)]
    commands = S.parsed_commands(spark.createDataFrame(sent, FIELDS))
    lists = {r["msg_id"]: r["message"] for r in S.notices(commands).where("subject = 'WEBSITE LIST'").collect()}
    assert lists == {1: "a", 3: "a\nb", 5: "b", 7: "", 10: "a"}


def test_notices(spark):
    commands = S.parsed_commands(inbox(spark))
    want = [(2, "ERROR", "mysite is already listed"), (3, "ERROR", "other is not listed"), (6, "WEBSITE LIST", "mysite")]
    for block in (1_000_000, 1):
        assert [(r["msg_id"], r["subject"], r["message"]) for r in rows(S.notices(commands, block), "msg_id")] == want


def test_known_senders(spark):
    known = spark.createDataFrame([("ANN@m.example ",), ("bob@m.example",), ("bob@m.example",)], "Email string")
    kept = S.from_known_senders(S.parsed_commands(inbox(spark)), known)
    assert sorted(r["msg_id"] for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 8, 9]


def test_report_is_cut_into_parts(spark):
    changes = [("u", "t", f"word{i:03d}", "N" if i % 2 else "O", i + 1) for i in range(25)] + [("v", "s", "one", "N", 1)]
    df = spark.createDataFrame(changes, "user string, title string, word string, is_new string, cnt long")
    for block in (1_000_000, 7):
        lines = [r["line"] for r in sorted(S.report_lines(df.where("user = 'u'"), block).collect(), key=lambda r: r["line_no"])]
        assert lines[:6] == [
            "\t\t\tList Of Websites With Changes", "1.t", "\t\t\tWORD REPORT", "\t\t\t\tt", "Old Words\t\t\t\t\tNew Words", "Word000\t+1",
        ]
        assert lines[6] == "\t\t\t\t\tWord001\t+2" and len(lines) == 30
        parts = rows(S.report_parts(df, 12, block), "user", "part")
        assert [(r["user"], r["part"], r["n_lines"]) for r in parts] == [("u", 1, 12), ("u", 2, 12), ("u", 3, 6), ("v", 1, 6)]
        assert "\n".join(r["body"] for r in parts[:3]).split("\n") == lines
        sites = rows(S.changed_sites(df, block_rows=block), "user")
        assert [r["entry"] for r in sites] == ["1.t", "1.s"]


def test_streamed_state_equals_batch(spark, tmp_path):
    landing, state, check = (str(tmp_path / n) for n in ("in", "state", "check"))
    want = rows(S.subscription_state(S.parsed_commands(inbox(spark))), "user", "site")

    def run():
        stream = spark.readStream.schema(FIELDS).parquet(landing)
        update_state(S.parsed_commands(stream), state, check)

    for part in (INBOX[:4], INBOX[4:]):
        spark.createDataFrame(part, FIELDS).write.mode("append").parquet(landing)
        run()
    assert rows(read_state(spark, state), "user", "site") == want
    run()  # nothing new
    assert rows(read_state(spark, state), "user", "site") == want


def test_late_file_with_older_commands(spark, tmp_path):
    """The order of arrival does not matter, only the time of the commands."""
    landing, state, check = (str(tmp_path / n) for n in ("in", "state", "check"))
    want = rows(S.subscription_state(S.parsed_commands(inbox(spark))), "user", "site")
    for part in (INBOX[4:], INBOX[:4]):
        spark.createDataFrame(part, FIELDS).write.mode("append").parquet(landing)
        update_state(S.parsed_commands(spark.readStream.schema(FIELDS).parquet(landing)), state, check)
    assert rows(read_state(spark, state), "user", "site") == want


def listed_replies(df):
    return sorted((r["msg_id"], r["user"], r["subject"], r["site"] or "") for r in df.collect())


def busy(n, users, seed, start=0):
    rng = random.Random(seed)
    told = ["add {} http://x.example", "delete {}", "show", "hello"]
    return [message(start + i, f"u{rng.randrange(users)}@m.example", rng.choice(told).format(f"s{rng.randrange(4)}")) for i in range(n)]


def test_streamed_replies_equal_batch(spark, tmp_path):
    """Three batches; the second has commands that are older than some of the first."""
    landing, target, check = (str(tmp_path / n) for n in ("in", "replies", "check"))
    sent = busy(200, 5, seed=4)
    parts = [sent[:60] + sent[80:100], sent[60:80] + sent[100:140], sent[140:] + [message(100_000, "end@m.example", "hello")]]
    for part in parts:
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(landing)
        commands = S.parsed_commands(spark.readStream.schema(FIELDS).parquet(landing))
        assert update_replies(commands, target, check, delay="1 hour", slots=3) == 0
    want = S.reply_rows(S.parsed_commands(spark.createDataFrame(sent, FIELDS)))
    assert listed_replies(read_replies(spark, target)) == listed_replies(want)
    texts = {r["msg_id"]: r["message"] for r in S.mails(read_replies(spark, target)).collect()}
    assert texts == {r["msg_id"]: r["message"] for r in S.notices(S.parsed_commands(spark.createDataFrame(sent, FIELDS))).collect()}


def test_commands_beyond_the_delay_are_counted(spark, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("in", "replies", "check"))
    late = []
    for part in ([message(500, "a@m.example", "add s http://x")], [message(1, "a@m.example", "delete s"), message(700, "a@m.example", "show")], [message(900, "a@m.example", "hello")]):
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(landing)
        late.append(update_replies(S.parsed_commands(spark.readStream.schema(FIELDS).parquet(landing)), target, check, delay="1 minute", slots=1))
    assert late == [0, 1, 0]
    assert listed_replies(read_replies(spark, target)) == [(700, "a", "WEBSITE LIST", ""), (700, "a", "WEBSITE LIST", "s")]


class Store:
    """States and timers in memory, which count their calls."""

    def __init__(self):
        self.calls, self.rows, self.pairs = 0, [], {}

    def getListState(self, *_):
        return self

    getMapState = getListState

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name in ("appendValue", "appendList"):
                self.rows += [args[0]] if name == "appendValue" else args[0]
            elif name == "updateValue":
                self.pairs[args[0]] = args[1]
            elif name == "clear":
                self.rows = []
            if name == "getValue":
                return self.pairs.get(args[0])
            return iter(list(self.rows)) if name == "get" else None

        return call


def test_the_state_is_called_by_bucket_not_by_command():
    """Two thousand commands of two users: calls for each batch, and two for each (user, slot)."""
    store, replay = Store(), streamed._Replay()
    replay.init(store)
    sent = [(i * 1_000_000, i, f"u{i % 2}", 0, "add" if i % 4 < 2 else "show", f"s{i % 10}" if i % 4 < 2 else None) for i in range(2_000)]
    batch = pd.DataFrame(sent, columns=["at", "msg_id", "user", "slot", "verb", "site"])
    list(replay.handleInputRows((7,), iter([batch]), None))
    found = pd.concat(replay.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1_000_000), None))
    # Before the watermark are 1,001 commands: of every four two shows; each user has five sites after ten commands.
    assert (found["subject"] == "WEBSITE LIST").sum() == sum(1 for i in range(1_001) if i % 4 > 1) + sum(
        len({j % 10 for j in range(i % 2, i, 2) if j % 4 < 2}) for i in range(1_001) if i % 4 > 1
    )
    assert store.calls < 20


@pytest.mark.parametrize("block", [1_000_000, 5_000])
def test_lists_of_a_user_with_many_commands(spark, block):
    """Rows are made in proportion to the lists, not to commands times shows."""
    sites = 20_000
    told = [f"add s{i} http://x" if i % 2 == 0 else f"delete s{i - 1}" for i in range(2 * sites)] + [f"add t{i} http://x" for i in range(10)]
    gap = len(told) // 4_000
    sent, i = [], 0
    for place, text in enumerate(told):
        sent.append(message(i, "u@m.example", text))
        i += 1
        if place % gap == 0:
            sent.append(message(i, "u@m.example", "show"))
            i += 1
    commands = S.parsed_commands(spark.createDataFrame(sent, FIELDS))
    stretches, shows = S.listed_stretches(commands, block)
    n_shows = shows.count()
    made = stretches.select(F.sum(F.greatest(F.lit(0), F.coalesce("last", F.lit(n_shows)) - F.col("first") + 1))).first()[0]
    listed, want = set(), 0
    for _, _, _, text in sent:
        verb, *site = text.split()[:2]
        if verb == "show":
            want += len(listed)
        else:
            (listed.add if verb == "add" else listed.discard)(site[0])
    assert n_shows > 3_900 and S.shown_lists(commands, block).count() == want == made


def test_pages_are_taken_in_once(spark, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("in", "pages", "check"))

    def land(*ids):
        spark.createDataFrame([(i, f"/p{i}", f"<p>{i}") for i in ids], "page_id long, url string, html string").write.mode("append").parquet(landing)

    land(1, 2)
    assert ingest_pages(spark, landing, target, check).count() == 2
    time.sleep(1.1)
    land(2, 3)
    table = ingest_pages(spark, landing, target, check)
    assert sorted(r["page_id"] for r in table.collect()) == [1, 2, 3]
    assert ingest_pages(spark, landing, target, check).count() == 3


def test_file_times_do_not_matter(spark, tmp_path):
    """New pages in a file hours older, and repeats in one hours younger."""
    landing, target, check = (str(tmp_path / n) for n in ("in", "pages", "check"))

    def land(name, hours, *ids):
        folder = tmp_path / "made" / name
        spark.createDataFrame([(i, f"/p{i}", f"<p>{i}") for i in ids], "page_id long, url string, html string").coalesce(1).write.parquet(str(folder))
        made, = folder.glob("*.parquet")
        os.makedirs(landing, exist_ok=True)
        placed = f"{landing}/{name}.parquet"
        shutil.copyfile(made, placed)
        now = time.time() + hours * 3600
        os.utime(placed, (now, now))
        return sorted(r["page_id"] for r in ingest_pages(spark, landing, target, check).collect())

    assert land("a", 0, 1, 2) == [1, 2]
    assert land("b", -3, 3, 4) == [1, 2, 3, 4]
    assert land("c", 6, 1, 5) == [1, 2, 3, 4, 5]
    assert land("d", -24 * 400, 6, 2) == [1, 2, 3, 4, 5, 6]


def test_a_batch_costs_its_own_size(spark, tmp_path, monkeypatch):
    """Ten batches: what a batch reads and looks up does not grow with what was taken in before."""
    landing, target, check = (str(tmp_path / n) for n in ("in", "pages", "check"))
    for batch in range(10):
        ids = [*range(batch * 50, batch * 50 + 50), *([batch * 50 - 1] if batch else []), None, None]
        pages = spark.createDataFrame([(i, f"/p{i}", "<p>" * 100) for i in ids], "page_id long, url string, html string")
        pages.coalesce(1).write.mode("append").parquet(landing)
    progress = []
    plain = DataStreamWriter.start

    def start(self, *args, **kwargs):
        query = plain(self, *args, **kwargs)
        progress.append(query)
        return query

    monkeypatch.setattr(DataStreamWriter, "start", start)
    table = ingest_pages(spark, landing, target, check, files_per_batch=1)
    assert sorted(r["page_id"] for r in table.where("page_id IS NOT NULL").collect()) == list(range(500))
    assert table.where("page_id IS NULL").count() == 20
    batches = [p for p in progress[0].recentProgress if p["numInputRows"]]
    assert len(batches) == 10
    assert {p["numInputRows"] for p in batches[1:]} == {53}
    state = [p["stateOperators"][0] for p in batches]
    assert [s["numRowsTotal"] for s in state] == [52 * (i + 1) for i in range(10)]
    # Lookups of the state: one for each row of the batch.
    read = [s["customMetrics"]["rocksdbTotalBytesReadByCompaction"] + s["customMetrics"]["rocksdbTotalBytesRead"] for s in state]
    assert max(read[2:]) <= 2 * max(read[1], 1_000)


def test_a_target_needs_its_checkpoint(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "pages")
    spark.createDataFrame([(1, "/p", "<p>")], "page_id long, url string, html string").write.parquet(landing)
    ingest_pages(spark, landing, target, str(tmp_path / "one"))
    with pytest.raises(ValueError):
        ingest_pages(spark, landing, target, str(tmp_path / "two"))
