"""Subscription state and replies kept up to date from a stream of commands.

:func:`update_state` folds commands of any order into the state. Replies depend on the order of a user's
commands, so :func:`update_replies` holds each command back until the watermark has passed it, and then
replays what waited in time order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hardwood.operators.subscriptions import ADD_ERROR, CHANGES, DELETE_ERROR, LIST, last_commands
from hardwood.streaming.ingest import keyed_state

# The processor travels to the executors with its code; nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def update_state(commands: DataFrame, target: str, checkpoint: str) -> None:
    """Fold all new commands into the change log below ``target``.

    The fold is the same aggregation as in batch. Each micro-batch writes the changed
    keys to its own folder, replaced as a whole if the batch is repeated.
    """

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    query = (
        last_commands(commands)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, target: str) -> DataFrame:
    """Current subscriptions: the newest entry of each (user, site) in the change log."""
    log = spark.read.parquet(target)
    newest = log.groupBy("user", "site").agg(F.max_by(F.struct("verb", "url", "ts"), "batch").alias("s"))
    return newest.where(F.col("s.verb") == "add").select("user", "site", "s.url", F.col("s.ts").alias("since"))


_REPLY = "msg_id long, at long, user string, subject string, site string"
# What one call of the state store moves: columns of many commands, and the sites of one (user, slot).
_WAITING = "at array<long>, msg_id array<long>, user array<string>, slot array<int>, verb array<string>, site array<string>"
_OWNER, _SITES = "user string, slot int", "sites array<string>"
# Keys of the state; a checkpoint holds for one number only.
BUCKETS = 4_096


def _frame(replies: list[tuple]) -> pd.DataFrame:
    """Replies ``(msg_id, at, user, subject, site)``; texts as plain objects, which Arrow takes in one piece."""
    msg_ids, ats, *texts = zip(*replies) if replies else ((),) * 5
    numbers = {"msg_id": pd.Series(msg_ids, dtype="int64"), "at": pd.Series(ats, dtype="int64")}
    return pd.DataFrame(numbers | {c: pd.Series(v, dtype=object) for c, v in zip(("user", "subject", "site"), texts)})


class _Replay(StatefulProcessor):
    """State of a bucket of (user, slot): the sites each has listed, and the commands that the watermark has not passed.

    After a command is replayed only its effect on the list remains, so what is kept is bounded by the
    sites and by the commands of one watermark delay. Commands come and go by the bucket; of the lists only those
    of the users who sent a command are read and written.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.listed = handle.getMapState("listed", _OWNER, _SITES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            known = batch[batch["slot"] >= 0]
            if len(known):
                at = known["at"].astype("int64")
                self._wait(zip(at, known["msg_id"].astype("int64"), known["user"], known["slot"], known["verb"], known["site"]))
                first = int(at.min()) if first is None else min(first, int(at.min()))
        if first is not None:
            self._wake(first)
        yield _frame([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        ready: dict[tuple, dict[tuple, tuple]] = {}
        later = []
        for columns in list(self.waiting.get()):
            for at, msg_id, user, slot, verb, site in zip(*columns):
                if at // 1000 > passed:
                    later.append((at, msg_id, user, slot, verb, site))
                else:
                    ready.setdefault((user, slot), {})[(at, msg_id)] = verb, site
        replies: list[tuple] = []
        for owner, commands in ready.items():
            self._replayed(owner, commands, replies)
        if ready:
            self.waiting.clear()
            if later:
                self._wait(later)
        if later:
            self._wake(min(row[0] for row in later))
        yield _frame(replies)

    def _wait(self, commands: Iterable[tuple]) -> None:
        at, msg_id, user, slot, verb, site = zip(*commands)
        numbers = [[int(v) for v in c] for c in (at, msg_id, slot)]
        self.waiting.appendValue((numbers[0], numbers[1], list(user), numbers[2], list(verb), list(site)))

    def _replayed(self, owner: tuple, commands: dict[tuple, tuple], replies: list[tuple]) -> None:
        """Replies to the commands ``(at, msg_id): (verb, site)`` of one (user, slot)."""
        user, slot = owner
        before = self.listed.getValue(owner)
        listed = dict.fromkeys(before[0]) if before else {}
        changed = False
        for (at, msg_id), (verb, site) in sorted(commands.items(), key=lambda item: item[0]):
            if verb == "show":
                if slot == 0:
                    replies.append((msg_id, at, user, LIST, None))
                replies += [(msg_id, at, user, LIST, name) for name in listed]
            elif (site in listed) == (verb == "add"):
                replies.append((msg_id, at, user, ADD_ERROR if verb == "add" else DELETE_ERROR, site))
            else:
                changed = True
                if verb == "add":
                    listed[site] = None
                else:
                    del listed[site]
        if changed and listed:
            self.listed.updateValue(owner, (list(listed),))
        elif changed and before:
            self.listed.removeKey(owner)

    def _wake(self, at: int) -> None:
        # Timers are in milliseconds, and one before the command's own also wakes a command at the watermark.
        self.handle.registerTimer(max(0, at // 1000 - 1))

    def close(self) -> None:
        pass


def update_replies(commands: DataFrame, target: str, checkpoint: str, delay: str = "1 hour", slots: int = 8) -> int:
    """Replay all new commands in time order and write the reply rows they cause below ``target``.

    Commands may arrive in any order within ``delay`` of event time; each waits until the newest command is
    ``delay`` ahead of it. Returns how many came too late to be replayed. A user's sites are dealt to ``slots``
    tasks, so a user with most commands is no hot task; a show asks all of them. Many (user, slot) share a key of the
    state, so its cost is that of the commands and not of calls for each. Each micro-batch writes its own
    folder, replaced as a whole if the batch is repeated.
    """
    spark = commands.sparkSession
    changes = F.col("verb").isin(*CHANGES) & F.col("site").isNotNull()
    shows = F.col("verb") == "show"
    of_site = F.when(changes, F.pmod(F.xxhash64("site"), F.lit(slots)).cast("int")).otherwise(F.lit(-1))
    slot = F.when(shows, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(of_site))
    # Any message moves the watermark; a filter here would be pushed below it, so what is no command goes to slot -1.
    # Watermarks are in milliseconds, so event time is, too; ``at`` keeps the order within one.
    exact = commands.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    timed = exact.withColumn("ts", F.date_trunc("millisecond", F.timestamp_micros("at"))).withWatermark("ts", delay)
    dealt = timed.select("ts", "at", "msg_id", "verb", "site", "user", F.explode(slot).alias("slot"))
    bucket = F.pmod(F.xxhash64("user", "slot"), F.lit(BUCKETS)).cast("int")
    replies = dealt.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        _Replay(), outputStructType=_REPLY, outputMode="append", timeMode="EventTime"
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("ts", F.timestamp_micros("at")).drop("at").write.mode("overwrite").parquet(f"{target}/batch={number}")

    # Timers and maps need the RocksDB store.
    with keyed_state(spark):
        query = (
            replies.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
        )
        query.awaitTermination()
    return sum(operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in progress["stateOperators"])


def read_replies(spark: SparkSession, target: str) -> DataFrame:
    """``(msg_id, ts, user, subject, site)`` of all batches, as :func:`~hardwood.operators.subscriptions.reply_rows`."""
    return spark.read.parquet(target).select("msg_id", "ts", "user", "subject", "site")
