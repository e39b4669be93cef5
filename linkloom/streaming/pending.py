"""The resumable loop inside one stream: pending URLs are held in keyed state and tried again by timers.

URLs are dealt to shards of their month.  Each shard keeps what is pending and what is done; it tries a
bounded number of URLs at a time, sets a timer while some are left, and goes on when that fires.  A URL
that timed out is tried again after a pause, when no new one is left.  State, timers and output
are those of the query's checkpoint, so a stream that is stopped or fails goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ATTEMPTS = "month string, shard int, uid bigint, url string, text string, status string, tries int"
SHARDS = 64

#: ``uid, url`` to the same rows with ``text`` and, if it can time out, a boolean ``timed_out``.
Process = Callable[[pd.DataFrame], pd.DataFrame]


class PendingUrls(StatefulProcessor):
    """Tries the pending URLs of a shard, ``limit`` at a time, until each is done."""

    def __init__(self, process: Process, limit: int, pause_ms: int, retry_ms: int, max_tries: int):
        self.process, self.limit, self.max_tries = process, limit, max_tries
        self.pause_ms, self.retry_ms = pause_ms, retry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A queue is a map from a running number, so that its head is read by number and nothing else is.
        row = "uid bigint, url string, tries int, after bigint"
        self.queues = {name: handle.getMapState(name, "place bigint", row) for name in ("fresh", "again")}
        self.ends = handle.getMapState("ends", "name string", "first bigint, next bigint")
        self.known = handle.getMapState("known", "uid bigint", "status string")

    def _bounds(self, name: str) -> tuple[int, int]:
        found = self.ends.getValue((name,)) if self.ends.containsKey((name,)) else (0, 0)
        return int(found[0]), int(found[1])

    def _put(self, name: str, rows: list[tuple]) -> None:
        first, end = self._bounds(name)
        for place, row in enumerate(rows, end):
            self.queues[name].updateValue((place,), row)
        self.ends.updateValue((name,), (first, end + len(rows)))

    def _take(self, name: str, n: int, now: int) -> list[tuple]:
        """Up to ``n`` rows from the head that need not wait; a queue's rows wait no longer than later ones."""
        first, end = self._bounds(name)
        out = []
        while len(out) < n and first < end:
            row = self.queues[name].getValue((first,))
            if row[3] > now:
                break
            self.queues[name].removeKey((first,))
            out.append((int(row[0]), row[1], int(row[2])))
            first += 1
        self.ends.updateValue((name,), (first, end))
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for frame in rows:
            for uid, url in zip(frame["uid"].tolist(), frame["url"].tolist()):
                if not self.known.containsKey((uid,)):
                    self.known.updateValue((uid,), ("pending",))
                    new.append((uid, url, 0, 0))
        self._put("fresh", new)
        # Where a timer is set, the shard waits for it: arrivals do not hasten the next try.
        if not any(True for _ in self.handle.listTimers()):
            yield from self._try(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._try(key, timerValues)

    def _try(self, key, timerValues) -> Iterator[pd.DataFrame]:
        now = int(timerValues.getCurrentProcessingTimeInMs())
        taken = self._take("fresh", self.limit, now)
        taken += self._take("again", self.limit - len(taken), now)
        if taken:
            found = self.process(pd.DataFrame([t[:2] for t in taken], columns=["uid", "url"])).set_index("uid")
            out, again = [], []
            for uid, url, tries in taken:
                late = "timed_out" in found.columns and bool(found.at[uid, "timed_out"])
                text = found.at[uid, "text"]
                text = text if isinstance(text, str) and not late else None
                if late and (self.max_tries < 0 or tries + 1 < self.max_tries):
                    again.append((uid, url, tries + 1, now + self.retry_ms))
                    status = "timeout"
                else:
                    status = "gave_up" if late else "ok" if text and text.strip() else "empty"
                    self.known.updateValue((uid,), (status,))
                out.append((key[0], int(key[1]), uid, url, text, status, tries + 1))
            self._put("again", again)
            yield pd.DataFrame(out, columns=["month", "shard", "uid", "url", "text", "status", "tries"])
        fresh, again = self._bounds("fresh"), self._bounds("again")
        if fresh[0] < fresh[1]:
            self.handle.registerTimer(now + self.pause_ms)
        elif again[0] < again[1]:
            after = int(self.queues["again"].getValue((again[0],))[3])
            self.handle.registerTimer(max(now + self.pause_ms, after))

    def close(self) -> None:
        pass


def attempts(
    urls: DataFrame,
    process: Process,
    limit: int = 100,
    shards: int = SHARDS,
    pause_ms: int = 1000,
    retry_ms: int = 60_000,
    max_tries: int = -1,
) -> DataFrame:
    """A stream of ``(month, uid, url)`` to a stream of attempts, in append mode.

    Each URL ends with one attempt of status ``ok``, ``empty`` or, after ``max_tries`` time-outs (-1 for
    no bound), ``gave_up``; a ``timeout`` before it is tried again after ``retry_ms``.  A shard of a month
    tries ``limit`` URLs at once and pauses before the next.  A ``uid`` that came before in its month is
    not taken up again; one without a ``uid`` is left out.  The query needs the RocksDB state store and a
    trigger that goes on, as timers fire in later batches: ``use_rocksdb`` sets the former.
    """
    shard = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard")
    rows = urls.select(F.col("month").cast("string"), F.col("uid").cast("bigint").alias("uid"), "url", shard)
    return rows.where("uid is not null").groupBy("month", "shard").transformWithStateInPandas(
        statefulProcessor=PendingUrls(process, limit, pause_ms, retry_ms, max_tries),
        outputStructType=ATTEMPTS,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def finished(written: DataFrame) -> DataFrame:
    """The last attempt of each URL that is done, from a table of attempts."""
    return written.where("status != 'timeout'")
