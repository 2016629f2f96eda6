"""Per-key state machines: call limiter, failure lockout, alert hysteresis.

Their results depend on every earlier decision of the same key, so they keep a small
state per key. The state is bounded (at most ``limit`` times per key) and expires with the
window, so forgotten keys free their memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskloom import constants as K

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = "times array<bigint>"


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _in_time_order(rows: Iterator[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    """A key's rows of one micro-batch; the batch size is set at the source."""
    return pd.concat(list(rows), ignore_index=True).sort_values(columns, kind="stable")


class _WindowedTimes(StatefulProcessor):
    """Holds the times that still count, oldest first."""

    def __init__(self, limit: int, seconds: int):
        self.limit, self.window = limit, seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getValueState("times", _TIMES)

    def close(self) -> None:
        pass

    def recent(self) -> list[int]:
        return [int(t) for t in self.times.get()[0]] if self.times.exists() else []

    def drop_old(self, times: list[int], now: int) -> list[int]:
        return [t for t in times if t > now - self.window]

    def keep(self, times: list[int]) -> None:
        """Store the times and wake up when the newest one stops counting."""
        for due in self.handle.listTimers():
            self.handle.deleteTimer(due)
        if times:
            self.times.update((times,))
            self.handle.registerTimer((times[-1] + self.window) // 1000 + 1)
        else:
            self.times.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.times.clear()
        yield from ()


class CallLimiter(_WindowedTimes):
    """Allow at most ``limit`` calls per trailing window (0: any number); refused calls do not count."""

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        calls, allowed = _in_time_order(rows, ["us", "event_id"]), self.recent()
        verdicts, waits = [], []
        for now in calls["us"]:
            allowed = self.drop_old(allowed, now)
            ok = self.limit <= 0 or len(allowed) < self.limit
            verdicts.append(ok)
            waits.append(0 if ok else max(1, int((self.window - (now - allowed[0])) / 1e6) + 1))
            if ok and self.limit > 0:
                allowed.append(int(now))
        self.keep(allowed)
        yield pd.DataFrame(
            {"key": key[0], "event_id": calls["event_id"], "allowed": verdicts, "retry_after": waits}
        )


class FailureLockout(_WindowedTimes):
    """Refuse attempts after ``limit`` failures in the window; a success clears them."""

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        tries, failures = _in_time_order(rows, ["us", "event_id"]), self.recent()
        verdicts, counts = [], []
        for now, failed, succeeded in zip(tries["us"], tries["failed"], tries["succeeded"]):
            failures = self.drop_old(failures, now)
            locked = len(failures) >= self.limit
            if not locked and failed:
                failures.append(int(now))
            elif not locked and succeeded:
                failures = []
            verdicts.append(locked)
            counts.append(len(failures))
        self.keep(failures)
        yield pd.DataFrame(
            {"key": key[0], "event_id": tries["event_id"], "refused": verdicts, "failures": counts}
        )


def _keyed(events: DataFrame, key: str, ts: str, delay: str, *more) -> DataFrame:
    """Key, id, event time (with watermark) and micros of each event."""
    timed = events.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    return timed.select(
        F.col(key).cast("string").alias("key"), "event_id", "_at", F.unix_micros("_at").alias("us"), *more
    )


def limited_calls(
    events: DataFrame, key: str, limit: int, seconds: int = 60, ts: str = "ts", delay: str = "10 minutes"
) -> DataFrame:
    """Stream of (key, event_id, allowed, retry_after)."""
    rows = _keyed(events, key, ts, delay)
    return rows.groupBy("key").transformWithStateInPandas(
        CallLimiter(limit, seconds), "key string, event_id bigint, allowed boolean, retry_after bigint",
        "Append", "EventTime",
    )


def lockouts(
    events: DataFrame, key: str, failed, succeeded, limit: int = 5, seconds: int = 900, ts: str = "ts",
    delay: str = "10 minutes",
) -> DataFrame:
    """Stream of (key, event_id, refused, failures)."""
    rows = _keyed(events, key, ts, delay, failed.alias("failed"), succeeded.alias("succeeded"))
    return rows.groupBy("key").transformWithStateInPandas(
        FailureLockout(limit, seconds), "key string, event_id bigint, refused boolean, failures bigint",
        "Append", "EventTime",
    )


class AlertMachine(StatefulProcessor):
    """Alert hysteresis per subject: fire once, again after the cooldown, resolve when the status is ok.

    The state of a subject is forgotten ``expiry`` after its latest report, by a timer that frees the
    memory and by the gap to the next report, so both agree whenever the timer runs. A report older than
    its subject's latest one is late: it is passed on, marked, and decides nothing.
    """

    def __init__(self, cooldown: int, expiry: int):
        self.cooldown, self.expiry = cooldown, expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alert", "triggered bigint, is_open boolean, latest bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        reports = _in_time_order(rows, ["us"])
        triggered, is_open, latest = (int(self.state.get()[0]), bool(self.state.get()[1]), int(self.state.get()[2])) if self.state.exists() else (0, False, None)
        fired, solved, late = [], [], []
        for us, status in zip(reports["us"], reports["status"]):
            behind = latest is not None and us < latest
            if not behind:
                if latest is not None and us - latest >= self.expiry:
                    triggered, is_open = 0, False
                latest = int(us)
            fire = not behind and status == "alert" and (not is_open or us - triggered >= self.cooldown)
            solve = not behind and status == "ok" and is_open
            if fire:
                triggered, is_open = int(us), True
            elif solve:
                is_open = False
            fired.append(fire)
            solved.append(solve)
            late.append(behind)
        self.state.update((triggered, is_open, latest))
        for due in self.handle.listTimers():
            self.handle.deleteTimer(due)
        self.handle.registerTimer((latest + self.expiry) // 1000 + 1)
        yield pd.DataFrame(
            {"subject": key[0], "us": reports["us"], "status": reports["status"], "should_alert": fired, "should_resolve": solved, "late": late}
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.state.clear()
        yield from ()


def alert_history(
    reports: DataFrame, subject: str, status: str, ts: str, cooldown_hours: int = K.ALERT_COOLDOWN_HOURS,
    expiry_hours: int = 24 * 365, delay: str = "10 minutes",
) -> DataFrame:
    """Stream of (subject, us, status, should_alert, should_resolve, late) along each subject's reports.

    A subject silent for ``expiry_hours`` begins anew. Reports later than ``delay`` behind the newest are
    dropped by the watermark, which the stream's progress counts; those in between are marked late
    if a newer one of their subject was there before.
    """
    rows = reports.select(
        F.col(subject).cast("string").alias("subject"), F.col(status).alias("status"), F.col(ts).cast("timestamp").alias("_at"),
    ).withWatermark("_at", delay)
    rows = rows.select("subject", "status", "_at", F.unix_micros("_at").alias("us"))
    return rows.groupBy("subject").transformWithStateInPandas(
        AlertMachine(cooldown_hours * 3_600_000_000, expiry_hours * 3_600_000_000),
        "subject string, us bigint, status string, should_alert boolean, should_resolve boolean, late boolean", "Append", "EventTime",
    )
