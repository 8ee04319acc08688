"""The stage loop as a stateful stream: claims, retries with backoff, stale work taken back, and an end when all is done.

A stage's input is a stream of what happens to documents: ``arrived`` (everything before the stage is done), ``done``,
``error`` (with a message). Its output is what is to be done with each: ``run`` with the number of the attempt, ``recovered``
(the document goes back to the status before the stage, and runs again), ``complete``, or ``failed`` for good. Each
document has its own state and timers, so neither a restart nor a slow document holds up others, and the query's
checkpoint makes every step take effect once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "hash string, action string, attempt int, at timestamp, message string"
#: What is kept for a document: waiting, running, complete or failed; the attempt, and when its next timer is due.
_STATE = "status string, attempt int, due long, message string"


class StageProcessor(StatefulProcessor):
    """The states of one stage. Times are event times: timers fire when the watermark has passed them."""

    def __init__(self, retries: int, base_seconds: float, cap_seconds: float, stale_seconds: float, transient: list[str]) -> None:
        self.retries, self.base, self.cap, self.stale, self.transient = retries, base_seconds, cap_seconds, stale_seconds, [p.lower() for p in transient]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("document", _STATE)

    def _set(self, status: str, attempt: int, due: int | None, message: str | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if due is not None:
            self.handle.registerTimer(due)
        self.state.update((status, attempt, due or 0, message))

    def _run(self, key: str, attempt: int, now: int, action: str = "run", message: str | None = None) -> Row:
        self._set("running", attempt, now + int(self.stale * 1000), message)
        return _row(key, action, attempt, now, message)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (name,) = key
        # In the order in which they happened; what arrives twice, or late for a document that has ended, changes nothing.
        for row in sorted(rows, key=lambda r: (r.at, ["arrived", "error", "done"].index(r.event) if r.event in ("arrived", "error", "done") else 9)):
            now = int(row.at.timestamp() * 1000)
            known = self.state.get() if self.state.exists() else None
            status, attempt = (known[0], known[1]) if known else (None, 0)
            if row.event == "arrived" and status is None:
                yield self._run(name, 1, now)
            elif row.event == "done" and status in ("running", "waiting"):
                self._set("complete", attempt, None, None)
                yield _row(name, "complete", attempt, now, None)
            elif row.event == "error" and status == "running":
                passing = any(p in (row.message or "").lower() for p in self.transient)
                if passing and attempt < self.retries:
                    # The wait doubles with each attempt, up to the cap.
                    due = now + int(min(self.base * 2 ** (attempt - 1), self.cap) * 1000)
                    self._set("waiting", attempt, due, row.message)
                else:
                    self._set("failed", attempt, None, row.message)
                    yield _row(name, "failed", attempt, now, row.message)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (name,) = key
        if not self.state.exists():
            return
        status, attempt, due, message = self.state.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        if at != due:
            return
        if status == "waiting":
            yield self._run(name, attempt + 1, at, message=message)
        elif status == "running":
            # Nothing was heard of it: it is taken back and runs again, which counts as an attempt.
            if attempt < self.retries:
                yield self._run(name, attempt + 1, at, "recovered")
            else:
                self._set("failed", attempt, None, "stale")
                yield _row(name, "failed", attempt, at, "stale")


def _row(name: str, action: str, attempt: int, at: int, message: str | None) -> Row:
    import datetime

    return Row(hash=name, action=action, attempt=attempt, at=datetime.datetime.fromtimestamp(at / 1000), message=message)


def stage(events: DataFrame, transient: list[str], retries: int = 5, base_seconds: float = 5.0, cap_seconds: float = 120.0, stale_seconds: float = 7200.0, late: str = "0 seconds") -> DataFrame:
    """``(hash, action, attempt, at, message)``: what is to be done with each document, from its ``events``
    (hash, event, at, message), a stream.

    An error whose message holds one of the ``transient`` parts is retried after ``base_seconds`` times two to the number of
    earlier retries, at most ``cap_seconds``; other errors, and more than ``retries`` attempts, end as failed.
    A document of which nothing is heard for ``stale_seconds`` is recovered. Rows without a hash or time are left out.
    """
    rows = events.where("hash is not null and at is not null").select("hash", "event", "at", "message").withWatermark("at", late)
    processor = StageProcessor(retries, base_seconds, cap_seconds, stale_seconds, transient)
    return rows.groupBy("hash").transformWithState(processor, OUTPUT, "Append", "EventTime")


def run_stages(steps: dict[str, Callable[[], int]], upstream: Callable[[str], int], idle_polls: int = 2, wait_seconds: float = 30.0, polls: int | None = None) -> dict[str, int]:
    """Poll the steps in turn until all are idle: a step gives how many documents it has handled.

    A step ends after ``idle_polls`` polls in a row without work, but not while ``upstream`` of its name counts documents that are still
    to come. There is a wait only after a round without any work. ``polls`` bounds the rounds. Gives what each step handled.
    """
    handled, idle = dict.fromkeys(steps, 0), dict.fromkeys(steps, 0)
    rounds = 0
    while any(n < idle_polls for n in idle.values()) and (polls is None or rounds < polls):
        worked = False
        for name, step in steps.items():
            if idle[name] >= idle_polls:
                continue
            n = step()
            handled[name] += n
            worked |= n > 0
            idle[name] = 0 if n or upstream(name) else idle[name] + 1
        rounds += 1
        if not worked and any(n < idle_polls for n in idle.values()):
            time.sleep(wait_seconds)
    return handled
