"""State of the rolling window, kept per element."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues


class RollingSum(StatefulProcessor):
    """Sum over an element's last three slots. State: its scores in them, gone once the watermark has left them behind."""

    def __init__(self, step: int, names: list[str]):
        self.step, self.names = step, names  # the key's columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "at long, score double")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held = sorted(tuple(x) for x in self.recent.get())
        for at, score in sorted(((r.at, r.abnScore) for r in rows), key=lambda x: x[0]):
            if held and at <= held[-1][0]:
                continue  # a slot is scored once
            held = [x for x in held if x[0] > at - 3 * self.step] + [(at, score)]
            known = [s for _, s in held if s is not None]
            yield Row(**dict(zip(self.names, key)), at=at, abnScore=score, windowScore=sum(known) if known else None)
        self.recent.put(held)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(1000 * (held[-1][0] + 3 * self.step))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.recent.clear()
        return iter([])

    def close(self) -> None:
        pass
