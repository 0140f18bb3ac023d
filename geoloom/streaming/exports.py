"""Two-phase preprocessing as a stream: a started export is held until its file comes, or until a timer says that it failed."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The states of a scene in preprocessing.
STARTED, DONE, FAILED = "STARTED_GEE_DRIVE_EXPORT", "OK_GEE_DOWNLOADED_AND_WARPED", "FAILED"
EVENTS = "scene string, at timestamp, kind string, path string"
STATES = "scene string, at timestamp, status string, path string, error string"


class Exports(StatefulProcessor):
    """Of each scene: when its export started, and its file, whichever comes first; the timer runs from the start."""

    def __init__(self, patience: timedelta) -> None:
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.started = handle.getValueState("started", "at timestamp, deadline long")
        self.file = handle.getValueState("file", "at timestamp, path string")
        self.ended = handle.getValueState("ended", "status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out, scene = [], key[0]
        for pdf in rows:
            for r in pdf.sort_values("at").itertuples():
                if r.kind == "started" and not self.started.exists():
                    deadline = int((r.at + self.patience).timestamp() * 1000)
                    self.started.update((r.at.to_pydatetime(), deadline))
                    out.append((scene, r.at, STARTED, None, None))
                    if not self.file.exists():
                        self.handle.registerTimer(deadline)
                elif r.kind == "file" and not self.file.exists():
                    self.file.update((r.at.to_pydatetime(), r.path))
                if self.started.exists() and self.file.exists() and not (self.ended.exists() and self.ended.get()[0] == DONE):
                    at, path = self.file.get()
                    self.ended.update((DONE,))
                    self.handle.deleteTimer(self.started.get()[1])
                    out.append((scene, max(pd.Timestamp(at), pd.Timestamp(self.started.get()[0])), DONE, path, None))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in STATES.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.ended.exists():
            self.ended.update((FAILED,))
            at = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
            yield pd.DataFrame([(key[0], at, FAILED, None, f"no export within {self.patience}")], columns=[x.split()[0] for x in STATES.split(", ")])

    def close(self) -> None:
        pass


def states(events: DataFrame, patience: timedelta = timedelta(days=2), delay: str = "1 hour") -> DataFrame:
    """STATES of a stream of EVENTS (kind: started, file): a scene's start, then that it is done or has failed; a file that comes after its scene failed still completes it. Repeated events change nothing."""
    late = events.withWatermark("at", delay)
    return late.groupBy("scene").transformWithStateInPandas(Exports(patience), STATES, "Append", "EventTime")


def latest(found: DataFrame) -> DataFrame:
    """The last state of each scene."""
    return found.groupBy("scene").agg(F.max_by(F.struct("status", "path", "error"), F.struct("at", F.col("status") != STARTED)).alias("s")).select("scene", "s.*")
