"""Logs the driver appends to: batch timings and streaming progress. They never raise."""

from __future__ import annotations

import json
import logging
import os
from datetime import UTC, datetime

from pyspark.sql.streaming import StreamingQueryListener

from logpulse.streaming.batch import Batch

logger = logging.getLogger(__name__)


class LineLog:
    """Appends lines to a file; without a path it only logs."""

    def __init__(self, path: str | None = None):
        self.path = path

    def append(self, line: str) -> None:
        if not self.path:
            return
        try:
            os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
            with open(self.path, "a", encoding="utf-8") as handle:
                handle.write(line + "\n")
        except OSError as exc:
            logger.warning("cannot append to %s: %s", self.path, exc)


class TimingLog(LineLog):
    """``telemetry.TIMING_LINE`` lines, one per stage of a batch."""

    def record(
        self, batch: Batch, seconds: float, *, stage: str | None = None, empty: bool = False
    ) -> None:
        words = ["[spark batch]", f"stream={batch.stream}", f"table={batch.table}"]
        if batch.query:
            words.append(f"query={batch.query}")
        words.append(f"batch_id={batch.batch_id}")
        if stage:
            words.append(f"stage={stage}")
        if empty:
            words.append("empty=true")
        words.append(f"duration={seconds:.3f}s")
        line = " ".join(words)
        logger.info(line)
        self.append(f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ} {line}")


class ProgressLog(StreamingQueryListener):
    """Every streaming query event as a JSON line (``telemetry.progress`` reads them)."""

    def __init__(self, path: str | None):
        super().__init__()
        self._log = LineLog(path)

    def _line(self, **fields) -> None:
        try:
            fields = {"ts": datetime.now(UTC).isoformat(), **fields}
            self._log.append(json.dumps(fields, ensure_ascii=False))
        except Exception as exc:
            logger.warning("progress line lost: %s", exc)

    def onQueryStarted(self, event) -> None:
        self._line(event="started", id=str(event.id), runId=str(event.runId), name=event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            details = json.loads(p.json)
        except ValueError:
            details = {"raw": p.json}
        self._line(queryName=p.name, id=str(p.id), runId=str(p.runId), progress=details)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._line(
            event="terminated", id=str(event.id), runId=str(event.runId), exception=event.exception
        )
