"""Spans: what a request did and how long it took, as rows and as lines of JSON."""

from __future__ import annotations

import json
import secrets
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SPANS


class Tracer:
    """One trace, with an id of 128 bits; spans opened within a span are its children."""

    def __init__(self, log=None):
        self.trace_id, self.open, self.spans, self.log = secrets.token_hex(16), [], [], log

    @contextmanager
    def span(self, name: str, **attributes) -> Iterator[dict]:
        """Times a block; an exception is noted and goes on."""
        own = {"trace_id": self.trace_id, "span_id": secrets.token_hex(8), "parent_span_id": self.open[-1] if self.open else None, "name": name, "start_time": datetime.now(timezone.utc)}
        own |= {"end_time": None, "duration_ms": None, "attributes": {k: str(v) for k, v in attributes.items()}, "error": None}
        self.open.append(own["span_id"])
        began = time.perf_counter()
        try:
            yield own
        except Exception as e:
            own["error"] = f"{type(e).__name__}: {e}"
            raise
        finally:
            own["duration_ms"], own["end_time"] = (time.perf_counter() - began) * 1000, datetime.now(timezone.utc)
            self.open.pop()
            self.spans.append(own)
            if self.log:
                self.log.write(line(own) + "\n")


def line(span: dict) -> str:
    return json.dumps(span, default=lambda t: t.isoformat(), sort_keys=True)


def table(spark: SparkSession, tracer: Tracer) -> DataFrame:
    """The finished spans of a trace."""
    names = [c.split()[0] for c in SPANS.split(", ")]
    return spark.createDataFrame([tuple(s[n] for n in names) for s in tracer.spans], SPANS)


def health(spark: SparkSession) -> dict[str, str]:
    """Whether the engine can work: "ok", or "unavailable" with the reason."""
    try:
        spark.range(1).count()
        return {"status": "ok", "spark": spark.version, "executors": str(spark.sparkContext.defaultParallelism)}
    except Exception as e:  # noqa: BLE001  whatever stops a session
        return {"status": "unavailable", "reason": str(e).splitlines()[0] if str(e) else type(e).__name__}
