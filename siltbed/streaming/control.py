"""Running streams: list, stop, wait."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_names(spark: SparkSession) -> list[str | None]:
    return [q.name for q in spark.streams.active]


def _stop(query: StreamingQuery, timeout: int) -> None:
    query.stop()
    if not query.awaitTermination(timeout):
        raise TimeoutError(f"stream {query.name} still runs {timeout} s after it was told to stop")


def stop_all_streams(spark: SparkSession, timeout: int = 60) -> bool:
    """Stop every stream; True if any was running."""
    running = list(spark.streams.active)
    for query in running:
        _stop(query, timeout)
    return bool(running)


def stop_named_stream(spark: SparkSession, name: str, timeout: int = 60) -> bool:
    running = [q for q in spark.streams.active if q.name == name]
    for query in running:
        _stop(query, timeout)
    return bool(running)


def until_stream_is_ready(
    spark: SparkSession,
    name: str,
    progressions: int = 3,
    timeout: float = 300.0,
    poll: float = 0.5,
) -> bool:
    """Wait for ``progressions`` progress reports. A failed stream or the timeout raises."""
    give_up = time.monotonic() + timeout
    seen: StreamingQuery | None = None
    while time.monotonic() < give_up:
        seen = next((q for q in spark.streams.active if q.name == name), seen)
        if seen is not None:
            if seen.exception() is not None:
                raise seen.exception()
            if len(seen.recentProgress) >= progressions:
                return True
        time.sleep(poll)
    raise TimeoutError(f"stream {name} gave fewer than {progressions} reports in {timeout} s")


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` stream to use up its input, however long that takes. With a
    ``timeout`` in seconds a stream that needs longer is stopped and raises."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name} still runs after {timeout} s")
    return query
