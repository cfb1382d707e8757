"""Start, trigger and await streaming queries.

A trigger is always set explicitly: ``availableNow`` drains what is there
and stops (T1); otherwise a fixed processing-time interval (T2). The default
trigger (T3) never ends, so it is never used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_stream(df: DataFrame, checkpoint: str, *, path: str | None = None,
                 table: str | None = None, fmt: str = "parquet",
                 foreach_batch: Callable[[DataFrame, int], None] | None = None,
                 output_mode: str = "append", once: bool = True,
                 processing_time: str = "15 seconds", query_name: str | None = None,
                 partition_by: list[str] | tuple[str, ...] | None = None,
                 options: dict[str, str] | None = None,
                 pool: str | None = None) -> StreamingQuery:
    """Start ``df`` into a file sink or managed table (K1, K2) or a micro-batch
    callback (K3).

    Every query has its own checkpoint folder (T6); exactly-once for file
    sinks comes from the sink's commit log, for callbacks from idempotent
    merges keyed by batch id.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=processing_time)
    if pool:
        df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    return w.toTable(table) if table else w.start()


def await_queries(queries: Iterable[StreamingQuery], timeout: float | None = None) -> None:
    """Barrier over the queries *we* started (not every active stream, T9).
    Re-raises the first query failure."""
    for q in queries:
        if timeout is None:
            q.awaitTermination()
        else:
            q.awaitTermination(timeout)
        if q.exception() is not None:
            raise q.exception()


def stop_after(query: StreamingQuery, seconds: float) -> StreamingQuery:
    """Run for a wall-clock budget, then stop (T10). Prefer ``once=True``."""
    query.awaitTermination(seconds)
    query.stop()
    return query
