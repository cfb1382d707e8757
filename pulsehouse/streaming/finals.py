"""Groups that are final when they appear, and the rows that came too late for them.

Two queries, one after the other. The first files the rows of each micro-batch as on time
or late, by the watermark that stood when the batch began: the newest time of all batches
before it, less the delay. The second groups the rows on time into windows in append mode:
a window appears once, when the watermark has passed its end, and its state leaves. A row
on time is never older than the watermark of its batch, so the second query drops none,
and rows on time and late rows add up to those read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsehouse.operators.merge import read_if_there
from pulsehouse.sources.files import parquet_stream

MARK = "newest LONG"


def file_by_time(root: str, time_col: str, delay: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch callback: the rows go to ``root/rows``, partitioned by ``late`` and
    ``load_batch``, in one pass that also finds the batch's newest time. ``time_col`` is an
    instant; a row without one can be in no window and counts as late.

    ``root/marks`` has the newest time so far after each micro-batch, one row. A batch with
    a mark is done, so a replay adds nothing; one without is written over. The batches of
    one checkpoint are numbered without gaps; a mark that is lost fails the next batch."""
    def mark(batch_id: int) -> str:
        return f"{root}/marks/load_batch={batch_id}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if read_if_there(spark, MARK, mark(batch_id)) is not None:
            return
        before = None if batch_id == 0 else spark.read.schema(MARK).parquet(mark(batch_id - 1)).first()[0]
        late = F.col(time_col).isNull()
        if before is not None:
            late = late | (F.col(time_col) < F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {delay}"))
        seen = Observation()
        (batch.observe(seen, F.max(F.unix_micros(time_col)).alias("newest"))
         .withColumn("late", late).withColumn("load_batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("late", "load_batch").parquet(f"{root}/rows"))
        known = [t for t in (before, seen.get["newest"]) if t is not None]
        (spark.range(1).select(F.lit(max(known, default=None)).cast("long").alias("newest"))
         .write.mode("overwrite").parquet(mark(batch_id)))
    return write


def late_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The late rows, with the micro-batch that brought them; reads their folders alone."""
    return spark.read.schema(f"{schema}, late BOOLEAN, load_batch INT").parquet(f"{root}/rows").where("late").drop("late")


def final_windows(spark: SparkSession, root: str, schema: str, time_col: str, delay: str, width: str,
                  keys: list[str], *aggs: Column) -> DataFrame:
    """Stream of window_start, window_end, ``keys`` and ``aggs``: each window of the rows on
    time once, when the watermark has passed its end. Runs while the first query does not,
    as a trigger must take whole micro-batches of it; ``delay`` is the one given there."""
    rows = parquet_stream(spark, f"{root}/rows", f"{schema}, late BOOLEAN, load_batch INT").where("NOT late")
    groups = rows.withWatermark(time_col, delay).groupBy(F.window(time_col, width).alias("w"), *keys).agg(*aggs)
    return groups.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         *[c for c in groups.columns if c != "w"])


def dropped(query: StreamingQuery) -> int:
    """Rows (after partial aggregation) that the state operators of a query's run dropped as
    older than the watermark."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
