"""Incremental file sources.

The file stream source keeps its own log of processed files in the query's
checkpoint, so every file is ingested exactly once across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.schemas import JSON_OPTIONS


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str,
                glob: str | None = None, max_files: int | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """Stream new files of ``fmt`` under ``path`` with a declared schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def csv_stream(spark: SparkSession, path: str, schema: str, header: bool = True,
               max_files: int | None = None, glob: str | None = "*.csv") -> DataFrame:
    """CSV landing zone as a stream; malformed fields become NULL (PERMISSIVE)."""
    return file_stream(spark, path, schema, "csv", glob=glob, max_files=max_files,
                       options={"header": str(header).lower(), "mode": "PERMISSIVE"})


def json_stream(spark: SparkSession, path: str, schema: str,
                max_files: int | None = None, glob: str | None = "*.json") -> DataFrame:
    return file_stream(spark, path, schema, "json", glob=glob, max_files=max_files,
                       options=JSON_OPTIONS)


def parquet_stream(spark: SparkSession, path: str, schema: str,
                   max_files: int | None = None, glob: str | None = None) -> DataFrame:
    return file_stream(spark, path, schema, "parquet", glob=glob, max_files=max_files)


def table_stream(spark: SparkSession, path: str, schema: str,
                 max_files: int | None = None,
                 since: str | None = None, since_col: str = "load_time") -> DataFrame:
    """A parquet table read as a stream of its appended files.

    Bronze tables are append-only, so deletes never reach the stream (S9).
    ``since`` starts mid-history by filtering on the ingest column (S7/S8).
    """
    df = parquet_stream(spark, path, schema, max_files=max_files)
    if since is not None:
        df = df.where(F.col(since_col) >= F.lit(since).cast("timestamp"))
    return df


def with_ingest_columns(df: DataFrame) -> DataFrame:
    """Bronze ingest columns (P13): load time and the file each row came from."""
    return (df.withColumn("load_time", F.current_timestamp())
              .withColumn("source_file", F.col("_metadata.file_path")))


def read_json(spark: SparkSession, path: str, schema: str,
              glob: str | None = "*.json") -> DataFrame:
    """Batch JSON scan with a declared schema, one distributed read."""
    r = spark.read.schema(schema).options(**JSON_OPTIONS)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path)
