"""A training corpus from ``documents``: quality, toxicity, near-duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and
returns a DataFrame that is written as Parquet and read again as the next stage's docs. All
stages but the last return the columns of ``documents``. The two classifiers learn from the
labelled rows of ``sf_dir`` (a bounded sample, see their modules). Near-duplicates keep the
document with the smallest id of each class, one row of it. The mix repeats documents, so
its rows may be equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsehouse.llm import mixing, neardup, packing, quality, toxicity
from pulsehouse.llm.common import read_table, stored, prepare


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more."""
    prepare(spark)
    model = quality.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, 0.7)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below 0.5."""
    prepare(spark)
    model = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each class of near-duplicates: that with the class's smallest id, and of
    different texts with that id one that is in the class."""
    prepare(spark)
    keep = neardup.firsts(docs).select(F.col("id").alias("id__"), F.col("digest").alias("digest__"))
    named = docs.withColumn("id__", neardup.row_id()).withColumn("digest__", neardup.text_digest())
    first = Window.partitionBy("id__", "digest__").orderBy(F.xxhash64("text"))
    return (named.join(keep, ["id__", "digest__"], "left_semi")
            .withColumn("row__", F.row_number().over(first)).where("row__ = 1")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with the token ids' crc32. The workers have run the
    stages before, so they keep fewer words than the operator by itself."""
    prepare(spark)
    return packing.pack_documents(docs, digests=True, kept_words=200_000)


STAGES = [("quality classifier", keep_good), ("toxicity", keep_clean),
          ("MinHash near-dedup", keep_one_of_each), ("mixing sources", mix_sources),
          ("packing", pack)]

#: SQL cannot express the trained classifiers; tests/llm holds the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
