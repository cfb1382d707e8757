"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words by weight, at most ``CAP`` times its own size;
what a source cannot take is shared among the others by weight until no target is above
its cap. A document is expected ``target / source size`` times in the mix. The whole part of
that number is certain: so many copies of every document. The fraction is its inclusion
probability p for one copy more, which differs from source to source. For that copy every
document draws a uniform u from a hash of its id, and documents are ranked by
(u / (1 - u)) / (p / (1 - p)), its random odds over its inclusion odds. In order of rank the
sample takes documents until the source's missing words are reached; the document on the
edge is taken if at least half of it fits. So the sample has a fixed size in words, and a
source misses its target by at most half a document.

The edge is found without ordering a source anywhere: ranks are whole numbers of ``4 *
DIGIT`` bits, and four rounds of sums over the next digit, for documents on the edge so
far, give the rank of the last document taken. Each round aggregates before it shuffles.
What is joined to the documents is one row for each source.

Defined results: a null text has size 0; a null source is a source of its own, after all
others in code point order; the weights are dealt to the sources in that order, again and
again. A row without doc_id is drawn by its text. Rows with equal rank (repeated rows, rows
without doc_id and of one text in one source) are on one side of the edge together. A source without words has target 0. An empty table gives an
empty result. Other columns are not read, and ``mixed`` returns the given columns alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import shown, stored

WEIGHTS = (5, 2, 1)
CAP = 3
DIGIT, ROUNDS = 13, 4
TOP = 1 << (DIGIT * ROUNDS)
#: A word is a run of characters other than these white spaces.
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str = "text") -> Column:
    return F.regexp_count(shown(text), F.lit(WORD)).cast("long")


def draw(id_col: str = "doc_id", text: str | None = None) -> Column:
    """A uniform number in (0, 1), the same in every run, from 52 bits of the id's MD5; of a
    row without an id, from those of its text's MD5."""
    own = F.coalesce(F.col(id_col).cast("string"), F.md5(shown(text).cast("binary")) if text else F.lit(""))
    key = F.md5(F.concat(F.lit("mix:"), own))
    bits = F.conv(F.substring(key, 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / F.lit(float(TOP))


def pareto_rank(u: Column, p: Column) -> Column:
    """Odds of u over odds of p, as a whole number below ``TOP`` that grows with them."""
    odds = (u * (1 - p)) / (u * (1 - p) + p * (1 - u))      # q / (1 + q) for the ratio q
    return F.least(F.floor(odds * float(TOP)), F.lit(TOP - 1)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, target. ``sizes``: source, size."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # sorted by Spark, so that a row's number is its place in its partition and the rows before it
    placed = stored(sums.orderBy(F.col("source").asc_nulls_last())
                    .withColumn("place", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("place", 33)
    before = (placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")))
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    number = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    sources = stored(placed.join(before, part == F.col("part"))
                     .select("source", "source_size",
                             F.element_at(pattern, (number % len(weights) + 1).cast("int")).alias("weight")),
                     "mix-weights")
    total = sources.agg(F.sum("source_size")).collect()[0][0] or 0
    level, capped = 0.0, -1
    while True:     # the words for each unit of weight, among sources that are not at their cap
        full = cap * F.col("source_size") <= level * F.col("weight")
        row = sources.agg(F.count_if(full).alias("n"),
                          F.sum(F.when(full, cap * F.col("source_size")).otherwise(0)).alias("words"),
                          F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).collect()[0]
        if row.n == capped or not row.weight:
            break
        capped, level = row.n, (total - row.words) / row.weight
    return sources.select("source", "source_size", F.least(
        F.lit(level) * F.col("weight"), (cap * F.col("source_size")).cast("double")).alias("target"))


def edges(documents: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """(documents' doc_id, source, size; sources' source, source_size, target, copies, p,
    last). A document of the source is taken ``copies`` times, and once more if its rank
    under p is at most ``last``."""
    sizes = stored(documents.select("doc_id", "source", size_of().alias("size"), draw(text="text").alias("u")),
                   "mix-sizes")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = stored(source_targets(sizes, weights, cap)
                     .withColumn("copies", F.floor(ratio).cast("long"))
                     .withColumn("p", ratio - F.floor(ratio))
                     .withColumn("room", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")
    at = sources.select(F.col("source").alias("s"), "p", "room")
    ranked = stored(sizes.join(at, F.col("source").eqNullSafe(F.col("s")))
                    .where("p > 0").select("source", "size", pareto_rank(F.col("u"), F.col("p")).alias("rank")),
                    "mix-ranks")
    state = at.where("p > 0").select("s", "room", F.lit(0).cast("long").alias("prefix"),
                                     F.lit(0).cast("long").alias("taken"))
    for k in reversed(range(ROUNDS)):
        shift = DIGIT * k
        digit = F.shiftright("rank", shift)
        found = (ranked.join(state, F.col("source").eqNullSafe(F.col("s"))
                             & (F.shiftright("rank", shift + DIGIT) == F.col("prefix")))
                 .groupBy("s", "room", "taken", digit.alias("digit")).agg(F.sum("size").alias("words")))
        run = F.sum("words").over(Window.partitionBy("s").orderBy("digit"))
        over = (found.withColumn("end", F.col("taken") + run).where("end > room")
                .groupBy("s").agg(F.min(F.struct("digit", "end", "words", "room")).alias("x")))
        state = stored(over.select("s", "x.room", F.col("x.digit").alias("prefix"),
                                   (F.col("x.end") - F.col("x.words")).alias("taken"), "x.words"), "mix-edge")
    # at least half of the document on the edge must fit; without an edge all are taken
    last = F.col("prefix") - F.when(F.col("taken") + F.col("words") / 2 <= F.col("room_"), 0).otherwise(1)
    cut = state.select(F.col("s").alias("s_"), F.col("room").alias("room_"), "prefix", "taken", "words")
    return sizes, stored(
        sources.join(cut, F.col("source").eqNullSafe(F.col("s_")), "left")
        .select("source", "source_size", "target", "copies", "p",
                F.when(F.col("p") == 0, -1).when(F.col("prefix").isNull(), TOP).otherwise(last).alias("last")),
        "mix-last")


def _copies(u: Column) -> Column:
    extra = (F.col("p_") > 0) & (pareto_rank(u, F.col("p_")) <= F.col("last_"))
    return F.col("copies_") + extra.cast("long")


def _joined(rows: DataFrame, sources: DataFrame) -> DataFrame:
    named = sources.select([F.col(c).alias(f"{c}_") for c in sources.columns])
    return rows.join(named, rows["source"].eqNullSafe(named["source_"]))


def mix(documents: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each row of ``documents``."""
    sizes, sources = edges(documents, weights, cap)
    return _joined(sizes, sources).select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", F.col("source_size_").alias("source_size"),
        F.col("target_").alias("target"), (F.col("size") * _copies(F.col("u"))).alias("taken"))


def mixed(documents: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mix itself: each row of ``documents``, with its columns, as often as it is taken."""
    _, sources = edges(documents, weights, cap)
    return (_joined(documents, sources)
            .select(*[documents[c] for c in documents.columns], _copies(draw(text="text")).cast("int").alias("copies__"))
            .where("copies__ > 0")
            .withColumn("copies__", F.explode(F.sequence(F.lit(1), F.col("copies__")))).drop("copies__"))


#: The mix of ``documents`` in DuckDB's SQL; {documents} is a table or subquery.
ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM {documents}),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sizes GROUP BY source),
filled AS (   -- sources by how soon they reach their cap; those before the first one below it are full
  SELECT *, 3 * source_size / weight AS fill,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE / sum(weight) OVER r AS level
  FROM sources
  WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    r AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lev AS (SELECT coalesce(arg_min(level, fill) FILTER (fill > level), 0) AS level FROM filled),
targets AS (
  SELECT source, source_size, least(lev.level * weight, CAST(3 * source_size AS DOUBLE)) AS target
  FROM sources, lev),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM targets),
split AS (
  SELECT source, source_size, target, CAST(floor(ratio) AS BIGINT) AS copies, ratio - floor(ratio) AS p,
    target - floor(ratio) * source_size AS room FROM shares),
ranked AS (
  SELECT s.doc_id, s.size, t.*, least(CAST(floor((u * (1 - p)) / (u * (1 - p) + p * (1 - u)) * 4503599627370496::DOUBLE) AS BIGINT),
    4503599627370495) AS rank
  FROM sizes s JOIN split t ON s.source IS NOT DISTINCT FROM t.source),
units AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank RANGE UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER (PARTITION BY source, rank) AS unit
  FROM ranked)
SELECT doc_id, size, source_size, target,
  CAST(size * (copies + CASE WHEN p > 0 AND upto - unit + unit / 2.0 <= room THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM units
"""
