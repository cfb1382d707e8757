"""Exact top-k search by inner product, in three phases with a uniform threshold.

Vectors become whole numbers: floor(256 * x) of each component. A vector is cut into
``SLICES`` runs of dimensions; a query has one list of local scores for each slice, and a
candidate's score is the sum of its local scores. Queries and candidates are dealt into
blocks, and each pair of blocks is a cell, whose task holds its part of every list.

1. Gather: each cell takes the ``k`` best entries of each of its lists, resolves these
   candidates' whole scores, and hands on the ``k`` best for each query. The k-th best of
   all of them is the query's cutoff: no vector below it can be among the k best.
2. Collect: the cutoff goes back to all cells. A score of at least the cutoff needs a local
   score of at least cutoff / SLICES in some list, so a cell collects the entries of its
   lists from that threshold on (also right for negative local scores).
3. Resolve: the collected candidates' whole scores are computed, those below the cutoff
   go, and the ``k`` best of each cell meet in a window that keeps k rows for each query
   and partition before it shuffles.

A cell is bounded by the block sizes; the queries are a stated set (ids divisible by
``EVERY``) against all rows, in blocks, and nothing is broadcast.

Defined results: vectors that are null, empty or hold a null or non-finite component, and
rows with a null id, take no part. Shorter vectors count as filled up with zeros. Rows
with one id are rows of their own: each takes part, as a candidate of the others too, and
each is a query if its id is one; a row is no candidate of itself alone. Ties go to smaller
ids. Scores are exact as long as they fit 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import partitions, stored

EVERY = 50
SLICES = 4
#: Queries and candidates of a cell, about.
QUERY_BLOCK, BLOCK = 512, 1024


def whole_vectors(embeddings: DataFrame, id_col: str = "vec_id",
                  vector: str = "embedding") -> DataFrame:
    """row (a number of its own), vec_id, v: the vectors that take part, as arrays of long. The
    numbers hold for as long as the rows are stored."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                              F.transform(F.col(vector), lambda c: c.cast("double")).alias("x"))
            .where("vec_id is not null and size(x) > 0").where(finite)
            .select(F.monotonically_increasing_id().alias("row"), "vec_id",
                    F.transform("x", lambda c: F.floor(c * 256)).alias("v")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers: by float64 where no sum can lose a bit."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2 ** 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _sliced(v: np.ndarray) -> list[np.ndarray]:
    edges = np.linspace(0, v.shape[1], SLICES + 1).astype(int)
    return [v[:, i:j] for i, j in zip(edges, edges[1:])]


def _slices(q: pd.DataFrame, c: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
    width = max(max(map(len, q["v"])), max(map(len, c["v"])))
    return _sliced(_matrix(q["v"], width)), _sliced(_matrix(c["v"], width))


def _reach(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """For each query no less than its best score in the cell: the lengths of its parts times
    the greatest lengths of the candidates' parts, added up."""
    length = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    return sum(length(x) * length(y).max(initial=0) for x, y in zip(a, b)) * (1 + 1e-9) + 1


FOUND = "row long, query_id long, vec_id long, score long"


def _frame(parts: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    if not parts:
        return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
    sizes = [len(p[2]) for p in parts]
    return pd.DataFrame({"row": np.repeat([p[0] for p in parts], sizes),
                         "query_id": np.repeat([p[1] for p in parts], sizes),
                         "vec_id": np.concatenate([p[2] for p in parts]),
                         "score": np.concatenate([p[3] for p in parts])})


def _gather(k: int):
    """The best of what the k highest entries of each of a cell's lists name."""
    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(q) and len(c):
            lists = [_products(x, y) for x, y in zip(*_slices(q, c))]
            ids, rows = c["vec_id"].to_numpy(np.int64), c["row"].to_numpy(np.int64)
            for i, (me, name) in enumerate(zip(q["row"], q["vec_id"])):
                other = np.flatnonzero(rows != me)
                if not len(other):
                    continue
                known = np.unique(np.concatenate(
                    [other[_best(part[i][other], ids[other], k)] for part in lists]))
                totals = sum(part[i][known] for part in lists)
                top = _best(totals, ids[known], k)
                parts.append((me, name, ids[known[top]], totals[top]))
        return _frame(parts)
    return cell


def _resolve(k: int):
    """The k best of a cell among those that reach the cutoff; a score that does has an entry
    of at least the cutoff's share in one of the lists. Queries that nothing in the cell can
    lift to their cutoff are not multiplied."""
    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(q) and len(c):
            a, b = _slices(q, c)
            # a query with fewer than k gathered entries has no cutoff: all its rows stay
            cut = q["cutoff"].to_numpy(np.float64, na_value=-np.inf)
            alive = np.flatnonzero(_reach(a, b) >= cut)
            if not len(alive):
                return _frame(parts)
            lists = [_products(x[alive], y) for x, y in zip(a, b)]
            share = np.floor(cut / len(lists))
            ids, rows = c["vec_id"].to_numpy(np.int64), c["row"].to_numpy(np.int64)
            mine, names = q["row"].to_numpy(np.int64), q["vec_id"].to_numpy(np.int64)
            for at, i in enumerate(alive):
                enough = lists[0][at] >= share[i]
                for part in lists[1:]:
                    enough |= part[at] >= share[i]
                known = np.flatnonzero(enough & (rows != mine[i]))
                totals = sum(part[at][known] for part in lists)
                known, totals = known[totals >= cut[i]], totals[totals >= cut[i]]
                top = _best(totals, ids[known], k)
                parts.append((mine[i], names[i], ids[known[top]], totals[top]))
        return _frame(parts)
    return cell


def _cells(queries: DataFrame, rows: DataFrame, q_blocks: int, c_blocks: int, task) -> DataFrame:
    n = max(1, min(q_blocks * c_blocks, 100 * partitions(rows.sparkSession)))
    every = lambda n_blocks: F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    # both sides come from one stored table: columns of their own for the queries
    queries = queries.select(*[F.col(x).alias(x) for x in queries.columns])
    q = queries.withColumn("q_block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(q_blocks)).cast("int"))
    c = rows.withColumn("c_block", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(c_blocks)).cast("int"))
    q = q.withColumn("c_block", every(c_blocks)).repartition(n, "q_block", "c_block")
    c = c.withColumn("q_block", every(q_blocks)).repartition(n, "q_block", "c_block")
    keys = ["q_block", "c_block"]
    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(task, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, k: int = 5, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each query, all if fewer."""
    rows = stored(whole_vectors(embeddings), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    size = rows.agg(F.count("*").alias("n"),
                    F.count_if(F.col("vec_id") % every == 0).alias("q")).collect()[0]
    q_blocks, c_blocks = max(1, -(-size.q // QUERY_BLOCK)), max(1, -(-size.n // BLOCK))
    gathered = _cells(queries, rows, q_blocks, c_blocks, _gather(k))
    cutoffs = (_ranked(gathered, k).where(F.col("rank") == k)
               .select("row", F.col("score").alias("cutoff")))
    asked = stored(queries.join(cutoffs, "row", "left"), "cutoffs")
    found = _cells(asked, rows, q_blocks, c_blocks, _resolve(k))
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
