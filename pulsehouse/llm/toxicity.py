"""Toxicity: a linear classifier over character n-grams, whose features are scaled by
naive Bayes log-count ratios.

Features are the distinct character n-grams (``ORDERS``) of the lower-cased text, each
run of control characters and blanks read as blanks, hashed to ``2**BITS`` bins. A bin's
scale is the log ratio of its smoothed document shares in toxic and in other texts.
The ``FEATURES`` bins whose ratio is surest stay, and logistic regression with an L1
penalty (accelerated proximal gradient) is fitted on the scaled features, both classes
weighing the same. So few bins have a weight, and scoring a text is a table look-up for
every character.

Defined results: a null text is an empty text; a text without a weighted n-gram (empty
texts too) gets the score of the intercept; repeated rows get equal scores, one for each
row; label rows with a null in doc_id or label are not learned from, repeated ones once, and
with labels of a single class, or none, every score is that class's share (0 without labels). Other columns
of the tables are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import code_points, give_back, pieces

ORDERS = (3, 4, 5, 6)
BITS = 20
#: Rows of each class that a model learns from, at most, and characters of them together.
ROWS_PER_CLASS = 3000
CHARS_PER_CLASS = 24_000_000
#: Bins that may have a weight.
FEATURES = 4000
#: Characters that a task holds as numbers at once.
BLOCK = 1 << 19


@dataclass
class Model:
    bins: np.ndarray      # int32, sorted
    weights: np.ndarray   # float32
    intercept: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=np.float32)
        out[self.bins] = self.weights
        return out


def gram_bins(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, the bins of the n-grams that start at each position) for each of ORDERS."""
    h = np.full(len(codes), 0x811C9DC5, dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        h = h[:max(0, len(codes) - order + 1)]
        h ^= codes[order - 1:]
        h *= np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        if order in ORDERS:
            mixed = (h + np.uint32(order)) * np.uint32(0x9E3779B1)
            yield order, (mixed >> np.uint32(32 - BITS)).astype(np.int32)


def _codes(piece: str) -> np.ndarray:
    codes = code_points(f" {piece.lower()} ").copy()
    codes[codes < 32] = 32
    return codes


def distinct_bins(text: str | None) -> np.ndarray:
    codes = _codes(text or "")
    return np.unique(np.concatenate([bins for _, bins in gram_bins(codes)]))


def score_texts(texts: Iterable[str | None], rows: int, model: Model,
                table: np.ndarray) -> np.ndarray:
    """The scores of ``rows`` texts; each bin counts once for each text."""
    hits: list[np.ndarray] = []
    for group in pieces(texts, BLOCK, overlap=max(ORDERS) - 1):
        parts = [_codes(p) for _, p, _ in group]
        codes = np.concatenate(parts)
        owner = np.repeat(np.array([r for r, _, _ in group], dtype=np.int64),
                          [len(p) for p in parts])
        ends = np.cumsum([len(p) for p in parts])
        for n, bins in gram_bins(codes):
            at = np.flatnonzero(table[bins])
            # an n-gram must end in the piece it starts in
            at = at[at + n <= ends[np.searchsorted(ends, at, side="right")]]
            hits.append(np.unique((owner[at] << BITS) | bins[at]))
    found = np.unique(np.concatenate(hits)) if hits else np.zeros(0, dtype=np.int64)
    total = np.bincount(found >> BITS, weights=table[found & ((1 << BITS) - 1)],
                        minlength=rows)
    z = np.clip(total + model.intercept, -50, 50)
    return 1.0 / (1.0 + np.exp(-z))


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray,
        penalty: float = 1e-4, rounds: int = 200, smooth: float = 1.0,
        least: int = 3, features: int = FEATURES) -> Model:
    """Fit on the given texts, with the ``features`` bins whose log-count ratio is surest.
    ``weights``: how many rows of the corpus each text stands for, among those of its class;
    the two classes weigh the same, as toxic texts are few and missing one costs more."""
    y = np.asarray(labels, dtype=np.float64)
    none = np.zeros(0, dtype=np.int32)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        return Model(none, none.astype(np.float32), float(np.log(share / (1 - share))))
    # two passes over the texts, so that only the bins that stay are held for all
    df, pos = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for t, toxic in zip(texts, y):
        bins = distinct_bins(t)
        df[bins] += 1
        pos[bins] += toxic
    neg = df - pos
    p = (pos + smooth) / (y.sum() + 2 * smooth)
    q = (neg + smooth) / (len(y) - y.sum() + 2 * smooth)
    ratio = np.log(p / q)
    # the bins whose ratio is surest, by its size over its standard error
    sure = np.abs(ratio) / np.sqrt(1 / (pos + smooth) + 1 / (neg + smooth)) * (df >= least)
    usable = np.sort(np.argsort(-sure, kind="stable")[:features])
    usable = usable[sure[usable] > 0]
    column = np.full(1 << BITS, -1, dtype=np.int32)
    column[usable] = np.arange(len(usable))
    held = [column[distinct_bins(t)] for t in texts]
    held = [c[c >= 0].astype(np.min_scalar_type(len(usable))) for c in held]
    doc = np.repeat(np.arange(len(held), dtype=np.min_scalar_type(len(held))), [len(c) for c in held])
    col = np.concatenate(held)
    del held
    scale = ratio[usable]
    share = weights / np.where(y == 1, weights @ y, weights @ (1 - y)) / 2

    # a feature's value is its bin's scale, so sums over a text's features need no more than
    # these two arrays, block by block
    def summed(to: np.ndarray, per: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n)
        for at in range(0, len(to), 1 << 20):
            out += np.bincount(to[at:at + (1 << 20)], weights=per[of[at:at + (1 << 20)]], minlength=n)
        return out

    def loss_of(ww: np.ndarray, bb: float) -> tuple[float, np.ndarray]:
        z = summed(doc, scale * ww, col, len(y)) + bb
        return float(share @ (np.logaddexp(0, z) - y * z)), z

    # accelerated proximal gradient on the weighted logistic loss
    w, b = np.zeros(len(usable)), float(np.log((share @ y) / (1 - share @ y)))
    at_w, at_b, t = w.copy(), b, 1.0
    step = 4.0 / (float(share @ summed(doc, scale ** 2, col, len(y))) + 1.0)
    for _ in range(rounds):
        f0, z = loss_of(at_w, at_b)
        r = share * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        grad, grad_b = scale * summed(col, r, doc, len(w)), float(r.sum())
        while True:
            new = at_w - step * grad
            new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
            new_b = at_b - step * grad_b
            d, db = new - at_w, new_b - at_b
            if (loss_of(new, new_b)[0]
                    <= f0 + grad @ d + grad_b * db + (d @ d + db * db) / (2 * step) + 1e-12):
                break
            step /= 2
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at_w = new + (t - 1) / t_new * (new - w)
        at_b = new_b + (t - 1) / t_new * (new_b - b)
        moved = float(np.abs(new - w).max(initial=0.0))
        w, b, t = new, new_b, t_new
        if moved < 1e-5:
            break
    kept = np.flatnonzero(w)
    return Model(usable[kept].astype(np.int32), (w[kept] * scale[kept]).astype(np.float32), b)


def training_rows(documents: DataFrame, labels: DataFrame, label: str, learn: Column,
                  per_class: int, chars: int) -> DataFrame:
    """(text, label, stands_for): at most ``per_class`` labelled rows of each class, those
    with the lowest hash of their id, as far as they hold ``chars`` characters together. A
    text that holds more by itself is passed over; repeated rows count once. stands_for is
    the number of labelled rows of the class for each row taken."""
    marked = (labels.where(learn).select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
              .where("_id is not null and _label in (0, 1)").distinct())
    shares = marked.groupBy("_label").count().withColumnRenamed("count", "_all")
    # the ids are picked first, with some to spare for labels without a fitting text
    none, some = (marked.where(F.col("_label") == k).orderBy(F.xxhash64("_id"), "_id").limit(2 * per_class)
                  for k in (0, 1))
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id"), "_id", F.xxhash64("_text"))
    size = F.length(F.coalesce("_text", F.lit("")))
    taken = (documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).where(size <= chars)
             .join(F.broadcast(none.unionAll(some)), "_id").distinct()
             .withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= per_class)
             .withColumn("_held", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .where(F.col("_held") <= chars).select("_text", "_label"))
    counts = taken.groupBy("_label").count()
    each = (shares.join(counts, "_label")
            .select("_label", (F.col("_all") / F.col("count")).alias("_stands_for")))
    return taken.join(F.broadcast(each), "_label").select("_text", "_label", "_stands_for")


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic",
          learn: Column | None = None, per_class: int = ROWS_PER_CLASS,
          chars: int = CHARS_PER_CLASS) -> Model:
    """Fit on a bounded sample of the labelled rows that ``learn`` admits (a column of
    ``labels``). One task fits, as the sample is bounded by ``2 * chars``
    characters; the driver gets the weights alone."""
    rows = training_rows(documents, labels, label, F.lit(True) if learn is None else learn,
                         per_class, chars)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if not got:
            model = fit([], np.zeros(0), np.zeros(0))
        else:
            all_rows = pd.concat(got).sort_values(["_label", "_text"], kind="stable", na_position="first")
            model = fit(all_rows["_text"].tolist(), all_rows["_label"].to_numpy(),
                        all_rows["_stands_for"].to_numpy())
        yield pd.DataFrame({"bins": [model.bins], "weights": [model.weights],
                            "intercept": [model.intercept]})
        give_back()

    fitted = rows.coalesce(1).mapInPandas(
        task, "bins array<int>, weights array<float>, intercept double").first()
    if fitted is None:      # a plan known to be empty runs no task
        return fit([], np.zeros(0), np.zeros(0))
    return Model(np.array(fitted["bins"], dtype=np.int32),
                 np.array(fitted["weights"], dtype=np.float32), fitted["intercept"])


def score(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted: one row for each row of ``documents``."""
    import pyarrow as pa

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for b in batches:
            s = score_texts(b.column("text").to_pylist(), b.num_rows, model, table)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(s),
                                   "predicted": pa.array((s >= threshold).astype("int32"))})
        give_back()

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(task, "doc_id long, score double, predicted int")


def keep_clean(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text scores below ``threshold``."""
    import pyarrow as pa

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for b in batches:
            s = score_texts(b.column("text").to_pylist(), b.num_rows, model, table)
            yield b.filter(pa.array(s < threshold))
        give_back()

    return documents.mapInArrow(task, documents.schema)
