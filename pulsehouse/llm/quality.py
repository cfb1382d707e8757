"""Quality classifier: supervised subword embeddings.

A text's features are its words (cut at white space, letter case kept) and the character
n-grams (``ORDERS``) inside them with the word's two ends marked, all hashed to
``2**BITS`` rows of a learned table of vectors; "the word before, again" and "the text
ends" are features too. The vectors of all occurrences are
averaged and a softmax layer gives the probability of each class. Vectors and layer are
trained together by stochastic gradient descent in numpy.

For scoring, each table row is multiplied by the output layer once, which gives one number
for each feature; a text's logit is the mean of its features' numbers. That is the same
sum in another order.

Defined results: a null text is an empty text; a text without words gets the score of
its end alone; repeated rows get equal scores, one for each row; label rows with a null in
doc_id or label are not learned from; with labels of a single class, or none, every score
is that class's share (0 without labels). A word of over ``BLOCK`` characters counts as
several. Other columns of the tables are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import code_points, give_back, pieces
from pulsehouse.llm.toxicity import training_rows

ORDERS = (2, 3, 4)
BITS = 18
WIDTH = 12
#: Rows of each class that a model learns from, at most, and characters of them together.
ROWS_PER_CLASS = 2500
CHARS_PER_CLASS = 24_000_000
BLOCK = 1 << 18
BLANK = np.uint32(32)
#: Bins of "a text ends", which counts ENDS times for each text so that a few words alone
#: do not settle a score, and of "a word equals the word before it".
END, REPEAT, ENDS = 0, 1, 60


@dataclass
class Model:
    logits: np.ndarray   # float32: one number for each hashed feature
    bias: float


def _codes(piece: str) -> np.ndarray:
    """Code points with every run of white space as one blank, and a blank at both ends."""
    codes = code_points(f" {piece} ")
    blank = (codes <= 32) | (codes == 0xA0) | (codes == 0x3000)
    keep = ~blank
    keep[:-1] |= blank[:-1] & ~blank[1:]
    keep[-1] = True
    return np.where(blank, BLANK, codes)[keep]


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, bin) of each word and each n-gram inside a word, ends included."""
    n = len(codes)
    blank = codes == BLANK
    where, bins = [], []
    shift = np.uint32(32 - BITS)
    # words: a polynomial over the word's code points, from running sums modulo 2**64
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    if len(starts):
        power = np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64)
        power[0] = 1
        power = np.cumprod(power)                     # odd, so each has an inverse
        back = np.full(n, pow(0x9E3779B97F4A7C15, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        back = np.cumprod(back)
        run = np.cumsum(codes.astype(np.uint64) * power)
        h = (run[ends - 1] - run[starts - 1]) * back[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        where.append(starts)
        bins.append((h >> np.uint64(64 - BITS)).astype(np.int32))
        again = starts[1:][h[1:] == h[:-1]]
        where.append(again)
        bins.append(np.full(len(again), REPEAT, dtype=np.int32))
    inner = np.cumsum(blank)      # blanks up to and with each position
    for order in ORDERS:
        m = n - order + 1
        if m <= 0:
            continue
        # no blank but at the ends, and not blanks alone
        at = np.flatnonzero((inner[order - 2:order - 2 + m] == inner[:m])
                            & ~(blank[:m] & blank[order - 1:]))
        h = np.full(len(at), 0x811C9DC5 + order, dtype=np.uint32)
        for j in range(order):
            h ^= codes[at + j]
            h *= np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x9E3779B1)
        where.append(at)
        bins.append((h >> shift).astype(np.int32))
    if not where:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
    return np.concatenate(where), np.concatenate(bins)


def score_texts(texts: Iterable[str | None], rows: int, model: Model) -> np.ndarray:
    total, count = np.full(rows, ENDS * float(model.logits[END])), np.full(rows, ENDS)
    for group in pieces(texts, BLOCK, at_space=True):
        parts = [_codes(p) for _, p, _ in group]
        owner = np.repeat(np.array([r for r, _, _ in group], dtype=np.int64),
                          [len(p) for p in parts])
        where, bins = features(np.concatenate(parts))
        who = owner[where]
        total += np.bincount(who, weights=model.logits[bins], minlength=rows)
        count += np.bincount(who, minlength=rows)
    z = np.clip(total / count + model.bias, -50, 50)
    return 1.0 / (1.0 + np.exp(-z))


def fit(texts: list[str | None], labels: np.ndarray, weights: np.ndarray, epochs: int = 8,
        rate: float = 0.5, seed: int = 7) -> Model:
    """Stochastic gradient descent over the texts, one at a time in a seeded order.
    ``weights``: how many rows of the corpus each text stands for."""
    y = np.asarray(labels, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        return Model(np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    # bins and shares of all texts in two long arrays, which go back to the system whole
    bins, shares, ends = [], [], [0]
    for t in texts:
        u, c = np.unique(features(_codes(t or ""))[1], return_counts=True)
        bins.append(np.append(u, np.int32(END)))
        shares.append((np.append(c, ENDS) / (c.sum() + ENDS)).astype(np.float32))
        ends.append(ends[-1] + len(u) + 1)
    bins, shares = np.concatenate(bins), np.concatenate(shares)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    out = np.zeros((2, WIDTH), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    share = weights / weights.mean()
    total, done = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            step = np.float32(rate * (1 - done / total))
            done += 1
            u, c = bins[ends[i]:ends[i + 1]], shares[ends[i]:ends[i + 1]]
            hidden = c @ table[u]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= np.float32(share[i])
            back = p @ out
            out -= step * np.outer(p, hidden)
            bias -= step * p * np.float32(0.1)
            # a bin's share of the mean is small: its vector moves by that share times WIDTH
            table[u] -= step * WIDTH * np.outer(c, back)
    return Model((table @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality",
          learn: Column | None = None, per_class: int = ROWS_PER_CLASS,
          chars: int = CHARS_PER_CLASS) -> Model:
    """Fit on a bounded sample of the labelled rows that ``learn`` admits (a column of
    ``labels``). One task fits, as the sample is bounded by ``2 * chars``
    characters; the driver gets one number for each of the ``2**BITS`` features."""
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
        yield pd.DataFrame({"logits": [model.logits.astype("<f4").tobytes()], "bias": [model.bias]})
        give_back()

    got = rows.coalesce(1).mapInPandas(task, "logits binary, bias double").first()
    if got is None:      # a plan known to be empty runs no task
        return fit([], np.zeros(0), np.zeros(0))
    return Model(np.frombuffer(bytes(got["logits"]), dtype="<f4"), got["bias"])


def score(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted: one row for each row of ``documents``."""
    import pyarrow as pa

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_texts(b.column("text").to_pylist(), b.num_rows, model)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(s),
                                   "predicted": pa.array((s >= threshold).astype("int32"))})
        give_back()

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(task, "doc_id long, score double, predicted int")


def keep_good(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose text scores ``threshold`` or more."""
    import pyarrow as pa

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_texts(b.column("text").to_pylist(), b.num_rows, model)
            yield b.filter(pa.array(s >= threshold))
        give_back()

    return documents.mapInArrow(task, documents.schema)
