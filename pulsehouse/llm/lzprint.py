"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases as LZ78 does: each phrase is the longest phrase met so far
and one character more. The set of phrases is hashed, and its ``SIZE`` smallest hashes are
the fingerprint (a minimum-hash signature of the phrase set). The likeness of two
fingerprints estimates the Jaccard index of the phrase sets, a stand-in for normalised
compression distance. Texts with at most ``SIZE`` phrases get the exact index.

``compare_with_next`` also fingerprints, for each document, an edited text whose last
quarter is replaced by the start of the document that follows by id, and compares the
document with its edited text and with the document that follows. Documents are dealt into
ranges of ids, and each range gets a copy of the first document of the range that follows,
so every task streams through its own ranges with two documents in hand; no window spans
the table.

Defined results: a null text is an empty text, with the empty fingerprint; two empty
fingerprints have likeness 1, an empty and another one 0. A null doc_id comes before all
others; rows with equal doc_id follow each other by text, and repeated rows stay. A single
document follows itself. After ``RESET`` phrases the dictionary is begun anew (the phrases
found so far stay in the set), which bounds memory for a text of any length. Other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import partitions, shown

SIZE = 128
RESET = 1 << 20
#: Ranges of ids for each shuffle partition.
RANGES = 16
LOWEST = -(1 << 63)

_FACTOR, _MASK = 0x100000001B3, (1 << 64) - 1


class Parse:
    """The phrases of a text; ``mark`` and ``back`` return to an earlier state."""

    def __init__(self) -> None:
        self.next = {}            # phrase number << 21 | character -> longer phrase << 21
        self.hashes = [0xCBF29CE484222325]
        self.keys: list[int] = []
        self.node = 0
        self.sketch = np.zeros(0, dtype=np.uint32)
        self.resets = 0

    def feed(self, text: str) -> None:
        get, put, hashes, keys = self.next.get, self.next, self.hashes, self.keys
        node, count, most = self.node, len(self.hashes), RESET
        for c in map(ord, text):
            key = node | c
            longer = get(key)
            if longer is None:
                put[key] = count << 21
                keys.append(key)
                hashes.append(((hashes[node >> 21] ^ c) * _FACTOR + 0x9E3779B9) & _MASK)
                count += 1
                node = 0
                if count > most:
                    self.sketch = self.signature()
                    put.clear()
                    keys.clear()
                    del hashes[1:]
                    count = 1
                    self.resets += 1
            else:
                node = longer
        self.node = node

    def mark(self) -> tuple[int, int, int]:
        return len(self.keys), self.node, self.resets

    def back(self, mark: tuple[int, int, int]) -> bool:
        """Undo what was fed since; False if the dictionary was begun anew meanwhile."""
        n, node, resets = mark
        if resets != self.resets:
            return False
        for key in self.keys[n:]:
            del self.next[key]
        del self.keys[n:], self.hashes[n + 1:]
        self.node = node
        return True

    def signature(self) -> np.ndarray:
        h = np.array(self.hashes[1:], dtype=np.uint64)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        small = (h >> np.uint64(32)).astype(np.uint32)
        if len(small) > 4 * SIZE:
            small = np.partition(small, 2 * SIZE)[:2 * SIZE]
        return np.unique(np.concatenate([self.sketch, small]))[:SIZE]


def fingerprint(text: str | None) -> np.ndarray:
    p = Parse()
    p.feed(text or "")
    return p.signature()


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard index of two phrase sets: of the SIZE smallest hashes of both,
    the share that both hold."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    distinct = np.concatenate([[True], ~twice])
    rank = np.cumsum(distinct)
    shared = np.count_nonzero(twice & (rank[:-1] <= SIZE))
    return float(shared) / min(SIZE, int(rank[-1]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, int, int]]:
    for b in batches:
        yield from zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                       b.column("bucket").to_pylist(), b.column("guest").to_pylist())


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    before = None
    for doc_id, text, bucket, guest in _rows(batches):
        n = len(text)
        cut = n - n // 4
        parse = Parse()
        parse.feed(text[:cut])
        mark = parse.mark()
        parse.feed(text[cut:])
        print_ = parse.signature()
        if before is not None and before[1] == bucket:
            out.append(_finish(before, text, print_))
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
                out = []
        before = None if guest else (doc_id, bucket, text, cut, parse, mark, print_)
    if out:
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def _finish(row: tuple, next_text: str, next_print: np.ndarray) -> tuple:
    doc_id, _, text, cut, parse, mark, own = row
    tail = next_text[:len(text) - cut]
    if not parse.back(mark):
        parse = Parse()
        parse.feed(text[:cut])
    parse.feed(tail)
    edited = parse.signature()
    sha = hashlib.sha256((text[:cut] + tail).encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(text), sha, as_text(own), as_text(edited),
            likeness(own, edited), likeness(own, next_print))


def compare_with_next(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next: one row for each row of ``documents``."""
    spark = documents.sparkSession
    n = partitions(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            shown("text").alias("text"))
    key = F.coalesce("doc_id", F.lit(LOWEST))
    shares = F.array(*[F.lit(i / (n * RANGES)) for i in range(1, n * RANGES)])
    bounds = docs.agg(F.percentile_approx(key, shares, 20_000)).collect()[0][0]
    # as many bounds as there are ranges, whatever the number of documents
    starts = np.unique(np.array(bounds or [0], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.to_numpy(np.int64), side="right").astype("int32"))

    ranged = docs.withColumn("bucket", range_of(key))
    firsts = (docs.select(range_of(key).alias("bucket"), key.alias("first"))
              .groupBy("bucket").agg(F.min("first").alias("first")).orderBy("bucket").collect())
    if not firsts:
        return spark.createDataFrame([], SCHEMA)
    # the first document of each range goes to the range before it as well, as a guest
    pairs = [(firsts[i].first, firsts[i - 1].bucket) for i in range(len(firsts))]
    lead = F.broadcast(spark.createDataFrame(pairs, "_first long, bucket int"))
    guests = (docs.join(lead, key == F.col("_first")).groupBy("bucket")
              .agg(F.min("text").alias("text"))
              .select(F.lit(None).cast("long").alias("doc_id"), "text", "bucket", F.lit(1).alias("guest")))
    dealt = (ranged.select("doc_id", "text", "bucket", F.lit(0).alias("guest")).unionAll(guests)
             .repartition(n, "bucket")
             .sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_first(), "text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _compare(batches):
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return dealt.mapInArrow(task, SCHEMA)
