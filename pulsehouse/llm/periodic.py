"""Periodic runs of words in documents.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of
at least ``max(LEAST, 2 * q)`` words that no neighbouring word extends. The words of a run
behind its first q words are repetitions, which ``collapsed`` leaves out.

1. Only stretches that can hold a run are looked at. With LEAST = 12 each word of a run lies
   in six consecutive words that stand in the run a second time, q words on or back, as at
   least six words remain beside one period. So words outside all repeated six-grams are in
   no run; what they leave is cut into stretches, and the same is asked of each stretch by
   itself until nothing more goes. Equal hashes only make stretches longer.
2. A stretch and its reversal get a suffix tree each by Ukkonen's construction. An Euler
   tour of string depths with range minima gives the longest common extension of any two
   places forwards and backwards in constant time.
3. Every run has a period that is a longest Lyndon word at its place, in the order of the
   words or in the reverse order. The Lyndon words come from the next smaller suffix of each
   place, by the order of the tree's leaves. Each is extended both ways by its length; what
   is at least twice as long as the word is a run, and no run is missed.

Defined results: words are runs of other bytes than space, tab, line feed, vertical tab, form
feed and carriage return; a null text is empty and has no words, no runs and an empty
``collapsed``. Repeated rows and rows without doc_id stay. Other columns are not read. An
empty table gives an empty result. A document's runs are found in one task; memory there
grows with the longest stretch of repeated words (about 1 kB a word), not with the
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.bagminhash import mix
from pulsehouse.llm.common import give_back, shown
from pulsehouse.llm.neardup import text_slices

#: Words of the shortest run.
LEAST = 12
_BLOCK = 32


def repeated_stretches(words: np.ndarray, owner: np.ndarray, gram: int = LEAST // 2
                       ) -> list[tuple[int, int]]:
    """[start, stop) of the stretches of one owner's words that can hold runs. ``words``:
    any numbers, equal for equal words; ``owner``: ascending."""
    at, owner = np.arange(len(words)), owner.astype(np.int64)
    while len(at):
        w, n = words[at].astype(np.uint64), len(at) - gram + 1
        if n < 1:
            return []
        value = owner[:n].astype(np.uint64)
        for k in range(gram):
            value = mix(value * np.uint64(3) + w[k:k + n])
        inside = np.flatnonzero(owner[:n] == owner[gram - 1:])
        value = value[inside]
        order = np.argsort(value, kind="stable")
        same = value[order][1:] == value[order][:-1]
        twice = np.zeros(len(value), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        change = np.zeros(len(at) + 1, dtype=np.int64)
        change[inside[twice]] += 1
        change[inside[twice] + gram] -= 1
        keep = np.cumsum(change[:-1]) > 0
        # neighbours among the kept words belong together if nothing went between them
        index = np.flatnonzero(keep)
        if not len(index):
            return []
        new = np.ones(len(index), dtype=bool)
        new[1:] = (np.diff(index) > 1) | (owner[index][1:] != owner[index][:-1])
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch)[stretch] >= LEAST
        kept_at, stretch = at[index[long]], stretch[long]
        if len(kept_at) == len(at):
            first = np.flatnonzero(np.diff(stretch, prepend=-1))
            stops = np.append(first[1:], len(kept_at))
            return [(int(kept_at[i]), int(kept_at[j - 1]) + 1) for i, j in zip(first, stops)]
        at, owner = kept_at, stretch
    return []


def suffix_tree(s: list[int], width: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Ukkonen's suffix tree of ``s``, whose last letter occurs nowhere else: the [start,
    stop) of each node's edge label, and the child of each ``node * width + letter``."""
    n = len(s)
    start, stop, link, child = [0], [0], [0], {}
    node = place = length = open_ = 0
    for i, letter in enumerate(s):
        open_ += 1
        inner = 0                      # made in this step, its link still to come
        while open_:
            if not length:
                place = i
            key = node * width + s[place]
            down = child.get(key)
            if down is None:
                child[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if inner:
                    link[inner] = node
                    inner = 0
            else:
                span = min(stop[down], i + 1) - start[down]
                if length >= span:
                    node, place, length = down, place + span, length - span
                    continue
                middle = start[down] + length
                if s[middle] == letter:
                    if inner:
                        link[inner] = node
                    length += 1
                    break
                fork = len(start)
                start += (start[down], i)
                stop += (middle, n)
                link += (0, 0)
                child[key] = fork
                child[fork * width + letter] = fork + 1
                start[down] = middle
                child[fork * width + s[middle]] = down
                if inner:
                    link[inner] = fork
                inner = fork
            open_ -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                place = i - open_ + 1
    return start, stop, child


class Extensions:
    """Longest common extensions of the places of a list of letters (numbers from 1), and the
    order of its suffixes, in the letters' order and in the reverse one."""

    def __init__(self, letters: list[int], width: int) -> None:
        s = [*letters, 0]
        start, stop, child = suffix_tree(s, width)
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        below = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        del child
        order = np.argsort(keys)
        self._parts = np.array(start), np.array(stop), keys[order] // width, keys[order] % width, below[order]
        self.n = len(s)
        self._tour()

    def _tour(self) -> None:
        start, stop, parent, letter, below = self._parts
        first = np.searchsorted(parent, np.arange(len(start) + 1)).tolist()
        below, length, n = below.tolist(), (stop - start).tolist(), self.n
        tour, place = [], [0] * n
        depth = [0] * len(start)
        todo = [0]
        while todo:
            v = todo.pop()
            if v < 0:                  # back from a child
                tour.append(depth[~v])
                continue
            d, i, j = depth[v], first[v], first[v + 1]
            tour.append(d)
            if i == j:
                place[n - d] = len(tour) - 1
            for c in reversed(below[i:j]):
                depth[c] = d + length[c]
                todo += (~v, c)
        self.place = np.array(place)
        self._minima(np.array(tour, dtype=np.int32))

    def _minima(self, tour: np.ndarray) -> None:
        """Minima from each block's edges, and over powers of two of whole blocks."""
        blocks = np.full(-(-len(tour) // _BLOCK) * _BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        blocks[:len(tour)] = tour
        self.tour, blocks = blocks, blocks.reshape(-1, _BLOCK)
        self.up_to = np.minimum.accumulate(blocks, axis=1).ravel()
        self.from_ = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while 2 ** len(self.table) <= len(blocks):
            row, half = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(row[:-half], row[half:]))

    def order(self) -> np.ndarray:
        """The rank of each suffix; a suffix is smaller than those that it begins."""
        rank = np.empty(self.n, dtype=np.int64)
        rank[np.argsort(self.place)] = np.arange(self.n)
        return rank

    def reverse_order(self) -> np.ndarray:
        """The same under the reverse order of letters; the end stays the smallest."""
        start, stop, parent, letter, below = self._parts
        first = np.searchsorted(parent, np.arange(len(start) + 1)).tolist()
        ending = (letter == 0).tolist()
        below, length, n = below.tolist(), (stop - start).tolist(), self.n
        found, todo = [], [(0, 0)]
        while todo:
            v, d = todo.pop()
            i, j = first[v], first[v + 1]
            if i == j:
                found.append(n - d)
                continue
            end = ending[i]
            todo += [(c, d + length[c]) for c in below[i + end:j]]
            if end:
                todo.append((below[i], d + length[below[i]]))
        rank = np.empty(n, dtype=np.int64)
        rank[found] = np.arange(n)
        return rank

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters from places a and b on are equal; a != b, up to the list's end."""
        one, two = self.place[a], self.place[b]
        lo, hi = np.minimum(one, two), np.maximum(one, two)
        left, right = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.from_[lo], self.up_to[hi])
        gap = right - left - 1
        far = np.flatnonzero(gap > 0)
        level = np.frexp(gap[far])[1] - 1
        for k in np.unique(level):
            at = far[level == k]
            row = self.table[k]
            out[at] = np.minimum(out[at], np.minimum(row[left[at] + 1], row[right[at] - 2 ** int(k)]))
        near = np.flatnonzero(gap < 0)
        lo, hi = lo[near], hi[near]
        least = self.tour[lo]
        for k in range(1, _BLOCK):
            least = np.minimum(least, self.tour[np.minimum(lo + k, hi)])
        out[near] = least
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """The next place with a smaller rank, or the last place."""
    rank, n = rank.tolist(), len(rank)
    out = [n - 1] * n
    for i in range(n - 2, -1, -1):
        j, own = i + 1, rank[i]
        while rank[j] > own:
            j = out[j]
        out[i] = j
    return np.array(out)


def runs_of(letters: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of numbers from 1, in order."""
    n = len(letters)
    if n < least:
        return []
    width = max(letters) + 1
    ahead = Extensions(letters, width)
    orders = [ahead.order(), ahead.reverse_order()]
    back = Extensions(letters[::-1], width)
    found = []
    for rank in orders:
        # the end's suffix is the smallest, so every place has a next smaller one
        i, j = np.arange(n), next_smaller(rank)[:n]
        fits = 2 * (j - i) <= n
        i, j = i[fits], j[fits]
        start = i - back(n - i, n - j)
        stop = j + ahead(i, j)
        found.append(np.stack([start, stop - start, j - i], axis=1))
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] >= np.maximum(least, 2 * rows[:, 2])]
    return [tuple(x) for x in np.unique(rows, axis=0).tolist()]


def runs_of_documents(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, given as a list of words."""
    counts = [len(d) for d in documents]
    total, found = sum(counts), [[] for _ in documents]
    if not total:
        return found
    words = np.fromiter((hash(w) for d in documents for w in d), dtype=np.int64, count=total).view(np.uint64)
    owner = np.repeat(np.arange(len(documents)), counts)
    begin = np.cumsum(counts) - counts
    for start, stop in repeated_stretches(words, owner):
        d = int(owner[start])
        start, stop = start - int(begin[d]), stop - int(begin[d])
        number: dict[bytes, int] = {}
        letters = [number.setdefault(w, len(number) + 1) for w in documents[d][start:stop]]
        found[d] += [(s + start, length, q) for s, length, q in runs_of(letters)]
    return found


def without_repetitions(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    gone = np.cumsum(change)[:-1] > 0
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


def find_runs(documents: DataFrame) -> DataFrame:
    """doc_id, runs (by start, then period), collapsed (the text without repetitions, its
    words with one space between): one row for each row of ``documents``."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b, texts in text_slices(whole):
                words = [t.encode().split() for t in texts]
                runs = [sorted(r, key=lambda x: (x[0], x[2])) for r in runs_of_documents(words)]
                kept = [b" ".join(without_repetitions(w, r)).decode() for w, r in zip(words, runs)]
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pa.record_batch({"doc_id": b.column("doc_id"), "runs": pa.array(rows, kind),
                                       "collapsed": pa.array(kept, pa.string())})
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shown().alias("text"))
    return rows.mapInArrow(task, "doc_id long, runs array<struct<start: long, length: long, period: long>>, "
                                 "collapsed string")


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """doc_id, text: of a tenth of the documents (by the crc32 h of the id) the words from
    a = g % n on repeat with period p = 1 + (n - a) // (3 + g % 8), g = h // 10. A row
    without doc_id keeps its text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), shown().alias("text"))
            .withColumn("g", F.when(h % 10 == 0, F.floor(h / 10)))
            .withColumn("words", F.when(F.col("g").isNotNull(), words))
            .withColumn("n", F.size("words"))
            .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
            .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    a, p = F.col("a"), F.col("p")
    again = F.transform(F.slice("words", a + 1, F.col("n") - a),
                        lambda w, i: F.element_at("words", a + 1 + i % p))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), again), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; ties: smallest
    start, then period), runs_sha256, collapsed_sha256."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return (found.withColumn("best", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
                    F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
