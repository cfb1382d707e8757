"""BagMinHash signatures of multisets, vectorised over many documents.

Every element carries a Poisson process over time and weight. Weights are whole numbers,
discretised into unit cells that are grouped into intervals [0, 1), [1, 2), [2, 4),
[4, 8), ... An interval of length L has one process with rate ``m * L``, whose points are
drawn in order of time from hashes of (element, interval, number of the point); a point
falls on one of ``m`` components and, by the leading bits of its hash, into one of the
interval's halves, quarters and so on down to a cell. An element of weight w sees the
points in cells below w, so two documents agree on all points in the cells that both have.
A component's value is the document's earliest point there; two documents have the same
value with probability sum(min) / sum(max), their weighted Jaccard index.

Points are drawn only up to a time limit, chosen from the document's total weight so that
nearly all components have a point by then; for a document with an empty component the
limit is doubled. So a document costs about its number of elements plus m log m points.
"""

from __future__ import annotations

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers, in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _processes(element: np.ndarray, weight: np.ndarray, doc: np.ndarray):
    """(seed, low end, length, weight, doc) of each element's intervals below its weight."""
    seeds, lows, lengths, weights, docs = [], [], [], [], []
    level, low, length = 0, 0, 1
    at = np.arange(len(element))
    while len(at):
        seeds.append(mix(element[at] + np.uint64((level + 1) * int(_GOLD) & (2 ** 64 - 1))))
        lows.append(np.full(len(at), low, dtype=np.int64))
        lengths.append(np.full(len(at), length, dtype=np.int64))
        weights.append(weight[at])
        docs.append(doc[at])
        level, low, length = level + 1, low + length, low + length
        at = at[weight[at] > low]
    return tuple(map(np.concatenate, (seeds, lows, lengths, weights, docs)))


def signatures(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, docs: int,
               m: int) -> np.ndarray:
    """(docs, m) unsigned 32-bit signatures. ``element``: distinct 64-bit hashes in each
    document, ``weight`` >= 1 their counts, ``doc`` their document's number. A document
    without elements gets zeros."""
    out = np.zeros((docs, m), dtype=np.uint32)
    total = np.bincount(doc, weights=weight, minlength=docs)
    todo = np.flatnonzero(total > 0)
    limit = np.zeros(docs)
    limit[todo] = (np.log(m) + 2.0) / total[todo]
    seed, low, length, high, owner = _processes(element, weight, doc)
    while len(todo):
        number = np.full(docs, -1)
        number[todo] = np.arange(len(todo))
        mine = np.flatnonzero(number[owner] >= 0)
        best = np.full(len(todo) * m, np.inf)
        value = np.zeros(len(todo) * m, dtype=np.uint32)
        time = np.zeros(len(mine))
        first, wide = 0, 4
        found = []
        while len(mine):
            count = np.arange(first, first + wide, dtype=np.uint64)[:, None]
            h = mix(seed[mine][None, :] + (count + np.uint64(1)) * _GOLD)
            gaps = -np.log((h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54)
            gaps /= m * length[mine]
            x = np.cumsum(gaps, axis=0) + time
            near = x <= limit[owner[mine]]
            k, j = np.nonzero(near)
            p = mine[j]
            pick = mix(h[k, j])
            cell = low[p] + (((pick & np.uint64(0xFFFFFFFF)) * length[p].astype(np.uint64))
                             >> np.uint64(32)).astype(np.int64)
            ok = cell < high[p]
            where = number[owner[p]] * m + ((pick >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            found.append((where[ok], x[k, j][ok], (h[k, j] >> np.uint64(32)).astype(np.uint32)[ok]))
            on = near[-1]
            time, mine = x[-1][on], mine[on]
            first, wide = first + wide, 32 if len(mine) < 20_000 else 4
        where, when, what = map(np.concatenate, zip(*found)) if found else (np.zeros(0, int),) * 3
        np.minimum.at(best, where, when)
        first_at = when == best[where]
        value[where[first_at]] = what[first_at]
        full = np.isfinite(best).reshape(len(todo), m).all(axis=1)
        out[todo[full]] = value.reshape(len(todo), m)[full]
        todo = todo[~full]
        limit[todo] *= 2
    return out
