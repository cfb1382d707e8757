"""Periodic runs against a plain search of every period."""
import hashlib
import random
import re
import zlib

from llm_fixtures import MIDDLE, edge_docs, no_docs  # noqa: F401

from pulsehouse.llm import periodic
from pulsehouse.llm.queries import op13_periodic_runs


def plain_runs(w, least=12):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                part = w[i:j + q]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def some_words(n, kinds):
    w = [b"%d" % random.randint(1, kinds) for _ in range(n)]
    if n > 20 and random.random() < .6:
        a = random.randrange(n)
        p = random.randint(1, max(1, (n - a) // 3))
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return [b"u%d" % i if random.random() < .02 else x for i, x in enumerate(w)]


def test_runs_of_word_lists():
    random.seed(3)
    for _ in range(400):
        docs = [some_words(random.randint(0, 80), random.choice([1, 2, 2, 3, 6])) for _ in range(3)]
        got = [sorted(r, key=lambda x: (x[0], x[2])) for r in periodic.runs_of_documents(docs)]
        assert got == [plain_runs(w) for w in docs]


def test_long_words_lists():
    random.seed(4)
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    for w in ([b"x"] * 900, [b"%c" % c for c in fib[-1]], [b"%d" % (i * i % 37) for i in range(600)], some_words(900, 2)):
        got = sorted(periodic.runs_of_documents([w])[0], key=lambda x: (x[0], x[2]))
        assert got == plain_runs(w) and got


def test_extensions():
    random.seed(6)
    letters = [random.randint(1, 2) for _ in range(300)]
    e = periodic.Extensions(letters, 3)
    suffixes = sorted(range(301), key=lambda i: letters[i:])
    assert [int(x) for x in e.order().argsort()] == suffixes
    assert [int(x) for x in e.reverse_order().argsort()] == sorted(range(301), key=lambda i: [-x for x in letters[i:]])
    import numpy as np
    a, b = (np.array([random.randint(0, 300) for _ in range(3000)]) for _ in "ab")
    a, b = a[a != b], b[a != b]
    common = [next((k for k in range(301) if max(i, j) + k >= 300 or letters[i + k] != letters[j + k]))
              for i, j in zip(a, b)]
    assert e(a, b).tolist() == common


def plain(rows):
    """The contract's columns by its own words."""
    out = []
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        n = len(w)
        if i is not None and n:
            h = zlib.crc32(str(i).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        runs = sorted(periodic_plain(w), key=lambda x: (x[0], x[2]))
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        out.append((i, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
                    hashlib.sha256(told.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def periodic_plain(w):
    """All runs by comparing the words with themselves, shifted; numpy for long texts."""
    import numpy as np
    number = {}
    v = np.array([number.setdefault(x, len(number)) for x in w])
    found = []
    for q in range(1, len(v) // 2 + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[0], (v[q:] == v[:-q]).astype(int), [0]])))
        for i, j in same.reshape(-1, 2):
            if j - i + q >= max(12, 2 * q):
                part = v[i:j + q]
                if not any((part[r:] == part[:-r]).all() for r in range(1, q) if q % r == 0 or True):
                    found.append((int(i), int(j - i + q), q))
    return found


def test_edge_rows(edge_docs):  # noqa: F811
    docs = edge_docs.where("doc_id is null or doc_id != 4")
    got = periodic.digest(periodic.find_runs(periodic.with_planted_periods(docs)))
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs.select("doc_id", "text").collect())


def test_very_long_text(edge_docs):  # noqa: F811
    row = periodic.find_runs(edge_docs.where("doc_id = 4")).first()
    # word{i % 977} idiot{i % 7}: period 2 * 977 * 7
    assert [tuple(r) for r in row["runs"]] == [(0, 240_000, 2 * 977 * 7)]
    assert len(row["collapsed"].split()) == 2 * 977 * 7


def test_empty_table(no_docs):  # noqa: F811
    assert periodic.digest(periodic.find_runs(periodic.with_planted_periods(no_docs))).collect() == []


def test_whole_table(spark):
    got = op13_periodic_runs(spark, MIDDLE)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    rows = [r for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)
