"""Pareto mixing against DuckDB, a plain version, and its promises."""
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_fixtures import edge_docs, no_docs  # noqa: F401

from pulsehouse.llm import mixing


def water_fill(sizes, weights, cap=3):
    total, full, level = sum(sizes), set(), 0.0
    while True:
        rest = [i for i in range(len(sizes)) if i not in full]
        w = sum(weights[i] for i in rest)
        if not w:
            break
        level = (total - sum(cap * sizes[i] for i in full)) / w
        new = {i for i in rest if cap * sizes[i] <= level * weights[i]}
        if not new:
            break
        full |= new
    return [min(level * w, cap * s) for s, w in zip(sizes, weights)]


def plain(rows):
    """The same mix over (doc_id, text, source) in plain Python, one document at a time."""
    import hashlib
    import re
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = [sum(n for n, r in zip(size, rows) if r[2] == s) for s in names]
    target = water_fill(total, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))])
    out = []
    for s, all_words, t in zip(names, total, target):
        ratio = t / all_words if all_words else 0.0
        copies, p = int(ratio), ratio - int(ratio)
        room = t - copies * all_words
        ranked = []
        for (i, text, of), n in zip(rows, size):
            if of == s:
                own = hashlib.md5((text or "").encode()).hexdigest() if i is None else i
                u = (int(hashlib.md5(f"mix:{own}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
                ranked.append((min(int((u * (1 - p)) / (u * (1 - p) + p * (1 - u)) * 2 ** 52), 2 ** 52 - 1) if p else 0, i, n))
        done = 0
        for rank in sorted({r for r, *_ in ranked}):
            unit = [x for x in ranked if x[0] == rank]
            words = sum(n for *_, n in unit)
            take = p > 0 and done + words / 2 <= room
            done += words
            out += [(i, n, all_words, t, n * (copies + take)) for _, i, n in unit]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text", "source").collect()]
    got = sorted((tuple(r) for r in mixing.mix(edge_docs).collect()), key=key)
    assert got == sorted(plain(rows), key=key) and len(got) == 10
    assert mixing.mix(no_docs).count() == 0
    out = mixing.mixed(edge_docs)
    assert out.columns == edge_docs.columns
    assert out.count() == sum(r[4] // r[1] for r in got if r[1]) + sum(
        1 for r in mixing.mixed(edge_docs).collect() if (r.text or "").strip(" \t\n") == "")


def test_random_tables_against_plain_and_duckdb(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join("w" * int(rng.integers(1, 4)) for _ in range(int(rng.integers(0, 60)))),
             None if rng.random() < .1 else f"s{int(rng.integers(0, 9)) ** 2}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in mixing.mix(df).collect()), key=key)
    assert got == sorted(plain(rows), key=key)
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(mixing.ORACLE.format(documents="docs")).fetchall(), key=key) == got
    targets, taken, largest = {}, {}, {}
    source = {i: s for i, _, s in rows}
    for i, n, _, t, k in got:
        s = source[i]
        targets[s], taken[s] = t, taken.get(s, 0) + k
        largest[s] = max(largest.get(s, 0), n)
        assert k <= 3 * n
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in targets)
    assert sum(targets.values()) == pytest.approx(sum(r[1] for r in got))


def test_pareto_ranks_keep_inclusion_probabilities(spark):
    """The n lowest ranks hold units about as often as their probabilities say."""
    p = np.array([0.9, 0.7, 0.5, 0.3, 0.3, 0.2, 0.1])
    df = spark.range(len(p) * 4000).select(
        (F.col("id") % len(p)).alias("unit"), F.floor(F.col("id") / len(p)).alias("draw"),
        mixing.draw("id").alias("u"))
    probs = F.element_at(F.array(*[F.lit(float(x)) for x in p]), (F.col("unit") + 1).cast("int"))
    rows = df.select("unit", "draw", mixing.pareto_rank(F.col("u"), probs).alias("rank")).toPandas()
    taken = rows.sort_values("rank").groupby("draw").head(3)
    assert taken.groupby("unit").size().div(4000).to_numpy() == pytest.approx(p, abs=0.04)


def test_targets_at_the_cap(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 90)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got["a"] == 30 and got["c"] == 0 and sum(got.values()) == pytest.approx(1100)
    assert [got[s] for s in ("a", "b", "c", None)] == pytest.approx(water_fill([10, 1000, 0, 90], [5., 2., 1., 5.]))


def test_rows_without_ids_are_drawn_one_by_one(spark):
    rows = [(None, f"{i} b c d", "a") for i in range(100)] + [(i, "one two three four", "b") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(got) == 2 and all(abs(r.taken - r.target) <= 2 for r in got)
    assert 0 < got[0].target % got[0].source_size
