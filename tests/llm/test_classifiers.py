"""Toxicity and quality: held-out accuracy, block-wise scoring, edge rows."""
import zlib

import numpy as np
import pytest
from llm_fixtures import SMALL, edge_docs, no_docs  # noqa: F401

from pulsehouse.llm import quality, queries, toxicity
from pulsehouse.llm.common import pieces

MIDDLE = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def held_out(spark, query, label, modulus, rest):
    got = {r.doc_id: r for r in query(spark, MIDDLE).collect()}
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == rest) for i, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())
    test = [i for i, r in got.items() if r.held_out and i in marks]
    return got, np.array([got[i].predicted for i in test]), np.array([marks[i] for i in test])


def test_toxicity_on_held_out_labels(spark):
    got, said, true = held_out(spark, queries.op1_toxicity, "toxic", 5, 0)
    assert len(got) == 1000 and (said == true).mean() > 0.93
    assert said[true == 0].mean() < 0.05


def test_quality_on_held_out_labels(spark):
    got, said, true = held_out(spark, queries.op7_quality, "quality", 4, 2)
    assert len(got) == 1000 and (said == true).mean() > 0.95


def toy(module):
    rng = np.random.default_rng(0)
    bad, good = ["vile scum!!", "utter scum!!"], ["a kind word", "some plain words here"]
    texts = [" ".join(rng.choice(good, 8)) + (" " + rng.choice(bad) if i % 2 else "") for i in range(60)]
    return module.fit(texts, np.arange(60) % 2, np.ones(60))


def test_toxicity_fit_and_plain_scoring():
    model = toy(toxicity)
    table = model.table()
    texts = ["a kind word", "utter scum!!", None, "", "kind " * 3 + "vile scum!!"]
    got = toxicity.score_texts(texts, len(texts), model, table)
    plain = [1 / (1 + np.exp(-(table[toxicity.distinct_bins(t)].sum() + model.intercept))) for t in texts]
    assert got == pytest.approx(plain)
    assert got[1] > 0.5 > got[0] and got[2] == got[3] and got[4] > 0.5


def test_a_text_cut_in_blocks_scores_as_a_whole(monkeypatch):
    text = "a kind word and some plain words here " * 40 + "vile scum!!"
    tox, qual = toy(toxicity), toy(quality)
    whole = toxicity.score_texts([text, "x"], 2, tox, tox.table()), quality.score_texts([text, "x"], 2, qual)
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    monkeypatch.setattr(quality, "BLOCK", 64)
    cut = quality.score_texts([text, "x"], 2, qual)
    assert cut == pytest.approx(whole[1], abs=0.02)
    # a cut adds a blank at either side of a piece, which may add n-grams but loses none
    assert (toxicity.score_texts([text, "x"], 2, tox, tox.table())[0] > 0.5) == (whole[0][0] > 0.5)


def test_quality_features_stay_inside_words():
    where, bins = quality.features(quality._codes("ab  ab\tab"))
    # three words, two repeats; n-grams: 2: _a ab b_, 3: _ab ab_, 4: _ab_ (ends included)
    assert len(where) == 3 + 2 + 3 * 3 + 3 * 2
    assert (bins == quality.REPEAT).sum() == 2


@pytest.mark.parametrize("module", [toxicity, quality])
def test_one_class_or_no_labels(module):
    for labels in ([], [1, 1], [0]):
        model = module.fit(["some text"] * len(labels), np.array(labels), np.ones(len(labels)))
        args = (["x", ""], 2, model) + ((model.table(),) if module is toxicity else ())
        share = sum(labels) / len(labels) if labels else 0
        assert module.score_texts(*args) == pytest.approx([share, share], abs=1e-6)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edge_rows(spark, edge_docs, no_docs, module):
    marks = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)], LABELS)
    label = "toxic" if module is toxicity else "quality"
    model = module.train(edge_docs, marks, label, chars=10_000_000)
    rows = module.score(edge_docs, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1      # null text, empty text
    assert module.score(no_docs, model).count() == 0
    keep = module.keep_clean if module is toxicity else module.keep_good
    assert keep(edge_docs, model).columns == edge_docs.columns
    both = keep(edge_docs, model, 2.0 if module is toxicity else -1.0)
    assert both.count() == 10
    none = module.train(no_docs, marks.limit(0), label)
    assert {r.predicted for r in module.score(edge_docs, none).collect()} == {0}


def test_sample_is_bounded_and_stands_for_all(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(200)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0), 0) for i in range(200)], LABELS)
    rows = toxicity.training_rows(docs, marks, "quality", marks.doc_id >= 0, 20, 10_000).collect()
    by = {k: [r for r in rows if r._label == k] for k in (0, 1)}
    assert len(by[0]) == len(by[1]) == 20
    assert sum(r._stands_for for r in by[0]) == pytest.approx(150)
    assert sum(r._stands_for for r in by[1]) == pytest.approx(50)


def test_sample_is_bounded_by_characters_and_takes_long_texts(spark):
    # label 1 has one text of 900 characters, repeated, and one of 5,000
    docs = spark.createDataFrame([(i, "x" * 9 + str(i)) for i in range(100)] + [(200, "y" * 900)] * 30
                                 + [(201, "z" * 5000), (202, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 0, 0) for i in range(100)] + [(200, 1, 0)] * 50 + [(201, 1, 0), (202, 1, 0)], LABELS)
    rows = toxicity.training_rows(docs, marks, "quality", marks.doc_id >= 0, 60, 1000).collect()
    by = {k: [r._text for r in rows if r._label == k] for k in (0, 1)}
    assert 55 <= len(by[0]) <= 60 and len(set(by[0])) == len(by[0])
    assert sorted(by[1], key=str) == [None, "y" * 900]
    few = toxicity.training_rows(docs, marks, "quality", marks.doc_id >= 0, 60, 100).collect()
    assert 8 <= sum(r._label == 0 for r in few) <= 10 and [r._text for r in few if r._label == 1] == [None]


def mixed_up(h, order):
    return ((h + order) * 0x9E3779B1 & 0xFFFFFFFF) >> 12


def test_toxicity_scores_are_those_of_a_plain_sum():
    model = toy(toxicity)
    weight = dict(zip(model.bins.tolist(), model.weights.tolist()))
    texts = ["a kind word\tUTTER scum!!", "", None, "x", "some plain words here vile scum!! \U0001F600"]
    want = []
    for t in texts:
        shown, found = f" {(t or '').lower()} ".replace("\t", " "), set()
        for order in (3, 4, 5, 6):
            for i in range(len(shown) - order + 1):
                h = 0x811C9DC5
                for c in shown[i:i + order]:
                    h = (h ^ ord(c)) * 0x01000193 & 0xFFFFFFFF
                    h ^= h >> 15
                found.add(mixed_up(h, order))
        want.append(1 / (1 + np.exp(-sum(weight.get(b, 0.0) for b in found) - model.intercept)))
    assert toxicity.score_texts(texts, len(texts), model, model.table()) == pytest.approx(want, abs=1e-6)


def test_toxicity_recall_of_held_out_rows(spark):
    """Fitted as op1 fits, on the largest table: at least 0.9 of toxic rows, at most 1% of others."""
    d = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.toxic is not None}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in marks}
    learn = sorted(i for i in marks if i in texts and not held[i])
    model = toxicity.fit([texts[i] or "" for i in learn], np.array([marks[i] for i in learn]), np.ones(len(learn)))
    test = [i for i in marks if i in texts and held[i]]
    said = toxicity.score_texts([texts[i] for i in test], len(test), model, model.table()) >= 0.5
    true = np.array([marks[i] for i in test]) == 1
    assert said[true].mean() >= 0.9 and said[~true].mean() <= 0.01


def test_pieces_cover_texts_once():
    texts = ["abc def " * 30, "", None, "x" * 100, "q"]
    for at_space in (True, False):
        joined = {}
        for group in pieces(texts, 17, at_space=at_space):
            for row, piece, last in group:
                joined[row] = joined.get(row, "") + piece
        assert [joined[i] for i in range(5)] == [t or "" for t in texts]


def test_smoke_on_smallest(spark):
    assert queries.op1_toxicity(spark, SMALL).count() == queries.op7_quality(spark, SMALL).count() == 200
