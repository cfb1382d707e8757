"""Template automata against regular expressions and a plain scan."""
import re

import pytest
from llm_fixtures import edge_docs, no_docs  # noqa: F401

from pulsehouse.llm import licenses
from pulsehouse.llm.licenses import compile_template, words_of


def accepted(template, text):
    a = compile_template(template, "x")
    words = words_of(text)
    return [(i, a.run(words, i)) for i in range(len(words)) if words[i] in a.openers and a.run(words, i)]


def test_words():
    assert words_of("The MIT-License, v2.0 É漢字 x") == [
        w.encode() for w in ["the", "mit", "license", "v2", "0", "É漢字 x"]]
    assert words_of(None) == words_of("") == words_of(" .\n") == []


def test_optional_and_replaceable_regions():
    t = ("licensed <<beginOptional>>by <<beginOptional>>the<<endOptional>> owner<<endOptional>> under "
         "<<var;name=\"x\";words=\"1-2\">> terms")
    assert accepted(t, "Licensed under these terms") == [(0, 4)]
    assert accepted(t, "licensed by the owner under our own terms") == [(0, 8)]
    assert accepted(t, "licensed by owner under our terms") == [(0, 6)]
    assert accepted(t, "licensed by the under our terms") == []
    assert accepted(t, "licensed under terms") == []
    assert accepted(t, "licensed under a b c terms") == []
    digits = "version <<var;name=\"n\";words=\"1-3\";match=\"[0-9]+\">>"
    assert accepted(digits, "version 1 2 3 4 five") == [(0, 4)]
    assert accepted(digits, "version one") == []


@pytest.mark.parametrize("bad", ["<<beginOptional>>a<<endOptional>>", "<<var;name=\"x\">> a",
                                 "a <<beginOptional>> b", "a <<endOptional>> b"])
def test_wrong_templates(bad):
    with pytest.raises(ValueError):
        compile_template(bad, "x")


def plain(text):
    words = [w.decode() for w in words_of(text)]
    out = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return words, out


def test_edge_rows_and_base(spark, edge_docs, no_docs):
    extra = [(50, "MIT License. The mit license; Apache License, Version 2.0; GNU General Public License v3"),
             (51, "Licensed under the Apache License, Version 2.0."), (52, "Licensed under CC BY-NC 4.0."),
             (53, "mit license mit\nLICENSE general public licenses"), (54, "licensed under the apache"),
             (55, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                  "and associated documentation files, to deal in the Software without restriction")]
    docs = edge_docs.select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    got = licenses.digest(licenses.scan(docs)).collect()
    assert len(got) == 16
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        if r.doc_id is None:
            continue
        words, base = plain(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert r.first_word == min((i for i, _ in base), default=None)
        assert r.last_word == max((i for i, _ in base), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r.labels for r in got}
    assert by[50] == "apache,gpl,gpl-notice,mit" and by[51] == "apache,apache-2.0"
    assert by[52] == "creative-commons" and by[53] == "mit" and by[54] == "" and by[55] == "mit-grant"
    assert licenses.digest(licenses.scan(no_docs)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in licenses.digest(licenses.scan(docs)).collect()}
    find = {label: re.compile(r"(?<![0-9a-z\x80-\U0010ffff])" + r"[\x00-/:-`{-\x7f]+".join(p.split())
                              + r"(?![0-9a-z\x80-\U0010ffff])") for p, label in licenses.BASE}
    for r in docs.collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        assert got[r.doc_id].n_base == sum(len(f.findall(low)) for f in find.values())
