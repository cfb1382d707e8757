"""The chunk table against the library on whole texts."""
import hashlib
import random

import pytest
from llm_fixtures import MIDDLE, edge_docs, no_docs  # noqa: F401

from pulsehouse.llm import chunktable
from pulsehouse.llm.queries import op11_sentencepiece

ODD = ["", " ", "  ", "a", " a", "a ", "▁", "▁a", "a▁b ▁", " ▁ ▁▁ x", "a\x00b", "a b  c\td\n e ", "<s> </s> <0x0A> <unk>",
       "é ß 漢字🙂  x y", "ﬁ ﬁ Å", "x" * 5000, "   " * 700, "\n\n\n  \t "]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=chunktable.default_model())


def test_model_splits_at_markers(library):
    assert chunktable.splits_at_markers(library)


def test_models_that_do_not_split_go_whole(library):
    class Crossing:
        def __len__(self):
            return len(library)

        def id_to_piece(self, i):
            return "a▁b" if i == 500 else library.id_to_piece(i)

        def is_byte(self, i):
            return library.is_byte(i)
    assert not chunktable.splits_at_markers(Crossing())
    table = chunktable.ChunkTable(chunktable.default_model())
    table.by_chunk = False
    assert [x.tolist() for x in table(ODD)] == library.encode(ODD)


@pytest.mark.parametrize("kept", [400_000, 3])
def test_ids_are_the_librarys(library, kept):
    random.seed(5)
    letters = "ab e▁\n\t.1é漢<>x  "
    texts = ODD + ["".join(random.choice(letters) for _ in range(random.randint(0, 90))) for _ in range(1500)]
    table = chunktable.ChunkTable(chunktable.default_model(), kept)
    for s in range(0, len(texts), 70):      # the table is kept, or begun anew, between calls
        assert [x.tolist() for x in table(texts[s:s + 70])] == library.encode(texts[s:s + 70])


def test_each_distinct_chunk_is_segmented_once(library):
    class Counting:
        asked: list = []

        def __getattr__(self, name):
            return getattr(library, name)

        def encode(self, texts, **kw):
            self.asked += texts
            return library.encode(texts, **kw)
    table = chunktable.ChunkTable(chunktable.default_model())
    table.processor = Counting()
    table(["to be or not to be", "be to  be"])
    table(["not to"])
    assert sorted(Counting.asked) == sorted(["to", "be", "or", "not", "▁be"])


def plain(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edge_rows(library, edge_docs):  # noqa: F811
    got = chunktable.digest(chunktable.encode(edge_docs)).collect()
    assert sorted(map(tuple, got), key=str) == plain(library, edge_docs.select("doc_id", "text").collect())


def test_empty_table(no_docs):  # noqa: F811
    assert chunktable.encode(no_docs).collect() == []


def test_whole_table(spark, library):
    got = op11_sentencepiece(spark, MIDDLE)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect()), key=str) == plain(library, rows)
