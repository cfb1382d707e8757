"""Alignment against a plain walk over both sides' bytes."""
import hashlib
from collections import Counter

import pytest
from llm_fixtures import SMALL, edge_docs, no_docs  # noqa: F401

from pulsehouse.llm import alignment
from pulsehouse.llm.queries import op12_token_alignment


@pytest.fixture(scope="module")
def plain():
    """The contract's columns by its own words: offsets of every token, all pairs compared."""
    import public_tokenizers as P
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    from tokenizers.decoders import ByteLevel
    from tokenizers.pre_tokenizers import ByteLevel as Letters
    assert sorted(Letters.alphabet()) == sorted(alignment.byte_letters()) and ByteLevel
    letters = alignment.byte_letters()

    def pieces(text):
        a = one.encode(" " + text, add_special_tokens=False)
        b = two.encode(text)
        xa = [bytes(letters[c] for c in t) for t in a.tokens]
        xb = [bytes([int(two.id_to_piece(i)[3:-1], 16)]) if two.is_byte(i)
              else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        return a.ids, xa, b, xb

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    def of(rows):
        told, links = [], Counter()
        for i, text in rows:
            ia, xa, ib, xb = pieces(text) if text else ([], [], [], [])
            if not text or not (b"".join(xa) == b"".join(xb) == b" " + text.encode()):
                told.append((i, 0, 0, 0, [], ""))
                continue
            sa, sb = spans(xa), spans(xb)
            own, j0 = [], 0
            for k, (s, e) in enumerate(sa):
                while sb[j0][1] <= s:
                    j0 += 1
                j = j0
                while j < len(sb) and sb[j][0] < e:
                    own.append((ia[k], ib[j]))
                    j += 1
            links.update(own)
            ends = sorted({e for _, e in sa} & {e for _, e in sb})
            groups, before = [], 0
            for e in ends:
                left = [str(x) for x, (_, t) in zip(ia, sa) if before < t <= e] if len(ia) < 400 else None
                groups.append((before, e, left))
                before = e
            ga, gb = Counter(), Counter()
            import bisect
            parts = [([], []) for _ in ends]
            for x, (_, t) in zip(ia, sa):
                parts[bisect.bisect_left(ends, t)][0].append(str(x))
            for x, (_, t) in zip(ib, sb):
                parts[bisect.bisect_left(ends, t)][1].append(str(x))
            text_of = ";".join(",".join(p) + "|" + ",".join(q) for p, q in parts)
            assert not ga and not gb
            told.append((i, len(ia), len(ib), len(ends), own, hashlib.sha256(text_of.encode()).hexdigest()))
        most = Counter()
        for (_, b), n in links.items():
            most[b] = max(most[b], n)
        return sorted(((i, na, nb, ng, len(own), sum(links[p] == most[p[1]] for p in own),
                        sum(links[p] for p in own), sha) for i, na, nb, ng, own, sha in told), key=str)
    return of


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edge_rows(spark, edge_docs, plain):  # noqa: F811
    more = spark.createDataFrame([(20, "marker ▁ inside"), (21, "<|endoftext|> </s> plain"), (22, "a\x00b\n\n  \t c"),
                                  (23, " "), (24, "ﬁ é 漢字🙂"), (25, "▁")], "doc_id long, text string")
    docs = edge_docs.select("doc_id", "text").unionAll(more)
    assert found(alignment.aligned(docs, digests=True)) == plain(docs.collect())


def test_extra_columns_and_groups(edge_docs):  # noqa: F811
    rows = alignment.aligned(edge_docs.withColumn("block", edge_docs.doc_id).withColumn("pairs", edge_docs.doc_id)
                             .where("doc_id = 7")).collect()
    assert len(rows) == 1 and rows[0]["groups"].count(";") == rows[0]["n_groups"] - 1 and rows[0]["n_groups"] > 0


def test_blocks_add_up(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 500)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").repartition(3)
    docs = docs.unionAll(docs)
    assert found(alignment.aligned(docs, digests=True)) == plain(docs.collect())


def test_empty_table(no_docs):  # noqa: F811
    assert alignment.aligned(no_docs).collect() == []


def test_whole_table(spark, plain):
    got = op12_token_alignment(spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found(got) == plain(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())


def test_ranks_give_the_files_ids(spark):
    side = alignment.ByteSide(alignment.default_bytes())
    assert side.ranks
    texts = [r[0] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += ["\n\n \t x  y'll we've 漢字🙂 <|endoftext|> 1234 ...!!", " ", "  a"]
    fast = side(texts)
    side.ranks = None
    assert fast == side(texts)
