"""Alignment of two tokenizers' tokens over the same bytes.

Side A is a byte-level vocabulary over a space and the text, side B a piece vocabulary over
the text, before which it puts a space itself. Both sides' tokens cover the same bytes, each
from a start offset to an end offset. For a batch of documents a ``merge_asof`` keyed by
document finds for the start of each token the other side's token that covers it; the union
of both directions holds every pair of overlapping tokens (a link) once, as of two tokens
that overlap one starts inside the other. Where tokens of both sides end at one offset, a
group ends.

How often a pair of ids is linked in the corpus is counted in two steps: tasks count the
pairs of a block of documents, and the blocks' counts are added up by pair. The corpus
counts go back to the blocks by a join on the pair, with one row for each block and pair
that occurs in it, so a pair that every document holds has one row a block. The documents of
a block meet its counts in one group, bounded by ``BLOCK`` characters and one text.

Defined results: a text that is null, empty, or whose tokens' bytes differ from a space and
the text (a piece vocabulary reads the marker character as a space) has no tokens: zeros,
and '' for the groups. Special tokens' strings in a text are plain text. Repeated rows and
rows without doc_id stay and count. Other columns are not read. An empty table gives an
empty result. Texts are taken whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.chunktable import MARK, chunk_table, default_model
from pulsehouse.llm.common import give_back, shown
from pulsehouse.llm.neardup import text_slices
from pulsehouse.session import scratch_dir

#: Characters of the documents whose pairs are counted together.
BLOCK = 4 << 20
#: What follows an id among a document's groups: an id of its side, side B, the next group.
SIGNS = ",|;"


def default_bytes() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level entry stands for: printable Latin-1
    characters are themselves, all other bytes in order are the letters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """The bytes of each id and their number, and the ids of texts."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = entries
        self.lengths = np.array([len(e) for e in entries], dtype=np.int64)
        # the decimal id and a sign, zero bytes behind it: one row for each of SIGNS
        self.decimals = np.array([[f"{i}{s}" for i in range(len(entries))] for s in SIGNS], dtype="S")

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


def by_rank(path: str, letters: dict[str, int]):
    """The vocabulary as a table of ranks, if that gives the same ids; else None.

    A table of ranks joins two neighbours if their bytes are an entry, a vocabulary file only
    if it lists this very pair. When every entry, spelt in bytes, is joined to itself by the
    file's rules, both are the same: neighbours whose bytes are an entry, not joined with
    others before, have come from the entry's own rules, and its last rule joins them."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    made = json.loads(Path(path).read_text(encoding="utf-8"))
    model, cut = made["model"], made["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or ()]
    entries = [e for e, _ in sorted(model["vocab"].items(), key=lambda x: x[1]) if set(e) <= set(letters)]
    special = {x["content"] for x in made["added_tokens"]}
    entries = [e for e in entries if e not in special]
    if not (model["type"] == "BPE" and made["normalizer"] is None and not model.get("dropout")
            and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
            and [model["vocab"][e] for e in entries] == list(range(len(entries)))
            and ["".join(m) for m in merges] == entries[256:]):
        return None
    bare = Tokenizer.from_str(json.dumps(made | {"pre_tokenizer": None, "post_processor": None, "added_tokens": []}))
    if any(len(x.ids) != 1 for x in bare.encode_batch(entries, add_special_tokens=False)):
        return None
    ranks = {bytes(letters[c] for c in e): i for i, e in enumerate(entries)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteSide(Side):
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        letters, vocabulary = byte_letters(), self.tokenizer.get_vocab()
        self.ranks = by_rank(path, letters)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            known = all(c in letters for c in entry)
            entries[i] = bytes(letters[c] for c in entry) if known else entry.encode()
        super().__init__(entries)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        if self.ranks:
            return [self.ranks.encode_ordinary(f" {t}") for t in texts]
        return [e.ids for e in self.fast([f" {t}" for t in texts], add_special_tokens=False)]


class PieceSide(Side):
    def __init__(self, path: str) -> None:
        self.table = chunk_table(path)
        p = self.table.processor
        super().__init__([bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i)
                          else p.id_to_piece(i).replace(MARK, " ").encode() for i in range(len(p))])

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [x.tolist() for x in self.table(texts)]


@lru_cache(maxsize=2)
def sides(bytes_path: str, piece_path: str) -> tuple[ByteSide, PieceSide]:
    """One pair for each worker process."""
    return ByteSide(bytes_path), PieceSide(piece_path)


def tokens(side: Side, ids: list[list[int]], name: str) -> pd.DataFrame:
    """doc, id, start, end and the token's number: the documents' bytes follow each other,
    so starts ascend over the whole batch."""
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64)
    end = np.cumsum(side.lengths[flat])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), [len(x) for x in ids]),
                         "start": end - side.lengths[flat], f"{name}_end": end, f"{name}_id": flat,
                         name: np.arange(len(flat))})


def covering(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (a, b) of all overlapping tokens of one document, each pair once."""
    to_b = pd.merge_asof(a[["doc", "start", "a"]], b[["doc", "start", "b"]], on="start", by="doc")
    to_a = pd.merge_asof(b[["doc", "start", "b"]], a[["doc", "start", "a"]], on="start", by="doc")
    # of tokens with one start the first direction has told already
    inside = a["start"].to_numpy()[to_a["a"].to_numpy()] < to_a["start"].to_numpy()
    return (np.concatenate([to_b["a"], to_a["a"][inside]]), np.concatenate([to_b["b"], to_a["b"][inside]]))


def grouped(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of A that end where one of B does, and the group of each token of A and B."""
    _, in_a, in_b = np.intersect1d(a["a_end"], b["b_end"], assume_unique=True, return_indices=True)
    groups = []
    for side, at in ((a, in_a), (b, in_b)):
        after = np.zeros(len(side) + 1, dtype=np.int64)
        after[at + 1] = 1
        groups.append(np.cumsum(after)[:-1])
    return in_a, *groups


def align(texts: list[str], one: Side, two: Side, texts_of_groups: bool = True) -> dict[str, list]:
    """For each text n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``: ids in order),
    and its links by pair of ids: ``pairs`` (a id * number of B ids + b id) and ``ns``."""
    full = [i for i, t in enumerate(texts) if t]
    some = [texts[i] for i in full]
    ids_a, ids_b = (one(some), two(some)) if some else ([], [])
    right = [one.joined(x) == two.joined(y) == b" " + t.encode() for x, y, t in zip(ids_a, ids_b, some)]
    full, ids_a, ids_b = ([x for x, ok in zip(xs, right) if ok] for xs in (full, ids_a, ids_b))
    a, b = tokens(one, ids_a, "a"), tokens(two, ids_b, "b")
    doc_a, doc_b, n = a["doc"].to_numpy(), b["doc"].to_numpy(), len(full)
    la, lb = covering(a, b)
    ending, group_a, group_b = grouped(a, b)
    id_a, id_b = a["a_id"].to_numpy(), b["b_id"].to_numpy()
    code = id_a[la] * len(two.entries) + id_b[lb]
    doc = doc_a[la]
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(code)))
    edges = np.searchsorted(doc[at], np.arange(n + 1))
    counts = [np.bincount(x, minlength=n) for x in (doc_a, doc_b, doc_a[ending], doc)]
    out: dict[str, list] = {c: [0] * len(texts) for c in ("n_a", "n_b", "n_groups", "n_links")}
    out |= {"groups": [""] * len(texts), "pairs": [[]] * len(texts), "ns": [[]] * len(texts)}
    if texts_of_groups:
        shown_groups = _groups_shown(one, two, id_a, id_b, group_a, group_b, counts[0] + counts[1])
    for k, i in enumerate(full):
        for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), counts):
            out[c][i] = int(x[k])
        out["pairs"][i], out["ns"][i] = code[at[edges[k]:edges[k + 1]]], times[edges[k]:edges[k + 1]]
        if texts_of_groups:
            out["groups"][i] = shown_groups[k]
    return out


def _groups_shown(one: Side, two: Side, id_a: np.ndarray, id_b: np.ndarray, group_a: np.ndarray,
                  group_b: np.ndarray, counts: np.ndarray) -> list[str]:
    """Each document's groups as text. A token's sign is what follows it there."""
    last = lambda g: np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, dtype=bool)
    kind = np.result_type(one.decimals, two.decimals)
    words = np.concatenate([one.decimals[np.where(last(group_a), 1, 0), id_a].astype(kind),
                            two.decimals[np.where(last(group_b), 2, 0), id_b].astype(kind)])
    words = words[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
    stops = np.cumsum(counts).tolist()
    return [words[i:j].tobytes().replace(b"\0", b"")[:-1].decode() for i, j in zip([0, *stops], stops)]


#: The columns of a document's own row; ``whole`` rows hold the pairs of a block instead.
_ROW = ("block long, whole boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups string, pairs array<long>, ns array<int>")


def _tokenised(documents: DataFrame, bytes_path: str, piece_path: str, digests: bool) -> DataFrame:
    """Rows of documents and, with ``whole``, of blocks, by ``_ROW``."""
    kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
             "groups": pa.string(), "pairs": pa.list_(pa.int64()), "ns": pa.list_(pa.int32())}

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, at = np.unique(np.concatenate([np.zeros(0, np.int64), *[p for p, _ in parts]]), return_inverse=True)
        ns = np.bincount(at, np.concatenate([np.zeros(0, np.int64), *[n for _, n in parts]]), len(pairs))
        return pairs, ns.astype(np.int64)

    def block_row(block: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs, ns = added(parts)
        values = {c: pa.array([None], k) for c, k in kinds.items()}
        values |= {"pairs": pa.array([pairs], kinds["pairs"]), "ns": pa.array([ns], kinds["ns"])}
        return pa.record_batch({"block": pa.array([block], pa.int64()), "whole": pa.array([True]),
                                "doc_id": pa.array([None], pa.int64()), **values})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = sides(bytes_path, piece_path)
        block, held, parts = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for b, texts in text_slices(batch):
                found = align(texts, one, two)
                if digests:
                    found["groups"] = [g and hashlib.sha256(g.encode()).hexdigest() for g in found["groups"]]
                held += sum(map(len, texts))
                parts.append(added(list(zip(found["pairs"], found["ns"]))))
                yield pa.record_batch({
                    "block": pa.array([block] * len(texts), pa.int64()),
                    "whole": pa.array([False] * len(texts)), "doc_id": b.column("doc_id"),
                    **{c: pa.array(found[c], k) for c, k in kinds.items()}})
                if held >= BLOCK:
                    yield block_row(block, parts)
                    block, held, parts = block + 1, 0, []
        if parts:
            yield block_row(block, parts)
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shown().alias("text"))
    return rows.mapInArrow(task, _ROW)


def aligned(documents: DataFrame, bytes_path: str | None = None, piece_path: str | None = None,
            digests: bool = False) -> DataFrame:
    """One row for each row of ``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best (links
    whose pair is, in the corpus, among the most frequent of its B id), count_sum (the corpus
    counts of the links' pairs, added up), groups (with ``digests`` their SHA-256)."""
    bytes_path, piece_path = bytes_path or default_bytes(), piece_path or default_model()
    spark, path = documents.sparkSession, scratch_dir(documents.sparkSession, "alignment")
    # read again below by kind of row, so the two kinds lie in folders of their own
    _tokenised(documents, bytes_path, piece_path, digests).write.partitionBy("whole").parquet(path)
    rows = spark.read.schema(_ROW).parquet(path)
    in_blocks = (rows.where("whole").select("block", F.explode(F.arrays_zip("pairs", "ns")).alias("x"))
                 .select("block", F.col("x.pairs").alias("pair"), F.col("x.ns").alias("n")))
    from sentencepiece import SentencePieceProcessor
    b_ids = len(SentencePieceProcessor(model_file=piece_path))
    counts = in_blocks.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % b_ids)
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    known = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    told = in_blocks.join(known, "pair").select("block", "pair", "count", "best")

    def add_up(own: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("pair")
        flat = lambda c: np.asarray(pa.concat_arrays(x.flatten() for x in own[c].chunks) if own.num_rows else [],
                                    dtype=np.int64)
        pairs, ns = flat("pairs"), flat("ns")
        doc = np.repeat(np.arange(own.num_rows), own["pairs"].combine_chunks().value_lengths().to_numpy(False))
        at = np.searchsorted(known["pair"].to_numpy(), pairs)
        for column, value in (("n_best", "best"), ("count_sum", "count")):
            total = np.zeros(own.num_rows, dtype=np.int64)
            np.add.at(total, doc, ns * known[value].to_numpy()[at].astype(np.int64))
            own = own.append_column(column, pa.array(total))
        return own.select(columns)

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    docs = spark.read.schema(_ROW).parquet(path).where("not whole").drop("whole")
    return docs.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                "count_sum long, groups string")
