"""Cost-balanced packing of documents into sequences.

Documents become token ids and an end id. Each task gathers its documents into groups of
about ``GROUP`` tokens. Within a group there are as many sequences of ``capacity`` tokens
as its tokens fill. A document that is longer than a sequence is first cut into whole
sequences. The rest go by descending length, each to the sequence with the lowest
estimated cost so far (``LINEAR`` for each token and ``SQUARE`` for each pair of tokens in
one document) among those with room for it; if none has room, the document is cut to fill
the cheapest sequence that has any room. What does not fill a whole sequence goes on to the
next group, and at a task's end into sequences whose lengths are powers of two, which need
no padding. So a sequence is always full, and nothing is shuffled.

Defined results: a null text is an empty text and has the end id alone; repeated rows are
packed each; an empty table gives an empty result; other columns are not read. A sequence
id holds the task's partition number above 32 bits, so equal input in equal partitions gives
equal results, also when a task runs again.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import give_back, shown

CAPACITY = 4096
END_ID = 2
#: Tokens of a group.
GROUP = 1 << 18
#: Estimated cost of a token and of a pair of tokens in one document.
LINEAR, SQUARE = 1.0, 1.0 / 2048
#: Words whose ids a worker keeps, unless told otherwise.
KEPT_WORDS = 800_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# How the vocabulary file cuts a text into words, and its letters and
# numbers among the first 256 characters.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]"
                   rf"|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+")
_SPECIAL = re.compile(r"<\|(?:start|end)oftext\|>")


class WordIds:
    """Token ids of a text.

    The library's time goes into words that it has met before. So a text of the first 256
    characters, for which the vocabulary's own rule to cut words is followed here (lower
    case; no character changes under NFC), is cut into words, and the library encodes only
    words that are new, all in one text: a word's ids end with the one id that carries the
    word end. Any other text, texts with special tokens, and all texts under a vocabulary
    with another rule, go to the library whole."""

    def __init__(self, path: str, kept: int | None = None) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.kept = KEPT_WORDS if kept is None else kept
        # without the places of the ids in the text, where the library offers that
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        made = json.loads(self.tokenizer.to_str())
        suffix = made["model"].get("end_of_word_suffix")
        steps = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", ())]
        cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", ())
        self.by_word = (bool(suffix) and steps == ["NFC", "Replace", "Lowercase"]
                        and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
                        and cuts[0]["pattern"] == {"Regex": _SPLIT} and cuts[0]["invert"]
                        and [x["content"] for x in made["added_tokens"]]
                        == ["<|startoftext|>", "<|endoftext|>"])
        if self.by_word:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}      # looked up before a word is encoded again

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        if not self.by_word or _SPECIAL.search(text):
            return self.whole(text)
        words = _WORD.findall(text.lower())
        found = list(map(self.known.get, words))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            new = {words[i]: None for i in missing}
            for w in new:
                new[w] = self.older.get(w)
            fresh = [w for w, ids in new.items() if ids is None]
            if fresh:
                ids = np.array(self.encode([" ".join(fresh)], add_special_tokens=False)[0].ids,
                               dtype="<u4")
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) != len(fresh) or stops[-1] != len(ids):
                    return self.whole(text)
                raw, start = ids.tobytes(), 0
                for w, stop in zip(fresh, (4 * stops).tolist()):
                    new[w] = raw[start:stop]
                    start = stop
            for i in missing:
                found[i] = new[words[i]]
            if len(self.known) + len(new) > self.kept // 2:
                self.older, self.known = self.known, {}
            self.known.update((w, ids) for w, ids in new.items() if len(w) <= 64)
        return b"".join(found)

    def whole(self, text: str) -> bytes:
        return np.array(self.encode([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def word_ids(path: str, kept: int) -> WordIds:
    """One for each worker process, which keeps its words from task to task."""
    return WordIds(path, kept)


def cost(tokens: np.ndarray | int) -> np.ndarray | float:
    return LINEAR * tokens + SQUARE * tokens * tokens


def pack(lengths: np.ndarray, capacities: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Fill sequences of the given capacities, at most the lengths' sum altogether.

    Returns (item, start in the item, length, sequence, offset); what is not placed is the
    tail of the shortest items. Longest items first; see the module's text for the rule."""
    room = capacities.astype(np.int64).copy()
    spent = np.zeros(len(room))
    out = []
    for item in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[item])
        while left:
            fits = np.flatnonzero(room >= left)
            if len(fits):
                seq, n = fits[np.argmin(spent[fits])], left
            else:
                some = np.flatnonzero(room)
                if not len(some):
                    return out
                seq = some[np.argmin(spent[some])]
                n = int(room[seq])
            out.append((int(item), start, n, int(seq), int(capacities[seq] - room[seq])))
            room[seq] -= n
            spent[seq] += cost(n)
            start, left = start + n, left - n
    return out


class Packer:
    """Groups of one task. Items are (doc number, start, ids as bytes)."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.sequence = capacity, first_id
        self.items: list[tuple[int, int, bytes]] = []
        self.tokens = 0

    def add(self, doc: int, ids: bytes) -> Iterator[tuple[int, int, bytes, int, int]]:
        n, size = len(ids) // 4, self.capacity
        whole = n - n % size if n > size else 0
        for start in range(0, whole, size):
            yield doc, start, ids[4 * start:4 * (start + size)], self.sequence, 0
            self.sequence += 1
        if whole < n:
            self.items.append((doc, whole, ids[4 * whole:]))
            self.tokens += n - whole
        if self.tokens >= max(GROUP, size):
            yield from self.fill(np.full(self.tokens // size, size))

    def fill(self, capacities: np.ndarray) -> Iterator[tuple[int, int, bytes, int, int]]:
        lengths = np.array([len(x[2]) // 4 for x in self.items], dtype=np.int64)
        done = np.zeros(len(lengths), dtype=np.int64)
        for item, start, n, seq, offset in pack(lengths, capacities):
            doc, begin, ids = self.items[item]
            yield doc, begin + start, ids[4 * start:4 * (start + n)], self.sequence + seq, offset
            done[item] = start + n
        self.sequence += len(capacities)
        self.items = [(d, s + int(k), ids[4 * int(k):]) for (d, s, ids), k, n
                      in zip(self.items, done, lengths) if k < n]
        self.tokens -= int(capacities.sum())

    def finish(self) -> Iterator[tuple[int, int, bytes, int, int]]:
        if not self.tokens:
            return
        whole, rest = divmod(self.tokens, self.capacity)
        powers = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        yield from self.fill(np.array([self.capacity] * whole + powers))


FIELDS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.list_(pa.int32()),
          "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
SCHEMA = ("doc_id long, start long, length long, {} doc_tokens long, sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, digests: bool = False,
                   kept_words: int = KEPT_WORDS) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: one row for each piece.
    With ``digests`` the ids' crc32 (ids_crc32 long) stands in for the ids. A worker keeps
    the ids of ``kept_words`` words, about 200 bytes each: more are faster."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    fields = {("ids_crc32" if digests and k == "ids" else k): (pa.int64() if digests and k == "ids" else v)
              for k, v in FIELDS.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = Packer(capacity, (context.partitionId() if context else 0) << 32)
        ids_of = word_ids(path, kept_words)
        names: list[int | None] = []      # of the documents that may still have pieces
        sizes: list[int] = []
        out: list[tuple] = []

        def note(pieces: Iterator[tuple[int, int, bytes, int, int]]) -> None:
            for doc, start, ids, seq, offset in pieces:
                value = zlib.crc32(ids) if digests else np.frombuffer(ids, dtype="<u4").astype(np.int32)
                out.append((names[doc], start, len(ids) // 4, value, sizes[doc], seq, offset))

        def batch() -> pa.RecordBatch:
            made = pa.record_batch({k: pa.array(v, t) for (k, t), v in
                                    zip(fields.items(), zip(*out))})
            out.clear()
            return made

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = ids_of(text) + end
                names.append(doc_id)
                sizes.append(len(ids) // 4)
                note(packer.add(len(names) - 1, ids))
                if len(out) > 2000:
                    yield batch()
                    if len(names) > 100_000:      # only documents that still wait are named
                        wait = sorted({d for d, _, _ in packer.items})
                        place = {d: i for i, d in enumerate(wait)}
                        names, sizes = [names[d] for d in wait], [sizes[d] for d in wait]
                        packer.items = [(place[d], s, ids) for d, s, ids in packer.items]
        note(packer.finish())
        if out:
            yield batch()
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shown("text").alias("text"))
    return rows.mapInArrow(task, SCHEMA.format("ids_crc32 long," if digests else "ids array<int>,"))
