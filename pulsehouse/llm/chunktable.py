"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece of a model holds a whitespace marker behind another character, no piece can
reach from one marked word into the next: a normalised text falls into chunks (a run of
markers and the word behind it) that are segmented each by itself. Natural text repeats its
words, so a task keeps a table of the chunks it has met, has the library segment each new
distinct chunk once, and puts the ids of a text together by the position of its chunks in
the table. The table holds at most ``KEPT`` chunks and ``KEPT_CHARS`` characters; a full one
is started anew, which costs time and changes nothing.

The library itself takes whole texts where the method does not hold: models with a piece
across a marker, without byte pieces or without the marker itself, and texts that the
model's normaliser changes by more than marking their spaces.

Defined results: a null text is empty; an empty text has the end id alone and decodes to an
empty text; a marker character in a text is a space, as for the library; repeated rows and
rows without doc_id stay; other columns are not read; an empty table gives an empty result.
Texts are taken whole: a task's memory grows with its longest text (about 60 bytes an id).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import give_back, shown
from pulsehouse.llm.neardup import text_slices

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Chunks and characters of chunks in a task's table.
KEPT, KEPT_CHARS = 400_000, 8_000_000


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def splits_at_markers(processor) -> bool:
    """Whether pieces never reach over the start of a run of markers, and whatever is no
    piece is spelt in bytes, so that chunks are segmented independently."""
    pieces = [processor.id_to_piece(i) for i in range(len(processor))]
    crossing = re.compile(f"[^{MARK}]{MARK}")
    byte_pieces = sum(map(processor.is_byte, range(len(processor))))
    return (byte_pieces == 256 and MARK in pieces and not any(map(crossing.search, pieces)))


class ChunkTable:
    """Ids of texts under one model; see the module's description."""

    def __init__(self, path: str, kept: int = KEPT, kept_chars: int = KEPT_CHARS) -> None:
        from sentencepiece import SentencePieceProcessor
        self.processor = SentencePieceProcessor(model_file=path)
        self.by_chunk = splits_at_markers(self.processor)
        self.kept, self.kept_chars = kept, kept_chars
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}                 # chunk -> row of the table
        self.begin = np.zeros(1, dtype=np.int64)         # the row's first id, and one end more
        self.ids = np.zeros(0, dtype=np.int32)
        self.chars = 0

    def _learn(self, chunks: list[str]) -> None:
        """Rows for the chunks that the table lacks, segmented in one call. The library puts
        a marker before each text, which stands for the first one of the chunk."""
        new = list(set(chunks).difference(self.number))
        if not new:
            return
        found = self.processor.encode([c[1:] for c in new], num_threads=1)
        # a chunk of one marker is an empty text to the library, which gives it no ids
        alone = self.processor.piece_to_id(MARK)
        found = [ids if ids else [alone] for ids in found]
        first = len(self.number)
        self.number.update(zip(new, range(first, first + len(new))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(x) for x in found])])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), dtype=np.int32)])
        self.chars += sum(map(len, new))

    def _marked(self, text: str) -> str | None:
        """The text as the model sees it, if its normaliser does no more than mark spaces."""
        marked = MARK + text.replace(" ", MARK)
        return marked if self.processor.normalize(text) == marked else None

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without an end id."""
        out: list[np.ndarray | None] = [None] * len(texts)
        chunks, owners, counts = [], [], []
        for i, text in enumerate(texts):
            marked = self._marked(text) if text and self.by_chunk else None
            if marked is None:
                out[i] = np.array(self.processor.encode(text), dtype=np.int32)
            else:
                own = _CHUNK.findall(marked)
                chunks += own
                owners.append(i)
                counts.append(len(own))
        if not owners:
            return out
        if len(self.number) > self.kept or self.chars > self.kept_chars:
            self._empty()
        self._learn(chunks)
        row = np.fromiter(map(self.number.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        length = self.begin[row + 1] - self.begin[row]
        stop = np.cumsum(length)
        ids = self.ids[np.repeat(self.begin[row] - stop + length, length) + np.arange(stop[-1])]
        ends = stop[np.cumsum(counts) - 1]
        for i, own in zip(owners, np.split(ids, ends[:-1])):
            out[i] = own
        return out


@lru_cache(maxsize=2)
def chunk_table(path: str) -> ChunkTable:
    """One for each worker process, which keeps its chunks from task to task."""
    return ChunkTable(path)


def encode(documents: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids (with the end id), decoded (the library's text of these ids): one row for
    each row of ``documents``."""
    path = model or default_model()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(path)
        end = np.array([table.processor.eos_id()], dtype=np.int32)
        for whole in batches:
            for b, texts in text_slices(whole):
                ids = [np.concatenate([x, end]) for x in table(texts)]
                decoded = table.processor.decode([x.tolist() for x in ids], num_threads=1)
                stops = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": b.column("doc_id"),
                    "ids": pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(ids))),
                    "decoded": pa.array(decoded, pa.string())})
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shown().alias("text"))
    return rows.mapInArrow(task, "doc_id long, ids array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids with one space between),
    decoded_sha256."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
