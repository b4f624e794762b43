"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of the model crosses from a character to a whitespace marker,
merges never cross either, so a text can be cut in front of every marker
that follows another character. Each worker process keeps a table of the
chunks it has seen: a chunk is segmented once by the library, and a text's ids are its
chunks' ids joined by position; decoding works the same way. The table has
at most ``table_limit`` entries and starts afresh beyond; longer chunks than
``chunk_limit`` characters are segmented where they stand. Nothing is
shuffled: the table is made where the text is read.

``model`` is the content of a model file, some hundred kilobytes, which the
driver reads and Spark ships to the tasks. A model with crossing pieces, or
one that normalises text, is refused.

Defined results: a null or empty text has the begin and end ids only and
decodes to the empty text; equal rows give equal results; input columns
named like a result column are replaced by it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: A chunk without its first marker: more markers, then other characters.
CHUNK = re.compile("(?:^| )( *[^ ]*)")
RESULT = ("n_tokens", "piece_ids", "decoded")
MODEL_LIMIT = 64 << 20


def load(model: bytes):
    """The processor, after a check that chunks are independent."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    crossing = re.compile(f"[^{MARK}]{MARK}")
    if any(crossing.search(pieces.id_to_piece(i)) for i in range(pieces.get_piece_size())):
        raise ValueError("a piece of this model crosses a whitespace marker")
    sample = "  a  b\tc Ａ "
    if pieces.decode(pieces.encode(sample)) != sample:
        raise ValueError("this model changes texts before it segments them")
    return pieces


class ChunkTable:
    """Ids (little-endian, 32 bits) of chunks, and what they decode to where that is not the chunk."""

    def __init__(self, model: bytes, table_limit: int, chunk_limit: int):
        self.pieces = load(model)
        self.table_limit, self.chunk_limit = table_limit, chunk_limit
        self.begin = self.packed([self.pieces.bos_id()])
        self.end = self.packed([self.pieces.eos_id()])
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, bytes] = {"": self.packed([self.pieces.piece_to_id(MARK)])}
        self.changed: dict[str, str] = {}

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def chunks(self, text: str) -> list[str]:
        spaced = text.replace(MARK, " ")
        if "  " in spaced or spaced[0] == " ":
            return CHUNK.findall(spaced)
        return spaced.split(" ")

    def learn(self, chunks: list[str]) -> None:
        known = self.ids
        new = [c for c in set(chunks) if c not in known]
        if len(known) + len(new) > self.table_limit:
            self.clear()
            known = self.ids
            new = [c for c in set(chunks) if c not in known]
        segmented = self.pieces.encode(new, num_threads=1)
        for chunk, ids, back in zip(new, segmented, self.pieces.decode(segmented, num_threads=1), strict=True):
            known[chunk] = self.packed(ids)
            if back != chunk:
                self.changed[chunk] = back

    def encode(self, text: str | None) -> tuple[bytes, str]:
        if not text:
            return self.begin + self.end, ""
        chunks = self.chunks(text)
        try:
            ids = b"".join(map(self.ids.__getitem__, chunks))
        except KeyError:
            self.learn(chunks)
            ids = b"".join(map(self.ids.__getitem__, chunks))
        changed = self.changed
        decoded = " ".join([changed.get(c, c) for c in chunks] if changed else chunks)
        if len(text) > self.chunk_limit:
            for chunk in chunks:
                if len(chunk) > self.chunk_limit:
                    self.ids.pop(chunk, None)
                    changed.pop(chunk, None)
        return self.begin + ids + self.end, decoded


#: The table that this worker process used last.
_LAST: dict[tuple, ChunkTable] = {}


def _table(model: bytes, table_limit: int, chunk_limit: int) -> ChunkTable:
    key = (model, table_limit, chunk_limit)
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = ChunkTable(*key)
    return _LAST[key]


def encode_texts(
    docs: DataFrame,
    model: bytes,
    text: str = "text",
    table_limit: int = 400_000,
    chunk_limit: int = 256,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``piece_ids`` (binary, 32-bit little-endian) and ``decoded``."""
    if len(model) > MODEL_LIMIT:
        raise ValueError(f"the model has {len(model)} bytes, more than {MODEL_LIMIT}")
    docs = docs.drop(*(c for c in RESULT if c != text))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shipped.value, table_limit, chunk_limit)
        for batch in batches:
            ids, decoded = [], []
            for value in batch.column(text):
                packed, back = table.encode(value.as_py())
                ids.append(packed)
                decoded.append(back)
            added = [
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(decoded, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *RESULT])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(encode, f"{kept}, n_tokens bigint, piece_ids binary, decoded string")
