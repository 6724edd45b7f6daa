"""SentencePiece encoding and decoding.

One pass over the text: at each position the automaton's output links give every piece that ends there, the longest first, and
each relaxes the best score of that position from the best score of where it starts. A piece replaces the best so
far only if its score is higher, so of equal paths the one whose last piece is longer stays, as in the public library. A
character that is no piece itself may also be taken alone at the unknown score; it becomes its UTF-8 byte pieces.

Texts are cut where no piece can cross, and the pieces of a chunk are looked up in a cache of bounded size. A very long text is encoded
whole, chunk by chunk; a very long chunk, as of a script without spaces, takes memory in proportion to itself and is not kept.

Defined results: a NULL or empty text has no pieces. Decoding gives the text back except that U+2581, the model's mark of a space,
comes back as a space. Repeated rows are encoded alike. Rows keep their doc_id, NULL or not; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.lexicon import SPACE, Lexicon, default_model, lexicon_of
from feedloom.llm.word_cache import WordCache

#: Chunks kept by a generation of a worker's cache: about 75 MB in all.
CACHED = 200_000
LOW = float("-inf")


def best_pieces(lexicon: Lexicon, chunk: str) -> list[int]:
    """The ids of the best path through one chunk."""
    n = len(chunk)
    score, begin, piece = [0.0] + [LOW] * n, [0] * (n + 1), [-1] * (n + 1)
    # Positions after a character that is no piece, to be relaxed once all longer pieces have been.
    alone = [i + 1 for i, c in enumerate(chunk) if c not in lexicon.singles]
    alone.append(n + 1)
    at = 0
    for end, (number, own, length) in lexicon.automaton.iter(chunk):
        end += 1
        while alone[at] < end:
            p = alone[at]
            if score[p - 1] + lexicon.unknown_score > score[p]:
                score[p], begin[p], piece[p] = score[p - 1] + lexicon.unknown_score, p - 1, -1
            at += 1
        start = end - length
        candidate = score[start] + own
        if candidate > score[end] or candidate == score[end] and start < begin[end]:
            score[end], begin[end], piece[end] = candidate, start, number
    while alone[at] <= n:
        p = alone[at]
        if score[p - 1] + lexicon.unknown_score > score[p]:
            score[p], begin[p], piece[p] = score[p - 1] + lexicon.unknown_score, p - 1, -1
        at += 1
    path: list[list[int]] = []
    while n:
        path.append([piece[n]] if piece[n] >= 0 else lexicon.fallback(chunk[n - 1]))
        n = begin[n]
    return [i for ids in reversed(path) for i in ids]


class Encoder:
    def __init__(self, path: str) -> None:
        self.lexicon = lexicon_of(path)
        self.dtype = np.dtype("<u2" if len(self.lexicon.pieces) <= 1 << 16 else "<u4")
        self.cache = WordCache(self._encode, CACHED)

    def _encode(self, chunks: list[str]) -> Iterator[bytes]:
        return (np.array(best_pieces(self.lexicon, c), self.dtype).tobytes() for c in chunks)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.cache.values(self.lexicon.chunks(text))), self.dtype)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.lexicon.plain.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.lexicon.prefix and text[:1] == " " else text


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ``ids`` of each row. One pass, no shuffle."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            ids = [encoder.encode(t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return slim(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ``text`` of each row of doc_id, ids."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            texts = [encoder.decode(np.array(i.as_py() or [], np.int64)) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def encode_whole(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, source, n_pieces, ids and round_trip of each row. One pass, no shuffle."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            ids, same = [], []
            for t in batch.column(2):
                text = t.as_py()
                found = encoder.encode(text)
                ids.append(found.astype(np.int32))
                same.append(encoder.decode(found) == text.replace(SPACE, " "))
            counts = pa.array([len(i) for i in ids], pa.int64())
            arrays = [batch.column(0), batch.column(1), counts, pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "source", "n_pieces", "ids", "round_trip"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text"))
    return whole.mapInArrow(run, "doc_id long, source string, n_pieces long, ids array<int>, round_trip boolean")


def encode_and_decode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_pieces, n_bytes (pieces that are single bytes), ids_crc32 (of the ids as unsigned 32-bit little-endian), and
    whether decoding gave the text back. Both directions in one pass."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        is_byte = np.zeros(len(encoder.lexicon.pieces), bool)
        is_byte[list(encoder.lexicon.bytes.values())] = True
        for batch in batches:
            rows = []
            for t in batch.column(1):
                text = t.as_py()
                ids = encoder.encode(text)
                same = encoder.decode(ids) == text.replace(SPACE, " ")
                rows.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()), same))
            columns = list(zip(*rows)) or [()] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.bool_()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "round_trip"])

    return slim(docs).mapInArrow(run, "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, round_trip boolean")
