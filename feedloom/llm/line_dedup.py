"""Line dedup with two Bloom filters, of hashes seen once and of hashes seen twice.

1. Every task sends the hashes of its documents' line keys, packed and told apart by hash prefix, to one reducer per prefix.
   The reducer adds them to its part of the once-seen filter; a hash that may have been there already goes to the
   twice-seen filter. A filter part has a fixed size, so the twice-seen filter that all tasks then read is bounded by
   ``parts * part_bits / 8`` bytes. The parts grow with the bytes of the input up to a limit; a fuller filter only lets more lines through to step 2.
2. Lines whose hash is in the twice-seen filter are suspected repeats. Only they are shuffled, by their key, for the exact
   count of documents and the choice of the first one.
3. Each text gets the keys it must lose. Texts of one doc_id are told apart by a hash, so that a doc_id on very many rows is no hot spot.

Defined results: a NULL or empty text is one empty line. Rows with the same doc_id are one document. A NULL doc_id is one
document that comes after all others. Rows keep their order of lines and all their other columns, whatever their
names; repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_bytes
from feedloom.scratch import materialize, scratch_path

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
MIN_POINTS = 10
#: The filters: this many parts, each of so many bits at least (64 times 2 million bits are 16 MB) and at most (128 MB). Between
#: these, one bit for so many bytes of text.
PARTS_BITS = 6
PART_BITS = 1 << 21
MOST_PART_BITS = 1 << 24
BYTES_PER_BIT = 32
PROBES = 4


def line_key(line: bytes) -> bytes | None:
    """The key of a line, or None if it is too short to count."""
    key = line.strip(SPACES).lower()
    if len(key) < MIN_POINTS or len(key) < 4 * MIN_POINTS and len(key.decode("utf-8", "replace")) < MIN_POINTS:
        return None
    return key


def keys_of(text: bytes) -> list[bytes]:
    """The distinct keys of a text."""
    keys = dict.fromkeys(map(line_key, text.split(b"\n")))
    keys.pop(None, None)
    return list(keys)


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def positions(hashes: np.ndarray, part_bits: int) -> np.ndarray:
    """Bit positions in a part, one row per probe. The part itself is told by the upper bits of the hash."""
    low = hashes & np.uint64(0xFFFFFFFF)
    step = (hashes >> np.uint64(26)) & np.uint64(0xFFFFFFFF) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (low + probes * step) % np.uint64(part_bits)


class Filter:
    def __init__(self, part_bits: int) -> None:
        self.bits = np.zeros(part_bits, bool)

    def has(self, at: np.ndarray) -> np.ndarray:
        return self.bits[at].all(axis=0)

    def add(self, at: np.ndarray) -> None:
        self.bits[at.ravel()] = True


def part_bits_for(n_bytes: int, parts_bits: int) -> int:
    wanted = -(-n_bytes // (BYTES_PER_BIT << parts_bits))
    return min(max(wanted + -wanted % 8, PART_BITS), MOST_PART_BITS)


def twice_seen(docs: DataFrame, parts_bits: int, part_bits: int) -> DataFrame:
    """(part, bits): the twice-seen filter, one row per hash prefix that occurs."""
    shift = np.uint64(64 - parts_bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashes_of(keys_of(t.as_py())) for t in batch.column(0)]
            # A hash that two documents of the batch hold is sent twice, which is as often as the filters can tell.
            hashes, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            hashes = np.repeat(hashes, np.minimum(counts, 2))
            edges = np.searchsorted(hashes >> shift, np.arange((1 << parts_bits) + 1, dtype=np.uint64))
            filled = np.flatnonzero(np.diff(edges))
            blobs = [hashes[edges[p] : edges[p + 1]].tobytes() for p in filled]
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(blobs, pa.binary())], ["part", "hashes"])

    def build(_: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Filter(part_bits), Filter(part_bits)
        part = 0
        for batch in batches:
            part = batch.column(0)[0].as_py()
            for blob in batch.column(1):
                hashes, counts = np.unique(np.frombuffer(blob.as_py(), np.uint64), return_counts=True)
                at = positions(hashes, part_bits)
                twice.add(at[:, once.has(at) | (counts > 1)])
                once.add(at)
        bits = np.packbits(twice.bits).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits], pa.binary())], ["part", "bits"])

    sent = docs.select(text_bytes()).mapInArrow(send, "part int, hashes binary")
    return sent.groupBy("part").applyInArrow(build, "part int, bits binary")


def suspects(docs: DataFrame, parts_bits: int, part_bits: int | None) -> DataFrame:
    """(doc_id, mark, key): the keys whose hash two or more rows may hold."""
    spark = docs.sparkSession
    if part_bits is None:
        part_bits = part_bits_for(docs.agg(F.sum(F.octet_length(text_bytes()).cast("long"))).first()[0] or 0, parts_bits)
    parts = {r["part"]: r["bits"] for r in twice_seen(docs, parts_bits, part_bits).toLocalIterator()}
    shared = spark.sparkContext.broadcast(parts)
    shift = np.uint64(64 - parts_bits)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(part_bits // 8, np.uint8)
        filters = np.stack([np.frombuffer(shared.value[p], np.uint8) if p in shared.value else empty for p in range(1 << parts_bits)])
        for batch in batches:
            ids, marks, keys = [], [], []
            for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = keys_of(text.as_py())
                if not own:
                    continue
                hashes = hashes_of(own)
                at = positions(hashes, part_bits)
                part = (hashes >> shift).astype(np.int64)
                bits = filters[part, (at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1
                picked = [own[i] for i in np.flatnonzero(bits.all(axis=0))]
                ids += [doc_id] * len(picked)
                marks += [mark] * len(picked)
                keys += picked
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "mark", "key"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_bytes()).alias("mark"), text_bytes())
    return slim.mapInArrow(test, "doc_id long, mark long, key binary")


def lost_keys(docs: DataFrame, parts_bits: int = PARTS_BITS, part_bits: int | None = None) -> DataFrame:
    """(doc_id, mark, keys): for each text of a document that loses lines, the keys of those lines. Texts of a document that share
    a mark share the keys, which changes nothing: a key is lost by the whole document."""
    spark = docs.sparkSession
    found = materialize(suspects(docs, parts_bits, part_bits), scratch_path(spark, "line-suspects"))
    per_key = found.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("unnamed")
    )
    repeated = (F.col("first") != F.col("last")) | (F.col("unnamed") & F.col("first").isNotNull())
    repeats = materialize(per_key.filter(repeated).select("key", "first"), scratch_path(spark, "line-repeats"))
    lost = found.join(repeats, "key").filter(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("first")))
    # A text has no more keys than lines, so its list is bounded by it.
    return lost.groupBy("doc_id", "mark").agg(F.collect_set("key").alias("keys"))


def with_lost_keys(docs: DataFrame, parts_bits: int, part_bits: int | None) -> DataFrame:
    """(doc: all columns of the row, keys)."""
    spark = docs.sparkSession
    lost = materialize(lost_keys(docs, parts_bits, part_bits), scratch_path(spark, "line-lost"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_bytes()).alias("mark"))
    return rows.join(lost, rows.doc_id.eqNullSafe(lost.doc_id) & (rows.mark == lost.mark), "left").select("doc", "keys")


def split_lines(text: bytes, keys: list[bytes] | None) -> tuple[int, int, bytes]:
    """(lines, dropped lines, the text that stays)."""
    lines = text.split(b"\n")
    if not keys:
        return len(lines), 0, text
    lost = set(keys)
    stay = [line for line in lines if line.strip(SPACES).lower() not in lost]
    return len(lines), len(lines) - len(stay), b"\n".join(stay)


def line_counts(docs: DataFrame, parts_bits: int = PARTS_BITS, part_bits: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text (bytes) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [split_lines(t.as_py(), k.as_py()) for t, k in zip(batch.column(1), batch.column(2))]
            lines, dropped, text = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(text, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_lines", "n_dropped", "kept_text"])

    slim = docs.select("doc_id", "text")
    rows = with_lost_keys(slim, parts_bits, part_bits)
    rows = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), text_bytes("doc.text").alias("text"), "keys")
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_text binary")


def drop_lines(docs: DataFrame, parts_bits: int = PARTS_BITS, part_bits: int | None = None) -> DataFrame:
    """The rows with the text that stays, all their columns kept; ``n_chars``, where present, follows the text."""
    at = docs.columns.index("text")
    kind = docs.schema["text"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, keys = batch.column(0), batch.column(1)
            columns = doc.flatten()
            texts = columns[at].to_pylist()
            for i, k in enumerate(keys.to_pylist()):
                if k and texts[i] is not None:
                    texts[i] = split_lines(texts[i].encode(), k)[2].decode()
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in doc.type])

    out = with_lost_keys(docs, parts_bits, part_bits).mapInArrow(run, docs.schema)
    out = out.withColumn("text", F.col("text").cast(kind))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(docs: DataFrame) -> DataFrame:
    counts = line_counts(docs)
    return counts.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
