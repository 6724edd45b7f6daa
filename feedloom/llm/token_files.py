"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A data file is a run of records:

    length   8 bytes   of the payload, little-endian
    check    4 bytes   masked checksum of the eight length bytes
    payload            1 byte: 1 if there is a doc_id; 8 bytes: doc_id; the token ids, little-endian
    check    4 bytes   masked checksum of the payload

Ids take two bytes where the vocabulary fits, else four. The checksum is CRC-32, rotated right by 15 bits plus a constant, so
that a checksum of data that holds checksums is no weak one. The index is a Parquet table: one row per record
with its file, offset, length, doc_id and number of ids; the manifest has one row per file. Files are in ascending doc_id
order (NULL first), within and across.

A task writes a file under a name of its own attempt, and only the files of attempts that Spark accepted are in the index:
a lost executor or a second attempt leaves at most an unlisted file. Files go through pyarrow's file systems to a folder that
all executors share.

Encoding: where white space separates a tokenizer's pre-tokens, a text's ids are those of its words (cut at ASCII white space) one after the
other. A slice of texts is cut and its distinct words are found at once; those that a cache of bounded size lacks are encoded by the
tokenizers library, and the ids of all words are gathered. Other tokenizers encode whole texts.

Defined results: a NULL text is the empty text and has the end id only. Repeated rows give repeated records. Equal doc_ids are in the
order of a text hash. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import text_bytes
from feedloom.llm.word_cache import WordCache
from feedloom.scratch import hadoop_path, materialize, scratch_path

END = 2
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
OWNER = struct.Struct("<?q")
CHECK = struct.Struct("<I")
#: Words kept by a generation of a worker's cache: about 150 MB in all.
CACHED = 300_000
#: Bytes of text encoded at a time.
SLICE = 4 << 20
#: Bytes of text that a file holds at most, about, where the session's shuffle partitions would make larger ones.
FILE_BYTES = 128 << 20
# The normalizer and the pre-tokens of the vocabularies whose words are looked up apart.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A word of Latin letters and the ASCII punctuation after it are separate pre-tokens, so their ids are looked up apart.
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]+)?")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """One record."""
    payload = OWNER.pack(doc_id is not None, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return length + CHECK.pack(masked(length)) + payload + CHECK.pack(masked(payload))


def records_in(stream, dtype: np.dtype) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each record of an open file."""
    while head := stream.read(HEAD.size):
        if len(head) != HEAD.size:
            raise ValueError("file ends within a record")
        check_length(head, 0)
        body = stream.read(HEAD.unpack(head)[0] + CHECK.size)
        doc_id, ids, _ = read_record(head + body, 0, dtype)
        yield doc_id, ids


def check_length(data: bytes, at: int) -> None:
    if masked(bytes(data[at : at + 8])) != HEAD.unpack_from(data, at)[1]:
        raise ValueError(f"damaged length at {at}")


class Words:
    """Ids of whole batches of texts."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.dtype = id_type(self.tokenizer)
        self.by_words = splits_at_white_space(json.loads(self.tokenizer.to_str()))
        self.words = WordCache(self._words, CACHED)
        self.stems = WordCache(self._stems, CACHED // 2)

    def _stems(self, stems: list[str]) -> list[bytes]:
        """Lower-case ASCII letters are what the normalizer and the pre-tokenizer leave as they are: such a stem is one
        pre-token and goes straight to the library's model."""
        plain = [s.isascii() and s.isalpha() for s in stems]
        rest = [s for s, p in zip(stems, plain) if not p]
        encoded = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        ids = ([t.id for t in self.model.tokenize(s)] if p else next(encoded).ids for s, p in zip(stems, plain))
        return [np.array(i, self.dtype).tobytes() for i in ids]

    def _words(self, words: list[str]) -> Iterator[bytes]:
        parts: list[str] = []
        counts = []
        for text in words:
            simple = SIMPLE.fullmatch(text)
            own = [text] if not simple else [simple[1].lower(), simple[2]] if simple[2] else [simple[1].lower()]
            parts += own
            counts.append(len(own))
        ids = iter(self.stems.values(parts))
        return (next(ids) if n == 1 else next(ids) + next(ids) for n in counts)

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, a bounded number of bytes at a time. Broken UTF-8 is read with replacement characters."""
        try:
            texts = texts.cast(pa.string())
        except pa.ArrowInvalid:
            texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
        for part in slices(texts):
            yield from self._by_words(part) if self.by_words else self._whole(part)

    def _whole(self, texts: pa.Array) -> Iterator[bytes]:
        for found in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False):
            yield np.array(found.ids, self.dtype).tobytes()

    def _by_words(self, texts: pa.Array) -> Iterator[bytes]:
        """Each distinct word is looked up once; the ids of all words are then gathered from those of the distinct ones."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        values = list(self.words.values(words.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(values), self.dtype)
        index = words.indices.to_numpy()
        each = sizes[index]
        ends = np.cumsum(each)
        first = (np.cumsum(sizes) - sizes)[index] - (ends - each)
        ids = pool[np.repeat(first, each) + np.arange(ends[-1] if len(ends) else 0)]
        n_words = np.cumsum(split.value_lengths().to_numpy())
        stops = np.concatenate([[0], ends])[n_words]
        begin = 0
        for stop in stops:
            yield ids[begin:stop].tobytes()
            begin = stop


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of at most ``SLICE`` bytes, or one that is longer."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + SLICE, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def splits_at_white_space(tokenizer: dict) -> bool:
    """Whether a text's ids are those of its words one after the other, with words of Latin letters in lower case: known of one normalizer
    and one pre-tokenizer. With any other, texts are encoded whole."""
    normalizers = [n.get("type") for n in (tokenizer.get("normalizer") or {}).get("normalizers", [])]
    splits = (tokenizer.get("pre_tokenizer") or {}).get("pretokenizers", [])
    own = splits[0] if splits else {}
    pattern = (own.get("pattern") or {}).get("Regex")
    removed = own.get("behavior") == "Removed" and own.get("invert") is True
    spaced = any(c.isspace() for t in tokenizer.get("added_tokens") or [] for c in t["content"])
    return normalizers == NORMALIZERS and pattern == PRE_TOKENS and removed and not spaced


def id_type(tokenizer) -> np.dtype:
    return np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


_words: dict[str, Words] = {}


def words_of(vocabulary: str) -> Words:
    """One encoder per worker process, kept between tasks."""
    if vocabulary not in _words:
        _words[vocabulary] = Words(vocabulary)
    return _words[vocabulary]


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path with a scheme, as ``qualified`` gives it, under the names that Hadoop and pyarrow have for it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pa.fs.LocalFileSystem(), urlparse(path).path
    if scheme in ("s3a", "s3n"):
        return pa.fs.FileSystem.from_uri(f"s3:{rest}")
    if scheme == "dbfs":
        return pa.fs.LocalFileSystem(), "/dbfs/" + urlparse(path).path.lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, path: str) -> str:
    """With the scheme that Spark would take: a bare path is on the default file system, not on each machine's own disk."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def write_records(docs: DataFrame, path: str, vocabulary: str, files: int) -> DataFrame:
    """Write the files and the index below ``path``; the index rows, with ``start``: the ids of all documents before."""
    spark = docs.sparkSession
    path = qualified(spark, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = words_of(vocabulary)
        end = np.array([END], encoder.dtype).tobytes()
        number = TaskContext.get().partitionId()
        fs, folder = file_system(f"{path}/data")
        fs.create_dir(folder, recursive=True)
        name = f"ids-{number:05d}-{uuid.uuid4().hex}.bin"
        offset, seen = 0, 0
        out = None
        for batch in batches:
            out = out or fs.open_output_stream(f"{folder}/{name}", buffer_size=1 << 20)
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1))):
                ids += end
                record = frame(doc_id, ids)
                out.write(record)
                n = len(ids) // encoder.dtype.itemsize
                size = len(record)
                rows.append((number, name, offset, size, doc_id, n, seen))
                offset, seen = offset + size, seen + n
            if rows:
                kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                names = ["part", "file", "at", "size", "doc_id", "n_tokens", "before"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        if out:
            out.close()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    ordered = slim.repartitionByRange(files, F.col("doc_id"), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    kinds = "part int, file string, at long, size long, doc_id long, n_tokens long, before long"
    return materialize(ordered.mapInArrow(write, kinds), f"{path}/index")


def manifest(index: DataFrame) -> DataFrame:
    """(part, file, start): one row per file, with the ids of all files before it."""
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("part", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))


def read_record(data: bytes, at: int, dtype: np.dtype) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, where the next record begins); raises on any damage."""
    check_length(data, at)
    begin = at + HEAD.size
    end = begin + HEAD.unpack_from(data, at)[0]
    payload = bytes(data[begin:end])
    if len(data) < end + CHECK.size or masked(payload) != CHECK.unpack_from(data, end)[0]:
        raise ValueError(f"damaged record at {at}")
    named, doc_id = OWNER.unpack_from(payload)
    return doc_id if named else None, np.frombuffer(payload, dtype, offset=OWNER.size), end + CHECK.size


def read_files(index: DataFrame, path: str, dtype: np.dtype) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record; each file is read as a stream by one task."""
    path = qualified(index.sparkSession, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, folder = file_system(f"{path}/data")
                yield from records(fs.open_input_stream(f"{folder}/{row['file']}", buffer_size=1 << 20), row["start"])

    def records(stream, start: int) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, ids in records_in(stream, dtype):
            rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            start += len(ids)
            if len(rows) == 10_000:
                yield as_batch(rows)
                rows = []
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest(index)
    files = files.repartition(max(1, index.sparkSession.sparkContext.defaultParallelism), "file")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shuffled(spark: SparkSession, path: str, seed: int, dtype: np.dtype) -> DataFrame:
    """(doc_id, ids array) of every record in a random order told by the seed, each found by its offset in the index."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(f"{path}/data")
        opened: dict[str, pa.NativeFile] = {}
        for batch in batches:
            ids, names = [], batch.column(0).to_pylist()
            owners = []
            for name, at, size in zip(names, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if name not in opened:
                    if len(opened) == 64:
                        opened.pop(next(iter(opened))).close()
                    opened[name] = fs.open_input_file(f"{folder}/{name}")
                doc_id, found, _ = read_record(opened[name].read_at(size, at), 0, dtype)
                owners.append(doc_id)
                ids.append(found.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    path = qualified(spark, path)
    index = spark.read.parquet(f"{path}/index")
    order = F.xxhash64("file", "at", F.lit(seed))
    shuffled = index.withColumn("__o", order).repartition(F.col("__o")).sortWithinPartitions("__o")
    return shuffled.select("file", "at", "size").mapInArrow(read, "doc_id long, ids array<int>")


def token_files(docs: DataFrame, path: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32 of each record."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    # Every file is written and read as a stream by one task.
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    vocabulary = vocabulary or default_vocabulary()
    index = write_records(docs, path, vocabulary, files)
    return read_files(index, path, words_of(vocabulary).dtype)
