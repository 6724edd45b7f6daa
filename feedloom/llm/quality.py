"""Quality rules: base measures of the words, and bands of the zstandard ratio of whole texts and fixed chunks.

The ratio is raw bytes over compressed bytes. Repetitive text compresses far better than prose of its length,
incompressible text (encoded data such as base64 at 1.33, noise) far worse. Short texts compress worse than long ones, so the limits depend on
the length. A text also fails if more than a fifth of its chunks are outside the chunk's band. The chunks cover every byte of a text
longer than one: the last is its last 4,096 bytes and may overlap the one before. It is also outside if the part after the overlap is outside
the limits for its own length, so that good text before does not hide it; below a quarter of a chunk it is less than a fifth of the text.

The limits of a whole text are those of BANDS, which are wide. Where documents are labelled, ``fitted_bands`` narrows them to the range of the good
ones of each octave of lengths, all of them. Every text is then measured once and its measures written; the fit joins these, not the texts, with the
labels, and the verdict is a condition on them.

Defined results: a NULL text is empty, has no words and fails the base rules. Repeated rows are judged alike. Other columns
pass through untouched, whatever their names; the measures are added only by ``measured``, which returns doc_id and
measures alone. A doc_id counts as good if all its labels are 1; labels without an id count for nothing. An octave with fewer than LEAST_GOOD good texts,
and a corpus without labels, keep the wide limits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import text_bytes
from feedloom.scratch import materialize, scratch_path

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
LEVEL = 3
CHUNK = 4096
#: (least bytes, lowest ratio, highest ratio): prose of each length compresses well inside these.
BANDS = (
    (0, 0.0, 6.0),
    (256, 1.05, 3.0),
    (512, 1.15, 3.3),
    (1024, 1.33, 3.8),
    (4096, 1.4, 4.5),
    (65536, 1.5, 5.5),
)
Bands = tuple[tuple[int, float, float], ...]
CHUNK_BAND = (1.35, 4.2)
MAX_CHUNKS_OUT = 0.2
#: The fit: least good documents of an octave, share of them cut off at each end, and what the limits are widened by.
LEAST_GOOD = 50
TAIL = 0.005
MARGIN = 1.02

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "zstd_ratio double, n_chunks long, n_chunks_out long, base_failed boolean, kept boolean"
)
SIZES = "n_bytes long, octave int"


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of eight that occurs twice or more.

    Windows are told apart exactly: pairs of words are numbered, then pairs of pairs, then pairs of those.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == n:
        return 0
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    width = 1
    while True:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        values, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(values) == len(pairs):
            return 0
        width *= 2
        if width == WINDOW:
            break
    starts = np.flatnonzero(counts[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:n])))


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            found += line in seen
            seen.add(line)
    return found


def ratio_band(n_bytes: int, bands: Bands = BANDS) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(bands) if n_bytes >= least)


def in_band(part: bytes, band: tuple[float, float], compressor: zstandard.ZstdCompressor) -> bool:
    return band[0] <= len(part) / len(compressor.compress(part)) <= band[1]


def rest_in_band(text: bytes, end: int, compressor: zstandard.ZstdCompressor) -> bool:
    """Whether the bytes of the chunk ending here that no chunk before has are inside the limits for their length."""
    rest = end % CHUNK
    return rest < CHUNK // 4 or in_band(text[end - rest : end], ratio_band(rest), compressor)


def judge(text: bytes, compressor: zstandard.ZstdCompressor, bands: Bands = BANDS) -> tuple:
    """The measures of one text, in the order of MEASURES. ``bands`` are the limits of whole texts."""
    words = text.split()
    n = len(words)
    spaces = len(text) - sum(map(len, words))
    word_chars = len(text.decode("utf-8", "replace")) - spaces
    symbols = sum(map(text.count, map(bytes, zip(SYMBOLS))))
    repeats = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    ratio = len(text) / len(compressor.compress(text)) if text else 0.0
    low, high = ratio_band(len(text), bands)
    chunks = out = 0
    if len(text) > CHUNK:
        for end in (*range(CHUNK, len(text), CHUNK), len(text)):
            chunks += 1
            out += not in_band(text[end - CHUNK : end], CHUNK_BAND, compressor) or not rest_in_band(text, end, compressor)
    kept = not base_failed and low <= ratio <= high and out <= MAX_CHUNKS_OUT * chunks
    return n, word_chars, symbols, duplicate_lines(text), repeats, ratio, chunks, out, base_failed, kept


def octave(n_bytes: int) -> int:
    return n_bytes.bit_length() - 1


def fitted_bands(docs: DataFrame, labels: DataFrame | None) -> Bands:
    """BANDS narrowed to the good documents' ratios by octave of length. ``labels``: doc_id, quality (1 is good)."""
    if labels is None:
        return BANDS
    return bands_of(measured(docs, sized=True), labels)


def bands_of(measures: DataFrame, labels: DataFrame) -> Bands:
    """The fit on measures of texts, of which only short rows are shuffled; one row per octave comes back."""
    per_id = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.min(F.col("quality").eqNullSafe(1)).alias("good"))
    good = per_id.filter("good AND labelled IS NOT NULL").select("labelled")
    # Rounded, so that what a percentile counts is bounded by the ratios there are and not by the rows.
    passed = measures.filter("NOT base_failed").select("doc_id", "octave", F.round("zstd_ratio", 4).alias("ratio"))
    ratios = passed.join(good, F.col("doc_id") == F.col("labelled"), "left_semi")
    limits = ratios.groupBy("octave").agg(F.count("*").alias("n"), F.percentile("ratio", F.array(F.lit(TAIL), F.lit(1 - TAIL))).alias("ends"))
    fitted = {r["octave"]: r["ends"] for r in limits.filter(F.col("n") >= LEAST_GOOD).collect()}
    return narrowed(fitted)


def narrowed(fitted: dict[int, Sequence[float]]) -> Bands:
    """BANDS cut at the octaves fitted, whose limits apply inside the wide ones."""
    edges = sorted({least for least, _, _ in BANDS} | {1 << k for k in fitted} | {2 << k for k in fitted})
    bands = []
    for least in edges:
        low, high = ratio_band(least)
        if octave(least) in fitted:
            first, last = fitted[octave(least)]
            low, high = max(low, first / MARGIN), min(high, last * MARGIN)
        bands.append((least, low, high))
    return tuple(bands)


def within(bands: Bands, measures: str = "") -> Column:
    """The verdict as a condition on the measures, which are columns or the fields of a struct column named with a dot after it."""
    low = high = F.lit(0.0)
    for least, lowest, highest in bands:
        longer = F.col(f"{measures}n_bytes") >= least
        low, high = F.when(longer, F.lit(lowest)).otherwise(low), F.when(longer, F.lit(highest)).otherwise(high)
    ratio, chunks, out = (F.col(f"{measures}{c}") for c in ("zstd_ratio", "n_chunks", "n_chunks_out"))
    return ~F.col(f"{measures}base_failed") & (low <= ratio) & (ratio <= high) & (out <= F.lit(MAX_CHUNKS_OUT) * chunks)


def measure_arrays(texts: Sequence[bytes], compressor: zstandard.ZstdCompressor, bands: Bands, sized: bool) -> list[pa.Array]:
    """The columns of MEASURES, and with ``sized`` those of SIZES after them."""
    columns = list(zip(*[judge(t, compressor, bands) for t in texts])) or [[]] * 10
    kinds = [pa.int64()] * 5 + [pa.float64()] + [pa.int64()] * 2 + [pa.bool_()] * 2
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    if sized:
        arrays += [pa.array([len(t) for t in texts], pa.int64()), pa.array([octave(len(t)) for t in texts], pa.int32())]
    return arrays


def measured(docs: DataFrame, bands: Bands = BANDS, sized: bool = False) -> DataFrame:
    """doc_id and the measures of each row, and with ``sized`` its length and octave. One pass, no shuffle."""
    kinds = f"{MEASURES}, {SIZES}" if sized else MEASURES
    names = [m.split()[0] for m in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *measure_arrays(texts, compressor, bands, sized)], ["doc_id", *names])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return slim.mapInArrow(run, f"doc_id long, {kinds}")


def keep_good(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows that pass, with all their columns. One pass, no shuffle of texts.

    With labels the rows are written with what the fit and the verdict need of them, since a doc_id does not tell one row from another.
    """
    at = docs.columns.index("text")
    if labels is not None:
        return fitted_good(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(at))
            yield batch.filter(pa.array([judge((t or "").encode(), compressor)[-1] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fitted_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    spark, at, own = docs.sparkSession, docs.columns.index("text"), "__measures"
    while own in docs.columns:
        own += "_"
    fields = T.StructType.fromDDL(f"{MEASURES}, {SIZES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(at)]
            measures = pa.StructArray.from_arrays(measure_arrays(texts, compressor, BANDS, True), fields.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, measures], [*batch.schema.names, own])

    rows = materialize(docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(own, fields)])), scratch_path(spark, "quality-measured"))
    measures = rows.select(F.col("doc_id").cast("long").alias("doc_id"), f"{own}.*")
    return rows.filter(within(bands_of(measures, labels), f"{own}.")).drop(own)


def quality_rules(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id and the measures of each row, judged by the bands that the labels narrow. The texts are read once."""
    if labels is None:
        return measured(docs)
    rows = materialize(measured(docs, sized=True), scratch_path(docs.sparkSession, "quality-measured"))
    return rows.withColumn("kept", within(bands_of(rows, labels))).drop("n_bytes", "octave")
