"""SimHash near-dedup by tiled exact comparison.

Documents with the same fingerprint are one class, so that copies are never compared. Classes are put into cells by the
population counts of the four 16-bit words of the fingerprint. Two fingerprints that differ in d bits differ by at most d
in the sum of these counts' differences, so only pairs of cells within the radius are compared; all others are skipped. A
cell is cut into tiles of bounded size, and a tile meets the tiles of its own cell and of half of the cells near
it. Tiles are compared whole with exclusive-or and bit counts. A pair of tiles gives a spanning forest of its links, at most
one link per fingerprint: no group is written out as all its pairs, and no link between groups is lost.

Defined results: a NULL text has no words, as has an empty one: fingerprint zero, linked like any other. Component ids are
smallest doc_ids; a NULL doc_id counts only if no other is there. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import text_bytes
from feedloom.llm.components import components
from feedloom.scratch import materialize, scratch_path

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints per tile, about: tiles are dealt by a hash.
TILE = 512
WORDS = 4
BITS = 64 // WORDS


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a text, as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)]))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, *keys: Column) -> DataFrame:
    """The given columns and ``fp`` of each row. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], fps], [*batch.schema.names[1:], "fp"])

    slim = docs.select(text_bytes().alias("__text"), *keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[1:])
    return slim.mapInArrow(run, f"{kinds}, fp long")


def counts_cell(fp: Column) -> Column:
    """The cell: the population counts of the words as one number in base 32."""
    cell = F.lit(0)
    for i in range(WORDS):
        word = F.shiftrightunsigned(fp, BITS * i).bitwiseAND((1 << BITS) - 1)
        cell = cell * 32 + F.bit_count(word)
    return cell.cast("int")


def near_cells() -> list[int]:
    """The cell itself, and one of each two opposite steps to a cell within the radius.

    The number of a cell is in base 32 and its digits are at most 16, so a step that leaves the range of a digit gives a number
    that is no cell's.
    """
    steps = []
    for step in product(range(-RADIUS, RADIUS + 1), repeat=WORDS):
        number = sum(s * 32 ** (WORDS - 1 - i) for i, s in enumerate(step))
        if sum(map(abs, step)) <= RADIUS and number >= 0:
            steps.append(number)
    return sorted(steps)


def forest(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs of a and b within the radius join, at most one per fingerprint.

    Links go from each fingerprint to its first partner; partners that this leaves apart are then joined by further
    links until every pair lies within one tree.
    """
    # Unsigned: of a negative number numpy counts the bits of its absolute value.
    hit = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= RADIUS
    if same:
        hit = np.triu(hit, 1)
    rows, columns = np.nonzero(hit)
    if not len(rows):
        return a[:0], b[:0]
    right = columns if same else columns + len(a)
    label = np.arange(len(a) + (0 if same else len(b)))
    picked = []
    while True:
        left, far = label[rows], label[right]
        apart = np.flatnonzero(left != far)
        if not len(apart):
            break
        high = np.maximum(left[apart], far[apart])
        low = np.minimum(left[apart], far[apart])
        tops, first = np.unique(high, return_index=True)
        picked.append(apart[first])
        label[tops] = low[first]
        while True:  # roots only, for the next round
            up = label[label]
            if (up == label).all():
                break
            label = up
    chosen = np.concatenate(picked)
    return a[rows[chosen]], b[columns[chosen]]


def compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for same, a, b in zip(batch.column(0), batch.column(1), batch.column(2)):
            found.append(forest(np.frombuffer(a.as_py(), np.int64), np.frombuffer(b.as_py(), np.int64), same.as_py()))
        left, right = (np.concatenate(x) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])


def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blob = b"".join(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for batch in batches)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([blob], pa.binary())], ["cell", "tile", "fps"])


def links(classes: DataFrame) -> DataFrame:
    """(a, b): links that connect all fingerprints of ``classes`` (fp, distinct) within the radius of each other."""
    spark = classes.sparkSession
    celled = classes.select("fp", counts_cell(F.col("fp")).alias("cell"))
    # At most 17**4 cells, whatever the input.
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = celled.join(F.broadcast(sizes), "cell").select("fp", "cell", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("tile"))
    tiles = dealt.groupBy("cell", "tile").applyInArrow(pack, "cell int, tile int, fps binary")
    tiles = materialize(tiles, scratch_path(spark, "simhash-tiles"))
    steps = F.array(*[F.lit(s) for s in near_cells()])
    guests = tiles.select("tile", F.col("fps").alias("guest"), "cell", F.explode(steps).alias("step"))
    guests = guests.select((F.col("cell") + F.col("step")).alias("home"), F.col("cell").alias("from"), F.col("tile").alias("from_tile"), "guest")
    pairs = guests.join(tiles, guests.home == tiles.cell).filter("from != cell OR from_tile <= tile")
    same = (F.col("from") == F.col("cell")) & (F.col("from_tile") == F.col("tile"))
    return pairs.select(same.alias("same"), "guest", "fps").mapInArrow(compare_tiles, "a long, b long")


def classes_of(prints: DataFrame) -> DataFrame:
    """(fp, label, doc_id): each fingerprint, its component and the component's smallest doc_id. ``prints``: doc_id, fp."""
    spark = prints.sparkSession
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), scratch_path(spark, "simhash-classes"))
    found = materialize(links(classes), scratch_path(spark, "simhash-links"))
    labels = components(found).withColumnRenamed("node", "fp")
    joined = classes.join(labels, "fp", "left").select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    joined = materialize(joined, scratch_path(spark, "simhash-joined"))
    ids = joined.groupBy("label").agg(F.min("rep").alias("component_id"))
    ids = materialize(ids, scratch_path(spark, "simhash-ids"))
    return materialize(joined.join(ids, "label").select("fp", "label", "component_id"), scratch_path(spark, "simhash-of"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of each row."""
    spark = docs.sparkSession
    prints = materialize(fingerprints(docs, F.col("doc_id").cast("long").alias("doc_id")), scratch_path(spark, "simhash-fps"))
    return prints.join(classes_of(prints), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows that stay, one of each component: that of the smallest doc_id (NULL last), of the smallest text hash among
    rows of one id. Of rows repeated with the same id and text one stays. All columns are kept, whatever their names."""
    spark = docs.sparkSession
    doc_id, mark = F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")))
    prints = materialize(fingerprints(docs, doc_id.alias("doc_id"), mark.alias("mark")), scratch_path(spark, "simhash-fps"))
    labelled = prints.join(classes_of(prints), "fp")
    stays = labelled.groupBy("label").agg(F.min_by(F.struct("doc_id", "mark"), F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("k"))
    stays = materialize(stays.select(F.col("k.doc_id").alias("keep_id"), F.col("k.mark").alias("keep_mark")), scratch_path(spark, "simhash-stays"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), doc_id.alias("own_id"), mark.alias("own_mark"))
    on = rows.own_id.eqNullSafe(stays.keep_id) & (rows.own_mark == stays.keep_mark)
    kept = rows.join(stays, on, "left_semi")
    first = Window.partitionBy("own_id", "own_mark").orderBy(F.lit(0))
    return kept.withColumn("n", F.row_number().over(first)).filter("n = 1").select("doc.*")
