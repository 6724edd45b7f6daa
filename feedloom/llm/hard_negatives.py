"""Hard negatives: rotated one-bit codes with stored alignments bound every inner product, and only what the bounds leave is scored.

Vectors become integers, ``floor(256 * x)``, and a score is the integer inner product of two of them. For each anchor its best rows of the
same label are its positives; for each positive the best rows of another label whose score is 80 to 100 % of the positive's are returned.

**Index.** A vector is rotated and each component replaced by its sign: a unit vector of one bit a dimension. The index keeps the bits, the
*alignment* (inner product of the vector with its code) and the length of what is left. What is left is rotated again and coded in the
same way, ``STAGES`` times. The rotations are made from a seed and fitted to nothing; every row is indexed.

**Search.** An anchor's rotated components are rounded to 8 bits, so that its product with a code is a sum of popcounts, one for each bit plane,
with a known rounding error. The rest is bounded by Cauchy-Schwarz: the residual is orthogonal to its code, so it can add no more than
its length times the length of the anchor's part orthogonal to that code. That is an interval that holds the score without exception. Rows whose interval
misses what is wanted go; the next code narrows the interval of the others, and those left after the last one are scored exactly.
So the result is that of brute force; what it saves is most of the exact scores.

**Spark.** Anchors are dealt by hash into groups of at most ``GROUP_BYTES``, one broadcast each; against each group every task reads its own part of
the index in blocks, so that no vector is shuffled and no key is hot. A task returns only the best rows of each slot (an anchor, or an
anchor with a positive); a bounded sample searched first tells scores that the best rows cannot be below, which spares candidates and changes nothing.
The rounds of a group are written before the next one begins.

Rows with a NULL label, a NULL vector or a NULL or non-finite component take no part, and neither do rows with components so large that a
score would not fit a long (``2**27 / sqrt(dimensions)``, scaled). Shorter vectors are filled up with zeros. A row without id
comes after all ids in ties. Rows repeated are rows of their own: a copy of an anchor can be its positive, and an anchor
repeated is mined for each of its rows. Very long vectors make the groups smaller. An empty table gives no rows. Other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.scratch import materialize, scratch_path

STAGES = 4
SEED = 12
PLANES = 8
GROUP_BYTES = 4 << 20
#: Rows searched first for lower limits.
SAMPLE = 4096
ANCHOR_BLOCK, ROW_BLOCK, PIECE = 128, 4096, 32_768
#: Candidates that a task holds before it keeps the best of each slot only.
HELD = 500_000
#: Bounds are widened by this share of the product of two lengths, far above what doubles round off.
SLACK = 1e-9


def rotations(dims: int) -> list[np.ndarray]:
    rng = np.random.default_rng(SEED)
    return [np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(STAGES)]


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits of the last axis as 64-bit words."""
    words = -(-bits.shape[-1] // 64)
    bytes_ = np.packbits(bits, axis=-1, bitorder="little")
    out = np.zeros((*bits.shape[:-1], 8 * words), np.uint8)
    out[..., : bytes_.shape[-1]] = bytes_
    return out.view(np.uint64)


def codes(vectors: np.ndarray, turns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, alignments, lengths of the residuals), each with one entry per stage."""
    rest, root = vectors.astype(np.float64), math.sqrt(vectors.shape[1])
    bits, alignments, lengths = [], [], []
    for turn in turns:
        rest = rest @ turn
        positive = rest >= 0
        alignment = np.abs(rest).sum(axis=1) / root
        rest = rest - np.where(positive, 1.0, -1.0) * (alignment / root)[:, None]
        bits.append(packed(positive))
        alignments.append(alignment)
        lengths.append(np.linalg.norm(rest, axis=1))
    return np.stack(bits, axis=1), np.stack(alignments, axis=1), np.stack(lengths, axis=1)


@dataclass
class Anchors:
    """A group of anchors, with what the search needs of each of them by stage."""

    ids: list
    labels: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    length: np.ndarray
    planes: np.ndarray
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    error: np.ndarray

    @classmethod
    def of(cls, ids: list, labels: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> Anchors:
        turned, by_stage = vectors.astype(np.float64), []
        for turn in rotations(vectors.shape[1]):
            turned = turned @ turn
            low = turned.min(axis=1)
            step = (turned.max(axis=1) - low) / (2**PLANES - 1)
            step[step == 0] = 1.0
            level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            rounded = low[:, None] + step[:, None] * level
            planes = packed((level[:, None, :] >> np.arange(PLANES)[None, :, None] & 1).astype(bool))
            by_stage.append((planes, low, step, rounded.sum(axis=1), np.abs(turned - rounded).sum(axis=1)))
        stacked = [np.stack(column, axis=1) for column in zip(*by_stage)]
        return cls(ids, labels, copies, vectors, np.linalg.norm(vectors.astype(np.float64), axis=1), *stacked)


@dataclass
class Wanted:
    """Per slot the scores that are wanted; slot ``k`` of anchor ``a`` is ``a * low.shape[1] + k``."""

    low: np.ndarray
    high: np.ndarray
    same_label: bool
    keep: int


@dataclass
class Rows:
    """A block of the index."""

    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    alignments: np.ndarray
    residuals: np.ndarray
    length: np.ndarray


def bounds(anchors: Anchors, rows: Rows, a, c, stage: int, counts: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(estimate, rounding error, residual bound) that one stage adds, from popcounts; ``a`` and ``c`` index anchors and rows."""
    root = math.sqrt(anchors.vectors.shape[1])
    dot = (2 * (anchors.low[a, stage] * ones + anchors.step[a, stage] * counts) - anchors.total[a, stage]) / root
    error = anchors.error[a, stage] / root
    along = np.maximum(np.abs(dot) - error, 0)
    across = np.sqrt(np.maximum(anchors.length[a] ** 2 - along**2, 0))
    alignment = rows.alignments[c, stage]
    return alignment * dot, alignment * error, rows.residuals[c, stage] * across


def plane_counts(words: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Sum of 2**p times the bits that the words share with plane p. The last axis of both is words; that of ``planes`` before it, planes."""
    total = np.zeros(np.broadcast_shapes(words.shape[:-1], planes.shape[:-2]), np.float64)
    for p in range(PLANES):
        for w in range(words.shape[-1]):
            total += np.float64(1 << p) * np.bitwise_count(words[..., w] & planes[..., p, w])
    return total


def candidates(anchors: Anchors, rows: Rows, wanted: Wanted, start: int, stop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(anchor, row) index pairs, a piece at a time, whose intervals meet what is wanted of anchors ``start`` to ``stop``."""
    a, c = np.arange(start, stop)[:, None], np.arange(len(rows.ids))[None, :]

    def meets(a, c, estimate, width):
        slack = width + SLACK * anchors.length[a] * rows.length[c] + 1e-6
        below, above = estimate - slack, estimate + slack
        found = np.zeros(estimate.shape, bool)
        for k in range(wanted.low.shape[1]):
            found |= (above >= wanted.low[a, k]) & (below <= wanted.high[a, k])
        return found

    ones = np.bitwise_count(rows.codes).sum(axis=-1, dtype=np.float64)
    counts = plane_counts(rows.codes[None, :, 0], anchors.planes[start:stop, None, 0])
    estimate, error, rest = bounds(anchors, rows, a, c, 0, counts, ones[c, 0])
    kept = meets(a, c, estimate, error + rest) & ((anchors.labels[a] == rows.labels[c]) == wanted.same_label)
    all_a, all_c = np.nonzero(kept)
    estimates, errors = estimate[all_a, all_c], error[all_a, all_c]
    for at in range(0, len(all_a), PIECE):
        piece = slice(at, at + PIECE)
        a, c, estimate, error = all_a[piece] + start, all_c[piece], estimates[piece], errors[piece]
        for stage in range(1, rows.codes.shape[1]):
            counts = plane_counts(rows.codes[c, stage], anchors.planes[a, stage])
            more, more_error, rest = bounds(anchors, rows, a, c, stage, counts, ones[c, stage])
            estimate, error = estimate + more, error + more_error
            left = meets(a, c, estimate, error + rest)
            a, c, estimate, error = a[left], c[left], estimate[left], error[left]
        if len(a):
            yield a, c


class Best:
    """The best rows of each slot among those seen; raises the slots' lower limits as it goes."""

    def __init__(self, wanted: Wanted) -> None:
        self.wanted = wanted
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def take(self, anchors: Anchors, rows: Rows, a: np.ndarray, c: np.ndarray) -> None:
        score = np.einsum("ij,ij->i", anchors.vectors[a], rows.vectors[c], dtype=np.int64, casting="safe")
        low, high = self.wanted.low, self.wanted.high
        for k in range(low.shape[1]):
            fits = (score >= low[a, k]) & (score <= high[a, k])
            fa, fc = a[fits], c[fits]
            same = (anchors.vectors[fa] == rows.vectors[fc]).all(axis=1) & self.wanted.same_label
            self.held.append((fa * low.shape[1] + k, score[fits], rows.ids[fc], rows.no_id[fc], same))
            self.size += len(fa)
        if self.size > HELD:
            self.held = [self.best()]
            self.size = len(self.held[0][0])

    def best(self) -> tuple[np.ndarray, ...]:
        slot, score, ids, no_id, same = (np.concatenate(column) for column in zip(*self.held))
        order = np.lexsort((ids, no_id, -score, slot))
        slot = slot[order]
        first = np.r_[True, slot[1:] != slot[:-1]]
        rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(first, np.arange(len(slot)), 0))
        order, slot, rank = order[rank < self.wanted.keep], slot[rank < self.wanted.keep], rank[rank < self.wanted.keep]
        full = rank == self.wanted.keep - 1
        a, k = np.divmod(slot[full], self.wanted.low.shape[1])
        self.wanted.low[a, k] = np.maximum(self.wanted.low[a, k], score[order][full])
        return slot, score[order], ids[order], no_id[order], same[order]


INDEX = "vec_id long, label long, vector binary, codes binary, alignments binary, residuals binary"


def vector_index(vectors: DataFrame, dims: int) -> DataFrame:
    """Each row's integers, codes, alignments and residuals as bytes; ``vectors`` has vec_id, label and embedding."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = rotations(dims)
        for batch in batches:
            for at in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(at, ROW_BLOCK)
                lists = part.column(2)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                whole = np.zeros((part.num_rows, dims), np.int32)
                whole[np.arange(dims)[None, :] < sizes[:, None]] = np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                columns = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (whole, *codes(whole, turns))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=names)

    names = ["vec_id", "label", "vector", "codes", "alignments", "residuals"]
    return vectors.select("vec_id", "label", "embedding").mapInArrow(encode, INDEX)


def matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """Values of one byte length as the rows of a matrix, without a copy of each."""
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset :][: len(column) + 1]
    if len(column) == 0:
        return np.zeros((0, width), kind)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].copy().view(kind).reshape(len(column), width)


def index_rows(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Rows]:
    words = -(-dims // 64)
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            ids, labels, vectors, bits, alignments, residuals = batch.slice(at, ROW_BLOCK).columns
            whole = matrix(vectors, np.int32, dims)
            yield Rows(
                np.asarray(ids.fill_null(0)),
                np.asarray(ids.is_null().to_numpy(zero_copy_only=False)),
                np.asarray(labels),
                whole,
                matrix(bits, np.uint64, STAGES * words).reshape(-1, STAGES, words),
                matrix(alignments, np.float64, STAGES),
                matrix(residuals, np.float64, STAGES),
                np.linalg.norm(whole.astype(np.float64), axis=1),
            )


FOUND = "slot long, score long, vec_id long, same boolean"


def search(index: DataFrame, shared, wanted: Wanted, dims: int) -> DataFrame:
    """The best rows of each slot: slot, score, vec_id, whether the row equals the anchor, and place (from 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = Best(Wanted(wanted.low.copy(), wanted.high, wanted.same_label, wanted.keep))
        for rows in index_rows(batches, dims):
            for start in range(0, len(anchors.ids), ANCHOR_BLOCK):
                stop = min(start + ANCHOR_BLOCK, len(anchors.ids))
                for a, c in candidates(anchors, rows, best.wanted, start, stop):
                    best.take(anchors, rows, a, c)
        if best.held:
            slot, score, ids, no_id, same = best.best()
            for at in range(0, len(slot), 10_000):
                p = slice(at, at + 10_000)
                arrays = [pa.array(slot[p]), pa.array(score[p]), pa.array(ids[p], mask=no_id[p]), pa.array(same[p])]
                yield pa.RecordBatch.from_arrays(arrays, names=["slot", "score", "vec_id", "same"])

    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), F.desc("same"))
    found = index.mapInArrow(run, FOUND).withColumn("place", F.row_number().over(order))
    return found.filter(F.col("place") <= wanted.keep)


def raised(sample: DataFrame, shared, wanted: Wanted, dims: int) -> Wanted:
    """What is wanted, with the limits that the rows of a sample set: the best rows of all are no worse than those of a part."""
    low = wanted.low.copy()
    for r in search(sample, shared, wanted, dims).filter(F.col("place") == wanted.keep).select("slot", "score").collect():
        at = divmod(r.slot, low.shape[1])
        low[at] = max(low[at], r.score)
    return Wanted(low, wanted.high, wanted.same_label, wanted.keep)


def anchor_group(rows: DataFrame, dims: int) -> Anchors:
    found = rows.select("vec_id", "label", "copies", "vector").toArrow()
    whole = np.frombuffer(b"".join(found.column("vector").to_pylist()), np.int32).reshape(-1, dims)
    return Anchors.of(found.column("vec_id").to_pylist(), found.column("label").to_numpy(), found.column("copies").to_numpy(), whole)


def positives_of(anchors: Anchors, found: list, n: int) -> tuple[list[list[tuple]], np.ndarray, np.ndarray]:
    """Each anchor's positives, and the scores wanted of negatives by slot. One row that equals the anchor is the anchor itself."""
    by_anchor: list[list] = [[] for _ in anchors.ids]
    for r in found:
        by_anchor[r.slot].append(r)
    low = np.ones((len(anchors.ids), n), np.int64)
    high = np.zeros((len(anchors.ids), n), np.int64)
    chosen = []
    for a, rows in enumerate(by_anchor):
        rows.sort(key=lambda r: r.place)
        own = next((r for r in rows if r.same and r.vec_id == anchors.ids[a]), None)
        others = [r for r in rows if r is not own][:n]
        chosen.append([(r.vec_id, r.score) for r in others])
        for k, r in enumerate(others):
            low[a, k], high[a, k] = -(-80 * r.score // 100), r.score
    return chosen, low, high


OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def named(found: DataFrame, anchors: Anchors, chosen: list[list[tuple]], n: int) -> DataFrame:
    """Slots as anchors and positives; an anchor that stands for several equal rows is returned for each."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [divmod(s, n) for s in batch.column(0).to_pylist()]
            again = np.repeat(np.arange(len(slots)), [int(anchors.copies[a]) for a, _ in slots])
            own = pa.array([anchors.ids[a] for a, _ in slots], pa.int64())
            positive = pa.array([chosen[a][k][0] for a, k in slots], pa.int64())
            scores = pa.array([chosen[a][k][1] for a, k in slots], pa.int64())
            columns = [own, positive, batch.column(3), batch.column(2), scores, batch.column(1)]
            for at in range(0, len(again), 10_000):
                yield pa.RecordBatch.from_arrays([c.take(pa.array(again[at : at + 10_000])) for c in columns], names=OUT)

    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return found.select("slot", "score", "vec_id", F.col("place").cast("int")).mapInArrow(name, schema)


def mine(vectors: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 5) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` holds; ``vectors`` has vec_id, label and embedding."""
    spark = vectors.sparkSession
    x = F.col("embedding")
    size = vectors.filter(x.isNotNull()).agg(F.max(F.size(x))).first()[0]
    dims = max(size or 1, 1)
    most = 2**27 / math.sqrt(dims) / 256
    usable = F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < most))
    rows = vectors.filter(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x)
    work = scratch_path(spark, "hard-negatives")
    index = materialize(vector_index(rows, dims), f"{work}/index")
    distinct = index.filter(anchor).groupBy("vec_id", "label", "vector").agg(F.count("*").alias("copies"))
    group_size = max(1, GROUP_BYTES // (4 * dims))
    anchors = materialize(distinct, f"{work}/anchors")
    n_groups = -(-anchors.count() // group_size)
    fraction = min(1.0, SAMPLE / max(index.count(), 1))
    group_of = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(max(n_groups, 1)))
    for g in range(n_groups):
        group = anchor_group(anchors.filter(group_of == g), dims)
        if not group.ids:
            continue
        shared = spark.sparkContext.broadcast(group)
        sample = index.sample(fraction, seed=SEED)
        shape = (len(group.ids), 1)
        wanted = Wanted(np.full(shape, -(2**62)), np.full(shape, 2**62), True, n_positives + 1)
        found = search(index, shared, raised(sample, shared, wanted, dims), dims).collect()
        chosen, low, high = positives_of(group, found, n_positives)
        wanted = raised(sample, shared, Wanted(low, high, False, n_negatives), dims)
        result = named(search(index, shared, wanted, dims), group, chosen, n_positives)
        result.write.parquet(f"{work}/found/group={g}")
        shared.destroy()
    if n_groups == 0:
        return spark.createDataFrame([], result_schema())
    return spark.read.schema(result_schema()).parquet(f"{work}/found/*")


def result_schema() -> str:
    return "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The registered query: every row whose id is divisible by 100 is an anchor; rows of every seventh id have the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), "embedding")
    return mine(rows, F.col("vec_id") % 100 == 0)
