from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import canonical, oracle_connection
from feedloom.llm import hard_negatives as mining
from feedloom.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ordered, tuples

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score string, slot string, vector string, rank string"


def brute(rows):
    usable = []
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id is not None and vec_id % 7 == 0 else label
        usable.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (anchor_id, label, v) in enumerate(usable):
        if anchor_id is None or anchor_id % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), r is None, r or 0, r, other) for j, (r, other, w) in enumerate(usable) if j != i]
        scored.sort(key=lambda t: t[:3])
        for p in [t for t in scored if t[4] == label][:5]:
            near = [t for t in scored if t[4] != label and 80 * -p[0] <= 100 * -t[0] <= 100 * -p[0]]
            out += [(anchor_id, p[3], k + 1, n[3], -p[0], -n[0]) for k, n in enumerate(near[:5])]
    return ordered(out)


def some_rows(n, dims, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.12) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        vector = [x + rng.gauss(0, 0.08) for x in rng.choice(centres)]
        if i % 17 == 0:
            vector = rows[i // 3][1] if i else vector
        if i % 23 == 0:
            vector = rng.choice([None, [], [0.0] * dims, [*vector[:-1], None], [*vector[:-1], math.nan], [math.inf, *vector[1:]], vector[: dims // 2]])
        rows.append((None if i % 29 == 0 else i * 5, vector, None if i % 31 == 0 else rng.choice([-1, 0, 1, 2, 9])))
    rows += rows[:30] + [(200, [0.1] * dims, 1), (200, [0.2] * dims, 1)]
    return [(*r, "s", "t", "v", "r") for r in rows]


@pytest.mark.parametrize("dims", [5, 64, 70])
def test_matches_brute_force(spark, dims):
    rows = some_rows(400, dims, dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = tuples(mining.mine_hard_negatives(df), *mining.OUT)
    assert found == brute(rows) and len(found) > 50


def test_small_groups_blocks_and_samples_change_nothing(spark, monkeypatch):
    rows = some_rows(300, 16, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name, value in [("GROUP_BYTES", 4 * 16 * 9), ("ANCHOR_BLOCK", 2), ("ROW_BLOCK", 7), ("PIECE", 5), ("HELD", 10), ("SAMPLE", 50)]:
        monkeypatch.setattr(mining, name, value)
    assert tuples(mining.mine_hard_negatives(df), *mining.OUT) == brute(rows)


def test_matches_sql(spark):
    with oracle_connection(SMALL) as connection:
        theirs = connection.sql(ORACLES["op12_hard_negatives"]).df()
    assert canonical(QUERIES["op12_hard_negatives"](spark, SMALL).toPandas()) == canonical(theirs)
    assert len(theirs) > 20


def test_bounds_hold_and_leave_little_to_score():
    rng = np.random.default_rng(5)
    whole = np.floor(256 * rng.normal(0, 0.125, (3000, 64))).astype(np.int32)
    turns = mining.rotations(64)
    bits, alignments, residuals = mining.codes(whole, turns)
    length = np.linalg.norm(whole.astype(float), axis=1)
    ids, labels = np.arange(3000), np.zeros(3000, np.int64)
    rows = mining.Rows(ids, np.zeros(3000, bool), labels, whole, bits, alignments, residuals, length)
    anchors = mining.Anchors.of(list(range(20)), labels[:20], np.ones(20, int), whole[:20])
    scores = whole[:20].astype(np.int64) @ whole.T.astype(np.int64)
    sixth = np.sort(scores, axis=1)[:, -6]
    wanted = mining.Wanted(sixth[:, None], np.full((20, 1), 2**62), True, 6)
    left = [(a, c) for part_a, part_c in mining.candidates(anchors, rows, wanted, 0, 20) for a, c in zip(part_a, part_c)]
    above = set(zip(*np.nonzero(scores >= sixth[:, None])))
    assert above <= set(left) and len(left) < 0.1 * scores.size
    # Every stage's interval holds the score.
    a, c = np.arange(20)[:, None], np.arange(3000)[None, :]
    ones = np.bitwise_count(bits).sum(axis=-1, dtype=float)
    estimate, error = 0, 0
    for stage in range(mining.STAGES):
        counts = mining.plane_counts(bits[None, :, stage], anchors.planes[:, None, stage])
        more, more_error, rest = mining.bounds(anchors, rows, a, c, stage, counts, ones[c, stage])
        estimate, error = estimate + more, error + more_error
        assert (np.abs(scores - estimate) <= error + rest + 1e-6).all()


def test_hot_copies_and_groups(spark):
    """A third of all rows alike, some of them anchors: every one of them is mined."""
    rows = [(100, [0.5, 0.25], 1)] * 40 + [(i, [0.5, 0.24], 2) for i in range(1, 60)] + [(i * 100, [0.1 * i, 0.3], i % 3) for i in range(2, 30)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    assert tuples(mining.mine_hard_negatives(df), *mining.OUT) == brute(rows)


def test_huge_components_take_no_part(spark):
    rows = [(100, [1e30, 0.0], 1), (200, [0.5, 0.5], 1), (300, [0.5, 0.5], 1), (1, [0.45, 0.5], 2), (2, [-1e38, 1e38], 2)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    assert tuples(mining.mine_hard_negatives(df), *mining.OUT) == brute([r for r in rows if r[0] not in (100, 2)])


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mining.mine_hard_negatives(none).collect() == []
    assert mining.mine(none, F.lit(True)).collect() == []
