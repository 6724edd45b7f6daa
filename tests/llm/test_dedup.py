from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from feedloom.llm import line_dedup as lines
from feedloom.llm import simhash
from feedloom.llm.components import components
from feedloom.llm.exact_dedup import DigestIndex, deduplicate, exact_dedup
from feedloom.scratch import scratch_path
from tests.llm import brute
from tests.llm.conftest import edge_rows, ordered, tuples


def test_exact_dedup_matches_brute_force(edge):
    groups = defaultdict(list)
    for doc_id, text, *_ in edge_rows():
        groups[text or ""].append(doc_id)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha, seen = hashlib.sha256(text.encode()).hexdigest(), False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            expected.append((i, keep, len(ids), kept, sha))
    assert tuples(exact_dedup(edge), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == ordered(expected)


def test_exact_dedup_of_nothing(none):
    assert exact_dedup(none).collect() == []


def test_later_batches_meet_the_index(spark):
    index = DigestIndex(spark, scratch_path(spark, "index-test"), buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(9, "a"), (8, "c"), (7, "c")], "doc_id long, text string")
    assert tuples(deduplicate(first, index, "1"), "doc_id", "keep_id", "group_size", "kept") == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]
    expected = [(7, 8, 2, False), (8, 8, 2, True), (9, 2, 3, False)]
    assert tuples(deduplicate(second, index, "2"), "doc_id", "keep_id", "group_size", "kept") == expected
    # A batch sent again after its append gives the same result and adds nothing.
    assert tuples(deduplicate(second, index, "2"), "doc_id", "keep_id", "group_size", "kept") == expected
    assert index.rows().count() == 3
    # The index outlives the session's catalog.
    again = DigestIndex(spark, spark.sql(f"DESCRIBE FORMATTED {index.name}").filter("col_name = 'Location'").first()["data_type"], buckets=4)
    assert again.rows().count() == 3


def test_reopened_index_keeps_its_buckets(spark):
    """Whatever count is asked for, all texts are found again, and after the index has grown too."""
    path = scratch_path(spark, "index-reopened")
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    first = DigestIndex(spark, path, buckets=4)
    assert deduplicate(texts, first, "1").filter("kept").count() == 200
    first.close()
    again = DigestIndex(spark, path)
    assert again.buckets == 4
    assert deduplicate(texts, again, "2").filter("kept").count() == 0 and again.rows().count() == 200


def test_index_grows_with_its_rows(spark, monkeypatch):
    index = DigestIndex(spark, scratch_path(spark, "index-small"), buckets=4)
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    deduplicate(texts, index, "1").count()
    monkeypatch.setattr("feedloom.llm.exact_dedup.BUCKETS", 1)
    assert index.grown(scratch_path(spark, "index-large")) is index
    monkeypatch.setattr("feedloom.llm.exact_dedup.ROWS_PER_BUCKET", 25)
    grown = index.grown(scratch_path(spark, "index-large"))
    assert grown.buckets == 8
    assert deduplicate(texts, grown, "2").filter("kept").count() == 0


def test_index_without_its_bucket_count_is_refused(spark):
    path = scratch_path(spark, "index-unmarked")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="bucket count"):
        DigestIndex(spark, path)


def test_index_is_read_without_a_shuffle(spark):
    index = DigestIndex(spark, scratch_path(spark, "index-plan"), buckets=4)
    groups = spark.createDataFrame([(b"x", 1, 1)], "digest binary, keep_id long, n_rows long")
    index.append(groups, "1")
    plan = groups.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("part_bits", [lines.PART_BITS, 64])
def test_line_dedup_matches_brute_force(edge, part_bits):
    """Also with filters so full that every line is suspected."""
    expected = [(i, n, d, t) for i, n, d, t in brute.after_line_dedup(edge_rows())]
    found = lines.line_counts(edge, part_bits=part_bits)
    found = [(r[0], r[1], r[2], bytes(r[3]).decode()) for r in found.collect()]
    assert ordered(found) == ordered(expected)


def test_lost_keys_are_bounded_by_each_text(spark):
    """Rows without a doc_id, and of one doc_id: each text has its own list."""
    rows = [(i, f"line number {i} of many") for i in range(50)] + [(k, f"line number {i} of many\nown {k} text {i}") for k in (None, 99) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [len(r["keys"]) for r in lines.lost_keys(docs).collect()] == [1] * 100
    assert tuples(lines.drop_lines(docs), "doc_id", "text") == ordered((r[0], t[3]) for r, t in zip(rows, brute.after_line_dedup(rows)))


def test_drop_lines_keeps_rows_and_columns(edge):
    out = lines.drop_lines(edge)
    assert out.schema.names == edge.schema.names
    expected = [(r[0], None if r[1] is None else t[3], r[5], r[-1]) for r, t in zip(edge_rows(), brute.after_line_dedup(edge_rows()))]
    assert tuples(out, "doc_id", "text", "kept", "keep_id") == ordered(expected)


def test_line_dedup_of_nothing(none):
    assert lines.line_dedup(none).collect() == []
    assert lines.drop_lines(none).collect() == []


def test_filters_have_no_false_negatives():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    bloom, at = lines.Filter(1 << 16), lines.positions(hashes, 1 << 16)
    bloom.add(at[:, :4000])
    assert bloom.has(at[:, :4000]).all() and bloom.has(at[:, 4000:]).mean() < 0.1


def test_filters_grow_with_the_input():
    """90 million keys, as many as 30 GB hold: ten bits for each."""
    assert lines.part_bits_for(0, 6) == lines.part_bits_for(10**9, 6) == lines.PART_BITS
    bits = lines.part_bits_for(30 * 10**9, 6)
    assert bits % 8 == 0 and 10 * 90e6 < bits << 6 < 11 * 90e6
    assert lines.part_bits_for(10**15, 6) == lines.MOST_PART_BITS


def test_near_dedup_matches_brute_force(edge):
    rows = edge_rows()
    prints = [brute.simhash(r[1]) for r in rows]
    labels = brute.groups(prints)
    least = {}
    for row, label in zip(rows, labels):
        ids = [i for i in (least.get(label), row[0]) if i is not None]
        least[label] = min(ids, default=None)
    expected = [(r[0], f"{p:016x}", least[x]) for r, p, x in zip(rows, prints, labels)]
    assert tuples(simhash.near_dedup(edge), "doc_id", "fingerprint", "component_id") == ordered(expected)
    kept = simhash.one_of_each(edge)
    assert kept.schema.names == edge.schema.names
    assert kept.count() == len(set(labels))
    found = kept.select("doc_id", "text").collect()
    assert ordered((r[0],) for r in found) == ordered((least[x],) for x in set(labels))
    assert all((r[0], r[1]) in {(x[0], x[1]) for x in rows} for r in found)


def test_near_dedup_of_nothing(none):
    assert simhash.near_dedup(none).collect() == []
    assert simhash.one_of_each(none).collect() == []


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    """Random fingerprints with chains of near ones, in small tiles."""
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(7)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 150)} | {0, (1 << 64) - 1, 7, 127}
    for x in list(prints)[:60]:
        for _ in range(4):
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(bit)
            prints.add(x)
    prints |= {(1 << 40) ^ (1 << b) ^ (1 << c) for b in range(12) for c in range(b)}
    prints = sorted(prints)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    found = components(simhash.links(spark.createDataFrame(signed, "fp long").repartition(3))).collect()
    labels = {r["node"]: r["label"] for r in found}
    expected = brute.groups(prints)
    ours = defaultdict(set)
    for (s,), x in zip(signed, expected):
        ours[x].add(labels.get(s, s))
    assert all(len(v) == 1 for v in ours.values())
    assert len({next(iter(v)) for v in ours.values()}) == len(ours)


def test_forest_is_small_and_whole():
    rng = np.random.default_rng(3)
    a = np.array([int(x) << 8 | 5 for x in rng.integers(0, 8, 60)], np.int64)
    a = np.unique(np.concatenate([a, np.array([1 << k for k in range(40)], np.int64)]))
    left, right = simhash.forest(a, a, True)
    assert len(left) < len(a)
    prints = [int(x) for x in a]
    labels = brute.groups(prints)
    assert len(left) == len(a) - len(set(labels))


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    labels = components(spark.createDataFrame(chain, "a long, b long"))
    assert tuples(labels.groupBy("label").count(), "label", "count") == [(0, 101), (1000, 200)]
