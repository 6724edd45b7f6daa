from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto

from feedloom.llm import quality, token_files
from feedloom.llm.lexicon import SPACE, default_model, lexicon_of
from feedloom.llm.sentence_pieces import decode, encode, encode_and_decode, encoder_of
from feedloom.llm.token_counts import counter_of, token_counts
from feedloom.llm.word_cache import WordCache
from feedloom.scratch import scratch_path
from tests.llm import brute
from tests.llm.conftest import edge_rows, ordered, prose, tuples


def test_quality_measures_match_brute_force(edge):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = [(r[0], *brute.base_measures(r[1])) for r in edge_rows()]
    assert tuples(quality.measured(edge), *names) == ordered(expected)


def test_quality_verdicts(edge, none):
    out = quality.keep_good(edge)
    assert out.schema == edge.schema
    assert {r["text"] for r in out.collect()} == {r[1] for r in edge_rows() if r[1] and quality.judge(r[1].encode(), zstandard.ZstdCompressor(level=3))[-1]}
    assert quality.measured(none).collect() == [] and quality.keep_good(none).collect() == []


@pytest.mark.parametrize(
    "text, kept",
    [
        (prose(1, 30), True),
        (prose(2, 400), True),
        (prose(3, 30000), True),
        (" ".join(base64.b64encode(random.Random(i).randbytes(45)).decode() for i in range(60)), False),
        (" ".join(f"row {i} value" for i in range(4000)), False),
        ("".join(map(chr, random.Random(5).choices(range(32, 127), k=9000))), False),
        (prose(4, 2000) + " " + " ".join(f"a b c d e {i}" for i in range(4000)), False),
    ],
    ids=["short", "middling", "long", "base64", "repetitive", "noise", "repetitive chunks"],
)
def test_compression_bands(text, kept):
    assert quality.judge(text.encode(), zstandard.ZstdCompressor(level=3))[-1] == kept


@pytest.mark.parametrize("clean, junk", [(4096, 0), (8191, 0), (8192, 500), (4096, 4095), (8192, 4095), (4096, 2000), (8192, 3000)])
@pytest.mark.parametrize("kind", ["base64", "counter"])
def test_chunks_cover_every_byte(clean, junk, kind):
    """Junk after clean text, in texts of less than two chunks and in the last bytes of longer ones."""
    bad = {
        "base64": " ".join(base64.b64encode(random.Random(i).randbytes(45)).decode() for i in range(100)),
        "counter": " ".join(f"a b c d e {i}" for i in range(500)),
    }[kind].encode()[:junk]
    good = prose(6, 3000).encode()[:clean]
    assert len(good) == clean and len(bad) == junk
    verdict = quality.judge(good + bad, zstandard.ZstdCompressor(level=3))
    assert verdict[-3] >= verdict[-4] / 5 if junk >= 1024 else verdict[-1]
    assert verdict[-1] == (junk < 1024) and verdict[-4] == (0 if clean + junk <= 4096 else -(-(clean + junk) // 4096))


def reference(path: str, tmp_path):
    """The public library over the same pieces as a unigram model. Its sums are single floats, so pieces with the score that
    means "never" (below any rank) get one that single floats can add up."""
    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    for piece in model.pieces:
        piece.score = max(piece.score, -40000.0)
    model.trainer_spec.model_type = 1
    other = tmp_path / "unigram.model"
    other.write_bytes(model.SerializeToString())
    return str(other), SentencePieceProcessor(model_file=str(other))


def test_encoding_matches_the_library(tmp_path):
    path, library = reference(default_model(), tmp_path)
    encoder, counter = encoder_of(path), counter_of(path)
    texts = [prose(i, 30) for i in range(60)] + [r[1] for r in edge_rows() if r[1] and len(r[1]) < 400]
    for text in texts:
        ids = encoder.encode(text).tolist()
        assert ids == library.encode(text)
        assert counter.count(text) == len(ids)


def test_encoding_matches_brute_force():
    """Whole texts, uncut, with the file's own scores."""
    lexicon, encoder = lexicon_of(default_model()), encoder_of(default_model())
    pieces = {p: v[:2] for p in lexicon.automaton.keys() for v in [lexicon.automaton.get(p)]}
    for text in [prose(8, 60), "a  b   c\n\nd 你好 \x00 ▁▁ e", edge_rows()[18][1]]:
        normal = SPACE + text.replace(" ", SPACE)
        expected = []
        for start, _, number in brute.best_path(pieces, lexicon.unknown_score, normal):
            expected += [number] if number >= 0 else lexicon.fallback(normal[start])
        assert encoder.encode(text).tolist() == expected
        assert counter_of(default_model()).count(text) == len(expected)


def test_encoding_round_trip(edge, none):
    encoded = encode(edge)
    assert tuples(decode(encoded), "doc_id", "text") == ordered((r[0], (r[1] or "").replace(SPACE, " ")) for r in edge_rows())
    digest = encode_and_decode(edge).collect()
    assert all(r["round_trip"] for r in digest)
    crcs = [(r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in encoded.collect()]
    assert ordered((r["doc_id"], r["n_pieces"], r["ids_crc32"]) for r in digest) == ordered(crcs)
    assert tuples(token_counts(edge), "doc_id", "n_tokens") == ordered((i, n) for i, n, _ in crcs)
    assert encode(none).collect() == [] and encode_and_decode(none).collect() == [] and token_counts(none).collect() == []


def test_cache_stays_small_and_right():
    cache = WordCache(lambda words: [w * 2 for w in words], 5)
    for i in range(100):
        words = [f"w{(i * j) % 37}" for j in range(4)]
        assert list(cache.values(words)) == [w * 2 for w in words]
    assert len(cache.young) <= 9 and len(cache.old) <= 9


def test_token_files_match_the_library(edge):
    tokenizer = token_files.words_of(token_files.default_vocabulary()).tokenizer
    rows = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in edge_rows()]
    found = token_files.token_files(edge).collect()
    crcs = [(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in rows]
    assert ordered((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == ordered(crcs)
    by_start = sorted(found, key=lambda r: r["start"])
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in by_start]
    assert ids == sorted(ids)
    ends = [r["start"] + r["n_tokens"] for r in by_start]
    assert [r["start"] for r in by_start] == [0, *ends[:-1]]


def test_batches_of_texts_match_the_library():
    """Every slice size, the second vocabulary whole, broken UTF-8, odd white space."""
    import public_tokenizers

    rng = np.random.default_rng(3)
    odd = ["", " ", "a", "\x1c", "\x85", "\u2003", "É", "İ", "'s", "don't", "1", "２", "<|endoftext|>", "\n\t ", "ﬁ", "e\u0301", "\x0b", ".", "中文", "🙂", "x" * 3000]
    texts = ["".join(rng.choice(odd, rng.integers(0, 12))) for _ in range(800)] + [r[1] or "" for r in edge_rows()]
    for name, fast in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        encoder = token_files.Words(public_tokenizers.path(name))
        assert encoder.by_words == fast
        want = [np.array(e.ids, encoder.dtype).tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert list(encoder.ids(pa.array([t.encode() for t in texts], pa.binary()))) == want
    encoder = token_files.words_of(token_files.default_vocabulary())
    broken = [b"ab\xc3 c\xff", b"fine"]
    want = [np.array(encoder.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u2").tobytes() for t in broken]
    assert list(encoder.ids(pa.array(broken, pa.binary()))) == want
    assert list(encoder.ids(pa.array([], pa.binary()))) == []


@pytest.mark.parametrize("size", [1, 7, 10**9])
def test_slices_keep_every_text(size, monkeypatch):
    monkeypatch.setattr(token_files, "SLICE", size)
    texts = pa.array(["", "a" * 9, "", "bb", "", "", "c" * 30, ""])
    parts = list(token_files.slices(texts))
    assert [t for p in parts for t in p.to_pylist()] == texts.to_pylist()
    assert all(len(p) == 1 or sum(map(len, p.to_pylist())) <= size for p in parts)


def test_paths_are_on_the_default_file_system(spark, tmp_path):
    """A path without a scheme is where Spark has it."""
    assert token_files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert token_files.file_system(f"file:{tmp_path}")[1] == str(tmp_path)
    assert token_files.file_system("dbfs:/a/b")[1] == "/dbfs/a/b"


def test_long_chunks_do_not_stay_in_the_cache():
    """50,000 distinct chunks of 2,000 characters leave less than a megabyte."""
    cache = WordCache(lambda words: [w[:4] for w in words], 100_000)
    for start in range(0, 50_000, 1000):
        words = [f"{i:06d}" + "x" * 1994 for i in range(start, start + 1000)] + ["short"]
        assert list(cache.values(words)) == [w[:4] for w in words]
    assert sum(map(len, [*cache.young, *cache.old])) < 1_000_000


def test_token_files_of_nothing(none):
    assert token_files.token_files(none).collect() == []


def test_shuffled_reads_use_the_offset_index(spark, edge):
    path = scratch_path(spark, "token-files-test")
    vocabulary = token_files.default_vocabulary()
    token_files.write_records(edge, path, vocabulary, 3)
    dtype = token_files.words_of(vocabulary).dtype
    tokenizer = token_files.words_of(vocabulary).tokenizer
    expected = [(r[0], *tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2) for r in edge_rows()]
    one, two = (token_files.read_shuffled(spark, path, seed, dtype).collect() for seed in (1, 2))
    for read in (one, two):
        assert ordered((r["doc_id"], *r["ids"]) for r in read) == ordered(expected)
    assert [r["ids"] for r in one] != [r["ids"] for r in two]


def test_damage_is_found():
    record = token_files.frame(7, np.array([1, 2, 3], "<u2").tobytes())
    doc_id, ids, end = token_files.read_record(record, 0, np.dtype("<u2"))
    assert (doc_id, ids.tolist(), end) == (7, [1, 2, 3], len(record))
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.read_record(bytes(broken), 0, np.dtype("<u2"))
    with pytest.raises(ValueError):
        token_files.read_record(record[:-1], 0, np.dtype("<u2"))


def plain_verdict(text: str | None, limits) -> bool:
    """The verdict written anew: whole text, then every chunk, by slices and lists."""
    data = (text or "").encode()
    squeezed = zstandard.ZstdCompressor(level=3)

    def ratio(part):
        return len(part) / len(squeezed.compress(part))

    def wide(n):
        low, high = 0.0, 6.0
        for least, first, last in quality.BANDS:
            if n >= least:
                low, high = first, last
        return low, high

    if brute.base_measures(text)[-1]:
        return False
    low, high = limits.get(len(data).bit_length() - 1, wide(len(data)))
    if not low <= ratio(data) <= high:
        return False
    if len(data) <= 4096:
        return True
    pieces = [data[i : i + 4096] for i in range(0, len(data), 4096)]
    out = 0
    for i, piece in enumerate(pieces):
        full = piece if len(piece) == 4096 else data[-4096:]
        bad = not 1.35 <= ratio(full) <= 4.2
        if len(piece) < 4096 and len(piece) >= 1024:
            bad = bad or not wide(len(piece))[0] <= ratio(piece) <= wide(len(piece))[1]
        out += bad
    return out * 5 <= len(pieces)


def test_fitted_limits_hold_on_documents_held_out(spark):
    """Fitted to one half of the labelled documents: at least half of the bad ones that pass the base rules go, at most 1 % of the good ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    bands = quality.fitted_bands(docs, labels.filter(half == 0))
    assert bands == quality.fitted_bands(docs.repartition(5), labels.filter(half == 0).unionByName(labels.filter(half == 0)))
    judged = quality.measured(docs.join(labels.filter(half == 1), "doc_id"), bands).filter("NOT base_failed").join(labels, "doc_id")
    found = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert found[0, False] >= found[0, True]
    assert found.get((1, False), 0) * 100 <= found[1, True] + found.get((1, False), 0)


def test_fitted_verdicts_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, prose(3000 + i, rng.randint(20, 250)), 1) for i in range(400)]
    rows += [(1000 + i, " ".join([prose(i, 12)] + [f"row {j} of {i}" for j in range(rng.randint(20, 200))]), 0) for i in range(40)]
    rows += [(2000 + i, prose(7000 + i, 3000), None) for i in range(3)] + [(None, prose(8, 50), 1), (2003, None, 1), (2004, "", 1), (0, rows[0][1], 1)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5, 0), (6, None)], "doc_id long, quality int")
    ratios = {}
    for i, text, label in rows:
        if i is not None and label == 1 and i not in (5, 6) and not brute.base_measures(text)[-1]:
            data = text.encode()
            ratios.setdefault(len(data).bit_length() - 1, []).append(round(len(data) / len(zstandard.ZstdCompressor(level=3).compress(data)), 4))
    limits = {}
    for k, found in ratios.items():
        if len(found) >= 50:
            low, high = np.percentile(found, [0.5, 99.5])
            wide = quality.ratio_band(1 << k)
            limits[k] = (max(wide[0], low / 1.02), min(wide[1], high * 1.02))
    assert limits
    got = quality.quality_rules(docs, labels)
    assert tuples(got, "doc_id", "kept") == ordered((i, plain_verdict(t, limits)) for i, t, _ in rows)
    assert not all(r["kept"] for r in got.filter("doc_id >= 1000 AND doc_id < 2000").collect())
    kept = quality.keep_good(docs, labels)
    assert tuples(kept, "doc_id", "text") == ordered((i, t) for i, t, _ in rows if plain_verdict(t, limits))


def test_no_labels_keep_the_wide_limits(spark, edge, none):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fitted_bands(edge, None) == quality.fitted_bands(edge, empty) == quality.fitted_bands(none, empty) == quality.BANDS


def test_limits_are_fitted_to_every_labelled_document(spark):
    """50,100 labelled documents, one more kind of them than a sample of 50,000 has room for: all that are left out of a fit show in it."""
    rng = random.Random(4)
    texts = [prose(9000 + i, rng.randint(25, 35)) for i in range(60)]
    docs = spark.range(50_100).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 60 + 1).cast("int")).alias("text")
    )
    drawn = {r[0] for r in docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(50_000).select("doc_id").collect()}
    rest = docs.select(F.col("doc_id"), F.when(F.col("doc_id").isin([i for i in range(50_100) if i not in drawn]), prose(5, 700)).otherwise(F.col("text")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    long = prose(5, 700).encode()
    bands = quality.fitted_bands(rest, labels)
    low, high = quality.ratio_band(len(long), bands)
    ratio = round(len(long) / len(zstandard.ZstdCompressor(level=3).compress(long)), 4)
    assert (low, high) == (ratio / quality.MARGIN, ratio * quality.MARGIN) != quality.ratio_band(len(long))
