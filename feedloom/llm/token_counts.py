"""Token counts without token ids: count-only Viterbi.

The automaton lists the vocabulary matches; for each position the program carries the best score and the number of pieces of
the path that has it, and nothing to trace back. Ties go as in the tokenizer itself: a path replaces another only if its score
is higher, and matches that end at one position come longest first. A character that is no piece counts as its UTF-8 bytes.

A very long text is counted whole, chunk by chunk; a very long chunk takes memory in proportion to itself and is not kept in the cache.

Defined results: a NULL or empty text has 0 tokens. Repeated rows are counted alike. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.lexicon import Lexicon, default_model, lexicon_of
from feedloom.llm.word_cache import WordCache

#: Chunks kept by a generation of a worker's cache: about 100 MB in all.
CACHED = 400_000


def count_pieces(lexicon: Lexicon, chunk: str) -> int:
    """The number of tokens of the best path through one chunk.

    best[p] is (score, -start of the last piece, tokens): of equal scores the longer last piece wins. A character without a
    piece of its own is relaxed when the scan reaches the position after it, before any piece starts there.
    """
    n = len(chunk)
    unknown = lexicon.unknown_score
    matches: list[list[tuple[float, int]]] = [[] for _ in range(n + 1)]
    for end, (_, score, length) in lexicon.automaton.iter(chunk):
        matches[end + 1].append((score, length))
    scores, tokens = [0.0] * (n + 1), [0] * (n + 1)
    for p in range(1, n + 1):
        best = None
        for score, length in matches[p]:
            total = scores[p - length] + score
            if best is None or total > best or total == best and length > longest:
                best, longest, count = total, length, tokens[p - length] + 1
        char = chunk[p - 1]
        if char not in lexicon.singles and (best is None or scores[p - 1] + unknown > best):
            best, count = scores[p - 1] + unknown, tokens[p - 1] + len(lexicon.fallback(char))
        scores[p], tokens[p] = best, count
    return tokens[n]


class Counter:
    def __init__(self, path: str) -> None:
        self.lexicon = lexicon_of(path)
        self.cache = WordCache(lambda chunks: (count_pieces(self.lexicon, c) for c in chunks), CACHED)

    def count(self, text: str) -> int:
        return sum(self.cache.values(self.lexicon.chunks(text)))


_counters: dict[str, Counter] = {}


def counter_of(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_chars and n_tokens of each row. One pass, no shuffle."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model)
        for batch in batches:
            counts = pa.array([counter.count(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["doc_id", "n_chars", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.length(text).cast("long").alias("n_chars"))
    return slim.mapInArrow(run, "doc_id long, n_chars long, n_tokens long")
