"""A corpus made ready for training: five stages over ``documents``, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents; the last one returns the documents of the
mix as SentencePiece ids. Each stage judges whole texts, whatever their length, and keeps every column that comes in, whatever its name. An empty
table stays empty through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import table
from feedloom.llm.line_dedup import drop_lines
from feedloom.llm.mixing import mixed
from feedloom.llm.quality import keep_good
from feedloom.llm.sentence_pieces import encode_whole
from feedloom.llm.simhash import one_of_each
from feedloom.scratch import materialize, scratch_path
from feedloom.sources.tables import read_optional


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands, which labelled documents narrow where there are any.

    A NULL or empty text has no words and goes. Rows repeated are judged alike and all stay or go; there are no ties.
    """
    return keep_good(docs, read_optional(spark, f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds. One left without any text stays, with an empty one.

    NULL texts stay NULL. Of documents with one line the smallest doc_id keeps it, NULL before any other; rows repeated under one doc_id are one
    document and keep their lines together.
    """
    return drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id.

    Texts without words, NULL ones among them, are one group. Of rows with the same doc_id one stays. Copies within 3 bits over 3-word shingles
    are near, as the operator's contract has it.
    """
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    A NULL source is a source, the last one. A text without words, or NULL, has size 0 and counts for nothing. Rows repeated are rows
    of their own, told apart by their number among their likes.
    """
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces, ids and whether they decode to the text again, one row per row of the mix.

    A NULL or empty text has no pieces. Of equally good paths the tokenizer's own tie rule decides. Rows repeated are encoded each.
    """
    return encode_whole(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix),
    ("sentence_pieces", encode),
]

# Compression ratios, fingerprints and the mix cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
