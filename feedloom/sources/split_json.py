"""Read large indented JSON documents with many tasks each.

A multi-line document cannot be split by the JSON reader: one task parses one file. Its lines can, and JSON allows no line break inside a
string, so that a line never begins within one. What a block of lines cannot know is how deeply nested it begins. So the text is read
twice. First every block tells its effect on the stack of open brackets: how many it closes that it did not open, and which, with their keys, it
leaves open. Effects are carried over a file's blocks in order, which is one short row per block on the driver, as many as the
scan has splits. Then every block, told its stack, cuts out the records that begin and end in it, and the pieces of those that do not; the
pieces, at most two a block, are put together, and each record is parsed on its own.

The result is what ``unnest(read_documents(…))`` gives, but that the text of a number may be spelt another way (1e-07, 1.0E-7). A document that is not well-formed (unbalanced, cut off, with an unreadable
record or anything but records in its list) is left to that reader, whole, which sends it to quarantine. A document on a single line is one
block; such documents are read by ``read_documents`` with ``multi_line=False``, of which each line is one document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.scratch import materialize, scratch_path
from feedloom.sources.feeds import CORRUPT, SNAPSHOT, FeedSpec, document_schema, read_documents, unnest

TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s"{}\[\]:,]+|"')
BRACKETS = {"}": "{", "]": "["}
#: The open brackets above a record, each with the key that it is the value of.
ABOVE = ["{", "{response", "[data"]
MOST_BLOCKS = 2_000_000


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines in the order of their file within each block; where Spark splits the files is where a block begins."""
    text = spark.read.text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """((file, name, block), its lines) of consecutive rows."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    row = next(rows, None)
    while row is not None:
        key = row[:3]

        def own() -> Iterator[str]:
            nonlocal row
            while row is not None and row[:3] == key:
                yield row[3]
                row = next(rows, None)

        lines = own()
        yield key, lines
        for _ in lines:
            pass


UNKNOWN = "\0"


class Brackets:
    """The stack of open brackets, each with the key it is the value of, and the string that may turn out to be the next key.

    Of a block whose beginning is unknown, ``closed`` collects the brackets it closes beyond its own, and the key before its first token is
    ``UNKNOWN``.
    """

    def __init__(self, stack: list[str] | None = None, key: str | None = UNKNOWN, named: bool = False) -> None:
        self.stack, self.key, self.named = list(stack or []), key, named
        self.closed: list[str] = []
        self.broken = False

    def take(self, token: str) -> None:
        if token in "{[":
            self.stack.append(token + (self.key if self.key is not None and (self.named or self.key == UNKNOWN) else ""))
            self.key, self.named = None, False
        elif token in "}]":
            if self.stack:
                self.broken |= self.stack.pop()[0] != BRACKETS[token]
            else:
                self.closed.append(BRACKETS[token])
            self.key, self.named = None, False
        elif token == ":":
            self.named = True
        elif token == ",":
            self.key, self.named = None, False
        else:
            self.broken |= token == '"'
            self.key, self.named = (token[1:-1] if token[0] == '"' and not self.named else None), False

    def then(self, closed: list[str], opened: list[str], key: str | None, named: bool) -> None:
        """Carry these on over a block with the given effect."""
        for bracket in closed:
            self.broken |= not self.stack or self.stack.pop()[0] != bracket
        self.stack += [b.replace(UNKNOWN, self.key or "") for b in opened]
        if key == UNKNOWN:
            self.named = self.named or named
        else:
            self.key, self.named = key, named


EFFECT = "file string, name string, block long, closed array<string>, opened array<string>, key string, named boolean, broken boolean"


def effects(lines: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for key, text in blocks(batches):
            state = Brackets()
            for line in text:
                for match in TOKEN.finditer(line):
                    state.take(match[0])
            rows.append((*key, state.closed, state.stack, state.key, state.named, state.broken))
        if rows:
            strings = pa.list_(pa.string())
            types = [pa.string(), pa.string(), pa.int64(), strings, strings, pa.string(), pa.bool_(), pa.bool_()]
            names = ["file", "name", "block", "closed", "opened", "key", "named", "broken"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return lines.mapInArrow(run, EFFECT)


def beginnings(found: list) -> tuple[dict[tuple[str, int], tuple[list[str], str | None, bool]], set[str]]:
    """The state at the beginning of each block, and the files that are not well-formed."""
    starts, broken = {}, set()
    state, file = Brackets(key=None), None
    for row in sorted(found, key=lambda r: (r["file"], r["block"])):
        if row["file"] != file:
            if file is not None and (state.stack or state.broken):
                broken.add(file)
            state, file = Brackets(key=None), row["file"]
        starts[file, row["block"]] = (list(state.stack), state.key, state.named)
        state.broken |= row["broken"]
        state.then(row["closed"], row["opened"], row["key"], row["named"])
    if file is not None and (state.stack or state.broken):
        broken.add(file)
    return starts, broken


WHOLE, TAIL, MIDDLE, HEAD, LIST = range(5)
PIECE = "file string, name string, block long, seq long, kind int, text string"


def pieces(lines: DataFrame, shared) -> DataFrame:
    """Records, pieces of records, and one row of kind LIST a block that tells of its list: how many commas, and whether anything else was there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = shared.value
        rows: list[tuple] = []
        for key, text in blocks(batches):
            state = Brackets(*starts[key[0], key[2]])
            inside = len(state.stack) > len(ABOVE) and state.stack[:3] == ABOVE
            part: list[str] = []
            kind, commas, lists, odd, seq, last = MIDDLE, 0, 0, False, 0, ""
            for line in text:
                begin = 0
                for match in TOKEN.finditer(line):
                    token = match[0]
                    if not inside and state.stack == ABOVE:
                        if token == "{":
                            inside, kind, part, begin = True, TAIL, [], match.start()
                        elif token == ",":
                            commas += 1
                        odd |= token not in "{,]" or token == last
                        last = token
                    state.take(token)
                    lists += token == "[" and state.stack == ABOVE
                    if inside and state.stack == ABOVE:
                        part.append(line[begin : match.end()])
                        rows.append((*key, seq, WHOLE if kind == TAIL else HEAD, "\n".join(part)))
                        inside, part, seq = False, [], seq + 1
                        if len(rows) >= 5000:
                            yield as_batch(rows)
                            rows = []
                if inside:
                    part.append(line[begin:])
            if inside and part:
                rows.append((*key, seq, kind, "\n".join(part)))
            rows.append((*key, seq + 1, LIST, f"{commas} {lists} {int(odd)}"))
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "name", "block", "seq", "kind", "text"])

    return lines.mapInArrow(run, PIECE)


def read_records(spark: SparkSession, spec: FeedSpec, path: str | list[str]) -> DataFrame:
    """The records of all documents under ``path``, with their snapshot, as ``unnest`` gives them."""
    lines = lines_of(spark, path)
    work = scratch_path(spark, f"split-{spec.name}")
    known = materialize(effects(lines), f"{work}/effects")
    if known.count() > MOST_BLOCKS:
        raise ValueError(f"more than {MOST_BLOCKS} blocks; raise spark.sql.files.maxPartitionBytes")
    starts, broken = beginnings(known.collect())
    found = materialize(pieces(lines, spark.sparkContext.broadcast(starts)), f"{work}/pieces")

    # Of a record in several blocks, its pieces follow each other; there are at most two a block.
    cut = found.filter(F.col("kind").isin(TAIL, MIDDLE, HEAD))
    order = Window.partitionBy("file").orderBy("block", "seq")
    numbered = cut.withColumn("nth", F.count_if(F.col("kind") == TAIL).over(order))
    joined = numbered.groupBy("file", "name", "nth").agg(F.sort_array(F.collect_list(F.struct("block", "seq", "text"))).alias("parts"))
    joined = joined.select("file", "name", F.array_join(F.col("parts.text"), "\n").alias("text"))
    texts = found.filter(F.col("kind") == WHOLE).select("file", "name", "text").unionByName(joined)

    schema = document_schema(spec)["response"].dataType["data"].dataType.elementType
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("text", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    records = materialize(texts.select("file", "name", parsed.alias("parsed")), f"{work}/records")

    # A list of n records has n - 1 commas. A document without such a list, or with two, may have another shape altogether.
    lists = F.split("text", " ")
    number = lambda i: F.sum(F.when(F.col("kind") == LIST, lists[i].cast("long")))
    begun = F.count_if(F.col("kind").isin(WHOLE, TAIL))
    told = found.groupBy("file").agg(begun.alias("n"), number(0).alias("commas"), number(1).alias("lists"), number(2).alias("odd"))
    wrong = told.filter("odd > 0 OR lists <> 1 OR commas <> greatest(n - 1, 0)").select("file")
    unreadable = records.filter(F.col(f"parsed.{CORRUPT}").isNotNull()).select("file")
    left = sorted({*broken, *(r[0] for r in wrong.unionByName(unreadable).distinct().collect())})

    fields = F.struct(*[F.col(f"parsed.`{f.name}`").alias(f.name) for f in schema.fields])
    good = records.filter(~F.col("file").isin(left)) if left else records
    good = good.select(fields.alias("record"), F.lit(None).cast("string").alias(CORRUPT), F.col("name").alias(SNAPSHOT))
    return good.unionByName(unnest(read_documents(spark, spec, left))) if left else good
