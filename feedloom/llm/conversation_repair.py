"""Conversation structure repair: the cheapest edits that make a conversation alternate, found by bidirectional Dijkstra.

The rows of a conversation are put in order of their turn (NULL first, rows of one turn by a digest of role and text). Each row's first
fault counts: *blank* (white space only), *duplicate* (role and text seen earlier in the conversation) or *truncated* (its last
character besides white space is none of ``.!?``). Edits are Keep (0), Rerole to user or assistant (1), Delete (2, the only edit
of blank and duplicate rows) and Insert of an empty row of either role (5); a truncated row that is not deleted adds 5. The
initials of the roles must end up as ``(s?(ua)+)?``. Of the cheapest ways the one whose initials (``DIKR``), in order, are least in
ASCII is taken.

The edit lattice has a node for each number of rows done and each state of that pattern. A forward heap starts at the beginning and a
reverse heap at the end; both go on until no path of the best cost can be missed, so that every crossing of that cost is known, and of
these the least audit, prefix and suffix put together, wins. Least prefixes and suffixes are enough, because two different ways of one cost to a node
are never one the beginning of the other.

Three steps, none of which holds the texts of a conversation:

1. rows become a digest and flags of a few bytes, with repeats told by counting digests;
2. these are sorted by range, so that a long conversation is spread over tasks, and cut into segments of at most ``SEGMENT`` rows. A
   conversation within one task's range is solved at once; of others each segment is solved from every state to every state;
3. segments and rows meet sorted by conversation: the segments' ways are joined to an audit, and the rows then stream past it.

The last step has one task per conversation because the hash of a whole conversation can only be made in order; it holds one
character a row (five while the audit is put together) and no text but the current batch's.

NULL roles and texts count as one space. NULL conversation ids are one conversation. A role's initial is its first character; an empty role has none and cannot
be kept. Repeated rows are duplicates. A conversation without rows costs nothing, with an empty audit. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import SPACES
from feedloom.scratch import materialize, scratch_path

SEGMENT = 1024
DELETE, RETEXT, REROLE, INSERT = 2, 5, 1, 5
MAX_LONG = 2**63 - 1
# States of the pattern: nothing yet, after s, after u, after a. The next row is an assistant after u, else a user.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# A row's code: d must be deleted; s, u, a, x by its initial, in upper case if truncated.
CODES = "dsuaxSUAX"
MOVE = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def row_steps(code: str) -> list[tuple[int, int, int, str]]:
    """(state, next state, cost, letter) of every edit that uses up a row."""
    steps = [(state, state, DELETE, "D") for state in NEXT]
    if code != "d":
        extra, kept = (RETEXT if code.isupper() else 0), STATE_OF.get(code.lower())
        for state, following in NEXT.items():
            steps.append((state, following, REROLE + extra, "R"))
            if kept == following or (state == START and kept == SYSTEM):
                steps.append((state, kept, extra, "K"))
    return steps


def by_state(steps: list[tuple[int, int, int, str]], reverse: bool) -> list[list[tuple[int, int, str]]]:
    table: list[list[tuple[int, int, str]]] = [[] for _ in NEXT]
    for state, following, cost, letter in steps:
        here, there = (following, state) if reverse else (state, following)
        table[here].append((there, cost, letter))
    return table


ONWARD = {code: by_state(row_steps(code), False) for code in CODES}
BACK = {code: by_state(row_steps(code), True) for code in CODES}
INSERT_STEPS = [(state, following, INSERT, "I") for state, following in NEXT.items()]
INSERT_ONWARD, INSERT_BACK = by_state(INSERT_STEPS, False), by_state(INSERT_STEPS, True)


def cheapest(codes: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, least audit) of the edits that lead from ``entry`` to one of ``exits``, or ``None`` if none do.

    A node is 4 * rows done + state. Labels are (cost, audit so far). Rows are free to keep, so that equal costs are settled in order of
    the rows done: forward from the first, in reverse from the last.
    """
    n = len(codes)

    def onward(node: int) -> Iterator[tuple[int, int, str]]:
        done, state = divmod(node, 4)
        if done < n:
            for there, cost, letter in ONWARD[codes[done]][state]:
                yield 4 * done + 4 + there, cost, letter
        for there, cost, letter in INSERT_ONWARD[state]:
            yield 4 * done + there, cost, letter

    def back(node: int) -> Iterator[tuple[int, int, str]]:
        done, state = divmod(node, 4)
        if done:
            for there, cost, letter in BACK[codes[done - 1]][state]:
                yield 4 * done - 4 + there, cost, letter
        for there, cost, letter in INSERT_BACK[state]:
            yield 4 * done + there, cost, letter

    ahead = {entry: (0, "")}
    behind = {4 * n + state: (0, "") for state in exits}
    heap, reverse_heap = [(0, entry)], [(0, -node) for node in sorted(behind, reverse=True)]
    settled, reverse_settled = set(), set()
    best = min((ahead[v][0] + behind[v][0] for v in ahead.keys() & behind.keys()), default=float("inf"))
    while heap or reverse_heap:
        top = heap[0][0] if heap else float("inf")
        reverse_top = reverse_heap[0][0] if reverse_heap else float("inf")
        if top + reverse_top > best:
            break
        if top <= reverse_top:
            cost, node = heappop(heap)
            if node in settled:
                continue
            settled.add(node)
            prefix = ahead[node][1]
            for there, step, letter in onward(node):
                label = (cost + step, prefix + letter)
                if there not in ahead or label < ahead[there]:
                    ahead[there] = label
                    heappush(heap, (label[0], there))
                if there in behind:
                    best = min(best, label[0] + behind[there][0])
        else:
            cost, node = heappop(reverse_heap)
            node = -node
            if node in reverse_settled:
                continue
            reverse_settled.add(node)
            suffix = behind[node][1]
            for there, step, letter in back(node):
                label = (cost + step, letter + suffix)
                if there not in behind or label < behind[there]:
                    behind[there] = label
                    heappush(reverse_heap, (label[0], -there))
                if there in ahead:
                    best = min(best, label[0] + ahead[there][0])
    if best == float("inf"):
        return None
    # Every label is a way that exists, so unsettled ones do no harm; those of the best cost are all here.
    audits = [ahead[v][1] + behind[v][1] for v in ahead.keys() & behind.keys() if ahead[v][0] + behind[v][0] == best]
    for node in settled:
        cost, prefix = ahead[node]
        for there, step, letter in onward(node):
            if there in behind and cost + step + behind[there][0] == best:
                audits.append(prefix + letter + behind[there][1])
    return int(best), min(audits)


#: Short conversations repeat the same few codes; 64 characters each bound the cache to some 30 MB.
_whole_short = lru_cache(50_000)(lambda codes: cheapest(codes, START, ENDS))


def whole_moves(codes: str) -> list[tuple[int, int, int, str]]:
    found = _whole_short(codes) if len(codes) <= 64 else cheapest(codes, START, ENDS)
    return [(START, ASSISTANT, *found)]


def part_moves(codes: str) -> list[tuple[int, int, int, str]]:
    """The best way from each state to each state that can be reached from it."""
    ways = ((entry, leave, cheapest(codes, entry, (leave,))) for entry in NEXT for leave in NEXT)
    return [(entry, leave, *found) for entry, leave, found in ways if found]


def joined(ways: dict[int, tuple[int, str]], moves: list[dict]) -> dict[int, tuple[int, str]]:
    """The best way to each state after one more segment."""
    found: dict[int, tuple[int, str]] = {}
    for move in moves:
        if move["entry"] in ways:
            cost, audit = ways[move["entry"]]
            label = (cost + move["cost"], audit + move["audit"])
            if move["exit"] not in found or label < found[move["exit"]]:
                found[move["exit"]] = label
    return found


def turns(conversations: DataFrame) -> DataFrame:
    """The rows in the form that the steps below take; ``present`` is false for a row that only names its conversation."""
    return conversations.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(0).alias("copy"),
        F.lit(True).alias("present"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """A known damage to repair, by a checksum of conversation and turn: dropped, emptied, unpunctuated, repeated, made a user's."""
    rows = turns(conversations)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
        (kind != 0).alias("present"),
    )


def digest() -> Column:
    """128 bits of SHA-256 over conversation, role and text, each preceded by its length."""
    parts = [F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("role"), F.col("text")]
    marked = [F.col("conv_id").isNull().cast("string"), *[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)]]
    return F.unhex(F.substring(F.sha2(F.concat(*marked).cast("binary"), 256), 1, 32))


def flags(rows: DataFrame) -> DataFrame:
    """A few bytes for each row instead of its text; ``later`` marks one whose role and text an earlier turn of its conversation holds.

    Digests are counted before they are shuffled. Only those found in more than one turn are joined back, a side that adaptive
    execution may broadcast if it is small and that else is split where one digest holds too many rows.
    """
    bare = F.regexp_replace("text", f"[{SPACES}]+$", "")
    light = rows.select(
        "conv_id",
        "turn",
        digest().alias("digest"),
        "copy",
        F.substring("role", 1, 1).alias("initial"),
        (bare == "").alias("is_blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("is_cut"),
        "present",
    )
    present = light.filter("present").groupBy("digest").agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_if(F.col("turn").isNull()).alias("nulls"))
    several = present.filter("least < most OR (nulls > 0 AND most IS NOT NULL)")
    first = F.when(F.col("nulls") == 0, F.col("least"))
    later = F.col("nulls").isNotNull() & ~F.col("turn").eqNullSafe(first)
    joined_rows = light.join(several, "digest", "left")
    return joined_rows.select(*light.columns, later.alias("later"))


MOVE_TYPE = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
SEGMENT_FIELDS = (
    "turn long, digest binary, seq int, blank long, duplicate long, truncated long, illegal long, "
    f"first_turn long, last_turn long, n_turns long, first_initial string, last_initial string, n_rows long, moves {MOVE}"
)


class Segment:
    """What is known of consecutive rows of one conversation."""

    def __init__(self, conv, turn, key, seq: int) -> None:
        self.conv, self.turn, self.key, self.seq = conv, turn, key, seq
        self.codes: list[str] = []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.turns: list[int | None] = [None, None, 0]
        self.initials: list[str | None] = [None, None]

    def add(self, turn, initial: str, blank: bool, repeat: bool, cut: bool) -> None:
        fault = "blank" if blank else "duplicate" if repeat else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        code = initial if initial in STATE_OF else "x"
        self.codes.append("d" if blank or repeat else code.upper() if cut else code)
        if self.codes[1:]:
            self.counts["illegal"] += self.initials[1] + initial not in ("su", "ua", "au")
        else:
            self.initials[0] = initial
        self.initials[1] = initial
        if turn is not None:
            if self.turns[2] == 0:
                self.turns[0] = turn
            self.turns[2] += turn != self.turns[1]
            self.turns[1] = turn

    def row(self, whole: bool) -> tuple:
        codes = "".join(self.codes)
        keys = ("entry", "exit", "cost", "audit")
        moves = [dict(zip(keys, m)) for m in (whole_moves(codes) if whole else part_moves(codes))]
        return (self.conv, self.turn, self.key, self.seq, *self.counts.values(), *self.turns, *self.initials, len(codes), moves)


def cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment | None]:
    """The segments of sorted rows; ``None`` after the last one of each conversation."""
    segment, previous, seq = None, None, 0
    for batch in batches:
        for conv, turn, key, _, initial, blank, cut, present, later in zip(*(c.to_pylist() for c in batch.columns)):
            other = segment is None or segment.conv != conv
            if other or (len(segment.codes) == SEGMENT and present):
                if segment is not None:
                    yield segment
                    if other:
                        yield None
                if other:
                    previous = None
                seq += 1
                segment = Segment(conv, turn, key, seq)
            if present:
                segment.add(turn, initial, blank, later or (turn, key) == previous, cut)
                previous = (turn, key)
    if segment is not None:
        yield segment
        yield None


def solved(segments: Iterator[Segment | None]) -> Iterator[tuple]:
    """Each segment with its ways. Of a conversation in one segment the best whole way is enough, if rows of other ones before and after
    it show that no other task holds more of it."""
    current, several, finished, single = None, False, 0, None
    for segment in segments:
        if segment is None:
            if several:
                yield current.row(whole=False)
            else:
                single = current
            current, several, finished = None, False, finished + 1
            continue
        if single is not None:
            yield single.row(whole=finished > 1)
            single = None
        if current is not None:
            yield current.row(whole=False)
            several = True
        current = segment
    if single is not None:
        yield single.row(whole=False)


def segment_table(rows: DataFrame) -> DataFrame:
    """One row per segment with its ways, from flags that are sorted by range here.

    Rows alike in conversation, turn and digest are always in one task.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "copy")
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(SEGMENT_FIELDS).fields])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, pa.int64(), pa.binary(), pa.int32(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), MOVE_TYPE]

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                types[0] = batch.schema.field(0).type
                yield batch

        for found in blocks(solved(cut_segments(typed(batches)))):
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*found), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return sorted_rows.mapInArrow(solve, schema)


def blocks(rows: Iterator[tuple], size: int = 1000) -> Iterator[list[tuple]]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


class Conversation:
    """A conversation's segments put together, then its rows as they come by."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first_turn = self.last_turn = self.last_initial = None
        self.n_turns, self.ways = 0, {START: (0, "")}
        self.audit: str | None = None
        self.cost, self.done, self.state, self.position = 0, 0, START, 0

    def add(self, s: dict) -> None:
        for name in COUNTS:
            self.counts[name] += s[name]
        self.ways = joined(self.ways, s["moves"])
        if s["n_rows"]:
            if self.last_initial is not None:
                self.counts["illegal"] += self.last_initial + s["first_initial"] not in ("su", "ua", "au")
            self.last_initial = s["last_initial"]
        if s["n_turns"]:
            self.n_turns += s["n_turns"] - (s["first_turn"] == self.last_turn)
            self.first_turn = s["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = s["last_turn"]

    def settle(self) -> None:
        self.cost, self.audit = min(self.ways[state] for state in ENDS if state in self.ways)
        self.ways = {}

    def inserted(self) -> Iterator[tuple]:
        """The rows inserted before the next row of the input, or at the end."""
        while self.audit[self.done : self.done + 1] == "I":
            self.done += 1
            self.state = NEXT[self.state]
            yield self.out("I", ROLE_OF[self.state], "")

    def take(self, role: str, text: str) -> Iterator[tuple]:
        """What becomes of the next row of the input."""
        yield from self.inserted()
        edit = self.audit[self.done]
        self.done += 1
        if edit == "R":
            self.state = NEXT[self.state]
            yield self.out("R", ROLE_OF[self.state], text)
        elif edit == "K":
            self.state = STATE_OF[role[:1]]
            yield self.out("K", role, text)

    def out(self, edit: str, role: str, text: str) -> tuple:
        self.position += 1
        return self.conv, self.position - 1, edit, role, text

    @property
    def gaps(self) -> int:
        return min(self.last_turn - self.first_turn + 1 - self.n_turns, MAX_LONG) if self.n_turns else 0


def repaired_rows(batches: Iterator[pa.RecordBatch], at_end: Callable[[Conversation], None]) -> Iterator[tuple]:
    """The rows of the repaired conversations from segments and rows sorted so that a conversation's segments come first."""
    current = None
    for batch in batches:
        for conv, segment, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text"))):
            if current is None or current.conv != conv:
                if current is not None:
                    yield from finished(current, at_end)
                current = Conversation(conv)
            if segment is not None:
                current.add(segment)
                continue
            if current.audit is None:
                current.settle()
            yield from current.take(role, text)
    if current is not None:
        yield from finished(current, at_end)


def finished(conversation: Conversation, at_end: Callable[[Conversation], None]) -> Iterator[tuple]:
    if conversation.audit is None:
        conversation.settle()
    yield from conversation.inserted()
    at_end(conversation)


def meeting(rows: DataFrame) -> DataFrame:
    """Segments and rows by conversation, in order. The flags are written once: a range sort reads its input twice."""
    light = materialize(flags(rows), scratch_path(rows.sparkSession, "conversation-flags"))
    segments = segment_table(light)
    fields = [c for c in segments.columns if c not in ("conv_id", "turn", "digest", "seq")]
    heads = segments.select(
        "conv_id", F.lit(0).alias("kind"), "turn", "digest", "seq", F.struct(*fields).alias("segment"),
        *[F.lit(None).cast("string").alias(c) for c in ("role", "text")],
    )
    bodies = rows.filter("present").select(
        "conv_id", F.lit(1).alias("kind"), "turn", digest().alias("digest"), F.col("copy").alias("seq"),
        F.lit(None).cast(heads.schema["segment"].dataType).alias("segment"), "role", "text",
    )
    both = heads.unionByName(bodies).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "digest", "seq")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, edit (K, R or I), role and text. ``rows`` as of ``turns``."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL("position long, edit string, role string, text string").fields])

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field(0).type
                yield batch

        for found in blocks(repaired_rows(typed(), lambda conversation: None)):
            types = [conv_type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=schema.names)

    return meeting(rows).mapInArrow(repair, schema)


REPORT_FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair, and the SHA-256 of the repaired ``role:text`` lines."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(REPORT_FIELDS).fields])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, found, sha = None, [], hashlib.sha256()

        def at_end(c: Conversation) -> None:
            nonlocal sha
            found.append((c.conv, c.gaps, *c.counts.values(), c.cost, c.audit, sha.hexdigest()))
            sha = hashlib.sha256()

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field(0).type
                yield batch

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        for _, position, _, role, text in repaired_rows(typed(), at_end):
            sha.update(f"\n{role}:{text}".encode() if position else f"{role}:{text}".encode())
            if len(found) >= 1000:
                yield batch_of(found)
                found.clear()
        if found:
            yield batch_of(found)

    return meeting(rows).mapInArrow(report, schema)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The report over conversations with the known damage."""
    return repair_report(damaged(conversations))
