from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import duckdb
import pytest

from checks.compare import canonical
from feedloom.llm import conversation_repair as repair
from feedloom.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ordered, tuples

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, audit string, digest string, present string, kind int, seq int"
ROLES = ["system", "user", "assistant", "tool", "ux", "", None]


def least_repair(rows):
    """(cost, audit, roles and texts) by trying every edit in turn, from the last row back; rows are (role, text, fault)."""
    known = {}

    def best(i, tail, inserted):
        if (i, tail, inserted) not in known:
            ways = []
            if i == len(rows) and re.fullmatch("|.*a", tail):
                ways.append((0, "", ()))
            options = []
            if inserted < 2:
                options += [(5, "I", r, "", i, inserted + 1) for r in ("user", "assistant")]
            if i < len(rows):
                role, text, fault = rows[i]
                options.append((2, "D", None, "", i + 1, 0))
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    options.append((more, "K", role, text, i + 1, 0))
                    options += [(more + 1, "R", r, text, i + 1, 0) for r in ("user", "assistant")]
            for cost, letter, role, text, j, n in options:
                grown = tail
                if role is not None:
                    pair = tail[-1:] + role[:1]
                    if role == "" or pair not in ("s", "u", "su", "ua", "au"):
                        continue
                    grown = pair[-1]
                rest = best(j, grown, n)
                if rest:
                    row = () if role is None else ((role, text),)
                    ways.append((cost + rest[0], letter + rest[1], row + rest[2]))
            known[i, tail, inserted] = min(ways) if ways else None
        return known[i, tail, inserted]

    return best(0, "", 0)


def expected_report(rows, damage=True):
    conversations = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        kept = conversations[conv]
        blank = lambda v: " " if v is None else v
        role, text = blank(role), blank(text)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in conversations.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest_of(conv, r[1], r[2])))
        seen, faults = set(), []
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            faults.append(fault)
            seen.add((role, text))
        numbers = {t for t, *_ in kept if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, fixed = least_repair([(r, t, f) for (_, r, t), f in zip(kept, faults)])
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha))
    return ordered(out)


def digest_of(conv, role, text):
    parts = ["" if conv is None else str(conv), role, text]
    return hashlib.sha256(("true" if conv is None else "false").encode() + "".join(f"{len(p)}:{p}" for p in parts).encode()).digest()[:16]


def some_rows(n_conversations, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randint(0, 9)):
            text = rng.choice(["Fine. ", "Cut off", "", " \t\n", "Again!\n", "Why?\x0b", "Same.", "x" * 5000 + ".", None, "…"])
            role = rng.choice(ROLES) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            number = None if rng.random() < 0.1 else turn + 3 * (rng.random() < 0.1)
            rows.append((conv, number, role, text))
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (None, 2, "assistant", "Yes."), (None, 2, "assistant", "Yes.")]
    rows += rows[:15] + [(900, -(2**62), "user", "Far."), (900, 2**62, "assistant", "Apart.")]
    return [(*r, "a", "d", "p", 1, 2) for r in rows]


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame(some_rows(120, 1), SCHEMA).repartition(3)


def test_report_matches_brute_force(conversations):
    assert tuples(repair.repair_conversations(conversations), *COLUMNS) == expected_report(some_rows(120, 1))


@pytest.mark.parametrize("segment", [1, 3])
def test_segments_give_the_same(spark, conversations, monkeypatch, segment):
    """However a conversation is cut and spread, its repair is the same."""
    rows = repair.turns(conversations)
    whole = tuples(repair.repair_report(rows), *COLUMNS)
    assert whole == expected_report(some_rows(120, 1), damage=False)
    monkeypatch.setattr(repair, "SEGMENT", segment)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tuples(repair.repair_report(rows), *COLUMNS) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_search_matches_brute_force_on_every_short_conversation():
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for n in range(4):
        for codes in map("".join, product(repair.CODES, repeat=n)):
            rows = [(roles.get(c.lower(), "user"), "t", "blank" if c == "d" else "truncated" if c.isupper() else None) for c in codes]
            assert repair.cheapest(codes, repair.START, repair.ENDS) == least_repair(rows)[:2], codes


def test_one_long_conversation_is_spread_over_tasks(spark):
    """A hot conversation is cut by range before it is solved; only its audit and its rows in order meet in one task."""
    rows = [(7, t, ["user", "assistant"][t % 3 == 0], f"Text {t}.") for t in range(5000)] + [(t, 0, "user", "Hi.") for t in range(100, 200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    light = repair.flags(repair.turns(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        segments = [r for r in repair.segment_table(light).collect() if r.conv_id == 7]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(r.n_rows for r in segments) == 5000 and max(r.n_rows for r in segments) <= repair.SEGMENT
    assert len({r.seq for r in segments}) < len(segments)
    found = repair.repair_report(repair.turns(df)).filter("conv_id = 7").collect()[0]
    assert (found.cost, found.audit) == repair.cheapest("".join("a" if t % 3 == 0 else "u" for t in range(5000)), repair.START, repair.ENDS)


def test_repaired_rows_alternate(conversations):
    rows = repair.repaired(repair.damaged(conversations)).collect()
    by_conversation = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.position):
        by_conversation[r.conv_id].append(r)
    for found in by_conversation.values():
        assert [r.position for r in found] == list(range(len(found)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in found))
        assert all(r.edit in "KRI" and (r.edit != "I" or r.text == "") for r in found)


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(none).collect() == []
    assert repair.repaired(repair.turns(none)).collect() == []


@pytest.mark.parametrize("rows", ["table", "odd"])
def test_matches_sql(spark, conversations, tmp_path, rows):
    """The small table, and rows with every kind of fault."""
    folder = "/root/testdata/sf0.001"
    if rows == "odd":
        folder = str(tmp_path)
        conversations.select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    found = QUERIES["op11_conversation_repair"](spark, folder).toPandas()
    with duckdb.connect() as connection:
        files = f"{folder}/conversations.parquet" + ("/*.parquet" if rows == "odd" else "")
        connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{files}')")
        theirs = connection.sql(ORACLES["op11_conversation_repair"]).df()
    assert canonical(found) == canonical(theirs) and len(found) > 10


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, turn, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert tuples(repair.repair_conversations(df), *COLUMNS) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
