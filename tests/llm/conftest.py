from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

#: Names that the operators use inside; documents may bring them along.
CLASHING = ["kept", "size", "fp", "label", "doc", "keys", "h", "rank", "copies", "digest", "batch", "n", "__bucket", "ids", "keep_id"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = ["the", "of", "and", "to", "in", "erha", "thon", "ing", "tion", "wh", "stre", "éa", "ou", "ble", "ent"]
    out = []
    for i in range(words):
        out.append("".join(rng.choices(parts, k=rng.randint(1, 3))) + rng.choice(["", "", "", ",", "."]))
        out.append("\n" if rng.random() < 0.1 else " ")
    return "".join(out).strip()


def edge_rows() -> list[tuple]:
    """NULLs in every column, empty and very long texts, copies and near copies, repeated rows, odd characters."""
    base, other = prose(1, 60), prose(2, 300)
    texts = [
        None, "", "  \t\n ", "one", "two words", base, base, base.replace("the", "The", 1), base + " Extra", other, other.upper(),
        "A shared line of text\nonly here now\n" + prose(3, 40), "  a SHARED line of text \t\nsomething else\nshort\nshort\n" + prose(4, 40),
        "A shared line of text", "a shared line of text\na shared line of text\n\n" + prose(5, 30),
        "buy now cheap pills today only here " * 40, prose(6, 20000), prose(7, 25) + " ### $$$ |a| <b> 100%",
        "non breaking space\x1cunit ▁ mark  double   triple \x00 nul 你好 🙂 é don't it's <|endoftext|> ﬁ İstanbul",
        "x", "short line\nshort line", "A".join(["", "b"] * 60), "\n\n\n", "0123456789" * 300,
    ]
    rows = []
    for i, text in enumerate(texts):
        source = [None, "a", "b", "é", "Z", "a", "a"][i % 7]
        rows.append((i * 3 % 41, text, None if i % 5 == 0 else "en", source, None if i % 4 == 0 else len(text or "")))
    rows += [(None, base, "en", "a", 1), (None, "only without id, a line of text", None, None, None), (None, None, None, None, None)]
    rows += [rows[5], rows[5], rows[0], rows[-1], (rows[5][0], "another text of the same id " + other[:200], "en", "b", 5)]
    rows += [(100 + i, prose(50 + i // 3, 20 + i), "de", "abc"[i % 3], 9) for i in range(30)]
    rows += [(200 + i, other, "en", "a", 9) for i in range(25)]
    return [(*r, *[f"{c}{i}" for c in CLASHING]) for i, r in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df, *columns):
    """Sorted tuples; NULL sorts first."""
    found = (tuple(r) for r in df.select(*columns).collect())
    return ordered(found)


def ordered(rows):
    return sorted(rows, key=lambda t: [(v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v) for v in t])
