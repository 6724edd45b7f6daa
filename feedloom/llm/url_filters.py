"""URL filters: pattern rules indexed by their rarest literal token.

A rule can only match a URL that holds all of the rule's literal tokens, so it is filed under the one that the fewest URLs hold.
The tokens of a URL fetch the rules filed under them, and only those run their regular expressions. How many URLs hold a token is
counted over all of them.

Two kinds of rules, both of which become a regular expression with tokens:

* ``HostRule``: a host with all its subdomains and the beginning of a path. The longest one that fits decides.
* ``PatternRule``: a line in the common filter-list syntax over the lower-cased URL. ``||`` is the start of the host or of one of its parent
  domains, ``|`` the start or the end of the URL, ``*`` anything, ``^`` one separator or the end. These decide where no host rule fits: an
  ``allow`` that matches, else a ``block`` that matches, else ``allow``.

The rules are a parameter, not data: they are held by the driver and sent to the tasks, up to ``MOST_RULES`` of them. No URL is shuffled; a
host with a third of the pages is split like any other rows. NULL URLs and URLs without ``://`` have an empty host and path; a NULL
one also has no tokens. Very long URLs are judged whole. Repeated rows are judged each; there are no ties: of equally long host rules
``block`` wins, then the smaller text. An empty table gives no rows. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLOW, BLOCK = "allow", "block"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_LOWERED = str.maketrans(UPPER, LOWER)
TOKEN = re.compile("[a-z0-9]+")
#: Rules sent to every task, some 500 bytes each.
MOST_RULES = 200_000
#: One character that is none of a name, or the end.
SEPARATOR = "(?:[^a-z0-9_.%-]|$)"
HOST_START = r"^[^:/?#]*://(?:[^/?#]*\.)?"


@dataclass(frozen=True)
class HostRule:
    """``host`` is in lower case; ``path`` is empty or begins with a slash."""

    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path

    def regex(self) -> str:
        """Over the host and path of a URL, without anything between them."""
        return r"^(?:[^/]*\.)?" + re.escape(self.host) + (re.escape(self.path) if self.path else "(?=/|$)")

    def tokens(self) -> set[str]:
        return whole_tokens(f"|{self.text.translate(_LOWERED)}" + ("" if self.path else "|"))


@dataclass(frozen=True)
class PatternRule:
    verdict: str
    text: str

    def regex(self) -> str:
        """Over the lower-cased URL."""
        body = self.text.translate(_LOWERED)
        start = HOST_START if body.startswith("||") else "^" if body.startswith("|") else ""
        body = body.lstrip("|") if start else body
        end = "$" if body.endswith("|") else ""
        body = body[:-1] if end else body
        return start + "".join({"*": ".*", "^": SEPARATOR}.get(c, re.escape(c)) for c in body) + end

    def tokens(self) -> set[str]:
        return whole_tokens(self.text.translate(_LOWERED))


def whole_tokens(pattern: str) -> set[str]:
    """The tokens that every URL the pattern matches holds whole: not next to an open end or a ``*``."""
    found = set()
    for match in TOKEN.finditer(pattern):
        before, after = pattern[: match.start()][-1:], pattern[match.end() :][:1]
        if before not in ("", "*") and after not in ("", "*"):
            found.add(match[0])
    return found


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty where there is no ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return host.translate(_LOWERED), path


class RuleIndex:
    """Rules by their rarest token; rules without a usable token are tried on every URL."""

    def __init__(self, hosts: Iterable[HostRule], patterns: Iterable[PatternRule], holders: dict[str, int]) -> None:
        self.filed: dict[str, list] = {}
        self.always: list = []
        for rule in dict.fromkeys([*hosts, *patterns]):
            tokens = rule.tokens()
            entry = (rule, re.compile(rule.regex(), re.DOTALL))
            if tokens:
                self.filed.setdefault(min(tokens, key=lambda t: (holders.get(t, 0), t)), []).append(entry)
            else:
                self.always.append(entry)

    def candidates(self, lowered: str) -> Iterator[tuple]:
        yield from self.always
        for token in set(TOKEN.findall(lowered)):
            yield from self.filed.get(token, ())

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None]:
        """(host, path, host rule, verdict, pattern rule)."""
        host, path = split_url(url)
        lowered = (url or "").translate(_LOWERED)
        fits, matches = [], []
        for rule, regex in self.candidates(lowered):
            if isinstance(rule, HostRule):
                if host and regex.match(host + path):
                    fits.append(rule)
            elif url is not None and regex.search(lowered):
                matches.append(rule)
        if fits:
            best = min(fits, key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))
            return host, path, best.text, best.verdict, None
        if matches:
            best = min(matches, key=lambda r: (r.verdict != ALLOW, r.text))
            return host, path, None, best.verdict, best.text
        return host, path, None, ALLOW, None


def token_holders(urls: DataFrame, url: str, tokens: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each of the given tokens; at most one row a token comes to the driver."""
    if not tokens:
        return {}
    held = F.array_distinct(F.regexp_extract_all(F.translate(F.col(url), UPPER, LOWER), F.lit(TOKEN.pattern), F.lit(0)))
    rows = urls.select(F.explode(held).alias("token")).filter(F.col("token").isin(list(tokens))).groupBy("token").count()
    return {r["token"]: r["count"] for r in rows.collect()}


def filter_urls(
    pages: DataFrame,
    hosts: Sequence[HostRule],
    patterns: Sequence[PatternRule] = (),
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Each row's ``page_id`` with host, path, the host rule that decided, the verdict and the pattern rule that decided."""
    if len(hosts) + len(patterns) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    tokens = sorted(set().union(*(rule.tokens() for rule in [*hosts, *patterns])))
    holders = token_holders(rows, "url", tokens)
    schema = T.StructType([rows.schema["page_id"], *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict", "pattern"))])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(hosts, patterns, holders)
        for batch in batches:
            found = list(zip(*map(index.judge, batch.column(1).to_pylist()))) or [()] * 5
            columns = [pa.array(values, pa.string()) for values in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return rows.mapInArrow(judged, schema)


#: The rules of the registered query: those of its contract, then patterns for what they leave undecided.
HOST_RULES = (
    HostRule(ALLOW, "org", "/"),
    HostRule(BLOCK, "example.org", "/es/"),
    HostRule(BLOCK, "example.org", "/en/1"),
    HostRule(ALLOW, "com", "/fr/"),
    HostRule(BLOCK, "com", "/de/"),
)
PATTERN_RULES = (
    PatternRule(BLOCK, "||spam-farm."),
    PatternRule(BLOCK, "?page=*&ref="),
    PatternRule(BLOCK, "^utm_source=feed|"),
    PatternRule(ALLOW, "^es^*?page="),
)


def judge_pages(pages: DataFrame) -> DataFrame:
    return filter_urls(pages, HOST_RULES, PATTERN_RULES)
