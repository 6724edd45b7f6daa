"""Plain versions of the operators over lists of (doc_id, text, source)."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def base_measures(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def key_of(line: str) -> str:
    return line.strip(SPACES).translate(LOWER)


def after_line_dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, lines, dropped, text that stays) of each row."""
    holders: dict[str, set] = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(doc_id)
    first = {}
    for key, ids in holders.items():
        if len(key) >= 10 and len(ids) >= 2:
            first[key] = min(i for i in ids if i is not None)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key_of(x) not in first or doc_id == first[key_of(x)]]
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def simhash(text: str | None) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(prints: list[int]) -> list[int]:
    """The number of each fingerprint's component."""
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def targets(sizes: dict) -> dict:
    """Targets by sharing out the excess again and again. Keys: sources in order."""
    total, weights = 1.5 * sum(sizes.values()), {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    aim, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while open_ and left > 1e-9:
        whole = sum(weights[s] for s in open_)
        for s in open_:
            aim[s] += left * weights[s] / whole
        left = 0.0
        for s in list(open_):
            if aim[s] >= 2 * sizes[s]:
                left += aim[s] - 2 * sizes[s]
                aim[s] = 2.0 * sizes[s]
                open_.discard(s)
    return aim


def in_order(sources) -> list:
    return sorted(set(sources), key=lambda s: (s is None, s or ""))


def best_path(pieces: dict[str, tuple[int, float]], unknown: float, text: str) -> list[tuple[int, int, int]]:
    """(start, end, piece or -1) of the best path through the text, by trying every piece at every position."""
    n, longest = len(text), max(map(len, pieces))
    best: list = [None] * (n + 1)
    best[0] = (0.0, 0, -1)
    for start in range(n):
        for end in range(start + 1, min(n, start + longest) + 1):
            found = pieces.get(text[start:end])
            if found is None and end > start + 1:
                continue
            number, score = found or (-1, unknown)
            total = best[start][0] + score
            if best[end] is None or total > best[end][0]:
                best[end] = (total, start, number)
    path = []
    while n:
        path.append((best[n][1], n, best[n][2]))
        n = best[n][1]
    return path[::-1]


def multiset(rows) -> Counter:
    return Counter(rows)
