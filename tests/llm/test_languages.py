"""Language identification against a plain Python fusion of the same evidence, written anew."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from feedloom.llm import language

WORDS = {"en": "the of and house water through with tree", "de": "der und wasser haus durch mit baum nicht", "fr": "le et maison eau avec arbre pas dans"}


def grams(text):
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return found


def fused(pages, labelled):
    """{page_id: (language, probability)}; pages are (page_id, url, declared, text)."""
    languages = sorted({lang for _, lang, _ in labelled})
    counts = {lang: sum((grams(t) for _, x, t in labelled if x == lang), Counter()) for lang in languages}
    known = set().union(*counts.values())
    sums = {lang: sum(counts[lang][g] + 0.5 for g in known) for lang in languages}
    log = {g: [math.log((counts[lang][g] + 0.5) / sums[lang]) for lang in languages] for g in known}

    def normal(scores):
        weights = [math.exp(s - max(scores)) for s in scores]
        return [w / sum(weights) for w in weights]

    rows = []
    for page_id, url, declared, text in pages:
        found = {g: n for g, n in grams(text).items() if g in known}
        n = sum(found.values())
        scale = min(1.0, language.EFFECTIVE / n) if n else 1.0
        scores = [scale * sum(c * (log[g][i] - sum(log[g]) / len(languages)) for g, c in found.items()) for i in range(len(languages))]
        host = re.match("[a-z]+://([^/]+)", url)[1] if url else ""
        keys = {"host": host, "domain": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "declared": declared}
        rows.append((page_id, scores, normal(scores), keys))
    all_counts = [sum(p[i] for _, _, p, _ in rows) for i in range(len(languages))]
    by = defaultdict(lambda: [0.0] * len(languages))
    for _, _, p, keys in rows:
        for kind, value in keys.items():
            by[kind, value] = [a + b for a, b in zip(by[kind, value], p)]
    out = []
    for page_id, scores, p, keys in rows:
        rest = {kind: [max(c - own, 0.0) for c, own in zip(by[kind, value], p)] for kind, value in keys.items()}
        prior = [(c + 1) / (len(rows) + len(languages)) for c in all_counts]
        if keys["host"]:
            for kind in ("domain", "host"):
                prior = [(c + language.KAPPA * q) / (sum(rest[kind]) + language.KAPPA) for c, q in zip(rest[kind], prior)]
        total = [s + math.log(q) for s, q in zip(scores, prior)]
        for kind in ("declared", "suffix"):
            if keys[kind]:
                share = (sum(rest[kind]) + 1) / (len(rows) + 1)
                total = [t + math.log((c + language.SMOOTH * share) / (max(whole, 1e-9) + language.SMOOTH)) for t, c, whole in zip(total, rest[kind], all_counts)]
        out.append((page_id, languages[total.index(max(total))], max(normal(total))))
    return out


def test_fusion_matches_plain_python(spark):
    """Sparse and contradicting evidence, hosts of very different size, a very long page, rows repeated, clashing columns."""
    rng = random.Random(8)

    def say(lang, n):
        return " ".join(rng.choices(WORDS[lang].split(), k=n))

    labelled = [(i, lang, say(lang, 12)) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    pages = []
    for i in range(150):
        lang = rng.choice(["en", "en", "de", "fr"])
        host = "big.example.org" if i % 3 == 0 else f"s{i % 20}.example.{rng.choice([lang, 'com'])}"
        said = rng.choice([lang, lang, "en", "", "xx"])
        pages.append((i, rng.choice([f"http://{host}/p{i}", ""]), said, say(lang, rng.choice([0, 1, 3, 40]))))
    pages += [(1000, "http://big.example.org/", "de", say("fr", 20_000)), (1001, "", "", ""), pages[0], pages[0], (1002, "http://only.here/", "", "")]
    rows = [(i, u or None, (f'<html lang="{d}">' if d else "") + f"<p>{t}</p>", "x", "y", 1.0, "z") for i, u, d, t in pages]
    schema = "page_id long, url string, html string, lang string, host string, p double, ll string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    documents = spark.createDataFrame(labelled, "doc_id long, lang string, text string")
    found = language.identify(df, documents, per_language=10_000).collect()
    got = sorted((r["page_id"], r["lang"], r["probability"]) for r in found)
    want = sorted(fused(pages, labelled))
    assert [(i, lang) for i, lang, _ in got] == [(i, lang) for i, lang, _ in want]
    assert all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want))
    assert len({lang for _, lang, _ in got}) == 3
