"""Language identification of web pages by Bayesian evidence fusion.

For each page and language the log odds add up

    text      the likelihood of the character trigrams, tempered, since neighbouring trigrams are not independent;
    declared  the language the markup declares;
    suffix    the last label of the host name;
    host      the prior of the host, smoothed towards that of its domain, which is smoothed towards that of all pages.

The trigram model is fitted on a bounded sample of labelled documents, told by a hash: about ``per_language`` documents of each
language, ``vocabulary`` trigrams and at most ``most_languages`` languages (more of them are an error). Everything else is counted
over all pages: every page adds its text posterior to the counts of its declared language, suffix, host and domain, so
that a declaration or a suffix is worth as much as it agrees with the texts. A page's own share is taken out of its counts.

Defined results: a page without text, declaration or address has the prior of all pages alone; what is missing is no evidence. NULL url or html is the empty one. A table without
pages gives no rows; without labelled documents every page has a NULL language. Repeated rows are judged alike. Other columns
are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.scratch import materialize, scratch_path

PER_LANGUAGE = 500
VOCABULARY = 20_000
MOST_LANGUAGES = 200
#: Trigrams that count in full; the likelihood of a longer text is scaled down to as many.
EFFECTIVE = 60.0
#: Pages that the coarser level is worth, and the weight of the smoothing of declarations and suffixes.
KAPPA = 4.0
SMOOTH = 2.0

#: Where parts without text of the page's own begin and end, and those that hide all that follows if they never end.
MARK = re.compile(r"<!--|-->|<(/?)(script|style|nav|header|footer|aside|template|title)\b", re.I)
OPAQUE = {"<!--", "script", "style", "template"}
#: Patterns stop at the next "<", so that a page full of unclosed tags takes linear time.
TAG = re.compile(r"<[^<>]*>")
DECLARED = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)
HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
WORD = re.compile(r"[^\W\d_]+")


def trigrams(text: str) -> Counter:
    spaced = " " + "  ".join(WORD.findall(text.lower())) + " "
    found = Counter(map("".join, zip(spaced, spaced[1:], spaced[2:])))
    return Counter({g: n for g, n in found.items() if "  " not in g})


def visible(markup: str) -> str:
    """The text of a page without scripts, styles, comments and boilerplate, found in one pass over their marks."""
    shown, at, inside = [], 0, ""
    for mark in MARK.finditer(markup):
        name = (mark[2] or mark[0]).lower()
        if not inside and name != "-->" and not mark[1]:
            shown.append(markup[at : mark.start()])
            at, inside = mark.end(), name
        elif inside and (name == "-->" if inside == "<!--" else mark[1] and name == inside):
            at, inside = mark.start() if mark[1] else mark.end(), ""
    if inside not in OPAQUE:
        shown.append(markup[at:])
    return entities.unescape(TAG.sub(" ", " ".join(shown)))


def declared(markup: str) -> str:
    found = DECLARED.search(markup)
    return found[1].lower() if found else ""


def address(url: str) -> tuple[str, str, str]:
    """(host, domain, suffix) of an address: the whole name, its last two labels and its last one."""
    found = HOST.match(url)
    host = found[1].lower().strip(".") if found else ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


@dataclass
class Model:
    languages: list[str]
    #: Per trigram, its log probability in each language less the mean over the languages.
    weights: dict[str, np.ndarray]

    def likelihood(self, text: str) -> tuple[np.ndarray, int]:
        """Tempered log likelihood per language, and the number of known trigrams."""
        total, n = np.zeros(len(self.languages)), 0
        for gram, count in trigrams(text).items():
            weight = self.weights.get(gram)
            if weight is not None:
                total += weight * count
                n += count
        return total * min(1.0, EFFECTIVE / n if n else 1.0), n


def fit(labelled: DataFrame, per_language: int, vocabulary: int, most_languages: int) -> Model:
    """``labelled``: doc_id, lang, text."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count().limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} labelled languages; raise most_languages")
    counts = sorted((r["lang"], r["count"]) for r in counts)
    languages = [lang for lang, _ in counts]
    if not languages:
        return Model([], {})
    share = F.coalesce(*[F.when(F.col("lang") == lang, min(1.0, per_language / n)) for lang, n in counts])
    # A hash in [0, 1) tells the sample, so that it is the same in every run.
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", F.length("text")), 11).cast("double") / 2.0**53
    sample = rows.filter(drawn < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.setdefault(lang, Counter()).update(trigrams(text.as_py()))
        flat = [(lang, gram, n) for lang, grams in found.items() for gram, n in grams.items()]
        columns = list(zip(*flat)) or [(), (), ()]
        kinds = [pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "gram", "n"])

    grams = sample.mapInArrow(count, "lang string, gram string, n long")
    per_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(languages)]
    top = grams.groupBy("gram").agg(F.sum("n").alias("n"), *per_lang).orderBy(F.desc("n"), "gram").limit(vocabulary).collect()
    table = np.array([list(r)[2:] for r in top], float).reshape(len(top), len(languages)) + 0.5
    logs = np.log(table / table.sum(axis=0))
    logs -= logs.mean(axis=1, keepdims=True)
    return Model(languages, {r["gram"]: w for r, w in zip(top, logs)})


def evidence(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, host, domain, suffix, declared, n_grams and the text's log likelihoods ``ll`` of each page. One pass."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            rows = []
            for url, markup in zip(batch.column(1), batch.column(2)):
                url, markup = url.as_py(), markup.as_py()
                likelihood, n = fitted.likelihood(visible(markup))
                rows.append((*address(url), declared(markup), n, likelihood.tolist()))
            kinds = [pa.string()] * 4 + [pa.int64(), pa.list_(pa.float64())]
            columns = list(zip(*rows)) or [()] * 6
            names = ["page_id", "host", "domain", "suffix", "declared", "n_grams", "ll"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("url", "html")])
    return slim.mapInArrow(run, "page_id long, host string, domain string, suffix string, declared string, n_grams long, ll array<double>")


def softmax(logs: Column) -> Column:
    weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def counts_by(rows: DataFrame, key: str, n: int) -> DataFrame:
    """(key, c): the sums of the text posteriors per language."""
    sums = F.array(*[F.sum(F.col("p")[i]) for i in range(n)])
    return rows.groupBy(key).agg(sums.alias(f"{key}_c"))


def total_of(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def smoothed(counts: Column, prior: Column, weight: float) -> Column:
    total = total_of(counts) + weight
    return F.zip_with(counts, prior, lambda c, p: (c + weight * p) / total)


def without(counts: Column, own: Column) -> Column:
    return F.zip_with(counts, own, lambda c, p: F.greatest(c - p, F.lit(0.0)))


def identify(pages: DataFrame, labelled: DataFrame, per_language: int = PER_LANGUAGE, vocabulary: int = VOCABULARY, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, suffix, host and n_grams of each page."""
    spark = pages.sparkSession
    model = fit(labelled, per_language, vocabulary, most_languages)
    n = len(model.languages)
    if not n:
        rows = evidence(pages, model)
        none = F.lit(None).cast("string")
        return rows.select("page_id", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared", "suffix", "host", "n_grams")
    rows = materialize(evidence(pages, model), scratch_path(spark, "lang-evidence"))
    rows = rows.withColumn("p", softmax(F.col("ll")))
    everything = rows.agg(*[F.coalesce(F.sum(F.col("p")[i]), F.lit(0.0)) for i in range(n)]).first()
    pages_seen = sum(everything)
    overall = F.array(*[F.lit((c + 1.0) / (pages_seen + n)) for c in everything])
    spread = F.array(*[F.lit(max(c, 1e-9)) for c in everything])
    nothing = F.array(*[F.lit(1.0)] * n)
    tables = {k: materialize(counts_by(rows, k, n), scratch_path(spark, f"lang-{k}")) for k in ("host", "domain", "declared", "suffix")}
    joined = rows
    for key, counted in tables.items():
        joined = joined.join(counted, key)
    own = F.col("p")
    domain = smoothed(without(F.col("domain_c"), own), overall, KAPPA)
    host = F.when(F.col("host") == "", overall).otherwise(smoothed(without(F.col("host_c"), own), domain, KAPPA))

    def told_by(key: str) -> Column:
        """P(value | language), the value's share among all pages as its prior."""
        counts = without(F.col(f"{key}_c"), own)
        share = (total_of(counts) + 1.0) / (pages_seen + 1.0)
        told = F.zip_with(counts, spread, lambda c, whole: (c + SMOOTH * share) / (whole + SMOOTH))
        return F.when(F.col(key) == "", nothing).otherwise(told)

    fused = F.col("ll")
    for factor in (host, told_by("declared"), told_by("suffix")):
        fused = F.zip_with(fused, factor, lambda a, p: a + F.log(p))
    names = F.array(*map(F.lit, model.languages))
    scored = joined.withColumn("fused", fused).withColumn("posterior", softmax(F.col("fused")))

    def best(scores: Column) -> Column:
        return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))

    return scored.select(
        "page_id",
        best(F.col("fused")).alias("lang"),
        F.round(F.array_max("posterior"), 6).alias("probability"),
        F.when(F.col("n_grams") > 0, best(F.col("ll"))).alias("text_lang"),
        "declared",
        "suffix",
        "host",
        "n_grams",
    )
