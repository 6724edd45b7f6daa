"""The operators over the whole test tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from feedloom.llm.common import table
from feedloom.llm.conversation_repair import repair_conversations
from feedloom.llm.exact_dedup import exact_dedup
from feedloom.llm.hard_negatives import mine_hard_negatives
from feedloom.llm.language import identify
from feedloom.llm.line_dedup import line_dedup
from feedloom.llm.mixing import mix_sources
from feedloom.llm.quality import quality_rules
from feedloom.llm.sentence_pieces import encode_and_decode
from feedloom.llm.sharding import shard_documents
from feedloom.llm.simhash import near_dedup
from feedloom.llm.token_counts import token_counts
from feedloom.llm.token_files import token_files
from feedloom.llm.url_filters import judge_pages
from feedloom.sources.tables import read_optional


def on_table(name, operator):
    def query(spark, sf_dir):
        return operator(table(spark, sf_dir, name))

    return query


def on_documents(operator):
    return on_table("documents", operator)


def page_languages(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return identify(table(spark, sf_dir, "pages"), labelled)


def judged_documents(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"), read_optional(spark, f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_sentence_pieces": on_documents(encode_and_decode),
    "op2_exact_dedup": on_documents(exact_dedup),
    "op3_quality_rules": judged_documents,
    "op4_token_counts": on_documents(token_counts),
    "op5_token_files": on_documents(token_files),
    "op6_near_dedup": on_documents(near_dedup),
    "op7_mix_sources": on_documents(mix_sources),
    "op8_line_dedup": on_documents(line_dedup),
    "op9_sharding": on_documents(shard_documents),
    "op10_page_languages": page_languages,
    "op11_conversation_repair": on_table("conversations", repair_conversations),
    "op12_hard_negatives": on_table("embeddings", mine_hard_negatives),
    "op13_url_filters": on_table("pages", judge_pages),
}

def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, folded bit by bit."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
    folded = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: {step})"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    start = "4294967295::BIGINT"
    return f"xor(list_reduce(list_prepend({start}, {codes}), lambda c, b: {folded}), {start})"


def repair_sql() -> str:
    """The edits row by row instead of by search: after each row the best (cost, audit, repaired lines) of each state of the pattern."""

    def more(label: str, cost: str, letter: str, line: str = "''") -> str:
        lines = f"{label}.r || CASE WHEN {line} = '' OR {label}.r = '' THEN '' ELSE chr(10) END || {line}"
        return f"CASE WHEN {label} IS NOT NULL THEN {{'c': {label}.c + {cost}, 's': {label}.s || '{letter}', 'r': {lines}}} END"

    def best(*labels: str) -> str:
        return f"list_min([{', '.join(labels)}])"

    def edited(state: str, initial: str, role: str) -> list[str]:
        own = "role || ':' || text"
        kept = f"CASE WHEN NOT gone AND initial = '{initial}' THEN {more(state, 'extra', 'K', own)} END"
        if initial == "s":
            return [kept]
        return [kept, f"CASE WHEN NOT gone THEN {more(state, 'extra + 1', 'R', f"'{role}:' || text")} END"]

    user = [e for state in ("f0", "f1", "f3") for e in edited(state, "u", "user")]
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    own = "coalesce(conv_id::VARCHAR, '')"
    parts = " || ".join(f"length({x}) || ':' || {x}" for x in (own, "role", "text"))
    return f"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(f'({key})')} % 20 AS kind FROM conversations),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM keyed WHERE kind <> 0),
        placed AS (
            SELECT *, rtrim(text, {spaces}) AS bare,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(CASE WHEN conv_id IS NULL THEN 'true' ELSE 'false' END || {parts}), copy) AS n
            FROM damaged),
        judged AS (
            SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
                   right(bare, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS initial,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
            FROM placed),
        rows AS (
            SELECT *, blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS extra FROM judged),
        walk AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS n, {{'c': 0, 's': '', 'r': ''}} AS f0, NULL::STRUCT(c INTEGER, s VARCHAR, r VARCHAR) AS f1,
                   {{'c': 5, 's': 'I', 'r': 'user:'}} AS f2, {{'c': 10, 's': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS f3
            FROM keyed
            UNION ALL
            SELECT conv_id, n, e0, e1, g2, {best('e3', more('g2', '5', 'I', "'assistant:'"))}
            FROM (
                SELECT *, {best('e2', *[more(e, '5', 'I', "'user:'") for e in ('e0', 'e1', 'e3')])} AS g2
                FROM (
                    SELECT r.conv_id, r.n, {more('f0', '2', 'D')} AS e0, {best(more('f1', '2', 'D'), *edited('f0', 's', ''))} AS e1,
                           {best(more('f2', '2', 'D'), *user)} AS e2, {best(more('f3', '2', 'D'), *edited('f2', 'a', 'assistant'))} AS e3
                    FROM walk w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = w.n + 1))),
        ended AS (
            SELECT conv_id, list_min([f0, f3]) AS least FROM walk
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
        counted AS (
            SELECT conv_id, least(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn), 9223372036854775807) AS gaps, count(*) FILTER (blank) AS blank,
                   count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows GROUP BY conv_id)
        SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, least.c::BIGINT AS cost, least.s AS audit,
               sha256(least.r) AS repaired_sha256
        FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """


ORACLES = {
    "op11_conversation_repair": repair_sql(),
    "op2_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
                     count(*) OVER (PARTITION BY body) AS group_size, sha256(body) AS text_sha256
              FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents))
    """,
    "op8_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        repeats AS (
            SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        marked AS (
            SELECT k.*, coalesce(k.doc_id <> r.first, false) AS lost FROM keyed k LEFT JOIN repeats r ON k.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.n AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM usable a JOIN usable r ON a.n <> r.n WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k
            FROM scored WHERE label = anchor_label QUALIFY k <= 5),
        negatives AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
            FROM positives p JOIN scored n ON p.anchor = n.anchor
            WHERE n.label <> n.anchor_label AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
    """,
    "op13_url_filters": r"""
        WITH marks AS (SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS mark FROM pages),
        rests AS (SELECT *, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM marks),
        hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rests),
        parts AS (
            SELECT page_id,
                   translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path,
                   translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
            FROM hosts),
        ruled AS (
            SELECT *, CASE
                WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM parts),
        patterned AS (
            SELECT *, CASE
                WHEN rule IS NOT NULL THEN NULL
                WHEN regexp_matches(lowered, '[^a-z0-9_.%-]es(?:[^a-z0-9_.%-].*|)[?]page=', 's') THEN '^es^*?page='
                WHEN regexp_matches(lowered, '[?]page=.*&ref=', 's') THEN '?page=*&ref='
                WHEN regexp_matches(lowered, '[^a-z0-9_.%-]utm_source=feed$', 's') THEN '^utm_source=feed|'
                WHEN regexp_matches(lowered, '^[^:/?#]*://(?:[^/?#]*[.])?spam-farm[.]', 's') THEN '||spam-farm.' END AS pattern
            FROM ruled)
        SELECT page_id, host, path, rule, pattern,
               CASE WHEN rule IN ('org/', 'com/fr/') OR pattern = '^es^*?page=' THEN 'allow'
                    WHEN rule IS NOT NULL OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
        FROM patterned
    """,
}
