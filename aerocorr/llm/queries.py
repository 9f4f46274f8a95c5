"""The corpus operators over the test tables, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerocorr.llm.collocations import collocations
from aerocorr.llm.common import table
from aerocorr.llm.divergence import divergence
from aerocorr.llm.exact import exact_dedup
from aerocorr.llm.fingerprints import fingerprints
from aerocorr.llm.page_text import extract
from aerocorr.llm.jaccard import near_groups
from aerocorr.llm.line_runs import dedup_lines
from aerocorr.llm.mixing import mix_positions
from aerocorr.llm.packing import pack
from aerocorr.llm.passages import repeated_passages
from aerocorr.llm.secret_scan import RULES, scan
from aerocorr.llm.toxicity import judge
from aerocorr.llm.urls import judge_urls


def op1_packing(spark, sf_dir):
    return pack(spark, table(spark, sf_dir, "documents"))


def op2_passages(spark, sf_dir):
    return repeated_passages(spark, table(spark, sf_dir, "documents"))


def op3_urls(spark, sf_dir):
    return judge_urls(spark, table(spark, sf_dir, "pages"))


def op4_html(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


def op5_jaccard(spark, sf_dir):
    return near_groups(spark, table(spark, sf_dir, "documents"))


def op6_fingerprints(spark, sf_dir):
    return fingerprints(spark, table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


def op8_mixing(spark, sf_dir):
    return mix_positions(spark, table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    return judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secrets(spark, sf_dir):
    return scan(spark, table(spark, sf_dir, "documents"))


def op11_lines(spark, sf_dir):
    return dedup_lines(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_collocations(spark, sf_dir):
    return collocations(spark, table(spark, sf_dir, "documents"))


def op13_divergence(spark, sf_dir):
    return divergence(spark, table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_passages, op3_urls, op4_html, op5_jaccard, op6_fingerprints, op7_exact_dedup,
    op8_mixing, op9_toxicity, op10_secrets, op11_lines, op12_collocations,
    op13_divergence)}

LOWER_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES = {
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY sha256(coalesce(text, '')))""",
    "op11_lines": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS t
                   FROM documents),
             l AS (SELECT doc_id, r, unnest(t) AS line, generate_subscripts(t, 1) AS i FROM d),
             k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                       {LOWER_AZ}) AS key FROM l),
             g AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20
                   GROUP BY key HAVING count(DISTINCT r) >= 3),
             m AS (SELECT k.*, g.key IS NOT NULL AND doc_id IS DISTINCT FROM keep AS gone
                   FROM k LEFT JOIN g ON k.key = g.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id""",
    "op12_collocations": f"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       translate(coalesce(text, ''), {LOWER_AZ}), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
             w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM d),
             g AS (SELECT lang, len(w) AS size, unnest(list_concat(
                       w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                       list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS p
                   FROM w),
             f AS (SELECT lang, p, count(*) AS a, string_split(p, ' ') AS w FROM g GROUP BY lang, p),
             s AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
             c AS (SELECT lang, p, a, w, unnest(range(1, len(w))) AS k FROM f WHERE len(w) > 1 AND a >= 10),
             x AS (SELECT c.*, l.a AS l, r.a AS r,
                          (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
                   FROM c JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.w[:k], ' ')
                          JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.w[k + 1:], ' ')),
             b AS (SELECT lang, p, a, w, l, r, score FROM x
                   QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
             o AS (SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS p, a FROM b WHERE len(w) = 3),
             m AS (SELECT lang, p, max(a) AS most FROM o GROUP BY lang, p),
             t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.p) AS rank
                   FROM b LEFT JOIN m ON m.lang = b.lang AND m.p = b.p
                   WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT t.lang, rank, t.p AS phrase, a, l, r, n, score FROM t JOIN s ON s.lang = t.lang WHERE rank <= 2000""",
    "op13_divergence": f"""
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
                          regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
                   FROM documents),
             o AS (SELECT lang, source, i, translate(unnest(w), {LOWER_AZ}) AS term FROM d),
             k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
             v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
             c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY lang, source, term),
             g AS (SELECT DISTINCT lang, source FROM d),
             x AS (SELECT g.lang, g.source, k.term, k.n AS kn, coalesce(c.n, 0) AS n
                   FROM g JOIN k ON k.lang = g.lang
                   LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
             p AS (SELECT x.*, 1 + 1000000000::HUGEINT * (x.n + 1)
                               // (sum(x.n) OVER (PARTITION BY x.lang, x.source) + v.v) AS p,
                          1 + 1000000000::HUGEINT * (x.kn + 1) // (v.n + v.v) AS q
                   FROM x JOIN v ON v.lang = x.lang),
             s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
                   FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
                   GROUP BY a.lang, a.source, b.source),
             r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
                   FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
                   LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
                   UNION ALL
                   SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
             z AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (
                       PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
        SELECT * FROM z WHERE part = 'pair' OR rank <= 200""",
}


def _spans_sql(order: int, rule) -> str:
    """Spans of one rule in DuckDB: pieces between the matches, summed up."""
    pattern = rule.pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(m{order}) + 1), lambda i: {{
        's': coalesce(list_sum(list_transform(p{order}[1:i], lambda x: length(x))), 0)::BIGINT
           + coalesce(list_sum(list_transform(m{order}[1:i - 1], lambda x: length(x))), 0)::BIGINT,
        'k': {order}, 'n': length(m{order}[i]), 'v': length(v{order}[i])}}), lambda x: x.v >= {rule.least})"""


def _secrets_sql() -> str:
    quoted = [r.pattern.replace("'", "''") for r in RULES]
    pieces = ", ".join(
        f"regexp_extract_all(t, '{q}') AS m{i}, string_split_regex(t, '{q}') AS p{i}, "
        f"regexp_extract_all(t, '{q}', {r.group}) AS v{i}" for i, (q, r) in enumerate(zip(quoted, RULES)))
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"
    text = (f"array_to_string(list_transform(list_sort({{}}), lambda x: {kinds}[x.k + 1] || ':' || x.s "
            "|| ':' || (x.s + x.n)), ',')")
    base = " || ".join(f"k{i}" for i, r in enumerate(RULES) if r.base)
    every = " || ".join(f"k{i}" for i in range(len(RULES)))
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             f AS (SELECT doc_id, {pieces} FROM d),
             g AS (SELECT doc_id, {", ".join(f"{_spans_sql(i, r)} AS k{i}" for i, r in enumerate(RULES))} FROM f)
        SELECT doc_id, len(k0) AS n_assign, len(k1) AS n_access, len(k2) AS n_hex,
               sha256({text.format(base)}) AS base_sha256, {text.format(every)} AS spans FROM g"""


ORACLES["op10_secrets"] = _secrets_sql()
