"""SQL (DuckDB) for the results of those queries that it can express."""

from __future__ import annotations

from cardamom.llm import license_scan as L
from cardamom.llm import quality_rules as Q


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality_rules() -> str:
    stop = ", ".join(map(_quoted, sorted(set(Q.STOP_WORDS))))
    hits = " OR ".join(f"(n_words >= {r.min_words} AND {r.metric} {r.op} {r.limit})" for r in Q.RULES)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM w, unnest(range(1, CAST(len(w) AS BIGINT) - 6)) AS u(i)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM d, range(0, 8) AS v(j) GROUP BY doc_id),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words, len(l) AS n_lines,
        len(list_filter(w, lambda x: ends_with(x, '!!'))) AS n_exclaims, len(list_filter(w, lambda x: x = '|')) AS n_bars,
        len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter_words,
        len(list_filter(l, lambda x: substr(ltrim(x, ' '), 1, 1) IN ('-', '*', '•'))) AS n_bullets,
        len(list_filter(l, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipses
      FROM w LEFT JOIN r USING (doc_id)),
m AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio,
        coalesce(n_exclaims / nullif(n_words, 0), 0) AS exclaim_ratio, coalesce(n_bars / nullif(n_words, 0), 0) AS bar_ratio,
        coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(n_bullets / nullif(n_lines, 0), 0) AS bullet_line_ratio,
        coalesce(n_ellipses / nullif(n_lines, 0), 0) AS ellipsis_line_ratio, coalesce(n_letter_words / nullif(n_words, 0), 0) AS letter_word_ratio,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({hits}) AS kept FROM m"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), {_quoted(L.COPYRIGHT_LINE)}, ' ', 'g')"
    out = f"' ' || trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') || ' '"
    for a, b in (pair for pair in L.SPELLINGS for _ in range(2)):
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out}, ' ')"


def license_scan() -> str:
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, texts in L.KNOWN.items() for text in texts)
    return f"""
WITH k AS (SELECT sha256({_canonical("text")}) AS digest, min(id) AS license_id FROM (VALUES {known}) AS v(id, text) GROUP BY 1),
d AS (SELECT doc_id, sha256({_canonical("text")}) AS digest FROM documents),
l AS (SELECT doc_id, sha256({_canonical("line")}) AS digest FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(lower(line), 'licen[cs]e')),
n AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids FROM l JOIN k USING (digest) GROUP BY 1)
SELECT d.doc_id, d.digest, k.license_id, coalesce(n.notice_ids, '') AS notice_ids FROM d LEFT JOIN k USING (digest) LEFT JOIN n USING (doc_id)"""


def topk_search() -> str:
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""
