"""DuckDB SQL for the operators that SQL can express, over the same tables.

The patterns, thresholds and word lists come from the operators; the way to
the result is SQL's own (regular expressions, list functions, windows).
"""

from __future__ import annotations

import math

from . import quality, secret_scan

WORD = r"[^\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def topk(every: int = 100, k: int = 10, scale: int = 1024) -> str:
    return f"""
    WITH v AS (
      SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {every} = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
    """


def quality_rules() -> str:
    def holds(r: quality.Rule) -> str:
        below = r.denominator or "1000"
        parts = [f"{r.numerator} * 1000 {op} {below} * {bound}" for op, bound in ((">=", r.least), ("<=", r.most)) if bound is not None]
        return " AND ".join(parts)

    failed = ", ".join(f"CASE WHEN NOT ({holds(r)}) THEN '{r.name}' END" for r in quality.RULES)
    stop = ", ".join(quoted(w) for w in sorted(set(quality.STOP_WORDS)))
    w = quality.WINDOW
    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
    n AS (SELECT rid, i, array_to_string(words[i:i + {w - 1}], ' ') AS shingle
          FROM (SELECT rid, words, unnest(range(1, len(words) - {w - 2})) AS i FROM d)),
    t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, shingle) AS times FROM n),
    c AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
          FROM (SELECT rid, unnest(range(i, i + {w})) AS p FROM t WHERE times > 1) GROUP BY rid),
    m AS (
      SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(words, lambda x: list_contains([{stop}], lower(x)))) AS n_stop_words,
             len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha_words,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS n_bullet_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS n_ellipsis_lines
      FROM d LEFT JOIN c USING (rid)),
    f AS (
      SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
             array_to_string(list_filter([{failed}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f
    """


def secrets(window: int = secret_scan.WINDOW) -> str:
    plain = lambda p: p.replace("(?<![0-9a-f])", "")  # noqa: E731  RE2 takes the whole run anyway
    classes = secret_scan.CLASSES
    run = f"[{classes[-1].run}]{{{classes[-1].least},}}"
    patterns = {"assign": secret_scan.ASSIGN, "access": secret_scan.ACCESS, "hex": plain(secret_scan.HEX), "entropy": run}
    found = ",\n".join(f"regexp_extract_all(text, {quoted(p)}) AS m_{k}, regexp_split_to_array(text, {quoted(p)}) AS g_{k}" for k, p in patterns.items())

    def spans(kind: str) -> str:
        # the end of match i: all gaps and matches up to it
        end = (f"list_sum(list_transform(g_{kind}[1:i], lambda x: length(x))) + list_sum(list_transform(m_{kind}[1:i], lambda x: length(x)))")
        return f"list_transform(range(1, len(m_{kind}) + 1), lambda i: {{'m': m_{kind}[i], 'e': CAST({end} AS BIGINT)}})"

    table = "[" + ", ".join(str(secret_scan._clogc(c)) for c in range(window + 1)) + "]"
    cost = f"list_sum(list_transform(map_values(list_histogram(string_split(substr(value, j, {window}), ''))), lambda c: {table}[CAST(c AS INTEGER) + 1]))"
    cases = []
    for c in classes:
        most = round((math.log2(window) - c.bits) * window * secret_scan.SCALE)
        value = "lower(m)" if c.fold else "m"
        cases.append((f"regexp_matches(m, '^[{c.run}]{{{c.least},}}$')", value, most))
    allow = " OR ".join(f"regexp_matches(m, {quoted(r)})" for r in secret_scan.ALLOW)
    value = "CASE " + " ".join(f"WHEN {test} THEN {v}" for test, v, _ in cases) + " END"
    most = "CASE " + " ".join(f"WHEN {test} THEN {x}" for test, _, x in cases) + " END"
    keep = {
        "assign": f"length(regexp_extract(m, {quoted(secret_scan.ASSIGN)}, 2)) >= {secret_scan.ASSIGN_LEAST}", "access": "true", "hex": "true",
        "entropy": f"NOT ({allow}) AND list_min(list_transform(range(1, length(value) - {window - 2}), lambda j: {cost})) <= most",
    }
    rows = "\nUNION ALL\n".join(
        f"SELECT rid, {rank} AS rank, '{kind}' AS kind, m, e FROM (SELECT rid, unnest(s_{kind}, recursive := true) FROM p)"
        for rank, kind in enumerate(patterns))
    kept = " OR ".join(f"(kind = '{k}' AND {test})" for k, test in keep.items())
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) {}, '')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    x AS (SELECT rid, {found} FROM d),
    p AS (SELECT rid, {', '.join(f'{spans(k)} AS s_{k}' for k in patterns)} FROM x),
    a AS ({rows}),
    b AS (SELECT *, e - length(m) AS s, {value} AS value, {most} AS most FROM a),
    k AS (SELECT * FROM b WHERE {kept}),
    g AS (SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
                 count(*) FILTER (WHERE kind = 'hex') AS n_hex, count(*) FILTER (WHERE kind = 'entropy') AS n_entropy,
                 {listed.format("FILTER (WHERE kind <> 'entropy')")} AS base, {listed.format('')} AS spans FROM k GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (rid)
    """


def warc(least: int = 1000) -> str:
    return f"""
    WITH p AS (
      SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
             row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= {least} AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {least} AND place > 1 THEN top END AS refers_to FROM p
    """


def collocations(least: int = 100, longest: int = 5, top: int = 2000, inside: int = 100) -> str:
    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
          FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
    t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
    g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
          FROM (SELECT lang, w, i, unnest(range(1, least({longest}, len(w) - i + 1) + 1)) AS m
                FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p))),
    f AS (SELECT lang, phrase, m, count(*) AS f FROM g GROUP BY lang, phrase, m HAVING count(*) >= {least}),
    c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
    s AS (SELECT DISTINCT b.lang, array_to_string(b.w[i:i + size - 1], ' ') AS phrase, b.f
          FROM (SELECT *, unnest(range(1, m - size + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS size FROM c)) AS b),
    q AS (SELECT lang, phrase, max(f) AS longer FROM s GROUP BY lang, phrase),
    kept AS (SELECT c.* FROM c LEFT JOIN q ON c.lang = q.lang AND c.phrase = q.phrase
             WHERE q.longer IS NULL OR 100 * q.longer < {inside} * c.f),
    k AS (SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS lhs, array_to_string(w[k + 1:m], ' ') AS rhs
          FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
    x AS (SELECT k.lang, k.phrase, k.a, k.k, fl.f AS l, fr.f AS r, t.n,
                 (CAST(1000 AS HUGEINT) * k.a * t.n) // (CAST(fl.f AS HUGEINT) * fr.f) AS score
          FROM k JOIN f AS fl ON fl.lang = k.lang AND fl.phrase = k.lhs
                 JOIN f AS fr ON fr.lang = k.lang AND fr.phrase = k.rhs JOIN t ON t.lang = k.lang),
    y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank FROM y)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM z WHERE rank <= {top}
    """
