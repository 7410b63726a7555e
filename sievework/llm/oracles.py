"""DuckDB SQL for the queries that SQL can express, independent of the operators' code but for their thresholds."""

from __future__ import annotations

from . import mixing, quality, vectorcodes

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _quality() -> str:
    stops = ", ".join(f"'{v}'" for v in sorted({v for own in quality.STOP_WORDS.values() for w in own.split() for v in (w, w[0].upper() + w[1:])}))
    checks = []
    for r in quality.RULES:
        bad = [f"{r.part} * 1000 < {r.whole} * {r.least}"] * (r.least is not None) + [f"{r.part} * 1000 > {r.whole} * {r.most}"] * (r.most is not None)
        checks.append(f"CASE WHEN {' OR '.join(bad)} THEN '{r.name}' END")
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
    i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d WHERE len(w) >= 3),
    win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM i),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY doc_id),
    m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_full_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(list_filter(w, lambda x: x IN ({stops})))::BIGINT AS n_stop_words
          FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {', '.join(checks)}) AS failed_rules FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f
    """


_WARC = """
    WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h FROM pages),
    f AS (SELECT *, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
    SELECT page_id, url, strlen(h)::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (j // 8 * 10 + 1)::BIGINT, 10))::BIGINT >> (35 - 5 * (j % 8))::BIGINT) & 31) + 1, 1)), '') AS payload_digest,
           CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
    FROM f
    """

_CONTAMINATION = rf"""
    WITH split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS x FROM starts),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, sizes WHERE len(w) >= n),
    hits AS (SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM places) p JOIN windows q ON p.x = q.x AND p.n = q.n),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
    found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
    SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM split s LEFT JOIN words ON s.doc_id = words.doc_id LEFT JOIN found ON s.doc_id = found.doc_id
    """



def _vector_codes() -> str:
    """Lloyd's rounds without any bound: every part against every entry. Squares and sums are whole numbers below 2^53."""
    parts, entries = vectorcodes.PARTS, vectorcodes.ENTRIES
    steps = [
        f"""usable AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {vectorcodes.SCALE})) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS e
                   FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"points AS MATERIALIZED (SELECT e, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM (SELECT e, v, unnest(range({parts})) AS p FROM usable))",
        f"book0 AS MATERIALIZED (SELECT p, e, x AS c, list_inner_product(x, x) AS cc FROM points WHERE e < {entries})",
    ]
    for r in range(vectorcodes.ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT q.e AS i, q.p, min((cc - 2 * list_inner_product(c, x) + list_inner_product(x, x), b.e)) AS best
                FROM points q JOIN book{r} b ON q.p = b.p GROUP BY q.e, q.p)"""
        )
        if r < vectorcodes.ROUNDS:
            steps.append(
                f"""mean{r} AS (SELECT p, e, list(s ORDER BY j) AS c FROM
                    (SELECT n.p, n.best[2] AS e, j, floor(sum(x[j]) / count(*)) AS s FROM near{r} n JOIN points q ON q.e = n.i AND q.p = n.p, unnest(range(1, len(x) + 1)) AS t(j) GROUP BY ALL) GROUP BY p, e),
                book{r + 1} AS MATERIALIZED (SELECT p, e, k AS c, list_inner_product(k, k) AS cc FROM (SELECT b.p, b.e, coalesce(m.c, b.c) AS k FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e))"""
            )
    last = vectorcodes.ROUNDS
    return f"""
    WITH {", ".join(steps)},
    sha AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{last}),
    codes AS (SELECT i, string_agg(printf('%02x', best[2]::BIGINT), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near{last} GROUP BY i)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM codes JOIN usable ON i = e, sha
    """


_EXACT = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """

ORACLES = {
    "op1_poisson_mixing": mixing.oracle(),
    "op3_quality_rules": _quality(),
    "op4_warc_index": _WARC,
    "op9_benchmark_decontamination": _CONTAMINATION,
    "op11_vector_codes": _vector_codes(),
    "op12_exact_dedup": _EXACT,
}
