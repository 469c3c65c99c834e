"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

LOWER = ("translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

# The given pages name no canonical address and no refresh, so each is a class of its own;
# tests hold the classes against brute force.
_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
_FITS = ("(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')")

SQL = {
    "op4_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)""",
    "op10_url_classes": f"""
        WITH u AS (SELECT page_id, coalesce({_REST}, '') AS rest FROM pages),
        p AS (SELECT page_id, {LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r AS (SELECT *, CASE WHEN {_FITS.format("example.org", "/en/1")} THEN 'example.org/en/1'
                             WHEN {_FITS.format("example.org", "/es/")} THEN 'example.org/es/'
                             WHEN {_FITS.format("com", "/fr/")} THEN 'com/fr/'
                             WHEN {_FITS.format("com", "/de/")} THEN 'com/de/'
                             WHEN {_FITS.format("org", "/")} THEN 'org/' END AS rule FROM p)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/')
                    THEN 'block' ELSE 'allow' END AS verdict
        FROM r""",
}

_FINITE = ("embedding IS NOT NULL "
           "AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0")


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Codebooks trained round by round, one common table expression each."""
    steps = [f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)
                                   FOR x IN embedding] AS ints
            FROM embeddings WHERE {_FINITE}),
        wide AS (SELECT max(len(ints)) // {parts} AS w FROM kept),
        flat AS MATERIALIZED (
            SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS place, ints[i] AS v
            FROM (SELECT vec_id, ints, w, unnest(range(1, len(ints) + 1)) AS i
                  FROM kept, wide)),
        c0 AS MATERIALIZED (
            SELECT part, entry, place, v FROM flat JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
                ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for n in range(rounds + 1):
        steps.append(f"""
        d{n} AS (SELECT vec_id, part, entry, sum((f.v - c.v) * (f.v - c.v)) AS gap
                 FROM flat f JOIN c{n} c USING (part, place) GROUP BY ALL),
        a{n} AS MATERIALIZED (SELECT vec_id, part, min({{'gap': gap, 'entry': entry}}) AS best
                              FROM d{n} GROUP BY ALL)""")
        if n < rounds:
            steps.append(f"""
        c{n + 1} AS MATERIALIZED (
            SELECT part, entry, place, coalesce(m, v) AS v FROM c{n} LEFT JOIN (
                SELECT part, best.entry AS entry, place,
                       CAST(sum(v) // count(*) - CASE WHEN sum(v) % count(*) < 0
                                                 THEN 1 ELSE 0 END AS BIGINT) AS m
                FROM flat JOIN a{n} USING (vec_id, part) GROUP BY ALL)
            USING (part, entry, place))""")
    steps.append(f"""
        coded AS (SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
                         CAST(sum(best.gap) AS BIGINT) AS error
                  FROM a{rounds} GROUP BY vec_id)""")
    return ",".join(steps) + f"""
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place))
                FROM c{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)"""


SQL["op11_vector_codes"] = _codes()

SQL["op13_hard_negatives"] = f"""
    WITH r AS MATERIALIZED (
        SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
    s AS MATERIALIZED (
        SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
               CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM r a JOIN r b ON a.id <> b.id WHERE a.id % 100 = 0),
    p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score,
           score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
    QUALIFY row_number() OVER w <= 10"""
