"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

import string

from playtrail.llm import collocations, substring_dedup, vector_codes

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_SPACE = r"[ \t\n\x0B\f\r]+"


def vector_codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """All Lloyd rounds, each with every distance between parts and entries."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        near{k} AS MATERIALIZED (
          SELECT rid, part, min(d * {entries} + entry) AS best FROM (
            SELECT x.rid, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
            FROM x JOIN c{k} c ON x.part = c.part AND x.pos = c.pos GROUP BY ALL)
          GROUP BY rid, part)""")
        if k < rounds:
            steps.append(f"""
        c{k + 1} AS MATERIALIZED (
          SELECT c.part, c.entry, c.pos, CASE WHEN m.n IS NULL THEN c.v ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v
          FROM c{k} c LEFT JOIN (
            SELECT a.part, a.best % {entries} AS entry, x.pos, sum(x.v)::BIGINT AS s, count(*) AS n
            FROM near{k} a JOIN x ON a.rid = x.rid AND a.part = x.part GROUP BY ALL) m
          ON c.part = m.part AND c.entry = m.entry AND c.pos = m.pos)""")
    return f"""
        WITH v AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
                 [CAST(floor({vector_codes.SCALE} * y::DOUBLE) AS BIGINT) FOR y IN embedding] AS e
          FROM embeddings
          WHERE len(embedding) > 0 AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0),
        x AS MATERIALIZED (
          SELECT rid, len_e, pos, (pos * {parts}) // len_e AS part, e[pos + 1] AS v
          FROM (SELECT rid, e, len(e) AS len_e, unnest(range(len(e))) AS pos FROM v)),
        c0 AS MATERIALIZED (SELECT part, rid AS entry, pos, v FROM x WHERE rid < {entries}),
        {",".join(steps)},
        coded AS (
          SELECT rid, string_agg(format('{{:02x}}', best % {entries}), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error
          FROM near{rounds} GROUP BY rid)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
        FROM coded JOIN v USING (rid)"""


def substring_dedup_sql(length: int = substring_dedup.LENGTH) -> str:
    """Every window spelt out and counted; a word is removed if one of the windows that
    start at it or up to ``length`` - 1 words before is met twice."""
    return f"""
        WITH d AS MATERIALIZED (
          SELECT row_number() OVER () AS rid, doc_id,
                 [x FOR x IN string_split_regex(coalesce(text, ''), '{_SPACE}') IF x <> ''] AS w FROM documents),
        words AS (SELECT rid, len(w) AS size, w, unnest(range(1, len(w) + 1)) AS i FROM d),
        windows AS MATERIALIZED (
          SELECT rid, i, w[i] AS word,
                 CASE WHEN i + {length - 1} <= size THEN sha256(array_to_string(w[i:i + {length - 1}], ' ')) END AS h FROM words),
        met AS (SELECT h FROM windows WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
        marked AS (
          SELECT rid, i, word, max(CASE WHEN met.h IS NULL THEN 0 ELSE 1 END)
                 OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS gone
          FROM windows LEFT JOIN met USING (h)),
        kept AS (
          SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS text
          FROM marked GROUP BY rid)
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (rid)"""


def collocations_sql(
    least: int = collocations.LEAST, inside: int = collocations.INSIDE, top: int = collocations.TOP, size: int = collocations.SIZE
) -> str:
    """Each phrase length counted by itself."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase"
        f" FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"
        for k in range(1, size + 1)
    )
    return f"""
        WITH pieces AS MATERIALIZED (
          SELECT lang, [x FOR x IN string_split_regex(piece, '[ \\t]+') IF x <> ''] AS w FROM (
            SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang,
                   unnest(string_split_regex({_LOWER}, '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents)),
        f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL),
        total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {least}),
        cuts AS (
          SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS tail
          FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
        scored AS (
          SELECT cuts.lang, cuts.phrase, a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
          FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = head JOIN f r ON r.lang = cuts.lang AND r.phrase = tail),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        longer AS (
          SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (
            SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
          GROUP BY ALL),
        ranked AS (
          SELECT weakest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
          FROM weakest LEFT JOIN longer USING (lang, phrase)
          WHERE longer IS NULL OR 100::HUGEINT * longer < {inside}::HUGEINT * a)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= {top}"""


ORACLE: dict[str, str] = {
    "op11_dual_tree_codes": vector_codes_sql(),
    "op12_seed_extend": substring_dedup_sql(),
    "op13_phrase_rollup": collocations_sql(),
}
