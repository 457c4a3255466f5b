"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import math

from citeloom.llm import licenses, mixing, secrets

OP2 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

OP7 = r"""
WITH u AS (
  SELECT page_id, url, row_number() OVER () AS n,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT n, h || p AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, length(h) DESC) AS k
  FROM u JOIN r ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (n)
"""


def _values(rows: list[tuple]) -> str:
    def cell(x) -> str:
        return str(x).lower() if isinstance(x, (bool, int)) else "'" + x.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(cell(x) for x in row) + ")" for row in rows)


def _op5() -> str:
    rows = []
    for number, (phrase, label, base) in enumerate(licenses.templates()):
        words = phrase.split()
        rows += [(number, label, base, len(words) - 1, i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.WORD}') AS w FROM documents
), g(template, label, base, n_grams, place, t1, t2) AS (VALUES {_values(rows)}),
p AS (SELECT n, unnest(w) AS w1, unnest(w[2:]) AS w2, unnest(range(len(w))) AS pos FROM d),
hits AS (SELECT *, pos - place AS diagonal FROM p JOIN g ON w1 = t1 AND w2 = t2),
marked AS (
  SELECT *, CASE WHEN base THEN diagonal IS DISTINCT FROM lag(diagonal) OVER a
    ELSE coalesce(diagonal - lag(diagonal) OVER a > {licenses.NEAR}, true) END AS new
  FROM hits WINDOW a AS (PARTITION BY n, template ORDER BY diagonal, pos)
), numbered AS (
  SELECT *, sum(new::INT) OVER (PARTITION BY n, template ORDER BY diagonal, pos) AS grp FROM marked
), spans AS (
  SELECT n, label, base, min(pos) AS first, count(DISTINCT place) / any_value(n_grams) AS score
  FROM numbered GROUP BY n, template, grp, label, base
  HAVING CASE WHEN base THEN count(DISTINCT place) = any_value(n_grams)
    ELSE count(DISTINCT place) / any_value(n_grams) >= {licenses.LEAST} END
), s AS (
  SELECT n, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
    max(first) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score
  FROM spans GROUP BY n
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN s USING (n)
"""


OP5 = _op5()

def op8(budget: float, weights: dict[str, dict[str, int]], epochs: int, seed: int, domain: str) -> str:
    """The same budgets level by level, then prefixes by running sums over whole leaves."""
    words = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    steps = [
        f"""d AS (SELECT row_number() OVER () AS n, doc_id, {domain} AS domain, lang, source, {words} AS tokens
  FROM documents)""",
        f"""l AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {epochs} AS supply,
  floor((SELECT sum(tokens) FROM d)::DOUBLE * {budget})::HUGEINT AS budget FROM d GROUP BY ALL)""",
    ]
    weigh = {
        level: "CASE " + " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in weights.get(level, {}).items()) + " ELSE 1 END"
        if weights.get(level)
        else "1"
        for level in mixing.LEVELS
    }
    usable = " AND ".join(f"{w} > 0" for w in weigh.values())
    steps.append(f"n0 AS (SELECT * FROM l WHERE tokens > 0 AND {usable})")
    for depth, level in enumerate(mixing.LEVELS):
        own = ", ".join(mixing.LEVELS[: depth + 1])
        part = f"PARTITION BY {', '.join(mixing.LEVELS[:depth])}" if depth else ""
        same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in mixing.LEVELS[: depth + 1])
        steps += [
            f"""c{depth} AS (SELECT {own}, sum(supply)::HUGEINT AS supply, max(budget)::HUGEINT AS budget,
  max({weigh[level]})::HUGEINT AS weight FROM n{depth} GROUP BY {own})""",
            f"""b{depth} AS (SELECT *, coalesce(sum(supply) OVER r, 0)::HUGEINT AS before_, (sum(weight) OVER s - coalesce(sum(weight) OVER r, 0))::HUGEINT AS heavier
  FROM c{depth} WINDOW s AS ({part}), r AS ({part} ORDER BY supply::DOUBLE / weight::DOUBLE, {level}
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
            f"""f{depth} AS (SELECT *, (budget - before_) * weight >= supply * heavier AS short FROM b{depth})""",
            f"""g{depth} AS (SELECT *, CASE WHEN short THEN supply ELSE
  ((budget - coalesce(sum(supply) FILTER (short) OVER s, 0)::HUGEINT) * weight) // (sum(weight) FILTER (NOT short) OVER s)::HUGEINT END AS given
  FROM f{depth} WINDOW s AS ({part}))""",
            f"""n{depth + 1} AS (SELECT a.domain, a.lang, a.source, a.tokens, a.supply, b.given::HUGEINT AS budget
  FROM n{depth} a JOIN g{depth} b ON {same})""",
        ]
    last = f"n{len(mixing.LEVELS)}"
    same = " AND ".join(f"d.{c} IS NOT DISTINCT FROM b.{c}" for c in mixing.LEVELS)
    steps += [
        f"""m AS (SELECT d.*, (b.budget // b.tokens)::BIGINT AS fulls, (b.budget % b.tokens)::BIGINT AS need
  FROM d LEFT JOIN {last} b ON {same})""",
        f"""o AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY md5('{seed}:' || fulls || ':' || coalesce(doc_id::VARCHAR, '')) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar
  FROM m)""",
    ]
    return (
        "WITH "
        + ",\n".join(steps)
        + """
SELECT doc_id, domain, lang, source, tokens,
  CASE WHEN tokens > 0 THEN coalesce(fulls + (sofar < need)::INT, 0) ELSE 0 END::BIGINT AS copies FROM o
"""
    )


def _places(pattern: str, group: int = 0) -> str:
    """A list of {s, e, part} for the matches of a pattern in ``text``."""
    q = pattern.replace("'", "''")
    return f"""list_transform(range(1, len(regexp_extract_all(text, '{q}')) + 1), lambda i: {{
      's': (list_sum(list_transform(string_split_regex(text, '{q}')[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(regexp_extract_all(text, '{q}')[1:i-1], lambda x: length(x))), 0))::BIGINT,
      'e': (list_sum(list_transform(string_split_regex(text, '{q}')[1:i], lambda x: length(x)))
        + list_sum(list_transform(regexp_extract_all(text, '{q}')[1:i], lambda x: length(x))))::BIGINT,
      'part': regexp_extract_all(text, '{q}', {group})[i]}})"""


def _op10() -> str:
    w, terms = secrets.WINDOW, secrets.TERMS
    least = "CASE " + " ".join(
        f"WHEN regexp_matches(part, '{p}') THEN {bits}" for p, bits in secrets.CLASSES.values()
    ) + " END"
    allowed = " OR ".join(f"regexp_matches(c.part, '{p}')" for p in secrets.ALLOWED)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
b AS (
  SELECT n, doc_id, list_filter({_places(secrets.ASSIGN, 1)}, lambda x: length(x.part) >= {secrets.ASSIGN_LEAST}) AS a,
    {_places(secrets.ACCESS)} AS k, {_places(secrets.HEX)} AS h, {_places(secrets.CANDIDATE)} AS c
  FROM t
), c AS (SELECT n, unnest(c) AS c FROM b),
cand AS (SELECT n, c.s AS s, c.part AS part, {least.replace('part', 'c.part')} AS least FROM c WHERE NOT ({allowed})),
win AS (SELECT n, s, part, least, unnest(range(0, length(part) - {w - 1})) AS i FROM cand),
high AS (
  SELECT n, s, min(i) AS f, max(i) + {w} AS l FROM win
  WHERE list_sum(list_transform(map_values(list_histogram(string_split(substr(part, (i + 1)::INT, {w}), ''))),
    lambda x: {terms}[(x + 1)::INT])) <= floor(({math.log2(w)!r}::DOUBLE - least::DOUBLE) * {w} * {secrets.MILLIONTHS})::BIGINT
  GROUP BY n, s
), spans AS (
  SELECT n, x.s AS s, 0 AS k, x.e AS e, 'assign' AS kind FROM (SELECT n, unnest(a) AS x FROM b)
  UNION ALL SELECT n, x.s, 1, x.e, 'access' FROM (SELECT n, unnest(k) AS x FROM b)
  UNION ALL SELECT n, x.s, 2, x.e, 'hex' FROM (SELECT n, unnest(h) AS x FROM b)
  UNION ALL SELECT n, s + f, 3, s + l, 'entropy' FROM high
), j AS (
  SELECT n, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
  FROM spans GROUP BY n
)
SELECT doc_id, len(a) AS n_assign, len(k) AS n_access, len(h) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM b LEFT JOIN j USING (n)
"""


OP10 = _op10()

OP12 = """
WITH x AS (
  SELECT vec_id, row_number() OVER () AS place,
         list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.place, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM x q JOIN x c ON q.place <> c.place
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
