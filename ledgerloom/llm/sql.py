"""DuckDB SQL of the ``opN_*`` queries that SQL can express, written from the rules, not from the plans."""

from __future__ import annotations

from ledgerloom.llm.catalog import WEIGHTS
from ledgerloom.llm.licences import EQUIVALENT, KNOWN, NOTICE
from ledgerloom.llm.mixing import EPOCHS, SEED
from ledgerloom.llm.ngram_join import PERCENT, SHINGLE
from ledgerloom.llm.repeats import LENGTH

_WORDS = r"[^\x20\x09-\x0D]+"
_OTHER = r"[^\p{L}\p{N}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    """The canonical form of a column, as nested calls."""
    out = f"translate({column}, '{_UPPER}', '{_LOWER}')"
    out = f"regexp_replace({out}, {_text(NOTICE)}, '\\1', 'g')"
    out = f"trim(regexp_replace({out}, {_text(_OTHER)}, ' ', 'g'))"
    for a, b in EQUIVALENT:
        out = f"regexp_replace({out}, '\\b{a}(s?)\\b', '{b}\\1', 'g')"
    return out


def _op1() -> str:
    known = ", ".join(f"({_text(n)}, {_text(t)})" for n, t in KNOWN)
    return f"""
    WITH known AS (
      SELECT min(licence) AS licence, digest FROM (
        SELECT licence, sha256({_canonical("t")}) AS digest FROM (VALUES {known}) AS k(licence, t)) GROUP BY digest),
    docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
    wholes AS (SELECT doc_id, text, {_canonical("text")} AS form FROM docs),
    lines AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line FROM docs),
    forms AS (SELECT doc_id, text, {_canonical("line")} AS form FROM lines),
    found AS (
      SELECT f.doc_id, f.text, count(*) AS n_lines, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS line_licences
      FROM forms f JOIN known k ON f.form <> '' AND sha256(f.form) = k.digest GROUP BY f.doc_id, f.text)
    SELECT w.doc_id, sha256(w.text) AS text_sha256, CASE WHEN w.form <> '' THEN sha256(w.form) END AS digest,
           k.licence AS licence, coalesce(f.n_lines, 0) AS n_lines, coalesce(f.line_licences, '') AS line_licences
    FROM wholes w
    LEFT JOIN known k ON w.form <> '' AND sha256(w.form) = k.digest
    LEFT JOIN found f ON f.doc_id IS NOT DISTINCT FROM w.doc_id AND f.text = w.text
    """


def _op3() -> str:
    """Every window of the corpus by its MD5 number; spans by a run of starts that touch."""
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents),
    starts AS (SELECT r, h, unnest(range(n - {LENGTH - 1})) AS p FROM docs WHERE n >= {LENGTH}),
    windows AS (SELECT r, p, md5_number(substr(h, 2 * p + 1, {2 * LENGTH})) AS k FROM starts),
    twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
    hits AS (SELECT r, p FROM windows SEMI JOIN twice USING (k)),
    marked AS (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM hits),
    runs AS (SELECT r, min(p) AS a, max(p) + {LENGTH} AS b FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM marked) GROUP BY r, run),
    gaps AS (
      SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM runs
      UNION ALL SELECT r, max(b), max(n) FROM runs JOIN docs USING (r) GROUP BY r),
    kept AS (SELECT r, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM gaps JOIN docs USING (r) GROUP BY r),
    gone AS (SELECT r, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY r)
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM docs LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
    """


def _op4() -> str:
    """All pairs that share a shingle, and what is reachable over the links."""
    return f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM docs WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    met AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * common >= {PERCENT} * (x.n + y.n - common)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id
    FROM docs d LEFT JOIN sizes z USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) c USING (doc_id)
    """


def _level(name: str, path: list[str], above: str) -> str:
    """Shares of one level of the tree: the budget that is left when the fullest children have theirs, by weight."""
    parent = path[:-1]
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    join = f"JOIN {above} USING ({', '.join(parent)})" if parent else f"CROSS JOIN {above}"
    keys = ", ".join(path)
    return f"""
    {name}_nodes AS (
      SELECT n.*, budget, coalesce(w.weight, 1)::HUGEINT AS weight
      FROM (SELECT {keys}, sum(tokens)::HUGEINT * {EPOCHS} AS capacity FROM leaves GROUP BY {keys}) n
      LEFT JOIN (SELECT name, weight FROM weights WHERE level = '{path[-1]}') w ON w.name = n.{path[-1]} {join}),
    {name}_ranked AS (
      SELECT *, coalesce(sum(capacity) OVER ({by} ORDER BY (capacity * 1000000000) // weight, {path[-1]}
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
             (sum(weight) OVER ({by} ORDER BY (capacity * 1000000000) // weight, {path[-1]}
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS rest
      FROM {name}_nodes),
    {name}_full AS (SELECT *, capacity * rest <= (budget - before) * weight AS filled FROM {name}_ranked),
    {name}_open AS (
      SELECT *, (sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({by or ''}))::HUGEINT AS taken,
             (sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by or ''}))::HUGEINT AS open FROM {name}_full),
    {name} AS (
      SELECT {keys}, CASE WHEN filled THEN capacity ELSE least((budget - taken) * weight // open, capacity) END AS budget
      FROM {name}_open)"""


def _op6() -> str:
    weights = ", ".join(f"('{level}', '{name}', {w})" for level, name, w in WEIGHTS)
    return f"""
    WITH weights AS (SELECT * FROM (VALUES {weights}) AS w(level, name, weight)),
    slim AS (
      SELECT doc_id, coalesce('d' || (nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '')::INT % 4), 'unknown') AS domain,
             coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
             coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS n_tokens
      FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM slim GROUP BY ALL),
    total AS (SELECT sum(tokens)::HUGEINT // 2 AS budget FROM leaves),
    {_level("domains", ["domain"], "total")},
    {_level("langs", ["domain", "lang"], "domains")},
    {_level("sources", ["domain", "lang", "source"], "langs")},
    plan AS (
      SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
             CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
      FROM leaves JOIN sources USING (domain, lang, source)),
    running AS (
      SELECT slim.*, whole, rest, sum(n_tokens) OVER (
               PARTITION BY domain, lang, source
               ORDER BY md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), n_tokens) AS run
      FROM slim JOIN plan USING (domain, lang, source)),
    taken AS (
      SELECT doc_id, domain, lang, source, n_tokens,
             (whole + CASE WHEN run <= rest AND n_tokens > 0 THEN 1 ELSE 0 END)::BIGINT AS copies FROM running)
    SELECT * FROM taken WHERE copies > 0
    """


def _op10() -> str:
    return f"""
    WITH docs AS (
      SELECT doc_id, source, lang, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS words,
             coalesce(len(regexp_extract_all(text, '\\p{{L}}+|[^\\p{{L}}\\x20\\x09-\\x0D]')), 0) AS pieces,
             doc_id = min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
      FROM documents),
    kept AS (SELECT * FROM docs WHERE first),
    states AS (
      SELECT 'words-1' AS version, source, lang, words AS n FROM kept WHERE words >= 100
      UNION ALL SELECT 'pieces-2', source, lang, pieces FROM kept)
    SELECT version, source, lang, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens FROM states GROUP BY ALL
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": _op1(), "op3_suffix_dedup": _op3(), "op4_ngram_join": _op4(),
        "op6_mixing": _op6(), "op10_token_counts": _op10(),
    }
