"""DuckDB SQL of the registered queries that SQL can express. The others (token
files, packing, neighbours, Feistel sharding with crc32, SimHash with XXH64, the
learned grammar) are tested against brute force in tests/llm."""

from __future__ import annotations

from fieldmart.llm import mixing, quality, secrets

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {}

ORACLE["op1_substring_dedup"] = f"""
WITH n AS (SELECT doc_id, {WORDS} AS ws, len({WORDS}) AS n FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 13], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(0, n - 12)) AS i FROM n WHERE n >= 13) t),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
hit AS (SELECT win.doc_id, i FROM win JOIN first ON win.g = first.g WHERE m < win.doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k FROM hit) t),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, n)) AS p FROM n),
kept AS (SELECT w.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE gone.p IS NULL) AS t
         FROM words w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.p = w.p GROUP BY w.doc_id)
SELECT n.doc_id, n.n AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM n LEFT JOIN kept ON kept.doc_id = n.doc_id"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _finds(name: str, pattern: str, kind: str, group: int = 0) -> str:
    p = _quoted(pattern)
    return f"""
{name}_m AS (SELECT rid, regexp_extract_all(text, {p}, 0) AS m, regexp_extract_all(text, {p}, {group}) AS v, string_split_regex(text, {p}) AS g FROM docs),
{name}_u AS (SELECT rid, unnest(m) AS x, unnest(v) AS v, unnest(g[1:len(m)]) AS g, unnest(range(0, len(m))) AS i FROM {name}_m WHERE len(m) > 0),
{name}_p AS (SELECT rid, {kind} AS kind, CAST(sum(length(g) + length(x)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) AS stop, length(x) AS n FROM {name}_u)"""


_KIND_FACTS = ", ".join(f"('{k}', {n}, '{role}', {str(base).lower()})" for k, (n, role, base) in secrets.KINDS.items())
_S = secrets.SCOPE
_NEAR = f"o.rid = w.rid AND o.start < w.stop + {_S} AND o.stop > w.start - {_S} AND (o.kind <> w.kind OR o.start <> w.start)"


def _met(role: str) -> str:
    return f"EXISTS (SELECT 1 FROM part o WHERE {_NEAR} AND o.role = '{role}')"


def _list(only: str) -> str:
    return f"string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth, kind, stop) FILTER (WHERE {only})"


ORACLE["op4_secret_scan"] = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),{','.join([
    _finds("a", secrets.ASSIGN, f"CASE WHEN length(v) >= {secrets.LEAST_VALUE} THEN 'assign' WHEN length(v) >= {secrets.LEAST_SHORT} THEN 'short' END", 2),
    _finds("c", secrets.ACCESS, "'access'"), _finds("h", secrets.HEX, "'hex'"),
    _finds("l", secrets.LOGIN, f"CASE WHEN length(v) >= {secrets.LEAST_NAME} THEN 'login' END", 2),
    _finds("k", secrets.KEY, f"CASE WHEN length(v) = {secrets.KEY_LENGTH} THEN 'key' END"), _finds("e", secrets.ENDPOINT, "'endpoint'")])},
fact AS (SELECT * FROM (VALUES {_KIND_FACTS}) t(kind, nth, role, base)),
part AS (SELECT rid, f.kind, f.nth, f.role, f.base, stop - n AS start, stop
         FROM ({' UNION ALL '.join(f'SELECT * FROM {x}_p' for x in 'achlke')}) p JOIN fact f ON f.kind = p.kind),
weak AS (SELECT w.* FROM part w
         WHERE NOT w.base AND NOT EXISTS (SELECT 1 FROM part o WHERE o.rid = w.rid AND o.base AND o.start < w.stop AND o.stop > w.start)
           AND CASE w.role WHEN 'identifier' THEN {_met('secret')} WHEN 'secret' THEN {_met('identifier')}
                           ELSE {_met('secret')} AND {_met('identifier')} END),
every AS (SELECT * FROM part WHERE base UNION ALL SELECT * FROM weak),
row_of AS (SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
                  count(*) FILTER (WHERE kind = 'hex') AS n_hex, {_list('base')} AS b, {_list('true')} AS s FROM every GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans
FROM docs LEFT JOIN row_of ON row_of.rid = docs.rid"""


def _share(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST(({a}) AS DOUBLE) / {b} ELSE 0.0 END"


_MEASURES = {"mean_word_length": _share("word_chars", "n_words"), "symbol_ratio": _share("n_symbols", "word_chars"), "stop_word_ratio": _share("n_stop + 1", "n_words"),
             "dup_line_ratio": _share("n_dup_lines", "n_lines"), "marked_line_ratio": _share("n_marked", "n_lines")}
_PASSES = " AND ".join(f"({_MEASURES[m]}) {op} {bound}" for _, m, least, most in quality.RULES for op, bound in ((">=", least), ("<=", most)) if bound is not None)
_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

ORACLE["op6_quality_rules"] = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT rid, i, array_to_string(ws[i + 1:i + 5], ' ') AS g FROM (SELECT rid, ws, unnest(range(0, len(ws) - 4)) AS i FROM t WHERE len(ws) >= 5) x),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) x WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(0, 5)) AS k FROM twice) x GROUP BY rid),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[|*•>-]'))) AS n_marked,
             len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop, coalesce(rep.n, 0) AS n_repeat_words
      FROM t LEFT JOIN rep ON rep.rid = t.rid),
b AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_PASSES} AS kept FROM b"""

ORACLE["op8_curriculum_mixing"] = f"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
t AS (SELECT *, CAST({list(mixing.WEIGHTS)}[nth % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight, CAST({mixing.REPEAT} * source_size AS DOUBLE) AS stop FROM s),
r AS (SELECT *, stop / weight AS ratio FROM t),
total AS (SELECT CAST(sum(source_size) AS DOUBLE) * {mixing.BUDGET} AS budget, sum(weight) AS weights FROM r),
step AS (SELECT DISTINCT ratio, sum(stop) OVER (ORDER BY ratio) AS stopped, sum(weight) OVER (ORDER BY ratio) AS gone FROM r),
level AS (SELECT -1.0::DOUBLE AS upto, budget / weights AS level, (SELECT min(ratio) FROM r) AS next FROM total
          UNION ALL SELECT ratio, (budget - stopped) / nullif(weights - gone, 0), lead(ratio) OVER (ORDER BY ratio) FROM step, total),
chosen AS (SELECT coalesce(level, 1e300) AS level FROM level WHERE next IS NULL OR level IS NULL OR next > level ORDER BY upto LIMIT 1),
goal AS (SELECT source, source_size, least(stop, weight * level) AS target FROM r, chosen),
o AS (SELECT d.doc_id, d.size, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('{mixing.SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id NULLS FIRST, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST({' + '.join(f'greatest(0, least(size, whole - (before + source_size * {k})))' for k in range(mixing.REPEAT))} AS BIGINT) AS taken
FROM o"""
