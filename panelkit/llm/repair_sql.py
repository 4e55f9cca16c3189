"""SQL of op11_lr_repair: the same result by a recursive walk over all conversations' rows, four states a conversation.

A state's value is its cost as nine digits followed by its audit, so that least() takes the least (cost, audit).
"""
#: The table of CRC-32 by its rule, and the checksum of a string of ASCII characters over it.
CRC_TABLE = """
bits(i, k, v) AS (SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8)"""


def crc32(codes: str) -> str:
    """CRC-32 of a list of byte values; `crc` must be among the tables."""
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


def _step(value: str, cost: str, letter: str) -> str:
    return f"(lpad(CAST(CAST({value}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {value}[10:] || '{letter}')"


def _inserted(start: str, s: str, u: str, a: str) -> dict[str, str]:
    """Start, system, user and assistant state after rows inserted before the next row: none, one, or a pair."""
    one_u = f"least({u}, {_step(start, 3, 'I')}, {_step(s, 3, 'I')}, {_step(a, 3, 'I')})"
    one_a = f"least({a}, {_step(u, 3, 'I')})"
    two_a = f"least({one_a}, {_step(_step(start, 3, 'I'), 3, 'I')}, {_step(_step(s, 3, 'I'), 3, 'I')})"
    return {"n": start, "s": s, "u": one_u, "a": two_a}


_PAD = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEEP = "(CASE WHEN truncated THEN 3 ELSE 0 END)"


def _stay(value: str, wanted: str) -> str:
    """The least of keeping and reroling a row from a state that wants this initial."""
    kept = f"CASE WHEN initial = '{wanted}' THEN {_step(value, _KEEP, 'K')} END"
    given = "NULL" if wanted == "s" else _step(value, f"(3 + {_KEEP})", "R")
    return f"CASE WHEN NOT goes THEN least({kept}, {given}) END"


SQL = f"""
WITH RECURSIVE {CRC_TABLE},
given AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32("[CAST(ord(x) AS BIGINT) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]")} % 20 AS fault
  FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM given),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, trim(text, {_PAD}) AS body FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again, left(role, 1) AS initial,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS above FROM placed),
facts AS (SELECT conv_id, turn, role, text, k, initial, above, body = '' AS blank, body <> '' AND again AS duplicate,
  body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, body = '' OR again AS goes FROM seen),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, '000000000' AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM (SELECT DISTINCT conv_id FROM facts)
  UNION ALL
  SELECT conv_id, k, {_step('n', 4, 'D')}, least({_step('s', 4, 'D')}, {_stay('n', 's')}),
    least({_step('u', 4, 'D')}, {_stay('n', 'u')}, {_stay('s', 'u')}, {_stay('a', 'u')}), least({_step('a', 4, 'D')}, {_stay('u', 'a')})
  FROM (SELECT f.conv_id, f.k, f.initial, f.truncated, f.goes, {', '.join(f'{v} AS {c}' for c, v in _inserted('w.n', 'w.s', 'w.u', 'w.a').items())}
        FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1)),
ends AS (SELECT conv_id, least(n, a, {_step('u', 3, 'I')}, {_step(_step('s', 3, 'I'), 3, 'I')}) AS best, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS last FROM walk),
audits AS (SELECT conv_id, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit FROM ends WHERE last = 1),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS pos FROM audits WHERE audit <> ''),
counted AS (SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS k, count(*) FILTER (WHERE letter <> 'D') OVER w AS nth FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
made AS (SELECT c.conv_id, c.pos, c.letter, c.nth, f.role, CASE WHEN c.letter = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN c.nth = 1 AND c.letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS system
  FROM counted c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.k = c.k AND c.letter <> 'I'),
repaired AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (nth - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS body
  FROM made WHERE letter <> 'D' GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
  count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE above IS NOT NULL AND above || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, coalesce(x.cost, 0) AS cost, coalesce(x.audit, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN audits x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id"""
