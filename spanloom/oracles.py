"""DuckDB SQL for the registered queries, put together from common table expressions."""

from __future__ import annotations

from .fixtures import SPANS_SQL

HL, L = "trace_id_high, trace_id_low", "trace_id_low"

FLAT = f"""s AS ({SPANS_SQL}),
f AS (SELECT coalesce(trace_id_high, 0) AS trace_id_high, trace_id_low, span_id, parent_span_id, service, operation,
  upper(span_kind) AS span_kind, coalesce(span_kind = 'server', false) AS is_server, coalesce(span_kind = 'client', false) AS is_client,
  start_time_us, start_time_us // 1000 AS ms, peer_service, client_version FROM s)"""

#: The odd wire records of fixtures.odd_nested_spans, as flat columns.
ODD = f"""s AS ({SPANS_SQL}),
d AS (SELECT trace_id_high, CASE WHEN start_time_us % 6 = 4 THEN -trace_id_low ELSE trace_id_low END AS trace_id_low, span_id, parent_span_id,
  CASE WHEN start_time_us % 6 <> 5 THEN service END AS service, span_kind AS kind,
  CASE WHEN start_time_us % 6 = 3 THEN CASE span_kind WHEN 'server' THEN 'client' WHEN 'client' THEN 'server' END END AS second,
  start_time_us, start_time_us % 6 AS odd, peer_service FROM s)"""


def sessions(keys: str, minutes: int, where: str = "is_client OR is_server") -> str:
    """CTEs up to t: the spans with sid and session_end in milliseconds."""
    gap = minutes * 60_000
    return f"""{FLAT},
a AS (SELECT *, CASE WHEN lag(ms) OVER w IS NULL OR ms - lag(ms) OVER w > {gap} THEN ms END AS fst FROM f WHERE {where}
  WINDOW w AS (PARTITION BY {keys} ORDER BY ms)),
b AS (SELECT *, max(fst) OVER (PARTITION BY {keys} ORDER BY ms RANGE UNBOUNDED PRECEDING) AS sid FROM a),
t AS (SELECT *, max(ms) OVER (PARTITION BY {keys}, sid) + {gap} AS session_end FROM b)"""


def deduped(keys: str = HL, minutes: int = 3, where: str = "is_client OR is_server") -> str:
    """CTEs up to e: spans with their new ids."""
    return f"""{sessions(keys, minutes, where)},
d1 AS (SELECT *, bool_or(is_client) OVER (PARTITION BY {keys}, sid, span_id) AND is_server AS renamed FROM t),
d2 AS (SELECT *, CASE WHEN renamed THEN sum(CASE WHEN renamed THEN 1 ELSE 0 END) OVER (PARTITION BY {keys}, sid
  ORDER BY start_time_us, span_id, parent_span_id, service ROWS UNBOUNDED PRECEDING) END AS k FROM d1),
u AS (SELECT {keys}, sid, span_id AS i FROM d2 UNION SELECT {keys}, sid, parent_span_id FROM d2),
c AS (SELECT DISTINCT {keys}, sid, unnest(range(1, 60)) AS i FROM d2 WHERE renamed),
free AS (SELECT {keys}, sid, i AS fresh, row_number() OVER (PARTITION BY {keys}, sid ORDER BY i) AS k
  FROM (SELECT * FROM c EXCEPT SELECT * FROM u)),
r AS (SELECT d2.*, fresh FROM d2 LEFT JOIN free USING ({keys}, sid, k)),
h AS (SELECT {keys}, sid, span_id AS par, arg_max(fresh, k) AS heir FROM r WHERE renamed GROUP BY ALL),
n AS (SELECT *, coalesce(fresh, span_id) AS new_id, CASE WHEN renamed THEN span_id ELSE parent_span_id END AS par FROM r),
e AS (SELECT n.*, CASE WHEN heir IS NOT NULL AND heir <> new_id THEN heir ELSE par END AS new_parent FROM n LEFT JOIN h USING ({keys}, sid, par))"""


def edges() -> str:
    return f"""{deduped()},
svc AS (SELECT {HL}, sid, new_id AS new_parent, service AS parent FROM e
  QUALIFY row_number() OVER (PARTITION BY {HL}, sid, new_id ORDER BY start_time_us DESC, service DESC) = 1),
ed AS (SELECT {HL}, sid, session_end, parent, service AS child FROM e JOIN svc USING ({HL}, sid, new_parent) WHERE parent IS NOT NULL)"""


def window_start(minutes: int) -> str:
    return f"((session_end - 1) // {minutes * 60_000}) * {minutes * 60_000}"


PAIRS = f"""{sessions(L, 3)},
rep AS (SELECT {L}, sid, span_id, service, peer_service, is_client, is_server FROM t
  QUALIFY row_number() OVER (PARTITION BY {L}, sid, span_id ORDER BY start_time_us, span_id, parent_span_id, service) = 1),
pc AS (SELECT t.{L}, t.sid, t.session_end, t.span_id, c.service AS cs, c.peer_service AS cp, c.is_client AS cc, c.is_server AS csv,
    p.service AS ps, p.is_client AS pcl, p.is_server AS psv, p.span_id IS NULL AS orphan
  FROM t JOIN rep c ON t.{L} = c.{L} AND t.sid = c.sid AND t.span_id = c.span_id
  LEFT JOIN rep p ON t.{L} = p.{L} AND t.sid = p.sid AND t.parent_span_id = p.span_id)"""

_LANG = "regexp_extract(lower(client_version), '^([^-]*)-([0-9]+([.][0-9]+)*)-*$', {})"
_PART = "TRY_CAST(nullif(split_part(v, '.', {0}), '') AS INTEGER)"
_LEAST = (("go", 2, 6, 0), ("python", 3, 8, 0), ("node", 3, 0, 0), ("java", 0, 0, 17))


def minimum_ok() -> str:
    """A boolean over lang and v."""
    cases = []
    for lang, *least in _LEAST:
        test = "true"
        for i, x in reversed(list(enumerate(least, 1))):
            p = _PART.format(i)
            test = f"CASE WHEN len(split(v, '.')) < {i} THEN true WHEN {p} IS NULL OR {p} < {x} THEN false WHEN {p} > {x} THEN true ELSE {test} END"
        cases.append(f"WHEN lang = '{lang}' AND v <> '' THEN {test}")
    return "CASE " + " ".join(cases) + " ELSE false END"


SCORES = f"""{PAIRS},
ver AS (SELECT *, coalesce({_LANG.format(1)}, '') AS lang, coalesce({_LANG.format(2)}, '') AS v FROM t),
sc AS (
  SELECT {L}, sid, session_end, service, 'ClientVersion' AS metric, client_version AS submetric FROM t
  UNION ALL SELECT {L}, sid, session_end, service, 'MinimumClientVersionCheck', CASE WHEN {minimum_ok()} THEN 'PASS' ELSE 'FAIL' END FROM ver
  UNION ALL SELECT {L}, sid, session_end, service, 'HasUniqueSpanIds', CASE WHEN count(*) OVER (PARTITION BY {L}, sid, span_id) = 1 THEN 'PASS' ELSE 'FAIL' END FROM t
  UNION ALL SELECT {L}, sid, session_end, cp, 'HasServerSpans', 'FAIL' FROM pc WHERE orphan AND cc
  UNION ALL SELECT {L}, sid, session_end, cs, 'HasClientSpans', 'PASS' FROM pc WHERE orphan AND cc
  UNION ALL SELECT {L}, sid, session_end, cp, 'HasClientSpans', 'FAIL' FROM pc WHERE orphan AND NOT cc AND csv
  UNION ALL SELECT {L}, sid, session_end, cs, 'HasServerSpans', 'PASS' FROM pc WHERE orphan AND NOT cc AND csv
  UNION ALL SELECT {L}, sid, session_end, cs, 'HasServerSpans', 'PASS' FROM pc WHERE NOT orphan AND pcl AND csv
  UNION ALL SELECT {L}, sid, session_end, cs, 'HasServerSpans', 'FAIL' FROM pc WHERE NOT orphan AND pcl AND cc
  UNION ALL SELECT {L}, sid, session_end, cs, 'HasClientSpans', 'PASS' FROM pc WHERE NOT orphan AND NOT pcl AND psv AND cc
  UNION ALL SELECT {L}, sid, session_end, coalesce(cp, cs), 'HasClientSpans', 'FAIL' FROM pc WHERE NOT orphan AND NOT pcl AND psv AND csv),
good AS (SELECT *, sid // 3600000 * 3600000 AS bucket_ms, lower(to_hex({L})) AS trace_id FROM sc WHERE service <> '' AND submetric <> '')"""

COUNTS = f"""{SCORES},
q AS (SELECT service, bucket_ms, metric, submetric, count(*) AS n, min(trace_id) AS trace_id FROM good GROUP BY ALL)"""

_CATALOG = """cat AS (SELECT * FROM (VALUES
  ('hasserverspans', 'The service emitted spans with server span.kind', 'Completeness'),
  ('hasclientspans', 'The service emitted spans with client span.kind ', 'Completeness'),
  ('hasuniquespanids', 'The service emitted spans with unique span ids', 'Quality'),
  ('minimumclientversioncheck', 'This service emitted a span that has an acceptable client version', 'Completeness')) v(m, d, ty)),
typed AS (SELECT q.*, coalesce(d, 'This metric isn''t used for computing trace quality') AS description, coalesce(ty, 'Other') AS type
  FROM q LEFT JOIN cat ON lower(metric) = m)"""
REPORT = f"{COUNTS}, {_CATALOG}"

# paths: a node is visited from the first parent that reaches it; ids form trees here but for repeats
def paths(spans: str, t: str = "t") -> str:
    """CTEs of spans up to ``t``, then up to up: the unique paths of each window."""
    return f"""{spans},
node AS (SELECT {L}, sid, span_id, service, operation, span_kind FROM {t}
  QUALIFY row_number() OVER (PARTITION BY {L}, sid, span_id ORDER BY start_time_us DESC, span_id DESC) = 1),
kid AS (SELECT DISTINCT {L}, sid, parent_span_id, span_id FROM {t} WHERE parent_span_id <> 0),
root AS (SELECT {L}, sid, session_end, span_id FROM {t} WHERE parent_span_id = 0
  QUALIFY row_number() OVER (PARTITION BY {L}, sid ORDER BY start_time_us DESC, span_id DESC) = 1),
ways AS (WITH RECURSIVE w AS (
    SELECT {L}, sid, session_end, span_id, [span_id] AS ids FROM root
    UNION ALL SELECT w.{L}, w.sid, w.session_end, kid.span_id, list_append(w.ids, kid.span_id)
      FROM w JOIN kid ON w.{L} = kid.{L} AND w.sid = kid.sid AND w.span_id = kid.parent_span_id WHERE NOT list_contains(w.ids, kid.span_id))
  SELECT * FROM w),
leaf AS (SELECT * FROM ways WHERE NOT EXISTS (SELECT 1 FROM kid WHERE kid.{L} = ways.{L} AND kid.sid = ways.sid AND kid.parent_span_id = ways.span_id)),
steps AS (SELECT {L}, sid, session_end, span_id AS leaf, unnest(ids) AS span_id, generate_subscripts(ids, 1) AS i FROM leaf),
pa AS (SELECT {L}, sid, session_end, leaf, coalesce(string_agg(service || '|' || operation, '>' ORDER BY i) FILTER (WHERE span_kind = 'SERVER'), '') AS path,
    lower(to_hex({L})) AS trace_id
  FROM steps JOIN node USING ({L}, sid, span_id) GROUP BY {L}, sid, session_end, leaf),
up AS (SELECT {window_start(10)} AS window_ms, path, min(trace_id) AS trace_id FROM pa GROUP BY ALL)"""


PATHS = paths(sessions(L, 5, "true"))
#: The same after shared ids were told apart.
DEDUPED_PATHS = paths(
    f"""{deduped(L, 5, "true")},
own AS (SELECT {L}, sid, session_end, start_time_us, service, operation, span_kind, new_id AS span_id, new_parent AS parent_span_id FROM e)""", "own"
)
INDEX = f"""{PATHS},
nodes AS (SELECT window_ms, path, trace_id, unnest(string_split(path, '>')) AS node FROM up WHERE path <> ''),
idx AS (SELECT DISTINCT (window_ms + 600000) // 3600000 * 3600000 AS bucket_ms, window_ms, split_part(node, '|', 1) AS service, x.o AS operation, trace_id, path
  FROM nodes, LATERAL (SELECT unnest([split_part(node, '|', 2), '']) AS o) x)"""


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
