"""Independent SQL (DuckDB dialect) for the correctness oracle.

Named CTEs mirror the Spark derivations step by step.  ``with_ctes(body,
names)`` prepends the CTEs a query needs, in dependency order.  The SQL has its
own text of every rule; only the values that make up the input lines are
shared, so a mistake on one side shows up as a mismatch.
"""

from __future__ import annotations

from logsift.sources.fixtures import (
    MSG_INJECTION, MSG_NORMAL, URL_COMMAND, URL_SCRIPT, URL_TRAVERSAL, USER_AGENTS,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- fixed values: the rules once more, as SQL text of their own -------------
ERR = r"""'^\[([\w\s:/\+\-]+)\] \[(\w+)\](?:\s\[([^\]]+)\])?\s(.+)$'"""
ACC = r"""'^(\S+) \S+ \S+ \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) \S+" (\d{3}) (\S+)(?: "([^"]*)" "([^"]*)")?'"""
CLIENT = r"'client\s([\d\.]+)'"
BROWSER = """CASE WHEN contains(lower(user_agent), 'firefox') THEN 'Firefox' WHEN contains(lower(user_agent), 'chrome') THEN 'Chrome'
  WHEN contains(lower(user_agent), 'safari') THEN 'Safari'
  WHEN contains(lower(user_agent), 'msie') OR contains(lower(user_agent), 'trident') THEN 'Internet Explorer' ELSE 'Other' END"""
OS = """CASE WHEN contains(lower(user_agent), 'windows') THEN 'Windows'
  WHEN contains(lower(user_agent), 'mac') OR contains(lower(user_agent), 'darwin') THEN 'macOS'
  WHEN contains(lower(user_agent), 'linux') THEN 'Linux' WHEN contains(lower(user_agent), 'android') THEN 'Android'
  WHEN contains(lower(user_agent), 'ios') OR contains(lower(user_agent), 'iphone') OR contains(lower(user_agent), 'ipad') THEN 'iOS'
  ELSE 'Other' END"""
ATTACK_URL = """(contains(lower(url), '../') OR contains(lower(url), 'script>') OR contains(lower(url), 'union select')
  OR contains(lower(url), '/etc/passwd') OR contains(lower(url), 'cmd='))"""
ATTACK_LINE = r"""(regexp_matches(line, '" [4-5]\d{2} ') OR contains(lower(line), '../') OR contains(lower(line), 'union select')
  OR contains(lower(line), '/etc/passwd') OR contains(lower(line), 'cmd=') OR contains(lower(line), '<script')
  OR contains(lower(line), 'exec(') OR contains(lower(line), 'eval(') OR contains(lower(line), 'phpinfo')
  OR contains(lower(line), 'shell') OR contains(lower(line), 'wget') OR contains(lower(line), 'curl')
  OR contains(lower(line), '../../') OR contains(lower(line), 'base64'))"""
# ---------------------------------------------------------------------------
_UA = ", ".join(_q(u) for u in USER_AGENTS)
_WEEKDAY = _q(r"(?i)^(mon|tue|wed|thu|fri|sat|sun)\s+")
_STRIP = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


cte("ev_derived", [], f"""
SELECT event_id, user_id, event_type, value,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id) AS ingested_at,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id)
      + to_microseconds(CAST(round(value * 1000) AS BIGINT)) AS indexed_at,
  CASE user_id % 10 WHEN 0 THEN '10.0.0.1' WHEN 1 THEN '192.168.1.7' WHEN 2 THEN '172.32.0.9'
       WHEN 3 THEN '127.0.0.1' ELSE '203.0.113.' || CAST(user_id % 10 AS VARCHAR) END AS ip,
  CAST(CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 404 ELSE 500 END
       WHEN event_type = 'signup' THEN 201 WHEN event_type = 'view' THEN 304 ELSE 200 END AS VARCHAR) AS status_s,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'notice' END AS level,
  CASE WHEN event_id % 53 = 0 THEN {_q(URL_TRAVERSAL)} WHEN event_id % 59 = 0 THEN {_q(URL_COMMAND)}
       WHEN event_id % 61 = 0 THEN {_q(URL_SCRIPT)} ELSE '/p/' || CAST(user_id AS VARCHAR) END AS url,
  CASE WHEN event_id % 7 = 0 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS bytes_s,
  list_extract([{_UA}], CAST(user_id % 6 AS INTEGER) + 1) AS ua
FROM events
""")

cte("log_lines", ["ev_derived"], f"""
SELECT event_id AS line_id,
  CASE
    WHEN event_id % 97 = 0 THEN 'garbage ' || CAST(event_id AS VARCHAR)
    WHEN event_id % 101 = 0 THEN '   '
    WHEN event_id % 5 = 0 THEN '[' || strftime(ingested_at, '%a %b %d %H:%M:%S %Y') || '] [' || level || '] '
         || CASE WHEN event_id % 3 = 0 THEN '' ELSE '[client ' || ip || '] ' END
         || CASE WHEN event_id % 15 = 0 THEN {_q(MSG_INJECTION)} ELSE {_q(MSG_NORMAL)} || CAST(event_id AS VARCHAR) END
    WHEN event_id % 4 = 0 THEN ip || ' - - [' || strftime(ingested_at, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET '
         || url || ' HTTP/1.0" ' || status_s || ' ' || bytes_s
    ELSE ip || ' - - [' || strftime(ingested_at, '%d/%b/%Y:%H:%M:%S') || ' +0000] "POST '
         || url || ' HTTP/1.1" ' || status_s || ' ' || bytes_s || ' "-" "' || ua || '"'
  END AS line,
  ingested_at, indexed_at
FROM ev_derived
""")

cte("clean_lines", ["log_lines"], f"""
SELECT line_id, trim(line, {_STRIP}) AS line, ingested_at, indexed_at
FROM log_lines WHERE length(trim(line, {_STRIP})) > 0
""")

cte("kinds", ["clean_lines"], f"""
SELECT *, CASE WHEN regexp_matches(line, {ERR}) THEN 'E' WHEN regexp_matches(line, {ACC}) THEN 'A' ELSE 'X' END AS kind
FROM clean_lines
""")

cte("groups", ["kinds"], f"""
SELECT line_id, line, ingested_at, indexed_at, kind,
  regexp_extract(line, {ERR}, 1) AS e1, regexp_extract(line, {ERR}, 2) AS e2,
  regexp_extract(line, {ERR}, 3) AS e3, regexp_extract(line, {ERR}, 4) AS e4,
  regexp_extract(line, {ACC}, 1) AS a1, regexp_extract(line, {ACC}, 2) AS a2,
  regexp_extract(line, {ACC}, 3) AS a3, regexp_extract(line, {ACC}, 4) AS a4,
  regexp_extract(line, {ACC}, 5) AS a5, regexp_extract(line, {ACC}, 6) AS a6,
  regexp_extract(line, {ACC}, 7) AS a7, regexp_extract(line, {ACC}, 8) AS a8
FROM kinds
""")

cte("parsed_all", ["groups"], f"""
SELECT line_id, line, ingested_at, indexed_at, kind,
  CASE kind WHEN 'E' THEN regexp_extract(e3, {CLIENT}, 1) WHEN 'A' THEN a1 END AS ip,
  CASE kind
    WHEN 'E' THEN coalesce(CASE WHEN regexp_matches(e1, {_WEEKDAY}) THEN
         try_strptime(regexp_replace(regexp_replace(e1, {_WEEKDAY}, ''), '\\s+', ' ', 'g'), '%b %d %H:%M:%S %Y') END,
         ingested_at)
    WHEN 'A' THEN coalesce(try_strptime(regexp_extract(a2, '^(\\S+)', 1), '%d/%b/%Y:%H:%M:%S'), ingested_at)
  END AS timestamp,
  CASE kind WHEN 'E' THEN 'LOG' WHEN 'A' THEN a3 END AS method,
  CASE kind WHEN 'E' THEN substring(e4, 1, 100) WHEN 'A' THEN a4 END AS url,
  CASE kind WHEN 'E' THEN CASE WHEN e2 = 'error' THEN 400 ELSE 200 END WHEN 'A' THEN CAST(a5 AS INTEGER) END AS status,
  CASE kind WHEN 'E' THEN CAST(0 AS BIGINT) WHEN 'A' THEN coalesce(try_cast(a6 AS BIGINT), 0) END AS bytes,
  CASE kind WHEN 'E' THEN e3 WHEN 'A' THEN a7 END AS referer,
  CASE kind WHEN 'E' THEN e2 WHEN 'A' THEN a8 END AS user_agent
FROM groups
""")

cte("log_events", ["parsed_all"], f"""
SELECT line_id AS event_id, ip, timestamp, method, url, status, bytes, referer, user_agent,
  {BROWSER} AS browser,
  {OS} AS os,
  CASE WHEN starts_with(ip, '10.') OR starts_with(ip, '192.168.') OR starts_with(ip, '172.') THEN 'private'
       WHEN starts_with(ip, '127.') THEN 'localhost' ELSE 'public' END AS ip_class,
  (status >= 400 OR {ATTACK_URL}) AS suspicious,
  ingested_at, indexed_at
FROM parsed_all WHERE kind <> 'X'
""")

cte("line_flags", ["clean_lines"], f"""
SELECT line_id, line, ingested_at,
  {ATTACK_LINE} AS suspicious
FROM clean_lines
""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


RECURSIVE: set[str] = set()


def with_ctes(body: str, *names: str) -> str:
    """``WITH [RECURSIVE] <needed ctes> <body>``."""
    order = _order(list(names))
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    head = "WITH RECURSIVE " if RECURSIVE & set(order) else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()


# --- alerts (time column ingested_at, flush batch 50) -----------------------

cte("susp", ["log_events"], "SELECT event_id, ip, ingested_at AS t FROM log_events WHERE suspicious")

cte("sliding", ["susp"], """
SELECT event_id, ip, t, CAST(least(100, count(*) OVER (PARTITION BY ip ORDER BY t
  RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)) AS BIGINT) AS count
FROM susp
""")

cte("cand", ["sliding"], "SELECT ip, t, max(count) AS count FROM sliding WHERE count >= 5 GROUP BY ip, t")


def cooldown_ctes(prefix: str, cand: str) -> str:
    """Greedy 5-minute cooldown over ``cand(ip, t, count)`` as a recursive CTE."""
    cte(f"{prefix}_next", [cand], f"""
SELECT a.ip, a.t, min(b.t) AS nt FROM {cand} a LEFT JOIN {cand} b
  ON a.ip = b.ip AND b.t >= a.t + INTERVAL 5 MINUTE GROUP BY a.ip, a.t
""")
    cte(f"{prefix}_chain", [f"{prefix}_next"], f"""
SELECT ip, min(t) AS t FROM {cand} GROUP BY ip
UNION ALL
SELECT n.ip, n.nt FROM {prefix}_chain f JOIN {prefix}_next n ON n.ip = f.ip AND n.t = f.t WHERE n.nt IS NOT NULL
""")
    RECURSIVE.add(f"{prefix}_chain")
    cte(f"{prefix}_alerts", [f"{prefix}_chain"], f"""
SELECT 'HIGH_ERROR_RATE' AS alert_type, f.ip, c.count, f.t - INTERVAL 60 SECOND AS window_start,
  f.t AS window_end, f.t AS created_at
FROM {prefix}_chain f JOIN {cand} c ON c.ip = f.ip AND c.t = f.t
""")
    return f"{prefix}_alerts"


cooldown_ctes("ev", "cand")
cte("alerts", ["ev_alerts"], "SELECT * FROM ev_alerts")

cte("ordered", ["log_events"], """
SELECT event_id, ip, suspicious, ingested_at AS t, row_number() OVER (ORDER BY ingested_at, event_id) AS rn
FROM log_events
""")
cte("flushes", ["ordered"], "SELECT rn // 50 - 1 AS flush_id, t AS ft, rn AS end_rn FROM ordered WHERE rn % 50 = 0")
cte("fcand", ["flushes"], """
SELECT o.ip, f.flush_id, f.ft AS t, CAST(least(100, count(*)) AS BIGINT) AS count
FROM flushes f JOIN ordered o ON o.suspicious AND o.rn <= f.end_rn AND o.t >= f.ft - INTERVAL 60 SECOND
GROUP BY o.ip, f.flush_id, f.ft HAVING count(*) >= 5
""")
cooldown_ctes("fl", "fcand")


# --- runs and metric samples --------------------------------------------------

cte("runs_ev", [], """
SELECT event_id, user_id, event_type, value, workers, rate, batch,
  'w' || workers || '_r' || rate || '_b' || batch AS exp_id
FROM (SELECT *, [2, 4, 6, 8][user_id % 4 + 1] AS workers, [300, 500, 1000][user_id % 3 + 1] AS rate,
             [50, 100][(user_id // 12) % 2 + 1] AS batch FROM events)
""")
cte("samples", ["runs_ev"], """
SELECT exp_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(rn * 5) AS timestamp, CAST(rn * 5 AS DOUBLE) AS runtime_sec,
  rn AS events_processed, event_id % 100 AS ingestion_queue_size, user_id % 50 AS parsed_queue_size,
  value % 100 AS cpu_percent, 20.0 + value % 10 AS memory_mb, value AS throughput_eps, alerts_count, event_id AS sample_id
FROM (SELECT *, row_number() OVER (PARTITION BY exp_id ORDER BY event_id) AS rn,
        sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY exp_id ORDER BY event_id) AS alerts_count
      FROM runs_ev)
""")
cte("runs", ["runs_ev"], """
SELECT exp_id, CAST(workers AS INTEGER) AS workers, CAST(rate AS INTEGER) AS rate, CAST(batch AS INTEGER) AS batch,
  60 AS duration, max(event_id) % 2 = 0 AS success,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(min(event_id)) AS start_time,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(max(event_id)) AS end_time,
  'results/events_' || exp_id || '.db' AS db_file, 'results/metrics_' || exp_id || '.csv' AS metrics_file
FROM runs_ev GROUP BY exp_id, workers, rate, batch
""")
cte("steady", ["samples"], """
SELECT exp_id, avg(throughput_eps) FILTER (WHERE rn > n // 2) AS avg_throughput, max(throughput_eps) AS max_throughput
FROM (SELECT *, row_number() OVER (PARTITION BY exp_id ORDER BY runtime_sec, sample_id) AS rn,
             count(*) OVER (PARTITION BY exp_id) AS n FROM samples)
GROUP BY exp_id
""")
cte("steady_cfg", ["steady"], """
SELECT *, CAST(regexp_extract(exp_id, 'w(\\d+)_r(\\d+)_b(\\d+)', 1) AS INTEGER) AS workers,
  CAST(regexp_extract(exp_id, 'w(\\d+)_r(\\d+)_b(\\d+)', 2) AS INTEGER) AS rate,
  CAST(regexp_extract(exp_id, 'w(\\d+)_r(\\d+)_b(\\d+)', 3) AS INTEGER) AS batch FROM steady
""")
cte("run_lat", ["runs_ev"], "SELECT exp_id, event_id, CAST(round(value * 1000) AS BIGINT) / 1000.0 AS latency_ms FROM runs_ev")
cte("lat_by_run", ["run_lat"], """
SELECT exp_id, count(*) AS count, round(avg(latency_ms), 6) AS mean,
  round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.95), 6) AS p95,
  round(quantile_cont(latency_ms, 0.99), 6) AS p99
FROM run_lat GROUP BY exp_id
""")
