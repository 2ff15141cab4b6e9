"""Checking SQL for the registered queries, run by an independent engine.

Each statement states the wanted result over the same tables in that engine's
own words. ``{rows}`` is the shared audit-row text of ``bridge``.
"""

from __future__ import annotations

from logtally import bridge

_K = "CAST(json_extract_string(props, '$.k') AS INT)"

_RAW = "raw AS (" + bridge.AUDIT_ROWS.format(k=_K, events="events") + ")"

_V = """v AS (
  SELECT id, account_id, action, status, user_agent, source, created_at,
    created_at + INTERVAL 9 HOUR AS kst,
    CAST(created_at + INTERVAL 9 HOUR AS DATE) AS day,
    coalesce(j ->> '$.mapId', j ->> '$.to') AS map_id,
    j ->> '$.from' AS map_from, j ->> '$.to' AS map_to,
    j ->> '$.pokedexId' AS pokedex_id,
    TRY_CAST(j ->> '$.level' AS INTEGER) AS level,
    TRY_CAST(j ->> '$.isShiny' AS BOOLEAN) AS is_shiny,
    coalesce(TRY_CAST(j ->> '$.isS000Starter' AS BOOLEAN), false) AS is_starter,
    coalesce(j ->> '$.wildUid', j ->> '$.uid') AS wild_uid,
    TRY_CAST(j ->> '$.bait' AS BOOLEAN) AS used_bait,
    TRY_CAST(j ->> '$.rock' AS BOOLEAN) AS used_rock,
    TRY_CAST(j ->> '$.partyBonus' AS DOUBLE) AS party_bonus,
    j ->> '$.reason' AS catch_reason,
    TRY_CAST(j ->> '$.fled' AS BOOLEAN) AS catch_fled,
    j ->> '$.result' AS flee_result,
    TRY_CAST(j ->> '$.count' AS INTEGER) AS spawn_count,
    TRY_CAST(j ->> '$.claimed' AS INTEGER) AS ticket_claimed,
    TRY_CAST(j ->> '$.money' AS BIGINT) AS money_after,
    j ->> '$.item' AS item_id,
    TRY_CAST(j ->> '$.quantity' AS INTEGER) AS quantity,
    TRY_CAST(coalesce(j ->> '$.totalCost', j ->> '$.totalGain') AS BIGINT)
      AS trade_amount,
    split_part(j ->> '$.url', '?', 1) AS req_url,
    j ->> '$.method' AS req_method, j ->> '$.errorCode' AS error_code,
    (j ->> '$.body._truncated') IS NOT NULL AS body_truncated,
    (j ->> '$.mapId') IS DISTINCT FROM 's000'
      AND coalesce(j ->> '$.mapId', j ->> '$.to', '') <> 's000' AS outside,
    j
  FROM (SELECT *, CAST(detail AS JSON) AS j FROM raw) parsed)"""

_BASE = f"WITH {_RAW}, {_V}"

_MONEY = """money AS (
  SELECT b.*, lag(money_after) OVER prior AS money_before,
    lag(created_at) OVER prior AS before_at
  FROM v b
  WHERE action IN ('ITEM_BUY', 'ITEM_SELL')
    AND money_after IS NOT NULL
  WINDOW prior AS (PARTITION BY account_id ORDER BY created_at, id))"""

# Pairing without windows on both sides: lists of the pair's failures, indexed.
_ATTEMPT = """fails AS (
  SELECT account_id, wild_uid,
    list({'at': created_at, 'why': catch_reason} ORDER BY created_at, id) AS known
  FROM v WHERE action = 'POKEMON_CATCH_FAIL'
    AND account_id IS NOT NULL AND wild_uid IS NOT NULL
  GROUP BY ALL),
tries AS (
  SELECT v.*, row_number() OVER (PARTITION BY account_id, wild_uid
                                 ORDER BY created_at, id) AS nth
  FROM v WHERE action = 'POKEMON_CATCH_ATTEMPT'
    AND account_id IS NOT NULL AND wild_uid IS NOT NULL),
attempt AS (
  SELECT tries.* EXCLUDE (catch_reason, nth), known[nth].at AS failed_at,
    known[nth].why AS why, coalesce(known[nth].why, 'caught') AS outcome
  FROM tries LEFT JOIN fails
    ON tries.account_id = fails.account_id AND tries.wild_uid = fails.wild_uid)"""

_SESSION = """moves AS (
  SELECT account_id, created_at, kst, map_id, action,
    lead({'act': action, 'at': created_at, 'map': map_id})
      OVER (PARTITION BY account_id ORDER BY created_at, id) AS nxt
  FROM v WHERE action IN ('SAFARI_ENTER', 'SAFARI_EXIT')
    AND account_id IS NOT NULL AND outside),
session AS (
  SELECT account_id, map_id AS entry_map, created_at AS entered_at,
    kst AS entered_kst, coalesce(nxt.act = 'SAFARI_EXIT', false) AS closed,
    if(nxt.act = 'SAFARI_EXIT', nxt.map, NULL) AS exit_map,
    if(nxt.act = 'SAFARI_EXIT', nxt.at, NULL) AS exited_at,
    if(nxt.act = 'SAFARI_EXIT', date_diff('us', created_at, nxt.at) / 1000000, NULL) AS dwell_sec
  FROM moves WHERE action = 'SAFARI_ENTER')"""


def _n(condition: str) -> str:
    """Rows meeting a condition, as BIGINT."""
    return f"CAST(coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT)"


_PLAIN = "used_bait IS NOT TRUE AND used_rock IS NOT TRUE"

_DAU_DAY = f"""dau_day AS (
  SELECT day, count(DISTINCT account_id) AS dau,
    {_n("action = 'CREATE_USER'")} AS new_users, count(*) AS events
  FROM v WHERE account_id IS NOT NULL GROUP BY day)"""

_TRY = "action = 'POKEMON_CATCH_ATTEMPT' AND outside"
_BAIT_DAY = f"""bait_day AS (
  SELECT *, attempts_bait / nullif(attempts, 0) AS bait_share,
    attempts_rock / nullif(attempts, 0) AS rock_share,
    attempts_plain / nullif(attempts, 0) AS plain_share,
    bait_stay / nullif(bait_n, 0) AS bait_stay_rate,
    rock_stay / nullif(rock_n, 0) AS rock_stay_rate
  FROM (
    SELECT day,
      {_n("action = 'SAFARI_BAIT'")} AS bait_n,
      {_n("action = 'SAFARI_ROCK'")} AS rock_n,
      count(DISTINCT CASE WHEN action = 'SAFARI_BAIT' THEN account_id END) AS users_bait,
      count(DISTINCT CASE WHEN action = 'SAFARI_ROCK' THEN account_id END) AS users_rock,
      {_n("action = 'SAFARI_BAIT' AND flee_result = 'stay'")} AS bait_stay,
      {_n("action = 'SAFARI_ROCK' AND flee_result = 'stay'")} AS rock_stay,
      {_n(_TRY)} AS attempts,
      {_n(_TRY + " AND used_bait")} AS attempts_bait,
      {_n(_TRY + " AND used_rock")} AS attempts_rock,
      {_n(_TRY + " AND " + _PLAIN)} AS attempts_plain
    FROM v GROUP BY day) sums)"""

_CATCH_DAY = f"""seen AS (
  SELECT day, count(*) AS n FROM v
  WHERE action = 'POKEMON_CATCH' AND NOT is_starter GROUP BY day),
catch_day AS (
  SELECT sums.* EXCLUDE (caught_bait, caught_rock, caught_plain),
    caught / nullif(attempts, 0) AS catch_rate,
    fled / nullif(attempts, 0) AS flee_rate,
    broke_out / nullif(attempts, 0) AS break_out_rate,
    caught_bait / nullif(attempts_bait, 0) AS catch_rate_bait,
    caught_rock / nullif(attempts_rock, 0) AS catch_rate_rock,
    caught_plain / nullif(attempts_plain, 0) AS catch_rate_plain,
    coalesce(seen.n, 0) AS caught_observed,
    caught - coalesce(seen.n, 0) AS caught_gap
  FROM (
    SELECT day, count(*) AS attempts, count(DISTINCT account_id) AS users,
      {_n("outcome = 'caught'")} AS caught,
      {_n("outcome = 'flee'")} AS fled,
      {_n("outcome = 'break_out'")} AS broke_out,
      {_n("used_bait")} AS attempts_bait,
      {_n("used_rock")} AS attempts_rock,
      {_n(_PLAIN)} AS attempts_plain,
      {_n("used_bait AND outcome = 'caught'")} AS caught_bait,
      {_n("used_rock AND outcome = 'caught'")} AS caught_rock,
      {_n(_PLAIN + " AND outcome = 'caught'")} AS caught_plain
    FROM attempt WHERE outside GROUP BY day) sums
  LEFT JOIN seen ON seen.day = sums.day)"""

_SESSION_DAY = f"""session_day AS (
  SELECT CAST(entered_kst AS DATE) AS day, count(*) AS sessions,
    count(DISTINCT account_id) AS users, {_n("closed")} AS closed_sessions,
    1 - {_n("closed")} / count(*) AS unclosed_rate,
    quantile_cont(dwell_sec, 0.5) AS dwell_median_sec,
    quantile_cont(dwell_sec, 0.9) AS dwell_p90_sec
  FROM session GROUP BY ALL)"""

_TEXT_DAY = "CAST(day AS VARCHAR) AS d_kst"


def _with(*ctes: str) -> str:
    return ", ".join([_BASE, *ctes])


SQL: dict[str, str] = {}

SQL["audit_parse"] = f"""{_BASE}
SELECT * EXCLUDE (created_at, kst, day, j, outside),
  CAST(created_at AS VARCHAR) AS created_at, CAST(kst AS VARCHAR) AS created_at_kst
FROM v"""

SQL["money_series"] = f"""{_with(_MONEY)}
SELECT id, account_id, CAST(created_at AS VARCHAR) AS created_at,
  CAST(kst AS VARCHAR) AS created_at_kst, action, item_id, quantity,
  trade_amount, money_after, money_after - money_before AS money_delta,
  money_before, date_diff('us', before_at, created_at) / 1000000 AS secs_since_prev
FROM money"""

SQL["economy_daily"] = f"""{_BASE}
SELECT {_TEXT_DAY},
  CAST(sum(CASE action WHEN 'ITEM_SELL' THEN trade_amount END) AS BIGINT) AS faucet,
  CAST(sum(CASE action WHEN 'ITEM_BUY' THEN trade_amount END) AS BIGINT) AS sink,
  {_n("action = 'ITEM_SELL'")} AS n_sell, {_n("action = 'ITEM_BUY'")} AS n_buy,
  count(DISTINCT account_id) AS traders
FROM v WHERE action IN ('ITEM_BUY', 'ITEM_SELL') GROUP BY day"""

SQL["dau_daily"] = f"""{_with(_DAU_DAY)}
SELECT {_TEXT_DAY}, dau, new_users, events FROM dau_day"""

SQL["bait_rock_daily"] = f"""{_with(_BAIT_DAY)}
SELECT {_TEXT_DAY}, * EXCLUDE (day, bait_stay, rock_stay) FROM bait_day"""

SQL["catch_attempt"] = f"""{_with(_ATTEMPT)}
SELECT id, account_id, CAST(created_at AS VARCHAR) AS created_at,
  CAST(kst AS VARCHAR) AS created_at_kst, map_id, wild_uid, pokedex_id, level,
  is_shiny, used_bait, used_rock, party_bonus,
  CAST(failed_at AS VARCHAR) AS failed_at, outcome, why IS NULL AS outcome_inferred
FROM attempt"""

SQL["catch_rate_daily"] = f"""{_with(_ATTEMPT, _CATCH_DAY)}
SELECT {_TEXT_DAY}, * EXCLUDE (day) FROM catch_day"""

SQL["safari_session"] = f"""{_with(_SESSION)}
SELECT account_id, entry_map, exit_map, CAST(entered_at AS VARCHAR) AS entered_at,
  CAST(entered_kst AS VARCHAR) AS entered_at_kst,
  CAST(exited_at AS VARCHAR) AS exited_at, dwell_sec, closed
FROM session"""

SQL["safari_session_daily"] = f"""{_with(_SESSION, _SESSION_DAY)}
SELECT {_TEXT_DAY}, * EXCLUDE (day) REPLACE (
  round(dwell_median_sec, 6) AS dwell_median_sec, round(dwell_p90_sec, 6) AS dwell_p90_sec)
FROM session_day"""

# --- dimensions ---------------------------------------------------------------


def _dim_cte() -> str:
    return f"""dim AS (
  SELECT if(length(key) < 4 AND key ~ '^[0-9]+$', right('0000' || key, 4), key) AS pokedex_id,
    key AS pokedex_id_raw, TRY_CAST(key AS INTEGER) AS pokedex_num,
    replace(comment, chr(13), '') AS name_ko, type1,
    CASE WHEN type2 <> '' THEN type2 END AS type2,
    replace(tier, chr(13), '') AS tier, generation, growth_group,
    TRY_CAST(rate_capture AS DOUBLE) AS rate_capture,
    TRY_CAST(replace(rate_flee, chr(13), '') AS DOUBLE) AS rate_flee,
    TRY_CAST(height_m AS DOUBLE) AS height_m,
    TRY_CAST(weight_kg AS DOUBLE) AS weight_kg,
    TRY_CAST(base_exp AS INTEGER) AS base_exp
  FROM (SELECT *, replace(id, chr(13), '') AS key
        FROM ({bridge.POKEMON_ROWS.format(part="part")}) f) g)"""


SQL["pokemon_dim"] = f"WITH {_dim_cte()} SELECT * FROM dim"

SQL["item_dim"] = f"""
SELECT id AS item_id, replace(comment, chr(13), '') AS name_ko, category, tier,
  TRY_CAST(buy AS BIGINT) AS buy_price,
  TRY_CAST(replace(sell, chr(13), '') AS BIGINT) AS sell_price,
  purchasable = 'TRUE' AS purchasable,
  upper(replace(sellable, chr(13), '')) = 'TRUE' AS sellable
FROM ({bridge.ITEM_ROWS.format(part="part")}) f"""

SQL["orphan_keys"] = f"""{_with(_dim_cte())}
SELECT pokedex_id, count(*) AS events FROM v
WHERE pokedex_id IS NOT NULL AND pokedex_id NOT IN (SELECT pokedex_id FROM dim)
GROUP BY pokedex_id"""

# --- series: a calendar joined with the daily metric ---------------------------


def _calendar(daily: str, name: str) -> str:
    return f"""{name} AS (
  SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(greatest(min(day), max(day) - 89) AS TIMESTAMP) AS lo,
               CAST(max(day) AS TIMESTAMP) AS hi FROM {daily}) b)"""


def _series_cte(name: str, daily: str, counts: str, rates: dict[str, str]) -> str:
    columns = [f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in counts.split()]
    columns += [f"{expression} AS {c}" for c, expression in rates.items()]
    return f"""{_calendar(daily, name + '_days')},
{name} AS (SELECT CAST(d AS VARCHAR) AS d, {', '.join(columns)}
  FROM {name}_days LEFT JOIN {daily} ON {daily}.day = d)"""


def _four(names: str) -> dict[str, str]:
    return {n: f"round({n}, 4)" for n in names.split()}


_S_DAU = _series_cte("s_dau", "dau_day", "dau new_users events", {})
_S_BAIT = _series_cte(
    "s_bait",
    "bait_day",
    "bait_n rock_n users_bait users_rock attempts attempts_bait attempts_rock attempts_plain",
    _four("bait_share rock_share plain_share bait_stay_rate rock_stay_rate"),
)
_S_CATCH = _series_cte(
    "s_catch",
    "catch_day",
    "attempts users caught fled broke_out attempts_bait attempts_rock attempts_plain"
    " caught_observed caught_gap",
    _four(
        "catch_rate flee_rate break_out_rate"
        " catch_rate_bait catch_rate_rock catch_rate_plain"
    ),
)
_S_SESSION = _series_cte(
    "s_session",
    "session_day",
    "sessions users closed_sessions",
    {
        "unclosed_rate": "round(unclosed_rate, 4)",
        "dwell_median_min": "round(dwell_median_sec / 60, 2)",
        "dwell_p90_min": "round(dwell_p90_sec / 60, 2)",
    },
)

SQL["series_dau"] = f"{_with(_DAU_DAY, _S_DAU)} SELECT * FROM s_dau"
SQL["series_bait_rock"] = f"{_with(_BAIT_DAY, _S_BAIT)} SELECT * FROM s_bait"
SQL["series_catch_rate"] = (
    f"{_with(_ATTEMPT, _CATCH_DAY, _S_CATCH)} SELECT * FROM s_catch"
)
SQL["series_safari_session"] = (
    f"{_with(_SESSION, _SESSION_DAY, _S_SESSION)} SELECT * FROM s_session"
)

# --- drill-down: every category counted straight from the rows ------------------

_DRILL_SOURCES = {
    "v": [
        ("dau", "active", "account_id IS NOT NULL"),
        ("dau", "new", "account_id IS NOT NULL AND action = 'CREATE_USER'"),
        ("bait_rock", "bait", "action = 'SAFARI_BAIT'"),
        ("bait_rock", "rock", "action = 'SAFARI_ROCK'"),
        ("bait_rock", "attempts", _TRY),
    ],
    "attempt": [
        ("catch_rate", "caught", "outside AND outcome = 'caught'"),
        ("catch_rate", "fled", "outside AND outcome = 'flee'"),
        ("catch_rate", "broke_out", "outside AND outcome = 'break_out'"),
        ("catch_rate", "all", "outside"),
        ("catch_rate", "bait", "outside AND used_bait"),
        ("catch_rate", "rock", "outside AND used_rock"),
        ("catch_rate", "plain", f"outside AND {_PLAIN}"),
    ],
    "(SELECT *, CAST(entered_kst AS DATE) AS day FROM session)": [
        ("safari_session", "completed", "dwell_sec IS NOT NULL"),
        ("safari_session", "all", "true"),
    ],
}

_DRILL = """published AS (
  SELECT 'dau' AS metric, min(day) AS lo, max(day) AS hi FROM v WHERE account_id IS NOT NULL
  UNION ALL SELECT 'bait_rock', min(day), max(day) FROM v
  UNION ALL SELECT 'catch_rate', min(day), max(day) FROM attempt WHERE outside
  UNION ALL SELECT 'safari_session', CAST(min(entered_kst) AS DATE), CAST(max(entered_kst) AS DATE) FROM session),
every_day AS (""" + " UNION ALL ".join(
    f"""SELECT '{metric}' AS metric, '{category}' AS category, day, account_id, count(*) AS count
FROM {source} src WHERE {condition} GROUP BY day, account_id"""
    for source, entries in _DRILL_SOURCES.items()
    for metric, category, condition in entries
) + """),
drill AS (
  SELECT metric, category, CAST(day AS VARCHAR) AS d, account_id, count
  FROM every_day JOIN published USING (metric) WHERE day BETWEEN greatest(lo, hi - 89) AND hi)"""

_DRILL_TOTALS = """drill_totals AS (
  SELECT metric, category, d, count(account_id) AS total_users,
    CAST(coalesce(sum(count) FILTER (account_id IS NULL), 0) AS BIGINT)
      AS unidentified_records
  FROM drill GROUP BY metric, category, d)"""

_ALL_DRILL = _with(_ATTEMPT, _SESSION, _DRILL)

SQL["drill_counts"] = f"{_ALL_DRILL} SELECT * FROM drill"
SQL["drill_totals"] = f"{_ALL_DRILL}, {_DRILL_TOTALS} SELECT * FROM drill_totals"
SQL["drill_preview"] = f"""{_ALL_DRILL}
SELECT metric, category, d, account_id, count,
  CAST(row_number() OVER best AS INTEGER) AS rank
FROM drill WHERE account_id IS NOT NULL
WINDOW best AS (PARTITION BY metric, category, d ORDER BY count DESC, account_id)
QUALIFY rank <= 10"""
SQL["drill_page"] = f"""{_ALL_DRILL}
SELECT account_id, count FROM drill
WHERE metric = 'dau' AND category = 'active' AND d = '2024-01-10'
  AND CAST(account_id AS VARCHAR) LIKE '%1%'
ORDER BY count DESC, account_id LIMIT 50"""

_LOOKUP = """lookup(metric, series, category) AS (VALUES
  ('dau', 'dau', 'active'), ('dau', 'new_users', 'new'),
  ('bait_rock', 'bait_n', 'bait'), ('bait_rock', 'bait_stay_rate', 'bait'),
  ('bait_rock', 'rock_n', 'rock'), ('bait_rock', 'rock_stay_rate', 'rock'),
  ('bait_rock', 'bait_share', 'attempts'), ('bait_rock', 'rock_share', 'attempts'),
  ('bait_rock', 'plain_share', 'attempts'),
  ('catch_rate', 'caught', 'caught'), ('catch_rate', 'fled', 'fled'),
  ('catch_rate', 'broke_out', 'broke_out'), ('catch_rate', 'catch_rate', 'all'),
  ('catch_rate', 'flee_rate', 'all'), ('catch_rate', 'break_out_rate', 'all'),
  ('catch_rate', 'catch_rate_bait', 'bait'), ('catch_rate', 'catch_rate_rock', 'rock'),
  ('catch_rate', 'catch_rate_plain', 'plain'),
  ('safari_session', 'dwell_median_min', 'completed'),
  ('safari_session', 'dwell_p90_min', 'completed'),
  ('safari_session', 'sessions', 'all'), ('safari_session', 'unclosed_rate', 'all'))"""
SQL["drill_by_series"] = f"""{_ALL_DRILL}, {_DRILL_TOTALS}, {_LOOKUP}
SELECT metric, series, category, d, total_users, unidentified_records
FROM drill_totals NATURAL JOIN lookup"""

# --- periods --------------------------------------------------------------------

_EVERY_SERIES = _with(
    _ATTEMPT, _SESSION, _DAU_DAY, _BAIT_DAY, _CATCH_DAY, _SESSION_DAY,
    _S_DAU, _S_BAIT, _S_CATCH, _S_SESSION,
)
_FROM_DAY = """cut AS (
  SELECT CAST(max(CAST(d AS DATE)) - 6 AS VARCHAR) AS d0 FROM (
    SELECT d FROM s_dau UNION ALL SELECT d FROM s_bait
    UNION ALL SELECT d FROM s_catch UNION ALL SELECT d FROM s_session) every_day)"""


def _last_days(name: str) -> str:
    return f"(SELECT {name}.* FROM {name}, cut WHERE d >= d0)"


SQL["period_summary"] = f"""{_EVERY_SERIES}, {_FROM_DAY}
SELECT (SELECT avg(dau) FROM {_last_days('s_dau')}) AS mean_dau,
  (SELECT CAST(sum(new_users) AS BIGINT) FROM {_last_days('s_dau')}) AS new_users,
  CAST(sum(attempts) AS BIGINT) AS attempts,
  CAST(sum(caught) AS DOUBLE) / sum(attempts) AS catch_rate
FROM {_last_days('s_catch')}"""

SQL["period_notes"] = f"""{_EVERY_SERIES}, {_FROM_DAY},
b AS (SELECT CAST(sum(bait_n) AS BIGINT) AS bait_n, CAST(sum(rock_n) AS BIGINT) AS rock_n,
  CAST(sum(attempts_bait + attempts_rock) AS DOUBLE) / sum(attempts) AS used_share
  FROM {_last_days('s_bait')}),
u AS (SELECT CAST(sum(new_users) AS BIGINT) AS new_users, max(dau) AS max_dau
  FROM {_last_days('s_dau')}),
c AS (SELECT CAST(sum(attempts) AS BIGINT) AS attempts,
  CAST(sum(caught) AS BIGINT) AS caught,
  CAST(sum(caught) AS DOUBLE) / sum(attempts) AS catch_rate,
  CAST(sum(abs(caught_gap)) AS BIGINT) AS gap,
  10 * sum(abs(caught_gap)) > sum(attempts) AS gap_flag
  FROM {_last_days('s_catch')}),
s AS (SELECT CAST(sum(sessions) AS BIGINT) AS sessions,
  CAST(sum(sessions - closed_sessions) AS DOUBLE) / sum(sessions) AS unclosed_share
  FROM {_last_days('s_session')})
SELECT * FROM b, u, c, s"""

SQL["period_slice"] = f"""{_EVERY_SERIES}, {_FROM_DAY}
SELECT * FROM {_last_days('s_catch')}"""

SQL["publish_roundtrip"] = SQL["drill_counts"]
SQL["dims_roundtrip"] = SQL["pokemon_dim"]

_LOG = """log AS (
  SELECT day, max(created_at) AS run_at, count(*) AS inserted FROM v GROUP BY day)"""

SQL["freshness"] = f"""{_with(_LOG)}
SELECT CAST(max(run_at) AS VARCHAR) AS last_load_at,
  epoch(TIMESTAMP '2024-02-01 12:00:00' - max(run_at)) / 3600 AS age_hours,
  max(run_at) < TIMESTAMP '2024-01-31 00:00:00' AS stale
FROM log"""

SQL["meta"] = f"""{_with(_LOG)}
SELECT CAST(max(run_at) AS VARCHAR) AS last_load_at,
  CAST(sum(inserted) AS BIGINT) AS total_rows,
  arg_max(inserted, run_at) AS last_inserted, CAST(1 AS BIGINT) AS last_files,
  (SELECT CAST(max(ts) AS VARCHAR) FROM events) AS latest_event_utc,
  'v1' AS master_sha, (SELECT count(*) FROM part) AS master_pokemon_rows
FROM log"""

# --- ingest -----------------------------------------------------------------------

_TRADE = "action IN ('ITEM_BUY', 'ITEM_SELL')"
_FACT = "id, account_id, action, source, CAST(created_at AS VARCHAR) AS created_at"

SQL["ingest_dedup"] = f"""{_BASE}
SELECT {_FACT.replace("source", f"if({_TRADE}, 'second', source) AS source")} FROM v"""

SQL["ingest_antijoin"] = f"""{_BASE}
SELECT {_FACT} FROM v WHERE action = 'POKEMON_CATCH'"""

SQL["upsert_latest"] = f"""{_BASE}
SELECT {_FACT.replace("source", f"if({_TRADE}, 'forced', source) AS source")} FROM v
UNION ALL
SELECT -id, account_id, action, 'forced', CAST(created_at AS VARCHAR)
FROM v WHERE action = 'POKEMON_CATCH'"""

SQL["scan_plan"] = f"""{_BASE}
SELECT concat('s3://b/audit/', strftime(ship, '%Y/%m/%d'), '/audit-', ship,
    'T0003Z-', cutoff_id, '.jsonl.gz') AS path,
  CAST(ship AS VARCHAR) AS batch_date, cutoff_id
FROM (SELECT CAST(created_at AS DATE) AS ship, max(id) AS cutoff_id
      FROM v GROUP BY ALL) o
WHERE ship > DATE '2024-01-19'"""

SQL["jsonl_roundtrip"] = SQL["stream_load"] = SQL["audit_parse"]

# Reloaded are objects of the last seven days: rows of 25 January on.
_AGAIN = f"({_TRADE} AND created_at >= TIMESTAMP '2024-01-25')"
SQL["forced_load"] = f"""{_BASE}
SELECT {_FACT.replace("source", f"if({_AGAIN}, 'forced', source) AS source")} FROM v"""
SQL["repeat_load"] = f"""{_BASE}
SELECT {_FACT} FROM v"""


def _reload_log(first_day: str) -> str:
    """The first load has everything, the second one objects but no new row."""
    return f"""{_BASE},
a AS (SELECT count(*) AS n, max(id) AS top, count(DISTINCT CAST(created_at AS DATE)) AS days,
    count(DISTINCT CASE WHEN {_TRADE} AND created_at >= TIMESTAMP '2024-01-25' THEN CAST(created_at AS DATE) END)
    + count(DISTINCT CASE WHEN created_at >= TIMESTAMP '{first_day}' THEN CAST(created_at AS DATE) END) AS again
  FROM v)
SELECT '2026-11-01 00:00:00' AS run_at, '2026-01-01' AS scanned_from, days AS files_scanned,
  n AS rows_inserted, n AS total_rows, top AS max_id FROM a
UNION ALL
SELECT '2026-11-01 01:00:00', '2026-10-25', again, 0, n, top FROM a"""


SQL["forced_load_log"] = _reload_log("2024-01-29")
SQL["repeat_load_log"] = _reload_log("2999-01-01")

SQL["load_log_row"] = f"""{_BASE}
SELECT '2026-11-01 00:00:00' AS run_at, '2026-01-01' AS scanned_from,
  count(DISTINCT CAST(created_at AS DATE)) AS files_scanned,
  count(*) AS rows_inserted, count(*) AS total_rows, max(id) AS max_id
FROM v"""

# --- checks -------------------------------------------------------------------------

_JUMPY = "jumpy AS (SELECT * REPLACE (id + id // 1500 * 5000 AS id) FROM v)"
_NEXT_ID = "lead(id) OVER (ORDER BY id)"

SQL["dup_ids"] = f"""{_BASE}
SELECT 'dup' AS check_name, CAST(id AS VARCHAR) AS detail FROM v WHERE {_TRADE}"""

SQL["id_gaps"] = f"""{_with(_JUMPY)}
SELECT id AS prev, nxt AS id FROM (SELECT id, {_NEXT_ID} AS nxt FROM jumpy) n
WHERE nxt > prev + 1000"""

SQL["unmasked_urls"] = f"""{_BASE}
SELECT 'unmasked_url' AS check_name, CAST(id AS VARCHAR) AS detail
FROM v WHERE strpos(req_url, '?') > 0"""

SQL["assertions"] = f"""{_with(_JUMPY, _dim_cte())}
SELECT 'dup' AS check_name, CAST(id AS VARCHAR) AS detail FROM jumpy WHERE {_TRADE}
UNION ALL
SELECT 'gap', concat(id, '→', nxt) FROM (
  SELECT id, {_NEXT_ID} AS nxt FROM jumpy
  WHERE created_at > TIMESTAMP '2024-01-28 00:00:00') n WHERE nxt - id > 1000
UNION ALL
SELECT 'orphan_pokedex', pokedex_id FROM v
WHERE pokedex_id IS NOT NULL AND pokedex_id NOT IN (SELECT pokedex_id FROM dim)"""

SQL["assertions_dirty"] = f"""{_with(_dim_cte())}
SELECT 'ip_column_present' AS check_name, 'ip' AS detail
UNION ALL SELECT 'username_column_exposed', 'Login_Username'
UNION ALL SELECT 'unmasked_url', CAST(id AS VARCHAR) FROM v
WHERE req_url IS NOT NULL AND req_method IS NOT NULL
UNION ALL SELECT 'crlf_residue', CAST(pokedex_id_raw AS VARCHAR) FROM dim
UNION ALL
SELECT 'gap', concat(id, '→', nxt) FROM (
  SELECT id, {_NEXT_ID} AS nxt FROM v
  WHERE created_at > TIMESTAMP '2024-01-28 00:00:00') n WHERE nxt - id > 1000
UNION ALL
SELECT 'orphan_pokedex', pokedex_id FROM v
WHERE pokedex_id IS NOT NULL AND pokedex_id NOT IN (SELECT pokedex_id FROM dim)"""

SQL["contract_broken"] = f"""{_with(_DAU_DAY)},
days AS (SELECT datediff('day', min(day), max(day)) + 1 AS n FROM dau_day)
SELECT 'dau' AS metric, 'too_many_days' AS rule, CAST(4 * n AS VARCHAR) AS detail FROM days WHERE 4 * n > 90
UNION ALL SELECT 'dau', 'days_not_contiguous', concat(4 * n, '/', 4 * n, '/', n + 300) FROM days
UNION ALL SELECT 'catch_rate', 'not_finite:catch_rate', '2024-01-10'
UNION ALL SELECT 'safari_session', 'not_finite:unclosed_rate', '2024-01-10'
UNION ALL SELECT 'bait_rock', 'days_not_contiguous', concat(n + 1, '/', n, '/', n) FROM days
UNION ALL SELECT 'meta', 'negative:last_inserted', CAST(-count(*) AS VARCHAR)
FROM v WHERE day = (SELECT max(day) FROM v)
UNION ALL SELECT 'meta', 'row_count', '2'"""

SQL["preview_spoiled"] = f"""{_ALL_DRILL}, {_DRILL_TOTALS},
hit AS (SELECT metric, category, d, total_users FROM drill_totals WHERE metric = 'dau' AND d = '2024-01-10')
SELECT metric, category, d, 'totals_missing' AS rule, 1 AS n FROM hit
UNION ALL SELECT metric, category, d, 'totals_extra', 1 FROM hit
UNION ALL SELECT metric, category, d, 'preview_missing', 1 FROM hit WHERE total_users > 0"""

SQL["contract_drift"] = f"""{_BASE},
recent AS (SELECT * FROM v WHERE created_at > TIMESTAMP '2024-01-01 00:00:00'),
n AS (SELECT
  {_n("action = 'REQUEST_REJECTED' AND strpos(j ->> '$.url', '?') > 0")} AS urls,
  {_n("action = 'LOGIN_FAILED' AND (j ->> '$.body.username') IS NOT NULL")} AS names,
  {_n("action = 'POKEMON_CATCH' AND (j ->> '$.wildUid') IS NOT NULL")} AS uids,
  {_n("action IN ('SAFARI_BAIT', 'SAFARI_ROCK') AND (j ->> '$.mapId') IS NOT NULL")} AS maps,
  (SELECT count(*) FROM part) AS parts,
  (SELECT CAST(max(created_at) AS VARCHAR) FROM v) AS seen_at
  FROM recent)
SELECT '1. source carries ip' AS item, 'yes' AS expected, 'yes' AS actual,
  'audit/2024/01/30/audit-1.jsonl.gz' AS evidence FROM n
UNION ALL SELECT '2. source columns',
  '[account_id, action, created_at, detail, id, ip, source, status, user_agent]',
  '[account_id, action, created_at, detail, id, ip, source, status, user_agent]',
  seen_at FROM n
UNION ALL SELECT '3. REQUEST_REJECTED url keeps its query string', 'yes',
  if(urls > 0, concat('yes: ', urls, ' rows'), 'no'), '' FROM n
UNION ALL SELECT '4. LOGIN_FAILED body has a plain username', 'yes',
  if(names > 0, concat('yes: ', names, ' rows'), 'no'), '' FROM n
UNION ALL SELECT '5. dimension files are delivered', 'no',
  if(parts > 0, concat('yes: ', parts, ' rows'), 'no'), 'v1' FROM n
UNION ALL SELECT '6. POKEMON_CATCH has wildUid', 'no',
  if(uids > 0, concat('yes: ', uids, ' rows'), 'no'), '' FROM n
UNION ALL SELECT '7. SAFARI_BAIT and SAFARI_ROCK have mapId', 'no',
  if(maps > 0, 'yes', 'no'), '' FROM n"""

SQL["reconcile"] = f"""{_with(_JUMPY)}
SELECT 'missing' AS kind, min(id) AS from_id, max(id) AS to_id, count(*) AS n
FROM jumpy WHERE action = 'LOGIN_FAILED' HAVING count(*) > 0
UNION ALL
SELECT 'gap', id, nxt, nxt - id - 1
FROM (SELECT id, {_NEXT_ID} AS nxt FROM jumpy) pairs WHERE nxt - id > 1000"""

SQL["series_contract"] = f"""{_with(_DAU_DAY)}
SELECT 'dau' AS metric, 'days_not_contiguous' AS rule,
  concat(count(*) - 1, '/', count(*) - 1, '/', count(*)) AS detail
FROM dau_day HAVING max(CASE WHEN day = DATE '2024-01-10' THEN 1 END) = 1"""

SQL["drill_invariants"] = f"""{_ALL_DRILL}, {_DRILL_TOTALS}
SELECT metric, category, d, 'total' AS rule,
  CAST(sum(count) AS BIGINT) AS published,
  CAST(sum(CASE WHEN account_id IS NULL THEN 0 ELSE count END) AS BIGINT) AS found
FROM drill GROUP BY metric, category, d
HAVING count(*) > count(account_id)"""

SQL["sanity"] = f"""{_with(_MONEY)}
SELECT 'created_twice' AS check_name, CAST(account_id AS VARCHAR) AS detail
FROM v WHERE action = 'CREATE_USER' GROUP BY account_id HAVING count(*) > 1
UNION ALL
SELECT 'balance_broken', CAST(id AS VARCHAR) FROM money
WHERE money_before + if(action = 'ITEM_SELL', trade_amount, -trade_amount) <> money_after"""

# --- product and abuse questions ---------------------------------------------------


def _within(days: int, as_of: str = "2024-01-31 00:00:00") -> str:
    end = f"TIMESTAMP '{as_of}'"
    return f"created_at > {end} - INTERVAL {days} DAY AND created_at <= {end}"


SQL["dau_recent"] = f"""{_BASE}
SELECT {_TEXT_DAY}, count(DISTINCT account_id) AS dau FROM v
WHERE {_within(30)} AND account_id IS NOT NULL GROUP BY day"""

SQL["dau_recent_past"] = f"""{_BASE}
SELECT {_TEXT_DAY}, count(DISTINCT account_id) AS dau FROM v
WHERE {_within(10, "2024-01-20 00:00:00")} AND account_id IS NOT NULL GROUP BY day"""

SQL["funnel"] = f"""{_BASE}
SELECT {_n("signup")} AS signup, {_n("avatar")} AS avatar, {_n("caught")} AS first_catch
FROM (SELECT bool_or(action IN ('REGISTER_LOCAL', 'LOGIN_OAUTH')) AS signup,
        bool_or(action = 'CREATE_USER') AS avatar,
        bool_or(action = 'POKEMON_CATCH') AS caught
      FROM v WHERE {_within(30)} GROUP BY account_id) who"""

SQL["faucet_sink"] = f"""{_BASE}
SELECT {_TEXT_DAY},
  CAST(sum(CASE action WHEN 'ITEM_SELL' THEN trade_amount END) AS BIGINT) AS faucet,
  CAST(sum(CASE action WHEN 'ITEM_BUY' THEN trade_amount END) AS BIGINT) AS sink
FROM v WHERE {_TRADE} AND {_within(30)} GROUP BY day"""

SQL["catch_composition"] = f"""{_with(_dim_cte())}
SELECT map_id, name_ko, tier, count(*) AS catches, {_n("is_shiny")} AS shiny,
  round(avg(level), 1) AS avg_level
FROM v LEFT JOIN dim ON dim.pokedex_id = v.pokedex_id
WHERE action = 'POKEMON_CATCH' AND NOT is_starter AND {_within(14)}
GROUP BY map_id, name_ko, tier"""

SQL["reentry_gap"] = f"""{_BASE}
SELECT account_id, CAST(created_at AS VARCHAR) AS entered,
  date_diff('us', created_at, lead(created_at) OVER (
    PARTITION BY account_id ORDER BY created_at, id)) / 1000000 AS gap_s
FROM v WHERE action = 'SAFARI_ENTER' AND {_within(7)}"""

SQL["map_edges"] = f"""{_BASE}
SELECT map_from AS src, map_to AS dst, count(*) AS n FROM v
WHERE action = 'MAP_CHANGE' AND {_within(7)}
GROUP BY map_from, map_to ORDER BY n DESC, src, dst LIMIT 50"""

SQL["shiny_screen"] = f"""{_BASE}
SELECT account_id, n AS catches, shiny, round(n / 4096, 3) AS expected,
  round(shiny / (n / 4096), 1) AS x_expected
FROM (SELECT account_id, count(*) AS n, {_n("is_shiny")} AS shiny FROM v
      WHERE action = 'POKEMON_CATCH' AND NOT is_starter AND {_within(30)}
      GROUP BY account_id) per
WHERE shiny > 4 * round(n / 4096, 3)"""

SQL["money_unexplained"] = f"""{_with(_MONEY)}
SELECT account_id, CAST(kst AS VARCHAR) AS created_at_kst, action, item_id,
  trade_amount, money_before, money_after, money_after - money_before AS money_delta,
  money_after - (money_before + if(action = 'ITEM_SELL', trade_amount, -trade_amount))
    AS unexplained
FROM money
WHERE {_within(30)} AND money_before IS NOT NULL AND abs(unexplained) > 10000
ORDER BY abs(unexplained) DESC, id LIMIT 50"""

SQL["money_net_gain"] = f"""{_with(_MONEY)}
SELECT account_id, {_TEXT_DAY}, min(money_before) AS money_start,
  max(money_after) AS money_end, max(money_after) - min(money_before) AS net_gain,
  count(*) AS trades
FROM money WHERE {_within(30)} GROUP BY account_id, day
HAVING max(money_after) > min(money_before)
ORDER BY net_gain DESC, account_id, d_kst LIMIT 30"""

SQL["bot_screen"] = f"""{_BASE},
steps AS (
  SELECT account_id, date_diff('us', lag(created_at) OVER (
           PARTITION BY account_id ORDER BY created_at, id), created_at) / 1000000 AS gap
  FROM v WHERE {_within(30)} AND account_id IS NOT NULL)
SELECT account_id, count(*) AS n, round(quantile_cont(gap, 0.5), 2) AS median_s,
  round(stddev(gap), 2) AS sd_s, round(stddev(gap) / quantile_cont(gap, 0.5), 3) AS cv
FROM steps WHERE gap >= 0.1 AND gap <= 400000
GROUP BY account_id HAVING count(*) >= 3 ORDER BY sd_s, account_id LIMIT 20"""

SQL["ticket_ledger"] = f"""{_BASE},
book AS (
  SELECT account_id, {_n("action = 'SAFARI_ENTER'")} AS enters,
    CAST(coalesce(sum(CASE
      WHEN action = 'SAFARI_TICKET_CLAIM' THEN ticket_claimed
      WHEN action = 'ITEM_BUY' AND item_id = 'safari-zone-ticket' THEN quantity
    END), 0) AS BIGINT) AS acquired,
    CAST(min(created_at) AS VARCHAR) AS first_seen,
    CAST(max(created_at) AS VARCHAR) AS last_seen
  FROM v WHERE account_id IS NOT NULL AND {_within(30)} GROUP BY account_id)
SELECT *, enters - acquired AS deficit FROM book WHERE enters > acquired
ORDER BY deficit DESC, account_id LIMIT 30"""


def _zscore(days: int, as_of: str, baseline: int, least: int, min_z: float) -> str:
    return f"""{_BASE},
tries AS (
  SELECT account_id, CAST(floor(epoch(created_at) / 3600) AS BIGINT) AS h, count(*) AS attempts
  FROM v WHERE {_TRY} AND account_id IS NOT NULL AND wild_uid IS NOT NULL AND {_within(days, as_of)}
  GROUP BY account_id, h),
starts AS (SELECT account_id, min(h) AS first FROM tries GROUP BY account_id),
hours AS (  -- every hour of the baseline, written out
  SELECT t.account_id, t.h, t.attempts, g.h AS past
  FROM tries t JOIN starts s ON s.account_id = t.account_id,
    LATERAL (SELECT unnest(range(greatest(t.h - {baseline}, s.first), t.h)) AS h) g),
stats AS (
  SELECT hours.account_id, hours.h, hours.attempts, count(*) AS hours,
    avg(coalesce(p.attempts, 0)) AS mean, stddev_samp(coalesce(p.attempts, 0)) AS sd
  FROM hours LEFT JOIN tries p ON p.account_id = hours.account_id AND p.h = hours.past
  GROUP BY hours.account_id, hours.h, hours.attempts)
SELECT account_id, CAST(TIMESTAMP '1970-01-01' + to_hours(h) AS VARCHAR) AS hour_utc, attempts, hours,
  round(mean, 4) AS mean, round(sd, 4) AS sd, round((attempts - mean) / sd, 3) AS z
FROM stats WHERE hours >= {least} AND sd > 0 AND (attempts - mean) / sd >= {min_z}
ORDER BY (attempts - mean) / sd DESC, account_id, h LIMIT 1000"""


SQL["attempt_zscore"] = _zscore(30, "2024-01-31 00:00:00", 168, 24, 5.0)
SQL["attempt_zscore_past"] = _zscore(14, "2024-01-20 00:00:00", 48, 12, 2.0)

_CONNECTED = """signs AS (
  SELECT account_id, created_at, id, action,
    created_at - lag(created_at) OVER prior > INTERVAL 30 MINUTE AS late
  FROM v LEFT JOIN (SELECT id AS raw_id, detail FROM raw) d ON d.raw_id = v.id
  WHERE account_id IS NOT NULL AND created_at IS NOT NULL
    AND NOT (action = 'SOCKET_DISCONNECT' AND coalesce(detail::JSON ->> '$.ownedSlot', 'true') = 'false')
  WINDOW prior AS (PARTITION BY account_id ORDER BY created_at, id)),
numbered AS (
  SELECT *, count(*) FILTER (late) OVER (PARTITION BY account_id ORDER BY created_at, id) AS nth FROM signs),
connected AS (
  SELECT account_id, min(created_at) AS started_at, max(created_at) AS ended_at,
    date_diff('us', min(created_at), max(created_at)) / 1000000 AS length_sec, count(*) AS events,
    count(*) FILTER (action = 'SOCKET_CONNECT') AS connects,
    count(*) FILTER (action = 'SOCKET_DISCONNECT') AS disconnects,
    last(action ORDER BY created_at, id) = 'SOCKET_DISCONNECT' AS closed
  FROM numbered GROUP BY account_id, nth)"""

SQL["connection_session"] = f"""{_with(_CONNECTED)}
SELECT * REPLACE (CAST(started_at AS VARCHAR) AS started_at, CAST(ended_at AS VARCHAR) AS ended_at)
FROM connected"""

SQL["connection_daily"] = f"""{_with(_CONNECTED)}
SELECT CAST(CAST(started_at + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS d_kst, count(*) AS sessions,
  count(DISTINCT account_id) AS users, {_n("closed")} AS closed_sessions,
  round(sum(length_sec) / count(DISTINCT account_id), 6) AS mean_sec_per_user,
  round(quantile_cont(length_sec, 0.5), 6) AS length_median_sec,
  round(quantile_cont(length_sec, 0.9), 6) AS length_p90_sec
FROM connected GROUP BY d_kst"""


def _hmac(salt: str) -> str:
    """HMAC-SHA256 of the account id, written out."""
    key = salt.encode().ljust(64, b"\0")
    inner, outer = (
        "'" + "".join(f"\\x{b ^ pad:02X}" for b in key) + "'::BLOB" for pad in (0x36, 0x5C)
    )
    message = "CAST(CAST(account_id AS VARCHAR) AS BLOB)"
    return f"sha256({outer} || unhex(sha256({inner} || {message})))[1:32]"


_SALT = "a salt for the test tables"

SQL["shared_details"] = f"""{_ALL_DRILL}
SELECT metric, category, d, {_hmac(_SALT)} AS pseudonym, "count" FROM drill"""

SQL["shared_joined"] = f"""{_ALL_DRILL}
SELECT 'same' AS salt, count(*) AS links, count(DISTINCT account_id) AS accounts FROM drill
WHERE metric = 'dau' AND category = 'active' UNION ALL SELECT 'other', 0, 0"""

SQL["shared_leaks"] = f"""{_ALL_DRILL}
SELECT 'no pseudonym' AS rule, 'dau' AS metric, count(*) AS n FROM drill
WHERE metric = 'dau' AND account_id IS NOT NULL UNION ALL SELECT 'column account_id', NULL, 1"""


def _over_long(sql: str) -> str:
    """The same question over the rows dealt over more than 200 days."""
    moved = """v AS (
  SELECT * FROM (SELECT * REPLACE (created_at + to_days(CAST(id % 7 * 30 AS INTEGER)) AS created_at,
      kst + to_days(CAST(id % 7 * 30 AS INTEGER)) AS kst,
      CAST(kst + to_days(CAST(id % 7 * 30 AS INTEGER)) AS DATE) AS day) FROM short) moved
  WHERE dayofyear(day) % 11 <> 3)"""
    return sql.replace(_BASE, _BASE.replace("v AS (", "short AS (", 1) + ", " + moved, 1)


for _name in ("series_dau", "series_bait_rock", "series_catch_rate", "series_safari_session", "drill_counts"):
    SQL[f"{_name}_long"] = _over_long(SQL[_name])


for _name, _days, _past_days in (
    ("ticket_ledger", 30, 12), ("map_edges", 7, 7), ("funnel", 30, 10), ("shiny_screen", 30, 15), ("bot_screen", 30, 15),
):
    SQL[f"{_name}_past"] = SQL[_name].replace(_within(_days), _within(_past_days, "2024-01-20 00:00:00"))
