"""The SQL statement of each query's result, over the same tables."""

from __future__ import annotations

LOG = """
log AS (
  SELECT CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y-%m-%d') AS case_id,
         e.event_id AS seq, e.event_type AS activity, e.ts AS ts, e.value AS value, e.k AS k,
         CASE WHEN e.k % 5 = 0 THEN NULL ELSE 'r' || (e.k % 7) END AS resource,
         c.c_mktsegment AS segment
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
)"""


def over_log(body: str, *ctes: str) -> str:
    return "WITH " + ",".join((LOG, *ctes)) + "\n" + body


MINUTES = "(epoch_us({b}) - epoch_us({a})) / 60000000.0"


def minutes(a: str, b: str) -> str:
    return MINUTES.format(a=a, b=b)


BUCKET = "CASE WHEN value <= 20.0 THEN 'low' WHEN value <= 50.0 THEN 'medium' ELSE 'high' END"


def model_ctes(attributes: dict[str, str], source: str = "log") -> tuple[str, ...]:
    """Steps, states, numbered edges and transitions; ``attributes`` are expressions over the log ``source``."""
    own = ", ".join(f"{e} AS {n}" for n, e in attributes.items())
    names = ", ".join(attributes)
    lead = ", ".join(f"lead({n}) OVER w AS next_{n}" for n in attributes)
    start_next = ", ".join(f"{n} AS next_{n}" for n in attributes)
    event_next = ", ".join(f"CASE WHEN last THEN {n} ELSE next_{n} END" for n in attributes)
    no_next = ", ".join("NULL" for _ in attributes)
    match_here = " AND ".join(f"s.{n} IS NOT DISTINCT FROM t.{n}" for n in attributes)
    match_next = " AND ".join(f"s.{n} IS NOT DISTINCT FROM t.next_{n}" for n in attributes)
    return (
        f"""
attributed AS (
  SELECT *, row_number() OVER w AS nr, lead(activity) OVER w AS next_activity,
         lead(activity) OVER w IS NULL AS last
  FROM {source} WINDOW w AS (PARTITION BY case_id ORDER BY ts, seq)
),
events_at AS (SELECT * EXCLUDE (nr, next_activity, last), nr, next_activity, last, {own} FROM attributed),
following AS (SELECT *, {lead} FROM events_at WINDOW w AS (PARTITION BY case_id ORDER BY ts, seq)),
steps AS (
  SELECT case_id, ts, seq, value, k, segment, resource, CAST(0 AS BIGINT) AS step, 'start' AS last_action, {names},
         activity AS action, {start_next}
  FROM following WHERE nr = 1
  UNION ALL
  SELECT case_id, ts, seq, value, k, segment, resource, nr, activity, {names},
         coalesce(next_activity, 'archive_application'), {event_next} FROM following
  UNION ALL
  SELECT case_id, ts, seq, value, k, segment, resource, nr + 1, 'archive_application', {names}, NULL, {no_next}
  FROM following WHERE last
),
positioned AS (SELECT *, row_number() OVER (ORDER BY case_id, ts, seq, step) AS pos FROM steps),
states AS (
  SELECT last_action, {names}, count(*) AS visits, bool_or(step = 0) AS initial, min(pos) AS first_pos,
         row_number() OVER (ORDER BY min(pos)) - 1 AS state
  FROM positioned GROUP BY last_action, {names}
),
actions AS (
  SELECT last_action AS action, row_number() OVER (ORDER BY min(pos)) - 1 AS action_index
  FROM positioned GROUP BY last_action
),
moves AS (
  SELECT t.*, s.state AS state FROM positioned t
  JOIN states s ON s.last_action = t.last_action AND {match_here}
),
rows_with_next AS (
  SELECT t.*, coalesce(s.state, -1) AS next_state FROM moves t
  LEFT JOIN states s ON s.last_action = t.action AND {match_next}
),
numbered AS (
  SELECT state, action, next_state, count(*) AS n FROM rows_with_next GROUP BY ALL
),
transitions AS (
  SELECT n.state, a.action_index, n.action, n.next_state,
         n.n * 1.0 / sum(n.n) OVER (PARTITION BY n.state, n.action) AS probability
  FROM numbered n LEFT JOIN actions a ON a.action = n.action
  WHERE n.action IS NOT NULL
)""",
    )


BUCKET_MODEL = model_ctes({"bucket": BUCKET})
POSITION_MODEL = model_ctes({"event_nr": "nr", "k10": "k % 10"})


def over_bucket_model(body: str, *more: str) -> str:
    return over_log(body, *BUCKET_MODEL, *more)


def over_position_model(body: str, *more: str) -> str:
    return over_log(body, *POSITION_MODEL, *more)


def mapped(key: str, source: str = "states") -> str:
    """Mapping of states with equal ``key`` onto ids by the smallest member."""
    return f"""
keyed AS (SELECT state, {key} AS key FROM {source}),
classes AS (SELECT key, row_number() OVER (ORDER BY min(state)) - 1 AS abstract_state FROM keyed GROUP BY key),
mapping AS (SELECT k.state, c.abstract_state FROM keyed k JOIN classes c ON c.key IS NOT DISTINCT FROM k.key)"""


ABSTRACT_TRANSITIONS = """
SELECT state, action, next_state, round(n * 1.0 / sum(n) OVER (PARTITION BY state, action), 6) AS probability
FROM (
  SELECT a.abstract_state AS state, n.action, b.abstract_state AS next_state, sum(n.n) AS n
  FROM numbered n JOIN mapping a ON a.state = n.state JOIN mapping b ON b.state = n.next_state
  WHERE n.action IS NOT NULL GROUP BY ALL
)"""

DESCRIBED = """
described AS (
  SELECT state, any_value(last_action) AS last_action_name,
         mode(segment ORDER BY segment) AS segment, mode(resource ORDER BY resource) AS resource,
         avg(value) AS value, avg(k) AS k, bool_or(step = 0) AS initial
  FROM moves GROUP BY state
)"""


def three_bins(column: str, table: str) -> str:
    levels = "[0.33333333333333326, 0.6666666666666665]"
    edges = f"(SELECT quantile_cont({column}, {levels}) FROM {table})"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN {column} <= {edges}[1] THEN 'low' "
        f"WHEN {column} <= {edges}[2] THEN 'medium' ELSE 'high' END"
    )


FLAGGED = f"""
flagged AS (
  SELECT *, CAST(floor(k % 3) AS DOUBLE) AS tenfold, k > 49.5 AS "isBusy",
         CASE WHEN state % 3 = 0 THEN 'True' WHEN state % 3 = 1 THEN 'missing' ELSE 'False' END AS "Overspent"
  FROM described
),
encoded AS (
  SELECT state, last_action_name, resource, {three_bins("value", "flagged")} AS value, {three_bins("k", "flagged")} AS k,
         initial, tenfold, "isBusy", "Overspent"
  FROM flagged
),
fluents AS (
  SELECT 'resource-' || lower(resource) AS pvar, state FROM encoded WHERE resource IS NOT NULL
  UNION ALL SELECT 'value-' || value, state FROM encoded
  UNION ALL SELECT 'k-' || k, state FROM encoded
  UNION ALL SELECT 'tenfold-v-' || CAST(CAST(tenfold AS BIGINT) AS VARCHAR), state FROM encoded
  UNION ALL SELECT 'is-busy', state FROM encoded WHERE "isBusy"
  UNION ALL SELECT 'overspent', state FROM encoded WHERE "Overspent" = 'True'
),
fluent_names AS (
  SELECT DISTINCT pvar FROM fluents
  UNION SELECT 'is-busy' UNION SELECT 'overspent'
)"""


def sanitized(e: str) -> str:
    split = f"regexp_replace(trim({e}), '([a-z0-9])([A-Z])', '\\1-\\2', 'g')"
    dashed = f"lower(trim(regexp_replace({split}, '[^0-9a-zA-Z]+', '-', 'g'), '-'))"
    return (
        f"CASE WHEN {dashed} = '' THEN 'na' WHEN regexp_matches({dashed}, '^[a-z]') THEN {dashed} "
        f"ELSE 'v-' || {dashed} END"
    )


def label(e: str) -> str:
    return f"CASE WHEN {e} = floor({e}) THEN CAST(CAST({e} AS BIGINT) AS VARCHAR) ELSE printf('%g', {e}) END"


def policy_step(step: int) -> str:
    later = (
        "0.0" if step == 1 else f"coalesce((SELECT value FROM best{step - 1} b WHERE b.state = t.next_state), 0.0)"
    )
    return f"""
worth{step} AS (
  SELECT t.state, t.action, sum(t.probability * (
    CASE WHEN s.last_action = 'archive_application' THEN 10.0 ELSE 0.0 END + 0.9 * {later})) AS q
  FROM transitions t JOIN states s ON s.state = t.next_state GROUP BY t.state, t.action
),
best{step} AS (
  SELECT state, action, q AS value FROM (
    SELECT *, row_number() OVER (PARTITION BY state ORDER BY round(q, 9) DESC, action) AS place FROM worth{step}
  ) WHERE place = 1
)"""


CASE_WINDOW = "WINDOW w AS (PARTITION BY case_id ORDER BY ts, seq), g AS (PARTITION BY case_id)"
SLOT = "CAST(k AS VARCHAR) || '-' || CAST(hour(ts) AS VARCHAR)"
KNOWN = "'UNKNOWN', 'Unknown', 'unknown', 'MISSING', 'Missing', 'missing', 'NaN', 'nan'"

#: Categories, then numbers
GAP_COLUMNS = ("activity", "slot", "busy", "segment", "value", "k")
GAPS = (
    f"""
raw AS (
  SELECT CASE WHEN k % 17 = 0 THEN 'missing_caseid' ELSE case_id END AS case_id, seq, activity, ts,
         CASE WHEN k % 3 <> 0 THEN value END AS value, k, segment, CASE WHEN k % 5 <> 0 THEN k > 49 END AS busy, {SLOT} AS slot
  FROM log
)""",
    """
kept AS (SELECT * FROM raw WHERE case_id IN (SELECT case_id FROM raw WHERE activity IN ('purchase', 'signup')))""",
)


ORACLES: dict[str, str] = {
    "canonical_log": over_log(
        "SELECT case_id, seq, activity, epoch_us(ts) AS ts_us, value, k, resource, segment FROM log"
    ),
    "log_summary": over_log(
        "SELECT count(*) AS events, count(DISTINCT case_id) AS cases, CAST(8 AS BIGINT) AS columns FROM log"
    ),
    "activity_counts": over_log("SELECT activity, count(*) AS n FROM log GROUP BY activity"),
    "value_counts": over_log(
        """
SELECT 'activity' AS attribute, activity AS value, count(*) AS n FROM log WHERE activity IS NOT NULL GROUP BY activity
UNION ALL SELECT 'resource', resource, count(*) FROM log WHERE resource IS NOT NULL GROUP BY resource
UNION ALL SELECT 'segment', segment, count(*) FROM log WHERE segment IS NOT NULL GROUP BY segment"""
    ),
    "invalid_ts_filter": over_log(
        """
SELECT seq, CASE k % 3 WHEN 1 THEN epoch_us(ts - INTERVAL 2 HOUR) ELSE epoch_us(date_trunc('second', ts)) END AS ts_us
FROM log WHERE k % 10 <> 0"""
    ),
    "numeric_coerce": over_log("SELECT seq, CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS number FROM log"),
    "coerce_bool": over_log("SELECT seq, k % 8 < 5 AS from_text, k % 3 <> 0 AS from_number FROM log"),
    "sentinel_to_null": over_log(
        """
SELECT seq, nullif(activity, 'error') AS activity, nullif(resource, 'r3') AS resource,
       nullif(segment, 'BUILDING') AS segment FROM log"""
    ),
    "normalize_missing": over_log(
        f"""
SELECT seq, CASE WHEN label IN ({KNOWN}) THEN 'missing' ELSE label END AS label,
       CASE WHEN resource IN ({KNOWN}) THEN 'missing' ELSE resource END AS resource
FROM (SELECT seq, resource, CASE k % 6 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'unknown' WHEN 2 THEN 'Missing'
      WHEN 3 THEN 'nan' ELSE activity END AS label FROM log)"""
    ),
    "fill_missing": over_log(
        """
SELECT seq, coalesce(resource, 'missing') AS resource, CASE WHEN k % 3 <> 0 THEN value ELSE 0.0 END AS value FROM log"""
    ),
    "forward_fill": over_log(
        """
SELECT seq, last_value(resource IGNORE NULLS) OVER w AS resource,
       last_value(CASE WHEN k % 3 <> 0 THEN value END IGNORE NULLS) OVER w AS value,
       last_value(segment IGNORE NULLS) OVER w AS segment
FROM log WINDOW w AS (PARTITION BY case_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    ),
    "rare_to_other": over_log(
        f"""
SELECT seq, CASE WHEN count(*) OVER (PARTITION BY slot) >= 10 THEN slot ELSE 'other' END AS slot,
       CASE WHEN count(*) OVER (PARTITION BY resource) >= 10 THEN resource ELSE 'other' END AS resource
FROM (SELECT seq, {SLOT} AS slot, coalesce(resource, 'missing') AS resource FROM log)"""
    ),
    "preprocessed_log": over_log(
        f"""
SELECT f.case_id, f.seq, activity,
       CASE WHEN count(*) OVER (PARTITION BY slot) >= 10 THEN slot ELSE 'other' END AS slot,
       CASE WHEN count(*) OVER (PARTITION BY busy) >= 10 THEN busy ELSE 'other' END AS busy,
       CASE WHEN count(*) OVER (PARTITION BY segment) >= 10 THEN segment ELSE 'other' END AS segment,
       timesincelastevent, timesincecasestart, remaining_time_minutes, execution_time_minutes,
       round(value, 6) AS value, round(CAST(k AS DOUBLE), 6) AS k, event_nr,
       hour(ts) * 60 + minute(ts) AS timesincemidnight, month(ts) AS month, isodow(ts) - 1 AS weekday, hour(ts) AS hour, open_cases
FROM filled f JOIN opened o ON o.seq = f.seq""",
        *GAPS,
        f"""
filled AS (
  SELECT case_id, seq, activity, ts, slot, coalesce(segment, 'missing') AS segment, k,
         coalesce(last_value(value IGNORE NULLS) OVER r, 0.0) AS value,
         CASE last_value(busy IGNORE NULLS) OVER r WHEN true THEN 'True' WHEN false THEN 'False' ELSE 'missing' END AS busy,
         round(coalesce({minutes("lag(ts) OVER w", "ts")}, 0), 6) AS timesincelastevent,
         round({minutes("min(ts) OVER g", "ts")}, 6) AS timesincecasestart,
         round({minutes("ts", "max(ts) OVER g")}, 6) AS remaining_time_minutes,
         round({minutes("min(ts) OVER g", "max(ts) OVER g")}, 6) AS execution_time_minutes,
         row_number() OVER w AS event_nr
  FROM kept WINDOW w AS (PARTITION BY case_id ORDER BY ts, seq), g AS (PARTITION BY case_id),
       r AS (PARTITION BY case_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)""",
        """
opened AS (
  SELECT e.seq, count(c.case_id) AS open_cases
  FROM kept e LEFT JOIN (SELECT case_id, min(ts) AS a, max(ts) AS b FROM kept GROUP BY case_id) c ON c.a <= e.ts AND e.ts < c.b
  GROUP BY e.seq
)""",
    ),
    "cleaning_report": over_log(
        f"""
SELECT 'read' AS measure, CAST(NULL AS VARCHAR) AS attribute, count(*) AS n FROM raw
UNION ALL SELECT 'case ids repaired', 'case_id', count(*) FROM raw WHERE case_id = 'missing_caseid'
UNION ALL SELECT 'dropped, case not complete', NULL, (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept)
UNION ALL SELECT 'dropped, no timestamp', NULL, count(*) FROM kept WHERE ts IS NULL
{"".join(f"UNION ALL SELECT 'filled forward', '{c}', count(*) FROM carried WHERE {c} IS NULL AND {c}_last IS NOT NULL " for c in GAP_COLUMNS)}
{"".join(f"UNION ALL SELECT 'filled with a category', '{c}', count(*) FROM carried WHERE {c}_last IS NULL " for c in GAP_COLUMNS[:4])}
{"".join(f"UNION ALL SELECT 'filled with a number', '{c}', count(*) FROM carried WHERE {c}_last IS NULL " for c in GAP_COLUMNS[4:])}
{"".join(f"UNION ALL SELECT 'grouped as rare', '{c}', coalesce(CAST(sum(n) AS BIGINT), 0) FROM (SELECT count(*) AS n FROM carried GROUP BY coalesce(CAST({c}_last AS VARCHAR), 'missing') HAVING count(*) < 10) " for c in GAP_COLUMNS[1:4])}""",
        *GAPS,
        f"""
carried AS (
  SELECT *, {", ".join(f"last_value({c} IGNORE NULLS) OVER r AS {c}_last" for c in GAP_COLUMNS)}
  FROM kept WINDOW r AS (PARTITION BY case_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)""",
    ),
    "complete_cases": over_log(
        """
SELECT case_id, seq, activity FROM log
WHERE case_id IN (SELECT case_id FROM log WHERE activity IN ('purchase', 'signup'))"""
    ),
    "label_cases": over_log(
        """
SELECT case_id, seq, CASE WHEN bool_or(activity = 'purchase') OVER (PARTITION BY case_id)
       THEN 'deviant' ELSE 'regular' END AS label FROM log"""
    ),
    "cut_prefix": over_log(
        f"""
SELECT case_id, seq, activity, CASE WHEN cut IS NULL THEN 'regular' ELSE 'deviant' END AS label
FROM (SELECT *, min(CASE WHEN activity = 'purchase' THEN nr END) OVER (PARTITION BY case_id) AS cut
      FROM (SELECT *, row_number() OVER w AS nr FROM log {CASE_WINDOW}))
WHERE cut IS NULL OR nr < cut"""
    ),
    "cut_at_terminal": over_log(
        f"""
SELECT case_id, seq, activity
FROM (SELECT *, min(CASE WHEN activity IN ('purchase', 'error') THEN nr END) OVER (PARTITION BY case_id) AS cut
      FROM (SELECT *, row_number() OVER w AS nr FROM log {CASE_WINDOW}))
WHERE cut IS NULL OR nr <= cut"""
    ),
    "time_features": over_log(
        f"""
SELECT case_id, seq, round(coalesce({minutes("lag(ts) OVER w", "ts")}, 0), 6) AS timesincelastevent,
       round({minutes("min(ts) OVER g", "ts")}, 6) AS timesincecasestart,
       round({minutes("ts", "max(ts) OVER g")}, 6) AS remaining_time_minutes,
       row_number() OVER w AS event_nr
FROM log {CASE_WINDOW}"""
    ),
    "calendar_features": over_log(
        """
SELECT seq, hour(ts) * 60 + minute(ts) AS timesincemidnight, month(ts) AS month, isodow(ts) - 1 AS weekday,
       hour(ts) AS hour FROM log"""
    ),
    "case_duration": over_log(
        f"""
SELECT case_id, epoch_us(min(ts)) AS start_time_us, epoch_us(max(ts)) AS end_time_us,
       round({minutes("min(ts)", "max(ts)")}, 6) AS execution_time_minutes FROM log GROUP BY case_id"""
    ),
    "event_case_duration": over_log(
        f"""
SELECT case_id, seq, round({minutes("min(ts) OVER g", "max(ts) OVER g")}, 6) AS execution_time_minutes
FROM log {CASE_WINDOW}"""
    ),
    "open_cases": over_log(
        """
SELECT e.seq, count(c.case_id) AS open_cases
FROM log e LEFT JOIN (SELECT case_id, min(ts) AS a, max(ts) AS b FROM log GROUP BY case_id) c
  ON c.a <= e.ts AND e.ts < c.b
GROUP BY e.seq"""
    ),
    "fixed_bins_both_sides": over_log(
        """
SELECT seq, CASE WHEN round(value) <= 20 THEN 'low' WHEN round(value) <= 50 THEN 'medium' ELSE 'high' END AS right_closed,
       CASE WHEN round(value) < 50 THEN 'low' ELSE 'high' END AS left_closed FROM log"""
    ),
    "standardize": over_log(
        """
SELECT seq, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS value,
       round((k - avg(k) OVER ()) / stddev_pop(k) OVER (), 6) AS k FROM log"""
    ),
    "one_hot": over_log(
        "SELECT seq, "
        + ", ".join(
            f"CAST(coalesce({c} = '{v}', false) AS DOUBLE) AS {c}_{v}"
            for c, vs in {
                "activity": ("click", "error", "purchase", "signup", "view"),
                "resource": ("r0", "r1", "r2", "r3", "r4", "r5", "r6"),
            }.items()
            for v in vs
        )
        + " FROM log"
    ),
    "sparse_one_hot": over_log(
        f"""
SELECT * FROM (
  SELECT seq, 'slot' AS attribute, {SLOT} AS value FROM log
  UNION ALL SELECT seq, 'activity', activity FROM log
  UNION ALL SELECT seq, 'resource', resource FROM log) WHERE value IS NOT NULL"""
    ),
    "from_one_hot": over_log("SELECT seq, activity FROM log"),
    "standardize_inverse": over_log("SELECT seq, round(value, 6) AS value, round(CAST(k AS DOUBLE), 6) AS k FROM log"),
    "label_encode": over_log(
        f"SELECT seq, slot, dense_rank() OVER (ORDER BY slot) - 1 AS code FROM (SELECT seq, {SLOT} AS slot FROM log)"
    ),
    "discretize_states": over_log(
        f"""
SELECT activity, CAST(k AS VARCHAR) AS k, {three_bins("mean_value", "grouped")} AS mean_value,
       {three_bins("n_events", "grouped")} AS n_events, nullif(resource, 'NIL') AS resource
FROM grouped""",
        """
grouped AS (
  SELECT activity, k, round(avg(value), 6) AS mean_value, count(*) AS n_events, max(coalesce(resource, 'NIL')) AS resource
  FROM log GROUP BY activity, k
)""",
    ),
    "discretize_fallback": over_log(
        """
SELECT seq, CAST(k % 2 AS VARCHAR) AS two_values,
       CAST(CASE WHEN k % 10 = 0 THEN k ELSE 1 END AS VARCHAR) AS mostly_one,
       CASE WHEN k <= e[1] THEN 'a' WHEN k <= e[2] THEN 'b' WHEN k <= e[3] THEN 'c' ELSE 'd' END AS bin
FROM log, (SELECT quantile_cont(k, [0.25, 0.5, 0.75]) AS e FROM log)"""
    ),
    "quantile_edges": over_log(
        " UNION ALL ".join(
            f"""
SELECT '{c}' AS attribute, count(DISTINCT {c}) AS distinct_values, round(CAST(min({c}) AS DOUBLE), 6) AS q0,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q2,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.9), 6) AS q3, round(CAST(max({c}) AS DOUBLE), 6) AS q4 FROM log"""
            for c in ("value", "k")
        )
    ),
    "mdp_events": over_bucket_model(
        "SELECT case_id, seq, step, last_action, bucket, action, next_bucket FROM steps"
    ),
    "action_index": over_bucket_model("SELECT action_index, action FROM actions"),
    "state_index": over_position_model("SELECT state, last_action, event_nr, k10, visits, initial FROM states"),
    "next_state": over_bucket_model(
        """
SELECT case_id, seq, step, state,
       coalesce(lead(state) OVER (PARTITION BY case_id ORDER BY ts, seq, step), -1) AS next_state FROM moves"""
    ),
    "transitions": over_bucket_model(
        "SELECT state, action_index, action, next_state, round(probability, 6) AS probability FROM transitions"
    ),
    "transitions_unabstracted": over_position_model(
        "SELECT state, action_index, action, next_state, round(probability, 6) AS probability FROM transitions"
    ),
    "initial_states": over_bucket_model("SELECT state FROM states WHERE initial"),
    "valid_actions": over_position_model(
        """
SELECT s.state, coalesce(t.actions, '') AS actions FROM states s LEFT JOIN (
  SELECT state, string_agg(action, ',' ORDER BY action) AS actions
  FROM (SELECT DISTINCT state, action FROM transitions) GROUP BY state) t ON t.state = s.state"""
    ),
    "states_of_action": over_position_model("SELECT DISTINCT action, state FROM transitions"),
    "simplicity": over_position_model(
        """
SELECT 'nodes' AS measure, count(*) AS n FROM states
UNION ALL SELECT 'edges', count(*) FROM (SELECT DISTINCT state, action, next_state FROM transitions)"""
    ),
    "states_per_event": over_position_model(
        """
SELECT s.n AS states, e.n AS events, round(s.n * 1.0 / e.n, 6) AS ratio
FROM (SELECT count(*) AS n FROM states) s, (SELECT count(*) AS n FROM log) e"""
    ),
    "describe_states": over_bucket_model(
        """
SELECT state, last_action_name, segment, resource, round(value, 6) AS value, round(k, 6) AS k, initial FROM described""",
        DESCRIBED,
    ),
    "abs_contextual": over_position_model(ABSTRACT_TRANSITIONS, mapped("last_action")),
    "abs_bucket": over_position_model(ABSTRACT_TRANSITIONS, mapped("last_action || '/' || (k10 < 5)")),
    "abs_structural": over_position_model(
        "SELECT state, abstract_state FROM mapping",
        mapped("string_agg(coalesce(action, '?') || ';' || next_state, ',' ORDER BY action, next_state)", "numbered GROUP BY state"),
    ),
    "abs_action_set": over_position_model(
        "SELECT state, abstract_state FROM mapping",
        """
sets AS (SELECT s.state, coalesce(string_agg(DISTINCT t.action, ',' ORDER BY t.action), '') AS actions
         FROM states s LEFT JOIN transitions t ON t.state = s.state GROUP BY s.state)""",
        mapped("actions", "sets"),
    ),
    "abs_action_count": over_position_model(
        "SELECT state, abstract_state FROM mapping",
        """
entries AS (SELECT DISTINCT state, action FROM transitions),
vectors AS (SELECT s.state, list((SELECT count(*) FROM entries e WHERE e.state = s.state AND e.action = a.action)
            ORDER BY a.action_index) AS counts FROM states s, actions a GROUP BY s.state)""",
        mapped("counts", "vectors"),
    ),
    "many_valued_columns": over_log(
        " UNION ALL ".join(
            f"SELECT '{n}' AS attribute, count(DISTINCT {e}) > 100 AS many FROM log"
            for n, e in {"value": "value", "k": "k", "slot": SLOT, "minute": "minute(ts)", "activity": "activity", "resource": "resource"}.items()
        )
    ),
    "kmeans_states": over_log(
        "SELECT state, abstract_state, last_action, visits FROM mapping JOIN states USING (state)",
        *model_ctes({"level": "1000.0 * (k % 3) + k % 2"}),
        mapped("last_action || '/' || CAST(floor(level / 1000) AS INTEGER)"),
    ),
    "abstraction_map": over_position_model(
        "SELECT state, abstract_state FROM mapping", mapped("last_action || '/' || (k10 < 5) || '/' || event_nr")
    ),
    "classify_columns": """
SELECT * FROM (VALUES
  (CAST(0 AS BIGINT), 'resource', 'cat', 'resource'), (1, 'value', 'cat', 'value'), (2, 'k', 'cat', 'k'),
  (3, 'tenfold', 'cat', 'tenfold'), (4, 'isBusy', 'tri', 'is-busy'), (5, 'Overspent', 'tri', 'overspent')
) AS t(position, attribute, kind, pvar)""",
    "bool_fluents": over_bucket_model("SELECT pvar, state FROM fluents", DESCRIBED, FLAGGED),
    "fluent_support": over_bucket_model(
        """
SELECT n.pvar, count(f.state) AS n_true,
       CASE WHEN count(f.state) = 0 THEN false WHEN count(f.state) = (SELECT count(*) FROM states) THEN true END AS constant
FROM fluent_names n LEFT JOIN fluents f ON f.pvar = n.pvar GROUP BY n.pvar""",
        DESCRIBED,
        FLAGGED,
    ),
    "fluent_support_sets": over_bucket_model(
        """
SELECT pvar, state // 32768 AS bucket, count(*) AS n_true, string_agg(CAST(state AS VARCHAR), ',' ORDER BY state) AS states
FROM fluents GROUP BY pvar, state // 32768""",
        DESCRIBED,
        FLAGGED,
    ),
    "action_fluents": over_bucket_model(
        "SELECT action, pvar, count(DISTINCT t.state) AS n FROM transitions t JOIN fluents f ON f.state = t.state GROUP BY action, pvar",
        DESCRIBED,
        FLAGGED,
    ),
    "initial_fluents": over_bucket_model(
        """
SELECT pvar, pvar IN (SELECT pvar FROM fluents WHERE state = (SELECT min(state) FROM states WHERE initial)) AS value
FROM fluent_names""",
        DESCRIBED,
        FLAGGED,
    ),
    "sanitize_names": "SELECT p_partkey, "
    + ", ".join(
        f"{sanitized(e)} AS {n}"
        for n, e in {
            "plain": "(p_name || ' / ' || p_brand || ' / ?')",
            "camel": "(split_part(p_name, ' ', -1) || p_brand)",
            "digits": "(CAST(p_size AS VARCHAR) || ' ' || p_type)",
        }.items()
    )
    + " FROM part",
    "category_labels": over_log(
        "SELECT seq, "
        + ", ".join(
            f"{label(e)} AS {n}"
            for n, e in {
                "plain": "value",
                "whole": "round(value)",
                "small": "(value / 1e6)",
                "large": "(value * 12345.0 + 0.5)",
            }.items()
        )
        + " FROM log"
    ),
    "uniquify": over_log(
        """
SELECT seq, case_id, CASE WHEN n = 1 THEN case_id ELSE case_id || '_' || n END AS unique_name
FROM (SELECT seq, case_id, row_number() OVER (PARTITION BY case_id ORDER BY seq) AS n FROM log)"""
    ),
    "action_names": over_bucket_model(
        f"SELECT DISTINCT action, 'action-' || {sanitized('action')} AS fluent FROM transitions"
    ),
    "stick_breaking": over_position_model(
        """
SELECT source, action, target, position, previous_target, round(before, 6) AS mass_before,
       round(CASE WHEN is_last THEN 1.0 ELSE least(greatest(probability / greatest(1.0 - before, 1e-9), 0.0), 1.0) END, 6) AS cond_p,
       is_last
FROM (
  SELECT state AS source, action, next_state AS target, probability, row_number() OVER w AS position,
         lag(next_state) OVER w AS previous_target,
         coalesce(sum(probability) OVER (PARTITION BY state, action ORDER BY next_state
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
         lead(next_state) OVER w IS NULL AS is_last
  FROM transitions WINDOW w AS (PARTITION BY state, action ORDER BY next_state)
)"""
    ),
    "modal_outcome": over_position_model(
        """
SELECT state AS source, action, next_state AS target, round(probability, 6) AS probability
FROM (SELECT *, row_number() OVER (PARTITION BY state, action ORDER BY probability DESC, next_state) AS place FROM transitions)
WHERE place = 1"""
    ),
    "terminal_states": over_bucket_model("SELECT state FROM states WHERE last_action = 'archive_application'"),
    "rewards": over_bucket_model(
        "SELECT state, CASE WHEN last_action = 'archive_application' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM states"
    ),
    "initial_candidates": over_bucket_model("SELECT state FROM states WHERE initial"),
    "id_check": over_position_model(
        """
SELECT count(*) AS n, min(state) AS smallest, max(state) AS largest, count(DISTINCT state) AS distinct_ids,
       min(state) = 0 AND max(state) = count(*) - 1 AND count(DISTINCT state) = count(*) AS contiguous FROM states"""
    ),
    "policy_h3": over_bucket_model(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS step, state, action, round(value, 6) AS value FROM best{i}" for i in (1, 2, 3)
        ),
        *[policy_step(i) for i in (1, 2, 3)],
    ),
    "policy_converged": over_bucket_model(
        """
SELECT state, action, round(q, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY round(q, 7) DESC, action) AS place FROM choices
) WHERE place = 1""",
        """
gains AS (SELECT state, CASE WHEN last_action = 'archive_application' THEN 10.0 ELSE 1.0 END AS reward FROM states),
rewarded AS (
  SELECT t.state, t.action, t.next_state, CAST(t.probability AS DOUBLE) AS p, CAST(g.reward AS DOUBLE) AS reward
  FROM transitions t JOIN gains g ON g.state = t.next_state
),
-- value iteration; doing nothing leads to a dead state with a reward of 1 at each step
iterated AS (
  SELECT 0 AS step, state, CAST(0 AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS dead FROM states
  UNION ALL
  SELECT i.step + 1, i.state, greatest(coalesce(max(a.q), 0.0), 1.0 + 0.3 * i.dead), 1.0 + 0.3 * i.dead
  FROM iterated i LEFT JOIN (
    SELECT r.state, r.action, sum(r.p * (r.reward + 0.3 * v.value)) AS q FROM rewarded r JOIN iterated v ON v.state = r.next_state
    GROUP BY r.state, r.action
  ) a ON a.state = i.state
  WHERE i.step < 40 GROUP BY i.step, i.state, i.dead
),
limits AS (SELECT state, value, dead FROM iterated WHERE step = 40),
choices AS (
  SELECT r.state, r.action, sum(r.p * (r.reward + 0.3 * v.value)) AS q FROM rewarded r JOIN limits v ON v.state = r.next_state
  GROUP BY r.state, r.action
  UNION ALL SELECT state, 'noop', 1.0 + 0.3 * dead FROM limits
)""",
    ).replace("WITH", "WITH RECURSIVE", 1),
    "terminal_model": over_log(
        """
SELECT a.abstract_state AS state, any_value(i.action_index) AS action_index, n.action, b.abstract_state AS next_state,
  CAST(sum(n.n) AS BIGINT) AS n,
  round(sum(n.n) * 1.0 / sum(sum(n.n)) OVER (PARTITION BY a.abstract_state, n.action), 6) AS probability
FROM numbered n JOIN mapping a ON a.state = n.state JOIN mapping b ON b.state = n.next_state LEFT JOIN actions i ON i.action = n.action
WHERE n.action IS NOT NULL GROUP BY a.abstract_state, n.action, b.abstract_state""",
        f"""
cut_log AS (
  SELECT * EXCLUDE (nr, cut)
  FROM (SELECT *, min(CASE WHEN activity IN ('purchase', 'error') THEN nr END) OVER (PARTITION BY case_id) AS cut
        FROM (SELECT *, row_number() OVER w AS nr FROM log {CASE_WINDOW}))
  WHERE cut IS NULL OR nr <= cut
)""",
        *model_ctes({"bucket": BUCKET}, "cut_log"),
        mapped("last_action"),
    ),
    "infer_timestamps": over_log(
        """
SELECT seq, CASE WHEN seq % 97 = 0 THEN NULL WHEN seq % 5 = 0 THEN epoch_us(date_trunc('second', ts)) WHEN seq % 5 = 1 THEN epoch_us(date_trunc('minute', ts))
  WHEN seq % 5 = 2 THEN epoch_us(date_trunc('second', ts)) WHEN seq % 5 = 3 THEN epoch_us(ts) ELSE epoch_us(date_trunc('day', ts)) END AS ts_us
FROM log"""
    ),
}
