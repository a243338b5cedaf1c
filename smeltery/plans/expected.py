"""What each query must return, as SQL over the plain tables.

Written from the meaning of the operators, with comparison joins, correlated subqueries and
whole-series windows, so that it shares no formulation with the Spark side.
"""

from __future__ import annotations

from smeltery.plans.catalogue import EVENTS_DIM, HOUR_FRAMES, HOURS, LIMITS, MINUTE_FRAMES, SENSORS


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


EVENTS = f"""ev AS (
    SELECT id, impact, zones, cats, CAST(a AS DATE) AS a, CAST(b AS DATE) AS b
    FROM (VALUES {_values(EVENTS_DIM)}) AS v(id, impact, zones, cats, a, b))"""

LIMIT_TABLE = f"""limits AS (
    SELECT * FROM (VALUES {_values(LIMITS)}) AS v(machine_type, temp_critical, vibration_critical))"""

SALES = """sales AS (
    SELECT l_orderkey AS transaction_id, l_linenumber AS line, p_brand AS drug_id, p_type AS drug_category,
           n_name AS region_id, r_name AS zone, c_mktsegment AS channel,
           CAST(l_shipdate AS DATE) AS transaction_date, CAST(l_quantity AS INT) AS quantity_sold,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(round(l_discount * 100) AS INT) AS returns
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

READINGS = """r AS (
    SELECT event_id AS reading_id, user_id AS machine_id, ts, value AS temperature,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS vibration, event_type,
           CAST(floor(epoch(ts)) AS BIGINT) AS s
    FROM events)"""

SEASON = """CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
         WHEN month IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END"""

MONTH_FLAGS = """CAST(month IN (11, 12, 1, 2) AS INT) AS is_flu_season, CAST(month IN (6, 7, 8, 9) AS INT) AS is_monsoon,
    CAST(month IN (10, 11) AS INT) AS is_festival_season, CAST(month IN (4, 5, 6) AS INT) AS is_summer"""

SHIFT = """hour(ts) AS hour, dayofweek(ts) + 1 AS day_of_week,
    CASE WHEN hour(ts) >= 22 OR hour(ts) <= 6 THEN 1 ELSE 0 END AS is_night_shift"""

RISK = """round(value / 500, 4) AS failure_probability,
    CASE WHEN value / 500 >= 0.75 THEN 'CRITICAL' WHEN value / 500 >= 0.5 THEN 'HIGH'
         WHEN value / 500 >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level"""

# The newest reading of every machine.
FLEET = f"""newest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    x AS (SELECT c_mktsegment AS machine_type, c_nationkey AS location, {RISK} FROM newest LEFT JOIN customer ON user_id = c_custkey)"""

_KPIS = """SELECT count(*) AS total_machines,
            count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical, count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk,
            round(avg(failure_probability), 6) AS avg_failure_probability FROM x"""

# Training rows by md5 buckets up to a cut per class.
_SPLIT = """x AS (SELECT event_id, user_id, value > 250 AS hot, CAST(event_type = 'error' AS INT) AS failed,
            CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT) % 10000 AS b FROM events),
        c AS (SELECT failed, b, count(*) AS n FROM x GROUP BY ALL),
        u AS (SELECT *, sum(n) OVER (PARTITION BY failed ORDER BY b) AS upto, sum(n) OVER (PARTITION BY failed) AS total FROM c),
        k AS (SELECT failed, max(b) FILTER (upto <= round(total * 0.8)) AS cut FROM u GROUP BY failed)"""

# A leaf is the weighted mean of the label as 1 or -1 among the training rows; the score its logistic, doubled.
_STUMP = f"""WITH {_SPLIT},
        w AS (SELECT count(*) FILTER (failed = 0) / CAST(count(*) FILTER (failed = 1) AS DOUBLE) AS w FROM x),
        leaf AS (SELECT hot, sum(CASE failed WHEN 1 THEN w ELSE -1 END) / sum(CASE failed WHEN 1 THEN w ELSE 1 END) AS m
            FROM x JOIN k USING (failed), w WHERE b <= cut GROUP BY hot),
        s AS (SELECT event_id AS reading_id, user_id AS machine_id, 500 / (1 + exp(-2 * m)) AS value FROM x JOIN leaf USING (hot))
        SELECT reading_id, machine_id, {RISK}, CASE WHEN value / 500 >= 0.75 THEN 'Immediate shutdown and inspection required!'
            WHEN value / 500 >= 0.5 THEN 'Schedule maintenance within 2 hours.'
            WHEN value / 500 >= 0.25 THEN 'Monitor closely and plan maintenance soon.'
            ELSE 'Machine operating normally.' END AS recommendation FROM s"""

_GROWTH = """CASE WHEN lag_1m IS NOT NULL AND lag_1m <> 0
         THEN (total_units_sold - lag_1m) / CAST(lag_1m AS DOUBLE) ELSE 0.0 END AS mom_growth_rate"""


def _frames(frames) -> str:
    functions = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    return ", ".join(
        f"round({functions[stat]}({s}) OVER f{suffix}, 6) AS {s}_{stat}_{suffix}"
        for suffix, (_, stats) in frames.items()
        for s in SENSORS
        for stat in stats
    )


def _window_clause(frames) -> str:
    return ", ".join(
        f"f{suffix} AS (PARTITION BY machine_id ORDER BY s RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
        for suffix, seconds in frames.items()
    )


def _lags(then_change: bool = True) -> str:
    parts = [f"lag({s}, {n}) OVER w AS {s}_lag{n}" for s in SENSORS for n in (1, 5, 10)]
    for s in SENSORS:
        base = f"lag({s}, 1) OVER w"
        parts.append(f"CASE WHEN {base} IS NOT NULL AND {base} <> 0 THEN ({s} - {base}) / {base} ELSE 0.0 END AS {s}_roc")
    return ", ".join(parts)


_ROW_ORDER = "w AS (PARTITION BY machine_id ORDER BY s, ts, reading_id)"
_LENGTHS = {"5m": 300, "15m": 900, "30m": 1800}

_FLAGS = f"""WITH {READINGS}, {LIMIT_TABLE}, m AS (
        SELECT c_custkey AS machine_id, machine_type, temp_critical, vibration_critical
        FROM customer JOIN limits ON c_mktsegment = machine_type WHERE machine_type <> 'BUILDING'),
    j AS (SELECT reading_id, r.machine_id, coalesce(temperature > temp_critical, false) AS temp_anomaly,
            coalesce(vibration > vibration_critical, false) AS vibration_anomaly, event_type,
            machine_type IS NULL AS master_missing
        FROM r LEFT JOIN m ON r.machine_id = m.machine_id)
    SELECT reading_id, machine_id, temp_anomaly, vibration_anomaly,
        temp_anomaly OR vibration_anomaly AS sensor_out_of_range,
        temp_anomaly OR vibration_anomaly OR event_type = 'error' AS is_anomaly, master_missing FROM j"""

_LAG_ONLY = f"""WITH {READINGS}
    SELECT reading_id, machine_id, temperature, vibration,
        {", ".join(f"lag({s}, {n}) OVER w AS {s}_lag{n}" for s in SENSORS for n in (1, 5, 10))}
    FROM r WINDOW {_ROW_ORDER}"""


def _windows_sql(length: int, step: int) -> str:
    return f"""WITH {READINGS}, spans AS (
        SELECT *, unnest(generate_series(s - (s % {step}) - {length - step}, s - (s % {step}), {step})) AS window_start FROM r)
    SELECT CAST(window_start AS BIGINT) AS window_start, CAST(window_start + {length} AS BIGINT) AS window_end, machine_id, count(*) AS readings,
        round(avg(temperature), 6) AS temperature_mean, min(temperature) AS temperature_min, max(temperature) AS temperature_max,
        round(avg(vibration), 6) AS vibration_mean, min(vibration) AS vibration_min, max(vibration) AS vibration_max
    FROM spans GROUP BY window_start, machine_id
    HAVING window_start + {length} <= (SELECT max(epoch(ts)) FROM r) - 600"""


def _trend(minutes: int, step: int) -> str:
    return f"""WITH {READINGS}, recent AS (
        SELECT r.* FROM r JOIN (SELECT machine_id, max(ts) AS last FROM r GROUP BY 1) e ON r.machine_id = e.machine_id
        WHERE ts > last - INTERVAL {minutes} MINUTE)
    SELECT machine_id, s - s % {step} AS step_start, round(avg(temperature), 6) AS temperature,
        round(avg(vibration), 6) AS vibration FROM recent GROUP BY 1, 2"""


# Orders with a NULL, an empty and some awkward texts.
_ORDERS = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN 'b:c'
        WHEN '5-LOW' THEN 'd/e=%f {g}' ELSE o_orderpriority END AS region,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INT) END AS year FROM orders"""

# Monthly units per series, each month with the months one to three ahead.
_AHEAD = f"""{SALES}, m AS (
        SELECT drug_id, region_id, year(transaction_date) AS year, month(transaction_date) AS month,
            year(transaction_date) * 12 + month(transaction_date) AS n, CAST(sum(quantity_sold) AS BIGINT) AS units
        FROM sales GROUP BY ALL),
    ahead AS (
        SELECT m.drug_id, m.region_id, m.year, m.month, m.n, horizon, t.units AS target, s.units AS seasonal,
            coalesce(s.units, m.units) AS naive
        FROM m CROSS JOIN (VALUES (1), (2), (3)) AS h(horizon)
        LEFT JOIN m AS t ON t.drug_id = m.drug_id AND t.region_id = m.region_id AND t.n = m.n + horizon
        LEFT JOIN m AS s ON s.drug_id = m.drug_id AND s.region_id = m.region_id AND s.n = m.n + horizon - 12)"""

# One round of depth 2: the best split of a node by gain of gradients and curvatures, penalty 1.
_FEATURES = ("hour", "day_of_week", "is_night_shift")


def _boosted_split(node: int) -> str:
    cells = " UNION ALL ".join(f"SELECT {i} AS f, {name} AS v, g, h FROM n{node}" for i, name in enumerate(_FEATURES))
    return f"""b{node} AS (SELECT f, v, sum(g) AS g, sum(h) AS h FROM ({cells}) GROUP BY f, v),
        c{node} AS (SELECT f, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY f) AS gt,
                sum(h) OVER (PARTITION BY f) AS ht FROM b{node} WINDOW w AS (PARTITION BY f ORDER BY v)),
        s{node} AS (SELECT f, v, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain
            FROM c{node} WHERE hl >= 1 AND ht - hl >= 1 AND gain > 0 ORDER BY gain DESC, f, v LIMIT 1)"""


def _boosted_side(node: int) -> str:
    above, side = (node - 1) // 2, "<=" if node % 2 else ">"
    value = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(_FEATURES))
    return f"n{node} AS (SELECT n{above}.* FROM n{above}, s{above} WHERE CASE s{above}.f {value} END {side} s{above}.v)"


_BOOSTED = f"""WITH n0 AS (
        SELECT {SHIFT}, CAST(0.5 AS DOUBLE) - CAST(event_type = 'error' AS INT) AS g, CAST(0.25 AS DOUBLE) AS h FROM events),
    {", ".join([_boosted_split(0)] + [f"{_boosted_side(n)}, {_boosted_split(n)}" for n in (1, 2)] + [_boosted_side(n) for n in (3, 4, 5, 6)])},
    names AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{name}')" for i, name in enumerate(_FEATURES))}) AS t(f, feature))"""

SQL: dict[str, str] = {
    "boosting_first_tree": _BOOSTED + " UNION ALL ".join(
        f""" SELECT CAST({node} AS INT) AS node, feature, CAST(v AS DOUBLE) AS cut, round(coalesce(gain, 0), 6) AS gain, round(value, 6) AS value
        FROM (SELECT -sum(g) / (sum(h) + 1) AS value, count(*) AS rows FROM n{node})
        LEFT JOIN ({f"SELECT * FROM s{node} JOIN names USING (f)" if node < 3
                   else "SELECT NULL AS feature, NULL AS v, NULL AS gain WHERE false"}) ON true WHERE rows > 0"""
        for node in range(7)
    ),
    "boosting_importance": _BOOSTED + """ SELECT feature, round(coalesce(sum(gain), 0), 6) AS gain
        FROM names LEFT JOIN (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2) USING (f) GROUP BY feature""",
    "stream_windows_late": f"""WITH {READINGS}, w AS (
            SELECT *, s - s % 21600 AS window_start, reading_id % 2 = 1
                AND to_timestamp(s - s % 21600 + 21600 + 600) <= (SELECT max(ts) FROM r WHERE reading_id % 2 = 0) AS late FROM r)
        SELECT window_start, machine_id, count(*) FILTER (NOT late) AS readings, count(*) FILTER (late) AS late,
            round(avg(temperature) FILTER (NOT late), 6) AS temperature_mean, min(temperature) FILTER (NOT late) AS temperature_min,
            max(temperature) FILTER (NOT late) AS temperature_max, round(avg(vibration) FILTER (NOT late), 6) AS vibration_mean,
            min(vibration) FILTER (NOT late) AS vibration_min, max(vibration) FILTER (NOT late) AS vibration_max
        FROM w GROUP BY window_start, machine_id""",
    "forecast_targets": f"""WITH {_AHEAD}
        SELECT drug_id, region_id, year, month, CAST(horizon AS INT) AS horizon,
            CAST(year(make_date(year, month, 1) + to_months(horizon)) AS INT) AS target_year,
            CAST(month(make_date(year, month, 1) + to_months(horizon)) AS INT) AS target_month, target, seasonal, naive FROM ahead""",
    "forecast_naive_errors": f"""WITH {_AHEAD}
        SELECT CAST(horizon AS INT) AS horizon, count(*) AS forecasts, round(avg(abs(naive - target)), 6) AS naive_mae,
            round(sqrt(avg((naive - target) * (naive - target))), 6) AS naive_rmse,
            round(CAST(sum(abs(naive - target)) AS DOUBLE) / CAST(sum(target) AS DOUBLE), 6) AS naive_wape
        FROM ahead WHERE target IS NOT NULL AND n BETWEEN (SELECT max(n) FROM m) - 5 AND (SELECT max(n) FROM m) - 3
        GROUP BY horizon""",
    "batch_replay": _ORDERS,
    "batch_compaction": _ORDERS,
    "monthly_demand_features": f"""WITH {EVENTS}, {SALES}, flagged AS (
            SELECT *, EXISTS (SELECT 1 FROM ev WHERE transaction_date BETWEEN a AND b) AS on_event FROM sales),
        m AS (SELECT drug_id, region_id, max(zone) AS zone, year(transaction_date) AS year, month(transaction_date) AS month,
                CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold, CAST(sum(price) AS DOUBLE) AS total_revenue,
                CAST(sum(returns) AS BIGINT) AS total_returns,
                round(CAST(sum(price) AS DOUBLE) / count(price), 6) AS avg_unit_price, count(transaction_id) AS num_transactions,
                CAST(sum(CASE WHEN channel = 'BUILDING' THEN quantity_sold ELSE 0 END) AS BIGINT) AS building_qty,
                CAST(sum(CASE WHEN channel = 'MACHINERY' THEN quantity_sold ELSE 0 END) AS BIGINT) AS machinery_qty,
                CAST(sum(CASE WHEN channel = 'HOUSEHOLD' THEN quantity_sold ELSE 0 END) AS BIGINT) AS household_qty,
                CAST(sum(CASE WHEN on_event THEN quantity_sold ELSE 0 END) AS BIGINT) AS event_day_qty,
                count(*) FILTER (WHERE on_event) AS event_day_count
            FROM flagged GROUP BY drug_id, region_id, year(transaction_date), month(transaction_date)),
        h AS (SELECT *, lag(total_units_sold, 1) OVER w AS lag_1m, lag(total_units_sold, 3) OVER w AS lag_3m,
                lag(total_units_sold, 6) OVER w AS lag_6m, lag(total_units_sold, 12) OVER w AS lag_12m,
                round(avg(total_units_sold) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_3m,
                round(avg(total_units_sold) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_6m
            FROM m WINDOW w AS (PARTITION BY drug_id, region_id ORDER BY year, month))
        SELECT *, {_GROWTH}, quarter(make_date(year, month, 1)) AS quarter, {SEASON} AS season, {MONTH_FLAGS} FROM h""",
    "monthly_calendar_lag": f"""WITH {SALES}, m AS (
            SELECT drug_id, region_id, year(transaction_date) AS year, month(transaction_date) AS month,
                CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold
            FROM sales GROUP BY ALL),
        i AS (SELECT *, year * 12 + month AS n FROM m),
        h AS (SELECT i.drug_id, i.region_id, i.year, i.month, i.total_units_sold,
                a.total_units_sold AS lag_1m, b.total_units_sold AS lag_3m, c.total_units_sold AS lag_6m, e.total_units_sold AS lag_12m,
                round((SELECT avg(x.total_units_sold) FROM i x WHERE x.drug_id = i.drug_id AND x.region_id = i.region_id
                    AND x.n BETWEEN i.n - 2 AND i.n), 6) AS rolling_avg_3m,
                round((SELECT avg(x.total_units_sold) FROM i x WHERE x.drug_id = i.drug_id AND x.region_id = i.region_id
                    AND x.n BETWEEN i.n - 5 AND i.n), 6) AS rolling_avg_6m
            FROM i {" ".join(f"LEFT JOIN i {t} ON i.drug_id = {t}.drug_id AND i.region_id = {t}.region_id AND {t}.n = i.n - {k}"
                             for t, k in (("a", 1), ("b", 3), ("c", 6), ("e", 12)))})
        SELECT *, {_GROWTH} FROM h""",
    "channel_breakdown": f"""WITH {SALES} SELECT drug_id, CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold,
            CAST(coalesce(sum(quantity_sold) FILTER (WHERE channel = 'BUILDING'), 0) AS BIGINT) AS building_qty,
            CAST(coalesce(sum(quantity_sold) FILTER (WHERE channel = 'MACHINERY'), 0) AS BIGINT) AS machinery_qty,
            CAST(coalesce(sum(quantity_sold) FILTER (WHERE channel = 'HOUSEHOLD'), 0) AS BIGINT) AS household_qty
        FROM sales GROUP BY drug_id""",
    "event_day_flag": f"""WITH {EVENTS} SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
            EXISTS (SELECT 1 FROM ev WHERE CAST(o_orderdate AS DATE) BETWEEN a AND b) AS is_event_day FROM orders""",
    "event_match": f"""WITH {EVENTS}, {SALES}, hit AS (
            SELECT transaction_date AS d, zone AS z, drug_category AS c, count(*) AS n,
                max(CASE impact WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END) AS k
            FROM (SELECT DISTINCT transaction_date, zone, drug_category FROM sales)
            JOIN ev ON transaction_date BETWEEN a AND b AND list_contains(string_split(zones, '|'), zone)
                AND list_contains(string_split(cats, '|'), drug_category) GROUP BY 1, 2, 3)
        SELECT transaction_id, line, CAST(transaction_date AS VARCHAR) AS transaction_date, zone, drug_category,
            CAST(coalesce(n, 0) AS BIGINT) AS active_events,
            CASE k WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' END AS max_impact, n IS NOT NULL AS event_match
        FROM sales LEFT JOIN hit ON d = transaction_date AND z = zone AND c = drug_category""",
    "high_return_flag": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS quantity_sold,
            CAST(round(l_discount * 100) AS INT) AS returns,
            CAST(round(l_discount * 100) AS INT) * 10 > CAST(l_quantity AS INT) AS high_return_flag FROM lineitem""",
    "net_revenue_check": """WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q,
                CAST(round(l_discount * 100) AS INT) AS ret, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)
        SELECT l_orderkey, l_linenumber, CAST(q * p AS DOUBLE) AS revenue, CAST((q - ret) * p AS DOUBLE) AS net_revenue,
            abs(ret * p) > 0.01 AS revenue_mismatch FROM x""",
    "dedup_line_items": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
            l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_returnflag, l_linestatus,
            CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "orphan_keys": """SELECT l_partkey, count(*) AS rows FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY l_partkey""",
    "required_fields_and_trim": """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
            nullif(o_orderstatus, 'P') AS o_orderstatus,
            concat_ws('; ', CASE WHEN o_orderpriority = '5-LOW' THEN 'missing o_orderpriority' END,
                CASE WHEN o_orderstatus = 'P' THEN 'missing o_orderstatus' END) AS reject_reason FROM orders""",
    "machine_age": """SELECT l_orderkey, l_linenumber,
            round(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) / 365.0, 1) AS age_years
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "gold_write_and_read": f"""WITH {SALES} SELECT drug_id, region_id, year(transaction_date) AS year,
            month(transaction_date) AS month, CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold, count(*) AS num_transactions
        FROM sales GROUP BY ALL""",
    "threshold_labels": f"""WITH {READINGS}, {LIMIT_TABLE} SELECT reading_id, temperature / 500 > 0.3 AS is_degrading,
            temperature / 500 > 0.8 AS will_fail_in_4hrs,
            coalesce(temperature < 10 OR temperature > temp_critical, false) AS outside_normal_range
        FROM r LEFT JOIN customer ON machine_id = c_custkey LEFT JOIN limits ON c_mktsegment = machine_type""",
    "json_round_trip": "SELECT event_id, user_id, event_type, value FROM events",
    "safe_parse_quarantine": """SELECT CASE event_type WHEN 'error' THEN 'malformed message'
            WHEN 'signup' THEN 'unreadable time' ELSE 'unreadable number' END AS reject_reason,
            count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS raw_kept
        FROM events WHERE event_type IN ('error', 'signup', 'view') GROUP BY 1""",
    "dimension_enrichment": f"""WITH {READINGS}, {LIMIT_TABLE} SELECT reading_id, machine_id, c_mktsegment AS machine_type,
            c_nationkey AS location, temp_critical FROM r LEFT JOIN customer ON machine_id = c_custkey
            LEFT JOIN limits ON c_mktsegment = machine_type""",
    "anomaly_flags": _FLAGS,
    "sensor_lags_and_change": f"""WITH {READINGS} SELECT reading_id, machine_id, temperature, vibration, {_lags()}
        FROM r WINDOW {_ROW_ORDER}""",
    "rolling_5_15_30m": f"""WITH {READINGS} SELECT reading_id, {_frames(MINUTE_FRAMES)} FROM r WINDOW {_window_clause(_LENGTHS)}""",
    "rolling_6_24_72h": f"""WITH {READINGS} SELECT reading_id, {_frames(HOUR_FRAMES)} FROM r WINDOW {_window_clause(HOURS)}""",
    "anomaly_count_frame": f"""WITH {READINGS} SELECT reading_id, {", ".join(
        f"count(CASE WHEN temperature > 90 THEN 1 END) OVER f{k} AS anomaly_count_{k}" for k in HOURS)}
        FROM r WINDOW {_window_clause(HOURS)}""",
    "calendar_and_shift": f"""WITH {READINGS}, x AS (SELECT *, month(ts) AS month FROM r)
        SELECT reading_id, quarter(ts) AS quarter, {SEASON} AS season, {MONTH_FLAGS}, {SHIFT} FROM x""",
    "failure_within_horizon": f"""WITH {READINGS} SELECT reading_id, machine_id, EXISTS (SELECT 1 FROM r f
            WHERE f.event_type = 'error' AND f.machine_id = r.machine_id AND f.s > r.s AND f.s <= r.s + 14400) AS will_fail_in_4hrs FROM r""",
    "machine_features_full": f"""WITH {READINGS} SELECT reading_id, machine_id, temperature, vibration,
            temperature > 90 AS is_anomaly, {_lags()}, {_frames(HOUR_FRAMES)},
            count(CASE WHEN temperature > 90 THEN 1 END) OVER f6h AS anomaly_count_6h, {SHIFT}
        FROM r WINDOW {_ROW_ORDER}, {_window_clause(HOURS)}""",
    "risk_tier": f"""SELECT event_id AS reading_id, {RISK}, CASE WHEN value / 500 >= 0.75 THEN 'Immediate shutdown and inspection required!'
            WHEN value / 500 >= 0.5 THEN 'Schedule maintenance within 2 hours.'
            WHEN value / 500 >= 0.25 THEN 'Monitor closely and plan maintenance soon.'
            ELSE 'Machine operating normally.' END AS recommendation FROM events""",
    "fleet_kpis": f"""WITH {FLEET} {_KPIS}""",
    "fleet_kpis_filtered": f"""WITH {FLEET} {_KPIS} WHERE location = 7 AND machine_type = 'BUILDING'""",
    "risk_distribution": f"""WITH {FLEET}
        SELECT risk_level, count(*) AS count FROM x WHERE risk_level <> 'LOW' GROUP BY 1""",
    "risk_quantiles_by_type": f"""WITH {FLEET}
        SELECT machine_type, count(*) AS rows, {", ".join(f"round(quantile_cont(failure_probability, {p}), 6) AS {n}" for p, n in
            ((0, "minimum"), (0.25, "lower_quartile"), (0.5, "median"), (0.75, "upper_quartile"), (1, "maximum")))}
        FROM x GROUP BY 1""",
    "latest_status": f"""WITH {READINGS}, x AS (SELECT *, temperature AS value FROM r
            QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY ts DESC, reading_id DESC) = 1)
        SELECT machine_id, reading_id, temperature, vibration, {RISK}, s AS last_updated FROM x""",
    "sensor_trend_30m": _trend(30, 60),
    "sensor_trend_72h": _trend(72 * 60, 6 * 3600),
    "class_balance": """WITH x AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS p FROM events)
        SELECT n AS rows, p AS positives, p / CAST(n AS DOUBLE) AS positive_rate, (n - p) / CAST(p AS DOUBLE) AS positive_weight FROM x""",
    "median_fill": f"""WITH {READINGS}, g AS (SELECT reading_id, CASE WHEN event_type <> 'click' THEN temperature END AS temperature,
                nullif(vibration, 50) AS vibration FROM r)
        SELECT reading_id, round(coalesce(temperature, (SELECT median(temperature) FROM g)), 6) AS temperature,
            round(coalesce(vibration, (SELECT median(vibration) FROM g)), 6) AS vibration FROM g""",
    "label_encode": "SELECT event_id AS reading_id, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type FROM events",
    "stratified_split": f"""WITH {_SPLIT}
        SELECT failed, coalesce(b <= cut, FALSE) AS is_training, count(*) AS rows FROM x JOIN k USING (failed) GROUP BY ALL""",
    "stump_scores": _STUMP,
    "classification_report": """WITH x AS (SELECT toxic AS label, CAST(quality = 0 AS INT) AS prediction FROM labels),
        c AS (SELECT DISTINCT label AS k FROM x UNION SELECT DISTINCT prediction FROM x),
        n AS (SELECT k, (SELECT count(*) FROM x WHERE label = k AND prediction = k) AS hits,
                (SELECT count(*) FROM x WHERE prediction = k) AS predicted, (SELECT count(*) FROM x WHERE label = k) AS support FROM c)
        SELECT k AS class, round(CASE WHEN predicted = 0 THEN 0 ELSE hits / CAST(predicted AS DOUBLE) END, 6) AS precision,
            round(CASE WHEN support = 0 THEN 0 ELSE hits / CAST(support AS DOUBLE) END, 6) AS recall,
            round(CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / CAST(predicted + support AS DOUBLE) END, 6) AS f1_score,
            support FROM n""",
    "binary_metrics": """WITH x AS (SELECT event_type = 'error' AS y, value / 500 AS p FROM events),
        l AS (SELECT p, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM x GROUP BY p),
        b AS (SELECT *, sum(neg) OVER (ORDER BY p) - neg AS below FROM l),
        a AS (SELECT sum(pos * below + pos * neg / 2.0) AS won FROM b),
        t AS (SELECT count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg,
                count(*) FILTER (WHERE y AND p >= 0.1) AS hits, count(*) FILTER (WHERE p >= 0.1) AS predicted FROM x)
        SELECT round(CAST(won AS DOUBLE) / (CAST(pos AS DOUBLE) * neg), 4) AS roc_auc,
            round(2.0 * hits / CAST(predicted + pos AS DOUBLE), 4) AS f1_score,
            round(hits / CAST(predicted AS DOUBLE), 4) AS precision, round(hits / CAST(pos AS DOUBLE), 4) AS recall FROM a, t""",
    "stream_bronze": """SELECT event_id, CAST(ts AS VARCHAR) AS "timestamp", user_id, event_type, value, props,
            'kafka' AS source_system, CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date FROM events""",
    "stream_silver": _FLAGS,
    "stream_dedup": f"WITH {READINGS} SELECT reading_id, machine_id, temperature, vibration, event_type FROM r",
    "stream_late_rows": f"WITH {READINGS} SELECT reading_id, machine_id, temperature, vibration, event_type FROM r",
    "stream_windows_tumbling": _windows_sql(6 * 3600, 6 * 3600),
    "stream_windows_sliding": _windows_sql(24 * 3600, 6 * 3600),
    "stream_windows_session": f"""WITH {READINGS}, g AS (SELECT *, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER w < 21600 THEN 0 ELSE 1 END AS starts
            FROM r WINDOW {_ROW_ORDER}),
        n AS (SELECT *, sum(starts) OVER w AS session FROM g WINDOW {_ROW_ORDER})
        SELECT min(s) AS window_start, max(s) + 21600 AS window_end, machine_id, count(*) AS readings,
            round(avg(temperature), 6) AS temperature_mean, min(temperature) AS temperature_min, max(temperature) AS temperature_max,
            round(avg(vibration), 6) AS vibration_mean, min(vibration) AS vibration_min, max(vibration) AS vibration_max
        FROM n GROUP BY machine_id, session HAVING max(epoch(ts)) + 21600 <= (SELECT max(epoch(ts)) FROM r) - 600""",
    "stream_failure_horizon": f"""WITH {READINGS} SELECT machine_id, reading_id FROM r WHERE EXISTS (SELECT 1 FROM r f
        WHERE f.event_type = 'error' AND f.machine_id = r.machine_id AND f.ts > r.ts AND f.ts <= r.ts + INTERVAL 4 HOUR)""",
    "stream_stateful_lag": _LAG_ONLY,
    "stream_lag_by_batch": _LAG_ONLY,
    "stream_ordered_lag": _LAG_ONLY,
}
