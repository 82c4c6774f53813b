"""The registered queries in SQL, for comparison."""

from __future__ import annotations

# Fixed values of the data model, repeated so that the SQL stands alone.
CATEGORIES = (
    "['grocery','electronics','restaurant','gas_station','online_retail',"
    "'travel','healthcare','entertainment','luxury_goods','crypto_exchange']"
)
COUNTRIES = "['US','UK','CA','DE','FR','JP','AU','BR','IN','SG']"


def settled(value: str, digits: int = 4) -> str:
    scale = f"{10**digits}::DOUBLE"
    return f"(floor(({value}) * {scale} + 0.37::DOUBLE) / {scale})"


ALL_TX = f"""
all_tx AS (
  SELECT event_id,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
         'txn_' || event_id AS transaction_id,
         'user_' || user_id AS user_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso,
         value AS amount,
         'USD' AS currency,
         'merchant_' || (100 + event_id % 900) AS merchant_id,
         {CATEGORIES}[event_id % 10 + 1] AS merchant_category,
         CASE WHEN k < 85 THEN 'US' ELSE {COUNTRIES}[k % 10 + 1] END AS merchant_country,
         event_id % 2 = 0 AS card_present,
         CASE WHEN event_id % 3 = 0 THEN 'debit' ELSE 'credit' END AS card_type,
         ['online','pos','atm','contactless'][event_id % 4 + 1] AS channel,
         '10.0.' || (events.user_id % 256) || '.' || (event_id % 256) AS ip_address,
         substr(md5(CAST(events.user_id AS VARCHAR)), 1, 16) AS device_fingerprint,
         event_id % 10 IN (8, 9) AS is_high_risk_merchant,
         ts AS event_time
  FROM events
),
tx AS (SELECT * FROM all_tx WHERE amount > 0)
"""

# Messages as written by the query, with the same damage by event number.
BODIES = f"""
{ALL_TX},
spoiled AS (
  SELECT all_tx.*,
         CASE WHEN event_id % 50 = 1 THEN -amount ELSE amount END AS sent_amount,
         CASE WHEN event_id % 50 = 2 THEN NULL ELSE transaction_id END AS sent_id,
         CASE WHEN event_id % 50 = 3 THEN 'junk' ELSE iso END AS sent_time
  FROM all_tx
),
bodies AS (
  SELECT spoiled.*,
         '{{"transaction_id":' || coalesce('"' || sent_id || '"', 'null')
         || ',"user_id":"' || user_id || '","timestamp":"' || sent_time
         || '","amount":' || CAST(sent_amount AS VARCHAR) || ',"currency":"' || currency
         || '","merchant_id":"' || merchant_id || '","merchant_category":"' || merchant_category
         || '","merchant_country":"' || merchant_country || '","card_present":' || card_present
         || ',"card_type":"' || card_type || '","channel":"' || channel
         || '","ip_address":"' || ip_address || '","device_fingerprint":"' || device_fingerprint
         || '","is_high_risk_merchant":' || is_high_risk_merchant || '}}' AS body,
         CASE WHEN event_id % 50 = 0 THEN 'malformed_json'
              WHEN sent_id IS NULL THEN 'missing_transaction_id'
              WHEN NOT sent_amount > 0 THEN 'invalid_amount'
              WHEN sent_time = 'junk' THEN 'invalid_timestamp' END AS error
  FROM spoiled
)
"""

WINDOWS = f"""
{ALL_TX},
placed AS (
  SELECT tx.*, unnest(generate_series(
           date_trunc('day', event_time) - INTERVAL 6 DAY, date_trunc('day', event_time), INTERVAL 1 DAY
         ))::TIMESTAMP AS window_start
  FROM tx
),
win AS (
  SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, user_id,
         count(transaction_id) AS txn_count_1h,
         sum(amount) AS total_amount_1h,
         avg(amount) AS avg_amount_1h,
         stddev_samp(amount) AS stddev_amount_1h,
         max(amount) AS max_amount_1h,
         count(DISTINCT merchant_country) AS country_count_1h
  FROM placed GROUP BY window_start, user_id
)
"""

SCORES = f"""
{WINDOWS},
z AS (
  SELECT win.*,
         CASE WHEN stddev_amount_1h > 0
              THEN (max_amount_1h - avg_amount_1h) / stddev_amount_1h ELSE 0.0::DOUBLE END AS zscore_amount
  FROM win
),
flags AS (
  SELECT z.*, zscore_amount > 3 AS zscore_fraud_flag,
         txn_count_1h > 20 AS rule_high_velocity,
         country_count_1h > 3 AS rule_country_velocity,
         max_amount_1h > 200 AS rule_large_amount
  FROM z
),
scores AS (
  SELECT flags.*,
         zscore_fraud_flag OR rule_high_velocity OR rule_country_velocity OR rule_large_amount
           AS is_fraud_suspected,
         zscore_fraud_flag::INT * 0.4::DOUBLE + rule_high_velocity::INT * 0.2::DOUBLE
           + rule_country_velocity::INT * 0.25::DOUBLE + rule_large_amount::INT * 0.15::DOUBLE AS fraud_score,
         window_end AS processed_at
  FROM flags
)
"""

VIEWS = f"""
{SCORES},
clock AS (SELECT max(processed_at) AS as_of FROM scores),
recent AS (SELECT scores.* FROM scores, clock WHERE processed_at >= as_of - INTERVAL 30 DAY),
summary AS (
  SELECT date_trunc('minute', window_start)::TIMESTAMP AS minute_bucket,
         count(*) AS total_users_flagged,
         sum(CASE WHEN is_fraud_suspected THEN 1 ELSE 0 END)::BIGINT AS fraud_count,
         sum(CASE WHEN is_fraud_suspected THEN total_amount_1h ELSE 0 END) AS fraud_amount_at_risk,
         avg(fraud_score) AS avg_fraud_score,
         max(fraud_score) AS max_fraud_score,
         sum(txn_count_1h)::BIGINT AS total_txn_volume,
         round(sum(CASE WHEN is_fraud_suspected THEN 1 ELSE 0 END) * 100.0::DOUBLE / nullif(count(*), 0), 2)
           AS fraud_rate_pct
  FROM scores GROUP BY 1
),
profile AS (
  SELECT user_id,
         max(processed_at) AS last_seen_at,
         count(*) AS total_windows,
         sum(txn_count_1h)::BIGINT AS total_txn_24h,
         sum(total_amount_1h) AS total_amount_24h,
         avg(avg_amount_1h) AS avg_txn_amount_24h,
         max(max_amount_1h) AS max_single_txn_24h,
         max(country_count_1h) AS max_country_velocity,
         sum(is_fraud_suspected::INT)::BIGINT AS fraud_flags_count,
         max(fraud_score) AS peak_fraud_score,
         avg(fraud_score) AS avg_fraud_score,
         CASE WHEN max(fraud_score) >= 0.8::DOUBLE THEN 'CRITICAL' WHEN max(fraud_score) >= 0.5::DOUBLE THEN 'HIGH'
              WHEN max(fraud_score) >= 0.25::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
         sum(zscore_fraud_flag::INT)::BIGINT AS zscore_flags,
         sum(rule_high_velocity::INT)::BIGINT AS velocity_flags,
         sum(rule_country_velocity::INT)::BIGINT AS geo_flags,
         sum(rule_large_amount::INT)::BIGINT AS large_txn_flags
  FROM recent GROUP BY user_id
),
alerts AS (
  SELECT user_id, window_start, fraud_score,
         CASE WHEN zscore_fraud_flag AND rule_high_velocity AND rule_large_amount THEN 'MULTI_SIGNAL_FRAUD'
              WHEN zscore_fraud_flag AND rule_country_velocity THEN 'GEO_ANOMALY_FRAUD'
              WHEN rule_high_velocity AND rule_large_amount THEN 'VELOCITY_FRAUD'
              WHEN zscore_fraud_flag THEN 'STATISTICAL_ANOMALY'
              WHEN rule_country_velocity THEN 'GEO_VELOCITY'
              ELSE 'RULE_BASED_FLAG' END AS alert_type,
         max_amount_1h AS flagged_amount, country_count_1h AS country_count,
         txn_count_1h AS transaction_count, processed_at AS alert_generated_at
  FROM recent WHERE is_fraud_suspected
),
kpi AS (
  SELECT (SELECT as_of FROM clock) AS refreshed_at,
         count(DISTINCT user_id) AS active_users_1h,
         sum(txn_count_1h)::BIGINT AS total_transactions_1h,
         sum(total_amount_1h) AS total_volume_usd_1h,
         sum(is_fraud_suspected::INT)::BIGINT AS fraud_alerts_1h,
         sum(CASE WHEN is_fraud_suspected THEN total_amount_1h ELSE 0 END) AS at_risk_usd_1h,
         round(avg(date_diff('millisecond', window_start, processed_at)), 0) AS avg_detection_latency_ms,
         count(DISTINCT CASE WHEN fraud_score >= 0.8::DOUBLE THEN user_id END) AS critical_users
  FROM recent
),
feed AS (
  SELECT a.user_id, a.alert_type, a.fraud_score, a.flagged_amount, a.country_count,
         a.transaction_count, a.alert_generated_at, p.risk_tier, p.avg_fraud_score, p.total_amount_24h
  FROM alerts a LEFT JOIN profile p USING (user_id)
)
"""

LINES = """
lines AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS transaction_id,
         'user_' || o_custkey AS user_id, l_extendedprice AS amount, n_name AS merchant_country,
         l_shipdate AS event_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)
"""


def trailing(frame: str) -> str:
    return (
        f"(PARTITION BY user_id ORDER BY event_time RANGE BETWEEN INTERVAL '{frame}' PRECEDING AND CURRENT ROW)"
    )


# Frames are open on the left: one microsecond less than their length.
LAST_MINUTE = trailing("59.999999 seconds")
LAST_HOUR = trailing("59 minutes 59.999999 seconds")
LAST_DAY = trailing("23 hours 59 minutes 59.999999 seconds")
LAST_90_DAYS = trailing("89 days 23 hours 59 minutes 59.999999 seconds")

PER_TX = f"""
{ALL_TX},
hour_stats AS (
  SELECT tx.*,
         count(amount) OVER {LAST_HOUR} AS txn_count_1h,
         sum(amount) OVER {LAST_HOUR} AS total_amount_1h,
         avg(amount) OVER {LAST_HOUR} AS avg_amount_1h,
         coalesce(stddev_samp(amount) OVER {LAST_HOUR}, 0) AS stddev_amount_1h,
         max(amount) OVER {LAST_HOUR} AS max_amount_1h
  FROM tx
),
row_stats AS (
  SELECT transaction_id,
         CASE WHEN count(amount) OVER w >= 10
              THEN (amount - avg(amount) OVER w) / (stddev_samp(amount) OVER w + 1e-9::DOUBLE) END AS zscore_amount
  FROM tx
  WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
),
quartiles AS (
  SELECT user_id, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM tx GROUP BY user_id
),
outliers AS (
  SELECT transaction_id,
         (amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1))::INT AS iqr_outlier
  FROM tx JOIN quartiles USING (user_id)
),
days AS (
  SELECT user_id, event_time::DATE AS day, count(DISTINCT merchant_country) AS country_count_1h
  FROM tx GROUP BY ALL
),
clocked AS (
  SELECT transaction_id,
         hour(event_time)::INT AS hour_of_day,
         (isodow(event_time) - 1)::INT AS day_of_week,
         (isodow(event_time) >= 6)::INT AS is_weekend,
         (hour(event_time) >= 22 OR hour(event_time) <= 5)::INT AS is_night,
         ln(1 + amount) AS log_amount,
         is_high_risk_merchant::INT AS is_high_risk_merchant_int,
         (NOT card_present)::INT AS is_card_not_present
  FROM tx
),
features AS (
  SELECT h.*, c.* EXCLUDE (transaction_id), r.zscore_amount, o.iqr_outlier, d.country_count_1h
  FROM hour_stats h JOIN clocked c USING (transaction_id) JOIN row_stats r USING (transaction_id)
  JOIN outliers o USING (transaction_id)
  JOIN days d ON d.user_id = h.user_id AND d.day = h.event_time::DATE
)
"""

# Order of the model's inputs: fixed values.
MODEL = (
    "amount",
    "txn_count_1h",
    "total_amount_1h",
    "avg_amount_1h",
    "stddev_amount_1h",
    "max_amount_1h",
    "country_count_1h",
    "zscore_amount",
    "hour_of_day",
    "is_weekend",
    "is_high_risk_merchant_int",
    "is_card_not_present",
)
SCALER = " UNION ALL ".join(
    f"""SELECT {i}::INT AS position, '{name}' AS feature, avg(coalesce({name}, 0)::DOUBLE) AS mean,
        CASE WHEN stddev_pop(coalesce({name}, 0)::DOUBLE) > 0
             THEN stddev_pop(coalesce({name}, 0)::DOUBLE) ELSE 1 END AS scale FROM features"""
    for i, name in enumerate(MODEL)
)
LONG = " UNION ALL ".join(
    f"SELECT transaction_id, {i}::INT AS position, coalesce({name}, 0)::DOUBLE AS x FROM features"
    for i, name in enumerate(MODEL)
)



# The forest: 200 trees of 256 draws, nodes numbered as in a heap.
def hashed(text: str) -> str:
    return f"('0x' || substr(md5('42:' || {text}), 1, 15))::BIGINT"


def node_draw(number: int) -> str:
    return f"(('0x' || substr(md5('42:0:' || tree_id || '/' || node), {1 + 8 * number}, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE)"


def node_splits(source: str, over: str, columns: str, ending: str = "") -> str:
    """Adds ``f`` (null: a leaf) and ``threshold`` of the node; ``over`` or ``ending`` says what its rows are."""
    lows, highs = (f"[{', '.join(f'{end}(x[{i + 1}]){over}' for i in range(len(MODEL)))}]" for end in ("min", "max"))
    return f"""(
      SELECT * EXCLUDE (drawn), CASE WHEN drawn >= highs[f] THEN lows[f] ELSE drawn END AS threshold FROM (
        SELECT *, lows[f] + {node_draw(1)} * (highs[f] - lows[f]) AS drawn FROM (
          SELECT *, CASE WHEN depth < deepest THEN usable[1 + floor({node_draw(0)} * len(usable))::INT] END AS f FROM (
            SELECT *, list_filter({list(range(1, len(MODEL) + 1))}, lambda i: highs[i] > lows[i]) AS usable FROM (
              SELECT {columns}, {lows} AS lows, {highs} AS highs FROM {source} {ending})))))"""


def walked(levels: int) -> str:
    step = "(SELECT transaction_id, x, tree_id, 0 AS node FROM inputs, range(200) t(tree_id))"
    for _ in range(levels):
        step = f"""(
  SELECT transaction_id, x, tree_id,
         CASE WHEN f IS NULL THEN node WHEN x[f] <= threshold THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM {step} JOIN nodes USING (tree_id, node))"""
    return step


FOREST = f"""
RECURSIVE {PER_TX}, scaler AS ({SCALER}), long AS ({LONG}),
inputs AS MATERIALIZED (
  SELECT transaction_id, list((x - mean) / scale ORDER BY position) AS x
  FROM long JOIN scaler USING (position) GROUP BY transaction_id
),
ranked AS (SELECT x, row_number() OVER (ORDER BY {hashed('transaction_id')}, transaction_id) - 1 AS place FROM inputs),
sizes AS (SELECT count(*) AS total, least(256, count(*)) AS size FROM inputs),
draws AS (
  SELECT i // size AS tree_id, {hashed("'draw:' || i")} % total AS place, ceil(log2(greatest(size, 2))) AS deepest
  FROM (SELECT *, unnest(range(200 * size)) AS i FROM sizes)
),
points AS MATERIALIZED (SELECT tree_id, x, deepest FROM draws JOIN ranked USING (place)),
grown AS (
  SELECT 0 AS depth, deepest, tree_id, 0 AS node, x FROM points
  UNION ALL
  SELECT depth + 1, deepest, tree_id, CASE WHEN x[f] <= threshold THEN 2 * node + 1 ELSE 2 * node + 2 END, x
  FROM {node_splits('grown', ' OVER (PARTITION BY tree_id, node)', 'depth, deepest, tree_id, node, x')} WHERE f IS NOT NULL
),
nodes AS MATERIALIZED (
  SELECT tree_id, node, f, threshold,
         depth + CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1
                      ELSE 2 * (ln(n - 1) + 0.5772156649015329::DOUBLE) - 2 * (n - 1)::DOUBLE / n END AS path
  FROM {node_splits('grown', '', 'depth, deepest, tree_id, node, count(*)::DOUBLE AS n', 'GROUP BY depth, deepest, tree_id, node')}
),
paths AS (
  SELECT transaction_id, sum(path ORDER BY tree_id) / 200 AS path
  FROM {walked(8)} JOIN nodes USING (tree_id, node) GROUP BY transaction_id
),
raw_scores AS MATERIALIZED (
  SELECT transaction_id,
         -pow(2::DOUBLE, -path / (2 * (ln(size - 1) + 0.5772156649015329::DOUBLE) - 2 * (size - 1)::DOUBLE / size)) AS score
  FROM paths, sizes
),
forest_scores AS (
  SELECT transaction_id, {settled('score', 9)} AS isolation_score,
         score < (SELECT quantile_cont(score, 0.02) FROM raw_scores) AS is_anomaly_ml
  FROM raw_scores
)
"""

BOUNDS = "0.001 0.005 0.01 0.025 0.05 0.1 0.25 0.5 1.0".split()


def draw(number: int, seed: int = 42) -> str:
    digest = f"md5('{seed}:{number // 4}:' || event_id)"
    digits = f"substr({digest}, {1 + 8 * (number % 4)}, 8)"
    return f"(('0x' || {digits})::BIGINT::DOUBLE / 4294967296.0::DOUBLE)"


def whole(number: int, low: int, high: int) -> str:
    return f"(floor({draw(number)} * {high - low + 1}) + {low})::BIGINT"


def chosen(number: int, names: list[str], weights: list[int] | None = None) -> str:
    weights = weights or [1] * len(names)
    reached, cases = 0, ""
    for name, weight in list(zip(names, weights))[:-1]:
        reached += weight
        cases += f" WHEN {draw(number)} < {reached}::DOUBLE / {sum(weights)}::DOUBLE THEN '{name}'"
    return f"CASE{cases} ELSE '{names[-1]}' END"


CATEGORY_NAMES = CATEGORIES.strip("[]").replace("'", "").split(",")
COUNTRY_NAMES = COUNTRIES.strip("[]").replace("'", "").split(",")
SYNTHETIC = f"""
WITH made AS (
  SELECT md5('id42:' || event_id) AS digest, ts AS event_time, {draw(2)} < 0.02::DOUBLE AS is_injected,
         {chosen(1, CATEGORY_NAMES, [20, 10, 15, 8, 18, 5, 7, 9, 3, 5])} AS merchant_category,
         {chosen(7, COUNTRY_NAMES)} AS any_country, {draw(6)} AS home, {draw(3)} AS u3,
         sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {draw(4)})) * cos(2.0::DOUBLE * pi() * {draw(5)}) AS normal,
         event_id
  FROM events
)
SELECT digest AS transaction_id, 'user_' || {whole(0, 1000, 9999)} AS user_id,
       round(CASE WHEN is_injected THEN 5000 + u3 * 45000
                  ELSE exp(3.5::DOUBLE + 1.2::DOUBLE * normal) END, 2) AS amount,
       'USD' AS currency, 'merchant_' || {whole(8, 100, 999)} AS merchant_id, merchant_category,
       CASE WHEN NOT is_injected AND home < 0.85::DOUBLE THEN 'US' ELSE any_country END AS merchant_country,
       {draw(9)} < 0.5::DOUBLE AS card_present, {chosen(10, ["credit", "debit"])} AS card_type,
       {chosen(11, ["online", "pos", "atm", "contactless"])} AS channel,
       {whole(12, 1, 255)} || '.' || {whole(13, 0, 255)} || '.' || {whole(14, 0, 255)} || '.' || {whole(15, 0, 255)}
         AS ip_address,
       substr(digest, 17, 16) AS device_fingerprint,
       merchant_category IN ('crypto_exchange', 'luxury_goods') AS is_high_risk_merchant,
       event_time, is_injected
FROM made
"""


def swept(score: str, rows: str) -> str:
    return f"""
counted AS (SELECT {score} AS score, count(*) AS n, count(*) FILTER (k >= 97) AS hits FROM {rows} GROUP BY 1),
swept AS (
  SELECT *, (sum(n) OVER w)::BIGINT AS flagged, (sum(hits) OVER w)::BIGINT AS caught,
         (sum(n) OVER ())::BIGINT AS n_all, (sum(hits) OVER ())::BIGINT AS hits_all
  FROM counted WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
),
best AS (
  SELECT 2::DOUBLE * caught / (flagged + hits_all) AS best_f1, score AS best_f1_score
  FROM swept ORDER BY best_f1 DESC, score DESC LIMIT 1
),
cut AS (
  SELECT score AS score_limit, flagged, caught FROM swept
  WHERE flagged >= ceil(n_all * 0.02::DOUBLE) ORDER BY score DESC LIMIT 1
),
whole AS (
  SELECT any_value(n_all) AS n_rows, any_value(hits_all) AS positives,
         sum((n - hits) * (caught - hits / 2::DOUBLE)) AS area
  FROM swept
)
SELECT n_rows, positives, {settled('area / (positives::DOUBLE * (n_rows - positives))')} AS auc, score_limit, flagged,
       {settled('caught::DOUBLE / flagged')} AS precision, {settled('caught::DOUBLE / positives')} AS recall,
       {settled('best_f1')} AS best_f1, best_f1_score
FROM whole, cut, best"""


def replaced(columns: str, digits: int = 4) -> str:
    return "* REPLACE (" + ", ".join(f"{settled(c, digits)} AS {c}" for c in columns.split()) + ")"


WINDOW_SUMS = "total_amount_1h avg_amount_1h stddev_amount_1h"
FEED = f"WITH {VIEWS} SELECT {replaced('fraud_score avg_fraud_score total_amount_24h')} FROM feed"
SCORED = replaced(f"{WINDOW_SUMS} zscore_amount fraud_score")
RATED = """
rated AS (
  SELECT round(sum(is_fraud_suspected::INT) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS fraud_rate_pct FROM recent
)
"""
KPI_METRICS = f"""{RATED},
metrics AS (
  SELECT 'critical_users' AS name, critical_users::DOUBLE AS value FROM kpi
  UNION ALL SELECT 'fraud_rate_pct', fraud_rate_pct FROM rated
  UNION ALL SELECT 'avg_detection_latency_ms', avg_detection_latency_ms FROM kpi
)
"""
OFFSETS = """
parts AS (SELECT user_id % 8 AS part, max(event_id) AS high FROM events GROUP BY 1),
offsets AS (SELECT part, high, CASE WHEN part = 0 THEN -1 ELSE high - 10 * part END AS committed FROM parts),
lag AS (SELECT sum(CASE WHEN committed >= 0 THEN greatest(0, high - committed) ELSE 0 END)::BIGINT AS lag FROM offsets)
"""


def alert_select(metrics: str, rules: str) -> str:
    return f"""
SELECT name, value, op, threshold, severity,
       upper(name) || ' ALERT: ' || format('{{:,.3f}}', value) || ' is '
       || CASE WHEN op = '>' THEN 'above' ELSE 'below' END || ' the limit ' || format('{{:,.3f}}', threshold)
         AS message
FROM {metrics} JOIN (VALUES {rules}) r(name, op, threshold, severity) USING (name)
WHERE CASE WHEN op = '>' THEN value > threshold ELSE value < threshold END
"""


DASHBOARD_RULES = """
('fraud_rate_pct', '>', 5::DOUBLE, 'warning'), ('critical_users', '>', 0::DOUBLE, 'critical'),
('avg_detection_latency_ms', '>', 2000::DOUBLE, 'warning')
"""
MONITOR_RULES = """
('kafka_lag', '>', 5000::DOUBLE, 'critical'), ('dlq_count', '>', 5::DOUBLE, 'critical'),
('avg_detection_latency_ms', '>', 2000::DOUBLE, 'warning'),
('fraud_rate', '<', 0.001::DOUBLE, 'warning'), ('fraud_rate', '>', 0.2::DOUBLE, 'warning')
"""
REJECTED_TODAY = """error IS NOT NULL AND event_time > (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""

ORACLES: dict[str, str] = {
    "parse_valid": f"""
WITH {BODIES}
SELECT transaction_id, user_id, iso AS timestamp, amount, currency, merchant_id, merchant_category,
       merchant_country, card_present, card_type, channel, ip_address, device_fingerprint,
       is_high_risk_merchant, event_time AS kafka_timestamp, event_time
FROM bodies WHERE error IS NULL""",
    "parse_lenient": f"""
WITH {BODIES}
SELECT transaction_id, user_id, amount, CASE WHEN sent_time <> 'junk' THEN event_time END AS event_time
FROM bodies WHERE error IS NULL OR error = 'invalid_timestamp'""",
    "dead_letter": f"""
WITH {BODIES}
SELECT user_id AS key, CASE WHEN event_id % 50 = 0 THEN substr(body, 1, 20) ELSE body END AS value,
       error, 'transactions' AS original_topic
FROM bodies WHERE error IS NOT NULL""",
    "delivery_counts": f"""
WITH {BODIES}
SELECT count(*) FILTER (error IS NULL) AS messages_sent, count(*) FILTER (error IS NOT NULL) AS messages_failed
FROM bodies""",
    "dead_letters_by_minute": f"""
WITH {BODIES}
SELECT date_trunc('minute', event_time)::TIMESTAMP AS minute_bucket, count(*) AS dlq_count
FROM bodies WHERE error IS NOT NULL GROUP BY 1""",
    "encoded_messages": f"""
WITH {ALL_TX}
SELECT user_id AS key,
       '{{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","timestamp":"' || iso
       || '","amount":' || CAST(amount AS VARCHAR) || ',"currency":"' || currency
       || '","merchant_id":"' || merchant_id || '","merchant_category":"' || merchant_category
       || '","merchant_country":"' || merchant_country || '","card_present":' || card_present
       || ',"card_type":"' || card_type || '","channel":"' || channel
       || '","ip_address":"' || ip_address || '","device_fingerprint":"' || device_fingerprint
       || '","is_high_risk_merchant":' || is_high_risk_merchant || '}}' AS value
FROM tx""",
    "window_features": f"WITH {WINDOWS} SELECT {replaced(WINDOW_SUMS)} FROM win",
    "zscore_flags": f"""
WITH {SCORES}
SELECT user_id, window_start, {settled('zscore_amount')} AS zscore_amount, zscore_fraud_flag FROM scores""",
    "rule_flags": f"""
WITH {SCORES}
SELECT user_id, window_start, rule_high_velocity, rule_country_velocity, rule_large_amount FROM scores""",
    "fraud_score": f"WITH {SCORES} SELECT {SCORED} FROM scores",
    "non_overlapping_totals": f"""
WITH {SCORES}
SELECT user_id, sum(txn_count_1h)::BIGINT AS txn_total, {settled('sum(total_amount_1h)')} AS amount_total
FROM scores WHERE date_diff('day', DATE '1970-01-01', window_start::DATE) % 7 = 0 GROUP BY user_id""",
    "order_line_windows": f"""
WITH {LINES},
placed AS (
  SELECT lines.*, unnest(generate_series(0, 2)) AS back,
         DATE '1970-01-01' + INTERVAL 1 DAY
           * (date_diff('day', DATE '1970-01-01', event_time::DATE) // 30 - back) * 30 AS window_start
  FROM lines
)
SELECT window_start::TIMESTAMP AS window_start, (window_start + INTERVAL 90 DAY)::TIMESTAMP AS window_end, user_id,
       count(*) AS txn_count_1h, {settled('sum(amount)', 2)} AS total_amount_1h,
       {settled('avg(amount)', 2)} AS avg_amount_1h, {settled('stddev_samp(amount)', 2)} AS stddev_amount_1h,
       max(amount) AS max_amount_1h, count(DISTINCT merchant_country) AS country_count_1h
FROM placed GROUP BY window_start, user_id""",
    "order_line_trailing": f"""
WITH {LINES}
SELECT transaction_id, user_id, event_time, amount, count(amount) OVER {LAST_90_DAYS} AS line_count,
       {settled(f'sum(amount) OVER {LAST_90_DAYS}', 2)} AS amount_sum,
       {settled(f'stddev_samp(amount) OVER {LAST_90_DAYS}', 2)} AS amount_stddev,
       max(amount) OVER {LAST_90_DAYS} AS amount_max
FROM lines""",
    "fraud_summary_1min": f"""
WITH {VIEWS} SELECT {replaced('fraud_amount_at_risk avg_fraud_score max_fraud_score')} FROM summary""",
    "user_risk_profile": f"""
WITH {VIEWS}
SELECT {replaced('total_amount_24h avg_txn_amount_24h peak_fraud_score avg_fraud_score')} FROM profile""",
    "fraud_alerts": f"WITH {VIEWS} SELECT {replaced('fraud_score')} FROM alerts",
    "dashboard_kpi": f"WITH {VIEWS} SELECT {replaced('total_volume_usd_1h at_risk_usd_1h')} FROM kpi",
    "fraud_feed": FEED,
    "refreshed_feed": FEED,
    "refreshed_incremental": FEED,
    "incremental_kpi": f"WITH {VIEWS} SELECT {replaced('total_volume_usd_1h at_risk_usd_1h')} FROM kpi",
    "incremental_summary": f"""
WITH {VIEWS} SELECT {replaced('fraud_amount_at_risk avg_fraud_score max_fraud_score')} FROM summary""",
    "sketched_kpi_error": f"""
WITH {VIEWS}
SELECT active_users_1h, critical_users, true AS active_users_1h_near, true AS critical_users_near FROM kpi""",
    "sketched_windows": f"WITH {WINDOWS} SELECT {replaced(WINDOW_SUMS)} FROM win",
    "stream_quartiles": f"""
WITH {ALL_TX}
SELECT user_id, count(*) AS amounts, true AS q1_near, true AS q3_near FROM tx GROUP BY user_id""",
    "compacted_scores": f"WITH {SCORES} SELECT {SCORED} FROM scores",
    "replayed_sink": f"WITH {SCORES} SELECT {SCORED} FROM scores",
    "txn_time_features": f"WITH {PER_TX} SELECT {replaced('log_amount')} FROM clocked",
    "txn_zscore_rows": f"WITH {PER_TX} SELECT {replaced('zscore_amount')} FROM row_stats",
    "txn_iqr_outlier": f"WITH {PER_TX} SELECT * FROM outliers",
    "txn_trailing_1h": f"""
WITH {PER_TX}
SELECT {replaced(WINDOW_SUMS)} FROM (
  SELECT transaction_id, user_id, event_time, amount, txn_count_1h, total_amount_1h, avg_amount_1h,
         stddev_amount_1h, max_amount_1h FROM hour_stats)""",
    "txn_trailing_24h": f"""
WITH {ALL_TX} SELECT transaction_id, count(amount) OVER {LAST_DAY} AS txn_count_24h FROM tx""",
    "daily_countries": f"""
WITH {PER_TX}
SELECT transaction_id, country_count_1h
FROM tx JOIN days ON days.user_id = tx.user_id AND days.day = tx.event_time::DATE""",
    "behavioral_features": f"""
WITH {PER_TX}
SELECT {replaced(WINDOW_SUMS + ' log_amount zscore_amount')}
FROM (SELECT * EXCLUDE (event_id, k, iso, ip_address, device_fingerprint) FROM features)""",
    "merchant_frequency": f"""
WITH {ALL_TX}
SELECT transaction_id, user_id, merchant_id, count(*) OVER (PARTITION BY user_id, merchant_id) AS merchant_frequency
FROM tx""",
    "rule_burst_amount": f"""
WITH {ALL_TX}
SELECT transaction_id, {settled(f'sum(amount) OVER {LAST_MINUTE}')} AS burst_amount,
       sum(amount) OVER {LAST_MINUTE} > 10000 AS rule_burst_amount FROM tx""",
    "rule_countries_24h": f"""
WITH {ALL_TX}
SELECT transaction_id, count(DISTINCT merchant_country) OVER {LAST_DAY} AS country_count_24h,
       count(DISTINCT merchant_country) OVER {LAST_DAY} > 5 AS rule_country_spread FROM tx""",
    "rule_cnp_high_risk": f"""
WITH {ALL_TX} SELECT transaction_id, NOT card_present AND is_high_risk_merchant AS rule_cnp_high_risk FROM tx""",
    "geo_velocity": f"""
WITH {ALL_TX},
lagged AS (
  SELECT tx.*, lag(merchant_country) OVER w AS previous_country, lag(event_time) OVER w AS previous_time
  FROM tx WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id)
)
SELECT transaction_id, previous_country, coalesce(merchant_country <> previous_country, false) AS country_changed,
       {settled("date_diff('microsecond', previous_time, event_time) / 3600000000.0::DOUBLE")} AS hours_since_previous
FROM lagged""",
    "historical_zscore": f"""
WITH {ALL_TX},
stats AS (SELECT user_id, avg(amount) AS m, stddev_samp(amount) AS s FROM tx GROUP BY user_id),
z AS (SELECT transaction_id, CASE WHEN s > 0 THEN (amount - m) / s ELSE 0 END AS z FROM tx JOIN stats USING (user_id))
SELECT transaction_id, {settled('z')} AS historical_zscore, abs(z) > 3 AS rule_historical_zscore FROM z""",
    "merchant_fraud_rate": f"""
WITH {ALL_TX}
SELECT merchant_id, count(*) AS txn_count, sum((amount > 200)::INT)::BIGINT AS flagged_count,
       round(sum((amount > 200)::INT) * 100.0::DOUBLE / count(*), 2) AS fraud_rate_pct
FROM tx GROUP BY merchant_id""",
    "tier_distribution": f"WITH {VIEWS} SELECT risk_tier, count(*) AS row_count FROM profile GROUP BY 1",
    "alert_distribution": f"WITH {VIEWS} SELECT alert_type, count(*) AS row_count FROM alerts GROUP BY 1",
    "country_distribution": f"""
WITH {ALL_TX} SELECT merchant_country, count(*) AS row_count FROM tx WHERE amount > 200 GROUP BY 1""",
    "fraud_rate_measure": f"""
WITH {VIEWS}
SELECT {settled('''coalesce((SELECT count(*) FROM alerts WHERE fraud_score > 0.5::DOUBLE)::DOUBLE
       / nullif((SELECT count(*) FROM scores), 0), 0) * 100''')} AS fraud_rate_pct""",
    "at_risk_usd": f"""
WITH {VIEWS}
SELECT {settled('sum(total_amount_24h)')} AS at_risk_usd FROM profile WHERE risk_tier = 'CRITICAL'""",
    "avg_latency": f"WITH {VIEWS} SELECT avg(avg_detection_latency_ms) AS avg_latency_ms FROM kpi",
    "top_risky_users": f"""
WITH {VIEWS}
SELECT user_id, risk_tier, {settled('peak_fraud_score')} AS peak_fraud_score,
       row_number() OVER (ORDER BY p.peak_fraud_score DESC, user_id)::INT AS risk_rank
FROM profile p ORDER BY p.peak_fraud_score DESC, user_id LIMIT 20""",
    "tier_slicer": f"""
WITH {VIEWS} SELECT user_id, risk_tier FROM profile WHERE risk_tier IN ('CRITICAL', 'HIGH')""",
    "volume_against_flags": f"""
WITH {VIEWS}
SELECT user_id, {settled('total_amount_24h')} AS total_amount_24h, fraud_flags_count FROM profile""",
    "fraud_trend": f"""
WITH {VIEWS} SELECT minute_bucket, fraud_count, fraud_rate_pct FROM summary ORDER BY minute_bucket""",
    "high_score_alerts": f"""
WITH {VIEWS} SELECT user_id, window_start, alert_type FROM alerts WHERE fraud_score > 0.8::DOUBLE""",
    "kpi_cards": f"""
WITH {VIEWS}, {RATED}
SELECT fraud_alerts_1h, {settled('at_risk_usd_1h')} AS at_risk_usd_1h, avg_detection_latency_ms, critical_users,
       fraud_rate_pct
FROM kpi, rated""",
    "detection_metrics": f"""
WITH judged AS (
  SELECT value > 150 AS p, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) >= 97 AS a FROM events
),
counted AS (
  SELECT sum((p AND a)::INT)::BIGINT AS true_positives, sum((p AND NOT a)::INT)::BIGINT AS false_positives,
         sum((NOT p AND a)::INT)::BIGINT AS false_negatives, sum((NOT p AND NOT a)::INT)::BIGINT AS true_negatives
  FROM judged
)
SELECT counted.*,
       {settled('true_positives::DOUBLE / nullif(true_positives + false_positives, 0)')} AS precision,
       {settled('true_positives::DOUBLE / nullif(true_positives + false_negatives, 0)')} AS recall,
       {settled('false_positives::DOUBLE / nullif(false_positives + true_negatives, 0)')} AS false_positive_rate
FROM counted""",
    "score_quality": f"WITH {ALL_TX}, {swept('amount', 'tx')}",
    "isolation_forest_scores": f"WITH {FOREST} SELECT * FROM forest_scores",
    "forest_quality": f"WITH {FOREST}, {swept('-isolation_score', 'forest_scores JOIN tx USING (transaction_id)')}",
    "stored_reports": f"""
WITH {BODIES}, {OFFSETS},
checks AS (SELECT (SELECT max(ts) FROM events) - to_days(i::INTEGER) AS report_time FROM range(7) r(i)),
rejected AS (SELECT event_time FROM bodies WHERE error IS NOT NULL),
reports AS (
  SELECT report_time, (SELECT lag FROM lag) AS kafka_lag, count(event_time) AS dlq_count
  FROM checks LEFT JOIN rejected ON event_time > report_time - INTERVAL 1 DAY AND event_time <= report_time
  GROUP BY report_time
)
SELECT *, (kafka_lag > 5000)::BIGINT + (dlq_count > 5)::BIGINT AS alerts FROM reports""",
    "stopped_and_resumed": f"""
WITH {ALL_TX} SELECT user_id, count(*) AS txn_count, {settled('sum(amount)')} AS total_amount FROM tx GROUP BY user_id""",
    "offset_lag": f"""
WITH {OFFSETS} SELECT 'detector' AS "group", 'transactions' AS topic, lag FROM lag""",
    "query_cost_summary": """
SELECT count(*) AS query_count, round(coalesce(sum(o_totalprice / 1e6::DOUBLE), 0), 4) AS credits_used,
       round(coalesce(avg(o_custkey::DOUBLE), 0), 1) AS avg_elapsed_ms,
       round(coalesce(max(o_custkey::DOUBLE), 0), 1) AS max_elapsed_ms,
       round(coalesce(sum(o_totalprice * 1e6::DOUBLE) / 1e9::DOUBLE, 0), 3) AS gb_scanned
FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY""",
    "latency_histogram": " UNION ALL ".join(
        [
            f"SELECT '{b}' AS le, count(*) FILTER (value / 500 <= {b}::DOUBLE) AS cumulative_count FROM events"
            for b in BOUNDS
        ]
        + ["SELECT '+Inf', count(*) FROM events"]
    ),
    "threshold_alerts": f"WITH {VIEWS}, {KPI_METRICS} {alert_select('metrics', DASHBOARD_RULES)}",
    "monitor_report": f"""
WITH {BODIES}, {OFFSETS}
SELECT (SELECT max(ts) FROM events) AS report_time, (SELECT lag FROM lag) AS kafka_lag,
       (SELECT count(*) FROM bodies WHERE {REJECTED_TODAY}) AS dlq_count""",
    "monitor_alerts": f"""
WITH {BODIES}, {OFFSETS},
metrics AS (
  SELECT 'kafka_lag' AS name, lag::DOUBLE AS value FROM lag
  UNION ALL SELECT 'dlq_count', count(*)::DOUBLE FROM bodies WHERE {REJECTED_TODAY}
  UNION ALL SELECT * FROM (
    WITH {VIEWS}, {RATED}
    SELECT 'fraud_rate', fraud_rate_pct / 100 FROM rated UNION ALL SELECT 'avg_detection_latency_ms', avg_detection_latency_ms FROM kpi
  )
)
{alert_select('metrics', MONITOR_RULES)}""",
    "scaler_fit": f"WITH {PER_TX}, scaler AS ({SCALER}) SELECT {replaced('mean scale')} FROM scaler",
    "scaler_apply": f"""
WITH {PER_TX}, scaler AS ({SCALER}), long AS ({LONG})
SELECT transaction_id, position, {settled('(x - mean) / scale', 3)} AS scaled
FROM long JOIN scaler USING (position)""",
    "forest_sample": f"""
WITH {ALL_TX}
SELECT unnest(generate_series(0, 199))::INT AS tree_id, (SELECT least(256, count(*)) FROM tx)::BIGINT AS draws""",
    "synthetic_transactions": SYNTHETIC,
    "stream_window_features": f"""
WITH {BODIES.replace('tx AS (SELECT * FROM all_tx WHERE amount > 0)', 'unused AS (SELECT 1)')},
tx AS (SELECT * FROM bodies WHERE error IS NULL),
{SCORES[SCORES.index('placed AS'):]},
closed AS (SELECT * EXCLUDE (processed_at) FROM scores
           WHERE window_end <= (SELECT max(event_time) FROM tx) - INTERVAL 10 MINUTE)
SELECT {SCORED} FROM closed""",
    "stream_dead_letters": f"""
WITH {BODIES}
SELECT error, 'transactions' AS original_topic, count(*) AS message_count
FROM bodies WHERE error IS NOT NULL GROUP BY error""",
    "stream_txn_features": f"""
WITH {PER_TX}
SELECT {replaced(WINDOW_SUMS + ' burst_amount zscore_amount')} FROM (
  SELECT user_id, transaction_id, amount, txn_count_1h, total_amount_1h, avg_amount_1h, stddev_amount_1h,
         max_amount_1h, count(amount) OVER {LAST_DAY} AS txn_count_24h,
         sum(amount) OVER {LAST_MINUTE} AS burst_amount,
         count(DISTINCT merchant_country) OVER {LAST_DAY} AS country_count_24h,
         count(DISTINCT merchant_country) OVER (
           PARTITION BY user_id, event_time::DATE ORDER BY event_time
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS country_count_1h,
         zscore_amount
  FROM hour_stats JOIN row_stats USING (transaction_id))""",
}
