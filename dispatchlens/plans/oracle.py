"""SQL over the test tables that must give what the Spark queries give."""

RAW = """
raw_orders AS (
  SELECT *, CASE WHEN k % 97 <> 0 THEN bought + to_hours(k % 20) END AS approved
  FROM (SELECT o_orderkey AS k, o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
               o_orderdate + to_hours(o_orderkey % 24) + to_seconds(o_orderkey % 3600) AS bought,
               o_orderdate + to_days(CAST(8 + o_orderkey % 33 AS INTEGER)) AS promised,
               o_orderdate + to_days(CAST(2 + o_orderkey % 5 AS INTEGER)) AS collected,
               CASE WHEN o_orderstatus <> 'P'
                    THEN o_orderdate + to_days(CAST(3 + (o_orderkey * 7) % 40 AS INTEGER)) END AS arrived
        FROM orders)),
raw_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS category,
         CASE WHEN p_partkey % 53 <> 0 THEN p_size * 100e0 END AS weight,
         15e0 + p_size AS len, 5e0 + p_size % 20 AS hgt, 10e0 + p_size % 30 AS wid
  FROM part),
raw_sellers AS (
  SELECT s_suppkey AS seller_id, CAST(1000 + s_suppkey * 7 AS INTEGER) AS zip,
         CAST(s_suppkey % 12 AS VARCHAR) AS city, n_name AS state
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
raw_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_extendedprice AS price, l_quantity * 5e-1 AS freight,
         bought + to_days(CAST(2 + l_linenumber % 7 AS INTEGER)) AS deadline
  FROM lineitem JOIN raw_orders ON l_orderkey = order_id),
raw_payments AS (
  SELECT k AS order_id, seq, kind, CASE WHEN kind = 'credit_card' THEN 1 + k % 10 ELSE 1 END AS installments
  FROM (SELECT k, seq, ['credit_card', 'boleto', 'voucher', 'debit_card'][1 + (k + seq) % 4] AS kind
        FROM (SELECT k, unnest(range(1, 2 + k % 2)) AS seq FROM raw_orders WHERE k % 61 <> 0)))"""

LINES = RAW + """,
lines AS (
  SELECT i.*, price + freight AS total_cost, p.category, p.weight, p.len, p.hgt, p.wid,
         len * hgt * wid AS volume, s.state, s.city, s.zip
  FROM raw_items i LEFT JOIN raw_products p USING (product_id) LEFT JOIN raw_sellers s USING (seller_id))"""

_MEASURE_SQL = ["count(*) AS order_item_count"]
for _c in ("price", "freight", "total_cost"):
    _MEASURE_SQL += [f"sum({_c}) AS {_c}_sum", f"avg({_c}) AS {_c}_mean", f"max({_c}) AS {_c}_max"]
_MEASURE_SQL += ["stddev_samp(price) AS price_std", "stddev_samp(freight) AS freight_std"]
for _c, _n in (("weight", "product_weight_g"), ("len", "product_length_cm"), ("hgt", "product_height_cm"),
               ("wid", "product_width_cm"), ("volume", "product_volume")):
    _MEASURE_SQL += [f"avg({_c}) AS {_n}_mean", f"max({_c}) AS {_n}_max"]


def _top_value(source: str, value: str, name: str) -> str:
    return f"""(SELECT order_id, v AS {name} FROM (
      SELECT order_id, {value} AS v, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, {value}) AS place
      FROM {source} WHERE {value} IS NOT NULL GROUP BY order_id, {value}) WHERE place = 1)"""


PER_ORDER = LINES + f""",
measures AS (SELECT order_id, {', '.join(_MEASURE_SQL)}, min(deadline) AS first_deadline,
                    max(deadline) AS last_deadline FROM lines GROUP BY order_id),
distincts AS (SELECT order_id, count(DISTINCT product_id) AS product_count,
                     count(DISTINCT seller_id) AS seller_count, count(DISTINCT category) AS product_category_count,
                     count(DISTINCT state) AS seller_state_count, count(DISTINCT city) AS seller_city_count
              FROM lines GROUP BY order_id),
item_vals AS (SELECT * FROM distincts
  LEFT JOIN {_top_value('lines', 'category', 'product_category_mode')} USING (order_id)
  LEFT JOIN {_top_value('lines', 'state', 'seller_state_mode')} USING (order_id)
  LEFT JOIN {_top_value('lines', 'zip', 'seller_zip_mode')} USING (order_id)),
pays AS (SELECT * FROM (SELECT order_id, count(*) AS payment_count, max(installments) AS max_installments
                        FROM raw_payments GROUP BY order_id)
  LEFT JOIN {_top_value('raw_payments', 'kind', 'payment_type_mode')} USING (order_id)),
kept_orders AS (SELECT * FROM raw_orders WHERE order_status = 'delivered' AND arrived IS NOT NULL
                AND promised IS NOT NULL AND bought IS NOT NULL AND approved IS NOT NULL)"""

CALENDAR = """hour(bought) AS purchase_hour, dayofweek(bought) AS purchase_dayofweek,
  CAST(dayofweek(bought) IN (0, 6) AS INTEGER) AS is_weekend_purchase, month(bought) AS purchase_month,
  quarter(bought) AS purchase_quarter,
  CAST(day(last_day(bought)) - day(bought) <= 2 AS INTEGER) AS is_month_end"""


def _days(later: str, earlier: str) -> str:
    return f"CAST(ceil((epoch_us({later}) - epoch_us({earlier})) / 864e8) AS INTEGER)"


WINDOWS = f"""greatest({_days('promised', 'bought')}, 1) AS estimated_delivery_days,
  greatest((epoch_us(approved) - epoch_us(bought)) / 36e8, 0e0) AS approval_delay_hours,
  {_days('first_deadline', 'bought')} AS shipping_limit_min_days,
  {_days('promised', 'first_deadline')} AS shipping_window_days,
  {_days('promised', 'last_deadline')} AS seller_margin_days"""

FEATURES = PER_ORDER + f""",
features AS (
  SELECT m.*, v.* EXCLUDE (order_id, product_category_mode, seller_state_mode, seller_zip_mode),
         coalesce(v.product_category_mode, 'unknown') AS product_category_mode,
         coalesce(v.seller_state_mode, 'unknown') AS seller_state_mode,
         coalesce(v.seller_zip_mode, 0) AS seller_zip_mode, v.product_category_count > 1 AS is_multi_category,
         coalesce(p.payment_count, 0) AS payment_count, coalesce(p.payment_type_mode, 'unknown') AS payment_type_mode,
         CAST(coalesce(p.max_installments, 0) AS DOUBLE) AS max_installments,
         {CALENDAR}, {WINDOWS}, CAST(arrived > promised AS INTEGER) AS is_late_delivery, bought AS purchase_ts
  FROM kept_orders o JOIN measures m ON m.order_id = o.order_id JOIN item_vals v ON v.order_id = o.order_id
  LEFT JOIN pays p ON p.order_id = o.order_id)"""

SCORED = FEATURES + """,
scored AS (
  SELECT *, least(greatest(CAST(0.06 AS DOUBLE) + CAST(0.018 AS DOUBLE) * estimated_delivery_days
    + CAST(0.0012 AS DOUBLE) * freight_sum
    + CAST(0.012 AS DOUBLE) * CAST(purchase_hour >= 18 AS INTEGER), CAST(0.01 AS DOUBLE)), CAST(0.98 AS DOUBLE)) AS p
  FROM features)"""

LEVEL = "CASE WHEN {p} >= 55e-2 THEN 'high' WHEN {p} >= 25e-2 THEN 'medium' ELSE 'low' END"
ACTION = ("CASE {level} WHEN 'high' THEN 'prioritize fulfillment intervention' "
          "WHEN 'medium' THEN 'confirm carrier capacity' ELSE 'monitor normally' END")

WINDOWED = SCORED + """,
cut AS (SELECT CAST(round(quantile_cont(epoch_us(purchase_ts), 0.8)) AS BIGINT) AS cut_us FROM features),
windowed AS (SELECT scored.*, CASE WHEN epoch_us(purchase_ts) >= cut_us THEN 'current' ELSE 'reference' END AS win
             FROM scored, cut)"""

NUMBER_FEATURES = (
    "payment_count", "max_installments", "order_item_count", "product_count", "seller_count", "price_sum",
    "price_mean", "price_max", "price_std", "freight_sum", "freight_mean", "freight_max", "freight_std",
    "total_cost_sum", "total_cost_mean", "total_cost_max", "product_category_count", "is_multi_category",
    "product_weight_g_mean", "product_weight_g_max", "product_length_cm_mean", "product_length_cm_max",
    "product_height_cm_mean", "product_height_cm_max", "product_width_cm_mean", "product_width_cm_max",
    "product_volume_mean", "product_volume_max", "seller_state_count", "seller_city_count", "seller_zip_mode",
    "purchase_hour", "purchase_dayofweek", "is_weekend_purchase", "purchase_month", "purchase_quarter",
    "is_month_end", "estimated_delivery_days", "approval_delay_hours", "shipping_limit_min_days",
    "shipping_window_days", "seller_margin_days")
TEXT_FEATURES = ("payment_type_mode", "product_category_mode", "seller_state_mode")
FLOATS = {c for c in NUMBER_FEATURES if c.endswith(("_sum", "_mean", "_max", "_std", "_hours"))} | {"max_installments"}
DRIFT = ("estimated_delivery_days", "freight_sum", "price_sum", "product_count", "seller_count",
         "approval_delay_hours", "shipping_window_days", "total_cost_sum")


def rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


FEATURE_LIST = ", ".join([*TEXT_FEATURES, *[c for c in NUMBER_FEATURES if c not in FLOATS],
                          rounded(*sorted(FLOATS))])
STAMP = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def metrics_sql(source: str, group: str) -> str:
    """Metrics per group from a table with columns (group, s, y)."""
    return f"""
steps AS (SELECT {group}, s, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY {group}, s),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM steps
        WINDOW w AS (PARTITION BY {group} ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
metrics AS (
  SELECT {group}, sum(pos * (tp / (tp + fp))) / sum(pos) AS pr_auc,
         sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc,
         sum(pos * (s - 1) * (s - 1) + neg * s * s) / sum(pos + neg) AS brier,
         coalesce(2 * sum(CASE WHEN s >= 5e-1 THEN pos END)
           / nullif(sum(pos) + sum(CASE WHEN s >= 5e-1 THEN pos + neg ELSE 0 END), 0), 0) AS f1_at_0_5,
         sum(pos) / sum(pos + neg) AS val_positive_rate, CAST(sum(pos + neg) AS BIGINT) AS "rows"
  FROM cum GROUP BY {group})"""


LONG = WINDOWED + """,
long AS (SELECT win, metric, v FROM (""" + " UNION ALL ".join(
    f"SELECT win, '{m}' AS metric, CAST({c} AS DOUBLE) AS v FROM windowed"
    for m, c in [("score", "p"), *[(d, d) for d in DRIFT]]) + """) WHERE v IS NOT NULL),
quants AS (SELECT metric, quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS qs
           FROM long WHERE win = 'reference' GROUP BY metric),
edges AS (SELECT metric, edge, CAST(row_number() OVER (PARTITION BY metric ORDER BY edge) - 1 AS INTEGER) AS position,
                 lead(edge) OVER (PARTITION BY metric ORDER BY edge) AS upper_edge,
                 max(edge) OVER (PARTITION BY metric) AS top
          FROM (SELECT DISTINCT metric, unnest(qs) AS edge FROM quants)),
binned AS (SELECT e.metric, e.position AS bin,
                  count(*) FILTER (win = 'reference') AS reference_n, count(*) FILTER (win = 'current') AS current_n
           FROM edges e LEFT JOIN long l ON l.metric = e.metric AND l.v >= e.edge
                AND (l.v < e.upper_edge OR (l.v = e.top AND e.upper_edge = e.top))
           WHERE e.upper_edge IS NOT NULL GROUP BY e.metric, e.position),
shares AS (SELECT metric, greatest(reference_n / sum(reference_n) OVER (PARTITION BY metric), 1e-6) AS r,
                  greatest(current_n / sum(current_n) OVER (PARTITION BY metric), 1e-6) AS c FROM binned),
psi AS (SELECT metric, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY metric),
rates AS (SELECT avg(is_late_delivery) FILTER (win = 'reference') AS reference_late_rate,
                 avg(is_late_delivery) FILTER (win = 'current') AS current_late_rate FROM windowed),
auc_rows AS (SELECT win, p AS s, is_late_delivery AS y FROM windowed WHERE win = 'current'),
""" + metrics_sql("auc_rows", "win").strip() + """,
monitor AS (
  SELECT (SELECT psi FROM psi WHERE metric = 'score') AS score_psi,
         (SELECT max(psi) FROM psi WHERE metric <> 'score') AS max_feature_psi,
         (SELECT roc_auc FROM metrics) AS current_auc, reference_late_rate, current_late_rate,
         abs(current_late_rate - reference_late_rate) AS label_drift FROM rates),
verdict AS (
  SELECT *, score_psi > 0.2 OR max_feature_psi > 0.2 AS drift_detected, current_auc < 0.65 AS performance_low
  FROM monitor)"""

FALLBACK = FEATURES + """,
by_model AS (SELECT *, price_std / (price_std + price_mean) AS model_p FROM features),
scored AS (
  SELECT *, CASE WHEN model_p IS NOT NULL THEN greatest(least(model_p, 1e0), 0e0)
    ELSE least(greatest(CAST(0.06 AS DOUBLE) + CAST(0.018 AS DOUBLE) * estimated_delivery_days
    + CAST(0.0012 AS DOUBLE) * freight_sum
    + CAST(0.012 AS DOUBLE) * CAST(purchase_hour >= 18 AS INTEGER), CAST(0.01 AS DOUBLE)), CAST(0.98 AS DOUBLE)) END AS p,
    CASE WHEN model_p IS NOT NULL THEN 'model' ELSE 'baseline_fallback' END AS scored_by
  FROM by_model)"""

REQUESTS = """
requests AS (SELECT event_id, CAST(user_id AS VARCHAR) AS request_id, 'POST' AS method, event_type AS endpoint,
                    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS latency_ms, ts
             FROM events)"""

RUNS = """
runs AS (
  SELECT event_id AS e, md5(CAST(event_id AS VARCHAR)) AS new_commit, md5(CAST(event_id - 1 AS VARCHAR)) AS old_commit,
         strftime(ts - to_seconds(event_id % 120), '%Y-%m-%dT%H:%M:%SZ') AS started_at,
         CASE WHEN event_id % 29 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE 'not a time' END AS finished_at,
         CASE WHEN event_id % 29 <> 0 THEN CAST(epoch(date_trunc('second', ts)) AS DOUBLE) ELSE 0e0 END AS finished_s,
         CAST(CASE WHEN event_id % 31 <> 0 THEN event_id % 120 ELSE 0 END AS INTEGER) AS duration_seconds,
         'app/m' || (event_id % 7) || '.py,tests/t' || (event_id % 3) || '.py' AS changed_paths,
         ['success', 'tests_failed', 'success', 'ff_failed', 'error', 'fetch_failed'][1 + event_id % 6] AS status,
         ['ok', 'no', 'failed', 'unconfirmed'][1 + event_id % 4] AS restart,
         CASE WHEN event_id % 3 = 0 THEN 'queued' ELSE 'no' END AS trigger,
         ['ok', 'no', 'no', 'FAILED'][1 + event_id % 4] AS import,
         CASE WHEN event_id % 3 = 0 THEN 'retrain__' || event_id END AS dag_run_id, 'host' || (event_id % 4) AS host
  FROM events),
outcomes AS (
  SELECT e * 2 + nth AS position, CASE WHEN e % 11 <> 0 THEN 'retrain__' || e END AS dag_run_id,
         md5(CAST(e AS VARCHAR)) AS deploy_commit,
         CASE WHEN nth = 0 THEN ['success', 'failed', 'timeout'][1 + e % 3] ELSE 'success' END AS state
  FROM (SELECT event_id AS e, unnest(range(0, 1 + event_id % 2)) AS nth FROM events
        WHERE event_id % 3 = 0 AND event_id % 9 <> 0)),
last_outcome AS (SELECT dag_run_id, arg_max(state, position) AS state, arg_max(deploy_commit, position) AS deploy_commit
                 FROM outcomes WHERE dag_run_id IS NOT NULL GROUP BY dag_run_id),
reconciled AS (
  SELECT r.*, CASE WHEN r.dag_run_id IS NULL THEN NULL ELSE coalesce(o.state, 'running') END AS retrain_state
  FROM runs r LEFT JOIN last_outcome o USING (dag_run_id)),
tail AS (SELECT * FROM reconciled ORDER BY e DESC LIMIT 20)"""


def _cells(columns, select) -> str:
    return " UNION ALL ".join(select(c) for c in columns)


MEDIANS = FEATURES + """,
medians AS (SELECT feature, median(v) AS median FROM (""" + _cells(
    NUMBER_FEATURES, lambda c: f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM features") + """)
  WHERE v IS NOT NULL GROUP BY feature)"""

CHECKED = FEATURES + """,
checked AS (
  SELECT order_id AS record_id, order_id % 71 = 0 AS unreadable,
    list_sort([x FOR x IN [
      CASE WHEN order_id % 73 = 0 THEN 'unknown:coupon' END,
      CASE WHEN order_id % 97 = 1 THEN 'unknown:is_late_delivery' END,
      CASE WHEN order_id % 79 = 0 THEN 'type:payment_count' END,
      CASE WHEN order_id % 83 = 0 THEN 'missing:price_sum' END,
      CASE WHEN order_id % 89 = 0 THEN 'range:purchase_hour' END] IF x IS NOT NULL]) AS broken,
    CASE WHEN order_id % 97 = 1 AND order_id % 71 <> 0 THEN 'is_late_delivery' ELSE '' END AS outcome_fields
  FROM features),
judged AS (SELECT record_id, outcome_fields,
                  CASE WHEN unreadable THEN ['unreadable'] ELSE broken END AS broken FROM checked)"""

_STEP = {
    "New commit": ("'ok'", "''"),
    "Fast-forward": ("CASE WHEN status = 'ff_failed' THEN 'failed' ELSE 'ok' END", "''"),
    "Test gate": ("CASE status WHEN 'ff_failed' THEN 'skipped' WHEN 'tests_failed' THEN 'failed' ELSE 'ok' END", "''"),
    "Retrain": ("CASE retrain_state WHEN 'success' THEN 'ok' WHEN 'failed' THEN 'failed' WHEN 'timeout' THEN 'warn' "
                "WHEN 'running' THEN 'running' ELSE 'skipped' END", "coalesce(retrain_state, 'not run')"),
}
for _name, _key in (("Restart API", "restart"), ("Trigger Airflow", "trigger"), ("Import Grafana", "import")):
    _STEP[_name] = (f"""CASE WHEN status IN ('ff_failed', 'tests_failed') OR lower({_key}) = 'no' THEN 'skipped'
      WHEN lower({_key}) LIKE '%fail%' THEN 'failed' WHEN lower({_key}) = 'ok' THEN 'ok'
      WHEN lower({_key}) = 'queued' THEN 'queued' ELSE 'warn' END""", _key)

BOUNDS = (5e-3, 1e-2, 2.5e-2, 5e-2, 7.5e-2, 1e-1, 2.5e-1, 5e-1, 7.5e-1, 1.0, 2.5, 5.0, 7.5, 10.0)
LATENCY = REQUESTS + """,
bounds AS (SELECT unnest([""" + ", ".join(f"CAST({b!r} AS DOUBLE)" for b in BOUNDS) + """]) AS hi,
                  unnest(range(1, 15)) AS place),
spans AS (SELECT hi, place, coalesce(lag(hi) OVER (ORDER BY place), 0e0) AS lo FROM bounds),
hist AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, hi, lo, place,
                count(*) FILTER (latency_ms / 1000 <= hi) AS upto,
                count(*) FILTER (latency_ms / 1000 > lo AND latency_ms / 1000 <= hi OR place = 1 AND latency_ms / 1000 <= hi) AS inside,
                count(*) AS n
         FROM requests, spans WHERE latency_ms IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, q, n * q AS rank FROM hist, (SELECT unnest([CAST(0.5 AS DOUBLE), CAST(0.95 AS DOUBLE), CAST(0.99 AS DOUBLE)]) AS q)),
found AS (SELECT w, n, q, coalesce(min_by(lo + (hi - lo) * (rank - (upto - inside)) / inside, place)
                 FILTER (upto >= rank), 10e0) AS v FROM ranked GROUP BY w, n, q),
quantiles AS (SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
                     strftime(w + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, w, n,
                     round(max(v) FILTER (q = 0.5), 6) AS p50, round(max(v) FILTER (q = 0.95), 6) AS p95,
                     round(max(v) FILTER (q = 0.99), 6) AS p99
              FROM found GROUP BY w, n)"""


def rates_sql(source: str, key: str, ts: str) -> str:
    return f"""
SELECT {key}, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS events,
       round(count(*) / 300e0, 6) AS per_second
FROM (SELECT {key}, time_bucket(INTERVAL 1 MINUTE, {ts}) - to_minutes(unnest(range(0, 5))) AS w FROM {source})
GROUP BY {key}, w"""


IMPORTANCE = WINDOWED + """,
valid AS (SELECT order_id, p, is_late_delivery AS y, CAST(estimated_delivery_days AS DOUBLE) AS eta, freight_sum AS fr,
                 CAST(purchase_hour AS DOUBLE) AS hr FROM windowed WHERE win = 'current'),
mixed AS (
  SELECT valid.*, r, lead(eta, 1) OVER w AS eta2, lead(fr, 1) OVER w AS fr2, lead(hr, 1) OVER w AS hr2,
         first_value(eta) OVER w AS eta1, first_value(fr) OVER w AS fr1, first_value(hr) OVER w AS hr1
  FROM valid, (SELECT unnest(range(42, 47)) AS r)
  WINDOW w AS (PARTITION BY r ORDER BY md5(order_id || '|' || r), order_id)),
swapped AS (
  SELECT r, feature, y, CASE WHEN feature = 'estimated_delivery_days' THEN coalesce(eta2, eta1) ELSE eta END AS eta,
         CASE WHEN feature = 'freight_sum' THEN coalesce(fr2, fr1) ELSE fr END AS fr,
         CASE WHEN feature = 'purchase_hour' THEN coalesce(hr2, hr1) ELSE hr END AS hr
  FROM mixed, (SELECT unnest(['estimated_delivery_days', 'freight_sum', 'purchase_hour']) AS feature)),
rescored AS (
  SELECT feature || ':' || r AS g, feature, y, least(greatest(CAST(0.06 AS DOUBLE) + CAST(0.018 AS DOUBLE) * eta
    + CAST(0.0012 AS DOUBLE) * fr + CAST(0.012 AS DOUBLE) * CAST(hr >= 18 AS INTEGER), CAST(0.01 AS DOUBLE)),
    CAST(0.98 AS DOUBLE)) AS s FROM swapped
  UNION ALL SELECT 'base', 'base', y, p FROM valid),
""" + metrics_sql("rescored", "g").strip() + """,
base AS (SELECT roc_auc AS a FROM metrics WHERE g = 'base'),
moved AS (SELECT split_part(g, ':', 1) AS feature, avg(a - roc_auc) AS d, stddev_pop(a - roc_auc) AS sd
          FROM metrics, base WHERE g <> 'base' GROUP BY 1)"""

ORACLE = {
    "raw_load": """
SELECT 'orders' AS table_name, count(*) AS "rows" FROM orders
UNION ALL SELECT 'order_items', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'customers', count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'sellers', count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION ALL SELECT 'products', count(*) FROM part
UNION ALL SELECT 'order_payments', CAST(sum(1 + o_orderkey % 2) AS BIGINT) FROM orders WHERE o_orderkey % 61 <> 0
UNION ALL SELECT 'order_reviews', count(*) FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'product_category_name_translation', count(DISTINCT p_type) FROM part""",
    "csv_orders": q(RAW, f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
       {STAMP.format(c='bought')} AS order_purchase_timestamp, {STAMP.format(c='approved')} AS order_approved_at,
       {STAMP.format(c='collected')} AS order_delivered_carrier_date, {STAMP.format(c='arrived')} AS order_delivered_customer_date,
       {STAMP.format(c='promised')} AS order_estimated_delivery_date FROM raw_orders"""),
    "csv_reviews": q(RAW, f"""
SELECT 'r' || k AS review_id, CAST(k AS VARCHAR) AS order_id, CAST(1 + k % 5 AS INTEGER) AS review_score,
       CASE WHEN k % 3 = 0 THEN 'title, ' || k END AS review_comment_title,
       CASE WHEN k % 4 = 0 THEN 'said "ok"' || chr(10) || 'line ' || k END AS review_comment_message,
       {STAMP.format(c='arrived + to_days(1)')} AS review_creation_date,
       {STAMP.format(c='arrived + to_days(CAST(2 + k % 3 AS INTEGER))')} AS review_answer_timestamp
FROM raw_orders WHERE arrived IS NOT NULL"""),
    "features_from_csv": q(FEATURES, f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, is_late_delivery, {FEATURE_LIST} FROM features"""),
    "feature_snapshot": q(FEATURES, f"""
SELECT order_id, is_late_delivery, {STAMP.format(c='purchase_ts')} AS purchase_ts, {FEATURE_LIST} FROM features"""),
    "first_feature_rows": q(FEATURES, f"SELECT order_id, {FEATURE_LIST} FROM features ORDER BY features.order_id LIMIT 100"),
    "deploy_log": q(RUNS, """
SELECT new_commit[1:7] || '-' || finished_at AS run_id, started_at, finished_at, duration_seconds, 'main' AS branch,
       old_commit, new_commit, changed_paths, status, restart, trigger, import, dag_run_id, host FROM runs"""),
    "order_features": q(FEATURES, f"""
SELECT order_id, is_late_delivery, {STAMP.format(c='purchase_ts')} AS purchase_ts, {FEATURE_LIST} FROM features"""),
    "delivered_orders": q(PER_ORDER, f"""
SELECT order_id, {STAMP.format(c='bought')} AS order_purchase_timestamp,
       {STAMP.format(c='approved')} AS order_approved_at, {STAMP.format(c='arrived')} AS order_delivered_customer_date,
       {STAMP.format(c='promised')} AS order_estimated_delivery_date FROM kept_orders"""),
    "priced_lines": q(LINES, f"""
SELECT order_id, price, freight AS freight_value, round(total_cost, 6) AS total_cost,
       {STAMP.format(c='deadline')} AS shipping_limit_date, weight AS product_weight_g, len AS product_length_cm,
       hgt AS product_height_cm, wid AS product_width_cm, volume AS product_volume FROM lines"""),
    "item_measures": q(PER_ORDER, f"""
SELECT order_id, order_item_count, {rounded(*[c for c in sorted(FLOATS) if c.split('_')[0] in
       ('price', 'freight', 'total', 'product')])}, {STAMP.format(c='first_deadline')} AS shipping_limit_min,
       {STAMP.format(c='last_deadline')} AS shipping_limit_max FROM measures"""),
    "item_values": q(PER_ORDER, "SELECT * FROM item_vals"),
    "payment_profile": q(PER_ORDER, "SELECT order_id, payment_count, payment_type_mode, "
                                    "CAST(max_installments AS INTEGER) AS max_installments FROM pays"),
    "purchase_calendar": q(RAW, f"SELECT order_id, {CALENDAR} FROM raw_orders"),
    "delivery_windows": q(PER_ORDER, f"""
SELECT order_id, CAST(arrived > promised AS INTEGER) AS is_late_delivery, estimated_delivery_days,
       round(approval_delay_hours, 6) AS approval_delay_hours, shipping_limit_min_days, shipping_window_days,
       seller_margin_days
FROM (SELECT o.*, {WINDOWS} FROM kept_orders o JOIN measures m ON m.order_id = o.order_id)"""),
    "category_mix": q(FEATURES, """
SELECT is_multi_category, count(*) AS orders, round(avg(is_late_delivery), 6) AS late_rate
FROM features GROUP BY is_multi_category"""),
    "label_balance": q(FEATURES, """
SELECT round(avg(is_late_delivery), 6) AS late_rate, CAST(sum(is_late_delivery) AS BIGINT) AS late,
       count(*) AS total FROM features"""),
    "quarantined_records": q(CHECKED, """
SELECT record_id, array_to_string(broken, ',') AS violations, outcome_fields FROM judged WHERE len(broken) > 0"""),
    "accepted_records": q(CHECKED, f"""
SELECT record_id, CAST(order_id AS VARCHAR) AS order_id, {FEATURE_LIST}
FROM judged JOIN features ON order_id = record_id WHERE len(broken) = 0"""),
    "violation_counts": q(CHECKED, """
SELECT violation, count(*) AS records FROM (SELECT unnest(broken) AS violation FROM judged) GROUP BY violation"""),
    "feature_row_checks": q(FEATURES, """
SELECT count(*) AS "rows", count(*) FILTER (price_sum < 0 OR freight_sum < 0 OR estimated_delivery_days > 365
       OR price_sum IS NULL OR freight_sum IS NULL OR shipping_limit_min_days IS NULL) AS rejected FROM features"""),
    "temporal_cut": q(WINDOWED, """
SELECT strftime(make_timestamp((SELECT cut_us FROM cut)), '%Y-%m-%d %H:%M:%S') AS split_ts,
       count(*) FILTER (win = 'reference') AS train, count(*) FILTER (win = 'current') AS valid FROM windowed"""),
    "temporal_split": q(WINDOWED, f"""
SELECT order_id, {STAMP.format(c='purchase_ts')} AS purchase_ts, win AS "window" FROM windowed"""),
    "numeric_medians": q(MEDIANS, "SELECT feature, round(median, 6) AS median FROM medians"),
    "feature_scales": q(MEDIANS, """
SELECT feature, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM (""" + _cells(
        NUMBER_FEATURES, lambda c: f"SELECT '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), "
        f"(SELECT median FROM medians WHERE feature = '{c}')) AS v FROM features") + ") GROUP BY feature"),
    "category_folding": q(FEATURES, """
SELECT feature, category, count(*) AS "rows",
       CASE WHEN count(*) < 20 THEN '__infrequent__' ELSE category END AS encoded_as
FROM (""" + _cells([*TEXT_FEATURES, "seller_zip_mode"],
                   lambda c: f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM features") + """)
GROUP BY feature, category"""),
    "class_weights": q(FEATURES, """
SELECT is_late_delivery, count(*) AS "rows",
       round((SELECT count(*) FROM features) / (2e0 * count(*)), 6) AS weight FROM features GROUP BY is_late_delivery"""),
    "baseline_predictions": q(SCORED, f"""
SELECT order_id, round(round_even(p * 1e6, 0) / 1e6, 6) AS late_delivery_probability, risk_level,
       {ACTION.format(level='risk_level')} AS recommended_action, 'reference-baseline' AS model_version
FROM (SELECT *, {LEVEL.format(p='p')} AS risk_level FROM scored)"""),
    "fallback_predictions": q(FALLBACK, f"""
SELECT order_id, round(round_even(p * 1e6, 0) / 1e6, 6) AS late_delivery_probability, risk_level,
       {ACTION.format(level='risk_level')} AS recommended_action, 'model' AS model_version, scored_by
FROM (SELECT *, {LEVEL.format(p='p')} AS risk_level FROM scored)"""),
    "risk_distribution": q(SCORED, f"""
SELECT risk_level, count(p) AS orders, round(avg(p), 6) AS mean_score
FROM (SELECT unnest(['low', 'medium', 'high']) AS risk_level)
LEFT JOIN (SELECT p, {LEVEL.format(p='p')} AS risk_level FROM scored) USING (risk_level) GROUP BY risk_level"""),
    "window_metrics": q(WINDOWED + ", rated AS (SELECT win, p AS s, is_late_delivery AS y FROM windowed), "
                        + metrics_sql("rated", "win").strip(), f"""
SELECT win AS "window", {rounded('pr_auc', 'roc_auc', 'brier', 'f1_at_0_5', 'val_positive_rate')}, "rows" FROM metrics"""),
    "category_metrics": q(SCORED + ", rated AS (SELECT product_category_mode, p AS s, is_late_delivery AS y FROM scored), "
                          + metrics_sql("rated", "product_category_mode").strip(), f"""
SELECT product_category_mode, {rounded('pr_auc', 'roc_auc', 'brier', 'f1_at_0_5', 'val_positive_rate')}, "rows"
FROM metrics"""),
    "score_leaderboard": q(WINDOWED + """,
rated AS (
  SELECT 'baseline' AS candidate, p AS s, is_late_delivery AS y FROM windowed WHERE win = 'current'
  UNION ALL SELECT 'short_promise', 1e0 / estimated_delivery_days, is_late_delivery FROM windowed WHERE win = 'current'
  UNION ALL SELECT 'constant', 5e-1, is_late_delivery FROM windowed WHERE win = 'current'),
""" + metrics_sql("rated", "candidate").strip(), f"""
SELECT candidate, {rounded('pr_auc', 'roc_auc', 'brier', 'f1_at_0_5', 'val_positive_rate')}, "rows",
       metrics.pr_auc = (SELECT max(pr_auc) FROM metrics) AS winner FROM metrics"""),
    "psi_edges": q(LONG, "SELECT metric, position, round(edge, 6) AS edge FROM edges"),
    "psi_histogram": q(LONG, "SELECT metric, bin, reference_n, current_n FROM binned"),
    "psi_by_metric": q(LONG, "SELECT metric, round(psi, 6) AS psi, isnan(psi) AS psi_undefined FROM psi"),
    "label_drift": q(LONG, f"SELECT {rounded('reference_late_rate', 'current_late_rate', 'label_drift')} FROM monitor"),
    "retrain_decision": q(LONG, f"""
SELECT {rounded('score_psi', 'max_feature_psi', 'current_auc')}, drift_detected, performance_low,
       drift_detected OR performance_low AS retrain_recommended,
       coalesce(nullif(concat_ws(',', CASE WHEN verdict.score_psi > 0.2 THEN 'score_psi>threshold' END,
         CASE WHEN verdict.max_feature_psi > 0.2 THEN 'feature_psi>threshold' END,
         CASE WHEN performance_low THEN 'auc<min' END), ''), 'within_thresholds') AS reasons FROM verdict"""),
    "monitoring_metrics": q(LONG, "".join(
        f"SELECT '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value FROM verdict UNION ALL "
        for m in ("score_psi", "max_feature_psi", "current_auc", "reference_late_rate", "current_late_rate",
                  "label_drift", "drift_detected", "performance_low")) + """
SELECT 'retrain_recommended', CAST(drift_detected OR performance_low AS DOUBLE) FROM verdict
UNION ALL SELECT 'psi_' || metric, round(psi, 6) FROM psi WHERE metric <> 'score'"""),
    "monitor_report": q(LONG, """
SELECT 'reference-baseline' AS model_version,
       (SELECT CASE WHEN cut_us % 1000000 = 0 THEN strftime(make_timestamp(cut_us), '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(make_timestamp(cut_us), '%Y-%m-%d %H:%M:%S.%f') END FROM cut) AS split_ts,
       0.2::DOUBLE AS psi_limit,
       0.65::DOUBLE AS min_auc, 17 AS metric_count,
       coalesce(nullif(concat_ws(',', CASE WHEN score_psi > 0.2 THEN 'score_psi>threshold' END,
         CASE WHEN max_feature_psi > 0.2 THEN 'feature_psi>threshold' END,
         CASE WHEN performance_low THEN 'auc<min' END), ''), 'within_thresholds') AS reasons FROM verdict"""),
    "feature_importance": q(IMPORTANCE, """
SELECT feature, round(coalesce(d, 0), 6) AS auc_drop, round(coalesce(sd, 0), 6) AS auc_drop_std
FROM (SELECT unnest([""" + ", ".join(f"'{f}'" for f in (*NUMBER_FEATURES, *TEXT_FEATURES)) + """]) AS feature)
LEFT JOIN moved USING (feature)"""),
    "last_outcomes": q(RUNS, "SELECT * FROM last_outcome"),
    "reconciled_runs": q(RUNS, "SELECT new_commit, status, dag_run_id, retrain_state FROM reconciled"),
    "recent_runs": q(RUNS, "SELECT new_commit, finished_at, status, dag_run_id FROM tail"),
    "all_runs_newest_first": q(RUNS, "SELECT new_commit, finished_at, status, dag_run_id FROM runs ORDER BY e DESC"),
    "deploy_snapshot": q(RUNS, """
SELECT status, CAST(NULL AS VARCHAR) AS message, new_commit, finished_at, dag_run_id, retrain_state,
       (SELECT count(*) FROM tail) AS total_recorded FROM tail ORDER BY e DESC LIMIT 1"""),
    "latest_retrain": q(RUNS, """
SELECT dag_run_id, retrain_state AS state, new_commit AS deploy_commit FROM tail
WHERE dag_run_id IS NOT NULL ORDER BY e DESC LIMIT 1"""),
    "deploy_steps": q(RUNS, " UNION ALL ".join(
        f"SELECT new_commit, '{name}' AS name, {state} AS state, {detail} AS detail FROM reconciled"
        for name, (state, detail) in _STEP.items())),
    "deploy_gauges": q(RUNS, """,
newest AS (SELECT * FROM tail ORDER BY e DESC LIMIT 1),
queued AS (SELECT * FROM tail WHERE dag_run_id IS NOT NULL ORDER BY e DESC LIMIT 1)
SELECT CAST(n.status = 'success' AS INTEGER) AS last_status, n.finished_s AS last_timestamp_seconds,
       18e8 - n.finished_s AS last_age_seconds, CAST(n.duration_seconds AS DOUBLE) AS last_duration_seconds,
       n.new_commit[1:7] AS last_commit, n.status AS last_status_label, q.retrain_state AS retrain_state,
       q.dag_run_id AS retrain_run_id, (SELECT count(*) FROM tail) AS runs_total,
       CAST(q.retrain_state = 'success' AS INTEGER) AS last_retrain_status FROM newest n, queued q"""),
    "run_times": q(RUNS, "SELECT new_commit, new_commit[1:7] AS short_commit, finished_s FROM runs"),
    "request_totals": q(REQUESTS, "SELECT method, endpoint, status, count(*) AS requests FROM requests GROUP BY ALL"),
    "error_totals": q(REQUESTS, """
SELECT endpoint, status, count(*) AS errors FROM requests WHERE status >= 400 GROUP BY ALL"""),
    "latency_stats": q(REQUESTS, """
SELECT endpoint, count(*) AS count, round(sum(latency_ms) / 1000, 6) AS sum_seconds,
       round(sum(latency_ms) / 1000 / count(*), 6) AS avg_seconds FROM requests GROUP BY endpoint"""),
    "risk_counts": q(FALLBACK, f"""
SELECT risk_level, count(p) AS predictions FROM (SELECT unnest(['low', 'medium', 'high']) AS risk_level)
LEFT JOIN (SELECT p, {LEVEL.format(p='p')} AS risk_level FROM scored) USING (risk_level) GROUP BY risk_level"""),
    "scoring_errors": q(FALLBACK, """
SELECT count(*) FILTER (scored_by = 'baseline_fallback') AS scoring_errors FROM scored"""),
    "prediction_requests": q(REQUESTS, """
SELECT endpoint, count(*) AS requests FROM requests WHERE endpoint IN ('purchase', 'click') AND status <> 422
GROUP BY endpoint"""),
    "service_summary": q(FALLBACK + "," + REQUESTS, f"""
SELECT 'totals' AS section, 'total_predictions' AS key, CAST(count(*) AS DOUBLE) AS value FROM scored
UNION ALL SELECT 'totals', 'scoring_errors', count(*) FILTER (scored_by = 'baseline_fallback') FROM scored
UNION ALL SELECT 'risk_distribution', l, count(p) FROM (SELECT unnest(['low', 'medium', 'high']) AS l)
  LEFT JOIN (SELECT p, {LEVEL.format(p='p')} AS l FROM scored) USING (l) GROUP BY l
UNION ALL SELECT 'requests_by_endpoint', endpoint, count(*) FROM requests
  WHERE endpoint IN ('purchase', 'click') GROUP BY endpoint
UNION ALL SELECT 'http', 'requests_total', count(*) FROM requests
UNION ALL SELECT 'http', 'errors_total', count(*) FILTER (status >= 400) FROM requests
UNION ALL SELECT 'prediction_latency', 'count', count(*) FROM requests WHERE endpoint IN ('purchase', 'click')
UNION ALL SELECT 'prediction_latency', 'sum_seconds', round(sum(latency_ms) / 1000, 6) FROM requests WHERE endpoint IN ('purchase', 'click')
UNION ALL SELECT 'prediction_latency', 'avg_seconds', round(sum(latency_ms) / 1000 / count(*), 6) FROM requests WHERE endpoint IN ('purchase', 'click')
UNION ALL SELECT 'http_latency', 'count', count(*) FROM requests
UNION ALL SELECT 'http_latency', 'sum_seconds', round(sum(latency_ms) / 1000, 6) FROM requests
UNION ALL SELECT 'http_latency', 'avg_seconds', round(sum(latency_ms) / 1000 / count(*), 6) FROM requests"""),
    "endpoint_rates": q(REQUESTS, rates_sql("requests", "endpoint", "ts")),
    "error_rates": q(REQUESTS, rates_sql("(SELECT * FROM requests WHERE status >= 400)", "status", "ts")),
    "risk_rates": q(FALLBACK, rates_sql(f"(SELECT purchase_ts, {LEVEL.format(p='p')} AS risk_level FROM scored)",
                                        "risk_level", "purchase_ts")),
    "latency_quantiles": q(LATENCY, "SELECT window_start, window_end, n, p50, p95, p99 FROM quantiles"),
    "stream_deduplicated": q(REQUESTS, "SELECT event_id, endpoint, status, latency_ms FROM requests"),
    "stream_rates": q(REQUESTS, """
SELECT endpoint, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS events,
       round(count(*) / 300e0, 6) AS per_second
FROM (SELECT endpoint, time_bucket(INTERVAL 5 MINUTE, ts) AS w FROM requests) GROUP BY endpoint, w"""),
    "stream_latency": q(LATENCY, "SELECT window_start, window_end, n, p50, p95, p99 FROM quantiles"),
    "stream_reconciled_runs": q(RUNS, "SELECT new_commit, status, dag_run_id, retrain_state FROM reconciled"),
    "stream_arrivals": """
WITH sent AS (SELECT event_id, ts, unnest(CASE WHEN event_id % 10 = 3 THEN [once, least(once + 1, 2)] ELSE [once] END) AS delivery
    FROM (SELECT event_id, ts, least((day(ts) - 1) // 10 + CASE WHEN event_id % 50 = 7 THEN 1 ELSE 0 END, 2) AS once FROM events)),
marks AS (SELECT d AS delivery, (SELECT max(ts) FROM sent WHERE delivery < d) - INTERVAL 10 MINUTE AS mark FROM (SELECT unnest([0, 1, 2]) AS d)),
judged AS (SELECT event_id, delivery, coalesce(ts < mark, false) AS late FROM sent JOIN marks USING (delivery))
SELECT event_id, CAST(delivery AS INTEGER) AS delivery, CASE WHEN late THEN 'late'
       WHEN row_number() OVER (PARTITION BY event_id, late ORDER BY delivery) > 1 THEN 'repeat' ELSE 'kept' END AS fate FROM judged""",
    "stream_model_change": q(CHECKED, """
SELECT record_id, CASE WHEN record_id % 2 = 0 THEN 'late:past' ELSE 'late:all' END AS model_version,
       CASE WHEN len(broken) = 0 THEN 'model' END AS scored_by, CASE WHEN len(broken) = 0 THEN 'accepted' ELSE 'quarantined' END AS outcome,
       len(broken) = 0 AS has_score, CASE WHEN len(broken) = 0 THEN true END AS band_agrees FROM judged"""),
    "stream_scoring": q(CHECKED + """,
final AS (SELECT record_id, f.*, broken FROM judged JOIN features f ON f.order_id = record_id),
scored AS (SELECT *, CASE WHEN len(broken) = 0 THEN
    least(greatest(CAST(0.06 AS DOUBLE) + CAST(0.018 AS DOUBLE) * estimated_delivery_days
    + CAST(0.0012 AS DOUBLE) * freight_sum
    + CAST(0.012 AS DOUBLE) * CAST(purchase_hour >= 18 AS INTEGER), CAST(0.01 AS DOUBLE)), CAST(0.98 AS DOUBLE)) END AS p
  FROM final)""", f"""
SELECT record_id, CASE WHEN broken <> ['unreadable'] THEN CAST(order_id AS VARCHAR) END AS order_id,
       round(round_even(p * 1e4, 0) / 1e4, 6) AS late_delivery_probability, risk_level,
       CASE WHEN p IS NOT NULL THEN {ACTION.format(level='risk_level')} END AS recommended_action,
       'reference-baseline' AS model_version, CASE WHEN p IS NOT NULL THEN 'baseline' END AS scored_by,
       CASE WHEN p IS NOT NULL THEN 'accepted' ELSE 'quarantined' END AS outcome,
       array_to_string(broken, ',') AS violations
FROM (SELECT *, CASE WHEN p IS NOT NULL THEN {LEVEL.format(p='p')} END AS risk_level FROM scored)"""),
}

_PLACES = [*NUMBER_FEATURES[:1], "payment_type_mode", *NUMBER_FEATURES[1:17], "product_category_mode",
           *NUMBER_FEATURES[17:28], "seller_state_mode", *NUMBER_FEATURES[28:],
           "order_id", "is_late_delivery", "purchase_ts"]
ORACLE["contract_columns"] = q(FEATURES, " UNION ALL ".join(
    f"SELECT {i} AS place, '{c}' AS column_name, count({c}) AS present FROM features" for i, c in enumerate(_PLACES)))

ORACLE |= {"logged_request_totals": ORACLE["request_totals"], "logged_error_totals": ORACLE["error_totals"], "logged_summary": ORACLE["service_summary"],
           "logged_latency_quantiles": ORACLE["latency_quantiles"], "logged_risk_rates": ORACLE["risk_rates"],
           "stream_error_rates": ORACLE["error_rates"], "stream_risk_rates": ORACLE["risk_rates"]}

_REASONS = """coalesce(nullif(concat_ws(',', CASE WHEN score_psi > 0.2 THEN 'score_psi>threshold' END,
         CASE WHEN max_feature_psi > 0.2 THEN 'feature_psi>threshold' END,
         CASE WHEN performance_low THEN 'auc<min' END), ''), 'within_thresholds')"""
ORACLE |= {
    "incremental_features": ORACLE["order_features"],
    "score_overview": q(SCORED, f"""
SELECT count(*) AS orders, round(avg(p), 6) AS mean_score, count(*) FILTER (l = 'low') AS low, count(*) FILTER (l = 'medium') AS medium,
       count(*) FILTER (l = 'high') AS high FROM (SELECT p, {LEVEL.format(p='p')} AS l FROM scored)"""),
    "written_report": q(LONG + ",\nmeasured AS (" + ORACLE["monitoring_metrics"].removeprefix("WITH " + LONG.strip()) + ")", f"""
SELECT 'reference-baseline' AS model_version, 0.2::DOUBLE AS psi_limit, drift_detected, performance_low,
       drift_detected OR performance_low AS retrain_recommended, {_REASONS} AS reasons, metric, value FROM verdict, measured"""),
    "sketch_ranks": "SELECT unnest(['score', " + ", ".join(f"'{d}'" for d in DRIFT) + "]) AS metric, p AS position, true AS within "
                    "FROM (SELECT unnest(range(0, 11))::INTEGER AS p)",
    "model_board_checks": q(WINDOWED, """
SELECT unnest(['logistic_regression', 'histogram_boosting', 'balanced_forest']) AS candidate, count(*) AS "rows",
       round(avg(is_late_delivery), 6) AS val_positive_rate, true AS in_range, true AS winner_is_best FROM windowed WHERE win = 'current'"""),
    "model_prediction_checks": q(FEATURES, """
SELECT order_id, unnest(['logistic_regression', 'histogram_boosting', 'balanced_forest']) AS model_version, 'model' AS scored_by,
       true AS in_range, true AS band_agrees, true AS action_agrees FROM features"""),
    "sketched_decision": q(LONG, f"""
SELECT drift_detected, performance_low, drift_detected OR performance_low AS retrain_recommended, {_REASONS} AS reasons FROM verdict"""),
}
