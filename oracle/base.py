"""Common table expressions and number helpers for the oracle queries."""


def dec(x: str, places: int = 10) -> str:
    return f"CAST({x} AS DECIMAL(28,{places}))"


def fsum(x: str) -> str:
    """Order-free sum as double."""
    return f"CAST(SUM({dec(x)}) AS DOUBLE)"


def favg(x: str) -> str:
    return f"(CAST(SUM({dec(x)}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def rnd(x: str, d: int) -> str:
    """Half-up rounding that is exact on ties: go through a decimal with spare digits."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,{d + 5})), {d}) AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


SILVER_TX = """
goods AS (
  SELECT l_orderkey, MIN(p_brand) AS merchant, MIN(p_type) AS category
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
),
silver_base AS (
  SELECT 'evt_' || o_orderkey AS event_id, 'user_' || o_custkey AS user_id, o_orderdate AS ts,
         CAST(o_orderdate AS DATE) AS date,
         CASE o_orderpriority
           WHEN '1-URGENT' THEN CASE WHEN o_orderstatus = 'F' THEN 'PAYMENT_FAILED' ELSE 'PAYMENT_MADE' END
           WHEN '2-HIGH' THEN 'PURCHASE_MADE' WHEN '3-MEDIUM' THEN 'TRANSFER_SENT'
           WHEN '4-NOT SPECIFIED' THEN 'MONEY_ADDED' WHEN '5-LOW' THEN 'USER_REGISTERED' END AS event,
         o_totalprice, c_acctbal - o_totalprice AS balance_after, merchant, category,
         CASE o_orderkey % 3 WHEN 0 THEN 'app' WHEN 1 THEN 'web' ELSE 'api' END AS channel,
         CASE o_orderkey % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'tablet' END AS device,
         c_name AS user_name, 'c' || o_custkey || '@mail.test' AS user_email,
         CAST(o_custkey % 60 + 18 AS INTEGER) AS user_age, c_mktsegment AS user_segment, n_name AS location_city
  FROM orders
  LEFT JOIN goods ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
),
silver AS (
  SELECT *, event = 'PAYMENT_FAILED' AS is_failed, event <> 'USER_REGISTERED' AS is_transactional,
         event IN ('PAYMENT_MADE', 'PURCHASE_MADE', 'TRANSFER_SENT') AS ok,
         CASE WHEN event <> 'USER_REGISTERED' THEN o_totalprice END AS amount_cop,
         CASE WHEN event <> 'USER_REGISTERED' THEN {usd} END AS amount_usd
  FROM silver_base
)
""".replace("{usd}", rnd("o_totalprice * (1.0::DOUBLE / 4150)", 4))


def mode_cte(name: str, column: str, where: str) -> str:
    return f"""
{name} AS (
  SELECT user_id, {column} AS v FROM (
    SELECT user_id, {column},
           ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, {column}) AS rn
    FROM silver WHERE {column} IS NOT NULL AND {where} GROUP BY user_id, {column}
  ) WHERE rn = 1
)"""


GOLD_USERS = ",".join([
    mode_cte("m_merchant", "merchant", "ok"), mode_cte("m_category", "category", "ok"),
    mode_cte("m_channel", "channel", "TRUE"), mode_cte("m_device", "device", "TRUE"),
]) + f""",
firsts AS (
  SELECT * FROM (
    SELECT user_id, user_name, user_email, user_age, user_segment, location_city AS city,
           ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id NULLS FIRST) AS rn FROM silver
  ) WHERE rn = 1
),
counts AS (
  SELECT user_id, COUNT(event_id) AS total_events, COUNT(*) FILTER (WHERE is_failed) AS failed_transactions,
         MAX(ts) AS last_event_date
  FROM silver GROUP BY user_id
),
tx AS (
  SELECT user_id, COUNT(event_id) AS total_transactions,
         {rnd('COALESCE(' + fsum('amount_cop') + ', 0.0)', 2)} AS total_amount_cop,
         {rnd('COALESCE(' + fsum('amount_usd') + ', 0.0)', 2)} AS total_amount_usd,
         {rnd(favg('amount_cop'), 2)} AS avg_ticket,
         MAX(ts) AS last_transaction_date
  FROM silver WHERE ok GROUP BY user_id
),
lasts AS (
  SELECT user_id, {rnd('balance_after', 2)} AS balance_current FROM (
    SELECT user_id, balance_after, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS LAST) AS rn
    FROM silver WHERE ok AND balance_after IS NOT NULL
  ) WHERE rn = 1
),
gold_user_360 AS (
  SELECT f.user_id, user_name, user_email, user_age, user_segment, city, total_events,
         COALESCE(total_transactions, 0) AS total_transactions, total_amount_cop, total_amount_usd, avg_ticket,
         failed_transactions,
         COALESCE({rnd('failed_transactions::DOUBLE / NULLIF(COALESCE(total_transactions, 0) + failed_transactions, 0)', 4)}, 0.0) AS failure_rate,
         balance_current, m_merchant.v AS top_merchant, m_category.v AS top_category,
         m_channel.v AS preferred_channel, m_device.v AS preferred_device,
         last_transaction_date, last_event_date,
         CAST(DATE '2001-08-02' - CAST(last_transaction_date AS DATE) AS BIGINT) AS days_since_last_tx
  FROM firsts f JOIN counts USING (user_id) LEFT JOIN tx USING (user_id) LEFT JOIN lasts USING (user_id)
  LEFT JOIN m_merchant ON m_merchant.user_id = f.user_id LEFT JOIN m_category ON m_category.user_id = f.user_id
  LEFT JOIN m_channel ON m_channel.user_id = f.user_id LEFT JOIN m_device ON m_device.user_id = f.user_id
)
"""

GOLD_DAILY = f"""
gold_daily_metrics AS (
  SELECT date, COUNT(event_id) AS total_events, COUNT(*) FILTER (WHERE is_transactional) AS total_transactions,
         {rnd('COALESCE(' + fsum('amount_cop') + ', 0.0)', 2)} AS total_amount_cop,
         COUNT(*) FILTER (WHERE is_failed) AS failed_count, COUNT(DISTINCT user_id) AS unique_users
  FROM silver WHERE date IS NOT NULL GROUP BY date
)
"""

GOLD_EVENTS = f"""
gold_event_summary AS (
  SELECT event, COUNT(event_id) AS count, COUNT(*) FILTER (WHERE NOT is_failed) AS success_count,
         COUNT(*) FILTER (WHERE is_failed) AS failed_count,
         {rnd('COUNT(event_id) * 100.0::DOUBLE / (SELECT COUNT(event_id) FROM silver WHERE event IS NOT NULL)', 2)} AS pct_of_total
  FROM silver WHERE event IS NOT NULL GROUP BY event
)
"""


def users(select: str) -> str:
    return f"WITH {SILVER_TX}, {GOLD_USERS} {select}"


def daily(select: str) -> str:
    return f"WITH {SILVER_TX}, {GOLD_DAILY} {select}"


def events(select: str) -> str:
    return f"WITH {SILVER_TX}, {GOLD_EVENTS} {select}"


def all_gold(ctes: str, select: str) -> str:
    """User and day tables together, plus further expressions."""
    return f"WITH {SILVER_TX}, {GOLD_USERS}, {GOLD_DAILY}, {GOLD_EVENTS} {ctes} {select}"
