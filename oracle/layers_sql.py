"""Oracle SQL for raw events, Bronze, Silver, messages, streams, checks, profiles and questions."""

from oracle.base import GOLD_USERS, GOLD_DAILY, GOLD_EVENTS, big, daily, dec, rnd, users, events as gold_events

BATCHES = """
ev AS (
  SELECT event_id AS n, ts, events.user_id AS u, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         props, c_name, c_acctbal, c_mktsegment, c_nationkey, n_name
  FROM events LEFT JOIN customer ON c_custkey = events.user_id LEFT JOIN nation ON n_nationkey = c_nationkey
),
numbered AS (
  SELECT 1 AS batch, n AS seq, CAST(NULL AS VARCHAR) AS nm, ev.* FROM ev
  UNION ALL
  SELECT 2, n * 2 + copy, CASE WHEN n % 30 = 7 THEN 'late-' || n END, ev.*
  FROM ev JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR n % 50 = 0 OR n % 90 = 7
  WHERE n % 10 = 0 OR n % 30 = 7
),
flat AS (
  SELECT batch, seq, n, 'payments.app' AS source, 'transaction' AS detailType,
    CASE WHEN n % 97 = 0 THEN NULL WHEN n % 13 = 0 THEN '  ' || COALESCE(nm, 'evt-' || n) || ' '
         ELSE COALESCE(nm, 'evt-' || n) END AS event_id,
    CASE event_type WHEN 'signup' THEN 'USER_REGISTERED' WHEN 'purchase' THEN 'PURCHASE_MADE'
      WHEN 'click' THEN 'PAYMENT_MADE' WHEN 'view' THEN 'TRANSFER_SENT' WHEN 'error' THEN 'PAYMENT_FAILED' END AS event,
    '1.0' AS event_version, 'business' AS event_type, event_type AS transaction_type, 'user' AS event_entity,
    CASE WHEN n % 89 = 0 THEN NULL WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS event_status,
    'user_' || u AS user_id, c_name AS user_name, CAST(u % 60 + 18 AS INTEGER) AS user_age,
    ' C' || u || '@Mail.Test ' AS user_email, CASE WHEN n % 7 <> 0 THEN n_name END AS user_city,
    c_mktsegment AS user_segment,
    CASE WHEN n % 101 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
    'acc_' || u AS account_id,
    CASE WHEN event_type = 'signup' THEN NULL WHEN n % 103 = 0 THEN 'n/a'
         ELSE CAST(CAST(ROUND(value * 1000) AS BIGINT) AS VARCHAR) END AS amount,
    'COP' AS currency,
    CASE WHEN event_type <> 'signup' THEN 'merchant_' || (k % 12) END AS merchant,
    CASE WHEN event_type <> 'signup' THEN 'category_' || (k % 5) END AS category,
    CASE WHEN n % 2 = 0 THEN 'card' ELSE 'cash' END AS payment_method,
    CASE WHEN n % 4 = 0 THEN NULL WHEN n % 107 = 0 THEN 'x' ELSE CAST(n % 12 + 1 AS VARCHAR) END AS installments,
    CAST(CAST(ROUND(c_acctbal * 1000) AS BIGINT) AS VARCHAR) AS balance_before,
    CAST(CAST(ROUND(c_acctbal * 1000) AS BIGINT) - CAST(ROUND(value * 1000) AS BIGINT) AS VARCHAR) AS balance_after,
    CASE WHEN event_type = 'signup' THEN '0' END AS initial_balance,
    CASE WHEN event_type = 'signup' THEN 'ACTIVE' END AS account_status, CAST(NULL AS VARCHAR) AS money_source,
    CASE WHEN n % 3 <> 0 THEN n_name END AS location_city,
    CASE WHEN n % 11 <> 0 THEN 'country_' || (c_nationkey % 3) END AS location_country,
    CAST(NULL AS VARCHAR) AS updated_city, CAST(NULL AS VARCHAR) AS updated_segment,
    CASE n % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'tablet' END AS device, 'os' AS os,
    CASE n % 5 WHEN 0 THEN '192.168.1.' || (n % 250) WHEN 1 THEN '8.8.8.8' WHEN 3 THEN '172.20.0.9'
      WHEN 4 THEN '1.1.1.1' END AS ip,
    CASE n % 3 WHEN 0 THEN 'app' WHEN 1 THEN 'web' ELSE 'api' END AS channel
  FROM numbered
)"""

BRONZE = BATCHES + """,
keyed AS (SELECT *, NULLIF(TRIM(event_id), '') AS idn FROM flat),
known AS (SELECT DISTINCT idn FROM keyed WHERE batch = 1 AND idn IS NOT NULL),
bronze0 AS (
  SELECT keyed.*, 'b' || batch AS batch_id, '2024-02-0' || batch AS ingestion_date,
         '2024-02-0' || batch || 'T00:00:00+00:00' AS ingestion_timestamp, 'events_' || batch || '.json' AS source_file,
         CASE WHEN batch = 2 AND known.idn IS NOT NULL THEN 'seen_in_bronze'
              WHEN keyed.idn IS NULL THEN 'missing_event_id'
              WHEN ROW_NUMBER() OVER (PARTITION BY batch, keyed.idn ORDER BY seq) > 1 THEN 'repeated_in_batch'
         END AS duplicate_reason,
         CASE WHEN batch = 2 AND known.idn IS NOT NULL THEN 'b1' END AS duplicate_first_seen_batch_id,
         CASE WHEN batch = 2 AND known.idn IS NOT NULL THEN 'batch_b1.parquet' END AS duplicate_first_seen_file
  FROM keyed LEFT JOIN known USING (idn)
),
bronze AS (SELECT *, duplicate_reason IS NOT NULL AS is_duplicate FROM bronze0)"""

SILVER = BRONZE + f""",
ranked AS (
  SELECT *, COUNT(*) OVER (PARTITION BY idn) AS copies,
         ROW_NUMBER() OVER (PARTITION BY idn ORDER BY is_duplicate, batch, seq) AS rk FROM bronze
),
typed AS (
  SELECT * EXCLUDE (timestamp, amount, balance_before, balance_after, initial_balance, installments, user_email),
    try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS ts, TRY_CAST(amount AS DOUBLE) AS amount_cop,
    TRY_CAST(balance_before AS DOUBLE) AS balance_before, TRY_CAST(balance_after AS DOUBLE) AS balance_after,
    TRY_CAST(initial_balance AS DOUBLE) AS initial_balance,
    COALESCE(TRY_CAST(installments AS INTEGER), 1) AS installments, TRIM(LOWER(user_email)) AS user_email,
    CASE WHEN idn IS NULL THEN 1 ELSE copies END AS bronze_duplicate_count
  FROM ranked WHERE idn IS NULL OR rk = 1
),
silver AS (
  SELECT * EXCLUDE (location_city, location_country),
    CASE WHEN ip = '8.8.8.8' THEN 'Mountain View' ELSE COALESCE(location_city, user_city, 'Desconocida') END
      AS location_city,
    CASE ip WHEN '8.8.8.8' THEN 'United States' WHEN '1.1.1.1' THEN 'Australia'
      ELSE COALESCE(location_country, 'Colombia') END AS location_country,
    CAST(ts AS DATE) AS date, COALESCE(event_status = 'FAILED', FALSE) AS is_failed,
    COALESCE(event IN ('PAYMENT_MADE', 'PURCHASE_MADE', 'TRANSFER_SENT', 'MONEY_ADDED', 'PAYMENT_FAILED'), FALSE)
      AS is_transactional,
    event IN ('PAYMENT_MADE', 'PURCHASE_MADE', 'TRANSFER_SENT') AND NOT COALESCE(event_status = 'FAILED', FALSE) AS ok,
    COALESCE(ip LIKE '192.168.%' OR ip LIKE '10.%' OR ip LIKE '172.20.%', FALSE) AS ip_is_private,
    {rnd('amount_cop * (1.0::DOUBLE / 4150)', 4)} AS amount_usd
  FROM typed
)"""

SILVER_COLUMNS = """event_id, event, event_status, user_id, user_name, user_age, user_email, user_city, user_segment,
    ts AS timestamp, account_id, amount_cop, currency, merchant, category, payment_method, installments,
    balance_before, balance_after, initial_balance, location_city, location_country, device, os, ip, channel,
    ingestion_timestamp, source_file, batch_id, is_duplicate AS bronze_is_duplicate, duplicate_reason,
    duplicate_first_seen_batch_id, duplicate_first_seen_file, date, bronze_duplicate_count, is_failed,
    is_transactional, ip_is_private,
    CASE WHEN ip_is_private THEN 'payload_location' ELSE 'ip-api.com' END AS geo_source, amount_usd"""
FLAT_COLUMNS = """source, detailType, event_id, event, event_version, event_type, transaction_type, event_entity,
    event_status, user_id, user_name, user_age, user_email, user_city, user_segment, timestamp, account_id, amount,
    currency, merchant, category, payment_method, installments, balance_before, balance_after, initial_balance,
    account_status, money_source, location_city, location_country, updated_city, updated_segment, device, os, ip,
    channel"""
AUDIT = "is_duplicate, duplicate_reason, duplicate_first_seen_batch_id, duplicate_first_seen_file"

# Gold of both event batches, in the one shape all stored-Gold queries return.
_MONEY_TEXT = ", ".join(f"CAST(CAST({c} AS DECIMAL(28,4)) AS VARCHAR)"
                        for c in ("total_amount_usd", "avg_ticket", "failure_rate", "balance_current"))
_DAY_TEXT = ", ".join(f"strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d')" for c in ("last_transaction_date", "last_event_date"))
GOLD_ROWS = f"""
  SELECT 'gold_user_360' AS "table", user_id AS key, total_events AS n, total_amount_cop AS amount,
         concat_ws('|', top_merchant, top_category, preferred_channel, preferred_device, city) AS label,
         concat_ws('|', {_MONEY_TEXT}) AS figures,
         concat_ws('|', user_name, user_email, user_age, user_segment, total_transactions, failed_transactions,
                   days_since_last_tx, {_DAY_TEXT}) AS facts FROM gold_user_360
  UNION ALL SELECT 'gold_daily_metrics', strftime(date, '%Y-%m-%d'), total_events, total_amount_cop,
         concat_ws('|', total_transactions, failed_count, unique_users), '', '' FROM gold_daily_metrics
  UNION ALL SELECT 'gold_event_summary', event, count, pct_of_total,
         concat_ws('|', success_count, failed_count), '', '' FROM gold_event_summary"""


def raw(select: str) -> str:
    return f"WITH {BATCHES} {select}"


def bronze(select: str) -> str:
    return f"WITH {BRONZE} {select}"


def silver(select: str) -> str:
    return f"WITH {SILVER} {select}"


def stored_gold() -> str:
    return f"WITH {SILVER}, {GOLD_USERS}, {GOLD_DAILY}, {GOLD_EVENTS} {GOLD_ROWS}"


def bronze_queries() -> dict[str, str]:
    flagged = bronze(f"SELECT seq, event_id, batch_id, {AUDIT} FROM bronze")
    place = "'in_day=2024-02-0' || right({0}, 1) || '/in_batch=b_' || {0}"   # a batch's folder
    repair = BATCHES + """,
      k AS (SELECT *, NULLIF(TRIM(event_id), '') AS idn, 'b' || batch AS batch_id,
              'batch_b' || batch || '.parquet' AS bronze_file FROM flat),
      r AS (SELECT *, ROW_NUMBER() OVER w AS rn, FIRST_VALUE(batch_id) OVER w AS fb, FIRST_VALUE(bronze_file) OVER w AS ff
            FROM k WINDOW w AS (PARTITION BY idn ORDER BY batch, bronze_file, seq)),
      fixed AS (SELECT *, CASE WHEN idn IS NULL THEN 'missing_event_id' WHEN rn > 1 AND batch_id = fb THEN 'repeated_in_batch'
              WHEN rn > 1 THEN 'seen_in_bronze' END AS duplicate_reason,
              CASE WHEN idn IS NOT NULL AND rn > 1 THEN fb END AS duplicate_first_seen_batch_id,
              CASE WHEN idn IS NOT NULL AND rn > 1 THEN ff END AS duplicate_first_seen_file FROM r)"""
    return {
        "bronze_flatten": raw(f"SELECT {FLAT_COLUMNS} FROM flat WHERE batch = 1"),
        "bronze_metadata": bronze("""SELECT event_id, ingestion_timestamp, source_file, batch_id, ingestion_date
            FROM bronze WHERE batch = 1"""),
        "event_id_normalize": raw("SELECT event_id, NULLIF(TRIM(event_id), '') AS event_key FROM flat WHERE batch = 1"),
        "bronze_first_seen": bronze("""SELECT idn AS event_key, 'b' || MIN(batch) AS batch_id,
            '2024-02-0' || MIN(batch) || 'T00:00:00+00:00' AS ingestion_timestamp,
            'events_' || MIN(batch) || '.json' AS source_file, 'batch_b' || MIN(batch) || '.parquet' AS bronze_file
            FROM bronze WHERE idn IS NOT NULL GROUP BY idn"""),
        "bronze_duplicates": flagged,
        "duplicate_log": bronze("""SELECT event_id, event, user_id, timestamp, batch_id, ingestion_timestamp,
            duplicate_reason, duplicate_first_seen_batch_id, duplicate_first_seen_file FROM bronze
            WHERE is_duplicate"""),
        "bronze_scan": bronze(f"""SELECT {FLAT_COLUMNS}, ingestion_timestamp, source_file, batch_id, ingestion_date,
            is_duplicate, duplicate_reason, duplicate_first_seen_batch_id,
            {place.format("duplicate_first_seen_batch_id")} AS duplicate_first_seen_file FROM bronze"""),
        "bronze_write_roundtrip": bronze("""SELECT batch_id, ingestion_date, event_id, user_id, amount, is_duplicate,
            duplicate_reason FROM bronze"""),
        "bronze_repair": f"""WITH {repair} SELECT batch_id, seq, event_id, duplicate_reason IS NOT NULL AS is_duplicate,
            duplicate_reason, duplicate_first_seen_batch_id, duplicate_first_seen_file FROM fixed""",
        "bronze_repair_roundtrip": f"""WITH {repair} SELECT batch_id, event_id, duplicate_reason IS NOT NULL AS is_duplicate,
            duplicate_reason, duplicate_first_seen_batch_id,
            {place.format("duplicate_first_seen_batch_id")} AS duplicate_first_seen_file FROM fixed""",
        "bronze_repair_summary": f"""WITH {repair} SELECT COUNT(DISTINCT bronze_file) AS files, COUNT(*) AS rows,
            COUNT(DISTINCT idn) AS distinct_event_ids, COUNT(duplicate_reason) AS flagged, TRUE AS dry_run FROM fixed""",
        "raw_event_counts": raw("SELECT event, COUNT(*) AS n FROM flat WHERE batch = 1 GROUP BY event"),
        "raw_distinct_values": raw("""SELECT DISTINCT 'city' AS field, COALESCE(user_city, '') AS value FROM flat WHERE batch = 1
            UNION ALL SELECT DISTINCT 'segment', COALESCE(user_segment, '') FROM flat WHERE batch = 1"""),
        "null_token_cleanup": raw("""SELECT event_id,
            CASE WHEN LOWER(timestamp) NOT IN ('none','nat','nan','null','') THEN timestamp END AS timestamp,
            CASE WHEN n % 5 <> 0 THEN user_segment END AS user_segment
            FROM flat WHERE batch = 1"""),
        "dq_bronze": bronze("""SELECT COUNT(*) AS rows, COUNT(DISTINCT event_id) AS distinct_ids,
            CAST((SELECT SUM(c) FROM (SELECT COUNT(*) AS c FROM bronze GROUP BY event_id) WHERE c > 1) AS BIGINT)
              AS rows_sharing_an_id,
            COUNT(*) FILTER (WHERE is_duplicate) AS flagged_rows, '' AS missing_columns FROM bronze"""),
    }


def silver_queries() -> dict[str, str]:
    return {
        "silver_types": bronze("""SELECT seq, try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
            CAST(try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS date, TRY_CAST(amount AS DOUBLE) AS amount,
            TRY_CAST(balance_before AS DOUBLE) AS balance_before, TRY_CAST(balance_after AS DOUBLE) AS balance_after,
            TRY_CAST(initial_balance AS DOUBLE) AS initial_balance,
            COALESCE(TRY_CAST(installments AS INTEGER), 1) AS installments, TRIM(LOWER(user_email)) AS user_email
            FROM bronze WHERE batch = 1"""),
        "silver_dedup": silver("SELECT event_id, batch_id, n % 10 AS digit, is_duplicate, bronze_duplicate_count FROM silver"),
        "silver_flags": silver("SELECT event_id, event, event_status, is_failed, is_transactional FROM silver"),
        "silver_ip_private": silver("""SELECT event_id, ip, ip_is_private,
            CASE WHEN ip_is_private THEN 'payload_location' ELSE 'ip-api.com' END AS geo_source FROM silver"""),
        "silver_geo": silver("""SELECT event_id, COALESCE(t.location_city, t.user_city, 'Desconocida') AS location_city,
            COALESCE(t.location_country, 'Colombia') AS location_country FROM typed t"""),
        "silver_geo_lookup": silver("SELECT event_id, ip, location_city, location_country FROM silver"),
        "silver_fx": silver("SELECT event_id, amount_cop, amount_usd FROM silver"),
        "silver_final": silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
        "silver_write_roundtrip": silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
        "silver_run_summary": silver(f"""SELECT {big('SUM(bronze_duplicate_count)')} AS rows_before_dedup,
            COUNT(*) AS rows_after_dedup, {big('SUM(bronze_duplicate_count - 1)')} AS rows_removed,
            COUNT(*) FILTER (WHERE idn IS NULL) AS rows_without_id, COUNT(amount_cop) AS rows_with_amount,
            COUNT(amount_usd) AS rows_converted, COUNT(*) FILTER (WHERE is_failed) AS failed_rows,
            COUNT(DISTINCT user_id) AS distinct_users FROM silver"""),
        "dq_silver": silver("""SELECT COUNT(*) AS rows, COUNT(DISTINCT idn) AS distinct_ids,
            CAST((SELECT COUNT(*) FROM (SELECT idn FROM silver WHERE idn IS NOT NULL GROUP BY idn HAVING COUNT(*) > 1))
              AS BIGINT) AS repeated_ids,
            COUNT(*) FILTER (WHERE is_failed) AS failed_rows, COUNT(amount_cop) AS rows_with_cop,
            COUNT(amount_usd) AS rows_with_usd, '' AS missing_columns FROM silver"""),
    }


MESSAGES = BATCHES + """,
msg AS (
  SELECT n AS seq,
    CASE WHEN n % 4 = 0 OR n % 43 = 0 AND n % 41 <> 0 THEN NULL WHEN n % 41 = 0 THEN 'bogus' WHEN n % 4 = 1 THEN 'metric'
      WHEN n % 8 = 2 THEN 'log' WHEN n % 4 = 2 THEN 'alert' WHEN n % 8 = 3 THEN 'event' ELSE 'record' END AS msg_type,
    n % 4 = 0 AS legacy, CASE WHEN n % 4 <> 0 AND n % 6 = 1 THEN '2.0' ELSE '1.0' END AS schema_version,
    CASE WHEN n % 4 <> 0 AND n % 9 <> 1 THEN 'msg-' || n END AS message_id,
    CASE WHEN n % 4 <> 0 AND n % 10 <> 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
    event_type, CAST(CAST(ROUND(value * 100) AS BIGINT) AS VARCHAR) AS v, props
  FROM ev
)"""


def message_queries() -> dict[str, str]:
    kind = "CASE WHEN legacy THEN 'event' ELSE COALESCE(msg_type, 'unknown') END"
    route = "CASE WHEN legacy THEN 'fintech_legacy' ELSE COALESCE(msg_type, 'unknown') END"
    counts = f"WITH {MESSAGES} SELECT {route} AS msg_route, COUNT(*) AS n FROM msg GROUP BY 1"
    return {
        "envelope_validate": f"""WITH {MESSAGES} SELECT seq, msg_type, schema_version,
            COALESCE(message_id, 'filled') AS message_id, COALESCE(timestamp, '2024-03-01T00:00:00Z') AS timestamp,
            CASE WHEN NOT legacy AND seq % 7 = 0 THEN '{{"device":"d"}}' ELSE '{{}}' END AS metadata,
            legacy OR COALESCE(msg_type IN ('event', 'metric', 'record', 'log', 'alert'), FALSE) AS is_valid FROM msg""",
        "message_quarantine": f"""WITH {MESSAGES} SELECT seq, {kind} AS msg_kind FROM msg
            WHERE NOT (legacy OR COALESCE(msg_type IN ('event', 'metric', 'record', 'log', 'alert'), FALSE))""",
        "message_classify": f"WITH {MESSAGES} SELECT seq, {kind} AS msg_kind, {route} AS msg_route FROM msg",
        "message_stats": f"WITH {MESSAGES} SELECT {kind} AS msg_kind, COUNT(*) AS n FROM msg GROUP BY 1",
        "generic_flatten": f"""WITH {MESSAGES} SELECT seq, COALESCE(msg_type, 'unknown') AS msg_type, 'bench' AS source,
            schema_version, message_id, timestamp,
            '{{"name":"' || event_type || '","value":' || v || ',"nested":' || props || ',"flag":true,"note":null,"list":[1,2]'
              || CASE WHEN seq % 8 = 1 THEN ',"a":1,"b":2,"c":3,"d":4,"e":5,"f":6' ELSE '' END || '}}' AS raw_data,
            event_type AS data_name, CAST(v AS DOUBLE) AS data_value, 'true' AS data_flag,
            CASE WHEN seq % 8 = 1 THEN '4' END AS data_d, CASE WHEN seq % 8 = 1 THEN '5' END AS data_e,
            CAST(CASE WHEN seq % 8 = 1 THEN 10 ELSE 4 END AS INTEGER) AS fields
            FROM msg WHERE NOT legacy""",
        "stream_route_counts": counts,
    }


def stream_queries() -> dict[str, str]:
    return {
        "stream_bronze": bronze("""SELECT event_id, event, amount, is_duplicate, duplicate_reason,
            CAST(batch AS INTEGER) AS arrival FROM bronze"""),
        "stream_gold_refresh": stored_gold(),
        "stream_late_data": stored_gold(),
        "gold_write_roundtrip": stored_gold(),
        "snapshot_roundtrip": daily("SELECT * FROM gold_daily_metrics"),
        "layer_export": stored_gold(),
        "catalog_publish": gold_events("SELECT * FROM gold_event_summary"),
        "catalog_readiness": daily("""SELECT 'gold_daily_metrics' AS "table", TRUE AS present,
              (SELECT COUNT(*) FROM gold_daily_metrics) AS rows, '' AS missing_columns
            UNION ALL SELECT 'gold_event_summary', TRUE, (SELECT COUNT(DISTINCT event) FROM silver), 'pct_of_total'
            UNION ALL SELECT 'gold_user_360', FALSE, NULL, 'user_id,user_name,user_email,user_age,user_segment,city,total_events,total_transactions,total_amount_cop,total_amount_usd,avg_ticket,failed_transactions,failure_rate,balance_current,top_merchant,top_category,preferred_channel,preferred_device,last_transaction_date,last_event_date,days_since_last_tx'"""),
        "catalog_query": users("""SELECT user_segment, CAST(NULL AS VARCHAR) AS e, COUNT(*) AS usuarios,
            CAST(SUM(total_transactions) AS BIGINT) AS tx FROM gold_user_360 GROUP BY user_segment"""),
        "guarded_sql": users("""SELECT user_segment, COUNT(*) AS usuarios, CAST(SUM(total_transactions) AS BIGINT) AS tx
            FROM gold_user_360 GROUP BY user_segment"""),
    }


USER_TYPES = (  # column, type, numeric, date
    ("user_id", "string", 0), ("user_name", "string", 0), ("user_email", "string", 0), ("user_age", "int", 1),
    ("user_segment", "string", 0), ("city", "string", 0), ("total_events", "bigint", 1),
    ("total_transactions", "bigint", 1), ("total_amount_cop", "double", 1), ("total_amount_usd", "double", 1),
    ("avg_ticket", "double", 1), ("failed_transactions", "bigint", 1), ("failure_rate", "double", 1),
    ("balance_current", "double", 1), ("top_merchant", "string", 0), ("top_category", "string", 0),
    ("preferred_channel", "string", 0), ("preferred_device", "string", 0), ("last_transaction_date", "timestamp", 2),
    ("last_event_date", "timestamp", 2), ("days_since_last_tx", "bigint", 1),
)
USER_ROLES = {
    "user_id": "identificador", "user_name": "pii", "user_email": "pii", "user_age": "pii",
    "user_segment": "dimension", "city": "dimension", "total_events": "metrica,dimension",
    "total_transactions": "metrica", "total_amount_cop": "metrica", "total_amount_usd": "metrica",
    "avg_ticket": "metrica", "failed_transactions": "estado", "failure_rate": "metrica,estado",
    "balance_current": "metrica", "top_merchant": "dimension", "top_category": "dimension",
    "preferred_channel": "dimension", "preferred_device": "dimension", "last_transaction_date": "fecha",
    "last_event_date": "fecha,dimension", "days_since_last_tx": "metrica",
}


def profile_queries() -> dict[str, str]:
    def one(c: str, kind: str, group: int) -> str:
        def of(f: str, on: int, null: str) -> str:
            return f if group == on else f"CAST(NULL AS {null})"

        return f"""SELECT 'gold_user_360' AS "table", '{c}' AS "column", '{kind}' AS type, '{USER_ROLES[c]}' AS roles,
            COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
            {rnd(f"(COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*)", 2)} AS nulls_pct,
            COUNT(DISTINCT {c}) AS "distinct",
            {of(f"CAST(MIN({c}) AS DOUBLE)", 1, "DOUBLE")} AS min, {of(f"CAST(MAX({c}) AS DOUBLE)", 1, "DOUBLE")} AS max,
            {of(rnd(f"CAST(SUM({dec(c)}) AS DOUBLE) / COUNT({c})", 4) if group == 1 else "", 1, "DOUBLE")} AS mean,
            {of(f"CAST(MIN({c}) AS DATE)", 2, "DATE")} AS min_date, {of(f"CAST(MAX({c}) AS DATE)", 2, "DATE")} AS max_date
            FROM gold_user_360"""

    def extreme(m: str) -> str:
        return f"""SELECT '{m}' AS measure, a.user_segment AS max_label, a.v AS max_value, b.user_segment AS min_label,
            b.v AS min_value, {rnd('a.v - b.v', 4)} AS gap, {rnd('(a.v - b.v) * 100.0 / NULLIF(ABS(b.v), 0)', 1)} AS gap_pct
            FROM (SELECT user_segment, CAST({m} AS DOUBLE) AS v FROM seg ORDER BY v DESC NULLS LAST, 1 LIMIT 1) a,
                 (SELECT user_segment, CAST({m} AS DOUBLE) AS v FROM seg ORDER BY v ASC NULLS LAST, 1 LIMIT 1) b"""

    segment_table = f"""seg AS (SELECT user_segment, COUNT(*) AS usuarios,
        {rnd('CAST(SUM(' + dec('total_amount_cop') + ') AS DOUBLE) / COUNT(*)', 0)} AS revenue_por_usuario,
        {rnd('CAST(SUM(' + dec('failure_rate') + ') AS DOUBLE) / COUNT(failure_rate) * 100', 1)} AS tasa_fallo_pct
        FROM gold_user_360 GROUP BY user_segment)"""
    rest = f"{GOLD_DAILY}, {GOLD_EVENTS}"
    rules = {
        "segment_named": "seg WHERE user_segment IS NULL",
        "segment_revenue_positive": "seg WHERE NOT revenue_por_usuario > 0",
        "segment_failure_in_range": "seg WHERE NOT tasa_fallo_pct BETWEEN 0 AND 100",
        "day_failed_within_transactions": "gold_daily_metrics WHERE failed_count > total_transactions",
        "day_has_users": "gold_daily_metrics WHERE unique_users <= 0",
        "day_volume_not_negative": "gold_daily_metrics WHERE total_amount_cop < 0",
        "event_parts_add_up": "gold_event_summary WHERE success_count + failed_count <> count",
    }
    names = {
        "gold_user_360": [c for c, _, _ in USER_TYPES],
        "gold_daily_metrics": ["date", "total_events", "total_transactions", "total_amount_cop", "failed_count",
                               "unique_users"],
        "gold_event_summary": ["event", "count", "success_count", "failed_count", "pct_of_total"],
    }
    pii = {"gold_user_360": "user_age,user_email,user_name"}
    with_role = lambda role: ",".join(sorted(c for c, roles in USER_ROLES.items() if role in roles.split(",")))
    listed = {
        "gold_user_360": (with_role("metrica"), with_role("dimension"), with_role("fecha")),
        "gold_daily_metrics": (
            "failed_count,total_amount_cop,total_events,total_transactions,unique_users", "total_events", "date"),
        "gold_event_summary": ("count,failed_count,pct_of_total,success_count", "event", ""),
    }
    return {
        "profile_columns": users(" UNION ALL ".join(one(*t) for t in USER_TYPES)),
        "profile_tables": users("").rstrip() + f", {rest} " + " UNION ALL ".join(
            f"""SELECT '{t}' AS "table", (SELECT COUNT(*) FROM {t}) AS rows, CAST({len(c)} AS BIGINT) AS columns,
            '{",".join(sorted(c))}' AS column_names, '{pii.get(t, "")}' AS pii_columns,
            '{listed[t][0]}' AS metric_columns, '{listed[t][1]}' AS dimension_columns, '{listed[t][2]}' AS date_columns"""
            for t, c in names.items()),
        "metric_extremes": users("").rstrip() + f", {segment_table} " + " UNION ALL ".join(
            extreme(m) for m in ("usuarios", "revenue_por_usuario", "tasa_fallo_pct")),
        "dq_gold": users("").rstrip() + f", {rest} " + " UNION ALL ".join(
            f"""SELECT '{t}' AS "table", (SELECT COUNT(*) FROM {t}) AS rows, '' AS missing_columns""" for t in names),
        "dq_invariants": users("").rstrip() + f", {rest}, {segment_table} " + " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, (SELECT COUNT(*) FROM {where}) AS broken_rows" for rule, where in rules.items()),
    }


def layers_oracle() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (bronze_queries, silver_queries, message_queries, stream_queries, profile_queries):
        out.update(part())
    return out
