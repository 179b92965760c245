"""Names, word lists, limits and constants whose exact content decides results."""

# --- Event and message vocabularies (fixed values) ---------------------------------------
EVENT_TYPES = (
    "PAYMENT_MADE", "PURCHASE_MADE", "TRANSFER_SENT", "MONEY_ADDED", "PAYMENT_FAILED",
    "USER_REGISTERED", "USER_PROFILE_UPDATED",
)
MESSAGE_TYPES = ("event", "metric", "record", "log", "alert")
SUCCESS_TX_EVENTS = ("PAYMENT_MADE", "PURCHASE_MADE", "TRANSFER_SENT")
TRANSACTIONAL_EVENTS = ("PAYMENT_MADE", "PURCHASE_MADE", "TRANSFER_SENT", "MONEY_ADDED", "PAYMENT_FAILED")
FAILED_STATUS = "FAILED"

# --- Duplicate reasons (fixed values) -----------------------------------------------------
SEEN_IN_BRONZE = "seen_in_bronze"
REPEATED_IN_BATCH = "repeated_in_batch"
MISSING_EVENT_ID = "missing_event_id"

# --- Silver rules (fixed values) ----------------------------------------------------------
# RFC 1918 private ranges, tested as text prefixes.
PRIVATE_IP_PATTERN = r"^(192\.168\.|10\.|172\.(1[6-9]|2[0-9]|3[01])\.)"
GEO_FROM_PAYLOAD = "payload_location"
GEO_FROM_LOOKUP = "ip-api.com"
UNKNOWN_CITY = "Desconocida"
DEFAULT_COUNTRY = "Colombia"
FALLBACK_FX_RATE = 1 / 4150
SILVER_DROPPED = (
    "source", "detailType", "event_type", "transaction_type", "event_entity", "event_version",
    "account_status", "money_source", "updated_city", "updated_segment", "ingestion_date",
)
DUPLICATE_LOG_COLUMNS = (
    "event_id", "event", "user_id", "timestamp", "batch_id", "ingestion_timestamp",
    "duplicate_reason", "duplicate_first_seen_batch_id", "duplicate_first_seen_file",
)

# --- Envelope defaults (fixed values) -----------------------------------------------------
DEFAULT_SCHEMA_VERSION = "1.0"
UNKNOWN_MESSAGE = "unknown"
LEGACY_ROUTE = "fintech_legacy"

# --- Privacy and SQL guard (fixed values) -------------------------------------------------
PII_COLUMNS = ("user_name", "user_email", "user_age")
FORBIDDEN_SQL_WORDS = (
    "DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "CREATE", "TRUNCATE", "EXEC", "EXECUTE",
)
WAREHOUSE_FORBIDDEN_WORDS = (
    "DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "CREATE", "TRUNCATE", "MERGE", "REPLACE", "GRANT",
    "REVOKE", "COPY", "PUT", "REMOVE",
)
QUERY_STARTS = ("SELECT", "WITH")
COMMAND_STARTS = ("SELECT", "WITH", "SHOW", "DESCRIBE", "DESC", "EXPLAIN")
SQL_ROW_CAP = 100
CHART_ROW_CAP = 50
WAREHOUSE_ROW_CAP = 500
NULL_TOKENS = ("none", "nat", "nan", "null", "")

# --- Alert thresholds (fixed values) ------------------------------------------------------
FAILURE_CRITICAL, FAILURE_WARNING = 5, 3
CONCENTRATION_CRITICAL, CONCENTRATION_WARNING = 60, 45
CHURN30_CRITICAL, CHURN30_WARNING = 30, 20
CHURN60_CRITICAL = 15
ACTIVITY_CRITICAL, ACTIVITY_WARNING, ACTIVITY_PEAK = -20, -10, 20
RECENT_DAYS, PRIOR_DAYS = 3, 7
BALANCE_CRITICAL, BALANCE_WARNING = 0, 50_000
PERIOD_RED = 10
INACTIVE_SHARE_RED = 0.3

# --- Gold tables (fixed values) -----------------------------------------------------------
GOLD_TABLES = ("gold_user_360", "gold_daily_metrics", "gold_event_summary")
USER_360_COLUMNS = (
    "user_id", "user_name", "user_email", "user_age", "user_segment", "city", "total_events",
    "total_transactions", "total_amount_cop", "total_amount_usd", "avg_ticket", "failed_transactions",
    "failure_rate", "balance_current", "top_merchant", "top_category", "preferred_channel",
    "preferred_device", "last_transaction_date", "last_event_date", "days_since_last_tx",
)
DAILY_COLUMNS = ("date", "total_events", "total_transactions", "total_amount_cop", "failed_count", "unique_users")
EVENT_SUMMARY_COLUMNS = ("event", "count", "success_count", "failed_count", "pct_of_total")
SILVER_REQUIRED = (
    "event_id", "event", "is_failed", "is_transactional", "amount_cop", "amount_usd", "timestamp",
    "date", "ip_is_private", "geo_source",
)
BRONZE_REQUIRED = ("event_id", "ingestion_timestamp", "batch_id")

# --- Column roles: name fragments per role (fixed values) ---------------------------------
ROLE_FRAGMENTS = (
    ("fecha", ("date", "fecha", "time")),
    ("metrica", ("amount", "ticket", "balance", "rate", "count", "total", "pct")),
    ("dimension", ("segment", "city", "channel", "device", "merchant", "category", "event")),
    ("estado", ("failed", "failure", "status", "success")),
    ("pii", ("email", "name", "age", "phone", "document")),
)

# --- Metric catalogue dimensions: key -> (column, drop nulls) (fixed values) ---------------
DIMENSIONS = {
    "merchant": ("top_merchant", True),
    "ciudad": ("city", False),
    "segmento": ("user_segment", False),
    "canal": ("preferred_channel", True),
    "dispositivo": ("preferred_device", True),
    "categoria": ("top_category", True),
}

# --- Question words (fixed values, accents already removed) --------------------------------
DATA_QUESTION_WORDS = (
    "kpi", "metric", "numero", "cuanto", "total", "promedio", "ticket", "volumen", "monto",
    "transaccion", "usuario", "segment", "ciudad", "fallo", "failed", "tasa", "ranking", "top",
    "resumen", "ejecutivo", "merchant", "comercio", "categoria", "canal", "device", "dispositivo",
    "evento", "diario", "fecha", "daily", "gold", "negocio",
    "alerta", "diagnostico", "anomalia", "salud", "estado",
    "variacion", "periodo", "semana", "anterior", "comparar", "evolucion", "cambio", "crecio",
    "bajo", "sube", "baja",
    "churn", "inactivo", "retencion", "abandono",
    "balance", "saldo", "riesgo",
    "campana", "lanzar", "promocion", "promociones", "estrategia", "iniciativa", "accion",
    "inversion", "oportunidad", "recomendar", "recomendacion", "objetivo", "meta", "plan", "targeting",
)
DATA_QUESTION_TOKEN = "dia"
SUMMARY_WORDS = ("resumen", "ejecutivo", "kpi", "indicador")

# Ordered rules: name, fragments of which any must occur, fragments of which one must occur as
# well (empty: none), whole words that match on their own.
INTENT_RULES = (
    ("inactive", ("inactiv", "sin transaccionar", "dias sin", "30 dia", "sin tx", "no transacciona",
                  "no han transaccionado"), (), ()),
    ("segment", ("segment", "rentable"), (), ()),
    ("city", ("ciudad", "city", "crecimiento"), (), ()),
    ("failure", ("fallo", "failed", "rechazo", "friccion"), (), ()),
    ("top_users", ("usuario",), ("top", "ranking", "gasto", "mayor", "mas"), ()),
    ("merchant", ("merchant", "comercio", "alianza", "aliado"), (), ()),
    ("category", ("categoria", "category"), (), ()),
    ("channel", ("canal", "channel"), (), ()),
    ("device", ("device", "dispositivo"), (), ()),
    ("event", ("event",), (), ()),
    ("daily", ("diario", "fecha", "daily", "tendencia", "evolucion"), (), ("dia",)),
    ("business_kpis", ("total", "volumen", "ticket", "transaccion", "monto", "negocio", "plataforma"), (), ()),
)
CITY_FAILURE_WORDS = ("fallo", "failed", "rechazo", "tasa")

# Word -> dimension key.
DIMENSION_WORDS = {
    "merchant": ("merchant", "merchants", "comercio", "comercios", "tienda", "tiendas", "aliado", "aliados"),
    "ciudad": ("ciudad", "ciudades", "city"),
    "segmento": ("segmento", "segmentos", "segment"),
    "canal": ("canal", "canales", "channel"),
    "dispositivo": ("dispositivo", "dispositivos", "device", "movil", "mobile", "app"),
    "categoria": ("categoria", "categorias", "category"),
}
# Word -> metric key.
METRIC_WORDS = {
    "revenue_usuario": ("revenue", "revenues", "ingreso", "ingresos", "monto", "montos", "ticket", "tickets",
                        "gasto", "gastos"),
    "volumen_total": ("cop", "volumen", "amount"),
    "ticket_transaccion": ("ticket_transaccion", "ticket_promedio", "avg_ticket"),
    "usuarios": ("usuario", "usuarios", "user", "users", "clientes", "cantidad", "personas"),
    "tasa_fallo": ("fallo", "fallos", "error", "errores", "tasa_fallo", "rechazos", "fracaso", "fallido"),
    "balance_promedio": ("balance", "saldo", "saldos"),
    "inactivos_30d": ("inactivo", "inactivos", "churn", "dormido", "abandono"),
    "pct_inactivos_30d": ("retencion",),
    "transacciones_prom": ("transaccion", "transacciones"),
    "dias_sin_tx": ("dias", "recencia"),
    "eventos_prom": ("eventos", "evento"),
}
# Phrase -> metric key, first match wins, before any word.
METRIC_PHRASES = (
    ("ticket por usuario", "revenue_usuario"),
    ("ticket_por_usuario", "revenue_usuario"),
    ("revenue por usuario", "revenue_usuario"),
    ("monto por usuario", "revenue_usuario"),
    ("gasto por usuario", "revenue_usuario"),
    ("ticket promedio", "ticket_transaccion"),
    ("ticket por transaccion", "ticket_transaccion"),
    ("tasa de fallo", "tasa_fallo"),
    ("tasa fallo", "tasa_fallo"),
    ("inactivos 30", "inactivos_30d"),
    ("inactivos 60", "inactivos_60d"),
)
GENERIC_METRIC = "usuarios"
