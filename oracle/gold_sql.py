"""Oracle SQL for the Gold tables and everything computed from them."""

from oracle.base import all_gold, big, daily, events, favg, fsum, rnd, users

REV = rnd(f"{fsum('total_amount_cop')} / COUNT(*)", 0)
VOL = rnd(f"{fsum('total_amount_cop')}", 0)
TICKET = rnd(f"{favg('avg_ticket')}", 0)
FAIL1 = rnd(f"{favg('failure_rate')} * 100", 1)
FAIL2 = rnd(f"{favg('failure_rate')} * 100", 2)
RECENCY = "ROUND(AVG(days_since_last_tx), 0)"
BALANCE = rnd(f"{favg('balance_current')}", 0)


def inactive(n: int) -> str:
    return f"COUNT(CASE WHEN days_since_last_tx > {n} THEN 1 END)"


def millions(d: int = 2) -> str:
    return rnd(f"{fsum('total_amount_cop')} / 1e6", d)


def share(part: str, whole: str, d: int) -> str:
    return rnd(f"({part}) * 100.0::DOUBLE / NULLIF({whole}, 0)", d)


def table(key: str, measures: dict[str, str], where: str = "", order: str = "", limit: int = 0,
          ascending: bool = False, label: str = "") -> str:
    cols = ", ".join(f'{sql} AS {name}' for name, sql in measures.items())
    sql = f"SELECT {key}{' AS ' + label if label else ''}, {cols} FROM gold_user_360 {where} GROUP BY {key}"
    if limit:
        direction = "ASC" if ascending else "DESC"
        sql += f" ORDER BY {order} {direction} NULLS LAST, {key} ASC NULLS LAST LIMIT {limit}"
    return users(sql)


METRIC_SQL = {
    "revenue_usuario": ("revenue_por_usuario", REV),
    "volumen_total": ("volumen_M_cop", millions()),
    "ticket_transaccion": ("ticket_promedio_tx", TICKET),
    "usuarios": ("usuarios", "COUNT(*)"),
    "tasa_fallo": ("tasa_fallo_pct", FAIL1),
    "balance_promedio": ("balance_promedio", BALANCE),
    "balance_total": ("balance_total", rnd(f"{fsum('balance_current')}", 0)),
    "inactivos_30d": ("inactivos_30d", inactive(30)),
    "inactivos_60d": ("inactivos_60d", inactive(60)),
    "pct_inactivos_30d": ("pct_inactivos_30d", share(inactive(30), "COUNT(*)", 1)),
    "transacciones_prom": ("tx_promedio", rnd("AVG(total_transactions)", 1)),
    "transacciones_total": ("transacciones_total", big("SUM(total_transactions)")),
    "fallos_totales": ("fallos_totales", big("SUM(failed_transactions)")),
    "dias_sin_tx": ("dias_promedio_sin_tx", RECENCY),
    "revenue_usd": ("revenue_usd_usuario", rnd(f"{fsum('total_amount_usd')} / COUNT(*)", 2)),
    "eventos_prom": ("eventos_promedio", rnd("AVG(total_events)", 1)),
}
DIMENSION_SQL = {
    "merchant": ("top_merchant", True), "ciudad": ("city", False), "segmento": ("user_segment", False),
    "canal": ("preferred_channel", True), "dispositivo": ("preferred_device", True),
    "categoria": ("top_category", True),
}


def metric_queries() -> dict[str, str]:
    out = {}
    for m, (label, sql) in METRIC_SQL.items():
        for d, (column, known) in DIMENSION_SQL.items():
            measures = {label: sql} if m == "usuarios" else {label: sql, "usuarios": "COUNT(*)"}
            where = f"WHERE {column} IS NOT NULL" if known else ""
            out[f"metric_{m}__{d}"] = table(column, measures, where, label, 10)
    return out


SEG, SHOP = "user_segment", "top_merchant"
KNOWN = "WHERE top_merchant IS NOT NULL"
U = {"usuarios": "COUNT(*)"}
ALL_USERS = "(SELECT COUNT(*) FROM gold_user_360)"


def business_queries() -> dict[str, str]:
    city = {**U, "volumen_cop": VOL, "revenue_por_usuario": REV, "ticket_promedio": TICKET,
            "tasa_fallo_pct": FAIL1, "inactivos": inactive(30)}
    top_users_cols = """user_id, user_segment, city, total_transactions,
        ROUND(total_amount_cop, 0) AS total_amount_cop, ROUND(avg_ticket, 0) AS avg_ticket, top_merchant, top_category"""
    return {
        "q_inactive": table(SEG, {
            "usuarios_inactivos": "COUNT(*)", "promedio_dias_sin_tx": RECENCY,
            "max_dias_sin_tx": "MAX(days_since_last_tx)", "ticket_historico": TICKET, "tasa_fallo_pct": FAIL1,
        }, "WHERE days_since_last_tx > 30"),
        "q_segment": table(SEG, {**U, "volumen_cop": VOL, "revenue_por_usuario": REV, "ticket_promedio": TICKET,
                                 "tasa_fallo_pct": FAIL1, "dias_promedio_sin_tx": RECENCY}),
        "q_city": table("city", city),
        "q_city_by_failure": table("city", city),
        "q_failure": table(SEG, {**U, "transacciones_fallidas": big("SUM(failed_transactions)"),
                                 "tasa_fallo_pct": FAIL1, "revenue_por_usuario": REV}),
        "q_top_users": users(f"SELECT {top_users_cols} FROM gold_user_360 "
                             "ORDER BY gold_user_360.total_amount_cop DESC NULLS LAST, user_id LIMIT 10"),
        "q_merchant": table(SHOP, {**U, "volumen_cop": VOL, "ticket_por_usuario": REV, "tasa_fallo_pct": FAIL1,
                                   "penetracion_pct": share("COUNT(*)", ALL_USERS, 1)}, KNOWN, "volumen_cop", 10),
        "q_category": table("top_category", {**U, "volumen_cop": VOL, "revenue_por_usuario": REV,
                                             "tasa_fallo_pct": FAIL1},
                            "WHERE top_category IS NOT NULL", "volumen_cop", 10),
        "q_channel": table("preferred_channel", {**U, "share_pct": share("COUNT(*)", ALL_USERS, 1),
                                                 "volumen_cop": VOL, "revenue_por_usuario": REV,
                                                 "tasa_fallo_pct": FAIL1}),
        "q_device": table("preferred_device", {**U, "share_pct": share("COUNT(*)", ALL_USERS, 1),
                                               "volumen_cop": VOL, "revenue_por_usuario": REV}),
        "q_event": events(f"""SELECT event, count, success_count, failed_count, pct_of_total,
            {share('failed_count', 'count', 1)} AS tasa_fallo_pct FROM gold_event_summary"""),
        "q_daily": daily(f"""SELECT date, total_events, total_transactions,
            ROUND(total_amount_cop, 0) AS total_amount_cop, failed_count, unique_users,
            {share('failed_count', 'total_transactions', 1)} AS tasa_fallo_pct
            FROM gold_daily_metrics ORDER BY date DESC LIMIT 35"""),
        "q_business_kpis": users(f"""SELECT COUNT(*) AS usuarios,
            {big('SUM(total_transactions)')} AS total_transacciones, {millions()} AS volumen_M_cop,
            {rnd(fsum('total_amount_usd'), 2)} AS volumen_usd, {TICKET} AS ticket_promedio,
            {FAIL1} AS tasa_fallo_pct, {inactive(30)} AS inactivos_30d FROM gold_user_360"""),
        "q_campaign": table(SEG, {**U, "revenue_por_usuario": REV, "ticket_promedio": TICKET,
                                  "tasa_fallo_pct": FAIL1, "inactivos": inactive(30)}),
        "exec_kpis": users(f"""SELECT COUNT(*) AS total_usuarios,
            {big('SUM(total_transactions)')} AS total_transacciones, {millions()} AS volumen_M_cop,
            ROUND({fsum('total_amount_usd')}, 0) AS volumen_usd, {TICKET} AS ticket_promedio,
            {FAIL1} AS tasa_fallo_pct, {inactive(30)} AS usuarios_inactivos_30d,
            {rnd(fsum('total_amount_cop') + ' / COUNT(*) / 1e3', 1)} AS revenue_K_por_usuario FROM gold_user_360"""),
        "exec_segments": table(SEG, {**U, "revenue_por_usuario": REV, "tasa_fallo_pct": FAIL1,
                                     "ticket_promedio": TICKET}),
        "exec_cities": table("city", {**U, "revenue_por_usuario": REV, "tasa_fallo_pct": FAIL1}),
        "exec_merchants": table(SHOP, {**U, "ticket_por_usuario": REV}, KNOWN, "ticket_por_usuario", 5),
        "user_profile": users("SELECT * EXCLUDE (user_name, user_email, user_age) FROM gold_user_360 "
                              "WHERE user_id = 'user_99'"),
        "pii_drop": users("SELECT * EXCLUDE (user_name, user_email, user_age) FROM gold_user_360"),
        "wh_segment_volume": table(SEG, {**U, "volumen_cop": VOL, "ticket_promedio": TICKET}),
        "wh_city_failure": table("city", {"tasa_fallo_pct": FAIL1}),
        "verify_city_failure": table("city", {"tasa_fallo_pct": FAIL1}, "", "tasa_fallo_pct", 1),
        "ask_01": users("SELECT COUNT(*) AS usuarios FROM gold_user_360"),
        "ask_02": users("SELECT user_id, total_amount_cop FROM gold_user_360 "
                        "ORDER BY total_amount_cop DESC NULLS LAST, user_id LIMIT 1"),
        "ask_03": users("SELECT user_id, total_amount_cop FROM gold_user_360 WHERE user_id = 'user_99'"),
        "ask_04": table(SHOP, {"transacciones": big("SUM(total_transactions)")}, KNOWN, "transacciones", 5),
        "ask_05": table(SEG, {"ticket_promedio": TICKET}, "", "ticket_promedio", 1),
        "ask_06": users("SELECT COUNT(*) AS usuarios FROM gold_user_360 WHERE failed_transactions > 3"),
        "ask_07": table("preferred_channel", U, "WHERE user_segment = 'BUILDING' AND preferred_channel IS NOT NULL",
                        "usuarios", 1),
        "ask_08": table("city", {"volumen_cop": VOL}, "", "volumen_cop", 1),
        "ask_09": users("SELECT user_id, days_since_last_tx FROM gold_user_360 "
                        "ORDER BY days_since_last_tx DESC NULLS LAST, user_id LIMIT 3"),
        "ask_10": users("SELECT user_id, total_amount_cop, avg_ticket, top_merchant, preferred_channel "
                        "FROM gold_user_360 WHERE user_id = 'user_210'"),
    }


def builder_queries() -> dict[str, str]:
    return {
        "gold_user_360": users("SELECT * FROM gold_user_360"),
        "gold_daily_metrics": daily("SELECT * FROM gold_daily_metrics"),
        "gold_event_summary": events("SELECT * FROM gold_event_summary"),
        "gold_success_tx": users("SELECT event_id, user_id, date, event, amount_cop, amount_usd FROM silver WHERE ok"),
        "gold_demographics": users("""SELECT user_id, user_name, user_email, user_age, user_segment, city,
            total_events, failed_transactions, last_event_date FROM gold_user_360"""),
        "gold_tx_metrics": users("""SELECT user_id, total_transactions, total_amount_cop, total_amount_usd,
            avg_ticket, balance_current, last_transaction_date FROM tx LEFT JOIN lasts USING (user_id)"""),
        "gold_modes": users("""SELECT user_id, top_merchant, top_category, preferred_channel, preferred_device
            FROM gold_user_360"""),
        "gold_failure_recency": users("""SELECT user_id, total_transactions, failed_transactions, failure_rate,
            last_transaction_date, days_since_last_tx FROM gold_user_360"""),
        "gold_run_summary": users(f"""SELECT COUNT(*) AS users,
            (SELECT user_id FROM gold_user_360 ORDER BY total_amount_cop DESC NULLS LAST, user_id LIMIT 1) AS top_user,
            MAX(total_amount_cop) AS top_amount_cop, {TICKET} AS mean_ticket,
            COUNT(*) FILTER (WHERE failed_transactions > 3) AS users_over_3_failures FROM gold_user_360"""),
        "gold_period": daily("SELECT MIN(date) AS desde, MAX(date) AS hasta FROM gold_daily_metrics"),
        "dq_top3": users("""SELECT user_id, total_transactions, total_amount_cop, top_merchant FROM gold_user_360
            ORDER BY total_amount_cop DESC NULLS LAST, user_id LIMIT 3"""),
    }


def report_queries() -> dict[str, str]:
    kpis = f"""SELECT COUNT(*) AS usuarios, {big('SUM(total_transactions)')} AS transacciones,
        {millions()} AS volumen_M_cop, {TICKET} AS ticket_promedio, {FAIL1} AS tasa_fallo_pct,
        {inactive(30)} AS inactivos_30d FROM gold_user_360"""
    fail_colour = "CASE WHEN tasa_fallo_pct > 5 THEN 'red' WHEN tasa_fallo_pct > 3 THEN 'yellow' ELSE 'green' END"
    return {
        "report_kpis": users(kpis),
        "report_kpi_status": users(f"""SELECT tasa_fallo_pct, {fail_colour} AS tasa_fallo_status, inactivos_30d,
            CASE WHEN inactivos_30d / usuarios::DOUBLE > 0.3 THEN 'red' ELSE 'neutral' END AS inactivos_status
            FROM ({kpis})"""),
        "report_segments": table(SEG, {"Usuarios": "COUNT(*)", "Revenue_por_usuario": REV, "Ticket_promedio": TICKET,
                                       "Tasa_fallo_pct": FAIL1, "Inactivos_30d": inactive(30)}, label="Segmento"),
        "report_cities": table("city", {"Usuarios": "COUNT(*)", "Revenue_por_usuario": REV, "Tasa_fallo_pct": FAIL1},
                               "", "Revenue_por_usuario", 10, label="Ciudad"),
        "report_merchants": table(SHOP, {"Usuarios": "COUNT(*)", "Revenue_por_usuario": REV}, KNOWN,
                                  "Revenue_por_usuario", 8, label="Merchant"),
        "report_daily": daily(f"""SELECT date AS Fecha, total_transactions AS Transacciones,
            {rnd('total_amount_cop / 1e6', 3)} AS Volumen_M_COP, unique_users AS Usuarios_unicos,
            {share('failed_count', 'total_transactions', 1)} AS Tasa_fallo_pct
            FROM gold_daily_metrics ORDER BY date DESC LIMIT 14"""),
        "dash_filtered_kpis": users(f"""SELECT COUNT(*) AS usuarios, {millions(1)} AS volumen_M_cop,
            {TICKET} AS ticket_promedio, {FAIL1} AS tasa_fallo_pct FROM gold_user_360
            WHERE user_segment IN ('BUILDING', 'MACHINERY')
              AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')"""),
        "dash_leaders": users(f"""
            (SELECT 'segment' AS kind, user_segment AS leader, {fsum('total_amount_cop')} AS score FROM gold_user_360
             GROUP BY user_segment ORDER BY score DESC, leader LIMIT 1)
            UNION ALL
            (SELECT 'city', city, CAST(COUNT(user_id) AS DOUBLE) AS score FROM gold_user_360
             GROUP BY city ORDER BY score DESC, city LIMIT 1)"""),
        "dash_segment_volume": table(SEG, {"total_amount_cop": fsum("total_amount_cop")}),
        "dash_channel_share": table("preferred_channel", {
            **U, "share_pct": share("COUNT(*)", "(SELECT COUNT(preferred_channel) FROM gold_user_360)", 1)},
            "WHERE preferred_channel IS NOT NULL"),
        "dash_merchants": table(SHOP, U, KNOWN, "usuarios", 12),
        "dash_cities": table("city", U),
        "dash_daily_trend": daily(f"""SELECT date, total_transactions,
            {rnd('(SELECT AVG(total_transactions) FROM gold_daily_metrics)', 4)} AS mean_transactions
            FROM gold_daily_metrics"""),
        "dash_top_users": users("""SELECT user_id, user_segment, city, total_amount_cop, avg_ticket, failure_rate,
            preferred_channel FROM gold_user_360 ORDER BY total_amount_cop DESC NULLS LAST, user_id LIMIT 15"""),
    }


def chart_queries() -> dict[str, str]:
    fail = {"tasa_fallo": FAIL1}
    by = {
        "segment_users": (SEG, U),
        "segment_revenue": (SEG, {"revenue_por_usuario": REV, "ticket_promedio": TICKET}),
        "segment_failure": (SEG, {**U, **fail}),
        "city_users": ("city", U),
        "city_volume": ("city", {"volumen_M_cop": millions()}),
        "city_failure": ("city", fail),
        "merchant_ticket": (SHOP, {"ticket_promedio": TICKET}, "ticket_promedio", 8),
        "merchant_users8": (SHOP, U, "usuarios", 8),
        "merchant_revenue": (SHOP, {"revenue_por_usuario": REV, "ticket_promedio": TICKET}, "revenue_por_usuario", 10),
        "merchant_users10": (SHOP, U, "usuarios", 10),
        "category_users": ("top_category", U, "usuarios", 1000),
        "category_ticket": ("top_category", {**U, "ticket_promedio": TICKET}, "usuarios", 10),
        "channel_users": ("preferred_channel", U, "usuarios", 1000),
        "channel_failure": ("preferred_channel", {**U, **fail}, "usuarios", 1000),
        "device_users": ("preferred_device", U, "usuarios", 1000),
        "device_ticket": ("preferred_device", {**U, "ticket_promedio": TICKET}, "usuarios", 1000),
        "revenue_segment": (SEG, {"revenue_por_usuario": REV}),
        "ticket_revenue": (SEG, {"ticket_promedio": TICKET, "revenue_por_usuario": REV}),
        "balance_avg": (SEG, {"balance_promedio": BALANCE}),
        "balance_avg_min": (SEG, {"balance_promedio": BALANCE, "balance_minimo": "ROUND(MIN(balance_current), 0)"}),
        "inactive30": (SEG, {"inactivos_30d": inactive(30)}),
        "inactive30_60": (SEG, {"inactivos_30d": inactive(30), "inactivos_60d": inactive(60),
                                "total_usuarios": "COUNT(*)"}),
        "failure_rate": (SEG, fail),
        "failure_detail": (SEG, {**fail, "transacciones_fallidas": big("SUM(failed_transactions)")}),
    }
    out = {}
    for name, (key, measures, *top) in by.items():
        where = f"WHERE {key} IS NOT NULL" if top else ""
        out[f"chart_{name}"] = table(key, measures, where, *top)
    out["chart_event_counts"] = events("SELECT event, count FROM gold_event_summary")
    out["chart_event_detail"] = events("SELECT event, count, success_count, failed_count FROM gold_event_summary")
    for name, sql in {
        "daily_volume": rnd("total_amount_cop / 1e6", 2) + " AS volumen_M_cop", "daily_users": "unique_users",
        "daily_failures": "failed_count", "daily_tx": "total_transactions",
    }.items():
        out[f"chart_{name}"] = daily(f"SELECT date, {sql} FROM gold_daily_metrics")
    return out


def alert_queries() -> dict[str, str]:
    level = "CASE WHEN {v} > {c} THEN 'critical' WHEN {v} > {w} THEN 'warning' {e} END"
    base = f"""SELECT {FAIL2} AS tasa_fallo_global, COUNT(*) AS total_usuarios, {inactive(30)} AS inactivos_30d,
        {inactive(60)} AS inactivos_60d, {millions()} AS volumen_M_cop, {TICKET} AS ticket_promedio,
        {share(inactive(30), 'COUNT(*)', 1)} AS pct_inactivos_30d,
        {share(inactive(60), 'COUNT(*)', 1)} AS pct_inactivos_60d FROM gold_user_360"""

    def finding(rule: str, entity: str, value: str, severity: str, source: str) -> str:
        return f"""SELECT * FROM (SELECT '{rule}' AS rule, CAST({entity} AS VARCHAR) AS entity,
            CAST({value} AS DOUBLE) AS value, {severity} AS severity FROM ({source})) WHERE severity IS NOT NULL"""

    glob = finding("global_failure", "'all'", "tasa_fallo_global",
                   level.format(v="tasa_fallo_global", c=5, w=3, e="ELSE 'ok'"), base)
    seg = finding("segment_failure", SEG, "tf", level.format(v="tf", c=5, w=3, e=""),
                  f"SELECT {SEG}, {FAIL1} AS tf FROM gold_user_360 GROUP BY {SEG}")
    conc = finding("concentration", SEG, "p", level.format(v="p", c=60, w=45, e="ELSE 'ok'"),
                   f"""SELECT {SEG}, {share(fsum('total_amount_cop'), '(SELECT ' + fsum('total_amount_cop') + ' FROM gold_user_360)', 1)} AS p
                   FROM gold_user_360 GROUP BY {SEG} ORDER BY p DESC NULLS LAST, {SEG} LIMIT 1""")
    churn = (finding("churn", "'30d'", "pct_inactivos_30d",
                     level.format(v="pct_inactivos_30d", c=30, w=20, e="ELSE 'ok'"), base)
             + " UNION ALL " +
             finding("churn", "'60d'", "pct_inactivos_60d",
                     "CASE WHEN pct_inactivos_60d > 15 THEN 'critical' END", base))
    act = finding(
        "activity", "CASE WHEN d > 20 THEN 'peak' WHEN d < -10 THEN 'drop' ELSE 'stable' END", "d",
        "CASE WHEN d < -20 THEN 'critical' WHEN d < -10 THEN 'warning' ELSE 'ok' END",
        f"""SELECT {rnd('(COALESCE(r, 0) - p) / p * 100', 1)} AS d FROM (
              SELECT ROUND(AVG(CASE WHEN rn <= 3 THEN total_transactions END), 0) AS r,
                     ROUND(AVG(CASE WHEN rn BETWEEN 4 AND 10 THEN total_transactions END), 0) AS p
              FROM (SELECT total_transactions, ROW_NUMBER() OVER (ORDER BY date DESC) AS rn FROM gold_daily_metrics))
            WHERE p > 0""")
    bal = finding("balance", SEG, "b", "CASE WHEN b < 0 THEN 'critical' WHEN b < 50000 THEN 'warning' END",
                  f"""SELECT {SEG}, {BALANCE} AS b FROM gold_user_360 GROUP BY {SEG}
                  ORDER BY b ASC NULLS LAST, {SEG} LIMIT 1""")
    both = " UNION ALL ".join([glob, seg, conc, churn, act, bal])
    return {
        "alert_base": users(base), "alert_global_failure": users(glob), "alert_segment_failure": users(seg),
        "alert_concentration": users(conc), "alert_churn": users(churn), "alert_balance": users(bal),
        "alert_activity": daily(act), "alerts": all_gold("", both),
        "alert_counts": all_gold("", f"SELECT severity, COUNT(*) AS n FROM ({both}) GROUP BY severity"),
    }


def period_queries() -> dict[str, str]:
    def side(label: str, where: str) -> str:
        return f"""SELECT '{label}' AS periodo, MIN(date) AS desde, MAX(date) AS hasta, COUNT(*) AS dias_datos,
            {big('SUM(total_transactions)')} AS transacciones, {rnd(fsum('total_amount_cop') + ' / 1e6', 3)} AS volumen_M_cop,
            ROUND(AVG(unique_users), 0) AS usuarios_activos_dia, {big('SUM(unique_users)')} AS usuarios_totales,
            {big('SUM(failed_count)')} AS fallos,
            {share('SUM(failed_count)', 'SUM(total_transactions)', 2)} AS tasa_fallo_pct
            FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY date DESC) AS rn FROM gold_daily_metrics) WHERE {where}"""

    both = side("ACTUAL", "rn <= 7") + " UNION ALL " + side("ANTERIOR", "rn > 7 AND rn <= 14")
    measures = {"transacciones": "FALSE", "volumen_M_cop": "FALSE", "usuarios_activos_dia": "FALSE",
                "usuarios_totales": "FALSE", "fallos": "TRUE", "tasa_fallo_pct": "TRUE"}
    pairs = " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, COALESCE(CAST(a.{m} AS DOUBLE), 0) AS current,
            COALESCE(CAST(p.{m} AS DOUBLE), 0) AS prior, {low} AS lower_is_better
            FROM (SELECT * FROM both_ WHERE periodo = 'ACTUAL') a, (SELECT * FROM both_ WHERE periodo = 'ANTERIOR') p"""
        for m, low in measures.items())
    delta = rnd("(current - prior) / NULLIF(ABS(prior), 0) * 100", 1)
    colour = """CASE WHEN delta_pct IS NULL THEN 'N/D'
        WHEN (lower_is_better AND delta_pct < 0) OR (NOT lower_is_better AND delta_pct > 0) THEN 'green'
        WHEN ABS(delta_pct) > 10 THEN 'red' ELSE 'yellow' END"""

    def change(m: str) -> str:
        return rnd(f"(CAST(a.{m} AS DOUBLE) - p.{m}) / NULLIF(CAST(p.{m} AS DOUBLE), 0) * 100", 1)

    def with_both(select: str) -> str:
        return daily("").rstrip() + f", both_ AS ({both}) {select}"

    return {
        "period_compare": daily(both),
        "period_deltas": with_both(f"SELECT *, {colour} AS colour FROM (SELECT *, {delta} AS delta_pct FROM ({pairs}))"),
        "period_trend": with_both(f"""SELECT *, CASE WHEN tx_delta_pct > 0 AND volume_delta_pct > 0 THEN 'growth'
            WHEN tx_delta_pct < 0 AND volume_delta_pct < 0 THEN 'contraction' ELSE 'mixed' END AS trend FROM (
            SELECT {change('transacciones')} AS tx_delta_pct, {change('volumen_M_cop')} AS volume_delta_pct,
                   {rnd('a.tasa_fallo_pct - p.tasa_fallo_pct', 2)} AS failure_delta_points
            FROM (SELECT * FROM both_ WHERE periodo = 'ACTUAL') a, (SELECT * FROM both_ WHERE periodo = 'ANTERIOR') p
            WHERE COALESCE(p.transacciones <> 0, TRUE) AND COALESCE(p.volumen_M_cop <> 0, TRUE))"""),
    }


def gold_oracle() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (builder_queries, business_queries, metric_queries, report_queries, chart_queries, alert_queries,
                 period_queries):
        out.update(part())
    return out
