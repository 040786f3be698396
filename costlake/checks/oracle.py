"""The registered queries in SQL, written from the data contract and not from the Spark code."""

from __future__ import annotations

INVOICES = """
cents AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders
), invoices AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id,
    CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_custkey % 50 AS VARCHAR) END AS org_id,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 20 = 0 THEN -o_totalprice
         ELSE o_totalprice END AS subtotal,
    CASE WHEN o_orderkey % 2 <> 0 THEN CAST(c // 20 AS DOUBLE) / 100 END AS credits,
    CASE WHEN o_orderkey % 29 <> 0 THEN CAST(c * 21 // 100 AS DOUBLE) / 100 END AS taxes,
    CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'BRL' END AS currency,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN CAST(1.0 AS DOUBLE)
         WHEN o_custkey % 3 = 1 THEN CAST(1.1 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE)
    END AS exchange_rate_to_usd
  FROM cents
), normalised AS (
  SELECT *, round(subtotal * rate, 6) AS revenue_usd, round(coalesce(credits, 0) * rate, 6) AS credits_usd,
    round(coalesce(taxes, 0) * rate, 6) AS taxes_usd, rate AS fx_applied
  FROM (SELECT *, coalesce(exchange_rate_to_usd, CAST(1.0 AS DOUBLE)) AS rate FROM invoices)
), billing AS (
  SELECT invoice_id, org_id, month, subtotal, credits, taxes, currency, exchange_rate_to_usd,
    revenue_usd, credits_usd, taxes_usd, fx_applied,
    coalesce(org_id IS NOT NULL AND month IS NOT NULL AND revenue_usd > 0, false) AS ok
  FROM normalised
), revenue AS (
  SELECT org_id, month, round(sum(revenue_usd), 6) AS revenue_usd,
    round(sum(credits_usd), 6) AS credits_usd, round(sum(taxes_usd), 6) AS taxes_usd,
    round(avg(fx_applied), 6) AS fx_applied,
    round(sum(revenue_usd) - sum(credits_usd) + sum(taxes_usd), 6) AS net_revenue_usd
  FROM billing WHERE ok GROUP BY org_id, month
)"""

TICKETS = """
tickets AS (
  SELECT CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS ticket_id,
    CAST(o_custkey % 20 AS VARCHAR) AS org_id,
    o_orderstatus AS category,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'critical'
         WHEN o_orderpriority = '2-HIGH' THEN 'high' WHEN o_orderpriority = '3-MEDIUM' THEN 'medium'
         WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'unknown' END AS severity,
    TIMESTAMP '2025-07-01 00:00:00' + (o_orderkey % 30) * INTERVAL 1 DAY
      + (o_orderkey % 24) * INTERVAL 1 HOUR AS created_at,
    CASE WHEN o_orderkey % 9 <> 0 THEN TIMESTAMP '2025-07-01 02:00:00'
      + (o_orderkey % 30) * INTERVAL 1 DAY + (o_orderkey % 24) * INTERVAL 1 HOUR END AS resolved_at,
    CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderkey % 8 AS DOUBLE) END AS csat,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus = 'F' END AS sla_breached
  FROM orders
), judged AS (
  SELECT *, coalesce(ticket_id IS NOT NULL AND severity IN ('low', 'medium', 'high', 'critical')
    AND (csat IS NULL OR (csat >= 1 AND csat <= 5)), false) AS ok
  FROM tickets
), by_severity AS (
  SELECT org_id, CAST(created_at AS DATE) AS created_date, severity, count(*) AS ticket_count,
    avg(CASE WHEN sla_breached THEN 1.0 WHEN NOT sla_breached THEN 0.0 END) AS sla_breach_rate,
    avg(csat) AS csat_avg
  FROM judged WHERE ok GROUP BY 1, 2, 3
), ticket_days AS (
  SELECT org_id, created_date AS event_date, CAST(sum(ticket_count) AS BIGINT) AS ticket_count,
    round(coalesce(sum(sla_breach_rate * ticket_count) / sum(ticket_count), 0), 6) AS sla_breach_rate,
    round(sum(csat_avg * ticket_count)
      / sum(CASE WHEN csat_avg IS NOT NULL THEN ticket_count END), 6) AS csat_avg,
    CAST(sum(CASE WHEN severity = 'low' THEN ticket_count ELSE 0 END) AS BIGINT) AS low_count,
    CAST(sum(CASE WHEN severity = 'medium' THEN ticket_count ELSE 0 END) AS BIGINT) AS medium_count,
    CAST(sum(CASE WHEN severity = 'high' THEN ticket_count ELSE 0 END) AS BIGINT) AS high_count,
    CAST(sum(CASE WHEN severity = 'critical' THEN ticket_count ELSE 0 END) AS BIGINT) AS critical_count,
    strftime(created_date, '%Y-%m') AS month_bucket
  FROM by_severity GROUP BY org_id, created_date
)"""

EVENTS = """
landed AS (
  SELECT
    CASE WHEN event_id % 83 <> 0 AND event_id % 61 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'not-a-time'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
    CASE WHEN event_id % 83 <> 0 AND event_id % 71 <> 0 THEN CAST(user_id % 20 AS VARCHAR) END AS org_id,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_type = 'click' THEN 'genai'
         ELSE event_type END AS service,
    CASE WHEN event_id % 83 = 0 THEN NULL ELSE CASE event_id % 3 WHEN 0 THEN ' Requests '
         WHEN 1 THEN 'CPU_Hours' ELSE 'storage_gb_hours ' END END AS metric,
    CASE WHEN event_id % 83 = 0 OR event_id % 43 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'bad'
         ELSE CAST(value AS VARCHAR) END AS value,
    CASE WHEN event_id % 83 = 0 OR event_id % 59 = 0 THEN NULL WHEN event_id % 53 = 0 THEN ' '
         ELSE CASE event_id % 3 WHEN 0 THEN 'count' WHEN 1 THEN ' hours' ELSE 'gb_hours' END END AS unit,
    CASE WHEN event_id % 83 <> 0 AND event_id % 47 <> 0
         THEN value / 10 - CAST(0.5 AS DOUBLE) END AS cost_usd_increment,
    CASE WHEN event_id % 83 <> 0 AND event_id % 2 = 1 AND event_type IN ('click', 'purchase')
         THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS genai_tokens,
    CASE WHEN event_id % 83 <> 0 AND event_id % 2 = 1 THEN value / 1000 END AS carbon_kg,
    CASE WHEN event_id % 83 = 0 THEN '{bad json ' || CAST(event_id AS VARCHAR) END AS _corrupt_record
  FROM events
), timed AS (
  SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts,
    CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS event_date,
    TRY_CAST(value AS DOUBLE) AS value_num,
    value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL AS is_value_cast_error
  FROM landed
), marked AS (
  SELECT *, _corrupt_record IS NULL AND event_id IS NOT NULL AND event_ts IS NOT NULL
    AND NOT is_value_cast_error AS ok
  FROM timed
), bronze AS (
  SELECT * FROM marked WHERE ok
), conformed AS (
  SELECT event_id, org_id, service, event_ts, event_date, lower(trim(metric)) AS metric, value,
    trim(unit) AS unit, value_num, cost_usd_increment, coalesce(genai_tokens, 0) AS genai_tokens,
    coalesce(carbon_kg, 0) AS carbon_kg
  FROM bronze
), flagged AS (
  SELECT *, event_id IS NOT NULL AS dq_event_id_not_null, true AS dq_event_id_unique,
    coalesce(cost_usd_increment, 0) >= CAST(-0.01 AS DOUBLE) AS dq_cost_min_threshold,
    value_num IS NULL OR coalesce(length(unit), 0) > 0 AS dq_unit_when_value,
    coalesce(cost_usd_increment, 0) < CAST(-0.01 AS DOUBLE) AS anomaly_cost_flag
  FROM conformed
), silver AS (
  SELECT * FROM flagged WHERE dq_event_id_not_null AND dq_unit_when_value
), rejected AS (
  SELECT * FROM flagged WHERE NOT (dq_event_id_not_null AND dq_unit_when_value)
), totals AS (
  SELECT event_date, org_id, service, sum(coalesce(cost_usd_increment, 0)) AS daily_cost_usd,
    CAST(trunc(round(sum(CASE WHEN metric = 'requests' THEN coalesce(value_num, 1) ELSE 0 END), 6))
      AS BIGINT) AS requests,
    sum(CASE WHEN metric = 'cpu_hours' THEN coalesce(value_num, 0) ELSE 0 END) AS cpu_hours,
    sum(CASE WHEN metric = 'storage_gb_hours' THEN coalesce(value_num, 0) ELSE 0 END)
      AS storage_gb_hours,
    CAST(sum(genai_tokens) AS BIGINT) AS genai_tokens_total, sum(carbon_kg) AS carbon_kg_total,
    count(*) AS events_count,
    CAST(sum(CASE WHEN anomaly_cost_flag THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_events_count
  FROM silver GROUP BY event_date, org_id, service
), org_days AS (
  SELECT event_date, org_id, service, sum(coalesce(cost_usd_increment, 0)) AS cost
  FROM bronze GROUP BY event_date, org_id, service
), baseline AS (
  SELECT service, avg(cost) AS mean_cost, stddev_samp(cost) AS sd_cost FROM org_days GROUP BY service
), scored AS (
  SELECT t.*, CASE WHEN sd_cost > 0 THEN (daily_cost_usd - mean_cost) / sd_cost ELSE 0 END AS z_score,
    coalesce(abs(CASE WHEN sd_cost > 0 THEN (daily_cost_usd - mean_cost) / sd_cost ELSE 0 END) > 3,
      false) AS anomaly_zscore_flag
  FROM totals t LEFT JOIN baseline b ON t.service = b.service
), features AS (
  SELECT event_date, org_id, service, round(daily_cost_usd, 6) AS daily_cost_usd, requests,
    round(cpu_hours, 6) AS cpu_hours, round(storage_gb_hours, 6) AS storage_gb_hours,
    genai_tokens_total, round(carbon_kg_total, 6) AS carbon_kg_total, events_count,
    anomaly_events_count, round(z_score, 6) AS z_score, anomaly_zscore_flag
  FROM scored
), usage AS (
  SELECT *, strftime(event_date, '%Y-%m') AS month_bucket,
    round(1.0 - CAST(anomaly_events_count AS DOUBLE) / events_count, 6) AS quality_score
  FROM features
), genai AS (
  SELECT event_date, org_id, genai_tokens_total, daily_cost_usd AS estimated_cost_usd, month_bucket
  FROM usage WHERE genai_tokens_total > 0 OR service = 'genai'
), anomalies AS (
  SELECT event_date, org_id, service, anomaly_events_count, events_count, quality_score, z_score,
    anomaly_zscore_flag, month_bucket
  FROM usage WHERE anomaly_events_count > 0 OR anomaly_zscore_flag
), usage_rows AS (
  SELECT org_id, month_bucket, event_date, service, daily_cost_usd, requests, cpu_hours,
    storage_gb_hours, genai_tokens_total, carbon_kg_total, events_count, anomaly_events_count,
    quality_score
  FROM usage WHERE org_id IS NOT NULL
), genai_rows AS (
  SELECT org_id, month_bucket, event_date,
    CAST(sum(genai_tokens_total) AS BIGINT) AS genai_tokens_total,
    round(sum(estimated_cost_usd), 6) AS estimated_cost_usd
  FROM genai WHERE org_id IS NOT NULL GROUP BY org_id, month_bucket, event_date
), loads AS (
  SELECT CAST(c_custkey + 2 AS VARCHAR) AS org_id, c_name AS org_name, c_mktsegment AS industry,
    CASE c_custkey % 4 WHEN 0 THEN 'free' WHEN 1 THEN 'pro' WHEN 2 THEN 'business'
      ELSE 'enterprise' END AS plan_tier,
    CASE WHEN c_custkey % 7 = 0 THEN 'churned' ELSE 'active' END AS lifecycle_stage,
    r_name AS hq_region, c_acctbal > 5000 AS is_enterprise
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), enriched AS (
  SELECT event_id, s.org_id, org_name, industry, plan_tier, lifecycle_stage, hq_region,
    is_enterprise, service, round(cost_usd_increment, 6) AS cost_usd_increment, anomaly_cost_flag,
    event_date
  FROM silver s LEFT JOIN loads o ON s.org_id = o.org_id
)"""

# Where a stream stops: two days before the latest event it saw, at millisecond precision.
SILVER_END = "(SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 2 DAY FROM silver)"
BRONZE_END = "(SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 2 DAY FROM bronze)"
CLOSED = f"event_date + INTERVAL 1 DAY <= {SILVER_END}"

TEXT_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
BRONZE_KEPT = f"""event_id, org_id, service, metric, value, unit, round(value_num, 6) AS value_num,
    {TEXT_TS.format('event_ts')}, event_date"""
TICKET_COLUMNS = f"""ticket_id, org_id, category, severity, {TEXT_TS.format('created_at')},
    {TEXT_TS.format('resolved_at')}, csat, sla_breached"""
VIOLATIONS = """concat_ws(',', CASE WHEN NOT dq_cost_min_threshold THEN 'cost_below_-0.01' END,
    CASE WHEN NOT dq_unit_when_value THEN 'unit_missing_when_value_present' END)"""
QUARANTINED = "SELECT event_id, org_id, service, value_num, unit, event_date FROM rejected"
SERVED_RANGE = """org_id = '3' AND month_bucket = '2024-01'
    AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"""
ONCE_PER_ID = "SELECT event_id, event_date FROM bronze"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _invoice_queries() -> dict[str, str]:
    required = "invoice_id IS NOT NULL AND org_id IS NOT NULL AND month IS NOT NULL"
    raw = "invoice_id, org_id, month, subtotal, credits, taxes, currency, exchange_rate_to_usd"
    text_month = """SELECT org_id, CAST(month AS VARCHAR) AS month, revenue_usd, credits_usd, taxes_usd,
        net_revenue_usd, fx_applied FROM revenue"""
    return {
        "billing_normalized": "SELECT * EXCLUDE (ok) FROM billing WHERE ok",
        "billing_quarantine": "SELECT * EXCLUDE (ok) FROM billing WHERE NOT ok",
        "revenue_mart": "SELECT * FROM revenue",
        "revenue_serving_month_text": text_month,
        "serving_rows_revenue": text_month,
        "flow_batch_revenue": text_month,
        "serving_q4_revenue": f"{text_month} WHERE org_id = '7'",
        "required_key_filter": f"SELECT {raw} FROM invoices WHERE {required}",
        "revenue_preview": """
            SELECT *, (SELECT count(*) FROM revenue) AS total_rows FROM revenue ORDER BY org_id, month LIMIT 20""",
        "ingest_moved_keys": f"""
            SELECT {raw.replace('month', """CASE WHEN CAST(invoice_id AS BIGINT) % 7 = 0 OR month = DATE '1995-03-01'
              THEN CAST(month + INTERVAL 240 MONTH AS DATE) ELSE month END AS month""")}
            FROM invoices WHERE {required}""",
        "partition_overwrite_idempotent": """
            SELECT month, count(*) AS invoices,
              round(sum(CASE WHEN month >= DATE '1998-01-01' THEN 0 ELSE credits_usd END), 6) AS credits_usd
            FROM billing WHERE ok GROUP BY month""",
        "ingest_csv_roundtrip": f"""
            SELECT {raw.replace('subtotal', '''CASE WHEN CAST(invoice_id AS BIGINT) % 17 <> 0
                THEN subtotal END AS subtotal''')},
              DATE '2026-06-15' AS batch_date, DATE '2026-06-15' AS load_date, true AS has_source_file
            FROM invoices WHERE {required}""",
    }


def _ticket_queries() -> dict[str, str]:
    severities = " UNION ALL ".join(
        f"SELECT org_id, event_date, '{name}' AS severity, {name}_count AS tickets FROM ticket_days"
        for name in ("low", "medium", "high", "critical")
    )
    return {
        "tickets_valid": f"SELECT {TICKET_COLUMNS} FROM judged WHERE ok",
        "tickets_quarantine": f"SELECT {TICKET_COLUMNS} FROM judged WHERE NOT ok",
        "tickets_daily_by_severity": """
            SELECT org_id, created_date, severity, ticket_count,
              round(sla_breach_rate, 6) AS sla_breach_rate, round(csat_avg, 6) AS csat_avg
            FROM by_severity""",
        "tickets_mart": "SELECT * FROM ticket_days",
        "tickets_severity_map": severities,
        "flow_batch_tickets": "SELECT * FROM ticket_days",
        "serving_rows_tickets": "SELECT * FROM ticket_days WHERE org_id IS NOT NULL",
        "serving_q3_tickets_sla": """
            SELECT event_date, ticket_count, sla_breach_rate, csat_avg, low_count, medium_count,
              high_count, critical_count
            FROM ticket_days WHERE org_id = '3' AND month_bucket = '2025-07'
              AND event_date BETWEEN DATE '2025-07-01' AND DATE '2025-07-31'""",
        "bronze_technical_columns": """
            SELECT ticket_id, CAST(created_at AS DATE) AS created_date, DATE '2026-06-15' AS batch_date,
              DATE '2026-06-15' AS load_date, true AS has_source_file, true AS has_ingest_ts
            FROM tickets""",
    }


def _event_queries() -> dict[str, str]:
    without_scores = "SELECT * EXCLUDE (z_score, anomaly_zscore_flag) FROM features"
    anomaly_rows = """SELECT org_id, month_bucket, event_date, service, anomaly_events_count,
        events_count, quality_score, z_score, anomaly_zscore_flag
        FROM anomalies WHERE org_id IS NOT NULL"""
    mart_counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS total_rows FROM {relation}"
        for name, relation in {
            "org_daily_usage_by_service": "usage",
            "genai_tokens_by_org_date": "genai",
            "cost_anomaly_mart": "anomalies",
        }.items()
    )
    layer_counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS total_rows FROM {relation}"
        for name, relation in {
            "bronze/usage_events": "bronze",
            "bronze/usage_events_invalid": "marked WHERE NOT ok",
            "silver/events_enriched": "silver",
            "silver/features_org_daily": f"features WHERE {CLOSED}",
            "silver/events_quality_issues": "rejected",
            "gold/org_daily_usage_by_service": f"features WHERE {CLOSED}",
            "silver/distinct_event_ids": "silver",
        }.items()
    )
    return {
        "events_cast_errors": f"""
            SELECT event_id, "timestamp", {TEXT_TS.format('event_ts')}, event_date, value,
              round(value_num, 6) AS value_num, is_value_cast_error FROM timed""",
        "events_valid": f"SELECT {BRONZE_KEPT} FROM bronze",
        "events_invalid": f"""
            SELECT {BRONZE_KEPT}, _corrupt_record, is_value_cast_error FROM marked WHERE NOT ok""",
        "events_conformed": f"""
            SELECT event_id, {TEXT_TS.format('event_ts')}, event_date, metric, unit,
              round(value_num, 6) AS value_num, round(cost_usd_increment, 6) AS cost_usd_increment,
              genai_tokens, round(carbon_kg, 6) AS carbon_kg FROM conformed""",
        "events_dq_flags": """
            SELECT event_id, dq_event_id_not_null, dq_event_id_unique, dq_cost_min_threshold,
              dq_unit_when_value, anomaly_cost_flag FROM flagged""",
        "events_dq_violations": f"""
            SELECT event_id, {VIOLATIONS} AS violations,
              CAST((NOT dq_cost_min_threshold)::INT + (NOT dq_unit_when_value)::INT AS BIGINT)
                AS violation_count
            FROM flagged""",
        "events_quarantine": QUARANTINED,
        "stream_quarantine": QUARANTINED,
        "stream_quarantine_samples": f"""
            SELECT event_id, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, org_id, service, metric, value, unit,
              round(cost_usd_increment, 6) AS cost_usd_increment, {VIOLATIONS} AS violations
            FROM rejected""",
        "quarantine_sample": """
            SELECT event_id, org_id, service, unit FROM rejected ORDER BY event_id LIMIT 100""",
        "events_distinct_ids": """
            SELECT 2 * count(*) AS rows_read, count(DISTINCT event_id) AS distinct_ids FROM landed""",
        "org_dimension": "SELECT * FROM loads",
        "events_enriched": "SELECT * FROM enriched",
        "stream_events_enriched": "SELECT * FROM enriched",
        "service_cost_baseline": """
            SELECT service, round(mean_cost, 6) AS service_mean_cost,
              round(sd_cost, 6) AS service_stddev_cost FROM baseline""",
        "features_org_daily": "SELECT * FROM features",
        "cost_zscore_anomalies": """
            SELECT event_date, org_id, service, daily_cost_usd, z_score FROM features
            WHERE anomaly_zscore_flag""",
        "gold_usage_mart": "SELECT * FROM usage",
        "gold_genai_tokens": "SELECT * FROM genai",
        "gold_cost_anomaly": "SELECT * FROM anomalies",
        "serving_rows_usage": "SELECT * FROM usage_rows",
        "serving_rows_genai": "SELECT * FROM genai_rows",
        "serving_rows_anomaly": anomaly_rows,
        "serving_q1_daily_costs": f"""
            SELECT org_id, month_bucket, event_date, service, daily_cost_usd, requests
            FROM usage_rows WHERE {SERVED_RANGE}""",
        "serving_q2_top_services": """
            SELECT CAST(row_number() OVER (ORDER BY total_cost_usd DESC, service) AS INT) AS rank,
              service, total_cost_usd
            FROM (SELECT service, round(sum(daily_cost_usd), 6) AS total_cost_usd FROM usage_rows
              WHERE org_id = '3' AND month_bucket IN ('2023-12', '2024-01')
                AND event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-23'
              GROUP BY service)
            ORDER BY rank LIMIT 3""",
        "serving_q5_genai": f"SELECT * FROM genai_rows WHERE {SERVED_RANGE}",
        "serving_q6_anomalies": f"{anomaly_rows} AND {SERVED_RANGE}",
        "serving_upsert_usage": """
            SELECT * REPLACE (CASE WHEN event_date >= DATE '2024-01-15' THEN 0 ELSE daily_cost_usd END
              AS daily_cost_usd) FROM usage_rows""",
        "stream_serving_upsert": "SELECT * FROM usage_rows",
        "stream_bronze_events": f"SELECT {BRONZE_KEPT} FROM bronze",
        "stream_dedupe": ONCE_PER_ID,
        "stream_continuous": "SELECT event_id, org_id, event_date FROM rejected",
        "stream_restart_idempotent": ONCE_PER_ID,
        "stream_late_data": f"""
            {ONCE_PER_ID} UNION ALL
            SELECT event_id || '-late' AS event_id, event_date FROM bronze
            WHERE event_ts > {BRONZE_END}""",
        "stream_daily_features": f"{without_scores} WHERE {CLOSED}",
        "stream_zscore": f"""
            SELECT event_date, org_id, service, z_score, anomaly_zscore_flag FROM features
            WHERE {CLOSED}""",
        "stream_gold_usage": "SELECT * FROM usage",
        "stream_gold_genai": "SELECT * FROM genai",
        "stream_gold_anomaly": "SELECT * FROM anomalies",
        "stream_gold_marts": mart_counts,
        "flow_streaming_counts": layer_counts,
        "flow_streaming_usage": f"SELECT * FROM usage_rows WHERE {CLOSED}",
        "flow_bounded_usage": f"SELECT * FROM usage_rows WHERE {CLOSED}",
        "flow_streaming_genai": f"SELECT * FROM genai_rows WHERE {CLOSED}",
        "flow_streaming_anomaly": f"{anomaly_rows} AND {CLOSED}",
        "stream_late_rows_kept": f"""
            SELECT event_id, {TEXT_TS.format('event_ts')}, true AS late_as_reported,
              (SELECT 2 * count(*) FROM landed) AS rows_accounted FROM bronze""",
        "stream_rows_accounted": "SELECT 2 * count(*) AS rows_accounted FROM landed",
    }


INGEST_STATS = _with(
    f"{INVOICES.strip()}, {TICKETS.strip()}, stats AS ("
    """
  SELECT 'billing_monthly' AS table_name, 2 * count(*) AS records_read,
    2 * count(*) FILTER (org_id IS NOT NULL) AS records_after_quality,
    count(DISTINCT invoice_id) FILTER (org_id IS NOT NULL) AS records_after_dedupe
  FROM invoices
  UNION ALL
  SELECT 'support_tickets', count(*), count(ticket_id), count(DISTINCT ticket_id) FROM tickets
)""",
    """SELECT *, records_after_dedupe AS records_written FROM stats
    UNION ALL
    SELECT 'total', CAST(sum(records_read) AS BIGINT), CAST(sum(records_after_quality) AS BIGINT),
      CAST(sum(records_after_dedupe) AS BIGINT), CAST(sum(records_after_dedupe) AS BIGINT) FROM stats""",
)

LANDING_STATS = _with(
    """
landing AS (
  SELECT 'customers_orgs' AS table_name, CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 700 AS VARCHAR) END AS key,
    c_custkey % 13 <> 0 AS ok FROM customer
  UNION ALL
  SELECT 'marketing_touches', CAST(event_id AS VARCHAR), event_id % 71 <> 0 AND event_id % 17 <> 0 FROM events
  UNION ALL
  SELECT 'nps_surveys', concat(o_custkey % 50, ' ', CAST(o_orderdate AS DATE)), o_orderkey % 19 <> 0 FROM orders
  UNION ALL
  SELECT 'resources', CAST(p_partkey AS VARCHAR), p_partkey % 9 <> 0 FROM part
  UNION ALL
  SELECT 'users', CAST(c_custkey AS VARCHAR), c_custkey % 8 <> 0 FROM customer
), stats AS (
  SELECT table_name, 2 * count(*) AS records_read, 2 * count(*) FILTER (ok) AS records_after_quality,
    count(DISTINCT key) FILTER (ok) AS records_after_dedupe
  FROM landing GROUP BY table_name
)""",
    """SELECT *, records_after_dedupe AS records_written, records_after_dedupe AS dry_run_rows FROM stats
    UNION ALL
    SELECT 'total', CAST(sum(records_read) AS BIGINT), CAST(sum(records_after_quality) AS BIGINT),
      CAST(sum(records_after_dedupe) AS BIGINT), CAST(sum(records_after_dedupe) AS BIGINT), NULL FROM stats""",
)

DEDUPE = """
SELECT * EXCLUDE (n) REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
      l_linestatus, l_shipdate) AS n
  FROM lineitem) WHERE n = 1"""


def all_sql() -> dict[str, str]:
    return {
        **{name: _with(INVOICES, sql) for name, sql in _invoice_queries().items()},
        **{name: _with(TICKETS, sql) for name, sql in _ticket_queries().items()},
        **{name: _with(EVENTS, sql) for name, sql in _event_queries().items()},
        "ingest_stats": INGEST_STATS,
        "ingest_landing_tables": LANDING_STATS,
        "dedupe_natural_key": DEDUPE,
    }
