"""SQL for DuckDB that computes what each query returns."""

from __future__ import annotations

from workload.bindings import BUDGET, CITY_HOLIDAYS, FIXED_HOLIDAYS

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288)"
_NAME = "trim(name, ' ' || chr(160) || chr(8195))"
_CEILING = BUDGET.ceiling_bytes
_FREE = BUDGET.free_tier_bytes
_LARGEST = BUDGET.max_bytes_per_query


def _records(names: dict[str, str], kind: str) -> str:
    rows = ", ".join(f"('{day}', '{name}')" for day, name in names.items())
    return f"""
    SELECT sha256(strftime(o_orderdate, '%Y-%m-%d') || '_' || lower(h.name) || '_{kind}') AS holiday_id,
           CAST(o_orderdate AS DATE) AS date, h.name, '{kind}' AS type, o_orderpriority AS source,
           o_orderdate + to_seconds(o_orderkey) AS ingested_at, o_orderstatus
    FROM orders JOIN (VALUES {rows}) h(month_day, name) ON strftime(o_orderdate, '%m%d') = h.month_day"""


_RAW = f"raw AS ({_records(FIXED_HOLIDAYS, 'national')})"
_RAW_CITY = (
    f"raw AS ({_records(FIXED_HOLIDAYS, 'national')} UNION ALL {_records(CITY_HOLIDAYS, 'municipal')})"
)
_HOLIDAYS = """
holidays AS (
    SELECT holiday_id, date AS holiday_date, name AS holiday_name, type AS holiday_type,
           source AS data_source, ingested_at
    FROM raw
    QUALIFY row_number() OVER (PARTITION BY holiday_id ORDER BY ingested_at DESC) = 1)"""
_SPAN = """
spine AS (
    SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE)
           AS calendar_date)"""
_SPAN_OF_ORDERS = """
spine AS (
    SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS calendar_date
    FROM (SELECT make_date(year(min(o_orderdate)), 1, 1) AS low,
                 make_date(year(max(o_orderdate)), 12, 31) AS high FROM orders))"""
_PARTS = """
       CAST(day(d.calendar_date) AS INTEGER) AS day_of_month,
       CAST(month(d.calendar_date) AS INTEGER) AS month_number,
       monthname(d.calendar_date) AS month_name,
       CAST(quarter(d.calendar_date) AS INTEGER) AS quarter_number,
       CAST(year(d.calendar_date) AS INTEGER) AS year_number,
       CAST(dayofweek(d.calendar_date) + 1 AS INTEGER) AS day_of_week_num,
       dayname(d.calendar_date) AS day_of_week_name,
       CAST(weekofyear(d.calendar_date) AS INTEGER) AS week_of_year,
       dayofweek(d.calendar_date) IN (0, 6) AS is_weekend"""
_NEAR = """
near AS (
    SELECT calendar_date,
           (SELECT min(holiday_date) FROM holidays WHERE holiday_date >= calendar_date) AS next_holiday_date,
           (SELECT max(holiday_date) FROM holidays WHERE holiday_date <= calendar_date) AS prev_holiday_date
    FROM spine)"""
_CALENDAR = f"""
calendar AS (
    SELECT d.calendar_date, {_PARTS},
           h.holiday_name IS NOT NULL AS is_holiday,
           coalesce(h.holiday_name, 'Dia Comum') AS holiday_name,
           coalesce(h.holiday_type, 'regular') AS holiday_type,
           dayofweek(d.calendar_date) NOT IN (0, 6) AND h.holiday_name IS NULL AS is_business_day,
           n.next_holiday_date,
           CAST(date_diff('day', d.calendar_date, n.next_holiday_date) AS INTEGER) AS days_to_holiday,
           n.prev_holiday_date,
           CAST(date_diff('day', n.prev_holiday_date, d.calendar_date) AS INTEGER) AS days_after_holiday,
           coalesce(date_diff('day', d.calendar_date, n.next_holiday_date) BETWEEN 1 AND 7, FALSE)
               AS is_pre_holiday_window,
           coalesce(date_diff('day', n.prev_holiday_date, d.calendar_date) BETWEEN 1 AND 3, FALSE)
               AS is_post_holiday_window
    FROM spine d
    LEFT JOIN holidays h ON d.calendar_date = h.holiday_date
    LEFT JOIN near n ON d.calendar_date = n.calendar_date)"""
_SALES = """
sales AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sale_id,
           CAST(l_shipdate AS DATE) AS sale_date, CAST(l_partkey AS VARCHAR) AS product_id,
           p_type AS product_category, CAST(round(l_quantity) AS BIGINT) AS quantity,
           CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue, r_name AS region
    FROM lineitem
    LEFT JOIN part ON p_partkey = l_partkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey)"""
_FACTS = """
facts AS (
    SELECT s.*, c.day_of_week_name AS day_name, c.month_name, c.year_number AS year, c.is_weekend,
           c.is_business_day, c.is_holiday, c.holiday_name, c.days_to_holiday, c.days_after_holiday,
           c.is_pre_holiday_window, c.is_post_holiday_window,
           CASE WHEN c.is_holiday THEN 'DURANTE_FERIADO' WHEN c.is_pre_holiday_window THEN 'PRE_FERIADO'
                WHEN c.is_post_holiday_window THEN 'POS_FERIADO' ELSE 'DIA_COMUM' END
               AS sales_period_context
    FROM sales s JOIN calendar c ON s.sale_date = c.calendar_date)"""
# Means are rounded half-up in whole cents, free of binary fractions.
_BASELINE = """
baseline AS (
    SELECT product_category,
           CAST((2 * sum(CAST(revenue * 100 AS HUGEINT)) + count(*)) // (2 * count(*)) AS BIGINT) AS cents,
           CAST((200 * sum(quantity) + count(*)) // (2 * count(*)) AS BIGINT) AS hundredths
    FROM facts WHERE sales_period_context = 'DIA_COMUM' GROUP BY product_category)"""


def _window(name: str) -> str:
    return f"""
before AS (
    SELECT {name} AS holiday_name, product_category,
           min(sale_date) AS first_sale_window, max(sale_date) AS last_sale_window,
           CAST((2 * sum(CAST(revenue * 100 AS HUGEINT)) + count(*)) // (2 * count(*)) AS BIGINT) AS cents,
           CAST((200 * sum(quantity) + count(*)) // (2 * count(*)) AS BIGINT) AS hundredths,
           CAST(sum(revenue) AS DOUBLE) AS total, count(DISTINCT sale_id) AS transactions
    FROM named GROUP BY ALL)"""


_NAMED = """
named AS (
    SELECT f.*, n.next_name FROM facts f
    JOIN (SELECT holiday_date, min(holiday_name) AS next_name FROM holidays GROUP BY holiday_date) n
      ON n.holiday_date = f.sale_date + f.days_to_holiday
    WHERE f.sales_period_context = 'PRE_FERIADO')"""
_NAMED_AS_WRITTEN = """
named AS (
    SELECT * FROM facts
    WHERE sales_period_context = 'PRE_FERIADO' AND holiday_name != 'Dia Comum')"""
_MART = """
grown AS (
    SELECT p.*, coalesce(b.cents, 0) AS base_cents,
           CASE WHEN coalesce(b.cents, 0) > 0
                THEN sign(p.cents - b.cents)
                     * ((2 * abs(CAST(p.cents - b.cents AS HUGEINT) * 10000) + b.cents) // (2 * b.cents))
                     / 100.0
                ELSE 0 END AS growth
    FROM before p LEFT JOIN baseline b ON p.product_category = b.product_category)
SELECT holiday_name, product_category, base_cents / 100.0 AS avg_sales_normal,
       cents / 100.0 AS avg_sales_before_holiday, total AS total_revenue_pre_holiday,
       transactions AS total_transactions_pre_holiday, CAST(growth AS DOUBLE) AS sales_growth_pct,
       CASE WHEN growth >= 30 THEN 'ALTA' WHEN growth >= 15 THEN 'MEDIA' ELSE 'BAIXA' END
           AS opportunity_score,
       CASE WHEN growth >= 30 THEN concat('Oportunidade ALTA para ', product_category,
                ': Antecipar campanhas promocionais em D-7 e reforçar estoque.')
            WHEN growth >= 15 THEN concat('Oportunidade MÉDIA para ', product_category,
                ': Disparar comunicações e ofertas em D-5 com foco em conversão.')
            ELSE concat('Demanda regular para ', product_category,
                ': Manter estratégia padrão sem custo extraordinário de mídia.') END AS recommendation
FROM grown"""
_LEDGER = """
ledger AS (
    SELECT 'run-' || o_custkey AS execution_id, 'query' AS step_name, CAST(o_orderkey AS VARCHAR) AS job_id,
           o_orderpriority AS project_id, o_orderdate AS start_time,
           o_orderdate + to_seconds(o_orderkey % 600) AS end_time,
           CAST(round(o_totalprice * 100) AS BIGINT) AS estimated_bytes,
           CASE WHEN o_orderstatus <> 'O'
                THEN (CAST(round(o_totalprice * 100) AS BIGINT) + 1048575) // 1048576 * 1048576 END
               AS bytes_billed,
           CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'ERROR' ELSE 'RUNNING' END AS status,
           CASE o_orderstatus WHEN 'O' THEN 'RUNNING' ELSE 'DONE' END AS state,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month
    FROM orders)"""
_USED = """
used AS (
    SELECT project_id, month, CAST(sum(bytes_billed) AS BIGINT) AS bytes_used_month
    FROM ledger WHERE state = 'DONE' AND bytes_billed > 0 GROUP BY ALL)"""
_COSTS = """
costs AS (
    SELECT project_id, month, job_id, CAST(coalesce(bytes_billed, 0) AS BIGINT) AS bytes_billed,
           CAST(sum(coalesce(bytes_billed, 0)) OVER (PARTITION BY project_id, month
                ORDER BY start_time NULLS FIRST, job_id NULLS FIRST, bytes_billed NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS month_total_after
    FROM ledger WHERE status = 'SUCCESS')"""
_GAPS = """
gaps AS (
    SELECT * REPLACE (CASE WHEN CAST(job_id AS BIGINT) % 5 <> 0 THEN project_id END AS project_id,
                      CASE WHEN CAST(job_id AS BIGINT) % 3 = 0 THEN DATE '1996-02-01'
                           WHEN CAST(job_id AS BIGINT) % 7 <> 0 THEN month END AS month,
                      CASE WHEN CAST(job_id AS BIGINT) % 3 = 0 THEN TIMESTAMP '1996-02-29 12:00:00'
                           WHEN CAST(job_id AS BIGINT) % 7 <> 0 THEN start_time END AS start_time)
    FROM ledger)"""
_ORDER_TIMES = """
times AS (
    SELECT o_orderkey,
           CASE left(o_orderpriority, 1) WHEN '1' THEN 'click' WHEN '2' THEN 'view' WHEN '3' THEN 'purchase'
                WHEN '4' THEN 'error' END AS event_type,
           CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2024-01-01'
                WHEN o_orderkey % 11 <> 0 THEN TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 7919 % 2678400) END AS moment
    FROM orders)"""
_EVENT_ITEMS = r"""
items AS (
    SELECT event_id, ts,
           CASE dayofweek(ts) WHEN 0 THEN strftime(ts, '%d/%m/%Y') WHEN 1 THEN '2024-02-30'
                WHEN 2 THEN strftime(ts, '%Y%m%d') WHEN 3 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS date,
           CASE event_type WHEN 'error' THEN ' ' || chr(9) || ' '
                WHEN 'click' THEN chr(160) || event_type || chr(8195) WHEN 'signup' THEN NULL
                ELSE event_type END AS name,
           CASE hour(ts) WHEN 3 THEN '' WHEN 5 THEN NULL ELSE ' National ' END AS type
    FROM events),
checked AS (
    SELECT *, CASE WHEN date IS NULL THEN 'date: missing'
                   WHEN NOT regexp_full_match(date, '\d{4}-\d{2}-\d{2}')
                        OR try_strptime(date, '%Y-%m-%d') IS NULL THEN 'date: not YYYY-MM-DD'
                   WHEN name IS NULL THEN 'name: missing'
                   WHEN trim(name, chr(32) || chr(9)) = '' THEN 'name: blank'
                   WHEN type IS NULL THEN 'type: missing'
                   WHEN trim(type, chr(32) || chr(9)) = '' THEN 'type: blank' END AS reject_reason
    FROM items)"""


def _records_of(date: str, ingested_at: str, where: str) -> str:
    return f"""
    SELECT sha256(strftime({date}, '%Y-%m-%d') || '_' || lower({_NAME}) || '_' || lower(trim(type)))
               AS holiday_id,
           {date} AS date, {_NAME} AS name, lower(trim(type)) AS type, 'events' AS source,
           {ingested_at} AS ingested_at, event_id
    FROM checked WHERE {where}"""


def _level(used: str) -> str:
    pct = f"{used} / {float(_FREE)} * 100.0"
    return f"""CASE WHEN {pct} >= {BUDGET.operational_limit_pct} THEN 'BLOQUEIO_OPERACIONAL'
        WHEN {pct} >= 40 THEN 'ALERTA_CRITICO' WHEN {pct} >= 25 THEN 'ALERTA'
        WHEN {pct} >= 10 THEN 'ACOMPANHAMENTO' ELSE 'NORMAL' END"""


def _rounded(value: str, decimals: int) -> str:
    """Rounding of a double by its exact value, ties to even: that of printing."""
    return f"CAST(format('{{{{:.{decimals}f}}}}', CAST({value} AS DOUBLE)) AS DOUBLE)".replace("{{", "{").replace("}}", "}")


def _summary(used: str) -> str:
    pct = _rounded(f"bytes_used_month / {float(_FREE)} * 100", 4)
    left = f"greatest(0, {_CEILING} - bytes_used_month)"
    return f"""SELECT project_id, strftime(month, '%Y-%m') AS month, bytes_used_month,
                {_rounded("bytes_used_month / 1073741824.0", 3)} AS gib_used_month,
                {_rounded(f"{_FREE} / CAST(1073741824 AS DOUBLE)", 1)} AS free_tier_total_gib,
                {pct} AS pct_free_tier_used,
                {_rounded(f"greatest(CAST(0 AS DOUBLE), 100 - {pct})", 4)} AS pct_free_tier_remaining,
                {_rounded(f"{_CEILING} / CAST(1073741824 AS DOUBLE)", 1)} AS operational_ceiling_gib,
                {left} AS bytes_remaining_to_ceiling,
                {_rounded(f"{left} / CAST(1073741824 AS DOUBLE)", 3)} AS gib_remaining_to_ceiling,
                {_rounded(f"bytes_used_month / CAST({float(_CEILING)} AS DOUBLE) * 100", 2)} AS pct_ceiling_used,
                {_level('bytes_used_month')} AS alert_level,
                bytes_used_month >= {_CEILING} AS circuit_breaker_active
            FROM {used}"""


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}\n"


_TO_CALENDAR = (_RAW, _HOLIDAYS, _SPAN, _NEAR, _CALENDAR)
_TO_CALENDAR_CITY = (_RAW_CITY, _HOLIDAYS, _SPAN, _NEAR, _CALENDAR)
_TO_FACTS = (*_TO_CALENDAR, _SALES, _FACTS)
_SALE_VALUES = "* REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(revenue AS DOUBLE) AS revenue)"
_DIM = """
    SELECT calendar_date AS date, day_of_month AS day, month_number AS month, month_name,
           quarter_number AS quarter, year_number AS year, day_of_week_num AS day_of_week,
           day_of_week_name AS day_name, week_of_year, is_weekend, is_business_day, is_holiday,
           holiday_name, holiday_type, days_to_holiday, days_after_holiday, is_pre_holiday_window,
           is_post_holiday_window
    FROM calendar"""
_LINE_SALES = """
line_sales AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS sale_id, l_orderkey, nullif(l_discount, 0) AS discount,
           l_returnflag AS flag, CAST(l_extendedprice * (1 - l_tax * 20) AS DECIMAL(18,2)) AS revenue,
           CAST(l_quantity AS BIGINT) - 1 AS quantity
    FROM lineitem)"""
_ARRIVED = """
existing AS (
    SELECT *, 0 AS generation FROM raw WHERE o_orderstatus <> 'O'),
merged AS (
    SELECT * FROM (SELECT * FROM existing UNION ALL SELECT *, 1 FROM raw WHERE o_orderstatus = 'O')
    QUALIFY row_number() OVER (PARTITION BY holiday_id ORDER BY generation DESC, ingested_at DESC) = 1)"""
_BODIES = """
bodies AS (
    SELECT *, first_value(event_type) OVER (PARTITION BY event_id // 100 ORDER BY event_id) = 'error' AS failed
    FROM events)"""


def _report() -> str:
    """One count per test of the data-quality suite."""
    relations = {
        "stg_holidays": "holidays",
        "stg_sales": "sales",
        "commercial_calendar": "calendar",
        "dim_calendar": "(SELECT *, calendar_date AS date FROM calendar)",
        "fct_sales": "facts",
        "mart_opportunities": "mart",
    }
    unique = {
        "stg_holidays": ["holiday_id"],
        "stg_sales": ["sale_id"],
        "commercial_calendar": ["calendar_date"],
        "dim_calendar": ["date"],
        "fct_sales": ["sale_id"],
    }
    not_null = {
        "stg_holidays": "holiday_id holiday_date holiday_name holiday_type data_source ingested_at",
        "stg_sales": "sale_id sale_date revenue",
        "commercial_calendar": "calendar_date is_weekend is_holiday is_business_day",
        "dim_calendar": "date is_business_day is_holiday",
        "fct_sales": "sale_id sale_date quantity revenue sales_period_context",
        "mart_opportunities": (
            "holiday_name product_category sales_growth_pct opportunity_score recommendation"
        ),
    }
    accepted = [
        ("stg_holidays", "holiday_type", "'national', 'facultativo', 'state', 'municipal'"),
        (
            "fct_sales",
            "sales_period_context",
            "'DIA_COMUM', 'PRE_FERIADO', 'DURANTE_FERIADO', 'POS_FERIADO'",
        ),
        ("mart_opportunities", "opportunity_score", "'ALTA', 'MEDIA', 'BAIXA'"),
    ]
    rows = []
    for relation, columns in unique.items():
        for column in columns:
            rows.append(
                ("unique", relation, column, f"SELECT count(*) FROM (SELECT {column} FROM "
                 f"{relations[relation]} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
            )
    for relation, columns in not_null.items():
        for column in columns.split():
            rows.append(
                ("not_null", relation, column,
                 f"SELECT count(*) FROM {relations[relation]} WHERE {column} IS NULL")
            )
    for relation, column, values in accepted:
        rows.append(
            ("accepted_values", relation, column, f"SELECT count(DISTINCT {column}) FROM "
             f"{relations[relation]} WHERE {column} NOT IN ({values})")
        )
    rows.append(
        ("relationships", "fct_sales", "sale_date", "SELECT count(*) FROM facts "
         "WHERE sale_date IS NOT NULL AND sale_date NOT IN (SELECT calendar_date FROM calendar)")
    )
    rows.append(
        ("positive_revenue", "stg_sales", "revenue",
         "SELECT count(*) FROM sales WHERE revenue < 0 OR quantity <= 0")
    )
    body = "\nUNION ALL ".join(
        f"SELECT '{test}' AS test, '{relation}' AS relation, '{column}' AS column_name, ({count}) AS failures"
        for test, relation, column, count in rows
    )
    # Tables keep the repeated use of the heavier relations cheap.
    heavy = [part.replace(" AS (", " AS MATERIALIZED (", 1) for part in (_HOLIDAYS, _CALENDAR, _SALES, _FACTS)]
    mart = _MART.strip()
    grown, select = mart.split("\nSELECT", 1)
    return (
        _with(_RAW_CITY, heavy[0], _SPAN, _NEAR, *heavy[1:], _NAMED, _window("next_name"), _BASELINE, grown,
              f"mart AS MATERIALIZED (SELECT{select})")
        + f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"
    )


_ITEMS = """, numbered AS (SELECT *, CAST(job_id AS BIGINT) AS number FROM ledger)
SELECT CASE WHEN number % 13 <> 0 AND number % 7 <> 0 THEN job_id END AS job_id,
       CASE WHEN number % 13 <> 0 AND number % 7 <> 0 THEN execution_id END AS execution_id,
       CASE WHEN number % 13 <> 0 THEN project_id END AS project_id,
       CASE WHEN number % 13 <> 0 THEN start_time END AS start_time,
       CASE WHEN number % 13 <> 0 THEN status END AS status,
       CASE WHEN number % 13 <> 0 THEN bytes_billed END AS bytes_billed,
       CAST(NULL AS TIMESTAMP) AS end_time,
       CASE WHEN number % 13 = 0 THEN 'record: not an object'
            WHEN number % 17 = 0 THEN 'end_time: does not fit' END AS reject_reason
FROM numbered"""
_COSTED = f"""SELECT project_id, month, job_id, bytes_billed,
       {_rounded("bytes_billed / CAST(1099511627776 AS DOUBLE) * 6.25", 4)} AS estimated_cost_usd,
       month_total_after, {_level('month_total_after')} AS alert_level
FROM costs"""


def oracle_sql() -> dict[str, str]:
    events_raw = f"""
    WITH typed AS (
        SELECT sha256(strftime(ts, '%Y-%m-%d') || '_' || event_type || '_national') AS holiday_id,
               CAST(ts AS DATE) AS holiday_date,
               trim('  ' || upper(event_type[1]) || event_type[2:] || chr(12288), {_BLANKS}) AS holiday_name,
               lower(trim('NATIONAL ', {_BLANKS})) AS holiday_type, 'user-' || user_id AS data_source,
               ts AS ingested_at
        FROM events)
    SELECT * FROM typed
    QUALIFY row_number() OVER (PARTITION BY holiday_id ORDER BY ingested_at DESC, data_source DESC) = 1"""
    lenient_date = (
        "CAST(coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%Y%m%d')) AS DATE)"
    )
    lenient = (
        "date NOT LIKE '%/%' AND date <> '2024-02-30' AND trim(name, chr(32) || chr(9)) <> '' "
        "AND trim(type) <> ''"
    )
    return {
        "date_spine": _with(_SPAN_OF_ORDERS) + "SELECT * FROM spine",
        "calendar_parts": _with(_SPAN_OF_ORDERS) + f"SELECT calendar_date, {_PARTS} FROM spine d",
        "nearest_holiday": _with(_RAW, _HOLIDAYS, _SPAN, _NEAR)
        + """SELECT calendar_date, next_holiday_date,
                CAST(date_diff('day', calendar_date, next_holiday_date) AS INTEGER) AS days_to_holiday,
                prev_holiday_date,
                CAST(date_diff('day', prev_holiday_date, calendar_date) AS INTEGER) AS days_after_holiday
             FROM near""",
        "commercial_calendar": _with(*_TO_CALENDAR) + "SELECT * FROM calendar",
        "commercial_calendar_duplicate_dates": _with(*_TO_CALENDAR_CITY) + "SELECT * FROM calendar",
        "commercial_calendar_first_of_date": _with(
            _RAW_CITY,
            _HOLIDAYS.replace("holidays AS", "every_holiday AS"),
            """holidays AS (
                SELECT * FROM every_holiday
                QUALIFY row_number() OVER (PARTITION BY holiday_date ORDER BY holiday_id) = 1)""",
            _SPAN,
            _NEAR,
            _CALENDAR,
        )
        + "SELECT * FROM calendar",
        "commercial_calendar_no_holidays": _with(
            _RAW,
            _HOLIDAYS.replace("FROM raw", "FROM raw WHERE type = 'state'"),
            _SPAN_OF_ORDERS,
            _NEAR,
            _CALENDAR,
        )
        + "SELECT * FROM calendar",
        "dim_calendar": _with(*_TO_CALENDAR) + _DIM,
        "materialised_calendar": _with(*_TO_CALENDAR) + "SELECT * FROM calendar",
        "stg_sales": _with(_SALES) + f"SELECT {_SALE_VALUES} FROM sales",
        "stg_sales_sub_cent": _with(
            _SALES.replace(
                "CAST(p_retailprice AS DECIMAL(18,2)) AS",
                "CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.001 AS DECIMAL(4,3)) AS",
            )
        )
        + f"SELECT {_SALE_VALUES} FROM sales",
        "csv_roundtrip": _with(_SALES) + f"SELECT {_SALE_VALUES} FROM sales",
        "stg_holidays": events_raw,
        "holiday_keys": """
            SELECT event_id, sha256(strftime(ts, '%Y-%m-%d') || '_' || event_type || '_national') AS holiday_id
            FROM events""",
        "validate_valid": _with(_EVENT_ITEMS)
        + _records_of("CAST(date AS DATE)", "TIMESTAMP '2026-01-05 12:00:00'", "reject_reason IS NULL"),
        "validate_rejects": _with(_EVENT_ITEMS)
        + "SELECT event_id, reject_reason FROM checked WHERE reject_reason IS NOT NULL",
        "validate_lenient": _with(_EVENT_ITEMS) + _records_of(lenient_date, "ts", lenient),
        "payload_scan": _with(_BODIES)
        + """SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS name, 'National' AS type,
                    CAST(NULL AS VARCHAR) AS reject_reason FROM bodies WHERE NOT failed""",
        "payload_rejected_files": _with(_BODIES)
        + """SELECT DISTINCT '{"message":"rate limit","body_no":' || (event_id // 100) || '}' AS body,
                    'payload: not a list' AS reject_reason FROM bodies WHERE failed""",
        "holiday_upsert": _with(_RAW, _ARRIVED)
        + """SELECT holiday_id, strftime(date, '%Y-%m-%d') AS date, chr(160) || ' ' || name || chr(9) AS name,
                    ' National ' AS type, source, ingested_at FROM merged""",
        "upsert_roundtrip": _with(_RAW, _ARRIVED)
        + """SELECT holiday_id, date, chr(160) || ' ' || name || chr(9) AS name, ' National ' AS type, source,
                    ingested_at FROM merged""",
        "versioned_upsert": _with(_RAW, _ARRIVED)
        + """SELECT holiday_id, date, chr(160) || ' ' || name || chr(9) AS name, ' National ' AS type, source,
                    ingested_at FROM merged""",
        "append_readback": """
            SELECT 'user-' || user_id AS id, event_type AS message, ts AS created_at
            FROM events WHERE user_id = 8""",
        "run_metrics": _with(
            _BODIES,
            """run AS (
                SELECT TIMESTAMP '2026-01-05 12:00:00' AS start_time, TIMESTAMP '2026-01-05 12:00:02.345' AS end_time)""",
        )
        + f"""SELECT 'holidays' AS pipeline, strftime(start_time, '%Y%m%d_%H%M%S') AS execution_id,
                    start_time, end_time, 'SUCCESS' AS status, n AS records_received, n AS records_loaded,
                    {_rounded("date_diff('microsecond', start_time, end_time) / CAST(1000000 AS DOUBLE)", 2)}
                        AS duration_seconds,
                    CAST(NULL AS VARCHAR) AS error_message
             FROM run, (SELECT count(*) AS n FROM bodies WHERE NOT failed)""",
        "dry_run_sample": _with(_EVENT_ITEMS)
        + f"""SELECT date, name, type FROM ({_records_of("CAST(date AS DATE)", "ts", "reject_reason IS NULL")})
              ORDER BY event_id LIMIT 3""",
        "holiday_ingest": _with(_BODIES)
        + """, loaded AS (
                SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS name FROM bodies WHERE NOT failed)
            SELECT sha256(strftime(date, '%Y-%m-%d') || '_' || name || '_national') AS holiday_id, date, name,
                   'national' AS type, 'events' AS source, TIMESTAMP '2026-01-05 12:00:00' AS ingested_at,
                   'SUCCESS' AS status,
                   (SELECT count(*) FROM bodies WHERE NOT failed) AS records_received,
                   (SELECT count(*) FROM loaded) AS records_loaded
            FROM loaded""",
        "holiday_ingest_years": """
            WITH loaded AS (SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS name FROM events)
            SELECT sha256(strftime(date, '%Y-%m-%d') || '_' || name || '_national') AS holiday_id, date, name,
                   'national' AS type, 'events' AS source, TIMESTAMP '2026-01-05 12:00:00' AS ingested_at,
                   'SUCCESS' AS status, (SELECT count(*) FROM loaded) AS records_received,
                   (SELECT count(*) FROM loaded) AS records_loaded
            FROM loaded""",
        "fct_sales": _with(*_TO_FACTS) + f"SELECT {_SALE_VALUES} FROM facts",
        "fct_sales_duplicate_dates": _with(*_TO_CALENDAR_CITY, _SALES, _FACTS)
        + f"SELECT {_SALE_VALUES} FROM facts",
        "sales_by_context": _with(*_TO_FACTS)
        + "SELECT sales_period_context, count(*) AS n_sales FROM facts GROUP BY ALL",
        "sales_outside_calendar": """
            SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sale_id,
                   CAST(l_shipdate AS DATE) AS sale_date, l_extendedprice AS revenue
            FROM lineitem
            WHERE CAST(l_shipdate AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
        "baseline_sales": _with(*_TO_FACTS, _BASELINE)
        + """SELECT product_category, cents / 100.0 AS avg_revenue_normal,
                    hundredths / 100.0 AS avg_quantity_normal FROM baseline""",
        "baseline_sales_sub_cent": _with(*_TO_FACTS)
        + """SELECT product_category,
                    CAST((2 * sum(CAST(revenue * 100 AS HUGEINT)) + 1000 * count(*)) // (2000 * count(*)) AS BIGINT)
                        / 100.0 AS avg_revenue_normal
             FROM facts WHERE sales_period_context = 'DIA_COMUM' GROUP BY product_category""",
        "pre_holiday_sales": _with(*_TO_FACTS, _NAMED, _window("next_name"))
        + """SELECT holiday_name, product_category, first_sale_window, last_sale_window,
                    cents / 100.0 AS avg_revenue_before_holiday,
                    hundredths / 100.0 AS avg_quantity_before_holiday, total AS total_revenue_pre_holiday,
                    transactions AS total_transactions_pre_holiday FROM before""",
        "transactions_before_holidays": _with(*_TO_FACTS, _NAMED, _window("next_name"))
        + """SELECT holiday_name, product_category, transactions AS total_transactions_pre_holiday FROM before""",
        "mart_opportunities": _with(*_TO_FACTS, _NAMED, _window("next_name"), _BASELINE, _MART.lstrip()),
        "mart_opportunities_as_written": _with(
            *_TO_FACTS, _NAMED_AS_WRITTEN, _window("holiday_name"), _BASELINE, _MART.lstrip()
        ),
        "positive_revenue_violations": _with(_LINE_SALES)
        + """SELECT sale_id, CAST(revenue AS DOUBLE) AS revenue, quantity FROM line_sales
             WHERE revenue < 0 OR quantity <= 0""",
        "dq_unique": _with(_LINE_SALES)
        + """SELECT sale_id AS value, count(*) AS n_records FROM line_sales
             WHERE sale_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
        "dq_not_null": _with(_LINE_SALES) + "SELECT sale_id, flag FROM line_sales WHERE discount IS NULL",
        "dq_accepted_values": _with(_LINE_SALES)
        + """SELECT flag AS value, count(*) AS n_records FROM line_sales
             WHERE flag NOT IN ('A', 'N') GROUP BY 1""",
        "dq_relationships": """
            SELECT doc_id AS value, count(*) AS n_records FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY 1""",
        "data_quality_report": _report(),
        "monthly_usage": _with(_LEDGER, _USED) + "SELECT * FROM used",
        "monthly_usage_success_only": _with(_LEDGER)
        + """SELECT project_id, month,
                    CAST(sum(CASE WHEN status = 'SUCCESS' THEN coalesce(bytes_billed, 0) ELSE 0 END) AS BIGINT)
                        AS bytes_used_month
             FROM ledger GROUP BY ALL""",
        "current_month_usage": _with(_LEDGER)
        + """SELECT project_id, DATE '2001-07-01' AS month,
                    CAST(sum(coalesce(bytes_billed, 0)) AS BIGINT) AS bytes_used_month
             FROM ledger WHERE status = 'SUCCESS' AND start_time >= TIMESTAMP '2001-07-01'
                  AND start_time < TIMESTAMP '2001-08-01' GROUP BY ALL""",
        "alert_levels": _with(_LEDGER, _USED)
        + f"SELECT *, {_level('bytes_used_month')} AS alert_level FROM used",
        "usage_summary": _with(_LEDGER, _USED) + _summary("used"),
        "idle_project_summary": _with(
            _LEDGER,
            _USED,
            """projects AS (
                SELECT DISTINCT project_id FROM ledger UNION SELECT 'idle-' || r_name FROM region)""",
            """in_july AS (
                SELECT p.project_id, DATE '2001-07-01' AS month,
                       CAST(coalesce(u.bytes_used_month, 0) AS BIGINT) AS bytes_used_month
                FROM projects p LEFT JOIN (SELECT * FROM used WHERE month = DATE '2001-07-01') u USING (project_id))""",
        )
        + _summary("in_july"),
        "request_verdicts": _with(_LEDGER, _USED)
        + f"""SELECT project_id, month, job_id, estimated_bytes,
                     CASE WHEN estimated_bytes > {_LARGEST} THEN 'TOO_LARGE'
                          WHEN coalesce(bytes_used_month, 0) + estimated_bytes > {_CEILING}
                          THEN 'CIRCUIT_BREAKER' ELSE 'ADMITTED' END AS verdict,
                     coalesce(bytes_used_month, 0) + estimated_bytes AS projected_bytes
              FROM ledger LEFT JOIN used USING (project_id, month) WHERE state = 'RUNNING'""",
        "job_costs": _with(_LEDGER, _COSTS) + _COSTED,
        "job_costs_with_gaps": _with(_LEDGER, _GAPS, _COSTS.replace("FROM ledger", "FROM gaps")) + _COSTED,
        "nearest_events": _with(_ORDER_TIMES)
        + """SELECT o_orderkey, event_type, moment, p.ts AS prev_mark, n.ts AS next_mark FROM times
             ASOF LEFT JOIN (SELECT DISTINCT ts FROM events) p ON moment >= p.ts
             ASOF LEFT JOIN (SELECT DISTINCT ts FROM events) n ON moment <= n.ts""",
        "nearest_events_of_kind": _with(_ORDER_TIMES)
        + """SELECT o_orderkey, t.event_type, moment, p.ts AS prev_mark, n.ts AS next_mark FROM times t
             ASOF LEFT JOIN (SELECT DISTINCT event_type, ts FROM events) p ON t.event_type = p.event_type AND moment >= p.ts
             ASOF LEFT JOIN (SELECT DISTINCT event_type, ts FROM events) n ON t.event_type = n.event_type AND moment <= n.ts""",
        "ledger_retention": _with(_LEDGER)
        + """SELECT project_id, job_id, start_time, bytes_billed FROM ledger
             QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY start_time DESC, job_id DESC) <= 500""",
        "ledger_append_retention": _with(_LEDGER)
        + """SELECT project_id, job_id, start_time, bytes_billed FROM ledger
             QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY start_time DESC, job_id DESC) <= 500""",
        "restricted_projects": _with(_LEDGER)
        + """SELECT project_id, job_id FROM ledger
             WHERE lower(project_id) LIKE '%urgent%' OR lower(project_id) LIKE '%low%'""",
        "ledger_import": _with(_LEDGER)
        + f"""SELECT execution_id, step_name, job_id, project_id, start_time, end_time,
                     estimated_bytes AS bytes_processed, bytes_billed,
                     {_rounded("coalesce(bytes_billed, 0) / CAST(1099511627776 AS DOUBLE) * 6.25", 4)}
                         AS estimated_cost_usd,
                     status, {_level('coalesce(bytes_billed, 0)')} AS alert_level,
                     strftime(start_time, '%Y-%m') AS run_month
              FROM ledger""",
        "ledger_items": _with(_LEDGER) + _ITEMS,
        "ledger_items_from_arrays": _with(_LEDGER) + _ITEMS,
        "ledger_usage_from_arrays": _with(_LEDGER)
        + """SELECT project_id, month,
                    CAST(sum(CASE WHEN status = 'SUCCESS' THEN coalesce(bytes_billed, 0) ELSE 0 END) AS BIGINT)
                        AS bytes_used_month
             FROM ledger WHERE CAST(job_id AS BIGINT) % 13 <> 0 GROUP BY ALL""",
    }
