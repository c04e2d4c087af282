"""Oracle SQL (DuckDB dialect) for every proof query with a SQL form.

Written from the models' SQL semantics, independently of the DataFrame code:
the forward fill is the calendar + ``last_value(... IGNORE NULLS)`` window, the
main payment type is ``row_number`` + inner join, the as-of lookup is an
``ASOF LEFT JOIN``.  Decimal division is done on scaled integers so the
9-place rounding is exact (half away from zero).  Tables ``orders lineitem
customer supplier part nation events`` are the driver's views.
"""

from __future__ import annotations

ZONE = "America/Sao_Paulo"


def _to_utc(wall: str) -> str:
    return f"(({wall} AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC')"


def _to_wall(utc: str) -> str:
    return f"(({utc} AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}')"


def _utc(expr: str) -> str:
    """Of the two instants of a repeated wall-clock time the earlier one (the engine takes the later)."""
    wall = f"CAST({expr} AS TIMESTAMP)"
    hour_before = f"({_to_utc(wall)} - INTERVAL 1 HOUR)"
    return f"CASE WHEN {_to_wall(hour_before)} = {wall} THEN {hour_before} ELSE {_to_utc(wall)} END"


def _local_date(expr: str) -> str:
    return f"CAST(({expr} AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS DATE)"


def _ratio9(num: str, den: str) -> str:
    """num / den rounded half away from zero to 9 places, exactly."""
    n = f"CAST({num} * 1000000000 AS HUGEINT)"
    d = f"CAST({den} * 1000000000 AS HUGEINT)"
    q = f"((2 * abs({n}) * 1000000000 + abs({d})) // (2 * abs({d})))"
    return (f"CAST(CAST(sign({n}) * sign({d}) * {q} AS DECIMAL(38,0)) "
            f"* CAST('0.000000001' AS DECIMAL(10,9)) AS DECIMAL(38,9))")


N = "DECIMAL(38,9)"

CTES: dict[str, str] = {
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status,
               strftime(day, '%Y-%m-%d') || clock AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 11 <> 0 THEN strftime(day + 1, '%Y-%m-%d') || clock END AS order_approved_at,
               CASE WHEN o_orderstatus = 'F' THEN strftime(day + CAST(o_orderkey % 7 + 1 AS INTEGER), '%Y-%m-%d') || clock END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN strftime(day + CAST(
                   CASE WHEN o_orderkey % 53 = 0 THEN -1 ELSE o_orderkey % 38 + 7 END AS INTEGER), '%Y-%m-%d') || clock END
                   AS order_delivered_customer_date,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS day,
                     ' ' || lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0')
                         || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS clock
              FROM (SELECT *, (o_orderkey * 7919) % 86400 AS s FROM orders))""",
    "stg_orders": f"""
        SELECT order_id, customer_id, order_status,
               {_utc('order_purchase_timestamp')} AS purchased_at,
               {_utc('order_approved_at')} AS approved_at,
               {_utc('order_delivered_carrier_date')} AS delivered_carrier_at,
               {_utc('order_delivered_customer_date')} AS delivered_customer_at,
               CAST({_utc('order_estimated_delivery_date')} AS DATE) AS estimated_delivery_date
        FROM raw_orders""",
    "raw_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
               CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
        FROM lineitem""",
    "stg_items": f"""
        SELECT order_id, order_item_id, product_id, seller_id,
               CAST(CAST(shipping_limit_date AS TIMESTAMP) AS DATE) AS shipping_limit_date,
               CAST(price AS {N}) AS item_price, CAST(freight_value AS {N}) AS freight_value
        FROM raw_items""",
    "raw_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS payment_sequential,
               l_returnflag AS payment_type,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS payment_value,
               CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS payment_installments
        FROM lineitem""",
    "stg_payments": f"""
        SELECT order_id, payment_sequential, payment_type, CAST(payment_value AS {N}) AS payment_amount,
               CAST(payment_installments AS BIGINT) AS payment_installments
        FROM raw_payments""",
    "stg_payments_q": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS payment_sequential,
               l_returnflag AS payment_type,
               CAST(CAST(l_quantity AS DECIMAL(18,2)) AS {N}) AS payment_amount
        FROM lineitem""",
    "raw_rates": """
        SELECT 'D.' || currency || '.EUR.SP00.A' AS "KEY", 'D' AS FREQ, currency AS CURRENCY,
               'EUR' AS CURRENCY_DENOM, 'SP00' AS EXR_TYPE, 'A' AS EXR_SUFFIX,
               strftime(rate_date, '%Y-%m-%d') AS TIME_PERIOD, CAST(rate AS VARCHAR) AS OBS_VALUE,
               'A' AS OBS_STATUS
        FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'GBP' WHEN 'O' THEN 'BRL' ELSE 'USD' END AS currency,
                     CAST(o_orderdate AS DATE) AS rate_date,
                     max(CAST(o_totalprice AS DECIMAL(18,2))) AS rate
              FROM orders
              WHERE strftime(o_orderdate, '%A') NOT IN ('Saturday', 'Sunday')
              GROUP BY 1, 2)""",
    "stg_fx": f"""
        SELECT CURRENCY AS currency, CAST(TIME_PERIOD AS DATE) AS rate_date,
               CAST(OBS_VALUE AS {N}) AS rate_per_eur, OBS_STATUS AS obs_status
        FROM raw_rates""",
    "pivoted": """
        SELECT rate_date AS ecb_date,
               max(CASE WHEN currency = 'GBP' THEN rate_per_eur END) AS gbp_per_eur,
               max(CASE WHEN currency = 'BRL' THEN rate_per_eur END) AS brl_per_eur
        FROM stg_fx WHERE currency IN ('GBP', 'BRL') GROUP BY rate_date""",
    "ecb_days": f"""
        SELECT ecb_date, {_ratio9('gbp_per_eur', 'brl_per_eur')} AS gbp_per_brl
        FROM pivoted WHERE gbp_per_eur IS NOT NULL AND brl_per_eur IS NOT NULL""",
    "bounds": "SELECT min(ecb_date) AS first_date, max(ecb_date) AS last_date FROM ecb_days",
    "calendar": """
        SELECT CAST(d AS DATE) AS rate_date
        FROM bounds, LATERAL (SELECT unnest(generate_series(CAST(first_date AS TIMESTAMP),
                                                            CAST(last_date AS TIMESTAMP),
                                                            INTERVAL 1 DAY)) AS d)""",
    "fx_daily": """
        SELECT rate_date, gbp_per_brl, last_ecb_date, last_ecb_date != rate_date AS is_forward_filled
        FROM (SELECT c.rate_date,
                     last_value(e.gbp_per_brl IGNORE NULLS) OVER w AS gbp_per_brl,
                     last_value(e.ecb_date IGNORE NULLS) OVER w AS last_ecb_date
              FROM calendar c LEFT JOIN ecb_days e ON e.ecb_date = c.rate_date
              WINDOW w AS (ORDER BY c.rate_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "items_by_order": """
        SELECT order_id, count(*) AS item_count, sum(item_price) AS items_value,
               sum(freight_value) AS freight_value
        FROM stg_items GROUP BY order_id""",
    "payments_by_order": """
        SELECT t.order_id, t.total_paid, t.payment_count, m.main_payment_type
        FROM (SELECT order_id, sum(payment_amount) AS total_paid, count(*) AS payment_count
              FROM stg_payments GROUP BY order_id) t
        JOIN (SELECT order_id, payment_type AS main_payment_type
              FROM (SELECT order_id, payment_type,
                           row_number() OVER (PARTITION BY order_id
                                              ORDER BY type_amount DESC NULLS LAST,
                                                       first_sequential ASC NULLS FIRST,
                                                       payment_type ASC NULLS FIRST) AS type_rank
                    FROM (SELECT order_id, payment_type, sum(payment_amount) AS type_amount,
                                 min(CAST(payment_sequential AS BIGINT)) AS first_sequential
                          FROM stg_payments GROUP BY order_id, payment_type))
              WHERE type_rank = 1) m ON m.order_id = t.order_id""",
    "fct_orders": f"""
        SELECT o.order_id, o.customer_id, o.order_status, o.purchased_at,
               CAST(i.items_value AS {N}) AS items_value_brl,
               CAST(i.freight_value AS {N}) AS freight_value_brl,
               CAST(i.items_value + i.freight_value AS {N}) AS gross_revenue_brl,
               CAST(p.total_paid AS {N}) AS paid_brl,
               CAST(f.gbp_per_brl AS {N}) AS gbp_per_brl,
               CAST(round(CAST(i.items_value + i.freight_value AS DECIMAL(20,2))
                          * CAST(f.gbp_per_brl AS DECIMAL(18,9)), 2) AS {N}) AS gross_revenue_gbp,
               f.is_forward_filled AS is_fx_forward_filled,
               o.purchase_date,
               CAST(coalesce(i.item_count, 0) AS BIGINT) AS item_count,
               CAST(coalesce(p.payment_count, 0) AS BIGINT) AS payment_count,
               p.main_payment_type
        FROM (SELECT order_id, customer_id, order_status, purchased_at,
                     {_local_date('purchased_at')} AS purchase_date FROM stg_orders) o
        LEFT JOIN items_by_order i ON i.order_id = o.order_id
        LEFT JOIN payments_by_order p ON p.order_id = o.order_id
        LEFT JOIN fx_daily f ON f.rate_date = o.purchase_date""",
    "run_log": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS run_id, 'events' AS source,
               json_extract_string(props, '$.k') AS table_name,
               CASE event_type WHEN 'click' THEN 'started' WHEN 'purchase' THEN 'success'
                               WHEN 'error' THEN 'failed' ELSE 'started' END AS status,
               ts AS started_at, ts AS event_at
        FROM events""",
}

DEPENDS = {
    "stg_orders": ["raw_orders"], "stg_items": ["raw_items"], "stg_payments": ["raw_payments"],
    "stg_fx": ["raw_rates"], "pivoted": ["stg_fx"], "ecb_days": ["pivoted"], "bounds": ["ecb_days"],
    "calendar": ["bounds"], "fx_daily": ["calendar", "ecb_days"], "items_by_order": ["stg_items"],
    "payments_by_order": ["stg_payments"],
    "fct_orders": ["stg_orders", "items_by_order", "payments_by_order", "fx_daily"],
}


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in DEPENDS.get(n, []):
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n"


def _fct_variant(items_join: str) -> str:
    return CTES["fct_orders"].replace("LEFT JOIN items_by_order", f"{items_join} JOIN items_by_order")


SQL: dict[str, str] = {}

SQL["q_stg_orders"] = with_ctes("stg_orders") + "SELECT * FROM stg_orders"
SQL["q_local_times"] = with_ctes("raw_orders") + f"""
    SELECT order_id, wall, wall_kind, at_utc, CASE WHEN wall_kind = 'overlap' THEN later ELSE at_utc END AS at_utc_later,
           CAST(at_utc AS DATE) AS utc_date, CAST({_to_wall('at_utc')} AS DATE) AS local_date
    FROM (SELECT order_id, wall, later, CASE WHEN back <> wall THEN 'gap' WHEN again = wall THEN 'overlap' END AS wall_kind,
                 CASE WHEN again = wall THEN later - INTERVAL 1 HOUR ELSE later END AS at_utc
          FROM (SELECT *, {_to_wall('later')} AS back, {_to_wall('(later - INTERVAL 1 HOUR)')} AS again
                FROM (SELECT order_id, wall, {_to_utc('wall')} AS later
                      FROM (SELECT order_id, CAST(order_purchase_timestamp AS TIMESTAMP) AS wall FROM raw_orders))))"""
SQL["q_zone_transitions"] = f"""
    WITH walls AS (SELECT DISTINCT unnest(generate_series(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP),
                       CAST(o_orderdate AS DATE) + INTERVAL 1410 MINUTE, INTERVAL 30 MINUTE)) AS wall FROM orders),
    marked AS (SELECT wall, {_to_wall(_to_utc('wall'))} AS back, {_to_wall('(' + _to_utc('wall') + ' - INTERVAL 1 HOUR)')} AS again
               FROM walls)
    SELECT CAST(wall AS DATE) AS wall_date, CASE WHEN back <> wall THEN 'gap' ELSE 'overlap' END AS kind, min(wall) AS wall_from
    FROM marked WHERE back <> wall OR again = wall GROUP BY 1, 2"""
SQL["q_stg_customers"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_uid,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           lower(c_mktsegment) AS customer_city_name,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS customer_state_code
    FROM customer"""
SQL["q_stg_sellers"] = """
    SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
           lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           s_name AS seller_city_name, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS seller_state_code
    FROM supplier"""
SQL["q_stg_reviews"] = """
    SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id % 1000 AS VARCHAR) AS order_id,
           CAST(n_chars % 5 + 1 AS BIGINT) AS review_score, lang AS review_comment_title,
           text AS review_comment_message,
           DATE '2018-01-01' + CAST(doc_id % 365 AS INTEGER) AS review_creation_date,
           DATE '2018-01-02' + CAST(doc_id % 365 AS INTEGER) AS review_answer_timestamp
    FROM documents"""
SQL["q_stg_geolocation"] = """
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code_prefix,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code,
           lower(c_mktsegment) AS city_name,
           '-' || CAST(c_custkey % 90 AS VARCHAR) || '.5450' AS latitude,
           '-' || CAST(c_custkey % 180 AS VARCHAR) || '.6390' AS longitude
    FROM customer"""
SQL["q_stg_translation"] = """
    SELECT lower(p_type) AS product_category_name, min(p_type) AS product_category_name_en
    FROM part GROUP BY ALL"""
SQL["q_stg_order_items"] = with_ctes("stg_items") + "SELECT * FROM stg_items"
SQL["q_stg_payments"] = with_ctes("stg_payments") + "SELECT * FROM stg_payments"
SQL["q_stg_fx"] = with_ctes("stg_fx") + "SELECT * FROM stg_fx"
SQL["q_filter_in"] = with_ctes("stg_fx") + """
    SELECT currency, rate_date, rate_per_eur FROM stg_fx
    WHERE currency IN ('GBP', 'USD') AND strftime(rate_date, '%A') IN ('Monday', 'Friday')"""
SQL["q_range_filter"] = with_ctes("stg_fx") + """
    SELECT currency, rate_date, rate_per_eur FROM stg_fx
    WHERE rate_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
      AND (rate_per_eur IS NULL OR NOT rate_per_eur BETWEEN 100000 AND 400000)"""
SQL["q_items_by_order"] = with_ctes("items_by_order") + "SELECT * FROM items_by_order"
SQL["q_left_join_no_fanout"] = with_ctes("stg_orders", "items_by_order") + """
    SELECT o.order_id, CAST(coalesce(i.item_count, 0) AS BIGINT) AS item_count,
           i.items_value, i.freight_value
    FROM stg_orders o LEFT JOIN items_by_order i ON i.order_id = o.order_id"""
SQL["q_payments_by_type"] = with_ctes("stg_payments") + """
    SELECT order_id, payment_type, sum(payment_amount) AS type_amount, count(*) AS type_count,
           min(CAST(payment_sequential AS BIGINT)) AS first_sequential
    FROM stg_payments GROUP BY order_id, payment_type"""
SQL["q_payments_by_order"] = with_ctes("payments_by_order") + "SELECT * FROM payments_by_order"
_BY_TYPE_Q = """
    SELECT order_id, payment_type, sum(payment_amount) AS type_amount,
           min(CAST(payment_sequential AS BIGINT)) AS first_sequential
    FROM stg_payments_q GROUP BY order_id, payment_type"""
_RANKED_Q = f"""
    SELECT order_id, payment_type, type_amount, first_sequential,
           CAST(row_number() OVER (PARTITION BY order_id ORDER BY type_amount DESC NULLS LAST,
                                   first_sequential ASC NULLS FIRST,
                                   payment_type ASC NULLS FIRST) AS BIGINT) AS type_rank
    FROM ({_BY_TYPE_Q})"""
SQL["q_row_number"] = with_ctes("stg_payments_q") + _RANKED_Q
SQL["q_main_payment_type"] = with_ctes("stg_payments_q") + f"""
    SELECT order_id, payment_type AS main_payment_type FROM ({_RANKED_Q}) WHERE type_rank = 1"""
SQL["q_pivot_rates"] = with_ctes("pivoted") + "SELECT * FROM pivoted"
SQL["q_fx_cross_rate"] = with_ctes("ecb_days") + "SELECT * FROM ecb_days"
SQL["q_bounds"] = with_ctes("bounds") + "SELECT * FROM bounds"
SQL["q_calendar"] = with_ctes("calendar") + "SELECT * FROM calendar"
SQL["q_calendar_gaps"] = with_ctes("calendar", "ecb_days") + """
    SELECT c.rate_date FROM calendar c LEFT JOIN ecb_days e ON e.ecb_date = c.rate_date
    WHERE e.ecb_date IS NULL"""
SQL["q_forward_fill"] = with_ctes("fx_daily") + "SELECT * FROM fx_daily"
_ORDERS_DAY = f"SELECT order_id, {_local_date('purchased_at')} AS purchase_date FROM stg_orders"
SQL["q_fx_lookup"] = with_ctes("stg_orders", "fx_daily") + f"""
    SELECT o.order_id, o.purchase_date, f.gbp_per_brl, f.is_forward_filled
    FROM ({_ORDERS_DAY}) o LEFT JOIN fx_daily f ON f.rate_date = o.purchase_date"""
SQL["q_asof_rate"] = with_ctes("stg_orders", "ecb_days") + f"""
    SELECT o.order_id, o.purchase_date, e.ecb_date, e.gbp_per_brl
    FROM ({_ORDERS_DAY}) o ASOF LEFT JOIN ecb_days e ON o.purchase_date >= e.ecb_date"""
SQL["q_asof_by_key"] = """
    WITH e AS (SELECT event_id, user_id, ts, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events),
    bought AS (SELECT user_id, ts, max(value) AS value FROM e WHERE event_type = 'purchase' GROUP BY user_id, ts)
    SELECT o.event_id, o.user_id, b.ts AS purchase_ts, b.value AS purchase_value
    FROM (SELECT * FROM e WHERE event_type <> 'purchase') o
    ASOF LEFT JOIN bought b ON o.user_id = b.user_id AND o.ts >= b.ts"""
SQL["q_last_ignore_nulls"] = """
    SELECT event_id, user_id,
           last_value(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END
                      IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               AS last_purchase_value
    FROM events"""
SQL["q_last_n_per_key"] = """
    SELECT user_id, event_id, ts, recency FROM (
        SELECT user_id, event_id, ts,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS BIGINT)
                   AS recency
        FROM events) WHERE recency <= 3"""
SQL["q_fct_orders"] = with_ctes("fct_orders") + "SELECT * FROM fct_orders"
SQL["q_count_if"] = with_ctes("stg_payments") + """
    SELECT n_with_instalments, n_with_instalments = 0 AS fails
    FROM (SELECT CAST(count_if(payment_installments > 1) AS BIGINT) AS n_with_instalments
          FROM stg_payments)"""
SQL["q_count_non_null_grouped"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
           CAST(length(p_name) AS VARCHAR) AS product_name_length,
           CAST(length(p_brand) AS VARCHAR) AS product_description_length,
           CAST(p_size AS BIGINT) AS product_weight_g, CAST(NULL AS BIGINT) AS product_length_cm,
           CAST(NULL AS BIGINT) AS product_height_cm, CAST(NULL AS BIGINT) AS product_width_cm,
           count(CASE WHEN p_type != 'SMALL' THEN CAST(p_size AS BIGINT) END) AS product_photos_qty
    FROM part GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""


def _days_rule_sql(year: int) -> str:
    return f"""
    SELECT 'expected 365 rows for {year}' AS problem, CAST(NULL AS DATE) AS rate_date,
           CAST(count(*) AS {N}) AS value
    FROM fx_daily WHERE rate_date BETWEEN DATE '{year}-01-01' AND DATE '{year}-12-31'
    HAVING count(*) != 365"""


SQL["q_having_no_group"] = with_ctes("fx_daily") + _days_rule_sql(1996)
SQL["q_assert_fx_sane"] = with_ctes("fx_daily") + _days_rule_sql(1998) + f"""
    UNION ALL
    SELECT 'gbp_per_brl outside 0.5-2.0 in 1998', rate_date, CAST(gbp_per_brl AS {N})
    FROM fx_daily WHERE rate_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
      AND (gbp_per_brl IS NULL OR NOT gbp_per_brl BETWEEN 0.5 AND 2.0)
    UNION ALL
    SELECT 'weekend not forward-filled', rate_date, CAST(gbp_per_brl AS {N})
    FROM fx_daily WHERE strftime(rate_date, '%A') IN ('Saturday', 'Sunday')
      AND (NOT is_forward_filled OR last_ecb_date >= rate_date)
    UNION ALL
    SELECT 'rate older than 2 days', rate_date, CAST(gbp_per_brl AS {N})
    FROM fx_daily WHERE date_diff('day', last_ecb_date, rate_date) > 2"""
SQL["q_assert_event_order"] = with_ctes("stg_orders", "raw_items") + f"""
    SELECT i.order_id, i.order_item_id, o.order_status, o.purchased_at,
           {_utc('i.shipping_limit_date')} AS shipped_at
    FROM raw_items i JOIN stg_orders o ON o.order_id = i.order_id
    WHERE {_utc('i.shipping_limit_date')} < o.purchased_at"""
SQL["q_assert_paid_vs_gross"] = with_ctes("fct_orders") + f"""
    SELECT order_id, order_status, gross_revenue_brl, paid_brl,
           CAST(paid_brl - gross_revenue_brl AS {N}) AS difference
    FROM fct_orders
    WHERE item_count > 0 AND payment_count > 0 AND abs(gross_revenue_brl - paid_brl) > 0.01"""
SQL["q_reconcile_count"] = (
    with_ctes("fct_orders") + f", fct_inner AS ({_fct_variant('INNER')})\n" + """
    SELECT 'left' AS variant, CAST((SELECT count(*) FROM fct_orders) AS BIGINT) AS fct_rows,
           CAST((SELECT count(*) FROM stg_orders) AS BIGINT) AS stg_rows,
           (SELECT count(*) FROM fct_orders) != (SELECT count(*) FROM stg_orders) AS fails
    UNION ALL
    SELECT 'inner_mutant', CAST((SELECT count(*) FROM fct_inner) AS BIGINT),
           CAST((SELECT count(*) FROM stg_orders) AS BIGINT),
           (SELECT count(*) FROM fct_inner) != (SELECT count(*) FROM stg_orders)""")
SQL["q_reconcile_total"] = (
    with_ctes("fct_orders", "raw_items") + f", fct_inner AS ({_fct_variant('INNER')}),\n" + f"""
    raw_total AS (SELECT coalesce(sum(CAST(price AS {N}) + CAST(freight_value AS {N})), 0) AS t
                  FROM raw_items),
    totals AS (
        SELECT 'left' AS variant, (SELECT coalesce(sum(gross_revenue_brl), 0) FROM fct_orders) AS f
        UNION ALL
        SELECT 'inner_mutant', (SELECT coalesce(sum(gross_revenue_brl), 0) FROM fct_inner))
    SELECT variant, CAST(f AS {N}) AS fct_total, CAST(r.t AS {N}) AS raw_total,
           CAST(f - r.t AS {N}) AS difference, abs(f - r.t) > 0.01 AS fails
    FROM totals, raw_total r""")
SQL["q_test_unique"] = with_ctes("stg_orders") + """
    SELECT customer_id, count(*) AS n_records FROM stg_orders WHERE customer_id IS NOT NULL
    GROUP BY customer_id HAVING count(*) > 1"""
SQL["q_test_unique_combo"] = with_ctes("stg_items") + """
    SELECT order_id, order_item_id, count(*) AS n_records FROM stg_items
    GROUP BY order_id, order_item_id HAVING count(*) > 1"""
_FCT_COLS = ["order_id", "customer_id", "order_status", "purchased_at", "items_value_brl",
             "freight_value_brl", "gross_revenue_brl", "paid_brl", "gbp_per_brl",
             "gross_revenue_gbp", "is_fx_forward_filled", "purchase_date", "item_count",
             "payment_count", "main_payment_type"]
SQL["q_test_not_null"] = with_ctes("fct_orders") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM fct_orders"
    for c in _FCT_COLS)
_REL = """
    SELECT c.order_id, CAST(count(*) AS BIGINT) AS n_records
    FROM (SELECT CASE WHEN order_item_id = '7' THEN order_id || '-lost' ELSE order_id END AS order_id
          FROM stg_items) c
    WHERE c.order_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM stg_orders p WHERE p.order_id = c.order_id)
    GROUP BY c.order_id"""
SQL["q_test_relationships"] = with_ctes("stg_items", "stg_orders") + _REL
SQL["q_test_accepted_values"] = with_ctes("stg_orders") + """
    SELECT order_status, count(*) AS n_records FROM stg_orders
    WHERE order_status NOT IN ('F', 'O') GROUP BY order_status"""
_RANGE = """
    SELECT order_id, payment_sequential, payment_installments FROM stg_payments
    WHERE NOT (payment_installments >= 0 AND payment_installments <= 24)"""
SQL["q_test_accepted_range"] = with_ctes("stg_payments") + _RANGE


def _grade(name: str, count_sql: str, warn: str, error: str, severity: str = "error") -> str:
    wop, wn = _split(warn)
    eop, en = _split(error)
    err = f"failures {eop} {en}"
    wrn = f"failures {wop} {wn}"
    if severity == "warn":
        status = f"CASE WHEN ({err}) OR ({wrn}) THEN 'warn' ELSE 'pass' END"
    else:
        status = f"CASE WHEN {err} THEN 'error' WHEN {wrn} THEN 'warn' ELSE 'pass' END"
    return (f"SELECT '{name}' AS test_name, failures, '{warn}' AS warn_if, '{error}' AS error_if, "
            f"{status} AS status FROM (SELECT CAST(coalesce(({count_sql}), 0) AS BIGINT) AS failures)")


def _split(rule: str) -> tuple[str, str]:
    i = len(rule.rstrip("0123456789"))
    return rule[:i], rule[i:]


_EVENT_FAULTS = f"""
    SELECT count(*) FROM raw_items i JOIN stg_orders o ON o.order_id = i.order_id
    WHERE {_utc('i.shipping_limit_date')} < o.purchased_at"""
SQL["q_severity"] = (
    with_ctes("fct_orders", "raw_items", "stg_items") + "\n" + "\nUNION ALL\n".join([
        _grade("assert_order_paid_matches_gross_revenue",
               "SELECT count(*) FROM fct_orders WHERE item_count > 0 AND payment_count > 0 "
               "AND abs(gross_revenue_brl - paid_brl) > 0.01", ">0", ">350"),
        _grade("assert_no_delivery_before_purchase", _EVENT_FAULTS, "!=0", "!=0"),
        _grade("unique_combination_order_items",
               "SELECT count(*) FROM (SELECT 1 FROM stg_items GROUP BY order_id, order_item_id "
               "HAVING count(*) > 1)", "!=0", "!=0"),
        _grade("accepted_range_payment_installments", f"SELECT count(*) FROM ({_RANGE})",
               "!=0", "!=0", severity="warn"),
        _grade("relationships_order_items_order_id", f"SELECT sum(n_records) FROM ({_REL})",
               "!=0", "!=0"),
        _grade("accepted_values_order_status",
               "SELECT count(DISTINCT order_status) FROM stg_orders WHERE order_status NOT IN ('F', 'O')",
               "!=0", "!=0"),
        _grade("assert_some_payments_have_instalments",
               "SELECT count(*) FROM (SELECT count_if(payment_installments > 1) AS n FROM stg_payments) "
               "WHERE n = 0", "!=0", "!=0"),
        _grade("assert_fct_orders_has_every_order",
               "SELECT count(*) FROM (SELECT 1) WHERE (SELECT count(*) FROM fct_orders) "
               "!= (SELECT count(*) FROM stg_orders)", "!=0", "!=0"),
    ]))
SQL["q_freshness"] = with_ctes("run_log") + """
    SELECT max_loaded_at, age_seconds, CAST(floor(age_seconds / 86400) AS BIGINT) AS age_days,
           CASE WHEN max_loaded_at IS NULL THEN 'error'
                WHEN age_seconds > 6 * 86400 THEN 'error'
                WHEN age_seconds > 4 * 86400 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(event_at) AS max_loaded_at,
                 CAST((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(event_at))) // 1000000
                      AS BIGINT) AS age_seconds
          FROM run_log)"""
SQL["q_dead_runs"] = with_ctes("run_log") + """
    SELECT run_id, table_name, CAST(count_if(status = 'started') AS BIGINT) AS started_events,
           max(event_at) AS last_event_at
    FROM run_log GROUP BY run_id, table_name
    HAVING count_if(status = 'started') > 0 AND count_if(status IN ('success', 'failed')) = 0"""
SQL["q_failed_tables"] = with_ctes("run_log") + """
    SELECT table_name, last_event_at FROM (
        SELECT table_name, arg_max(status, (event_at, event_id)) AS last_status,
               max(event_at) AS last_event_at
        FROM run_log GROUP BY table_name) WHERE last_status = 'failed'"""
SQL["q_load_skew"] = with_ctes("run_log") + """
    SELECT table_name, last_success_date, newest_date,
           CAST(date_diff('day', last_success_date, newest_date) AS BIGINT) AS days_behind
    FROM (SELECT table_name, last_success_date, max(last_success_date) OVER () AS newest_date
          FROM (SELECT table_name, max(CAST(event_at AS DATE)) AS last_success_date
                FROM run_log WHERE status = 'success' GROUP BY table_name))
    WHERE date_diff('day', last_success_date, newest_date) > 0"""
SQL["q_high_water_mark"] = with_ctes("raw_rates") + """
    SELECT max(TIME_PERIOD) AS latest,
           coalesce(CAST(CAST(max(TIME_PERIOD) AS DATE) - INTERVAL 7 DAY AS DATE), DATE '2016-01-01')
               AS start_date,
           (SELECT coalesce(CAST(CAST(max(TIME_PERIOD) AS DATE) - INTERVAL 7 DAY AS DATE),
                            DATE '2016-01-01') FROM raw_rates WHERE CURRENCY = 'XXX') AS empty_start_date
    FROM raw_rates"""
SQL["q_window_extract"] = with_ctes("raw_rates") + """
    SELECT "KEY", CURRENCY, TIME_PERIOD, OBS_VALUE FROM raw_rates
    WHERE CURRENCY IN ('GBP', 'BRL')
      AND CAST(TIME_PERIOD AS DATE) BETWEEN
          (SELECT CAST(max(TIME_PERIOD) AS DATE) - INTERVAL 7 DAY FROM raw_rates)
          AND (SELECT CAST(max(TIME_PERIOD) AS DATE) FROM raw_rates)"""
SQL["q_missing_keys"] = with_ctes("raw_rates") + """
    SELECT r.currency, EXISTS (SELECT 1 FROM raw_rates h WHERE h.CURRENCY = r.currency) AS known
    FROM (VALUES ('GBP'), ('BRL'), ('XXX')) r(currency)
    WHERE r.currency NOT IN (
        SELECT CURRENCY FROM raw_rates
        WHERE CAST(TIME_PERIOD AS DATE) BETWEEN
              (SELECT CAST(max(TIME_PERIOD) AS DATE) - INTERVAL 7 DAY FROM raw_rates)
              AND (SELECT CAST(max(TIME_PERIOD) AS DATE) FROM raw_rates))
    ORDER BY r.currency"""
SQL["q_audit_columns"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           lower(c_mktsegment) AS customer_city, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS customer_state,
           'landing/tpch/customers/load_date=2024-01-01/customers.csv' AS _source_uri
    FROM customer"""
SQL["q_full_replace"] = """
    SELECT s_suppkey, s_name, s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2))
           AS s_acctbal FROM supplier"""
SQL["q_upsert_first_run"] = """
    SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
           'landing/tpch/customers/load_date=2024-01-01/customers.csv' AS _source_uri FROM customer"""
SQL["q_upsert_merge"] = """
    SELECT c_custkey, c_name,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey END AS c_nationkey,
           CAST(CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'AUTOMOBILE')
                     THEN CAST(c_acctbal AS DECIMAL(18,2)) + 1
                     ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS c_acctbal,
           c_mktsegment
    FROM customer"""
SQL["q_log_append"] = with_ctes("run_log") + """
    SELECT status, count(*) AS n_events FROM run_log GROUP BY status"""
SQL["q_mart_roundtrip"] = SQL["q_items_by_order"]

SQL["q_manifest_load_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows, true AS matches "
    f"FROM {t}" for t in ["region", "nation", "supplier", "customer", "orders"])
SQL["q_landing_partition_prune"] = with_ctes("raw_orders") + """
    SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
           '1997-01-01' AS load_date
    FROM raw_orders WHERE substr(order_purchase_timestamp, 1, 4) = '1997'"""
SQL["q_incremental_load"] = with_ctes("raw_rates") + """
    , first_max AS (SELECT max(TIME_PERIOD) AS m FROM raw_rates
                    WHERE CURRENCY IN ('GBP', 'BRL') AND TIME_PERIOD BETWEEN '1995-01-01' AND '1998-12-31')
    SELECT "KEY", CURRENCY, TIME_PERIOD,
           CASE WHEN TIME_PERIOD >= (SELECT strftime(CAST(m AS DATE) - INTERVAL 7 DAY, '%Y-%m-%d')
                                     FROM first_max)
                THEN CAST(CAST(CAST(OBS_VALUE AS DECIMAL(18,2)) + 0.01 AS DECIMAL(18,2)) AS VARCHAR)
                ELSE OBS_VALUE END AS OBS_VALUE,
           OBS_STATUS
    FROM raw_rates WHERE CURRENCY IN ('GBP', 'BRL') AND TIME_PERIOD <= '2001-12-31'"""
SQL["q_stream_upsert"] = with_ctes("raw_rates") + """
    SELECT "KEY", CURRENCY, TIME_PERIOD,
           CASE WHEN TIME_PERIOD >= '1997-01-01'
                THEN CAST(CAST(CAST(OBS_VALUE AS DECIMAL(18,2)) + 0.01 AS DECIMAL(18,2)) AS VARCHAR)
                ELSE OBS_VALUE END AS OBS_VALUE, OBS_STATUS
    FROM raw_rates"""
SQL["q_stream_log"] = with_ctes("raw_rates") + """
    SELECT status, CASE WHEN status = 'success' THEN n END AS source_rows,
           CASE WHEN status = 'success' THEN n END AS loaded_rows, true AS one_per_commit
    FROM (SELECT CAST(count(*) + count_if(TIME_PERIOD >= '1997-01-01') AS BIGINT) AS n FROM raw_rates),
         (VALUES ('started'), ('success')) s(status)"""
SQL["q_load_outcomes"] = """
    SELECT 'customer' AS table_name, 'success' AS status, count(*) AS source_rows, count(*) AS loaded_rows,
           'tpch/customer/load_date=2024-01-01' AS landing, NULL AS error, true AS timed FROM customer
    UNION ALL
    SELECT 'part', 'success', count(*), count(*), 'tpch/part/load_date=2024-01-01', NULL, true FROM part
    UNION ALL
    SELECT 'supplier', 'failed', NULL, NULL, 'tpch/supplier/load_date=2024-01-01', CAST(count(*) + 2 AS VARCHAR), true
    FROM supplier
    UNION ALL
    SELECT 'region', 'failed', NULL, NULL, 'tpch/region/load_date=2024-01-01', 'no rows', true"""
SQL["q_ragged_rows"] = """
    SELECT line, record FROM (
        SELECT s_suppkey, 1 + row_number() OVER (ORDER BY s_suppkey) AS line,
               CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey || ',' || s_name
                    ELSE s_suppkey || ',' || s_name || ',' || s_nationkey || ',x' END AS record
        FROM supplier) WHERE s_suppkey % 10 = 0 OR s_suppkey % 15 = 0"""

_STATES = "'created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered', 'unavailable', 'canceled'"
CTES["stg_customers"] = "SELECT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer"
CTES["stg_products"] = "SELECT CAST(p_partkey AS VARCHAR) AS product_id FROM part"
CTES["stg_translation"] = "SELECT DISTINCT lower(p_type) AS product_category_name FROM part"
CTES["stg_sellers"] = "SELECT CAST(s_suppkey AS VARCHAR) AS seller_id FROM supplier"


def _t(name: str, count_sql: str, warn: str = "!=0", error: str = "!=0") -> str:
    return _grade(name, count_sql, warn, error)


def _unique(model: str, col: str) -> str:
    return (f"SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)")


def _combo(model: str, cols: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {model} GROUP BY {cols} HAVING count(*) > 1)"


def _nulls(model: str, col: str) -> str:
    return f"SELECT count(*) FROM {model} WHERE {col} IS NULL"


def _rel(child: str, col: str, parent: str, field: str) -> str:
    return (f"SELECT count(*) FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{field} = c.{col})")


_BUILD = [
    _t("unique_stg_orders_order_id", _unique("stg_orders", "order_id")),
    _t("not_null_stg_orders_order_id", _nulls("stg_orders", "order_id")),
    _t("unique_combination_stg_order_items", _combo("stg_items", "order_id, order_item_id")),
    _t("not_null_stg_order_items_order_id", _nulls("stg_items", "order_id")),
    _t("relationships_stg_order_items_order_id", _rel("stg_items", "order_id", "stg_orders", "order_id")),
    _t("unique_combination_stg_order_payments", _combo("stg_payments", "order_id, payment_sequential")),
    _t("not_null_stg_order_payments_order_id", _nulls("stg_payments", "order_id")),
    _t("not_null_stg_order_payments_payment_installments", _nulls("stg_payments", "payment_installments")),
    _t("relationships_stg_order_payments_order_id",
       _rel("stg_payments", "order_id", "stg_orders", "order_id")),
    _t("accepted_range_stg_order_payments_payment_installments",
       "SELECT count(*) FROM stg_payments WHERE NOT (payment_installments >= 0 AND payment_installments <= 24)"),
    _t("unique_stg_customers_customer_id", _unique("stg_customers", "customer_id")),
    _t("not_null_stg_customers_customer_id", _nulls("stg_customers", "customer_id")),
    _t("unique_stg_products_product_id", _unique("stg_products", "product_id")),
    _t("not_null_stg_products_product_id", _nulls("stg_products", "product_id")),
    _t("unique_stg_sellers_seller_id", _unique("stg_sellers", "seller_id")),
    _t("not_null_stg_sellers_seller_id", _nulls("stg_sellers", "seller_id")),
    _t("unique_stg_product_category_name_translation_product_category_name",
       _unique("stg_translation", "product_category_name")),
    _t("not_null_stg_product_category_name_translation_product_category_name",
       _nulls("stg_translation", "product_category_name")),
    _t("unique_combination_stg_fx_rates", _combo("stg_fx", "currency, rate_date")),
    _t("accepted_values_stg_fx_rates_obs_status",
       "SELECT count(DISTINCT obs_status) FROM stg_fx WHERE obs_status NOT IN ('A')"),
    _t("unique_int_fx_rates_daily_rate_date", _unique("fx_daily", "rate_date")),
    *[_t(f"not_null_int_fx_rates_daily_{c}", _nulls("fx_daily", c))
      for c in ("rate_date", "gbp_per_brl", "last_ecb_date", "is_forward_filled")],
    _t("unique_int_order_items_by_order_order_id", _unique("items_by_order", "order_id")),
    *[_t(f"not_null_int_order_items_by_order_{c}", _nulls("items_by_order", c))
      for c in ("order_id", "item_count")],
    _t("unique_int_order_payments_by_order_order_id", _unique("payments_by_order", "order_id")),
    *[_t(f"not_null_int_order_payments_by_order_{c}", _nulls("payments_by_order", c))
      for c in ("order_id", "total_paid", "payment_count", "main_payment_type")],
    _t("unique_fct_orders_order_id", _unique("fct_orders", "order_id")),
    *[_t(f"not_null_fct_orders_{c}", _nulls("fct_orders", c))
      for c in ("order_id", "customer_id", "order_status", "purchased_at", "gbp_per_brl",
                "is_fx_forward_filled")],
    _t("relationships_fct_orders_customer_id",
       _rel("fct_orders", "customer_id", "stg_customers", "customer_id")),
    _t("accepted_values_fct_orders_order_status",
       f"SELECT count(DISTINCT order_status) FROM fct_orders WHERE order_status NOT IN ({_STATES})"),
    _t("assert_fct_orders_has_every_order",
       "SELECT count(*) FROM (SELECT 1) WHERE (SELECT count(*) FROM fct_orders) != (SELECT count(*) FROM stg_orders)"),
    _t("assert_fx_rates_daily_sane", """
       SELECT (SELECT count(*) FROM (SELECT count(*) AS n FROM fx_daily WHERE year(rate_date) = 2018) WHERE n != 365)
            + (SELECT count(*) FROM fx_daily WHERE year(rate_date) = 2018
                  AND (gbp_per_brl IS NULL OR NOT gbp_per_brl BETWEEN 0.15 AND 0.30))
            + (SELECT count(*) FROM fx_daily WHERE strftime(rate_date, '%A') IN ('Saturday', 'Sunday')
                  AND (NOT is_forward_filled OR last_ecb_date >= rate_date))
            + (SELECT count(*) FROM fx_daily WHERE date_diff('day', last_ecb_date, rate_date) > 5)"""),
    _t("assert_no_delivery_before_purchase",
       "SELECT count(*) FROM stg_orders WHERE delivered_customer_at IS NOT NULL "
       "AND delivered_customer_at < purchased_at"),
    _t("assert_order_paid_matches_gross_revenue",
       "SELECT count(*) FROM fct_orders WHERE item_count > 0 AND payment_count > 0 "
       "AND abs(gross_revenue_brl - paid_brl) > 0.01", ">0", ">350"),
    _t("assert_revenue_reconciles_to_raw", f"""
       SELECT count(*) FROM (SELECT 1) WHERE abs(
           (SELECT coalesce(sum(gross_revenue_brl), 0) FROM fct_orders)
         - (SELECT coalesce(sum(CAST(price AS {N}) + CAST(freight_value AS {N})), 0) FROM raw_items)) > 0.01"""),
    _t("assert_some_payments_have_instalments",
       "SELECT count(*) FROM (SELECT count_if(payment_installments > 1) AS n FROM stg_payments) WHERE n = 0"),
]
SQL["q_build_tests"] = (with_ctes("fct_orders", "raw_items", "stg_customers", "stg_products",
                                  "stg_sellers", "stg_translation") + "\nUNION ALL\n".join(_BUILD))
SQL["q_csv_split_roundtrip"] = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents"

SQL["q_headers_by_name"] = with_ctes("raw_rates") + """
    SELECT "KEY", CURRENCY, TIME_PERIOD, OBS_VALUE, OBS_STATUS FROM raw_rates"""
SQL["q_missing_sources"] = "SELECT n_name FROM nation WHERE n_nationkey % 2 = 1"
SQL["q_failed_replace"] = """
    SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal, 'refused' AS outcome,
           CAST(1 AS BIGINT) AS data_folders FROM supplier"""
SQL["q_empty_window"] = with_ctes("raw_rates") + """
    SELECT 'failed' AS status, CAST(NULL AS BIGINT) AS source_rows, CAST(NULL AS BIGINT) AS loaded_rows
    UNION ALL
    SELECT 'success', count(*), count(*) FROM raw_rates
    WHERE CURRENCY = 'GBP' OR (CURRENCY = 'BRL' AND TIME_PERIOD < (
        SELECT strftime(CAST(max(TIME_PERIOD) AS DATE) - INTERVAL 60 DAY, '%Y-%m-%d') FROM raw_rates))
    UNION ALL SELECT 'success', 0, 0"""
SQL["q_staging_views"] = with_ctes("stg_orders") + """
    SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS customer_state_code, o.order_status, count(*) AS n_orders,
           min(o.purchased_at) AS first_purchase
    FROM stg_orders o JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = o.customer_id GROUP BY 1, 2"""
SQL["q_text_helpers"] = """
    SELECT doc_id, array_to_string(list_filter([upper(lang), upper(source), 'GBP'], lambda x: x IS NOT NULL), '|') AS codes,
           substr(text, 1, 2000) AS clipped, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path
    FROM documents"""
SQL["q_seconds_between"] = """
    SELECT e.event_id, (epoch_us(e.ts) - epoch_us(min(e.ts) OVER (PARTITION BY user_id))) / 1000000.0 AS seconds
    FROM events e"""
