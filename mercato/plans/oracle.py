"""Independent SQL for every query, for DuckDB over the driver tables.

Written from the operator definitions, not from the Spark plans: the
views are plain CTEs, sessions use one unsplit window per user, thresholds
use ``quantile_disc``, first values use ``arg_min`` or ``row_number``.
Only the shared conventions are the same on both sides: money summed as
DECIMAL(18,2), rounding half-up on the double, ties ordered by key.
"""

from __future__ import annotations

GAP_US = 12 * 3600 * 1_000_000


def HU(x: str, d: int = 2) -> str:
    if d == 0:
        return f"CAST(floor(({x}) + CAST(0.5 AS DOUBLE)) AS DOUBLE)"
    s = f"CAST({10 ** d} AS DOUBLE)"
    return f"(floor(({x}) * {s} + CAST(0.5 AS DOUBLE)) / {s})"


def MS(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def ME(x: str) -> str:
    return f"({MS(x)} / CAST(count({x}) AS DOUBLE))"


def MEI(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / CAST(count({x}) AS DOUBLE))"


def D(v) -> str:
    return f"CAST({v} AS DOUBLE)"


VIEWS = {
    "users": """
  SELECT c.c_custkey AS user_id, CAST(NULL AS VARCHAR) AS city, r.r_name AS state,
         n.n_name AS country, o.registration_date, o.last_active
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS registration_date,
                    max(o_orderdate) AS last_active
             FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""",
    "products": """
  SELECT p_partkey AS product_id, p_name AS name, p_brand AS category_id,
         p_type AS subcategory_id, p_retailprice AS base_price,
         CAST(p_size AS BIGINT) AS current_stock, p_size > 1 AS is_active,
         CAST(NULL AS TIMESTAMP) AS creation_date
  FROM part""",
    "transactions": """
  SELECT o_orderkey AS transaction_id, CAST(NULL AS VARCHAR) AS session_id,
         o_custkey AS user_id, o_orderdate AS "timestamp", o_totalprice AS subtotal,
         CAST(0 AS DOUBLE) AS discount, o_totalprice AS total,
         o_orderpriority AS payment_method,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing'
                            WHEN 'P' THEN 'shipped' END AS status
  FROM orders""",
    "txn_items": """
  SELECT t.transaction_id, t.user_id, t."timestamp", t.total, t.payment_method, t.status,
         l.l_linenumber AS line_number, l.l_partkey AS product_id,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         """ + HU("l.l_extendedprice / l.l_quantity") + """ AS unit_price, l.l_extendedprice AS subtotal
  FROM lineitem l JOIN transactions t ON l.l_orderkey = t.transaction_id""",
    "invoices": """
  SELECT transaction_id, subtotal, discount,
         CASE WHEN transaction_id % 3 = 0 THEN order_total ELSE """ + HU("subtotal - discount") + """ END AS total
  FROM (SELECT t.transaction_id, t.total AS order_total, coalesce(p.off, 0) AS discount,
               CASE WHEN t.transaction_id % 4 = 0 THEN t.total ELSE p.lines END AS subtotal
        FROM transactions t LEFT JOIN (
             SELECT l_orderkey, """ + MS("l_extendedprice") + """ AS lines, """ + MS(HU("l_extendedprice * l_discount")) + """ AS off
             FROM lineitem GROUP BY l_orderkey) p ON t.transaction_id = p.l_orderkey)""",
    "raw_users": """
  SELECT * FROM users
  UNION ALL SELECT user_id, city, state, country, last_active, last_active FROM users WHERE user_id % 7 = 0
  UNION ALL SELECT NULL, city, state, country, registration_date, last_active FROM users WHERE user_id % 11 = 0""",
    "marked_products": """
  SELECT product_id, name, category_id, subcategory_id, base_price,
         CASE WHEN product_id % 5 > 0 THEN current_stock END AS current_stock,
         CASE WHEN product_id % 6 > 0 THEN is_active END AS is_active, creation_date FROM products""",
    "raw_products": """
  SELECT * FROM marked_products
  UNION ALL SELECT * REPLACE (base_price - 1 AS base_price) FROM marked_products WHERE product_id % 7 = 0
  UNION ALL SELECT * REPLACE (NULL AS product_id) FROM marked_products WHERE product_id % 11 = 0""",
    "marked_transactions": """
  SELECT * REPLACE (CASE WHEN transaction_id % 5 > 0 THEN discount END AS discount,
                    CASE WHEN transaction_id % 13 = 0 THEN -total WHEN transaction_id % 17 = 0 THEN 'NaN'::DOUBLE
                         WHEN transaction_id % 11 > 0 THEN total END AS total) FROM transactions""",
    "raw_transactions": """
  SELECT * FROM marked_transactions
  UNION ALL SELECT * REPLACE ('delivered' AS status) FROM marked_transactions WHERE transaction_id % 7 = 0""",
    "ev": f"""
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS us,
         lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_us,
         lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_us,
         lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type
  FROM events""",
    "ev2": f"""
  SELECT *, CAST(sum(CASE WHEN prev_us IS NULL OR us - prev_us >= {GAP_US} THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_seq
  FROM ev""",
    "sessions": """
  SELECT CAST(user_id AS VARCHAR) || '-' || CAST(session_seq AS VARCHAR) AS session_id,
         user_id, min(ts) AS start_time, max(ts) AS end_time,
         (max(us) - min(us)) // 1000000 AS duration_seconds, count(*) AS n_events,
         CASE arg_min(k, {'a': us, 'b': event_id}) % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop'
              WHEN 2 THEN 'tablet' END AS device_type,
         CASE arg_min(k, {'a': us, 'b': event_id}) % 5 WHEN 0 THEN 'direct' WHEN 1 THEN 'email'
              WHEN 2 THEN 'social' WHEN 3 THEN 'search_engine' WHEN 4 THEN 'affiliate' END
           AS referrer,
         CASE WHEN bool_or(event_type = 'purchase') THEN 'converted'
              WHEN bool_or(event_type = 'click') THEN 'abandoned' ELSE 'browsed' END
           AS conversion_status
  FROM ev2 GROUP BY user_id, session_seq""",
    "plookup": """
  SELECT product_id, name AS product_name, category_id FROM products""",
    "clean_users": """
  SELECT user_id, city, state, country, registration_date, last_active FROM users
  WHERE user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY city NULLS FIRST, state NULLS FIRST,
          country NULLS FIRST, registration_date NULLS FIRST, last_active NULLS FIRST) = 1""",
    "cleaned_raw_users": """
  SELECT user_id, city, state, country, registration_date, last_active FROM raw_users
  WHERE user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY city NULLS FIRST, state NULLS FIRST,
          country NULLS FIRST, registration_date NULLS FIRST, last_active NULLS FIRST) = 1""",
    "clean_products": """
  SELECT product_id, name, category_id, subcategory_id, base_price,
         coalesce(current_stock, 0) AS current_stock, coalesce(is_active, false) AS is_active,
         creation_date
  FROM products WHERE product_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY name NULLS FIRST,
          category_id NULLS FIRST, subcategory_id NULLS FIRST, base_price NULLS FIRST,
          current_stock NULLS FIRST, is_active NULLS FIRST, creation_date NULLS FIRST) = 1""",
    "cleaned_raw_products": """
  SELECT product_id, name, category_id, subcategory_id, base_price,
         coalesce(current_stock, 0) AS current_stock, coalesce(is_active, false) AS is_active,
         creation_date
  FROM raw_products WHERE product_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY name NULLS FIRST,
          category_id NULLS FIRST, subcategory_id NULLS FIRST, base_price NULLS FIRST,
          coalesce(current_stock, 0), coalesce(is_active, false), creation_date NULLS FIRST) = 1""",
    "clean_transactions": """
  SELECT transaction_id, session_id, user_id, "timestamp", subtotal,
         coalesce(discount, 0.0) AS discount, total, payment_method, status
  FROM transactions WHERE total IS NOT NULL AND total >= 0
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY session_id NULLS FIRST,
          user_id NULLS FIRST, "timestamp" NULLS FIRST, subtotal NULLS FIRST,
          coalesce(discount, 0.0) NULLS FIRST, total NULLS FIRST,
          payment_method NULLS FIRST, status NULLS FIRST) = 1""",
    "cleaned_raw_transactions": """
  SELECT transaction_id, session_id, user_id, "timestamp", subtotal,
         coalesce(discount, 0.0) AS discount, total, payment_method, status
  FROM raw_transactions WHERE total IS NOT NULL AND NOT isnan(total) AND total >= 0
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY session_id NULLS FIRST,
          user_id NULLS FIRST, "timestamp" NULLS FIRST, subtotal NULLS FIRST,
          coalesce(discount, 0.0) NULLS FIRST, total NULLS FIRST,
          payment_method NULLS FIRST, status NULLS FIRST) = 1""",
    "clean_sessions": """
  SELECT * FROM sessions WHERE duration_seconds > 0
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY user_id, start_time) = 1""",
    "summary": """
  SELECT h.user_id, h.total_orders, h.total_spent, h.last_purchase_date, f.favorite_category
  FROM (SELECT user_id, count(*) AS total_orders, """ + MS("total") + """ AS total_spent,
               max("timestamp") AS last_purchase_date
        FROM transactions GROUP BY user_id) h
  LEFT JOIN (SELECT user_id, category_id AS favorite_category FROM (
               SELECT i.user_id, p.category_id, sum(i.quantity) AS qty
               FROM txn_items i JOIN plookup p ON i.product_id = p.product_id
               GROUP BY i.user_id, p.category_id)
             QUALIFY row_number() OVER (PARTITION BY user_id
                                        ORDER BY qty DESC, category_id NULLS FIRST) = 1) f
    ON h.user_id = f.user_id""",
    "ue": """
  SELECT u.user_id, u.country, u.state, u.registration_date, u.last_active,
         CASE WHEN coalesce(s.total_orders, 0) > 0 THEN s.total_orders ELSE 0 END AS total_orders,
         CASE WHEN coalesce(s.total_orders, 0) > 0 THEN """ + HU("s.total_spent") + """
              ELSE 0.0 END AS total_spent,
         CASE WHEN coalesce(s.total_orders, 0) > 0 THEN """ + HU("s.total_spent / s.total_orders") + """
              ELSE 0.0 END AS avg_order_value,
         CASE WHEN coalesce(s.total_orders, 0) > 0 THEN s.last_purchase_date END AS last_purchase_date,
         CASE WHEN coalesce(s.total_orders, 0) > 0 THEN s.favorite_category END AS favorite_category
  FROM users u LEFT JOIN summary s ON u.user_id = s.user_id""",
    "ie": """
  SELECT i.*, p.product_name, p.category_id
  FROM txn_items i LEFT JOIN plookup p ON i.product_id = p.product_id""",
    "fin": """
  SELECT user_id, country, state, total_orders, total_spent, avg_order_value, favorite_category
  FROM ue WHERE total_orders > 0""",
    "beh": """
  SELECT user_id, count(*) AS total_sessions,
         """ + HU(MEI("duration_seconds"), 0) + """ AS avg_session_duration_sec,
         """ + HU("CAST(sum(CASE WHEN conversion_status = 'converted' THEN 1 ELSE 0 END) AS DOUBLE) * "
                 + D(100) + " / count(*)") + """ AS personal_conversion_rate_pct,
         arg_min(device_type, {'a': start_time, 'b': session_id}) AS primary_device,
         arg_min(referrer, {'a': start_time, 'b': session_id}) AS primary_referrer,
         CAST(sum(CASE WHEN conversion_status = 'converted' THEN 1 ELSE 0 END) AS BIGINT)
           AS converted_sessions
  FROM sessions GROUP BY user_id""",
    "comb": """
  SELECT f.*, coalesce(b.total_sessions, 0) AS total_sessions,
         coalesce(b.avg_session_duration_sec, 0.0) AS avg_session_duration_sec,
         coalesce(b.personal_conversion_rate_pct, 0.0) AS personal_conversion_rate_pct,
         b.primary_device, b.primary_referrer,
         coalesce(b.converted_sessions, 0) AS converted_sessions
  FROM fin f LEFT JOIN beh b ON f.user_id = b.user_id""",
    "eng": """
  SELECT *, """ + HU(f"total_sessions * {D(0.4)} + avg_session_duration_sec / 60 * {D(0.3)}"
                   f" + personal_conversion_rate_pct * {D(0.3)}") + """ AS engagement_score
  FROM comb""",
    "scored": """
  SELECT e.*, """ + HU(f"{D('e.total_spent')} / NULLIF({D('m.ms')}, 0) * {D(100)} * {D(0.6)}"
                      f" + {D('e.total_orders')} / NULLIF({D('m.mo')}, 0) * {D(100)} * {D(0.2)}"
                      f" + {D('e.engagement_score')} / NULLIF({D('m.me')}, 0) * {D(100)} * {D(0.2)}")
    + """ AS clv_score
  FROM eng e, (SELECT max(total_spent) AS ms, max(total_orders) AS mo,
                      max(engagement_score) AS me FROM eng) m""",
    "tiered": """
  SELECT s.*, CASE WHEN s.clv_score >= th.p75 THEN 'Premium'
                   WHEN s.clv_score >= th.p50 THEN 'High Value'
                   WHEN s.clv_score >= th.p25 THEN 'Medium Value' ELSE 'Low Value' END AS clv_tier
  FROM scored s, (SELECT quantile_disc(clv_score, 0.25) AS p25, quantile_disc(clv_score, 0.5) AS p50,
                         quantile_disc(clv_score, 0.75) AS p75
                  FROM scored WHERE clv_score IS NOT NULL) th""",
    "tier_summary": """
  SELECT clv_tier, count(*) AS user_count, """ + HU(ME("clv_score")) + """ AS avg_clv_score,
         """ + HU(ME("total_spent")) + """ AS avg_total_spent,
         """ + HU(MEI("total_orders"), 1) + """ AS avg_orders,
         """ + HU(MEI("total_sessions"), 1) + """ AS avg_sessions,
         """ + HU(ME("personal_conversion_rate_pct")) + """ AS avg_conversion_rate
  FROM tiered GROUP BY clv_tier""",
    "funnel": """
  SELECT device_type, referrer, count(*) AS total_sessions,
         CAST(sum(CASE WHEN conversion_status = 'converted' THEN 1 ELSE 0 END) AS BIGINT)
           AS converted_sessions,
         """ + HU("CAST(sum(CASE WHEN conversion_status = 'converted' THEN 1 ELSE 0 END) AS DOUBLE) * "
                 + D(100) + " / count(*)") + """ AS conversion_rate_pct,
         """ + HU(MEI("duration_seconds"), 0) + """ AS avg_session_duration_sec
  FROM sessions GROUP BY device_type, referrer""",
    "monthly": """
  SELECT strftime("timestamp", '%Y-%m') AS month, count(DISTINCT transaction_id) AS order_count,
         count(DISTINCT user_id) AS unique_buyers, """ + HU(MS("total")) + """ AS revenue,
         """ + HU(ME("total")) + """ AS avg_order_value
  FROM transactions WHERE status = 'completed' GROUP BY 1""",
    "pp": """
  SELECT DISTINCT l_partkey AS product_id, l_shipdate AS "date",
         l_extendedprice / l_quantity AS price FROM lineitem""",
}

# Dependencies between the CTEs above (each view lists what it reads).
DEPS = {
    "txn_items": ["transactions"], "ev2": ["ev"], "sessions": ["ev2"], "plookup": ["products"],
    "raw_users": ["users"], "marked_products": ["products"], "raw_products": ["marked_products"],
    "marked_transactions": ["transactions"], "raw_transactions": ["marked_transactions"], "invoices": ["transactions"],
    "cleaned_raw_users": ["raw_users"], "cleaned_raw_products": ["raw_products"],
    "cleaned_raw_transactions": ["raw_transactions"],
    "clean_users": ["users"], "clean_products": ["products"],
    "clean_transactions": ["transactions"], "clean_sessions": ["sessions"],
    "summary": ["transactions", "txn_items", "plookup"], "ue": ["users", "summary"],
    "ie": ["txn_items", "plookup"], "fin": ["ue"], "beh": ["sessions"],
    "comb": ["fin", "beh"], "eng": ["comb"], "scored": ["eng"], "tiered": ["scored"],
    "tier_summary": ["tiered"], "funnel": ["sessions"], "monthly": ["transactions"],
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def sql(uses: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in _order(uses))
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {
    # ---- A
    "clean_users": sql(["cleaned_raw_users"], "SELECT user_id, country, state, registration_date, last_active FROM cleaned_raw_users"),
    "clean_products": sql(["cleaned_raw_products"], "SELECT * FROM cleaned_raw_products"),
    "clean_transactions": sql(["cleaned_raw_transactions"], "SELECT * FROM cleaned_raw_transactions"),
    "clean_sessions": sql(["clean_sessions"], """SELECT session_id, user_id, start_time, end_time,
        duration_seconds, n_events, device_type, referrer, conversion_status FROM clean_sessions"""),
    "table_counts": sql(["clean_users", "clean_products", "clean_transactions", "clean_sessions"], """
        SELECT 'users' AS table_name, count(*) AS row_count FROM clean_users
        UNION ALL SELECT 'products', count(*) FROM clean_products
        UNION ALL SELECT 'categories', count(DISTINCT p_brand) FROM part
        UNION ALL SELECT 'transactions', count(*) FROM clean_transactions
        UNION ALL SELECT 'sessions', count(*) FROM clean_sessions"""),
    "txn_items": sql(["txn_items"], "SELECT * FROM txn_items"),
    "enrich_products": sql(["products"], """
        SELECT p.product_id, p.name, p.category_id, c.category_name, p.subcategory_id,
               s.subcategory_name, p.base_price, p.current_stock, p.is_active, p.creation_date
        FROM products p
        LEFT JOIN (SELECT DISTINCT p_brand AS category_id, p_brand AS category_name FROM part) c
          ON p.category_id = c.category_id
        LEFT JOIN (SELECT p_type AS subcategory_id, arg_max(p_type, p_brand) AS subcategory_name
                   FROM part GROUP BY p_type) s ON p.subcategory_id = s.subcategory_id"""),
    "purchase_summary": sql(["summary"], "SELECT * FROM summary"),
    "enrich_users": sql(["ue"], "SELECT * FROM ue"),
    "enrich_transactions": sql(["transactions", "txn_items", "plookup"], """
        SELECT t.*, i.product_id, i.line_number, i.quantity, i.unit_price,
               i.subtotal AS item_subtotal, p.product_name, p.category_id
        FROM transactions t
        LEFT JOIN txn_items i ON t.transaction_id = i.transaction_id
        LEFT JOIN plookup p ON i.product_id = p.product_id"""),
    # ---- B
    "product_affinity": sql(["txn_items", "clean_transactions"], """
        , b AS (SELECT DISTINCT transaction_id, product_id FROM txn_items
                WHERE transaction_id IN (SELECT transaction_id FROM clean_transactions)
                  AND transaction_id IS NOT NULL AND product_id IS NOT NULL)
        SELECT x.product_id AS product_a, y.product_id AS product_b, count(*) AS co_purchase_count
        FROM b x JOIN b y ON x.transaction_id = y.transaction_id AND x.product_id < y.product_id
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""),
    "cohort_analysis": sql(["clean_users", "clean_transactions"], """
        SELECT strftime(u.registration_date, '%Y-%m') AS cohort_month,
               strftime(t."timestamp", '%Y-%m') AS txn_month,
               """ + MS("t.total") + """ AS total_revenue,
               count(DISTINCT t.user_id) AS active_users, count(*) AS order_count
        FROM clean_transactions t JOIN clean_users u ON t.user_id = u.user_id
        GROUP BY 1, 2 ORDER BY 1, 2"""),
    # ---- C
    "revenue_by_category": sql(["txn_items", "products"], """
        SELECT p.category_id, count(DISTINCT p.product_id) AS product_count,
               CAST(sum(t.quantity) AS BIGINT) AS total_units_sold,
               """ + HU(MS("t.subtotal")) + """ AS total_revenue,
               """ + HU(ME("p.base_price")) + """ AS avg_product_price,
               """ + HU(MS("t.subtotal") + " / count(DISTINCT t.transaction_id)") + """ AS avg_order_value
        FROM txn_items t JOIN products p ON t.product_id = p.product_id
        GROUP BY p.category_id ORDER BY total_revenue DESC, category_id LIMIT 10"""),
    "top_users": sql(["transactions", "users"], """
        SELECT u.user_id, u.country, u.state, count(DISTINCT t.transaction_id) AS order_count,
               """ + HU(MS("t.total")) + """ AS total_spent,
               """ + HU(ME("t.total")) + """ AS avg_order_value,
               min(t."timestamp") AS first_purchase, max(t."timestamp") AS last_purchase
        FROM transactions t JOIN users u ON t.user_id = u.user_id
        WHERE t.status = 'completed'
        GROUP BY u.user_id, u.country, u.state ORDER BY total_spent DESC, user_id LIMIT 10"""),
    "conversion_funnel": sql(["funnel"], "SELECT * FROM funnel"),
    "monthly_revenue": sql(["monthly"], "SELECT * FROM monthly ORDER BY month"),
    # ---- D
    "product_popularity": sql(["ie", "clean_products"], """
        , g AS (SELECT product_id, min(product_name) AS product_name, min(category_id) AS category_id,
                       CAST(sum(quantity) AS BIGINT) AS units_sold, """ + MS("subtotal") + """ AS rev,
                       count(*) AS order_count
                FROM ie GROUP BY product_id ORDER BY rev DESC, product_id LIMIT 10)
        SELECT g.product_id, g.product_name, g.category_id, g.units_sold,
               """ + HU("g.rev") + """ AS revenue, g.order_count, p.current_stock, p.is_active
        FROM g LEFT JOIN clean_products p ON g.product_id = p.product_id"""),
    "user_segmentation": sql(["ue"], """
        SELECT CASE WHEN total_orders >= 0 AND total_orders < 1 THEN '0 orders (never purchased)'
                    WHEN total_orders >= 1 AND total_orders < 3 THEN '1-2 orders'
                    WHEN total_orders >= 3 AND total_orders < 6 THEN '3-5 orders'
                    WHEN total_orders >= 6 AND total_orders < 11 THEN '6-10 orders'
                    WHEN total_orders >= 11 AND total_orders < 100000 THEN '11+ orders'
                    ELSE '11+' END AS order_count_bucket,
               count(*) AS user_count, """ + HU(ME("total_spent")) + """ AS avg_total_spent,
               """ + HU(ME("avg_order_value")) + """ AS avg_order_value
        FROM ue GROUP BY 1"""),
    "revenue_by_category_monthly": sql(["ie"], """
        SELECT category_id, strftime("timestamp", '%Y-%m') AS year_month,
               """ + HU(MS("subtotal")) + """ AS revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
        FROM ie GROUP BY 1, 2"""),
    # ---- E
    "user_financials": sql(["fin"], "SELECT * FROM fin"),
    "session_behaviour": sql(["beh"], "SELECT * FROM beh"),
    "clv_scores": sql(["scored"], "SELECT * FROM scored"),
    "clv_tiers": sql(["tiered"], "SELECT * FROM tiered"),
    "clv_tiers_approx": sql(["scored"], """
        SELECT q AS quantile, (SELECT count(clv_score) FROM scored) AS user_count, true AS rank_ok
        FROM (VALUES (CAST(0.25 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.75 AS DOUBLE))) v(q)"""),
    "clv_tier_summary": sql(["tier_summary"], "SELECT * FROM tier_summary ORDER BY avg_clv_score DESC"),
    "clv_top_customers": sql(["tiered"], """
        SELECT user_id, country, clv_tier, clv_score, total_spent, total_orders, total_sessions,
               personal_conversion_rate_pct, primary_device
        FROM tiered ORDER BY clv_score DESC, user_id LIMIT 15"""),
    "clv_by_country": sql(["tiered"], """
        SELECT country, count(*) AS user_count, """ + HU(ME("clv_score")) + """ AS avg_clv_score,
               """ + HU(MS("total_spent")) + """ AS total_revenue
        FROM tiered GROUP BY country ORDER BY total_revenue DESC, country LIMIT 10"""),
    # ---- F
    "chart_product_revenue": sql(["ie"], """
        , g AS (SELECT product_id, min(product_name) AS product_name, """ + MS("subtotal") + """ AS revenue,
                       CAST(sum(quantity) AS BIGINT) AS units_sold
                FROM ie GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10)
        SELECT product_id, product_name,
               CASE WHEN length(product_name) > 28 THEN substring(product_name, 1, 28) || '...'
                    ELSE product_name END AS short_name,
               revenue, units_sold, revenue / """ + D(1000) + """ AS revenue_k
        FROM g ORDER BY revenue, product_id DESC"""),
    "chart_category_revenue_series": sql(["ie"], """
        SELECT category_id, strftime("timestamp", '%Y-%m') AS year_month,
               """ + MS("subtotal") + """ AS revenue
        FROM ie GROUP BY 1, 2 ORDER BY 2, 1"""),
    "chart_monthly_revenue": sql(["monthly"], """
        SELECT *, revenue / """ + D(1000000) + """ AS revenue_m FROM monthly ORDER BY month"""),
    "chart_tier_share": sql(["tier_summary"], """
        SELECT clv_tier, user_count,
               """ + HU(f"user_count * {D(100)} / sum(user_count) OVER ()", 1) + """ AS share_pct,
               avg_total_spent / """ + D(1000) + """ AS avg_spent_k, avg_conversion_rate
        FROM tier_summary"""),
    "chart_conversion_pivot": sql(["funnel"], """
        SELECT device_type,
               avg(CASE WHEN referrer = 'affiliate' THEN conversion_rate_pct END) AS affiliate,
               avg(CASE WHEN referrer = 'direct' THEN conversion_rate_pct END) AS direct,
               avg(CASE WHEN referrer = 'email' THEN conversion_rate_pct END) AS email,
               avg(CASE WHEN referrer = 'search_engine' THEN conversion_rate_pct END) AS search_engine,
               avg(CASE WHEN referrer = 'social' THEN conversion_rate_pct END) AS social
        FROM funnel GROUP BY device_type ORDER BY device_type"""),
    # ---- G
    "build_sessions": sql(["sessions"], """SELECT session_id, user_id, start_time, end_time,
        duration_seconds, n_events, device_type, referrer, conversion_status FROM sessions"""),
    "page_transitions": sql(["ev"], f"""
        , steps AS (SELECT event_type AS from_page, next_type AS to_page, count(*) AS transitions
                    FROM ev WHERE next_us IS NOT NULL AND next_us - us < {GAP_US}
                    GROUP BY 1, 2)
        SELECT from_page, to_page, transitions,
               """ + HU(f"{D('transitions')} / {D('sum(transitions) OVER (PARTITION BY from_page)')}", 4)
        + """ AS share
        FROM steps"""),
    "invoice_check": sql(["invoices", "txn_items"], """
        , per AS (SELECT transaction_id, count(*) AS n_items,
                         CAST(sum(CASE WHEN CAST(""" + HU("quantity * unit_price") + """ AS DECIMAL(18,2))
                                       = CAST(subtotal AS DECIMAL(18,2)) THEN 0 ELSE 1 END) AS BIGINT)
                           AS bad_items,
                         sum(CAST(subtotal AS DECIMAL(18,2))) AS lines
                  FROM txn_items GROUP BY transaction_id)
        , chk AS (SELECT t.transaction_id, coalesce(per.n_items, 0) AS n_items,
                         coalesce(per.bad_items, 0) AS bad_items,
                         CAST(coalesce(per.lines, 0) AS DOUBLE) AS items_subtotal,
                         t.subtotal, t.discount, t.total,
                         coalesce(CAST(t.subtotal AS DECIMAL(18,2)) = coalesce(per.lines, 0), false)
                           AS subtotal_ok,
                         coalesce(CAST(""" + HU("t.subtotal - coalesce(t.discount, 0)") + """ AS DECIMAL(18,2))
                                  = CAST(t.total AS DECIMAL(18,2)), false) AS total_ok
                  FROM invoices t LEFT JOIN per ON t.transaction_id = per.transaction_id)
        SELECT * FROM chk WHERE bad_items > 0 OR NOT subtotal_ok OR NOT total_ok"""),
    "stock_ledger": sql(["clean_products", "txn_items"], """
        SELECT p.product_id, p.current_stock, CAST(coalesce(s.sold, 0) AS BIGINT) AS units_sold,
               CAST(p.current_stock + coalesce(s.sold, 0) AS BIGINT) AS opening_stock
        FROM clean_products p
        LEFT JOIN (SELECT product_id, sum(quantity) AS sold FROM txn_items GROUP BY 1) s
          ON p.product_id = s.product_id"""),
    "key_and_domain_check": sql(["transactions", "users", "products", "sessions", "pp"], """
        , ct AS (SELECT transaction_id, CASE WHEN transaction_id % 997 = 0 THEN -user_id ELSE user_id END AS user_id,
                        CASE WHEN transaction_id % 50 = 0 THEN CAST(user_id % 200 AS VARCHAR) || '-1' END AS session_id,
                        CASE WHEN transaction_id % 101 = 0 THEN 'lost' ELSE status END AS status, payment_method FROM transactions),
        ci AS (SELECT CASE WHEN l_orderkey % 997 = 0 THEN -l_partkey ELSE l_partkey END AS product_id FROM lineitem),
        cs AS (SELECT session_id, CASE WHEN user_id % 37 = 0 THEN 'fax' ELSE referrer END AS referrer,
                      CASE WHEN user_id % 43 = 0 THEN 'maybe' ELSE conversion_status END AS conversion_status,
                      CASE WHEN user_id % 41 = 0 THEN 'fridge' ELSE device_type END AS device_type FROM sessions),
        ce AS (SELECT CASE WHEN event_id % 89 > 0 THEN user_id END AS user_id, CASE WHEN event_id % 83 > 0 THEN ts END AS ts FROM events),
        cp AS (SELECT CASE WHEN product_id % 61 > 0 THEN product_id END AS product_id,
                      CASE WHEN product_id % 59 > 0 THEN "date" END AS "date" FROM pp)
        SELECT 'orphan_user' AS check_name, CAST(user_id AS VARCHAR) AS value, count(*) AS n_rows
        FROM ct t WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = t.user_id)
        GROUP BY 2
        UNION ALL
        SELECT 'orphan_product', CAST(product_id AS VARCHAR), count(*) FROM ci i
        WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = i.product_id) GROUP BY 2
        UNION ALL
        SELECT 'orphan_session', session_id, count(*) FROM ct t
        WHERE session_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM cs s WHERE s.session_id = t.session_id) GROUP BY 2
        UNION ALL
        SELECT 'bad_status', status, count(*) FROM ct
        WHERE status IS NULL OR status NOT IN ('completed', 'processing', 'shipped', 'delivered')
        GROUP BY 2
        UNION ALL
        SELECT 'bad_payment_method', payment_method, count(*) FROM ct
        WHERE payment_method IS NULL OR payment_method NOT IN ('credit_card', 'paypal', 'apple_pay',
              'crypto', 'bank_transfer', 'gift_card') GROUP BY 2
        UNION ALL
        SELECT 'bad_conversion_status', conversion_status, count(*) FROM cs
        WHERE conversion_status IS NULL
           OR conversion_status NOT IN ('converted', 'abandoned', 'browsed') GROUP BY 2
        UNION ALL
        SELECT 'bad_referrer', referrer, count(*) FROM cs
        WHERE referrer IS NULL
           OR referrer NOT IN ('direct', 'email', 'social', 'search_engine', 'affiliate') GROUP BY 2
        UNION ALL
        SELECT 'bad_device_type', device_type, count(*) FROM cs
        WHERE device_type IS NULL OR device_type NOT IN ('mobile', 'desktop', 'tablet') GROUP BY 2
        UNION ALL
        SELECT 'unplaced_event', 'user_id', count(*) FROM ce WHERE user_id IS NULL HAVING count(*) > 0
        UNION ALL
        SELECT 'unplaced_event', 'ts', count(*) FROM ce WHERE ts IS NULL HAVING count(*) > 0
        UNION ALL
        SELECT 'unplaced_price', 'product_id', count(*) FROM cp WHERE product_id IS NULL HAVING count(*) > 0
        UNION ALL
        SELECT 'unplaced_price', 'date', count(*) FROM cp WHERE "date" IS NULL HAVING count(*) > 0"""),
    "price_history": sql(["pp"], """
        , w AS (SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY "date", price) AS prev_price
                FROM pp WHERE "date" IS NOT NULL)
        SELECT product_id, "date", price, prev_price,
               sign((price - prev_price) / prev_price * """ + D(100) + """)
               * """ + HU(f"abs((price - prev_price) / prev_price * {D(100)})") + """ AS change_pct
        FROM w WHERE prev_price IS NULL OR price <> prev_price"""),
    "price_check": sql(["products", "pp"], """
        , l AS (SELECT product_id, arg_max(price, {'d': "date", 'p': price}) AS latest_price,
                       min("date") AS first_price_date, count(*) AS n_points
                FROM pp GROUP BY product_id)
        , listed AS (
            SELECT p.product_id, l.latest_price, l.n_points, l.first_price_date,
                   CASE WHEN p.product_id % 3 = 0 AND l.latest_price IS NOT NULL THEN """ + HU("l.latest_price") + """
                        ELSE p.base_price END AS base_price,
                   CASE WHEN p.product_id % 4 = 0 THEN l.first_price_date
                        WHEN p.product_id % 4 = 1 THEN l.first_price_date - INTERVAL 1 DAY END AS creation_date
            FROM products p LEFT JOIN l ON p.product_id = l.product_id)
        SELECT product_id, base_price, latest_price, n_points,
               """ + HU("base_price") + " = " + HU("latest_price") + """ AS price_matches,
               creation_date, first_price_date, creation_date = first_price_date AS date_matches
        FROM listed"""),
}

PRICED = """
  SELECT l_orderkey AS transaction_id, l_linenumber AS line_number, l_partkey AS product_id, l_shipdate AS sold_at,
         """ + HU("l_extendedprice / l_quantity") + """ AS unit_price FROM lineitem"""

ORACLE |= {
    # ---- G on time lines
    "price_at_sale": f"""
        WITH priced AS ({PRICED}),
        list AS (SELECT product_id, sold_at AS since, max(unit_price) AS price FROM priced
                 WHERE line_number = 1 GROUP BY 1, 2)
        SELECT p.transaction_id, p.line_number, p.product_id, p.sold_at, p.unit_price, l.price AS list_price,
               l.since AS list_price_since, p.unit_price = l.price AS price_ok,
               sign((p.unit_price - l.price) / l.price * {D(100)})
               * """ + HU(f"abs((p.unit_price - l.price) / l.price * {D(100)})") + """ AS deviation_pct
        FROM priced p ASOF LEFT JOIN list l ON p.product_id = l.product_id AND p.sold_at >= l.since""",
    "stock_timeline": """
        WITH moves AS (
            SELECT l_partkey AS product_id, l_shipdate AS moved_at, l_orderkey AS transaction_id, l_linenumber AS line_number,
                   -CAST(l_quantity AS BIGINT) AS quantity FROM lineitem
            UNION ALL
            SELECT l_partkey, l_shipdate + INTERVAL 30 DAY, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT)
            FROM lineitem WHERE l_returnflag = 'R'),
        run AS (
            SELECT m.*, p.p_size * 20 + sum(quantity) OVER line AS stock, row_number() OVER line AS pos
            FROM moves m JOIN part p ON m.product_id = p.p_partkey
            WINDOW line AS (PARTITION BY m.product_id ORDER BY moved_at, transaction_id, line_number, quantity
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        per AS (
            SELECT product_id, count(*) AS n, sum(CASE WHEN quantity < 0 THEN -quantity ELSE 0 END) AS units_out,
                   sum(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS units_in, min(stock) AS lowest,
                   min(pos) FILTER (WHERE stock < 0) AS first_pos
            FROM run GROUP BY product_id)
        SELECT p.p_partkey AS product_id, CAST(p.p_size * 20 AS BIGINT) AS opening_stock,
               coalesce(per.n, 0) AS n_movements, CAST(coalesce(per.units_out, 0) AS BIGINT) AS units_out,
               CAST(coalesce(per.units_in, 0) AS BIGINT) AS units_in,
               CAST(p.p_size * 20 - coalesce(per.units_out, 0) + coalesce(per.units_in, 0) AS BIGINT) AS closing_stock,
               CAST(least(p.p_size * 20, coalesce(per.lowest, p.p_size * 20)) AS BIGINT) AS lowest_stock,
               f.moved_at AS oversold_at, f.transaction_id AS oversold_transaction, f.line_number AS oversold_line,
               CAST(-f.stock AS BIGINT) AS units_missing
        FROM part p LEFT JOIN per ON p.p_partkey = per.product_id
        LEFT JOIN run f ON f.product_id = per.product_id AND f.pos = per.first_pos""",
}

FUNNEL = """
    , pos AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_seq ORDER BY ts, event_id) AS pos FROM ev2),
    v AS (SELECT user_id, session_seq, count(*) AS n_events, min(pos) FILTER (WHERE event_type = 'view') AS p1
          FROM pos GROUP BY 1, 2),
    c AS (SELECT v.user_id, v.session_seq, v.n_events, v.p1, min(pos.pos) FILTER (WHERE event_type = 'click' AND pos.pos > v.p1) AS p2
          FROM v JOIN pos USING (user_id, session_seq) GROUP BY 1, 2, 3, 4),
    taken AS (SELECT c.user_id, c.session_seq, c.n_events,
                     CASE WHEN c.p1 IS NULL THEN 0 WHEN c.p2 IS NULL THEN 1
                          WHEN count(*) FILTER (WHERE event_type = 'purchase' AND pos.pos > c.p2) = 0 THEN 2 ELSE 3 END AS steps_taken
              FROM c JOIN pos USING (user_id, session_seq) GROUP BY 1, 2, 3, c.p1, c.p2)"""

ORACLE |= {
    "ordered_funnel": sql(["ev2"], FUNNEL + """
        SELECT CAST(user_id AS VARCHAR) || '-' || CAST(session_seq AS VARCHAR) AS session_id, user_id,
               CAST(n_events AS BIGINT) AS n_events, CAST(steps_taken AS INTEGER) AS steps_taken,
               CASE steps_taken WHEN 1 THEN 'view' WHEN 2 THEN 'cart' WHEN 3 THEN 'checkout' END AS furthest_step
        FROM taken"""),
    "funnel_steps": sql(["ev2"], FUNNEL + """
        , n AS (SELECT step, step_name, count(*) FILTER (WHERE steps_taken >= step) AS sessions, count(*) AS total,
                       count(*) FILTER (WHERE steps_taken >= step - 1) AS prior
                FROM taken, (VALUES (1, 'view'), (2, 'cart'), (3, 'checkout')) s(step, step_name) GROUP BY 1, 2)
        SELECT CAST(step AS INTEGER) AS step, step_name, sessions, """ + HU("sessions * " + D(100) + " / total") + """ AS pct_of_sessions,
               """ + HU("sessions * " + D(100) + " / nullif(prior, 0)") + """ AS pct_of_previous
        FROM n"""),
}

ORACLE |= {
    "purchase_summary_merged": ORACLE["purchase_summary"],
    "order_line_differences": """
        WITH cut AS (
            SELECT l_orderkey AS transaction_id, CASE WHEN l_orderkey % 19 = 0 THEN -l_partkey ELSE l_partkey END AS product_id,
                   unnest(CASE WHEN l_orderkey % 13 = 0 AND l_quantity > 1 THEN [l_quantity - 1, 1]
                               WHEN l_orderkey % 11 = 0 THEN [l_quantity + 1] ELSE [l_quantity] END) AS quantity
            FROM lineitem WHERE l_orderkey % 17 > 0 OR l_linenumber > 1),
        s AS (SELECT l_orderkey AS transaction_id, l_partkey AS product_id, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q
              FROM lineitem GROUP BY 1, 2),
        i AS (SELECT transaction_id, product_id, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS q FROM cut GROUP BY 1, 2),
        both_sides AS (
            SELECT coalesce(s.transaction_id, i.transaction_id) AS transaction_id, coalesce(s.product_id, i.product_id) AS product_id,
                   coalesce(s.n, 0) AS shipped_lines, coalesce(i.n, 0) AS invoiced_lines,
                   coalesce(s.q, 0) AS shipped_quantity, coalesce(i.q, 0) AS invoiced_quantity,
                   CASE WHEN i.n IS NULL THEN 'only_shipped' WHEN s.n IS NULL THEN 'only_invoiced'
                        WHEN s.q <> i.q THEN 'quantity' WHEN s.n <> i.n THEN 'split' END AS difference
            FROM s FULL JOIN i ON s.transaction_id = i.transaction_id AND s.product_id = i.product_id)
        SELECT * FROM both_sides WHERE difference IS NOT NULL""",
}

BUYERS = """
    , b AS (SELECT DISTINCT strftime("timestamp", '%Y-%m') AS month, year("timestamp") * 12 + month("timestamp") AS n, user_id
            FROM transactions WHERE status = 'completed')"""

ORACLE |= {
    "nested_transactions": sql(["transactions", "plookup"], """
        , l AS (SELECT l_orderkey AS transaction_id, l_linenumber AS line_number, l_partkey AS product_id, p.product_name, p.category_id,
                       CAST(l_quantity AS BIGINT) AS quantity,
                       CAST(round(""" + HU("l_extendedprice / l_quantity") + """ * 100) AS BIGINT) AS price,
                       CAST(round(l_extendedprice * 100) AS BIGINT) AS subtotal
                FROM lineitem LEFT JOIN plookup p ON l_partkey = p.product_id)
        , cut AS (SELECT *, (line_number - 1) // 4 AS piece,
                         (row_number() OVER (PARTITION BY transaction_id, (line_number - 1) // 4
                                             ORDER BY line_number, product_id, product_name, category_id, quantity, price, subtotal) - 1) // 4 AS cut
                  FROM l)
        , parts AS (SELECT transaction_id, piece, cut, count(*) AS n_items,
                           string_agg(concat_ws(':', line_number, product_id, product_name, category_id, quantity, price, subtotal), '|'
                                      ORDER BY line_number, product_id, product_name, category_id, quantity, price, subtotal) AS lines
                    FROM cut GROUP BY 1, 2, 3)
        , numbered AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY piece, cut) AS part,
                              count(*) OVER (PARTITION BY transaction_id) AS n_parts FROM parts)
        SELECT t.transaction_id, t.user_id, t."timestamp", CAST(coalesce(n.part, 1) AS INTEGER) AS part, coalesce(n.n_parts, 1) AS n_parts,
               CAST(coalesce(n.n_items, 0) AS INTEGER) AS n_items, coalesce(n.lines, '') AS lines
        FROM transactions t LEFT JOIN numbered n ON t.transaction_id = n.transaction_id"""),
    "rolling_buyers": sql(["transactions"], BUYERS + """
        , e AS (SELECT DISTINCT month, n FROM b)
        SELECT e.month AS last_month, CAST(k AS INTEGER) AS months, count(DISTINCT b.user_id) AS unique_buyers, true AS within_error
        FROM e, (VALUES (1), (3), (12)) v(k) JOIN b ON b.n BETWEEN e.n - k + 1 AND e.n GROUP BY 1, 2"""),
    "returning_buyers": sql(["transactions"], BUYERS + """
        SELECT b.month, count(p.user_id) AS returning_buyers, true AS within_error
        FROM b LEFT JOIN b p ON p.n = b.n - 1 AND p.user_id = b.user_id
        WHERE b.n - 1 IN (SELECT n FROM b) GROUP BY b.month"""),
}

ORACLE["cart_outcomes"] = sql(["ev2"], """
    , e AS (SELECT user_id, CAST(user_id AS VARCHAR) || '-' || CAST(session_seq AS VARCHAR) AS session_id, event_type,
                   CASE WHEN event_id % 9 > 0 THEN k END AS product_id, event_id % 4 AS quantity FROM ev2)
    , c AS (SELECT session_id, product_id, sum(quantity) AS units FROM e
            WHERE event_type = 'click' AND product_id IS NOT NULL GROUP BY 1, 2)
    SELECT e.user_id, e.session_id, count(DISTINCT CASE WHEN event_type = 'view' THEN product_id END) AS viewed_products,
           coalesce(any_value(k.n), 0) AS cart_products, CAST(coalesce(any_value(k.units), 0) AS BIGINT) AS cart_units,
           CASE WHEN any_value(k.entries) IS NULL THEN 'browsed'
                WHEN bool_or(event_type = 'purchase') THEN 'converted' ELSE 'abandoned' END AS conversion_status
    FROM e LEFT JOIN (SELECT session_id, count(*) AS entries, count(*) FILTER (WHERE units > 0) AS n,
                             sum(units) FILTER (WHERE units > 0) AS units FROM c GROUP BY 1) k USING (session_id)
    GROUP BY e.user_id, e.session_id""")
