"""Oracle statements: the same results in plain SQL for a second engine.

Written independently of the Spark plans: each dataset is a named subquery over the star-schema
tables, and a statement pulls in just the subqueries it mentions.
"""

from __future__ import annotations

import re

from vitrine.functions.fixed_values import (
    GRAIN_AUDIT,
    KEY_TESTS,
    ORDER_STATUSES,
    REVIEW_SCORES,
    STATE_CENTRES,
)
from vitrine.sources.star_schema import STAR_SQL

# cuts that bite on the test data, whose dates run from 1995-01 to 2001-08
AS_OF, EXCLUDED_YEAR = "2001-07-15", 1995
RANGE = ("1997-03-15", "1999-09-20")
LEAST_ON_TIME, LEAST_SCORE = 50.0, 2.95

_DEFS: dict[str, str] = {
    f"raw_{name}": sql.format(**{t: t for t in tables}) for name, (tables, sql) in STAR_SQL.items()
}

_DEFS |= {
    "stg_orders": """
        SELECT order_id, customer_id, order_status,
               order_purchase_timestamp::TIMESTAMP AS order_purchase_at,
               order_approved_at::TIMESTAMP AS order_approved_at,
               order_delivered_carrier_date::TIMESTAMP AS order_delivered_carrier_at,
               order_delivered_customer_date::TIMESTAMP AS order_delivered_customer_at,
               order_estimated_delivery_date::TIMESTAMP AS order_estimated_delivery_at
        FROM raw_orders""",
    "stg_order_items": """
        SELECT order_id, order_item_id, product_id, seller_id,
               shipping_limit_date::TIMESTAMP AS shipping_limit_at,
               price::DECIMAL(18,3) AS item_price,
               freight_value::DECIMAL(18,3) AS freight_value
        FROM raw_order_items""",
    "stg_order_payments": """
        SELECT * REPLACE (payment_value::DECIMAL(18,3) AS payment_value) FROM raw_order_payments""",
    "stg_order_reviews": """
        SELECT review_id, order_id, review_score::INTEGER AS review_score,
               review_comment_title, review_comment_message,
               review_creation_date::TIMESTAMP AS review_created_at,
               review_answer_timestamp::TIMESTAMP AS review_answered_at
        FROM raw_order_reviews""",
    "stg_customers": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
               customer_city AS city, customer_state AS state
        FROM raw_customers""",
    "stg_sellers": """
        SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix,
               seller_city AS city, seller_state AS state
        FROM raw_sellers""",
    "stg_products": """
        SELECT product_id, product_category_name,
               product_name_lenght::INTEGER AS product_name_length,
               product_description_lenght::INTEGER AS product_description_length,
               product_photos_qty::INTEGER AS product_photos_qty,
               product_weight_g::DECIMAL(18,3) AS product_weight_g,
               product_length_cm::DECIMAL(18,3) AS product_length_cm,
               product_height_cm::DECIMAL(18,3) AS product_height_cm,
               product_width_cm::DECIMAL(18,3) AS product_width_cm
        FROM raw_products""",
    "stg_category_translation": """
        SELECT product_category_name, product_category_name_english
        FROM raw_category_translation""",
    # the published pick among a prefix's rows is arbitrary; both sides take the least row
    "stg_geolocation": """
        SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_lat AS latitude,
               geolocation_lng AS longitude, geolocation_city AS city, geolocation_state AS state
        FROM raw_geolocation
        QUALIFY row_number() OVER (
            PARTITION BY geolocation_zip_code_prefix
            ORDER BY geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST,
                     geolocation_city NULLS FIRST, geolocation_state NULLS FIRST) = 1""",
    "order_items_agg": """
        SELECT order_id, sum(item_price)::DECIMAL(38,3) AS order_revenue,
               sum(freight_value)::DECIMAL(38,3) AS order_freight,
               count(order_item_id) AS items_count
        FROM stg_order_items GROUP BY ALL""",
    "payments_agg": """
        SELECT order_id, sum(payment_value)::DECIMAL(38,3) AS total_payment
        FROM stg_order_payments GROUP BY ALL""",
    "reviews_agg": """
        SELECT order_id, max(review_score) AS review_score FROM stg_order_reviews GROUP BY ALL""",
    "delivery_metrics": """
        SELECT order_id,
               order_delivered_customer_at::DATE - order_purchase_at::DATE AS delivery_days,
               CASE WHEN order_delivered_customer_at::DATE > order_estimated_delivery_at::DATE
                    THEN order_delivered_customer_at::DATE - order_estimated_delivery_at::DATE
                    WHEN order_delivered_customer_at::DATE <= order_estimated_delivery_at::DATE
                    THEN 0 END::BIGINT AS delay_days,
               order_delivered_customer_at <= order_estimated_delivery_at AS is_on_time
        FROM stg_orders""",
    "recognized_revenue": """
        SELECT o.order_id, o.order_status,
               (ifnull(p.total_payment, 0)
                * (NOT ifnull(o.order_status IN ('canceled', 'unavailable'), false))::INTEGER
               )::DECIMAL(38,3) AS recognized_revenue
        FROM stg_orders o LEFT JOIN payments_agg p USING (order_id)""",
    "mart_orders_wide": """
        SELECT o.order_id, o.customer_id, o.order_purchase_at AS purchased_at,
               date_trunc('month', o.order_purchase_at)::TIMESTAMP AS order_month,
               o.order_delivered_customer_at AS delivered_at,
               o.order_estimated_delivery_at AS estimated_delivery_at, o.order_status,
               d.delivery_days, d.delay_days, d.is_on_time,
               ifnull(i.order_revenue, 0)::DECIMAL(38,3) AS order_revenue,
               ifnull(i.order_freight, 0)::DECIMAL(38,3) AS order_freight,
               ifnull(p.total_payment, 0)::DECIMAL(38,3) AS total_payment,
               ifnull(i.items_count, 0) AS items_count, rr.recognized_revenue,
               c.city AS customer_city, c.state AS customer_state, v.review_score
        FROM stg_orders o
        JOIN delivery_metrics d USING (order_id)
        JOIN recognized_revenue rr USING (order_id)
        LEFT JOIN order_items_agg i USING (order_id)
        LEFT JOIN payments_agg p USING (order_id)
        LEFT JOIN reviews_agg v USING (order_id)
        LEFT JOIN stg_customers c USING (customer_id)""",
    "seller_orders": """
        SELECT i.seller_id, m.order_id, sum(i.item_price)::DECIMAL(38,3) AS order_revenue,
               count(i.order_item_id) AS items_count, max(m.delivery_days) AS delivery_days,
               max(m.delay_days) AS delay_days, max(m.is_on_time::INTEGER) AS is_on_time,
               max(m.review_score) AS review_score
        FROM mart_orders_wide m JOIN stg_order_items i USING (order_id)
        WHERE m.order_status = 'delivered'
        GROUP BY ALL""",
    "mart_sellers_wide": """
        SELECT s.seller_id, s.city AS seller_city, s.state AS seller_state,
               count(x.order_id) AS total_orders,
               ifnull(sum(x.items_count), 0)::BIGINT AS total_items_sold,
               ifnull(sum(x.order_revenue), 0)::DECIMAL(38,3) AS total_revenue,
               sum(x.order_revenue)::DOUBLE / nullif(sum(x.items_count), 0)::DOUBLE
                   AS avg_revenue_per_item,
               round(avg(x.delivery_days), 1) AS avg_delivery_days,
               round(avg(x.delay_days), 1) AS avg_delay_days,
               round(100.0 * sum(x.is_on_time) / nullif(count(x.order_id), 0), 2)::DOUBLE
                   AS on_time_pct,
               round(avg(x.review_score), 2) AS avg_review_score,
               count(x.review_score) AS total_reviews
        FROM stg_sellers s LEFT JOIN seller_orders x USING (seller_id)
        GROUP BY ALL""",
    "closed_orders": f"""
        SELECT *, strftime(order_month, '%Y-%m') AS month FROM mart_orders_wide
        WHERE order_month < date_trunc('month', DATE '{AS_OF}')
          AND year(order_month) <> {EXCLUDED_YEAR}""",
    "cfo_monthly_revenue": """
        SELECT month, sum(recognized_revenue)::DECIMAL(38,3) AS revenue, count(order_id) AS orders,
               avg(recognized_revenue) FILTER (WHERE recognized_revenue > 0) AS aov
        FROM closed_orders GROUP BY ALL""",
    "coo_monthly_delivery": """
        SELECT month, round(100.0 * count(*) FILTER (WHERE is_on_time) / count(*), 1) AS on_time_pct,
               round(avg(delivery_days), 1) AS avg_days
        FROM closed_orders WHERE is_on_time IS NOT NULL GROUP BY ALL""",
    "cx_monthly_reviews": """
        SELECT month, round(avg(review_score), 2) AS avg_score,
               round(100.0 * count(*) FILTER (WHERE review_score >= 4) / count(*), 1) AS csat_pct
        FROM closed_orders WHERE review_score IS NOT NULL GROUP BY ALL""",
    "cx_review_volume": """
        SELECT month, count(*) AS reviews
        FROM closed_orders WHERE review_score IS NOT NULL GROUP BY ALL""",
    "coo_monthly_delay": """
        SELECT month, round(avg(delay_days), 1) AS avg_delay_days
        FROM closed_orders WHERE is_on_time IS NOT NULL GROUP BY ALL""",
    "ranked_sellers": """
        SELECT *, row_number() OVER (ORDER BY total_revenue DESC, seller_id) AS place
        FROM mart_sellers_wide WHERE total_revenue > 0""",
    "top_sellers": """
        SELECT left(seller_id, 8) AS seller_label, seller_state, total_revenue, avg_review_score,
               on_time_pct, total_orders
        FROM ranked_sellers WHERE place <= 10""",
    "state_revenue": """
        SELECT customer_state, sum(recognized_revenue)::DECIMAL(38,3) AS revenue,
               count(order_id) AS orders
        FROM mart_orders_wide WHERE recognized_revenue > 0 GROUP BY ALL""",
    "state_centres": "SELECT * FROM (VALUES "
    + ", ".join(f"('{s}', {lat}::DOUBLE, {lon}::DOUBLE)" for s, lat, lon in STATE_CENTRES)
    + ") AS t(state, lat, lon)",
    "state_revenue_map": """
        SELECT c.state, round_even(r.revenue, 2)::DOUBLE AS revenue, r.orders, c.lat, c.lon
        FROM state_centres c JOIN state_revenue r ON r.customer_state = c.state""",
    "kpi_finance": """
        SELECT ifnull(sum(revenue), 0)::DECIMAL(38,3) AS total_revenue,
               ifnull(sum(orders), 0)::BIGINT AS total_orders,
               ifnull(sum(revenue)::DOUBLE / nullif(sum(orders), 0)::DOUBLE, 0) AS aov
        FROM cfo_monthly_revenue""",
    # rounded monthly figures are exact as decimals, so their mean has one value in every order
    "kpi_delivery": """
        SELECT ifnull(sum(ifnull(on_time_pct, 0)::DECIMAL(18,1))::DOUBLE / nullif(count(*), 0), 0)
                   AS on_time_pct,
               ifnull(sum(ifnull(avg_days, 0)::DECIMAL(18,1))::DOUBLE / nullif(count(*), 0), 0)
                   AS avg_delivery_days
        FROM coo_monthly_delivery""",
    "kpi_satisfaction": """
        SELECT ifnull(sum(ifnull(avg_score, 0)::DECIMAL(18,2))::DOUBLE / nullif(count(*), 0), 0)
                   AS avg_score,
               ifnull(sum(ifnull(csat_pct, 0)::DECIMAL(18,1))::DOUBLE / nullif(count(*), 0), 0)
                   AS csat_pct
        FROM cx_monthly_reviews""",
    "kpi_top_seller": """
        SELECT ifnull(sum(total_revenue), 0)::DECIMAL(38,3) AS top_seller_revenue
        FROM ranked_sellers WHERE place = 1""",
    "kpi_active_sellers": """
        SELECT count(*) FILTER (WHERE total_orders > 0) AS active_sellers FROM mart_sellers_wide""",
    "kpi_cards": """
        SELECT 'R$ ' || translate(format('{:,.2f}', f.total_revenue::DOUBLE), ',.', '.,') AS kpi_revenue,
               translate(format('{:,}', f.total_orders), ',', '.') AS kpi_orders,
               'R$ ' || translate(format('{:,.2f}', f.aov), ',.', '.,') AS kpi_aov,
               format('{:.1f}%', d.on_time_pct) AS kpi_on_time,
               format('{:.1f} days', d.avg_delivery_days) AS kpi_avg_delivery,
               format('{:.2f} / 5', s.avg_score) AS kpi_avg_score,
               format('{:.1f}%', s.csat_pct) AS kpi_csat,
               'R$ ' || translate(format('{:,.2f}', t.top_seller_revenue::DOUBLE), ',.', '.,')
                   AS kpi_top_seller_rev,
               format('{:,}', a.active_sellers) AS kpi_active_sellers
        FROM kpi_finance f, kpi_delivery d, kpi_satisfaction s, kpi_top_seller t,
             kpi_active_sellers a""",
    "cfo_chart": """
        SELECT month, ifnull(round_even(revenue, 2), 0)::DOUBLE AS revenue
        FROM cfo_monthly_revenue""",
    "top_sellers_chart": """
        SELECT format('{}... ({})', seller_label, ifnull(seller_state, 'None')) AS seller,
               ifnull(round_even(total_revenue, 2), 0)::DOUBLE AS revenue,
               format('{:.2f}', ifnull(avg_review_score, 0))::DOUBLE AS score,
               format('{:.1f}', ifnull(on_time_pct, 0))::DOUBLE AS on_time
        FROM top_sellers""",
}


def _unique(dataset: str, column: str) -> str:
    return f"""
        SELECT '{dataset}' AS dataset, '{column}' AS "column", 'unique' AS test,
               count(*) AS failures, count(*) = 0 AS passed
        FROM (SELECT {column} FROM {dataset} WHERE {column} IS NOT NULL
              GROUP BY {column} HAVING count(*) > 1)"""


def _not_null(dataset: str, column: str) -> str:
    return f"""
        SELECT '{dataset}' AS dataset, '{column}' AS "column", 'not_null' AS test,
               count(*) - count({column}) AS failures, count(*) = count({column}) AS passed
        FROM {dataset}"""


def _repeated_groups(table: str, label: str, keys: list[str]) -> str:
    return f"""
        SELECT '{label}' AS table_name, count(*) FILTER (WHERE n > 1) AS duplicate_count
        FROM (SELECT count(*) AS n FROM raw_{table} GROUP BY {", ".join(keys)})"""


_DEFS["dq_unique"] = " UNION ALL ".join(_unique(*k) for k in KEY_TESTS)
_DEFS["dq_not_null"] = " UNION ALL ".join(_not_null(*k) for k in KEY_TESTS)
_DEFS["dq_suite"] = "SELECT * FROM dq_unique UNION ALL SELECT * FROM dq_not_null"
_DEFS["granularity_audit"] = " UNION ALL ".join(_repeated_groups(*g) for g in GRAIN_AUDIT)

_statuses = ", ".join(f"'{status}'" for status in ORDER_STATUSES)
_scores = ", ".join(str(score) for score in REVIEW_SCORES)


def _accepted(dataset: str, column: str, values: str) -> str:
    return f"""
        SELECT '{dataset}' AS dataset, '{column}' AS "column", 'accepted_values' AS test,
               count(DISTINCT {column}) AS failures, count(DISTINCT {column}) = 0 AS passed
        FROM {dataset} WHERE {column} NOT IN ({values})"""


def _related(dataset: str, column: str, parent: str) -> str:
    return f"""
        SELECT '{dataset}' AS dataset, '{column}' AS "column", 'relationships' AS test,
               count(*) AS failures, count(*) = 0 AS passed
        FROM {dataset} child
        WHERE {column} IS NOT NULL
          AND NOT EXISTS (FROM {parent} WHERE {parent}.{column} = child.{column})"""


_DEFS |= {
    "dq_accepted_values": _accepted("stg_orders", "order_status", _statuses)
    + " UNION ALL "
    + _accepted("stg_order_reviews", "review_score", _scores),
    "dq_relationships": " UNION ALL ".join(
        _related(*r)
        for r in [
            ("mart_orders_wide", "order_id", "stg_orders"),
            ("mart_orders_wide", "customer_id", "stg_customers"),
            ("mart_sellers_wide", "seller_id", "stg_sellers"),
            ("stg_order_items", "order_id", "mart_orders_wide"),
            ("stg_order_items", "seller_id", "mart_sellers_wide"),
        ]
    ),
    "repeated_reviews": """
        SELECT review_id, count(*) AS copies, count(DISTINCT order_id) AS orders,
               min(review_score) = max(review_score) AS same_score,
               min(review_created_at) AS first_created_at, max(review_created_at) AS last_created_at
        FROM stg_order_reviews GROUP BY review_id HAVING count(*) > 1""",
    "mart_customers_wide": """
        SELECT c.customer_unique_id, count(m.order_id) AS total_orders,
               ifnull(sum(m.recognized_revenue), 0)::DECIMAL(38,3) AS total_revenue,
               min(m.purchased_at) AS first_purchase_at, max(m.purchased_at) AS last_purchase_at,
               date_trunc('month', min(m.purchased_at))::TIMESTAMP AS cohort_month,
               count(m.order_id) > 1 AS is_repeat
        FROM stg_customers c LEFT JOIN mart_orders_wide m USING (customer_id)
        WHERE c.customer_unique_id IS NOT NULL
        GROUP BY c.customer_unique_id""",
    "dated_orders": """
        SELECT c.customer_unique_id, m.order_id, m.recognized_revenue, m.order_month,
               min(m.order_month) OVER (PARTITION BY c.customer_unique_id) AS first_month
        FROM mart_orders_wide m JOIN stg_customers c USING (customer_id)
        WHERE c.customer_unique_id IS NOT NULL""",
    "customer_cohorts": """
        SELECT strftime(first_month, '%Y-%m') AS cohort,
               date_diff('month', first_month, order_month) AS months_since,
               count(DISTINCT customer_unique_id) AS customers, count(order_id) AS orders,
               sum(recognized_revenue)::DECIMAL(38,3) AS revenue
        FROM dated_orders GROUP BY ALL""",
    "second_purchases": f"""
        SELECT customer_unique_id, min(purchased_at) AS first_at,
               CASE WHEN count(*) > 1 THEN max(purchased_at) END AS second_at
        FROM (SELECT c.customer_unique_id, m.purchased_at,
                     row_number() OVER (PARTITION BY c.customer_unique_id ORDER BY m.purchased_at) AS place
              FROM mart_orders_wide m JOIN stg_customers c USING (customer_id)
              WHERE c.customer_unique_id IS NOT NULL AND m.purchased_at::DATE <= DATE '{AS_OF}')
        WHERE place <= 2 GROUP BY customer_unique_id""",
    "watch_days": f"""
        SELECT date_diff('day', first_at::DATE, coalesce(second_at::DATE, DATE '{AS_OF}')) AS days,
               count(*) AS gone, count(second_at) AS came_back
        FROM second_purchases GROUP BY ALL""",
    "watched_days": """
        SELECT days, came_back, (sum(gone) OVER (ORDER BY days DESC))::BIGINT AS at_risk FROM watch_days""",
    "repeat_purchase": """
        SELECT days AS days_since_first, at_risk, came_back, round(100.0 * (1.0 - away), 4) AS came_back_pct
        FROM (SELECT *, list_reduce(list_prepend(1.0::DOUBLE, list((at_risk - came_back)::DOUBLE / at_risk::DOUBLE)
                                    OVER (ORDER BY days)), lambda x, y: x * y) AS away
              FROM watched_days) WHERE came_back > 0""",
    "category_sales": """
        SELECT m.order_month, ifnull(t.english, p.original) AS category, i.item_price, i.order_item_id
        FROM stg_order_items i
        JOIN (SELECT order_id, min(order_month) AS order_month FROM mart_orders_wide
              WHERE order_status IS DISTINCT FROM 'canceled' AND order_status IS DISTINCT FROM 'unavailable'
              GROUP BY order_id) m ON m.order_id = i.order_id
        LEFT JOIN (SELECT product_id, min(product_category_name) AS original FROM stg_products
                   GROUP BY product_id) p ON p.product_id = i.product_id
        LEFT JOIN (SELECT product_category_name, min(product_category_name_english) AS english
                   FROM stg_category_translation GROUP BY product_category_name) t
               ON t.product_category_name = p.original""",
    "category_revenue": """
        SELECT category, sum(item_price)::DECIMAL(38,3) AS revenue, count(order_item_id) AS items_count
        FROM category_sales GROUP BY ALL""",
    "category_monthly_revenue": """
        SELECT strftime(order_month, '%Y-%m') AS month, category,
               sum(item_price)::DECIMAL(38,3) AS revenue, count(order_item_id) AS items_count
        FROM category_sales GROUP BY ALL""",
    "review_candidates": """
        SELECT r.review_id, r.order_id, o.purchased_at, o.delivered_at, r.reviewed_at,
               ifnull(o.delivered_at <= r.reviewed_at, false) AS after_delivery,
               abs(date_diff('day', (CASE WHEN o.delivered_at <= r.reviewed_at THEN o.delivered_at
                                          ELSE o.purchased_at END)::DATE, r.reviewed_at::DATE)) AS days_apart
        FROM (SELECT review_id, order_id, min(review_created_at) AS reviewed_at FROM stg_order_reviews
              WHERE review_id IS NOT NULL AND order_id IS NOT NULL
              GROUP BY review_id, order_id
              QUALIFY count(*) OVER (PARTITION BY review_id) > 1) r
        LEFT JOIN (SELECT order_id, min(order_purchase_at) AS purchased_at,
                          min(order_delivered_customer_at) AS delivered_at
                   FROM stg_orders GROUP BY order_id) o USING (order_id)""",
    "review_order_match": """
        SELECT review_id, order_id, purchased_at, delivered_at, reviewed_at, after_delivery, days_apart,
               row_number() OVER (PARTITION BY review_id ORDER BY after_delivery DESC, days_apart NULLS LAST,
                                  order_id) = 1 AS is_best,
               max(after_delivery AND place = 1) OVER (PARTITION BY review_id)
                   AND count(*) FILTER (WHERE place = 1) OVER (PARTITION BY review_id) = 1 AS is_clear
        FROM (SELECT *, rank() OVER (PARTITION BY review_id ORDER BY after_delivery DESC,
                                     days_apart NULLS LAST) AS place FROM review_candidates)""",
    "state_delivery_map": """
        SELECT c.state, d.deliveries, d.on_time_pct, d.avg_delivery_days, d.avg_delay_days, c.lat, c.lon
        FROM state_delivery d JOIN state_centres c ON c.state = d.customer_state""",
    "leader_history": """
        SELECT s.seller_id, m.order_id, m.purchased_at, m.order_status, s.seller_revenue, s.seller_items,
               m.delivery_days, m.delay_days, m.is_on_time, m.review_score
        FROM (SELECT i.seller_id, i.order_id, sum(i.item_price)::DECIMAL(38,3) AS seller_revenue,
                     count(i.order_item_id) AS seller_items
              FROM ranked_sellers r JOIN stg_order_items i ON i.seller_id = r.seller_id
              WHERE r.place = 1 GROUP BY ALL) s
        JOIN mart_orders_wide m ON m.order_id = s.order_id""",
    "state_delivery": """
        SELECT customer_state, count(is_on_time) AS deliveries,
               round(100.0 * count(*) FILTER (WHERE is_on_time) / count(*), 1) AS on_time_pct,
               round(avg(delivery_days), 1) AS avg_delivery_days,
               round(avg(delay_days), 1) AS avg_delay_days
        FROM mart_orders_wide WHERE is_on_time IS NOT NULL GROUP BY ALL""",
    "state_satisfaction": """
        SELECT customer_state, count(review_score) AS reviews,
               round(avg(review_score), 2) AS avg_score,
               round(100.0 * count(*) FILTER (WHERE review_score >= 4) / count(*), 1) AS csat_pct
        FROM mart_orders_wide WHERE review_score IS NOT NULL GROUP BY ALL""",
    "delay_by_score": """
        SELECT review_score, count(*) AS orders, round(avg(delay_days), 2) AS avg_delay_days
        FROM mart_orders_wide
        WHERE review_score IS NOT NULL AND delay_days IS NOT NULL GROUP BY ALL""",
    "score_delay_correlation": """
        SELECT n AS orders,
               (n * xy - x * y)::DOUBLE
                   / (sqrt((n * xx - x * x)::DOUBLE) * sqrt((n * yy - y * y)::DOUBLE)) AS correlation
        FROM (SELECT count(*) AS n, sum(review_score) AS x, sum(delay_days) AS y,
                     sum(review_score * delay_days) AS xy, sum(review_score * review_score) AS xx,
                     sum(delay_days * delay_days) AS yy
              FROM mart_orders_wide WHERE review_score IS NOT NULL AND delay_days IS NOT NULL)""",
    "underperforming_sellers": f"""
        SELECT seller_id, seller_state, total_orders, on_time_pct, avg_review_score,
               ifnull(on_time_pct < {LEAST_ON_TIME}, false) AS is_late,
               ifnull(avg_review_score < {LEAST_SCORE}, false) AS is_poorly_rated
        FROM mart_sellers_wide
        WHERE total_orders > 0 AND (on_time_pct < {LEAST_ON_TIME} OR avg_review_score < {LEAST_SCORE})""",
}


# figures over the orders bought in RANGE: the query's name, the figure's
IN_RANGE = {
    "revenue_in_range": "cfo_monthly_revenue",
    "delivery_in_range": "coo_monthly_delivery",
    "reviews_in_range": "cx_monthly_reviews",
    "sellers_in_range": "mart_sellers_wide",
    "state_revenue_in_range": "state_revenue",
    "cards_in_range": "kpi_cards",
}


def statement(name: str) -> str:
    """The dataset's SQL, preceded by the subqueries it needs in order of use."""
    defs = dict(_DEFS)
    if name in IN_RANGE:
        name = IN_RANGE[name]
        defs["every_order"] = defs["mart_orders_wide"]
        defs["mart_orders_wide"] = f"""
            SELECT * FROM every_order
            WHERE purchased_at::DATE BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"""
    ordered: list[str] = []

    def visit(current: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", defs[current])):
            if word in defs and word != current and word not in ordered:
                visit(word)
        if current not in ordered:
            ordered.append(current)

    visit(name)
    parts = [f"{d} AS ({defs[d]})" for d in ordered[:-1]]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + defs[name]
