"""SQL counterparts of the registered queries, for an independent engine.

Written against the raw tables. Common parts are named subqueries; a statement
gets those it mentions. Rounding and sums follow the library's conventions: money
is summed as decimal, doubles are rounded half to even after scaling.
"""

from __future__ import annotations

import re

from merchweave.operators.features import FEATURE_REGISTRY
from merchweave.operators.text import COMMON_WORDS

ONE_HOT = ["brand_1", "brand_2", "brand_3", "brand_4", "brand_5", "brand_6", "brand_8", "brand_9", "brand_10", "brand_11"]


def r(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE)"


def money(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def money_mean(x: str) -> str:
    return f"({money(x)} / CAST(count({x}) AS DOUBLE))"


def tenths_mean(x: str) -> str:
    return f"(CAST(sum(CAST({x} AS DECIMAL(10,1))) AS DOUBLE) / CAST(count({x}) AS DOUBLE))"


def int_mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / CAST(count({x}) AS DOUBLE))"


def scaled(x: str, source: str, column: str) -> str:
    low, high = f"(SELECT min({column}) FROM {source})", f"(SELECT max({column}) FROM {source})"
    return (
        f"(CASE WHEN {low} = {high} THEN 0.0 ELSE (CAST({x} AS DOUBLE) - CAST({low} AS DOUBLE)) "
        f"/ (CAST({high} AS DOUBLE) - CAST({low} AS DOUBLE)) END)"
    )


def day(n: int) -> str:
    return f"o_orderdate + INTERVAL {n} DAY"


VIEWS: dict[str, str] = {}

VIEWS["s_customers"] = """
SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id, CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
       concat(' ', n_name, ' ') AS customer_city, lower(r_name) AS customer_state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""
VIEWS["s_products"] = """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_brand END AS product_category_name,
       CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
       CAST(CASE WHEN p_partkey % 50 <> 0 THEN p_size * 10 END AS DOUBLE) AS product_description_lenght,
       CAST(CASE WHEN p_partkey % 50 <> 0 THEN p_partkey % 7 END AS DOUBLE) AS product_photos_qty,
       CAST(CASE WHEN p_partkey % 40 <> 0 THEN p_size * 100 END AS DOUBLE) AS product_weight_g,
       CAST(p_size + 5 AS DOUBLE) AS product_length_cm, CAST(p_size % 20 + 2 AS DOUBLE) AS product_height_cm,
       CAST(p_size % 30 + 6 AS DOUBLE) AS product_width_cm
FROM part"""
VIEWS["s_categories"] = """
SELECT DISTINCT p_brand AS product_category_name, lower(replace(p_brand, '#', '_')) AS product_category_name_english
FROM part WHERE p_brand NOT IN ('Brand#7', 'Brand#19')"""
VIEWS["s_orders"] = f"""
SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 25 <> 0 THEN o_orderdate END AS order_approved_at,
       CASE WHEN o_orderstatus <> 'P' THEN {day(3)} END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN {day(9)} END AS order_delivered_customer_date,
       {day(20)} AS order_estimated_delivery_date
FROM orders"""
VIEWS["s_order_items"] = """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_quantity AS freight_value
FROM lineitem"""
VIEWS["s_reviews"] = f"""
SELECT o_orderkey * 10 AS review_id, o_orderkey AS order_id,
       CAST((o_orderkey * 7 + o_custkey) % 5 + 1 AS INTEGER) AS review_score,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS review_comment_title,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS review_comment_message,
       {day(12)} AS review_creation_date, {day(14)} AS review_answer_timestamp
FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL
SELECT o_orderkey * 10 + 1, o_orderkey, CAST((o_orderkey * 3 + o_custkey) % 5 + 1 AS INTEGER), NULL, NULL, {day(12)}, {day(14)}
FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 97 = 0"""
VIEWS["s_payments"] = """
SELECT o_orderkey AS order_id, seq AS payment_sequential,
       CASE (o_orderkey + seq) % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto' WHEN 2 THEN 'voucher' ELSE 'debit_card' END AS payment_type,
       CAST(o_orderkey % 12 AS INTEGER) AS payment_installments,
       CASE WHEN seq = 1 THEN o_totalprice ELSE CAST(seq AS DOUBLE) END AS payment_value
FROM orders JOIN (VALUES (1), (2), (3)) s(seq) ON seq <= 1 + o_orderkey % 3"""
VIEWS["s_sellers"] = """
SELECT s_suppkey AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix, n_name AS seller_city, r_name AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
VIEWS["s_points"] = """
SELECT c_custkey AS row_id, CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
       CAST(c_custkey % 100 - 70 AS DOUBLE) AS geolocation_lat, CAST(-(c_custkey % 80) AS DOUBLE) AS geolocation_lng,
       n_name AS geolocation_city, r_name AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
VIEWS["s_geolocation"] = "SELECT * EXCLUDE (row_id) FROM s_points"
VIEWS["s_predictions"] = """
SELECT DISTINCT l_suppkey AS uid, l_partkey AS iid, CAST((l_partkey + l_suppkey) % 5 + 1 AS DOUBLE) AS true_rating,
       CAST((l_partkey * 13 + l_suppkey * 7) % 97 AS DOUBLE) / 10 AS pred_rating
FROM lineitem"""

VIEWS["first_customers"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) AS rn FROM s_customers) WHERE rn = 1"""
VIEWS["c_customers"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, lower(trim(customer_city)) AS customer_city,
       upper(trim(customer_state)) AS customer_state FROM first_customers"""
VIEWS["c_all_customers"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, lower(trim(customer_city)) AS customer_city,
       upper(trim(customer_state)) AS customer_state FROM s_customers"""
IMPUTED = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
VIEWS["i_products"] = (
    "SELECT product_id, product_category_name, "
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM s_products)) AS {c}" for c in IMPUTED)
    + " FROM s_products"
)
VIEWS["c_products"] = """
SELECT p.* REPLACE (coalesce(p.product_category_name, 'unknown') AS product_category_name),
       coalesce(c.product_category_name_english, 'unknown') AS category_english
FROM i_products p LEFT JOIN s_categories c ON p.product_category_name = c.product_category_name"""
VIEWS["p_category"] = """
SELECT p.product_id, coalesce(c.product_category_name_english, 'unknown') AS category_english
FROM s_products p LEFT JOIN s_categories c ON p.product_category_name = c.product_category_name"""
VIEWS["c_reviews"] = """
SELECT review_id, order_id, review_score, coalesce(review_comment_title, '') AS review_comment_title,
       coalesce(review_comment_message, '') AS review_comment_message, review_creation_date, review_answer_timestamp,
       CAST(length(coalesce(review_comment_message, '')) > 0 AS INTEGER) AS has_review_text FROM s_reviews"""
VIEWS["c_payments"] = f"""
SELECT order_id, {money('payment_value')} AS total_payment, max(payment_sequential) AS num_payments,
       arg_min(payment_type, payment_sequential) AS primary_payment_type FROM s_payments GROUP BY order_id"""


def _lines(customers: str) -> str:
    return f"""
SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value,
       coalesce(v.review_score, 0) AS review_score, v.has_review_text, c.customer_unique_id, c.customer_state, p.category_english
FROM s_orders o JOIN s_order_items i ON o.order_id = i.order_id LEFT JOIN c_reviews v ON o.order_id = v.order_id
LEFT JOIN {customers} c ON o.customer_id = c.customer_id LEFT JOIN p_category p ON i.product_id = p.product_id"""


def _transactions(customers: str) -> str:
    return f"""
SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value,
       coalesce(v.review_score, 0) AS review_score, v.has_review_text, y.total_payment, y.num_payments, y.primary_payment_type,
       c.customer_unique_id, c.customer_state, p.category_english, p.product_weight_g, p.product_photos_qty,
       CAST(o.order_purchase_timestamp AS DATE) AS purchase_date, CAST(hour(o.order_purchase_timestamp) AS INTEGER) AS purchase_hour,
       CAST(isodow(o.order_purchase_timestamp) - 1 AS INTEGER) AS purchase_dayofweek
FROM s_orders o JOIN s_order_items i ON o.order_id = i.order_id LEFT JOIN c_reviews v ON o.order_id = v.order_id
LEFT JOIN c_payments y ON o.order_id = y.order_id
LEFT JOIN {customers} c ON o.customer_id = c.customer_id LEFT JOIN c_products p ON i.product_id = p.product_id"""


VIEWS["lines"] = _lines("c_customers")
VIEWS["all_lines"] = _lines("c_all_customers")
VIEWS["pairs"] = f"""
SELECT customer_unique_id, product_id, {r(int_mean('review_score'), 1)} AS rating,
       count(DISTINCT order_id) AS purchase_count, 1 AS implicit
FROM lines WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id, product_id"""


def _user_features(lines: str) -> str:
    return f"""
WITH g AS (
  SELECT customer_unique_id, count(DISTINCT order_id) AS purchase_count, {money('price')} AS total_spending,
         {money_mean('price')} AS avg_order_value,
         {int_mean('CASE WHEN review_score > 0 THEN review_score END')} AS avg_rating_given,
         count(CASE WHEN review_score > 0 THEN 1 END) AS review_count, count(DISTINCT product_id) AS distinct_products,
         count(DISTINCT category_english) AS distinct_categories, {money_mean('freight_value')} AS avg_freight,
         min(customer_state) AS customer_state, max(order_purchase_timestamp) AS last_purchase
  FROM {lines} WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id),
m AS (
  SELECT customer_unique_id, category_english AS preferred_category FROM (
    SELECT customer_unique_id, category_english,
           row_number() OVER (PARTITION BY customer_unique_id ORDER BY count(*) DESC, category_english) AS rn
    FROM {lines} WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id, category_english) WHERE rn = 1)
SELECT g.customer_unique_id, purchase_count, {r('total_spending', 4)} AS total_spending, {r('avg_order_value', 4)} AS avg_order_value,
       {r('avg_rating_given', 4)} AS avg_rating_given, review_count, distinct_products, distinct_categories, preferred_category,
       {r('avg_freight', 4)} AS avg_freight, customer_state,
       CAST(floor((epoch((SELECT max(order_purchase_timestamp) FROM {lines})) - epoch(last_purchase)) / 86400) AS INTEGER) AS recency_days,
       {r('ln(1.0::DOUBLE + purchase_count)', 4)} AS purchase_freq_log, {r('ln(1.0::DOUBLE + total_spending)', 4)} AS spending_log,
       {r(scaled('total_spending', 'g', 'total_spending'), 4)} AS spending_normalized,
       {r(scaled('avg_order_value', 'g', 'avg_order_value'), 4)} AS aov_normalized
FROM g JOIN m ON g.customer_unique_id = m.customer_unique_id"""


VIEWS["user_f"] = _user_features("lines")
VIEWS["item_g"] = f"""
SELECT product_id, min(category_english) AS category_english, count(order_id) AS total_sold,
       {int_mean('CASE WHEN review_score > 0 THEN review_score END')} AS avg_rating_received,
       count(CASE WHEN review_score > 0 THEN 1 END) AS review_count, {money_mean('price')} AS avg_price,
       {money('price')} AS total_revenue, count(DISTINCT customer_unique_id) AS distinct_buyers,
       {money_mean('freight_value')} AS avg_freight
FROM lines GROUP BY product_id"""
PCT_RANK = (
    "(CAST(rank() OVER (ORDER BY avg_price) - 1 AS DOUBLE) + (CAST(count(*) OVER (PARTITION BY avg_price) AS DOUBLE) + 1.0) / 2.0) "
    "/ CAST(count(*) OVER () AS DOUBLE)"
)
VIEWS["item_f"] = (
    f"""
WITH z AS (SELECT *, coalesce(avg_rating_received, 0.0) AS rating0 FROM item_g)
SELECT z.product_id, z.category_english, total_sold, {r('avg_rating_received', 4)} AS avg_rating_received, review_count,
       {r('avg_price', 4)} AS avg_price, {r('total_revenue', 4)} AS total_revenue, distinct_buyers, {r('avg_freight', 4)} AS avg_freight,
       {r('product_weight_g', 4)} AS product_weight_g, {r('product_photos_qty', 4)} AS product_photos_qty,
       {r('product_length_cm * product_height_cm * product_width_cm', 4)} AS product_volume_cm3,
       CAST(rank() OVER (ORDER BY total_sold DESC) AS INTEGER) AS popularity_rank, {r(PCT_RANK, 4)} AS price_percentile,
       {r(scaled('avg_price', 'z', 'avg_price'), 4)} AS price_normalized,
       {r(scaled('total_sold', 'z', 'total_sold'), 4)} AS sold_normalized,
       {r(scaled('rating0', 'z', 'rating0'), 4)} AS rating_normalized, """
    + ", ".join(f"CAST(z.category_english = '{c}' AS INTEGER) AS is_cat_{c}" for c in ONE_HOT)
    + f""", CAST(z.category_english NOT IN ({', '.join(f"'{c}'" for c in ONE_HOT)}) AS INTEGER) AS is_cat_other
FROM z LEFT JOIN c_products p ON z.product_id = p.product_id"""
)
VIEWS["pair_f"] = f"""
SELECT customer_unique_id, product_id, {r('rating', 4)} AS rating, purchase_count, implicit AS implicit_signal,
       {r(scaled('rating', 'pairs', 'rating'), 4)} AS rating_normalized,
       {r('0.6::DOUBLE * ' + scaled('rating', 'pairs', 'rating') + ' + 0.4::DOUBLE * ' + scaled('purchase_count', 'pairs', 'purchase_count'), 4)} AS user_item_affinity
FROM pairs"""
VIEWS["rated"] = """
SELECT x.customer_unique_id, x.product_id, coalesce(p.category_english, 'unknown') AS category_english, x.rating, x.purchase_count
FROM pairs x LEFT JOIN p_category p ON x.product_id = p.product_id"""
VIEWS["training"] = """
SELECT *, CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', CAST(customer_unique_id AS VARCHAR), CAST(product_id AS VARCHAR))), 1, 8)) AS BIGINT) % 100 < 80
               THEN 'train' ELSE 'test' END AS split
FROM rated WHERE customer_unique_id IN (
  SELECT customer_unique_id FROM rated GROUP BY customer_unique_id HAVING count(DISTINCT category_english) >= 2)"""
VIEWS["grid"] = f"""
SELECT customer_unique_id, category_english, {tenths_mean('rating')} AS rating
FROM training WHERE split = 'train' GROUP BY customer_unique_id, category_english"""
VIEWS["vec"] = """
SELECT customer_unique_id AS u, category_english AS c, rating AS x,
       rating / sqrt(sum(rating * rating) OVER (PARTITION BY customer_unique_id)) AS w
FROM grid WHERE rating > 0"""
VIEWS["grid_users"] = "SELECT DISTINCT customer_unique_id AS u FROM grid"
VIEWS["grid_cats"] = "SELECT DISTINCT category_english AS c FROM grid"
VIEWS["sims"] = "SELECT a.u, b.u AS v, round(sum(a.w * b.w), 9) AS sim FROM vec a JOIN vec b ON a.c = b.c GROUP BY a.u, b.u"
VIEWS["knn5"] = """
SELECT u, v, sim, place FROM (
  SELECT x.u, y.u AS v, coalesce(s.sim, 0.0) AS sim,
         row_number() OVER (PARTITION BY x.u ORDER BY coalesce(s.sim, 0.0) DESC, y.u) AS place
  FROM grid_users x JOIN grid_users y ON x.u <> y.u LEFT JOIN sims s ON s.u = x.u AND s.v = y.u) WHERE place <= 5"""
VIEWS["knn_scores"] = f"""
SELECT k.u AS customer_unique_id, g.category_english, {r('sum(g.rating) / max(k.n)', 9)} AS score
FROM (SELECT *, count(*) OVER (PARTITION BY u) AS n FROM knn5) k JOIN grid g ON k.v = g.customer_unique_id AND g.rating > 0
GROUP BY k.u, g.category_english"""
VIEWS["liked"] = """
SELECT customer_unique_id, category_english FROM training
WHERE split = 'test' AND rating >= 4 AND customer_unique_id IN (SELECT u FROM grid_users)"""
VIEWS["popular"] = """
SELECT category_english, count(CASE WHEN rating > 0 THEN 1 END) AS n_users,
       CAST(count(CASE WHEN rating > 0 THEN 1 END) AS DOUBLE) / CAST((SELECT count(*) FROM grid_users) AS DOUBLE) * 100 AS share_pct,
       CAST(row_number() OVER (ORDER BY count(CASE WHEN rating > 0 THEN 1 END) DESC, category_english) AS INTEGER) AS place
FROM grid GROUP BY category_english"""
VIEWS["item_means"] = f"SELECT product_id, any_value(category_english) AS category_english, {tenths_mean('rating')} AS mean_rating FROM training GROUP BY product_id"
VIEWS["user_shares"] = """
SELECT n.u AS id, g.category_english, CAST(count(*) AS DOUBLE) / CAST(max(n.n) AS DOUBLE) * 100 AS share_pct FROM (
  SELECT *, count(*) OVER (PARTITION BY u) AS n FROM (
    SELECT x.u, y.u AS v, row_number() OVER (PARTITION BY x.u ORDER BY coalesce(s.sim, 0.0) DESC, y.u) AS place
    FROM grid_users x CROSS JOIN grid_users y LEFT JOIN sims s ON s.u = x.u AND s.v = y.u) WHERE place <= 100) n
JOIN grid g ON n.v = g.customer_unique_id AND g.rating > 0 GROUP BY n.u, g.category_english"""
VIEWS["user_targets"] = """
SELECT u AS id, c AS category_english, share_pct FROM (
  SELECT x.u, k.c, coalesce(s.share_pct, 0.0) AS share_pct,
         row_number() OVER (PARTITION BY x.u ORDER BY coalesce(s.share_pct, 0.0) DESC, k.c) AS place
  FROM grid_users x CROSS JOIN grid_cats k LEFT JOIN user_shares s ON s.id = x.u AND s.category_english = k.c
  WHERE NOT EXISTS (SELECT 1 FROM vec o WHERE o.u = x.u AND o.c = k.c)) WHERE place <= 20"""


def _user_recs(seen: str) -> str:
    return f"""
SELECT customer_unique_id, CAST(rank AS INTEGER) AS rank, product_id, category_english, {r('score', 4)} AS score FROM (
  SELECT id AS customer_unique_id, product_id, category_english, score,
         row_number() OVER (PARTITION BY id ORDER BY score DESC, share_pct DESC, product_id) AS rank FROM (
    SELECT t.id, i.product_id, t.category_english, t.share_pct, i.mean_rating + t.share_pct / 100 AS score,
           row_number() OVER (PARTITION BY t.id, t.category_english ORDER BY i.mean_rating DESC, i.product_id) AS place
    FROM user_targets t JOIN item_means i ON t.category_english = i.category_english
    WHERE NOT EXISTS (SELECT 1 FROM {seen} b WHERE b.customer_unique_id = t.id AND b.product_id = i.product_id)) WHERE place <= 2)
WHERE rank <= 10"""


VIEWS["disliked"] = "SELECT DISTINCT customer_unique_id, product_id FROM all_lines WHERE review_score = 1"
VIEWS["seen_or_disliked"] = """
SELECT customer_unique_id, product_id FROM training UNION SELECT customer_unique_id, product_id FROM disliked"""
VIEWS["asked"] = """
SELECT DISTINCT i.order_id AS request_id, coalesce(c.product_category_name_english, p.product_category_name, 'no category') AS category
FROM s_order_items i JOIN s_products p ON i.product_id = p.product_id
LEFT JOIN s_categories c ON p.product_category_name = c.product_category_name"""
VIEWS["report_asked"] = """
SELECT * FROM (VALUES (1, 'brand_1'), (2, 'brand_1'), (2, 'brand_2'), (3, 'brand_3'), (3, 'brand_4'), (3, 'brand_5')) t(request_id, category)"""


def _request_views(asked: str, prefix: str) -> None:
    VIEWS[f"{prefix}_valid"] = f"SELECT request_id AS q, category AS c FROM {asked} WHERE category IN (SELECT c FROM grid_cats)"
    VIEWS[f"{prefix}_vec"] = f"SELECT q, c, 5.0::DOUBLE / sqrt(25.0::DOUBLE * count(*) OVER (PARTITION BY q)) AS w FROM {prefix}_valid"
    VIEWS[f"{prefix}_sims"] = f"SELECT a.q, b.u AS v, round(sum(a.w * b.w), 9) AS sim FROM {prefix}_vec a JOIN vec b ON a.c = b.c GROUP BY a.q, b.u"
    VIEWS[f"{prefix}_shares"] = f"""
SELECT n.q, g.category_english, CAST(count(*) AS DOUBLE) / CAST(max(n.n) AS DOUBLE) * 100 AS share_pct FROM (
  SELECT *, count(*) OVER (PARTITION BY q) AS n FROM (
    SELECT x.q, y.u AS v, row_number() OVER (PARTITION BY x.q ORDER BY coalesce(s.sim, 0.0) DESC, y.u) AS place
    FROM (SELECT DISTINCT q FROM {prefix}_valid) x CROSS JOIN grid_users y
    LEFT JOIN {prefix}_sims s ON s.q = x.q AND s.v = y.u) WHERE place <= 100) n
JOIN grid g ON n.v = g.customer_unique_id AND g.rating > 0 GROUP BY n.q, g.category_english"""
    VIEWS[f"{prefix}_ranked"] = f"""
SELECT x.q AS request_id, k.c AS category_english, coalesce(s.share_pct, 0.0) AS share_pct,
       row_number() OVER (PARTITION BY x.q ORDER BY coalesce(s.share_pct, 0.0) DESC, k.c) AS place
FROM (SELECT DISTINCT q FROM {prefix}_valid) x CROSS JOIN grid_cats k
LEFT JOIN {prefix}_shares s ON s.q = x.q AND s.category_english = k.c
WHERE NOT EXISTS (SELECT 1 FROM {prefix}_valid o WHERE o.q = x.q AND o.c = k.c)"""
    VIEWS[f"{prefix}_targets"] = f"""
SELECT request_id, category_english, share_pct, place, 'KNN' AS recommendation_type FROM {prefix}_ranked
UNION ALL
SELECT a.request_id, p.category_english, p.share_pct, p.place, 'rank_based'
FROM (SELECT DISTINCT request_id FROM {asked} WHERE request_id NOT IN (SELECT q FROM {prefix}_valid)) a CROSS JOIN popular p"""


_request_views("asked", "basket")
_request_views("report_asked", "report")

VIEWS["rank_rows"] = """
SELECT uid, iid, pred_rating AS score, CAST(true_rating >= 4 AS INTEGER) AS relevant,
       row_number() OVER (PARTITION BY uid ORDER BY pred_rating DESC, iid) AS pos,
       count(*) OVER (PARTITION BY uid) AS n, sum(CAST(true_rating >= 4 AS INTEGER)) OVER (PARTITION BY uid) AS n_rel
FROM s_predictions"""


def _rank_table(rows: str) -> str:
    return f"""
SELECT uid, CAST(k AS INTEGER) AS k, CAST(sum(relevant) AS DOUBLE) / least(k, max(n)) AS precision,
       CAST(sum(relevant) AS DOUBLE) / max(n_rel) AS recall,
       {r('sum(relevant / log2(pos + 1.0::DOUBLE)) / list_sum(list_transform(range(1, CAST(least(k, max(n_rel)) AS BIGINT) + 1), lambda i: 1.0::DOUBLE / log2(i + 1.0::DOUBLE)))', 9)} AS ndcg,
       {r('sum(relevant * CAST(running AS DOUBLE) / pos) / least(k, max(n_rel), max(n))', 9)} AS map
FROM (SELECT *, sum(relevant) OVER (PARTITION BY uid ORDER BY pos) AS running FROM {rows})
JOIN (VALUES (5), (10), (20)) ks(k) ON pos <= k
WHERE n_rel > 0 GROUP BY uid, k"""


VIEWS["rank_table"] = _rank_table("rank_rows")
VIEWS["checks"] = ""  # filled below

SOURCES = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "products": ["product_id", "product_category_name", *IMPUTED],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "categories": ["product_category_name", "product_category_name_english"],
}
UNIQUE = [
    ("customers", "customer_unique_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("orders", "customer_id"),
    ("sellers", "seller_id"),
    ("categories", "product_category_name"),
]
RANGES = [
    ("products", "product_photos_qty", 0, 50),
    ("products", "product_weight_g", 0, 200000),
    ("products", "product_length_cm", 0, 200),
    ("products", "product_height_cm", 0, 200),
    ("products", "product_width_cm", 0, 200),
    ("order_items", "price", 1000, 100000),
    ("order_items", "freight_value", 2, 49),
    ("order_items", "order_item_id", 1, 50),
    ("reviews", "review_score", 1, 5),
    ("payments", "payment_value", 0, 100000),
    ("payments", "payment_installments", 0, 30),
    ("geolocation", "geolocation_lat", -90, 90),
    ("geolocation", "geolocation_lng", -180, 180),
]
ALLOWED = [
    ("orders", "order_status", ["F", "O"]),
    ("payments", "payment_type", ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]),
]
UNION = "\nUNION ALL\n"


def _check(table: str, check: str, severity: str, violations: str, source: str, detail: str = "''") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, CASE WHEN CAST({violations} AS BIGINT) > 0 THEN '{severity}' ELSE 'PASS' END AS severity, "
        f"CAST({violations} AS BIGINT) AS violations, {detail} AS detail FROM {source}"
    )


def _named(s: str) -> str:
    return f"s_{s}"


SCHEMA_CHECKS = UNION.join(
    [
        "SELECT 'customers' AS table_name, 'schema_missing_columns' AS check_name, 'ERROR' AS severity, CAST(1 AS BIGINT) AS violations, 'customer_email' AS detail",
        "SELECT 'order_items', 'schema_extra_columns', 'WARNING', 1, 'freight_value'",
        *[f"SELECT '{t}', 'schema_match', 'PASS', 0, ''" for t in SOURCES if t not in ("customers", "order_items")],
    ]
)
FULL_DUPES = UNION.join(
    _check(t, "full_row_duplicates", "WARNING", "(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM " + _named(t) + ")))", _named(t))
    for t in SOURCES
)
KEY_DUPES = UNION.join(
    _check(t, f"duplicate_key_{c}", "ERROR", f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {c} FROM {_named(t)})))", _named(t))
    for t, c in UNIQUE
)


def _range(t: str, c: str, low: float, high: float) -> str:
    below, above = f"count(CASE WHEN {c} < {low} THEN 1 END)", f"count(CASE WHEN {c} > {high} THEN 1 END)"
    return _check(t, f"range_{c}", "ERROR", f"({below} + {above})", _named(t), f"({below} || ' below, ' || {above} || ' above')")


RANGE_CHECKS = UNION.join(_range(*x) for x in RANGES)


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


ALLOWED_CHECKS = UNION.join(
    _check(t, f"allowed_values_{c}", "WARNING", f"count(DISTINCT CASE WHEN {c} NOT IN ({_in(v)}) THEN {c} END)", _named(t))
    for t, c, v in ALLOWED
)
VIEWS["checks"] = UNION.join([SCHEMA_CHECKS, FULL_DUPES, KEY_DUPES, RANGE_CHECKS, ALLOWED_CHECKS])


def _completeness(t: str) -> str:
    columns = SOURCES[t]
    present = " + ".join(f"count({c})" for c in columns)
    cells = f"(count(*) * {len(columns)})"
    return (
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, {len(columns)} AS n_columns, CAST({cells} - ({present}) AS BIGINT) AS missing_cells, "
        f"{r(f'CAST({present} AS DOUBLE) / CAST({cells} AS DOUBLE) * 100', 2)} AS completeness_pct FROM {_named(t)}"
    )


VIEWS["sizes"] = UNION.join(_completeness(t) for t in SOURCES)
VIEWS["status"] = """
SELECT table_name, CASE max(CASE severity WHEN 'ERROR' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)
       WHEN 2 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'PASS' END AS overall_status FROM checks GROUP BY table_name"""
VIEWS["snapshots"] = """
SELECT 'v_' || strftime(order_purchase_timestamp, '%Y%m') AS snapshot_id, max(order_purchase_timestamp) AS created_at
FROM s_orders GROUP BY 1"""


def _rated_predictions(kind: str) -> str:
    if kind == "blend":
        pred = (
            "coalesce(CASE WHEN u.m IS NOT NULL AND i.m IS NOT NULL THEN "
            "greatest(1.0, least(5.0, 0.6::DOUBLE * u.m + 0.4::DOUBLE * i.m)) END, (SELECT m FROM train_mean))"
        )
    else:
        pred = "coalesce(i.m, (SELECT m FROM train_mean))"
    return f"""
SELECT t.customer_unique_id AS uid, t.product_id AS iid, t.rating AS true_rating, {r(pred, 9)} AS pred_rating
FROM training t LEFT JOIN train_users u ON t.customer_unique_id = u.customer_unique_id
LEFT JOIN train_items i ON t.product_id = i.product_id WHERE t.split = 'test'"""


VIEWS["train_users"] = f"SELECT customer_unique_id, {tenths_mean('rating')} AS m FROM training WHERE split = 'train' GROUP BY 1"
VIEWS["train_items"] = f"SELECT product_id, {tenths_mean('rating')} AS m FROM training WHERE split = 'train' GROUP BY 1"
VIEWS["train_mean"] = f"SELECT {tenths_mean('rating')} AS m FROM training WHERE split = 'train'"
for _kind in ("blend", "item_mean"):
    VIEWS[f"preds_{_kind}"] = _rated_predictions(_kind)
    VIEWS[f"rows_{_kind}"] = VIEWS["rank_rows"].replace("s_predictions", f"preds_{_kind}")
    VIEWS[f"ranks_{_kind}"] = _rank_table(f"rows_{_kind}")
VIEWS["results"] = UNION.join(
    f"""SELECT '{k}' AS model, {r('sqrt(avg((true_rating - pred_rating) * (true_rating - pred_rating)))', 6)} AS rmse,
       {r('avg(abs(true_rating - pred_rating))', 6)} AS mae, (SELECT {r('avg(ndcg)', 6)} FROM ranks_{k} WHERE k = 10) AS ndcg FROM preds_{k}"""
    for k in ("blend", "item_mean")
)
VIEWS["top_unseen"] = """
SELECT u AS customer_unique_id, product_id, mean_rating, rank FROM (
  SELECT u.customer_unique_id AS u, i.product_id, i.mean_rating,
         row_number() OVER (PARTITION BY u.customer_unique_id ORDER BY i.mean_rating DESC, i.product_id) AS rank
  FROM (SELECT DISTINCT customer_unique_id FROM training) u CROSS JOIN item_means i
  WHERE NOT EXISTS (SELECT 1 FROM training b WHERE b.customer_unique_id = u.customer_unique_id AND b.product_id = i.product_id))
WHERE rank <= 100"""
VIEWS["content"] = """
SELECT customer_unique_id, product_id, mean_rating, rank FROM (
  SELECT l.customer_unique_id, i.product_id, i.mean_rating,
         row_number() OVER (PARTITION BY l.customer_unique_id ORDER BY i.mean_rating DESC, i.product_id) AS rank
  FROM (SELECT DISTINCT customer_unique_id, category_english FROM training WHERE rating >= 4) l
  JOIN item_means i ON l.category_english = i.category_english
  WHERE NOT EXISTS (SELECT 1 FROM training b WHERE b.customer_unique_id = l.customer_unique_id AND b.product_id = i.product_id))
WHERE rank <= 100"""
VIEWS["popular_products"] = """
SELECT product_id, count(rating) AS n_ratings FROM training GROUP BY product_id ORDER BY n_ratings DESC, product_id LIMIT 10"""


def _tfidf(source: str, key: str, text: str) -> str:
    stop = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    return f"""
WITH words AS (
  SELECT {key}, unnest(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {source}),
counts AS (SELECT {key}, term, count(*) AS tf FROM words WHERE term NOT IN ({stop}) GROUP BY {key}, term),
vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM counts GROUP BY term ORDER BY total DESC, term LIMIT 1000),
raw AS (SELECT c.{key}, c.term, c.tf,
               c.tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + v.df)) + 1.0::DOUBLE) AS x
        FROM counts c JOIN vocab v ON c.term = v.term)
SELECT {key}, term, tf, {r(f'x / sqrt(sum(x * x) OVER (PARTITION BY {key}))', 9)} AS weight FROM raw"""


VIEWS["product_terms"] = _tfidf("s_products", "product_id", "product_category_name")

SQL: dict[str, str] = {}

# ---- sources and lake ----
SQL["latest_partition"] = "SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"
SQL["json_flatten"] = """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS "props.k" FROM events"""
RAW = {
    "region": "r_regionkey,r_name",
    "nation": "n_nationkey,n_name,n_regionkey",
    "customer": "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment",
    "supplier": "s_suppkey,s_name,s_nationkey,s_acctbal",
    "part": "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
    "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
    "lineitem": "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate",
    "events": "event_id,ts,user_id,event_type,value,props",
    "documents": "doc_id,text,lang,source,n_chars",
    "embeddings": "vec_id,embedding,label",
    "pages": "page_id,url,html",
    "benchmark": "item_id,text",
    "labels": "doc_id,quality,toxic",
    "conversations": "conv_id,turn,role,text",
}
VIEWS["audit"] = UNION.join(
    [
        f"SELECT '{t}' AS source_name, count(*) AS row_count, 'SUCCESS' AS status, '{c}' AS columns, {c.count(',') + 1} AS column_count FROM {t}"
        for t, c in RAW.items()
    ]
    + ["SELECT 'absent', 0, 'FAILED', '', 0"]
)
SQL["ingest_audit"] = "SELECT * FROM audit"
SQL["ingest_summary"] = """
SELECT count(*) AS total, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS success,
       count(CASE WHEN status <> 'SUCCESS' THEN 1 END) AS failed, CAST(sum(row_count) AS BIGINT) AS rows_ingested FROM audit"""


def _checksum(t: str, changed: str = "") -> str:
    """Sums over both halves of the rows' digests; ``changed`` is a column read in lower case."""
    texts = [f"CAST({f'lower({c})' if c == changed else c} AS VARCHAR)" for c in RAW[t].split(",")]
    digest = "md5(concat(" + ", ".join(f"coalesce(length({x}) || ':' || {x}, '-')" for x in texts) + "))"
    halves = [f"coalesce(CAST(sum(CAST('0x' || substr(d, {at}, 16) AS UBIGINT)) AS VARCHAR), '0')" for at in (1, 17)]
    return f"SELECT count(*) AS n, {halves[0]} || '-' || {halves[1]} AS checksum FROM (SELECT {digest} AS d FROM {t})"


def _verified(t: str) -> str:
    actual = _checksum(t, "n_name" if t == "nation" else "")
    expected = "'skipped'" if t == "labels" else "CASE WHEN a.checksum = e.checksum THEN 'verified' ELSE 'mismatched' END"
    return (
        f"SELECT '{t}' AS source_name, a.n AS actual_rows, a.checksum AS actual_checksum, {expected} AS result "
        f"FROM ({actual}) a, ({_checksum(t)}) e"
    )


SQL["checksum_verify"] = UNION.join(_verified(t) for t in RAW if t != "embeddings")
_BYTES = "(n_chars * n_chars * doc_id)"


def _size(power: int, unit: str) -> str:
    return f"printf('%.1f {unit}', {r(f'CAST({_BYTES} AS DOUBLE) / {1024**power}::DOUBLE', 1)})"


SQL["human_size_text"] = f"""
SELECT doc_id, {_BYTES} AS n_bytes, CASE WHEN {_BYTES} < 1024 THEN {_size(0, 'B')} WHEN {_BYTES} < {1024**2} THEN {_size(1, 'KB')}
  WHEN {_BYTES} < {1024**3} THEN {_size(2, 'MB')} WHEN {_BYTES} < {1024**4} THEN {_size(3, 'GB')} ELSE {_size(4, 'TB')} END AS size_human
FROM documents"""
SQL["source_names"] = UNION.join(
    f"SELECT '{t.removesuffix('s')}' AS source_name, count(*) AS n_rows FROM {t}" for t in RAW
)
SQL["sample_rows"] = """
SELECT order_id, order_status FROM (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(order_id AS VARCHAR), '42')), order_id) AS p, count(*) OVER () AS n FROM s_orders)
WHERE p <= greatest(1, CAST(round_even(n * 10.0 / 100, 0) AS BIGINT))"""
VIEWS["users_g"] = f"""
SELECT customer_unique_id, count(DISTINCT order_id) AS purchase_count, {money('price')} AS total_spending
FROM lines WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id"""
SQL["constraint_check"] = UNION.join(
    [
        *[
            _check(t, "primary_key_" + "_".join(k), "ERROR", "count(*)", f"(SELECT 1 FROM {v} GROUP BY {', '.join(k)} HAVING count(*) > 1)")
            for t, v, k in (
                ("user_features", "users_g", ["customer_unique_id"]),
                ("item_features", "item_g", ["product_id"]),
                ("interaction_features", "pairs", ["customer_unique_id", "product_id"]),
                ("order_items", "s_order_items", ["order_id", "order_item_id"]),
            )
        ],
        *[
            _check(t, f"foreign_key_{c}", "ERROR", "count(*)", f"(SELECT 1 FROM {v} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {p}))")
            for t, v, c, p in (
                ("interaction_features", "pairs", "customer_unique_id", "users_g"),
                ("interaction_features", "pairs", "product_id", "item_g"),
                ("orders", "s_orders", "order_id", "s_order_items"),
            )
        ],
        *[
            _check(t, f"not_null_{c}", "ERROR", f"count(CASE WHEN {c} IS NULL THEN 1 END)", v)
            for t, v, c in (
                ("user_features", "users_g", "purchase_count"),
                ("user_features", "users_g", "total_spending"),
                ("orders", "s_orders", "order_status"),
                ("orders", "s_orders", "order_approved_at"),
            )
        ],
    ]
)

# ---- quality ----
SQL["dq_missing"] = UNION.join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    f"{r(f'CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100', 2)} AS missing_pct, "
    f"{r(f'CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100', 2)} AS completeness_pct FROM s_{t}"
    for t, cs in SOURCES.items()
    for c in cs
)
SQL["dq_completeness"] = "SELECT * FROM sizes"
SQL["dq_full_dupes"] = FULL_DUPES
SQL["dq_key_dupes"] = KEY_DUPES
SQL["dq_range"] = RANGE_CHECKS
SQL["dq_allowed"] = ALLOWED_CHECKS
SQL["dq_unexpected_values"] = UNION.join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS unexpected_value, count(*) AS n_rows FROM s_{t} WHERE {c} NOT IN ({_in(v)}) GROUP BY {c}"
    for t, c, v in ALLOWED
)
NUMERIC = {
    "products": ["product_id", *IMPUTED],
    "payments": ["order_id", "payment_sequential", "payment_installments", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "customers": ["customer_id", "customer_unique_id"],
    "orders": ["order_id", "customer_id"],
    "sellers": ["seller_id"],
    "geolocation": ["geolocation_lat", "geolocation_lng"],
}
SQL["profile_numeric"] = UNION.join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS null_count, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {r(f'avg(CAST({c} AS DOUBLE))', 2)} AS mean, "
    f"{r(f'stddev_samp(CAST({c} AS DOUBLE))', 2)} AS std, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 2)} AS median FROM s_{t}"
    for t, cs in NUMERIC.items()
    for c in cs
)
TEXT = {
    "orders": ["order_status"],
    "payments": ["payment_type"],
    "reviews": ["review_comment_title", "review_comment_message"],
    "products": ["product_category_name"],
    "sellers": ["seller_zip_code_prefix", "seller_city", "seller_state"],
    "customers": ["customer_zip_code_prefix", "customer_city", "customer_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
    "categories": ["product_category_name", "product_category_name_english"],
}
SQL["profile_categorical"] = UNION.join(
    f"SELECT * FROM (SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS n, "
    f"CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS place, count(*) OVER () AS unique_count "
    f"FROM s_{t} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE place <= 5"
    for t, cs in TEXT.items()
    for c in cs
)
SQL["dq_status"] = "SELECT * FROM status"
SQL["dq_summary"] = """
SELECT c.table_name, max(CASE WHEN check_name = 'full_row_duplicates' THEN violations END) AS full_duplicates,
       count(CASE WHEN severity = 'PASS' THEN 1 END) AS n_pass, count(CASE WHEN severity = 'WARNING' THEN 1 END) AS n_warning,
       count(CASE WHEN severity = 'ERROR' THEN 1 END) AS n_error, any_value(overall_status) AS overall_status,
       any_value(n_rows) AS n_rows, any_value(n_columns) AS n_columns, any_value(completeness_pct) AS completeness_pct
FROM checks c JOIN status s ON c.table_name = s.table_name JOIN sizes z ON c.table_name = z.table_name GROUP BY c.table_name"""
SQL["dq_issues"] = "SELECT * FROM checks WHERE severity <> 'PASS'"
SQL["stage_success"] = f"""
SELECT count(*) AS n_stages, count(CASE WHEN overall_status <> 'ERROR' THEN 1 END) AS n_success,
       {r("avg(CASE WHEN overall_status <> 'ERROR' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100", 1)} AS success_pct FROM status"""

# ---- cleaning ----
SQL["dedupe_keep_first"] = "SELECT * FROM first_customers"
SQL["clean_customers"] = "SELECT * FROM c_customers"
SQL["clean_products"] = "SELECT * FROM c_products"
SQL["impute_median"] = "SELECT * FROM i_products"


def _parsed(c: str, expression: str) -> str:
    return f"TRY_CAST({expression} AS TIMESTAMP) AS {c}"


def _text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


SQL["clean_orders"] = (
    "SELECT order_id, customer_id, order_status, "
    + _parsed(
        "order_purchase_timestamp",
        f"CASE WHEN order_id % 60 = 0 THEN 'not a date' ELSE {_text('order_purchase_timestamp')} END",
    )
    + ", "
    + ", ".join(_parsed(c, _text(c)) for c in SOURCES["orders"][4:])
    + " FROM s_orders"
)
SQL["filter_status"] = "SELECT * FROM s_orders WHERE order_status IN ('F', 'O')"
SQL["clean_reviews"] = "SELECT * FROM c_reviews"
SQL["geo_clean"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY row_id) AS rn FROM s_points)
WHERE rn = 1 AND geolocation_lat BETWEEN -60 AND 10 AND geolocation_lng BETWEEN -80 AND -30"""
SQL["txn_time_parts"] = """
SELECT order_id, order_purchase_timestamp, CAST(order_purchase_timestamp AS DATE) AS purchase_date,
       CAST(hour(order_purchase_timestamp) AS INTEGER) AS purchase_hour, CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_dayofweek
FROM s_orders"""
SQL["minmax_scale"] = f"""
SELECT order_id, payment_sequential, payment_value, {r(scaled('payment_value', 's_payments', 'payment_value'), 6)} AS scaled FROM s_payments"""
SQL["log_features"] = f"""
SELECT order_id, spent, {r('ln(1.0::DOUBLE + spent)', 4)} AS spent_log
FROM (SELECT order_id, {money('price')} AS spent FROM s_order_items GROUP BY order_id)"""
SQL["one_hot"] = (
    "SELECT product_id, category_english, "
    + ", ".join(f"CAST(category_english = '{c}' AS INTEGER) AS is_cat_{c}" for c in ONE_HOT)
    + f", CAST(category_english NOT IN ({_in(ONE_HOT)}) AS INTEGER) AS is_cat_other FROM p_category"
)
SQL["recency"] = """
SELECT order_id, CAST(floor((epoch((SELECT max(order_purchase_timestamp) FROM s_orders)) - epoch(order_purchase_timestamp)) / 86400) AS INTEGER) AS recency_days
FROM s_orders"""
SQL["dense_ids"] = "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer)"

# ---- joins ----
SQL["join_inner"] = "SELECT o.*, i.* EXCLUDE (order_id) FROM s_orders o JOIN s_order_items i ON o.order_id = i.order_id"
SQL["join_left_fanout"] = """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, coalesce(v.review_score, 0) AS review_score, v.has_review_text
FROM s_orders o JOIN s_order_items i ON o.order_id = i.order_id LEFT JOIN c_reviews v ON o.order_id = v.order_id"""
SQL["transactions"] = _transactions("c_customers")
SQL["transactions_all_orders"] = _transactions("c_all_customers")
SQL["merged_inner"] = """
SELECT v.order_id, c.customer_unique_id, i.product_id, t.product_category_name_english, v.review_score, i.price, p.product_photos_qty
FROM s_reviews v JOIN s_orders o ON v.order_id = o.order_id JOIN s_order_items i ON i.order_id = v.order_id
JOIN s_customers c ON c.customer_id = o.customer_id JOIN s_products p ON p.product_id = i.product_id
JOIN s_categories t ON t.product_category_name = p.product_category_name"""
SQL["distinct_dropna"] = """
SELECT DISTINCT review_score, review_comment_title, review_comment_message FROM s_reviews
WHERE review_score IS NOT NULL AND review_comment_title IS NOT NULL AND review_comment_message IS NOT NULL"""
SQL["interaction_category"] = """
SELECT x.*, coalesce(p.category_english, 'unknown') AS category_english FROM pairs x LEFT JOIN p_category p ON x.product_id = p.product_id"""
SQL["multi_category_users"] = """
SELECT customer_unique_id, count(DISTINCT category_english) AS distinct_categories FROM rated GROUP BY 1 HAVING count(DISTINCT category_english) >= 2"""
SQL["unseen_items"] = "SELECT * FROM p_category WHERE product_id NOT IN (SELECT product_id FROM pairs)"
SQL["exclusion_union"] = "SELECT customer_unique_id, product_id FROM pairs UNION SELECT customer_unique_id, product_id FROM disliked"

# ---- aggregates and features ----
SQL["payments_per_order"] = "SELECT * FROM c_payments"
SQL["interactions"] = "SELECT * FROM pairs"
SQL["user_features"] = "SELECT * FROM user_f"
SQL["user_features_all_orders"] = _user_features("all_lines")
SQL["mode_agg"] = """
SELECT order_id, category_english AS preferred_category FROM (
  SELECT i.order_id, p.category_english, row_number() OVER (PARTITION BY i.order_id ORDER BY count(*) DESC, p.category_english) AS rn
  FROM s_order_items i LEFT JOIN p_category p ON i.product_id = p.product_id GROUP BY i.order_id, p.category_english) WHERE rn = 1"""
SQL["item_features"] = "SELECT * FROM item_f"
SQL["interaction_features"] = "SELECT * FROM pair_f"
SQL["popularity_rank"] = """
SELECT product_id, total_sold, CAST(rank() OVER (ORDER BY total_sold DESC) AS INTEGER) AS popularity_rank
FROM (SELECT product_id, count(*) AS total_sold FROM s_order_items GROUP BY product_id)"""
SQL["price_percentile"] = f"""
SELECT product_id, {r('avg_price', 4)} AS avg_price, {r(PCT_RANK, 4)} AS price_percentile
FROM (SELECT product_id, {money_mean('price')} AS avg_price FROM s_order_items GROUP BY product_id)"""
_SPARSE = "(1.0::DOUBLE - CAST({n} AS DOUBLE) / (CAST({u} AS DOUBLE) * CAST({i} AS DOUBLE))) * 100"
SQL["sparsity"] = f"""
SELECT n_users, n_items, n_interactions, {r(_SPARSE.format(n='n_interactions', u='n_users', i='n_items'), 4)} AS sparsity_pct
FROM (SELECT count(DISTINCT customer_unique_id) AS n_users, count(DISTINCT product_id) AS n_items, count(*) AS n_interactions FROM pairs)"""
SQL["prep_summary"] = f"""
SELECT *, {r(_SPARSE.format(n='interaction_count', u='unique_users', i='unique_products'), 4)} AS sparsity_pct FROM (
  SELECT count(*) AS transaction_rows, count(DISTINCT customer_unique_id) AS unique_users, count(DISTINCT product_id) AS unique_products,
         count(DISTINCT category_english) AS unique_categories,
         {r(int_mean('CASE WHEN review_score > 0 THEN review_score END'), 2)} AS avg_review_score,
         min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase,
         (SELECT count(*) FROM pairs) AS interaction_count FROM lines)"""
_TABLES = {"user_features": "user_f", "item_features": "item_f", "interaction_features": "pair_f"}
_COUNTS = {"user_features": 16, "item_features": 28, "interaction_features": 7}


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SQL["feature_registry"] = UNION.join(
    "SELECT "
    + ", ".join(
        f"{_quote(v)} AS {n}"
        for v, n in zip(
            row, ["feature_name", "feature_table", "feature_type", "transformation", "description", "source_columns"], strict=True
        )
    )
    + f", (SELECT count({'is_cat_other' if row[0] == 'is_cat_*' else row[0]}) FROM {_TABLES[row[1]]}) AS n_filled"
    for row in FEATURE_REGISTRY
)
SQL["feature_summary"] = UNION.join(
    f"SELECT '{t}' AS feature_table, CAST({sum(1 for x in FEATURE_REGISTRY if x[1] == t)} AS BIGINT) AS n_registered, {_COUNTS[t]} AS n_columns, count(*) AS n_rows FROM {v}"
    for t, v in _TABLES.items()
)
_ITEM_COLUMNS = (
    "product_id,category_english,total_sold,avg_rating_received,review_count,avg_price,total_revenue,distinct_buyers,avg_freight,"
    "product_weight_g,product_photos_qty,product_volume_cm3,popularity_rank,price_percentile,price_normalized,sold_normalized,"
    "rating_normalized," + ",".join(f"is_cat_{c}" for c in ONE_HOT) + ",is_cat_other"
)
_USER_COLUMNS = (
    "customer_unique_id,purchase_count,total_spending,avg_order_value,avg_rating_given,review_count,distinct_products,"
    "distinct_categories,preferred_category,avg_freight,customer_state,recency_days,purchase_freq_log,spending_log,"
    "spending_normalized,aov_normalized"
)
_PAIR_COLUMNS = "customer_unique_id,product_id,rating,purchase_count,implicit_signal,rating_normalized,user_item_affinity"
SQL["group_stats"] = UNION.join(
    f"SELECT '{t}' AS feature_table, count(*) AS row_count, {_COUNTS[t]} AS column_count, '{c}' AS columns FROM {_TABLES[t]}"
    for t, c in (("user_features", _USER_COLUMNS), ("item_features", _ITEM_COLUMNS), ("interaction_features", _PAIR_COLUMNS))
)

# ---- exploratory ----
SQL["eda_score_dist"] = "SELECT review_score, count(*) AS n FROM lines WHERE review_score > 0 GROUP BY review_score"
SQL["eda_top_categories"] = "SELECT category_english, count(*) AS n FROM lines GROUP BY 1 ORDER BY n DESC, category_english LIMIT 15"
SQL["eda_long_tail"] = """
SELECT product_id, n_sold, row_number() OVER (ORDER BY n_sold DESC, product_id) AS place
FROM (SELECT product_id, count(*) AS n_sold FROM lines GROUP BY product_id)"""
SQL["eda_user_activity"] = """
SELECT n_purchases, count(*) AS n_users FROM (SELECT customer_unique_id, CAST(sum(purchase_count) AS BIGINT) AS n_purchases FROM pairs GROUP BY 1)
GROUP BY n_purchases ORDER BY n_purchases LIMIT 10"""
SQL["eda_monthly"] = """
SELECT last_day(CAST(m AS DATE)) AS month_end, count(l.order_id) AS n_lines
FROM (SELECT unnest(generate_series(date_trunc('month', min(order_purchase_timestamp))::TIMESTAMP, date_trunc('month', max(order_purchase_timestamp))::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM lines) s
LEFT JOIN lines l ON date_trunc('month', l.order_purchase_timestamp) = s.m GROUP BY s.m"""
SQL["eda_heatmap"] = (
    "SELECT CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_dayofweek, "
    + ", ".join(f"count(CASE WHEN hour(order_purchase_timestamp) = {h} THEN order_id END) AS h{h:02d}" for h in range(24))
    + " FROM lines GROUP BY 1"
)
SQL["eda_price_hist"] = """
WITH p AS (SELECT least(price, 50000.0::DOUBLE) AS x FROM lines), e AS (SELECT min(x) AS lo, max(x) AS hi FROM p)
SELECT CAST(b AS INTEGER) AS bin, count(x) AS n_lines FROM range(0, 50) t(b)
LEFT JOIN (SELECT x, least(CAST(floor((x - lo) / (hi - lo) * 50) AS INTEGER), 49) AS bb FROM p, e) q ON q.bb = t.b GROUP BY b"""
SQL["eda_payment_share"] = f"""
SELECT primary_payment_type, count(*) AS n_lines, {r('CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(count(*)) OVER () AS DOUBLE)', 1)} AS share_pct
FROM lines l JOIN c_payments y ON l.order_id = y.order_id GROUP BY primary_payment_type"""

# ---- feature store ----
SQL["snapshot_list"] = "SELECT snapshot_id, created_at, created_at = (SELECT max(created_at) FROM snapshots) AS is_latest FROM snapshots"
SQL["asof_snapshot"] = """
SELECT m.order_id, m.order_approved_at AS at, s.snapshot_id, s.created_at
FROM (SELECT * FROM s_orders WHERE order_approved_at IS NOT NULL) m ASOF LEFT JOIN snapshots s ON m.order_approved_at >= s.created_at"""
SQL["training_set"] = """
SELECT i.* FROM pair_f i JOIN user_f u ON i.customer_unique_id = u.customer_unique_id WHERE u.distinct_categories >= 2"""
SQL["training_set_wide"] = """
SELECT i.*, u.total_spending, u.avg_order_value, u.avg_rating_given, u.review_count AS user_review_count, u.distinct_products,
       u.distinct_categories, u.preferred_category, u.recency_days, u.purchase_freq_log, u.spending_normalized, u.aov_normalized,
       u.customer_state, t.category_english, t.total_sold, t.avg_rating_received, t.review_count AS item_review_count, t.avg_price,
       t.total_revenue, t.distinct_buyers, t.popularity_rank, t.price_percentile, t.price_normalized, t.sold_normalized,
       t.rating_normalized AS item_rating_normalized
FROM pair_f i LEFT JOIN user_f u ON i.customer_unique_id = u.customer_unique_id LEFT JOIN item_f t ON i.product_id = t.product_id"""
SQL["training_sample"] = """
SELECT customer_unique_id, product_id, rating FROM training
ORDER BY md5(concat_ws('|', CAST(customer_unique_id AS VARCHAR), CAST(product_id AS VARCHAR), '42')), customer_unique_id, product_id LIMIT 1000"""
SQL["distinct_ids"] = "SELECT DISTINCT customer_unique_id FROM pairs ORDER BY 1 LIMIT 20"
SQL["feature_lookup"] = "SELECT * FROM user_f ORDER BY customer_unique_id LIMIT 20"
SQL["user_interactions"] = "SELECT * FROM pairs WHERE customer_unique_id = (SELECT min(customer_unique_id) FROM pairs)"
SQL["store_status"] = UNION.join(
    f"SELECT 'v_20240101_120000' AS snapshot_id, '{t}' AS feature_table, count(*) AS row_count, {_COUNTS[t]} AS column_count, TRUE AS is_latest FROM {v}"
    for t, v in _TABLES.items()
)

# ---- model and recommendations ----
SQL["train_test_split"] = "SELECT customer_unique_id, product_id, split FROM training"
SQL["train_grid"] = "SELECT * FROM grid"
SQL["user_category_grid"] = (
    "SELECT customer_unique_id, "
    + ", ".join(f"coalesce(max(CASE WHEN category_english = '{c}' THEN rating END), 0.0::DOUBLE) AS {c}" for c in ONE_HOT)
    + " FROM grid GROUP BY customer_unique_id"
)
SQL["popular_categories"] = f"SELECT category_english, n_users, {r('share_pct', 6)} AS share_pct, place FROM popular"
SQL["item_mean_rating"] = f"SELECT product_id, {r('mean_rating', 6)} AS mean_rating FROM item_means"
SQL["top2_per_category"] = f"""
SELECT category_english, product_id, {r('mean_rating', 6)} AS mean_rating, item_place FROM (
  SELECT *, row_number() OVER (PARTITION BY category_english ORDER BY mean_rating DESC, product_id) AS item_place FROM item_means) WHERE item_place <= 2"""
SQL["knn_users"] = "SELECT u AS customer_unique_id, CAST(place AS INTEGER) AS place, v AS neighbour_id, sim AS similarity FROM knn5"
SQL["neighbour_scores"] = "SELECT * FROM knn_scores"
SQL["knn_precision_recall"] = """
WITH top AS (
  SELECT u, c FROM (
    SELECT x.u, k.c, row_number() OVER (PARTITION BY x.u ORDER BY coalesce(s.score, 0.0) DESC, k.c) AS place
    FROM grid_users x CROSS JOIN grid_cats k LEFT JOIN knn_scores s ON s.customer_unique_id = x.u AND s.category_english = k.c) WHERE place <= 5),
hit AS (SELECT u, count(*) AS hits FROM top WHERE (u, c) IN (SELECT (customer_unique_id, category_english) FROM liked) GROUP BY u)
SELECT l.customer_unique_id, count(*) AS n_liked, CAST(coalesce(any_value(h.hits), 0) AS INTEGER) AS hits,
       CAST(coalesce(any_value(h.hits), 0) AS DOUBLE) / 5.0::DOUBLE AS precision,
       CAST(coalesce(any_value(h.hits), 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS recall
FROM liked l LEFT JOIN hit h ON l.customer_unique_id = h.u GROUP BY l.customer_unique_id"""
SQL["knn_ndcg"] = f"""
WITH truth AS (
  SELECT customer_unique_id AS u, category_english AS c, arg_max(rating, product_id) AS gain FROM training
  WHERE split = 'test' AND customer_unique_id IN (SELECT customer_unique_id FROM liked) AND category_english IN (SELECT c FROM grid_cats) GROUP BY 1, 2),
dense AS (
  SELECT x.u, k.c, coalesce(t.gain, 0.0) AS gain, coalesce(s.score, 0.0) AS score
  FROM (SELECT DISTINCT u FROM truth) x CROSS JOIN grid_cats k LEFT JOIN truth t ON t.u = x.u AND t.c = k.c
  LEFT JOIN knn_scores s ON s.customer_unique_id = x.u AND s.category_english = k.c),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, c) AS p, row_number() OVER (PARTITION BY u ORDER BY gain DESC, c) AS q FROM dense),
blocks AS (
  SELECT u, score, avg(gain) * sum(CASE WHEN p <= 5 THEN 1.0::DOUBLE / log2(p + 1.0::DOUBLE) ELSE 0.0 END) AS part FROM placed GROUP BY u, score),
ideal AS (SELECT u, sum(gain / log2(q + 1.0::DOUBLE)) AS idcg FROM placed WHERE q <= 5 GROUP BY u)
SELECT b.u AS customer_unique_id, {r('CASE WHEN any_value(i.idcg) > 0 THEN sum(b.part) / any_value(i.idcg) ELSE 0.0 END', 9)} AS ndcg
FROM blocks b JOIN ideal i ON b.u = i.u GROUP BY b.u"""
SQL["knn_metrics"] = f"""
SELECT 'precision_5' AS metric, count(*) AS n_users, coalesce({r('avg(precision)', 6)}, 0.0::DOUBLE) AS mean FROM ({SQL["knn_precision_recall"]})
UNION ALL SELECT 'recall_5', count(*), coalesce({r('avg(recall)', 6)}, 0.0::DOUBLE) FROM ({SQL["knn_precision_recall"]})
UNION ALL SELECT 'ndcg_5', count(*), coalesce({r('avg(ndcg)', 6)}, 0.0::DOUBLE) FROM ({SQL["knn_ndcg"]})"""
SQL["published_grid"] = "SELECT *, 'v2' AS model_version FROM grid"
SQL["recommend_users"] = _user_recs("training")
SQL["recommend_users_excluding"] = _user_recs("seen_or_disliked")
SQL["recommend_categories"] = f"""
SELECT request_id, CAST(rank AS INTEGER) AS rank, product_id, category_english, {r('score', 4)} AS score, recommendation_type FROM (
  SELECT t.request_id, t.category_english, t.recommendation_type, i.product_id, i.mean_rating + t.share_pct / 100 AS score,
         row_number() OVER (PARTITION BY t.request_id ORDER BY i.mean_rating + t.share_pct / 100 DESC, t.share_pct DESC, i.product_id) AS rank
  FROM basket_targets t JOIN (
    SELECT *, row_number() OVER (PARTITION BY category_english ORDER BY mean_rating DESC, product_id) AS item_place FROM item_means) i
    ON t.category_english = i.category_english AND i.item_place <= 2 WHERE t.place <= 20) WHERE rank <= 10"""
SQL["recommend_fallback"] = f"""
SELECT request_id, category_english, {r('share_pct', 6)} AS share_pct, recommendation_type FROM basket_targets WHERE place <= 10"""
SQL["category_confidence"] = f"""
SELECT CAST(request_id AS BIGINT) AS request_id, CAST(place AS INTEGER) AS rank, category_english, {r('share_pct', 2)} AS confidence_pct
FROM report_ranked WHERE place <= 5 AND share_pct > 0"""

# ---- ranking metrics ----
for _name, _column in (("precision_at_k", "precision"), ("recall_at_k", "recall"), ("ndcg_at_k", "ndcg"), ("map_at_k", "map")):
    SQL[_name] = f"SELECT uid, k, {r(_column, 6)} AS {_column} FROM rank_table"
SQL["graded_ndcg"] = f"""
WITH o AS (
  SELECT uid, true_rating AS g, row_number() OVER (PARTITION BY uid ORDER BY pred_rating DESC, iid) AS p,
         row_number() OVER (PARTITION BY uid ORDER BY true_rating DESC, iid) AS q FROM s_predictions)
SELECT uid, {r('sum(CASE WHEN p <= 10 THEN g / log2(p + 1.0::DOUBLE) END) / sum(CASE WHEN q <= 10 THEN g / log2(q + 1.0::DOUBLE) END)', 6)} AS ndcg
FROM o GROUP BY uid"""
SQL["ranking_metrics"] = f"""
SELECT k, metric, count(*) AS n_users, {r('avg(value)', 6)} AS mean, {r('stddev_pop(value)', 6)} AS std FROM (
  UNPIVOT (SELECT uid, k, precision, recall, ndcg, map FROM rank_table WHERE k IN (5, 10)) ON precision, recall, ndcg, map INTO NAME metric VALUE value)
GROUP BY k, metric"""
SQL["rating_errors"] = f"""
SELECT count(*) AS n_rows, {r('sqrt(avg((true_rating - pred_rating) * (true_rating - pred_rating)))', 6)} AS rmse,
       {r('avg(abs(true_rating - pred_rating))', 6)} AS mae FROM s_predictions"""

# ---- rating models ----
SQL["blend_rating"] = f"""
SELECT t.product_id, t.customer_unique_id, {r('coalesce(CASE WHEN u.m IS NOT NULL AND i.mean_rating IS NOT NULL THEN greatest(1.0, least(5.0, 0.6::DOUBLE * u.m + 0.4::DOUBLE * i.mean_rating)) END, (SELECT ' + tenths_mean('rating') + ' FROM training))', 6)} AS pred_rating
FROM rated t LEFT JOIN (SELECT customer_unique_id, {tenths_mean('rating')} AS m FROM training GROUP BY 1) u ON t.customer_unique_id = u.customer_unique_id
LEFT JOIN item_means i ON t.product_id = i.product_id"""
SQL["top_rated_unseen"] = f"""
SELECT customer_unique_id, CAST(rank AS INTEGER) AS rank, product_id, {r('mean_rating', 6)} AS score FROM top_unseen WHERE rank <= 10"""
SQL["popular_items"] = "SELECT * FROM popular_products"
SQL["content_recs"] = f"""
SELECT customer_unique_id, CAST(rank AS INTEGER) AS rank, product_id, {r('mean_rating', 6)} AS score FROM content WHERE rank <= 10
UNION ALL
SELECT u.customer_unique_id, CAST(p.rank AS INTEGER), p.product_id, 0.0
FROM (SELECT DISTINCT customer_unique_id FROM rated WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM training)) u
CROSS JOIN (SELECT product_id, row_number() OVER (ORDER BY n_ratings DESC, product_id) AS rank FROM popular_products) p"""
SQL["hybrid_recs"] = f"""
WITH n AS (SELECT customer_unique_id, count(*) >= 2 AS many FROM training GROUP BY 1),
parts AS (
  SELECT t.customer_unique_id, product_id, (CASE WHEN many THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END) * mean_rating AS part FROM top_unseen t JOIN n ON t.customer_unique_id = n.customer_unique_id
  UNION ALL
  SELECT c.customer_unique_id, product_id, (CASE WHEN many THEN 0.2::DOUBLE ELSE 0.8::DOUBLE END) * mean_rating FROM content c JOIN n ON c.customer_unique_id = n.customer_unique_id),
total AS (SELECT customer_unique_id, product_id, round(sum(part), 9) AS score FROM parts GROUP BY 1, 2)
SELECT customer_unique_id, product_id, {r('score', 6)} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY score DESC, product_id) AS rank FROM total) WHERE rank <= 10"""


def _item_knn(source: str) -> str:
    return f"""
SELECT i, j, sim, place FROM (
  SELECT a.i, b.i AS j, round(sum(a.w * b.w), 9) AS sim,
         row_number() OVER (PARTITION BY a.i ORDER BY round(sum(a.w * b.w), 9) DESC, b.i) AS place
  FROM {source} a JOIN {source} b ON a.u = b.u AND a.i <> b.i GROUP BY a.i, b.i) WHERE place <= 40"""


def _item_vec(where: str) -> str:
    return f"""
SELECT product_id AS i, customer_unique_id AS u, rating / sqrt(sum(rating * rating) OVER (PARTITION BY product_id)) AS w
FROM {where} rating > 0"""


VIEWS["all_item_vec"] = _item_vec("rated WHERE")
VIEWS["train_item_vec"] = _item_vec("training WHERE split = 'train' AND")
VIEWS["all_item_knn"] = _item_knn("all_item_vec")
VIEWS["train_item_knn"] = _item_knn("train_item_vec")
SQL["item_neighbours"] = "SELECT i AS product_id, j AS neighbour_id, sim AS similarity, CAST(place AS INTEGER) AS place FROM all_item_knn"
SQL["item_knn_rating"] = f"""
WITH test AS (SELECT * FROM training WHERE split = 'test'),
est AS (
  SELECT t.customer_unique_id AS uid, t.product_id AS iid, sum(n.sim) AS weight, sum(n.sim * coalesce(m.rating, 0.0)) AS top
  FROM test t JOIN train_item_knn n ON t.product_id = n.i
  LEFT JOIN training m ON m.split = 'train' AND m.customer_unique_id = t.customer_unique_id AND m.product_id = n.j GROUP BY 1, 2),
um AS (SELECT customer_unique_id, {tenths_mean('rating')} AS m FROM training WHERE split = 'train' AND rating > 0 GROUP BY 1)
SELECT t.customer_unique_id AS uid, t.product_id AS iid, t.rating AS true_rating,
       {r("greatest(1.0, least(5.0, CASE WHEN e.weight > 1e-9 THEN e.top / (e.weight + 1e-9::DOUBLE) ELSE coalesce(um.m, (SELECT m FROM train_mean)) END))", 6)} AS pred_rating
FROM test t LEFT JOIN est e ON e.uid = t.customer_unique_id AND e.iid = t.product_id
LEFT JOIN um ON um.customer_unique_id = t.customer_unique_id"""
VIEWS["preds_item_knn"] = SQL["item_knn_rating"]
VIEWS["rows_item_knn"] = VIEWS["rank_rows"].replace("s_predictions", "preds_item_knn")
VIEWS["ranks_item_knn"] = _rank_table("rows_item_knn")
SQL["performance_report"] = f"""
WITH knn_means AS ({SQL["knn_metrics"]}),
models AS (
  SELECT 'user_knn' AS model, max(CASE WHEN metric = 'precision_5' THEN mean END) AS precision_5,
         max(CASE WHEN metric = 'recall_5' THEN mean END) AS recall_5, max(CASE WHEN metric = 'ndcg_5' THEN mean END) AS ndcg_5 FROM knn_means
  UNION ALL SELECT 'blend', {r('avg(precision)', 6)}, {r('avg(recall)', 6)}, {r('avg(ndcg)', 6)} FROM ranks_blend WHERE k = 5
  UNION ALL SELECT 'item_knn', {r('avg(precision)', 6)}, {r('avg(recall)', 6)}, {r('avg(ndcg)', 6)} FROM ranks_item_knn WHERE k = 5),
filled AS (
  SELECT model, coalesce(precision_5, 0.0::DOUBLE) AS precision_5, coalesce(recall_5, 0.0::DOUBLE) AS recall_5, coalesce(ndcg_5, 0.0::DOUBLE) AS ndcg_5
  FROM models)
SELECT *, CAST(row_number() OVER (ORDER BY ndcg_5 DESC, precision_5 DESC, model) AS INTEGER) AS place FROM filled
WHERE greatest(precision_5, recall_5, ndcg_5) > 0"""
SQL["model_report"] = "SELECT * FROM results"
SQL["best_model"] = """
SELECT (SELECT model FROM results ORDER BY ndcg DESC, model LIMIT 1) AS best_ranking_model, max(ndcg) AS best_ndcg,
       (SELECT model FROM results ORDER BY rmse, model LIMIT 1) AS best_rating_model, min(rmse) AS best_rmse FROM results"""
SQL["latest_model"] = """
SELECT event_type AS model, arg_max(event_id, (ts, event_id)) AS version, max(ts) AS start_time FROM events GROUP BY event_type"""
SQL["tfidf"] = f"SELECT product_id, term, tf, {r('weight', 6)} AS weight FROM product_terms"
SQL["tfidf_documents"] = f"SELECT doc_id, term, tf, {r('weight', 6)} AS weight FROM ({_tfidf('documents', 'doc_id', 'text')})"
VIEWS["term_vec"] = "SELECT product_id AS u, term AS c, weight / sqrt(sum(weight * weight) OVER (PARTITION BY product_id)) AS w FROM product_terms"
SQL["item_similarity"] = """
WITH items AS (SELECT DISTINCT u FROM term_vec),
ts AS (SELECT a.u, b.u AS v, round(sum(a.w * b.w), 9) AS sim FROM term_vec a JOIN term_vec b ON a.c = b.c GROUP BY a.u, b.u)
SELECT u AS product_id, CAST(place AS INTEGER) AS place, v AS neighbour_id, sim AS similarity FROM (
  SELECT x.u, y.u AS v, coalesce(s.sim, 0.0) AS sim, row_number() OVER (PARTITION BY x.u ORDER BY coalesce(s.sim, 0.0) DESC, y.u) AS place
  FROM items x JOIN items y ON x.u <> y.u LEFT JOIN ts s ON s.u = x.u AND s.v = y.u) WHERE place <= 10"""

# ---- streaming ----
SQL["stream_land"] = """
SELECT CAST(ts AS DATE) AS ingest_date, event_type, count(*) AS n_events, (SELECT count(*) FROM events) AS rows_audited
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY ALL"""
SQL["stream_ingest"] = "SELECT *, CAST(ts AS DATE) AS ingest_date FROM events"
SQL["stream_item_counts"] = """
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM events GROUP BY 1, 2"""
SQL["stream_dedupe"] = "SELECT event_id, user_id, event_type, value FROM events"


# ---- what is bought together, when and where ----
def _together(baskets: str, item: str, k: int) -> str:
    """Partners by a self-join; ``baskets`` gives (basket, item)."""
    return f"""
WITH b AS (SELECT DISTINCT basket, item FROM ({baskets}) WHERE basket IS NOT NULL AND item IS NOT NULL),
n AS (SELECT item, CAST(count(*) AS DOUBLE) AS n FROM b GROUP BY item),
t AS (SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM b),
p AS (
  SELECT x.item, y.item AS partner, count(*) AS n_both FROM b x JOIN b y ON x.basket = y.basket AND x.item <> y.item GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY n_both DESC, partner) AS INTEGER) AS rank FROM p)
SELECT k.item AS {item}, k.rank, k.partner, k.n_both, {r('n_both / t.n', 9)} AS support, {r('n_both / i.n', 9)} AS confidence,
       {r('n_both * t.n / (i.n * j.n)', 9)} AS lift
FROM k JOIN n i ON i.item = k.item JOIN n j ON j.item = k.partner, t WHERE k.rank <= {k}"""


SQL["item_cooccurrence"] = _together("SELECT order_id AS basket, product_id AS item FROM s_order_items", "product_id", 10)
SQL["category_cooccurrence"] = _together(
    "SELECT order_id AS basket, category_english AS item FROM s_order_items JOIN p_category USING (product_id)",
    "category_english",
    5,
)
SQL["repeat_gap"] = f"""
SELECT customer_unique_id, order_id, previous_order_id, {r('CAST(epoch_us(moment) - epoch_us(previous) AS DOUBLE) / 86400000000', 6)} AS gap_days
FROM (
  SELECT customer_unique_id, order_id, order_purchase_timestamp AS moment, lag(order_id) OVER w AS previous_order_id,
         lag(order_purchase_timestamp) OVER w AS previous
  FROM s_orders JOIN c_all_customers USING (customer_id)
  WINDOW w AS (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id))
WHERE previous_order_id IS NOT NULL"""
SQL["temporal_split"] = """
WITH l AS (
  SELECT DISTINCT customer_unique_id, product_id, order_id, order_purchase_timestamp FROM all_lines WHERE customer_unique_id IS NOT NULL),
c AS (SELECT order_purchase_timestamp AS moment, row_number() OVER (ORDER BY order_purchase_timestamp) AS p, count(*) OVER () AS n FROM l),
cut AS (SELECT min(moment) AS moment FROM c WHERE p >= greatest(1, ceil(n * 0.8::DOUBLE)))
SELECT l.*, CASE WHEN order_purchase_timestamp <= cut.moment THEN 'train' ELSE 'test' END AS split FROM l, cut"""
VIEWS["centroids"] = """
SELECT geolocation_zip_code_prefix AS zip, CAST(sum(CAST(geolocation_lat AS DECIMAL(12,6))) AS DOUBLE) / count(*) AS lat,
       CAST(sum(CAST(geolocation_lng AS DECIMAL(12,6))) AS DOUBLE) / count(*) AS lng
FROM s_points WHERE geolocation_lat BETWEEN -60 AND 10 AND geolocation_lng BETWEEN -80 AND -30 GROUP BY 1"""
_H = (
    "(pow(sin(radians(b.lat - a.lat) / 2), 2) "
    "+ cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))"
)
_KM = r(f"2 * 6371.0::DOUBLE * asin(sqrt(CASE WHEN {_H} > 1 THEN 1.0::DOUBLE ELSE {_H} END))", 3)
SQL["geo_distance"] = f"""
SELECT customer_state, distance_band, count(*) AS n_lines,
       {r('CAST(sum(CAST(round_even(km * 1000, 0) AS BIGINT)) AS DOUBLE) / count(*) / 1000', 3)} AS mean_km
FROM (
  SELECT customer_state, km, CASE WHEN km IS NULL THEN 'unknown' WHEN km < 100 THEN '0-100' WHEN km < 500 THEN '100-500'
         WHEN km < 1000 THEN '500-1000' WHEN km < 2500 THEN '1000-2500' WHEN km < 5000 THEN '2500-5000' ELSE '5000+' END AS distance_band
  FROM (
    SELECT customer_state, {_KM} AS km
    FROM s_order_items JOIN s_orders USING (order_id) JOIN c_all_customers USING (customer_id) JOIN s_sellers USING (seller_id)
    LEFT JOIN centroids a ON a.zip = customer_zip_code_prefix LEFT JOIN centroids b ON b.zip = seller_zip_code_prefix))
GROUP BY 1, 2"""
SQL["regional_pref"] = f"""
WITH c AS (
  SELECT customer_state, category_english, count(*) AS n_lines FROM all_lines
  WHERE customer_state IS NOT NULL AND category_english IS NOT NULL GROUP BY 1, 2),
s AS (
  SELECT *, CAST(n_lines AS DOUBLE) / sum(n_lines) OVER (PARTITION BY customer_state) AS share,
         sum(n_lines) OVER (PARTITION BY category_english) / (SELECT CAST(sum(n_lines) AS DOUBLE) FROM c) AS overall FROM c)
SELECT customer_state, category_english, n_lines,
       CAST(row_number() OVER (PARTITION BY customer_state ORDER BY n_lines DESC, category_english) AS INTEGER) AS rank,
       {r('share', 9)} AS region_share, {r('share / overall', 9)} AS preference FROM s"""


# Long form: one row per id and component.
def _start(ids: str, kind: str) -> str:
    return f"""
SELECT id, j, CAST(CAST('0x' || substr(md5(concat_ws('|', '{kind}', CAST(id AS VARCHAR), CAST(j AS VARCHAR))), 1, 8) AS BIGINT) AS DOUBLE)
       / 4294967296.0::DOUBLE * (SELECT scale FROM nmf_scale) AS v
FROM (SELECT DISTINCT {ids} AS id FROM training), (SELECT unnest(range(20)) AS j)"""


def _nmf_step(own: str, own_key: str, other: str, other_key: str) -> str:
    return f"""
WITH g AS (SELECT a.j, b.j AS k, sum(a.v * b.v) AS v FROM {other} a JOIN {other} b ON a.id = b.id GROUP BY a.j, b.j),
s AS (SELECT x.{own_key} AS id, f.j, sum(x.x * f.v) AS v FROM nmf_x x JOIN {other} f ON f.id = x.{other_key} GROUP BY ALL),
d AS (SELECT f.id, g.j, sum(g.v * f.v) AS v FROM {own} f JOIN g ON g.k = f.j GROUP BY ALL)
SELECT f.id, f.j, coalesce(s.v, 0) * f.v / greatest(d.v, 1e-12) AS v
FROM {own} f JOIN d ON d.id = f.id AND d.j = f.j LEFT JOIN s ON s.id = f.id AND s.j = f.j"""


VIEWS["nmf_x"] = """
SELECT customer_unique_id AS u, product_id AS i, CAST(rating AS DOUBLE) AS x FROM training WHERE split = 'train' AND rating > 0"""
VIEWS["nmf_scale"] = """
SELECT sqrt((SELECT sum(x) FROM nmf_x) / CAST(count(DISTINCT customer_unique_id) * count(DISTINCT product_id) AS DOUBLE) / 20) AS scale
FROM training"""
VIEWS["nmf_w0"] = _start("customer_unique_id", "user")
VIEWS["nmf_h0"] = _start("product_id", "item")
VIEWS["nmf_w1"] = _nmf_step("nmf_w0", "u", "nmf_h0", "i")
VIEWS["nmf_h1"] = _nmf_step("nmf_h0", "i", "nmf_w1", "u")
SQL["nmf_update"] = f"""
SELECT 'user' AS kind, id, CAST(j AS INTEGER) AS component, {r('v', 9)} AS value FROM nmf_w1
UNION ALL SELECT 'item', id, CAST(j AS INTEGER), {r('v', 9)} FROM nmf_h1"""


# Columns and types of the raw files, with three differences on purpose.
_LONG = "doc_id vec_id event_id user_id page_id item_id conv_id turn n_chars".split()
_NUMBERS = "value l_quantity l_extendedprice l_discount l_tax s_acctbal c_acctbal o_totalprice p_retailprice".split()
_SHORT = "quality toxic label l_linenumber p_size n_nationkey n_regionkey r_regionkey c_nationkey s_nationkey".split()


def _file_type(column: str) -> str:
    if column in _LONG or (column.endswith("key") and column not in _SHORT):
        return "bigint"
    if column in _SHORT:
        return "int"
    if column in _NUMBERS:
        return "double"
    return {"ts": "timestamp_ntz", "o_orderdate": "timestamp_ntz", "l_shipdate": "timestamp_ntz", "embedding": "array<float>"}.get(column, "string")


def _file_check(t: str) -> str:
    want = {c: _file_type(c) for c in RAW[t].split(",")}
    if t == "customer":
        want["c_email"] = "string"
    if t == "lineitem":
        del want["l_tax"]
    if t == "documents":
        want["n_chars"] = "int"
    values = ", ".join(f"('{c}', '{k}')" for c, k in want.items())
    return f"""
SELECT '{t}' AS table_name, '{t}.parquet' AS file_name, check_name, severity, violations, detail, (SELECT count(*) FROM {t}) AS n_rows
FROM (
  WITH want(c, k) AS (VALUES {values}),
  have AS (
    SELECT column_name AS c, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
           WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(column_type) END AS k FROM (DESCRIBE {t})),
  found AS (
    SELECT 'schema_missing_columns' AS check_name, 'ERROR' AS severity, count(*) AS violations, string_agg(c, ', ' ORDER BY c) AS detail
    FROM want WHERE c NOT IN (SELECT c FROM have)
    UNION ALL SELECT 'schema_extra_columns', 'WARNING', count(*), string_agg(c, ', ' ORDER BY c) FROM have WHERE c NOT IN (SELECT c FROM want)
    UNION ALL SELECT 'schema_types', 'ERROR', count(*), string_agg(want.c || ': ' || have.k || ' instead of ' || want.k, ', ' ORDER BY want.c)
    FROM want JOIN have ON want.c = have.c WHERE want.k <> have.k)
  SELECT * FROM found WHERE violations > 0
  UNION ALL SELECT 'schema_match', 'PASS', 0, '' WHERE (SELECT sum(violations) FROM found) = 0)"""


SQL["column_profile"] = UNION.join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{_file_type(c)}' AS dtype, count({c}) AS non_null, "
    f"count(*) - count({c}) AS null_count FROM {t}"
    for t, columns in RAW.items()
    for c in columns.split(",")
)
SQL["payload_shapes"] = """
SELECT shape, l_partkey, n AS "ship.n", mode AS "ship.l_returnflag", modes, value, count(*) AS n_rows FROM (
  SELECT 'objects' AS shape, l_partkey, CAST(l_quantity AS BIGINT) AS n, l_returnflag AS mode, NULL AS modes, NULL AS value
  FROM lineitem WHERE l_orderkey % 4 = 0
  UNION ALL SELECT 'object', x.p, x.n, x.m, NULL, NULL FROM (
    SELECT max({'p': l_partkey, 'n': CAST(l_quantity AS BIGINT), 'm': l_returnflag}) AS x FROM lineitem WHERE l_orderkey % 4 = 1 GROUP BY l_orderkey)
  UNION ALL SELECT 'list', NULL, NULL, NULL, l_returnflag, NULL FROM lineitem WHERE l_orderkey % 4 = 2
  UNION ALL SELECT 'scalar', NULL, NULL, NULL, NULL, CAST(count(*) AS VARCHAR) FROM lineitem WHERE l_orderkey % 4 = 3 GROUP BY l_orderkey)
GROUP BY ALL"""
SQL["dq_schema"] = UNION.join(_file_check(t) for t in RAW)


def _needed(sql: str) -> list[str]:
    """Named subqueries a statement mentions, each after those it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def statements() -> dict[str, str]:
    out = {}
    for key, sql in SQL.items():
        views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in _needed(sql))
        out[key] = f"WITH {views}\nSELECT * FROM (\n{sql.strip()}\n) AS answer" if views else sql.strip()
    return out
