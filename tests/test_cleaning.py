import pytest
from pyspark.sql import functions as F

from merchweave.operators import cleaning, eda, features, transactions


def test_keep_first_takes_first_by_order(spark, rows):
    df = spark.createDataFrame([("u", 3, "c"), ("u", 1, "a"), ("v", 2, None), ("u", 2, "b")], "k string, o int, x string")
    assert rows(cleaning.keep_first(df, ["k"], ["o"])) == [("u", 1, "a"), ("v", 2, None)]


def test_clean_customers(spark, rows):
    df = spark.createDataFrame(
        [(1, "u", "z1", " Rio ", "rj"), (2, "u", "z2", "SP", "sp"), (3, "v", "z3", "X", " mg ")],
        "customer_id int, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    assert rows(cleaning.clean_customers(df)) == [(1, "u", "z1", "rio", "RJ"), (3, "v", "z3", "x", "MG")]


def test_clean_products_translates_and_imputes(spark):
    df = spark.createDataFrame(
        [(1, "p", 10.0), (2, None, None), (3, "q", 20.0), (4, "p", 40.0)],
        "product_id int, product_category_name string, product_weight_g double",
    )
    names = spark.createDataFrame([("p", "pets")], "product_category_name string, product_category_name_english string")
    got = {r.product_id: r for r in cleaning.clean_products(df, names).collect()}
    assert {k: r.category_english for k, r in got.items()} == {1: "pets", 2: "unknown", 3: "unknown", 4: "pets"}
    assert got[2].product_category_name == "unknown" and got[3].product_category_name == "q"
    assert got[2].product_weight_g == 20.0


def test_clean_orders_parses_and_filters(spark):
    df = spark.createDataFrame(
        [(1, "delivered", "2018-01-02 03:04:05"), (2, "shipped", "bad"), (3, "canceled", None)],
        "order_id int, order_status string, order_purchase_timestamp string",
    )
    got = cleaning.clean_orders(df)
    assert got.count() == 3
    assert [r.order_id for r in got.filter("order_purchase_timestamp is null").orderBy("order_id").collect()] == [2, 3]
    assert [r.order_id for r in cleaning.clean_orders(df, ["delivered"]).collect()] == [1]


def test_payments_first_type_skips_null(spark):
    df = spark.createDataFrame(
        [("o", 1, None, 1.10), ("o", 2, "boleto", 2.20), ("o", 3, "voucher", 3.30), (None, 1, "x", 9.0)],
        "order_id string, payment_sequential int, payment_type string, payment_value double",
    )
    assert [tuple(r) for r in cleaning.payments_per_order(df).collect()] == [("o", 6.6, 3, "boleto")]


def test_geolocation_dedupes_before_the_box(spark):
    df = spark.createDataFrame(
        [(1, "a", 50.0, -40.0), (2, "a", -10.0, -40.0), (3, "b", -60.0, -80.0), (4, "c", 0.0, 0.0)],
        "row_id int, geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double",
    )
    assert [r.geolocation_zip_code_prefix for r in cleaning.clean_geolocation(df).collect()] == ["b"]


@pytest.fixture
def shop(spark):
    stamp = F.col("t").cast("timestamp_ntz")
    orders = spark.createDataFrame(
        [("o1", "c1", "2018-01-01 23:50:00"), ("o2", "c2", "2018-03-02 00:10:00"), ("o3", "c3", "2018-03-05 12:00:00")],
        "order_id string, customer_id string, t string",
    ).select("order_id", "customer_id", stamp.alias("order_purchase_timestamp"))
    items = spark.createDataFrame(
        [("o1", 1, "p1", 10.0, 1.0), ("o1", 2, "p2", 20.0, 2.0), ("o2", 1, "p1", 30.0, 3.0), ("o3", 1, "p3", 5.0, 1.0)],
        "order_id string, order_item_id int, product_id string, price double, freight_value double",
    )
    reviews = spark.createDataFrame(
        [("o1", 5, 1), ("o1", 2, 0), ("o2", 4, 1)], "order_id string, review_score int, has_review_text int"
    )
    payments = spark.createDataFrame(
        [("o1", 33.0, 1, "boleto"), ("o3", 6.0, 1, "voucher")],
        "order_id string, total_payment double, num_payments int, primary_payment_type string",
    )
    customers = spark.createDataFrame(
        [("c1", "u1", "RJ"), ("c3", "u2", "SP")], "customer_id string, customer_unique_id string, customer_state string"
    )
    products = spark.createDataFrame(
        [("p1", "toys", 1.0, 1.0, 2.0, 3.0, 4.0), ("p2", "auto", 1.0, 1.0, 1.0, 1.0, 1.0), ("p3", "toys", 2.0, 2.0, 2.0, 2.0, 2.0)],
        "product_id string, category_english string, product_weight_g double, product_photos_qty double, "
        "product_length_cm double, product_height_cm double, product_width_cm double",
    )
    return transactions.build_transactions(orders, items, reviews, payments, customers, products), products


def test_transactions_fan_out_and_defaults(shop):
    txn, _ = shop
    got = txn.orderBy("order_id", "order_item_id", "review_score").collect()
    assert len(got) == 6  # two reviews repeat both lines of the first order
    assert [r.review_score for r in got] == [2, 5, 2, 5, 4, 0]
    assert [r.customer_unique_id for r in got] == ["u1"] * 4 + [None, "u2"]
    assert (got[0].purchase_hour, got[0].purchase_dayofweek) == (23, 0)


def test_user_features(shop):
    users = {r.customer_unique_id: r for r in features.build_user_features(shop[0]).collect()}
    assert set(users) == {"u1", "u2"}
    u1 = users["u1"]
    assert (u1.purchase_count, u1.total_spending, u1.avg_order_value) == (1, 60.0, 15.0)
    assert (u1.avg_rating_given, u1.review_count, u1.distinct_products, u1.distinct_categories) == (3.5, 4, 2, 2)
    assert u1.preferred_category == "auto"  # a tie goes to the smaller name
    assert u1.recency_days == 62 and users["u2"].recency_days == 0
    assert users["u2"].avg_rating_given is None and users["u2"].review_count == 0
    assert (u1.spending_normalized, users["u2"].spending_normalized) == (1.0, 0.0)


def test_item_features(shop):
    txn, products = shop
    items = {r.product_id: r for r in features.build_item_features(txn, products, ["toys"]).collect()}
    p1 = items["p1"]
    assert (p1.total_sold, p1.distinct_buyers, p1.total_revenue, p1.product_volume_cm3) == (3, 1, 50.0, 24.0)
    assert (p1.popularity_rank, items["p2"].popularity_rank, items["p3"].popularity_rank) == (1, 2, 3)
    assert p1.price_percentile == round(2 / 3, 4)
    assert (p1.is_cat_toys, p1.is_cat_other, items["p2"].is_cat_toys, items["p2"].is_cat_other) == (1, 0, 0, 1)
    assert items["p3"].rating_normalized == 0.0 and items["p3"].avg_rating_received is None


def test_interactions_and_affinity(shop):
    pairs = transactions.build_interactions(shop[0])
    got = {(r.customer_unique_id, r.product_id): r for r in pairs.collect()}
    assert len(got) == 3 and got[("u1", "p1")].rating == 3.5 and got[("u2", "p3")].rating == 0.0
    scored = {(r.customer_unique_id, r.product_id): r for r in features.build_interaction_features(pairs).collect()}
    assert scored[("u1", "p1")].user_item_affinity == 0.6  # equal purchase counts scale to 0
    stats = transactions.matrix_stats(pairs).first()
    assert (stats.n_users, stats.n_items, stats.n_interactions, stats.sparsity_pct) == (2, 3, 3, 50.0)


def test_monthly_volume_shows_empty_months(shop):
    got = [(str(r.month_end), r.n_lines) for r in eda.monthly_volume(shop[0]).orderBy("month_end").collect()]
    assert got == [("2018-01-31", 4), ("2018-02-28", 0), ("2018-03-31", 2)]


def test_price_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (99.0,), (600.0,), (500.0,)], "price double")
    got = {r.bin: r.n_lines for r in eda.price_histogram(df, 500.0, 50).collect()}
    assert len(got) == 50 and sum(got.values()) == 5
    assert (got[0], got[1], got[9], got[49]) == (1, 1, 1, 2)
    flat = {r.bin: r.n_lines for r in eda.price_histogram(spark.createDataFrame([(5.0,), (5.0,)], "price double")).collect()}
    assert flat[25] == 2 and sum(flat.values()) == 2


def test_one_hot_other_includes_unknown_and_null(spark):
    df = spark.createDataFrame([("toys",), ("unknown",), (None,)], "category_english string")
    assert [r.is_cat_other for r in features.one_hot(df, ["toys"]).collect()] == [0, 1, 1]
