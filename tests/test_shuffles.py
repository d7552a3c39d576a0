"""Order lines are shuffled and computed no more often than they have to be."""

import re
from datetime import datetime

from merchweave.operators import features, timing, transactions
from merchweave.plans.pipeline import Shop
from merchweave.sources import roles

DAY = datetime(2020, 1, 1)


def frames(spark):
    orders = spark.createDataFrame(
        [(1, 1, DAY), (2, 2, DAY), (3, 3, None), (3, 3, DAY), (None, None, DAY)],
        "order_id long, customer_id long, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(1, 1, 7, 5.0), (1, 2, 8, 6.0), (2, 1, 9, 1.0), (3, 1, None, 2.0), (None, 1, 7, 3.0)],
        "order_id long, order_item_id int, product_id long, price double",
    )
    reviews = spark.createDataFrame([(1, 4, 1), (1, 2, 0), (3, 5, 1)], "order_id long, review_score int, has_review_text int")
    people = spark.createDataFrame([(1, 10, "A"), (3, 11, "B"), (3, 12, None)], "customer_id long, customer_unique_id long, customer_state string")
    goods = spark.createDataFrame([(7, "x"), (8, "y"), (8, "z")], "product_id long, category_english string")
    return orders, items, reviews, people, goods


def test_lines_are_not_shuffled_by_customer(spark, rows):
    orders, items, reviews, people, goods = frames(spark)
    lines = transactions.purchase_lines(orders, items, reviews, people, goods)
    # The joins one after the other, as the lines are defined.
    plain = transactions.with_reviews(transactions.orders_with_items(orders, items), reviews)
    plain = plain.join(people, "customer_id", "left").join(goods, "product_id", "left")
    assert lines.columns == plain.columns
    assert rows(lines) == rows(plain) and lines.count() == 11
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lines._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((\w+)#", plan)
    by_customer = [columns for columns, key in exchanges if key == "customer_id"]
    assert by_customer and not any("price" in c for c in by_customer)


def shop(spark, folder):
    data = {
        "region": [(0, "AFRICA")],
        "nation": [(0, "ALGERIA", 0)],
        "customer": [(c, f"c{c}", 0, 0.0, "m") for c in range(4)],
        "part": [(p, f"p{p}", f"Brand#{p % 3}", "t", p, 1.0) for p in range(1, 9)],
        "orders": [(o, o % 4, "F", 1.0, DAY, "1") for o in range(1, 30)],
        "lineitem": [(o, o % 8 + 1, 1, n, 2.0, 10.0 * o, 0.0, 0.0, "N", "F", DAY) for o in range(1, 30) for n in (1, 2)],
    }
    for name, values in data.items():
        spark.createDataFrame(values, roles.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return Shop(spark, str(folder))


def test_feature_tables_join_the_lines_once(spark, rows, tmp_path, monkeypatch):
    seen = []

    def recording(function):
        def call(lines, *rest):
            seen.append(lines)
            return function(lines, *rest)

        return call

    made = shop(spark, tmp_path)
    plain = [rows(t) for t in (made.user_features, made.item_features, made.interaction_features)]
    for module, name in ((features, "user_aggregates"), (features, "item_aggregates"), (transactions, "build_interactions")):
        monkeypatch.setattr(module, name, recording(getattr(module, name)))
    tables = Shop(spark, str(tmp_path)).feature_tables
    assert [rows(t) for t in tables.values()] == plain
    assert len(seen) == 3
    assert not any("lineitem" in f for lines in seen for f in lines.inputFiles())


def test_rows_of_the_temporal_split_are_computed_once(spark, tmp_path):
    times = [(i, datetime(2020, 1, 1 + i)) for i in range(10)] + [(10, None)]
    spark.createDataFrame(times, "id long, t timestamp_ntz").write.parquet(f"{tmp_path}/source")
    found = timing.temporal_split(spark.read.parquet(f"{tmp_path}/source"), "t", 0.8)
    assert not any("/source/" in f for f in found.inputFiles())
    assert sorted((r.id, r.split) for r in found.collect()) == [
        *[(i, "train") for i in range(8)], (8, "test"), (9, "test"), (10, None)
    ]
