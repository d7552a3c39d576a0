"""Lines of a user that stand in one task are counted there."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from merchweave.operators import features, transactions

SCHEMA = (
    "order_id long, product_id long, customer_unique_id long, customer_state string, order_purchase_timestamp timestamp_ntz, "
    "price decimal(18,2), freight_value decimal(18,2), review_score int, category_english string"
)


def lines(spark, n=400):
    rng = random.Random(6)
    one = lambda *values: rng.choice([*values, None])
    rows = [
        (one(*range(30)), one(*range(9)), one(*range(7)), one("A", "B"), one(datetime(2020, 1, 1), datetime(2021, 1, 1)),
         None, None, one(0, 3, 5), one("x", "y", "z"))
        for _ in range(n)
    ]
    rows += [(1, 1, 90, None, None, None, None, None, None), (None, None, 91, None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.hash("order_id", "product_id").cast("decimal(18,2)") for c in ("price", "freight_value")})
    return frame.unionAll(frame.limit(50)).localCheckpoint()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_first_lines_are_the_distinct_values_without_a_shuffle(spark, rows):
    every = lines(spark).filter("customer_unique_id is not null")
    placed = every.repartition("customer_unique_id")
    found = features.user_aggregates(placed, True)
    assert rows(found) == rows(features.user_aggregates(every)) and found.count() == 9
    assert plan(found).count("Exchange hashpartitioning") == 1 and "Expand" not in plan(found)


def test_lines_of_a_pair_meet_once(spark, rows):
    every = lines(spark)
    pairs = transactions.build_interactions(every.repartition("customer_unique_id", "product_id"))
    assert rows(pairs) == rows(transactions.build_interactions(every))
    assert plan(pairs).count("Exchange hashpartitioning") == 1
