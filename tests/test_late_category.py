"""Order lines meet their products only where the category is used, and pairs of products are compared once."""

from merchweave.operators import corating, features
from merchweave.plans.pipeline import Shop
from tests.test_shuffles import shop


def test_interactions_do_not_read_products(spark, rows, tmp_path):
    made = shop(spark, tmp_path)
    assert not any("part.parquet" in f for f in made.interactions.inputFiles())
    # A product listed twice repeats its lines, but neither mean score nor orders change.
    assert rows(made.interactions) == rows(features_interactions(made))


def features_interactions(made):
    from merchweave.operators import transactions

    twice = made.product_categories.unionByName(made.product_categories.limit(3))
    lines = transactions.purchase_lines(made.orders, made.role("order_items"), made.reviews, made.customers, twice)
    return transactions.build_interactions(lines)


def test_written_lines_of_the_feature_tables_have_no_category(spark, tmp_path, monkeypatch):
    shop(spark, tmp_path)
    seen = {}
    import merchweave.plans.pipeline as pipeline

    plain = pipeline.staged
    monkeypatch.setattr(pipeline, "staged", lambda df, name, **options: seen.setdefault(name, plain(df, name, **options)))
    tables = Shop(spark, str(tmp_path)).feature_tables
    assert set(seen["lines"].columns) == set(features.LINE_COLUMNS) and "category_english" not in seen["lines"].columns
    assert tables["user_features"].filter("distinct_categories = 0").count() == 0


def test_pairs_of_products_are_compared_once(spark, monkeypatch):
    seen = []
    plain = corating._similarities

    def watched(pairs, entries):
        seen.extend(tuple(r)[:2] for r in pairs.collect())
        return plain(pairs, entries)

    monkeypatch.setattr(corating, "_similarities", watched)
    rows = [(u, p, float((u * p) % 4 + 1)) for u in range(12) for p in range(9) if (u + p) % 3 or u % 5 == p % 5]
    ratings = spark.createDataFrame(rows, "customer_unique_id long, product_id long, rating double")
    everything = {tuple(r) for r in corating.item_neighbours(ratings, k=3).collect()}
    assert seen and len({frozenset(x) for x in seen}) == len(seen)
    some = spark.createDataFrame([(2,), (7,)], "product_id long")
    assert {tuple(r) for r in corating.item_neighbours(ratings, some, k=3).collect()} == {r for r in everything if r[0] in (2, 7)}
