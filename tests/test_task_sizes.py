"""What one task or one Python worker gets at a time does not grow with the tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from merchweave.llm import simhash
from merchweave.operators import neighbours, recommend
from tests.test_neighbours import answers, as_frame, brute, random_vectors
from tests.test_recommend import random_training


def test_few_pairs_of_blocks_travel_to_python_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 2)
    made = neighbours.best_of_blocks

    def watched(*given):
        kernel = made(*given)

        def watch(batches):
            for batch in batches:
                if batch.num_rows > 8:
                    raise ValueError(f"{batch.num_rows} pairs of blocks at once")
                yield batch

        return lambda batches: kernel(watch(batches))

    monkeypatch.setattr(neighbours, "best_of_blocks", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    vectors = random_vectors(7, 120, 6, 0.1)
    profiles = neighbours.build_profiles(as_frame(spark, vectors), 5)
    lists = answers(neighbours.nearest(neighbours.profile_queries(profiles), profiles))
    want = brute(vectors, vectors, 5)
    assert all(lists[q] == want[q] for q in lists)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_targets_of_users_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(recommend, "TARGETS", 20, raising=False)
    seen = []
    plain = recommend.unseen_items

    def watched(targets, *rest):
        seen.append(targets.select(F.spark_partition_id().alias("p")).distinct().count())
        return plain(targets, *rest)

    monkeypatch.setattr(recommend, "unseen_items", watched)
    columns = "customer_unique_id bigint, product_id bigint, category_english string, rating double"
    training = spark.createDataFrame(random_training(3), columns)
    assert recommend.recommend_users(training, recommend.train_grid(training, training), 4).count()
    assert seen[0] > 4  # shuffle partitions of the session


def test_fingerprints_are_dealt_to_more_tasks_before_their_signatures(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DEALT", 20, raising=False)
    most = []
    plain = simhash.signatures

    def watched(distinct):
        sizes = distinct.groupBy(F.spark_partition_id().alias("p")).count()
        most.append(sizes.agg(F.max("count")).first()[0])
        return plain(distinct)

    monkeypatch.setattr(simhash, "signatures", watched)
    found = simhash.links(spark.range(400).select(F.col("id").alias("fp")).coalesce(1))
    assert most[0] < 60
    pairs = {tuple(r) for r in found.collect()}
    assert all(bin(a ^ b).count("1") <= 4 for a, b in pairs) and pairs


def test_signatures_and_points_are_not_broadcast(spark, monkeypatch):
    plans = []
    plain = simhash.staged

    def watched(df, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name, **options)

    monkeypatch.setattr(simhash, "staged", watched)
    # So few that Spark takes every table for a small one, with single bits apart and some signatures crowded.
    distinct = simhash.staged(spark.range(300).select(F.col("id").alias("fp")), "few-fingerprints")
    found = simhash.links(distinct)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and all("BroadcastExchange" not in p for p in plans)
    root = {r.node: r.root for r in simhash.components(found).collect()}
    assert set(root) == set(range(300)) and set(root.values()) == {0}


def test_the_pipeline_stage_links_its_documents_without_broadcasts(spark, monkeypatch):
    plans = {}
    plain = simhash.staged

    def watched(df, name, **options):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name, **options)

    monkeypatch.setattr(simhash, "staged", watched)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    words = [f"w{i}" for i in range(200)]
    texts = [(1, " ".join(words)), (2, " ".join(reversed(words))), (3, " ".join(words)), (4, None), (5, ""), (6, " ".join(words[:50]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    try:
        kept = corpus_pipeline.without_near_copies(spark, docs, "")
        assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]
    finally:
        spark.conf.set(key, before)
    # The signatures, then the first links, which come from both ways.
    assert "Generate explode" in plans["signatures"]
    assert all("BroadcastExchange" not in plans[name] for name in ("signatures", "edges"))
