"""The neighbour search compares directions once and gives out k candidates per query."""

import pytest
from pyspark.sql import functions as F

from merchweave.operators import neighbours, recommend
from tests.test_neighbours import answers, as_frame, brute, random_vectors


def test_owners_of_one_direction_share_a_profile(spark):
    vectors = {i: {"a": float(i % 5 + 1), "b": float(i % 5 + 1)} for i in range(20)}
    vectors |= {20: {"a": 2.0, "b": 4.0}, 21: {"a": 1.0, "b": 2.0}, 22: {"a": 1.0, "b": 2.1}}
    profiles = neighbours.build_profiles(as_frame(spark, vectors), 30)
    assert sorted(r.profile_id for r in profiles.table.collect()) == [0, 20, 22]
    owners = {r.owner: r.profile_id for r in neighbours.profile_of_owner(profiles).collect()}
    lists, want = answers(neighbours.nearest(neighbours.profile_queries(profiles), profiles)), brute(vectors, vectors, 30)
    assert all(lists[owners[u]] == want[u] for u in vectors)


@pytest.mark.parametrize("ids", ["bigint", "string"])
def test_a_query_gets_k_candidates_from_all_blocks_together(spark, monkeypatch, ids):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 6)
    monkeypatch.setattr(neighbours, "ROWS_PER_TASK", 16)
    monkeypatch.setattr("merchweave.functions.cosine.GATHERED", 10, raising=False)
    most = []
    plain = neighbours.staged

    def watched(df, name, **options):
        out = plain(df, name, **options)
        if name == "nearest-found":
            most.append(out.groupBy("query_id").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(neighbours, "staged", watched)
    vectors = random_vectors(11, 200, 8, 0.1)
    if ids == "string":
        vectors = {f"u{'x' * (i % 7)}{i}": v for i, v in vectors.items()}
    profiles = neighbours.build_profiles(as_frame(spark, vectors, ids), 5)
    lists, want = answers(neighbours.nearest(neighbours.profile_queries(profiles), profiles)), brute(vectors, vectors, 5)
    assert most and most[0] <= 5
    assert all(lists[q] == want[q] for q in lists)


def test_repeated_unknown_and_nameless_requests(spark):
    grid = as_frame(spark, {1: {"a": 5.0, "b": 3.0}, 2: {"a": 1.0}, 3: {"b": 2.0, "c": 2.0}})
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "x"), (3, None), (4, "x"), (4, "b"), (None, "x")]
    requests = spark.createDataFrame(rows, "request_id bigint, category string")
    got = recommend.category_targets(requests, grid, 2).collect()
    kinds = {(r.request_id, r.recommendation_type) for r in got}
    assert kinds == {(1, "KNN"), (2, "KNN"), (3, "rank_based"), (4, "KNN"), (None, "rank_based")}
    assert len(got) == 10
    same = [{(r.category_english, r.share_pct) for r in got if r.request_id == i} for i in (1, 2)]
    assert same[0] == same[1]
