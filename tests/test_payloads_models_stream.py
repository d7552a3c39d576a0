"""Payloads of mixed shapes, published model versions, streamed batches in the raw layer, column profiles."""

import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merchweave.operators import metrics, quality
from merchweave.sources import files, lake, models
from merchweave.streaming import events


def test_payloads_of_all_shapes_in_one_folder(spark, tmp_path):
    bodies = {
        "a": [{"id": 1, "r": {"rate": 3.5}}, {"id": 2, "extra": "x"}, 7],
        "b": {"id": 3, "r": {"rate": 1, "n": {"c": True}}},
        "c": ["toys", "auto", None],
        "d": "hello",
        "e": 7,
        "f": [],
        "g": None,
    }
    for name, body in bodies.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "h.json").write_text("no json {")
    rows = files.payload_rows(spark, str(tmp_path))
    got = files.payload_table(rows, "things").withColumn("f", F.element_at(F.split("source_file", "/"), -1)).collect()
    assert {"id", "r.rate", "extra", "r.n.c", "things", "value"} <= set(got[0].asDict())
    by = {(r.f[0], r.position): r.asDict() for r in got}
    assert by["a", 0]["id"] == 1 and float(by["a", 0]["r.rate"]) == 3.5 and by["a", 1]["extra"] == "x"
    assert by["a", 2]["id"] is None and by["a", 2]["shape"] == "objects" and by["a", 2]["things"] == "7"
    assert by["b", 0]["r.n.c"] is True and by["b", 0]["shape"] == "object"
    assert [by["c", i]["things"] for i in range(3)] == ["toys", "auto", None]
    assert (by["d", 0]["value"], by["e", 0]["value"], by["h", 0]["value"]) == ("hello", "7", "no json {")
    assert not any(k[0] == "f" for k in by) and by["g", 0]["value"] is None
    assert len(by) == len(got) == 11


def test_payload_table_of_one_shape(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1, 2]")
    table = files.payload_table(files.payload_rows(spark, str(tmp_path)), "numbers")
    assert table.columns == ["source_file", "shape", "position", "numbers"]
    assert sorted(r.numbers for r in table.collect()) == ["1", "2"]


def test_published_versions(spark, tmp_path):
    root = str(tmp_path)
    grid = spark.range(5)
    models.publish(spark, root, "knn", "b", {"grid": grid.limit(2)}, {"ndcg": 0.5}, datetime(2024, 1, 2))
    models.publish(spark, root, "knn", "a", {"grid": grid}, at=datetime(2024, 1, 1))
    models.publish(spark, root, "mean", "z", {"items": grid}, at=datetime(2024, 1, 1))
    assert {r.model: r.version for r in models.latest(spark, root).collect()} == {"knn": "b", "mean": "z"}
    latest = models.load(spark, root, "knn", "grid")
    assert latest.count() == 2 and latest.first().model_version == "b"
    assert models.load(spark, root, "knn", "grid", "a").count() == 5
    # Tables without a version row are a try that failed, and are not seen.
    grid.write.parquet(f"{root}/knn/version=c/grid")
    assert models.load(spark, root, "knn", "grid").first().model_version == "b"
    models.publish(spark, root, "knn", "c", {"grid": grid.limit(1)}, at=datetime(2024, 1, 3))
    assert models.load(spark, root, "knn", "grid").count() == 1
    for arguments in (("other", "grid"), ("knn", "none"), ("knn", "grid", "zz")):
        with pytest.raises(ValueError):
            models.load(spark, root, *arguments)
    with pytest.raises(ValueError):
        models.publish(spark, root, "a/b", "1", {})


def test_a_replayed_batch_replaces_its_data_and_audit(spark, tmp_path):
    source, root, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")
    rows = [(i, datetime(2024, 1, 1 + i % 3), i, "click", 1.0, None) for i in range(30)]
    spark.createDataFrame(rows, events.EVENTS).coalesce(1).write.parquet(str(source))
    one = next(source.glob("part*.parquet"))
    one.rename(source / "events1.parquet")
    land = lambda: events.land_stream(events.event_stream(spark, str(source)), root, "events", state)
    land()
    more = spark.createDataFrame([(99, datetime(2024, 1, 3), 1, "view", 2.0, None)], events.EVENTS)
    more.coalesce(1).write.parquet(str(tmp_path / "more"))
    shutil.copy(next((tmp_path / "more").glob("part*.parquet")), source / "events2.parquet")
    land()

    def state_of():
        landed = lake.read_landed(spark, root, "events", "stream")
        audit = events.read_stream_audit(spark, root, "events")
        return landed.count(), files.latest_partition(landed).count(), sorted(
            (r.batch_id, r.row_count, r.checksum) for r in audit.collect()
        )

    before = state_of()
    assert before[:2] == (31, 11) and [x[:2] for x in before[2]] == [(0, 30), (1, 1)]
    # Without the commit of the last batch it runs again.
    for f in (tmp_path / "state" / "commits").glob("*1*"):
        f.unlink()
    land()
    assert state_of() == before
    plan = files.latest_partition(lake.read_landed(spark, root, "events", "stream"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (None, None, None)], "id int, `a b` string, v array<double>")
    got = [tuple(r) for r in quality.profile_columns(df, "t").collect()]
    assert got == [("t", "id", "int", 1, 1), ("t", "a b", "string", 0, 2), ("t", "v", "array<double>", 1, 1)]


def test_catalogue_of_a_root_with_and_without_scheme(spark, tmp_path):
    root = str(tmp_path / "raw")
    lake.land(spark.range(3), root, "things", ingest_date="2024-01-01")
    seen = []
    for name in (root, f"file:{root}", f"file://{root}/"):
        rows = lake.lake_catalog(spark, name).filter(F.col("file_name").endswith(".parquet")).collect()
        seen.append({(r.source_name, r.data_type, r.partition_date, r.relative_path) for r in rows})
    assert seen[0] == seen[1] == seen[2] and {x[:3] for x in seen[0]} == {("things", "table", "2024-01-01")}


def test_performance_report(spark):
    rows = [("a", "ndcg_5", 0.4), ("a", "precision_5", 0.1), ("b", "ndcg_5", 0.4), ("b", "precision_5", 0.2)]
    rows += [("c", "recall_5", 0.9), ("d", "ndcg_5", 0.0), ("e", "map_5", 0.7)]
    got = metrics.performance_report(spark.createDataFrame(rows, "model string, metric string, mean double"))
    assert sorted((r.place, r.model, r.recall_5) for r in got.collect()) == [(1, "b", 0.0), (2, "a", 0.0), (3, "c", 0.9)]


def test_means_over_users(spark):
    hits = spark.createDataFrame([("a", 0.2, 0.5), ("b", 0.6, 1.0)], "customer_unique_id string, precision double, recall double")
    ndcg = spark.createDataFrame([("a", 0.25), ("b", 0.5)], "customer_unique_id string, ndcg double")
    got = {r.metric: (r.n_users, r["mean"]) for r in metrics.neighbour_means(hits, ndcg).collect()}
    assert got == {"precision_5": (2, 0.4), "recall_5": (2, 0.75), "ndcg_5": (2, 0.375)}
    none = {r.metric: (r.n_users, r["mean"]) for r in metrics.neighbour_means(hits.limit(0), ndcg.limit(0)).collect()}
    assert set(none.values()) == {(0, 0.0)}
