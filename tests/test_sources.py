import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merchweave.operators import features, text
from merchweave.session import shared_dir, staged
from merchweave.sources import files, lake, roles, store
from merchweave.streaming import events


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('id,text,zip\n1,"two\nlines, ""quoted""",01234\n2,,99\n')
    got = files.scan_csv(spark, str(path), "id int, text string, zip string", multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 'two\nlines, "quoted"', "01234"), (2, None, "99")]


@pytest.mark.parametrize(
    "payload, columns, n",
    [
        ([{"id": 1, "r": {"rate": 3.5, "in": {"c": 2}}}, {"id": 2, "r": {"rate": 1.0, "in": {"c": 5}}}], ["id", "r.in.c", "r.rate"], 2),
        ({"id": 1, "a": {"b": "x"}}, ["a.b", "id"], 1),
        (["toys", "auto", "toys"], ["things"], 3),
        ("hello", ["value"], 1),
        (7, ["value"], 1),
    ],
)
def test_payload_shapes(spark, tmp_path, payload, columns, n):
    path = tmp_path / "payload.json"
    path.write_text(json.dumps(payload, indent=2))
    df = files.read_payload(spark, str(path), "things")
    assert sorted(df.columns) == columns and df.count() == n
    if payload == "hello":
        assert df.first().value == "hello"


def test_land_replaces_same_day_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    one = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string")
    two = spark.createDataFrame([(3, "c")], "id int, x string")
    first = lake.land(one, root, "things", ingest_date="2024-01-01")
    lake.land(two, root, "things", ingest_date="2024-01-02")
    lake.land(one.union(two), root, "things", ingest_date="2024-01-01")
    landed = lake.read_landed(spark, root, "things")
    counts = {str(r.ingest_date): r["count"] for r in landed.groupBy("ingest_date").count().collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 1}
    assert (first["row_count"], first["status"], first["column_count"]) == (2, "SUCCESS", 2)
    assert [r.id for r in files.latest_partition(landed).collect()] == [3]
    assert files.latest_or_source(None, one).count() == 2
    assert files.latest_or_source(landed, one).columns == ["id", "x"]


def test_one_bad_source_does_not_stop_the_others(spark, tmp_path):
    sources = {
        "good": lambda: spark.range(5),
        "bad": lambda: spark.read.parquet(str(tmp_path / "absent")),
        "late": lambda: spark.range(3).select(F.raise_error(F.lit("broken")).alias("x")),
    }
    audit = lake.ingest_all(spark, sources, str(tmp_path / "raw"), "2024-01-01")
    assert {r.source_name: r.status for r in audit.collect()} == {"good": "SUCCESS", "bad": "FAILED", "late": "FAILED"}
    assert tuple(lake.run_summary(audit).first()) == (3, 1, 2, 5)


def test_checksums_and_catalogue(spark, tmp_path):
    root = str(tmp_path / "raw")
    audit = lake.ingest_all(
        spark, {"a": lambda: spark.range(100), "b": lambda: spark.range(10).select(F.col("id").cast("string").alias("x"))}, root, "2024-01-01"
    )
    tables = {n: lake.read_landed(spark, root, n) for n in ("a", "b")}
    # Row order and file layout do not matter, a changed value does.
    tables["a"] = tables["a"].repartition(3)
    tables["b"] = tables["b"].withColumn("x", F.when(F.col("x") == "3", F.lit(None)).otherwise(F.col("x")))
    tables["c"] = spark.range(1)
    got = {r.source_name: r.result for r in lake.verify_checksums(tables, audit).collect()}
    assert got == {"a": "verified", "b": "mismatched", "c": "skipped"}
    catalog = lake.lake_catalog(spark, root)
    data = catalog.filter(F.col("file_name").endswith(".parquet")).collect()
    assert {(r.source_name, r.data_type, r.partition_date) for r in data} == {("a", "table", "2024-01-01"), ("b", "table", "2024-01-01")}
    stats = {(r.scope, r.name): r for r in lake.lake_stats(catalog.filter(F.col("file_name").endswith(".parquet")), audit).collect()}
    assert stats["total", "all"].files == len(data)
    assert stats["total", "all"].size_bytes == sum(r.size_bytes for r in data)
    assert stats["source", "a"].max_rows == 100 and stats["type", "table"].files == len(data)
    lake.write_sidecars(audit, root)
    assert lake.read_sidecars(spark, root).count() == 2
    assert lake.with_audit(catalog, audit).filter("audit.row_count = 100").count() >= 1


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b"'), (2, None)], "id int, x string")
    for fmt in ("parquet", "json"):
        files.write_table(df, str(tmp_path / fmt), fmt)
        assert rows(spark.read.schema(df.schema).format(fmt).load(str(tmp_path / fmt))) == rows(df)
    files.write_table(df, str(tmp_path / "csv"), "csv")
    assert rows(files.scan_csv(spark, str(tmp_path / "csv"), df.schema)) == rows(df)
    files.register_tables({"pairs_view": df})
    assert spark.sql("select count(*) n from pairs_view where x is not null").first().n == 1
    files.save_tables({"saved_pairs": df})
    files.save_tables({"saved_pairs": df.limit(1)})
    assert spark.table("saved_pairs").count() == 1
    spark.sql("drop table saved_pairs")


def test_column_choice():
    assert files.resolve_category_column(["product_category_name", "category_english"]) == "category_english"
    assert files.resolve_category_column(["product_category_name"]) == "product_category_name"
    with pytest.raises(ValueError):
        files.resolve_category_column(["x"])


def test_required_columns(spark):
    with pytest.raises(ValueError, match="rating"):
        files.require_columns(spark.range(1), ["id", "rating"])


def test_staged_tables_live_in_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = staged(spark.range(3), "probe")
    assert df.count() == 3 and folder in df.inputFiles()[0]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the generated tables")
def test_declared_schemas_match_the_files(spark):
    for name in roles.SCHEMAS:
        path = f"/root/testdata/sf0.001/{name}.parquet"
        assert roles.read(spark, "/root/testdata/sf0.001", name).schema == spark.read.parquet(path).schema


# ---- feature store ----


@pytest.fixture
def tables(spark):
    users = spark.createDataFrame([("u1", 2), ("u2", 1)], "customer_unique_id string, distinct_categories bigint")
    items = spark.createDataFrame([("p1", "a"), ("p2", "b")], "product_id string, category_english string")
    pairs = spark.createDataFrame(
        [("u1", "p1", 4.0), ("u1", "p2", 5.0), ("u2", "p1", 3.0)], "customer_unique_id string, product_id string, rating double"
    )
    return {"user_features": users, "item_features": items, "interaction_features": pairs}


def test_feature_store(spark, tmp_path, tables, rows):
    kept = store.FeatureStore(spark, str(tmp_path / "store"))
    newer = kept.register(tables, datetime(2024, 5, 1, 8, 0, 0))
    fewer = {**tables, "interaction_features": tables["interaction_features"].limit(1)}
    older = kept.register(fewer, datetime(2024, 3, 1), "early")  # registered later, but older
    assert newer == "v_20240501_080000" and kept.latest() == newer
    assert kept.at_time(datetime(2024, 4, 30)) == older
    assert kept.at_time(datetime(2024, 5, 1, 8, 0, 0)) == newer
    with pytest.raises(store.SnapshotNotFound):
        kept.at_time(datetime(2024, 1, 1))
    with pytest.raises(store.SnapshotNotFound):
        kept.table("user_features", "nope")
    assert rows(kept.training_set(), "customer_unique_id", "product_id") == [("u1", "p1"), ("u1", "p2")]
    assert kept.training_set(sample=1).count() == 1
    assert kept.interactions("u1", older).count() <= 1
    assert rows(kept.users(["u2"]), "customer_unique_id") == [("u2",)]
    assert rows(kept.items(spark.createDataFrame([("p1",)], "product_id string")), "product_id") == [("p1",)]
    status = {(r.snapshot_id, r.feature_table): (r.row_count, r.is_latest) for r in kept.status().collect()}
    assert status[newer, "interaction_features"] == (3, True)
    assert status[older, "interaction_features"] == (1, False)


def test_one_snapshot_reads_one_partition(spark, tmp_path, tables):
    kept = store.FeatureStore(spark, str(tmp_path / "store"))
    kept.register(tables, datetime(2024, 5, 1), "a")
    kept.register(tables, datetime(2024, 6, 1), "b")
    plan = kept.table("user_features", "a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan


def test_many_moments(spark):
    registry = spark.createDataFrame(
        [("c", datetime(2024, 3, 1, 12)), ("a", datetime(2024, 1, 1, 12)), ("b", datetime(2024, 1, 1, 18))], "snapshot_id string, created_at timestamp"
    )
    moments = spark.createDataFrame(
        [(1, datetime(2023, 12, 31)), (2, datetime(2024, 1, 1, 12)), (3, datetime(2024, 1, 1, 17)), (4, datetime(2024, 2, 1)), (5, datetime(2025, 1, 1))],
        "id int, at timestamp",
    )
    got = {r.id: r.snapshot_id for r in store.snapshots_for(moments, registry).collect()}
    assert got == {1: None, 2: "a", 3: "a", 4: "b", 5: "c"}
    one = store.snapshot_at(registry, datetime(2024, 2, 1)).first()
    assert one.snapshot_id == "b"


def test_registry_is_complete(spark):
    registry = features.feature_registry(spark)
    assert registry.count() == 33
    assert registry.select("feature_table", "feature_name").distinct().count() == 33


# ---- text ----


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "Red red ring"), (2, "the blue RING"), (3, None), (4, "a x 17 café")], "id int, t string")
    got = {(r.id, r.term): r.weight for r in text.tfidf(docs, "id", "t").collect()}
    assert set(got) == {(1, "red"), (1, "ring"), (2, "blue"), (2, "ring"), (4, "17"), (4, "café")}
    from math import log, sqrt

    rare, common = log(5 / 2) + 1, log(5 / 3) + 1
    norm = sqrt((2 * rare) ** 2 + common**2)
    assert abs(got[1, "red"] - 2 * rare / norm) < 1e-8 and abs(got[1, "ring"] - common / norm) < 1e-8
    assert {t for _, t in {(r.id, r.term) for r in text.tfidf(docs, "id", "t", max_terms=1).collect()}} == {"red"}


# ---- streaming ----


@pytest.fixture
def event_dir(spark, tmp_path):
    def write(name, first, n):
        df = spark.range(first, first + n).select(
            F.col("id").alias("event_id"),
            (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600)).cast("timestamp_ntz").alias("ts"),
            (F.col("id") % 5).alias("user_id"),
            F.when(F.col("id") % 2 == 0, "view").otherwise("buy").alias("event_type"),
            (F.col("id") / 4).alias("value"),
            F.lit('{"k": 1}').alias("props"),
        )
        df.coalesce(1).write.parquet(str(tmp_path / "in" / name))

    return tmp_path, write


def source(spark, tmp):
    raw = spark.readStream.schema(events.EVENTS).option("recursiveFileLookup", True).parquet(str(tmp / "in"))
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def test_ingest_reads_each_file_once(spark, event_dir):
    tmp, write = event_dir
    target, state = str(tmp / "out"), str(tmp / "state")
    write("a", 0, 50)
    events.ingest(source(spark, tmp), target, state)
    events.ingest(source(spark, tmp), target, state)
    assert spark.read.parquet(target).count() == 50
    write("b", 50, 30)
    events.ingest(source(spark, tmp), target, state)
    landed = spark.read.parquet(target)
    assert landed.count() == 80 and landed.select("event_id").distinct().count() == 80


def test_window_counts_over_several_batches(spark, event_dir):
    tmp, write = event_dir
    target, state = str(tmp / "counts"), str(tmp / "state")
    counted = [("window_start"), ("event_type")]
    for name, first in (("a", 0), ("b", 100)):
        write(name, first, 100)
        events.drain(events.windowed_counts(source(spark, tmp)), target, state, "update")
    got = events.newest_version(spark.read.parquet(target), counted)
    assert got.agg(F.sum("n_events")).first()[0] == 200
    assert got.groupBy(*counted).count().filter("count > 1").isEmpty()


def test_repeats_are_dropped(spark, event_dir):
    tmp, write = event_dir
    write("a", 0, 40)
    twice = source(spark, tmp).unionByName(source(spark, tmp))
    events.drain(events.without_repeats(twice), str(tmp / "once"), str(tmp / "state"))
    assert spark.read.parquet(str(tmp / "once")).count() == 40


def test_checksum_keeps_fields_and_nulls_apart(spark):
    def checksum(*rows):
        df = spark.createDataFrame(list(rows), "x string, y string")
        return df.agg(lake.table_checksum(["x", "y"])).first()[0]

    assert checksum(("a|b", "c")) != checksum(("a", "b|c"))
    assert checksum((None, "c")) != checksum(("\\N", "c")) != checksum(("-", "c"))
    assert checksum(("a", None)) != checksum((None, "a"))
    assert checksum(("a", "b"), ("c", "d")) == checksum(("c", "d"), ("a", "b")) != checksum(("a", "b"))
    assert checksum() == "0-0"
