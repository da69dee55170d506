"""The keyed form of transaction assembly, and a whole ingestion."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.schema import Registry, SchemaError
from tidemark.plans import catalog
from tidemark.sources import envelopes as E
from tidemark.streaming import assembler as Z
from tidemark.streaming.ingest import Ingestion, service

none = None
SF = os.environ.get("TIDEMARK_SF", "/root/testdata/sf0.001")


def keyed(spark, tmp_path, parts, timeout):
    for part in parts:
        spark.createDataFrame(part, Z.ITEM).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(Z.ITEM).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = Z.assemble_keyed(stream, timeout).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    Z.finish(query, 120)
    return spark.read.schema(Z.OUT).parquet(f"{tmp_path}/out").collect()


def test_keyed_assembly(spark, tmp_path):
    parts = [
        [("t1", "ROW", 10, "a", 2, 2, "y", none), ("t2", "ROW", 10, "a", 1, 1, "w", none)],
        [("t1", "END", 11, none, none, none, none, [("shop.a", 2)]), ("t1", "BEGIN", 10, none, none, none, none, none)],
        [("t1", "ROW", 12, "a", 1, 1, "x", none), ("t3", "ROW", 9000, "a", 1, 1, "z", none)],
        [("t3", "ROW", 9500, "a", 2, 2, "z", none)],
    ]
    got = keyed(spark, tmp_path, parts, 1000)
    assert [(r.tx_id, r.total_order, r.body) for r in got if r.outcome == "committed"] == [("t1", 1, "x"), ("t1", 2, "y")]
    assert [(r.tx_id, r.body) for r in got if r.outcome == "expired"] == [("t2", "w")]


def test_rows_behind_the_clock_are_kept(spark, tmp_path):
    parts = [
        [("t1", "END", 0, none, none, none, none, [("shop.a", 2)]), ("t1", "ROW", 5000, "a", 1, 1, "x", none)],
        [("t8", "ROW", 5500, "a", 1, 1, "-", none)],
        [("t1", "ROW", 20, "a", 2, 2, "y", none)],
    ]
    got = keyed(spark, tmp_path, parts, 1000)
    assert [r.body for r in got if (r.tx_id, r.outcome) == ("t1", "committed")] == ["x", "y"]


def test_live_transactions_do_not_expire_and_late_rows_are_told(spark, tmp_path):
    """Rows keep coming within the timeout: the first row's timer must not end the transaction."""
    parts = [
        [("t1", "ROW", 10, "a", 3, 3, "c", none)],
        [("t1", "ROW", 900, "a", 2, 2, "b", none), ("t9", "ROW", 900, "a", 1, 1, "-", none)],
        [("t9", "ROW", 1500, "a", 2, 2, "-", none)],
        [("t1", "END", 1600, none, none, none, none, [("shop.a", 3)])],
        [("t1", "ROW", 1700, "a", 1, 1, "a", none), ("t1", "END", 1700, none, none, none, none, [("shop.a", 3)])],
        [("t1", "ROW", 1800, "b", 4, 1, "late", none)],
    ]
    got = keyed(spark, tmp_path, parts, 1000)
    assert [r.body for r in got if (r.tx_id, r.outcome) == ("t1", "committed")] == ["a", "b", "c"]
    assert [r.body for r in got if r.outcome == "late"] == ["late"]
    assert not [r for r in got if r.outcome == "expired"]


def test_transactions_share_the_keys_of_the_state(spark, tmp_path, monkeypatch):
    """Many transactions in two buckets: each commits, expires or is late by itself, and state keys don't grow with them."""
    monkeypatch.setattr(Z, "BUCKETS", 2)
    ids = [f"t{i}" for i in range(300)]
    parts = [
        [(t, "ROW", 10 + k, "a", k, k, f"{t}:{k}", none) for t in ids for k in (3, 2)],
        [(t, "ROW", 20, "a", 1, 1, f"{t}:1", none) for t in ids[100:]] + [(t, "END", 20, none, none, none, none, [("shop.a", 3)]) for t in ids[200:]],
        [(t, "ROW", 1014, "a", 1, 1, f"{t}:1", none) for t in ids[50:100]] + [("t250", "ROW", 900, "a", 4, 4, "t250:4", none)],
        [("t250", "ROW", 1800, "a", 5, 5, "t250:5", none)],
    ]
    runs = []
    for part in parts:
        spark.createDataFrame(part, Z.ITEM).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(Z.ITEM).parquet(f"{tmp_path}/in")
        runs.append(Z.assemble_keyed(stream, 1000).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out"))
        Z.finish(runs[-1], 120)
    got = spark.read.schema(Z.OUT).parquet(f"{tmp_path}/out").collect()
    of = lambda outcome: [r.body for r in got if r.outcome == outcome]
    ended = of("committed")
    assert sorted(ended) == sorted(f"{t}:{k}" for t in ids[200:] for k in (1, 2, 3))
    assert all([b for b in ended if b.startswith(f"{t}:")] == [f"{t}:1", f"{t}:2", f"{t}:3"] for t in ids[200:])
    # last events at 13 and 20 are older than the timeout by the clock's 1014 to 1800, those at 1014 are not
    assert sorted(of("expired")) == sorted([f"{t}:{k}" for t in ids[:50] for k in (2, 3)] + [f"{t}:{k}" for t in ids[100:200] for k in (1, 2, 3)])
    assert of("late") == ["t250:4", "t250:5"]
    assert max(p["stateOperators"][0]["numRowsTotal"] for r in runs for p in r.recentProgress) < 20


@pytest.mark.parametrize("n", [1, 3, 9, 16])
def test_rows_of_many_files(spark, tmp_path, n):
    parts = [[("t5", "ROW", 10 + i, "a", n - i, n - i, str(n - i), none)] for i in range(n)]
    parts[0].append(("t5", "END", 10, none, none, none, none, [("shop.a", n)]))
    got = keyed(spark, tmp_path, [sum(parts[: n // 2], []), sum(parts[n // 2 :], [])] if n > 1 else parts, 10_000)
    assert [r.body for r in got if r.outcome == "committed"] == [str(i + 1) for i in range(n)]


def messages(spark, path, part):
    """Three tables' worth of messages; the second part deletes and moves keys."""
    payload = [
        ("tide.shop.a", {"op": "r", "ts_ms": 1, "ts_us": 1, "source": {"db": "shop"}, "before": None, "after": {"id": 1, "v": "x "}}),
        ("tide.shop.a", {"op": "c", "ts_ms": 2, "ts_us": 2, "source": {"db": "shop"}, "before": None, "after": {"id": 2, "v": None}, "transaction": {"id": "t", "total_order": 1, "data_collection_order": 1}}),
        ("tide.shop.b", {"op": "c", "ts_ms": 2, "ts_us": 2, "source": {"db": "shop"}, "before": None, "after": {"id": 7}, "transaction": {"id": "t", "total_order": 2, "data_collection_order": 1}}),
        ("tide.shop.other", {"op": "c", "ts_ms": 2, "ts_us": 2, "before": None, "after": {"id": 9}}),
        ("tide.shop.a", {"op": "z", "ts_ms": 2}),
    ] if part == 0 else [
        ("tide.shop.a", {"op": "u", "ts_ms": 5, "ts_us": 5, "source": {"db": "shop"}, "before": {"id": 2, "v": None}, "after": {"id": 3, "v": "q"}}),
        ("tide.shop.a", {"op": "d", "ts_ms": 6, "ts_us": 6, "source": {"db": "shop"}, "before": {"id": 1, "v": "x"}, "after": None}),
    ]
    rows = [(t, json.dumps(p if i % 2 else {"payload": p}).encode()) for i, (t, p) in enumerate(payload)] + [("tide.shop.a", b""), ("tide.shop.a", none)]
    spark.createDataFrame(rows, "topic string, value binary").coalesce(1).write.mode("append").parquet(f"{path}/{E.ROWS}")
    told = [{"status": "BEGIN", "id": "t"}, {"status": "END", "id": "t", "data_collections": [{"data_collection": "shop.a", "event_count": 1}, {"data_collection": "shop.b", "event_count": 1}]}]
    spark.createDataFrame([("tide.transaction", json.dumps(m).encode()) for m in (told if part == 0 else [])], "topic string, value binary").coalesce(1).write.mode("append").parquet(f"{path}/{E.TRANSACTIONS}")


@pytest.fixture
def registry(tmp_path):
    field = lambda n, t: {"field": n, "type": t, "optional": True}
    for name, fields in {"a": [field("id", "int64"), field("v", "string")], "b": [field("id", "int64")]}.items():
        row = {"type": "struct", "field": "after", "fields": fields}
        (tmp_path / f"schemas_{name}").mkdir()
        folder = tmp_path / "schemas"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text(json.dumps({"keys": ["id"], "schema": {"type": "struct", "fields": [row]}}))
    return Registry.from_folder(str(tmp_path / "schemas"), "shop")


@pytest.mark.parametrize("mode", ["table", "csv"])
def test_ingestion_writes_tables_dead_letters_and_metrics(spark, tmp_path, registry, mode):
    config = Config(sink_mode=mode, csv_path=f"{tmp_path}/out", csv_header=True, topic_prefix="tide", capture_database="shop", include_tables=("a", "b"), source_path=str(tmp_path))
    job = Ingestion(spark, config, registry)
    last = none
    for part in (0, 1):
        messages(spark, tmp_path, part)
        run = job.start(once=True)
        Z.finish(run, 120)
        last = run.lastProgress["batchId"]
    if mode == "table":
        assert [tuple(r) for r in job.table("shop", "a", last).collect()] == [(3, "q")]
        assert [tuple(r) for r in job.table("shop", "b", last).collect()] == [(7,)]
    else:
        got = spark.read.options(sep="|", header=True).csv(f"{tmp_path}/out/shop/a").select("id", "v").collect()
        assert sorted(map(tuple, got), key=str) == [("1", "x"), ("2", none), ("3", "q")]
    dead = spark.read.parquet(f"{tmp_path}/out/_dead_letters").select("outcome", "body").collect()
    assert [r.outcome for r in dead] == ["unreadable"] and "unknown operation: z" in dead[0].body
    counted = spark.read.parquet(f"{tmp_path}/out/_metrics").groupBy("table", "op").agg(F.sum("n").alias("n")).collect()
    assert {(r.table, r.op): r.n for r in counted} == {("a", "SNAPSHOT"): 1, ("a", "INSERT"): 1, ("b", "INSERT"): 1, ("a", "UPDATE"): 1, ("a", "DELETE"): 1}
    assert {r.step for r in job.progress.latencies(spark).collect()} >= {"addBatch", "triggerExecution"}


def test_messages_are_decoded_once_for_rows_outside_transactions(spark, tmp_path, registry):
    config = Config(csv_path=f"{tmp_path}/out", topic_prefix="tide", capture_database="shop", source_path=str(tmp_path))
    messages(spark, tmp_path, 0)
    plan = Ingestion(spark, config, registry).outcomes()._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 3  # rows in transactions, metadata, all other rows


def test_service_starts_once_and_stops(spark, tmp_path, registry):
    messages(spark, tmp_path, 0)
    config = Config(csv_path=f"{tmp_path}/out", topic_prefix="tide", capture_database="shop", source_path=str(tmp_path), flush_interval_ms=200)
    run = service(spark, config, registry)
    assert not run.is_active
    run.start()
    assert run.is_active
    with pytest.raises(RuntimeError):
        run.start()
    run.query.processAllAvailable()
    run.stop()
    assert not run.is_active


def test_sinks_and_keys_are_checked_first(spark, registry):
    with pytest.raises(ValueError):
        Ingestion(spark, Config(sink_mode="nowhere"), registry)
    row, _ = registry.get("shop", "a")
    for keys, unique in ((("id",), False), ((), True), (("no",), True)):
        with pytest.raises(SchemaError):
            registry.put("shop", "c", row, keys, unique)


@pytest.mark.parametrize("name, folder, parts", [("stream_tx_assembly", "in", 3), ("stream_tx_keyed", "in", 2)])
def test_no_task_writes_a_whole_part(spark, tmp_path, monkeypatch, name, folder, parts):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    monkeypatch.setattr(catalog, "fresh", lambda spark: f"{tmp_path}/x")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small results would be put into one file
    try:
        catalog.QUERIES[name](spark, SF)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(glob.glob(f"{tmp_path}/x/{folder}/*.parquet")) >= 4 * parts
