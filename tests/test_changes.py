"""Decoding, transactions, merging and settings on literal messages."""

from __future__ import annotations

import itertools
import json
import re
from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.functions import schema as H
from tidemark.functions import values as V
from tidemark.operators import apply as A
from tidemark.operators import metrics as M
from tidemark.operators import sinks as S
from tidemark.operators import transactions as X
from tidemark.sources import envelopes as E
from tidemark.streaming import assembler as Z

REGION = T.StructType([T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())])


def message(op, before=None, after=None, tx=None, **more):
    source = {"version": "3.0", "connector": "postgresql", "db": "shop", "table": "region", "ts_ms": 1} | more.pop("source", {})
    return {"schema": {"type": "struct"}, "payload": {"op": op, "before": before, "after": after, "source": source, "ts_ms": 5, "transaction": tx} | more}


@pytest.fixture(scope="module")
def events(spark):
    sent = [
        message("c", after={"r_regionkey": 1, "r_name": "BASE                 "}, tx={"id": "7:1", "total_order": 1, "data_collection_order": 1}),
        message("u", {"R_REGIONKEY": 2, "R_NAME": "MIDDLE EAST"}, {"R_REGIONKEY": 2, "R_NAME": "CHINA"}, source={"connector": "mysql", "server_id": 1}),
        message("d", {"r_regionkey": 3, "r_name": "x"}),
        message("r", after={"r_regionkey": 4}),
        message("z", after={"r_regionkey": 5}),
        message("C", after={"r_regionkey": 6, "r_name": None})["payload"],
    ]
    raw = [json.dumps(m).encode() for m in sent] + [b"", None, b"{broken", b"[]"]
    return E.decode_changes(spark.createDataFrame([("tide.shop.region", v) for v in raw], "topic string, value binary"))


def test_decode(events):
    rows = E.current(E.typed(events, REGION, fold_case=True)).select("op", "row", "before", "source", "transaction").collect()
    assert sorted((r.op, r.row.r_regionkey, r.row.r_name) for r in rows if r.row.r_name is not None) == [("DELETE", 3, "x"), ("INSERT", 1, "BASE"), ("UPDATE", 2, "CHINA")]
    assert {(r.op, r.row.r_regionkey) for r in rows if r.row.r_name is None} == {("SNAPSHOT", 4), ("INSERT", 6)}
    update = next(r for r in rows if r.op == "UPDATE")
    assert update.before.r_name == "MIDDLE EAST" and update.source.schema == "" and update.source.txId == 0
    assert next(r for r in rows if r.row.r_regionkey == 1).transaction.id == "7:1"


def test_dead_letters(events):
    got = sorted((r.message, bytes(r.original_data)[:3]) for r in E.dead_letters(events).collect())
    assert [m for m, _ in got] == ["unknown operation: z", "unreadable message", "unreadable message"]
    assert {d for _, d in got} == {b'{"s', b"{br", b"[]"}


def test_decimals(spark):
    cases = [("BqQ=", "17.00"), ("JbR7", "24710.35"), ("/w==", "-0.01"), ("+Vw=", "-17.00"), (None, None), ("", None)]
    df = spark.createDataFrame(cases, "b string, want string")
    for p in (15, 38):
        got = df.select(V.decode_decimal(F.col("b"), p, 2).alias("d"), "want").collect()
        assert all((None if r.want is None else Decimal(r.want)) == r.d for r in got)
    big = spark.createDataFrame([("S0yoWgmMT4Yg////////" + "/w==",)], "b string").select(V.decode_decimal(F.col("b").substr(1, 20), 38, 0).alias("d")).first()
    import base64

    assert int(big.d) == int.from_bytes(base64.b64decode("S0yoWgmMT4Yg////////"), "big", signed=True)


def test_java_hash(spark):
    texts = ["", "a", "tx1", "file=binlog.000002,pos=1384", "日本", "😀x"]

    def java(s):
        h = 0
        raw = s.encode("utf-16-be")
        for i in range(0, len(raw), 2):
            h = (31 * h + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
        return h - 2**32 if h >= 2**31 else h

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", V.java_hash(F.col("t")).alias("h")).collect()
    assert {r.t: r.h for r in got} == {t: java(t) for t in texts}


def test_connect_schema():
    decimal = {"type": "bytes", "name": "org.apache.kafka.connect.data.Decimal", "parameters": {"scale": "2", "connect.decimal.precision": "15"}}
    assert H.connect_type(decimal) == T.DecimalType(15, 2)
    assert H.connect_type({"type": "int32", "name": "io.debezium.time.Date"}) == T.DateType()
    assert H.connect_type({"type": "string", "name": "io.debezium.data.Enum"}) == T.StringType()
    row = {"field": "after", "type": "struct", "fields": [{"field": "R_KEY", "type": "int32", "optional": False}, decimal | {"field": "p"}]}
    assert H.connect_row({"type": "struct", "fields": [row]}) == T.StructType([T.StructField("r_key", T.IntegerType(), False), T.StructField("p", T.DecimalType(15, 2))])
    for bad in ({"type": "unknown_type"}, {"name": "x"}):
        with pytest.raises(H.SchemaError):
            H.connect_type(bad)


def test_avro_schema():
    record = {"type": "record", "name": "r", "fields": [{"name": "a", "type": ["null", "long"]}, {"name": "b", "type": {"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 2}}, {"name": "c", "type": {"type": "int", "logicalType": "date"}}, {"name": "d", "type": {"type": "array", "items": "string"}}]}
    assert H.avro_type(record).simpleString() == "struct<a:bigint,b:decimal(15,2),c:date,d:array<string>>"
    with pytest.raises(H.SchemaError):
        H.avro_type("nothing")


def test_registry():
    r = H.Registry()
    r.put("Shop", "Region", REGION, ("R_REGIONKEY",))
    assert r.get("SHOP", "region")[1] == ("r_regionkey",)
    with pytest.raises(H.SchemaError):
        r.put("shop", "x", REGION, ("absent",))


def test_any_order_of_arrival_commits_the_same(spark):
    """Rows of two tables, BEGIN and END of two transactions, one of them incomplete, in every order of three files."""
    rows = [("t1", "a", 1, 1), ("t1", "b", 2, 1), ("t2", "a", 1, 1)]
    ev = spark.createDataFrame([(t, 10, c, o, d) for t, c, o, d in rows], "tx_id string, ts_ms long, table string, total_order long, data_collection_order long").withColumn("body", F.lit("x"))
    told = spark.createDataFrame(
        [("BEGIN", "t1", 0, 1, None), ("END", "t1", 2, 20, [("shop.a", 1), ("public.b", 1)]), ("END", "t2", 2, 20, [("shop.a", 2)]), ("END", "t1", 2, 20, [("shop.a", 1), ("public.b", 1)])],
        E.METADATA.replace("struct<status:string,id:string,event_count:bigint,ts_ms:bigint,", "status string, id string, event_count long, ts_ms long, ").replace("data_collections:", "data_collections ")[:-1],
    )
    done = X.committed_rows(ev, told)
    assert sorted((r.tx_id, r.total_order) for r in done.collect()) == [("t1", 1), ("t1", 2)]
    assert X.orphans(ev, told).select("tx_id").distinct().collect()[0].tx_id == "t2"
    assert [r.tx_id for r in X.ends_without_begin(told).collect()] == ["t2"]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_stream_in_any_order(spark, tmp_path, order):
    none = None
    parts = [
        [("t1", "ROW", 10, "a", 1, 1, "x", none), ("t9", "ROW", 1, "a", 1, 1, "old", none)],
        [("t1", "BEGIN", 10, none, none, none, none, none), ("t1", "END", 11, none, none, none, none, [("shop.a", 2)])],
        [("t1", "ROW", 12, "a", 2, 2, "y", none), ("t3", "ROW", 5000, "a", 1, 1, "z", none)],
    ]
    for k in order:
        spark.createDataFrame(parts[k], Z.ITEM).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(Z.ITEM).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = Z.assemble(stream, f"{tmp_path}/out", timeout_ms=1000 if order[-1] == 2 else None).collect()
    assert sorted((r.tx_id, r.total_order, r.body) for r in got) == [("t1", 1, "x"), ("t1", 2, "y")]
    if order[-1] == 2:
        assert [r.tx_id for r in spark.read.parquet(f"{tmp_path}/out/expired").collect()] == ["t9"]


def test_key_change_and_delete(spark):
    row = "struct<k:int,v:string>"
    log = [("INSERT", None, (1, "a"), 1), ("INSERT", None, (2, "b"), 2), ("UPDATE", (1, "a"), (3, "c"), 3), ("DELETE", (2, "b"), None, 4), ("UPDATE", (3, "c"), (3, "d"), 5), ("UNRECOGNIZED", None, None, 6), ("INSERT", None, (2, None), 7)]
    for part in (log, log[::-1]):
        changes = spark.createDataFrame(part, f"op string, before {row}, after {row}, o long")
        want = [(2, None), (3, "d")]
        assert sorted(map(tuple, A.replay(changes, ["k"], "o").collect())) == want
        assert sorted(map(tuple, A.merge(spark.createDataFrame([(2, "old")], "k int, v string"), changes, ["k"], "o").collect())) == want
        assert A.replay(changes.where("false"), ["k"], "o").count() == 0


def test_ranks_without_one_task(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 200).alias("t"), F.col("id").cast("string").alias("i"))
    got = X.ranked(df, "t", "i", "n", per_bucket=90).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert [(r.t, r.i) for r in got] == sorted((r.t, r.i) for r in got)


def test_sinks(spark, tmp_path):
    row = "struct<k:int,v:string,d:date>"
    df = spark.createDataFrame([("INSERT", (1, 'a|"b', date(2020, 1, 2))), ("DELETE", None), ("UPDATE", (2, None, None))], f"op string, after {row}")
    assert sorted(r.line for r in S.csv_lines(df, ["k", "v", "d"]).collect()) == ['1|a|"b|2020-01-02', "2||"]
    for mode in ("CSV", "parquet", "Memory"):
        S.writer_for(mode)(df, "out_view" if mode == "Memory" else f"{tmp_path}/{mode}", ["k", "v", "d"])
    back = spark.read.schema("k int, v string, d date").options(sep="|", escape='"').csv(f"{tmp_path}/CSV")
    assert sorted(r.k for r in back.collect()) == sorted(r.k for r in spark.table("out_view").collect()) == [1, 2]
    with pytest.raises(ValueError):
        S.writer_for("nowhere")


def test_config(tmp_path):
    path = tmp_path / "p.properties"
    path.write_text("# comment\nsink.mode=CSV\ntopic.prefix = tide\nconsumer.capture_database=shop\nconsumer.include_tables=a, b\nsink.csv.enable_header=true\ntransaction.timeout=300\nunknown=1\nvalue.deserializer=x.AvroThing\n")
    c = config.from_args(["-c", str(path)])
    assert (c.sink_mode, c.topic_prefix, c.include_tables, c.csv_header, c.transaction_timeout, c.value_format) == ("CSV", "tide", ("a", "b"), True, 300, "avro")
    options = E.kafka_options(replace(c, include_tables=()))
    assert re.fullmatch(options["subscribePattern"], "tide.shop.orders") and not re.fullmatch(options["subscribePattern"], "tide.shopping.x")
    assert "maxOffsetsPerTrigger" not in options
    some = E.kafka_options(replace(c, include_tables=("orders", "part"), max_offsets_per_trigger=9))
    assert re.fullmatch(some["subscribePattern"], "tide.shop.part") and not re.fullmatch(some["subscribePattern"], "tide.shop.parts")
    assert some["maxOffsetsPerTrigger"] == "9"
    assert options["kafka.group.id"] != E.kafka_options(c, E.TRANSACTIONS)["kafka.group.id"]
    with pytest.raises(ValueError):
        E.kafka_options(c, "other")
    assert E.kafka_options(c, E.TRANSACTIONS)["subscribe"] == "tide.transaction"
    with pytest.raises(Exception):
        c.sink_mode = "x"


def test_entry_without_the_corpus_package(monkeypatch):
    import importlib.util

    import __spark_entry__

    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name: None if name in ("tidemark.llm", "corpus_pipeline") else found(name))
    again = importlib.reload(__spark_entry__)
    assert "replay_orders" in again.queries() and not any(n.startswith("op1_") or n == "pipeline" for n in again.queries())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


def test_small_inputs_are_spread_and_large_ones_stay(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, 1, 1)
    assert E.spread(one).rdd.getNumPartitions() == cores
    assert sorted(r.id for r in E.spread(one).collect()) == list(range(1000))
    assert E.spread(one.limit(0)).count() == 0
    many = spark.range(0, 1000, 1, cores)
    assert E.spread(many) is many


@pytest.mark.parametrize("per_range", [7, 1000])
def test_exact_quantiles_need_no_task_with_a_whole_group(spark, per_range):
    """As F.percentile has them: ties, nulls, groups of one, two or only null values, null keys, -0.0, infinite values and NaN."""
    rows = [("a", None, float(i * 37 % 101)) for i in range(300)] + [("a", "x", None)] * 3 + [("b", "x", 5.0), ("c", None, -0.5), ("c", None, 2.0), (None, None, 1.0), (None, None, None)]
    rows += [("d", "x", v) for v in (float("inf"), float("inf"), 1.0, -0.0, 0.0)] + [("e", "x", v) for v in (float("nan"), 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, o string, v double")
    want = df.groupBy("k", "o").agg(*[F.percentile("v", q).alias(f"p{round(100 * q)}") for q in M.QUANTILES])
    got = M.percentiles(df, "v", ["k", "o"], per_range)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = M.latency(df, "v", ["k"], exact=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan
