"""Transactions put together on a stream.

Two forms of one state machine: `assemble`, micro-batches of DataFrame joins with the waiting rows
in a table, and `TransactionProcessor`, keyed state with timers. Both emit a transaction's rows once END
has come and every declared table is complete, in whatever order rows, BEGIN and END arrive.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.config import Config
from tidemark.operators.transactions import committed_rows

ITEM = "tx_id string, kind string, ts_ms bigint, table string, total_order bigint, data_collection_order bigint, body string, data_collections array<struct<data_collection:string,event_count:bigint>>"


def items(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows and metadata as one stream keyed by transaction."""
    none = "array<struct<data_collection:string,event_count:bigint>>"
    rows = events.select("tx_id", F.lit("ROW").alias("kind"), "ts_ms", "table", "total_order", "data_collection_order", "body", F.lit(None).cast(none).alias("data_collections"))
    empty = lambda t: F.lit(None).cast(t)
    told = metadata.select(F.col("id").alias("tx_id"), F.col("status").alias("kind"), "ts_ms", empty("string").alias("table"), empty("bigint").alias("total_order"), empty("bigint").alias("data_collection_order"), empty("string").alias("body"), "data_collections")
    return rows.unionByName(told)


class Batches:
    """foreachBatch: commits complete transactions, keeps the rest for later batches, sends what is too old to dead letters.

    Every batch writes its own folders, so a batch that is run again replaces what it wrote before. What waits is written
    anew in each batch, so this form is for few waiting transactions; timeout_ms None: they wait for ever.
    """

    def __init__(self, folder: str, timeout_ms: int | None = Config.transaction_timeout):
        self.folder, self.timeout_ms = folder, timeout_ms

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number:
            batch = batch.unionByName(spark.read.schema(ITEM).parquet(f"{self.folder}/waiting/{number - 1}"))
        batch = batch.persist()
        rows = batch.where("kind = 'ROW'")
        told = batch.where("kind <> 'ROW'").select(F.col("kind").alias("status"), F.col("tx_id").alias("id"), "ts_ms", "data_collections")
        done = committed_rows(rows, told)
        done.write.mode("overwrite").parquet(f"{self.folder}/committed/batch={number}")
        ids = spark.read.schema(ITEM).parquet(f"{self.folder}/committed/batch={number}").select("tx_id").distinct()
        left = batch.join(ids, "tx_id", "left_anti")
        if self.timeout_ms is not None:
            now = batch.agg(F.max("ts_ms")).first()[0] or 0
            old = left.groupBy("tx_id").agg(F.max("ts_ms").alias("last")).where(F.lit(now) - F.col("last") > self.timeout_ms).select("tx_id")
            left.join(old, "tx_id", "left_semi").where("kind = 'ROW'").write.mode("overwrite").parquet(f"{self.folder}/expired/batch={number}")
            left = left.join(old, "tx_id", "left_anti")
        left.write.mode("overwrite").parquet(f"{self.folder}/waiting/{number}")
        batch.unpersist()


def assemble(stream: DataFrame, folder: str, timeout_ms: int | None = Config.transaction_timeout, wait_s: int = 600) -> DataFrame:
    """Run over what is there and return the committed rows."""
    query = stream.writeStream.foreachBatch(Batches(folder, timeout_ms)).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    finish(query, wait_s)
    return stream.sparkSession.read.schema(ITEM).parquet(f"{folder}/committed/*")


def finish(query: StreamingQuery, wait_s: int) -> None:
    if not query.awaitTermination(wait_s):
        query.stop()
        raise TimeoutError(f"the stream did not end in {wait_s} s")


OUT = "tx_id string, outcome string, table string, ts_ms bigint, total_order bigint, data_collection_order bigint, body string"


#: Transactions are dealt over as many keys of the state by a hash of their id; fixed for the life of a checkpoint.
BUCKETS = 8192
IN = ["tx_id", "kind", "ts_ms", "table", "total_order", "data_collection_order", "body"]
CHUNK = 10_000


class TransactionProcessor(StatefulProcessor):
    """Keyed state, one key for a bucket of transactions, as each key and state call costs more than many rows do.

    State: a value with each transaction's head, and chunks of waiting rows, which are added to and written anew only
    when some of them leave. A head is [newest event time, closed, declared by END or None, received by table, rows in chunks].
    The one timer of a bucket is that of its transaction longest without an event.

    Outcomes: committed, in the order of total_order; expired, when no event came for the timeout; late, for rows
    that come within the timeout after their transaction committed. Repeated BEGIN and END change nothing.
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "rows binary")
        self.heads = handle.getValueState("heads", "timer bigint, heads binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timer, heads = self.load()
        new: dict = {}
        for pdf in rows:
            for tx, kind, ts, table, total, order, body in zip(*[pdf[c].tolist() for c in IN]):
                head = heads.setdefault(tx, [0, False, None, {}, 0])
                head[0] = max(head[0], ts)
                here = new.setdefault(tx, [])
                if kind == "ROW":
                    here.append((tx, table, ts, total, order, body))
                    if not head[1]:
                        head[3][table] = head[3].get(table, 0) + 1
                elif kind == "END" and not head[1]:
                    head[2] = {}
                    for c in json.loads(body or "[]"):
                        name = c.get("data_collection", "").rpartition(".")[2]
                        head[2][name] = max(head[2].get(name, 0), c.get("event_count", 0))
        late, done, wait = {}, {}, []
        for tx, here in new.items():
            head = heads[tx]
            if head[1]:
                late[tx] = here
            elif head[2] is not None and all(head[3].get(n, 0) >= c for n, c in head[2].items()):
                done[tx] = here
            else:
                head[4] += len(here)
                wait += here
        self.take({tx: here for tx, here in done.items() if heads[tx][4]})
        self.append(wait)
        for tx in done:
            heads[tx] = [heads[tx][0], True, None, {}, 0]
        self.save(timer, heads)
        yield from self.emit(late, "late")
        yield from self.emit(done, "committed")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, heads = self.load()
        old = {tx: [] for tx, head in heads.items() if timerValues.getCurrentWatermarkInMs() - head[0] > self.timeout_ms}
        self.take({tx: here for tx, here in old.items() if heads[tx][4]})
        for tx in old:
            del heads[tx]
        self.save(None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer, heads)
        yield from self.emit(old, "expired")

    def load(self) -> tuple[int | None, dict]:
        got = self.heads.get()
        return (None, {}) if got is None else (got[0], pickle.loads(got[1]))

    def save(self, timer: int | None, heads: dict) -> None:
        """timer: the one that is set, if any."""
        due = min(head[0] for head in heads.values()) + self.timeout_ms + 1 if heads else None
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if heads:
            self.heads.update((due, pickle.dumps(heads)))
        else:
            self.heads.clear()

    def take(self, wanted: dict) -> None:
        """Moves the waiting rows of these transactions before those that they hold; the other rows stay."""
        if not wanted:
            return
        found, kept = {tx: [] for tx in wanted}, []
        for chunk in self.chunks.get():
            for row in pickle.loads(chunk[0]):
                found.get(row[0], kept).append(row)
        for tx, here in wanted.items():
            here[:0] = found[tx]
        self.chunks.clear()
        self.append(kept)

    def append(self, rows: list) -> None:
        for i in range(0, len(rows), CHUNK):
            self.chunks.appendValue((pickle.dumps(rows[i : i + CHUNK]),))

    @staticmethod
    def emit(found: dict, outcome: str) -> Iterator[pd.DataFrame]:
        rows = [row for here in found.values() for row in sorted(here, key=lambda row: row[3:5])]
        for i in range(0, len(rows), CHUNK):
            out = pd.DataFrame(rows[i : i + CHUNK], columns=["tx_id", "table", "ts_ms", "total_order", "data_collection_order", "body"])
            out.insert(1, "outcome", outcome)
            yield out

    def close(self) -> None:
        pass


def assemble_keyed(stream: DataFrame, timeout_ms: int) -> DataFrame:
    """The keyed form, columns of OUT; sets the RocksDB state store, which it needs, for the session's next streams."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # Spark drops rows behind the watermark where it sees their event time: `at` moves it and goes before the state
    stream = stream.withColumn("at", F.when(F.col("ts_ms") > 0, F.timestamp_millis("ts_ms"))).withWatermark("at", "0 seconds")
    bucket = F.pmod(F.xxhash64("tx_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    body = F.when(F.col("kind") == "END", F.to_json("data_collections")).otherwise(F.col("body")).alias("body")
    number = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    items = stream.select(bucket, "tx_id", "kind", number("ts_ms"), "table", number("total_order"), number("data_collection_order"), body)
    return items.groupBy("bucket").transformWithStateInPandas(TransactionProcessor(timeout_ms), OUT, "Append", "EventTime")


class Service:
    """A running ingestion: start, stop, is_active."""

    def __init__(self, spark: SparkSession, begin):
        self.spark, self.begin, self.query = spark, begin, None

    def start(self) -> None:
        if self.is_active:
            raise RuntimeError("it runs already")
        self.query = self.begin(self.spark)

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
            self.query = None

    @property
    def is_active(self) -> bool:
        return self.query is not None and self.query.isActive
