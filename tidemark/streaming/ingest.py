"""One ingestion run from its settings: read, route, decode, assemble, apply, write; metrics and dead letters beside it.

Below the sink's path stand <database>/<table> for each table, `_dead_letters` and `_metrics`; the stream's state is
kept in state_path. Sink modes: those of the writers (rows appended), and `table`, which keeps each table's last state by key.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Config
from tidemark.functions.schema import Registry
from tidemark.operators import apply as A
from tidemark.operators import metrics as M
from tidemark.operators import routing as R
from tidemark.operators import sinks as S
from tidemark.sources import envelopes as E
from tidemark.streaming import assembler as Z

BODY = "struct<db:string,op:string,ts_us:bigint,total_order:bigint,tx_id:string,before:string,after:string>"


class Ingestion:
    """start() begins the stream of a Config over the tables of a Registry; outcomes are written batch by batch."""

    def __init__(self, spark: SparkSession, config: Config, registry: Registry):
        S.writer_for(config.sink_mode if config.sink_mode != "table" else "parquet")
        self.spark, self.config, self.registry = spark, config, registry
        self.progress = M.Progress() if config.monitor_enabled else None
        self.state = config.state_path or f"{config.csv_path}/_state"

    def events(self) -> DataFrame:
        """Decoded changes of the wanted tables, with `table`."""
        raw = R.routed(E.read_stream(self.spark, self.config), self.config.topic_prefix, self.config.capture_database, self.config.include_tables)
        if self.config.value_format == "json":
            return E.decode_changes(raw.select("topic", "value")).withColumn("table", R.table_of(F.col("topic")))
        out = None
        for (database, table), schema in self.registry.avro.items():  # each table's records have a schema of their own
            row, _ = self.registry.get(database, table)
            part = raw.where(F.lower("table") == table).select("topic", "value", E.from_avro(F.expr("substring(value, 6)"), schema).alias("event"))
            part = E.decode_avro_changes(part, row).withColumns({s: F.to_json(s) for s in ("before", "after")}).withColumn("table", F.lit(table))
            out = part if out is None else out.unionByName(part)
        return out

    def metadata(self) -> DataFrame:
        raw = E.read_stream(self.spark, self.config, E.TRANSACTIONS)
        if self.config.value_format == "json":
            return E.decode_metadata(raw)
        return E.decode_avro_metadata(raw.select("value", E.from_avro(F.expr("substring(value, 6)"), AVRO_METADATA).alias("event")))

    def outcomes(self) -> DataFrame:
        """Rows of assembler.OUT: committed (also those without a transaction), expired, late, unreadable."""
        events = self.events()
        tx = F.col("transaction.id")
        body = F.to_json(F.struct(F.col("source.db").alias("db"), "op", "ts_us", F.col("transaction.total_order").alias("total_order"), tx.alias("tx_id"), "before", "after"))
        rows = events.withColumns({"body": body, "tx_id": tx, "total_order": F.coalesce("transaction.total_order", F.lit(0).cast("long")), "data_collection_order": F.coalesce("transaction.data_collection_order", F.lit(0).cast("long"))})
        good = rows.where("error IS NULL")
        columns = ["tx_id", "outcome", "table", "ts_ms", "total_order", "data_collection_order", "body"]
        held = Z.assemble_keyed(Z.items(good.where(R.transactional(tx)), self.metadata()), self.config.transaction_timeout)
        told = F.to_json(F.struct("error.message", F.base64("error.original_data").alias("original_data")))
        fine = F.col("error").isNull()
        # one branch for both, as each branch of the stream reads and decodes its messages anew
        rest = rows.where(~fine | ~R.transactional(tx)).withColumns({"outcome": F.when(fine, "committed").otherwise("unreadable"), "body": F.when(fine, F.col("body")).otherwise(told)})
        return held.select(*columns).unionByName(rest.select(*columns))

    def typed(self, rows: DataFrame, database: str, table: str) -> DataFrame:
        """Committed rows of one table as typed events, with `order` to apply them by."""
        row, _ = self.registry.get(database, table)
        b = F.from_json("body", BODY)
        here = rows.where((F.col("outcome") == "committed") & (F.lower("table") == table)).withColumn("b", b)
        here = here.select("table", "ts_ms", F.col("b.op").alias("op"), F.col("b.before").alias("before"), F.col("b.after").alias("after"), F.struct("b.ts_us", F.coalesce("b.total_order", F.lit(0).cast("long")).alias("place")).alias("order"), F.struct(F.col("b.tx_id").alias("id"), F.col("b.total_order").alias("total_order")).alias("transaction"), F.lit(None).cast("string").alias("error"))
        return A.with_transaction(E.typed(here, row))

    def put(self, batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        tables = {(d, t): self.typed(batch, d, t) for d, t in self.registry.tables()}
        for attempt in range(self.config.max_retries + 1):
            try:
                self._write(batch, tables, number)
                break
            except Exception:
                if attempt == self.config.max_retries:
                    raise
        batch.unpersist()

    def _write(self, batch: DataFrame, tables: dict, number: int) -> None:
        path = self.config.csv_path
        if self.config.sink_mode == "table":
            for (database, table), events in tables.items():
                at = S.table_path(path, database, table)
                keys = list(self.registry.get(database, table)[1])
                old = self.spark.read.parquet(f"{at}/version={number - 1}") if number else None
                A.fold(old, events, keys, "order").write.mode("overwrite").parquet(f"{at}/version={number}")
        else:
            S.write_tables(tables, path, self.config.sink_mode, self.config.csv_header, number)
        dead = batch.where("outcome <> 'committed' AND outcome <> ''")
        dead.write.mode("overwrite").parquet(f"{path}/_dead_letters/batch={number}")
        if self.config.monitor_enabled:
            now = F.lit(int(time.time() * 1000))
            done = batch.where("outcome = 'committed'").withColumn("op", F.get_json_object("body", "$.op"))
            counted = done.groupBy("table", "op").agg(F.count("*").alias("n"), F.count_distinct("tx_id").alias("transactions"), F.sum(F.octet_length("body")).alias("bytes"))
            counted.join(M.total_latency(done, now), ["table", "op"]).write.mode("overwrite").parquet(f"{path}/_metrics/batch={number}")

    def start(self, once: bool = False) -> StreamingQuery:
        """once: what is there now; else a batch every flush interval until stopped."""
        if self.progress:
            self.spark.streams.addListener(self.progress)
        trigger = {"availableNow": True} if once else {"processingTime": f"{self.config.flush_interval_ms} milliseconds"}
        return self.outcomes().writeStream.foreachBatch(self.put).option("checkpointLocation", self.state).trigger(**trigger).start()

    def table(self, database: str, table: str, version: int) -> DataFrame:
        """A table of sink mode `table` as of a batch."""
        got = self.spark.read.parquet(f"{S.table_path(self.config.csv_path, database, table)}/version={version}")
        return got.where("image IS NOT NULL").select("image.*")


#: Schema of transaction metadata as connectors send it (fixed values).
AVRO_METADATA = """{"type": "record", "name": "TransactionMetadataValue", "fields": [
{"name": "status", "type": "string"}, {"name": "id", "type": "string"}, {"name": "event_count", "type": ["null", "long"]},
{"name": "data_collections", "type": ["null", {"type": "array", "items": {"type": "record", "name": "DataCollection", "fields": [
{"name": "data_collection", "type": "string"}, {"name": "event_count", "type": "long"}]}}]},
{"name": "ts_ms", "type": "long"}]}"""


def service(spark: SparkSession, config: Config, registry: Registry) -> Z.Service:
    """An ingestion to start and stop from code."""
    return Z.Service(spark, lambda s: Ingestion(s, config, registry).start())
