"""Transactions put together from row events and metadata, in whatever order they came.

events: tx_id, table, data_collection_order, total_order and more. metadata: status, id, event_count,
ts_ms, data_collections, as decoded. Everything is a join or aggregation on the transaction id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.folders import fresh


def collection_table(name: Column) -> Column:
    """Connectors name a collection by database, schema or both; the table is the last part."""
    return F.element_at(F.split(name, r"\."), -1)


def table_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("tx_id", "table").agg(F.count("*").alias("n"))


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("tx_id").agg(F.count("*").alias("n"))


def ends(metadata: DataFrame) -> DataFrame:
    """One END for each transaction, repeated ones folded."""
    return metadata.where("status = 'END'").groupBy("id").agg(F.max("ts_ms").alias("ts_ms"), F.max_by("data_collections", "ts_ms").alias("data_collections"))


def completeness(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """(tx_id, expected, received, complete) of ended transactions: complete if each table has as many rows as declared, or more."""
    told = ends(metadata).select(F.col("id").alias("tx_id"), F.explode_outer("data_collections").alias("c"))
    told = told.select("tx_id", collection_table(F.col("c.data_collection")).alias("table"), F.coalesce("c.event_count", F.lit(0)).alias("expected"))
    both = told.join(table_counts(events), ["tx_id", "table"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return both.groupBy("tx_id").agg(F.sum("expected").alias("expected"), F.sum("n").alias("received"), F.every(F.col("n") >= F.col("expected")).alias("complete"))


def committed_rows(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """Events of complete transactions."""
    done = completeness(events, metadata).where("complete").select("tx_id")
    return events.join(done, "tx_id", "left_semi")


def orphans(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """Events of transactions without a BEGIN."""
    return events.join(metadata.where("status = 'BEGIN'").select(F.col("id").alias("tx_id")), "tx_id", "left_anti")


def ends_without_begin(metadata: DataFrame) -> DataFrame:
    begun = metadata.where("status = 'BEGIN'").select("id")
    return metadata.where("status = 'END'").join(begun, "id", "left_anti").select(F.col("id").alias("tx_id")).distinct()


def order_gaps(events: DataFrame) -> DataFrame:
    """(tx_id, table, after, before): neighbouring orders more than one apart."""
    w = Window.partitionBy("tx_id", "table").orderBy("data_collection_order")
    rows = events.select("tx_id", "table", F.lag("data_collection_order", 1, 0).over(w).alias("after"), F.col("data_collection_order").alias("before"))
    return rows.where("before > after + 1")


def out_of_order(events: DataFrame, arrival: str) -> DataFrame:
    """Events that came after one of their transaction and table with a higher order."""
    w = Window.partitionBy("tx_id", "table").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("__most", F.max("data_collection_order").over(w)).where("__most > data_collection_order").drop("__most")


def cursors(events: DataFrame) -> DataFrame:
    """(tx_id, table, cursor): the order that each table waits for, one after those that came without a gap."""
    w = Window.partitionBy("tx_id", "table").orderBy("data_collection_order")
    orders = events.select("tx_id", "table", "data_collection_order").distinct().withColumn("rank", F.row_number().over(w))
    return orders.groupBy("tx_id", "table").agg((F.count(F.when(F.col("rank") == F.col("data_collection_order"), 1)) + 1).alias("cursor"))


def ranked(df: DataFrame, order: str, tie: str, name: str, per_bucket: int = 1_000_000) -> DataFrame:
    """Add name: 1, 2, ... by (order, tie), without ordering all rows in one task.

    Rows are dealt into ranges of about per_bucket rows (or the root of their number, if that is more) and numbered inside
    each; the ranges' sizes are added up. The ranges are written, as both uses must see the same ones.
    """
    spark, path = df.sparkSession, fresh(df.sparkSession)
    n = df.count()
    parts = max(1, -(-n // max(per_bucket, int(n**0.5))))
    df.repartitionByRange(parts, order, tie).withColumn("__bucket", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__bucket", T.IntegerType())])).parquet(path)
    sizes = rows.groupBy("__bucket").agg(F.count("*").alias("__size"))
    w = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # of `parts` rows
    sizes = sizes.select("__bucket", F.coalesce(F.sum("__size").over(w), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy(order, tie))
    return rows.join(F.broadcast(sizes), "__bucket").withColumn(name, (inside + F.col("__before")).cast("long")).drop("__bucket", "__before")


def commit_ids(metadata: DataFrame) -> DataFrame:
    """(tx_id, commit_id): ended transactions numbered by the time of their END, then by id."""
    return ranked(ends(metadata).select(F.col("id").alias("tx_id"), "ts_ms"), "ts_ms", "tx_id", "commit_id").select("tx_id", "commit_id")


def expired(events: DataFrame, metadata: DataFrame, timeout_ms: int) -> DataFrame:
    """(tx_id, last_ts): transactions without END whose last event is older than the timeout, by the newest event's time."""
    now = events.agg(F.max("ts_ms")).first()[0]
    last = events.groupBy("tx_id").agg(F.max("ts_ms").alias("last_ts"))
    return last.join(metadata.where("status = 'END'").select(F.col("id").alias("tx_id")), "tx_id", "left_anti").where(F.lit(now) - F.col("last_ts") > timeout_ms)
