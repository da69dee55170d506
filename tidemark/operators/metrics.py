"""Counters and latencies of a run, as aggregations of its events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources.folders import fresh

#: Quantiles and the accuracy that percentile_approx needs for their allowed errors (fixed values).
QUANTILES = {0.5: 20, 0.75: 100, 0.95: 200, 0.99: 1000}


def table_changes(events: DataFrame) -> DataFrame:
    return events.groupBy("table").agg(F.count("*").alias("n"))


def row_changes(events: DataFrame) -> DataFrame:
    return events.groupBy("table", "op").agg(F.count("*").alias("n"))


def totals(events: DataFrame) -> DataFrame:
    """Row changes with subtotals by table and in all."""
    return events.rollup("table", "op").agg(F.count("*").alias("n"))


def transactions(committed: DataFrame) -> DataFrame:
    return committed.agg(F.count_distinct("tx_id").alias("n"))


def bytes_read(events: DataFrame) -> DataFrame:
    return events.groupBy("table").agg(F.sum("bytes").alias("bytes"))


def latency(df: DataFrame, column: str, by: list[str], exact: bool = False) -> DataFrame:
    """p50, p75, p95 and p99 of a latency; approximate ones within the allowed errors."""
    if exact:
        return percentiles(df, column, by)
    return df.groupBy(*by).agg(*[F.percentile_approx(column, q, a).alias(f"p{round(100 * q)}") for q, a in QUANTILES.items()])


def percentiles(df: DataFrame, column: str, by: list[str], per_range: int = 100_000) -> DataFrame:
    """QUANTILES as F.percentile has them, without all values of a group in one task.

    Values are counted and dealt into ranges of about per_range of them (or the root of their number, if that is more);
    only the ranges that hold a wanted place are numbered inside. Both steps are written, as later ones must see the same rows.
    """
    spark, at = df.sparkSession, fresh(df.sparkSession)
    counted = df.select(F.struct(*by).alias("g"), F.col(column).alias("v")).groupBy("g", "v").agg(F.count("*").alias("n"))
    counted.write.parquet(f"{at}/counted")
    counted = spark.read.schema(counted.schema).parquet(f"{at}/counted")
    n = counted.count()
    parts = max(1, -(-n // max(per_range, int(n**0.5))))
    some = counted.where("v IS NOT NULL").repartitionByRange(parts, "g", "v").withColumn("part", F.spark_partition_id())
    some.write.parquet(f"{at}/ranges")
    rows = spark.read.schema(some.schema).parquet(f"{at}/ranges")
    w = Window.partitionBy("g").orderBy("part")  # of as many rows as ranges
    sizes = rows.groupBy("g", "part").agg(F.sum("n").alias("size")).withColumn("first", F.sum("size").over(w) - F.col("size"))
    place = lambda q: (F.sum("size") - 1) * F.lit(q)
    places = sizes.groupBy("g").agg(F.array(*[F.struct(F.lit(q).alias("q"), place(q).alias("at")) for q in QUANTILES]).alias("p")).select("g", F.inline("p"))
    # a quantile lies between the values at the places below and above it
    places = places.select("g", "q", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("k"))
    held = places.join(sizes, "g").where("k >= first AND k < first + size")
    wanted = held.select("g", "part", "first").distinct()
    inside = rows.join(wanted, ["g", "part"]).withColumn("end", F.col("first") + F.sum("n").over(Window.partitionBy("g", "part").orderBy("v")))
    found = held.select("g", "part", "q", "at", "k").join(inside.select("g", "part", "v", "n", "end"), ["g", "part"]).where("k >= end - n AND k < end")
    found = found.groupBy("g", "q", "at").agg(F.min_by("v", "k").cast("double").alias("low"), F.max_by("v", "k").cast("double").alias("high"))
    share = F.col("at") - F.floor("at")
    # equal neighbours are not mixed, as F.percentile does not; infinite ones would give NaN
    value = F.when((share == 0) | (F.col("low") == F.col("high")), F.col("low")).otherwise((F.ceil("at") - F.col("at")) * F.col("low") + share * F.col("high"))
    found = found.withColumn("value", value).groupBy("g").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{round(100 * q)}") for q in QUANTILES])
    return counted.select("g").distinct().join(found, "g", "left").select("g.*", *[f"p{round(100 * q)}" for q in QUANTILES])


def total_latency(events: DataFrame, now_ms: Column, exact: bool = False) -> DataFrame:
    """Quantiles of the time from a change to now_ms, by table and operation."""
    return latency(events.withColumn("__ms", now_ms - F.col("ts_ms")), "__ms", ["table", "op"], exact)


class Progress(StreamingQueryListener):
    """Keeps the durations of each micro-batch: write latency (addBatch) and what goes to offsets, planning and commits."""

    def __init__(self):
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += [(str(p.id), int(p.batchId), int(p.numInputRows), step, int(ms)) for step, ms in p.durationMs.items()]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        """(query, batch, rows, step, ms)"""
        return spark.createDataFrame(self.rows, "query string, batch bigint, rows bigint, step string, ms bigint")

    def latencies(self, spark: SparkSession) -> DataFrame:
        return self.frame(spark).groupBy("step").agg(*[F.percentile("ms", q).alias(f"p{round(100 * q)}") for q in QUANTILES])  # rows of the driver: few
