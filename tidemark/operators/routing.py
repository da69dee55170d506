"""Filters and names by topic, table and operation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_of(topic: Column) -> Column:
    """The part after the last dot."""
    return F.element_at(F.split(topic, r"\."), -1)


def full_name(db: Column, table: Column) -> Column:
    return F.concat_ws(".", db, table)


def routed(df: DataFrame, prefix: str, database: str, include: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose topic is <prefix>.<database>.<table>, of the included tables (none named: all), with `table`."""
    out = df.where(F.col("topic").startswith(f"{prefix}.{database}.")).withColumn("table", table_of(F.col("topic")))
    return out.where(F.col("table").isin(*include)) if include else out


def new_topics(topics: DataFrame, known: DataFrame) -> DataFrame:
    return topics.join(known, "topic", "left_anti")


def with_flags(events: DataFrame) -> DataFrame:
    op = F.col("op")
    return events.withColumns(
        {
            "is_insert": op == "INSERT",
            "is_update": op == "UPDATE",
            "is_delete": op == "DELETE",
            "is_snapshot": op == "SNAPSHOT",
            "has_before": op.isin("UPDATE", "DELETE"),
            "has_after": op.isin("INSERT", "UPDATE", "SNAPSHOT"),
        }
    )


def transactional(tx_id: Column) -> Column:
    return F.coalesce(tx_id, F.lit("")) != ""
