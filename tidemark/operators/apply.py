"""Changes applied to tables by key.

changes: op, before, after (structs of one row type) and an order column; later orders win. An update
that changes the key deletes the old one and inserts the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import java_hash


def index_key(columns: list[str]) -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns])


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def _steps(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(key, order, image): image null for a delete."""
    nothing = F.when(F.lit(False), F.col("after"))
    of = lambda s: F.struct(*[F.col(f"{s}.{k}").alias(k) for k in keys])
    step = lambda key, image, sub: F.struct(key.alias("key"), F.struct(F.col(order).alias("o"), F.lit(sub).alias("s")).alias("order"), image.alias("image"))
    moved = (F.col("op") == "UPDATE") & F.col("before").isNotNull() & (of("before") != of("after"))
    each = (
        F.when(F.col("op") == "DELETE", F.array(step(of("before"), nothing, 0)))
        .when(moved, F.array(step(of("before"), nothing, 0), step(of("after"), F.col("after"), 1)))
        .otherwise(F.array(step(of("after"), F.col("after"), 1)))
    )
    return changes.where("op IN ('INSERT', 'SNAPSHOT', 'UPDATE', 'DELETE')").select(F.explode(each).alias("x")).select("x.*")


def fold(state: DataFrame | None, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(key, order, image) of every key ever seen, image null once deleted, from such a state and further changes.

    The larger order wins wherever it stands, so changes that come late, twice or in another order give the same state.
    """
    steps = _steps(changes, keys, order)
    both = steps if state is None else state.unionByName(steps)
    last = both.groupBy("key").agg(F.max_by(F.struct("order", "image"), "order").alias("m"))
    return last.select("key", F.col("m.order").alias("order"), F.col("m.image").alias("image"))


def latest(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(key, image): each key's last state, image null if it was deleted. One shuffle on the key, partial sums before it."""
    last = _steps(changes, keys, order).groupBy("key").agg(F.max_by(F.struct("image"), "order").alias("m"))
    return last.select("key", F.col("m.image").alias("image"))


def replay(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The table that the changes make of an empty one."""
    return latest(changes, keys, order).where("image IS NOT NULL").select("image.*")


def merge(target: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The table that the changes make of target."""
    last = latest(changes, keys, order)
    touched = last.select(*[F.col(f"key.{k}").alias(k) for k in keys])
    return target.join(touched, keys, "left_anti").unionByName(last.where("image IS NOT NULL").select("image.*"))


def with_transaction(events: DataFrame) -> DataFrame:
    """Events with `_tx_order` and `_tx_hash`: the place in their transaction and a hash of its id; null without one."""
    return events.withColumns({"_tx_order": F.col("transaction.total_order"), "_tx_hash": java_hash(F.col("transaction.id"))})
