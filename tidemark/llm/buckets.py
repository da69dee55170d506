"""Pairs inside the buckets of a join, without a task for a whole hot bucket and without emitting pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(rows: DataFrame, keys: list[str], node: str, most: int) -> DataFrame:
    """Rows of buckets with two members or more, dealt into cells of at most about 2 * `most` rows.

    A bucket of n rows gets k = ceil(n / most) chunks by a hash of the node and a cell for each pair of
    chunks, so every pair of its rows meets in exactly one cell: in (c, c) if both are of chunk c, else in
    (c, d), where only pairs across count. Adds cell (long), lo, hi and mine (int).
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.ceil(F.col("n") / most).cast("int").alias("k"))
    rows = rows.join(sizes, keys).withColumn("mine", F.pmod(F.xxhash64(node), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
    return rows.withColumn("cell", F.xxhash64(*keys, "lo", "hi")).drop("k", "other")


def by_cell(df: DataFrame, work: Callable[[dict], tuple | None], schema: str, names: tuple[str, ...], types: list[pa.DataType]) -> DataFrame:
    """Shuffle rows by cell and call work once a cell with its columns; a cell's rows are what a task holds at once.

    Number columns come as numpy arrays, others as Arrow arrays. work gives columns, or None.
    """
    width = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    columns = df.columns
    at = columns.index("cell")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            keys = held.column(at).to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if len(cuts):
                held = held.combine_chunks()
                starts = [0, *cuts.tolist()]
                for a, b in zip(starts, starts[1:]):
                    yield held.slice(a, b - a)
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield held.combine_chunks()

    def run(batches):
        out: list[tuple] = []
        rows = 0
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            cols = {}
            for name in columns:
                c = group.column(name)
                c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
                c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
                cols[name] = c.to_numpy(zero_copy_only=False) if pa.types.is_integer(c.type) else c
            got = work(cols)
            if got is not None and len(got[0]):
                out.append(got)
                rows += len(got[0])
            if rows > 50_000:
                yield emit(out)
                out, rows = [], 0
        if out:
            yield emit(out)

    def emit(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out]), type=t) for i, t in enumerate(types)], names=list(names))

    return df.repartition(int(width), "cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def matrix(lists: pa.Array, dtype) -> np.ndarray:
    """Lists of one length as rows."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1).astype(dtype, copy=False)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new
